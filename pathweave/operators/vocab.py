"""Histograms, vocabularies and vocabulary look-ups.

Scale notes
-----------
* Histograms are ``explode`` + ``groupBy().count()`` (partial aggregation).
* Top-N and indices need a global order ``(cnt desc, token)`` per kind.  That
  is a range-partitioned sort; each row's rank is its offset inside its range
  partition plus the sizes of the partitions before it (one small table with
  one row per partition, broadcast).  No single-task ``TakeOrderedAndProject``
  of N rows per partition, no global window.
* Look-ups join against the vocabulary; only the cut vocabularies (bounded by
  their configured size) are broadcast explicitly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import BAR
from ..session import cut_lineage
from .tree import context_rows

KINDS = ("target", "subtoken", "node")


# ------------------------------------------------------------------ F1-F3
def token_rows(samples: DataFrame, kinds: tuple = KINDS) -> DataFrame:
    """(kind, token) for every target subtoken, context-end subtoken and path node, of the ``kinds`` asked for."""
    def of(kind, df, tokens):
        # an inner explode would first ask whether the array is empty, which builds it a second time
        return df.select(F.lit(kind).alias("kind"), F.posexplode_outer(tokens).alias("_pos", "token")).where(
            F.col("_pos").isNotNull()).drop("_pos")

    parts = []
    if "target" in kinds:
        parts.append(of("target", samples, "target"))
    if "subtoken" in kinds:
        parts.append(of("subtoken", context_rows(samples), F.concat("start", "end")))
    if "node" in kinds:
        parts.append(of("node", context_rows(samples), "path"))
    return reduce(DataFrame.unionByName, parts)


def histograms(samples: DataFrame, kinds: tuple = KINDS) -> DataFrame:
    """kind, token, cnt (train rows only should be passed in)."""
    return token_rows(samples, kinds).groupBy("kind", "token").agg(F.count("*").alias("cnt"))


# ---------------------------------------------------------------- ranks
def global_rank(df: DataFrame, order_cols: list, out: str = "rank") -> DataFrame:
    """Exact 0-based position of each row in ``order_cols`` order (a total order).

    Range partitioning sorts the data across tasks; inside a partition
    ``monotonically_increasing_id`` is consecutive, so the local position is the
    id minus the partition's first id.  The partition table (one row per
    partition) gives the offsets.  The positioned rows are checkpointed so the
    partition ids used by both branches are the same rows.
    """
    parted = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    local = cut_lineage(parted.withColumn("_pid", F.spark_partition_id())
                        .withColumn("_mid", F.monotonically_increasing_id()))
    parts = local.groupBy("_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_m0"))
    offs = parts.select("_pid", "_m0", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("_n")).alias("_off"))
    return (local.join(F.broadcast(offs), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("bigint"))
            .drop("_pid", "_mid", "_m0", "_off"))


def ranked_vocab(hist: DataFrame) -> DataFrame:
    """Adds ``pos``: place of the token in its kind by falling count, ties by token."""
    kinds = F.when(F.col("kind") == "target", 0).when(F.col("kind") == "subtoken", 1).otherwise(2)
    ranked = global_rank(hist.withColumn("_k", kinds), [F.col("_k"), F.col("cnt").desc(), F.col("token")], "_r")
    first = ranked.groupBy("kind").agg(F.min("_r").alias("_r0"))
    return ranked.join(F.broadcast(first), "kind").withColumn("pos", F.col("_r") - F.col("_r0")).drop("_r", "_r0", "_k")


# ------------------------------------------------------------------ H1 / F7
def vocab_top_n(hist: DataFrame, sizes: dict) -> DataFrame:
    """kind, token, cnt, pos of the N most frequent tokens per kind (None = all)."""
    ranked = ranked_vocab(hist)
    cond = F.lit(False)
    for kind in KINDS:
        n = sizes.get(kind)
        cond = cond | ((F.col("kind") == kind) & (F.lit(True) if n is None else (F.col("pos") < n)))
    return ranked.where(cond)


def vocab_sizes(vocab: DataFrame) -> DataFrame:
    return vocab.groupBy("kind").agg(F.count("*").alias("size"))


# ------------------------------------------------------------------ G4 / I3
def vocab_index(vocab: DataFrame, specials: list[str]) -> DataFrame:
    """Index -> word with the specials first; ``word_idx`` is the word's final index.

    A token equal to a special takes the later index (the numbering still advances).
    """
    spark = vocab.sparkSession
    sp = spark.createDataFrame([(k, s, i) for k in KINDS for i, s in enumerate(specials)],
                               "kind string, token string, idx bigint")
    words = vocab.select("kind", "token", (F.col("pos") + len(specials)).cast("bigint").alias("idx"))
    both = sp.unionByName(words)
    final = both.groupBy("kind", "token").agg(F.max("idx").alias("word_idx"))
    return both.join(final, ["kind", "token"])


# ------------------------------------------------------------------ D5 / D6
BROADCAST_VOCAB_ROWS = 5_000_000  # a cut vocabulary up to this many tokens is broadcast


def context_vocab_flags(samples: DataFrame, vocab: DataFrame, subtoken_limit: int | None = None,
                        keep: list[str] | None = None) -> DataFrame:
    """Per context: whole start / path / end strings looked up in the subtoken and node vocabularies.

    The subtoken vocabulary is broadcast only when it was cut to ``subtoken_limit``
    tokens and that bound is small; otherwise the planner chooses the join.
    """
    keep = list(keep or [])
    ctx = context_rows(samples, "file", "line", *keep).select(
        "file", "line", *keep, "ctx_pos",
        F.array_join("start", BAR).alias("s"), F.array_join("path", BAR).alias("p"), F.array_join("end", BAR).alias("e"))
    sub = vocab.where(F.col("kind") == "subtoken").select(F.col("token").alias("_t"), F.lit(True).alias("_in"))
    node = vocab.where(F.col("kind") == "node").select(F.col("token").alias("_t"), F.lit(True).alias("_in"))
    if subtoken_limit is not None and subtoken_limit <= BROADCAST_VOCAB_ROWS:
        sub = F.broadcast(sub)
    out = ctx
    for col, voc, flag in (("s", sub, "in_start"), ("p", node, "in_path"), ("e", sub, "in_end")):
        out = (out.join(voc, out[col] == voc["_t"], "left")
               .withColumn(flag, F.coalesce("_in", F.lit(False))).drop("_t", "_in"))
    return (out.withColumn("full", F.col("in_start") & F.col("in_path") & F.col("in_end"))
            .withColumn("partial", F.col("in_start") | F.col("in_path") | F.col("in_end")))


def materialize(df: DataFrame) -> DataFrame:
    return cut_lineage(df)
