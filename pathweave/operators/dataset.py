"""Merge and preprocess operators over the ``samples`` table.

``samples``: file string, line bigint, target array<string>,
contexts array<struct<start,path,end>> (+ any order columns).

Scale notes
-----------
* First-wins dedup is ``min_by`` per mark: a map-side partial aggregate, so a
  mark repeated in a third of all raw rows still leaves each map task with one
  row for it.  Of a stored table, only copies of repeated marks go through it.
* Ids, shuffle order and splits come from a dense rank over
  ``md5(seed:file:line)``.  The md5 prefix spreads rows evenly over up to 16^5
  buckets; bucket sizes are counted (partial aggregate, at most 16^5 rows,
  broadcast), and a row's id is its bucket offset plus its place inside the
  bucket.  No global window, no driver-side loop.
* Context sampling and padding are in-row array functions (no explode/regroup).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DatasetConfig  # noqa: F401  (re-exported)
from ..functions.text import format_sample, pad_row

HASH_HEX_DIGITS = 5  # 16^5 buckets at most: offsets table <= 1,048,576 rows


def seeded_hash(seed: int, *cols) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c
                                                        for c in cols]))


# ------------------------------------------------------------- I1 / D8 merge
def merge_raw(*parts: DataFrame) -> DataFrame:
    """Bag union of raw sample sets (equal rows are all kept)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dedup_first(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """First row per ``keys`` in ``order_cols`` order (a total order is the caller's duty)."""
    payload = [c for c in df.columns if c not in keys]
    w = F.min_by(F.struct(*payload), F.struct(*[F.col(c) for c in order_cols])).alias("_w")
    return df.groupBy(*keys).agg(w).select(*keys, *[F.col("_w")[c].alias(c) for c in payload])


def dedup_first_stored(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """``dedup_first`` of a stored table, whose keys can be read without its payload.

    A count over the keys alone finds the repeated marks; only their copies are
    compared.  Rows of the others pass by an anti join: neither sorted nor shuffled
    where the repeated marks are few enough for Spark to broadcast, else by a
    sort-merge join on the keys.  Null keys are equal.
    """
    repeated = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    once = df.join(repeated, same, "left_anti")
    return once.unionByName(dedup_first(df.join(repeated, same, "left_semi"), keys, order_cols))


# ------------------------------------------------------- G1 / H3 dense ranks
def hash_rank(df: DataFrame, key_cols: list[str], seed: int, out: str = "sample_id", ties: tuple = ()) -> DataFrame:
    """Dense 0-based rank of rows by ``md5(seed:key...)``, then the keys, then ``ties`` (distributed)."""
    h = seeded_hash(seed, *key_cols)
    with_b = (df.withColumn("_h", h)
              .withColumn("_b", F.conv(F.substring("_h", 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")))
    counts = with_b.groupBy("_b").agg(F.count("*").alias("_n"))
    offsets = counts.select("_b", (F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
                                   - F.col("_n")).alias("_off"))
    w = Window.partitionBy("_b").orderBy("_h", *key_cols, *ties)
    return (with_b.join(F.broadcast(offsets), "_b")
            .withColumn(out, (F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
            .drop("_h", "_b", "_off"))


# -------------------------------------------------------------- G2 / J10 split
def split_sizes(n: int, cfg: DatasetConfig) -> tuple[int, int, int]:
    train = int(n * cfg.train_ratio)
    test = (n - train) // 2
    val = n - train - test if cfg.keep_remainder else test
    return train, test, val


def split_expr(rank: Column, n_col: Column, cfg: DatasetConfig) -> Column:
    """train = floor(ratio*n), test = val = (n-train) div 2; an odd remainder is dropped."""
    train = F.floor(n_col * F.lit(cfg.train_ratio)).cast("bigint")
    test = F.floor((n_col - train) / 2).cast("bigint")
    val_end = n_col if cfg.keep_remainder else train + test * 2
    return (F.when(rank < train, "train").when(rank < train + test, "test")
            .when(rank < val_end, "val"))


def shuffle_split(samples: DataFrame, cfg: DatasetConfig, n: int | None = None) -> DataFrame:
    """Adds ``sample_id`` (shuffled position) and ``split``; drops the remainder sample.

    ``samples`` should be materialised (it is counted once and ranked once).
    """
    if n is None:
        n = samples.count()
    ranked = hash_rank(samples, ["file", "line"], cfg.seed)
    return (ranked.withColumn("split", split_expr(F.col("sample_id"), F.lit(n).cast("bigint"), cfg))
            .where(F.col("split").isNotNull()))


def shuffle_split_in_place(samples: DataFrame, cfg: DatasetConfig, row: str, n: int | None = None) -> DataFrame:
    """The ``split`` of ``shuffle_split`` without moving the samples, which get no ``sample_id``.

    Only the keys and ``row``, a stored unique id that orders samples with equal keys, are ranked.
    The (at most three) rows where a split ends are looked up, and every sample is compared
    with them, so its contexts are neither shuffled nor sorted.  ``samples`` should be materialised.
    """
    if n is None:
        n = samples.count()
    train, test, val = split_sizes(n, cfg)
    keys = ["file", "line", row]
    ends = {"train": train, "test": train + test, "val": train + test + val}
    ranked = hash_rank(samples.select(*keys), keys[:2], cfg.seed, ties=(row,))
    found = {r["sample_id"]: r for r in ranked.where(F.col("sample_id").isin(list(ends.values()))).collect()}
    place = F.struct(seeded_hash(cfg.seed, *keys[:2]).alias("h"), *keys)
    split = F.lit(None).cast("string")
    for name, end in reversed(ends.items()):
        if end in found:
            at = found[end]
            edge = F.struct(seeded_hash(cfg.seed, *[F.lit(at[k]).cast("string") for k in keys[:2]]).alias("h"),
                            *[F.lit(at[k]).cast(samples.schema[k].dataType).alias(k) for k in keys])
            split = F.when(place < edge, F.lit(name)).otherwise(split)
        else:                                   # no sample is past this end
            split = F.lit(name)
    return samples.withColumn("split", split).where(F.col("split").isNotNull())


# ------------------------------------------------------------------ G3 / J6
def sample_contexts(df: DataFrame, cfg: DatasetConfig) -> DataFrame:
    """Keep at most N contexts per row (train: max_data_contexts, else max_contexts),
    uniformly without replacement by a seeded hash; rows within the limit keep their order.

    ``contexts`` may be structs or texts; where ``n_contexts`` is their number, counts are taken from it alone."""
    n = F.col("n_contexts") if "n_contexts" in df.columns else F.size("contexts")
    limit = F.when(F.col("split") == "train", F.lit(cfg.max_data_contexts)).otherwise(F.lit(cfg.max_contexts))
    keyed = F.transform("contexts", lambda c, i: F.struct(
        F.md5(F.concat_ws(":", F.lit(str(cfg.seed)), F.col("file"), F.col("line").cast("string"),
                          i.cast("string"))).alias("k"), c.alias("c")))
    sampled = F.transform(F.slice(F.array_sort(keyed), 1, limit), lambda x: x["c"])
    return (df.withColumn("n_before", n)
            .withColumn("contexts", F.when(F.col("n_before") > limit, sampled).otherwise(F.col("contexts")))
            .withColumn("n_after", F.when(F.col("n_before") > limit, limit).otherwise(F.col("n_before"))))


def padded_lines(df: DataFrame, cfg: DatasetConfig) -> DataFrame:
    """``target ctx ctx ...`` plus one space per context short of max_data_contexts."""
    n = F.col("n_after") if "n_after" in df.columns else F.size("contexts")
    texts = df.schema["contexts"].dataType.elementType.typeName() == "string"
    return df.withColumn("text", pad_row(format_sample("target", "contexts", texts), n, cfg.max_data_contexts))


# ------------------------------------------------------------------ F4 / F5
def split_stats(df: DataFrame) -> DataFrame:
    """Per split: average contexts before / after sampling, examples, maximum before."""
    return df.groupBy("split").agg(
        F.avg("n_before").alias("avg_total"), F.avg("n_after").alias("avg_final"),
        F.count("*").alias("n_examples"), F.max("n_before").cast("bigint").alias("max_contexts"))
