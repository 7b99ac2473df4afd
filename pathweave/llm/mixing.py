"""Mixing sources to target weights: fixed-length blocks, drawn into shards and looked up by permuted index.

1. Targets.  Sources in code-point order, null last, get the weights in turn and
   share all words by them.  A target stops at ``repeats`` times its source's
   words; the excess is shared again by weight until no target is above.
2. Blocks.  The documents of a source stand one after another in the order of a
   hash; that stream is cut into blocks of ``block_words`` words, the last one
   shorter.  A document's offset is that of its hash bucket plus its place in it.
3. Slots.  A source's target is so many whole rounds over its blocks and a part
   of one more, the last slot cut to the word: so many slots for each source.
   Every slot of a shard draws its source by these numbers, which makes the
   counts of a shard multinomial.  Slots that a source drew beyond its number
   (about the square root of all) are handed, in permuted order, to the sources that
   drew too few, so the words taken are the target.
4. Look-up.  The i-th slot of a source reads block p(i mod blocks) of the round
   i div blocks, p a pseudorandom permutation of that source and round, and meets
   the block by an equi-join on (source, index).

Scale: rows are narrow except the text pieces, which move twice, by bucket and
by block.  A source that holds a third of all words is spread over its 2^``bucket_bits``
buckets and over its blocks; no source, shard or block is gathered.  Windows run over a
bucket, a shard (``shard_slots`` rows), the shards of one source or 1/1024 of the sources.

Defined results: null texts count as empty; documents without words are in no
block; equal rows stand beside each other and count each; null doc_ids and
sources are values like others; an empty table, or one without words, gives an
empty mix; other columns are not read.  All draws are hashes of the seed, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pathweave.operators.vocab import global_rank
from pathweave.session import cut_lineage

from .quality import words

WORD = r"[^\x20\x09-\x0D]++"


@dataclass(frozen=True)
class MixConfig:
    weights: tuple = (5.0, 2.0, 1.0)    # of the sources in code-point order, repeating
    repeats: int = 3                    # a target is at most this many times its source's words
    block_words: int = 256
    shard_slots: int = 1024
    seed: int = 11
    bucket_bits: int = 12               # changes how offsets are computed, never the offsets
    cells: int = 4096                   # pieces into which a range of numbers is cut to be joined with intervals


# ------------------------------------------------------------------ permutations
def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit function of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray, back: bool = False, rounds: int = 6) -> np.ndarray:
    """Where ``index`` goes in the pseudorandom permutation of 0 .. size - 1 that ``key`` names (``back``: where from).

    Numbers are pairs (left, right) of an a * b grid that is little larger than
    ``size``.  Rounds add to one half a function of the other, which can be undone;
    a result outside goes round again, and comes back inside as a permutation has cycles.
    """
    size, key = size.astype(np.uint64), key.astype(np.int64).view(np.uint64)
    a = np.maximum(1, np.floor(np.sqrt(size.astype(np.float64)))).astype(np.uint64)
    b = (size + a - np.uint64(1)) // a
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        sa, sb, k = a[todo], b[todo], key[todo]
        left, right = out[todo] // sb, out[todo] % sb
        for r in range(rounds)[::-1 if back else 1]:
            other, width = (right, sa) if r % 2 == 0 else (left, sb)
            by = _mixed(_mixed(other + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)) ^ k) % width
            by = width - by if back else by
            if r % 2 == 0:
                left = (left + by) % width
            else:
                right = (right + by) % width
        out[todo] = left * sb + right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def _permuted(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(index.to_numpy(), size.to_numpy(), key.to_numpy()))


def _permuted_from(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(index.to_numpy(), size.to_numpy(), key.to_numpy(), back=True))


def permuted(index: Column, size: Column, key: Column, back: bool = False) -> Column:
    return F.pandas_udf(_permuted_from if back else _permuted, LongType())(index, size, key)


# ------------------------------------------------------------------ tables of ranges
def running_sum(rows: DataFrame, place: str, value: str, out: str, step: int = 1024) -> DataFrame:
    """Add ``out``, the sum of ``value`` over the rows before, by ``place`` (dense from 0): within steps, then over steps."""
    stepped = rows.withColumn("__step", F.floor(F.col(place) / step))
    before = stepped.groupBy("__step").agg(F.sum(value).alias("__sum")).select("__step", F.coalesce(
        F.sum("__sum").over(Window.orderBy("__step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("__step").orderBy(place).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    return stepped.withColumn("__inside", inside).join(before, "__step") \
        .withColumn(out, F.col("__before") + F.col("__inside")).drop("__step", "__inside", "__before")


def by_interval(points: DataFrame, at: str, owners: DataFrame, first: str, length: str, total: int, cells: int) -> DataFrame:
    """Points joined with the owner whose interval [first, first + length) of 0 .. total - 1 holds ``at``: an equi-join by cell."""
    width = F.lit(max(1, -(-total // cells)))
    cell = lambda c: F.floor(c / width)
    spread = owners.where(F.col(length) > 0).withColumn(
        "__cell", F.explode(F.sequence(cell(F.col(first)), cell(F.col(first) + F.col(length) - 1))))
    return points.withColumn("__cell", cell(F.col(at))).join(spread, "__cell") \
        .where((F.col(at) >= F.col(first)) & (F.col(at) < F.col(first) + F.col(length))).drop("__cell")


# ------------------------------------------------------------------ 1. targets
def with_targets(sources: DataFrame, cfg: MixConfig) -> DataFrame:
    """Sources (source, source_size) with ``src``, their place in code-point order, and ``target``.

    The level at which all weights are served rises until no further source
    reaches its cap; each rise takes one aggregation.
    """
    ranked = global_rank(sources, [F.col("source").isNull(), F.col("source")], "src")
    weights = F.array(*[F.lit(float(w)) for w in cfg.weights])
    ranked = cut_lineage(ranked.withColumn("weight", F.get(weights, (F.col("src") % len(cfg.weights)).cast("int")))
                         .withColumn("cap", cfg.repeats * F.col("source_size")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        capped, weight = ranked.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        raised = (total - (capped or 0)) / weight if weight else level
        if raised <= level:
            break
        level = raised
    return ranked.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")))


def _key(cfg: MixConfig, what: str, *cols) -> Column:
    return F.xxhash64(F.lit(cfg.seed), F.lit(what), *cols)


def with_slots(sources: DataFrame, cfg: MixConfig) -> DataFrame:
    """Add ``blocks``, ``tail`` (words of the last block), ``slots`` and ``spare``, the words that the last slot leaves out."""
    b = cfg.block_words
    up = lambda x: F.ceil(x / F.lit(b))
    s = sources.where("source_size > 0").withColumns({
        "words": F.least(F.round("target").cast("long"), F.col("cap")), "blocks": up(F.col("source_size"))})
    s = s.withColumns({"tail": F.col("source_size") - (F.col("blocks") - 1) * b,
                       "rounds": F.floor(F.col("words") / F.col("source_size"))})
    s = s.withColumns({"rest": F.col("words") - F.col("rounds") * F.col("source_size"),
                       "tail_at": permuted(F.col("blocks") - 1, F.col("blocks"), _key(cfg, "block", "src", F.col("rounds")), back=True)})
    # the short block is among those of the last, partial round or not
    short = F.when(F.col("tail_at") < up(F.col("rest")), b - F.col("tail")).otherwise(0)
    s = s.withColumns({"part": F.when(F.col("rest") > 0, up(F.col("rest") + short)).otherwise(0),
                       "spare": F.when(F.col("rest") > 0, up(F.col("rest") + short) * b - short - F.col("rest")).otherwise(0)})
    return s.withColumn("slots", (F.col("rounds") * F.col("blocks") + F.col("part")).cast("long")).drop("rest", "tail_at", "part")


# ------------------------------------------------------------------ 2. blocks
def _h(docs: DataFrame) -> Column:
    return F.xxhash64("doc_id", "text")


def lay_out(docs: DataFrame, cfg: MixConfig = MixConfig(), text: bool = True) -> tuple[DataFrame, DataFrame]:
    """Documents as (doc_id, source, src, size, offset[, text]) and the sources with their targets.

    ``offset`` counts the words of the source before the document's.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), _h(docs).alias("h"),
                       *([F.coalesce("text", F.lit("")).alias("text")] if text else [])) \
        .withColumn("bucket", F.shiftrightunsigned("h", 64 - cfg.bucket_bits))
    sums = cut_lineage(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")))
    sources = cut_lineage(with_targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), cfg))
    names = sources.select(F.col("source").alias("__source"), "src")
    known = lambda df: df.join(names, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = known(sums).select("src", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    # the bucket is the hash's first bits, so any number of them gives the same order
    place = Window.partitionBy("src", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = known(rows).withColumn("inside", F.coalesce(F.sum("size").over(place), F.lit(0))).join(starts, ["src", "bucket"])
    return placed.select("doc_id", "source", "src", "size", (F.col("start") + F.col("inside")).alias("offset"),
                         *(["text"] if text else [])), sources


def pieces(laid: DataFrame, cfg: MixConfig) -> DataFrame:
    """A row for each block that a document has words in: block, at (place there), start (in the document), length[, text]."""
    b = cfg.block_words
    end = F.col("offset") + F.col("size")
    last = F.floor((end - 1) / b)
    ws = words(F.col("text")) if "text" in laid.columns else None

    def piece(i):
        start, stop = F.greatest(i * b - F.col("offset"), F.lit(0)), F.least(end, (i + 1) * b) - F.col("offset")
        at = F.greatest(F.col("offset") - i * b, F.lit(0))
        some = [] if ws is None else [F.array_join(F.slice("__words", (start + 1).cast("int"), (stop - start).cast("int")), " ").alias("text")]
        return F.struct(i.alias("block"), at.alias("at"), start.alias("start"), (stop - start).alias("length"), *some)

    rows = laid.where("size > 0")
    if ws is not None:
        rows = rows.withColumn("__words", ws).drop("text")
    return rows.select("doc_id", "source", "src", "offset", F.inline(F.transform(F.sequence(F.floor(F.col("offset") / b), last), piece)))


# ------------------------------------------------------------------ 3. slots
def slots(sources: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """Every slot of the mix: shard, place, src, round, block and the ``words`` it takes from the block's start."""
    table = cut_lineage(running_sum(with_slots(sources, cfg), "src", "slots", "first"))
    total = table.agg(F.sum("slots")).first()[0] or 0
    drawn = F.pmod(_key(cfg, "draw", "id"), F.lit(max(1, total)))
    draws = by_interval(sources.sparkSession.range(total).select(
        F.floor(F.col("id") / cfg.shard_slots).alias("shard"), drawn.alias("at")),
        "at", table.select("src", "first", "slots"), "first", "slots", total, cfg.cells)
    counts = cut_lineage(draws.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    got = table.join(counts.groupBy("src").agg(F.sum("n").alias("got")), "src", "left").withColumns({
        "got": F.coalesce("got", F.lit(0)), "over": F.greatest(F.coalesce("got", F.lit(0)) - F.col("slots"), F.lit(0)),
        "under": F.greatest(F.col("slots") - F.coalesce("got", F.lit(0)), F.lit(0))})
    got = cut_lineage(running_sum(running_sum(got, "src", "over", "over_first"), "src", "under", "under_first"))
    moved_total = got.agg(F.sum("over")).first()[0] or 0
    each = counts.select("shard", "src", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("i"))
    each = each.join(got.select("src", "slots", "over_first"), "src")
    kept = each.where("i < slots").select("shard", "src", "i")
    over = each.where("i >= slots").select("shard", permuted(
        F.col("over_first") + F.col("i") - F.col("slots"), F.lit(moved_total), _key(cfg, "over")).alias("at"))
    moved = by_interval(over, "at", got.select("src", "got", "under", "under_first"), "under_first", "under",
                        moved_total, cfg.cells).select("shard", "src", (F.col("got") + F.col("at") - F.col("under_first")).alias("i"))
    full = kept.unionByName(moved).join(table.select("src", "blocks", "tail", "slots", "spare"), "src") \
        .withColumn("round", F.floor(F.col("i") / F.col("blocks")))
    full = full.withColumn("block", permuted(F.col("i") % F.col("blocks"), F.col("blocks"), _key(cfg, "block", "src", F.col("round"))))
    there = F.when(F.col("block") == F.col("blocks") - 1, F.col("tail")).otherwise(cfg.block_words)
    left = F.when(F.col("i") == F.col("slots") - 1, F.col("spare")).otherwise(0)
    order = Window.partitionBy("shard").orderBy(_key(cfg, "place", "src", "i"), "src", "i")
    return full.select("shard", (F.row_number().over(order) - 1).alias("place"), "src", "round", "block",
                       (there - left).cast("long").alias("words"))


# ------------------------------------------------------------------ 4. the mix
def mix(laid: DataFrame, sources: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The mixed corpus, a row for each piece of a document in a slot.

    shard, place, at (in the slot), doc_id, source, src, offset (of the document in its source), round,
    block, start and length (words of the document), and the piece's text, words joined by one space, if ``laid`` has texts.
    """
    met = pieces(laid, cfg).join(slots(sources, cfg), ["src", "block"]).where("at < words")
    length = F.least(F.col("length"), F.col("words") - F.col("at"))
    text = []
    if "text" in laid.columns:
        text = [F.when(length < F.col("length"), F.array_join(F.slice(F.split("text", " ", -1), F.lit(1), length.cast("int")), " "))
                .otherwise(F.col("text")).alias("text")]
    return met.select("shard", "place", "at", "doc_id", "source", "src", "offset", "round", "block", "start",
                      length.alias("length"), *text)
