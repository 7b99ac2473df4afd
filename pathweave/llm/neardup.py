"""Near duplicates: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity.

Words are runs of characters other than the six ASCII white spaces, ASCII
letters in lower case; a shingle is ``words`` of them in a row (a text with fewer words
has one shingle of them all).  A shingle weighs tf * idf, with
idf = ln(1 + N / max(df, T)) / ln(1 + N / T): df counts documents over the whole
corpus of N rows, and T is the share ``common`` of them.  N / T is the same in every corpus, so
a weight depends on the share of documents that hold the shingle and not on
their number; ordinary shingles weigh their tf, widespread passages less.  A document
of s shingles adds s to all df together, so at most (mean s) / ``common`` shingles reach T,
however many documents there are: that bounds the table of shingles that weigh less.

1. df: tasks count their distinct shingles (48 bits of the hash) and shuffle
   them packed by hash range; ranges are merged and shingles of df > T kept.
2. Sketch: each distinct text gets bands * rows samples by improved consistent
   weighted sampling (Ioffe): with r, c ~ Gamma(2, 1) and b ~ U(0, 1) of (shingle,
   sample), t = floor(ln w / r + b) and the sample is the shingle and t of the
   least ln c - r (t - b + 1).  r, c and b come from tables of 2^16 draws.
3. Candidates: a bucket (band, hash) pairs its members with one of them, the
   first in a random order that differs between bands.  After verification, a
   bucket that still holds several classes pairs a new member, one of its
   smallest class, with those of other classes, ``rounds`` times in all: rounds * n
   pairs at most for a bucket of n members.  The members of buckets that hold
   several classes still, centres aside, then meet wherever their weighted
   prefixes share a shingle, so no two texts of one bucket at the threshold are
   left unmet: with the shingles of a text in one order for all texts, rarest
   first, the first that two texts share stands where the weight from there on is
   their overlap or more, which is threshold / (1 + threshold) of their weights
   together at least.  A passage that all share is thus met only by texts which
   it alone could bring to the threshold; what follows such a passage costs the
   square of their number where they are different classes all the same.
4. Verification: the weighted Jaccard similarity of the two whole texts is
   ``threshold`` or more.
5. Classes: connected components by label propagation with pointer jumping.

Equal texts share one node and are never paired.  Nothing but the common
shingles (bounded as said above) and counts reaches the driver.

Defined results: a null text is an empty one; texts without words link only
with equal texts; a class is named by its smallest doc_id (null ids last);
repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

from .common import give_back, keep_marked, release_worker


@dataclass(frozen=True)
class NearConfig:
    words: int = 5
    threshold: float = 0.8
    bands: int = 20
    rows: int = 4                    # chance to miss a pair at 0.8: (1 - 0.8^4)^20 = 3e-5
    common: float = 1 / 2000         # share of the rows above which a shingle weighs less
    orders: int = 4                  # different random orders over the bands in the first round; then one a band
    rounds: int = 3                  # of centres, before prefixes take over
    width: float = 1.03              # ratio of the weights in which texts are held to have one weight in prefixes
    chunk_chars: int = 1_000_000     # text hashed at once
    block_shingles: int = 1_000_000  # shingles counted before a task sends them
    ranges: int = 8                  # hash ranges per shuffle partition; one range is merged in memory


# ---- shingles -------------------------------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _draws(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2 ** 64, n, dtype=np.uint64) | np.uint64(1)


_BYTE, _STEP = _draws(256, 11), _draws(1, 12)[0]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word of the texts, in order."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    if not len(data):
        return np.array([], np.int64), np.array([], np.uint64)
    ends = np.cumsum(sizes)
    space = _SPACE[data]
    opens = ~space
    opens[1:] &= space[:-1]
    firsts = (ends - sizes)[sizes > 0]
    opens[firsts] = ~space[firsts]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.array([], np.int64), np.array([], np.uint64)
    inside = np.flatnonzero(~space)
    word = np.cumsum(opens)[inside] - 1
    place = inside - starts[word]
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _STEP, np.uint64))
    summed = np.add.reduceat(_BYTE[data[inside]] * powers[place], np.searchsorted(inside, starts))
    return np.searchsorted(ends, starts, "right"), _mix(summed)


def shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, tf) of the distinct shingles of each text, ordered by row and hash."""
    row, word = _word_hashes(texts)
    if not len(row):
        return row, word, np.array([], np.int64)
    mult = _draws(n, 13)
    counts = np.bincount(row, minlength=len(texts))
    at = np.cumsum(counts) - counts
    begin = np.flatnonzero(np.arange(len(row)) + n <= (at + counts)[row])
    total = np.zeros(len(begin), np.uint64)
    for k in range(n):
        total += word[begin + k] * mult[k]
    short = np.flatnonzero((counts > 0) & (counts < n))
    extra = [(word[at[i]:at[i] + counts[i]] * mult[:counts[i]]).sum(dtype=np.uint64) + np.uint64(counts[i]) for i in short]
    rows = np.concatenate([row[begin], short])
    hashes = _mix(np.concatenate([total, np.array(extra, np.uint64)]))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return rows[first], hashes[first], np.diff(np.append(first, len(rows)))


def _chunks(sizes: list[int], most: int):
    """(from, to) of runs of items that come to about ``most``."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(sizes):
        yield at, len(sizes)


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


# ---- document frequencies -------------------------------------------------------------------------------------

_LOW = np.uint64(16)        # a df key is the hash without its low 16 bits


@dataclass(frozen=True)
class Weights:
    """idf of the heavy shingles; all others weigh 1."""
    keys: np.ndarray
    idf: np.ndarray

    def of(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return tf.astype(np.float64)
        key = hashes >> _LOW
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return tf * np.where(self.keys[at] == key, self.idf[at], 1.0)


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.array([], int)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def document_frequencies(docs: DataFrame, least: float, cfg: NearConfig) -> DataFrame:
    """(key, df) of shingles in more than ``least`` documents."""
    ranges = cfg.ranges * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        import zstandard
        release_worker()
        pack = zstandard.ZstdCompressor(level=1)
        held, size = [], 0

        def send():
            key, n = _counted(held, [np.ones(len(k), np.int64) for k in held])
            part = (key >> np.uint64(16)) * np.uint64(ranges) >> np.uint64(32)
            edges = np.searchsorted(part, np.arange(ranges + 1))
            there = np.flatnonzero(np.diff(edges))
            step = np.diff(key, prepend=np.uint64(0))
            step[edges[there]] = key[edges[there]]
            keys = [pack.compress(np.ascontiguousarray(step[a:b].view(np.uint8).reshape(-1, 8).T[:6]).tobytes())
                    for a, b in zip(edges[there], edges[there + 1])]
            counts = [pack.compress(n[a:b].astype("<u4").tobytes()) for a, b in zip(edges[there], edges[there + 1])]
            return pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                                              ["part", "keys", "counts"])
        for b in batches:
            texts = _bytes(b.column("text"))
            for x, y in _chunks([*map(len, texts)], cfg.chunk_chars):
                _, hashes, _ = shingles(texts[x:y], cfg.words)
                held.append(hashes >> _LOW)
                size += len(hashes)
                if size >= cfg.block_shingles:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()
        held = []
        give_back()

    def merge(table: pa.Table) -> pa.Table:
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        keys, counts = [], []
        for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist()):
            n = np.frombuffer(unpack.decompress(c), "<u4").astype(np.int64)
            planes = np.zeros((len(n), 8), np.uint8)
            planes[:, :6] = np.frombuffer(unpack.decompress(k), np.uint8).reshape(6, -1).T
            keys.append(np.cumsum(planes.view("<u8").ravel(), dtype=np.uint64))
            counts.append(n)
        key, n = _counted(keys, counts)
        often = n > least
        return pa.table({"key": pa.array(key[often].astype(np.int64)), "df": pa.array(n[often], pa.int64())})

    return docs.select("text").mapInArrow(count, "part int, keys binary, counts binary") \
        .groupBy("part").applyInArrow(merge, "key long, df long")


def fit_weights(docs: DataFrame, cfg: NearConfig = NearConfig()) -> Weights:
    n = docs.count()
    least = n * cfg.common
    found = document_frequencies(docs.select(F.col("text").cast("string").alias("text")), least, cfg)
    rows = found.toArrow()      # at most (mean number of a text's shingles) / common
    key, df = (rows.column(c).to_numpy().astype(np.uint64) for c in ("key", "df"))
    order = np.argsort(key)
    idf = np.log1p(n / df[order].astype(float)) / np.log1p(1 / cfg.common)
    return Weights(key[order], idf)


# ---- sketches -------------------------------------------------------------------------------------------------

class Sampler:
    """Improved consistent weighted sampling with tabled draws."""
    SIZE = 1 << 16

    def __init__(self, cfg: NearConfig):
        self.k, self.cfg = cfg.bands * cfg.rows, cfg
        u = np.random.Generator(np.random.PCG64(17)).random((5, self.SIZE)) * (1 - 1e-12) + 1e-13
        self.r, self.lnc, self.b = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]
        self.one = (self.lnc - self.r * (1 - self.b)).astype(np.float32)     # of weight 1: ln w = 0, t = 0
        self.mult = _draws(self.k, 19)

    def bands(self, rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        """(n, bands) hashes of the samples of each text; 0 for texts without shingles."""
        out = np.zeros((n, self.cfg.bands), np.uint64)
        if not len(rows):
            return out
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        sizes = np.diff(np.append(first, len(rows)))
        other = np.flatnonzero(weights != 1.0)
        lnw = np.log(weights[other])
        fold = np.zeros(len(first), np.uint64)
        for k in range(self.k):
            draw = (hashes * self.mult[k]) >> np.uint64(48)
            a = self.one[draw]
            t = np.zeros(len(other), np.int64)
            if len(other):
                d = draw[other]
                r, b = self.r[d], self.b[d]
                t = np.floor(lnw / r + b).astype(np.int64)
                a[other] = self.lnc[d] - r * (t - b + 1)
            least = np.minimum.reduceat(a, first)
            # the first shingle in hash order that reaches the least value
            hit = np.flatnonzero(a == np.repeat(least, sizes))
            pick = hit[np.searchsorted(hit, first)]
            sample = hashes[pick]
            if len(other):
                at = np.minimum(np.searchsorted(other, pick), len(other) - 1)
                sample = sample + np.where(other[at] == pick, t[at], 0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            fold = _mix(fold * np.uint64(31) + sample + np.uint64(k + 1))
            if (k + 1) % self.cfg.rows == 0:
                out[rows[first], k // self.cfg.rows] = fold | np.uint64(1)
                fold = np.zeros(len(first), np.uint64)
        return out


def node(text: Column) -> Column:
    """The identity of a whole text."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def sketches(docs: DataFrame, weights: Weights, cfg: NearConfig) -> DataFrame:
    """(doc_id, node, bands array<long>) of every row; bands is empty for texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)     # of the size that ``common`` allows

    def run(batches):
        sampler, w = Sampler(cfg), shared.value
        for batch in batches:
            texts = _bytes(batch.column("text"))
            out = []
            for x, y in _chunks([*map(len, texts)], cfg.chunk_chars):
                rows, hashes, tf = shingles(texts[x:y], cfg.words)
                out.append(sampler.bands(rows, hashes, w.of(hashes, tf), y - x))
            all_bands = np.concatenate(out) if out else np.zeros((0, cfg.bands), np.uint64)
            there = (all_bands[:, 0] != 0).astype(np.int64) * cfg.bands
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(there)]), pa.int32()),
                                             pa.array(all_bands[there > 0].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), lists], ["doc_id", "node", "bands"])
        give_back()

    return docs.select("doc_id", node(F.col("text")).alias("node"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, node binary, bands array<bigint>")


# ---- candidates, verification, classes ------------------------------------------------------------------------

def _centred(members: DataFrame, spent: DataFrame | None, round_no: int, cfg: NearConfig) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), a < b, of each bucket's centre with the members of other classes; and the centres (band, hash, node).

    The centre is a member of the smallest class that was no centre of the
    bucket before, the first of those in the round's random order.
    """
    order = F.xxhash64("node", F.col("band") % (cfg.orders if round_no == 0 else cfg.bands), F.lit(round_no))
    fresh = members if spent is None else members.join(spent, ["band", "hash", "node"], "left_anti")
    centres = cut_lineage(fresh.groupBy("band", "hash").agg(F.min(F.struct("size", order.alias("o"), "node", "comp")).alias("f"))
                          .select("band", "hash", F.col("f.node").alias("centre"), F.col("f.comp").alias("of")))
    met = members.join(centres, ["band", "hash"]).where(F.col("comp") != F.col("of"))
    return met.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), \
        centres.select("band", "hash", F.col("centre").alias("node"))


def similarity(first: list[bytes], second: list[bytes], weights: Weights, n: int) -> np.ndarray:
    """Weighted Jaccard similarity of texts pairwise; 0 where either has no words."""
    out = np.zeros(len(first))
    ra, ha, ta = shingles(first, n)
    rb, hb, tb = shingles(second, n)
    wa, wb = weights.of(ha, ta), weights.of(hb, tb)
    rows, hashes, w = np.concatenate([ra, rb]), np.concatenate([ha, hb]), np.concatenate([wa, wb])
    order = np.lexsort((hashes, rows))
    rows, hashes, w = rows[order], hashes[order], w[order]
    same = np.flatnonzero((rows[1:] == rows[:-1]) & (hashes[1:] == hashes[:-1]))
    common = np.bincount(rows[same], np.minimum(w[same], w[same + 1]), len(first))
    total = np.bincount(ra, wa, len(first)) + np.bincount(rb, wb, len(first)) - common
    np.divide(common, total, out=out, where=total > 0)
    return out


def _verified(pairs: DataFrame, texts: DataFrame, weights, cfg: NearConfig) -> DataFrame:
    """The pairs whose texts reach the threshold."""
    def run(batches):
        import zstandard
        unpack, w = zstandard.ZstdDecompressor(), weights.value
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                first, second = ([unpack.decompress(x) for x in part.column(c).to_pylist()] for c in ("ta", "tb"))
                for x, y in _chunks([len(f) + len(s) for f, s in zip(first, second)], cfg.chunk_chars):
                    near = similarity(first[x:y], second[x:y], w, cfg.words) >= cfg.threshold - 1e-9
                    yield part.slice(x, y - x).select(["a", "b"]).filter(pa.array(near))
        give_back()
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("tb")), "b") \
        .join(texts.select(F.col("node").alias("a"), F.col("packed").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def _packed_texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, packed): the compressed text of each needed node, once."""
    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = [pack.compress(t) for t in _bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("doc_id"), pa.array(packed, pa.binary())], ["node", "doc_id", "packed"])
    # one row of each node comes through: the one with the node's smallest doc_id
    rows = docs.select(node(F.col("text")).alias("node"), "doc_id", F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "node binary, doc_id long, packed binary")
    met = rows.join(needed.withColumnRenamed("doc_id", "__pw_first"), "node").where(F.col("doc_id").eqNullSafe(F.col("__pw_first")))
    return met.groupBy("node").agg(F.first("packed").alias("packed"))


def _unpacked(packed: DataFrame) -> DataFrame:
    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([unpack.decompress(x) for x in b.column("packed").to_pylist()], pa.binary())], ["text"])
    return packed.select("packed").mapInArrow(run, "text binary").select(F.col("text").cast("string").alias("text"))


def prefixes(first: list[bytes], weights: Weights, common: Weights, cfg: NearConfig) -> tuple[np.ndarray, ...]:
    """(row, hash, weight from there on, weight of the text) of the shingles that a link's first shared one can be."""
    rows, hashes, tf = shingles(first, cfg.words)
    if not len(rows):
        return rows, hashes, np.array([]), np.array([])
    w = weights.of(hashes, tf)
    order = np.lexsort((hashes, -common.of(hashes, np.ones(len(hashes))), rows))
    rows, hashes, w = rows[order], hashes[order], w[order]
    at = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    total = np.repeat(np.add.reduceat(w, at), np.diff(np.append(at, len(rows))))
    gone = np.cumsum(w) - w
    rest = total - (gone - np.repeat(gone[at], np.diff(np.append(at, len(rows)))))
    held = rest >= cfg.threshold * total * (1 - 1e-6)
    return rows[held], hashes[held], rest[held], total[held]


def _prefix_pairs(members: DataFrame, texts: DataFrame, weights, cfg: NearConfig) -> DataFrame:
    """Pairs (a, b), a < b, of different classes whose prefixes share a shingle; ``members`` is (node, comp), once each."""
    packed = cut_lineage(members.join(texts, "node").select("node", "comp", "packed"))
    # shingles frequent among these texts come last; the order decides the cost, not the links
    common = members.sparkSession.sparkContext.broadcast(fit_weights(_unpacked(packed), cfg))

    def run(batches):
        import zstandard
        unpack, w, c = zstandard.ZstdDecompressor(), weights.value, common.value
        for batch in batches:
            raw = [unpack.decompress(x) for x in batch.column("packed").to_pylist()]
            for x, y in _chunks([*map(len, raw)], cfg.chunk_chars):
                rows, hashes, rest, total = prefixes(raw[x:y], w, c, cfg)
                at = pa.array(rows + x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(at), batch.column("comp").take(at), pa.array(hashes.view(np.int64)), pa.array(rest), pa.array(total)],
                    ["node", "comp", "shingle", "rest", "total"])

    entries = cut_lineage(packed.mapInArrow(run, "node binary, comp binary, shingle long, rest double, total double"))
    mixed = entries.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    share, log = cfg.threshold / (1 + cfg.threshold), float(np.log(cfg.width))
    span = lambda v: F.floor(F.log(v) / log)
    # the span of weights where a partner can be: overlap >= threshold of either weight, and >= share of both
    most = F.least(F.col("total") / cfg.threshold, F.col("rest") / share - F.col("total")) * (1 + 1e-5)
    least = F.col("total") * cfg.threshold * (1 - 1e-5)
    met = cut_lineage(entries.join(mixed.select("shingle"), "shingle").select(
        "*", span(F.col("total")).alias("own"), F.explode(F.sequence(span(least), F.greatest(span(most), span(least)))).alias("other")))

    def side(name, own, other, keep):
        return met.where(keep).select("shingle", F.col(own).alias("light"), F.col(other).alias("dark"), *[
            F.col(c).alias(f"{name}_{c}") for c in ("node", "comp", "rest", "total")])
    both = side("x", "own", "other", F.col("own") <= F.col("other")).join(
        side("y", "other", "own", F.col("own") >= F.col("other")), ["shingle", "light", "dark"])
    needed = (F.col("x_total") + F.col("y_total")) * share * (1 - 1e-6)
    found = both.where((F.col("x_comp") != F.col("y_comp")) & (F.col("x_rest") >= needed) & (F.col("y_rest") >= needed)
                       & ((F.col("light") < F.col("dark")) | (F.col("x_node") < F.col("y_node"))))
    return found.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node with a link; comp is the class's smallest node."""
    both = cut_lineage(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                       .unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v"))))
    label = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("comp")))
    while True:
        near = both.join(label.withColumnRenamed("node", "u"), "u").groupBy("v").agg(F.min("comp").alias("m"))
        step = label.join(near.withColumnRenamed("v", "node"), "node").select(
            "node", F.least("comp", "m").alias("comp"), (F.col("m") < F.col("comp")).alias("moved"))
        step = cut_lineage(step)
        if not step.where("moved").take(1):
            return label
        jump = step.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        label = cut_lineage(step.join(jump, "comp", "left").select("node", F.least("comp", F.coalesce("far", "comp")).alias("comp")))


def classes(docs: DataFrame, cfg: NearConfig = NearConfig()) -> DataFrame:
    """(doc_id, node, class_id, class_size, kept) of every row; class_id is the class's smallest doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weights = fit_weights(rows, cfg)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    sketched = cut_lineage(sketches(rows, weights, cfg))
    # of equal texts one row goes on: the bands are the same for all
    per_text = cut_lineage(sketched.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")))
    entries = per_text.select("node", F.posexplode("bands").alias("band", "hash"))
    shared_buckets = cut_lineage(entries.groupBy("band", "hash").count().where("count > 1").drop("count"))
    members = cut_lineage(entries.join(shared_buckets, ["band", "hash"]))
    texts = cut_lineage(_packed_texts(rows, members.select("node").distinct().join(per_text.select("node", "doc_id"), "node")))

    links, spent, comp = None, None, None
    there = members.select("*", F.col("node").alias("comp"), F.lit(1).cast("long").alias("size"))

    def mixed(rows):
        """The members of the buckets that hold several classes."""
        ends = rows.groupBy("band", "hash").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
        return cut_lineage(rows.join(ends.select("band", "hash"), ["band", "hash"]))

    def linked(pairs):
        nonlocal links, comp, there
        new = cut_lineage(_verified(pairs, texts, shared, cfg))
        if new.take(1):
            links = new if links is None else links.unionAll(new)
            comp = components(links)
            sized = comp.join(comp.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), "comp")
            there = cut_lineage(there.select("band", "hash", "node").join(sized, "node", "left").select(
                "band", "hash", "node", F.coalesce("comp", "node").alias("comp"), F.coalesce("size", F.lit(1)).alias("size")))

    for round_no in range(cfg.rounds):
        pairs, centres = _centred(there, spent, round_no, cfg)
        spent = centres if spent is None else spent.unionAll(centres)
        linked(pairs)
        there = mixed(there)
    # centres have met all other classes of their buckets; of the other members, those of one bucket and several classes have not met
    rest = mixed(there if spent is None else there.join(spent, ["band", "hash", "node"], "left_anti")).select("node", "comp").distinct()
    rest = cut_lineage(rest)
    if rest.take(1):
        linked(_prefix_pairs(rest, texts, shared, cfg))

    named = per_text.drop("bands")
    named = named.withColumn("comp", F.col("node")) if comp is None else \
        named.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = cut_lineage(named)
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("lead")
    of_class = cut_lineage(named.groupBy("comp").agg(lead, F.sum("n").alias("class_size")))
    of_node = cut_lineage(named.join(of_class, "comp").select("node", "lead", "class_size"))
    return sketched.select("doc_id", "node").join(of_node, "node").select(
        "doc_id", "node", F.col("lead.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("node") == F.col("lead.node"))).alias("kept"))


def one_of_each(docs: DataFrame, cfg: NearConfig = NearConfig()) -> DataFrame:
    """The input's rows and columns with one row of each class."""
    made = cut_lineage(classes(docs, cfg).select("doc_id", "node", "kept"))
    return keep_marked(docs.withColumn("__pw_key", node(F.col("text"))), made.withColumnRenamed("node", "__pw_key"), "__pw_key") \
        .select(*docs.columns)
