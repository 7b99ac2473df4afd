"""Packing documents into sequences: Martello-Toth reduction, then best fit, over a histogram of lengths.

1. Tasks tokenize whole texts (each distinct chunk between white space once per
   worker), append the separator and cut only what is longer than a sequence.
2. The plan needs just the number of pieces of each length: at most
   ``capacity`` numbers on the driver, whatever the input.  The reduction fixes
   sets that provably dominate every other set with the same largest piece: a
   piece beside which nothing fits; a piece and its exact complement; a piece
   and the largest that fits beside it, if no two fit.  Best fit in order of
   decreasing length packs the rest.  Equal pieces are handled together, so a
   plan row says: pieces number ``first``.. of a length go to sequences
   ``base``.., ``per`` to each, from ``offset``.
3. Each piece gets its number among those of its length (a count per length and
   hash bucket, a running sum over the buckets, and its place in its bucket)
   and looks its plan row up.

Defined results: a null text is an empty one, whose only id is the separator;
rows are packed one by one, so repeated rows are packed repeatedly; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import gc
import os
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

from .common import keep_in_worker


@dataclass(frozen=True)
class PackConfig:
    tokenizer: str | None = None     # file of the tokenizers library; None: word_bpe_49k.json of public_tokenizers
    capacity: int = 2048
    separator: int = 0
    cache_chunks: int = 300_000      # distinct chunks of a generation whose ids a worker keeps; it keeps two
    rank_buckets: int = 4096


_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
# the tokenizer's words in lower-case Latin-1 text, which its normalizer leaves alone; another tokenizer file needs its own
_L, _N = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\\x09-\\x0D\\x20\\x85\\xa0{_L}{_N}]+")


class ChunkEncoder:
    """Ids of a text, chunk by chunk: the tokenizer never looks across white space.

    A chunk not met before is put together from its words where it is Latin-1
    and the tokenizer is the default one; only words not met before are encoded.
    """

    def __init__(self, cfg: PackConfig):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks share the cores already
        from tokenizers import Tokenizer
        path = cfg.tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(str(path))
        self.tokenizer.encode_special_tokens = True     # their strings in a text are ordinary text
        self.most, self.known, self.older, self.words = cfg.cache_chunks, {}, {}, {}
        self.by_word = cfg.tokenizer is None
        if self.by_word:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _encoded(self, strings: list[str]) -> list[bytes]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)] if strings else []
        return [struct.pack(f"<{len(x)}I", *x) for x in lists]

    def _encoded_words(self, words: list[str], together: int = 200) -> list[bytes]:
        """As ``_encoded``, for words of the default tokenizer: many in one text, cut behind each token that ends a word."""
        runs = [words[i:i + together] for i in range(0, len(words), together)]
        lists = self.tokenizer.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False) if runs else []
        out = []
        for run, e in zip(runs, lists):
            ids = np.array(e.ids, "<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) != len(run):
                out += self._encoded(run)
                continue
            data, stops = ids.tobytes(), stops.tolist()
            out += [data[i:j] for i, j in zip([0, *stops], stops)]
        return out

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        chunks = _CHUNK.findall(text)
        known, older, words = self.known, self.older, self.words
        found = list(map(known.get, chunks))
        if None not in found:
            return b"".join(found)
        missing = [i for i, ids in enumerate(found) if ids is None]
        if len(words) > self.most:
            words.clear()
        whole, made = [], []
        for c in {chunks[i] for i in missing}:
            if c in older:
                known[c] = older[c]
            elif self.by_word and (c.isascii() or max(c) <= "\xff"):
                made.append((c, _WORD.findall(c.lower())))
            else:
                whole.append(c)
        new = list({w for _, own in made for w in own if w not in words})
        words.update(zip(new, self._encoded_words(new)))
        known.update((c, b"".join([words[w] for w in own])) for c, own in made)
        known.update(zip(whole, self._encoded(whole)))
        for i in missing:
            found[i] = known[chunks[i]]
        if len(known) > self.most:      # what is still in use comes back from the older generation
            self.known, self.older = {}, known
        return b"".join(found)


def pieces(docs: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece of each document."""
    def run(batches):
        encoder = keep_in_worker(("packing", cfg), lambda: ChunkEncoder(cfg))
        end, width = np.array([cfg.separator], "<u4").tobytes(), 4 * cfg.capacity
        gc.disable()        # new chunks make many lists and no cycles
        try:
            for b in batches:
                row, piece, start, length, crc = [], [], [], [], []
                for i, text in enumerate(b.column("text").to_pylist()):
                    ids = encoder.ids(text or "") + end
                    for k, at in enumerate(range(0, len(ids), width)):
                        part = ids[at:at + width]
                        row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            gc.enable()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Plan:
    """Where the pieces of each length go: rows (length, first, base, per, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left, self.used = capacity, dict(counts), {}
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.fixed = 0
        self._reduce()
        self._best_fit()

    def _put(self, length: int, base: int, bins: int, per: int, offset: int) -> None:
        first = self.used.get(length, 0)
        self.rows.append((length, first, base, per, offset))
        self.used[length] = first + bins * per
        self.left[length] -= bins * per
        if not self.left[length]:
            del self.left[length]

    def _fix(self, a: int, b: int | None, bins: int) -> None:
        base = self.sequences
        self.sequences += bins
        self.fixed += bins
        if a == b:
            return self._put(a, base, bins, 2, 0)
        self._put(a, base, bins, 1, 0)
        if b is not None:
            self._put(b, base, bins, 1, a)

    def _reduce(self) -> None:
        """Fix dominating sets of the longest pieces first, until a pass fixes none."""
        changed = True
        while changed:
            changed = False
            for a in sorted(self.left, reverse=True):
                while self.left.get(a):
                    sizes, room = sorted(self.left), self.capacity - a
                    # what can stand beside one piece of length a
                    others = {s: self.left[s] - (s == a) for s in sizes if s <= room and self.left[s] > (s == a)}
                    if not others:
                        n = 1 if 2 * a <= self.capacity else self.left[a]
                        self._fix(a, None, n)
                    else:
                        b, low = max(others), min(others)
                        two = 2 * low if others[low] > 1 else low + min((s for s in others if s != low), default=self.capacity)
                        if a + b != self.capacity and two <= room:
                            break
                        self._fix(a, b, self.left[a] // 2 if a == b else min(self.left[a], self.left[b]))
                    changed = True

    def _best_fit(self) -> None:
        """Best fit, longest first; sequences with equal room are ranges (base, number)."""
        rooms: list[int] = []
        ranges: dict[int, list[tuple[int, int]]] = {}

        def keep(room: int, base: int, bins: int) -> None:
            if bins and room:
                if room not in ranges:
                    bisect.insort(rooms, room)
                    ranges[room] = []
                ranges[room].append((base, bins))

        for length in sorted(self.left, reverse=True):
            n = self.left[length]
            while n:
                i = bisect.bisect_left(rooms, length)
                if i < len(rooms):
                    room = rooms[i]
                    base, bins = ranges[room].pop()
                    if not ranges[room]:
                        del ranges[room]
                        rooms.pop(i)
                else:
                    room, per = self.capacity, self.capacity // length
                    base, bins = self.sequences, -(-n // per)
                    self.sequences += bins
                per, offset = room // length, self.capacity - room
                full = min(bins, n // per)
                if full:
                    self._put(length, base, full, per, offset)
                    keep(room - per * length, base, full)
                    n -= full * per
                if full < bins and n:       # fewer than ``per`` are left: one more sequence takes them
                    self._put(length, base + full, 1, n, offset)
                    keep(room - n * length, base + full, 1)
                    full, n = full + 1, 0
                keep(room, base + full, bins - full)


def pack(docs: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return place(pieces(docs, cfg), cfg)


def place(parts: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to capacity, and doc_id and piece."""
    spark = parts.sparkSession
    rows = cut_lineage(parts.withColumn("__pw_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(cfg.rank_buckets))))
    counts = rows.groupBy("length", "__pw_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__pw_bucket")) - F.col("n")
    counts = cut_lineage(counts.withColumn("before", before))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}   # capacity rows at most
    plan = Plan(histogram, cfg.capacity)
    lookup = np.array(sorted(plan.rows), dtype=np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(lookup)    # a few rows per length
    ranked = rows.join(counts.drop("n"), ["length", "__pw_bucket"]).withColumn(
        "__pw_rank", F.col("before") + F.row_number().over(
            Window.partitionBy("length", "__pw_bucket").orderBy("doc_id", "piece", *[c for c in ("start", "ids_crc32") if c in parts.columns])) - 1)

    def run(batches):
        table = shared.value
        keys = table[:, 0] << 44 | table[:, 1]       # (length, first) as one ascending number
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "__pw_rank"))
            row = table[np.searchsorted(keys, length << 44 | rank, "right") - 1]
            slot = rank - row[:, 1]
            sequence, offset = row[:, 2] + slot // row[:, 3], row[:, 4] + slot % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])
    names = [c for c in parts.columns]
    schema = parts.schema.fields
    out = type(parts.schema)(list(schema)).add("sequence_id", "long").add("offset", "long")
    return ranked.select(*names, "__pw_rank").mapInArrow(run, out)
