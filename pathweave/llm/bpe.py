"""Byte-level BPE by a global shuffle of distinct words.

1. A task splits its texts into pre-tokens and numbers the distinct ones of a
   block of about ``block_tokens`` tokens.  A block holds its documents' words as
   numbers, in order of position, and its distinct words by hash bucket.  Blocks
   are written once to a table in the shared folder, bucketed by block.
2. The blocks' distinct words are shuffled by hash bucket.  The task of a bucket
   streams them, encodes each distinct word once and answers every block with
   the ids of its words.  A frequent word reaches it once a block, however often
   it occurs, so no word is hot.
3. The answers are shuffled back and join their block, whose own rows stay where
   the bucketed table has them; ids are put together by position.

Positions and words travel packed (numbers and words in Zstandard), because a
row per occurrence would be several times the input.

Decoding joins ids with the token-byte table.  That table is the vocabulary
file, so its size is fixed, and the join is a look-up on the map side.

Defined results: a null or empty text has no ids and decodes to no bytes; rows
are independent (ties and repeated rows need no rule); an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class BpeConfig:
    ranks: str | None = None         # a tiktoken rank file; None: byte_bpe_50k.tiktoken of public_tokenizers
    pattern: str | None = None       # None: public_tokenizers.PATTERN
    block_tokens: int = 1_500_000
    known_words: int = 1_000_000     # words whose ids a bucket's task keeps; it starts anew beyond that
    decode_tokens: int = 2_000_000   # decoded at once

    def path(self) -> str:
        import public_tokenizers
        return self.ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def split(self) -> str:
        import public_tokenizers
        return self.pattern or public_tokenizers.PATTERN

    def table(self) -> dict[bytes, int]:
        with open(self.path(), "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _pack(*arrays) -> bytes:
    """Several arrays or byte strings as one compressed string."""
    import zstandard
    raw = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    head = np.array([len(raw), *map(len, raw)], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def _unpack(data: bytes) -> list[bytes]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    sizes = np.frombuffer(raw, "<u8", n, 8).astype(int)
    at = 8 * (n + 1) + np.concatenate([[0], np.cumsum(sizes)])
    return [raw[a:b] for a, b in zip(at[:-1], at[1:])]


class _Block:
    """Documents of a block while a task reads them."""

    def __init__(self, buckets: int):
        self.buckets, self.count = buckets, 0
        self.reset()

    def reset(self):
        self.number, self.codes, self.sizes, self.ids, self.tokens = {}, [], [], [], 0

    def add(self, doc_id, words: list[str]):
        number = self.number
        self.codes.append(np.fromiter([number.setdefault(w, len(number)) for w in words], np.uint32, len(words)))
        self.sizes.append(len(words))
        self.ids.append(doc_id)
        self.tokens += len(words)

    def row(self, id_type) -> pa.RecordBatch:
        words = [w.encode() for w in self.number]
        bucket = np.fromiter((zlib.crc32(w) % self.buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        parts = []
        for b in np.flatnonzero(np.diff(edges)):
            own = [words[i] for i in order[edges[b]:edges[b + 1]]]
            parts.append({"bucket": int(b), "at": int(edges[b]), "words": _pack(np.array([len(w) for w in own], "<u4"), b"".join(own))})
        codes = place[np.concatenate(self.codes)] if words else np.array([], np.uint32)
        name = f"{TaskContext.get().partitionId()}-{self.count}"
        # the four bytes of a number apart: the high ones are mostly alike
        planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        out = pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([self.ids], pa.list_(id_type)),
             pa.array([_pack(np.array(self.sizes, "<u4"), planes)], pa.binary()),
             pa.array([parts], pa.list_(pa.struct([("bucket", pa.int32()), ("at", pa.int32()), ("words", pa.binary())])))],
            ["block", "doc_ids", "codes", "parts"])
        self.count += 1
        self.reset()
        return out


def _blocks(docs: DataFrame, cfg: BpeConfig, buckets: int) -> DataFrame:
    """The block table, written to the shared folder and bucketed by block."""
    spark, kind, split = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString(), cfg.split()

    def run(batches):
        import regex
        find, block = regex.compile(split).findall, _Block(buckets)
        id_type = pa.null()
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                block.add(doc_id, find(text or ""))
                if block.tokens >= cfg.block_tokens:
                    yield block.row(id_type)
        if block.ids:
            yield block.row(id_type)

    made = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"block string, doc_ids array<{kind}>, codes binary, parts array<struct<bucket:int,at:int,words:binary>>")
    name = f"pw_bpe_{uuid.uuid4().hex}"
    made.write.format("parquet").bucketBy(buckets, "block").option("compression", "zstd") \
        .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name)
    return spark.table(name)


def encode(docs: DataFrame, cfg: BpeConfig = BpeConfig(), buckets: int | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(docs, cfg, buckets)
    words = blocks.select("block", F.explode("parts").alias("p")).select("block", "p.*").repartition(buckets, "bucket")

    def encode_words(batches):
        import tiktoken
        # the whole word is one piece: it was split off already
        encoder = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=cfg.table(), special_tokens={})
        known: dict[bytes, list[int]] = {}
        for b in batches:
            out = []
            for packed in b.column("words").to_pylist():
                sizes, flat = _unpack(packed)
                ends = np.cumsum(np.frombuffer(sizes, "<u4")).tolist()
                own = [flat[x:y] for x, y in zip([0, *ends], ends)]
                if len(known) > cfg.known_words:
                    known.clear()
                for w in own:
                    if w not in known:
                        known[w] = encoder.encode_ordinary(w.decode())
                lists = [known[w] for w in own]
                out.append(_pack(np.array([len(x) for x in lists], "<u4"), np.array([i for x in lists for i in x], "<u4")))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("at"), pa.array(out, pa.binary())], ["block", "at", "ids"])

    answers = words.mapInArrow(encode_words, "block string, at int, ids binary")

    def assemble(block: pa.Table, answers: pa.Table) -> pa.Table:
        parts = [_unpack(x) for x in answers.sort_by("at").column("ids").to_pylist()]
        sizes = np.concatenate([np.frombuffer(n, "<u4") for n, _ in parts] or [np.array([], "<u4")]).astype(np.int64)
        flat = np.concatenate([np.frombuffer(x, "<u4") for _, x in parts] or [np.array([], "<u4")]).astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        out_ids, out_lists = [], []
        for doc_ids, packed in zip(block.column("doc_ids"), block.column("codes").to_pylist()):
            words_of, planes = _unpack(packed)
            words_of = np.frombuffer(words_of, "<u4").astype(np.int64)
            codes = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()
            each = sizes[codes]
            ends = np.cumsum(each)
            ids = flat[np.repeat(starts[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
            upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words_of)])]
            out_ids.append(doc_ids.values)
            out_lists.append(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids, pa.int32())))
        return pa.table({"doc_id": pa.chunked_array(out_ids), "ids": pa.chunked_array(out_lists)})

    return blocks.select("block", "doc_ids", "codes").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        assemble, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, cfg: BpeConfig = BpeConfig(), ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that the ids stand for."""
    names = [c for c in encoded.columns if c != out]

    def run(batches):
        table = sorted((i, t) for t, i in cfg.table().items())
        most = table[-1][0] + 1
        size = np.zeros(most, np.int64)
        size[[i for i, _ in table]] = [len(t) for _, t in table]
        flat, start = np.frombuffer(b"".join(t for _, t in table), np.uint8), np.cumsum(size) - size
        for b in batches:
            lists = b.column(ids)
            numbers = lists.flatten().to_numpy(zero_copy_only=False)
            counts = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(counts)])
            texts = []
            row = 0
            while row < len(lists):        # some rows at a time: bytes are several times the ids
                upto = max(row + 1, int(np.searchsorted(edges, edges[row] + cfg.decode_tokens, "right")) - 1)
                some = numbers[edges[row]:edges[upto]]
                each = size[some]
                ends = np.cumsum(each)
                data = flat[np.repeat(start[some] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
                at = np.concatenate([[0], ends])[edges[row:upto + 1] - edges[row]]
                texts += [data[x:y] for x, y in zip(at[:-1], at[1:])]
                row = upto
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(texts, pa.binary())], [*names, out])

    schema = encoded.select(*names).schema
    return encoded.select(*names).mapInArrow(run, type(schema)(list(schema.fields)).add(out, "binary"))
