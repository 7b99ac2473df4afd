"""WARC records in seekable Zstandard bundles.

A task streams its records into independent Zstandard frames of about
``frame_bytes`` and closes a bundle at about ``bundle_bytes``: the frames, then
the seek table of the public seekable format (a skippable frame with the sizes
of all frames and a footer).  A bundle is one row of a Parquet table in the
shared folder, with an index from each record to its frame and to its offset
within the frame once decompressed; so any store that Spark writes will do,
and a lost task leaves no half-written archive.  ``export`` of a bundle is its
``content``, byte for byte.

Of records with equal payloads of ``revisit_bytes`` or more, that with the
largest page_id is a response and the others revisit it.

Defined results: a null html is an empty payload; null page_ids count as the
smallest; rows that share the largest page_id and the payload are all
responses; line ends in a url are percent-encoded and a null url leaves its
header out; an empty table gives no bundle; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

SEEK_MAGIC, SKIPPABLE = 0x8F92EAB1, 0x184D2A5E
INDEX = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
BUNDLES = ("bundle string, frames int, records long, content binary, "
           "index array<struct<record_id:string,frame:int,offset:bigint,length:bigint>>")
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "payload binary")


@dataclass(frozen=True)
class WarcConfig:
    revisit_bytes: int = 1000
    frame_bytes: int = 256 * 1024
    bundle_bytes: int = 8 * 1024 * 1024
    bundles_per_file: int = 1               # what ``fetch`` reads at least; more where many files cost more
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"      # of every record, so that equal input gives equal archives


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    return int(urn[10:-1]) if urn != "<urn:page:>" else None


def record(cfg: WarcConfig, page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the full payload's digest and length, but no block."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {cfg.date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"X-Payload-Length: {len(payload)}"]
    block = b"" if revisit else payload
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record at an offset."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines[1:])
    end = stop + 4 + int(head["Content-Length"])
    return head, data[stop + 4:end], end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: compressed and decompressed size of each frame, and the footer."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from the footer."""
    n, _, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    at, out = 0, []
    for packed, plain in struct.iter_unpack("<II", content[-9 - 8 * n:-9]):
        out.append((at, packed, plain))
        at += packed
    return out


class _Bundle:
    def __init__(self, cfg: WarcConfig):
        import zstandard
        self.cfg, self.pack, self.count = cfg, zstandard.ZstdCompressor(level=cfg.level), 0
        self.reset()

    def reset(self):
        self.done, self.sizes, self.index, self.open, self.open_bytes = [], [], [], [], 0

    def add(self, rid: str, data: bytes):
        self.index.append({"record_id": rid, "frame": len(self.sizes), "offset": self.open_bytes, "length": len(data)})
        self.open.append(data)
        self.open_bytes += len(data)
        if self.open_bytes >= self.cfg.frame_bytes:
            self.close_frame()

    def close_frame(self):
        if self.open:
            packed = self.pack.compress(b"".join(self.open))
            self.done.append(packed)
            self.sizes.append((len(packed), self.open_bytes))
            self.open, self.open_bytes = [], 0

    def full(self) -> bool:
        return sum(p for p, _ in self.sizes) >= self.cfg.bundle_bytes

    def row(self) -> pa.RecordBatch:
        self.close_frame()
        name = f"{TaskContext.get().partitionId():06d}-{self.count:05d}"
        row = pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([len(self.sizes)], pa.int32()), pa.array([len(self.index)], pa.int64()),
             pa.array([b"".join(self.done) + seek_table(self.sizes)], pa.binary()), pa.array([self.index], INDEX)],
            ["bundle", "frames", "records", "content", "index"])
        self.count += 1
        self.reset()
        return row


def with_revisits(pages: DataFrame, cfg: WarcConfig = WarcConfig()) -> DataFrame:
    """page_id, url, payload, digest, refers_to and ``revisit`` of each page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload")) \
        .withColumn("digest", F.sha1("payload"))
    # payloads of equal SHA-1 can be made, so SHA-256 decides which are equal
    large = rows.where(F.octet_length("payload") >= cfg.revisit_bytes).withColumn("same", F.sha2("payload", 256))
    # one row per task and payload is shuffled here, however many copies there are
    top = cut_lineage(large.groupBy("same").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                      .where("n > 1").drop("n"))
    large = large.join(top, "same", "left").drop("same").withColumn("revisit", F.coalesce(
        F.col("page_id") < F.col("refers_to"), F.col("page_id").isNull() & F.col("refers_to").isNotNull()))
    # short and empty payloads, however often they occur, meet nothing
    small = rows.where(F.octet_length("payload") < cfg.revisit_bytes)
    return large.unionByName(small.withColumns({"refers_to": F.lit(None).cast("long"), "revisit": F.lit(False)}))


def write(pages: DataFrame, path: str, cfg: WarcConfig = WarcConfig()) -> None:
    """Write the pages' records as bundles to a Parquet table at ``path``."""
    def run(batches):
        bundle = _Bundle(cfg)
        for b in batches:
            for r in b.to_pylist():
                bundle.add(record_id(r["page_id"]),
                           record(cfg, r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], r["revisit"]))
                if bundle.full():
                    yield bundle.row()
        if bundle.index:
            yield bundle.row()

    with_revisits(pages, cfg).select("page_id", "url", "payload", "digest", "refers_to", "revisit") \
        .mapInArrow(run, BUNDLES).write.option("compression", "uncompressed") \
        .option("maxRecordsPerFile", cfg.bundles_per_file).parquet(path)


def _record_batch(found: list[tuple[dict, bytes]], payloads: bool) -> pa.RecordBatch:
    cols = {k: [] for k in ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")}
    for head, block in found:
        revisit = head["WARC-Type"] == "revisit"
        told = base64.b32decode(head["WARC-Payload-Digest"][5:]).hex()
        digest = told if revisit else hashlib.sha1(block).hexdigest()
        if digest != told:
            raise ValueError(f"payload of {head['WARC-Record-ID']} does not have its digest")
        cols["page_id"].append(_page(head["WARC-Record-ID"]))
        cols["url"].append(head.get("WARC-Target-URI"))
        cols["record_type"].append(head["WARC-Type"])
        cols["refers_to"].append(_page(head["WARC-Refers-To"]) if revisit else None)
        cols["payload_bytes"].append(int(head["X-Payload-Length"]) if revisit else len(block))
        cols["payload_digest"].append(digest)
        cols["payload"].append(block if payloads and not revisit else None)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), kinds)], list(cols))


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records of the bundles, frame by frame; ``payload`` is null for revisits and unless asked for."""
    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for content in b.column("content"):
                data = content.as_py()
                for at, packed, plain in frames(data):
                    frame = unpack.decompress(data[at:at + packed], max_output_size=plain)
                    found, here = [], 0
                    while here < len(frame):
                        head, block, here = parse(frame, here)
                        found.append((head, block))
                    yield _record_batch(found, payloads)
    return spark.read.parquet(path).select("content").mapInArrow(run, RECORDS)


def fetch(spark: SparkSession, path: str, page_ids: DataFrame) -> DataFrame:
    """The records of the given page_ids, with payloads.

    The index alone tells the files and bundles that hold them.  Content is read of
    these files only, and of it only the frames that hold a record are decompressed.
    The driver receives file names, no more than it lists to open the table.
    """
    bundles = spark.read.parquet(path)
    wanted = page_ids.select(F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
                             .alias("record_id")).distinct()
    index = bundles.select("bundle", F.col("_metadata.file_name").alias("file"), F.explode("index").alias("i"))
    places = cut_lineage(
        index.select("file", "bundle", "i.*").join(wanted, "record_id").groupBy("file", "bundle")
        .agg(F.sort_array(F.collect_list(F.struct("frame", "offset"))).alias("places")))   # bounded by a bundle
    files = [f"{path.rstrip('/')}/{r.file}" for r in places.select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], RECORDS)
    held = spark.read.schema(bundles.schema).parquet(*files).select("bundle", "content")

    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for row in b.to_pylist():
                table, last, frame, found = frames(row["content"]), None, b"", []
                for p in row["places"]:
                    if p["frame"] != last:
                        last = p["frame"]
                        at, packed, plain = table[last]
                        frame = unpack.decompress(row["content"][at:at + packed], max_output_size=plain)
                    head, block, _ = parse(frame, p["offset"])
                    found.append((head, block))
                yield _record_batch(found, True)
    return held.join(places, "bundle").select("content", "places").mapInArrow(run, RECORDS)
