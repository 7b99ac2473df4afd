"""Incremental forms of the merge and the histograms (Structured Streaming).

L1  raw sample files are merged as they appear (``merge_stream``): a micro-batch
    keeps its first sample per mark, in the order of its files and of their lines,
    and leaves out marks of earlier batches.  Earlier batches are read back from the
    output itself (two columns of it), so no state grows in the executors, and a
    batch that is run again after a failure replaces its own folder only.
    ``dedup_marks`` is the form on a state store, for streams without an output table.
L2  running vocabulary counts: ``groupBy(kind, token).count()`` in update mode.
A11 the file source can delete or archive inputs once read (``cleanSource``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import RAW_FILES, parse_raw_line
from ..operators.vocab import token_rows
from ..sources.c2s import first_raw_samples, parse_dataset_lines


def raw_sample_stream(spark: SparkSession, path: str, files_per_trigger: int = 1,
                      clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming rows (file, line, sample, source, block_start) from the raw files under ``path``."""
    r = (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger)
         .option("pathGlobFilter", RAW_FILES).option("recursiveFileLookup", "true"))
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return r.load(path).select(*parse_raw_line("value"), F.col("_metadata.file_path").alias("source"),
                                F.col("_metadata.file_block_start").alias("block_start"))


def dedup_marks(stream: DataFrame) -> DataFrame:
    """One row for each (file, line) across the whole stream; which of a batch is Spark's choice."""
    return stream.dropDuplicates(["file", "line"])


def merge_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Writes the batch's first sample of each mark that no earlier batch has to ``out/batch=<id>``.

    A mark's earlier rows are looked up by the batch's own marks first, so that what is
    joined and shuffled follows the batch, while earlier batches are scanned in two columns.
    """
    spark = batch.sparkSession
    # a split of a file is read by one task, in which the increasing id follows the lines
    placed = batch.withColumn("block_place", F.monotonically_increasing_id())
    fresh = first_raw_samples(placed)
    if batch_id > 0:
        earlier = spark.read.parquet(out).where(F.col("batch") < batch_id).select("file", "line")
        asked = batch.select("file", "line").distinct()
        seen = earlier.join(asked, ["file", "line"], "left_semi")
        fresh = fresh.join(seen, ["file", "line"], "left_anti")
    fresh.select("file", "line", "sample").write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")


def merge_stream(spark: SparkSession, raw_path: str, out: str, checkpoint: str, files_per_trigger: int = 1000,
                 **source_options) -> DataFrame:
    """Merges the raw files that are there and not yet merged; returns the merged samples.

    ``out`` and ``checkpoint`` belong together.  Earlier triggers win over later ones; within a
    trigger the order is that of the batch merge.
    """
    stream = raw_sample_stream(spark, raw_path, files_per_trigger, **source_options)
    run_available(stream, checkpoint, "append", lambda df, i: merge_batch(df, i, out))
    return spark.read.parquet(out).drop("batch")


def running_histograms(dataset_stream: DataFrame) -> DataFrame:
    """Streaming (kind, token, cnt) over dataset rows (``target``/``contexts`` arrays)."""
    return token_rows(dataset_stream).groupBy("kind", "token").agg(F.count("*").alias("cnt"))


def dataset_line_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Streaming dataset rows parsed from ``target ctx ctx ...`` text files."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return parse_dataset_lines(lines)


def run_available(df: DataFrame, checkpoint: str, mode: str, sink_fn) -> None:
    """Drain everything available now through ``foreachBatch(sink_fn)`` and stop."""
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink_fn).trigger(availableNow=True).start())
    q.awaitTermination()
