"""Sinks: raw sample text files (A4), split data sets (A6), padded files (A8),
histograms (A9) and the dictionary bundle (A10).  Parquet is canonical."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import DatasetConfig
from .functions.text import format_sample, raw_line


def write_raw_samples(samples: DataFrame, out: str, per_file: int = 1000) -> None:
    """``('<file>', <line>)<sample>`` lines, at most ``per_file`` per output file."""
    (samples.select(raw_line("file", "line", "target", "contexts").alias("value"))
     .write.mode("overwrite").option("maxRecordsPerFile", per_file).text(out))


def write_splits(dataset: DataFrame, out: str, fmt: str = "parquet") -> None:
    """One folder per split (``split=train|test|val``)."""
    if fmt == "text":
        (dataset.select("split", format_sample("target", "contexts").alias("value"))
         .write.mode("overwrite").partitionBy("split").text(out))
    else:
        dataset.write.mode("overwrite").partitionBy("split").parquet(out)


def write_padded(padded: DataFrame, out: str) -> None:
    padded.select("split", F.col("text").alias("value")).write.mode("overwrite").partitionBy("split").text(out)


def write_histogram(hist: DataFrame, out: str) -> None:
    (hist.select("kind", F.concat_ws(" ", "token", F.col("cnt").cast("string")).alias("value"))
     .write.mode("overwrite").partitionBy("kind").text(out))


def dictionary_metadata(dataset: DataFrame, vocab: DataFrame, cfg: DatasetConfig) -> DataFrame:
    """One row: max contexts, number of train examples and the three vocabulary sizes."""
    n_train = dataset.where(F.col("split") == "train").count()

    def size(kind):
        return F.sum(F.when(F.col("kind") == kind, 1).otherwise(0)).cast("bigint")
    return vocab.agg(F.lit(cfg.max_data_contexts).cast("bigint").alias("max_contexts"),
                     F.lit(n_train).cast("bigint").alias("num_examples"),
                     size("subtoken").alias("subtoken_size"), size("node").alias("node_size"),
                     size("target").alias("target_size"))


def write_dictionaries(vocab: DataFrame, meta: DataFrame, out: str) -> None:
    vocab.write.mode("overwrite").partitionBy("kind").parquet(f"{out}/vocab")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{out}/metadata")
