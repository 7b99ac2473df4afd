"""The three stages as Spark jobs over files (mine, merge, preprocess).

Each job reads what the previous one wrote, so they can run on different
clusters or days.  Parquet is the canonical format; the text shapes of the
data set are written next to it when asked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks
from .config import DatasetConfig, MineConfig
from .operators import cursors as C
from .operators import dataset as D
from .operators import vocab as V
from .schemas import CURSORS
from .session import cut_lineage
from .sources.c2s import RAW_ORDER, parse_dataset_lines, read_raw_samples


def mine_job(spark: SparkSession, cursors_path: str, out: str, cfg: MineConfig = MineConfig(),
             raw_text: bool = False, sources_path: str | None = None, rules_path: str | None = None) -> None:
    """cursors parquet -> ``out/samples`` (+ ``out/rejects``; raw text lines when asked).

    ``sources_path``: parquet of loc_file, text; operators that a macro hides
    take their label from it.  ``rules_path``: parquet of kind, role for a tree
    language other than the default.
    """
    cursors = spark.read.schema(CURSORS).parquet(cursors_path)
    rules = spark.read.parquet(rules_path) if rules_path else None
    if sources_path:
        cursors = cut_lineage(C.attach_span_text(
            cursors.drop("span_text"), spark.read.parquet(sources_path).select("loc_file", "text"), rules))
    samples, rejects, _ = C.mine_cursors(cursors, cfg, rules=rules)
    samples = cut_lineage(samples.select("file", "line", "target", "contexts",
                                         F.col("tree_id").alias("unit_cursor")))
    samples.write.mode("overwrite").parquet(f"{out}/samples")
    rejects.write.mode("overwrite").parquet(f"{out}/rejects")
    if raw_text:
        sinks.write_raw_samples(samples, f"{out}/raw")


def merge_job(spark: SparkSession, samples_paths: list[str], out: str, cfg: DatasetConfig = DatasetConfig(),
              text: bool = False, raw_text: bool = False) -> DataFrame:
    """Bag of sample sets -> first sample per (file, line) -> ids, shuffle, split -> ``out/dataset``.

    A path is a folder of samples as Parquet or, with ``raw_text``, of raw text files.  Earlier
    paths win; within one, the order is that of the mined functions, or of the raw files and their lines.
    """
    if raw_text:
        parts = [read_raw_samples(spark, p) for p in samples_paths]
        order = ["_src", *RAW_ORDER]
    else:
        parts = [spark.read.parquet(p) for p in samples_paths]
        order = ["_src"] + (["unit_cursor"] if all("unit_cursor" in p.columns for p in parts) else [])
    merged = D.merge_raw(*[p.withColumn("_src", F.lit(i)) for i, p in enumerate(parts)])
    unique = (D.dedup_first if raw_text else D.dedup_first_stored)(merged, ["file", "line"], order)
    if raw_text:
        unique = parse_dataset_lines(unique.drop(*RAW_ORDER), "sample")
    unique = cut_lineage(unique.drop("_src"))
    ds = D.shuffle_split(unique, cfg)
    sinks.write_splits(ds, f"{out}/dataset")
    if text:
        sinks.write_splits(ds, f"{out}/dataset_text", fmt="text")
    return spark.read.parquet(f"{out}/dataset")


def preprocess_job(spark: SparkSession, dataset_path: str, out: str, cfg: DatasetConfig = DatasetConfig()) -> None:
    """Train histograms -> vocabularies + metadata; sampled and padded rows per split."""
    ds = spark.read.parquet(dataset_path)
    hist = cut_lineage(V.histograms(ds.where(F.col("split") == "train")))
    sinks.write_histogram(hist, f"{out}/histograms")
    sizes = {"subtoken": cfg.subtoken_vocab_size, "target": cfg.target_vocab_size, "node": cfg.node_vocab_size}
    vocab = cut_lineage(V.vocab_top_n(hist, sizes))
    meta = sinks.dictionary_metadata(ds, vocab, cfg)
    sinks.write_dictionaries(vocab, meta, f"{out}/dict")
    sampled = D.sample_contexts(ds, cfg)
    sinks.write_padded(D.padded_lines(sampled, cfg), f"{out}/padded")
    D.split_stats(sampled).write.mode("overwrite").parquet(f"{out}/stats")
