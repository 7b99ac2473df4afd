"""A training corpus in five stages, each on what the stage before it kept.

Toxic documents go, of exact and near duplicates one document stays, personal
data is masked, and what is left is packed into sequences.  A stage takes
(spark, docs, sf_dir) and returns rows with the columns of documents; the last
returns the packed pieces.  ``run`` writes each stage's rows as Parquet to the
shared folder of the session and reads them again for the next.

Labels are learnt from as in op4: from rows of the labels table outside the
held-out fold.  A table without documents passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.llm import dedup, neardup, packing, pii, toxicity
from pathweave.llm.common import ship_code
from pathweave.session import ensure_checkpoint_dir, table

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under ``TOXIC_FROM``."""
    learnt = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.fit(docs, learnt), "__pw_score")
    return scored.where(F.col("__pw_score") < TOXIC_FROM).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest doc_id."""
    return dedup.unique_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest doc_id."""
    return neardup.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data in its text masked."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    # workers hold what earlier stages left, so this keeps less than the query of its own
    return packing.pack(docs, packing.PackConfig(cache_chunks=150_000))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# scores, sampled buckets and token ids are beyond SQL; tests/llm compares the rows with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pw-corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
