"""Exact duplicates of texts by skew-safe combining.

Texts are equal when they are identical after replacing each run of the six
ASCII white spaces by one space.

1. Each row's SHA-256 and xxhash of the normalised text go to a narrow table.
   A digest that holds more than 1/``HOT_SHARE`` of all rows is hot; there are
   fewer than ``HOT_SHARE`` of those, so their list is broadcast.
2. Rows are grouped by (digest, salt, whole text): first within each task
   (partial aggregation leaves one row per distinct text and task), then across
   tasks.  Rows of hot digests get one of ``SALTS`` salts by their doc_id, the
   others salt 0.
3. The salt winners of hot digests (at most HOT_SHARE * SALTS texts) are grouped
   once more by (digest, whole text).  The others are complete already.
4. Groups meet the narrow table again on the two hashes.

Texts move once, in step 2, and are compared in full in steps 2 and 3.

Defined results: a null text equals an empty one; the smallest doc_id stays,
null doc_ids come last; rows with the doc_id that stays and an equal text all
have kept = true here, and ``unique_rows`` returns one of them; an empty table
gives an empty result; other columns are only read by ``unique_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

from .common import keep_marked

HOT_SHARE = 1000
SALTS = 64


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def hashes(text: Column) -> list[Column]:
    """The digest and the second hash by which groups are known outside the content-comparing steps."""
    return [F.unhex(F.sha2(text, 256)).alias("__pw_digest"), F.xxhash64(text).alias("__pw_second")]


KEY = ["__pw_digest", "__pw_second"]


def decisions(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    text = normalized(F.col("text"))
    rows = cut_lineage(docs.select("doc_id", text.alias("t")).select("doc_id", *hashes(F.col("t"))))
    counts = rows.groupBy("__pw_digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = counts.where(F.col("n") * HOT_SHARE > rows.count()).select("__pw_digest", F.lit(True).alias("hot"))

    whole = docs.select("doc_id", text.alias("t")).select("doc_id", "t", *hashes(F.col("t"))) \
        .join(F.broadcast(hot), "__pw_digest", "left")
    salt = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0).cast("int")
    salted = whole.groupBy(*KEY, salt.alias("salt"), "t").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    won = cut_lineage(salted.withColumn("t", F.when(F.col("salt") > 0, F.col("t"))))    # cold texts have done their part
    again = won.where("salt > 0").groupBy(*KEY, "t").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    groups = won.where("salt = 0").select(*KEY, "keep_id", F.col("n").alias("group_size")) \
        .unionByName(again.drop("t"))
    return rows.join(cut_lineage(groups), KEY, "left").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("__pw_digest")).alias("text_sha256"))


def unique_rows(docs: DataFrame) -> DataFrame:
    """The input's rows and columns with one row of each group of equal texts."""
    marked = cut_lineage(decisions(docs).select("doc_id", "kept", F.unhex("text_sha256").alias("__pw_digest")))
    rows = docs.withColumn("__pw_digest", hashes(normalized(F.col("text")))[0])
    return keep_marked(rows, marked, "__pw_digest").select(*docs.columns)
