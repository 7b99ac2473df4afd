"""Data quality of samples (B14) and the reject report (B15).

Each rule is a column over exploded elements; the counts per rule are a
partial aggregate.  Rules follow the optional validators of the reference:
every target subtoken, context subtoken and path node must be non-empty and
hold no space, bar or comma (the text delimiters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the delimiters of the text format
DELIMITERS = [" ", "|", ","]


def _bad_delim(x):
    cond = F.lit(False)
    for d in DELIMITERS:
        cond = cond | x.contains(d)
    return cond


def element_rows(samples: DataFrame) -> DataFrame:
    """(file, line, part, value) for every target subtoken, context subtoken and path node."""
    tgt = samples.select("file", "line", F.lit("target").alias("part"), F.explode("target").alias("value"))
    ctx = samples.select("file", "line", F.explode("contexts").alias("c"))
    tok = ctx.select("file", "line", F.lit("token").alias("part"), F.explode(F.concat("c.start", "c.end")).alias("value"))
    node = ctx.select("file", "line", F.lit("path").alias("part"), F.explode("c.path").alias("value"))
    return tgt.unionByName(tok).unionByName(node)


def validate_samples(samples: DataFrame) -> DataFrame:
    """part, rule, n_violations, n_samples (rule = empty | delimiter)."""
    el = element_rows(samples)
    rule = F.when(F.length("value") == 0, "empty").when(_bad_delim(F.col("value")), "delimiter")
    bad = el.withColumn("rule", rule).where(F.col("rule").isNotNull())
    return bad.groupBy("part", "rule").agg(F.count("*").alias("n_violations"),
                                           F.count_distinct("file", "line").alias("n_samples"))
