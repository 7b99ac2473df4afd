"""Queries that need no contexts of the samples do not write them."""

import pytest
from pyspark.sql import functions as F

from pathweave.operators import vocab as V
from pathweave.plans import dataset_queries as Q


@pytest.mark.parametrize("query", ["q_sample_ids", "q_shuffle_split", "q_dataset_counts", "q_hist_target"])
def test_contexts_are_not_written(spark, monkeypatch, query):
    samples = spark.createDataFrame([(i, f"f{i % 3}", i, ["a", "b"], [(["x"], ["P"], ["y"])]) for i in range(20)],
                                    "tree_id bigint, file string, line bigint, target array<string>, "
                                    "contexts array<struct<start:array<string>,path:array<string>,end:array<string>>>")
    written, keep = [], V.materialize
    monkeypatch.setattr(Q, "ot_samples", lambda spark, sf: (samples, samples.where(F.lit(False))))
    monkeypatch.setattr(V, "materialize", lambda df: written.append(df.columns) or keep(df))
    assert getattr(Q, query)(spark, "").count() > 0
    assert written and all("contexts" not in cols for cols in written)
