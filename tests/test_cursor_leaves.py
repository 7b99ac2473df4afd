"""Leaves of cursors are made of the stored walk where they are read; degrees need no join."""

from pyspark.sql import functions as F

from pathweave.config import MineConfig
from pathweave.functions.text import format_sample
from pathweave.operators import cursors as C
from pathweave.operators import tree as T
from tests.test_mining_writes import source


def test_leaves_are_not_written_and_texts_are_those_of_the_contexts(spark, monkeypatch):
    written, keep = [], C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: written.append(df.columns) or keep(df))
    samples, _, leaves = C.mine_cursors(source(spark), MineConfig(), contexts=False)
    assert leaves.count() > 0 and not any("n_kids" in cols for cols in written)
    got = T.with_texts(samples).select("file", "line", format_sample("target", "contexts", texts=True).alias("s")).collect()
    whole, _, _ = C.mine_cursors(source(spark), MineConfig())
    want = whole.select("file", "line", format_sample("target", "contexts").alias("s")).collect()
    assert len(got) == 3 and sorted(map(str, got)) == sorted(map(str, want))


def test_degrees_without_a_join(spark):
    rows = [(1, "r", None), (1, "a", "r"), (1, "b", "a"), (1, "b", "a"), (2, "r", None), (2, "x", "gone"), (None, "r", None), (None, "a", "r"), (3, None, "r"), (3, "r", None)]
    out = T.node_degree(spark.createDataFrame(rows, "tree_id bigint, node_id string, parent_id string").withColumn("extra", F.lit(1)))
    assert out.columns == ["tree_id", "node_id", "parent_id", "extra", "degree"]
    assert sorted(str((r.tree_id, r.node_id, r.degree)) for r in out.collect()) == sorted(map(str, [
        (1, "r", 1), (1, "a", 3), (1, "b", 1), (1, "b", 1), (2, "r", 0), (2, "x", 1), (None, "r", 0), (None, "a", 1), (3, None, 1), (3, "r", 1)]))
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
