"""Contexts are built in their tree's row and stay there: neither grouped, sorted nor shuffled."""

import pytest
from pyspark.sql import functions as F

from pathweave.config import DatasetConfig, MineConfig
from pathweave.operators import dataset as D
from pathweave.operators import tree as T
from pathweave.operators import vocab as V

CTX = "contexts array<struct<start:array<string>,path:array<string>,end:array<string>>>"


def some_terms(spark):
    rows = [(n, f"n{i:03}", i % 2 == 0, ["r", f"p{i % 4}", f"n{i:03}"], ["ROOT", f"P{i % 4}", f"w{i}A"], i)
            for n in (0, 1, 2, 3, 9, 14, 15, 102, 103, 130) for i in range(n)]
    rows += [(500, "r", True, ["r"], ["ROOT"], 0), (500, "x", False, ["r", "x"], ["ROOT", "___"], 1),   # a root that is a leaf, no subtoken
             (501, "r", True, ["r"], ["ROOT"], 0), (501, "x", False, ["r", "x"], ["ROOT", None], 1)]
    return spark.createDataFrame(rows, "tree_id bigint, node_id string, is_reserved boolean, ids array<string>, labels array<string>, "
                                 "sort_key int").withColumn("label", F.element_at("labels", -1))


@pytest.mark.parametrize("cfg", [MineConfig(leaf_order="fixed"), MineConfig(leaf_order="random"),
                                 MineConfig(leaf_order="random", max_contexts=7), MineConfig(leaf_order="fixed", max_path_len=3)])
def test_row_contexts_are_the_grouped_ones(spark, cfg):
    terms = some_terms(spark)
    rows = T.tree_contexts(None, cfg, terms)
    got = {r.tree_id: (r.contexts, r.any_bad or 0) for r in rows.collect()}
    want = {r.tree_id: (r.contexts, r.any_bad or 0) for r in T._grouped(T.mine_contexts(None, cfg, terms)).collect()}
    assert got == want and len(got) > 3
    if not cfg.max_path_len:
        assert "Aggregate" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("n", [0, 1, 2, 7, 60])
def test_split_in_place_is_the_split(spark, keep, n):
    cfg = DatasetConfig(keep_remainder=keep)
    rows = [(i, None if i % 11 == 0 else f"f{i % 3}", None if i % 13 == 0 else i) for i in range(n)]
    df = spark.createDataFrame(rows, "_row bigint, file string, line bigint")
    got = D.shuffle_split_in_place(df, cfg, "_row")
    assert sorted(map(str, got.select("_row", "split").collect())) == sorted(
        map(str, D.shuffle_split(df, cfg).select("_row", "split").collect()))


def test_equal_keys_are_split_exactly(spark):
    df = spark.range(30).select(F.col("id").alias("_row"), F.lit("f").alias("file"), F.lit(1).cast("bigint").alias("line"))
    got = {r.split: r["count"] for r in D.shuffle_split_in_place(df, DatasetConfig(), "_row").groupBy("split").count().collect()}
    assert got == {"train": 21, "test": 4, "val": 5}


def test_split_moves_no_contexts(spark):
    samples = V.materialize(spark.createDataFrame([(i, "f", i, ["a"], [(["x"], ["P"], ["y"])]) for i in range(20)],
                                                  f"_row bigint, file string, line bigint, target array<string>, {CTX}"))
    plan = D.shuffle_split_in_place(samples, DatasetConfig(), "_row")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
