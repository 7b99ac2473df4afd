"""Leaf pairs come from one sort a tree, without grouping the leaves."""

from itertools import combinations, islice

from pyspark.sql import functions as F

from pathweave.config import MineConfig
from pathweave.operators import tree as T


def test_pairs_in_combination_order_without_grouping(spark):
    sizes = [0, 1, 2, 3, 5, 9, 14, 15, 40, 51, 101, 102, 103, 250]
    terms = spark.createDataFrame([(n, f"n{i:03}", False, ["r", f"n{i:03}"], ["ROOT", f"w{i}"], i) for n in sizes for i in range(n)],
                                  "tree_id bigint, node_id string, is_reserved boolean, ids array<string>, labels array<string>, sort_key int"
                                  ).withColumn("label", F.element_at("labels", -1))
    pairs = T.leaf_pairs(None, MineConfig(leaf_order="fixed"), terms)
    got = {n: [] for n in sizes}
    for r in pairs.orderBy("tree_id", "pair_idx").collect():
        assert r.a_ids == ["r", r.a_node_id] and r.b_labels == ["ROOT", r.b_label]
        got[r.tree_id].append((r.pair_idx, r.a_label, r.b_label))
    for n in sizes:
        want = islice(combinations([f"w{i}" for i in range(n)], 2), 101)
        assert got[n] == [(k, a, b) for k, (a, b) in enumerate(want)]
    assert "Aggregate" not in pairs._jdf.queryExecution().executedPlan().toString()
