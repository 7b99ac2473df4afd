"""Trees of few leaves are compared in one row under a length limit; the others, in rounds, give the same pairs."""

from pyspark.sql import functions as F

from pathweave.config import MineConfig
from pathweave.operators import tree as T


def some_terms(spark):
    rows = [(n, f"n{i:03}", False, ["r", f"p{i % 5}", f"n{i:03}"], ["ROOT", f"P{i % 5}", f"w{i}"], i)
            for n in (1, 2, 7, 25, 63, 64, 65, 90) for i in range(n)]
    rows += [(30, f"m{i}", False, ["r", f"m{i}"], ["ROOT", f"v{i}"], 100 + i) for i in range(3)]
    rows += [(31, "r", True, ["r"], ["ROOT"], 0), (31, "x", False, ["r", "x"], ["ROOT", "X"], 1)]
    return spark.createDataFrame(rows, "tree_id bigint, node_id string, is_reserved boolean, ids array<string>, labels array<string>, "
                                 "sort_key int").withColumn("label", F.element_at("labels", -1))


def test_small_trees_need_no_rounds(spark, monkeypatch):
    terms = some_terms(spark)
    cols = ["tree_id", "pair_idx", "a_node_id", "b_node_id", "a_ids", "b_labels", "a_tok"]
    for cfg in (MineConfig(leaf_order="fixed", max_path_len=3), MineConfig(leaf_order="random", max_path_len=4, max_contexts=10)):
        want = sorted(map(str, T._length_limited_pairs(T._limited_terminals(None, cfg, terms), cfg).select(*cols).collect()))
        assert sorted(map(str, T.leaf_pairs(None, cfg, terms).select(*cols).collect())) == want
    small = terms.where("tree_id <= 64")
    want = sorted(map(str, T._length_limited_pairs(T._limited_terminals(None, cfg, small), cfg).select(*cols).collect()))
    monkeypatch.setattr(T, "_length_limited_pairs", None)
    assert sorted(map(str, T.leaf_pairs(None, cfg, small).select(*cols).collect())) == want


def test_odd_trees_go_through_the_rounds(spark):
    cfg = MineConfig(leaf_order="fixed", max_path_len=3)
    terms = some_terms(spark).where("tree_id = 7")
    odd = terms.unionByName(terms.limit(1)).unionByName(terms.withColumns({"tree_id": F.lit(8).cast("bigint"), "ids": F.array(
        F.lit("r"), F.lit(None).cast("string"), "node_id")})).unionByName(terms.withColumn("tree_id", F.lit(None).cast("bigint")))
    small, rest = T._small_trees(T._limited_terminals(None, cfg, odd), cfg)
    assert small.count() == 0 and sorted(r.tree_id for r in rest.collect()) == [7, 8]
