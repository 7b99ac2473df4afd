"""Rounds of the root paths write the path once: not the node's id, label and parent beside it."""

from pathweave.operators import tree as T


def test_rounds_write_paths_alone_and_give_the_columns_back(spark, monkeypatch):
    rows = [(1, "a", None, "A", 7), (1, "b", "a", None, 8), (1, "c", "b", "C", 9), (1, "d", "c", "D", None),
            (1, "x", "gone", "X", 1), (1, "y", "z", "Y", 1), (1, "z", "y", "Z", 1), (2, "a", None, "R", 5)]
    edges = spark.createDataFrame(rows, "tree_id bigint, node_id string, parent_id string, label string, extra int")
    written, keep = [], T.cut_lineage
    monkeypatch.setattr(T, "cut_lineage", lambda df: written.append(df.columns) or keep(df))
    out = T.root_paths(edges)
    assert out.columns == ["tree_id", "node_id", "parent_id", "label", "extra", "ids", "labels", "depth"]
    got = sorted(tuple(r) for r in out.select("tree_id", "node_id", "parent_id", "label", "extra", "labels", "depth").collect())
    assert str(got) == str(sorted([
        (1, "a", None, "A", 7, ["A"], 0), (1, "b", "a", None, 8, ["A", None], 1), (1, "c", "b", "C", 9, ["A", None, "C"], 2),
        (1, "d", "c", "D", None, ["A", None, "C", "D"], 3), (2, "a", None, "R", 5, ["R"], 0)]))
    assert written and all(not {"node_id", "parent_id", "label"} & set(c) for c in written)
