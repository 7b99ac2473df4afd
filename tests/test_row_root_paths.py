"""Small trees find their root paths in a row: the same paths as the rounds of joins, and no round is written."""

import pytest
from pyspark.sql import functions as F

from pathweave.operators import tree as T

EDGES = "tree_id bigint, node_id string, parent_id string, label string, extra int"


def edges(spark, rows):
    return spark.createDataFrame(rows, EDGES)


def chain(tree, n):
    return [(tree, f"n{i}", f"n{i - 1}" if i else None, f"L{i}", i) for i in range(n)]


def odd_rows():
    return (chain(1, 1) + chain(2, 2) + chain(3, 9) + chain(4, 40) + [(5, f"x{i}", f"x{(i - 1) // 2}" if i else None, None, i) for i in range(31)]
            + [(6, "a", None, "A", 1), (6, "b", "gone", "B", 1), (6, "c", "b", "C", 1), (6, "y", "z", "Y", 1), (6, "z", "y", "Z", 1),
               (6, "w", "z", "W", 1), (6, "s", "s", "S", 1), (6, None, "a", "N", 1), (6, "m", None, "M", 2), (6, "k", "m", "K", 2)]
            + [(7, "a", None, "A", 1), (7, "a", None, "B", 2), (7, "c", "a", "C", 3), (7, "d", "c", "D", 4)]
            + [(None, "a", None, "A", 1), (None, "b", "a", "B", 1)])


@pytest.mark.parametrize("most", [256, 8, 0])
def test_rows_and_rounds_agree(spark, monkeypatch, most):
    monkeypatch.setattr(T, "ROW_NODES", most)
    df = edges(spark, odd_rows())
    got, want = T.root_paths(df), T._doubled_root_paths(df)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_small_trees_write_no_round(spark, monkeypatch):
    written, keep = [], T.cut_lineage
    monkeypatch.setattr(T, "cut_lineage", lambda df: written.append(df.columns) or keep(df))
    out = T.root_paths(edges(spark, chain(1, 20) + chain(2, 3)))
    assert out.where(F.col("depth") == 19).count() == 1 and written == [["_other"]]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
