"""Under a length limit trees of many leaves are settled in their row where their first leaves give pairs enough."""

import itertools
import re

from pyspark.sql import functions as F

from pathweave.config import MineConfig
from pathweave.operators import tree as T


def terms_of(spark, trees):
    """trees: tree_id -> list of root paths of leaves in leaf order."""
    rows = [(t, ids[-1], ids[-1].upper(), False, ids, [x.upper() for x in ids], i) for t, paths in trees.items() for i, ids in enumerate(paths)]
    return spark.createDataFrame(rows, "tree_id bigint, node_id string, label string, is_reserved boolean, ids array<string>, "
                                 "labels array<string>, sort_key int")


def fitting(paths, limit, most):
    def nodes(a, b):
        return len(a) + len(b) - 2 * sum(x == y for x, y in zip(a, b)) + 1
    return [(a[-1], b[-1]) for a, b in itertools.combinations(paths, 2) if nodes(a, b) <= limit][:most]


def lines(n, per_line):
    """Leaves of n lines, dealt round; every seventh leaf stands directly under its line, one under the root."""
    return [["r", f"l{i % n}", f"l{i % n}k{i}", f"w{i}"] if i % 7 else ["r", f"l{i % n}", f"w{i}"] for i in range(n * per_line)] + [["r", "x"]]


def test_many_leaves_are_settled_in_their_row(spark, monkeypatch):
    trees = {1: lines(6, 40), 2: lines(30, 20), 3: lines(1, 300), 4: lines(2, 3), 5: lines(400, 1)[:64]}
    cfg = MineConfig(leaf_order="fixed", max_path_len=5, max_contexts=100)
    monkeypatch.setattr(T, "_length_limited_pairs", None)      # no rounds
    got = {}
    for r in T.leaf_pairs(None, cfg, terms_of(spark, trees)).orderBy("tree_id", "pair_idx").collect():
        assert r.pair_idx == len(got.setdefault(r.tree_id, []))
        assert r.a_ids[-1] == r.a_node_id and r.b_labels[-1] == r.b_label and r.a_tok == tokens(r.a_label)
        got[r.tree_id].append((r.a_node_id, r.b_node_id))
    assert got == {t: want for t, paths in trees.items() if (want := fitting(paths, 5, 101))}


def tokens(label):
    return re.findall("[a-z]+|[A-Z]+[a-z]*|[0-9.]+", label)[:5]


def test_trees_short_of_pairs_or_too_large_go_through_the_rounds(spark, monkeypatch):
    # lines of two words: the first starts do not give 101 pairs; and a tree beyond the size of a row
    trees = {1: [["r", f"l{i % 90}", f"k{i}", f"w{i}"] for i in range(180)], 2: lines(6, 40), 3: lines(3, 60)}
    cfg = MineConfig(leaf_order="fixed", max_path_len=5, max_contexts=100)
    monkeypatch.setattr(T, "ROW_LEAVES", 200)
    terms = terms_of(spark, trees)
    small, rest = T._small_trees(T._limited_terminals(None, cfg, terms), cfg)
    assert [r.tree_id for r in small.collect()] == [3] and sorted(r.tree_id for r in rest.collect()) == [1, 2]
    got = {}
    for r in T.leaf_pairs(None, cfg, terms).orderBy("tree_id", "pair_idx").collect():
        got.setdefault(r.tree_id, []).append((r.a_node_id, r.b_node_id))
    assert got == {t: fitting(paths, 5, 101) for t, paths in trees.items()}


def test_row_comparison_agrees_with_rounds_for_odd_limits(spark):
    terms = terms_of(spark, {1: lines(5, 30), 2: [["r"]] + [["r", *[f"d{k}" for k in range(i % 6)], f"e{i}"] for i in range(80)]})
    for limit, m in ((4, 20), (6, 3)):
        cfg = MineConfig(leaf_order="random", max_path_len=limit, max_contexts=m)
        cols = ["tree_id", "pair_idx", "a_node_id", "b_node_id", "a_ids", "b_labels", "a_tok"]
        want = sorted(map(str, T._length_limited_pairs(T._limited_terminals(None, cfg, terms), cfg).select(*cols).collect()))
        assert sorted(map(str, T.leaf_pairs(None, cfg, terms).select(*cols).collect())) == want
