"""Pointer doubling, length-limited pairs, the depth cut of leaves, header copies and raw files."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pathweave import jobs, sinks
from pathweave.config import DatasetConfig, MineConfig
from pathweave.operators import cursors as C
from pathweave.operators import tree as T
from pathweave.sources import c2s
from tests.cursor_fixtures import cur, cursor_df, ident

EDGES = "tree_id string, node_id string, parent_id string, label string, is_reserved boolean, note int"


def edges_df(spark, parents):
    """parents: {(tree, node): parent or None}"""
    return spark.createDataFrame([(t, n, p, n.upper(), True, 7) for (t, n), p in parents.items()], EDGES)


def random_trees(seed, trees=12, most=40):
    rng = random.Random(seed)
    out = {}
    for t in range(trees):
        for i in range(rng.randint(1, most)):
            out[f"t{t}", f"n{i}"] = None if i == 0 else f"n{rng.randrange(max(0, i - rng.choice([1, 3, 30])), i)}"
    return out


def up(parents, t, n):
    path = []
    while n is not None:
        path.append(n)
        n = parents[t, n]
    return path[::-1]


# ------------------------------------------------------------------ root paths
def test_a_deep_chain_takes_log_rounds(spark, monkeypatch):
    written = []
    real = T.cut_lineage
    monkeypatch.setattr(T, "cut_lineage", lambda df: written.append(1) or real(df))
    depth = 1500
    chain = {("c", f"n{i}"): f"n{i - 1}" if i else None for i in range(depth)}
    got = T.root_paths(edges_df(spark, chain)).select("node_id", "depth", F.size("labels").alias("n"),
                                                     F.element_at("ids", 1).alias("root"), F.element_at("ids", -1).alias("last"))
    rows = got.collect()
    assert {(r.node_id, r.depth, r.n, r.root, r.last) for r in rows} == {(f"n{i}", i, i + 1, "n0", f"n{i}") for i in range(depth)}
    assert len(rows) == depth and len(written) <= 13       # the first table and 11 or 12 doublings


def test_root_paths_leave_out_orphans_and_cycles(spark):
    parents = random_trees(1)
    bad = {("t0", "x"): "missing", ("t0", "y"): "x", ("z", "a"): "b", ("z", "b"): "c", ("z", "c"): "a", ("z", "d"): "a", ("s", "s"): "s"}
    got = T.root_paths(edges_df(spark, parents | bad)).collect()
    assert {(r.tree_id, r.node_id): (r.ids, r.depth, r.note, r.labels) for r in got} == {
        (t, n): (up(parents, t, n), len(up(parents, t, n)) - 1, 7, [x.upper() for x in up(parents, t, n)]) for t, n in parents}
    assert T.root_paths(edges_df(spark, parents), max_levels=2).agg(F.max("depth")).first()[0] == 2


# ------------------------------------------------------------------ pairs within a path length
def leaves_of(parents):
    kids = Counter((t, p) for (t, n), p in parents.items() if p is not None)
    return [(t, n) for (t, n), p in parents.items() if kids[t, n] + (p is not None) == 1]


def path_nodes(a, b):
    c = sum(x == y for x, y in zip(a, b))
    return len(a) + len(b) - 2 * c + 1


@pytest.mark.parametrize("limit,m,first", [(2, 5, 1), (3, 0, 1), (3, 4, 2), (4, 9, 1), (5, 30, 4), (7, 100, 1), (50, 3, 1)])
def test_length_limited_pairs_are_the_first_in_order(spark, monkeypatch, limit, m, first):
    parents = random_trees(limit * 100 + m, trees=9, most=45) | {
        ("star", "r"): None, **{("star", f"k{i}"): "r" for i in range(60)},
        **{("comb", f"b{i}"): f"b{i - 1}" if i else None for i in range(30)}, **{("comb", f"x{i}"): f"b{i}" for i in range(30)}}
    cfg = MineConfig(max_contexts=m, max_path_len=limit, length_round_start=first)
    rounds = []
    real = T.cut_lineage

    def watched(df):
        out = real(df)
        if "pair_idx" in df.columns:
            rounds.append(out)
        return out
    monkeypatch.setattr(T, "cut_lineage", watched)
    nodes = T.root_paths(edges_df(spark, parents))
    got = {(r.tree_id, r.pair_idx): (r.a_node_id, r.b_node_id, r.a_ids, r.b_labels) for r in T.leaf_pairs(nodes, cfg).collect()}
    order = {(r.tree_id, r.node_id): r.h for r in nodes.select("tree_id", "node_id", F.md5(F.concat_ws(
        ":", F.lit("42"), "tree_id", "node_id")).alias("h")).collect()}
    by = {}
    for t, n in leaves_of(parents):
        by.setdefault(t, []).append((order[t, n], n))
    want = {}
    for t, ls in by.items():
        fits = [(a, b) for (_, a), (_, b) in itertools.combinations(sorted(ls), 2)
                if path_nodes(up(parents, t, a), up(parents, t, b)) <= limit]
        for i, (a, b) in enumerate(fits[:m + 1]):
            want[t, i] = (a, b, up(parents, t, a), [x.upper() for x in up(parents, t, b)])
    assert got == want
    # no round writes more than a tree's m + 1 pairs, and all rounds together as many as are kept
    for r in rounds:
        assert (r.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0) <= m + 1
    assert sum(r.count() for r in rounds) == len(want)


# ------------------------------------------------------------------ depth cut
@pytest.mark.parametrize("depth", [1, 2, 4, 30])
def test_depth_limit_is_the_same_from_nodes_and_from_leaves(spark, depth):
    parents = random_trees(50 + depth)
    nodes = T.root_paths(edges_df(spark, parents))
    cfg = MineConfig(max_ast_depth=depth, max_contexts=60)
    rows = [sorted(map(str, df.drop("tok").collect())) for df in (
        T.mine_contexts(nodes, cfg), T.mine_contexts(None, cfg, T.terminals(nodes)))]
    assert rows[0] == rows[1] and rows[0]


def test_depth_cut_keeps_the_leaf_order_and_extra_leaves(spark):
    nodes = T.root_paths(edges_df(spark, {("t", "r"): None, ("t", "a"): "r", ("t", "b"): "a", ("t", "c"): "b", ("t", "d"): "b", ("t", "e"): "r"}))
    terms = T.terminals(nodes).withColumn("sort_key", F.struct(F.ascii("node_id")))
    got = T.depth_limit_terminals(terms, 1).orderBy("sort_key").collect()
    assert [(r.node_id, r.label, r.ids, r.is_reserved) for r in got] == [
        ("b", "B", ["r", "a", "b"], True), ("e", "E", ["r", "e"], True)]


# ------------------------------------------------------------------ callee chains
def test_callee_chain_of_any_length(spark):
    rows = [cur("f", None, "FUNCTION_DECL", 0, "main", is_decl=True, is_def=True)]
    for length in (1, 2, 3, 7, 40):
        rows.append(cur(f"call{length}", "f", "CALL_EXPR", length, type_spelling="int"))
        for i in range(length):
            rows.append(cur(f"c{length}.{i}", f"c{length}.{i - 1}" if i else f"call{length}", "UNEXPOSED_EXPR", 0, f"s{length}.{i}"))
            rows.append(cur(f"o{length}.{i}", f"c{length}.{i}", "DECL_REF_EXPR", 1, "other"))
    rows += [cur("named", "f", "CALL_EXPR", 50, referenced="g"), cur("nc", "named", "UNEXPOSED_EXPR", 0, "unused"), cur("bare", "f", "CALL_EXPR", 51)]
    got = {r.cursor_id: r.chain_spelling for r in C.first_child_chain_spelling(cursor_df(spark, rows)).collect()}
    assert got == {f"call{n}": f"s{n}.{n - 1}" for n in (1, 2, 3, 7, 40)}


# ------------------------------------------------------------------ header copies
def header_unit(unit, kind="good", line=5, method=False):
    root, parent = f"{unit}", f"{unit}cl" if method else f"{unit}"
    rows = [cur(root, None, "TRANSLATION_UNIT", spelling=unit, unit=unit)]
    if method:
        rows.append(cur(parent, root, "CLASS_DECL", 0, "Shape", unit=unit))
    f = f"{unit}f"
    rows += [cur(f, parent, "CXX_METHOD" if method else "FUNCTION_DECL", 1, "total", is_decl=True, is_def=True, result_type="int",
                 loc_file="shape.h", line=line, unit=unit), cur(f + "b", f, "COMPOUND_STMT", 0, unit=unit)]
    if kind == "good":
        rows.append(cur(f + "l", f + "b", "DECL_REF_EXPR", 0, "x", tokens=ident("x" + unit), unit=unit))
    else:
        rows.append(cur(f + "c", f + "b", "CALL_EXPR", 0, "g", type_spelling="", referenced="g", unit=unit))
    return rows


def test_header_marks_fall_back_to_the_next_copy(spark):
    bad = {"a", "b", "c", "e"}
    rows = [r for u in "abcdefgh" for r in header_unit(u, "bad" if u in bad else "good")]
    rows += [r for u in ("m1", "m2") for r in header_unit(u, "bad" if u == "m1" else "good", line=9, method=True)]
    rows += [r for u in ("z1", "z2", "z3") for r in header_unit(u, "bad", line=77)]
    samples, rejects, leaves = C.mine_cursors(cursor_df(spark, rows), MineConfig())
    assert sorted((r.tree_id, r.line) for r in samples.collect()) == [("df", 5), ("m2f", 9)]
    # copies tried before the good one are reported with their extent, later ones are not
    assert sorted((r.unit, r.line, r.reason, r.end_line, r.start_col) for r in rejects.collect()) == [
        ("a", 5, "call without a type", 5, 1), ("b", 5, "call without a type", 5, 1), ("c", 5, "call without a type", 5, 1),
        ("m1", 9, "call without a type", 9, 1), *[(f"z{i}", 77, "call without a type", 77, 1) for i in (1, 2, 3)]]
    assert {r.tree_id for r in leaves.collect()} >= {"df", "m2f"} and not {"ff", "gf", "hf"} & {r.tree_id for r in leaves.collect()}


# ------------------------------------------------------------------ raw files
def test_first_line_of_a_raw_file_wins_over_many_splits(spark, tmp_path):
    (tmp_path / "raw" / "deep").mkdir(parents=True)
    with open(tmp_path / "raw" / "b.c2s", "w") as f:
        for i in range(4000):
            f.write(f"('x{i % 700}.cc', {i % 700})name{i} s{i},P,e{i}\n")
    with open(tmp_path / "raw" / "a.c2s", "w") as f:
        f.write("('x5.cc', 5)first a,P|Q,b\n('only.cc', 1)k a,,b\n")
    with open(tmp_path / "raw" / "deep" / "c.c2s", "w") as f:
        f.write("('x6.cc', 6)late a,P,b\n")
    (tmp_path / "raw" / "notes.md").write_text("('no.cc', 1)k a,P,b\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        raw = c2s.read_raw_samples(spark, str(tmp_path / "raw"))
        assert raw.where("source LIKE '%b.c2s'").select("block_start").distinct().count() > 5
        first = c2s.first_raw_samples(raw).collect()
        ds = jobs.merge_job(spark, [str(tmp_path / "raw")], str(tmp_path / "out"), DatasetConfig(), raw_text=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(r.file, r.line): r.sample for r in first}
    want = {(f"x{i}.cc", i): f"name{i} s{i},P,e{i}" for i in range(700)} | {("x5.cc", 5): "first a,P|Q,b", ("only.cc", 1): "k a,,b"}
    assert got == want and len(first) == 701
    rows = {(r.file, r.line): r for r in ds.collect()}
    assert len(rows) == 701 and rows["x5.cc", 5].target == ["first"] and rows["x5.cc", 5].contexts[0].path == ["P", "Q"]
    assert rows["only.cc", 1].contexts[0].path == []


def test_raw_files_of_two_miners_in_order(spark, tmp_path):
    made = spark.createDataFrame([("f", 1, ["one"], [(["a"], ["P"], ["b"])])], "file string, line long, target array<string>, "
                                 "contexts array<struct<start:array<string>,path:array<string>,end:array<string>>>")
    sinks.write_raw_samples(made.withColumn("target", F.array(F.lit("two"))), str(tmp_path / "a"))
    sinks.write_raw_samples(made, str(tmp_path / "b"))
    for order, want in ((("a", "b"), "two"), (("b", "a"), "one")):
        ds = jobs.merge_job(spark, [str(tmp_path / p) for p in order], str(tmp_path / "-".join(order)), raw_text=True)
        assert [(r.file, r.line, r.target) for r in ds.collect()] == [("f", 1, [want])]
