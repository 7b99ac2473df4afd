import itertools

import pytest
from pyspark.sql import functions as F

from pathweave.config import DatasetConfig, MineConfig
from pathweave.functions import tokens as W
from pathweave.functions.paths import inner_path, lca_depth
from pathweave.functions.text import format_mark, parse_context, parse_raw_line
from pathweave.operators import commands as C
from pathweave.operators import dataset as D
from pathweave.operators import tree as T


def _one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [("",)], schema)
    return df.select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("name,cut,want", [
    ("const Base &", 5, ["const", "Base", "&"]),
    ("std::vector<int>", 5, ["std", "vector", "int"]),
    ("_", 5, []),
    ("operator==_HTTPServer2.5AddImpl&&", 5, ["operator", "==", "HTTPServer", "2.5", "Add"]),
    ("operator==_HTTPServer2.5AddImpl&&", 0, ["operator", "==", "HTTPServer", "2.5", "Add", "Impl", "&&"]),
    ("&&", 5, ["&&"]),
    ("getHTTPResponseCode", 2, ["get", "HTTPResponse"]),
])
def test_tokenize(spark, name, cut, want):
    assert _one(spark, W.tokenize(F.lit(name), cut)) == want


def test_operator_token_and_aliases(spark):
    for op in W.OPERATOR_TOKENS:
        assert _one(spark, W.is_operator_token(F.lit(op)))
    assert not _one(spark, W.is_operator_token(F.lit(",")))
    assert _one(spark, W.fix_operator_spelling(F.lit("||"))) == "OPERATOR_LOGICAL_OR"
    assert _one(spark, W.fix_operator_spelling(F.lit("+"))) == "+"


def test_normalize_and_legal_names(spark):
    assert _one(spark, W.normalize_word(F.lit("Hello_World2!"))) == "helloworld"
    assert _one(spark, W.normalize_word(F.lit("123"))) == "123"
    assert _one(spark, W.filter_legal_names(F.array(*[F.lit(x) for x in ["a", "<UNK>", "<S>", "<PAD>", "</S>"]]))) == ["a", "<S>"]


def test_object_files(spark):
    for name, want in [("x.o", True), ("lib/x.o.d", True), ("x.cc", False), ("dir.o/x.c", False), ("x.obj", False)]:
        assert _one(spark, W.is_object_file(F.lit(name))) is want


def test_compile_args(spark):
    cmds = spark.createDataFrame([(1, ["clang", "-Xclang", "-foo", "-c", "x.cc", "-o", "x.o", "-DA=1"]),
                                  (2, ["clang", "-Xclang", "-Xclang", "kept", "-c"]),
                                  (3, ["clang"])], "cmd_id int, arguments array<string>")
    none = spark.createDataFrame([], "path string")
    got = {r["cmd_id"]: r["args"] for r in C.clean_compile_args(cmds, none).collect()}
    assert got == {1: ["x.cc", "-DA=1"], 2: ["kept"], 3: []}
    known = spark.createDataFrame([("x.cc",)], "path string")
    assert {r["cmd_id"]: r["args"] for r in C.clean_compile_args(cmds, known).collect()}[1] == ["-DA=1"]


def test_raw_mark_round_trip(spark):
    df = spark.createDataFrame([("a/b).cc", 7), ("it's.h", 3)], "file string, line bigint")
    rows = df.select(F.concat(format_mark("file", "line"), F.lit("t a,P,b")).alias("v")) \
        .select(*parse_raw_line("v")).collect()
    assert [(r["file"], r["line"], r["sample"]) for r in rows] == [("a/b).cc", 7, "t a,P,b"), ("it's.h", 3, "t a,P,b")]


def test_parse_context(spark):
    r = _one(spark, parse_context(F.lit("a|b,P|Q,c")))
    assert (r["start"], r["path"], r["end"]) == (["a", "b"], ["P", "Q"], ["c"])


def test_lca_and_inner_path(spark):
    row = spark.createDataFrame([(["r", "a", "b"], ["R", "A", "B"], ["r", "a", "c", "d"], ["R", "A", "C", "D"])],
                                "ia array<string>, la array<string>, ib array<string>, lb array<string>")
    r = row.select(lca_depth("ia", "ib").alias("c")).first()["c"]
    assert r == 2
    assert row.select(inner_path("la", "lb", F.lit(2)).alias("p")).first()["p"] == ["A", "C"]
    # one end is the ancestor of the other (a root with one child is a leaf)
    anc = spark.createDataFrame([(["r"], ["R"], ["r", "a", "b"], ["R", "A", "B"])],
                                "ia array<string>, la array<string>, ib array<string>, lb array<string>")
    assert anc.select(inner_path("la", "lb", lca_depth("ia", "ib")).alias("p")).first()["p"] == ["A"]


@pytest.mark.parametrize("m", [0, 1, 2, 5, 11])
def test_pair_generation_matches_combinations(spark, m):
    """Kept pairs equal the first m+1 of itertools.combinations, for 0..29 leaves."""
    ts = list(range(0, 30))
    df = spark.createDataFrame([(t,) for t in ts], "t bigint")
    got = {r["t"]: [(p["i"], p["j"], p["idx"]) for p in r["p"]]
           for r in df.select("t", T._pairs_in_row(F.col("t"), m).alias("p")).collect()}
    for t in ts:
        want = [(i, j, k) for k, (i, j) in enumerate(itertools.combinations(range(t), 2)) if k <= m]
        assert got[t] == want


def test_split_sizes():
    assert D.split_sizes(1001, DatasetConfig(keep_remainder=False)) == (700, 150, 150)
    assert D.split_sizes(1001, DatasetConfig()) == (700, 150, 151)
    assert D.split_sizes(1001, DatasetConfig(keep_remainder=True)) == (700, 150, 151)
    assert D.split_sizes(15000, DatasetConfig()) == (10500, 2250, 2250)


def test_split_is_disjoint_and_sized(spark):
    df = spark.range(1001).select(F.col("id").cast("string").alias("file"), F.lit(1).cast("bigint").alias("line"))
    out = D.shuffle_split(df, DatasetConfig(keep_remainder=False))
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 700, "test": 150, "val": 150}
    kept = D.shuffle_split(df, DatasetConfig()).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in kept} == {"train": 700, "test": 150, "val": 151}
    ids = [r["sample_id"] for r in out.collect()]
    assert sorted(ids) == list(range(1000))


def test_dedup_first_of_a_stored_table(spark, tmp_path):
    rows = [("a", 1, "x", 3), ("a", 1, "y", 2), ("a", 1, "z", 9), ("b", 1, "u", 5), (None, 2, "n", 4), (None, 2, "m", 1),
            (None, None, "o", 1), ("c", None, "p", 2), ("c", None, "p", 2)]
    spark.createDataFrame(rows, "file string, line int, sample string, ord int").write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    got = D.dedup_first_stored(df, ["file", "line"], ["ord"])
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, D.dedup_first(df, ["file", "line"], ["ord"]).collect()))
    assert sorted(r["sample"] for r in got.collect()) == ["m", "o", "p", "u", "y"]
    assert D.dedup_first_stored(df.limit(0), ["file", "line"], ["ord"]).count() == 0


def test_dedup_first_takes_first(spark):
    df = spark.createDataFrame([("f", 1, 2, "b"), ("f", 1, 1, "a"), ("g", 1, 5, "c")],
                               "file string, line bigint, ord int, sample string")
    got = {(r["file"], r["sample"]) for r in D.dedup_first(df, ["file", "line"], ["ord"]).collect()}
    assert got == {("f", "a"), ("g", "c")}


def test_context_sampling_keeps_small_rows(spark):
    cfg = DatasetConfig(max_contexts=2, max_data_contexts=3)
    ctx = [{"start": [str(i)], "path": ["P"], "end": ["e"]} for i in range(5)]
    df = spark.createDataFrame([("a", 1, "train", ctx), ("b", 2, "test", ctx[:2])],
                               "file string, line bigint, split string, "
                               "contexts array<struct<start:array<string>,path:array<string>,end:array<string>>>")
    rows = {r["file"]: r for r in D.sample_contexts(df, cfg).collect()}
    assert rows["a"]["n_before"] == 5 and rows["a"]["n_after"] == 3
    assert len({c["start"][0] for c in rows["a"]["contexts"]}) == 3
    assert [c["start"][0] for c in rows["b"]["contexts"]] == ["0", "1"]


def test_length_limited_pairs_equal_bruteforce(spark):
    """Rounds of start windows give the first survivors in combination order."""
    # a chain-and-star tree: root r; children a0..a5 each with a leaf; a deep branch r-x-y-z-leaf
    rows = [("t", "r", None, "R", True, 0, ["r"], ["R"])]
    for i in range(6):
        rows.append(("t", f"a{i}", "r", "A", True, 1, ["r", f"a{i}"], ["R", "A"]))
        rows.append(("t", f"l{i}", f"a{i}", f"w{i}", False, 2, ["r", f"a{i}", f"l{i}"], ["R", "A", f"w{i}"]))
    chain = ["x", "y", "z", "q"]
    for k, n in enumerate(chain):
        ids = ["r"] + chain[:k + 1]
        rows.append(("t", n, ids[-2], n.upper(), n != "q", k + 1, ids, ["R"] + [c.upper() for c in chain[:k + 1]]))
    nodes = spark.createDataFrame(rows, "tree_id string, node_id string, parent_id string, label string, "
                                        "is_reserved boolean, depth int, ids array<string>, labels array<string>")
    for limit, m in [(4, 3), (5, 100), (6, 2)]:
        cfg = MineConfig(max_contexts=m, max_path_len=limit, leaf_order="random", length_round_start=1)
        got = [(r["a_node_id"], r["b_node_id"]) for r in T.leaf_pairs(nodes, cfg).orderBy("pair_idx").collect()]
        ranked = [r["node_id"] for r in T.ranked_terminals(T.terminals(nodes), cfg, None).orderBy("rank").collect()]
        paths = {r["node_id"]: r["ids"] for r in nodes.collect()}
        want = []
        for a, b in itertools.combinations(ranked, 2):
            c = len(set(paths[a]) & set(paths[b]))
            if len(paths[a]) + len(paths[b]) - 2 * c + 1 <= limit:
                want.append((a, b))
            if len(want) > m:
                break
        assert got == want


def test_predictions_have_an_attention_map_per_step(spark):
    from pathweave.operators import predictions as P
    results = spark.createDataFrame(
        [("m", ["draw", "<UNK>", "draw", "line"], [{"c": 0.5, "d": 0.9}, {"c": 0.1}, {"e": 0.7, "c": 0.6}]),
         ("n", ["<PAD>"], [{"c": 0.2}]), ("o", [], []), ("p", ["shape"], [{}]), ("q", None, None)],
        "method string, words array<string>, attention array<map<string,double>>")
    info = spark.createDataFrame([("c", "P", "a", "b"), ("e", "Q", "x", "y")],
                                 "context string, path string, token1 string, token2 string")
    methods = spark.createDataFrame([(m, i, m.upper()) for i, m in enumerate("mnopq")],
                                    "method string, method_id bigint, original_name string")
    top = P.attention_topk(P.attention_steps(results), 2)
    out = P.parse_predictions(P.attention_paths(top, info), P.suggested_words(results), methods)
    got = sorted(((r["method_id"], r["step"], r["word"], [(p["rank"], p["path"]) for p in r["paths"]]) for r in out.collect()),
                 key=lambda r: (r[0], r[1] or 0))
    assert got == [(0, 0, "draw", [(2, "P")]), (0, 2, "draw", [(1, "Q"), (2, "P")]), (1, None, None, []),
                   (2, None, None, []), (3, 0, "shape", []), (4, None, None, [])]


def test_compile_arguments_are_looked_up_under_their_directory(spark):
    from pathweave.operators import commands as K
    cmds = spark.createDataFrame([(1, "/a/", ["cc", "x.cc", "./y.cc", "/a/x.cc", "-O2"]), (2, "/b", ["cc", "x.cc"]),
                                  (3, None, ["cc", "x.cc"])], "cmd_id int, directory string, arguments array<string>")
    known = spark.createDataFrame([("/a/x.cc",), ("/a/y.cc",)], "path string")
    got = {r["cmd_id"]: r["args"] for r in K.clean_compile_args(cmds, known).collect()}
    assert got == {1: ["-O2"], 2: ["x.cc"], 3: ["x.cc"]}
