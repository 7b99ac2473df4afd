"""Samples that hold leaves: contexts made of them are the contexts, and no step writes or evaluates them twice."""

import glob

import pytest
from pyspark.sql import functions as F

from pathweave.config import MineConfig
from pathweave.functions.text import format_context, parse_context
from pathweave.operators import dataset as D
from pathweave.operators import tree as T
from pathweave.operators import vocab as V
from pathweave.plans import dataset_queries as Q
from pathweave.plans.order_tree import order_tree_nodes, order_tree_terminals
from pathweave.sources.c2s import parse_dataset_lines

from .test_contexts_in_place import some_terms


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def odd_terms(spark):
    deep = [f"d{i}" for i in range(T.TEXT_DEPTH + 3)]
    rows = [(600, "a", False, ["r", "q", "a"], ["R|S", None, "xY"]), (600, "b", False, ["r", "q", "b"], ["R|S", None, "z,W"]),
            (600, "c", False, ["r", "c"], ["R|S", None]), (600, "e", True, ["r", "p", "e"], ["", "P|", "||"]),
            (600, "f", True, ["r", "p", "f"], ["", "", ""]),
            (601, "a", False, [*deep, "a"], [*deep, "aB"]), (601, "b", False, [*deep, "b"], [*deep, "c"]), (601, "c", False, ["d0", "c"], ["d0", "e"]),
            (602, "a", True, ["x", "a"], ["X", "a"]), (602, "b", True, ["y", "b"], ["Y", "b"])]
    odd = spark.createDataFrame(rows, "tree_id bigint, node_id string, is_reserved boolean, ids array<string>, labels array<string>")
    odd = odd.withColumns({"label": F.element_at("labels", -1), "sort_key": F.lit(0)})
    return some_terms(spark).unionByName(odd)


@pytest.mark.parametrize("m", [100, 7])
def test_contexts_of_leaves(spark, m):
    cfg = MineConfig(leaf_order="random", max_contexts=m)
    leaves = T.tree_leaves(None, cfg, odd_terms(spark))
    want = {r.tree_id: r for r in T._grouped(T.mine_contexts(None, cfg, odd_terms(spark))).withColumn(
        "texts", F.transform("contexts", format_context)).collect()}
    got = {r.tree_id: r for r in leaves.select("*", T.row_contexts().alias("contexts"), T.row_texts().alias("texts")).collect()}
    assert set(got) == set(want) and {600, 601, 602} <= set(got)
    for k, r in got.items():
        assert (r.contexts, r.texts, r.n_contexts) == (want[k].contexts, want[k].texts, len(want[k].contexts))
    flat = {}
    for r in T.context_rows(leaves, "tree_id").collect():
        flat.setdefault(r.tree_id, []).append((r.ctx_pos, r.start, r.path, r.end))
    assert {k: sorted(v, key=lambda c: c[0]) for k, v in flat.items()} == {
        k: [(i, c.start, c.path, c.end) for i, c in enumerate(r.contexts)] for k, r in want.items()}


def test_histograms_and_flags_of_leaves(spark):
    cfg = MineConfig(leaf_order="random", max_contexts=7)
    mark = {"file": F.col("tree_id").cast("string"), "line": F.col("tree_id"), "target": F.array(F.lit("t"))}
    leaves = T.tree_leaves(None, cfg, odd_terms(spark)).withColumns(mark)
    contexts = T.tree_contexts(None, cfg, odd_terms(spark)).withColumns(mark)

    def rows(df):
        return sorted(map(str, df.collect()))
    assert rows(V.histograms(leaves)) == rows(V.histograms(contexts))
    vocab = spark.createDataFrame([("subtoken", "w1|A", 1, 0), ("node", "P1|ROOT|P0", 1, 0)], "kind string, token string, cnt bigint, pos bigint")
    assert rows(V.context_vocab_flags(leaves, vocab, 5)) == rows(V.context_vocab_flags(contexts, vocab, 5))
    # a filter that asks whether the path is empty would build it again
    assert "size(concat(reverse" not in plan(V.histograms(leaves, ("node",)))


def test_sampled_texts_are_the_texts_of_the_sampled(spark):
    cfg = D.DatasetConfig(max_contexts=3, max_data_contexts=5)
    leaves = T.tree_leaves(None, MineConfig(leaf_order="random"), odd_terms(spark)).withColumns(
        {"file": F.lit("f"), "line": F.col("tree_id"), "target": F.array(F.lit("t")),
         "split": F.when(F.col("tree_id") % 2 == 0, "train").otherwise("val")})
    structs = leaves.withColumn("contexts", T.row_contexts()).drop("n_contexts", "leaves")
    cols = ["line", "n_before", "n_after", "text"]
    texts = D.padded_lines(D.sample_contexts(T.with_texts(leaves), cfg), cfg).select(*cols)
    assert sorted(map(str, texts.collect())) == sorted(map(str, D.padded_lines(D.sample_contexts(structs, cfg), cfg).select(*cols).collect()))
    # statistics read the numbers of contexts alone
    stats = D.split_stats(D.sample_contexts(T.with_texts(V.materialize(leaves)), cfg))
    assert "leaves" not in plan(stats)


def test_nodes_are_not_shuffled_by_tree(spark, sf):
    for df in (T.tree_leaves(None, MineConfig(leaf_order="random"), order_tree_terminals(spark, sf)),
               order_tree_nodes(spark, sf).groupBy("tree_id").count()):
        assert "hashpartitioning(tree_id" not in plan(df)


def test_part_given_twice_doubles_its_leaf_alone(spark, tmp_path):
    spark.createDataFrame([(1, "O", "1-URGENT")], "o_orderkey bigint, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, 7, 3, 2.5, "N"), (1, 2, 8, 3, 2.5, "R"), (2, 1, 9, 3, 2.5, None)],
                          "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_returnflag string"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, "bolt"), (7, None), (8, "nut")], "p_partkey bigint, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    leaves = sorted(str((r.tree_id, r.label)) for r in order_tree_terminals(spark, str(tmp_path)).collect())
    assert leaves == sorted(map(str, [(1, "O"), (1, "1-URGENT"), (1, "N"), (1, "bolt"), (1, None), (1, "R"), (1, "nut"), (2, None), (2, None)]))
    assert order_tree_nodes(spark, str(tmp_path)).where("label = 'FLAG'").count() == 3


def test_raw_files_are_compressed_and_each_is_written_once(spark, sf):
    folders = Q._raw_parts(spark, sf)
    files = [f for d in folders for f in glob.glob(f"{d.removeprefix('file:')}/raw_file=*/part-*")]
    assert len(folders) == 2 and files and all(f.endswith(".txt.gz") for f in files)


def test_padding_is_not_split(spark):
    lines = ["a|b x|y,P|Q,z ,P,", "a x,P,y" + " " * 2000, " a  x,P,y  ", "a", "", "   ", "a x\t,P,\u2003 "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    parts = F.filter(F.split("value", " "), lambda x: x != "")
    want = df.select("i", parts.alias("p")).select("i", F.get("p", F.lit(0)).alias("t"),
                                                             F.slice("p", 2, 10).alias("c")).collect()
    got = parse_dataset_lines(df.where("trim(value) <> ''")).select("i", F.array_join("target", "|").alias("t"), F.transform("contexts", format_context).alias("c")).collect()
    assert [(r.i, r.t, r.c) for r in got] == [(r.i, r.t, r.c) for r in want if r.t is not None]
    assert "split(rtrim(" in plan(parse_dataset_lines(df))
    assert str(parse_context(F.col("value"))).count("split(value") == 1
