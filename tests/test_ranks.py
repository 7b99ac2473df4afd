import hashlib

from pyspark.sql import functions as F

from pathweave.config import MineConfig
from pathweave.operators import dataset as D
from pathweave.operators import tree as T
from pathweave.operators.vocab import global_rank


def test_global_rank_equals_sorted_position(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("cnt"),
                                  F.concat(F.lit("t"), F.col("id").cast("string")).alias("token"))
    ranked = global_rank(df, [F.col("cnt").desc(), F.col("token")], "r").collect()
    want = sorted(((r["cnt"], r["token"]) for r in ranked), key=lambda x: (-x[0], x[1]))
    got = sorted(ranked, key=lambda r: r["r"])
    assert [(r["cnt"], r["token"]) for r in got] == want
    assert [r["r"] for r in got] == list(range(5000))


def test_hash_rank_equals_md5_order(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("file"), (F.col("id") % 3).alias("line"))
    ranked = D.hash_rank(df, ["file", "line"], 42).collect()
    want = sorted(ranked, key=lambda r: (hashlib.md5(f"42:{r['file']}:{r['line']}".encode()).hexdigest(),
                                         r["file"], r["line"]))
    assert [r["sample_id"] for r in want] == list(range(3000))


def test_bucketed_tree_rank_equals_window_rank(spark):
    rows = [("big", f"n{i}", "r", "w", False, ["r", f"n{i}"], ["R", "w"]) for i in range(4000)]
    rows += [("small", f"m{i}", "r", "w", False, ["r", f"m{i}"], ["R", "w"]) for i in range(3)]
    terms = spark.createDataFrame(rows, "tree_id string, node_id string, parent_id string, label string, "
                                        "is_reserved boolean, ids array<string>, labels array<string>")
    cfg = MineConfig()
    got = {(r["tree_id"], r["node_id"]): r["rank"] for r in T.ranked_terminals(terms, cfg, None).collect()}
    want = {}
    for tree in ("big", "small"):
        nodes = sorted((r[1] for r in rows if r[0] == tree),
                       key=lambda n: (hashlib.md5(f"42:{tree}:{n}".encode()).hexdigest(), n))
        want.update({(tree, n): i for i, n in enumerate(nodes)})
    assert got == want
