"""Random trees mined by Spark against a brute-force miner written from the
reference semantics (leaves = degree-one nodes in seeded order, pairs in
combination order, shortest path through the tree, stop after max+1)."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from pathweave.config import MineConfig
from pathweave.functions.tokens import OPERATOR_TOKENS, SUBTOKEN_PATTERN
from pathweave.operators import tree as T

WORDS = ["getValue", "x", "HTTPServer2", "+", "__", "count_total", "==", "ß", "a.b"]


def random_forest(seed=7, n_trees=40):
    rng = random.Random(seed)
    rows = []
    for t in range(n_trees):
        n = rng.randint(1, 30)
        parents = [None] + [rng.randrange(i) for i in range(1, n)]
        for i, p in enumerate(parents):
            rows.append((f"t{t}", f"n{i}", None if p is None else f"n{p}", rng.choice(WORDS), rng.random() < 0.3))
    return rows


def brute_force(rows, max_contexts, max_sub, seed, max_path_len=0):
    trees = {}
    for tree, node, parent, label, res in rows:
        trees.setdefault(tree, {})[node] = (parent, label, res)
    out = {}
    for tree, nodes in trees.items():
        deg = {n: (1 if p is not None else 0) for n, (p, _, _) in nodes.items()}
        for n, (p, _, _) in nodes.items():
            if p is not None:
                deg[p] += 1
        leaves = [n for n in nodes if deg[n] == 1]
        leaves.sort(key=lambda n: (hashlib.md5(f"{seed}:{tree}:{n}".encode()).hexdigest(), n))

        def up(n):
            path = [n]
            while nodes[path[-1]][0] is not None:
                path.append(nodes[path[-1]][0])
            return path

        def tok(n):
            _, label, res = nodes[n]
            if res or label in OPERATOR_TOKENS:
                return [label]
            pieces = re.findall(SUBTOKEN_PATTERN, label)
            return pieces[:max_sub] if max_sub else pieces
        ctx = []
        for a, b in itertools.combinations(leaves, 2):
            ua, ub = up(a), up(b)
            common = set(ua) & set(ub)
            ia = next(i for i, x in enumerate(ua) if x in common)
            ib = next(i for i, x in enumerate(ub) if x in common)
            full = ua[:ia + 1] + list(reversed(ub[:ib]))
            if max_path_len and len(full) > max_path_len:
                continue
            ctx.append(("|".join(tok(a)), "|".join(nodes[x][1] for x in full[1:-1]), "|".join(tok(b))))
            if len(ctx) > max_contexts:
                break
        if ctx:
            out[tree] = ctx
    return out


def spark_nodes(spark, rows):
    edges = spark.createDataFrame(rows, "tree_id string, node_id string, parent_id string, label string, "
                                        "is_reserved boolean")
    return T.root_paths(edges)


@pytest.mark.parametrize("max_contexts,max_sub,max_path_len", [(100, 5, 0), (3, 2, 0), (0, 0, 0), (4, 5, 4)])
def test_random_trees_match_brute_force(spark, max_contexts, max_sub, max_path_len):
    rows = random_forest()
    cfg = MineConfig(max_contexts=max_contexts, max_subtokens=max_sub, max_path_len=max_path_len,
                     leaf_order="random", length_round_start=2)
    ctx = T.mine_contexts(spark_nodes(spark, rows), cfg)
    got = {}
    for r in ctx.orderBy("tree_id", "pair_idx").collect():
        got.setdefault(r["tree_id"], []).append(("|".join(r["start"]), "|".join(r["path"]), "|".join(r["end"])))
    assert got == brute_force(rows, max_contexts, max_sub, cfg.seed, max_path_len)


def test_result_does_not_depend_on_partitioning(spark):
    rows = random_forest(seed=11)
    nodes = spark_nodes(spark, rows)
    cfg = MineConfig(max_contexts=5)
    a = T.mine_contexts(nodes, cfg)
    b = T.mine_contexts(nodes.repartition(7, "node_id"), cfg)
    cols = ["tree_id", "pair_idx", F.array_join("start", "|"), F.array_join("path", "|"), F.array_join("end", "|")]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_reversed_pair_gives_reversed_path(spark):
    rows = random_forest(seed=3, n_trees=10)
    nodes = spark_nodes(spark, rows)
    pairs = T.leaf_pairs(nodes, MineConfig(max_contexts=1000))
    from pathweave.functions.paths import inner_path, lca_depth
    both = pairs.select(inner_path("a_labels", "b_labels", lca_depth("a_ids", "b_ids")).alias("p"),
                        inner_path("b_labels", "a_labels", lca_depth("a_ids", "b_ids")).alias("q"))
    assert both.where(F.reverse("p") != F.col("q")).count() == 0
