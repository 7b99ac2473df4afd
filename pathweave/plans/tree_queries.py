"""Registered tree queries over the order tree (OT) and document tree (DT)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MineConfig
from ..functions.text import format_sample
from ..operators import tree as T
from ..operators.quality import validate_samples
from .document_tree import document_terminals, document_trees
from .order_tree import order_tree_edges, order_tree_nodes, order_tree_terminals, order_trees
from .sql_dt import dt_ctx_sql
from .registry import register
from .sql_ot import OT_NODES_SQL, ot_pairs_sql, ot_ranked_sql, tok_sql

FIXED = MineConfig(leaf_order="fixed")
RANDOM = MineConfig(leaf_order="random")


def flat_contexts(ctx: DataFrame) -> DataFrame:
    return ctx.select("tree_id", "pair_idx",
                      F.array_join("start", "|").alias("start_tok"),
                      F.array_join("path", "|").alias("path"),
                      F.array_join("end", "|").alias("end_tok"))


CTX_COLS = "tree_id, pair_idx, start_tok, path, end_tok"


# ---------------------------------------------------------------------- D1
@register("root_paths", f"""WITH {OT_NODES_SQL}
SELECT tree_id, label, depth, array_to_string(list_concat(list_reverse(up), [label]), '|') AS root_path FROM ot_nodes""")
def q_root_paths(spark, sf):
    nodes = T.root_paths(order_tree_edges(spark, sf))
    return nodes.select("tree_id", "label", "depth", F.array_join("labels", "|").alias("root_path"))


# ---------------------------------------------------------------------- F6
@register("node_degree", f"""WITH {OT_NODES_SQL}
SELECT tree_id, label, depth, degree FROM ot_nodes""")
def q_node_degree(spark, sf):
    return T.node_degree(order_tree_nodes(spark, sf)).select("tree_id", "label", "depth",
                                                            F.col("degree").cast("bigint").alias("degree"))


# ---------------------------------------------------------------------- D2
@register("terminals", f"""WITH {OT_NODES_SQL}
SELECT tree_id, label, depth, array_to_string(list_concat(list_reverse(up), [label]), '|') AS root_path
FROM ot_nodes WHERE degree = 1""")
def q_terminals(spark, sf):
    return T.terminals(order_tree_nodes(spark, sf)).select(
        "tree_id", "label", "depth", F.array_join("labels", "|").alias("root_path"))


# ---------------------------------------------------------------------- E1
@register("terminal_order", f"""WITH {ot_ranked_sql('random')}
SELECT tree_id, rk AS leaf_rank, label FROM ot_ranked""")
def q_terminal_order(spark, sf):
    terms = order_tree_terminals(spark, sf)
    return T.ranked_terminals(terms, RANDOM, None).select(
        "tree_id", F.col("rank").cast("bigint").alias("leaf_rank"), "label")


# ---------------------------------------------------------------------- D3
@register("terminal_pairs", f"""WITH {ot_pairs_sql('fixed', 100)}
SELECT tree_id, pair_idx, a_label, b_label FROM ot_ctx""")
def q_terminal_pairs(spark, sf):
    pairs = T.leaf_pairs(None, MineConfig(leaf_order="fixed"), order_tree_terminals(spark, sf))
    return pairs.select("tree_id", "pair_idx", F.col("a_label"), F.col("b_label"))


# ---------------------------------------------------------------------- E2
@register("lca_paths", f"""WITH {ot_pairs_sql('random', 100)}
SELECT tree_id, pair_idx, path_len, path FROM ot_ctx""")
def q_lca_paths(spark, sf):
    ctx = T.pair_contexts(T.leaf_pairs(None, RANDOM, order_tree_terminals(spark, sf)), RANDOM)
    return ctx.select("tree_id", "pair_idx", F.col("path_len").cast("bigint").alias("path_len"),
                      F.array_join("path", "|").alias("path"))


# ---------------------------------------------------------------------- E4
@register("path_contexts", f"""WITH {ot_pairs_sql('fixed', 100)}
SELECT {CTX_COLS} FROM ot_ctx""")
def q_path_contexts(spark, sf):
    return flat_contexts(T.mine_contexts(None, FIXED, order_tree_terminals(spark, sf)))


# ---------------------------------------------------------------------- E5
@register("context_cap", f"""WITH {ot_ranked_sql('random')}
SELECT tree_id, max(t) AS n_terminals, least(max(t) * (max(t) - 1) // 2, 101) AS n_contexts
FROM ot_ranked GROUP BY tree_id HAVING max(t) >= 2""")
def q_context_cap(spark, sf):
    terms = order_tree_terminals(spark, sf)
    ctx = T.mine_contexts(None, RANDOM, terms).groupBy("tree_id").agg(F.count("*").alias("n_contexts"))
    counts = T.terminal_counts(terms)
    return ctx.join(counts, "tree_id").select("tree_id", "n_terminals", "n_contexts")


# ---------------------------------------------------------------------- B8
@register("depth_limit", f"""WITH {ot_pairs_sql('fixed', 100, leaf_filter="depth <= 2 AND (degree = 1 OR depth = 2)")}
SELECT {CTX_COLS} FROM ot_ctx""")
def q_depth_limit(spark, sf):
    return flat_contexts(T.mine_contexts(order_tree_nodes(spark, sf), FIXED.with_(max_ast_depth=1)))


@register("depth_limit_terminals", f"""WITH {ot_pairs_sql('random', 100, leaf_filter="depth <= 2 AND (degree = 1 OR depth = 2)")}
SELECT {CTX_COLS} FROM ot_ctx""")
def q_depth_limit_terminals(spark, sf):
    return flat_contexts(T.mine_contexts(None, RANDOM.with_(max_ast_depth=1), order_tree_terminals(spark, sf)))


# ---------------------------------------------------------------------- B9
@register("path_length_filter", f"""WITH {ot_pairs_sql('fixed', 100, path_limit=5)}
SELECT {CTX_COLS} FROM ot_ctx""")
def q_path_length_filter(spark, sf):
    return flat_contexts(T.mine_contexts(None, FIXED.with_(max_path_len=5), order_tree_terminals(spark, sf)))


@register("doc_path_length", f"""WITH {dt_ctx_sql(five_nodes=True)}
SELECT {CTX_COLS} FROM dt_ctx""")
def q_doc_path_length(spark, sf):
    return flat_contexts(T.mine_contexts(None, RANDOM.with_(max_path_len=5), document_terminals(spark, sf)))


# ---------------------------------------------------------------------- E6 / J3
SAMPLES_SQL = f"""WITH {ot_pairs_sql('random', 100)},
s AS (
  SELECT tree_id, count(*) AS n_contexts,
         string_agg(start_tok || ',' || path || ',' || end_tok, ' ' ORDER BY pair_idx) AS ctxs
  FROM ot_ctx GROUP BY tree_id
)
SELECT CAST(o.o_custkey AS VARCHAR) AS file, o.o_orderkey AS line, s.n_contexts,
       array_to_string({tok_sql('o.o_orderpriority')}, '|') || ' ' || s.ctxs AS sample
FROM s JOIN orders o ON o.o_orderkey = s.tree_id"""


def ot_samples(spark, sf, cfg: MineConfig = RANDOM):
    ctx = T.tree_contexts(None, cfg, order_tree_terminals(spark, sf))
    samples, rejects = T.assemble_samples(ctx, order_trees(spark, sf, cfg.max_subtokens))
    return samples, rejects


def ot_leaf_samples(spark, sf, cfg: MineConfig = RANDOM):
    """The samples of ``ot_samples`` with leaves and n_contexts in place of the contexts, which are made of them where they are read."""
    rows = T.tree_leaves(None, cfg, order_tree_terminals(spark, sf))
    return T.assemble_samples(rows, order_trees(spark, sf, cfg.max_subtokens))


@register("assemble_samples", SAMPLES_SQL)
def q_assemble_samples(spark, sf):
    samples, _ = ot_leaf_samples(spark, sf)
    return T.with_texts(samples).select("file", "line", F.col("n_contexts").cast("bigint").alias("n_contexts"),
                                        format_sample("target", "contexts", texts=True).alias("sample"))


# ---------------------------------------------------------------------- B10
@register("nonempty_samples", f"""WITH {ot_ranked_sql('random')}
SELECT (SELECT count(*) FROM orders) AS n_trees,
       (SELECT count(DISTINCT tree_id) FROM ot_ranked WHERE t >= 2) AS n_samples""")
def q_nonempty_samples(spark, sf):
    samples, _ = ot_samples(spark, sf)
    marked = order_trees(spark, sf).join(samples.select("tree_id", F.lit(1).alias("has")), "tree_id", "left")
    return marked.agg(F.count("*").alias("n_trees"), F.count("has").alias("n_samples"))


# ---------------------------------------------------------------------- DT: E4 / B15 / B14 / B7
def dt_samples(spark, sf, cfg: MineConfig = RANDOM, transparent: bool = False):
    terms = document_terminals(spark, sf, transparent, cfg)
    samples = T.assemble_samples(T.tree_contexts(None, cfg, terms), document_trees(spark, sf, cfg.max_subtokens))
    return T.mine_contexts(None, cfg, terms), samples


@register("doc_contexts", f"""WITH {dt_ctx_sql()}
SELECT {CTX_COLS} FROM dt_ctx""")
def q_doc_contexts(spark, sf):
    ctx, _ = dt_samples(spark, sf)
    return flat_contexts(ctx)


@register("rejects", f"""WITH {dt_ctx_sql()}
SELECT file, line, CASE WHEN len(target) = 0 THEN 'target has no subtoken' ELSE 'token has no subtoken' END AS reason
FROM dt_status WHERE any_bad OR len(target) = 0""")
def q_rejects(spark, sf):
    _, (_, rejects) = dt_samples(spark, sf)
    return rejects.select("file", "line", "reason")


@register("validate_samples", f"""WITH {dt_ctx_sql()},
good AS (SELECT s.*, c.s_arr, c.p_arr, c.e_arr FROM dt_status s JOIN dt_ctx c ON c.tree_id = s.tree_id
         WHERE NOT s.any_bad AND len(s.target) > 0),
el AS (
  SELECT file, line, 'target' AS part, unnest(target) AS value FROM (SELECT DISTINCT file, line, target FROM good)
  UNION ALL SELECT file, line, 'token', unnest(s_arr) FROM good
  UNION ALL SELECT file, line, 'token', unnest(e_arr) FROM good
  UNION ALL SELECT file, line, 'path', unnest(p_arr) FROM good
),
r AS (SELECT *, CASE WHEN length(value) = 0 THEN 'empty'
                     WHEN contains(value, ' ') OR contains(value, '|') OR contains(value, ',') THEN 'delimiter' END AS rule
      FROM el)
SELECT part, rule, count(*) AS n_violations, count(DISTINCT (file, line)) AS n_samples
FROM r WHERE rule IS NOT NULL GROUP BY part, rule""")
def q_validate_samples(spark, sf):
    _, (samples, _) = dt_samples(spark, sf)
    return validate_samples(samples)


@register("collapse_transparent", f"""WITH {dt_ctx_sql(transparent=True)}
SELECT {CTX_COLS} FROM dt_ctx""")
def q_collapse_transparent(spark, sf):
    ctx, _ = dt_samples(spark, sf, transparent=True)
    return flat_contexts(ctx)


# ---------------------------------------------------------------------- J3 on DT
@register("format_sample", f"""WITH {dt_ctx_sql()},
g AS (SELECT tree_id, string_agg(start_tok || ',' || path || ',' || end_tok, ' ' ORDER BY pair_idx) AS ctxs
      FROM dt_ctx GROUP BY tree_id)
SELECT s.file, s.line, array_to_string(s.target, '|') || ' ' || g.ctxs AS sample
FROM dt_status s JOIN g ON g.tree_id = s.tree_id WHERE NOT s.any_bad AND len(s.target) > 0""")
def q_format_sample(spark, sf):
    _, (samples, _) = dt_samples(spark, sf)
    return samples.select("file", "line", format_sample("target", "contexts").alias("sample"))
