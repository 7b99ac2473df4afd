"""DuckDB oracle fragments for the order tree.

Written independently of the Spark plan: leaves carry their path *up* to the
root, and the path between two leaves is decided by whether they share a line
item (LCA = LINEITEM) or not (LCA = ORDER).
"""

from __future__ import annotations

from ..functions.tokens import OPERATOR_TOKENS, SUBTOKEN_PATTERN

OPS_SQL = ", ".join("'" + o + "'" for o in OPERATOR_TOKENS)


def tok_sql(label: str, reserved: str = "FALSE", max_sub: int = 5) -> str:
    cut = f"[1:{max_sub}]" if max_sub else ""
    return (f"(CASE WHEN {reserved} THEN [{label}] WHEN {label} IN ({OPS_SQL}) THEN [{label}] "
            f"ELSE regexp_extract_all({label}, '{SUBTOKEN_PATTERN}'){cut} END)")


LI_SQL = """
li AS MATERIALIZED (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_returnflag, p.p_name,
         'l' || concat_ws(':', l.l_linenumber, l.l_partkey, l.l_suppkey,
                          CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS lid
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

# every node: tree_id, node_id, label, depth, up (labels from the parent to the root), lid, grp/sort keys, degree
OT_NODES_SQL = LI_SQL + """,
ot_nl AS (SELECT l_orderkey AS tree_id, count(*) AS n_lines FROM li GROUP BY l_orderkey),
ot_nodes AS MATERIALIZED (
  SELECT o_orderkey AS tree_id, 'o' AS node_id, 'ORDER' AS label, TRUE AS res, 0 AS depth,
         []::VARCHAR[] AS up, NULL::VARCHAR AS lid, -1 AS grp, NULL::INT AS ln, NULL::BIGINT AS pk,
         NULL::BIGINT AS sk, NULL::DOUBLE AS ep, 2 + coalesce(n.n_lines, 0) AS degree
    FROM orders LEFT JOIN ot_nl n ON n.tree_id = o_orderkey
  UNION ALL SELECT o_orderkey, 's', 'STATUS', TRUE, 1, ['ORDER'], NULL, -1, NULL, NULL, NULL, NULL, 2 FROM orders
  UNION ALL SELECT o_orderkey, 'sv', o_orderstatus, FALSE, 2, ['STATUS', 'ORDER'], NULL, 0, NULL, NULL, NULL, NULL, 1 FROM orders
  UNION ALL SELECT o_orderkey, 'p', 'PRIORITY', TRUE, 1, ['ORDER'], NULL, -1, NULL, NULL, NULL, NULL, 2 FROM orders
  UNION ALL SELECT o_orderkey, 'pv', o_orderpriority, FALSE, 2, ['PRIORITY', 'ORDER'], NULL, 1, NULL, NULL, NULL, NULL, 1 FROM orders
  UNION ALL SELECT l_orderkey, lid, 'LINEITEM', TRUE, 1, ['ORDER'], lid, -1, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 3 FROM li
  UNION ALL SELECT l_orderkey, lid || 'f', 'FLAG', TRUE, 2, ['LINEITEM', 'ORDER'], lid, -1, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 2 FROM li
  UNION ALL SELECT l_orderkey, lid || 'fv', l_returnflag, FALSE, 3, ['FLAG', 'LINEITEM', 'ORDER'], lid, 2, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 1 FROM li
  UNION ALL SELECT l_orderkey, lid || 'p', 'PART', TRUE, 2, ['LINEITEM', 'ORDER'], lid, -1, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 2 FROM li
  UNION ALL SELECT l_orderkey, lid || 'pv', p_name, FALSE, 3, ['PART', 'LINEITEM', 'ORDER'], lid, 3, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 1 FROM li
)"""


def order_by(leaf_order: str, seed: int = 42) -> str:
    if leaf_order == "random":
        return f"md5('{seed}:' || tree_id || ':' || node_id), node_id"
    return "grp, ln, pk, sk, ep, node_id"


def ot_ranked_sql(leaf_order: str, seed: int = 42, leaf_filter: str = "degree = 1") -> str:
    return OT_NODES_SQL + f""",
ot_leaves AS (SELECT * FROM ot_nodes WHERE {leaf_filter}),
ot_ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY {order_by(leaf_order, seed)}) - 1 AS rk,
         count(*) OVER (PARTITION BY tree_id) AS t
  FROM ot_leaves
)"""


def ot_pairs_sql(leaf_order: str, max_contexts: int, seed: int = 42, max_sub: int = 5,
                 path_limit: int = 0, leaf_filter: str = "degree = 1") -> str:
    """CTE chain ending in ``ot_ctx(tree_id, pair_idx, a_label, b_label, start_tok, path, end_tok, path_len)``."""
    idx = "a.rk * a.t - (a.rk * (a.rk + 1)) // 2 + (b.rk - a.rk - 1)"
    path = ("CASE WHEN a.lid IS NOT NULL AND a.lid = b.lid AND a.depth = 3 AND b.depth = 3 "
            "THEN [a.up[1], 'LINEITEM', b.up[1]] "
            "WHEN a.lid IS NOT NULL AND a.lid = b.lid THEN list_concat(a.up[1:len(a.up) - 1], list_reverse(b.up[1:len(b.up) - 2])) "
            "ELSE list_concat(a.up, list_reverse(b.up[1:len(b.up) - 1])) END")
    if path_limit:
        pick = f"""ot_all AS (
  SELECT a.tree_id, a.rk AS ra, b.rk AS rb, a.label AS a_label, b.label AS b_label, a.res AS a_res, b.res AS b_res,
         {path} AS p
  FROM ot_ranked a JOIN ot_ranked b ON a.tree_id = b.tree_id AND a.rk < b.rk
),
ot_pick AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY ra, rb) - 1 AS pair_idx
    FROM ot_all WHERE len(p) + 2 <= {path_limit}) WHERE pair_idx <= {max_contexts}
)"""
    else:
        pick = f"""ot_pick AS (
  SELECT a.tree_id, {idx} AS pair_idx, a.label AS a_label, b.label AS b_label, a.res AS a_res, b.res AS b_res,
         {path} AS p
  FROM ot_ranked a JOIN ot_ranked b ON a.tree_id = b.tree_id AND a.rk < b.rk
  WHERE a.rk <= {max_contexts} AND b.rk <= {max_contexts} + 1 AND {idx} <= {max_contexts}
)"""
    return ot_ranked_sql(leaf_order, seed, leaf_filter) + ",\n" + pick + f""",
ot_ctx AS (
  SELECT tree_id, pair_idx, a_label, b_label,
         array_to_string({tok_sql('a_label', 'a_res', max_sub)}, '|') AS start_tok,
         array_to_string(p, '|') AS path,
         array_to_string({tok_sql('b_label', 'b_res', max_sub)}, '|') AS end_tok,
         len(p) + 2 AS path_len,
         len({tok_sql('a_label', 'a_res', max_sub)}) = 0 OR len({tok_sql('b_label', 'b_res', max_sub)}) = 0 AS bad
  FROM ot_pick
)"""
