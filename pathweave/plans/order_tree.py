"""Order tree (OT): the driver's orders and line items as syntax-like trees.

``tree_id = o_orderkey``; root ``ORDER``; children ``STATUS -> o_orderstatus``
and ``PRIORITY -> o_orderpriority``; per line item ``LINEITEM`` with
``FLAG -> l_returnflag`` and ``PART -> p_name``.  Value leaves are not
reserved.  Target = subtokens of the priority; mark = (customer, order).

The tree has a fixed depth, so root paths are built by projection (no join to
orders).  Orders and line items are dealt by order while they are rows of a few
numbers; the nodes made of them are wide and stay where they are, so ranking and
grouping by tree shuffles no node.  The only join is line item -> part for the part name; Spark
broadcasts ``part`` only when its scan statistics are under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.tokens import tokenize
from ..session import table

LINE_KEY = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

NODE_SCHEMA = ("tree_id bigint, node_id string, parent_id string, label string, is_reserved boolean, "
               "depth int, ids array<string>, labels array<string>")


NODE_COLUMNS = ["node_id", "parent_id", "label", "is_reserved", "depth", "ids", "labels", "sort_key"]


def _node(node_id, parent_id, label, reserved, ids, labels, sort_key) -> list:
    """One node as a plain projection list (code-generated; no wide ``inline``)."""
    return [(F.lit(node_id) if isinstance(node_id, str) else node_id).alias("node_id"),
            (parent_id if parent_id is not None else F.lit(None).cast("string")).alias("parent_id"),
            label.cast("string").alias("label"), F.lit(reserved).alias("is_reserved"),
            F.lit(len(ids) - 1).alias("depth"), F.array(*ids).alias("ids"),
            F.array(*labels).alias("labels"), sort_key.alias("sort_key")]


def _project(df: DataFrame, tree_col: str, nodes: list, wanted: list | None = None) -> DataFrame:
    """A row per node of ``nodes`` for every row, where its condition in ``wanted`` holds; columns nobody reads are not built."""
    rows = df.withColumn("_node", F.explode(F.array(*[F.lit(i) for i in range(len(nodes))])))
    for i, cond in enumerate(wanted or []):
        rows = rows if cond is None else rows.where((F.col("_node") != i) | cond)

    def pick(columns):
        out = columns[-1]
        for i in reversed(range(len(columns) - 1)):
            out = F.when(F.col("_node") == i, columns[i]).otherwise(out)
        return out
    return rows.select(F.col(tree_col).alias("tree_id"), *[pick(c).alias(n) for n, c in zip(NODE_COLUMNS, zip(*nodes))])


def _by_tree(df: DataFrame, tree_col: str) -> DataFrame:
    """The rows dealt by tree while they are narrow: what is made of them then needs no shuffle by tree."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), tree_col)


def _sort_key(grp: int, cols: dict | None = None):
    cols = cols or {}
    fields = [F.lit(grp).alias("grp")]
    for c, t in [("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_extendedprice", "double")]:
        fields.append((cols[c] if c in cols else F.lit(None)).cast(t).alias(c))
    return F.struct(*fields)


def order_tree_nodes(spark: SparkSession, sf_dir: str, leaves_only: bool = False) -> DataFrame:
    """All nodes of every order tree; with ``leaves_only`` just its terminals
    (the value leaves: every order tree has a STATUS and a PRIORITY branch, so
    the root is never a leaf and the terminals are known without a degree join)."""
    orders = _by_tree(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    L = F.lit
    inner_o = [
        _node("o", None, L("ORDER"), True, [L("o")], [L("ORDER")], _sort_key(-1)),
        _node("s", L("o"), L("STATUS"), True, [L("o"), L("s")], [L("ORDER"), L("STATUS")], _sort_key(-1)),
        _node("p", L("o"), L("PRIORITY"), True, [L("o"), L("p")], [L("ORDER"), L("PRIORITY")], _sort_key(-1)),
    ]
    leaves_o = [
        _node("sv", L("s"), F.col("o_orderstatus"), False, [L("o"), L("s"), L("sv")],
              [L("ORDER"), L("STATUS"), F.col("o_orderstatus")], _sort_key(0)),
        _node("pv", L("p"), F.col("o_orderpriority"), False, [L("o"), L("p"), L("pv")],
              [L("ORDER"), L("PRIORITY"), F.col("o_orderpriority")], _sort_key(1)),
    ]
    on = _project(orders, "o_orderkey", leaves_o if leaves_only else inner_o + leaves_o)

    # Line items are told apart inside an order by content (unique in the driver data),
    # so ids -- and the md5 leaf order built on them -- are reproducible by any engine.
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_KEY, "l_returnflag")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", F.row_number().over(
        Window.partitionBy("p_partkey").orderBy("p_name")).alias("copy"))
    # only the PART value leaf reads the part: of a line that meets several copies, the others come of the first
    li_part = _by_tree(li.join(part, "l_partkey", "left"), "l_orderkey")
    once = F.coalesce(F.col("copy"), L(1)) == 1
    key = {c: F.col(c) for c in LINE_KEY}
    lid = F.col("lid")
    li_part = li_part.withColumn("lid", F.concat(L("l"), F.concat_ws(":", "l_linenumber", "l_partkey", "l_suppkey",
                                                                     F.round(F.col("l_extendedprice") * 100).cast("bigint"))))
    ids_l = [L("o"), lid]
    inner_l = [
        _node(lid, L("o"), L("LINEITEM"), True, ids_l, [L("ORDER"), L("LINEITEM")], _sort_key(-1, key)),
        _node(F.concat(lid, L("f")), lid, L("FLAG"), True, ids_l + [F.concat(lid, L("f"))],
              [L("ORDER"), L("LINEITEM"), L("FLAG")], _sort_key(-1, key)),
        _node(F.concat(lid, L("p")), lid, L("PART"), True, ids_l + [F.concat(lid, L("p"))],
              [L("ORDER"), L("LINEITEM"), L("PART")], _sort_key(-1, key)),
    ]
    flag_leaf = [
        _node(F.concat(lid, L("fv")), F.concat(lid, L("f")), F.col("l_returnflag"), False,
              ids_l + [F.concat(lid, L("f")), F.concat(lid, L("fv"))],
              [L("ORDER"), L("LINEITEM"), L("FLAG"), F.col("l_returnflag")], _sort_key(2, key)),
    ]
    part_leaf = [
        _node(F.concat(lid, L("pv")), F.concat(lid, L("p")), F.col("p_name"), False,
              ids_l + [F.concat(lid, L("p")), F.concat(lid, L("pv"))],
              [L("ORDER"), L("LINEITEM"), L("PART"), F.col("p_name")], _sort_key(3, key)),
    ]
    of_line = flag_leaf if leaves_only else inner_l + flag_leaf
    return on.unionByName(_project(li_part, "l_orderkey", of_line + part_leaf, [once] * len(of_line)))


def order_tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree as a plain parent/child table (input of the generic ``root_paths``)."""
    return order_tree_nodes(spark, sf_dir).select("tree_id", "node_id", "parent_id", "label", "is_reserved")


def order_trees(spark: SparkSession, sf_dir: str, max_subtokens: int = 5) -> DataFrame:
    """tree_id, target, file, line for each order."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("tree_id"),
                    tokenize(F.col("o_orderpriority"), max_subtokens).alias("target"),
                    F.col("o_custkey").cast("string").alias("file"),
                    F.col("o_orderkey").alias("line"))


def order_tree_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_tree_nodes(spark, sf_dir, leaves_only=True)
