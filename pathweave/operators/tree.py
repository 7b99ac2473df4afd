"""Tree operators: root paths, terminals, leaf order, leaf pairs, contexts, samples.

Node table contract (one row per node of an expanded tree)::

    tree_id, node_id string, parent_id string|null, label string,
    is_reserved boolean, depth int, ids array<string>, labels array<string>,
    sort_key <any orderable, optional>

``ids``/``labels`` run from the root to the node itself.

Scale notes
-----------
* Terminal detection is a partial-aggregated child count joined on the unique
  ``(tree_id, node_id)`` key.
* Leaf ranks are only needed up to ``max_contexts + 1``: ``row_number() <= k``
  is planned as a map-side partial ``WindowGroupLimit``, so a tree holding a
  third of all leaves sends at most ``k`` rows per map task to the final window.
* Leaf pairs are generated in-row (no theta join): a leaf holds the start leaves
  of its tree, of which there are few where a tree has many leaves, and the output
  of the pair step is exactly the contexts that are kept.  One sort per tree serves
  the rank, the count and the starts; no leaf is grouped into an aggregate.  Samples get
  their contexts in the row of the tree's first leaf, so contexts are never grouped or sorted.
* With a path-length limit, a tree of at most ``ROW_LEAVES`` leaves tries its first ``ROW_STARTS`` leaves as starts in
  its row, until it has pairs enough; leaves of trees that are larger or still short of pairs meet in an index of their
  ancestors within the limit; only leaves that have a partner start pairs, in rounds of doubling numbers of starts with
  bounded top-k on both sides (exact, no tree beyond the row size is ranked whole).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MineConfig
from ..functions.paths import inner_path, lca_depth, path_len
from ..functions.text import format_context
from ..functions.tokens import BAR, token_or_subtokens
from ..session import cut_lineage

LEAF_FIELDS = ["node_id", "label", "is_reserved", "ids", "labels"]
PAIR_FIELDS = LEAF_FIELDS + ["tok"]
CTX_TYPE = "struct<start:array<string>,path:array<string>,end:array<string>>"


# ---------------------------------------------------------------- D1 root paths
def root_paths(edges: DataFrame, max_levels: int | None = None) -> DataFrame:
    """Root-to-node ``ids``/``labels`` for any tree, by pointer doubling.

    ``edges``: tree_id, node_id, parent_id (null at the root), label, is_reserved
    and any extra columns (carried along).  Every node holds a pointer to an
    ancestor and the path from there down to itself, at first its parent and
    itself.  A round puts the ancestor's path before it and takes over the
    ancestor's pointer, so it doubles what a node knows and a tree of depth d is
    done after log2(d) + 1 rounds.  Nodes that have reached their root only serve as
    ancestors.  Nodes under a missing parent or in a cycle have no root path
    and are left out.

    A tree of at most ``ROW_NODES`` nodes, whose ids are not repeated, doubles in one row: only its edges are shuffled, and
    not even these where ``edges`` comes dealt by tree.  Of all other trees rounds are written to the checkpoint folder, and a
    node's own id, label and parent are read off its path again.  ``edges`` is read several times, so store it where it is dear.
    """
    # by hash: an id taken for a repeated one only moves its tree to the rounds
    counts = (edges.groupBy("tree_id", F.xxhash64("node_id").alias("_h")).agg(F.count("*").alias("_n"))
              .groupBy("tree_id").agg(F.sum("_n").alias("_all"), F.max("_n").alias("_most")))
    others = cut_lineage(counts.where(
        F.col("tree_id").isNull() | (F.col("_all") > ROW_NODES) | (F.col("_most") > 1)).select(F.col("tree_id").alias("_other")))
    same = F.col("tree_id").eqNullSafe(F.col("_other"))
    if others.isEmpty():
        out = _row_root_paths(edges)
    else:
        out = _row_root_paths(edges.join(others, same, "left_anti")).unionByName(
            _doubled_root_paths(edges.join(others, same, "left_semi")))
    return out if max_levels is None else out.where(F.col("depth") <= max_levels)


ROW_NODES = 256  # a tree of at most so many nodes finds its root paths in one row; a round there looks up each of its nodes


def _row_root_paths(edges: DataFrame) -> DataFrame:
    """``root_paths`` of trees that are held in a row each: nodes look up their ancestor's path in the row."""
    nodes = edges.groupBy("tree_id").agg(F.collect_list(F.struct(*[c for c in edges.columns if c != "tree_id"])).alias("nodes"))
    first = F.transform("nodes", lambda x: F.struct(x["parent_id"].alias("up"), F.array(x["node_id"]).alias("ids"),
                                                    F.array(x["label"]).alias("labels")))

    def doubled(state):
        def move(x):
            def below(above):
                known = above.isNotNull() & (above["up"].isNull() | ~F.array_contains(x["ids"], above["up"]))
                # without such an ancestor the node keeps its pointer, as it will in every round
                return F.when(known, F.struct(above["up"].alias("up"), F.concat(above["ids"], x["ids"]).alias("ids"),
                                              F.concat(above["labels"], x["labels"]).alias("labels"))).otherwise(x)
            place = F.array_position("names", x["up"])
            above = F.when(place > 0, F.get(state, (place - 1).cast("int")))
            return F.when(x["up"].isNull(), x).otherwise(F.get(F.transform(F.array(above), below), F.lit(0)))
        return F.when(F.exists(state, lambda x: x["up"].isNotNull()), F.transform(state, move)).otherwise(state)

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size("nodes"))).cast("int"))
    done = (nodes.withColumn("names", F.transform("nodes", lambda x: x["node_id"]))
            .select("tree_id", "nodes", F.aggregate(rounds, first, lambda state, _: doubled(state)).alias("state")))
    rows = done.select("tree_id", F.inline(F.arrays_zip("nodes", "state"))).where(F.col("state.up").isNull())
    return rows.select(*[F.col(c) if c == "tree_id" else F.col(f"nodes.{c}") for c in edges.columns], "state.ids", "state.labels",
                       (F.size("state.ids") - 1).alias("depth"))


def _doubled_root_paths(edges: DataFrame) -> DataFrame:
    """``root_paths`` in rounds of joins, for trees of any size."""
    extra = [c for c in edges.columns if c not in ("tree_id", "node_id", "parent_id", "label")]
    state = edges.select("tree_id", F.col("parent_id").alias("up"), F.array("node_id").alias("ids"),
                         F.array("label").alias("labels"), *extra)
    done = [state.where(F.col("up").isNull())]
    open_ = state.where(F.col("up").isNotNull())
    while not open_.isEmpty():
        above = state.select("tree_id", F.element_at("ids", -1).alias("up"), F.col("up").alias("up2"),
                             F.slice("ids", F.lit(1), F.size("ids") - 1).alias("ids2"), F.col("labels").alias("labels2"))
        moved = (open_.join(above, ["tree_id", "up"])
                 .select("tree_id", F.col("up2").alias("up"), F.concat("ids2", F.array("up"), "ids").alias("ids"),
                         F.concat("labels2", "labels").alias("labels"), *extra)
                 .where(F.col("up").isNull() | ~F.array_contains("ids", F.col("up"))))
        moved = cut_lineage(moved)
        done.append(moved.where(F.col("up").isNull()))
        open_ = moved.where(F.col("up").isNotNull())
        state = reduce(DataFrame.unionByName, done + [open_])
    n = F.size("ids")
    own = {"node_id": F.element_at("ids", -1), "parent_id": F.when(n > 1, F.get("ids", n - 2)),
           "label": F.element_at("labels", -1)}
    return reduce(DataFrame.unionByName, done).select(
        *[own[c].alias(c) if c in own else F.col(c) for c in edges.columns], "ids", "labels", (n - 1).alias("depth"))


# ------------------------------------------------------------ F6 / D2 terminals
def node_degree(nodes: DataFrame) -> DataFrame:
    """Undirected degree of each node: children plus one for the parent edge.

    The counts of children stand beside the nodes they belong to and are read by a window, which nodes
    that come dealt by tree pass without a shuffle, as they would not pass a join.
    """
    kids = (nodes.where(F.col("parent_id").isNotNull() & F.col("tree_id").isNotNull())
            .groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(F.count("*").alias("n_children")))
    both = (nodes.withColumns({"n_children": F.lit(None).cast("bigint"), "_node": F.lit(True)})
            .unionByName(kids.withColumn("_node", F.lit(False)), allowMissingColumns=True))
    n = F.coalesce(F.max("n_children").over(Window.partitionBy("tree_id", "node_id")), F.lit(0))
    rest = [c for c in nodes.columns if c not in ("tree_id", "node_id")]
    return both.withColumn("n_children", n).where("_node").select("tree_id", "node_id", *rest, (
        F.col("n_children") + F.when(F.col("parent_id").isNotNull(), 1).otherwise(0)).cast("int").alias("degree"))


def terminals(nodes: DataFrame) -> DataFrame:
    """Nodes of degree one (a root with a single child counts; a lone root does not)."""
    return node_degree(nodes).where(F.col("degree") == 1).drop("degree")


def depth_limit(nodes: DataFrame, max_depth: int) -> DataFrame:
    """Keep cursors up to ``max_depth + 1`` (a node at ``max_depth`` is still expanded)."""
    if not max_depth:
        return nodes
    return nodes.where(F.col("depth") <= max_depth + 1)


def depth_limit_terminals(terms: DataFrame, max_depth: int) -> DataFrame:
    """The leaves that the limit leaves of a tree known by its leaves alone.

    A leaf below the cut gives way to its ancestor at ``max_depth + 1``, which
    lost its children; leaves with the same one are merged (partial aggregate).
    That ancestor is a structure node, so it is reserved, and stands where the
    first of its leaves stood.  A root that is a leaf keeps its one child.
    """
    if not max_depth:
        return terms
    n = max_depth + 2
    deep = F.size("ids") > n
    fields = ["tree_id", *LEAF_FIELDS, *(["sort_key"] if "sort_key" in terms.columns else [])]
    cut = (terms.where(deep).select("tree_id", F.slice("ids", 1, n).alias("ids"), F.slice("labels", 1, n).alias("labels"),
                                    *[F.col(f) for f in fields if f == "sort_key"])
           .withColumns({"node_id": F.element_at("ids", -1), "label": F.element_at("labels", -1)}))
    keep = [F.any_value(f).alias(f) for f in ("label", "ids", "labels")] + [F.min(f).alias(f) for f in fields if f == "sort_key"]
    merged = cut.groupBy("tree_id", "node_id").agg(*keep).withColumn("is_reserved", F.lit(True))
    return terms.where(~deep).select(*fields).unionByName(merged.select(*fields))


# ------------------------------------------------------------------ E1 ordering
def leaf_hash(cfg: MineConfig, node_id="node_id") -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(cfg.seed)), F.col("tree_id").cast("string"), F.col(node_id) if isinstance(node_id, str) else node_id))


def leaf_order_key(df: DataFrame, cfg: MineConfig) -> list:
    if cfg.leaf_order == "random":
        return [F.unhex(leaf_hash(cfg)), F.col("node_id")]      # 16 bytes, in the order of the hex digits
    return [F.col("sort_key"), F.col("node_id")]


RANK_BUCKET_HEX = 4  # a whole-tree rank spreads each tree over up to 16^4 md5 buckets


def ranked_terminals(terms: DataFrame, cfg: MineConfig, top: int | None) -> DataFrame:
    """0-based ``rank`` of each leaf in its tree; with ``top`` only ranks < top.

    ``row_number() <= top`` becomes a partial + final ``WindowGroupLimit``.
    A whole-tree rank in md5 order is a bucketed dense rank instead of one
    window per tree: buckets are md5 prefixes inside a tree, their sizes come
    from a partial count, and a leaf's rank is its bucket's offset plus its
    place inside the bucket (each window holds one bucket, not one tree).
    """
    if top is None and cfg.leaf_order == "random":
        return _bucketed_rank(terms, cfg)
    key = [F.col("okey"), F.col("node_id")] if "okey" in terms.columns else leaf_order_key(terms, cfg)
    w = Window.partitionBy("tree_id").orderBy(*key)
    ranked = terms.withColumn("rn", F.row_number().over(w))
    if top is not None:
        ranked = ranked.where(F.col("rn") <= top)
    return ranked.withColumn("rank", F.col("rn") - 1).drop("rn")


def _bucketed_rank(terms: DataFrame, cfg: MineConfig) -> DataFrame:
    h, node = leaf_hash(cfg), F.col("node_id")
    keyed = terms.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, RANK_BUCKET_HEX))
    sizes = keyed.groupBy("tree_id", "_b").agg(F.count("*").alias("_n"))
    offs = sizes.select("tree_id", "_b", (F.sum("_n").over(
        Window.partitionBy("tree_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .alias("_off"))
    w = Window.partitionBy("tree_id", "_b").orderBy("_h", node)
    return (keyed.join(offs, ["tree_id", "_b"])
            .withColumn("rank", (F.col("_off") + F.row_number().over(w) - 1).cast("int"))
            .drop("_h", "_b", "_off"))


def terminal_counts(terms: DataFrame) -> DataFrame:
    return terms.groupBy("tree_id").agg(F.count("*").alias("n_terminals"))


# ------------------------------------------------------------- D3 / E5 pairs
def _pairs_in_row(t, m: int):
    """Array of (i, j, idx) of the first ``m + 1`` pairs in combination order.

    For 0-based ranks ``i < j`` of ``t`` leaves the pair index is
    ``i*t - i*(i+1)/2 + (j-i-1)``; a start leaf ``i`` is used only while its
    first index is within the cap.
    """
    def off(i):
        return i * t - (i * (i + 1)) / 2

    starts = F.filter(F.sequence(F.lit(0).cast("bigint"), F.least(t - 2, F.lit(m).cast("bigint"))),
                      lambda i: off(i) <= m)
    return F.when(t < 2, F.array().cast("array<struct<i:bigint,j:bigint,idx:bigint>>")).otherwise(
        F.flatten(F.transform(starts, lambda i: F.transform(
            F.sequence(i + 1, F.least(t - 1, i + 1 + (F.lit(m) - off(i)).cast("bigint"))),
            lambda j: F.struct(i.alias("i"), j.alias("j"),
                               (off(i) + j - i - 1).cast("bigint").alias("idx"))))))


def leaf_pairs(nodes: DataFrame | None, cfg: MineConfig, terms: DataFrame | None = None) -> DataFrame:
    """Kept leaf pairs: tree_id, pair_idx, a_* and b_* leaf fields.

    Without a length limit the first ``max_contexts + 1`` pairs in combination
    order are kept (the reference stops once it holds more than the maximum).
    Adapters that know their terminals by rule pass ``terms`` instead of nodes.
    """
    m = cfg.max_contexts
    if cfg.max_path_len:
        limited = _limited_terminals(nodes, cfg, terms)
        small, rest = _small_trees(limited, cfg)
        pairs = _limited_row_pairs(small, cfg)
        return pairs if rest.isEmpty() else pairs.unionByName(
            _length_limited_pairs(limited.join(rest, "tree_id", "left_semi"), cfg))
    top = _top_terminals(nodes, cfg, terms)
    # the first m + 1 pairs need the first m + 2 leaves only, so their number stands for the number of leaves
    t = F.col("t")
    counted = _widened(top.withColumn("t", F.count("*").over(_tree())).where(t > 1), cfg)
    leaf = F.struct(*PAIR_FIELDS)
    is_start = _first_index(F.col("rank").cast("bigint"), t) <= m
    # sorted once for all three windows; a leaf meets the few starts of its tree, not all its leaves
    met = counted.withColumn("starts", F.collect_list(F.when(is_start & (F.col("rank") < t - 1), leaf)).over(_tree()))
    met = met.where(F.col("rank") > 0).withColumn("i", F.explode(F.sequence(
        F.lit(0), F.least(F.col("rank"), F.size("starts")) - 1)))
    idx = (_first_index(F.col("i").cast("bigint"), t) + F.col("rank") - F.col("i") - 1).cast("bigint")
    pairs = met.withColumn("pair_idx", idx).where(F.col("pair_idx") <= m).withColumn("a", F.get("starts", F.col("i")))
    return pairs.select("tree_id", "pair_idx", *[F.col("a")[f].alias(f"a_{f}") for f in PAIR_FIELDS],
                        *[F.col(f).alias(f"b_{f}") for f in PAIR_FIELDS])


def _limited_terminals(nodes: DataFrame | None, cfg: MineConfig, terms: DataFrame | None) -> DataFrame:
    if terms is None:
        terms = terminals(depth_limit(nodes, cfg.max_ast_depth))
    else:
        terms = depth_limit_terminals(terms, cfg.max_ast_depth)
    return terms.select("tree_id", *LEAF_FIELDS, *(["sort_key"] if cfg.leaf_order == "fixed" else []))


def _top_terminals(nodes: DataFrame | None, cfg: MineConfig, terms: DataFrame | None) -> DataFrame:
    """The first ``max_contexts + 2`` leaves of each tree with their rank, sorted for windows over ``_tree()``."""
    return ranked_terminals(_narrow(_limited_terminals(nodes, cfg, terms), cfg), cfg, cfg.max_contexts + 2)


def _tree():
    return Window.partitionBy("tree_id").orderBy("okey", "node_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _first_index(i: Column, t: Column) -> Column:
    """Index of the first pair that leaf ``i`` of ``t`` starts, in combination order: i*t - i*(i+1)/2."""
    return i * t - F.shiftright(i * (i + 1), 1)


def _narrow(terms: DataFrame, cfg: MineConfig) -> DataFrame:
    """What is sorted and shuffled of a leaf: the ends of its root path stand in ``node_id`` and ``labels`` alone."""
    return terms.select("tree_id", "node_id", "is_reserved", F.slice("ids", F.lit(1), F.size("ids") - 1).alias("above"),
                        "labels", leaf_order_key(terms, cfg)[0].alias("okey"))


def _widened(leaves: DataFrame, cfg: MineConfig) -> DataFrame:
    return (leaves.withColumns({"label": F.element_at("labels", -1), "ids": F.concat("above", F.array("node_id"))})
            .withColumn("tok", _leaf_tokens(cfg)))


def _leaf_tokens(cfg: MineConfig):
    """Subtokens of a leaf, computed once per kept leaf rather than once per pair."""
    return token_or_subtokens("label", "is_reserved", cfg.max_subtokens)


def ancestor_index(leaves: DataFrame, reach: int) -> DataFrame:
    """A row per leaf and ancestor at most ``reach`` levels up: tree_id, anc, up, branch, okey, node_id.

    ``up`` is 0 for the leaf itself; ``branch`` is the ancestor's child on the way to the leaf.
    """
    n = F.size("ids")
    steps = F.transform(F.sequence(F.lit(0), F.least(F.lit(reach), n - 1)), lambda k: F.struct(
        F.get("ids", n - 1 - k).alias("anc"), k.alias("up"), F.get("ids", n - k).alias("branch")))
    return leaves.select("tree_id", "node_id", "okey", F.inline(steps))


def _with_partner(index: DataFrame, reach: int) -> DataFrame:
    """Leaves (tree_id, node_id, okey) with a later leaf in reach.

    The last leaf under an ancestor within each distance is a partial maximum,
    so looking it up is an equi-join that gives one row per leaf and ancestor.
    """
    last = index.groupBy("tree_id", "anc", "up").agg(F.max("okey").alias("okey"))
    within = (last.select("tree_id", "anc", "okey", F.explode(F.sequence(F.col("up"), F.lit(reach))).alias("left"))
              .groupBy("tree_id", "anc", "left").agg(F.max("okey").alias("last")))
    return (index.withColumn("left", F.lit(reach) - F.col("up")).join(within, ["tree_id", "anc", "left"])
            .where(F.col("last") > F.col("okey")).select("tree_id", "node_id", "okey").distinct())


ROW_LEAVES = 16384  # a tree of at most so many leaves is held in one row
ROW_STARTS = 64  # leaves of such a tree that are tried as starts in its row


def _small_trees(terms: DataFrame, cfg: MineConfig) -> tuple[DataFrame, DataFrame]:
    """(tree_id, leaves, used, pairs) of the trees that are settled in one row, and tree_id of all others.

    ``pairs`` are the ranks (i, j) of the first ``max_contexts + 1`` pairs within ``max_path_len``, ``used`` the ranks
    in them and ``leaves`` the leaves of these ranks.  Starts are tried in leaf order until there are pairs enough, so a
    row compares at most ``ROW_STARTS`` times its leaves.  The others have more leaves, ids that are null or repeat, or
    more than ``ROW_STARTS`` leaves and too few pairs from the first of them.
    """
    terms = _narrow(terms.where(F.col("tree_id").isNotNull()), cfg)
    many = cut_lineage(terms.groupBy("tree_id").agg(F.count("*").alias("n")).where(F.col("n") > ROW_LEAVES).select("tree_id"))
    trees = (terms.join(many, "tree_id", "left_anti").repartition("tree_id").groupBy("tree_id")
             .agg(F.collect_list(F.struct("okey", "node_id", "is_reserved", "above", "labels")).alias("leaves")))
    rows = trees.select("tree_id", F.transform(F.sort_array("leaves"), lambda x, i: F.struct(
        i.alias("rank"), F.concat(x["above"], F.array(x["node_id"])).alias("ids"), (F.size(x["above"]) + 1).alias("n"),
        x["labels"].alias("labels"), x["is_reserved"].alias("is_reserved"))).alias("leaves"))

    def fits(a, b):
        # a path is short enough if the ends have a common ancestor at this depth
        c = F.shiftright(a["n"] + b["n"] + (2 - cfg.max_path_len), 1)
        return (c <= 0) | (F.get(a["ids"], c - 1) == F.get(b["ids"], c - 1))

    def more(found, a):
        later = F.filter("leaves", lambda b: (b["rank"] > a["rank"]) & fits(a, b))
        return F.when(F.size(found) > cfg.max_contexts, found).otherwise(F.concat(found, F.transform(
            later, lambda b: F.struct(a["rank"].alias("i"), b["rank"].alias("j")))))

    nodes = F.array_distinct(F.transform("leaves", lambda x: F.element_at(x["ids"], -1)))
    plain = (F.size(nodes) == F.size("leaves")) & ~F.exists("leaves", lambda x: F.exists(x["ids"], lambda i: i.isNull()))
    rows = rows.withColumns({"plain": plain, "found": F.aggregate(
        F.slice("leaves", 1, ROW_STARTS), F.array().cast("array<struct<i:int,j:int>>"), more)})
    rows = rows.select("tree_id", "leaves", F.slice("found", 1, cfg.max_contexts + 1).alias("pairs"), (F.col("plain") & (
        (F.size("leaves") <= ROW_STARTS) | (F.size("found") > cfg.max_contexts))).alias("settled"))
    rows = rows.withColumn("used", F.sort_array(F.array_distinct(F.flatten(F.transform("pairs", lambda p: F.array(p["i"], p["j"]))))))
    kept = F.transform(F.filter("leaves", lambda x: F.array_contains("used", x["rank"])), lambda x: F.struct(
        F.element_at(x["ids"], -1).alias("node_id"), F.element_at(x["labels"], -1).alias("label"), x["is_reserved"].alias("is_reserved"),
        x["ids"].alias("ids"), x["labels"].alias("labels"),
        token_or_subtokens(F.element_at(x["labels"], -1), x["is_reserved"], cfg.max_subtokens).alias("tok")))
    rows = cut_lineage(rows.select("tree_id", F.when(F.col("settled"), kept).alias("leaves"), "used", F.when(
        F.col("settled"), F.col("pairs")).alias("pairs")))
    others = rows.where(F.col("leaves").isNull()).select("tree_id").unionByName(many)
    return rows.where(F.col("leaves").isNotNull()), others


def _limited_row_pairs(small: DataFrame, cfg: MineConfig) -> DataFrame:
    """The pairs of the trees that are settled in their row, written like those of a round."""
    pairs = small.select("tree_id", "leaves", "used", F.posexplode("pairs").alias("pair_idx", "p"))
    a, b = (F.get("leaves", (F.array_position("used", F.col(f"p.{x}")) - 1).cast("int")) for x in "ij")
    pairs = pairs.select("tree_id", F.col("pair_idx").cast("bigint").alias("pair_idx"), a.alias("a"), b.alias("b"))
    return cut_lineage(pairs.select("tree_id", "pair_idx", *[F.col(s)[f].alias(f"{s}_{f}") for s in "ab" for f in PAIR_FIELDS]))


def _length_limited_pairs(terms: DataFrame, cfg: MineConfig) -> DataFrame:
    """Exact first ``max_contexts + 1`` pairs whose full path fits ``max_path_len``.

    A path over an ancestor ``u`` and ``v`` levels above its ends has u + v + 1
    nodes, so partners meet in the ancestor index with u + v < ``max_path_len``;
    the lowest common ancestor is the one that they reach by different branches.

    Only leaves that have a later partner (``_with_partner``) are starts, and
    each gives at least one pair, so the first ``max_contexts + 1`` starts suffice.
    They are taken in rounds of ``length_round_start``, twice that, ... starts a tree, each round only for trees
    still short of pairs.  A leaf under an ancestor that is before a start and in
    its reach is itself one of the starts so far, so the partners that count are among the
    first (starts so far + ``max_contexts`` + 1) leaves of (ancestor, distance): a bounded
    top-k (partial ``WindowGroupLimit``) stands on that side of the join, and
    another one cuts what a round writes to the pairs its tree still needs.
    """
    m, reach = cfg.max_contexts, cfg.max_path_len - 1
    okey = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(leaf_order_key(terms, cfg))])
    leaves = cut_lineage(terms.withColumns({"okey": okey, "tok": _leaf_tokens(cfg)}))
    index = cut_lineage(ancestor_index(leaves, reach))
    starts = cut_lineage(_with_partner(index, reach))
    pending = starts.groupBy("tree_id").agg(F.count("*").alias("n_starts")).withColumn("found", F.lit(0).cast("bigint"))
    lo, width, rounds = 0, max(1, cfg.length_round_start), []
    while lo <= m:
        pending = cut_lineage(pending)
        if pending.isEmpty():
            break
        live = starts.join(pending.select("tree_id", "found"), "tree_id")
        place = F.row_number().over(Window.partitionBy("tree_id").orderBy("okey"))
        mine = live.withColumn("rn", place).where(F.col("rn") <= lo + width).where(F.col("rn") > lo)
        a = mine.select("tree_id", "node_id", "found").join(index, ["tree_id", "node_id"]).select(
            "tree_id", "anc", "found", *[F.col(c).alias(f"a_{c}") for c in ("node_id", "okey", "up", "branch")])
        near = index.join(pending.select("tree_id"), "tree_id", "left_semi").withColumn("rn", F.row_number().over(
            Window.partitionBy("tree_id", "anc", "up").orderBy("okey"))).where(F.col("rn") <= lo + width + m + 1)
        b = near.select("tree_id", "anc", *[F.col(c).alias(f"b_{c}") for c in ("node_id", "okey", "up", "branch")])
        cand = (a.join(b, ["tree_id", "anc"])
                .where((F.col("b_okey") > F.col("a_okey")) & (F.col("a_up") + F.col("b_up") <= reach)
                       & ~F.col("a_branch").eqNullSafe(F.col("b_branch"))))
        first = Window.partitionBy("tree_id").orderBy("a_okey", "b_okey")
        kept = cut_lineage(cand.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= m + 1)
                           .where(F.col("rn") + F.col("found") <= m + 1)
                           .select("tree_id", (F.col("rn") + F.col("found") - 1).cast("bigint").alias("pair_idx"),
                                   "a_node_id", "b_node_id"))
        rounds.append(kept)
        new = kept.groupBy("tree_id").agg(F.count("*").alias("n_new"))
        lo, width = lo + width, 2 * width
        pending = (pending.join(new, "tree_id", "left")
                   .select("tree_id", "n_starts", (F.col("found") + F.coalesce("n_new", F.lit(0))).alias("found"))
                   .where((F.col("found") <= m) & (F.col("n_starts") > lo)))
    if not rounds:
        rounds = [leaves.where(F.lit(False)).select("tree_id", F.lit(0).cast("bigint").alias("pair_idx"),
                                                    F.col("node_id").alias("a_node_id"), F.col("node_id").alias("b_node_id"))]
    pairs = reduce(DataFrame.unionByName, rounds)
    for side in ("a", "b"):
        pairs = pairs.join(leaves.select("tree_id", *[F.col(f).alias(f"{side}_{f}") for f in PAIR_FIELDS]),
                           ["tree_id", f"{side}_node_id"])
    return pairs.select("tree_id", "pair_idx", *[f"a_{f}" for f in PAIR_FIELDS], *[f"b_{f}" for f in PAIR_FIELDS])


# ------------------------------------------------------------ E2-E4 contexts
def pair_contexts(pairs: DataFrame, cfg: MineConfig) -> DataFrame:
    """tree_id, pair_idx, start, path, end (arrays), path_len (both ends included) and ``bad`` (a token with no subtoken)."""
    return (pairs.withColumn("lca", lca_depth("a_ids", "b_ids"))
            .select("tree_id", "pair_idx",
                    F.col("a_tok").alias("start"),
                    inner_path("a_labels", "b_labels", F.col("lca")).alias("path"),
                    F.col("b_tok").alias("end"),
                    path_len(F.size("a_ids"), F.size("b_ids"), F.col("lca")).alias("path_len"))
            .withColumn("bad", (F.size("start") == 0) | (F.size("end") == 0)))


def mine_contexts(nodes: DataFrame | None, cfg: MineConfig, terms: DataFrame | None = None) -> DataFrame:
    return pair_contexts(leaf_pairs(nodes, cfg, terms), cfg)


def tree_contexts(nodes: DataFrame | None, cfg: MineConfig, terms: DataFrame | None = None) -> DataFrame:
    """The contexts of ``mine_contexts`` in one row per tree: tree_id, contexts in pair order, any_bad.

    Contexts are built in the row, from at most ``max_contexts + 2`` leaves (``tree_leaves``),
    and keep the order of the trees.  With a length limit the contexts are grouped.
    """
    if cfg.max_path_len:
        return _grouped(mine_contexts(nodes, cfg, terms))
    return tree_leaves(nodes, cfg, terms).select("tree_id", row_contexts().alias("contexts"), "any_bad")


def tree_leaves(nodes: DataFrame | None, cfg: MineConfig, terms: DataFrame | None = None) -> DataFrame:
    """The rows of ``tree_contexts`` before their contexts are built: tree_id, leaves, n_contexts, any_bad.

    The contexts of a row are those of the first ``n_contexts`` pairs of its ``leaves`` in combination order.  There
    are several times as many contexts as leaves, so what is stored, sorted or shuffled should be leaves; ``context_rows``,
    ``row_contexts`` and ``row_texts`` make contexts of them.  The window that ranks the leaves also hands them to the first one.
    """
    if cfg.max_path_len:
        raise ValueError("a length limit chooses pairs, so leaves alone do not tell the contexts")
    leaf = F.struct("ids", "labels", "tok")
    rows = (_widened(_top_terminals(nodes, cfg, terms), cfg).withColumn("leaves", F.collect_list(leaf).over(_tree()))
            .where((F.col("rank") == 0) & (F.size("leaves") > 1)))
    # every one of these leaves ends a pair with the first
    bad = F.exists("leaves", lambda x: F.coalesce(F.size(x["tok"]) == 0, F.lit(False)))
    t = F.size("leaves").cast("bigint")
    n = F.least(F.shiftright(t * (t - 1), 1), F.lit(cfg.max_contexts + 1)).cast("int")
    return rows.select("tree_id", "leaves", n.alias("n_contexts"), bad.cast("int").alias("any_bad"))


def _in_row(context, leaves=None, starts=None) -> Column:
    """``context(a, b, c)`` of the first ``n_contexts`` pairs of ``leaves``, whose common ancestor has depth c, in combination order.

    ``starts`` makes of leaves what is wanted of a pair's start, and ``leaves`` what is wanted of its end.
    """
    t, n = F.size("leaves").cast("bigint"), F.col("n_contexts")
    first = F.filter(F.sequence(F.lit(0).cast("bigint"), t - 2), lambda i: _first_index(i, t) < n)
    a_side = F.slice("leaves", F.lit(1), F.size(first))

    def one(x, f):
        # an expression that is read several times is held by a lambda over one element
        return F.get(F.transform(F.array(x), f), F.lit(0))

    def pairs(b_side):
        return F.flatten(F.transform(starts(a_side) if starts else a_side, lambda a, i: F.transform(
            F.slice(b_side, i + 2, (n - _first_index(i.cast("bigint"), t)).cast("int")),
            lambda b: one(lca_depth(a["ids"], b["ids"]), lambda c: context(a, b, c)))))
    return one(leaves(F.col("leaves")), pairs) if leaves else pairs(F.col("leaves"))


def row_contexts() -> Column:
    """The contexts of a row of ``tree_leaves``, as an array."""
    return _in_row(lambda a, b, c: F.struct(a["tok"].alias("start"), inner_path(a["labels"], b["labels"], c).alias("path"),
                                            b["tok"].alias("end")))


TEXT_DEPTH = 32  # leaves at most so deep hold the two sides of their contexts' texts ready for every depth of the common ancestor


def row_texts() -> Column:
    """The contexts of a row of ``tree_leaves`` as ``format_context`` writes them, as an array.

    A text is what its start gives down to the common ancestor and what its end gives below it, and both are made once
    a leaf and depth.  Where that would not do (an end is the ancestor itself, nulls, deep leaves) it is made for the context.
    """
    def sides(make):
        def of(x):
            n = F.size(x["labels"])
            plain = (n > 1) & (n <= TEXT_DEPTH) & x["tok"].isNotNull() & ~F.exists(x["labels"], lambda v: v.isNull())
            return F.struct(x["ids"].alias("ids"), x["labels"].alias("labels"), x["tok"].alias("tok"), F.when(
                plain, F.transform(F.sequence(F.lit(1), n - 1), lambda c: make(x, n, c))).alias("sides"))
        return lambda leaves: F.transform(leaves, of)

    def head(x, n, c):
        return F.concat(F.array_join(x["tok"], BAR), F.lit(","), F.array_join(F.reverse(F.slice(x["labels"], c, n - c)), BAR))

    def tail(x, n, c):
        below = F.concat(F.lit(BAR), F.array_join(F.slice(x["labels"], c + 1, n - c - 1), BAR))
        return F.concat(F.when(c < n - 1, below).otherwise(""), F.lit(","), F.array_join(x["tok"], BAR))

    def text(a, b, c):
        made = F.when(c > 0, F.concat(F.get(a["sides"], c - 1), F.get(b["sides"], c - 1)))
        path = inner_path(a["labels"], b["labels"], c)
        return F.coalesce(made, format_context(F.struct(a["tok"].alias("start"), path.alias("path"), b["tok"].alias("end"))))
    return _in_row(text, leaves=sides(tail), starts=sides(head))


def with_texts(samples: DataFrame) -> DataFrame:
    """Samples that hold leaves with ``contexts`` as an array of texts."""
    return samples.withColumn("contexts", row_texts()).drop("leaves")


def context_rows(samples: DataFrame, *keep: str) -> DataFrame:
    """A row per context, from samples that hold contexts or leaves: ``keep``, ctx_pos, start, path, end."""
    if "leaves" not in samples.columns:
        return samples.select(*keep, F.posexplode("contexts").alias("ctx_pos", "c")).select(*keep, "ctx_pos", "c.start", "c.path", "c.end")
    t, n = F.size("leaves"), F.col("n_contexts")
    starts = samples.select(*keep, "leaves", n, F.posexplode(F.slice("leaves", F.lit(1), t - 1)).alias("i", "a"))
    first = _first_index(F.col("i").cast("bigint"), t.cast("bigint"))
    ends = F.slice("leaves", F.col("i") + 2, (n - first).cast("int"))
    pairs = starts.where(first < n).select(*keep, "a", first.alias("first"), F.posexplode(ends).alias("j", "b"))
    met = pairs.withColumn("lca", lca_depth("a.ids", "b.ids"))
    return met.select(*keep, (F.col("first") + F.col("j")).cast("int").alias("ctx_pos"), F.col("a.tok").alias("start"),
                      inner_path("a.labels", "b.labels", "lca").alias("path"), F.col("b.tok").alias("end"))


def _grouped(contexts: DataFrame) -> DataFrame:
    cs = F.array_sort(F.collect_list(F.struct("pair_idx", "start", "path", "end")))
    return (contexts.groupBy("tree_id").agg(cs.alias("cs"), F.max(F.col("bad").cast("int")).alias("any_bad"))
            .select("tree_id", F.transform("cs", lambda c: F.struct(
                c["start"].alias("start"), c["path"].alias("path"), c["end"].alias("end"))).alias("contexts"), "any_bad"))


# ------------------------------------------------------- E6 / B10 / B15 samples
def assemble_samples(contexts: DataFrame, trees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One sample per tree that has contexts; trees with a bad token are rejected.

    ``contexts``: rows of ``mine_contexts`` or, neither grouped nor sorted again, of ``tree_contexts`` or ``tree_leaves``.
    ``trees``: tree_id, target array<string>, file, line.  Returns
    ``(samples, rejects)``; samples carry contexts ordered by pair index or, of ``tree_leaves``, leaves and n_contexts.
    """
    grouped = contexts if "any_bad" in contexts.columns else _grouped(contexts)
    joined = grouped.join(trees, "tree_id")
    bad_target = F.size("target") == 0
    reason = (F.when(bad_target, F.lit("target has no subtoken"))
              .when(F.col("any_bad") == 1, F.lit("token has no subtoken")))
    joined = joined.withColumn("reason", reason)
    samples = joined.where(F.col("reason").isNull()).select(
        "tree_id", "file", "line", "target", *[c for c in ("contexts", "leaves", "n_contexts") if c in grouped.columns])
    rejects = joined.where(F.col("reason").isNotNull()).select("tree_id", "file", "line", "reason")
    return samples, rejects
