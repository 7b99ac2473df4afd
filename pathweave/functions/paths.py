"""Tree-path column functions over root-path arrays.

Every node carries ``ids`` and ``labels`` from the root down to itself, so the
lowest common ancestor of two nodes of one tree is the length of the common
prefix of their ``ids``; the path between them is read off the two label
arrays without any look-up join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lca_depth(ids_a, ids_b) -> Column:
    """Common-prefix length of two root paths of one tree.

    Node ids are unique inside a tree, so the common elements of two root
    paths are exactly their common ancestors: a built-in set intersection
    (code-generated) replaces a per-element lambda.
    """
    return F.size(F.array_intersect(_c(ids_a), _c(ids_b)))


def path_len(size_a, size_b, lca) -> Column:
    """Number of nodes on the path, both ends included."""
    return _c(size_a) + _c(size_b) - _c(lca) * 2 + 1


def inner_path(labels_a, labels_b, lca) -> Column:
    """Labels strictly between the two ends: up from a, the LCA, down to b.

    If one end is itself the common ancestor (a root with one child is a leaf)
    the ancestor is an end and is left out.
    """
    la, lb, c = _c(labels_a), _c(labels_b), _c(lca)
    na, nb = F.size(la), F.size(lb)
    up = F.reverse(F.slice(la, c + 1, F.greatest(na - c - 1, F.lit(0))))
    mid = F.when((c < na) & (c < nb), F.array(F.element_at(la, F.greatest(c, F.lit(1))))).otherwise(
        F.array().cast("array<string>"))
    down = F.slice(lb, c + 1, F.greatest(nb - c - 1, F.lit(0)))
    return F.concat(up, mid, down)
