"""Cover trees over small blocks of integer vectors, and the dual-tree search for the nearest of many centroids.

A node has a centre, one of the points, and a radius that holds all points below it. A node's children halve its scale: the centre stays one of them, the next
centre is always the point farthest from those there are, and a point goes to the first centre within the new scale. So siblings' centres are more than
the scale apart. Points equal to each other share a leaf. Nodes are held depth-first, so the points of a node are a range.

Distances between integer vectors are exact; bounds made of their roots get a slack far above their rounding, so a
pair is pruned only if no point of the one can be nearest, or as near, to a centroid below the other.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LEAF = 16
#: Relative slack of bounds, far above the rounding of square roots in doubles.
SLACK = 1e-9


class Tree(NamedTuple):
    """Nodes depth-first: the position of the centre, of the first point and of the point after the last one, radius, the node after the subtree. ``order`` has the point at each position."""

    order: np.ndarray
    centre: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    radius: np.ndarray
    skip: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` to the row ``b``."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The cover tree of ``points`` (64-bit integers)."""
    n = len(points)
    order: list[np.ndarray] = []
    nodes: list[list] = []
    # (members, the first of them the centre; their distances to it) to be built, or the number of a node to close
    todo: list = [(np.arange(n), np.sqrt(squared(points, points[0])))] if n else []
    at = 0
    while todo:
        top = todo.pop()
        if isinstance(top, int):
            nodes[top][4] = len(nodes)
            continue
        members, far = top
        radius = float(far.max())
        own = len(nodes)
        nodes.append([at, at, at + len(members), radius * (1 + SLACK), own + 1])
        if len(members) <= leaf or radius == 0:
            order.append(members)
            at += len(members)
            continue
        # members keep the distance to their nearest centre, which the next centre maximises
        scale, near, children, free = radius / 2, far.copy(), [], far > radius / 2
        children.append((members[~free], far[~free]))
        while free.any():
            rest = np.flatnonzero(free)
            pick = rest[np.argmax(near[rest])]
            d = np.sqrt(squared(points[members[rest]], points[members[pick]]))
            near[rest] = np.minimum(near[rest], d)
            takes = d <= scale
            got = rest[takes]
            lead = np.argsort(got != pick, kind="stable")
            children.append((members[got[lead]], d[takes][lead]))
            free[got] = False
        todo.append(own)
        todo.extend(reversed(children))
    c, lo, hi, r, skip = (np.array(x) for x in zip(*nodes)) if nodes else (np.zeros(0, np.int64),) * 5
    return Tree(np.concatenate(order) if order else np.zeros(0, np.int64), c, lo, hi, r.astype(float), skip)


class Counts(NamedTuple):
    """What a search did: node pairs looked at, node pairs pruned, points settled with their node, exact distances."""

    pairs: int
    pruned: int
    settled: int
    exact: int


def nearest(tree: Tree, points: np.ndarray, ctree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]], Counts]:
    """(nearest centroid by position of the tree, ranges of positions settled as a whole as (lo, hi, centroid), counts).

    ``points`` and ``centroids`` are in the order of their trees. Of equally near centroids the one with the smallest number (``ctree.order``) wins.
    """
    best = np.zeros(len(points), np.int64)
    settled: list[tuple[int, int, int]] = []
    pairs = pruned = whole = exact = 0
    if not len(points):
        return best, settled, Counts(0, 0, 0, 0)
    # a point node with the centroid nodes that may hold a nearest centroid of one of its points
    todo = [(0, np.zeros(1, np.int64))]
    while todo:
        q, cand = todo.pop()
        lo, hi, radius = int(tree.lo[q]), int(tree.hi[q]), float(tree.radius[q])
        centre = points[tree.centre[q]]
        is_leaf = tree.skip[q] == q + 1
        while True:
            d = np.sqrt(squared(centroids[ctree.centre[cand]], centre).astype(float))
            # a centre of a centroid node is a centroid, so its distance bounds the nearest one's from above
            most = (d.min() + 2 * radius) * (1 + SLACK)
            keep = d - ctree.radius[cand] <= most
            pairs, pruned = pairs + len(cand), pruned + int((~keep).sum())
            cand = cand[keep]
            wide = (ctree.skip[cand] > cand + 1) & ((ctree.radius[cand] > radius) | is_leaf | (len(cand) == 1))
            if not wide.any():
                break
            cand = np.concatenate([cand[~wide], *(_children(ctree, int(c)) for c in cand[wide])])
        ids = np.concatenate([np.arange(ctree.lo[c], ctree.hi[c]) for c in cand])
        if len(ids) == 1:
            one = int(ctree.order[ids[0]])
            best[lo:hi] = one
            settled.append((lo, hi, one))
            whole += hi - lo
        elif is_leaf:
            ids = ids[np.argsort(ctree.order[ids])]
            gap = points[lo:hi, None, :] - centroids[None, ids, :]
            best[lo:hi] = ctree.order[ids[np.argmin(np.einsum("ijk,ijk->ij", gap, gap), axis=1)]]
            exact += (hi - lo) * len(ids)
        else:
            todo.extend((int(c), cand) for c in _children(tree, q))
    return best, settled, Counts(pairs, pruned, whole, exact)


def _children(t: Tree, node: int) -> np.ndarray:
    out, c = [], node + 1
    while c < t.skip[node]:
        out.append(c)
        c = int(t.skip[c])
    return np.array(out, np.int64)
