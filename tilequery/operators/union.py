"""Area that several shapes cover together inside rectangles, by plane sweeps that run side by side.

Shapes are given by their edges. Between two neighbouring events (ends and crossings of edges, and where they leave
the rectangle) edges are straight and do not cross, so what is covered there is a set of trapezoids, and its length in the middle times the
width is its area. Edges of one shape open and close in turn (so holes are left out); a running count of open shapes gives the union.
"""

from __future__ import annotations

import numpy as np

#: Pairs of edges looked at together.
_PAIRS = 1 << 21


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, value) of all whole numbers in the half-open ranges."""
    n = np.maximum(end - start, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[which]


def _height(e: np.ndarray, x: np.ndarray) -> np.ndarray:
    return e[1] + (e[3] - e[1]) * ((x - e[0]) / (e[2] - e[0]))


def _crossings(e: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, x) of proper crossings of edges with the same owner; owners are sorted."""
    at = np.arange(len(owner))
    end = np.searchsorted(owner, owner, side="right")
    cuts = np.searchsorted(np.cumsum(end - at - 1), np.arange(0, (end - at - 1).sum() + _PAIRS, _PAIRS))
    found = [np.zeros(0, np.int64)], [np.zeros(0)]
    for s, t in zip(cuts[:-1], cuts[1:], strict=True):
        which, j = ranges(at[s : t + 1] + 1, end[s : t + 1])
        i = which + s
        low, high = np.maximum(e[0, i], e[0, j]), np.minimum(e[2, i], e[2, j])
        i, j, low, high = (v[low < high] for v in (i, j, low, high))
        first, last = _height(e[:, i], low) - _height(e[:, j], low), _height(e[:, i], high) - _height(e[:, j], high)
        cross = first * last < 0
        first, last = first[cross], last[cross]
        found[0].append(owner[i[cross]])
        found[1].append(low[cross] + (high - low)[cross] * (first / (first - last)))
    return np.concatenate(found[0]), np.concatenate(found[1])


def _boxes(e: np.ndarray, shape: np.ndarray) -> bool:
    """Whether flat edges come in pairs of one shape each, over the same stretch."""
    pairs = len(shape) % 2 == 0 and bool((shape[::2] == shape[1::2]).all() and (e[[0, 2], ::2] == e[[0, 2], 1::2]).all())
    return pairs and not (shape[2::2] == shape[1:-1:2]).any()


def union_areas(edges: np.ndarray, shape: np.ndarray, owner: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Area of the union of shapes inside each of ``boxes`` (4 x n: left, top, right, bottom).

    ``edges`` (4 x m: x, y of both ends) belong to a shape, and shapes to a box (``owner``). Those of a shape close at every x
    inside the box; the inside is where a line from above has crossed an odd number of them. Upright edges say nothing and may be absent.
    """
    n = boxes.shape[1]
    e = np.where(edges[0] <= edges[2], edges, edges[[2, 3, 0, 1]])
    box = boxes[:, owner]
    keep = (e[0] < e[2]) & (e[2] > box[0]) & (e[0] < box[2])
    order = np.flatnonzero(keep)
    order = order[np.argsort(owner[order], kind="stable")]
    e, shape, owner, box = e[:, order], shape[order], owner[order], box[:, order]
    if not len(owner):
        return np.zeros(n)
    left, right = np.maximum(e[0], box[0]), np.minimum(e[2], box[2])
    e = np.stack([left, _height(e, left), right, _height(e, right)])
    m = len(owner)
    owners, xs = [owner, owner], [e[0], e[2]]
    for side in (box[1], box[3]):
        leaves = (e[1] - side) * (e[3] - side) < 0
        owners.append(owner[leaves])
        xs.append((e[0] + (e[2] - e[0]) * (side - e[1]) / np.where(leaves, e[3] - e[1], 1.0))[leaves])
    flat = bool((e[1] == e[3]).all())  # then no edges cross
    more = (np.zeros(0, np.int64), np.zeros(0)) if flat else _crossings(e, owner)
    owners, xs = np.concatenate([*owners, more[0]]), np.concatenate([*xs, more[1]])
    order = np.lexsort((xs, owners))
    new = np.r_[True, (np.diff(owners[order]) != 0) | (np.diff(xs[order]) > 0)]
    place = np.empty(len(xs), np.int64)
    place[order] = np.cumsum(new) - 1
    at, of = xs[order][new], owners[order][new]
    edge, slab = ranges(place[:m], place[m : 2 * m])
    if flat and _boxes(e, shape):
        # Boxes: of the two edges the upper one opens.
        y = np.clip(e[1], box[1], box[3])[edge]
        turn = (np.arange(m) % 2 ^ np.repeat(e[1, ::2] > e[1, 1::2], 2))[edge]
    else:
        y = np.clip(_height(e[:, edge], (at[slab] + at[slab + 1]) / 2), box[1, edge], box[3, edge])
        order = np.lexsort((y, shape[edge], slab))
        edge, slab, y = edge[order], slab[order], y[order]
        start = np.r_[True, (np.diff(slab) != 0) | (np.diff(shape[edge]) != 0)]
        turn = (np.arange(len(y)) - np.flatnonzero(start)[np.cumsum(start) - 1]) % 2
    order = np.lexsort((y, slab))
    slab, y, opened = slab[order], y[order], np.cumsum(1 - 2 * turn[order])
    inside = (opened[:-1] > 0) & (slab[1:] == slab[:-1])
    area = np.where(inside, y[1:] - y[:-1], 0.0) * (at[np.minimum(slab[:-1] + 1, len(at) - 1)] - at[slab[:-1]])
    return np.bincount(of[slab[:-1]], area, n)


def edges_near(ring: np.ndarray, left: float, top: float, right: float, bottom: float) -> np.ndarray:
    """Edges (4 x m) of a closed ring that say what a rectangle holds of it: chains above or below it become one edge along its side, those beside it go."""
    after = np.roll(ring, -1, axis=0)
    code = np.where((ring[:, 1] <= top) & (after[:, 1] <= top), 1, np.where((ring[:, 1] >= bottom) & (after[:, 1] >= bottom), 2, 0))
    start = np.flatnonzero((code == 0) | (code != np.roll(code, 1)))
    if not len(start):
        return np.zeros((4, 0))
    kind, x, y = code[start], ring[start, 0], ring[start, 1]
    end = after[np.roll(start, -1) - 1]
    level = np.where(kind == 1, top, bottom)
    e = np.stack([x, np.where(kind == 0, y, level), end[:, 0], np.where(kind == 0, end[:, 1], level)])
    return e[:, (np.maximum(e[0], e[2]) > left) & (np.minimum(e[0], e[2]) < right)]
