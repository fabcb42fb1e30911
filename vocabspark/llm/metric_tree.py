"""Metric trees over points of whole numbers, and nearest-entry assignment through them.

A tree is built middle-out. About sqrt(n) anchors come first: each new anchor is the point farthest from its
own anchor, and takes over every point that is nearer to it; a point closer to its anchor than half the
way to the new one cannot change hands and is not measured. Anchor balls are then merged upwards, always the
two that fit the smallest ball, and split downwards by the same procedure. Every ball keeps the sum and the count
of its points.

Assignment walks down with the list of entries that may still be nearest to some point of the ball.
An entry leaves the list if another one is strictly nearer to every point: for a ball of centre q and radius r,
``|q-c|^2 - |q-b|^2 > 2 r |c-b|``. A ball with one entry left is owned by it, and its cached sum and
count are added at once. Leaves with more entries left compare their points exactly, in whole numbers. The rule
keeps a margin far above rounding errors, so that the result is that of comparing every point with
every entry, ties to the lower index.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

LEAF_POINTS = 48
_MARGIN = 1e-9


@dataclass
class Tree:
    """Balls as arrays; ball 0 is the root. A ball's points are a run of the tree's order."""

    points: np.ndarray  # (n, d) int64, in tree order
    order: np.ndarray  # row that each point came from
    first: np.ndarray  # where a ball's points begin
    count: np.ndarray
    left: np.ndarray  # children; -1 in leaves
    right: np.ndarray
    centre: np.ndarray  # (balls, d) float64
    radius: np.ndarray
    sums: np.ndarray  # (balls, d) int64


def _anchors(points: np.ndarray) -> np.ndarray:
    """The anchor, as a number from 0, that owns each point."""
    n = len(points)
    most = int(np.ceil(np.sqrt(n)))
    at = points.astype(np.float64)
    chosen = [0]
    owner = np.zeros(n, np.int32)
    away = np.sqrt(((at - at[0]) ** 2).sum(1))
    while len(chosen) < most:
        new = int(away.argmax())
        if away[new] == 0:
            break
        half = np.sqrt(((at[chosen] - at[new]) ** 2).sum(1)) / 2
        may = np.flatnonzero(away > half[owner] * (1 - _MARGIN))
        near = np.sqrt(((at[may] - at[new]) ** 2).sum(1))
        taken = near < away[may]
        owner[may[taken]] = len(chosen)
        away[may[taken]] = near[taken]
        chosen.append(new)
    return owner


def _merged(groups: list[np.ndarray], points: np.ndarray) -> list | int:
    """Nested pairs of group numbers: the two balls that fit the smallest ball are joined first."""
    k = len(groups)
    centre = np.array([points[g].mean(0) for g in groups])
    radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre)])
    weight = np.array([len(g) for g in groups], float)
    nodes: list = list(range(k))

    def wide(i: int) -> np.ndarray:
        gap = np.sqrt(((centre - centre[i]) ** 2).sum(1))
        return np.maximum((gap + radius + radius[i]) / 2, np.maximum(radius, radius[i]))

    size = np.array([wide(i) for i in range(k)])
    np.fill_diagonal(size, np.inf)
    root = nodes[0]
    for _ in range(k - 1):
        i, j = divmod(int(size.argmin()), k)
        root = nodes[i] = [nodes[i], nodes[j]]
        both = weight[i] + weight[j]
        middle = (centre[i] * weight[i] + centre[j] * weight[j]) / both
        reach = [np.sqrt(((middle - centre[x]) ** 2).sum()) + radius[x] for x in (i, j)]
        centre[i], radius[i], weight[i] = middle, max(reach), both
        size[j, :] = size[:, j] = np.inf
        gone = np.isinf(size[i])
        fresh = wide(i)
        fresh[gone] = np.inf
        fresh[i] = np.inf
        size[i, :] = size[:, i] = fresh
    return root


def build(points: np.ndarray) -> Tree:
    """The tree of ``points``, an (n, d) array of int64; ``n`` is at least 1."""
    first, count, left, right, order = [], [], [], [], []
    floats = points.astype(np.float64)

    def ball() -> int:
        first.append(len(order))
        for column in (count, left, right):
            column.append(-1)
        return len(first) - 1

    # An explicit stack, since merged anchors can form a chain: (rows or nested groups, its ball).
    def grow(rows: np.ndarray) -> None:
        stack: list = [("open", rows, None, -1)]
        while stack:
            kind, what, groups, parent = stack.pop()
            if kind == "close":
                count[what] = len(order) - first[what]
                continue
            own = ball()
            if parent >= 0:
                side = left if left[parent] < 0 else right
                side[parent] = own
            stack.append(("close", own, None, -1))
            if isinstance(what, int):
                what, groups = groups[what], None
            if groups is None:
                owner = _anchors(points[what]) if len(what) > LEAF_POINTS else np.zeros(len(what), np.int32)
                many = int(owner.max()) + 1
                if many == 1:
                    order.extend(what.tolist())
                    continue
                groups = [what[owner == g] for g in range(many)]
                what = _merged(groups, floats)
            for child in reversed(what):
                stack.append(("open", child, groups, own))

    grow(np.arange(len(points)))
    order_, first_, count_ = np.array(order, np.int32), np.array(first, np.int32), np.array(count, np.int32)
    placed = points[order_]
    total = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(placed, axis=0, out=total[1:])
    sums = total[first_ + count_] - total[first_]
    centre = sums / count_[:, None]
    radius = np.array([
        np.sqrt(((placed[f : f + n] - c) ** 2).sum(1).max()) for f, n, c in zip(first_.tolist(), count_.tolist(), centre)
    ])
    return Tree(placed, order_, first_, count_, np.array(left, np.int32), np.array(right, np.int32), centre, radius, sums)


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of several runs, one run after the other."""
    begins = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(first - begins, count)


def assign(tree: Tree, entries: np.ndarray, owned: Callable, compared: Callable) -> None:
    """Find the nearest entry of every point.

    ``owned(balls, entry)`` is told of balls that belong to one entry each, ``compared(places, entry)`` of
    single points, by place in the tree's order.
    """
    k = len(entries)
    exact = entries.astype(np.float64)
    apart = np.sqrt(((exact[:, None] - exact[None]) ** 2).sum(2))
    # Equal entries: the first one wins every tie.
    alive = np.array([not (entries[:i] == entries[i]).all(1).any() for i in range(k)])
    square = (entries * entries).sum(1)
    balls = np.zeros(1, np.int64)
    may = alive[None, :]
    while len(balls):
        q, r = tree.centre[balls], tree.radius[balls]
        far = ((q[:, None, :] - exact[None]) ** 2).sum(2)
        best = np.where(may, far, np.inf).argmin(1)
        near = far[np.arange(len(balls)), best][:, None]
        reach = 2 * r[:, None] * apart[best]
        may = may & ~(far - near > reach + _MARGIN * (far + near + reach) + _MARGIN)
        alone = may.sum(1) == 1
        if alone.any():
            owned(balls[alone], may[alone].argmax(1))
        leaf = ~alone & (tree.left[balls] < 0)
        if leaf.any():
            places = _runs(tree.first[balls[leaf]], tree.count[balls[leaf]])
            points = tree.points[places]
            distance = square - 2 * (points @ entries.T)
            allowed = np.repeat(may[leaf], tree.count[balls[leaf]], axis=0)
            compared(places, np.where(allowed, distance, np.iinfo(np.int64).max).argmin(1))
        inner = ~alone & ~leaf
        balls, may = (
            np.concatenate((tree.left[balls[inner]], tree.right[balls[inner]])),
            np.concatenate((may[inner], may[inner])),
        )


def sums_by_entry(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the points that are nearest to each entry."""
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)

    def owned(balls: np.ndarray, entry: np.ndarray) -> None:
        np.add.at(sums, entry, tree.sums[balls])
        np.add.at(counts, entry, tree.count[balls])

    def compared(places: np.ndarray, entry: np.ndarray) -> None:
        np.add.at(sums, entry, tree.points[places])
        np.add.at(counts, entry, 1)

    assign(tree, entries, owned, compared)
    return sums, counts


def nearest(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each row, in the rows' own order."""
    found = np.empty(len(tree.order), np.int32)

    def owned(balls: np.ndarray, entry: np.ndarray) -> None:
        places = _runs(tree.first[balls], tree.count[balls])
        found[places] = np.repeat(entry, tree.count[balls])

    def compared(places: np.ndarray, entry: np.ndarray) -> None:
        found[places] = entry

    assign(tree, entries, owned, compared)
    out = np.empty_like(found)
    out[tree.order] = found
    return out
