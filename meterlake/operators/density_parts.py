"""Density clusters of one part of the points, in arrays: blocks of near points, decided box by box before point by point."""

from __future__ import annotations

import numpy as np

BLOCK = 64


def split_order(points: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points, and bounds in it, such that each stretch is one of the boxes of halving the widest side again and again."""
    order, bounds, work = np.arange(len(points)), [], [(0, len(points))]
    while work:
        a, b = work.pop()
        if b - a <= size:
            bounds.append(a)
            continue
        own = points[order[a:b]]
        axis = int(np.argmax(own.max(0) - own.min(0)))
        middle = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
        work += [(a, a + middle), (a + middle, b)]
    return order, np.array(sorted(bounds) + [len(points)])


def squared(difference: np.ndarray) -> np.ndarray:
    """Sum of squares over the last axis, added from the first to the last as a formula would."""
    total = difference[..., 0] * difference[..., 0]
    for i in range(1, difference.shape[-1]):
        total = total + difference[..., i] * difference[..., i]
    return total


class Blocks:
    """Points in boxes; pairs of boxes are all near, undecided, or (not listed) all far."""

    def __init__(self, points: np.ndarray, eps: float, size: int = BLOCK):
        self.order, self.bounds = split_order(points, size)
        self.points, self.limit = points[self.order], eps * eps
        starts = self.bounds[:-1]
        self.low = np.minimum.reduceat(self.points, starts) if len(points) else np.zeros((0, points.shape[1]))
        self.high = np.maximum.reduceat(self.points, starts) if len(points) else self.low

    def pairs(self, a: int) -> tuple[np.ndarray, np.ndarray]:
        """Boxes from `a` on that are near it as a whole, and those that may be."""
        low, high = self.low[a:], self.high[a:]
        gap = np.maximum(np.maximum(low - self.high[a], self.low[a] - high), 0.0)
        near = squared(gap) <= self.limit
        whole = squared(np.maximum(high - self.low[a], self.high[a] - low)) <= self.limit
        return np.flatnonzero(near & whole) + a, np.flatnonzero(near & ~whole) + a

    def span(self, a: int) -> slice:
        return slice(self.bounds[a], self.bounds[a + 1])

    def near(self, a: int, b: int) -> np.ndarray:
        return squared(self.points[self.span(a)][:, None, :] - self.points[self.span(b)][None, :, :]) <= self.limit

    def neighbours(self) -> np.ndarray:
        """Points within eps of each point, itself included."""
        counts = np.zeros(len(self.points), np.int64)
        sizes = np.diff(self.bounds)
        for a in range(len(sizes)):
            whole, some = self.pairs(a)
            counts[self.span(a)] += sizes[whole].sum()
            for b in whole[whole != a].tolist():
                counts[self.span(b)] += sizes[a]
            for b in some.tolist():
                inside = self.near(a, b)
                counts[self.span(a)] += inside.sum(1)
                if a != b:
                    counts[self.span(b)] += inside.sum(0)
        return counts

    def components(self, core: np.ndarray) -> np.ndarray:
        """For each core point the place of the first point of its cluster; -1 for others."""
        root = np.where(core, np.arange(len(core)), -1)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = int(root[i])
            return i

        def roots(at: np.ndarray) -> np.ndarray:
            at = root[at]
            while True:
                up = root[at]
                if np.array_equal(up, at):
                    return at
                at = up

        def join(ones: np.ndarray, others: np.ndarray) -> None:
            for i, j in set(zip(ones.tolist(), others.tolist(), strict=True)):
                i, j = find(i), find(j)
                if i != j:
                    root[max(i, j)] = min(i, j)

        places = np.arange(len(core))
        for a in range(len(self.bounds) - 1):
            whole, some = self.pairs(a)
            own = places[self.span(a)][core[self.span(a)]]
            if not len(own):
                continue
            for b in whole.tolist():
                other = places[self.span(b)][core[self.span(b)]]
                if len(other):
                    mine = roots(np.concatenate((own, other)))
                    join(mine[1:], np.repeat(mine[:1], len(mine) - 1))
            for b in some.tolist():
                other = places[self.span(b)][core[self.span(b)]]
                if not len(other):
                    continue
                mine, theirs = roots(own), roots(other)
                if (mine == mine[0]).all() and (theirs == mine[0]).all():
                    continue  # one cluster already
                i, j = np.nonzero(self.near(a, b)[np.ix_(own - self.bounds[a], other - self.bounds[b])])
                join(mine[i], theirs[j])
        out = np.full(len(core), -1)
        out[core] = roots(places[core])
        return out

    def reaching(self, core: np.ndarray, label: np.ndarray, wanted: np.ndarray) -> list[tuple[int, int]]:
        """(point, label) for the wanted points and the labels of all core points within eps, each once."""
        found: set[tuple[int, int]] = set()
        places = np.arange(len(core))
        for a in range(len(self.bounds) - 1):
            whole, some = self.pairs(a)
            for b in np.concatenate((whole, some)).tolist():
                for x, y in {(a, b), (b, a)}:
                    mine = places[self.span(x)][wanted[self.span(x)]]
                    theirs = places[self.span(y)][core[self.span(y)]]
                    if len(mine) and len(theirs):
                        inside = self.near(x, y)[np.ix_(mine - self.bounds[x], theirs - self.bounds[y])]
                        i, j = np.nonzero(inside)
                        found |= set(zip(mine[i].tolist(), label[theirs[j]].tolist(), strict=True))
        return sorted(found)


def cluster_part(points: np.ndarray, ids: np.ndarray, own: np.ndarray, close: np.ndarray, eps: float, least: int) -> list[tuple]:
    """(id, label, core, own) of a part's own points, and of the core points close to it.

    `points` holds the part's own points and all within twice eps of its box; `close` marks those within eps. A core point's label is the
    smallest id of its cluster here; another point has a row for each cluster that reaches it, or one without a label. Points of other parts
    have rows only where they are core, to tie the parts' clusters together.
    """
    blocks = Blocks(points, eps)
    ids, own, close = ids[blocks.order], own[blocks.order], close[blocks.order]
    core = (blocks.neighbours() >= least) & close
    root = blocks.components(core)
    smallest: dict[int, object] = {}
    for r, i in zip(root[core].tolist(), ids[core].tolist(), strict=True):
        if r not in smallest or i < smallest[r]:
            smallest[r] = i
    rows: list[tuple] = [(i, smallest[r], True, o) for i, r, o in zip(ids[core].tolist(), root[core].tolist(), own[core].tolist(), strict=True)]
    wanted = own & ~core
    reached = blocks.reaching(core, root, wanted)
    rows += [(ids[p], smallest[r], False, True) for p, r in reached]
    alone = np.flatnonzero(wanted)
    alone = alone[~np.isin(alone, [p for p, _ in reached])]
    return rows + [(i, None, False, True) for i in ids[alone].tolist()]


def point_gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point from every box."""
    total = 0.0
    for i in range(points.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, i] - points[:, None, i], points[:, None, i] - high[None, :, i]), 0.0)
        total = total + gap * gap
    return total


def _facing(one: Blocks, other: Blocks):
    """Each box of `one` with the boxes of `other` that are near it as a whole, and those that may be."""
    for a in range(len(one.low)):
        gap = np.maximum(np.maximum(other.low - one.high[a], one.low[a] - other.high), 0.0)
        near = squared(gap) <= one.limit
        whole = squared(np.maximum(other.high - one.low[a], one.high[a] - other.low)) <= one.limit
        yield a, np.flatnonzero(near & whole), np.flatnonzero(near & ~whole)


def _inside(one: Blocks, a: int, other: Blocks, b: int, pairs: int):
    """Which points of box b are within eps of the points of box a: rows of `a` by stretches, at most `pairs` pairs (or a row) at once."""
    theirs, span = other.points[other.span(b)], one.span(a)
    step = max(1, pairs // len(theirs))
    for start in range(span.start, span.stop, step):
        rows = slice(start, min(start + step, span.stop))
        yield rows, squared(one.points[rows][:, None, :] - theirs[None, :, :]) <= one.limit


def near_counts(asking: np.ndarray, points: np.ndarray, eps: float, pairs: int) -> np.ndarray:
    """How many of the points are within eps of each asking one."""
    one, other = Blocks(asking, eps), Blocks(points, eps)
    counts, sizes = np.zeros(len(asking), np.int64), np.diff(other.bounds)
    for a, whole, some in _facing(one, other):
        counts[one.span(a)] += sizes[whole].sum()
        for b in some.tolist():
            for rows, inside in _inside(one, a, other, b, pairs):
                counts[rows] += inside.sum(1)
    out = np.empty_like(counts)
    out[one.order] = counts
    return out


def least_near(asking: np.ndarray, points: np.ndarray, numbers: np.ndarray, eps: float, pairs: int) -> np.ndarray:
    """The smallest number of a point within eps of each asking one; the greatest integer where there is none."""
    one, other = Blocks(asking, eps), Blocks(points, eps)
    none = np.iinfo(np.int64).max
    best, numbers = np.full(len(asking), none), numbers[other.order]
    smallest = np.minimum.reduceat(numbers, other.bounds[:-1]) if len(points) else numbers
    for a, whole, some in _facing(one, other):
        if len(whole):
            best[one.span(a)] = np.minimum(best[one.span(a)], smallest[whole].min())
        for b in some.tolist():
            if smallest[b] >= best[one.span(a)].max():
                continue
            for rows, inside in _inside(one, a, other, b, pairs):
                best[rows] = np.minimum(best[rows], np.where(inside, numbers[other.span(b)][None, :], none).min(1))
    out = np.empty_like(best)
    out[one.order] = best
    return out


def ties(points: np.ndarray, clusters: np.ndarray, others: np.ndarray, their_clusters: np.ndarray, eps: float, pairs: int) -> list[tuple[int, int]]:
    """Pairs of clusters, one of either set of core points, that tie together all clusters with points within eps of each other."""
    one, other = Blocks(points, eps), Blocks(others, eps)
    names, at = np.unique(np.concatenate((clusters[one.order], their_clusters[other.order])), return_inverse=True)
    mine, theirs = at[: len(points)], at[len(points) :]
    root = np.arange(len(names))
    found: list[tuple[int, int]] = []
    starts = other.bounds[:-1]
    for a, whole, some in _facing(one, other):
        own = mine[one.span(a)]
        low, high = np.minimum.reduceat(root[theirs], starts), np.maximum.reduceat(root[theirs], starts)
        for b in np.concatenate((whole, some)).tolist():
            here = root[own]
            if (here == here[0]).all() and low[b] == high[b] == here[0]:
                continue  # one cluster already
            far = theirs[other.span(b)]
            if (here == here[0]).all() and (root[far] == here[0]).all():
                continue
            for rows, inside in _inside(one, a, other, b, pairs):
                i, j = np.nonzero(inside)
                for x, y in set(zip(mine[rows][i].tolist(), far[j].tolist(), strict=True)):
                    if root[x] != root[y]:
                        found.append((int(names[x]), int(names[y])))
                        root[root == root[x]] = root[y]
    return found
