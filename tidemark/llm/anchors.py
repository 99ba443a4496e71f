"""Anchors-hierarchy metric trees over integer points, with cached sums, and assignment of whole balls.

A tree is built middle-out: about sqrt(n) anchors take the points that are
nearest to them, each anchor's points become a subtree in the same way, and
the anchors are joined pairwise, smallest joint ball first, up to one root.
Every ball knows its centre, radius, number and sum of points.

``assign`` walks a tree with a list of candidate entries.  A child inherits
its parent's list and strikes the entries whose bisector with the best one
lies beyond the ball.  A ball with one candidate left is owned as a whole: its
sum and number are added without a look at its points.
"""

from __future__ import annotations

import numpy as np

LEAF = 32
#: Pairs of points and candidates whose distances are worked out at once.
PAIRS = 1 << 18


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(1))


def _anchors(points: np.ndarray) -> np.ndarray:
    """The anchor of each point: about sqrt(n) anchors, each new one the point farthest from its own.

    A point closer to its anchor than half the way from there to the new one
    can't change sides, so only the others are looked at.
    """
    n = len(points)
    own, centres = np.zeros(n, np.int64), [points[0]]
    far = _distances(points, points[0])
    for new in range(1, int(np.ceil(np.sqrt(n)))):
        at = int(far.argmax())
        if far[at] == 0:
            break
        between = _distances(np.array(centres), points[at])
        look = np.flatnonzero(2 * far >= between[own])
        nearer = _distances(points[look], points[at])
        moved = nearer < far[look]
        own[look[moved]], far[look[moved]] = new, nearer[moved]
        own[at], far[at] = new, 0.0
        centres.append(points[at])
    return own


def _join(balls: list[tuple]) -> tuple:
    """One tree from balls (size, centre, radius, tree): the pair with the smallest joint ball is joined first."""
    k = len(balls)
    size = np.array([b[0] for b in balls], float)
    centre, radius, tree = np.array([b[1] for b in balls]), np.array([b[2] for b in balls]), [b[3] for b in balls]

    def joint(i: int, others: np.ndarray) -> np.ndarray:
        apart, share = _distances(centre[others], centre[i]), size[others] / (size[i] + size[others])
        return np.maximum(share * apart + radius[i], (1 - share) * apart + radius[others])

    everyone = np.arange(k)
    cost = np.stack([joint(i, everyone) for i in range(k)])
    np.fill_diagonal(cost, np.inf)
    for _ in range(k - 1):
        i, j = divmod(int(cost.argmin()), k)
        radius[i] = cost[i, j]
        total = size[i] + size[j]
        centre[i] = (size[i] * centre[i] + size[j] * centre[j]) / total
        size[i], tree[i] = total, (tree[i], tree[j])
        cost[j], cost[:, j] = np.inf, np.inf
        left = np.flatnonzero(np.isfinite(cost[i]))
        cost[i, left] = cost[left, i] = joint(i, left)
        last = i
    return size[last], centre[last], radius[last], tree[last]


def _grow(points: np.ndarray, at: np.ndarray) -> tuple:
    """(size, centre, radius, tree) of the points ``at``; a leaf is an array of positions, other trees are pairs."""
    own = points[at]
    centre = own.mean(0)
    radius = float(_distances(own, centre).max())
    if len(at) <= LEAF or radius == 0:
        return len(at), centre, radius, at
    side = _anchors(own)
    order = np.argsort(side, kind="stable")
    parts = np.split(at[order], np.flatnonzero(np.diff(side[order])) + 1)
    if len(parts) == 1:
        return len(at), centre, radius, at
    return len(at), centre, radius, _join([_grow(points, part) for part in parts])[3]


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """The tree over the rows of an integer matrix, as arrays; nodes come after their parents.

    ``order`` holds positions so that each node's points are ``first:last``.
    """
    exact = points.astype(np.float64)
    leaves, first, last, parent, depth, leaf = [], [], [], [], [], []
    stack, seen = [(_grow(exact, np.arange(len(points)))[3], -1, 0)], 0
    while stack:
        tree, above, level = stack.pop()
        node = len(parent)
        parent.append(above)
        depth.append(level)
        leaf.append(not isinstance(tree, tuple))
        first.append(seen)
        last.append(-1)
        if leaf[node]:
            leaves.append(tree)
            seen += len(tree)
            last[node] = seen
        else:
            stack += [(tree[1], node, level + 1), (tree[0], node, level + 1)]
    for node in range(len(parent) - 1, 0, -1):
        last[parent[node]] = max(last[parent[node]], last[node])
    order = np.concatenate(leaves)
    first, last = np.array(first), np.array(last)
    held = points[order]
    total = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(held, axis=0, out=total[1:])
    sums = total[last] - total[first]
    radius = np.array([_distances(exact[order[a:b]], c).max() for a, b, c in zip(first, last, sums / (last - first)[:, None])])
    return {"order": order.astype(np.int32), "points": held.astype(np.int32), "first": first, "last": last, "parent": np.array(parent), "depth": np.array(depth), "leaf": np.array(leaf), "sums": sums, "radius": radius}


def _work(tree: dict, entries: np.ndarray) -> type:
    """Doubles where squared distances of integers stay exact in them, else 64-bit integers."""
    most = max(int(np.abs(tree["points"]).max(initial=0)), int(np.abs(entries).max(initial=0)))
    return np.float64 if 4 * most * most * entries.shape[1] < 1 << 53 else np.int64


def _squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows with rows."""
    return (points * points).sum(1)[:, None] + (entries * entries).sum(1) - 2 * (points @ entries.T)


def _owners(tree: dict, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Wholly owned balls, the entry of each, the leaves that are not owned, and a mask of candidates of each of those."""
    radius, parent, depth = tree["radius"], tree["parent"], tree["depth"]
    centre = tree["sums"] / (tree["last"] - tree["first"])[:, None]
    exact = entries.astype(np.float64)
    far = _squared(centre, exact)
    apart = np.sqrt(np.maximum(_squared(exact, exact), 0))
    slack = 1e-9 * (1 + (centre * centre).sum(1).max() + (exact * exact).sum(1).max())
    alive = np.zeros(far.shape, bool)
    # an entry equal to an earlier one never wins a tie, so it is struck from the start
    alive[0, np.unique(entries, axis=0, return_index=True)[1]] = True
    open_, owned, entry, left = np.zeros(len(parent), bool), [], [], []
    for level in range(int(depth.max()) + 1):
        at = np.flatnonzero((depth == level) & open_[parent]) if level else np.zeros(1, np.int64)
        inherited = alive[parent[at]] if level else alive[:1]
        best = np.where(inherited, far[at], np.inf).argmin(1)
        lead = far[at] - far[at, best][:, None]
        listed = inherited & (lead <= 2 * radius[at][:, None] * apart[best] + slack)
        alive[at] = listed
        single = listed.sum(1) == 1
        owned.append(at[single])
        entry.append(best[single])
        open_[at] = ~single & ~tree["leaf"][at]
        left.append(at[~single & tree["leaf"][at]])
    leaves = np.sort(np.concatenate(left))
    return np.concatenate(owned), np.concatenate(entry), leaves, alive[leaves]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first .. first + size of each range, one range after the other."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


def _decide(tree: dict, entries: np.ndarray, leaves: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points of leaves with several candidates: places in the order, nearest entry (ties to the lower) and distance.

    Neighbouring leaves are decided together against the candidates that any of them has.
    """
    kind = _work(tree, entries)
    none = np.inf if kind is np.float64 else np.iinfo(np.int64).max
    size = tree["last"][leaves] - tree["first"][leaves]
    out: list[list] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]]
    for lo, hi in _chunks(size * len(entries)):
        place = _spread(tree["first"][leaves[lo:hi]], size[lo:hi])
        some = np.flatnonzero(lists[lo:hi].any(0))
        far = _squared(tree["points"][place].astype(kind), entries[some].astype(kind))
        far[~np.repeat(lists[lo:hi][:, some], size[lo:hi], 0)] = none
        best = far.argmin(1)
        for column, values in zip(out, (place, some[best], far[np.arange(len(place)), best].astype(np.int64))):
            column.append(values)
    return tuple(np.concatenate(c) for c in out)


def _chunks(work: np.ndarray):
    """Ranges of leaves of about ``PAIRS`` pairs; one leaf at least."""
    total, lo = np.cumsum(work), 0
    while lo < len(work):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, "right")))
        yield lo, hi
        lo = hi


def totals(tree: dict, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points nearest to each entry; owned balls give their cached sums."""
    owned, entry, *rest = _owners(tree, entries)
    count, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    np.add.at(count, entry, tree["last"][owned] - tree["first"][owned])
    np.add.at(sums, entry, tree["sums"][owned])
    place, best, _ = _decide(tree, entries, *rest)
    np.add.at(count, best, 1)
    np.add.at(sums, best, tree["points"][place])
    return count, sums


def assign(tree: dict, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each point, in the order in which the tree got them."""
    owned, entry, *rest = _owners(tree, entries)
    size = tree["last"][owned] - tree["first"][owned]
    place, best = _spread(tree["first"][owned], size), np.repeat(entry, size)
    least = ((tree["points"][place] - entries[best]) ** 2).sum(1)
    code, error = np.empty(len(tree["order"]), np.int64), np.empty(len(tree["order"]), np.int64)
    for at, e, d in ((place, best, least), _decide(tree, entries, *rest)):
        code[tree["order"][at]], error[tree["order"][at]] = e, d
    return code, error
