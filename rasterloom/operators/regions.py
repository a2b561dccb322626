"""Regions of equal class: components, sieve, adjacency, polygons and shared-edge simplification, over numpy windows.

Regions are 4-connected. A region's id is its first pixel in row order, y * width + x. Pixel (x, y) covers the unit square from
corner (x, y) to (x + 1, y + 1), y growing downward."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

import numpy as np

Ring = list[tuple[int, int]]


def merge_labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component, for nodes 0..n-1 and edges u-v: hooking and pointer jumping, whole arrays at a time."""
    parent = np.arange(n)
    while len(u):
        a, b = parent[u], parent[v]
        low = np.minimum(a, b)
        np.minimum.at(parent, a, low)
        np.minimum.at(parent, b, low)
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        apart = parent[u] != parent[v]
        u, v = u[apart], v[apart]
    return parent


def label(a: np.ndarray) -> np.ndarray:
    """Region ids. Runs of equal pixels along rows are the nodes, so large plain areas cost little."""
    new = np.ones(a.shape, bool)
    new[:, 1:] = a[:, 1:] != a[:, :-1]
    whole = np.int32 if a.size < 2**31 else np.int64
    run = np.cumsum(new.ravel(), dtype=whole).reshape(a.shape)
    run -= 1
    # Where two rows agree over a stretch of one run each, one pixel of it says so.
    same = a[1:] == a[:-1]
    same[:, 1:] &= new[1:, 1:] | new[:-1, 1:] | ~same[:, :-1]
    least = merge_labels(int(run[-1, -1]) + 1, run[:-1][same], run[1:][same])
    return np.flatnonzero(new.ravel()).astype(whole)[least][run]


def sizes_of(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(labels.ravel())
    ids = np.flatnonzero(n)
    return ids, n[ids]


def adjacency(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(region, other region, shared unit edges), each pair once with region < other."""
    found, size = [], labels.size
    for one, two in ((labels[:, :-1], labels[:, 1:]), (labels[:-1], labels[1:])):
        apart = one != two
        x, y = one[apart].astype(np.int64), two[apart].astype(np.int64)
        found.append(np.minimum(x, y) * size + np.maximum(x, y))
    pairs, n = np.unique(np.concatenate(found), return_counts=True)
    return pairs // size, pairs % size, n


def sieve(a: np.ndarray, threshold: int) -> np.ndarray:
    """Regions under threshold pixels take the class of their largest neighbour (the smaller id on a tie), one after the other by size
    and id. A region grows by what it absorbs, and by the neighbours of its new class. None under threshold is left, unless it is all."""
    labels = label(a)
    ids, n = sizes_of(labels)
    u, v, _ = adjacency(labels)
    if not (n < threshold).any() or not len(u):
        return a.copy()
    near: list[set[int]] = [set() for _ in ids]
    for x, y in zip(np.searchsorted(ids, u).tolist(), np.searchsorted(ids, v).tolist(), strict=True):
        near[x].add(y)
        near[y].add(x)
    value, size, first, into = a.ravel()[ids].tolist(), n.tolist(), list(range(len(ids))), list(range(len(ids)))
    heap = [(size[i], i, i) for i in np.flatnonzero(n < threshold).tolist()]
    heapq.heapify(heap)
    while heap:
        held, _, i = heapq.heappop(heap)
        if into[i] != i or size[i] != held or not near[i]:
            continue
        target = min(near[i], key=lambda j: (-size[j], first[j]))
        joined = [i, *(j for j in near[i] if value[j] == value[target])]
        keep = max(joined, key=lambda j: len(near[j]))  # the fewest neighbours are told of another name
        value[keep], size[keep], first[keep] = value[target], sum(size[j] for j in joined), min(first[j] for j in joined)
        for j in joined:
            if j != keep:
                into[j] = keep
                for k in near[j]:
                    near[k].discard(j)
                    if k != keep:
                        near[k].add(keep)
                        near[keep].add(k)
                near[j] = set()
        near[keep].difference_update(joined)
        if size[keep] < threshold:
            heapq.heappush(heap, (size[keep], first[keep], keep))
    for i in range(len(into)):
        top = i
        while into[top] != top:
            top = into[top]
        while into[i] != top:
            into[i], i = top, into[i]
    new = np.zeros(int(ids[-1]) + 1, a.dtype)
    new[ids] = np.array(value, a.dtype)[into]
    return new[labels]


#: The sides of a pixel in the order of a walk around it: top, right, bottom, left. Of each: where its first corner lies, the step along it,
#: the pixel across it and the pixels ahead, beside its own and across.
SIDES = (((0, 0), (1, 0), (0, -1), (1, 0), (1, -1)), ((1, 0), (0, 1), (1, 0), (0, 1), (1, 1)), ((1, 1), (-1, 0), (0, 1), (-1, 0), (-1, 1)), ((0, 1), (0, -1), (-1, 0), (0, -1), (-1, -1)))


def boundary_edges(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, region, next) of all unit edges: the corner where each starts, the region on its right, and the edge that follows it around
    that region. Where two rings touch in a corner each turns right, to its own pixel."""
    h, w = labels.shape
    padded = np.full((h + 2, w + 2), -1, labels.dtype)
    padded[1:-1, 1:-1] = labels
    keys, to, xs, ys, owners = [], [], [], [], []
    for side, (corner, _, across, ahead, beyond) in enumerate(SIDES):
        y, x = np.nonzero(labels != padded[1 + across[1] : 1 + across[1] + h, 1 + across[0] : 1 + across[0] + w])
        own = labels[y, x]
        right, straight = (padded[y + 1 + dy, x + 1 + dx] == own for dx, dy in (ahead, beyond))
        # Own pixel's next side; or the same side of the pixel ahead; or the side before, of the pixel across and ahead.
        step = np.where(right, np.where(straight, 2, 1), 0)
        dx, dy = (np.array([0, ahead[k], beyond[k]])[step] for k in range(2))
        turn = np.array([(side + 1) % 4, side, (side + 3) % 4])[step]
        place = y * w + x
        keys.append(place * 4 + side)
        to.append((place + dy * w + dx) * 4 + turn)
        xs.append((x + corner[0]).astype(np.int32))
        ys.append((y + corner[1]).astype(np.int32))
        owners.append(own)
    keys, to, xs, ys, owners = map(np.concatenate, (keys, to, xs, ys, owners))
    order = np.argsort(keys)
    return xs[order], ys[order], owners[order], np.searchsorted(keys[order], to[order])


def traced(labels: np.ndarray, kept: np.ndarray | None = None) -> dict[int, list[Ring]]:
    """The rings of every region, its outer ring first, then holes: all their corners, or bends and the corners in `kept` only."""
    xs, ys, owners, following = boundary_edges(labels)
    if kept is None:
        wanted = bytes([1]) * len(xs)
    else:
        before = np.empty_like(following)
        before[following] = np.arange(len(following))
        # The step of an edge is where the next one starts, less where it starts itself.
        dx, dy = xs[following] - xs, ys[following] - ys
        wanted = (kept[ys, xs] | (dx != dx[before]) | (dy != dy[before])).astype(np.uint8).tobytes()
    follow, seen = following.tolist(), bytearray(len(following))
    out: dict[int, list[Ring]] = defaultdict(list)
    for first in range(len(follow)):
        if not seen[first]:
            ring, at = [], first
            while not seen[at]:
                seen[at] = 1
                if wanted[at]:
                    ring.append(at)
                at = follow[at]
            out[int(owners[first])].append(list(zip(xs[ring].tolist(), ys[ring].tolist(), strict=True)))
    return {r: sorted(rings, key=lambda ring: (-area2(ring), ring)) for r, rings in out.items()}


def polygonize(labels: np.ndarray) -> dict[int, list[Ring]]:
    """Unit-step rings of every region (corners, first not repeated). Together they cover the window without gaps."""
    return traced(labels)


def area2(ring: Ring) -> int:
    """Twice the signed area; positive for outer rings, negative for holes."""
    if len(ring) < 64:
        return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True))
    x, y = np.array(ring).T
    return (x * np.roll(y, -1) - np.roll(x, -1) * y).sum().item()


def junctions(labels: np.ndarray) -> np.ndarray:
    """Corners where three or more borders meet, or a border meets the window's edge. Shape (height + 1, width + 1)."""
    h, w = labels.shape
    padded = np.full((h + 2, w + 2), -1, labels.dtype)
    padded[1:-1, 1:-1] = labels
    nw, ne, sw, se = padded[:-1, :-1], padded[:-1, 1:], padded[1:, :-1], padded[1:, 1:]
    return ((nw != ne).astype(int) + (sw != se) + (nw != sw) + (ne != se)) > 2


def is_clear(taken: np.ndarray, a: tuple[int, int], b: tuple[int, int], c: tuple[int, int]) -> bool:
    """Whether the closed triangle holds no corner in use but its own three. Row by row, so a long thin one costs its height only."""
    (ax, ay), (bx, by), (cx, cy) = a, b, c
    left, right, top, bottom = min(ax, bx, cx), max(ax, bx, cx) + 1, min(ay, by, cy), max(ay, by, cy) + 1
    if np.count_nonzero(taken[top:bottom, left:right]) <= 3:
        return True
    own = {a, b, c}
    for y in range(top, bottom):
        low, high = math.inf, -math.inf
        for (x0, y0), (x1, y1) in ((a, b), (b, c), (c, a)):
            if y0 == y1:
                if y0 == y:
                    low, high = min(low, x0, x1), max(high, x0, x1)
            elif min(y0, y1) <= y <= max(y0, y1):
                x = x0 + (y - y0) * (x1 - x0) / (y1 - y0)
                low, high = min(low, x), max(high, x)
        first, last = math.ceil(low - 1e-9), math.floor(high + 1e-9)
        held = taken[y, first : last + 1]
        if held.any() and any((first + int(i), y) not in own for i in np.flatnonzero(held)):
            return False
    return True


def visvalingam(line: Ring, tolerance2: float, taken: np.ndarray, straight: set[tuple]) -> Ring:
    """Drops inner points of an open line, least triangle first, while twice its area is at most tolerance2 and the triangle holds no other
    corner in use: a border that moves over no corner crosses none. taken: the corners in use, kept up to date. straight: the ends
    of lines without inner points. So that no ring collapses, a second line of such ends keeps a point, and a closed one two."""
    n = len(line)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive, left = [True] * n, n - 2
    ends = tuple(sorted((line[0], line[-1])))

    def twice(i: int) -> int:
        (ax, ay), (bx, by), (cx, cy) = line[before[i]], line[i], line[after[i]]
        return abs((bx - ax) * (cy - ay) - (cx - ax) * (by - ay))

    heap = [(area, i) for i in range(1, n - 1) if (area := twice(i)) <= tolerance2]
    heapq.heapify(heap)
    while heap:
        area, i = heapq.heappop(heap)
        if not alive[i] or area != twice(i):
            continue
        a, b, c = line[before[i]], line[i], line[after[i]]
        if left <= (2 if ends[0] == ends[1] else ends in straight) or area and not is_clear(taken, a, b, c):
            continue  # it is asked again when a neighbour goes
        alive[i], left = False, left - 1
        taken[b[1], b[0]] = False
        after[before[i]], before[after[i]] = after[i], before[i]
        for j in (before[i], after[i]):
            if 0 < j < n - 1 and (area := twice(j)) <= tolerance2:
                heapq.heappush(heap, (area, j))
    if not left:
        straight.add(ends)
    return [p for p, a in zip(line, alive, strict=True) if a]


def split_ring(ring: Ring, knots: np.ndarray) -> list[Ring]:
    """The ring as open arcs between knots, ends included. A ring without knots is one arc that starts and ends at its least corner, with its far corner as a stop."""
    at = [i for i, (x, y) in enumerate(ring) if knots[y, x]]
    if not at:
        i = ring.index(min(ring))
        turned = ring[i:] + ring[:i]
        far = max(range(len(turned)), key=lambda k: (abs(turned[k][0] - turned[0][0]) + abs(turned[k][1] - turned[0][1]), turned[k]))
        return [turned[: far + 1], turned[far:] + turned[:1]]
    turned = ring[at[0] :] + ring[: at[0]]
    stops = [i - at[0] for i in at] + [len(ring)]
    closed = turned + turned[:1]
    return [closed[a : b + 1] for a, b in zip(stops, stops[1:], strict=False)]


def simplify_coverage(labels: np.ndarray, tolerance_px: float) -> dict[int, list[Ring]]:
    """The regions' rings, each border simplified once, whichever of its two regions asks, so neighbours keep matching edges. The window's edge only loses
    points on straight lines. Borders never cross or touch where they didn't before, and no ring collapses."""
    h, w = labels.shape
    knots = junctions(labels)
    taken = np.zeros(knots.shape, bool)
    done: dict[tuple, Ring] = {}
    order: list[tuple[int, list[list[tuple[tuple, bool]]]]] = []
    for r, rings in traced(labels, knots).items():
        parts = []
        for ring in rings:
            arcs = []
            for line in split_ring(ring, knots):
                forth, back = tuple(line), tuple(line[::-1])
                arcs.append((min(forth, back), forth <= back))
                if arcs[-1][0] not in done:
                    done[arcs[-1][0]] = list(arcs[-1][0])
                    for x, y in line:
                        taken[y, x] = True
            parts.append(arcs)
        order.append((r, parts))
    straight: set[tuple] = {tuple(sorted((k[0], k[-1]))) for k in done if len(k) == 2}
    for key in done:
        on_edge = any(x0 == x1 and x0 in (0, w) or y0 == y1 and y0 in (0, h) for (x0, y0), (x1, y1) in zip(key, key[1:], strict=False))
        if len(key) > 2 and not on_edge:
            done[key] = visvalingam(list(key), 2 * tolerance_px**2, taken, straight)
    return {r: [[p for key, forth in arcs for p in (done[key] if forth else done[key][::-1])[:-1]] for arcs in parts] for r, parts in order}
