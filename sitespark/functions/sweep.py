"""Overlay of polygons by a sweep: edges are split where they meet, a sweep line tells what lies on either side of each, and the
edges between inside and outside are joined to rings, outer ones counter-clockwise, holes clockwise.

Coordinates are snapped to a grid of some 2^-46 of their size, so that points computed twice are equal. Plain numpy and Python on the
edges of one pair of shapes; nothing here knows of Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Pairs of edges looked at together.
PAIRS = 1 << 20


def segments_of(rings: list[np.ndarray]) -> np.ndarray:
    """Edges x0, y0, x1, y1 of closed rings; an open one is closed."""
    parts = []
    for r in rings:
        if len(r) > 2:
            r = r if (r[0] == r[-1]).all() else np.vstack([r, r[:1]])
            parts.append(np.hstack([r[:-1], r[1:]]))
    return np.concatenate(parts) if parts else np.empty((0, 4))


def is_convex(ring: np.ndarray) -> bool:
    """Whether a closed ring turns one way only, and around once."""
    if len(ring) < 4 or (ring[0] != ring[-1]).any():
        return False
    d = ring[1:] - ring[:-1]
    d = d[d.any(1)]
    e = np.roll(d, -1, 0)
    turn = d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]
    if not len(d) or (turn < 0).any() and (turn > 0).any() or ((turn == 0) & ((d * e).sum(1) < 0)).any():
        return False
    ways = [np.sign(v[v != 0]) for v in d.T]
    return all(int((v != np.roll(v, 1)).sum()) == 2 for v in ways)


def grid_of(*segments: np.ndarray) -> float:
    most = max((float(np.abs(s).max()) for s in segments if len(s)), default=1.0)
    return 2.0 ** (np.ceil(np.log2(max(most, 1e-300))) - 46)


def candidate_pairs(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i before j, of boxes that meet, some at a time and some more than once: boxes are listed for the cells of a
    grid whose cells are about as large as the boxes."""
    n = len(low)
    if n < 2:
        return
    start, size = low.min(0), np.maximum(high.max(0) - low.min(0), 1e-300)
    mean = np.maximum((high - low).mean(0), size / n)
    cells = np.maximum(size / mean, 1)
    cells = np.maximum((cells / max(1.0, np.sqrt(cells.prod() / (2 * n)))).astype(np.int64), 1)
    while True:
        a, b = (np.minimum((v - start) / size * cells, cells - 1).astype(np.int64) for v in (low, high))
        wide = b - a + 1
        if wide.prod(1).sum() <= 24 * n or (cells == 1).all():
            break
        cells = np.maximum(cells // 2, 1)
    count = wide.prod(1)
    box = np.repeat(np.arange(n), count)
    k = np.arange(len(box)) - np.repeat(np.cumsum(count) - count, count)
    key = (a[box, 0] + k % wide[box, 0]) * cells[1] + a[box, 1] + k // wide[box, 0]
    order = np.lexsort((box, key))
    box, key = box[order], key[order]
    ends = np.searchsorted(key, key, "right")
    after = ends - np.arange(len(box)) - 1  # entries of the same cell behind each
    at = 0
    upto = np.cumsum(after)
    while at < len(box):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        m = after[at:to]
        i = np.repeat(np.arange(at, to), m)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(m) - m, m)
        i, j = box[i], box[j]
        meet = ((low[i] <= high[j]) & (low[j] <= high[i])).all(1)
        yield i[meet], j[meet]
        at = to


def cut_points(s: np.ndarray, grid: float | np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(edge, point) for each place strictly within an edge where another one crosses, touches or ends. grid may be one for each
    edge, and pairs the ones to look at; by default all that meet."""
    if pairs is None:
        pairs = candidate_pairs(np.minimum(s[:, :2], s[:, 2:]) - grid, np.maximum(s[:, :2], s[:, 2:]) + grid)
    grid = np.broadcast_to(grid, len(s))
    edges, points = [], []

    def add(e: np.ndarray, p: np.ndarray) -> None:
        inner = (p != s[e, :2]).any(1) & (p != s[e, 2:]).any(1)
        edges.append(e[inner])
        points.append(p[inner])

    for i, j in pairs:
        for e, f in ((i, j), (j, i)):  # ends of f on e
            d = s[e, 2:] - s[e, :2]
            square = (d * d).sum(1)
            for end in (s[f, :2], s[f, 2:]):
                apart = end - s[e, :2]
                along = (apart * d).sum(1)
                off = np.abs(apart[:, 0] * d[:, 1] - apart[:, 1] * d[:, 0])
                on = (along > 0) & (along < square) & (off <= grid[e] * np.sqrt(square))
                add(e[on], end[on])
        d, f = s[i, 2:] - s[i, :2], s[j, 2:] - s[j, :2]
        cross = d[:, 0] * f[:, 1] - d[:, 1] * f[:, 0]
        apart = s[j, :2] - s[i, :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (apart[:, 0] * f[:, 1] - apart[:, 1] * f[:, 0]) / cross
            u = (apart[:, 0] * d[:, 1] - apart[:, 1] * d[:, 0]) / cross
        hit = (cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        step = grid[i[hit], None]
        p = np.round((s[i[hit], :2] + t[hit, None] * d[hit]) / step) * step
        add(i[hit], p)
        add(j[hit], p)
    return (np.concatenate(edges), np.concatenate(points)) if edges else (np.empty(0, np.int64), np.empty((0, 2)))


def arranged(s: np.ndarray, mask: np.ndarray, grid: float, winding: bool = False, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Edges that meet at their ends only, upwards (or to the right where level), each once; where edges coincide their masks
    cancel by pairs, or with winding their turns are added up. New points move by half a grid step, so a round can bring
    new crossings; a few rounds end that."""
    s = np.round(s / grid) * grid
    for _ in range(rounds):
        keep = (s[:, :2] != s[:, 2:]).any(1)
        s, mask = s[keep], mask[keep]
        turn = (s[:, 1] > s[:, 3]) | (s[:, 1] == s[:, 3]) & (s[:, 0] > s[:, 2])
        s[turn] = s[turn][:, [2, 3, 0, 1]]
        mask = np.where(turn, -mask, mask) if winding else mask
        if len(s):
            order = np.lexsort(s.T[::-1])
            s, mask = s[order], mask[order]
            first = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]).any(1)]))
            s, mask = s[first], (np.add if winding else np.bitwise_xor).reduceat(mask, first)
            s, mask = s[mask != 0], mask[mask != 0]
        e, p = cut_points(s, grid)
        if not len(e):
            break
        d = s[e, 2:] - s[e, :2]
        t = ((p - s[e, :2]) * d).sum(1)
        order = np.lexsort((t, e))
        e, p = e[order], p[order]
        every = np.concatenate([np.arange(len(s)), e, np.arange(len(s))])
        place = np.concatenate([np.zeros(len(s)), np.arange(1, len(e) + 1), np.full(len(s), len(e) + 1)])
        at = np.concatenate([s[:, :2], p, s[:, 2:]])
        order = np.lexsort((place, every))
        every, at = every[order], at[order]
        joint = every[1:] == every[:-1]
        s, mask = np.hstack([at[:-1], at[1:]])[joint], mask[every[:-1][joint]]
    return s, mask


def sides(s: np.ndarray, mask: np.ndarray, winding: bool = False) -> tuple[list[int], list[int]]:
    """For each arranged edge what is on its left and on its right: masks of the shapes that hold these places, or with
    winding how many do.

    Events are the edges' ends from the lowest, at one height from the left; the status lists the edges that cross the
    line, from the left. An edge's left side is its left neighbour's right side, and stays so to its end.
    """
    x0, y0, x1, y1 = (c.tolist() for c in s.T)
    n = len(x0)
    slope = [(x1[e] - x0[e]) / (y1[e] - y0[e]) if y1[e] > y0[e] else float("inf") for e in range(n)]
    events = [(y1[e], x1[e], 0, 0.0, e) for e in range(n)] + [(y0[e], x0[e], 1, slope[e], e) for e in range(n)]
    events.sort()
    masks, left, right, status = mask.tolist(), [0] * n, [0] * n, []

    def place(x: float, y: float) -> int:
        """How many edges of the status lie left of (x, y)."""
        low, high = 0, len(status)
        while low < high:
            mid = (low + high) // 2
            f = status[mid]
            at = x0[f] + (y - y0[f]) * slope[f] if slope[f] != float("inf") else x0[f]
            if at < x:
                low = mid + 1
            else:
                high = mid
        return low

    last, at = None, 0
    for y, x, starts, _, e in events:
        if starts:
            at = at + 1 if last == (x, y) else place(x, y)
            last = (x, y)
            left[e] = right[status[at - 1]] if at else 0
            right[e] = left[e] - masks[e] if winding else left[e] ^ masks[e]
            status.insert(at, e)
        else:
            k = place(x, y)
            for near in (k, k + 1, k - 1, k + 2, k - 2):
                if 0 <= near < len(status) and status[near] == e:
                    del status[near]
                    break
            else:
                status.remove(e)
            last = None
    return left, right


def directed(s: np.ndarray, mask: np.ndarray, keep: Callable[[int], bool]) -> np.ndarray:
    """The arranged edges between what is kept and what isn't, with the kept side on the left."""
    left, right = sides(s, mask)
    inside = np.array([keep(m) for m in range(4)])
    l, r = inside[left] if len(left) else np.empty(0, bool), inside[right] if len(right) else np.empty(0, bool)
    return np.concatenate([s[l & ~r], s[r & ~l][:, [2, 3, 0, 1]]])


def traced(edges: np.ndarray, stop: Callable[[tuple], bool] | None = None) -> list[list[tuple[float, float]]]:
    """Directed edges joined to closed rings. Where several leave a point, the one most to the left is taken, so that areas that
    touch in a point stay apart. With stop, a walk ends at points for which it is true, and pieces between such points are open."""
    starts: dict[tuple, list[int]] = {}
    a, b = [tuple(p) for p in edges[:, :2].tolist()], [tuple(p) for p in edges[:, 2:].tolist()]
    for k, p in enumerate(a):
        starts.setdefault(p, []).append(k)

    def turn(k: int, m: int) -> float:
        ux, uy, vx, vy = b[k][0] - a[k][0], b[k][1] - a[k][1], b[m][0] - a[m][0], b[m][1] - a[m][1]
        return float(np.arctan2(ux * vy - uy * vx, ux * vx + uy * vy))

    used, found = [False] * len(a), []
    heads = [k for k in range(len(a)) if stop is not None and stop(a[k])]
    for head in [*heads, *range(len(a))]:
        if used[head]:
            continue
        ring, k = [a[head]], head
        while not used[k]:
            used[k] = True
            ring.append(b[k])
            if stop is not None and stop(b[k]):
                break
            rest = [m for m in starts.get(b[k], ()) if not used[m]]
            if not rest:
                break
            k = rest[0] if len(rest) == 1 else max(rest, key=lambda m: turn(k, m))
        found.append(ring)
    return found


def straightened(ring: np.ndarray, grid: float) -> np.ndarray:
    """A closed ring, or an open line, without vertices that lie on the line through their neighbours."""
    is_ring = (ring[0] == ring[-1]).all()
    p = ring[:-1] if is_ring else ring
    before, behind = np.roll(p, 1, 0), np.roll(p, -1, 0)
    d = behind - before
    off = np.abs((p[:, 0] - before[:, 0]) * d[:, 1] - (p[:, 1] - before[:, 1]) * d[:, 0])
    ahead = ((p - before) * (behind - p)).sum(1) >= 0
    keep = ~((off <= 2 * grid * np.sqrt((d * d).sum(1))) & ahead)
    if not is_ring:
        keep[[0, -1]] = True
    p = p[keep]
    return np.vstack([p, p[:1]]) if is_ring and len(p) else p


def overlay(a: list[np.ndarray], b: list[np.ndarray], keep: Callable[[bool, bool], bool], grid: float | None = None) -> list[np.ndarray]:
    """Rings of the places for which keep(in a, in b) holds; rings of a and b are filled by the even-odd rule. grid: what
    coordinates are snapped to, by default a grid of their size."""
    ea, eb = segments_of(a), segments_of(b)
    if not len(ea) and not len(eb):
        return []
    grid = grid or grid_of(ea, eb)
    s, mask = arranged(np.concatenate([ea, eb]), np.concatenate([np.full(len(ea), 1), np.full(len(eb), 2)]), grid)
    rings = [straightened(np.array(r), grid) for r in traced(directed(s, mask, lambda m: bool(keep(bool(m & 1), bool(m & 2)))))]
    return [r for r in rings if len(r) > 3]


def united(shapes: list[list[np.ndarray]], grid: float) -> np.ndarray:
    """Directed edges around all that any of the shapes covers, the covered side on the left. Shapes are outlines: outer rings
    counter-clockwise, holes clockwise. One sweep for all of them, by how many cover a place."""
    edges = segments_of([r for rings in shapes for r in rings])
    s, turns = arranged(edges, np.ones(len(edges), np.int64), grid, winding=True)
    left, right = (np.array(x, np.int64) for x in sides(s, turns, winding=True))
    return np.concatenate([s[(left > 0) & (right <= 0)], s[(right > 0) & (left <= 0)][:, [2, 3, 0, 1]]])


def clipped(ring: np.ndarray, axis: int, at: float, below: bool) -> np.ndarray:
    """A closed ring's part on one side of a line; where it leaves and comes back it runs along the line, there and back if need
    be. Where an edge crosses the line depends on the edge and the line only, not on the side or the direction."""
    side = ring[:, axis] - at
    side = side if below else -side
    if (side <= 0).all():
        return ring
    if (side >= 0).all():
        return ring[:0]
    a, b = ring[:-1], ring[1:]
    cross = (side[:-1] < 0) & (side[1:] > 0) | (side[:-1] > 0) & (side[1:] < 0)
    swap = (a[:, axis] > b[:, axis])[:, None]
    low, high = np.where(swap, b, a)[cross], np.where(swap, a, b)[cross]
    points = np.empty((len(low), 2))
    points[:, axis] = at
    points[:, 1 - axis] = low[:, 1 - axis] + (at - low[:, axis]) * (high[:, 1 - axis] - low[:, 1 - axis]) / (high[:, axis] - low[:, axis])
    keep = side[:-1] <= 0
    number = np.concatenate([np.flatnonzero(keep) * 2, np.flatnonzero(cross) * 2 + 1])
    out = np.concatenate([a[keep], points])[np.argsort(number, kind="stable")]
    return np.vstack([out, out[:1]]) if len(out) > 2 else ring[:0]


def in_cells(rings: list[np.ndarray], size: float) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """A shape cut into the cells of a grid: (column, row, rings), by halving, so that an edge is looked at a few times only."""
    rings = [r for r in rings if len(r) > 3]
    if not rings:
        return
    low, high = np.min([r.min(0) for r in rings], 0), np.max([r.max(0) for r in rings], 0)
    first = np.floor(low / size).astype(np.int64)
    todo = [(first, np.maximum(np.ceil(high / size).astype(np.int64), first + 1), rings)]
    while todo:
        a, b, held = todo.pop()
        if (b - a == 1).all():
            yield int(a[0]), int(a[1]), held
            continue
        axis = int(np.argmax(b - a))
        middle = (a[axis] + b[axis]) // 2
        for below in (True, False):
            part = [c for r in held if len(c := clipped(r, axis, float(middle * size), below)) > 3]
            if part:
                to, start = b.copy(), a.copy()
                (to if below else start)[axis] = middle
                todo.append((start, to, part))


# Distances --------------------------------------------------------------------------------------------------------------


def _point_gaps(points: np.ndarray, edges: np.ndarray) -> float:
    d = edges[:, 2:] - edges[:, :2]
    apart = points[:, None] - edges[None, :, :2]
    t = np.clip((apart * d).sum(2) / np.maximum((d * d).sum(1), 1e-300), 0, 1)
    return float(np.sqrt(((apart - t[..., None] * d) ** 2).sum(2)).min())


def _pair_gap(a: np.ndarray, b: np.ndarray) -> float:
    """The least distance between edges, 0 where any cross."""
    d, f = a[:, None, 2:] - a[:, None, :2], b[None, :, 2:] - b[None, :, :2]
    cross = d[..., 0] * f[..., 1] - d[..., 1] * f[..., 0]
    apart = b[None, :, :2] - a[:, None, :2]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (apart[..., 0] * f[..., 1] - apart[..., 1] * f[..., 0]) / cross
        u = (apart[..., 0] * d[..., 1] - apart[..., 1] * d[..., 0]) / cross
    if ((cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)).any():
        return 0.0
    return min(_point_gaps(a.reshape(-1, 2), b), _point_gaps(b.reshape(-1, 2), a))


def _blocks(e: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Edges in boxes of `size`, halved along the longer side until they fit; and the boxes' bounds."""
    todo, out = [e], []
    while todo:
        x = todo.pop()
        if len(x) <= size:
            out.append(x)
            continue
        mid = x[:, :2] + x[:, 2:]
        axis = int(np.argmax(np.ptp(mid, axis=0)))
        order = np.argsort(mid[:, axis], kind="stable")
        todo += [x[order[: len(x) // 2]], x[order[len(x) // 2 :]]]
    bounds = np.array([(*np.minimum(x[:, :2], x[:, 2:]).min(0), *np.maximum(x[:, :2], x[:, 2:]).max(0)) for x in out])
    return out, bounds


def edge_distance(a: np.ndarray, b: np.ndarray, size: int = 48) -> float:
    """The least distance between two sets of edges: pairs of blocks by the distance of their bounds, until none can be nearer."""
    (xa, ba), (xb, bb) = _blocks(a, size), _blocks(b, size)
    best, heap = np.inf, []
    for i, x in enumerate(ba):
        gap = np.maximum(0, np.maximum(bb[:, :2] - x[2:], x[:2] - bb[:, 2:]))
        heap.append(np.hypot(gap[:, 0], gap[:, 1]))
        j = int(np.argmin(heap[-1]))
        if heap[-1][j] < best:
            best = min(best, _pair_gap(xa[i], xb[j]))
        if best == 0:
            return 0.0
    for i, far in enumerate(heap):
        for j in np.flatnonzero(far < best):
            if far[j] < best:
                best = min(best, _pair_gap(xa[i], xb[j]))
    return float(best)
