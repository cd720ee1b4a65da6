"""The overlay of functions.sweep for many small pairs of shapes at once: a column's edges in flat arrays, each with its row. Edges
are split where they meet, a ray from the middle of each tells what lies beside it, and next edges give the rings.

Rows with many edges, and the few whose edges don't link up after rounding, are named to the caller, who sweeps them one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute

from . import sweep

#: Edges of a row that is swept by itself, and pairs of edges looked at together.
MANY, PAIRS = 64, 1 << 19


class Shapes(NamedTuple):
    """Vertices of all rings, how many each ring has, how many rings each row has."""

    flat: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray


def _before(n: np.ndarray) -> np.ndarray:
    return np.cumsum(n) - n


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each of n."""
    return np.arange(n.sum()) - np.repeat(_before(n), n)


def read(column: pa.Array) -> Shapes:
    rings = column.flatten()
    points = rings.flatten()
    flat = np.column_stack([points.field(c).to_numpy(zero_copy_only=False) for c in "xy"]) if len(points) else np.empty((0, 2))
    long = lambda c: pa.compute.fill_null(pa.compute.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return Shapes(flat, long(rings), long(column))


def write(s: Shapes) -> pa.Array:
    points = pa.StructArray.from_arrays([pa.array(s.flat[:, k], pa.float64()) for k in range(2)], names=["x", "y"])
    ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    return pa.ListArray.from_arrays(ends(s.counts), pa.ListArray.from_arrays(ends(s.sizes), points))


def taken(s: Shapes, rows: np.ndarray) -> Shapes:
    """Rows by their numbers, each as often as it is named."""
    ring = np.repeat(_before(s.counts)[rows], s.counts[rows]) + _within(s.counts[rows])
    point = np.repeat(_before(s.sizes)[ring], s.sizes[ring]) + _within(s.sizes[ring])
    return Shapes(s.flat[point], s.sizes[ring], s.counts[rows])


def none(rows: int) -> Shapes:
    return Shapes(np.empty((0, 2)), np.empty(0, np.int64), np.zeros(rows, np.int64))


def edges_of(s: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """(row, edge) of all rings; open ones are closed."""
    use = s.sizes > 2
    row, start, sizes = np.repeat(np.arange(len(s.counts)), s.counts)[use], _before(s.sizes)[use], s.sizes[use]
    n = sizes - (s.flat[start] == s.flat[start + sizes - 1]).all(1)
    k, ring = _within(n), np.repeat(np.arange(len(n)), n)
    a = start[ring] + k
    return row[ring], np.hstack([s.flat[a], s.flat[np.where(k + 1 < sizes[ring], a + 1, start[ring])]])


def areas(s: Shapes) -> np.ndarray:
    """Of each row's outlines, holes counting off."""
    ring = np.repeat(np.arange(len(s.sizes)), s.sizes)
    x, y = (s.flat - s.flat[_before(s.sizes)[ring]]).T if len(ring) else np.empty((2, 0))
    joint = ring[1:] == ring[:-1]
    twice = np.bincount(ring[:-1][joint], (x[:-1] * y[1:] - x[1:] * y[:-1])[joint], len(s.sizes))
    return np.abs(np.bincount(np.repeat(np.arange(len(s.counts)), s.counts), twice, len(s.counts)) / 2)


def _pairs(row: np.ndarray, every: bool):
    """Pairs (i, j) of edges of a row, some at a time: of sorted rows i before j, or with every all but i itself."""
    start, end = np.searchsorted(row, row), np.searchsorted(row, row, "right")
    at = np.arange(len(row))
    n = end - start - 1 if every else end - at - 1
    upto, k = np.cumsum(n), 0
    while k < len(row):
        to = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PAIRS, "right")))
        i, off = np.repeat(at[k:to], n[k:to]), _within(n[k:to])
        j = start[i] + off if every else i + 1 + off
        yield i, j + (j >= i) if every else j
        k = to


def _arranged(row: np.ndarray, s: np.ndarray, mask: np.ndarray, grid: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """sweep.arranged of each row: rows without a further cut are done."""
    done = []
    for _ in range(rounds):
        s = np.round(s / grid[row, None]) * grid[row, None]
        keep = (s[:, :2] != s[:, 2:]).any(1)
        row, s, mask = row[keep], s[keep], mask[keep]
        if not len(s):
            break
        turn = (s[:, 1] > s[:, 3]) | (s[:, 1] == s[:, 3]) & (s[:, 0] > s[:, 2])
        s = np.where(turn[:, None], s[:, [2, 3, 0, 1]], s)
        order = np.lexsort((*s.T[::-1], row))
        row, s, mask = row[order], s[order], mask[order]
        first = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]).any(1) | (row[1:] != row[:-1])]))
        row, s, mask = row[first], s[first], np.bitwise_xor.reduceat(mask, first)
        row, s, mask = row[mask != 0], s[mask != 0], mask[mask != 0]
        low, high = np.minimum(s[:, :2], s[:, 2:]) - grid[row, None], np.maximum(s[:, :2], s[:, 2:]) + grid[row, None]
        near = ((i[m], j[m]) for i, j in _pairs(row, False) for m in [((low[i] <= high[j]) & (low[j] <= high[i])).all(1)])
        e, p = sweep.cut_points(s, grid[row], near)
        again = np.zeros(len(grid), bool)
        again[row[e]] = True
        rest = again[row]
        done.append((row[~rest], s[~rest], mask[~rest]))
        if not len(e):
            row, s, mask = row[:0], s[:0], mask[:0]
            break
        t = ((p - s[e, :2]) * (s[e, 2:] - s[e, :2])).sum(1)
        whole = np.flatnonzero(rest)
        every = np.concatenate([whole, e, whole])
        place = np.concatenate([np.full(len(whole), -np.inf), t, np.full(len(whole), np.inf)])
        at = np.concatenate([s[whole, :2], p, s[whole, 2:]])
        order = np.lexsort((place, every))
        every, at = every[order], at[order]
        joint = every[1:] == every[:-1]
        of = every[:-1][joint]
        row, s, mask = row[of], np.hstack([at[:-1], at[1:]])[joint], mask[of]
    done.append((row, s, mask))
    row, s, mask = (np.concatenate(v) for v in zip(*done, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], s[order], mask[order]


def _left(row: np.ndarray, s: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Masks of the shapes on the left of each edge: by a ray to the left, or up where the edge is level."""
    out = np.zeros((2, len(s)), np.int64)
    level = s[:, 1] == s[:, 3]
    # level edges are looked at with x and y exchanged
    mx, my = (s[:, 0] + s[:, 2]) / 2, (s[:, 1] + s[:, 3]) / 2
    for i, j in _pairs(row, True):
        up = level[i]
        a, b = np.where(up, s[j, 0], s[j, 1]), np.where(up, s[j, 2], s[j, 3])
        m = np.where(up, mx[i], my[i])
        hit = np.flatnonzero((a <= m) != (b <= m))
        i, j, up, a, b, m = i[hit], j[hit], up[hit], a[hit], b[hit], m[hit]
        c, d = np.where(up, s[j, 1], s[j, 0]), np.where(up, s[j, 3], s[j, 2])
        at = c + (m - a) * ((d - c) / (b - a))
        i, j = (v[np.where(up, at > my[i], at < mx[i])] for v in (i, j))
        for bit in range(2):
            out[bit] += np.bincount(i[mask[j] >> bit & 1 == 1], minlength=len(s))
    return out[0] % 2 + out[1] % 2 * 2


def _rings(row: np.ndarray, edges: np.ndarray, grid: np.ndarray) -> tuple[Shapes, np.ndarray]:
    """Rings of directed edges, and the rows whose edges don't link up."""
    n, rows = len(row), len(grid)
    bad = np.zeros(rows, bool)
    if not n:
        return none(rows), bad
    ends = np.concatenate([edges[:, :2], edges[:, 2:]])
    both = np.concatenate([row, row])
    order = np.lexsort((ends[:, 1], ends[:, 0], both))
    new = np.concatenate([[False], (ends[order][1:] != ends[order][:-1]).any(1) | (both[order][1:] != both[order][:-1])])
    name = np.empty(2 * n, np.int64)
    name[order] = np.cumsum(new)
    start, end = name[:n], name[n:]
    by, there = np.argsort(start, kind="stable"), np.bincount(start, minlength=2 * n)
    bad[row[there[end] == 0]] = True
    k = np.repeat(np.arange(n), there[end])
    m = by[_before(there)[end[k]] + _within(there[end])]
    u, v = edges[k, 2:] - edges[k, :2], edges[m, 2:] - edges[m, :2]
    several = there[end[k]] > 1
    turn = np.zeros(len(k))
    turn[several] = np.arctan2(u[several, 0] * v[several, 1] - u[several, 1] * v[several, 0], (u[several] * v[several]).sum(1))
    order = np.lexsort((turn, k))
    last = np.concatenate([k[order][1:] != k[order][:-1], [True]])
    follow = np.full(n, -1)
    follow[k[order][last]] = m[order][last]
    taken_ = np.bincount(follow[follow >= 0], minlength=n)
    bad[row[taken_ != 1]] = True
    good = ~bad[row]
    number = np.cumsum(good) - 1
    row, edges, follow = row[good], edges[good], number[follow[good]]
    n = len(row)
    least, jump = np.arange(n), follow.copy()
    while True:
        now = np.minimum(least, least[jump])
        if (now == least).all():
            break
        least, jump = now, jump[jump]
    place, at, step = np.zeros(n, np.int64), np.flatnonzero(least == np.arange(n)), 0
    head = at
    while len(at):
        place[at] = step
        at, step = follow[at], step + 1
        at, head = at[at != head], head[at != head]
    order = np.lexsort((place, least))
    p, ring = edges[order, :2], least[order]
    first = np.flatnonzero(np.concatenate([[True], ring[1:] != ring[:-1]])) if n else np.empty(0, np.int64)
    size = np.diff(np.append(first, n))
    g, of = grid[row[order]], np.repeat(np.arange(len(size)), size)
    k, begin = _within(size), first[of]
    before, behind = p[begin + (k - 1) % size[of]], p[begin + (k + 1) % size[of]]
    d = behind - before
    off = np.abs((p[:, 0] - before[:, 0]) * d[:, 1] - (p[:, 1] - before[:, 1]) * d[:, 0])
    keep = ~((off <= 2 * g * np.sqrt((d * d).sum(1))) & (((p - before) * (behind - p)).sum(1) >= 0))
    left = np.bincount(of[keep], minlength=len(size))
    keep &= left[of] > 2
    p, of, row_of = p[keep], of[keep], row[order][first][left > 2]
    left = left[left > 2]
    # each ring ends where it begins
    first = _before(left)
    where = np.repeat(first, left + 1) + _within(left + 1) % np.repeat(left, left + 1)
    return Shapes(p[where], left + 1, np.bincount(row_of, minlength=rows)), bad


def overlays(a: Shapes, b: Shapes, keeps: list[Callable[[bool, bool], bool]]) -> tuple[list[Shapes], np.ndarray]:
    """For each of keeps, the rings of the places for which keep(in a, in b) holds, of all rows; and the rows left to the sweep,
    which are empty here."""
    rows = len(a.counts)
    (ra, ea), (rb, eb) = edges_of(a), edges_of(b)
    row, s = np.concatenate([ra, rb]), np.concatenate([ea, eb])
    mask = np.concatenate([np.full(len(ra), 1), np.full(len(rb), 2)])
    alone = np.bincount(row, minlength=rows) > MANY
    most = np.full(rows, 0.0)
    np.maximum.at(most, row, np.abs(s).max(1) if len(s) else np.empty(0))
    alone |= ~np.isfinite(most)
    grid = 2.0 ** (np.ceil(np.log2(np.maximum(np.where(np.isfinite(most), most, 1.0), 1e-300))) - 46)
    use = ~alone[row]
    row, s, mask = _arranged(row[use], s[use], mask[use], grid)
    left = _left(row, s, mask)
    right, out = left ^ mask, []
    for keep in keeps:
        inside = np.array([bool(keep(bool(m & 1), bool(m & 2))) for m in range(4)])
        l, r = inside[left] & ~inside[right], inside[right] & ~inside[left]
        of = np.concatenate([row[l], row[r]])
        order = np.argsort(of, kind="stable")
        found, bad = _rings(of[order], np.concatenate([s[l], s[r][:, [2, 3, 0, 1]]])[order], grid)
        alone |= bad
        out.append(found)
    return out, alone
