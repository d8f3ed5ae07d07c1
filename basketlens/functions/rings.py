"""Validity of polygons: rings that close, do not touch themselves, and nest as they should.

Edges are compared within the cells of a grid, so a ring of many short edges costs its length and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pairs of edges that are compared at once.
_PAIRS = 1 << 20


def _grid_pairs(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of boxes that share a cell, once for each shared cell."""
    extent = (high.max(axis=0) - low.min(axis=0)).max()
    size = max(2 * float((high - low).max(axis=1).mean()), extent / (2 * len(low) ** 0.5 + 1), np.finfo(float).tiny)
    first = np.floor((low - low.min(axis=0)) / size).astype(np.int64)
    last = np.floor((high - low.min(axis=0)) / size).astype(np.int64)
    wide, tall = (last - first + 1).T
    count = wide * tall
    edge = np.repeat(np.arange(len(low)), count)
    inside = np.arange(len(edge)) - np.repeat(np.cumsum(count) - count, count)
    x = first[edge, 0] + inside % wide[edge]
    y = first[edge, 1] + inside // wide[edge]
    cell = x * (int(last[:, 1].max()) + 1) + y
    order = np.argsort(cell, kind="stable")
    cell, edge = cell[order], edge[order]
    alive = np.arange(len(cell))
    step = 1
    while True:
        alive = alive[alive + step < len(cell)]
        alive = alive[cell[alive] == cell[alive + step]]
        if not len(alive):
            return
        for begin in range(0, len(alive), _PAIRS):
            at = alive[begin:begin + _PAIRS]
            a, b = edge[at], edge[at + step]
            yield np.minimum(a, b), np.maximum(a, b)
        step += 1


def _side(o: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sign((a[:, 0] - o[:, 0]) * (b[:, 1] - o[:, 1]) - (a[:, 1] - o[:, 1]) * (b[:, 0] - o[:, 0]))


def _on(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((p >= np.minimum(a, b)) & (p <= np.maximum(a, b))).all(axis=1)


def _inside(point: np.ndarray, ring: np.ndarray) -> bool | None:
    """Even-odd test; None on the ring itself."""
    a, b = ring[:-1], ring[1:]
    p = np.broadcast_to(point, a.shape)
    if ((_side(a, b, p) == 0) & _on(p, a, b)).any():
        return None
    above = (a[:, 1] > point[1]) != (b[:, 1] > point[1])
    a, b = a[above], b[above]
    x = (b[:, 0] - a[:, 0]) * (point[1] - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
    return bool((x > point[0]).sum() % 2)


def _lies_in(ring: np.ndarray, around: np.ndarray) -> bool | None:
    """Whether a ring that does not cross another lies in it, told by its first point off the other."""
    if (ring.max(axis=0) < around.min(axis=0)).any() or (ring.min(axis=0) > around.max(axis=0)).any():
        return False
    for point in ring[:-1]:
        found = _inside(point, around)
        if found is not None:
            return found
    return None


def fault(parts: list[list[np.ndarray]]) -> str | None:
    """The first rule that a polygon of parts, each an outer ring and inner ones, breaks."""
    rings = [r for rings in parts for r in rings]
    part_of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    if any(len(r) < 4 for r in rings):
        return "ring has fewer than four points"
    if any((r[0] != r[-1]).any() for r in rings):
        return "ring is not closed"
    a, b = np.concatenate([r[:-1] for r in rings]), np.concatenate([r[1:] for r in rings])
    if not np.isfinite(a).all():
        return "ordinate is not a number"
    sizes = np.array([len(r) - 1 for r in rings])
    ring = np.repeat(np.arange(len(rings)), sizes)
    place = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for e, f in _grid_pairs(np.minimum(a, b), np.maximum(a, b)):
        same = ring[e] == ring[f]
        apart = place[f] - place[e]
        e, f, same = (v[~(same & ((apart == 1) | (apart == sizes[ring[e]] - 1)))] for v in (e, f, same))
        s1, s2 = _side(a[e], b[e], a[f]), _side(a[e], b[e], b[f])
        s3, s4 = _side(a[f], b[f], a[e]), _side(a[f], b[f], b[e])
        crossing = (s1 * s2 < 0) & (s3 * s4 < 0)
        touching = (((s1 == 0) & _on(a[f], a[e], b[e])) | ((s2 == 0) & _on(b[f], a[e], b[e]))
                    | ((s3 == 0) & _on(a[e], a[f], b[f])) | ((s4 == 0) & _on(b[e], a[f], b[f])))
        if (same & (crossing | touching)).any():
            return "ring touches itself"
        if crossing.any():
            at = np.flatnonzero(crossing)[0]
            return "rings cross" if part_of[ring[e[at]]] == part_of[ring[f[at]]] else "parts overlap"
    for part in parts:
        outer, inner = part[0], part[1:]
        if any(_lies_in(r, outer) is not True for r in inner):
            return "inner ring is not inside the outer one"
        if any(i != j and _lies_in(r, s) for i, r in enumerate(inner) for j, s in enumerate(inner)):
            return "inner ring lies in another one"
    for i, one in enumerate(parts):
        for j, other in enumerate(parts):
            if i != j and _lies_in(one[0], other[0]) and not any(_lies_in(one[0], hole) for hole in other[1:]):
                return "parts overlap"
    return None


def why_invalid(parts: Column) -> Column:
    """The first rule that nested polygon parts break, NULL if none (or no geometry)."""
    @F.arrow_udf("string")
    def told(column: pa.Array) -> pa.Array:
        part_at, rings = column.offsets.to_numpy(), column.values
        ring_at, lines = rings.offsets.to_numpy(), rings.values
        line_at, points = lines.offsets.to_numpy(), lines.values
        x, y = (points.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y"))
        xy = np.column_stack([x, y])
        out = []
        for g in range(len(column)):
            found = None
            if column[g].is_valid and part_at[g + 1] > part_at[g]:
                found = fault([[xy[line_at[i]:line_at[i + 1]] for i in range(ring_at[p], ring_at[p + 1])]
                               for p in range(part_at[g], part_at[g + 1])])
            out.append(found)
        return pa.array(out, pa.string())

    return told(parts)
