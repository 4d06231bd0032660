"""Kernels over whole polylines as Arrow functions: every vertex has its measure, the length of the line up to it, and a
batch of lines is worked on at once. Lines are arrays of struct(x, y); a null line gives null."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import geometry as G

LINE = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
#: Pairs of segments that distances() looks at together.
SEGMENT_PAIRS = 1 << 18
_XY = pa.struct([("x", pa.float64()), ("y", pa.float64())])


class Lines:
    """The vertices of a batch of lines, one after another: x, y, of (the line of each), first (its first vertex)."""

    def __init__(self, lines: pa.Array) -> None:
        self.valid = lines.is_valid()
        self.count = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lines.flatten()
        self.x, self.y = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.empty(0) for c in ("x", "y"))
        self.first = np.cumsum(self.count) - self.count
        self.of = np.repeat(np.arange(len(self.count)), self.count)

    def steps(self, between) -> np.ndarray:
        """between(x1, y1, x2, y2) of each vertex and the one before it in its line; 0 at a line's first."""
        out = np.zeros(len(self.x))
        k = np.flatnonzero(self.of[1:] == self.of[:-1]) + 1
        out[k] = between(self.x[k - 1], self.y[k - 1], self.x[k], self.y[k])
        return out

    def lengths(self, between) -> np.ndarray:
        return np.bincount(self.of, self.steps(between), len(self.count)) if len(self.x) else np.zeros(len(self.count))


def _planar(x1, y1, x2, y2):
    return np.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def _on_ellipsoid(x1, y1, x2, y2):
    return G.geodesic_inverse(x1, y1, x2, y2)[0] if len(x1) else np.empty(0)


def _array(offsets: np.ndarray, x: np.ndarray, y: np.ndarray, valid: pa.Array | None = None) -> pa.Array:
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], fields=list(_XY))
    out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), points)
    return out if valid is None else pc.if_else(valid, out, pa.scalar(None, out.type))


@F.arrow_udf(T.DoubleType())
def geodesic_length(lines: pa.Array) -> pa.Array:
    """Metres of a line in degrees of WGS84, along all its vertices on the ellipsoid."""
    own = Lines(lines)
    return pc.if_else(own.valid, pa.array(own.lengths(_on_ellipsoid)), pa.scalar(None, pa.float64()))


def distances(one: Lines, other: Lines, i: np.ndarray, j: np.ndarray, at_most: float = np.inf) -> np.ndarray:
    """The least distances between pairs of lines of two points and more (the i-th of one, the j-th of other), as
    geometry.line_distance(): every segment of one with every segment of the other whose boxes are not farther apart than
    at_most, of many pairs at once, parts of them where they have very many segments. Infinite, or any number over at_most,
    where there is none that near."""
    boxes = [[(np.minimum(v[:-1], v[1:]), np.maximum(v[:-1], v[1:])) for v in (own.x, own.y)] for own in (one, other)]
    m, n = np.maximum(one.count[i] - 1, 0), np.maximum(other.count[j] - 1, 0)
    out = np.full(len(m), np.inf)
    ends = np.cumsum(m * n)
    at = 0
    while at < len(m):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SEGMENT_PAIRS, side="right")))
        pair = np.repeat(np.arange(at, stop), m[at:stop])
        own = np.repeat(one.first[i[at:stop]], m[at:stop]) + np.arange(len(pair)) - np.repeat(np.cumsum(m[at:stop]) - m[at:stop], m[at:stop])
        # For each segment of one, runs of the other's.
        for low in range(0, int(n[at:stop].max(initial=0)), max(1, SEGMENT_PAIRS // max(1, len(pair)))):
            high = np.minimum(n[pair], low + max(1, SEGMENT_PAIRS // max(1, len(pair))))
            size = np.maximum(high - low, 0)
            p, a = np.repeat(pair, size), np.repeat(own, size)
            b = other.first[j[p]] + low + np.arange(len(p)) - np.repeat(np.cumsum(size) - size, size)
            for (low1, high1), (low2, high2) in zip(*boxes, strict=True) if at_most < np.inf else ():
                near = np.flatnonzero((low1[a] - high2[b] <= at_most) & (low2[b] - high1[a] <= at_most))
                p, a, b = p[near], a[near], b[near]
            apart = _apart(*(v[k] for v, k in ((one.x, a), (one.y, a), (one.x, a + 1), (one.y, a + 1), (other.x, b), (other.y, b), (other.x, b + 1), (other.y, b + 1))))
            if len(p):
                first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
                out[p[first]] = np.minimum(out[p[first]], np.minimum.reduceat(apart, first))
        at = stop
    return np.where(np.isnan(out), np.inf, out)


class Crossings:
    """Which lines of two batches cross, of blocks of all pairs: lines of few points, as columns of first points, second points
    and so on (a shorter line's last point stands again, which crosses nothing)."""

    MOST = 8

    def __init__(self, one: Lines, other: Lines) -> None:
        self.sides = []
        for own in (one, other):
            k = own.first + np.minimum(np.arange(int(own.count.max(initial=0)))[:, None], own.count - 1)
            self.sides.append((own.x[k], own.y[k]))

    @classmethod
    def fit(cls, one: Lines, other: Lines) -> bool:
        return 1 < min(one.count.min(initial=2), other.count.min(initial=2)) and max(one.count.max(initial=0), other.count.max(initial=0)) <= cls.MOST

    def of(self, part: slice) -> np.ndarray:
        """A row for each line of this part of one, a column for each line of other."""
        (px, py), (qx, qy) = self.sides
        px, py = px[:, part, None], py[:, part, None]

        def turns(ax, ay, bx, by, points) -> list[tuple[np.ndarray, np.ndarray]]:
            """Whether points stand on the one and on the other side of segments a-b."""
            vx, vy = bx - ax, by - ay
            side = [vx * (y - ay) - vy * (x - ax) for x, y in points]
            return [(t < 0, t > 0) for t in side]

        def parted(t: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
            return [(a[0] & b[1]) | (a[1] & b[0]) for a, b in zip(t, t[1:], strict=False)]

        out = np.zeros((px.shape[1], qx.shape[1]), bool)
        ps, qs = list(zip(px, py, strict=True)), list(zip(qx, qy, strict=True))
        theirs = [parted(turns(*a, *b, ps)) for a, b in zip(qs, qs[1:], strict=False)]  # [their segment][our segment]
        for k, (a, b) in enumerate(zip(ps, ps[1:], strict=False)):
            for mine, own in zip(parted(turns(*a, *b, qs)), theirs, strict=True):
                out |= mine & own[k]
        return out


def _apart(ax, ay, bx, by, cx, cy, dx, dy) -> np.ndarray:
    """Of segments a-b and c-d: 0 where they cross, else the least distance of an end to the other segment."""

    def near(px, py, ax, ay, bx, by):
        vx, vy = bx - ax, by - ay
        size = vx * vx + vy * vy
        share = np.clip(np.divide((px - ax) * vx + (py - ay) * vy, size, out=np.zeros(len(size)), where=size > 0), 0, 1)
        x, y = px - (ax + share * vx), py - (ay + share * vy)
        return np.sqrt(x * x + y * y)

    turn = lambda ax, ay, bx, by, px, py: np.sign((bx - ax) * (py - ay) - (by - ay) * (px - ax))
    cross = (turn(ax, ay, bx, by, cx, cy) * turn(ax, ay, bx, by, dx, dy) < 0) & (turn(cx, cy, dx, dy, ax, ay) * turn(cx, cy, dx, dy, bx, by) < 0)
    ends = np.minimum(np.minimum(near(ax, ay, cx, cy, dx, dy), near(bx, by, cx, cy, dx, dy)), np.minimum(near(cx, cy, ax, ay, bx, by), near(dx, dy, ax, ay, bx, by)))
    return np.where(cross, 0.0, ends)


def with_grid(df: DataFrame, name: str, new: str) -> DataFrame:
    """df with the column `new`: the line of the column `name`, in degrees, in metres of the national grid. A step of its own,
    so that expressions and kernels can build on the column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Lines(batch.column(name))
            made = _array(np.append(0, np.cumsum(own.count)), *G.to_grid(own.x, own.y), own.valid)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, new])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(new, LINE)]))


@F.arrow_udf(LINE)
def from_grid(lines: pa.Array) -> pa.Array:
    own = Lines(lines)
    x, y = G.from_grid(own.x, own.y)
    return _array(np.append(0, np.cumsum(own.count)), x, y, own.valid)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def projections(lines: pa.Array, points: pa.Array) -> pa.Array:
    """The measures of an array's points along a line, as geometry.project(): a batch's points are held against the first
    segments of their lines, then against the second ones, and so on."""
    own, counts = Lines(lines), pc.fill_null(pc.list_value_length(points), 0).to_numpy(zero_copy_only=False)
    flat, line = points.flatten(), np.repeat(np.arange(len(counts)), counts)
    px, py = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.empty(0) for c in ("x", "y"))
    step, best, at, done = own.steps(_planar), np.full(len(px), np.inf), np.zeros(len(px)), np.zeros(len(px))
    i, k = np.arange(len(px)), 1
    while len(i := i[own.count[line[i]] > k]):
        b = own.first[line[i]] + k
        ax, ay, dx, dy = own.x[b - 1], own.y[b - 1], own.x[b] - own.x[b - 1], own.y[b] - own.y[b - 1]
        size2 = dx * dx + dy * dy
        share = np.clip(np.divide((px[i] - ax) * dx + (py[i] - ay) * dy, size2, out=np.zeros(len(i)), where=size2 != 0), 0.0, 1.0)
        d = _planar(ax + share * dx, ay + share * dy, px[i], py[i])
        near = i[d < best[i]]
        at[near] = (done[i] + share * step[b])[d < best[i]]
        best[i] = np.fmin(d, best[i])
        done[i] += step[b]
        k += 1
    measures = pc.if_else(flat.is_valid(), pa.array(at), pa.scalar(None, pa.float64()))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), measures)


@F.arrow_udf(T.ArrayType(LINE))
def pieces(lines: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
    """The parts of a line between the measures of two arrays, in their order: the points at both measures (the line's ends
    beyond them), and its vertices strictly between. One pass over the batch's vertices and one search for all cuts."""
    own, spans = Lines(lines), pc.fill_null(pc.list_value_length(begins), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    spans = np.where(own.count > 0, spans, 0)
    keep = np.repeat(own.count > 0, pc.fill_null(pc.list_value_length(begins), 0).to_numpy(zero_copy_only=False))
    line = np.repeat(np.arange(len(spans)), spans)
    total = np.cumsum(own.steps(_planar))
    measure = total - total[own.first[own.of]] if len(total) else total
    low = own.first[line]
    high = low + own.count[line]
    b, e = (np.clip(x.flatten().to_numpy(zero_copy_only=False).astype(np.float64)[keep], 0, measure[high - 1] if len(high) else 0) for x in (begins, ends))
    after_b, from_e = _place(measure, low, high, b, True), _place(measure, low, high, e, False)
    inner = np.maximum(from_e - after_b, 0)
    offsets = np.append(0, np.cumsum(inner + 2))
    x, y = np.empty(offsets[-1]), np.empty(offsets[-1])
    for place, at, where in ((offsets[:-1], b, after_b), (offsets[1:] - 1, e, from_e)):
        k = np.clip(where, low + (own.count[line] > 1), high - 1)
        size = measure[k] - measure[np.maximum(k - 1, low)]
        share = np.clip(np.divide(at - measure[np.maximum(k - 1, low)], size, out=np.zeros(len(k)), where=size > 0), 0, 1)
        for out, c in ((x, own.x), (y, own.y)):
            a = c[np.maximum(k - 1, low)]
            out[place] = a + share * (c[k] - a)
    if len(line):
        source = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner) + np.repeat(after_b, inner)
        target = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner) + np.repeat(offsets[:-1] + 1, inner)
        x[target], y[target] = own.x[source], own.y[source]
    parts = _array(offsets, x, y)
    out = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(spans)), pa.int32()), parts)
    return pc.if_else(own.valid, out, pa.scalar(None, out.type))


def _place(measure: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, beyond: bool) -> np.ndarray:
    """By bisection, the first vertex in [low, high) whose measure is at or more (beyond: more); high without one."""
    low, high = low.copy(), high.copy()
    while len(todo := np.flatnonzero(low < high)):
        middle = (low[todo] + high[todo]) >> 1
        short = measure[middle] <= at[todo] if beyond else measure[middle] < at[todo]
        low[todo[short]] = middle[short] + 1
        high[todo[~short]] = middle[~short]
    return low
