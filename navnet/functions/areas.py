"""Shapes of points, lines and polygons with holes and parts: struct(dim, chains). dim is 0, 1 or 2; chains are arrays of
struct(x, y): points, the lines, or all rings of all parts. What is inside an odd number of rings is inside the polygon."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .geometry import POINT, point
from .lines import LINE

SHAPE = f"struct<dim:int,chains:array<array<{POINT}>>>"
TYPE = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("chains", T.ArrayType(LINE))])


def parse_wkt(wkt: Column) -> Column:
    """The shape of a POINT, LINESTRING or POLYGON text or their MULTI forms; a third coordinate is left out. Null for null,
    EMPTY and other texts."""
    name = F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))
    dim = F.when(name.isin("POINT", "MULTIPOINT"), 0).when(name.isin("LINESTRING", "MULTILINESTRING"), 1).when(name.isin("POLYGON", "MULTIPOLYGON"), 2)
    pair = lambda p: F.transform(F.array(F.split(F.trim(p), r"\s+")), lambda c: point(F.try_element_at(c, F.lit(1)).try_cast("double"), F.try_element_at(c, F.lit(2)).try_cast("double")))[0]
    chains = F.transform(F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1), lambda c: F.transform(F.split(c, ","), pair))
    return F.when(dim.isNotNull() & (F.size(chains) > 0), F.struct(dim.alias("dim"), chains.alias("chains")))


def of_points(p: Column) -> Column:
    return F.struct(F.lit(0).alias("dim"), F.array(F.array(p)).alias("chains"))


def bounds(shape: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax)."""
    flat = F.flatten(shape["chains"])
    end = lambda f, c: f(F.transform(flat, lambda p: p[c]))
    return F.struct(end(F.array_min, "x").alias("xmin"), end(F.array_min, "y").alias("ymin"), end(F.array_max, "x").alias("xmax"), end(F.array_max, "y").alias("ymax"))


class _Shapes:
    """A batch of shapes: of each its vertices (n, 2), its segments' ends, and the first vertex of each chain."""

    def __init__(self, shapes: pa.StructArray) -> None:
        self.dim = shapes.field("dim").to_numpy(zero_copy_only=False)
        chains = shapes.field("chains")
        self.outer, rings = chains.offsets.to_numpy(), chains.values
        self.inner, flat = rings.offsets.to_numpy(), rings.values
        self.xy = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")], 1)

    def at(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        edges = self.inner[self.outer[i] : self.outer[i + 1] + 1]
        low, high = edges[0], edges[-1]
        vertices = self.xy[low:high]
        if self.dim[i] == 0:
            none = np.empty((0, 2))
            return vertices, none, none, vertices
        keep = np.ones(max(0, high - low - 1), bool)
        keep[edges[1:-1] - low - 1] = False  # from a chain's last vertex to the next one's first
        return vertices, vertices[:-1][keep], vertices[1:][keep], vertices[edges[:-1][np.diff(edges) > 0] - low]


def _inside(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each point is inside an odd number of the rings that the segments make up."""
    above = (a[None, :, 1] > p[:, None, 1]) != (b[None, :, 1] > p[:, None, 1])
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (b[:, 0] - a[:, 0]) * (p[:, None, 1] - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
    return (above & (p[:, None, 0] < x)).sum(1) % 2 == 1


def _nearest(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> float:
    """The least distance of any point to any segment."""
    if not len(p) or not len(a):
        return np.inf
    d = b - a
    size = (d * d).sum(1)
    share = np.clip(((p[:, None] - a) * d).sum(2) / np.where(size > 0, size, 1), 0, 1)
    off = p[:, None] - a - share[..., None] * d
    return float(np.sqrt((off * off).sum(2).min()))


def _crossing(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> bool:
    side = lambda p, q, r: np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))
    a, b, c, d = a[:, None], b[:, None], c[None], d[None]
    return bool(((side(a, b, c) * side(a, b, d) < 0) & (side(c, d, a) * side(c, d, b) < 0)).any())


def _distance(one: tuple, one_dim: int, other: tuple, other_dim: int) -> float:
    (p, a, b, heads), (q, c, d, starts) = one, other
    if one_dim == 2 and _inside(starts, a, b).any() or other_dim == 2 and _inside(heads, c, d).any():
        return 0.0
    if len(a) and len(c) and _crossing(a, b, c, d):
        return 0.0
    least = min(_nearest(p, c, d), _nearest(q, a, b))
    if one_dim == 0 and other_dim == 0:
        least = float(np.sqrt(((p[:, None] - q) ** 2).sum(2).min()))
    return least


@F.arrow_udf(T.DoubleType())
def distance(left: pa.Array, right: pa.Array) -> pa.Array:
    """The least distance between two shapes: 0 where they touch, cross or one lies in the other."""
    one, other = _Shapes(left), _Shapes(right)
    return pa.array([_distance(one.at(i), one.dim[i], other.at(i), other.dim[i]) for i in range(len(left))], pa.float64())
