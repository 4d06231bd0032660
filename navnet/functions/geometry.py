"""Planar geometry as Column expressions; projections and geodesics as Arrow functions.

A line is an array of struct(x, y). Points are struct(x, y).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = "struct<x:double,y:double>"


def point(x: Column | float, y: Column | float) -> Column:
    f = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("double")
    return F.struct(f(x).alias("x"), f(y).alias("y"))


def parse_wkt_line(wkt: Column) -> Column:
    """The points of a LINESTRING or POINT text; null for other texts."""
    body = F.regexp_extract(wkt, r"^\s*(?:LINESTRING|POINT)\s*Z?\s*\(([^()]*)\)\s*$", 1)
    pairs = F.transform(F.split(F.trim(body), r"\s*,\s*"), lambda p: F.split(p, r"\s+"))
    return F.when(body != "", F.transform(pairs, lambda p: point(p[0].try_cast("double"), p[1].try_cast("double"))))


def to_wkt_line(line: Column) -> Column:
    text = F.array_join(F.transform(line, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", ")
    return F.concat(F.lit("LINESTRING ("), text, F.lit(")"))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2))


def _segments(line: Column) -> Column:
    return F.zip_with(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, 2, F.greatest(F.size(line), F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def line_length(line: Column) -> Column:
    return F.aggregate(_segments(line), F.lit(0.0), lambda s, g: s + distance(g["a"], g["b"]))


def _share(p: Column, g: Column) -> Column:
    """Where along a segment the nearest point to p is, 0 to 1."""
    dx, dy = g["b"]["x"] - g["a"]["x"], g["b"]["y"] - g["a"]["y"]
    along = (p["x"] - g["a"]["x"]) * dx + (p["y"] - g["a"]["y"]) * dy
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(along, dx * dx + dy * dy))), F.lit(0.0))


def _at(g: Column, share: Column) -> Column:
    return point(g["a"]["x"] + share * (g["b"]["x"] - g["a"]["x"]), g["a"]["y"] + share * (g["b"]["y"] - g["a"]["y"]))


def point_line_distance(p: Column, line: Column) -> Column:
    return F.array_min(F.transform(_segments(line), lambda g: distance(p, _at(g, _share(p, g)))))


def segments(line: Column) -> Column:
    """The segments of a line: an array of struct(a, b)."""
    return _segments(line)


def _side(a: Column, b: Column, p: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"]))


def line_distance(one: Column, other: Column) -> Column:
    """The least distance between two lines: 0 where they cross, else from a point of one to the other."""
    cross = lambda g, h: (_side(g["a"], g["b"], h["a"]) * _side(g["a"], g["b"], h["b"]) < 0) & (_side(h["a"], h["b"], g["a"]) * _side(h["a"], h["b"], g["b"]) < 0)
    crossing = F.exists(_segments(one), lambda g: F.exists(_segments(other), lambda h: cross(g, h)))
    ends = F.least(F.array_min(F.transform(one, lambda p: point_line_distance(p, other))), F.array_min(F.transform(other, lambda p: point_line_distance(p, one))))
    return F.when(crossing, F.lit(0.0)).otherwise(ends)


def point_region_distance(p: Column, ring: Column) -> Column:
    """0 inside a closed ring (a ray from p crosses it an odd number of times), else the distance to it."""
    across = lambda g: ((g["a"]["y"] > p["y"]) != (g["b"]["y"] > p["y"])) & (p["x"] < (g["b"]["x"] - g["a"]["x"]) * (p["y"] - g["a"]["y"]) / F.nullif(g["b"]["y"] - g["a"]["y"], F.lit(0.0)) + g["a"]["x"])
    inside = F.size(F.filter(_segments(ring), across)) % 2 == 1
    return F.when(inside, F.lit(0.0)).otherwise(point_line_distance(p, ring))


def oriented(p: Column, a: Column, b: Column, off: Column) -> Column:
    """The point at `off` from p in the direction from a to b; p itself where a and b are one."""
    span = F.nullif(distance(a, b), F.lit(0.0))
    return point(p["x"] + F.coalesce(off * (b["x"] - a["x"]) / span, F.lit(0.0)), p["y"] + F.coalesce(off * (b["y"] - a["y"]) / span, F.lit(0.0)))


def parts_distance(p: Column, parts: Column) -> Column:
    """The least distance of a point to the lines of an array."""
    return F.array_min(F.transform(parts, lambda line: point_line_distance(p, line)))


def project(line: Column, p: Column) -> Column:
    """Length along the line to its point nearest to p (the first of equals)."""
    start = F.struct(F.lit(0.0).alias("done"), F.lit(float("inf")).alias("best"), F.lit(0.0).alias("at"))

    def step(acc: Column, g: Column) -> Column:
        size, s = distance(g["a"], g["b"]), _share(p, g)
        d = distance(p, _at(g, s))
        near = d < acc["best"]
        return F.struct((acc["done"] + size).alias("done"), F.when(near, d).otherwise(acc["best"]).alias("best"), F.when(near, acc["done"] + s * size).otherwise(acc["at"]).alias("at"))

    return F.aggregate(_segments(line), start, step, lambda acc: acc["at"])


def interpolate(line: Column, at: Column) -> Column:
    """The point at a length along the line, its ends beyond them."""
    start = F.struct(F.lit(0.0).alias("done"), line[0].alias("p"))

    def step(acc: Column, g: Column) -> Column:
        size = distance(g["a"], g["b"])
        share = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(at - acc["done"], size))), F.lit(0.0))
        return F.struct((acc["done"] + size).alias("done"), F.when(at > acc["done"], _at(g, share)).otherwise(acc["p"]).alias("p"))

    return F.aggregate(_segments(line), start, step, lambda acc: acc["p"])


def substring(line: Column, begin: Column, end: Column) -> Column:
    """The line between two lengths along it."""
    start = F.struct(F.lit(0.0).alias("done"), F.expr(f"cast(array() as array<{POINT}>)").alias("out"))

    def step(acc: Column, g: Column) -> Column:
        done = acc["done"] + distance(g["a"], g["b"])
        inside = (done > begin) & (done < end)
        return F.struct(done.alias("done"), F.when(inside, F.array_append(acc["out"], point(g["b"]["x"], g["b"]["y"]))).otherwise(acc["out"]).alias("out"))

    middle = F.aggregate(_segments(line), start, step, lambda acc: acc["out"])
    return F.concat(F.array(interpolate(line, begin)), middle, F.array(interpolate(line, end)))


def cut(line: Column, at: Column) -> Column:
    """struct(before, after): two parts of a line."""
    return F.struct(substring(line, F.lit(0.0), at).alias("before"), substring(line, at, line_length(line)).alias("after"))


def cut_to_point(line: Column, p: Column) -> Column:
    """struct(before, after, before_empty, after_empty): a line cut where it is nearest to p, both ends there moved to p. A
    part that the cut leaves nothing of goes straight between the line's end and p, and is marked empty."""
    at, size = project(line, p), line_length(line)
    parts = cut(line, at)
    before = F.when(at <= 0, F.array(line[0], p)).otherwise(F.concat(F.slice(parts["before"], F.lit(1), F.size(parts["before"]) - 1), F.array(p)))
    after = F.when(at >= size, F.array(p, F.element_at(line, -1))).otherwise(F.concat(F.array(p), F.slice(parts["after"], F.lit(2), F.size(parts["after"]))))
    return F.struct(before.alias("before"), after.alias("after"), (at <= 0).alias("before_empty"), (at >= size).alias("after_empty"))


def centroid(ring: Column) -> Column:
    """Of a closed ring, by area; of a degenerate one, the mean of its points."""
    area = F.aggregate(_segments(ring), F.lit(0.0), lambda s, g: s + (g["a"]["x"] * g["b"]["y"] - g["b"]["x"] * g["a"]["y"]))
    cross = lambda k: F.aggregate(_segments(ring), F.lit(0.0), lambda s, g: s + (g["a"][k] + g["b"][k]) * (g["a"]["x"] * g["b"]["y"] - g["b"]["x"] * g["a"]["y"]))
    mean = lambda k: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[k]) / F.size(ring)
    return F.when(area == 0, point(mean("x"), mean("y"))).otherwise(point(F.try_divide(cross("x"), 3 * area), F.try_divide(cross("y"), 3 * area)))


def bbox(line: Column) -> Column:
    low, high = lambda k: F.array_min(F.transform(line, lambda p: p[k])), lambda k: F.array_max(F.transform(line, lambda p: p[k]))
    return F.struct(low("x").alias("xmin"), low("y").alias("ymin"), high("x").alias("xmax"), high("y").alias("ymax"))


def degrees_to_metres(d: Column) -> Column:
    return d * 111320.0


# Ellipsoids: fixed values of WGS84 and Bessel 1841 (semi-major axis, flattening).
WGS84, BESSEL = (6378137.0, 1 / 298.257223563), (6377397.155, 1 / 299.1528128)
#: Position vector shift from the national datum to WGS84: metres, arc seconds, parts per million (EPSG:28992).
SHIFT = (565.2369, 50.0087, 465.658, -0.40685733032239757, 0.3507326765425626, -1.8703473836067956, 4.0812)


def geodesic_inverse(lon1, lat1, lon2, lat2):
    """Metres between points of WGS84 by Vincenty's inverse formula, for arrays; the bearing at the first in degrees."""
    a, f = WGS84
    b = a * (1 - f)
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, float)) for v in (lon1, lat1, lon2, lat2))
    u1, u2, gap = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2)), lon2 - lon1
    lam = gap.copy()
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(60):
            sin_s = np.hypot(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam))
            cos_s = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0.0, np.cos(u1) * np.cos(u2) * np.sin(lam) / np.where(sin_s == 0, 1, sin_s))
            cos2 = 1 - sin_a**2
            mid = np.where(cos2 == 0, 0.0, cos_s - 2 * np.sin(u1) * np.sin(u2) / np.where(cos2 == 0, 1, cos2))
            c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
            new = gap + (1 - c) * f * sin_a * (sigma + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1)))
            if np.nanmax(np.abs(new - lam), initial=0.0) < 1e-13:
                lam = new
                break
            lam = new
    k = cos2 * (a * a - b * b) / (b * b)
    big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    turn = small * sin_s * (mid + small / 4 * (cos_s * (2 * mid**2 - 1) - small / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3)))
    bearing = np.degrees(np.arctan2(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam)))
    return b * big * (sigma - turn), bearing


def geodesic_direct(lon, lat, bearing, metres):
    """Longitude and latitude at a bearing and distance, by a short iteration on the inverse formula."""
    lon, lat, bearing, metres = (np.asarray(v, float) for v in (lon, lat, bearing, metres))
    x, y = metres * np.sin(np.radians(bearing)), metres * np.cos(np.radians(bearing))
    to_lat, to_lon = lat + y / 111320.0, lon + x / (111320.0 * np.cos(np.radians(lat)))
    for _ in range(12):
        d, az = geodesic_inverse(lon, lat, to_lon, to_lat)
        dx, dy = x - d * np.sin(np.radians(az)), y - d * np.cos(np.radians(az))
        to_lat, to_lon = to_lat + dy / 111320.0, to_lon + dx / (111320.0 * np.cos(np.radians(to_lat)))
    return to_lon, to_lat


def _to_xyz(lon, lat, ellipsoid):
    a, f = ellipsoid
    e2 = f * (2 - f)
    n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return n * np.cos(lat) * np.cos(lon), n * np.cos(lat) * np.sin(lon), n * (1 - e2) * np.sin(lat)


def _to_geo(x, y, z, ellipsoid):
    a, f = ellipsoid
    e2 = f * (2 - f)
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(6):
        n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(z + e2 * n * np.sin(lat), p)
    return np.arctan2(y, x), lat


def _shifted(x, y, z, sign):
    dx, dy, dz, rx, ry, rz, ppm = SHIFT
    rx, ry, rz = (math.radians(v / 3600) for v in (rx, ry, rz))
    m = 1 + ppm * 1e-6
    r = np.array([[1, -rz, ry], [rz, 1, -rx], [-ry, rx, 1]])
    if sign > 0:
        out = m * np.tensordot(r, np.stack([x, y, z]), 1)
        return out[0] + dx, out[1] + dy, out[2] + dz
    return tuple(np.tensordot(np.linalg.inv(m * r), np.stack([x - dx, y - dy, z - dz]), 1))


class _Stereo:
    """Oblique (double) stereographic projection of the national grid: fixed values of EPSG:28992."""

    LON0, LAT0, K0, X0, Y0 = math.radians(5 + 23 / 60 + 15.5 / 3600), math.radians(52 + 9 / 60 + 22.178 / 3600), 0.9999079, 155000.0, 463000.0

    def __init__(self):
        a, f = BESSEL
        self.e2 = e2 = f * (2 - f)
        self.e = e = math.sqrt(e2)
        s = math.sin(self.LAT0)
        rho, nu = a * (1 - e2) / (1 - e2 * s * s) ** 1.5, a / math.sqrt(1 - e2 * s * s)
        self.r = math.sqrt(rho * nu)
        self.n = math.sqrt(1 + e2 * math.cos(self.LAT0) ** 4 / (1 - e2))
        w1 = ((1 + s) / (1 - s) * ((1 - e * s) / (1 + e * s)) ** e) ** self.n
        chi = (w1 - 1) / (w1 + 1)
        self.c = (self.n + s) * (1 - chi) / ((self.n - s) * (1 + chi))
        w2 = self.c * w1
        self.chi0 = math.asin((w2 - 1) / (w2 + 1))

    def forward(self, lon, lat):
        e, s = self.e, np.sin(lat)
        w = self.c * ((1 + s) / (1 - s) * ((1 - e * s) / (1 + e * s)) ** e) ** self.n
        chi, gap = np.arcsin((w - 1) / (w + 1)), self.n * (lon - self.LON0)
        b = 1 + np.sin(chi) * math.sin(self.chi0) + np.cos(chi) * math.cos(self.chi0) * np.cos(gap)
        k = 2 * self.r * self.K0 / b
        return self.X0 + k * np.cos(chi) * np.sin(gap), self.Y0 + k * (np.sin(chi) * math.cos(self.chi0) - np.cos(chi) * math.sin(self.chi0) * np.cos(gap))

    def inverse(self, x, y):
        x, y = (x - self.X0) / (2 * self.r * self.K0), (y - self.Y0) / (2 * self.r * self.K0)
        rho = np.hypot(x, y)
        c = 2 * np.arctan(rho)
        chi = np.arcsin(np.cos(c) * math.sin(self.chi0) + np.where(rho == 0, 0, y * np.sin(c) * math.cos(self.chi0) / np.where(rho == 0, 1, rho)))
        lon = self.LON0 + np.arctan2(x * np.sin(c), rho * math.cos(self.chi0) * np.cos(c) - y * math.sin(self.chi0) * np.sin(c)) / self.n
        psi = 0.5 * np.log((1 + np.sin(chi)) / (self.c * (1 - np.sin(chi)))) / self.n
        lat = 2 * np.arctan(np.exp(psi)) - math.pi / 2
        for _ in range(8):
            s = np.sin(lat)
            psi_i = np.log(np.tan(lat / 2 + math.pi / 4) * ((1 - self.e * s) / (1 + self.e * s)) ** (self.e / 2))
            lat = lat - (psi_i - psi) * np.cos(lat) * (1 - self.e2 * s * s) / (1 - self.e2)
        return lon, lat


_GRID = _Stereo()


def to_grid(lon, lat):
    """WGS84 degrees to metres of the national grid."""
    xyz = _shifted(*_to_xyz(np.radians(np.asarray(lon, float)), np.radians(np.asarray(lat, float)), WGS84), -1)
    return _GRID.forward(*_to_geo(*xyz, BESSEL))


def from_grid(x, y):
    lon, lat = _GRID.inverse(np.asarray(x, float), np.asarray(y, float))
    lon, lat = _to_geo(*_shifted(*_to_xyz(lon, lat, BESSEL), 1), WGS84)
    return np.degrees(lon), np.degrees(lat)


def to_utm(lon, lat, zone: int = 31):
    """WGS84 degrees to metres of a northern UTM zone (Krüger's series)."""
    a, f = WGS84
    n = f / (2 - f)
    lat, gap = np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float) - (6 * zone - 183))
    e = math.sqrt(f * (2 - f))
    t = np.sinh(np.arctanh(np.sin(lat)) - e * np.arctanh(e * np.sin(lat)))
    xi, eta = np.arctan2(t, np.cos(gap)), np.arctanh(np.sin(gap) / np.hypot(1, t))
    scale = 0.9996 * a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    x = eta + sum(c * np.cos(2 * k * xi) * np.sinh(2 * k * eta) for k, c in enumerate(alpha, 1))
    y = xi + sum(c * np.sin(2 * k * xi) * np.cosh(2 * k * eta) for k, c in enumerate(alpha, 1))
    return 500000.0 + scale * x, scale * y


@F.pandas_udf(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
def grid_point(lon: pd.Series, lat: pd.Series) -> pd.DataFrame:
    x, y = to_grid(lon, lat)
    return pd.DataFrame({"x": x, "y": y})


@F.pandas_udf(T.DoubleType())
def geodesic_metres(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    return pd.Series(geodesic_inverse(lon1, lat1, lon2, lat2)[0])


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("lon1", "lat1", "lon2", "lat2")]))
def geodesic_passage(lon: pd.Series, lat: pd.Series, split_lon: pd.Series, split_lat: pd.Series, merge_lon: pd.Series, merge_lat: pd.Series, metres: pd.Series) -> pd.DataFrame:
    """The two ends of a passage of so many metres around a place, in the bearing from split to merge, on the ellipsoid."""
    bearing = geodesic_inverse(split_lon.to_numpy(float), split_lat.to_numpy(float), merge_lon.to_numpy(float), merge_lat.to_numpy(float))[1]
    half = metres.to_numpy(float) / 2
    a = geodesic_direct(lon.to_numpy(float), lat.to_numpy(float), bearing + 180.0, half)
    b = geodesic_direct(lon.to_numpy(float), lat.to_numpy(float), bearing, half)
    return pd.DataFrame({"lon1": a[0], "lat1": a[1], "lon2": b[0], "lat2": b[1]})
