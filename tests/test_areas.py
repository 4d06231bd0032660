"""Shapes with holes and parts: distances by hand, and the join against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from navnet.functions import areas as A
from navnet.operators import spatial

SQUARE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 8 2, 8 8, 2 8, 2 2))"
TWO = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((20 20, 22 20, 22 22, 20 22, 20 20)))"


def shaped(spark, rows):
    return spark.createDataFrame(rows, "id int, wkt string").select("id", A.parse_wkt(F.col("wkt")).alias("shape"))


@pytest.mark.parametrize(
    ("one", "other", "want"),
    [
        ("POINT (1 1)", SQUARE, 0), ("POINT (5 5)", SQUARE, 3), ("POINT (10 5)", SQUARE, 0), ("POINT (13 14)", SQUARE, 5), ("POINT (21 21)", TWO, 0), ("POINT (10 1)", TWO, 9),
        ("LINESTRING (4 4, 6 6)", SQUARE, 2), ("LINESTRING (-5 5, 15 5)", SQUARE, 0), ("LINESTRING (3 3, 3 7)", "LINESTRING (0 5, 2 5)", 1), ("LINESTRING (0 0, 2 2)", "LINESTRING (0 2, 2 0)", 0),
        ("POLYGON ((3 3, 7 3, 7 7, 3 7, 3 3))", SQUARE, 1), ("POLYGON ((-1 -1, 11 -1, 11 11, -1 11, -1 -1))", SQUARE, 0), ("MULTIPOINT ((50 50), (9 9))", SQUARE, 0), ("MULTILINESTRING ((30 0, 30 5), (12 0, 12 5))", SQUARE, 2),
        ("POINT (1 2)", "POINT (4 6)", 5), ("POINT Z (1 2 9)", "MULTIPOINT (1 2, 7 7)", 0),
    ],
)
def test_distance(spark, one, other, want):
    df = spark.createDataFrame([(one, other)], "a string, b string").select(A.parse_wkt(F.col("a")).alias("a"), A.parse_wkt(F.col("b")).alias("b"))
    a, b = df.select(A.distance("a", "b"), A.distance("b", "a")).first()
    assert a == b == pytest.approx(want)


def test_other_texts_are_no_shape(spark):
    df = spark.createDataFrame([(None,), ("",), ("POINT EMPTY",), ("CIRCLE (1 2)",)], "t string")
    assert [r[0] for r in df.select(A.parse_wkt(F.col("t"))).collect()] == [None] * 4


def shapes(rng, n, spread):
    out = []
    for i in range(n):
        x, y, s = rng.uniform(0, spread), rng.uniform(0, spread), rng.choice([0.1, 1.0, 5.0, 40.0])
        kind = rng.randrange(4)
        if kind == 0:
            out.append((i, f"POINT ({x} {y})"))
        elif kind == 1:
            out.append((i, f"LINESTRING ({x} {y}, {x + s} {y + s / 2}, {x + s} {y - s})"))
        elif kind == 2:
            out.append((i, f"POLYGON (({x} {y}, {x + s} {y}, {x + s} {y + s}, {x} {y + s}, {x} {y}), ({x + s / 4} {y + s / 4}, {x + s / 2} {y + s / 4}, {x + s / 2} {y + s / 2}, {x + s / 4} {y + s / 4}))"))
        else:
            out.append((i, f"MULTIPOINT ({x} {y}, {x + s} {y})"))
    return out


@pytest.mark.parametrize("radius", [0.0, 0.7, 30.0])
def test_area_join_matches_all_pairs(spark, radius):
    """Shapes of all sizes, a dense corner, rows without a shape: every pair once, none missing."""
    rng = random.Random(int(radius * 10))
    left = shapes(rng, 60, 100) + [(i + 100, w) for i, w in shapes(rng, 40, 3)] + [(900, None)]
    right = shapes(rng, 60, 100) + [(i + 100, w) for i, w in shapes(rng, 40, 3)] + [(900, "GARBAGE")]
    a, b = shaped(spark, left).repartition(3), shaped(spark, right).repartition(2)
    got = [(r.left_id, r.right_id, r.distance) for r in spatial.area_join(a, b, radius).collect()]
    every = a.where("shape is not null").crossJoin(b.where("shape is not null").select(F.col("id").alias("r"), F.col("shape").alias("s"))).select("id", "r", A.distance("shape", "s").alias("d"))
    want = {(r.id, r.r): r.d for r in every.collect() if r.d <= radius}
    assert len(got) == len(want) > 40 and {(i, j): d for i, j, d in got} == want and all(math.isfinite(d) for d in want.values())


def test_area_cascade(spark):
    locks = shaped(spark, [(1, "POINT (5 1)"), (2, "POINT (30 5)"), (3, "POINT (500 500)"), (4, None)])
    areas = shaped(spark, [(10, SQUARE), (11, "POLYGON ((32 0, 40 0, 40 10, 32 10, 32 0))"), (12, "POINT (5 2)")])
    got = sorted((r.left_id, r.right_id, r.relation) for r in spatial.area_cascade(locks, areas, 4.0).collect() if r.right_id)
    assert got == [(1, 10, "strict"), (2, 11, "near")]
    assert sorted(r.left_id for r in spatial.area_cascade(locks, areas.limit(0), 4.0).collect()) == [1, 2, 3, 4]
