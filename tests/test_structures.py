import math

import pytest
from pyspark.sql import functions as F

from navnet.functions import geometry as G
from navnet.functions import shapes
from navnet.operators import structures as S


def turned(points, angle):
    c, s = math.cos(angle), math.sin(angle)
    return [(x * c - y * s, x * s + y * c) for x, y in points]


@pytest.mark.parametrize("angle", [0.0, 0.7, 2.0])
def test_doors_follow_the_flow(angle):
    ring = turned([(0, 0), (100, 0), (100, 12), (0, 12)], angle)
    a, b = shapes.doors(ring, *turned([(-50, 6), (150, 6)], angle))
    want = turned([(0, 6), (100, 6)], angle)
    assert a == pytest.approx(want[0], abs=1e-6) and b == pytest.approx(want[1], abs=1e-6)
    a, b = shapes.doors(ring, *turned([(150, 6), (-50, 6)], angle))
    assert a == pytest.approx(want[1], abs=1e-6)
    assert shapes.doors([(0, 0), (1, 1)], (0, 0), (1, 1)) is None


def test_best_section():
    line = [(0, 0), (10, 0)]
    assert shapes.overlap(line, [(4, 0), (20, 0)]) == pytest.approx(6)
    assert shapes.best_section(line, [("a", [(4, 0), (20, 0)]), ("b", [(-5, 0), (9, 0)]), ("c", [(5, -5), (5, 5)])]) == "b"
    assert shapes.best_section(line, [("a", [(5, 2), (5, 9)]), ("b", [(5, -5), (5, 5)])]) == "b"
    with pytest.raises(ValueError):
        shapes.best_section(line, [("a", [])])


def test_split_around_grows_to_openings(spark):
    line = F.array(G.point(F.lit(0.0), F.lit(0.0)), G.point(F.lit(1000.0), F.lit(0.0)))
    df = spark.createDataFrame([([],), ([560.0],), ([980.0],)], "o array<double>")
    got = [(r[0].split_at, r[0].merge_at) for r in df.select(S.split_around(line, F.lit(500.0), F.col("o"), 50)).collect()]
    assert got == [(450.0, 550.0), (340.0, 660.0), (0.0, 1000.0)]


def test_complexes_and_features(spark):
    locks = spark.createDataFrame([(1.0, "L"), (7151.0, "ignored")], "id double, name string")
    chambers = spark.createDataFrame([(11.0, 1.0, 12.0), (12.0, 1.0, 16.0)], "id double, parent_id double, width double")
    subs = spark.createDataFrame([("s1", "11")], "id string, parent_id string")
    own = S.complexes(locks, chambers, "parent_id", subs, "parent_id", ignored=("7151",)).collect()
    assert len(own) == 1 and [(c.id, c.width, [x.id for x in c.subchildren]) for c in own[0].children] == [("11", 12.0, ["s1"]), ("12", 16.0, [])]
    f = S.detailed_features(S.complexes(locks, chambers, "parent_id", ignored=("7151",)), "lock").collect()
    assert len(f) == 12 and ("chamber_11_route", "chamber_11_start", "chamber_11_end") in {(r.id, r.source_node, r.target_node) for r in f}
    b = S.detailed_features(S.complexes(spark.createDataFrame([("9", "B")], "id string, name string"), chambers.where("false"), "parent_id"), "bridge").collect()
    assert "opening_virtual_9_passage" in {r.id for r in b}


def test_embedded_bridges(spark):
    openings = spark.createDataFrame([("op1", "brug west", 0.0, 0.0), ("op2", "brug oost", 100.0, 0.0)], "id string, name string, x double, y double")
    chambers = spark.createDataFrame([("ch1", "kolk oost", 10.0, 0.0), ("ch2", "kolk west", 90.0, 0.0)], "id string, name string, x double, y double")
    pairs = S.embedded(openings, chambers)
    assert {(r.left, r.right) for r in pairs.collect()} == {("op2", "ch1"), ("op1", "ch2")}
    lock = S.detailed_features(S.complexes(spark.createDataFrame([("1",)], "id string"), spark.createDataFrame([("ch1", "1"), ("ch2", "1")], "id string, p string"), "p"), "lock")
    bridge = S.detailed_features(S.complexes(spark.createDataFrame([("2",)], "id string"), spark.createDataFrame([("op1", "2"), ("op2", "2")], "id string, p string"), "p"), "bridge")
    d = spark.createDataFrame([(o, f"chamber_{c}_{e}", v) for o, c in (("op2", "ch1"), ("op1", "ch2")) for e, v in (("route", 1.0), ("approach", 1.0), ("exit", 5.0))], "opening string, edge string, distance double")
    ids = {r.id for r in S.inject(lock.unionByName(bridge), pairs, d).collect()}
    assert {"chamber_ch1_approach_part1", "chamber_ch1_approach_part2", "chamber_ch1_route", "opening_op1_passage"} <= ids
    assert not ids & {"chamber_ch1_approach", "bridge_2_split", "bridge_2_merge", "opening_op1_approach", "opening_op2_exit"}


def test_berths_and_sections(spark):
    locks = spark.createDataFrame([("l", ["1"], 5.0, 52.0)], "id string, fairways array<string>, lon double, lat double")
    berths = spark.createDataFrame([("a", None, "1", 5.0, 52.005), ("b", "WAITING_AREA", "1", 5.0, 52.06), ("c", "OTHER", "1", 5.0, 52.0), ("d", None, "2", 5.0, 52.0)], "id string, category string, fairway_id string, lon double, lat double")
    assert [tuple(r) for r in S.nearby_berths(locks, berths).collect()] == [("l", "a", pytest.approx(556.3, abs=0.1))]
    own = spark.createDataFrame([("l", "s1"), ("m", None)], "id string, section_id string")
    near = spark.createDataFrame([("l", "s1"), ("l", "s2")], "left_id string, right_id string")
    sections = spark.createDataFrame([("s1",), ("s2",)], "id string")
    got = {r.id: [(s.id, s.relation) for s in r.sections] for r in S.related_sections(own, sections, near).collect()}
    assert got == {"l": [("s1", "direct"), ("s2", "overlap")], "m": []}
