"""Networks built from their sources: what SQL doesn't say, errors, and greedy matching against one pass over sorted pairs."""

import random

import pytest
from pyspark.sql import functions as F

from navnet.functions import geometry as G
from navnet.functions import scalars as S
from navnet.operators import compare, components, graph, network, relational, spatial
from navnet.plans.catalogue import QUERIES, Tables

FOLDER = "/root/testdata/sf0.001"


def test_greedy_pairs_are_those_of_one_sorted_pass(spark):
    got = {(r.left, r.right) for r in QUERIES["greedy_pairs"](spark, FOLDER).collect()}
    part = [(r.p_partkey, r.p_name.lower(), r.p_size) for r in Tables(spark, FOLDER).part.collect()]
    pairs = [(a, b, abs(s - z)) for a, n, s in part for b, m, z in part if a % 2 == 1 and b % 2 == 0 and n == m and abs(s - z) <= 3]
    frame = spark.createDataFrame([(a, b, float(d)) for a, b, d in pairs], "left long, right long, distance double")
    scored = frame.select("left", "right", S.name_score(F.lit("x"), F.lit("x"), F.col("distance") * 100).alias("score"), "distance").where("score > 1").collect()
    used, want = (set(), set()), set()
    for r in sorted(scored, key=lambda r: (-r.score, r.distance, r.left, r.right)):
        if r.left not in used[0] and r.right not in used[1]:
            used[0].add(r.left)
            used[1].add(r.right)
            want.add((r.left, r.right))
    assert got == want and want


def test_matching_of_chains_and_giant_parts(spark):
    """A chain in which each pair waits for the one before it: one sorted pass, also where a part is too large for a task."""
    rows = [(i // 2 * 2, (i + 1) // 2 * 2 + 1, 20_000.0 - i, 1.0) for i in range(10_000)]
    chain = spark.createDataFrame([*rows, (None, 1, 1.0, 1.0), (1, None, 1.0, 1.0)], "left long, right long, score double, distance double")
    used, want = (set(), set()), set()
    for a, b, *_ in rows:
        if a not in used[0] and b not in used[1]:
            used[0].add(a)
            used[1].add(b)
            want.add((a, b))
    assert {(r.left, r.right) for r in spatial.greedy_pairs(chain).collect()} == want
    assert {(r.left, r.right) for r in spatial.greedy_pairs(chain.where("score > 19985"), giant=5).collect()} == {(a, b) for a, b in want if 20_000 - a > 19_985}
    assert spatial.greedy_pairs(chain.limit(0)).count() == 0


def test_rounds_that_run_out_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(components, "ROUNDS", 1)
    with pytest.raises(RuntimeError):
        components.components(spark.createDataFrame([(i, i + 1) for i in range(40)], "src long, dst long"))


def test_quartiles_of_many_values(spark):
    """Order statistics by refinement against sorting: ties, one value, negative numbers, nulls, places in between."""
    rng = random.Random(3)
    for values in ([rng.gauss(0, 1e6) for _ in range(3001)], [rng.choice([1.0, 2.0, 2.0, 7.5]) for _ in range(1000)], [5.0] * 40, [-3.0, 1e12, 2.0, 2.0000001], [1.0]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
        ordered = sorted(values)
        places = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
        assert relational.order_values(df, "v", places) == {k: ordered[k] for k in places}
        exact, refined = (relational.describe(df, "v", few).first() for few in (10_000, 0))
        assert tuple(exact) == pytest.approx(tuple(refined), nan_ok=True) if None not in exact else exact.q50 == refined.q50


def test_lengths_on_the_ellipsoid(spark):
    """Whole lines in degrees: a degree of the equator and of a meridian, and a bent line; null without a line."""
    line = "array<struct<x:double,y:double>>"
    p = lambda x, y: {"x": x, "y": y}
    rows = [("a", "b", 1, [p(0.0, 0.0), p(1.0, 0.0)]), ("b", "c", 2, [p(0.0, 0.0), p(0.0, 1.0)]), ("c", "d", 3, [p(5.0, 52.0), p(5.01, 52.0), p(5.01, 52.01)]), ("d", "e", 4, None)]
    sections = spark.createDataFrame(rows, f"start string, end string, ord int, line {line}")
    edges = {r.src: r.length_m for r in graph.build_graph(sections, spark.createDataFrame([("a",)], "id string"), "ord")[1].collect()}
    assert edges["a"] == pytest.approx(111319.4908, abs=1e-3) and edges["b"] == pytest.approx(110574.3886, abs=1e-3) and edges["d"] is None
    assert edges["c"] == pytest.approx(686.72 + 1112.68, abs=0.5)
    nodes = spark.createDataFrame([("n1", "s", None, "L", 1), ("n2", "s", None, "M", 2)], "node_id string, sectionref string, borderpoint string, locode string, ord int")
    own = spark.createDataFrame([("s", rows[0][3])], f"code string, line {line}")
    assert network.foreign_graph(nodes, own, "ord")[1].first().length_m == pytest.approx(111319.4908, abs=1e-3)
    place = spark.createDataFrame([(15, "H", "C1", "NLTE1", 0.0, 0.0)], "id int, name string, code string, unlocode string, x double, y double")
    access = network.harbours(place, spark.createDataFrame([("100", "C1", 0.0, 1.0)], "node string, code string, x double, y double"), 1.0, degrees=True)[1].first()
    assert access.length_m == pytest.approx(110574.3886, abs=1e-3) and access.length == 1.0


def test_numbers_are_not_read_as_texts(spark):
    df = spark.createDataFrame([(-5, "-5"), (7, "km 7.5")], "n int, t string")
    assert [tuple(r) for r in df.select(S.number_in_text("n"), S.number_in_text("t")).collect()] == [(None, 5.0), (7.0, 7.5)]


def test_an_object_without_a_section_is_an_error(spark):
    empty = spark.createDataFrame([], "id long, sections array<struct<id:long>>")
    objects = spark.createDataFrame([(1, 5.0), (2, None)], "id long, section_id double")
    with pytest.raises(Exception, match="berth without a section: 2"):
        network.dropins_by_section({"lock": empty}, {"berth": objects}).collect()
    assert network.dropins_by_section({"lock": empty}, {"berth": objects.where("id = 1")}).collect()[0][0] == "5"


def test_line_and_region_distances(spark):
    line = lambda *p: F.array(*[G.point(float(x), float(y)) for x, y in p])
    row = spark.range(1).select(
        G.line_distance(line((0, 0), (2, 2)), line((0, 2), (2, 0))).alias("crossing"),
        G.line_distance(line((0, 0), (1, 0)), line((3, 0), (3, 5))).alias("apart"),
        G.point_region_distance(G.point(0.5, 0.5), line((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))).alias("inside"),
        G.point_region_distance(G.point(2.0, 0.5), line((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))).alias("outside"),
    ).first()
    assert (row.crossing, row.apart, row.inside, row.outside) == (0.0, 2.0, 0.0, 1.0)


def test_foreign_graph_keeps_all_records(spark):
    nodes = spark.createDataFrame([("a", "s1", 1, None, "L1"), ("b", "s1", 2, None, "L2"), ("b", "s2", 3, None, "L2"), ("c", "s2", 4, "L9", "L3"), ("d", "s3", 5, None, "L9")], "node_id string, sectionref string, ord int, borderpoint string, locode string")
    sections = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "code string")
    n, e = network.foreign_graph(nodes, sections, "ord")
    assert {(r.source, r.target, r.is_border, r.subgraph) for r in e.collect()} == {("a", "b", False, "a"), ("b", "c", False, "a"), ("c", "d", True, "a"), ("d", "d", False, "a")}
    assert {r.node_id: len(r.records) for r in n.collect()} == {"a": 1, "b": 2, "c": 1, "d": 1}


def test_harbours_snap_by_code_then_place(spark):
    rows = spark.createDataFrame([(1.0, "One", " nlabc001 ", None, 0.0, 0.0), (2.0, "Two", "x", "BEANR99", 5.0, 5.0), (None, "No id", "x", None, 1.0, 1.0)], "id double, name string, code string, unlocode string, x double, y double")
    junctions = spark.createDataFrame([("j1", "NLABC001", 9.0, 9.0), ("j2", None, 5.0, 6.0)], "node string, code string, x double, y double")
    nodes, edges = network.harbours(rows, junctions, 1.0)
    assert {r.id: r.locode for r in nodes.collect()} == {"harbour_1": "NLABC", "harbour_2": "BEANR99"}
    assert {(r.src, r.dst, r.by, r.segment_type) for r in edges.collect()} == {("harbour_1", "j1", "code", "harbour_access"), ("harbour_2", "j2", "nearest", "harbour_access")}


def test_lines_within_finds_what_all_pairs_do(spark):
    import random

    rng = random.Random(4)
    lines = [(i, [(rng.random(), rng.random()) for _ in range(3)]) for i in range(24)]
    df = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in p]) for i, p in lines], "id long, line array<struct<x:double,y:double>>")
    got = {(r.left_id, r.right_id) for r in compare.lines_within(df, df, 0.05, 0.1).collect()}
    both = df.alias("a").join(df.alias("b"), F.lit(True)).select(F.col("a.id"), F.col("b.id"), G.line_distance(F.col("a.line"), F.col("b.line")).alias("d"))
    assert got == {(r[0], r[1]) for r in both.collect() if r[2] <= 0.05} and len(got) > 24
