"""The drop-in build from structures to tables, its command line, and the sources and sinks around it."""

import json
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from navnet import cli
from navnet.timing import timer
from navnet.functions import geometry as G
from navnet.operators import dropins
from navnet.sources import files, sinks

P = "struct<x:double,y:double>"
CHILD = f"array<struct<id:string,name:string,first:{P},last:{P},centre:{P},length:double>>"
COMPLEX = f"id string, name string, before {P}, after {P}, buffer double, sections array<struct<id:string,relation:string,distance:double>>, children {CHILD}"


def p(x, y=0.0):
    return {"x": float(x), "y": float(y)}


@pytest.fixture
def tables(spark):
    sections = spark.createDataFrame([("s1", "a", "b", 1000.0), ("s2", "b", "c", 500.0)], "section_id string, start string, end string, length double")
    chamber = [{"id": "11", "name": "Lock One east", "first": p(480), "last": p(520), "centre": p(500), "length": 40.0}, {"id": "12", "name": "Lock One west", "first": None, "last": None, "centre": p(500, 30), "length": 40.0}]
    locks = spark.createDataFrame([("1", "Lock One", p(450), p(550), 50.0, [{"id": "s1", "relation": "direct", "distance": 500.0}], chamber)], COMPLEX)
    opening = [{"id": "21", "name": "Lock One east", "first": None, "last": None, "centre": p(485, 1), "length": 10.0}]
    bridges = spark.createDataFrame([("2", "Bridge over lock", p(470), p(500), 15.0, [], opening), ("3", "Road bridge", p(200), p(220), 10.0, [{"id": "s2", "relation": "direct", "distance": 210.0}], [])], COMPLEX)
    terminals = spark.createDataFrame([("5", "Quay", "s2", 400.0)], "id string, name string, section_id string, distance double")
    return sections, {"lock": locks, "bridge": bridges}, {"terminal": terminals}


def test_detailed_build(tables):
    made = dropins.build(*tables, "detailed")
    nodes, edges = {r.id: r for r in made["nodes"].collect()}, {r.id: r for r in made["edges"].collect()}
    at = lambda i: (nodes[i].geometry[0].x, nodes[i].geometry[0].y)
    assert at("lock_1_split") == (450, 0) and at("chamber_11_start") == (480, 0) and at("chamber_12_start") == at("chamber_12_end") == (500, 30)  # without doors: the centre
    assert at("opening_virtual_3_start") == (210, 0)
    line = lambda i: [(q.x, q.y) for q in edges[i].geometry]
    assert line("chamber_12_approach") == [(450, 0), (500, 30)] and line("chamber_12_exit") == [(500, 30), (550, 0)]
    # the bridge of the east chamber begins at (480, 1), as near to the approach as to the route: the approach is cut, at its
    # end, and nothing is left behind it; the bridge's own ends are gone; the road bridge stays
    assert "chamber_11_approach" not in edges and "chamber_11_route" in edges
    assert line("chamber_11_approach_part1") == [(450, 0), (480, 1)] and line("chamber_11_approach_part2") == [(480, 1), (480, 0)]
    assert (edges["chamber_11_approach_part2"].source_node, edges["chamber_11_approach_part2"].length_m) == ("opening_21_end", 0.0)
    assert "bridge_2_split" not in nodes and "bridge_3_split" in nodes and "opening_virtual_3_passage" in edges
    # sections end at what stands on them
    ends = {(r.section_id, r.source_node, r.target_node) for r in made["sections"].collect()}
    assert {("s1", "a", "lock_1_split"), ("s1", "lock_1_merge", "b"), ("s2", "b", "bridge_3_split"), ("s2", "bridge_3_merge", "terminal_5_connection"), ("s2", "terminal_5_connection", "c")} == ends
    assert made["chambers"].count() == 2 and made["openings"].count() == 1 and made["locks"].columns[:2] == ["id", "name"]


def parts_of(edges):
    """The connected parts of a network, each as the set of its nodes."""
    parts = []
    for r in edges:
        touched = [x for x in parts if x & {r.source_node, r.target_node}]
        parts = [x for x in parts if x not in touched] + [set().union({r.source_node, r.target_node}, *touched)]
    return parts


@pytest.fixture
def lined(spark, tables):
    """The same with lines: a bent section, a straight one, and a terminal and a berth off it, known by their points."""
    line = f"array<{P}>"
    sections = spark.createDataFrame([("s1", "a", "b", [p(0), p(300), p(300, 400), p(600, 400)]), ("s2", "b", "c", [p(600, 400), p(1100, 400)]), ("s3", "c", "d", [p(1100, 400), p(1100, 900)]), ("s4", "x", "y", None)], f"section_id string, start string, end string, line {line}")
    chamber = [{"id": "11", "name": "Lock One", "first": p(300, 180), "last": p(300, 220), "centre": p(300, 200), "length": 40.0}]
    lock = spark.createDataFrame([("1", "Lock One", p(300, 100), p(300, 300), None, [{"id": "s1", "relation": "direct", "distance": None}], chamber, p(310, 200))], COMPLEX + f", point {P}")
    bridge = spark.createDataFrame([("3", "Road bridge", p(790, 400), p(810, 400), None, [{"id": "s2", "relation": "direct", "distance": None}], [], p(800, 420))], COMPLEX + f", point {P}")
    objects = {"terminal": spark.createDataFrame([("5", "Quay", "s2", p(1000, 430)), ("6", "Off", "s4", p(0))], f"id string, name string, section_id string, point {P}"), "berth": spark.createDataFrame([("9", "Berth", "s2", p(900, 390))], f"id string, name string, section_id string, point {P}")}
    return sections, {"lock": lock, "bridge": bridge}, objects


def test_detailed_build_along_lines(lined):
    made = dropins.build(*lined, "detailed")
    nodes, edges = {r.id: r for r in made["nodes"].collect()}, {r.id: r for r in made["edges"].collect()}
    line = lambda i: [(q.x, q.y) for q in edges[i].geometry]
    # the lock takes half its chamber and 50 m, around 500 m along the line; the bridge 10 m, terminal and berth nothing
    assert line("fairway_segment_section_s1_0") == [(0, 0), (300, 0), (300, 130)] and line("fairway_segment_section_s1_1") == [(300, 270), (300, 400), (600, 400)]
    ends = {k: (r.source_node, r.target_node, r.length_m, r.type) for k, r in edges.items() if k.startswith("fairway_segment_section")}
    assert ends == {
        "fairway_segment_section_s1_0": ("a", "lock_1_split", 430.0, "approach_or_exit"), "fairway_segment_section_s1_1": ("lock_1_merge", "b", 430.0, "approach_or_exit"),
        "fairway_segment_section_s2_0": ("b", "bridge_3_split", 190.0, "approach_or_exit"), "fairway_segment_section_s2_1": ("bridge_3_merge", "berth_9_connection", 90.0, "approach_or_exit"),
        "fairway_segment_section_s2_2": ("berth_9_connection", "terminal_5_connection", pytest.approx(99.999), "approach_or_exit"), "fairway_segment_section_s2_3": ("terminal_5_connection", "c", pytest.approx(99.999), "approach_or_exit"),
        "fairway_segment_section_s3": ("c", "d", 500.0, "clear"),
    }
    at = lambda i: (nodes[i].geometry[0].x, nodes[i].geometry[0].y, nodes[i].type)
    assert at("a") == (0, 0, "junction") and at("c") == (1100, 400, "junction") and at("lock_1_split") == (300, 130, "lock_split") and at("lock_1_merge") == (300, 270, "lock_merge")
    assert at("terminal_5_connection") == (1000, 400, "junction") and at("terminal_5") == (1000, 430, "terminal") and line("terminal_access_5") == [(1000, 400), (1000, 430)] and edges["terminal_access_5"].length_m == 30
    # the approach goes from the section's end, everything hangs together, and what stands on no line is left out
    assert line("chamber_11_approach") == [(300, 130), (300, 180)] and len(parts_of(edges.values())) == 1
    assert {"a", "b", "c", "d"} <= nodes.keys() and "terminal_6" not in nodes and all(r.geometry for r in [*nodes.values(), *edges.values()])
    assert {r.source_node for r in edges.values()} | {r.target_node for r in edges.values()} <= nodes.keys()


def test_simplified_build_along_lines(lined):
    edges = {r.id: r for r in dropins.build(*lined, "simplified")["edges"].collect()}
    assert edges["fairway_segment_section_s1_0"].length_m == 490 and "terminal_access_5" not in edges and len(parts_of(edges.values())) == 1


def test_lines_in_degrees(spark):
    """Cut on the grid, measured on the ellipsoid: the segments' lengths add up to the line's."""
    from navnet.operators import splice

    sections = spark.createDataFrame([(1.0, 7.0, 8.0, [p(4.30, 51.70), p(4.35, 51.71), p(4.40, 51.70)])], f"section_id double, start double, end double, line array<{P}>")
    cuts = spark.createDataFrame([("1", "terminal_2", 0.0, p(4.36, 51.72)), ("1", "berth_3", 0.0, p(4.32, 51.70))], f"section_id string, id string, buffer double, anchor {P}")
    got = splice.splice_lines(sections, cuts, degrees=True).orderBy("segment").collect()
    whole = splice.splice_lines(sections, cuts.where("false"), degrees=True).collect()
    assert [(r.source_node, r.target_node) for r in got] == [("7", "berth_3_connection"), ("berth_3_connection", "terminal_2_connection"), ("terminal_2_connection", "8")]
    assert [r.id for r in whole] == ["fairway_segment_section_1"] and whole[0].length_m == pytest.approx(7259, abs=25)
    assert sum(r.length_m for r in got) == pytest.approx(whole[0].length_m, abs=0.01)


def test_line_kernel_matches_plain_cuts(spark):
    """Pieces of odd lines (repeated vertices, one point, null) at odd measures, against the plain expressions."""
    import random

    from navnet.functions import lines as L

    rng = random.Random(7)
    rows = []
    for i in range(200):
        line = [p(rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(2, 12))]
        cuts = sorted(rng.choice([0.0, 1.0, 2.5, 7.0, 100.0, rng.random() * 20]) for _ in range(rng.randrange(0, 5)))
        rows.append((i, line, cuts[:-1], cuts[1:]))
    df = spark.createDataFrame([*rows, (500, None, [0.0], [1.0]), (501, [], [0.0], [1.0])], f"id int, line array<{P}>, b array<double>, e array<double>").repartition(3)
    got = {r.id: r.p for r in df.select("id", L.pieces("line", "b", "e").alias("p")).collect()}
    plain = df.where("size(line) > 0").select("id", F.transform(F.arrays_zip("b", "e"), lambda z: G.substring(F.col("line"), z["b"], F.least(z["e"], G.line_length(F.col("line"))))).alias("p"))
    for r in plain.collect():
        assert [[(q.x, q.y) for q in part] for part in got[r.id]] == [[(pytest.approx(q.x, abs=1e-9), pytest.approx(q.y, abs=1e-9)) for q in part] for part in r.p], r.id
    assert got[500] is None and got[501] == []


def test_capacities_of_passages(spark):
    from navnet.operators import splice

    child = "array<struct<id:string,dim_gate_width:double,dim_usable_length:double,dim_height:double>>"
    kids = [("a", 9.0, 100.0, 7.0), ("b", 12.0, None, 5.5), ("c", None, 80.0, None)]
    df = spark.createDataFrame([("1", "S", p(0), p(9), [("s", "direct"), ("t", "overlap")], kids), ("2", "E", p(0), p(9), [], [])], f"id string, name string, before {P}, after {P}, sections array<struct<id:string,relation:string>>, children {child}")
    lock = {r.id: r for r in splice.passages(df, "lock").collect()}
    bridge = {r.id: r for r in splice.passages(df, "bridge").collect()}
    assert (lock["lock_passage_1"].dim_gate_width, lock["lock_passage_1"].dim_usable_length, lock["lock_passage_1"].constituent_ids, lock["lock_passage_1"].section_id) == (12.0, 100.0, "a,b,c", "t")
    assert (bridge["bridge_passage_1"].dim_gate_width, bridge["bridge_passage_1"].dim_height) == (9.0, 5.5)
    assert (lock["lock_passage_2"].dim_gate_width, lock["lock_passage_2"].constituent_ids) == (None, "") and lock["lock_1_split"].constituent_ids is None


def test_opening_cuts_its_chambers_line(spark):
    line = f"array<{P}>"
    rows = [([p(0), p(10), p(10, 10)], p(11, 4)), ([p(0), p(10)], p(-3, 1)), ([p(0), p(10)], p(14, 0)), ([p(0), p(10), p(20)], p(10, 2))]
    got = [r.c for r in spark.createDataFrame(rows, f"line {line}, p {P}").coalesce(1).select(G.cut_to_point(F.col("line"), F.col("p")).alias("c")).collect()]
    pts = lambda part: [(q.x, q.y) for q in part]
    assert (pts(got[0].before), pts(got[0].after), got[0].before_empty, got[0].after_empty) == ([(0, 0), (10, 0), (11, 4)], [(11, 4), (10, 10)], False, False)
    assert (pts(got[1].before), pts(got[1].after), got[1].before_empty) == ([(0, 0), (-3, 1)], [(-3, 1), (10, 0)], True)
    assert (pts(got[2].before), pts(got[2].after), got[2].after_empty) == ([(0, 0), (14, 0)], [(14, 0), (10, 0)], True)
    assert (pts(got[3].before), pts(got[3].after)) == ([(0, 0), (10, 2)], [(10, 2), (20, 0)])


def test_simplified_build(tables):
    made = dropins.build(*tables, "simplified")
    assert {r.id for r in made["nodes"].collect()} == {f"{k}_{i}_{e}" for k, i in (("lock", 1), ("bridge", 2), ("bridge", 3)) for e in ("split", "merge")}
    edges = {r.id: r for r in made["edges"].collect()}
    assert [(q.x, q.y) for q in edges["lock_passage_1"].geometry] == [(450, 0), (550, 0)]
    assert edges["lock_passage_1"].constituent_ids == "11,12" and edges["lock_passage_1"].dim_usable_length == 40 and edges["bridge_passage_2"].constituent_ids == "21"
    assert not any("terminal" in (r.target_node or "") for r in edges.values())
    with pytest.raises(ValueError):
        dropins.build(*tables, "other")


def test_command_line(spark, tables, tmp_path, capsys):
    src = str(tmp_path / "in")
    tables[0].write.parquet(f"{src}/sections.parquet")
    for k, df in {**tables[1], **tables[2]}.items():
        df.write.parquet(f"{src}/{k}.parquet")
    cli.main(["dropins", src, str(tmp_path / "out"), "--mode", "simplified"])
    assert {"nodes", "edges", "sections", "locks", "chambers"} <= set(json.loads(capsys.readouterr().out))
    cli.main(["publish", str(tmp_path / "out"), "--needed", "nodes,edges"])
    assert json.loads(capsys.readouterr().out)["complete"]
    with pytest.raises(SystemExit):
        cli.main(["publish", str(tmp_path / "out"), "--needed", "nodes,readme"])
    spark.createDataFrame([("1", "L", p(0), p(9))], f"id string, name string, before {P}, after {P}").write.parquet(f"{src}/structures.parquet")
    spark.createDataFrame([("7", "1", p(4))], f"id string, parent_id string, centre {P}").write.parquet(f"{src}/children.parquet")
    cli.main(["schematize", src, str(tmp_path / "locks")])
    assert json.loads(capsys.readouterr().out) == ["lock", "nodes", "edges"]
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "locks" / "edges.geojson")).collect()]
    assert {f["properties"]["id"] for f in lines} == {"chamber_7_approach", "chamber_7_route", "chamber_7_exit"} and all(f["geometry"]["type"] == "LineString" for f in lines)
    assert json.loads(spark.read.text(str(tmp_path / "locks" / "summary.json")).first().value)["children"][0]["id"] == "7"


def test_assignment_from_files_to_layers(spark, tmp_path, capsys):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    empty = "cast(array() as array<struct<id:string,name:string,width:double,length:double,minutes:double>>)"
    edges = spark.createDataFrame([("a", "b", "e1", 1000.0, "Waal"), ("b", "c", "e2", 500.0, "Waal")], "src string, dst string, key string, length_m double, water_name string")
    edges = edges.selectExpr("*", "'x' as name", "case when key = 'e1' then 5.0D end as width", "cast(null as string) as cemt_class", f"{empty} as chambers", f"{empty} as openings").withColumn("geometry", F.array(G.point(F.lit(0.0), F.lit(0.0)), G.point(F.lit(1.0), F.lit(1.0))))
    edges.write.parquet(f"{src}/edges.parquet")
    nodes = spark.createDataFrame([("a", "NLAAA01", "harbour", 0.0, 0.0), ("c", "NLCCC", "harbour", 1.0, 1.0)], "id string, locode string, kind string, x double, y double")
    nodes.write.parquet(f"{src}/nodes.parquet")
    spark.createDataFrame([("NLAAA", 0.0, 0.0)], "code string, x double, y double").write.parquet(f"{src}/places.parquet")
    voyages = spark.createDataFrame([("NLAAA", "NLCCC", "M8", 10.0, 20.0, "x"), ("NLAAA", "ZZZZZ", "M8", 1.0, 2.0, "y"), ("NLAAA", "NLCCC", "M8", 5.0, 20.0, "z")], "origin string, destination string, class_code string, cargo double, capacity double, event string")
    voyages.write.parquet(f"{src}/voyages")
    cli.main(["assign", src, out])
    assert json.loads(capsys.readouterr().out) == {"success": 1, "geocode_fail": 1}
    got = {r.edge: (r.total_cargo, r.trips) for r in spark.read.parquet(f"{out}/intensity").collect()}
    assert got == {"e1": (15.0, 2), "e2": (15.0, 2)} and spark.read.parquet(f"{out}/trips_with_paths").first().path == ["a", "b", "c"]
    sums = {r.edge: r for r in spark.read.parquet(f"{out}/intensity").collect()}
    kinds = ("lock", "bridge", "fairway", "sea", "cemt")
    assert sums["e1"].penalty_total > 0 == sums["e2"].penalty_total and all(r.penalty_total == sum(r[f"penalty_{k}"] for k in kinds) for r in sums.values())
    over = [r for r in spark.read.parquet(f"{out}/penalised_edges").collect()]
    assert {r.key for r in over} == {"e1"} and over[0].trips == 2
    with pytest.raises(ValueError):
        none = spark.createDataFrame([], "status string, edge string")
        sinks.export_assignment(none, none, None, edges, out)


def test_sources_of_places_pages_and_matrices(spark, tmp_path):
    with sqlite3.connect(tmp_path / "u.gpkg") as db:
        db.execute("create table unlo (country_code text, location_code text, geom blob)")
        db.executemany("insert into unlo values (?, ?, ?)", [("NL", "NTJ", b"GP\0\1" + bytes(4) + b"\1\1\0\0\0" + struct.pack("<dd", 0, 0)), ("BE", "ANR", b"GP\0\1" + bytes(4) + b"\1\1\0\0\0" + struct.pack("<dd", 4.4, 51.2)), ("DE", "XXX", None)])
    assert {(r.code, r.x, r.y) for r in files.location_codes(spark, str(tmp_path / "u.gpkg")).collect()} == {("NLNTJ", 3.7115, 51.6391), ("BEANR", 4.4, 51.2)}
    (tmp_path / "od.csv").write_text("from,to,w,rest\nA,B,2.5,x\nB,A,,y\n")
    assert [tuple(r) for r in files.od_matrix(spark, str(tmp_path / "od.csv"), "from", "to", "w").collect()] == [("A", "B", 2.5), ("B", "A", None)]
    page = lambda o, rows, n=3, t="lock": json.dumps({"GeoType": t, "Offset": o, "TotalCount": n, "Result": [{"Id": i} for i in rows]})
    (tmp_path / "pages.jsonl").write_text("\n".join([page(0, [1, 2]), page(2, [3]), page(0, [1, 2])]))
    assert sorted(r.Id for r in files.captured_pages(spark, str(tmp_path / "pages.jsonl"), "Id bigint").collect()) == [1, 2, 3]
    (tmp_path / "part.jsonl").write_text(page(0, [1, 2]))
    with pytest.raises(Exception, match="pages are missing of lock"):
        files.captured_pages(spark, str(tmp_path / "part.jsonl"), "Id bigint").collect()
    (tmp_path / "wfs").mkdir()
    for name in ("bridges", "other"):
        (tmp_path / "wfs" / f"{name}.json").write_text(json.dumps({"features": [{"properties": {"n": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    rows = files.feature_rows(spark, str(tmp_path / "wfs"), ("bridges", "locks"), "n int").collect()
    assert [(r.layer, r.n) for r in rows] == [("bridges", 1)] and json.loads(rows[0].geometry)["coordinates"] == [1, 2]
    assert files.border_nodes(spark, str(tmp_path)).count() == 0


def test_geodesic_passage_is_around_its_place(spark):
    row = spark.createDataFrame([(5.0, 52.0, 4.9, 52.0, 5.1, 52.0, 100.0)], "a double, b double, c double, d double, e double, f double, g double").select(G.geodesic_passage("a", "b", "c", "d", "e", "f", "g").alias("p")).first().p
    metres = G.geodesic_inverse(np.array([row.lon1]), np.array([row.lat1]), np.array([row.lon2]), np.array([row.lat2]))[0][0]
    assert metres == pytest.approx(100.0, abs=1e-6) and row.lon1 < 5.0 < row.lon2


def test_reports_and_timing(spark, caplog):
    text = sinks.comparison_report("Networks", {"sizes": spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int")})
    assert text.index("| a | n 1 |") < text.index("| b | n 2 |")

    @timer
    def fails():
        raise KeyError("x")

    with caplog.at_level("INFO"), pytest.raises(KeyError):
        fails()
    assert "fails failed after" in caplog.text
