"""Operators on small inline tables, with the expected results of the blueprint's fixtures."""

import heapq
import random
import sqlite3
import zipfile


import pytest
from pyspark.sql import functions as F

from navnet.functions import geometry as G
from navnet.functions import scalars as S
from navnet.operators import graph, relational, schema, spatial, splice, traffic, validate
from navnet.sources import files, sinks
from navnet.streaming import positions


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_identifiers_and_codes(spark):
    v = F.col("v")
    assert values(spark, S.stringify_id(v), ["123.0", "nan", "NaN", None, "7.5", "abc", "007", "1e3", "inf"]) == ["123", None, None, None, "7.5", "abc", "7", "1000", None]
    assert values(spark, S.stringify_id(v), [1.0, 2.5, float("nan"), None], "double") == ["1", "2.5", None, None]
    assert values(spark, S.normalize_code(v), ["001b", "041.0", "", None, "nan", "0abc", "abc"]) == ["1", "41", None, None, None, "0", "abc"]
    assert values(spark, S.normalize_class_code(v), [" b01 ", "m8", None]) == ["BO1", "M8", ""]
    assert values(spark, S.normalize_cemt(v), ["iv_a", "VII-a", "Vb", None]) == ["IV", "VIC", "VB", ""]
    assert values(spark, S.cemt_scale(v), ["IV", "VIC", "?", None]) == [4, 9, 0, 0]
    assert values(spark, S.number_in_text(v), ["12 km/h", "x 3.5", "slow", "0", None]) == [12.0, 3.5, None, None, None]
    assert values(spark, S.camel_to_snake(v), ["RouteKmBegin", "GeneralDepth", "Geometry", "already_snake"]) == ["route_km_begin", "general_depth", "geometry", "already_snake"]
    assert values(spark, S.is_valid(v), ["x", "nan", None]) == [True, False, False]


def test_file_names(spark):
    names = ["IVS_weekmonitor_15JAN2024_20240116_1.zip", "IVS_weekmonitor_01DEC2023_x.zip", "IVS_weekmonitor_2024_20240510_1.zip", "other.zip"]
    got = values(spark, S.file_year_month(F.col("v")), names)
    assert [(g.year, g.month) for g in got] == [(2024, 1), (2023, 12), (2024, 5), (None, None)]


def test_overlap_of_mirrored_kilometres(spark):
    df = spark.createDataFrame([(104.598, 116.71, 14.42, 17.24, 121.0)], "a double, b double, c double, d double, m double")
    assert df.select(S.ranges_overlap("a", "b", "c", "d"), S.ranges_overlap("a", "b", "c", "d", "m")).first() == (False, True)


def test_draft_and_weights(spark):
    df = spark.createDataFrame([(0.0, 100.0), (100.0, 100.0), (50.0, 100.0)], "cargo double, cap double")
    d = S.vessel_draft(F.col("cargo"), F.col("cap"), F.lit(3.5), F.lit(1.4), F.lit(None).cast("double"))
    assert [round(r[0], 6) for r in df.select(d).collect()] == [1.4, 3.5, 2.45]
    rows = [("a", []), ("b", [("1", "lock", 12.0)]), ("c", [("1", "lock", 8.0)])]
    e = spark.createDataFrame(rows, "k string, chambers array<struct<id:string,name:string,width:double>>")
    limit = S.narrowest("chambers", F.expr("cast(array() as array<struct<id:string,name:string,width:double>>)"), F.struct(F.col("k").alias("id"), F.lit("f").alias("name"), F.lit(None).cast("double").alias("width")))
    pen = S.soft_penalties(F.lit(10.0), F.lit(80.0), F.lit(""), limit, F.lit(None).cast("double"), F.lit("Rijn"), F.lit(None).cast("string"))
    w = S.edge_weight(F.lit(1000.0), S.edge_speed([F.lit("10")]), F.transform("chambers", lambda c: F.lit(None).cast("double")), pen["total"])
    assert [round(r[0], 6) for r in e.orderBy("k").select(w).collect()] == [0.1, 0.6, 1000.6]


def test_schema_normalisation(spark):
    df = spark.createDataFrame([(1.0, "x", 17.14, 500.0), (10.0, "y", 20.0, None)], "Id double, SomeUnknownAttribute string, ClearanceHeightClosed double, mheightcm double")
    out = schema.normalize_attributes(df, {"Id": "id", "ClearanceHeightClosed": "dim_height", "mheightcm": "dim_height_cm", "Absent": "absent"}, ("id",))
    assert [tuple(r) for r in out.select("id", "some_unknown_attribute", "dim_height", "absent").orderBy("id").collect()] == [("1", "x", 5.0, None), ("10", "y", 20.0, None)]


def test_range_match_takes_the_first(spark):
    s = spark.createDataFrame([(1, 100, 0.0, 5.0), (2, 100, 5.0, 10.0), (3, 200, 8.0, 0.0), (4, None, 0.0, 1.0)], "id int, route int, b double, e double")
    d = spark.createDataFrame([(301, 100, 0.0, 4.0, 12.0), (302, 100, 6.0, 10.0, 8.0), (303, 100, 4.0, 6.0, 5.0)], "ord int, route int, b double, e double, speed double")
    out = relational.match_by_range(s, d, "route", "b", "e", "id", "ord", ["speed"], "nav_")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 12.0), (2, 8.0), (3, None)]
    with pytest.raises(ValueError):
        relational.match_by_range(s, d.where("false"), "route", "b", "e", "id", "ord", ["speed"])


def test_strict_lookup_raises(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no code"):
        relational.strict_lookup(a, b, "k", "no code").collect()
    assert relational.strict_lookup(a.where("k = 1"), b, "k", "no code").count() == 1


def test_geometry(spark):
    line = F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (3.0, 4.0), (3.0, 10.0))])
    df = spark.range(1)
    got = df.select(G.line_length(line), G.project(line, G.point(F.lit(4.0), F.lit(7.0))), G.interpolate(line, F.lit(7.0)), G.point_line_distance(G.point(F.lit(4.0), F.lit(7.0)), line), G.substring(line, F.lit(2.5), F.lit(8.0)), G.parse_wkt_line(G.to_wkt_line(line)), G.parse_wkt_line(F.lit("POLYGON ((0 0))"))).first()
    assert got[0] == 11.0 and got[1] == 8.0 and (got[2].x, got[2].y) == (3.0, 6.0) and got[3] == 1.0
    assert [(p.x, p.y) for p in got[4]] == [(1.5, 2.0), (3.0, 4.0), (3.0, 7.0)]
    assert [(p.x, p.y) for p in got[5]] == [(0, 0), (3, 4), (3, 10)] and got[6] is None
    ring = F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0))])
    c = df.select(G.centroid(ring)).first()[0]
    assert (c.x, c.y) == (1.0, 1.0)


def test_projections():
    x, y = G.to_grid(5.38720621, 52.15517440)
    assert abs(x - 155000) < 1 and abs(y - 463000) < 1
    lon, lat = G.from_grid(*G.to_grid(4.5, 51.9))
    assert abs(lon - 4.5) < 1e-7 and abs(lat - 51.9) < 1e-7
    assert abs(G.geodesic_inverse([5.0], [52.0], [5.0], [52.005])[0][0] - 556.3) < 0.1
    to = G.geodesic_direct([5.0], [52.0], [37.0], [1000.0])
    assert abs(G.geodesic_inverse([5.0], [52.0], *to)[0][0] - 1000) < 1e-6
    assert G.to_utm(3.0, 52.0)[0] == 500000.0


@pytest.mark.parametrize(("cuts", "want"), [([], [100.0]), ([("L1", 50, 10)], [40, 40]), ([("L1", 30, 5), ("B1", 70, 5)], [25, 30, 25]), ([("L1", 30, 10), ("L2", 45, 10)], [20, 45])])
def test_splice(spark, cuts, want):
    s = spark.createDataFrame([("s", "a", "b", 100.0)], "section_id string, start string, end string, length double")
    c = spark.createDataFrame([("s", float(d), float(b), i) for i, d, b in cuts], "section_id string, distance double, buffer double, id string")
    got = splice.splice(s, c).orderBy("segment").collect()
    assert [round(r.length_m, 2) for r in got] == want and got[0].source_node == "a" and got[-1].target_node == "b"


def test_passages_and_access(spark):
    p = spark.createDataFrame([("7", "x", "P", "Q", [("1", "direct"), ("2", "overlap")]), ("8", "y", None, "Q", [])], "id string, name string, before string, after string, sections array<struct<id:string,relation:string>>")
    got = splice.passages(p, "lock").collect()
    assert [r.id for r in got] == ["lock_7_split", "lock_7_merge", "lock_passage_7"] and got[2].section_id == "2"
    t = spark.createDataFrame([("1", "t", "s"), ("2", "u", None)], "id string, name string, section_id string")
    assert [r.id for r in splice.access_features(t, "terminal").collect()] == ["terminal_1_connection", "terminal_1", "terminal_access_1"]


def scattered(spark, n, seed, start=0):
    rng = random.Random(seed)
    return spark.createDataFrame([(start + i, rng.random(), rng.random() * 3) for i in range(n)], "id bigint, x double, y double")


def test_spatial_joins_match_brute_force(spark):
    a, b = scattered(spark, 120, 1), scattered(spark, 90, 2, 1000)
    pa, pb = a.collect(), b.collect()
    d = lambda p, q: ((p.x - q.x) ** 2 + (p.y - q.y) ** 2) ** 0.5
    want = sorted((p.id, q.id) for p in pa for q in pb if d(p, q) <= 0.1)
    assert sorted((r.left_id, r.right_id) for r in spatial.within_distance(a, b, 0.1).collect()) == want
    best = sorted((p.id, min(pb, key=lambda q: (d(p, q), q.id)).id) for p in pa)
    for rows in (1_000, 5):
        assert sorted((r.left_id, r.right_id) for r in spatial.nearest(a, b, 0.05, broadcast_rows=rows).collect()) == best


def test_greedy_pairs(spark):
    rng = random.Random(3)
    c = [(f"o{i}", f"c{j}", float(rng.randrange(8)), float(rng.randrange(5))) for i in range(12) for j in range(9)]
    used, want = set(), set()
    for o, ch, *_ in sorted(c, key=lambda r: (-r[2], r[3], r[0], r[1])):
        if o not in used and ch not in used:
            used |= {o, ch}
            want.add((o, ch))
    df = spark.createDataFrame(c, "left string, right string, score double, distance double")
    assert {(r.left, r.right) for r in spatial.greedy_pairs(df).collect()} == want


def test_routes_match_dijkstra(spark):
    rng = random.Random(4)
    table = {}
    for _ in range(60):
        a, b = rng.sample(range(25), 2)
        table[min(a, b), max(a, b)] = rng.randrange(1, 50)
    edges = spark.createDataFrame([(f"n{a}", f"n{b}", f"e{a}_{b}", float(w)) for (a, b), w in table.items()], "src string, dst string, key string, w double")
    groups = spark.createDataFrame([(f"n{a}", f"n{b}", "M8") for a in range(5) for b in range(26)] + [(None, "n1", "M8")], "origin_node string, destination_node string, class string")

    def best(a, b):
        heap, seen = [(0, a)], set()
        while heap:
            d, u = heapq.heappop(heap)
            if u == b:
                return d
            if u in seen:
                continue
            seen.add(u)
            for (p, q), w in table.items():
                if u in (p, q):
                    heapq.heappush(heap, (d + w, q if u == p else p))
        return None

    for r in graph.route(groups, edges, "class", {"M8": F.col("w")}).collect():
        if r.origin_node is None:
            assert r.status == "geocode_fail"
            continue
        a, b = int(r.origin_node[1:]), int(r.destination_node[1:])
        want = best(a, b)
        assert (r.status, r.cost) == (("success", want) if want is not None else ("no_path", None))
        if want:
            assert r.path[0] == f"n{a}" and r.path[-1] == f"n{b}" and len(r.edges) == len(r.path) - 1


def test_assignment(spark):
    none = "array<struct<id:string,name:string,width:double,length:double,minutes:double>>"
    edges = spark.createDataFrame(
        [("A", "B", "e1", "x", 1000.0, "10", "Rijn", None, None, [], []), ("B", "C", "e2", "y", 1000.0, None, "Rijn", None, None, [("1", "l", 8.0, 200.0, 30.0)], []), ("A", "C", "e3", "z", 9000.0, "10", None, "II", None, [], [])],
        f"src string, dst string, key string, name string, length_m double, maxspeed string, water_name string, cemt_class string, width double, chambers {none}, openings {none}",
    )
    nodes = spark.createDataFrame([("A", "NLAAA01", "harbour", 5.0, 52.0), ("B", "NLBBB01", "other", 5.1, 52.0), ("C", "NLCCC01", "terminal", 5.2, 52.0)], "id string, locode string, kind string, x double, y double")
    v = spark.createDataFrame([("NLAAA", "NLCCC", "M8", 10.0, 20.0, 1), ("NLAAA", "NLCCC", "M8", None, 20.0, None), ("NLAAA", "XX", "?", 1.0, 1.0, 1)], "origin string, destination string, class_code string, cargo double, capacity double, event int")
    codes = traffic.geocode(v.select(F.explode(F.array("origin", "destination")).alias("code")), nodes, spark.createDataFrame([], "code string, x double, y double"))
    trips, intensity, status = traffic.assign(v, codes, edges, {"M8": (11.4, 110.0, "I")})
    got = {(r.origin, r.destination): (r.edges, r.status, r.total_cargo, r.trips) for r in trips.collect()}
    assert got["NLAAA", "NLCCC"] == (["e3"], "success", 10.0, 1) and got["NLAAA", "XX"][1] == "geocode_fail"
    assert [tuple(r) for r in intensity.collect()] == [("e3", 10.0, 1)] and status.count() == 2
    assert traffic.penalised(trips, edges, {"M8": (11.4, 110.0, "Va")}).collect()[0].kind == "cemt"


def test_border_stitching(spark):
    hn, he = spark.createDataFrame([(1001,), (1002,)], "id int"), spark.createDataFrame([(1001, 1002, 1000.0)], "src int, dst int, length_m double")
    fn = spark.createDataFrame([("DE_1", "DE"), ("NL_1", "NL"), ("NL_2", "NL")], "id string, countrycode string")
    fe = spark.createDataFrame([("DE_1", "NL_1"), ("NL_1", "NL_2")], "src string, dst string")
    links = spark.createDataFrame([(1001, "DE_1", "NL_1", 12.5)], "home_node int, foreign_node string, bridgehead string, distance double")
    nodes, edges = graph.merge_graphs((hn, he), (fn, fe), links, "NL")
    assert {r.id for r in nodes.collect()} == {"FIS_1001", "FIS_1002", "EURIS_DE_1"}
    assert {(r.src, r.dst, r.data_source) for r in edges.collect()} == {("FIS_1001", "FIS_1002", "FIS"), ("FIS_1001", "EURIS_DE_1", "BORDER")}
    assert validate.borders(edges)["status"] == "WARNING" and validate.connection(edges, "DE_1")["status"] == "PASS"


def test_components_of_odd_tables(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (7, 7)], "src bigint, dst bigint")
    got = dict(graph.components(e).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100}
    assert graph.components(e.where("false")).count() == 0


def voyage_zip(path, name, head, lines):
    with zipfile.ZipFile(path / name, "w") as z:
        z.writestr("f.csv", "\n".join([head, *lines]))


def test_voyage_files(spark, tmp_path):
    src = tmp_path / "zips"
    src.mkdir()
    head = "Jaar;Maand;WeekNr;V05_06_begindt_evenement_iso;V38_vervoerd_gewicht;SK_code;nstr_nw"
    voyage_zip(src, "IVS_weekmonitor_15JAN2024_1.zip", head, ["2024;1;2;2024-01-10T12:00:00Z;125.5;M8;01", "2024;x;2;bad;oops;M8;02"])
    voyage_zip(src, "IVS_weekmonitor_2024_20240110_1.zip", head, ["2024;1;2;2024-01-10T12:00:00Z;125.5;M8;01"])
    voyage_zip(src, "unknown.zip", head, ["2022;8;2;;1;M8;01"])
    (src / "broken.zip").write_bytes(b"no zip")
    df = files.zipped_voyages(spark, str(src))
    rows = sorted((r.source_file.rpartition("/")[2], r.row, r.jaarmaand, r.maand, r.v38_vervoerd_gewicht, r.nstr_nw, r.file_year, r.file_month) for r in df.collect())
    assert rows == [("IVS_weekmonitor_15JAN2024_1.zip", 0, 2401, 1, 125.5, "01", 2024, 1), ("IVS_weekmonitor_15JAN2024_1.zip", 1, 2400, 0, None, "02", 2024, 1), ("IVS_weekmonitor_2024_20240110_1.zip", 0, 2401, 1, 125.5, "01", 2024, 1), ("unknown.zip", 0, 2208, 8, 1.0, "01", 2022, 8)]
    sinks.voyage_months(df, str(tmp_path / "out"))
    assert files.voyages(spark, str(tmp_path / "out"), 2024, 1).count() == 2 and files.voyages(spark, str(tmp_path / "out")).count() == 3


def test_other_sources(spark, tmp_path):
    (tmp_path / "Node_NL_2024.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"code":"a"},"geometry":{"type":"Point","coordinates":[5.0,52.0]}}]}')
    r = files.geojson(spark, str(tmp_path / "*.geojson"), "code string").first()
    assert (r.code, r.geometry_type, r.coordinates, r.country) == ("a", "Point", [5.0, 52.0], "NL")
    with sqlite3.connect(tmp_path / "x.sqlite") as db:
        db.execute("create table nodes (ID int, x real)")
        db.execute("insert into nodes values (1, 2.5)")
    db.close()
    assert [tuple(r) for r in files.sqlite_table(spark, str(tmp_path / "x.sqlite"), "select ID, x from nodes", "id bigint, x double").collect()] == [(1, 2.5)]
    sheet = "".join(f'<row r="{n}">' + "".join(f'<c r="{col}{n}" t="inlineStr"><is><t>{v}</t></is></c>' for col, v in zip("AB", row, strict=True)) + "</row>" for n, row in enumerate([("title", ""), ("ISRS", "Name"), ("NLRTM0001000000000001", "x"), ("short", "y")], 1))
    with zipfile.ZipFile(tmp_path / "i.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{sheet}</sheetData></worksheet>')
    assert [tuple(r) for r in files.index_workbook(spark, str(tmp_path / "i.xlsx"), {"ISRS": "isrs_code", "Name": "name"}).collect()] == [("NLRTM0001000000000001", "x")]
    with pytest.raises(ValueError, match="absent"):
        files.index_workbook(spark, str(tmp_path / "i.xlsx"), {"ISRS": "isrs_code", "Nope": "n"})
    spark.createDataFrame([(1,)], "id int").write.parquet(str(tmp_path / "section.parquet"))
    with pytest.warns(UserWarning):
        assert list(files.bundle(spark, str(tmp_path), ("section",), ("berth",))) == ["section"]
    with pytest.raises(FileNotFoundError):
        files.bundle(spark, str(tmp_path), ("absent",))


def test_graph_export(spark, tmp_path):
    nodes = spark.createDataFrame([("a", [1]), ("b", [2]), ("c", [3])], "id string, nested array<int>")
    edges = spark.createDataFrame([("a", "b")], "src string, dst string")
    assert sinks.export_graph(nodes, edges, str(tmp_path / "g")) == {"nodes": 3, "edges": 1, "components": 2, "largest_component": 2}
    assert spark.read.parquet(str(tmp_path / "g/nodes")).columns == ["id"]
    with pytest.raises(ValueError):
        sinks.export_graph(nodes, edges.where("false"), str(tmp_path / "h"))
    assert "| a | 1 |" in sinks.report("t", {"s": [("a", 1)]})


def test_positions(spark):
    rows = spark.createDataFrame([("v1", "2024-01-01 00:00:00", 5.0001, 52.0, 1), ("v1", "2024-01-01 00:05:00", 5.0002, 52.0, 99), ("v2", "2024-01-01 00:01:00", 6.0, 52.0, 0)], "vessel string, ts string, x double, y double, status int").withColumn("ts", F.to_timestamp("ts"))
    nodes = spark.createDataFrame([("n1", 5.0, 52.0), ("n2", 5.0003, 52.0)], "id string, x double, y double")
    got = sorted((r.vessel, r.node) for r in positions.snapped(rows, nodes).collect())
    assert got == [("v1", "n1"), ("v1", "n2")]
    assert positions.latest(rows).where("vessel = 'v1'").first().x == 5.0002
    own = positions.described(rows.withColumns({f"dim_{c}": F.lit(1) for c in "abcd"})).collect()
    assert {r.status_text for r in own} == {"At anchor", "Other", "Under way using engine"} and own[0].length == 2


