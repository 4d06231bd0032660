import json

from navnet import cli


def test_build_validate_and_dropins(spark, tmp_path, capsys):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 10, 11), (2, 11, 12), (3, 12, None)], "id int, start_junction_id int, end_junction_id int").write.parquet(f"{src}/section.parquet")
    spark.createDataFrame([(10,), (11,), (12,), (13,)], "id int").write.parquet(f"{src}/routejunction.parquet")
    cli.main(["build", src, str(tmp_path / "g")])
    assert json.loads(capsys.readouterr().out) == {"components": 1, "edges": 2, "largest_component": 3, "nodes": 3}
    for part in ("nodes", "edges"):
        spark.read.parquet(str(tmp_path / "g" / part)).selectExpr("*", "'FIS' as data_source").write.parquet(str(tmp_path / "m" / part))
    cli.main(["validate", str(tmp_path / "m"), str(tmp_path / "report.md")])
    assert "| components | [(10, 3)] |" in (tmp_path / "report.md").read_text()
    spark.createDataFrame([("s", "a", "b", 100.0)], "section_id string, start string, end string, length double").write.parquet(f"{src}/sections")
    spark.createDataFrame([("s", 50.0, 10.0, "L")], "section_id string, distance double, buffer double, id string").write.parquet(f"{src}/cuts")
    cli.main(["cuts", src, str(tmp_path / "d")])
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2


def test_merge(spark, tmp_path, capsys):
    spark.createDataFrame([(1,)], "id int").write.parquet(str(tmp_path / "h/nodes"))
    spark.createDataFrame([(1, 1)], "src int, dst int").write.parquet(str(tmp_path / "h/edges"))
    spark.createDataFrame([("DE_1", "DE")], "id string, countrycode string").write.parquet(str(tmp_path / "f/nodes"))
    spark.createDataFrame([], "src string, dst string").write.parquet(str(tmp_path / "f/edges"))
    spark.createDataFrame([(1, "DE_1")], "home_node int, foreign_node string").write.parquet(str(tmp_path / "links"))
    cli.main(["merge", str(tmp_path / "m"), "--home", str(tmp_path / "h"), "--foreign", str(tmp_path / "f"), "--links", str(tmp_path / "links")])
    assert json.loads(capsys.readouterr().out)["edges"] == 2


def test_all_from_both_sources(spark, tmp_path, capsys):
    """Home and foreign sources to one graph: the foreign home-country node gives way to the home node beside it."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    line = "array<struct<x:double,y:double>>"
    p = lambda x, y: {"x": x, "y": y}
    spark.createDataFrame([(1, 1001, 1002, 1, [p(6.0, 51.9), p(6.1, 51.9)])], f"id int, start_junction_id int, end_junction_id int, `order` int, line {line}").write.parquet(f"{src}/home/section.parquet")
    spark.createDataFrame([(1001, 0.0, 0.0), (1002, -900.0, 0.0)], "id int, x double, y double").write.parquet(f"{src}/home/routejunction.parquet")
    rows = [("DE_1", "s1", None, "DE", 7000.0, 0.0, 1), ("NL_1", "s1", None, "NL", 10.0, 10.0, 2), ("NL_1", "s2", None, "NL", 10.0, 10.0, 3), ("NL_2", "s2", None, "NL", -900.0, 0.0, 4)]
    spark.createDataFrame(rows, "node_id string, sectionref string, borderpoint string, countrycode string, x double, y double, `order` int").selectExpr("*", "node_id as locode").write.parquet(f"{src}/foreign/nodes.parquet")
    spark.createDataFrame([("s1",), ("s2",)], "code string").write.parquet(f"{src}/foreign/sections.parquet")
    cli.main(["all", src, out, "--at-most", "500"])
    merged = {(r.src, r.dst) for r in spark.read.parquet(f"{out}/merged/edges").collect()}
    assert ("FIS_1001", "EURIS_DE_1") in merged and not any("NL_" in n for pair in merged for n in pair)
    assert abs(spark.read.parquet(f"{out}/home/edges").first().length_m - 6880) < 10 and "Network" in (tmp_path / "out" / "report.md").read_text()
    capsys.readouterr()
    cli.main(["stitch", str(tmp_path / "links"), "--home", f"{out}/home", "--foreign", f"{out}/foreign", "--at-most", "500"])
    assert [(r.home_node, r.foreign_node) for r in spark.read.parquet(str(tmp_path / "links")).collect()] == [(1001, "DE_1")]


def test_enrich(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 100, 0.0, 5.0, 7), (2, 100, 5.5, 10.0, 8)], "section_id int, route_id int, km_begin double, km_end double, fairway_id int").write.parquet(f"{src}/edges")
    spark.createDataFrame([(100, 0.0, 5.0, 3.5, 1)], "route_id int, km_begin double, km_end double, depth double, `order` int").write.parquet(f"{src}/dims")
    spark.createDataFrame([(7, "FW123", 1)], "fairway_id int, number string, `order` int").write.parquet(f"{src}/fairway")
    (tmp_path / "plan.json").write_text(json.dumps({"by_key": [["fairway", "fairway_id", "fairway_", ["number"]]], "by_range": [["dims", "dim_", ["depth"]]]}))
    cli.main(["enrich", src, str(tmp_path / "out"), "--plan", str(tmp_path / "plan.json")])
    assert {(r.section_id, r.fairway_number, r.dim_depth) for r in spark.read.parquet(str(tmp_path / "out" / "edges")).collect()} == {(1, "FW123", 3.5), (2, None, None)}
