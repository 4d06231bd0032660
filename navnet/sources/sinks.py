"""Sinks: partitioned tables, graph and table exports with summaries, reports as texts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..operators.relational import keep_first
from ..functions.scalars import stringify_id
from ..operators.schema import sanitized


def by_type(df: DataFrame, path: str, column: str = "GeoType") -> None:
    """JSON lines, a folder for each type."""
    df.write.partitionBy(column).mode("overwrite").json(path)


def voyage_months(df: DataFrame, path: str) -> None:
    """The voyage table, deduplicated on its trip columns, by year and two-digit month; a month is dealt by its rows' keys,
    not to one task."""
    keys = [c for c in ("jaarmaand", "v05_06_begindt_evenement", "unlo_herkomst", "unlo_bestemming", "sk_code", "v18_laadvermogen", "v38_vervoerd_gewicht") if c in df.columns]
    own = keep_first(df, keys, ["source_file", "row"])
    own = own.withColumn("year", F.col("file_year")).withColumn("month", F.lpad(F.col("file_month").cast("string"), 2, "0"))
    own.drop("source_file", "row", "file_year", "file_month").repartition("year", "month", F.pmod(F.xxhash64(*keys), F.lit(16))).write.partitionBy("year", "month").mode("overwrite").parquet(path)


def graph_summary(nodes: DataFrame, edges: DataFrame) -> dict:
    sizes = components(edges).groupBy("component").count()
    n, most = sizes.agg(F.count(F.lit(1)), F.max("count")).first()
    alone = nodes.select(F.col("id").alias("node")).join(edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), "node", "left_anti").count()
    return {"nodes": nodes.count(), "edges": edges.count(), "components": n + alone, "largest_component": most or min(alone, 1)}


def export_graph(nodes: DataFrame, edges: DataFrame, path: str) -> dict:
    """nodes and edges as Parquet, flat columns only, and summary.json; an empty side is an error."""
    for name, df in (("nodes", nodes), ("edges", edges)):
        if not df.limit(1).count():
            raise ValueError(f"no {name}")
        sanitized(df).write.mode("overwrite").parquet(f"{path}/{name}")
    summary = graph_summary(nodes, edges)
    nodes.sparkSession.createDataFrame([(json.dumps(summary, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/summary.json")
    return summary


def export_tables(tables: dict[str, DataFrame], path: str, needed: tuple[str, ...] = ()) -> list[str]:
    """Each table that has rows as Parquet; an empty one of `needed` is an error. The names written."""
    out = []
    for name, df in tables.items():
        if df.limit(1).count():
            sanitized(df, nested="json").write.mode("overwrite").parquet(f"{path}/{name}")
            out.append(name)
        elif name in needed:
            raise ValueError(f"{name} is empty")
    return out


def geojson_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """value: a GeoJSON feature for each row, a line or point (array of struct(x, y)) and the flat columns."""
    points = F.transform(line, lambda p: F.array(p["x"], p["y"]))
    geometry = F.when(F.size(line) == 1, F.struct(F.lit("Point").alias("type"), F.to_json(points[0]).alias("c"))).otherwise(F.struct(F.lit("LineString").alias("type"), F.to_json(points).alias("c")))
    flat = sanitized(df.drop(line)).columns
    return df.select(F.concat(F.lit('{"type":"Feature","geometry":{"type":"'), geometry["type"], F.lit('","coordinates":'), geometry["c"], F.lit('},"properties":'), F.to_json(F.struct(*flat)), F.lit("}")).alias("value"))


def report(title: str, sections: dict[str, list[tuple[str, object]]]) -> str:
    """A Markdown report of small figures."""
    out = [f"# {title}"]
    for name, rows in sections.items():
        out += ["", f"## {name}", "", "| what | value |", "|-|-|", *(f"| {k} | {v} |" for k, v in rows)]
    return "\n".join(out) + "\n"


def discrepancies(left: DataFrame, matches: DataFrame, left_id: str) -> tuple[DataFrame, DataFrame]:
    """Rows of left without a match, and left ids with several."""
    hit = matches.where(F.col("right_id").isNotNull()).select(F.col("left_id").alias(left_id))
    return left.join(hit, left_id, "left_anti"), hit.groupBy(left_id).count().where("count > 1")


def with_line(df: DataFrame, path: str, name: str, line: str = "geometry") -> None:
    """A table as Parquet (flat columns and the line) and as lines of GeoJSON features; ids are clean texts."""
    flat = sanitized(df.drop(line)).columns
    own = df.select(*[stringify_id(c).alias(c) if c == "id" or c.endswith("_id") else F.col(c) for c in flat], line)
    own.write.mode("overwrite").parquet(f"{path}/{name}")
    geojson_lines(own.where(F.size(line) > 0), line).write.mode("overwrite").text(f"{path}/{name}.geojson")


def export_schematization(complexes: DataFrame, tables: dict[str, DataFrame], path: str) -> list[str]:
    """summary.json, a line for each complex with all that is nested in it, and each table that has rows with its lines."""
    complexes.write.mode("overwrite").json(f"{path}/summary.json")
    out = []
    for name, df in tables.items():
        if df.limit(1).count():
            with_line(df, path, name) if "geometry" in df.columns else sanitized(df).write.mode("overwrite").parquet(f"{path}/{name}")
            out.append(name)
    return out


def export_assignment(trips: DataFrame, intensity: DataFrame, penalised: DataFrame | None, edges: DataFrame, path: str) -> None:
    """The layers of an assignment: intensity and penalised edges with their lines (edges: key, geometry), and the trips with
    their paths. No trips that got through is an error."""
    through = trips.where("status = 'success'")
    if not through.limit(1).count() or not intensity.limit(1).count():
        raise ValueError("no voyage was routed")
    lines = edges.select(F.col("key").alias("_key"), "geometry")
    with_line(intensity.join(lines, F.col("edge") == F.col("_key")).drop("_key"), path, "intensity")
    if penalised is not None and penalised.limit(1).count():
        with_line(penalised.join(lines, F.col("key") == F.col("_key")).drop("_key"), path, "penalised_edges")
    through.write.mode("overwrite").parquet(f"{path}/trips_with_paths")


def missing_artifacts(spark: SparkSession, path: str, needed: tuple[str, ...]) -> list[str]:
    """Names of needed that aren't in the folder, on any file system that Spark reads: a publication's check."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [n for n in needed if not files.exists(jvm.org.apache.hadoop.fs.Path(folder, n))]


def comparison_report(title: str, figures: dict[str, DataFrame], most: int = 50) -> str:
    """report() of small tables: a section each, of its first `most` rows by its first column."""
    sections = {}
    for name, df in figures.items():
        rows = df.orderBy(df.columns[0]).limit(most).collect()
        sections[name] = [(r[0], ", ".join(f"{c} {r[c]}" for c in df.columns[1:])) for r in rows]
    return report(title, sections)
