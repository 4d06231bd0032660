"""File sources: lines of JSON, GeoJSON collections, zipped CSV, workbooks, SQLite tables, Parquet bundles.

Every reader returns a DataFrame. Archives and workbooks are read by the tasks from binaryFile rows, one file a row.
"""

from __future__ import annotations

import csv
import io
import re
import sqlite3
import struct
import tempfile
import warnings
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import file_year_month, stringify_id, to_long, year_month_key

#: The voyage table's columns by kind.
VOYAGE_LONG = ("jaarmaand", "jaar", "maand", "weeknr")
VOYAGE_TIME = "v05_06_begindt_evenement_iso"
VOYAGE_TEXT = ("v05_06_begindt_evenement", "unlo_herkomst", "unlo_bestemming", "v15_1_scheepstype_rws", "sk_code", "nstr_nw", "nst2007_nw")
VOYAGE_DOUBLE = ("v18_laadvermogen", "v28_beladingscode", "v38_vervoerd_gewicht", "v30_4_containers_teu_s")
VOYAGE_COLUMNS = (*VOYAGE_LONG, VOYAGE_TIME, *VOYAGE_TEXT, *VOYAGE_DOUBLE)


def json_lines(spark: SparkSession, path: str, codes: DataFrame | None = None, key: str = "IsrsId") -> DataFrame:
    """JSON lines, with the location codes of `codes` (Id, ...) joined to key, their columns suffixed _isrs."""
    rows = spark.read.json(path)
    if codes is None or key not in rows.columns:
        return rows
    own = codes.select(*[F.col(c).alias(f"{c}_isrs") for c in codes.columns])
    return rows.join(own, stringify_id(F.col(key)) == stringify_id(F.col("Id_isrs")), "left")


def geojson(spark: SparkSession, path: str, properties: str, coordinates: str = "array<double>") -> DataFrame:
    """A row for each feature of the collections at path: the properties (a DDL schema), geometry_type, coordinates (of the
    given type), path, and country from the file's name (<Kind>_<CC>_<date>)."""
    schema = f"features array<struct<properties:struct<{_as_struct(properties)}>,geometry:struct<type:string,coordinates:{coordinates}>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select("*", F.col("_metadata.file_path").alias("path"))
    rows = rows.select("path", F.explode("features").alias("f"))
    country = F.regexp_extract("path", r"_([A-Z]{2})_[^/]*$", 1)
    return rows.select("f.properties.*", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"), "path", country.alias("country"))


def _as_struct(ddl: str) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl).fields)


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """<name>.geoparquet if it can be read, else <name>.parquet; a column Geometry is named geometry."""
    from pyspark.errors import AnalysisException

    for suffix in ("geoparquet", "parquet"):
        try:
            df = spark.read.parquet(f"{folder}/{name}.{suffix}")
            return df.withColumnRenamed("Geometry", "geometry") if "geometry" not in df.columns else df
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"{folder}/{name}.parquet")


def bundle(spark: SparkSession, folder: str, required: tuple[str, ...], optional: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Tables by name; a required one that is absent is an error, an optional one a warning."""
    out = {}
    for name in (*required, *optional):
        try:
            out[name] = parquet_table(spark, folder, name)
        except FileNotFoundError:
            if name in required:
                raise
            warnings.warn(f"{name} is absent", stacklevel=2)
    return out


def zipped_voyages(spark: SparkSession, path: str) -> DataFrame:
    """The weekly voyage files at path: zips with one CSV by semicolons, headers in any case. All VOYAGE_COLUMNS, typed,
    absent ones null, and source_file, row, file_year, file_month (by name, else by the first row).

    A cell that can't be read is 0 in a whole-number column and null in another; it doesn't cost the file. A file that is
    no such zip gives no rows."""
    names = VOYAGE_COLUMNS
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as f:
                        reader = csv.reader(io.TextIOWrapper(f, "utf-8", errors="replace"), delimiter=";")
                        head = [h.strip().lower() for h in next(reader, [])]
                        place = [head.index(c) if c in head else None for c in names]
                        block = []
                        for n, line in enumerate(reader):
                            block.append([name, n, *(line[p] if p is not None and p < len(line) and line[p] != "" else None for p in place)])
                            if len(block) == 50_000:
                                yield pd.DataFrame(block, columns=["source_file", "row", *names])
                                block = []
                        yield pd.DataFrame(block, columns=["source_file", "row", *names])
                except (zipfile.BadZipFile, IndexError):
                    continue

    raw = files.mapInPandas(run, ", ".join(["source_file string", "row bigint", *(f"{c} string" for c in names)]))
    typed = {c: to_long(c) for c in VOYAGE_LONG} | {VOYAGE_TIME: F.try_to_timestamp(VOYAGE_TIME)} | {c: F.col(c).try_cast("double") for c in VOYAGE_DOUBLE}
    typed["jaarmaand"] = year_month_key("jaarmaand", "jaar", "maand")
    named = file_year_month(F.regexp_extract("source_file", r"([^/]+)$", 1))
    first = raw.where("row = 0").select("source_file", named.alias("f"), to_long("jaar").cast("int").alias("y"), to_long("maand").cast("int").alias("m"))
    first = first.select("source_file", F.coalesce("f.year", "y").alias("file_year"), F.coalesce("f.month", "m").alias("file_month"))
    return raw.select("source_file", "row", *[typed.get(c, F.col(c)).alias(c) for c in names]).join(first, "source_file")


def voyages(spark: SparkSession, base: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """The written voyage table, of one month or all: a filter on its partition columns."""
    df = spark.read.parquet(base)
    return df if year is None else df.where((F.col("year") == year) & (F.col("month").cast("int") == month))


def workbook(spark: SparkSession, path: str, header_row: int = 1) -> DataFrame:
    """Rows of the first sheet of each .xlsx at path: path, row, cells (map of header to text). header_row counts from 0."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

    def column(ref: str) -> int:
        n = 0
        for ch in re.match("[A-Z]+", ref)[0]:
            n = 26 * n + ord(ch) - 64
        return n - 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    shared = []
                    if "xl/sharedStrings.xml" in z.namelist():
                        shared = ["".join(t.text or "" for t in s.iter(f"{space}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{space}si")]
                    sheet = sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet"))[0]
                    rows = []
                    for r in ElementTree.fromstring(z.read(sheet)).iter(f"{space}row"):
                        cells = {}
                        for c in r.iter(f"{space}c"):
                            v, inline = c.find(f"{space}v"), c.find(f"{space}is")
                            text = "".join(t.text or "" for t in inline.iter(f"{space}t")) if inline is not None else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
                            if text is not None:
                                cells[column(c.get("r"))] = text
                        rows.append(cells)
                head = rows[header_row] if len(rows) > header_row else {}
                yield pd.DataFrame({"path": name, "row": n, "cells": {head[k]: v for k, v in cells.items() if k in head}} for n, cells in enumerate(rows[header_row + 1 :]))

    return files.mapInPandas(run, "path string, row bigint, cells map<string,string>")


def index_workbook(spark: SparkSession, path: str, renames: dict[str, str]) -> DataFrame:
    """The location index: renamed columns of workbook(), of rows whose isrs_code has over ten characters. A column that no
    row has is an error."""
    rows = workbook(spark, path)
    have = {r[0] for r in rows.select(F.explode(F.map_keys("cells"))).distinct().collect()}
    if absent := sorted(set(renames) - have):
        raise ValueError(f"columns are absent: {absent}")
    return rows.select(*[F.try_element_at("cells", F.lit(k)).alias(v) for k, v in renames.items()]).where(F.length("isrs_code") > 10)


def sqlite_table(spark: SparkSession, path: str, sql: str, schema: str) -> DataFrame:
    """Rows of a query on each SQLite (or GeoPackage) file at path, read by the tasks."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with tempfile.NamedTemporaryFile(suffix=".sqlite") as f:  # the task's own scratch copy, gone with it
                    f.write(content)
                    f.flush()
                    with sqlite3.connect(f.name) as db:
                        cursor = db.execute(sql)
                        while rows := cursor.fetchmany(50_000):
                            yield pd.DataFrame(rows, columns=names)

    return files.mapInPandas(run, schema)


def vessel_classes(spark: SparkSession, path: str) -> DataFrame:
    """The vessel database, a JSON array: the last entry of each class code (upper case, trimmed)."""
    rows = spark.read.option("multiLine", True).json(path)
    code = F.trim(F.upper(F.col("`RWS-class`")))
    keyed = rows.where(F.length(code) > 0).withColumn("class_code", code).withColumn("_n", F.monotonically_increasing_id())
    others = [c for c in rows.columns]
    return keyed.groupBy("class_code").agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), "_n").alias("r")).select("class_code", "r.*")


def latest_files(listing: DataFrame) -> DataFrame:
    """name, last_modified of the newest file of each (country, dataset) of a listing (name: <dataset>_<CC>_...)."""
    own = listing.withColumn("dataset", F.regexp_extract("name", r"^(\w+?)_([A-Z]{2})_", 1)).withColumn("country", F.regexp_extract("name", r"^(\w+?)_([A-Z]{2})_", 2)).where("country <> ''")
    return own.groupBy("country", "dataset").agg(F.max_by("name", F.struct("last_modified", "name")).alias("name"), F.max("last_modified").alias("last_modified"))


#: A location whose place is wrong in the reference data, and its place in degrees.
CORRECTED_PLACES = {"NLNTJ": (3.7115, 51.6391)}


def corrected_places(rows: DataFrame) -> DataFrame:
    """code, x, y of the rows (country_code, location_code, x, y) that have a place: the code is country and location."""
    code = F.concat("country_code", "location_code")
    x, y = F.col("x"), F.col("y")
    for name, (lon, lat) in CORRECTED_PLACES.items():
        x, y = F.when(code == name, lon).otherwise(x), F.when(code == name, lat).otherwise(y)
    return rows.select(code.alias("code"), x.alias("x"), y.alias("y")).where("code is not null and x is not null and y is not null")


def location_codes(spark: SparkSession, path: str, table: str = "unlo") -> DataFrame:
    """corrected_places() of a GeoPackage whose points are in `table`; a point's coordinates are the last 16 bytes."""
    rows = sqlite_table(spark, path, f"SELECT country_code, location_code, geom FROM {table} WHERE geom IS NOT NULL", "country_code string, location_code string, geom binary")  # noqa: S608

    @F.pandas_udf("struct<x:double,y:double>")
    def place(blob: pd.Series) -> pd.DataFrame:
        xy = [struct.unpack("<dd", bytes(b)[-16:]) if b is not None and len(b) >= 21 else (None, None) for b in blob]
        return pd.DataFrame(xy, columns=["x", "y"], dtype=float)

    return corrected_places(rows.select("country_code", "location_code", place("geom").alias("p")).select("country_code", "location_code", "p.x", "p.y"))


def od_matrix(spark: SparkSession, path: str, origin: str, destination: str, weight: str) -> DataFrame:
    """origin, destination, weight of a CSV matrix with a header; other columns are not parsed."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(F.col(f"`{origin}`").alias("origin"), F.col(f"`{destination}`").alias("destination"), F.col(f"`{weight}`").try_cast("double").alias("weight"))


def border_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """The table of border nodes, if the folder has one; else an empty table of its columns."""
    from pyspark.errors import AnalysisException

    try:
        return parquet_table(spark, folder, "border_nodes")
    except (AnalysisException, FileNotFoundError):
        return spark.createDataFrame([], "node_id string, borderpoint string, locode string")


def captured_pages(spark: SparkSession, path: str, result: str) -> DataFrame:
    """The rows of a paged service's captured answers (JSON lines of {"Result": [...], "Offset", "TotalCount"}): result is
    their DDL. A page that was captured again counts once, and a type whose pages don't reach its total is an error."""
    pages = spark.read.schema(f"GeoType string, Offset bigint, TotalCount bigint, Result array<struct<{_as_struct(result)}>>").json(path)
    last = pages.groupBy("GeoType", "Offset").agg(F.max_by(F.struct("TotalCount", "Result"), F.size("Result")).alias("p"))
    got = last.groupBy(F.col("GeoType").alias("_type")).agg(F.sum(F.size("p.Result")).alias("_got"), F.max("p.TotalCount").alias("_all"))
    whole = F.when(F.col("_got") >= F.coalesce("_all", F.lit(0)), True).otherwise(F.raise_error(F.concat(F.lit("pages are missing of "), F.col("_type"))).cast("boolean"))
    rows = last.join(got.where(whole), F.col("GeoType").eqNullSafe(F.col("_type")))
    return rows.select("GeoType", F.explode("p.Result").alias("r")).select("GeoType", "r.*")


def feature_rows(spark: SparkSession, path: str, layers: tuple[str, ...], properties: str) -> DataFrame:
    """layer, properties, geometry (as text) of captured feature answers, a file <layer>.json each: layers that weren't
    captured have no rows, other files are left out."""
    schema = f"features array<struct<properties:struct<{_as_struct(properties)}>,geometry:string>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("layer"), F.explode("features").alias("f"))
    return rows.where(F.col("layer").isin(*layers)).select("layer", "f.properties.*", "f.geometry")
