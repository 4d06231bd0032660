"""Validation of a network: figures with a status each, small enough for a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import component_sizes


def length_figures(edges: DataFrame, measured: str = "geometry_m", given: str = "length_m") -> DataFrame:
    """One row of differences between measured and given lengths: status is PASS below 5 % over a metre."""
    d = F.abs(F.col(measured) - F.col(given))
    row = edges.agg(F.count(F.lit(1)).alias("edges"), F.count_if(d > 1).alias("over_1m"), F.max(d).alias("largest"), F.count_if(F.col(measured) < 1e-3).alias("zero"), F.avg(d).alias("mean"))
    return row.withColumn("status", F.when(F.col("over_1m") < 0.05 * F.greatest(F.lit(1), "edges"), "PASS").otherwise("FAIL"))


def edge_lengths(edges: DataFrame, measured: str = "geometry_m", given: str = "length_m") -> dict:
    return length_figures(edges, measured, given).first().asDict()


def border_figures(edges: DataFrame, expected: int = 14) -> DataFrame:
    """One row on the border edges and their gaps; PASS with as many as expected."""
    g = F.col("distance").cast("double")
    row = edges.where("data_source = 'BORDER'").agg(F.count(F.lit(1)).alias("total"), F.min(g).alias("min_gap"), F.max(g).alias("max_gap"), F.avg(g).alias("avg_gap"))
    return row.withColumn("status", F.when(F.col("total") >= expected, "PASS").otherwise("WARNING"))


def borders(edges: DataFrame, expected: int = 14) -> dict:
    return border_figures(edges, expected).first().asDict()


def connection(edges: DataFrame, part: str) -> dict:
    """Whether a border edge has an end that contains the text."""
    hit = edges.where((F.col("data_source") == "BORDER") & (F.col("src").contains(part) | F.col("dst").contains(part))).limit(1).count()
    return {"status": "PASS" if hit else "FAIL"}


def statistics(nodes: DataFrame, edges: DataFrame, top: int = 10) -> dict:
    """Counts by source, and the components: the `top` largest, or all of more than one node."""
    sizes = component_sizes(edges).where("size > 1").limit(top).collect()
    return {"nodes": {r[0]: r[1] for r in nodes.groupBy("data_source").count().collect()}, "edges": {r[0]: r[1] for r in edges.groupBy("data_source").count().collect()}, "components": [(r.component, r["size"]) for r in sizes]}


def names(df: DataFrame) -> list[str]:
    """Columns that aren't in canonical (small letter) form."""
    return sorted(c for c in df.columns if c != c.lower())


def dropin_figures(features: DataFrame) -> DataFrame:
    """One row: existence of lock and bridge passages, and spliced segments."""
    return features.agg(F.bool_or(F.col("type").startswith("lock")).alias("locks"), F.bool_or(F.col("type").startswith("bridge")).alias("bridges"), F.count_if(F.coalesce(F.col("is_splice"), F.lit(False)) if "is_splice" in features.columns else F.lit(False)).alias("splices"))


def dropins(features: DataFrame) -> dict:
    row = dropin_figures(features).first().asDict()
    return row | {"status": "PASS" if row["locks"] and row["bridges"] and row["splices"] else "WARNING"}
