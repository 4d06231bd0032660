"""Traffic assignment: voyages grouped, geocoded, routed under vessel limits, and summed by edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .graph import route
from .network import penalty_sums
from .relational import edge_intensity, group_voyages, top_record

#: Kinds of limits that a vessel can exceed.
KINDS = ("lock", "bridge", "fairway", "sea", "cemt")


def locode_nodes(nodes: DataFrame) -> DataFrame:
    """code, node, rank, x, y: nodes (id, locode, kind, x, y) by location code and by its first five characters; harbours
    rank before terminals before others."""
    code = F.upper(F.trim("locode"))
    rank = F.when(F.col("kind") == "harbour", 0).when(F.col("kind") == "terminal", 1).otherwise(2)
    own = nodes.where(F.length(code) > 0).select(F.explode(F.array_distinct(F.array(code, F.substring(code, 1, 5)))).alias("code"), F.col("id").alias("node"), rank.alias("rank"), "x", "y")
    return own.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def geocode(codes: DataFrame, nodes: DataFrame, places: DataFrame, nearest: DataFrame | None = None) -> DataFrame:
    """code, node: of each code (a table of them) the node of the least 10 * rank + squared degrees to the code's own place
    (places: code, x, y; 0 without one), by the whole code or its first five characters; else the nearest node of the place
    (nearest: left_id, right_id); else null. Ties: the smaller node."""
    asked = codes.select("code").distinct().withColumn("_c", F.upper(F.trim("code")))
    keys = asked.withColumn("_k", F.explode(F.array_distinct(F.array("_c", F.substring("_c", 1, 5)))))
    own = keys.join(locode_nodes(nodes).withColumnRenamed("code", "_k"), "_k").join(places.select(F.col("code").alias("_c"), F.col("x").alias("px"), F.col("y").alias("py")), "_c", "left")
    d2 = F.coalesce(F.pow(F.col("x") - F.col("px"), 2) + F.pow(F.col("y") - F.col("py"), 2), F.lit(0.0))
    best = own.groupBy("code").agg(F.min_by("node", F.struct((10.0 * F.col("rank") + d2).alias("s"), "node")).alias("_best"))
    out = asked.join(best, "code", "left")
    if nearest is None:
        return out.select("code", F.col("_best").alias("node"))
    out = out.join(nearest.select(F.col("left_id").alias("_c"), "right_id"), "_c", "left")
    return out.select("code", F.coalesce("_best", "right_id").alias("node"))


def penalty_columns(edges: DataFrame, beam: float, length: float, cemt: str) -> Column:
    """Penalties of a vessel on edges with chambers and openings (arrays of struct(id, name, width, length, minutes))."""
    edge = F.struct(F.col("key").alias("id"), F.col("name").alias("name"), F.col("width").cast("double").alias("width"))
    limit = S.narrowest("chambers", "openings", edge)
    shortest = F.array_min(F.transform("chambers", lambda c: c["length"].cast("double")))
    return S.soft_penalties(F.lit(beam), F.lit(length), F.lit(cemt), limit, shortest, F.col("water_name"), F.col("cemt_class"))


def weight_column(edges: DataFrame, beam: float, length: float, cemt: str) -> Column:
    speeds = [F.col(c) for c in S.SPEED_COLUMNS if c in edges.columns]
    minutes = F.transform("chambers", lambda c: c["minutes"].cast("double"))
    return S.edge_weight(F.col("length_m"), S.edge_speed(speeds), minutes, penalty_columns(edges, beam, length, cemt)["total"])


def assign(voyages: DataFrame, codes: DataFrame, edges: DataFrame, vessels: dict[str, tuple[float, float, str]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """trips with their paths, intensity by edge, counts by status.

    voyages: origin, destination, class_code, cargo, capacity, event. codes: geocode(). vessels: beam, length and class by
    code; a voyage of another class sails as the default vessel (class '')."""
    default = S.VESSEL_DEFAULT
    known = {"": (default["beam"], default["length"], default["cemt"]), **vessels}
    own = voyages.dropna(subset=["origin", "destination", "class_code"]).withColumn("class_code", S.normalize_class_code("class_code"))
    own = own.withColumn("class_code", F.when(F.col("class_code").isin(*known), F.col("class_code")).otherwise(F.lit("")))
    groups = group_voyages(own, ["origin", "destination", "class_code"], "cargo", "capacity", "event")
    for side in ("origin", "destination"):
        groups = groups.join(codes.select(F.col("code").alias(side), F.col("node").alias(f"{side}_node")), side, "left")
    trips = route(groups, edges, "class_code", {k: weight_column(edges, *v) for k, v in known.items()})
    return trips, edge_intensity(trips.where("status = 'success'"), "edges"), trips.groupBy("status").agg(F.count(F.lit(1)).alias("groups"), F.sum("trips").alias("trips"))


def passed(trips: DataFrame, edges: DataFrame, vessels: dict[str, tuple[float, float, str]]) -> DataFrame:
    """key, class_code, trips, total_cargo, origin, destination and the penalties by kind and in total, of every edge that a
    routed group passes."""
    default = S.VESSEL_DEFAULT
    known = {"": (default["beam"], default["length"], default["cemt"]), **vessels}
    used = trips.where("status = 'success'").select("class_code", "trips", "total_cargo", "origin", "destination", F.explode("edges").alias("key"))
    chosen = None
    for code, vessel in known.items():
        own = penalty_columns(edges, *vessel)
        chosen = F.when(F.col("class_code") == code, own) if chosen is None else chosen.when(F.col("class_code") == code, own)
    return used.join(edges, "key").select("key", "class_code", "trips", "total_cargo", "origin", "destination", *[chosen[k].alias(k) for k in (*KINDS, "total")])


def with_penalties(intensity: DataFrame, trips: DataFrame, edges: DataFrame, vessels: dict[str, tuple[float, float, str]]) -> DataFrame:
    """intensity (edge, ...) with the penalties of the trips over each edge, by kind and in total, summed by trips."""
    return intensity.join(penalty_sums(passed(trips, edges, vessels).withColumnRenamed("key", "edge")), "edge", "left")


def penalised(trips: DataFrame, edges: DataFrame, vessels: dict[str, tuple[float, float, str]]) -> DataFrame:
    """Per edge and kind of limit that is exceeded: trips, cargo, and the class of the group with most trips."""
    over = F.filter(F.array(*[F.when(F.col(k) > 0, F.lit(k)) for k in KINDS]), lambda k: k.isNotNull())
    flat = passed(trips, edges, vessels).select("key", "class_code", "trips", "total_cargo", "origin", "destination", F.explode(over).alias("kind"))
    return top_record(flat, ["key", "kind"], "trips", ["class_code", "origin", "destination"], ["class_code"], ["trips", "total_cargo"])
