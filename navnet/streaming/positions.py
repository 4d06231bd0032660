"""Live vessel positions: snap to the nearest node, keep the latest per vessel, count by node. Windows and watermarks are
extensions of the snapshot that the positions come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Navigation status by number.
STATUS = {0: "Under way using engine", 1: "At anchor", 2: "Not under command", 3: "Restricted manoeuverability", 5: "Moored", 7: "Engaged in fishing", 8: "Under way sailing"}
METRES = 111320.0


def described(rows: DataFrame) -> DataFrame:
    """length and beam from the antenna's distances, status as text ('Other' if unknown)."""
    label = F.create_map(*[x for k, v in STATUS.items() for x in (F.lit(k), F.lit(v))])
    return rows.withColumns({"length": F.col("dim_a") + F.col("dim_b"), "beam": F.col("dim_c") + F.col("dim_d"), "status_text": F.coalesce(F.try_element_at(label, F.col("status")), F.lit("Other"))})


def snapped(rows: DataFrame, nodes: DataFrame, at_most: float = 200.0, most_nodes: int = 100_000, cell: float = 0.01) -> DataFrame:
    """rows (vessel, ts, x, y in degrees), streamed or not, with node and distance_m of their nearest node (id, x, y)
    within at_most metres; others are left out. The network's size is checked before it is broadcast, by cells: a row
    meets only the nodes around it (cell must be wider than at_most)."""
    if nodes.limit(most_nodes + 1).count() > most_nodes:
        raise ValueError(f"more than {most_nodes} nodes")
    span = F.sequence(F.lit(-1), F.lit(1))
    near = nodes.select(F.col("id").alias("node"), F.col("x").alias("nx"), F.col("y").alias("ny"))
    near = near.withColumn("cx", F.explode(F.transform(span, lambda d: F.floor(F.col("nx") / cell) + d))).withColumn("cy", F.explode(F.transform(span, lambda d: F.floor(F.col("ny") / cell) + d)))
    lists = near.groupBy("cx", "cy").agg(F.collect_list(F.struct("node", "nx", "ny")).alias("near"))
    own = rows.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell)).join(F.broadcast(lists), ["cx", "cy"])
    d2 = lambda n: F.pow(n["nx"] - F.col("x"), 2) + F.pow(n["ny"] - F.col("y"), 2)
    best = F.array_min(F.transform("near", lambda n: F.struct(d2(n).alias("d2"), n["node"].alias("node"))))
    out = own.withColumn("b", best).withColumn("node", F.col("b.node")).withColumn("distance_m", F.sqrt("b.d2") * METRES)
    return out.where(F.col("distance_m") <= at_most).drop("cx", "cy", "near", "b")


def latest(rows: DataFrame) -> DataFrame:
    """The newest row of each vessel of a table."""
    cols = [c for c in rows.columns if c != "vessel"]
    return rows.groupBy("vessel").agg(F.max_by(F.struct(*cols), F.struct("ts", *[c for c in cols if c != "ts"])).alias("r")).select("vessel", "r.*")


def node_counts(rows: DataFrame, window: str = "10 minutes", late: str = "10 minutes", key: Column | str = "node") -> DataFrame:
    """node, start, vessels: distinct vessels by node and window of a stream (approximate in a stream, as it must be)."""
    own = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return own.groupBy(F.window("ts", window), key).agg(F.approx_count_distinct("vessel").alias("vessels")).select("node", F.col("window.start").alias("start"), "vessels")


def busiest(rows: DataFrame, k: int = 5) -> DataFrame:
    return rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "node").limit(k)
