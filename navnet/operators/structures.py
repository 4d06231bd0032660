"""Complexes of locks and bridges, their features in a detailed graph, and bridges embedded in lock chambers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from .schema import nested
from .spatial import greedy_pairs, within_distance


def split_around(line: Column, at: Column, openings: Column, buffer: float) -> Column:
    """struct(before, after, split_at, merge_at): the line up to and from a structure at a length along it. The buffer grows
    to the farthest opening (an array of lengths) and 100 m beyond it, as far as the line has room."""
    total = G.line_length(line)

    def reach(o: Column) -> Column:
        off = F.abs(o - at)
        room = F.when(o >= at, total - o).otherwise(o)
        return off + F.least(F.lit(100.0), F.greatest(F.lit(0.0), room))

    size = F.greatest(F.lit(float(buffer)), F.coalesce(F.array_max(F.transform(openings, reach)), F.lit(0.0)))
    a, b = F.greatest(F.lit(0.0), at - size), F.least(total, at + size)
    return F.struct(G.substring(line, F.lit(0.0), a).alias("before"), G.substring(line, b, total).alias("after"), a.alias("split_at"), b.alias("merge_at"))


def related_sections(structures: DataFrame, sections: DataFrame, near: DataFrame) -> DataFrame:
    """structures (id, section_id) with sections: an array of struct(relation, id); 'direct' for the section that the
    structure names, else 'overlap' for those near it (near: left_id, right_id). Each section once, direct first."""
    direct = structures.join(sections.select(F.col("id").alias("_s")), F.col("section_id") == F.col("_s")).select("id", F.struct(F.lit("direct").alias("relation"), F.col("_s").alias("id")).alias("s"))
    over = near.where(F.col("right_id").isNotNull()).select(F.col("left_id").alias("id"), F.struct(F.lit("overlap").alias("relation"), F.col("right_id").alias("id")).alias("s"))
    first = direct.unionByName(over).groupBy("id", F.col("s.id").alias("_s")).agg(F.min("s").alias("s"))
    own = first.groupBy("id").agg(F.sort_array(F.collect_list("s")).alias("sections"))
    none = f"cast(array() as {own.schema['sections'].dataType.simpleString()})"
    return structures.join(own, "id", "left").withColumn("sections", F.coalesce("sections", F.expr(none)))


def complexes(structures: DataFrame, children: DataFrame, parent: str, grandchildren: DataFrame | None = None, grandparent: str = "parent_id", ignored: tuple[str, ...] = ()) -> DataFrame:
    """structures (id, ...) with children: an array of structs by id (and theirs as subchildren); ids clean, ignored ones
    left out."""
    own = structures.withColumn("id", S.stringify_id("id")).where(~F.col("id").isin(*ignored)) if ignored else structures.withColumn("id", S.stringify_id("id"))
    kids = children.withColumn("id", S.stringify_id("id")).withColumn(parent, S.stringify_id(parent))
    if grandchildren is not None:
        below = grandchildren.withColumn("id", S.stringify_id("id")).withColumn(grandparent, S.stringify_id(grandparent))
        kids = nested(kids, below, "id", grandparent, "subchildren", "id")
    return nested(own, kids, "id", parent, "children", "id")


def matched_registry(objects: DataFrame, chambers: DataFrame, radius: float, buffered: bool) -> DataFrame:
    """left_id, right_id: objects of the asset registry at chambers: touching ones, and for those that touch none within
    the radius; with buffered, all within it."""
    if buffered:
        return within_distance(objects, chambers, radius).select("left_id", "right_id")
    strict = within_distance(objects, chambers, 1e-6)
    rest = objects.join(strict.select(F.col("left_id").alias("id")), "id", "left_anti")
    return strict.unionByName(within_distance(rest, chambers, radius)).select("left_id", "right_id")


def berth_candidates(berths: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """Those of the categories, and those without one."""
    return berths.where(F.col("category").isNull() | F.col("category").isin(*categories))


def nearby_berths(locks: DataFrame, berths: DataFrame, at_most: float = 2000.0, categories: tuple[str, ...] = ("WAITING_AREA",)) -> DataFrame:
    """lock_id, berth_id, dist_m of the berths (id, category, fairway_id, lon, lat) within at_most metres of a lock (id,
    fairways, lon, lat) on its fairways (none: on any), of the categories or without one. Distances are geodesic; cells of
    degrees choose the candidates."""
    cell = at_most / 55_000.0
    span = F.sequence(F.lit(-1), F.lit(1))
    own = berth_candidates(berths, categories)
    b = own.select(F.col("id").alias("berth_id"), F.col("fairway_id").alias("_f"), F.col("lon").alias("_x"), F.col("lat").alias("_y")).withColumn("cx", F.floor(F.col("_x") / cell)).withColumn("cy", F.floor(F.col("_y") / cell))
    l = locks.withColumn("cx", F.explode(F.transform(span, lambda d: F.floor(F.col("lon") / cell) + d))).withColumn("cy", F.explode(F.transform(span, lambda d: F.floor(F.col("lat") / cell) + d)))
    on = l.join(b, ["cx", "cy"]).where(F.coalesce(F.size("fairways") <= 0, F.lit(True)) | F.array_contains("fairways", F.col("_f")))
    d = on.withColumn("dist_m", F.round(G.geodesic_metres("lon", "lat", "_x", "_y"), 1)).where(F.col("dist_m") <= at_most)
    return d.select(F.col("id").alias("lock_id"), "berth_id", "dist_m")


def _f(i: Column, feature: str, kind: str, a: Column | None = None, b: Column | None = None, child: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(i.alias("id"), F.lit(feature).alias("feature_type"), F.lit(kind).alias("type"), (null if a is None else a).alias("source_node"), (null if b is None else b).alias("target_node"), (null if child is None else child).alias("child_id"))


def detailed_features(own: DataFrame, kind: str) -> DataFrame:
    """Features of each complex (id, children: array of struct(id, ...)): nodes where it splits and merges, and for each
    chamber (kind lock) or opening (bridge) its start and end nodes and the edges to, through and from it. A bridge without
    openings has one by the name virtual_<id>."""
    child, inner = ("chamber", "route") if kind == "lock" else ("opening", "passage")
    cid = F.col("id").cast("string")
    ids = F.transform("children", lambda c: c["id"].cast("string"))
    if kind == "bridge":
        ids = F.when(F.size(ids) > 0, ids).otherwise(F.array(F.concat(F.lit("virtual_"), cid)))
    name = lambda part: F.concat(F.lit(f"{kind}_"), cid, F.lit(f"_{part}"))

    def of(c: Column) -> Column:
        n = lambda part: F.concat(F.lit(f"{child}_"), c, F.lit(f"_{part}"))
        edge = lambda part, a, b: _f(n(part), "fairway_segment", f"{child if kind == 'lock' else 'bridge'}_{part}", a, b, c)
        return F.array(_f(n("start"), "node", f"{child}_start", child=c), _f(n("end"), "node", f"{child}_end", child=c), edge("approach", name("split"), n("start")), edge(inner, n("start"), n("end")), edge("exit", n("end"), name("merge")))

    ends = F.array(_f(name("split"), "node", f"{kind}_split"), _f(name("merge"), "node", f"{kind}_merge"))
    return own.select(cid.alias("structure_id"), F.explode(F.concat(ends, F.flatten(F.transform(ids, of)))).alias("f")).select("structure_id", F.lit(kind).alias("structure_type"), "f.*")


def embedded(openings: DataFrame, chambers: DataFrame, at_most: float = 500.0) -> DataFrame:
    """left (opening), right (chamber), score, distance of bridges that belong to a chamber: greedy one-to-one by names and
    nearness, of candidates within at_most metres and a score over 1. Both tables: id, name, x, y."""
    near = within_distance(openings, chambers, at_most)
    named = near.join(openings.select(F.col("id").alias("left_id"), F.lower("name").alias("_a")), "left_id").join(chambers.select(F.col("id").alias("right_id"), F.lower("name").alias("_b")), "right_id")
    scored = named.select(F.col("left_id").alias("left"), F.col("right_id").alias("right"), S.name_score(F.coalesce("_a", F.lit("")), F.coalesce("_b", F.lit("")), "distance").alias("score"), "distance")
    return greedy_pairs(scored.where("score > 1"))


def inject(features: DataFrame, pairs: DataFrame, distances: DataFrame) -> DataFrame:
    """features with each embedded bridge in its chamber: the nearest edge of the chamber (distances: opening, edge,
    distance; within a millimetre approach and exit go before the route) is replaced by two parts to and from the opening,
    and the bridge's own ends, approach and exit go. pairs: left (opening), right (chamber).

    If distances has each edge's geometry (a line) and the opening's point too, the line is cut where it is nearest to the
    point, the parts end and begin in the point, and they have a line and a length_m, which is 0 where nothing is left."""
    edges = features.where("feature_type = 'fairway_segment' and structure_type = 'lock'").select(F.col("id").alias("edge"), "type", "source_node", "target_node", "structure_id", "structure_type", "child_id")
    own = pairs.select(F.col("left").cast("string").alias("opening"), F.col("right").cast("string").alias("child_id")).join(edges, "child_id").join(distances, ["opening", "edge"])
    drawn = {"geometry", "point"} <= set(distances.columns)
    kept = ["edge", "source_node", "target_node", "structure_id", "structure_type", "child_id", "type", *(["geometry", "point"] if drawn else [])]
    best = own.groupBy("opening").agg(F.min(F.struct(F.round("distance", 3).alias("d"), (F.col("type") == "chamber_route").alias("route"), *kept)).alias("b"))
    if drawn:
        best = best.withColumn("cut", G.cut_to_point(F.col("b.geometry"), F.col("b.point")))
    end = lambda e: F.concat(F.lit("opening_"), F.col("opening"), F.lit(f"_{e}"))

    def part(n: int, a: Column, b: Column, side: str) -> Column:
        line = [F.col(f"cut.{side}").alias("line"), F.when(F.col(f"cut.{side}_empty"), 0.0).otherwise(G.line_length(F.col(f"cut.{side}"))).alias("length_m")] if drawn else []
        return F.struct(F.concat(F.col("b.edge"), F.lit(f"_part{n}")).alias("id"), a.alias("source_node"), b.alias("target_node"), *line)

    parts = F.array(part(1, F.col("b.source_node"), end("start"), "before"), part(2, end("end"), F.col("b.target_node"), "after"))
    made = best.select("b.structure_id", "b.structure_type", "b.type", "b.child_id", F.explode(parts).alias("p"))
    made = made.select("structure_id", "structure_type", "p.id", F.lit("fairway_segment").alias("feature_type"), "type", "p.source_node", "p.target_node", "child_id", *(["p.line", "p.length_m"] if drawn else []))
    hosts = hosting(features, pairs)
    gone = features.where("structure_type = 'bridge' and type in ('bridge_split', 'bridge_merge', 'bridge_approach', 'bridge_exit')").join(hosts, "structure_id", "left_semi").select("id")
    rest = features.join(gone.union(best.select("b.edge")), "id", "left_anti")
    common = [c for c in made.columns if c not in ("line", "length_m") or c in features.columns]
    return rest.select(*common).unionByName(made, allowMissingColumns=True)


def hosting(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """structure_id of the bridges of which an opening is in a chamber."""
    return features.where("structure_type = 'bridge'").join(pairs.select(F.col("left").cast("string").alias("child_id")), "child_id", "left_semi").select("structure_id").distinct()
