"""The drop-in build: structures become nodes and edges with geometries, sections are spliced around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import lines as L
from ..functions.scalars import stringify_id
from .network import split_features
from .relational import ragged_union
from .schema import exploded
from .splice import access_features, cut_buffer, passages, segment_nodes, splice, splice_lines
from .structures import detailed_features, embedded, hosting, inject

POINT = "struct<x:double,y:double>"


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def node_points(own: DataFrame, kind: str) -> DataFrame:
    """id, point of the nodes of each complex (id, before, after: points where it splits and merges; children: array of
    struct(id, first, last, centre: points, length)). A chamber starts and ends at its doors (first, last), else at its
    centre; an opening without them half its length before and behind its centre, in the direction from split to merge. A
    bridge without openings has its virtual one between split and merge."""
    child = "chamber" if kind == "lock" else "opening"
    cid, null = F.col("id").cast("string"), F.lit(None).cast(POINT)
    fields = own.schema["children"].dataType.elementType.names
    get = lambda c, name, t: c[name].cast(t) if name in fields else F.lit(None).cast(t)
    node = lambda i, p: F.struct(i.alias("id"), p.alias("point"))
    name = lambda part: F.concat(F.lit(f"{kind}_"), cid, F.lit(f"_{part}"))
    middle = G.point((F.col("before.x") + F.col("after.x")) / 2, (F.col("before.y") + F.col("after.y")) / 2)

    def of(c: Column) -> Column:
        centre = F.coalesce(get(c, "centre", POINT), middle)
        end = lambda door, way: F.coalesce(get(c, door, POINT), centre if kind == "lock" else G.oriented(centre, F.col("before"), F.col("after"), way * F.coalesce(get(c, "length", "double"), F.lit(0.0)) / 2))
        n = lambda part: F.concat(F.lit(f"{child}_"), c["id"].cast("string"), F.lit(f"_{part}"))
        return F.array(node(n("start"), end("first", -1)), node(n("end"), end("last", 1)))

    inner = F.flatten(F.transform("children", of))
    if kind == "bridge":
        virtual = lambda part: F.concat(F.lit("opening_virtual_"), cid, F.lit(f"_{part}"))
        inner = F.when(F.size("children") > 0, inner).otherwise(F.array(node(virtual("start"), middle), node(virtual("end"), middle)))
    ends = F.array(node(name("split"), F.coalesce("before", null)), node(name("merge"), F.coalesce("after", null)))
    return own.select(F.explode(F.concat(ends, inner)).alias("n")).select("n.id", "n.point").where(F.col("point").isNotNull())


def with_geometry(features: DataFrame, points: DataFrame) -> DataFrame:
    """features (id, feature_type, source_node, target_node, ...) with geometry: its own line where it has one, a node's
    point, an edge's line between its ends; null where a point isn't known. Of points (id, point) of one id, the one of the
    smallest rank counts, if they have one."""
    rank = F.col("rank") if "rank" in points.columns else F.lit(0)
    p = points.groupBy("id").agg(F.min(F.struct(rank.alias("rank"), "point")).alias("p")).select("id", F.col("p.point").alias("point"))
    own = features.join(p.withColumnRenamed("point", "_own"), "id", "left")
    for end in ("source", "target"):
        own = own.join(p.select(F.col("id").alias(f"{end}_node"), F.col("point").alias(f"_{end}")), f"{end}_node", "left")
    line = F.when(F.col("feature_type") == "node", F.when(F.col("_own").isNotNull(), F.array("_own"))).when(F.col("_source").isNotNull() & F.col("_target").isNotNull(), F.array("_source", "_target"))
    line = F.coalesce("line", line) if "line" in features.columns else line
    return own.withColumn("geometry", line).select(*[c for c in features.columns if c != "line"], "geometry")


def cuts_of(complexes: dict[str, DataFrame], objects: dict[str, DataFrame], mode: str) -> DataFrame:
    """section_id, distance, anchor, buffer, id of what cuts a section: complexes (sections: array of struct(id, relation,
    distance); point, where they stand; buffer) on each of their sections, by the name of their split and merge; terminals
    and berths (section_id, distance, point) in the detailed mode only. Buffers are cut_buffer()'s, by kind and mode."""
    cut = lambda kind: F.concat(F.lit(f"{kind}_"), stringify_id("id"))
    rows = []
    for kind, df in complexes.items():
        child = df.schema["children"].dataType.elementType if "children" in df.columns else None
        lengths = F.transform("children", lambda c: c["length"].cast("double")) if child is not None and "length" in child.names else None
        buffer = cut_buffer(kind, mode, F.col("buffer") if "buffer" in df.columns else None, lengths)
        own = df.select(F.explode("sections").alias("s"), cut(kind).alias("id"), buffer.alias("buffer"), _column(df, "point", POINT).alias("anchor"))
        at = F.col("s.distance").cast("double") if "distance" in df.schema["sections"].dataType.elementType.names else F.lit(None).cast("double")
        rows.append(own.select(stringify_id("s.id").alias("section_id"), at.alias("distance"), "anchor", "buffer", "id"))
    if mode == "detailed":
        rows += [df.where(F.col("section_id").isNotNull()).select(stringify_id("section_id").alias("section_id"), _column(df, "distance", "double").cast("double").alias("distance"), _column(df, "point", POINT).alias("anchor"), cut_buffer(k, mode).alias("buffer"), cut(k).alias("id")) for k, df in objects.items()]
    return ragged_union(rows).where(F.col("distance").isNotNull() | F.col("anchor").isNotNull())


def routes(own: DataFrame) -> DataFrame | None:
    """id, line of the routes of chambers that bring their own (a field route of the children); None if none can."""
    if "route" not in own.schema["children"].dataType.elementType.names:
        return None
    child = own.select(F.explode("children").alias("c")).where(F.size("c.route") > 1)
    return child.select(F.concat(F.lit("chamber_"), F.col("c.id").cast("string"), F.lit("_route")).alias("id"), F.col("c.route").alias("line"))


def build(sections: DataFrame, complexes: dict[str, DataFrame], objects: dict[str, DataFrame], mode: str = "detailed", degrees: bool = False) -> dict[str, DataFrame]:
    """The tables of a drop-in network: nodes, edges, spliced sections, and the scalar tables of what is on them.

    sections: section_id, start, end, and line (an array of points, in metres, or with `degrees` in degrees) or else length
    alone. complexes by kind (lock, bridge): id, name, before, after (points), sections (array of struct(id, relation,
    distance)), point, buffer, children. objects by kind (terminal, berth): id, name, section_id, distance, point. A
    structure stands on a section's line at its distance, or else where its point is nearest.

    mode 'detailed' has nodes and edges of every chamber and opening, bridges in the chambers they belong to (these don't
    cut their sections), and access features; 'simplified' has one passage for each complex. With lines, segments have
    their own stretch of the line, its ends are the points of the nodes there, junctions are nodes too, and objects that
    stand on no line are left out."""
    if mode not in ("detailed", "simplified"):
        raise ValueError(f"no mode {mode!r}")
    lined = "line" in sections.columns
    points = ragged_union([node_points(df, k) for k, df in complexes.items()]).withColumn("rank", F.lit(1))
    made, cutting = None, complexes
    if mode == "detailed":
        made = ragged_union([detailed_features(df, k) for k, df in complexes.items()])
        drawn = [r for r in (routes(df) for k, df in complexes.items() if k == "lock") if r is not None]
        made = made.join(drawn[0], "id", "left") if drawn else made.withColumn("line", F.lit(None).cast(f"array<{POINT}>"))
        if {"lock", "bridge"} <= set(complexes):
            pairs = embedded_pairs(complexes["bridge"], complexes["lock"], points)
            inside = hosting(made, pairs).withColumnRenamed("structure_id", "_h")
            cutting = {**complexes, "bridge": complexes["bridge"].join(inside, F.col("id").cast("string") == F.col("_h"), "left_anti")}
            made = embedded_in(made, pairs, points)
    cuts = cuts_of(cutting, objects, mode)
    if lined:
        spliced = splice_lines(sections, cuts, degrees)
        ends = segment_nodes(spliced)
        segment = spliced.select("id", F.lit("fairway_segment").alias("feature_type"), F.col("segment_type").alias("type"), "source_node", "target_node", "section_id", "length_m", F.col("geometry").alias("line"))
        connection = F.col("id").rlike("^(terminal|berth)_.*_connection$")
        junctions = ends.where((F.col("node_type") == "junction") & ~connection).select("id", F.lit("node").alias("feature_type"), F.lit("junction").alias("type"))
        parts = [segment, junctions]
        placed = [df.select(F.concat(F.lit(f"{k}_"), F.col("id").cast("string")).alias("id"), "point").where("point is not null") for k, df in objects.items() if "point" in df.columns]
        points = ragged_union([ends.select("id", "point", F.lit(0).alias("rank")), points, *[p.withColumn("rank", F.lit(1)) for p in placed]])
        met = ends.where(connection).select(F.col("id").alias("_met"))
    else:
        spliced = splice(sections, cuts)
        parts = [spliced.select(F.concat_ws("_", F.lit("fairway_segment_section"), "section_id", F.col("segment").cast("string")).alias("id"), F.lit("fairway_segment").alias("feature_type"), F.lit("section").alias("type"), "source_node", "target_node", "length_m")]
        met = None
    if mode == "simplified":
        parts += [passages(df, k).drop("name", "section_id") if not lined else passages(df, k).drop("name") for k, df in complexes.items()]
    else:
        parts.append(made)
        for kind, df in objects.items():
            own = df if met is None else df.join(met, F.concat(F.lit(f"{kind}_"), F.col("id").cast("string"), F.lit("_connection")) == F.col("_met"), "left_semi")
            parts.append(access_features(own, kind))
    features = with_geometry(ragged_union(parts), points)
    if lined:
        size = L.geodesic_length("geometry") if degrees else G.line_length(F.col("geometry"))
        features = features.withColumn("length_m", F.coalesce("length_m", F.when(F.col("feature_type") != "node", size)))
    own = features.withColumn("geometry", F.when(F.col("feature_type") == "fairway_segment", F.coalesce("geometry", F.expr(f"cast(array() as array<{POINT}>)"))).otherwise(F.col("geometry")))
    nodes, _ = split_features(own, "id")
    edges = own.where("feature_type <> 'node' and source_node is not null and target_node is not null")
    out = {"nodes": nodes, "edges": edges, "sections": spliced}
    for kind, df in complexes.items():
        out[f"{kind}s"] = df.drop("children", "sections")
        out["chambers" if kind == "lock" else "openings"] = exploded(df.withColumnRenamed("id", f"{kind}_id"), "children", (f"{kind}_id",))
    return out | {f"{kind}s": df for kind, df in objects.items()}


def embedded_pairs(bridges: DataFrame, locks: DataFrame, points: DataFrame) -> DataFrame:
    """left (opening), right (chamber) of the openings that belong to a chamber: matched one to one by name and nearness of
    their middles."""
    of = lambda df: exploded(df.select(F.col("id").alias("_c"), "name", "children", "before", "after"), "children", ("_c",))
    inner = lambda kind: F.regexp_extract("id", f"^{kind}_(.*)_(start|end)$", 1).alias("_k")
    place = lambda kind: points.groupBy(inner(kind)).agg(F.avg("point.x").alias("x"), F.avg("point.y").alias("y")).where("_k <> ''")
    named = lambda df, kind: of(df).withColumn("_k", F.col("id").cast("string")).join(place(kind), "_k").select(F.col("_k").alias("id"), _column(of(df), "name", "string").alias("name"), "x", "y")
    return embedded(named(bridges, "opening"), named(locks, "chamber"))


def embedded_in(features: DataFrame, pairs: DataFrame, points: DataFrame) -> DataFrame:
    """features with the openings of pairs put into their chambers: each cuts the chamber's edge nearest to its start."""
    starts = points.select(F.regexp_extract("id", "^opening_(.*)_start$", 1).alias("opening"), "point").where("opening <> ''")
    edges = with_geometry(features.where("structure_type = 'lock' and feature_type = 'fairway_segment'"), points).where(F.size("geometry") > 1)
    asked = pairs.select(F.col("left").cast("string").alias("opening"), F.col("right").cast("string").alias("child_id")).join(starts, "opening")
    apart = edges.join(asked, "child_id").select("opening", F.col("id").alias("edge"), "geometry", "point", G.point_line_distance(F.col("point"), F.col("geometry")).alias("distance"))
    return inject(features, pairs, apart)
