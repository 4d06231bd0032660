"""Building a network from its sources: foreign graphs, borders, harbours, enrichment, and what belongs to a section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.geometry import geodesic_metres
from .components import components
from .graph import harbour_access, measured
from .relational import fill_from, keep_first, left_first, match_by_range, ragged_union, section_endpoints
from .spatial import nearest

#: The complex whose chambers and openings go to one section, by parts of their names.
RENAMED_SECTIONS = {"Irenesluis": "47304", "Irenesluizen": "47304"}


def foreign_ids(rows: DataFrame, path: str = "path") -> DataFrame:
    """rows with countrycode (from the file's name, ..._CC_... or ..._CC.), and node_id: country and object code."""
    country = F.upper(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"_([A-Za-z]{2})[_.]", 1))
    node = F.concat_ws("_", F.substring("locode", 1, 2), F.col("objectcode").cast("string"))
    return rows.withColumns({"countrycode": F.nullif(country, F.lit("")), "node_id": F.when(F.col("locode").isNotNull() & F.col("objectcode").isNotNull(), node)})


def border_links(nodes: DataFrame) -> DataFrame:
    """source, target: nodes (node_id, borderpoint, locode) whose border point is another node's location code."""
    own = nodes.where(F.col("borderpoint").isNotNull()).select(F.col("node_id").alias("source"), "borderpoint")
    return own.join(nodes.select(F.col("node_id").alias("target"), F.col("locode").alias("borderpoint")), "borderpoint").select("source", "target")


def foreign_graph(nodes: DataFrame, sections: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """nodes with records (all rows of a node, by `order`) and subgraph; edges (section columns, source, target, is_border,
    subgraph). nodes: node_id, sectionref, borderpoint, locode, ...; sections: code, .... A section's ends are the first and
    last of its nodes; border edges join the nodes that border_links() finds. Sections with a line in degrees get length_m,
    along it on the ellipsoid. subgraph: the smallest node of the part."""
    own = measured(section_endpoints(sections, nodes, "code", "sectionref", "node_id", order))
    edges = ragged_union([own.withColumn("is_border", F.lit(False)), border_links(nodes).withColumn("is_border", F.lit(True))])
    parts = components(edges, "source", "target").withColumnRenamed("component", "subgraph")
    edges = edges.join(parts, edges["source"] == parts["node"], "left").drop("node")
    records = nodes.groupBy("node_id").agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in nodes.columns if c not in ("node_id", order)]))).alias("records"))
    return records.join(parts.withColumnRenamed("node", "node_id"), "node_id"), edges


def stitched(home: DataFrame, foreign: DataFrame, edges: DataFrame, country: str = "NL", at_most: float = 100.0, cell: float = 100.0) -> DataFrame:
    """foreign_node, foreign_cc, bridgehead, home_node, distance of the border links: foreign edges (src, dst) between a
    node of the home country, the bridgehead, and one of another, where a home node is nearer than at_most to the
    bridgehead. home: id, x, y; foreign: id, countrycode, x, y; metres."""
    a = foreign.select(F.col("id").alias("src"), F.col("countrycode").alias("ca"))
    b = foreign.select(F.col("id").alias("dst"), F.col("countrycode").alias("cb"))
    both = edges.select("src", "dst").join(a, "src").join(b, "dst").where(F.col("ca").isNotNull() & F.col("cb").isNotNull())
    over = both.where((F.col("ca") == country) != (F.col("cb") == country))
    inward = F.col("cb") == country
    links = over.select(F.when(inward, F.col("src")).otherwise(F.col("dst")).alias("foreign_node"), F.when(inward, F.col("ca")).otherwise(F.col("cb")).alias("foreign_cc"), F.when(inward, F.col("dst")).otherwise(F.col("src")).alias("bridgehead"))
    heads = foreign.join(links.select(F.col("bridgehead").alias("id")).distinct(), "id", "left_semi").select("id", "x", "y")
    found = nearest(heads, home.select("id", "x", "y"), cell, at_most).where(F.col("right_id").isNotNull())
    return links.join(found, F.col("bridgehead") == F.col("left_id")).select("foreign_node", "foreign_cc", "bridgehead", F.col("right_id").alias("home_node"), "distance")


def harbours(rows: DataFrame, junctions: DataFrame, cell: float, degrees: bool = False) -> tuple[DataFrame, DataFrame]:
    """nodes and access edges of harbours (id, name, code, unlocode, x, y): the edge goes to the junction (node, code, x, y) of
    the same code, else to the nearest one. Rows without id or place are left out. The edge has its length in the places'
    own unit, or, if these are degrees, length_m on the ellipsoid too."""
    own = rows.where(S.is_valid("id") & F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("code", F.upper(F.trim("code")))
    nodes = own.select(F.concat(F.lit("harbour_"), S.stringify_id("id")).alias("id"), F.lit("harbour").alias("node_type"), "name", S.harbour_locode("unlocode", "code").alias("locode"), F.col("code").alias("isrs_id"), "x", "y")
    at = junctions.select(F.col("node").alias("id"), "x", "y")
    keyed = own.select(F.concat(F.lit("harbour_"), S.stringify_id("id")).alias("id"), F.nullif("code", F.lit("")).alias("code"), "name", "x", "y")
    access = harbour_access(keyed.select("id", "code"), junctions.select("node", F.upper(F.trim("code")).alias("code")), nearest(keyed.select("id", "x", "y"), at, cell))
    ends = access.join(keyed.select(F.col("id").alias("harbour_id"), "name", "x", "y"), "harbour_id").join(at.select(F.col("id").alias("node"), F.col("x").alias("nx"), F.col("y").alias("ny")), "node")
    length = F.sqrt(F.pow(F.col("x") - F.col("nx"), 2) + F.pow(F.col("y") - F.col("ny"), 2))
    edges = ends.select(F.col("harbour_id").alias("src"), F.col("node").alias("dst"), "by", F.lit("harbour_access").alias("segment_type"), F.lit("vinharbour").alias("data_source"), F.concat(F.lit("Access to "), F.col("name")).alias("name"), length.alias("length"), *([geodesic_metres("x", "y", "nx", "ny").alias("length_m")] if degrees else []))
    return nodes, edges


def derived(sections: DataFrame, aliases: dict[str, str], flags: dict[str, str]) -> DataFrame:
    """aliases: new column and the one it repeats; flags: new truth value and the column, then dropped, that tells it by
    being there. Columns that sections lack are passed over."""
    out = sections.withColumns({new: F.col(f"`{old}`") for new, old in aliases.items() if old in sections.columns})
    return out.withColumns({new: F.col(f"`{c}`").isNotNull() for new, c in flags.items() if c in sections.columns}).drop(*flags.values())


def enriched(edges: DataFrame, by_key: list[tuple[DataFrame, str, str, list[str]]], by_range: list[tuple[DataFrame, str, list[str]]], order: str, section: str = "section_id", route: tuple[str, str, str] = ("route_id", "km_begin", "km_end")) -> DataFrame:
    """edges with all that is known of their sections: of each (table, key, prefix, columns) the first row of the key, of each
    (table, prefix, columns) the first row whose kilometres on the same route touch the section's, as prefixed columns.
    Values that aren't null replace those an edge has under the same name."""
    out = edges
    for table, key, prefix, columns in by_key:
        own = table.select(key, order, *[F.col(c).alias(prefix + c) for c in columns])
        out = fill_from(out, own, key, order, [prefix + c for c in columns])
    for table, prefix, columns in by_range:
        found = match_by_range(edges, table, *route, section, order, columns, prefix)
        names = [c for c in found.columns if c != section]
        out = fill_from(out, found.withColumn("_order", F.lit(0)), section, "_order", names)
    return out


def aligned(base: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    """base with the columns of each part, by key: rows of base only, nulls where a part has none; of a part's rows with one
    key the first by its columns."""
    out = base
    for part in parts:
        columns = [c for c in part.columns if c != key]
        out = left_first(out, part.withColumn("_order", F.struct(*columns)), key, "_order", columns)
    return out


def section_structures(chambers: DataFrame, openings: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """section, chambers, openings: ids of the distinct structures (id, name, section_id) of each section; the named complex
    goes to its own section. edges: section, structure_id of sections that pass a structure by its id."""
    section = S.stringify_id("section_id")
    for part, target in RENAMED_SECTIONS.items():
        section = F.when(F.coalesce(F.contains("name", F.lit(part)), F.lit(False)), F.lit(target)).otherwise(section)
    kind = lambda df, k: df.select(section.alias("section"), F.lit(k).alias("kind"), S.stringify_id("id").alias("id"))
    rows = kind(chambers, "chamber").unionByName(kind(openings, "opening"))
    if edges is not None:
        by_id = rows.select("kind", "id").distinct()
        passed = edges.select(S.stringify_id("section").alias("section"), S.stringify_id("structure_id").alias("id"))
        rows = rows.unionByName(passed.join(by_id, "id").select("section", "kind", "id"))
    of = lambda k: F.sort_array(F.collect_set(F.when(F.col("kind") == k, F.col("id"))))
    return rows.where(F.col("section").isNotNull()).groupBy("section").agg(of("chamber").alias("chambers"), of("opening").alias("openings"))


def dropins_by_section(complexes: dict[str, DataFrame], objects: dict[str, DataFrame]) -> DataFrame:
    """section, type, id of everything that stands on a section. complexes: id, sections (array of struct(id, ...)); objects:
    id, section_id, of which one without a section is an error."""
    rows = [df.select(F.explode("sections").alias("s"), "id").select(S.stringify_id("s.id").alias("section"), F.lit(k).alias("type"), S.stringify_id("id").alias("id")) for k, df in complexes.items()]
    for k, df in objects.items():
        section = S.stringify_id("section_id")
        missing = F.raise_error(F.concat(F.lit(f"{k} without a section: "), F.col("id").cast("string"))).cast("string")
        rows.append(df.select(F.when(section.isNotNull() & (section != ""), section).otherwise(missing).alias("section"), F.lit(k).alias("type"), S.stringify_id("id").alias("id")))
    return ragged_union(rows)


def area_or_point(objects: DataFrame, areas: DataFrame, key: str, order: str) -> DataFrame:
    """objects (key, point, ...) with geometry: the first area's ring of the same key, else the object's point alone."""
    found = left_first(objects, areas.select(key, order, "ring"), key, order, ["ring"])
    return found.withColumn("geometry", F.coalesce("ring", F.array("point"))).drop("ring")


def split_features(features: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """nodes (the first of each id) and edges (with both ends) of a table of features (id, feature_type, source_node,
    target_node, geometry, ...); features without a geometry are left out."""
    own = features.where(has_geometry("geometry"))
    nodes = keep_first(own.where("feature_type = 'node'"), ["id"], [order])
    edges = own.where((F.col("feature_type") == "fairway_segment") & F.col("source_node").isNotNull() & F.col("target_node").isNotNull())
    return nodes, edges


def has_geometry(line: str) -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.size(line) > 0, F.lit(False))


def neighbour_values(nodes: DataFrame, edges: DataFrame, column: str) -> DataFrame:
    """node, values: the sorted distinct values (as clean texts) of a column over the edges (src, dst) at each of the nodes;
    empty without any."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"), S.stringify_id(column).alias("v"))
    own = ends.groupBy("node").agg(F.sort_array(F.collect_set("v")).alias("values"))
    return nodes.select("node").distinct().join(own, "node", "left").withColumn("values", F.coalesce("values", F.expr("cast(array() as array<string>)")))


def checked_routes(routes: DataFrame, waypoints: DataFrame) -> DataFrame:
    """name, result of each asserted route (name, status, path: array of edge keys; waypoints: name, any_of: array of keys):
    RESOLVE_FAIL without an end, NO_PATH without a path, PASS if the path has one of the keys (or none is asked for), else
    FAIL."""
    own = routes.join(waypoints, "name", "left")
    passed = F.coalesce(F.size("any_of") <= 0, F.lit(True)) | F.coalesce(F.arrays_overlap("path", "any_of"), F.lit(False))
    return own.select("name", F.when(F.col("status") == "geocode_fail", "RESOLVE_FAIL").when(F.col("status") == "no_path", "NO_PATH").when(passed, "PASS").otherwise("FAIL").alias("result"))


def penalty_sums(passed: DataFrame, kinds: tuple[str, ...] = ("lock", "bridge", "fairway", "sea", "cemt", "total")) -> DataFrame:
    """edge, and of each kind the sum of penalty times trips, over rows (edge, trips, kinds) of groups that pass an edge."""
    return passed.groupBy("edge").agg(*[F.sum(F.col(k) * F.col("trips")).alias(f"penalty_{k}") for k in kinds])
