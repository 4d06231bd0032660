"""Queries on building, enriching and comparing networks, each beside its DuckDB equivalent (see catalogue)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import areas as A
from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import compare, dropins, graph, network, relational, schema, spatial, splice, structures
from ..sources import files, sinks
from .catalogue import _POINTS, _VOYAGES, _points, _voyages, query


def _text(prefix: str, *columns: str):
    return F.concat(F.lit(prefix), F.concat_ws("_", *[F.col(c).cast("string") for c in columns]))


# scalars and projections


@query("""SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 1 THEN p_size::VARCHAR END, CASE WHEN p_size % 2 = 0 THEN p_brand END) AS key FROM part""")
def edge_key(t):
    fis = F.when(F.col("p_size") % 3 == 1, F.col("p_size").cast("string")).when(F.col("p_size") % 3 == 2, "")
    return t.part.select("p_partkey", S.edge_key(fis, F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))).alias("key"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 1e8 WHEN o_orderkey % 7 = 0 THEN 1.0 ELSE o_totalprice END AS without_sea, o_totalprice * CASE WHEN o_orderpriority LIKE '1%' THEN 1.0 ELSE 10.0 END AS by_class FROM orders""")
def haul_weights(t):
    sea, length = F.when(F.col("o_orderstatus") == "P", "Noordzee"), F.when((F.col("o_orderkey") % 7 != 0) | (F.col("o_orderstatus") == "P"), F.col("o_totalprice"))
    cemt = F.when(F.col("o_orderpriority").startswith("1"), "Va").when(F.col("o_orderpriority").startswith("2"), "III")
    return t.orders.select("o_orderkey", S.length_without_sea(length, sea).alias("without_sea"), S.length_by_class("o_totalprice", cemt).alias("by_class"))


@query("""SELECT p_partkey, p_brand AS nav_code, p_brand AS cemt_class, p_size % 4 = 0 AS is_tidal FROM part""")
def derived_columns(t):
    own = t.part.select("p_partkey", F.col("p_brand").alias("nav_code"), F.when(F.col("p_size") % 4 == 0, F.col("p_name")).alias("tide"))
    return network.derived(own, {"cemt_class": "nav_code", "unknown": "missing"}, {"is_tidal": "tide"})


@query("""SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN 'BE' END AS countrycode, CASE WHEN s_suppkey % 5 <> 0 THEN left(s_name, 2) || '_' || s_suppkey::VARCHAR END AS node_id FROM supplier""")
def foreign_node_ids(t):
    path = F.when(F.col("s_nationkey") % 2 == 0, "data/v1/Node_be_2024.geojson").otherwise("data/v1/nodes.geojson")
    own = t.supplier.select("s_suppkey", path.alias("path"), F.when(F.col("s_suppkey") % 5 != 0, F.col("s_name")).alias("locode"), F.col("s_suppkey").alias("objectcode"))
    return network.foreign_ids(own).select("s_suppkey", "countrycode", "node_id")


@query("""SELECT n_nationkey AS id, n_name AS title FROM nation""")
def renamed_and_dropped(t):
    return schema.rename_and_drop(t.nation.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"), F.lit(1).alias("Length"), F.lit(1).alias("length_km")), {"Id": "id", "Name": "title"})


@query("""SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, s_nationkey::VARCHAR) AS start FROM supplier""")
def first_present(t):
    own = t.supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("StartJunctionId"), F.col("s_nationkey").cast("string").alias("start_junction_id"))
    return schema.first_present(own, ("StartJunctionId", "start_junction_id", "absent"), "start").select("s_suppkey", "start")


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN p_size::VARCHAR END AS flag, p_size % 4 < 3 AS valid FROM part""")
def flags_and_validity(t):
    raw = F.when(F.col("p_size") % 4 == 0, " True").when(F.col("p_size") % 4 == 1, "no").when(F.col("p_size") % 4 == 2, F.concat(F.col("p_size").cast("string"), F.lit(".0")))
    odd = F.when(F.col("p_size") % 8 == 3, "nan").otherwise(raw)
    return t.part.select("p_partkey", S.flag_text(raw).alias("flag"), S.is_valid(odd).alias("valid"))


@query("""SELECT o_orderkey, o_totalprice::DOUBLE AS n, CASE WHEN o_custkey % 3 <> 0 AND o_custkey > 0 THEN o_custkey::DOUBLE END AS whole FROM orders""")
def numbers_as_they_are(t):
    """Numbers, negative ones too, are not read as texts."""
    whole = F.when(F.col("o_custkey") % 3 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return t.orders.select("o_orderkey", S.number_in_text("o_totalprice").alias("n"), S.number_in_text(whole).alias("whole"))


# choices by key


@query("""SELECT DISTINCT p_brand, p_type, p_size FROM part""")
def distinct_but_path(t):
    own = t.part.select("p_brand", "p_type", "p_size", F.col("p_partkey").alias("path"))
    return relational.distinct_without(own, "path").drop("path")


@query("""SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def strict_lookup(t):
    own = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return relational.strict_lookup(own, t.nation.select("n_nationkey", "n_name"), "n_nationkey", "no nation").select("c_custkey", "n_name")


@query("""WITH f AS (SELECT 'Set' || (user_id % 5)::VARCHAR AS dataset, CASE user_id % 3 WHEN 0 THEN 'NL' WHEN 1 THEN 'BE' ELSE 'DE' END AS country, event_id, ts FROM events)
SELECT country, dataset, first(dataset || '_' || country || '_' || lpad(event_id::VARCHAR, 9, '0') || '.json' ORDER BY ts DESC, event_id DESC) AS name, max(ts) AS last_modified FROM f GROUP BY ALL""")
def latest_files(t):
    country = F.when(F.col("user_id") % 3 == 0, "NL").when(F.col("user_id") % 3 == 1, "BE").otherwise("DE")
    name = F.concat(F.lit("Set"), (F.col("user_id") % 5).cast("string"), F.lit("_"), country, F.lit("_"), F.lpad(F.col("event_id").cast("string"), 9, "0"), F.lit(".json"))
    return files.latest_files(t.events.select(name.alias("name"), F.col("ts").alias("last_modified")))


@query("""SELECT o_orderkey, c_custkey AS id_parent, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def suffixed_join(t):
    child = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parent"), "o_totalprice")
    out = compare.suffixed(child, t.customer.select(F.col("c_custkey").alias("id"), "c_name"), ("parent", "id"), ("_child", "_parent"))
    return out.select(F.col("id_child").alias("o_orderkey"), "id_parent", "o_totalprice", "c_name")


@query("""SELECT p_partkey, p_brand, first_name, n FROM (SELECT p_partkey, p_brand, p_size FROM part) LEFT JOIN (SELECT s_nationkey AS p_size, min(s_name) AS first_name FROM supplier GROUP BY 1) USING (p_size) LEFT JOIN (SELECT c_nationkey AS p_size, count(*) AS n FROM customer GROUP BY 1) USING (p_size)""")
def aligned_columns(t):
    base = t.part.select("p_partkey", "p_brand", "p_size")
    a = t.supplier.select(F.col("s_nationkey").alias("p_size"), F.col("s_name").alias("first_name"))
    b = t.customer.groupBy(F.col("c_nationkey").alias("p_size")).agg(F.count(F.lit(1)).alias("n"))
    return network.aligned(base, [a, b], "p_size").drop("p_size")


# what belongs to a section


@query("""WITH s AS (SELECT CASE WHEN p_type = 'SMALL' THEN '47304' ELSE p_size::VARCHAR END AS section, p_partkey FROM part WHERE p_type = 'SMALL' OR p_size % 9 <> 0),
a AS (SELECT section, CASE WHEN p_partkey % 2 = 0 THEN 'chamber' ELSE 'opening' END AS kind, p_partkey::VARCHAR AS id FROM s UNION SELECT 'e' || s_suppkey::VARCHAR, CASE WHEN p_partkey % 2 = 0 THEN 'chamber' ELSE 'opening' END, p_partkey::VARCHAR FROM supplier JOIN part ON p_partkey = s_suppkey)
SELECT section, coalesce(string_agg(id, ',' ORDER BY id) FILTER (WHERE kind = 'chamber'), '') AS chambers, coalesce(string_agg(id, ',' ORDER BY id) FILTER (WHERE kind = 'opening'), '') AS openings FROM a GROUP BY section""")
def structures_of_sections(t):
    name = F.when(F.col("p_type") == "SMALL", F.concat(F.lit("Prinses Irenesluizen "), "p_name")).otherwise(F.col("p_name"))
    own = t.part.select(F.col("p_partkey").alias("id"), name.alias("name"), F.when(F.col("p_size") % 9 != 0, F.col("p_size").cast("double")).alias("section_id"))
    passed = t.supplier.select(_text("e", "s_suppkey").alias("section"), F.col("s_suppkey").cast("double").alias("structure_id"))
    found = network.section_structures(own.where("id % 2 = 0"), own.where("id % 2 = 1"), passed)
    return found.select("section", F.array_join("chambers", ",").alias("chambers"), F.array_join("openings", ",").alias("openings"))


@query("""SELECT l_partkey::VARCHAR AS section, 'lock' AS type, l_orderkey::VARCHAR AS id FROM lineitem UNION ALL SELECT c_nationkey::VARCHAR, 'terminal', c_custkey::VARCHAR FROM customer""")
def dropins_by_section(t):
    locks = schema.nested(t.orders.select(F.col("o_orderkey").alias("id")), t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("id"), "l_suppkey", "l_shipdate"), "id", "l_orderkey", "sections", "l_linenumber")
    return network.dropins_by_section({"lock": locks}, {"terminal": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("double").alias("section_id"))})


@query("""WITH a AS (SELECT s_nationkey AS k, min(s_suppkey) AS s FROM supplier WHERE s_suppkey % 4 = 0 GROUP BY 1) SELECT c_custkey, CASE WHEN s IS NULL THEN 1 ELSE 3 END AS points, coalesce(s, c_acctbal)::DOUBLE AS first_x FROM customer LEFT JOIN a ON k = c_nationkey""")
def area_or_point(t):
    areas = t.supplier.where("s_suppkey % 4 = 0").select(F.col("s_nationkey").alias("code"), "s_suppkey", F.array(*[G.point(F.col("s_suppkey").cast("double") + k, F.lit(float(k % 2))) for k in range(3)]).alias("ring"))
    own = t.customer.select("c_custkey", F.col("c_nationkey").alias("code"), G.point(F.col("c_acctbal"), F.lit(0.0)).alias("point"))
    return network.area_or_point(own, areas, "code", "s_suppkey").select("c_custkey", F.size("geometry").alias("points"), F.col("geometry")[0]["x"].alias("first_x"))


@query("""SELECT 'node' AS kind, min(event_id) AS event_id, user_id::VARCHAR AS id FROM events WHERE event_type = 'view' AND event_id % 5 > 0 GROUP BY user_id UNION ALL SELECT 'edge', event_id, user_id::VARCHAR FROM events WHERE event_type = 'click' AND event_id % 5 > 1""")
def split_features(t):
    kind = F.when(F.col("event_type") == "view", "node").when(F.col("event_type") == "click", "fairway_segment").otherwise("other")
    line = F.when(F.col("event_id") % 5 > 0, F.array(G.point(F.col("value"), F.lit(0.0)))).otherwise(F.expr("cast(array() as array<struct<x:double,y:double>>)"))
    own = t.events.select("event_id", F.col("user_id").cast("string").alias("id"), kind.alias("feature_type"), line.alias("geometry"), F.when(F.col("event_id") % 5 != 1, F.col("user_id")).alias("source_node"), F.col("user_id").alias("target_node"))
    nodes, edges = network.split_features(own, "event_id")
    return nodes.select(F.lit("node").alias("kind"), "event_id", "id").unionByName(edges.select(F.lit("edge").alias("kind"), "event_id", "id"))


# graphs


@query("""WITH r AS (SELECT o_custkey AS a, o_orderkey % 97 AS b, o_orderkey FROM orders WHERE o_orderkey % 11 <> 0), e AS (SELECT a, b, o_orderkey FROM r QUALIFY row_number() OVER (PARTITION BY least(a, b), greatest(a, b) ORDER BY o_orderkey DESC) = 1) SELECT 'edge' AS kind, o_orderkey AS id FROM e UNION ALL SELECT 'node', c_custkey FROM customer WHERE c_custkey IN (SELECT a FROM e UNION SELECT b FROM e)""")
def built_graph(t):
    sections = t.orders.select(F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("start"), (F.col("o_orderkey") % 97).alias("end"), "o_orderkey")
    nodes, edges = graph.build_graph(sections, t.customer.select(F.col("c_custkey").alias("id")), "o_orderkey")
    return edges.select(F.lit("edge").alias("kind"), F.col("o_orderkey").alias("id")).unionByName(nodes.select(F.lit("node").alias("kind"), "id"))


@query("""WITH n AS (SELECT 'n' || l_orderkey::VARCHAR || '_' || l_linenumber::VARCHAR AS node, l_orderkey AS k, l_linenumber AS i FROM lineitem), e AS (SELECT k, first(node ORDER BY i) AS source, first(node ORDER BY i DESC) AS target FROM n GROUP BY k),
b AS (SELECT x.source, y.source AS target, x.k FROM e x JOIN e y ON y.k = x.k + 1 WHERE x.k % 64 = 0), p AS (SELECT e.k, least(e.source, e.target, f.source, f.target) AS part FROM e LEFT JOIN e f ON f.k = CASE WHEN e.k % 64 = 0 THEN e.k + 1 WHEN e.k % 64 = 1 THEN e.k - 1 END)
SELECT source, target, false AS is_border, part AS subgraph FROM e JOIN p USING (k) UNION ALL SELECT source, target, true, part FROM b JOIN p USING (k)""")
def foreign_graph(t):
    """Orders as sections between their first and last line item's node; of every 64 the first one's border point is the next
    order's first node."""
    head = F.min("l_linenumber").alias("head")
    heads = t.lineitem.groupBy("l_orderkey").agg(head)
    rows = t.lineitem.select("l_orderkey", "l_linenumber").distinct().join(heads, "l_orderkey")
    first = F.col("l_linenumber") == F.col("head")
    border = F.when(first & (F.col("l_orderkey") % 64 == 0), F.concat(F.lit("L"), (F.col("l_orderkey") + 1).cast("string")))
    nodes = rows.select(_text("n", "l_orderkey", "l_linenumber").alias("node_id"), F.col("l_orderkey").alias("sectionref"), "l_linenumber", border.alias("borderpoint"), F.when(first, _text("L", "l_orderkey")).alias("locode"))
    return network.foreign_graph(nodes, t.orders.select(F.col("o_orderkey").alias("code")), "l_linenumber")[1].select("source", "target", "is_border", "subgraph")


_HOME = "h AS (SELECT * FROM e WHERE id % 2 = 0), g AS (SELECT *, CASE id % 3 WHEN 0 THEN 'NL' WHEN 1 THEN 'BE' END AS cc FROM e WHERE id % 2 = 1), d AS (SELECT g.id, first(h.id ORDER BY power(g.x - h.x, 2) + power(g.y - h.y, 2), h.id) AS home_node, min(power(g.x - h.x, 2) + power(g.y - h.y, 2)) AS d2 FROM g, h GROUP BY g.id)"


@query(f"""WITH {_POINTS}, {_HOME}, l AS (SELECT a.id AS a, b.id AS b, a.cc AS ca, b.cc AS cb FROM g a JOIN g b ON b.id = a.id + 2 WHERE a.cc IS NOT NULL AND b.cc IS NOT NULL AND (a.cc = 'NL') <> (b.cc = 'NL')),
k AS (SELECT CASE WHEN cb = 'NL' THEN a ELSE b END AS foreign_node, CASE WHEN cb = 'NL' THEN ca ELSE cb END AS foreign_cc, CASE WHEN cb = 'NL' THEN b ELSE a END AS bridgehead FROM l)
SELECT foreign_node, foreign_cc, bridgehead, home_node, round(sqrt(d2), 6) AS distance FROM k JOIN d ON id = bridgehead WHERE sqrt(d2) < 0.01""")
def border_stitching(t):
    p = _points(t)
    foreign = p.where("id % 2 = 1").withColumn("countrycode", F.when(F.col("id") % 3 == 0, "NL").when(F.col("id") % 3 == 1, "BE"))
    edges = foreign.select(F.col("id").alias("src"), (F.col("id") + 2).alias("dst"))
    return network.stitched(p.where("id % 2 = 0"), foreign, edges, "NL", 0.01, 0.01).withColumn("distance", F.round("distance", 6))


@query(f"""WITH {_POINTS}, j AS (SELECT id AS node, 'J' || (id % 50)::VARCHAR || '000' AS code, x, y FROM e WHERE id % 5 = 0), c AS (SELECT code, min(node) AS node FROM j GROUP BY code), a AS (SELECT e.id, x, y, c.node FROM e LEFT JOIN c ON c.code = 'J' || (e.id % 70)::VARCHAR || '000' WHERE e.id % 5 <> 0),
b AS (SELECT a.id, first(j.node ORDER BY power(a.x - j.x, 2) + power(a.y - j.y, 2), j.node) AS near FROM a, j GROUP BY a.id)
SELECT 'harbour_' || a.id::VARCHAR AS src, coalesce(a.node, near) AS dst, CASE WHEN a.node IS NULL THEN 'nearest' ELSE 'code' END AS "by", round(sqrt(power(a.x - j.x, 2) + power(a.y - j.y, 2)), 6) AS length FROM a JOIN b USING (id) JOIN j ON j.node = coalesce(a.node, near)""")
def harbour_edges(t):
    p = _points(t)
    code = lambda n: F.concat(F.lit("j"), (F.col("id") % n).cast("string"), F.lit("000 "))
    rows = p.where("id % 5 <> 0").select("id", F.lit("h").alias("name"), code(70).alias("code"), F.lit(None).cast("string").alias("unlocode"), "x", "y")
    edges = network.harbours(rows, p.where("id % 5 = 0").select(F.col("id").alias("node"), code(50).alias("code"), "x", "y"), 0.05)[1]
    return edges.select("src", "dst", "by", F.round("length", 6).alias("length"))


@query("""WITH s AS (SELECT o_orderkey, o_custkey % 50 AS k, o_totalprice AS b, o_totalprice + 2000 AS e, CASE WHEN o_orderkey % 2 = 0 THEN 'own' END AS nav_code FROM orders), n AS (SELECT c_custkey AS o_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 0),
d AS (SELECT p_partkey AS id, p_partkey % 50 AS k, p_retailprice * 150 AS b, p_retailprice * 150 + 500 AS e, p_size FROM part), r AS (SELECT o_orderkey, first(d.p_size ORDER BY id) FILTER (WHERE id IS NOT NULL) AS dim_size FROM s LEFT JOIN d ON s.k = d.k AND NOT (s.e < d.b OR d.e < s.b) GROUP BY o_orderkey)
SELECT s.o_orderkey AS section_id, coalesce(n.c_mktsegment, s.nav_code) AS nav_code, r.dim_size FROM s JOIN orders USING (o_orderkey) LEFT JOIN n USING (o_custkey) JOIN r USING (o_orderkey)""")
def enriched_edges(t):
    edges = t.orders.select(F.col("o_orderkey").alias("section_id"), "o_custkey", (F.col("o_custkey") % 50).alias("route_id"), F.col("o_totalprice").alias("km_begin"), (F.col("o_totalprice") + 2000).alias("km_end"), F.when(F.col("o_orderkey") % 2 == 0, "own").alias("nav_code"))
    nav = t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("code"), F.lit(0).cast("bigint").alias("row"))
    dims = t.part.select(F.col("p_partkey").alias("row"), (F.col("p_partkey") % 50).alias("route_id"), (F.col("p_retailprice") * 150).alias("km_begin"), (F.col("p_retailprice") * 150 + 500).alias("km_end"), F.col("p_size").alias("size"))
    out = network.enriched(edges, [(nav, "o_custkey", "nav_", ["code"])], [(dims, "dim_", ["size"])], "row")
    return out.select("section_id", "nav_code", "dim_size")


@query("""WITH v AS (SELECT DISTINCT node, (l_suppkey)::VARCHAR AS v FROM (SELECT l_orderkey % 40 AS node, l_suppkey FROM lineitem UNION ALL SELECT l_partkey % 40, l_suppkey FROM lineitem)) SELECT n_nationkey::BIGINT AS node, coalesce(string_agg(v, ',' ORDER BY v), '') AS "values" FROM nation LEFT JOIN v ON node = n_nationkey GROUP BY 1""")
def neighbour_values(t):
    edges = t.lineitem.select((F.col("l_orderkey") % 40).alias("src"), (F.col("l_partkey") % 40).alias("dst"), F.col("l_suppkey").cast("double").alias("fairway_id"))
    return network.neighbour_values(t.nation.select(F.col("n_nationkey").cast("bigint").alias("node")), edges, "fairway_id").withColumn("values", F.array_join("values", ","))


@query("""WITH r AS (SELECT o_orderkey, o_orderstatus, list(l_partkey::VARCHAR) AS path FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) SELECT o_orderkey AS name, CASE WHEN o_orderstatus = 'F' THEN 'RESOLVE_FAIL' WHEN o_orderstatus = 'P' THEN 'NO_PATH' WHEN o_orderkey % 3 <> 0 OR list_has_any(path, ['1', '2', '3', '5', '8']) THEN 'PASS' ELSE 'FAIL' END AS result FROM r""")
def route_checks(t):
    paths = t.lineitem.groupBy(F.col("l_orderkey").alias("name")).agg(F.collect_list(F.col("l_partkey").cast("string")).alias("path"))
    status = F.when(F.col("o_orderstatus") == "F", "geocode_fail").when(F.col("o_orderstatus") == "P", "no_path").otherwise("success")
    routes = t.orders.select(F.col("o_orderkey").alias("name"), status.alias("status")).join(paths, "name", "left")
    asked = t.orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("name"), F.array(*[F.lit(x) for x in "12358"]).alias("any_of"))
    return network.checked_routes(routes, asked)


@query(f"""WITH {_POINTS}, c AS (SELECT 'g' || label::VARCHAR AS name, id AS node, x, y FROM e), g AS (SELECT node, count(*) AS degree FROM (SELECT id - id % 3 AS node FROM e UNION ALL SELECT id + 1 FROM e) GROUP BY 1), m AS (SELECT name, avg(x) AS mx, avg(y) AS my FROM c GROUP BY 1)
SELECT name, first(node ORDER BY coalesce(degree, 0) < 2, round(power(x - mx, 2) + power(y - my, 2), 12), node) AS node FROM c JOIN m USING (name) LEFT JOIN g USING (node) GROUP BY name""")
def representative_nodes(t):
    p = _points(t)
    edges = p.select((F.col("id") - F.col("id") % 3).alias("src"), (F.col("id") + 1).alias("dst"))
    return graph.representative_node(p.select(_text("g", "label").alias("name"), F.col("id").alias("node"), "x", "y"), edges)


@query(f"""WITH {_VOYAGES}, p AS (SELECT least(origin, dest)::VARCHAR || '-' || greatest(origin, dest)::VARCHAR AS edge, (origin % 3)::DOUBLE AS lock, (dest % 4)::DOUBLE AS bridge, count(*) AS trips FROM v GROUP BY origin, dest)
SELECT edge, sum(lock * trips)::DOUBLE AS penalty_lock, sum(bridge * trips)::DOUBLE AS penalty_bridge, sum((lock + bridge) * trips)::DOUBLE AS penalty_total FROM p GROUP BY edge""")
def penalty_sums(t):
    g = _voyages(t).groupBy("origin", "dest").agg(F.count(F.lit(1)).alias("trips"))
    edge = F.concat_ws("-", F.least("origin", "dest").cast("string"), F.greatest("origin", "dest").cast("string"))
    passed = g.select(edge.alias("edge"), "trips", (F.col("origin") % 3).cast("double").alias("lock"), (F.col("dest") % 4).cast("double").alias("bridge")).withColumn("total", F.col("lock") + F.col("bridge"))
    return network.penalty_sums(passed, ("lock", "bridge", "total"))


# comparisons

_SEGMENTS = f"""{_POINTS}, n AS (SELECT id // 4 AS line, id, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS "by" FROM e WINDOW w AS (PARTITION BY id // 4 ORDER BY id)), s AS (SELECT * FROM n WHERE bx IS NOT NULL)"""


def _near(px: str, py: str, g: str) -> str:
    dx, dy = f"({g}.bx - {g}.ax)", f'({g}."by" - {g}.ay)'
    share = f"greatest(0, least(1, (({px} - {g}.ax) * {dx} + ({py} - {g}.ay) * {dy}) / nullif({dx} * {dx} + {dy} * {dy}, 0)))"
    return f"sqrt(power({px} - {g}.ax - {share} * {dx}, 2) + power({py} - {g}.ay - {share} * {dy}, 2))"


def _turn(g: str, px: str, py: str) -> str:
    return f'sign(({g}.bx - {g}.ax) * ({py} - {g}.ay) - ({g}."by" - {g}.ay) * ({px} - {g}.ax))'


_CROSS = f"""({_turn("l", "r.ax", "r.ay")} * {_turn("l", "r.bx", 'r."by"')} < 0 AND {_turn("r", "l.ax", "l.ay")} * {_turn("r", "l.bx", 'l."by"')} < 0)"""
_APART = f"""CASE WHEN {_CROSS} THEN 0 ELSE least({_near("l.ax", "l.ay", "r")}, {_near("l.bx", 'l."by"', "r")}, {_near("r.ax", "r.ay", "l")}, {_near("r.bx", 'r."by"', "l")}) END"""
_LINES = f"""l2 AS (SELECT l.line AS left_id, r.line AS right_id, min({_APART}) AS distance FROM s l JOIN s r ON l.line % 2 = 0 AND r.line % 2 = 1 GROUP BY ALL HAVING min({_APART}) <= 0.01)"""


def _lines(t):
    rows = _points(t).groupBy(F.floor(F.col("id") / 4).alias("id")).agg(F.sort_array(F.collect_list(F.struct("id", "x", "y"))).alias("p"))
    return rows.where(F.size("p") > 1).select("id", F.transform("p", lambda p: G.point(p["x"], p["y"])).alias("line"))


@query(f"""WITH {_SEGMENTS}, {_LINES} SELECT left_id, right_id, round(distance, 6) AS distance FROM l2""")
def lines_within(t):
    own = _lines(t)
    return compare.lines_within(own.where("id % 2 = 0"), own.where("id % 2 = 1"), 0.01, 0.1).withColumn("distance", F.round("distance", 6))


@query(f"""WITH {_SEGMENTS}, {_LINES}, c AS (SELECT DISTINCT line AS id, line % 9 AS code, line % 20 AS b FROM s), m AS (SELECT code, max(b + 5) AS longest FROM c GROUP BY code)
SELECT left_id, right_id FROM l2 JOIN c x ON x.id = left_id JOIN c y ON y.id = right_id AND x.code = y.code JOIN m ON m.code = x.code WHERE NOT (x.b + 5 < y.b OR y.b + 5 < x.b) OR NOT (x.b + 5 < longest - y.b - 5 OR longest - y.b < x.b)""")
def combined_match(t):
    own = _lines(t)
    coded = own.select("id", "line", F.concat(F.lit("00"), (F.col("id") % 9).cast("string")).alias("code"), (F.col("id") % 20).alias("begin"), (F.col("id") % 20 + 5).alias("end"))
    return compare.combined_within(coded.where("id % 2 = 0"), coded.where("id % 2 = 1"), 0.01, 0.1).select("left_id", "right_id")


_CODED = "c AS (SELECT p_partkey AS id, regexp_replace(p_brand, 'Brand#', '') AS code, p_size AS b, p_size + 2 AS e FROM part), m AS (SELECT code, max(greatest(b, e)) AS longest FROM c GROUP BY code)"


def _coded(t):
    own = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("0"), F.regexp_replace("p_brand", "Brand#", "")).alias("code"), F.col("p_size").alias("begin"), (F.col("p_size") + 2).alias("end"))
    return own.where("id % 2 = 0"), own.where("id % 2 = 1")


@query(f"WITH {_CODED} SELECT code, longest FROM m")
def route_extent(t):
    return compare.route_extent(*_coded(t))


@query(f"""WITH {_CODED} SELECT x.code, sum((NOT (x.e < y.b OR y.e < x.b))::INT)::BIGINT AS forward, sum((NOT (x.e < longest - y.e OR longest - y.b < x.b))::INT)::BIGINT AS backward FROM c x JOIN c y ON x.code = y.code AND x.id % 2 = 0 AND y.id % 2 = 1 JOIN m ON m.code = x.code GROUP BY 1 HAVING backward > forward""")
def inverted_routes(t):
    return compare.inverted_routes(compare.route_counts(*_coded(t)))


@query("""WITH k AS (SELECT source, coalesce(lang, '') AS lang, count(*) AS c FROM documents GROUP BY ALL) SELECT source, sum(c)::BIGINT AS n, string_agg(lang || '=' || c::VARCHAR, ',' ORDER BY lang) AS types FROM k GROUP BY source""")
def type_histogram(t):
    found = compare.type_histogram(t.documents, ["source"], "lang")
    return found.withColumn("types", F.array_join(F.transform(F.array_sort(F.map_entries("types")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","))


@query("""SELECT 'deep' AS flag, count(*) FILTER (WHERE l_discount > 0.05) AS n, 100.0 * count(*) FILTER (WHERE l_discount > 0.05) / count(*) AS pct FROM lineitem UNION ALL SELECT 'wide', count(*) FILTER (WHERE l_quantity > 25), 100.0 * count(*) FILTER (WHERE l_quantity > 25) / count(*) FROM lineitem""")
def flagged_pairs(t):
    return compare.flagged(t.lineitem, {"deep": F.col("l_discount") > 0.05, "wide": F.col("l_quantity") > 25})


@query(f"""WITH {_POINTS}, a AS (SELECT * FROM e WHERE id % 3 = 0), p AS (SELECT l.id, r.id AS near_right_id FROM a l JOIN e r ON r.id % 3 = 1 AND power(l.x - r.x, 2) + power(l.y - r.y, 2) <= 0.0004), q AS (SELECT l.id, r.id AS wide_right_id FROM a l JOIN e r ON r.id % 3 = 2 AND power(l.x - r.x, 2) + power(l.y - r.y, 2) <= 0.0009)
SELECT a.id, near_right_id, wide_right_id FROM a LEFT JOIN p USING (id) LEFT JOIN q USING (id)""")
def chained_matches(t):
    p = _points(t)
    a = p.where("id % 3 = 0").select("id", "x", "y")
    steps = [("near", p.where("id % 3 = 1"), 0.02), ("wide", p.where("id % 3 = 2"), 0.03)]
    return compare.chained_within(a, steps).select("id", "near_right_id", "wide_right_id")


_BOXES = "b AS (SELECT label, min(x) AS xmin, min(y) AS ymin, min(x) + 0.2 AS xmax, min(y) + 0.2 AS ymax FROM e GROUP BY label)"


def _boxes(t):
    return _points(t).groupBy(F.col("label").alias("id")).agg(F.min("x").alias("xmin"), F.min("y").alias("ymin")).withColumns({"xmax": F.col("xmin") + 0.2, "ymax": F.col("ymin") + 0.2})


@query(f"""WITH {_POINTS}, {_BOXES} SELECT b.label AS box_id, e.id FROM b JOIN e ON x BETWEEN xmin - 0.015 AND xmax + 0.015 AND y BETWEEN ymin - 0.015 AND ymax + 0.015""")
def padded_boxes(t):
    return spatial.in_boxes(_points(t), _boxes(t), 0.015, 0.05).select("box_id", "id")


@query(f"""WITH {_POINTS}, {_BOXES}, d AS (SELECT e.id, b.label, sqrt(power(greatest(xmin - x, 0, x - xmax), 2) + power(greatest(ymin - y, 0, y - ymax), 2)) AS d FROM b, e WHERE x BETWEEN xmin - 0.05 AND xmax + 0.05)
SELECT id AS left_id, first(label ORDER BY round(d, 9), label) AS right_id FROM d WHERE d <= 0.03 GROUP BY id""")
def points_in_regions(t):
    corners = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")]
    rings = _boxes(t).select("id", F.array(*[G.point(F.col(x), F.col(y)) for x, y in corners]).alias("line"))
    found = compare.points_in(_points(t).select("id", "x", "y"), rings, 0.05, 0.03)
    return compare.first_match(found.withColumn("distance", F.round("distance", 9))).select("left_id", "right_id")


@query(f"""WITH {_SEGMENTS} SELECT o.id, round(min({_near("o.x", "o.y", "s")}), 6) AS distance FROM e o JOIN s ON s.line // 3 <> o.id // 12 GROUP BY o.id""")
def parts_distance(t):
    """Three lines after each other are the parts of one; each point is measured to all lines but those of its own."""
    lines = _lines(t).withColumn("whole", F.floor(F.col("id") / 3))
    return compare.parts_nearest(_points(t).withColumn("whole", F.floor(F.col("id") / 12)), lines).select("id", F.round("distance", 6).alias("distance"))


#: Each label's box with a square hole, and a second part beside it.
_HOLED = """h AS (SELECT label, min(x) AS x0, min(y) AS y0 FROM e GROUP BY label), w AS (SELECT e.id, h.label, x - x0 AS u, y - y0 AS v FROM e, h),
f AS (SELECT id, label, greatest(-u, u - 0.2, 0) AS ox, greatest(-v, v - 0.2, 0) AS oy, CASE WHEN u > 0.05 AND u < 0.15 AND v > 0.05 AND v < 0.15 THEN least(u - 0.05, 0.15 - u, v - 0.05, 0.15 - v) ELSE 0 END AS hole, greatest(0.21 - u, u - 0.23, 0) AS px, greatest(-v, v - 0.2, 0) AS py FROM w),
d AS (SELECT id, label, least(CASE WHEN hole > 0 THEN hole ELSE sqrt(ox * ox + oy * oy) END, sqrt(px * px + py * py)) AS d FROM f)"""


def _holed(t):
    low = _points(t).groupBy(F.col("label").alias("id")).agg(F.min("x").alias("x0"), F.min("y").alias("y0"))
    at = lambda x, y: G.point(F.col("x0") + x, F.col("y0") + y)
    ring = lambda a, b, c, d: F.array(at(a, b), at(c, b), at(c, d), at(a, d), at(a, b))
    return low.select("id", F.struct(F.lit(2).alias("dim"), F.array(ring(0, 0, 0.2, 0.2), ring(0.05, 0.05, 0.15, 0.15), ring(0.21, 0, 0.23, 0.2)).alias("chains")).alias("shape"))


@query(f"""WITH {_POINTS}, {_HOLED} SELECT id AS left_id, label AS right_id, round(d, 9) AS distance FROM d WHERE d <= 0.02""")
def areas_within(t):
    """Points at polygons with holes and parts, all within a distance."""
    points = _points(t).select("id", A.of_points(G.point(F.col("x"), F.col("y"))).alias("shape"))
    return spatial.area_join(points, _holed(t), 0.02).withColumn("distance", F.round("distance", 9))


@query(f"""WITH {_POINTS}, {_HOLED}, m AS (SELECT id, label, d, min(d) OVER (PARTITION BY id) AS least FROM d WHERE d <= 0.02), r AS (SELECT * FROM m WHERE d <= 0 OR least > 0)
SELECT e.id AS left_id, r.label AS right_id, CASE WHEN r.d <= 0 THEN 'strict' WHEN r.d > 0 THEN 'near' END AS relation FROM e LEFT JOIN r ON r.id = e.id""")
def area_cascade(t):
    """Touched areas, else near ones, else none."""
    points = _points(t).select("id", A.of_points(G.point(F.col("x"), F.col("y"))).alias("shape"))
    return spatial.area_cascade(points, _holed(t), 0.02).select("left_id", "right_id", "relation")


# structures with their geometries; sinks and sources, written and read again

_STRUCTURES = """x AS (SELECT s_suppkey AS id, s_nationkey::DOUBLE AS bx, s_nationkey + 100.0::DOUBLE AS ax FROM supplier), k AS (SELECT s_suppkey AS id, p_partkey::VARCHAR AS child, p_size::DOUBLE AS cx, p_retailprice AS cy FROM supplier, part, (SELECT count(*) AS n FROM supplier) AS o WHERE p_partkey % n = s_suppkey % n)"""


def _structures(t):
    point = lambda x, y: G.point(x.cast("double"), y)
    own = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), point(F.col("s_nationkey"), F.lit(0.0)).alias("before"), point(F.col("s_nationkey") + 100, F.lit(0.0)).alias("after"))
    many = t.supplier.agg(F.count(F.lit(1)).alias("_n"))
    kids = t.part.crossJoin(many).select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % F.col("_n")).alias("_k"), point(F.col("p_size"), F.col("p_retailprice")).alias("centre"))
    child = own.crossJoin(many).select(F.col("id").alias("parent"), (F.col("id") % F.col("_n")).alias("_k")).join(kids, "_k").drop("_k")
    return schema.nested(own, child.withColumn("id", F.col("id").cast("string")), "id", "parent", "children", "id")


@query(f"""WITH {_STRUCTURES}, f AS (SELECT id, 'lock_' || id::VARCHAR || '_split' AS f, bx AS x1, 0.0 AS y1, NULL::DOUBLE AS x2, NULL::DOUBLE AS y2 FROM x UNION ALL SELECT id, 'lock_' || id::VARCHAR || '_merge', ax, 0.0, NULL, NULL FROM x
UNION ALL SELECT id, 'chamber_' || child || e, cx, cy, NULL, NULL FROM k, (VALUES ('_start'), ('_end')) v(e) UNION ALL SELECT k.id, 'chamber_' || child || '_approach', bx, 0.0, cx, cy FROM k JOIN x USING (id) UNION ALL SELECT id, 'chamber_' || child || '_route', cx, cy, cx, cy FROM k UNION ALL SELECT k.id, 'chamber_' || child || '_exit', cx, cy, ax, 0.0 FROM k JOIN x USING (id))
SELECT id::VARCHAR AS structure_id, f AS id, x1::DOUBLE AS x1, y1::DOUBLE AS y1, x2, y2 FROM f""")
def lock_features(t):
    own = _structures(t)
    found = dropins.with_geometry(structures.detailed_features(own, "lock"), dropins.node_points(own, "lock"))
    at = lambda i, c: F.try_element_at("geometry", F.lit(i))[c].alias(f"{c}{i}")
    return found.select("structure_id", "id", at(1, "x"), at(1, "y"), at(2, "x"), at(2, "y"))


@query(f"""WITH {_STRUCTURES}, v AS (SELECT id::VARCHAR AS id, 'virtual_' || id::VARCHAR AS child, (bx + ax) / 2 AS cx FROM x WHERE id % 2 = 1 UNION ALL SELECT id::VARCHAR, child, cx FROM k WHERE id % 2 = 0)
SELECT 'bridge_' || id::VARCHAR || '_split' AS id, bx AS x1, NULL::DOUBLE AS x2 FROM x UNION ALL SELECT 'bridge_' || id::VARCHAR || '_merge', ax, NULL FROM x UNION ALL SELECT 'opening_' || child || e, cx, NULL FROM v, (VALUES ('_start'), ('_end')) w(e)
UNION ALL SELECT 'opening_' || child || '_approach', bx, cx FROM v JOIN x ON x.id::VARCHAR = v.id UNION ALL SELECT 'opening_' || child || '_passage', cx, cx FROM v UNION ALL SELECT 'opening_' || child || '_exit', cx, ax FROM v JOIN x ON x.id::VARCHAR = v.id""")
def bridge_features(t):
    """Every other bridge has no openings, and so a virtual one."""
    own = _structures(t).withColumn("children", F.filter("children", lambda c: F.col("id") % 2 == 0))
    found = dropins.with_geometry(structures.detailed_features(own, "bridge"), dropins.node_points(own, "bridge"))
    at = lambda i: F.try_element_at("geometry", F.lit(i))["x"].alias(f"x{i}")
    return found.select("id", at(1), at(2))


@query("""WITH p AS (SELECT 'lock_passage_' || s_suppkey::VARCHAR AS id, s_nationkey::DOUBLE AS x1, s_nationkey + 100.0::DOUBLE AS x2 FROM supplier)
SELECT id, x1, x2, NULL::DOUBLE AS length_m FROM p UNION ALL SELECT 'fairway_segment_section_' || s || '_0', NULL, NULL, 90.0 FROM (SELECT s_suppkey::VARCHAR AS s FROM supplier) UNION ALL SELECT 'fairway_segment_section_' || s || '_1', NULL, NULL, 890.0 FROM (SELECT s_suppkey::VARCHAR AS s FROM supplier)""")
def simplified_build(t):
    """Each supplier's lock on a section of its own, at 100 m with 10 m around."""
    sid = F.col("id").cast("string")
    locks = _structures(t).withColumn("sections", F.array(F.struct(sid.alias("id"), F.lit("direct").alias("relation"), F.lit(100.0).alias("distance"))))
    sections = t.supplier.select(F.col("s_suppkey").cast("string").alias("section_id"), F.lit("a").alias("start"), F.lit("b").alias("end"), F.lit(1000.0).alias("length"))
    edges = dropins.build(sections, {"lock": locks}, {}, "simplified")["edges"]
    at = lambda i: F.try_element_at("geometry", F.lit(i))["x"].alias(f"x{i}")
    return edges.select("id", at(1), at(2), "length_m")


#: An order is a section along two sides of a square of 100 m for each of its line items; a line item stands 120 m behind the
#: one before it, beside the line: a terminal, a bridge or a lock by its flag.
_CORNERED = """c AS (SELECT l_orderkey AS o, l_linenumber AS k, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL),
n AS (SELECT o, max(k) * 100.0::DOUBLE AS side FROM c GROUP BY o),
q AS (SELECT o, k, 120.0::DOUBLE * k AS d, CASE flag WHEN 'A' THEN 'terminal' WHEN 'R' THEN 'bridge' ELSE 'lock' END || '_' || o::VARCHAR || '-' || k::VARCHAR AS cut, CASE flag WHEN 'A' THEN 0.0::DOUBLE WHEN 'R' THEN 10.0::DOUBLE ELSE 50.0::DOUBLE END AS r FROM c),
m AS (SELECT *, d - r AS split, d + CASE r WHEN 0 THEN 0.001::DOUBLE ELSE r END AS merge FROM q),
g AS (SELECT o, coalesce(lag(merge) OVER w, 0) AS b, split AS e, lag(cut) OVER w AS source, cut AS target FROM m WINDOW w AS (PARTITION BY o ORDER BY d)
UNION ALL SELECT o, arg_max(merge, k), 2 * any_value(side), arg_max(cut, k), NULL FROM m JOIN n USING (o) GROUP BY o),
z AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY b) - 1 AS i FROM g JOIN n USING (o))"""
_ENDS = """CASE WHEN source LIKE 'terminal%' THEN source || '_connection' WHEN source IS NULL THEN 'a' || o::VARCHAR ELSE source || '_merge' END AS source_node, CASE WHEN target LIKE 'terminal%' THEN target || '_connection' WHEN target IS NULL THEN 'b' || o::VARCHAR ELSE target || '_split' END AS target_node"""


def _cornered(t):
    own = t.lineitem.groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("k")).agg(F.min("l_returnflag").alias("flag"))
    side = own.groupBy("o").agg((F.max("k") * 100.0).alias("side"))
    corners = F.array(G.point(0.0, 0.0), G.point(F.col("side"), 0.0), G.point(F.col("side"), F.col("side")))
    sections = side.select(F.col("o").alias("section_id"), _text("a", "o").alias("start"), _text("b", "o").alias("end"), corners.alias("line"))
    d, flag = F.col("k") * 120.0, F.col("flag")
    kind = F.when(flag == "A", "terminal").when(flag == "R", "bridge").otherwise("lock")
    beside = F.when(d <= F.col("side"), G.point(d, -7.0)).otherwise(G.point(F.col("side") + 5, d - F.col("side")))
    cuts = own.join(side, "o").select(F.col("o").alias("section_id"), F.concat(kind, F.lit("_"), F.col("o").cast("string"), F.lit("-"), F.col("k").cast("string")).alias("id"), F.when(flag == "A", 0.0).when(flag == "R", 10.0).otherwise(50.0).alias("buffer"), beside.alias("anchor"))
    return sections, cuts


@query(f"""WITH {_CORNERED} SELECT 'fairway_segment_section_' || o::VARCHAR || '_' || i::VARCHAR AS id, {_ENDS}, round(e - b, 6) AS length_m, 2 + (b < side AND side < e)::INT AS points,
round(least(b, side), 6) AS x1, round(greatest(b - side, 0), 6) AS y1, round(least(e, side), 6) AS x2, round(greatest(e - side, 0), 6) AS y2 FROM z""")
def spliced_lines(t):
    """Segments with their own stretch of a bent line, between structures known by points beside it."""
    first, last = F.col("geometry")[0], F.element_at("geometry", -1)
    ends = [F.round(p[c], 6).alias(f"{c}{i}") for i, p in ((1, first), (2, last)) for c in ("x", "y")]
    return splice.splice_lines(*_cornered(t)).select("id", "source_node", "target_node", F.round("length_m", 6).alias("length_m"), F.size("geometry").alias("points"), *ends)


@query(f"""WITH {_CORNERED}, s AS (SELECT *, {_ENDS} FROM z), p AS (SELECT source_node AS id, least(b, side) AS x, greatest(b - side, 0) AS y, o, i * 2 AS place FROM s UNION ALL SELECT target_node, least(e, side), greatest(e - side, 0), o, i * 2 + 1 FROM s)
SELECT id, CASE WHEN id LIKE 'lock%' THEN 'lock_end' WHEN id LIKE 'bridge%' THEN 'bridge_end' ELSE 'junction' END AS node_type, round(arg_min(x, place), 6) AS x, round(arg_min(y, place), 6) AS y FROM p GROUP BY id""")
def segment_nodes(t):
    """The nodes at the segments' ends: junctions, connections, splits and merges, each with its point."""
    return splice.segment_nodes(splice.splice_lines(*_cornered(t))).select("id", "node_type", F.round("point.x", 6).alias("x"), F.round("point.y", 6).alias("y"))


@query("""WITH o AS (SELECT s_suppkey AS id, s_nationkey AS n FROM supplier), e AS (
SELECT id, 'fairway_segment_section_' || id::VARCHAR || '_0' AS edge, 'a' || n::VARCHAR AS source_node, 'lock_' || id::VARCHAR || '_split' AS target_node, 330.0 AS length_m FROM o UNION ALL SELECT id, 'fairway_segment_section_' || id::VARCHAR || '_1', 'lock_' || id::VARCHAR || '_merge', 'terminal_' || id::VARCHAR || '_connection', 230.0 FROM o
UNION ALL SELECT id, 'fairway_segment_section_' || id::VARCHAR || '_2', 'terminal_' || id::VARCHAR || '_connection', 'a' || ((n + 1) % 25)::VARCHAR, 299.999 FROM o
UNION ALL SELECT id, 'chamber_' || id::VARCHAR || '_approach', 'lock_' || id::VARCHAR || '_split', 'chamber_' || id::VARCHAR || '_start', 50.0 FROM o UNION ALL SELECT id, 'chamber_' || id::VARCHAR || '_route', 'chamber_' || id::VARCHAR || '_start', 'chamber_' || id::VARCHAR || '_end', 40.0 FROM o
UNION ALL SELECT id, 'chamber_' || id::VARCHAR || '_exit', 'chamber_' || id::VARCHAR || '_end', 'lock_' || id::VARCHAR || '_merge', 50.0 FROM o UNION ALL SELECT id, 'terminal_access_' || id::VARCHAR, 'terminal_' || id::VARCHAR || '_connection', 'terminal_' || id::VARCHAR, 25.0 FROM o)
SELECT edge AS id, source_node, target_node, length_m::DOUBLE AS length_m FROM e""")
def detailed_build(t):
    """Each supplier's section of 1000 m between its nation and the next, with a lock at 400 m and a terminal at 700 m."""
    own = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), "s_nationkey")
    p = lambda x, y=0.0: G.point(float(x), float(y))
    sections = own.select(F.col("id").alias("section_id"), _text("a", "s_nationkey").alias("start"), F.concat(F.lit("a"), ((F.col("s_nationkey") + 1) % 25).cast("string")).alias("end"), F.array(p(0), p(500), p(1000)).alias("line"))
    chamber = F.struct("id", p(380).alias("first"), p(420).alias("last"), p(400).alias("centre"), F.lit(40.0).alias("length"))
    lock = own.select("id", "name", p(300).alias("before"), p(500).alias("after"), p(400, 9).alias("point"), F.array(F.struct("id", F.lit("direct").alias("relation"))).alias("sections"), F.array(chamber).alias("children"))
    terminal = own.select("id", "name", F.col("id").alias("section_id"), p(700, 25).alias("point"))
    return dropins.build(sections, {"lock": lock}, {"terminal": terminal})["edges"].select("id", "source_node", "target_node", F.round("length_m", 6).alias("length_m"))


def _folder(t, name: str) -> str:
    """A folder of the query's own in the shared one."""
    base = t.spark.conf.get("spark.checkpoint.dir", None) or t.spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/navnet/{name}-{uuid.uuid4().hex}"


@query("""SELECT event_type AS "GeoType", event_id, value FROM events""")
def types_fanned_out(t):
    path = _folder(t, "types")
    sinks.by_type(t.events.select(F.col("event_type").alias("GeoType"), "event_id", "value"), path)
    return t.spark.read.schema("event_id bigint, value double, GeoType string").json(path)


@query("""SELECT 'n' || n_nationkey::VARCHAR AS id, n_name AS name, '{"a":' || n_regionkey::VARCHAR || '}' AS extra FROM nation""")
def tables_exported(t):
    """Nested columns go as JSON texts, empty tables are skipped."""
    path = _folder(t, "tables")
    own = t.nation.select(_text("n", "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.struct(F.col("n_regionkey").alias("a")).alias("extra"))
    assert sinks.export_tables({"nodes": own, "berths": own.where("false")}, path, needed=("nodes",)) == ["nodes"]
    return t.spark.read.parquet(f"{path}/nodes")


@query("""SELECT 'l' || o_orderkey::VARCHAR AS id, o_totalprice AS width, o_totalprice AS x FROM orders""")
def lines_exported(t):
    """Lines as GeoJSON features, read again as a collection's features."""
    path = _folder(t, "lines")
    own = t.orders.select(_text("l", "o_orderkey").alias("id"), F.col("o_totalprice").alias("width"), F.array(G.point(F.col("o_totalprice"), F.lit(0.0)), G.point(F.lit(1.0), F.lit(2.0))).alias("geometry"))
    sinks.with_line(own, path, "edges")
    rows = t.spark.read.schema("type string, geometry struct<type:string,coordinates:array<array<double>>>, properties struct<id:string,width:double>").json(f"{path}/edges.geojson")
    return rows.where("geometry.type = 'LineString'").select("properties.id", "properties.width", F.col("geometry.coordinates")[0][0].alias("x"))


@query("""SELECT year(ts)::INT AS year, month(ts)::INT AS month, count(*) AS n FROM events GROUP BY ALL""")
def months_exported(t):
    """The partitioned table, read back by its folders."""
    path = _folder(t, "months")
    own = t.events.select("event_id", F.col("event_id").cast("string").alias("v05_06_begindt_evenement"), F.year("ts").alias("file_year"), F.month("ts").alias("file_month"), F.lit("f").alias("source_file"), F.col("event_id").alias("row"))
    sinks.voyage_months(own, path)
    return files.voyages(t.spark, path).groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT s_suppkey, CASE s_nationkey WHEN 0 THEN 3.7115 ELSE s_acctbal END::DOUBLE AS x, CASE s_nationkey WHEN 0 THEN 51.6391 ELSE 1 END::DOUBLE AS y FROM supplier WHERE s_suppkey % 6 > 0""")
def corrected_places(t):
    location = F.when(F.col("s_nationkey") == 0, "NTJ").otherwise(F.col("s_suppkey").cast("string"))
    rows = t.supplier.select("s_suppkey", F.lit("NL").alias("country_code"), location.alias("location_code"), F.when(F.col("s_suppkey") % 6 > 0, F.col("s_acctbal")).alias("x"), F.lit(1.0).alias("y"))
    # NLNTJ stands at several suppliers: their places are looked up by key
    keyed = files.corrected_places(rows).distinct()
    own = rows.where("x is not null").select("s_suppkey", F.concat("country_code", "location_code").alias("code"))
    return own.join(keyed, "code").select("s_suppkey", "x", "y")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) > 1""")
def discrepancies(t):
    """Ids with several matches; those without one are none here."""
    matches = t.lineitem.select(F.col("l_orderkey").alias("left_id"), F.col("l_linenumber").alias("right_id"))
    alone, many = sinks.discrepancies(t.orders.select(F.col("o_orderkey").alias("id")), matches, "id")
    return t.lineitem.join(many.select(F.col("id").alias("l_orderkey")), "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")
