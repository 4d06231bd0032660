"""Graph operators on edge tables (src, dst, ...) and node tables (id, ...)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lines as L
from .components import components
from .relational import keep_last, ragged_union, semi_referenced
from .store import stored


def build_graph(sections: DataFrame, junctions: DataFrame, order: str, start: str = "start", end: str = "end", node: str = "id") -> tuple[DataFrame, DataFrame]:
    """nodes, edges: sections with both ends, the last of each undirected pair; junctions that some section refers to. Sections
    with a line in degrees (an array of points) get length_m, along it on the ellipsoid."""
    own = sections.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumnRenamed(start, "src").withColumnRenamed(end, "dst")
    keyed = own.withColumn("_a", F.least("src", "dst")).withColumn("_b", F.greatest("src", "dst"))
    edges = measured(keep_last(keyed, ["_a", "_b"], [order]).drop("_a", "_b"))
    return semi_referenced(junctions, node, edges, ("src", "dst")), edges


def measured(edges: DataFrame) -> DataFrame:
    """edges with length_m, the geodesic length of their lines (degrees), if they have lines; null where there is none."""
    return edges.withColumn("length_m", L.geodesic_length("line")) if "line" in edges.columns else edges


def merge_graphs(home: tuple[DataFrame, DataFrame], foreign: tuple[DataFrame, DataFrame], links: DataFrame, country: str, names: tuple[str, str] = ("FIS", "EURIS"), pruned_nodes: tuple = (), pruned_edges: tuple = (), edge_id: str = "edge_id") -> tuple[DataFrame, DataFrame]:
    """One graph: ids prefixed by source, foreign nodes of the home country (and edges at them) left out, pruned parts of
    the home graph too, and border links (home_node, foreign_node, bridgehead, distance)."""
    (hn, he), (fn, fe) = home, foreign
    pre = lambda df, p, cols: df.withColumns({c: F.concat(F.lit(p + "_"), F.col(c).cast("string")) for c in cols}).withColumn("data_source", F.lit(p))
    if pruned_nodes:
        hn = hn.where(~F.col("id").isin(*pruned_nodes))
        he = he.where(~F.col("src").isin(*pruned_nodes) & ~F.col("dst").isin(*pruned_nodes))
    if pruned_edges and edge_id in he.columns:
        he = he.where(~F.coalesce(F.col(edge_id).isin(*pruned_edges), F.lit(False)))
    own = fn.where(F.coalesce(F.col("countrycode") == country, F.lit(False))).select("id")
    fe = fe.join(own.withColumnRenamed("id", "src"), "src", "left_anti").join(own.withColumnRenamed("id", "dst"), "dst", "left_anti")
    fn = fn.join(own, "id", "left_anti")
    border = links.select(F.concat(F.lit(names[0] + "_"), F.col("home_node").cast("string")).alias("src"), F.concat(F.lit(names[1] + "_"), F.col("foreign_node").cast("string")).alias("dst"), *[c for c in links.columns if c not in ("home_node", "foreign_node")], F.lit("BORDER").alias("data_source"))
    return ragged_union([pre(hn, names[0], ["id"]), pre(fn, names[1], ["id"])]), ragged_union([pre(he, names[0], ["src", "dst"]), pre(fe, names[1], ["src", "dst"]), border])


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def component_sizes(edges: DataFrame) -> DataFrame:
    """component, size, by size (largest first), then component."""
    return components(edges).groupBy("component").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "component")


def neighbourhood(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """node, hops: every node within so many steps of a seed (node), with its least number of steps."""
    own = stored(edges.select("src", "dst"), "neighbourhood")
    # Fronts are stored, so that their sizes are known: edges are only shuffled for a front that is large itself.
    found = front = stored(seeds.select("node", F.lit(0).alias("hops")), "neighbourhood")
    for k in range(1, hops + 1):
        at = front.select(F.col("node").alias("at")).distinct()
        step = at.join(own, F.col("at") == F.col("src")).select(F.col("dst").alias("node")).union(at.join(own, F.col("at") == F.col("dst")).select("src"))
        step = step.where(F.col("node").isNotNull()).distinct().join(found.select("node"), "node", "left_anti")
        front = stored(step.withColumn("hops", F.lit(k)), "neighbourhood")
        found = found.unionByName(front)
    return found.groupBy("node").agg(F.min("hops").alias("hops"))


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between nodes (node) of the table."""
    own = nodes.select("node").distinct()
    return edges.join(own.withColumnRenamed("node", "src"), "src", "left_semi").join(own.withColumnRenamed("node", "dst"), "dst", "left_semi")


def relaxed_costs(edges: DataFrame, sources: DataFrame, rounds: int) -> DataFrame:
    """source, node, cost: the least cost (edges src, dst, weight, undirected) over at most `rounds` edges."""
    both = edges.select("src", "dst", "weight").union(edges.select("dst", "src", "weight")).groupBy("src", "dst").agg(F.min("weight").alias("weight"))
    both = stored(both, "relaxed")
    cost = sources.select(F.col("node").alias("source"), "node", F.lit(0.0).alias("cost"))
    for _ in range(rounds):
        step = cost.join(both, cost["node"] == both["src"]).select("source", F.col("dst").alias("node"), (F.col("cost") + F.col("weight")).alias("cost"))
        cost = stored(cost.unionByName(step).groupBy("source", "node").agg(F.min("cost").alias("cost")), "relaxed")
    return cost


def path_pairs(paths: DataFrame, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, step, a, b: each pair of neighbours on a path; a path of under two nodes has none."""
    n = F.greatest(F.size(path) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(path, 1, n).alias("a"), F.slice(path, 2, n).alias("b"))
    return paths.select(*keep, F.posexplode(pairs).alias("step", "p")).select(*keep, "step", "p.a", "p.b")


#: Edges that are broadcast to the routing tasks; a network of more is an error, not a slow job.
MAX_EDGES = 5_000_000


def route(groups: DataFrame, edges: DataFrame, class_key: str, costs: dict[str, Column]) -> DataFrame:
    """groups with path (nodes), edges (keys), cost, status: the cheapest path from origin_node to destination_node.

    edges: src, dst, key. costs: a weight expression over edges for each class. A path depends on origin, destination and
    class: each such three is asked for once, however many groups have it, dealt by (origin, class), and one search serves
    all destinations; groups are joined to the answers. The network, of a checked size, is broadcast. Status: geocode_fail without an end, no_path if unknown or unreachable, else success (origin equal to
    destination: an empty path). Equal costs: fewer edges, then the smaller node."""
    spark = groups.sparkSession
    if edges.limit(MAX_EDGES + 1).count() > MAX_EDGES:
        raise ValueError(f"more than {MAX_EDGES} edges")
    names = sorted(costs)
    table = edges.select("src", "dst", "key", *[costs[n].cast("double").alias(f"w{i}") for i, n in enumerate(names)]).toPandas()
    nodes = np.unique(np.concatenate([table["src"].to_numpy(str), table["dst"].to_numpy(str)])) if len(table) else np.zeros(0, str)
    a, b = (np.searchsorted(nodes, table[c].to_numpy(str)) for c in ("src", "dst"))
    tail, head, edge = np.r_[a, b], np.r_[b, a], np.r_[np.arange(len(a)), np.arange(len(a))]
    order = np.lexsort((head, tail))
    start = np.searchsorted(tail[order], np.arange(len(nodes) + 1))
    shared = spark.sparkContext.broadcast((nodes, start, head[order], edge[order], table["key"].tolist(), {n: table[f"w{i}"].to_numpy() for i, n in enumerate(names)}))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, start, head, edge, keys, weights = shared.value
        number = {n: i for i, n in enumerate(nodes.tolist())}
        for frame in frames:
            out = []
            for (origin, kind), own in frame.groupby(["origin_node", class_key], dropna=False, sort=False):
                wanted = {number[d] for d in own["destination_node"].dropna().astype(str) if d in number}
                tree = search(number.get(str(origin), -1), wanted, start, head, edge, weights.get(kind)) if pd.notna(origin) else {}
                for row in own.itertuples(index=False):
                    d = row.destination_node
                    if pd.isna(origin) or pd.isna(d):
                        out.append(([], [], None, "geocode_fail"))
                    elif str(origin) == str(d):
                        out.append(([], [], 0.0, "success"))
                    elif number.get(str(d), -1) not in tree:
                        out.append(([], [], None, "no_path"))
                    else:
                        at, path, used = number[str(d)], [], []
                        cost = float(tree[at][0])
                        while True:
                            path.append(str(nodes[at]))
                            _, back, e = tree[at]
                            if back < 0:
                                break
                            used.append(str(keys[e]))
                            at = back
                        out.append((path[::-1], used[::-1], cost, "success"))
            rows = pd.concat([g for _, g in frame.groupby(["origin_node", class_key], dropna=False, sort=False)]) if len(frame) else frame
            yield rows.assign(path=[o[0] for o in out], edges=[o[1] for o in out], cost=[o[2] for o in out], status=[o[3] for o in out])

    texts, asked = T.ArrayType(T.StringType()), ["origin_node", "destination_node", class_key]
    schema = T.StructType([*[groups.schema[c] for c in asked], T.StructField("path", texts), T.StructField("edges", texts), T.StructField("cost", T.DoubleType()), T.StructField("status", T.StringType())])
    found = groups.select(*asked).distinct().repartition("origin_node", class_key).mapInPandas(run, schema).withColumnsRenamed({c: f"_{c}" for c in asked})
    same = reduce(lambda a, b: a & b, [groups[c].eqNullSafe(found[f"_{c}"]) for c in asked])
    return groups.join(found, same).drop(*[f"_{c}" for c in asked])


def search(origin: int, wanted: set[int], start, head, edge, weight) -> dict[int, tuple[float, int, int]]:
    """Settled nodes with cost, the node before and the edge from it, until all wanted ones are (Dijkstra)."""
    if origin < 0 or weight is None:
        return {}
    settled: dict[int, tuple[float, int, int]] = {}
    heap, left = [(0.0, 0, origin, -1, -1)], set(wanted)
    while heap and left:
        cost, steps, at, back, e = heapq.heappop(heap)
        if at in settled:
            continue
        settled[at] = (cost, back, e)
        left.discard(at)
        for i in range(start[at], start[at + 1]):
            if (to := int(head[i])) not in settled:
                heapq.heappush(heap, (cost + float(weight[edge[i]]), steps + 1, to, at, int(edge[i])))
    return settled


def representative_node(candidates: DataFrame, edges: DataFrame) -> DataFrame:
    """name, node: of each name's candidates (name, node, x, y) the one nearest to their centroid, of those with two or
    more edges if any (ties: the smaller node)."""
    c = candidates.join(degrees(edges), "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    mid = c.groupBy("name").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    d2 = F.pow(F.col("x") - F.col("mx"), 2) + F.pow(F.col("y") - F.col("my"), 2)
    return c.join(mid, "name").groupBy("name").agg(F.min_by("node", F.struct((F.col("degree") < 2).alias("leaf"), d2.alias("d2"), "node")).alias("node"))


def harbour_access(harbours: DataFrame, junctions: DataFrame, nearest_node: DataFrame) -> DataFrame:
    """harbour_id, node, by: each harbour's access node by the junction of its code (the first), else the nearest node
    (left_id, right_id of spatial.nearest)."""
    by_code = junctions.groupBy("code").agg(F.min("node").alias("_code_node"))
    out = harbours.join(by_code, "code", "left").join(nearest_node, harbours["id"] == nearest_node["left_id"], "left")
    return out.select(F.col("id").alias("harbour_id"), F.coalesce("_code_node", "right_id").alias("node"), F.when(F.col("_code_node").isNotNull(), "code").when(F.col("right_id").isNotNull(), "nearest").alias("by"))
