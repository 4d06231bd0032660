"""navnet <command>: the pipelines from files to files."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import dropins, graph, network, splice, structures, traffic, validate
from .operators.store import stored
from .sources import files, sinks
from .timing import timer


def session() -> SparkSession:
    return SparkSession.builder.appName("navnet").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def build(spark: SparkSession, a: argparse.Namespace) -> None:
    """Sections and junctions to a graph."""
    t = files.bundle(spark, a.source, ("section", "routejunction"))
    nodes, edges = graph.build_graph(t["section"], t["routejunction"], a.order, a.start, a.end, a.node)
    print(json.dumps(sinks.export_graph(nodes.withColumnRenamed(a.node, "id"), edges, a.target)))


def foreign(spark: SparkSession, a: argparse.Namespace) -> None:
    """Nodes and sections of an explicit-link source to a graph, with records, border edges and subgraphs."""
    t = files.bundle(spark, a.source, ("nodes", "sections"))
    nodes, edges = network.foreign_graph(t["nodes"], t["sections"], a.order)
    first = [c for c in nodes.schema["records"].dataType.elementType.names if c not in nodes.columns]
    nodes = nodes.withColumns({c: F.col("records")[0][c] for c in first})
    print(json.dumps(sinks.export_graph(nodes.withColumnRenamed("node_id", "id"), edges.withColumnsRenamed({"source": "src", "target": "dst"}), a.target)))


def stitch(spark: SparkSession, a: argparse.Namespace) -> None:
    """Border links between two graphs: nodes with id, x and y in metres, the foreign ones with countrycode."""
    read = lambda p, n: spark.read.parquet(f"{p}/{n}")
    links = network.stitched(read(a.home, "nodes"), read(a.foreign, "nodes"), read(a.foreign, "edges"), a.country, float(a.at_most))
    links.write.mode("overwrite").parquet(a.target)


def enrich(spark: SparkSession, a: argparse.Namespace) -> None:
    """Edges with what is known of their sections. The plan (JSON) lists by_key: table, key, prefix, columns; and by_range:
    table, prefix, columns; tables are Parquet folders of the source."""
    with open(a.plan) as f:
        plan = json.load(f)
    table = lambda name: spark.read.parquet(f"{a.source}/{name}")
    by_key = [(table(name), key, prefix, columns) for name, key, prefix, columns in plan.get("by_key", [])]
    by_range = [(table(name), prefix, columns) for name, prefix, columns in plan.get("by_range", [])]
    network.enriched(table("edges"), by_key, by_range, a.order, a.section, tuple(a.route.split(","))).write.mode("overwrite").parquet(f"{a.target}/edges")


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    """Two graphs and their border links to one; links that aren't given are found as stitch finds them."""
    read = lambda p, n: spark.read.parquet(f"{p}/{n}")
    links = spark.read.parquet(a.links) if a.links else network.stitched(read(a.home, "nodes"), read(a.foreign, "nodes"), read(a.foreign, "edges"), a.country, float(a.at_most))
    nodes, edges = graph.merge_graphs((read(a.home, "nodes"), read(a.home, "edges")), (read(a.foreign, "nodes"), read(a.foreign, "edges")), links, a.country)
    print(json.dumps(sinks.export_graph(nodes, edges, a.target)))


def run_all(spark: SparkSession, a: argparse.Namespace) -> None:
    """From the sources of both graphs (folders home and foreign) to the merged graph and its report, in the target."""
    step = lambda fn, **options: fn(spark, argparse.Namespace(**{**vars(a), **options}))
    step(build, source=f"{a.source}/home", target=f"{a.target}/home")
    step(foreign, source=f"{a.source}/foreign", target=f"{a.target}/foreign")
    step(merge, home=f"{a.target}/home", foreign=f"{a.target}/foreign", links="", target=f"{a.target}/merged")
    step(check, source=f"{a.target}/merged", target=f"{a.target}/report.md")


def check(spark: SparkSession, a: argparse.Namespace) -> None:
    """A report on a merged graph."""
    nodes, edges = spark.read.parquet(f"{a.source}/nodes"), spark.read.parquet(f"{a.source}/edges")
    parts = {"statistics": list(validate.statistics(nodes, edges).items()), "borders": list(validate.borders(edges).items()) if "distance" in edges.columns else []}
    with open(a.target, "w") as f:
        f.write(sinks.report("Network", parts))


def process(spark: SparkSession, a: argparse.Namespace) -> None:
    """Zipped weekly voyage files to the monthly table."""
    sinks.voyage_months(files.zipped_voyages(spark, a.source), a.target)


@timer
def cuts(spark: SparkSession, a: argparse.Namespace) -> None:
    """Sections and cuts to spliced segments."""
    splice.splice(spark.read.parquet(f"{a.source}/sections"), spark.read.parquet(f"{a.source}/cuts")).write.mode("overwrite").parquet(a.target)


#: Tables of a drop-in build by what they hold.
COMPLEXES, OBJECTS = ("lock", "bridge"), ("terminal", "berth")


@timer
def build_dropins(spark: SparkSession, a: argparse.Namespace) -> None:
    """Sections, structures and objects to the tables of a drop-in network."""
    t = files.bundle(spark, a.source, ("sections",), (*COMPLEXES, *OBJECTS))
    made = dropins.build(t["sections"], {k: t[k] for k in COMPLEXES if k in t}, {k: t[k] for k in OBJECTS if k in t}, a.mode)
    print(json.dumps(sinks.export_tables(made, a.target, needed=("nodes", "edges"))))


@timer
def schematize(spark: SparkSession, a: argparse.Namespace) -> None:
    """Structures and their children to complexes, and nodes and edges with lines."""
    t = files.bundle(spark, a.source, ("structures", "children"), ("grandchildren",))
    own = structures.complexes(t["structures"], t["children"], a.parent, t.get("grandchildren"), ignored=tuple(filter(None, a.ignored.split(","))))
    features = dropins.with_geometry(structures.detailed_features(own, a.kind), dropins.node_points(own, a.kind)) if "before" in own.columns else structures.detailed_features(own, a.kind)
    tables = {a.kind: own.drop("children"), "nodes": features.where("feature_type = 'node'"), "edges": features.where("feature_type <> 'node'")}
    print(json.dumps(sinks.export_schematization(own, tables, a.target)))


@timer
def assign(spark: SparkSession, a: argparse.Namespace) -> None:
    """Voyages over a network to the intensity of its edges."""
    t = files.bundle(spark, a.source, ("edges", "nodes", "places"), ("vessels",))
    voyages = files.voyages(spark, f"{a.source}/voyages", a.year and int(a.year), a.month and int(a.month)) if a.year else spark.read.parquet(f"{a.source}/voyages")
    codes = voyages.select(F.col("origin").alias("code")).union(voyages.select("destination")).distinct()
    known = {r.class_code: (r.beam, r.length, r.cemt) for r in t["vessels"].collect()} if "vessels" in t else {}
    trips, intensity, status = traffic.assign(voyages, traffic.geocode(codes, t["nodes"], t["places"]), t["edges"], known)
    trips = stored(trips, "assigned")
    intensity = traffic.with_penalties(intensity, trips, t["edges"], known)
    sinks.export_assignment(trips, intensity, traffic.penalised(trips, t["edges"], known), t["edges"], a.target)
    print(json.dumps({r.status: r.groups for r in status.collect()}))


def publish(spark: SparkSession, a: argparse.Namespace) -> None:
    """Check that a publication has all it needs; nothing is sent."""
    if missing := sinks.missing_artifacts(spark, a.source, tuple(a.needed.split(","))):
        raise SystemExit("missing: " + ", ".join(missing))
    print(json.dumps({"source": a.source, "complete": True}))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="navnet", description=__doc__)
    p.add_argument("--debug", action="store_true")
    commands = p.add_subparsers(dest="command", required=True)
    for name, fn, options in (
        ("build", build, {"--order": "id", "--start": "start_junction_id", "--end": "end_junction_id", "--node": "id"}),
        ("foreign", foreign, {"--order": "order"}),
        ("stitch", stitch, {"--home": None, "--foreign": None, "--country": "NL", "--at-most": "100"}),
        ("merge", merge, {"--home": None, "--foreign": None, "--links": "", "--country": "NL", "--at-most": "100"}),
        ("enrich", enrich, {"--plan": None, "--order": "order", "--section": "section_id", "--route": "route_id,km_begin,km_end"}),
        ("all", run_all, {"--order": "order", "--start": "start_junction_id", "--end": "end_junction_id", "--node": "id", "--country": "NL", "--at-most": "100"}),
        ("validate", check, {}),
        ("process", process, {}),
        ("cuts", cuts, {}),
        ("dropins", build_dropins, {"--mode": "detailed"}),
        ("schematize", schematize, {"--kind": "lock", "--parent": "parent_id", "--ignored": ""}),
        ("assign", assign, {"--year": "", "--month": ""}),
        ("publish", publish, {"--needed": "nodes,edges,summary.json"}),
    ):
        c = commands.add_parser(name, help=fn.__doc__)
        if name not in ("merge", "stitch"):
            c.add_argument("source")
        if name != "publish":
            c.add_argument("target")
        for o, default in options.items():
            c.add_argument(o, default=default, required=default is None)
        c.set_defaults(run=fn)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.debug else logging.INFO)
    a.run(session(), a)


if __name__ == "__main__":
    main()
