"""Splicing structures into fairway sections: a fold over the ordered cuts of each section."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions import lines as L
from ..functions.scalars import stringify_id
from .relational import bottleneck
from .store import dealt

EPS = 0.001
#: Fixed values, metres: what a lock takes of a section beyond half its longest chamber, a lock in the simplified mode, a bridge.
LOCK_BUFFER, SIMPLE_LOCK_BUFFER, BRIDGE_BUFFER = 50.0, 10.0, 10.0
_SEGMENTS = T.ArrayType(T.StructType([T.StructField("begin", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("source", T.StringType()), T.StructField("target", T.StringType())]))


@F.arrow_udf(_SEGMENTS)
def _remaining(lengths: pa.Array, cuts: pa.Array) -> pa.Array:
    """The fold of segments() over a batch of lines: their first cuts at once, then their second ones, and so on."""
    length, count = (x.to_numpy(zero_copy_only=False) for x in (lengths, pc.fill_null(pc.list_value_length(cuts), 0)))
    flat, line = cuts.flatten(), np.repeat(np.arange(len(count)), count)
    fields = {c: flat.field(c) for c in ("distance", "buffer", "id")}
    order = pc.sort_indices(pa.table({"line": line, **fields}), sort_keys=[(c, "ascending") for c in ("line", *fields)], null_placement="at_start").to_numpy()
    distance, buffer = (fields[c].to_numpy(zero_copy_only=False).astype(np.float64)[order] for c in ("distance", "buffer"))
    # a cut without a place or buffer: greatest and least go by the rest
    low, high = np.nan_to_num(distance - buffer, nan=0.0), np.fmin(length.astype(np.float64)[line], distance + buffer)
    # each line's cuts, and one place more for its last segment
    first = np.cumsum(count) - count + np.arange(len(count))
    begin, end, kept = np.zeros(len(line) + len(count)), np.zeros(len(line) + len(count)), np.zeros(len(line) + len(count), bool)
    at, i, k = np.zeros(len(count)), np.arange(len(count)), 0
    while len(i := i[count[i] > k]):
        place = first[i] + k
        cut, whole, least = place - i, length[i], at[i] + EPS
        split = np.maximum(least, np.maximum(0.0, low[cut]))
        split = np.where(split >= whole, np.maximum(least, whole - 2 * EPS), split)
        merge = np.maximum(split + EPS, high[cut])
        merge = np.where(merge >= whole, np.maximum(split + EPS, whole - EPS), merge)
        begin[place], end[place], kept[place] = at[i], split, split > least
        at[i] = merge
        k += 1
    last = first + count
    begin[last], end[last], kept[last] = at, length, at < length
    number = np.full(len(kept), -1)
    number[np.delete(np.arange(len(kept)), last)] = order
    source = np.append(-1, number[:-1])
    source[first] = -1
    ids = [fields["id"].take(pa.array(n[kept], mask=n[kept] < 0)) for n in (source, number)]
    sizes = np.add.reduceat(kept.astype(np.int64), first) if len(first) else first
    rows = pa.StructArray.from_arrays([pa.array(begin[kept]), pa.array(end[kept]), *ids], names=["begin", "end", "source", "target"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), rows)


def segments(length: Column, cuts: Column) -> Column:
    """Array of struct(begin, end, source, target): what remains of a line of this length around its cuts (an array of
    struct(distance, buffer, id)). source and target are the ids of the structures at the ends, null at the line's own.
    Cuts go by distance (then buffer, id); one that overlaps the cut before it begins where that ends."""
    plain = F.transform(F.coalesce(cuts, F.expr("cast(array() as array<struct<distance:double,buffer:double,id:string>>)")), lambda c: F.struct(c["distance"].cast("double").alias("distance"), c["buffer"].cast("double").alias("buffer"), c["id"].cast("string").alias("id")))
    return _remaining(length.cast("double"), plain)


def cut_buffer(kind: str, mode: str, own: Column | None = None, lengths: Column | None = None) -> Column:
    """Metres of a section that a structure takes on each side: a lock's own buffer, else half its longest chamber (lengths:
    array) and LOCK_BUFFER, in the simplified mode SIMPLE_LOCK_BUFFER; a bridge BRIDGE_BUFFER; a terminal or berth none."""
    if kind == "lock" and mode != "simplified":
        longest = F.lit(0.0) if lengths is None else F.coalesce(F.array_max(lengths), F.lit(0.0))
        made = longest / 2 + LOCK_BUFFER
        return made if own is None else F.coalesce(own.cast("double"), made)
    return F.lit({"lock": SIMPLE_LOCK_BUFFER, "bridge": BRIDGE_BUFFER}.get(kind, 0.0))


def _node(cut: Column, part: str) -> Column:
    """The node at a cut: a structure's own split or merge, the one connection of a terminal or berth."""
    return F.concat(cut, F.when(cut.rlike("^(terminal|berth)_"), F.lit("_connection")).otherwise(F.lit(f"_{part}")))


def splice(sections: DataFrame, cuts: DataFrame) -> DataFrame:
    """section_id, segment, begin, end, source_node, target_node, length_m of every section (section_id, start, end,
    length) spliced with cuts (section_id, distance, buffer, id). Nodes at a structure are <id>_split and <id>_merge, at a
    terminal or berth <id>_connection on both sides."""
    own = cuts.groupBy("section_id").agg(F.collect_list(F.struct("distance", "buffer", "id")).alias("cuts"))
    rows = sections.join(own, "section_id", "left").withColumn("s", segments(F.col("length"), F.col("cuts")))
    rows = rows.select("section_id", F.col("start").cast("string").alias("_a"), F.col("end").cast("string").alias("_b"), F.posexplode("s").alias("segment", "s"))
    return rows.select(
        "section_id", "segment", "s.begin", "s.end",
        F.coalesce(_node(F.col("s.source"), "merge"), "_a").alias("source_node"),
        F.coalesce(_node(F.col("s.target"), "split"), "_b").alias("target_node"),
        (F.col("s.end") - F.col("s.begin")).alias("length_m"),
    )


def splice_lines(sections: DataFrame, cuts: DataFrame, degrees: bool = False) -> DataFrame:
    """id, section_id, segment, begin, end, segment_type, source_node, target_node, length_m, geometry of every section
    (section_id, start, end, line; fairway_id and name stay if there) spliced with cuts (section_id, id, buffer, and its
    place: distance along the line, or else anchor, a point that is projected onto it).

    Lines are in metres, or in degrees: these are cut on the national grid, and lengths are geodesic. A section that
    nothing cuts is one 'clear' segment, without a number in its id; others are 'clear' only if both their ends are the
    section's. Sections without a line give nothing; cuts without a place none. Segments' measures meet, so their lengths
    and the buffers add up to the line's."""
    extra = [c for c in ("fairway_id", "name") if c in sections.columns]
    place = [F.col(c) if c in cuts.columns else F.lit(None).cast(k).alias(c) for c, k in (("distance", "double"), ("anchor", G.POINT))]
    at = cuts.select(stringify_id("section_id").alias("section_id"), F.struct("id", F.col("buffer").cast("double").alias("buffer"), *place).alias("c"))
    if degrees:
        at = L.with_grid(at.withColumn("_a", F.when(F.col("c.anchor").isNotNull(), F.array("c.anchor"))), "_a", "_g")
        at = at.select("section_id", F.col("c").withField("anchor", F.try_element_at("_g", F.lit(1))).alias("c"))
    own = dealt(at, "section_id").groupBy("section_id").agg(F.collect_list("c").alias("_cuts"))
    rows = dealt(sections.withColumn("section_id", stringify_id("section_id")).where(F.size("line") > 1), "section_id")
    rows = L.with_grid(rows, "line", "_line") if degrees else rows.withColumn("_line", F.col("line"))
    rows = rows.join(own, "section_id", "left").withColumn("_length", G.line_length(F.col("_line")))
    rows = rows.withColumn("_cuts", F.coalesce("_cuts", F.array()))
    if "anchor" in cuts.columns:
        rows = rows.withColumn("_at", L.projections("_line", F.transform("_cuts", lambda c: c["anchor"])))
        placed = F.zip_with("_cuts", "_at", lambda c, at: F.struct(F.coalesce(c["distance"], at).alias("distance"), c["buffer"].alias("buffer"), c["id"].alias("id")))
    else:
        placed = F.transform("_cuts", lambda c: F.struct(c["distance"].alias("distance"), c["buffer"].alias("buffer"), c["id"].alias("id")))
    rows = rows.withColumn("_cuts", F.filter(placed, lambda c: c["distance"].isNotNull())).withColumn("_s", segments(F.col("_length"), F.col("_cuts")))
    rows = rows.withColumn("_p", L.pieces("_line", F.transform("_s", lambda s: s["begin"]), F.transform("_s", lambda s: s["end"])))
    cut = rows.withColumn("_clear", F.size("_cuts") == 0)
    each = cut.select("section_id", *extra, "_clear", stringify_id("start").alias("_a"), stringify_id("end").alias("_b"), F.posexplode(F.arrays_zip(F.col("_s").alias("s"), F.col("_p").alias("p"))).alias("segment", "z"))
    s, piece = F.col("z.s"), F.col("z.p")
    name = F.concat(F.lit("fairway_segment_section_"), F.col("section_id"), F.when(F.col("_clear"), F.lit("")).otherwise(F.concat(F.lit("_"), F.col("segment").cast("string"))))
    out = each.select(
        name.alias("id"), "section_id", *extra, "segment", s["begin"].alias("begin"), s["end"].alias("end"),
        F.when(s["source"].isNull() & s["target"].isNull(), F.lit("clear")).otherwise(F.lit("approach_or_exit")).alias("segment_type"),
        F.coalesce(_node(s["source"], "merge"), "_a").alias("source_node"),
        F.coalesce(_node(s["target"], "split"), "_b").alias("target_node"),
        s["source"].alias("source_cut"), s["target"].alias("target_cut"), piece.alias("geometry"),
    )
    if degrees:
        out = out.withColumn("geometry", L.from_grid("geometry"))
        return out.withColumn("length_m", L.geodesic_length("geometry"))
    return out.withColumn("length_m", F.col("end") - F.col("begin"))


def segment_nodes(segments: DataFrame) -> DataFrame:
    """id, node_type, point of the nodes at the ends of splice_lines()' segments: junctions (and connections, which are
    junctions on the fairway), and the splits and merges of structures. A node of several segments has the point of the
    first of them."""
    kind = lambda cut: F.when(cut.isNull() | cut.rlike("^(terminal|berth)_"), F.lit("junction")).otherwise(F.concat(F.regexp_extract(cut, "^([^_]+)_", 1), F.lit("_end")))
    end = lambda node, cut, point: F.struct(F.col(node).alias("id"), kind(F.col(cut)).alias("node_type"), point.alias("point"))
    ends = F.array(end("source_node", "source_cut", F.col("geometry")[0]), end("target_node", "target_cut", F.element_at("geometry", -1)))
    rows = segments.select("section_id", "segment", F.posexplode(ends).alias("side", "n")).where(F.col("n.id").isNotNull())
    first = dealt(rows.withColumn("id", F.col("n.id")), "id").groupBy("id").agg(F.min_by("n", F.struct("section_id", "segment", "side")).alias("n"))
    return first.select("id", "n.node_type", "n.point")


#: What a simplified passage says of what its structure is made of: of a lock the largest, of a bridge the least, by the fields
#: that can tell it.
CAPACITIES = {"lock": {"dim_gate_width": ("dim_gate_width", "width"), "dim_usable_length": ("dim_usable_length", "length")}, "bridge": {"dim_gate_width": ("dim_gate_width", "width"), "dim_height": ("dim_height", "height")}}


def passages(structures: DataFrame, kind: str) -> DataFrame:
    """Node and edge features of a simplified passage through each structure (id, name, before, after: the points where it
    splits and merges, sections: array of struct(id, relation), children). Structures without both points are skipped.

    With children, an edge has their constituent_ids, comma-joined, and the capacity of the whole: a lock's widest and longest
    chamber, a bridge's narrowest and lowest opening; null where no child says."""
    s = structures.where(F.col("before").isNotNull() & F.col("after").isNotNull()).withColumn("_id", F.col("id").cast("string"))
    name = lambda part: F.concat(F.lit(f"{kind}_"), F.col("_id"), F.lit(f"_{part}"))
    overlap = F.filter("sections", lambda x: x["relation"] == "overlap")
    section = F.coalesce(F.try_element_at(overlap, F.lit(1))["id"], F.try_element_at(F.col("sections"), F.lit(1))["id"])
    node = lambda part: F.struct(name(part).alias("id"), F.lit("node").alias("feature_type"), F.lit(f"{kind}_{part}").alias("type"), F.lit(None).cast("string").alias("source_node"), F.lit(None).cast("string").alias("target_node"), F.lit(None).cast("string").alias("section_id"))
    edge = F.struct(F.concat(F.lit(f"{kind}_passage_"), F.col("_id")).alias("id"), F.lit("fairway_segment").alias("feature_type"), F.lit(f"{kind}_passage").alias("type"), name("split").alias("source_node"), name("merge").alias("target_node"), section.cast("string").alias("section_id"))
    fields = structures.schema["children"].dataType.elementType.names if "children" in structures.columns else []
    told = {target: next(f for f in names if f in fields) for target, names in CAPACITIES.get(kind, {}).items() if set(names) & set(fields)}
    own = bottleneck("children", *((told, {}) if kind == "bridge" else ({}, told))) if fields else []
    found = s.select("*", *own) if own else s
    extra = [*told, "constituent_ids"] if own else []
    rows = found.select(F.col("_id").alias("structure_id"), "name", *extra, F.explode(F.array(node("split"), node("merge"), edge)).alias("f"))
    only = [F.when(F.col("f.feature_type") != "node", F.col(c)).alias(c) for c in extra]
    return rows.select("structure_id", "name", "f.*", *only)


def access_features(objects: DataFrame, kind: str) -> DataFrame:
    """Three features for each terminal or berth (id, name, section_id): its connection, the junction on the section that
    both segments there end in; its own node; and the access edge between them. An object without an id is an error; one without a section is skipped."""
    checked = objects.where(F.when(F.col("id").isNotNull(), True).otherwise(F.raise_error(F.lit(f"{kind} without id")).cast("boolean")))
    own = checked.where(F.col("section_id").isNotNull()).withColumn("_k", F.col("id").cast("string")).withColumn("_id", F.concat(F.lit(f"{kind}_"), "_k"))
    f = lambda i, t, n, a=None, b=None: F.struct(i.alias("id"), F.lit(t).alias("feature_type"), F.lit(n).alias("type"), (a if a is not None else F.lit(None).cast("string")).alias("source_node"), (b if b is not None else F.lit(None).cast("string")).alias("target_node"))
    on = F.concat(F.col("_id"), F.lit("_connection"))
    parts = F.array(f(on, "node", "junction"), f(F.col("_id"), "node", kind), f(F.concat(F.lit(f"{kind}_access_"), F.col("_k")), "fairway_segment", f"{kind}_access", on, F.col("_id")))
    return own.select("name", F.col("section_id").cast("string").alias("section_id"), F.explode(parts).alias("f")).select("name", "section_id", "f.*")
