"""Joins, keyed choices, set operations and aggregates of the network pipelines.

Order rule: "first" and "last" are always by an explicit order column, never by the order of rows. Sums of nothing but
nulls are 0 where the operator says so. Small sides are left to the optimiser's own size check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import first_touching
from .store import stored


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key (nulls are a key of their own)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_first(df, keys, [F.desc(c) for c in order])


def distinct_without(df: DataFrame, ignored: str) -> DataFrame:
    return df.dropDuplicates([c for c in df.columns if c != ignored])


def first_value(value: str | Column, order: str | Column) -> Column:
    """The first non-null value of a group."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, F.when(v.isNotNull(), F.col(order) if isinstance(order, str) else order))


def last_value(value: str | Column, order: str | Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.max_by(v, F.when(v.isNotNull(), F.col(order) if isinstance(order, str) else order))


def left_first(left: DataFrame, right: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """left with columns of the first right row of its key, null without one."""
    own = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("_r"))
    return left.join(own, key, "left").select(left["*"], *[F.col("_r")[c].alias(c) for c in columns])


def fill_from(left: DataFrame, right: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """left, its columns overwritten by the non-null ones of the first right row of its key."""
    found = left_first(left, right.select(key, order, *[F.col(c).alias(f"_new_{c}") for c in columns]), key, order, [f"_new_{c}" for c in columns])
    return found.withColumns({c: F.coalesce(f"_new_{c}", c) if c in left.columns else F.col(f"_new_{c}") for c in columns}).drop(*[f"_new_{c}" for c in columns])


def match_by_range(left: DataFrame, data: DataFrame | None, key: str, begin: str, end: str, left_id: str, order: str, columns: list[str], prefix: str = "", pairs: int = 100_000_000) -> DataFrame:
    """left_id and prefixed columns of the first data row (by order) of the same key whose range touches left's; ranges
    are closed and may be reversed. Rows of left with a null key or end are left out, those without a match have nulls.
    Where the keys' rows make up more than so many pairs, these are never looked at one by one (intervals.first_touching), so
    a key of half of all rows is many tasks'; up to that, the equality is a hash join's and the ranges its residual
    condition. The result is the same. Data without an order can't be first. No data: left_id only; empty data: an error."""
    rows = left.dropna(subset=[key, begin, end])
    if data is None:
        return rows.select(left_id).distinct()
    if data.limit(1).count() == 0:
        raise ValueError("no rows to match")
    have = [c for c in columns if c in data.columns]
    if not have or any(c not in data.columns for c in (key, begin, end)):
        return rows.select(left_id).distinct()
    lo, hi = F.least(begin, end), F.greatest(begin, end)
    own = rows.select(left_id, F.col(key).alias("_k"), lo.cast("double").alias("_b"), hi.cast("double").alias("_e"))
    there = data.dropna(subset=[key, begin, end, order]).select(F.col(key).alias("_k"), lo.cast("double").alias("_lo"), hi.cast("double").alias("_hi"), F.col(order).alias("_o"), F.struct(*have).alias("_r"))
    count = lambda df, n: df.groupBy("_k").agg(F.count(F.lit(1)).cast("double").alias(n))
    if (count(own, "_n").join(count(there, "_m"), "_k").agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0) <= pairs:
        met = own.join(there, (own["_k"] == there["_k"]) & (F.col("_lo") <= F.col("_e")) & (F.col("_b") <= F.col("_hi")), "left")
        best = met.groupBy(left_id).agg(F.min_by("_r", "_o").alias("_r"))
        return best.select(left_id, *[F.col("_r")[c].alias(prefix + c) for c in have])
    if dict(there.dtypes)["_o"] not in ("tinyint", "smallint", "int", "bigint"):
        ranks = stored(there.select("_o").distinct().orderBy("_o").withColumn("_n", F.monotonically_increasing_id()), "orders")
        there = there.join(ranks, "_o").withColumn("_o", F.col("_n")).drop("_n")
    named = lambda df, b, e, *more: df.select(F.col("_k").alias("key"), F.col(b).alias("begin"), F.col(e).alias("end"), *more)
    first = first_touching(named(own, "_b", "_e"), named(there, "_lo", "_hi", F.col("_o").alias("order"))).select(F.col("key").alias("_k"), F.col("begin").alias("_b"), F.col("end").alias("_e"), F.col("first").alias("_o"))
    found = first.join(there, ["_k", "_o"]).where("_lo <= _e and _b <= _hi").groupBy("_k", "_b", "_e").agg(F.min_by(F.struct("_o", "_r"), F.struct("_lo", "_hi")).alias("_f"))
    best = own.join(found, ["_k", "_b", "_e"], "left").groupBy(left_id).agg(F.min_by("_f._r", "_f._o").alias("_r"))
    return best.select(left_id, *[F.col("_r")[c].alias(prefix + c) for c in have])


def undirected_lookup(edges: DataFrame, sections: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """edges (src, dst) with columns of the last section (start, end) in either direction; a reverse one goes before."""
    a = sections.select(F.least("start", "end").alias("_a"), F.greatest("start", "end").alias("_b"), (F.col("start") > F.col("end")).alias("_r"), order, *columns)
    keyed = edges.withColumn("_a", F.least("src", "dst")).withColumn("_b", F.greatest("src", "dst")).withColumn("_er", F.col("src") > F.col("dst"))
    both = keyed.select("_a", "_b", "_er").distinct().join(a, ["_a", "_b"])
    best = both.groupBy("_a", "_b", "_er").agg(F.max_by(F.struct(*columns), F.struct(F.col("_r") != F.col("_er"), order)).alias("_s"))
    return keyed.join(best, ["_a", "_b", "_er"], "left").select(edges["*"], *[F.col("_s")[c].alias(c) for c in columns])


def double_lookup(edges: DataFrame, nodes: DataFrame, key: str, ends: tuple[str, str], columns: list[str], names: tuple[str, str] = ("from_", "to_")) -> DataFrame:
    """edges inner joined to nodes at both ends, columns prefixed."""
    out = edges
    for end, prefix in zip(ends, names, strict=True):
        own = nodes.select(F.col(key).alias(end), *[F.col(c).alias(prefix + c) for c in columns])
        out = out.join(own, end)
    return out


def section_endpoints(sections: DataFrame, nodes: DataFrame, code: str, ref: str, node: str, order: str, place: str | None = None) -> DataFrame:
    """sections with source and target: the first and last of the nodes that refer to them (one node: a loop). Among nodes of
    equal order it is the one with the smallest place (a column of numbers), or without it the smallest node first and the
    largest last."""
    by = lambda at: F.when(F.col(order).isNotNull(), F.struct(F.col(order), at))
    source, target = F.min_by(node, by(F.col(place or node))), F.max_by(node, by(-F.col(place) if place else F.col(node)))
    ends = nodes.groupBy(F.col(ref).alias("_ref")).agg(source.alias("source"), target.alias("target"))
    return sections.join(ends, sections[code] == ends["_ref"]).drop("_ref")


def strict_lookup(left: DataFrame, right: DataFrame, key: str, message: str) -> DataFrame:
    """left inner joined to right by key; a row of left without a partner is an error."""
    found = left.join(right.withColumn("_found", F.lit(True)), key, "left")
    checked = F.when(F.col("_found"), True).otherwise(F.raise_error(F.concat(F.lit(message + ": "), F.col(key).cast("string"))).cast("boolean"))
    return found.where(checked).drop("_found")


def semi_referenced(nodes: DataFrame, node: str, edges: DataFrame, ends: tuple[str, str]) -> DataFrame:
    """nodes that an edge refers to at either end."""
    used = edges.select(F.col(ends[0]).alias(node)).union(edges.select(ends[1])).distinct()
    return nodes.join(used, node, "left_semi")


def matched_sets(all_ids: DataFrame, a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Every id with matched: a, b, both or neither."""
    mark = lambda df, n: df.select(key).distinct().withColumn(n, F.lit(True))
    out = all_ids.select(key).distinct().join(mark(a, "_a"), key, "left").join(mark(b, "_b"), key, "left")
    kind = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "a").when(F.col("_b"), "b").otherwise("neither")
    return out.select(key, kind.alias("matched"))


def ragged_union(frames: list[DataFrame]) -> DataFrame:
    """All rows; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b.select("*"), allowMissingColumns=True), [f.select("*") for f in frames])


def bottleneck(children: Column | str, low: dict[str, str], high: dict[str, str], child_id: str = "id") -> list[Column]:
    """Least and largest of children's fields (target to field), and constituent_ids, their ids comma-joined."""
    c = F.col(children) if isinstance(children, str) else children
    value = lambda f: F.transform(c, lambda x: x[f].cast("double"))
    ids = F.array_join(F.transform(c, lambda x: x[child_id].cast("string")), ",").alias("constituent_ids")
    return [*[F.array_min(value(f)).alias(t) for t, f in low.items()], *[F.array_max(value(f)).alias(t) for t, f in high.items()], ids]


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, missing (null or '') of each, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias(c) for c in columns])
    return counts.select(F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column", "missing"))


def describe(df: DataFrame, column: str, few: int = 1_000_000) -> DataFrame:
    """count, mean, std, min, quartiles (interpolated), max of a column. Quartiles are exact: those of at most `few` values by
    percentile(), which holds the distinct ones in a task, those of more by order_values()."""
    plain = [F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max")]
    names, order = ("q25", "q50", "q75"), ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    many = df.agg(F.count(column)).first()[0]
    if many <= few:
        return df.agg(*plain, *[F.percentile(column, p).alias(n) for n, p in zip(names, (0.25, 0.5, 0.75), strict=True)]).select(*order)
    places = {n: divmod(p * (many - 1), 1) for n, p in zip(names, (0.25, 0.5, 0.75), strict=True)}
    found = order_values(df, column, sorted({int(k) + d for k, _ in places.values() for d in (0, 1) if int(k) + d < many}))
    quartiles = {n: found[int(k)] if not share else (1 - share) * found[int(k)] + share * found[int(k) + 1] for n, (k, share) in places.items()}
    return df.agg(*plain).withColumns({n: F.lit(float(v)) for n, v in quartiles.items()}).select(*order)


def order_values(df: DataFrame, column: str, places: list[int], bins: int = 1024) -> dict[int, float]:
    """The values at the given places (from 0) of the sorted non-null values of a column of finite numbers. Each pass counts the
    values of every place's range in bins and keeps the bin that holds the place, until a bin is one value; a few counts
    for each place are all that comes to the driver, and no task holds the values."""
    value = F.col(column).cast("double")
    own = df.where(F.col(column).isNotNull()).select(value.alias("v"))
    low, high = own.agg(F.min("v"), F.max("v")).first()
    todo, out = {k: (low, high, k) for k in places}, {}  # range, and the place within it
    while todo:
        ranges = sorted({(a, b) for a, b, _ in todo.values()})
        asked = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(ranges)])
        rows = own.select("v", F.explode(F.filter(asked, lambda r: (F.col("v") >= r["a"]) & (F.col("v") <= r["b"]))).alias("r"))
        bin_ = F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("r.a")) / F.nullif(F.col("r.b") - F.col("r.a"), F.lit(0.0)) * bins))
        counts = rows.groupBy("r.i", F.coalesce(bin_, F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).orderBy("i", "bin").collect()
        rest = {}
        for k, (a, b, at) in todo.items():
            for r in (r for r in counts if r.i == ranges.index((a, b))):
                if at < r.n:
                    if r.a == r.b:
                        out[k] = r.a
                    else:
                        rest[k] = (r.a, r.b, at)
                    break
                at -= r.n
        todo = rest
    return out


def group_voyages(trips: DataFrame, keys: list[str], cargo: str, capacity: str, event: str) -> DataFrame:
    """Per group (nulls are groups): cargo (0 if all null), mean capacity, trips (non-null events)."""
    return trips.groupBy(*keys).agg(F.coalesce(F.sum(cargo), F.lit(0.0)).alias("total_cargo"), F.avg(capacity).alias("avg_capacity"), F.count(event).alias("trips"))


def edge_intensity(routed: DataFrame, path: str = "path") -> DataFrame:
    """Per edge of the routed groups' paths: total_cargo, trips."""
    return routed.select(F.explode(path).alias("edge"), "total_cargo", "trips").groupBy("edge").agg(F.sum("total_cargo").alias("total_cargo"), F.sum("trips").alias("trips"))


def top_record(df: DataFrame, keys: list[str], weight: str, tie: list[str], columns: list[str], sums: list[str]) -> DataFrame:
    """Sums per group, and columns of the record with the most weight (a tie: the smallest `tie`)."""
    first = F.min_by(F.struct(*columns), F.struct((-F.col(weight)).alias("w"), *tie))
    own = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], first.alias("_top"))
    return own.select(*keys, *sums, *[F.col("_top")[c].alias(f"top_{c}") for c in columns])
