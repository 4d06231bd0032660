"""The first of the ranges that touch a range, within a key, without listing the pairs that touch.

Two closed ranges touch where one begins within the other. Each key's numbers are cut into buckets that hold about as many
rows each, by quantiles, and a key of many rows into many buckets, so a hot key is dealt out over its buckets.

* A data row stands in the bucket where it begins, for ranges that begin before it; in the buckets where it begins and ends,
  for those that begin within it; all buckets between them it covers.
* A range asks in the bucket where it begins, and in the one where it ends; the buckets between are asked as a whole.

Of what is only told by a bucket, the first row of the bucket is enough; of what is covered, the first row of each node of a
tree over the buckets, so a long range is a few rows, not one for every bucket. Rows with the same two ends are one before
they are shuffled. What remains is asked within a bucket by sorting and sweeping, in NumPy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

#: Rows of a bucket; levels of the tree over a key's buckets, of which there are 2**LEVELS at most.
ROWS, LEVELS = 4096, 10
_NONE = np.iinfo(np.int64).max


def _first_in(order: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least order among the places [low, high): of two overlapping runs of a power of two."""
    out = np.full(len(low), _NONE)
    run, k = order, 0
    while len(todo := np.flatnonzero((high - low) >> k > 0)):
        exact = todo[(high - low)[todo] >> (k + 1) == 0]
        out[exact] = np.minimum(run[low[exact]], run[high[exact] - (1 << k)])
        run, k = np.minimum(run[: len(run) - (1 << k)], run[1 << k :]) if len(run) > 1 << k else run[:0], k + 1
    return out


def _first_over(points: int, order: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of each of so many sorted points, the least order of the rows that cover the places [low, high) around it."""
    top = max(1, points).bit_length()
    runs = [np.full(points, _NONE) for _ in range(top)]
    size = high - low
    for k in range(top):
        own = np.flatnonzero(size >> k == 1)
        for at in (low[own], high[own] - (1 << k)):
            np.minimum.at(runs[k], at, order[own])
    for k in range(top - 1, 0, -1):
        half = 1 << (k - 1)
        np.minimum(runs[k - 1], runs[k], out=runs[k - 1])
        if points > half:
            np.minimum(runs[k - 1][half:], runs[k][: points - half], out=runs[k - 1][half:])
    return runs[0] if points else np.empty(0, np.int64)


def _answered(key: tuple[pa.Scalar, ...], ranges: pa.Table, data: pa.Table) -> pa.Table:
    """kind, a, b, first of the parts of ranges that a bucket is asked for: 'in' (begins and ends here), 'begin', 'end'."""
    role, own = (np.array(t.column("role").to_pylist(), object) for t in (ranges, data))
    ask_begin, ask_end, begin, end = (t.column(c).to_numpy(zero_copy_only=False) for t in (ranges, data) for c in ("begin", "end"))
    order = data.column("order").to_numpy(zero_copy_only=False).astype(np.int64)
    # Data that begins here, after the range does and before it ends.
    starts = np.argsort(begin, kind="stable")
    starts = starts[own[starts] != "end"]
    at, rank = begin[starts], order[starts]
    low = np.where(role == "end", 0, np.searchsorted(at, ask_begin, side="right"))
    high = np.where(role == "begin", len(at), np.searchsorted(at, ask_end, side="right"))
    best = _first_in(rank, low, np.maximum(low, high))
    # Data that the range begins in: a row that leaves the bucket covers the rest of it, one that comes in covers its begin.
    here = np.flatnonzero(role != "end")
    sort = here[np.argsort(ask_begin[here], kind="stable")]
    points = ask_begin[sort]
    low = np.where(own == "end", 0, np.searchsorted(points, begin, side="left"))
    high = np.where(own == "begin", len(points), np.searchsorted(points, end, side="right"))
    best[sort] = np.minimum(best[sort], _first_over(len(points), order, low, np.maximum(low, high)))
    found = pa.array(best < _NONE)
    whole = pa.array(role == "in")
    a = pc.if_else(pa.array(role == "end"), ranges.column("end"), ranges.column("begin"))
    b = pc.if_else(whole, ranges.column("end"), pa.scalar(0.0))
    out = pa.table({"key": pa.chunked_array([pa.repeat(key[0], len(role))]), "kind": pa.array(role.tolist(), pa.string()), "a": a, "b": b, "first": pa.array(best)})
    return out.filter(found)


def _bucket(value: Column) -> Column:
    """The number of bounds at or below a value, of a sorted array: by halving, so in steps of the array's logarithm."""
    halve = lambda acc, k: acc + F.when((acc + k <= F.size("bounds")) & (F.try_element_at("bounds", acc + k) <= value), k).otherwise(0)
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(LEVELS, -1, -1)]), F.lit(0), halve)


def _nodes(low: Column, high: Column) -> Column:
    """The nodes of the tree over 2**LEVELS buckets (leaf 2**LEVELS + bucket; the parent of a node is half of it) that make up
    the buckets low to high: on each level those whose parent reaches beyond."""

    def level(k: int) -> Column:
        size = 1 << k
        a, b = F.ceil(low / size).cast("int"), (F.floor((high + 1) / size) - 1).cast("int")
        alone = lambda x: (F.floor(x / 2) * 2 * size < low) | ((F.floor(x / 2) + 1) * 2 * size - 1 > high) if k < LEVELS else F.lit(True)
        node = lambda x: x + (1 << LEVELS - k)
        return F.when(a <= b, F.array_distinct(F.concat(F.when(alone(a), F.array(node(a))).otherwise(F.expr("cast(array() as array<int>)")), F.when(alone(b), F.array(node(b))).otherwise(F.expr("cast(array() as array<int>)"))))).otherwise(F.expr("cast(array() as array<int>)"))

    return F.flatten(F.array(*[level(k) for k in range(LEVELS + 1)]))


def first_touching(ranges: DataFrame, data: DataFrame, rows: int = ROWS) -> DataFrame:
    """key, begin, end, first: of each distinct range of ranges (key, begin, end) the least order (a whole number) among the
    data (key, begin, end, order) of its key that touch it; ranges that nothing touches are left out. Begins may not be
    after ends, nothing may be null. rows: of a bucket, about."""
    kind = dict(ranges.dtypes)["key"]
    ask = ranges.select("key", F.col("begin").cast("double"), F.col("end").cast("double")).distinct()
    own = data.select("key", F.col("begin").cast("double"), F.col("end").cast("double"), F.col("order").cast("bigint")).groupBy("key", "begin", "end").agg(F.min("order").alias("order"))
    # Bounds: of each key, quantiles of where its rows begin, as many as its rows ask for. They are written, since approximate
    # quantiles come out differently in another order of the partial ones, and ranges and data must have the same buckets.
    steps = [(k + 1) / (1 << LEVELS) for k in range((1 << LEVELS) - 1)]
    both = ask.select("key", "begin").unionByName(own.select("key", "begin"))
    quantiles = both.groupBy("key").agg(F.percentile_approx("begin", steps, 4096).alias("q"), F.count(F.lit(1)).alias("n"))
    many = F.least(F.lit(1 << LEVELS), F.greatest(F.lit(1), F.ceil(F.col("n") / rows))).cast("int")
    pick = F.transform(F.sequence(F.lit(1), F.greatest(many - 1, F.lit(1))), lambda i: F.element_at("q", F.floor(i * (1 << LEVELS) / many).cast("int")))
    bounds = quantiles.select("key", F.when(many > 1, F.array_sort(F.array_distinct(pick))).otherwise(F.expr("cast(array() as array<double>)")).alias("bounds"))
    bounds = stored(bounds, "bounds")
    ask, own = (df.join(bounds, "key").withColumns({"i": _bucket(F.col("begin")), "j": _bucket(F.col("end"))}).drop("bounds") for df in (ask, own))

    # What is asked of buckets as a whole, and what covers a bucket.
    leaf = lambda c: F.array(*[F.shiftright(c + (1 << LEVELS), k) for k in range(LEVELS + 1)])
    up = lambda df, *by: df.groupBy("key", *by).agg(F.min("order").alias("order"))
    between = _nodes(F.col("i") + 1, F.col("j") - 1)
    starts = up(up(own, "i").select("key", "order", F.explode(leaf(F.col("i"))).alias("node")), "node")
    covers = up(up(own.where("j - i > 1"), "i", "j").select("key", "order", F.explode(between).alias("node")), "node")
    inside = up(ask.where("j - i > 1").select("key", "i", "j").distinct().select("key", "i", "j", F.explode(between).alias("node")).join(starts, ["key", "node"]), "i", "j")
    over = up(ask.select("key", "i").distinct().select("key", "i", F.explode(leaf(F.col("i"))).alias("node")).join(covers, ["key", "node"]), "i")

    # What is asked within buckets: a range or row that stands in two has a part in each, with the end that it has there.
    none = F.lit(None).cast("double")
    part = lambda role, bucket, b, e: F.struct(F.lit(role).alias("role"), bucket.alias("bucket"), b.alias("begin"), e.alias("end"))
    parts = F.when(F.col("i") == F.col("j"), F.array(part("in", F.col("i"), F.col("begin"), F.col("end")))).otherwise(F.array(part("begin", F.col("i"), F.col("begin"), none), part("end", F.col("j"), none, F.col("end"))))
    asked = ask.select("key", F.explode(parts).alias("p")).select("key", "p.*").distinct()
    stood = up(own.select("key", "order", F.explode(parts).alias("p")).select("key", "p.*", "order"), "role", "bucket", "begin", "end")
    stood = stood.select(*[F.col(c).alias(c) for c in stood.columns])  # columns of its own, also where both sides are of one table
    within = asked.groupBy("key", "bucket").cogroup(stood.groupBy("key", "bucket")).applyInArrow(_answered, f"key {kind}, kind string, a double, b double, first bigint")

    number = lambda c: F.col(c).cast("double")
    known = within.unionByName(inside.select("key", F.lit("inside").alias("kind"), number("i").alias("a"), number("j").alias("b"), F.col("order").alias("first")))
    known = known.unionByName(over.select("key", F.lit("over").alias("kind"), number("i").alias("a"), F.lit(0.0).alias("b"), F.col("order").alias("first")))
    probe = lambda name, a, b: F.struct(F.lit(name).alias("kind"), a.alias("a"), b.alias("b"))
    zero, here = F.lit(0.0), F.col("i") == F.col("j")
    probes = F.array(
        F.when(here, probe("in", F.col("begin"), F.col("end"))).otherwise(probe("begin", F.col("begin"), zero)),
        F.when(~here, probe("end", F.col("end"), zero)),
        F.when(F.col("j") - F.col("i") > 1, probe("inside", number("i"), number("j"))),
        probe("over", number("i"), zero),
    )
    each = ask.select("key", "begin", "end", F.explode(F.filter(probes, lambda p: p.isNotNull())).alias("p")).select("key", "begin", "end", "p.*")
    return each.join(known, ["key", "kind", "a", "b"]).groupBy("key", "begin", "end").agg(F.min("first").alias("first"))
