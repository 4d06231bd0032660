"""First touching ranges against all pairs: hot keys, long ranges, ties, many buckets."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from navnet.operators import intervals, relational


def plain(ranges, data):
    out = {}
    for k, b, e in set(ranges):
        hit = [o for kk, lo, hi, o in data if kk == k and not (e < lo or hi < b)]
        if hit:
            out[k, b, e] = min(hit)
    return out


@pytest.mark.parametrize("size", [4, 25, 4096])
def test_first_touching_matches_all_pairs(spark, size):
    rng = random.Random(size)
    value = lambda: rng.choice([0.0, 10.0, 50.0, float(rng.randrange(100)), rng.random() * 100])
    rows = lambda n: [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", *sorted((v := value(), rng.choice([v, v + rng.random() * 3, value()])))) for _ in range(n)]
    ranges, data = rows(700), [(*r, o) for o, r in enumerate(rows(600))]
    rng.shuffle(data)
    data = [(*r[:3], r[3] + 5000 if r[2] - r[1] > 20 else r[3]) for r in data]  # long ones seldom come first
    got = intervals.first_touching(spark.createDataFrame(ranges, "key string, begin double, end double"), spark.createDataFrame(data, "key string, begin double, end double, order bigint"), rows=size)
    assert {(r.key, r.begin, r.end): r["first"] for r in got.collect()} == plain(ranges, data)


def test_bounds_that_come_out_differently_each_time(spark, monkeypatch):
    """Partial quantiles that arrive in another order give other bounds: ranges and data have the same buckets all the same (F2)."""
    rng = random.Random(7)
    some = lambda n: [(f"k{rng.randrange(2)}", b, b + rng.random() * 5) for b in (rng.random() * 100 for _ in range(n))]
    ranges, data = some(900), [(*r, o) for o, r in enumerate(some(300))]

    @F.udf("array<double>")
    def shaken(q):
        noise = random.Random(time.time_ns())
        return sorted(v + noise.uniform(-8, 8) for v in q)

    plain_quantiles = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *a: shaken.asNondeterministic()(plain_quantiles(*a)))
    got = intervals.first_touching(spark.createDataFrame(ranges, "key string, begin double, end double"), spark.createDataFrame(data, "key string, begin double, end double, order bigint"), rows=40)
    assert {(r.key, r.begin, r.end): r["first"] for r in got.collect()} == plain(ranges, data)


def test_hot_key_is_dealt_over_buckets(spark):
    """A route of half of all rows: no bucket holds over twice the median's rows, and no pair is listed."""
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("key"), (F.rand(3) * 1000).alias("begin")).withColumn("end", F.col("begin") + 1)
    found = intervals.first_touching(df, df.withColumn("order", F.monotonically_increasing_id()), rows=512)
    assert found.count() == 20_000
    steps = [(k + 1) / 1024 for k in range(1023)]
    hot = df.where("key = 'hot'")
    bounds = sorted(set(hot.agg(F.percentile_approx("begin", steps, 4096)).first()[0]))
    many = -(-2 * 10_000 // 512)
    cuts = [bounds[i * 1024 // many - 1] for i in range(1, many)]
    sizes = np.histogram([r.begin for r in hot.collect()], [-1, *cuts, 1e9])[0]
    assert len(sizes) > 30 and sizes.max() <= 2 * np.median(sizes)


def test_nodes_make_up_their_buckets(spark):
    rng = random.Random(2)
    rows = [(a, b) for a, b in (sorted(rng.choice([0, 1, 7, 512, 1023, rng.randrange(1024)]) for _ in range(2)) for _ in range(300))]
    for r in spark.createDataFrame(rows, "a int, b int").select("a", "b", intervals._nodes(F.col("a"), F.col("b")).alias("n")).collect():
        covered = sorted(x for n in r.n for x in range((n << (10 - n.bit_length() + 1)) - 1024, ((n + 1) << (10 - n.bit_length() + 1)) - 1024))
        assert covered == list(range(r.a, r.b + 1)) and len(r.n) <= 20


def test_match_by_range_of_other_orders(spark):
    """An order of texts, rows of one order, a row of left that stands twice."""
    left = spark.createDataFrame([("a", "r", 0.0, 5.0), ("b", "r", 9.0, 6.0), ("b", "r", 1.0, 2.0), ("c", "s", 0.0, 1.0), ("d", None, 0.0, 1.0)], "id string, route string, b double, e double")
    data = spark.createDataFrame([("r", 5.0, 6.0, "n", 1), ("r", 0.0, 0.5, "m", 2), ("r", 8.0, 8.5, "a", 3), ("r", 100.0, 101.0, "a", 4), ("r", 0.0, 9.0, None, 5)], "route string, b double, e double, o string, v int")
    for pairs in (0, 1000):
        got = {r.id: r.x_v for r in relational.match_by_range(left, data, "route", "b", "e", "id", "o", ["v"], "x_", pairs).collect()}
        assert got == {"a": 2, "b": 3, "c": None}
