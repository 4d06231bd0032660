"""Forms of the operators whose work grows with their rows, against the plain forms by brute force."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from navnet.functions import geometry as G
from navnet.operators import compare, spatial
from navnet.operators.components import components
from navnet.plans.catalogue import QUERIES, SQL


def _ranges(n, seed):
    rng = random.Random(seed)
    return [(i, f"0{rng.randrange(3)}", rng.randrange(9), rng.randrange(9)) for i in range(n)]


def test_route_counts_are_those_of_the_pairs(spark):
    left, right = (spark.createDataFrame(_ranges(60, s), "id long, code string, begin int, end int") for s in (1, 2))
    want = {tuple(r) for r in compare.code_matches(left, right).groupBy("code").agg(F.count_if("forward"), F.count_if("backward")).collect()}
    assert {tuple(r) for r in compare.route_counts(left, right).collect()} == want
    many = left.crossJoin(spark.range(2000).select(F.col("id").alias("copy"))).drop("copy")  # 24,000 rows of a code on each side
    assert {(r.code, r.forward) for r in compare.route_counts(many, many).collect()} == {(r.code, r.forward * 4_000_000) for r in compare.route_counts(left, left).collect()}


def test_overlaps_within_count_each_pair_once(spark):
    rows = [(i, f"k{c}", b, e) for i, c, b, e in _ranges(50, 3)] + [(7, "k00", 1, 2), (100, "alone", 1, 2), (None, "k00", 1, 2)]
    got = {r.key: (r.forward, r.backward, r.either) for r in compare.overlaps_within(spark.createDataFrame(rows, "id long, key string, begin int, end int")).collect()}
    want = {}
    for key in {r[1] for r in rows}:
        own = [(i, min(b, e), max(b, e)) for i, k, b, e in rows if k == key]
        longest, pairs = max(e for _, _, e in own), [(x, y) for x in own for y in own if x[0] is not None and y[0] is not None and x[0] < y[0]]
        tests = [(not (x[2] < y[1] or y[2] < x[1]), not (x[2] < longest - y[2] or longest - y[1] < x[1])) for x, y in pairs]
        if pairs:
            want[key] = (sum(f for f, _ in tests), sum(r for _, r in tests), sum(f or r for f, r in tests))
    assert got == want


def test_greedy_class_pairs_take_what_greedy_pairs_take(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), rng.randrange(8)) for i in range(300)]
    p = spark.createDataFrame(rows, "id long, part string, class int")
    near = [(part, a, b, 10.0 - abs(a - b), float(abs(a - b))) for part in "ab" for a in range(8) for b in range(8) if abs(a - b) <= 3]
    pairs = spark.createDataFrame(near, "part string, left_class int, right_class int, score double, distance double")
    a, b = p.where("id % 2 = 1"), p.where("id % 3 = 0 and id % 2 = 0")
    listed = pairs.join(a.select("part", F.col("class").alias("left_class"), F.col("id").alias("left")), ["part", "left_class"]).join(b.select("part", F.col("class").alias("right_class"), F.col("id").alias("right")), ["part", "right_class"])
    want = {tuple(r) for r in spatial.greedy_pairs(listed.select("left", "right", "score", "distance")).collect()}
    got = spatial.greedy_class_pairs(a, b, pairs)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 30


def test_lines_within_by_batches_of_pairs(spark):
    """Lines of several lengths, crossing, touching and degenerate: the kernel against the plain expression, over all pairs."""
    rng = random.Random(6)
    line = lambda: [(rng.uniform(-1, 1), rng.uniform(-1, 1)) for _ in range(rng.randrange(2, 7))]
    rows = [(i, line(), f"0{i % 3}", i % 20, i % 20 + 5) for i in range(60)] + [(60, [(0.0, 0.0), (0.0, 0.0)], "01", 3, 8), (61, [(0.0, 0.0), (1.0, 0.0)], "1", 3, 8)]
    own = spark.createDataFrame(rows, "id long, line array<struct<x:double,y:double>>, code string, begin long, end long")
    left, right = own.where("id % 2 = 0"), own.where("id % 2 = 1")
    plain = left.select(F.col("id").alias("a"), F.col("line").alias("p")).crossJoin(right.select(F.col("id").alias("b"), F.col("line").alias("q")))
    want = {(r.a, r.b): r.d for r in plain.select("a", "b", G.line_distance(F.col("p"), F.col("q")).alias("d")).where("d <= 0.1").collect()}
    near = compare.lines_within(left, right, 0.1, 0.3)
    got = [(r.left_id, r.right_id, r.distance) for r in near.collect()]
    assert len(got) == len(want) and {(a, b): d for a, b, d in got} == pytest.approx(want, abs=1e-12)
    both = {(r.left_id, r.right_id) for r in compare.combined_within(left, right, 0.1, 0.3).collect()}
    assert both == {(r.left_id, r.right_id) for r in compare.combined(near, compare.code_matches(left, right)).collect()} and both


@pytest.mark.parametrize("cell", [0.05, 5.0])
def test_lines_within_by_blocks_of_lines(spark, monkeypatch, cell):
    """Blocks of a few lines, short and long ones, of keys that may be null: every near pair once, none that isn't near (F4)."""
    for name, size in {"CELL_LINES": 10, "LEFT_LINES": 7, "RIGHT_LINES": 5, "LINE_PAIRS": 20}.items():
        monkeypatch.setattr(compare, name, size)
    rng = random.Random(8)

    def line(n):
        x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
        return [(x + rng.uniform(-0.2, 0.2), y + rng.uniform(-0.2, 0.2)) for _ in range(n)]

    rows = [(i, line(rng.choice([2, 3, 5, 8] if i < 120 else [2, 9, 30])), rng.choice(["a", "a", "b", None])) for i in range(160)]
    own = spark.createDataFrame(rows, "id long, line array<struct<x:double,y:double>>, code string")
    left, right = own.where("id % 2 = 0"), own.where("id % 2 = 1")
    plain = left.select(F.col("id").alias("a"), F.col("line").alias("p"), F.col("code").alias("c")).crossJoin(right.select(F.col("id").alias("b"), F.col("line").alias("q"), "code"))
    want = {(r.a, r.b): (r.d, r.same) for r in plain.select("a", "b", G.line_distance(F.col("p"), F.col("q")).alias("d"), (F.col("c") == F.col("code")).alias("same")).where("d <= 0.02").collect()}
    for on, pairs in (((), {k: d for k, (d, _) in want.items()}), (("code",), {k: d for k, (d, same) in want.items() if same})):
        got = [(r.left_id, r.right_id, r.distance) for r in compare.lines_within(left, right, 0.02, cell, on).collect()]
        assert len(got) == len(pairs) > 30 and {(a, b): d for a, b, d in got} == pytest.approx(pairs, abs=1e-12)
    assert compare.lines_within(left.limit(0), right, 0.02, cell).count() == 0


def test_components_of_chains_and_stars(spark):
    """A chain in the nodes' order goes by hashes, a star in one round; a self-loop is a part of its own."""
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)] + [("s0", f"t{i}") for i in range(20)] + [("u", "u"), ("v", None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {**{f"c{i:03}": "c000" for i in range(41)}, "s0": "s0", **{f"t{i}": "s0" for i in range(20)}, "u": "u"}


def test_first_last_endpoint_takes_the_first_row_of_equal_orders(spark, tmp_path):
    """Part keys of a million and more: line 1 of part 1,000,005 and line 2 of part 5 have one order (F7)."""
    rows = [(1, 1_000_005, 1), (1, 5, 2), (2, 5, 2), (2, 1_000_005, 1), (3, 9, 1), (1, 1, 1), (4, None, 1), (4, 3, 2), (1, 3, 3)]
    table = pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["l_orderkey", "l_partkey", "l_linenumber"])
    pq.write_table(table, f"{tmp_path}/lineitem.parquet")
    pq.write_table(pa.table({"o_orderkey": pa.array([1, 2, 3, 4], pa.int64())}), f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    want = sorted(con.sql(SQL["first_last_endpoint"]).fetchall())
    assert sorted(map(tuple, QUERIES["first_last_endpoint"](spark, str(tmp_path)).collect())) == want
    assert (2, 5, 5) in want


def test_splice_folds_batches_as_one_line_at_a_time(spark):
    """Segments and projections of odd sections in one pass over a batch, against a plain fold and geometry.project() (F17, F18)."""
    from navnet.functions import lines as L
    from navnet.operators import splice

    rng, eps = random.Random(11), splice.EPS
    some = lambda: rng.choice([None, 0.0, 10.0, 55.5, 99.999, 100.0, 130.0, rng.random() * 120])
    rows = [(i, rng.choice([100.0, 0.0005, 60.0]), [(some(), some(), rng.choice([None, "a", "b", "c"])) for _ in range(rng.randrange(7))] if i % 9 else None) for i in range(300)]

    def plain(length, cuts):
        at, source, out = 0.0, None, []
        for d, b, name in sorted(cuts or [], key=lambda c: tuple((v is not None, v or type(v)()) if v is not None else (False, 0) for v in c)):
            low, high = (None, None) if d is None or b is None else (d - b, d + b)
            split = max(at + eps, 0.0, *[v for v in (low,) if v is not None])
            split = max(at + eps, length - 2 * eps) if split >= length else split
            merge = max(split + eps, min(length, *[v for v in (high,) if v is not None]) if high is not None else length)
            merge = max(split + eps, length - eps) if merge >= length else merge
            if split > at + eps:
                out.append((at, split, source, name))
            at, source = merge, name
        return [*out, (at, length, source, None)] if at < length else out

    df = spark.createDataFrame(rows, "id long, length double, cuts array<struct<distance:double,buffer:double,id:string>>").repartition(3)
    got = {r.id: [tuple(s) for s in r.s] for r in df.select("id", splice.segments(F.col("length"), F.col("cuts")).alias("s")).collect()}
    assert got == {i: plain(n, c) for i, n, c in rows}

    p = lambda: (float(rng.randrange(6)), float(rng.randrange(6)))
    lines = [(i, [p() for _ in range(rng.randrange(2, 9))], [rng.choice([None, p()]) for _ in range(rng.randrange(5))]) for i in range(200)]
    P = "array<struct<x:double,y:double>>"
    df = spark.createDataFrame(lines, f"id long, line {P}, points {P}").repartition(3)
    want = F.transform("points", lambda q: F.when(q.isNotNull(), G.project(F.col("line"), q)))
    for r in df.select(L.projections("line", "points").alias("a"), want.alias("b")).collect():
        assert [v is None for v in r.a] == [v is None for v in r.b] and [v for v in r.a if v is not None] == pytest.approx([v for v in r.b if v is not None])


def test_parts_nearest_measures_each_point_to_all_other_lines(spark, monkeypatch):
    """By blocks of a few points and segments, against geometry.parts_distance() of all pairs (F8)."""
    monkeypatch.setattr(compare, "POINT_BLOCK", 20)
    monkeypatch.setattr(compare, "SEGMENT_BLOCK", 15)
    rng = random.Random(12)
    p = lambda: (rng.random(), rng.random())
    still = p()
    lines = spark.createDataFrame([(k // 3, [still, still] if k == 4 else [p() for _ in range(rng.randrange(2, 5))]) for k in range(18)], "whole long, line array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(i, *p(), i // 12) for i in range(80)], "id long, x double, y double, whole long")
    parts = lines.groupBy("whole").agg(F.collect_list("line").alias("parts")).withColumnRenamed("whole", "other")
    every = points.join(parts, F.col("whole") != F.col("other")).groupBy("id").agg(F.min(G.parts_distance(G.point(F.col("x"), F.col("y")), F.col("parts"))).alias("d"))
    got, want = dict(compare.parts_nearest(points, lines).collect()), dict(every.collect())
    assert got == pytest.approx(want, abs=1e-12) and min(got.values()) > 0
    assert compare.parts_nearest(points.where("whole = 0"), lines.where("whole = 0")).count() == 0


def test_chained_matches_are_made_in_all_partitions(spark):
    """Few pairs make many rows: they don't end in one task because they are few bytes (F11)."""
    left = spark.range(40).select("id", F.lit(1).alias("x"))
    pairs = left.select(F.col("id").alias("left_id")).crossJoin(spark.range(30).select(F.col("id").alias("right_id")))
    got = compare.chained(left, [("a", pairs), ("b", pairs.where("left_id < 20"))])
    assert got.count() == 20 * 900 + 20 * 30
    assert got.select(F.spark_partition_id()).distinct().count() > 4


def test_chained_matches_shuffle_no_pairs(spark):
    """The rows of chained(), also of left rows without a match or a place, and no join below a shuffle (F3)."""
    rng = random.Random(13)
    points = spark.createDataFrame([(i, rng.random(), rng.random() if i % 50 else None) for i in range(600)], "id long, x double, y double")
    left, one, two = (points.where(f"id % 3 = {k}") for k in range(3))
    steps = [("a", one, 0.05), ("b", two, 0.08)]
    want = compare.chained(left, [(name, spatial.within_distance(left, right, radius)) for name, right, radius in steps])
    got = compare.chained_within(left, steps)
    assert got.columns == want.columns
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(got) == rows(want) and got.where("a_right_id is null and b_right_id is null").count() > 0 and got.count() > 300

    def joined_before_shuffles(df):
        lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        return sum("Join" in b and depth(b) > depth(a) for i, a in enumerate(lines) if "Exchange" in a or "RepartitionByExpression" in a for b in lines[i + 1 : next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(a)), len(lines))])

    assert joined_before_shuffles(want) > 0 and joined_before_shuffles(got) == 0
