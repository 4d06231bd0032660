"""The leaderboard feed against a plain version that keeps every revenue and ranks all items each day."""

import random

import numpy as np
import pyarrow as pa
import pytest

from navnet.llm import leaderboard

LINE = "nation_id int, item_id bigint, event_day bigint, arrival_day bigint, cents bigint, batch int"


def plain_feed(lines, top=10, lateness=15):
    revenue, boards, out, seen = {}, {}, [], None
    for batch in sorted({x[5] for x in lines if x[5] is not None}):
        own = [x for x in lines if x[5] == batch and x[2] is not None and x[3] is not None]
        for day in sorted({x[3] for x in own}):
            kept = [x for x in own if x[3] == day and x[0] is not None and x[1] is not None and (seen is None or x[2] + lateness >= seen)]
            for nation, item, _, _, cents, _ in kept:
                mine = revenue.setdefault(nation, {})
                mine[item] = mine.get(item, 0) + (cents or 0)
            for nation in {x[0] for x in kept}:
                ranked = sorted((-r, i) for i, r in revenue[nation].items() if r > 0)[:top]
                now, was = {i: k for k, (_, i) in enumerate(ranked, 1)}, boards.get(nation, {})
                for i in now.keys() | was.keys():
                    if now.get(i) != was.get(i):
                        change = "enter" if i not in was else "exit" if i not in now else "move"
                        out.append((nation, day, i, batch, change, was.get(i), now.get(i), revenue[nation][i]))
                boards[nation] = now
        seen = max([*([] if seen is None else [seen]), *(x[2] for x in own)], default=seen)
    return sorted(out)


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(12)
    out = []
    for _ in range(3000):
        event = rng.randrange(100, 160)
        arrival = event + rng.randrange(6) + rng.choice([0, 0, 20])
        nation = rng.choice([None, 1, 2, 2, 2, 2, 3])
        out.append((nation, rng.choice([None, *range(40)]), event, arrival, rng.choice([None, 0, 5, 10, 10, 300, -200, -10, rng.randrange(500)]), 1 + (arrival - 100) // 20))
    return [*out, *out[:50], (1, 1, None, 120, 5, 1), (1, 1, 110, None, 5, 1), (1, 1, 110, 110, 5, None)]


def test_feed_matches_plain_version(spark, lines):
    df = spark.createDataFrame(lines, LINE).repartition(3).selectExpr("*", "1 as bucket", "2 as sums", "'x' as change")
    got = leaderboard.change_feed(df, buckets=4)
    assert ", ".join(f"{n} {k}" for n, k in got.dtypes) == leaderboard.FEED
    got, want = sorted(tuple(r) for r in got.collect()), plain_feed(lines)
    assert sorted(got, key=repr) == sorted(want, key=repr) and {x[4] for x in got} == {"enter", "exit", "move"}


def test_feed_of_no_lines(spark, lines):
    df = spark.createDataFrame(lines, LINE)
    assert leaderboard.change_feed(df.limit(0)).collect() == []
    assert leaderboard.change_feed(df.where("nation_id is null"), buckets=2).collect() == []


def test_best_is_exact_with_ties():
    rng = np.random.default_rng(1)
    for n in (0, 1, 9, 10, 11, 200):
        items, revenue = rng.permutation(n).astype(np.int64), rng.integers(-3, 6, n)
        assert items[leaderboard.best(items, revenue, 10)].tolist() == [i for _, i in sorted((-r, i) for r, i in zip(revenue.tolist(), items.tolist(), strict=True) if r > 0)[:10]]


def test_sale_batches(spark):
    import datetime
    import zlib

    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(n, 3600 * 5)
    sales = [(1, 1, 10, 7, 2, 1.005, 0.1, "kept", day(0)), (2, 1, 10, 7, 3, None, 0.1, "swapped", day(40)), (3, None, None, 7, 3, 2.0, 0.0, "kept", None), (4, 2, 11, 8, None, None, 0.0, None, day(148)), (5, 1, 12, 9, 1, 3.0, 0.0, "kept", day(9)), (6, 1, 10, None, 1, 3.0, 0.0, "kept", day(9))]
    df = spark.createDataFrame(sales, "sale_id bigint, line_no int, item_id bigint, vendor_id bigint, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz")
    vendors = spark.createDataFrame([(7, "a", 4, 0.0), (7, "a", 4, 0.0), (8, "b", None, 0.0), (9, "c", 5, 0.0)], "vendor_id bigint, name string, nation_id int, balance double")
    items = spark.createDataFrame([(10, 2.5), (10, 2.5), (11, None)], "item_id bigint, price double")
    got = sorted((tuple(r) for r in leaderboard.sale_batches(df, vendors, items).collect()), key=repr)
    want = []
    for sale, line, item, vendor, quantity, amount, _, flag, at in sales:
        h = zlib.crc32(",".join("" if x is None else str(x) for x in (sale, item, vendor, line)).encode())
        s = 19723 + (h % 150 if at is None else (at - datetime.datetime(2024, 1, 1)).days)
        a = s + h % 7 + (20 if h % 5 == 0 else 0)
        cents = int(np.floor(100 * amount + 0.5)) if amount is not None else quantity * 250 if quantity and item == 10 else 0
        want.append(({7: 4, 9: 5}.get(vendor), item if item in (10, 11) else None, s, a, -cents if flag == "swapped" else cents, min(8, 1 + (a - 19723) * 8 // 180)))
    assert got == sorted(want, key=repr)


def test_packets_give_the_workers_memory_back(monkeypatch):
    freed = []
    monkeypatch.setattr(leaderboard, "release", lambda: freed.append(1), raising=False)
    line = pa.RecordBatch.from_pydict({"nation_id": pa.array([1], pa.int32()), "bucket": pa.array([0], pa.int32()), "arrival_day": [3], "item_id": [4], "cents": [5]})
    assert sum(b.num_rows for b in leaderboard.packets(iter([line]))) == 1 and freed
