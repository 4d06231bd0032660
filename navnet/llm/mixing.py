"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

The rows of each source are dealt into blocks. A source of `units` whole units gets, in virtual time v, units * v blocks
until it has no more; t(v), the sum over the sources, is the slot that this ideal schedule has reached. Block j (from 1) of
a source may not stand before slot floor(t((j - 1) / units)), its release, and must stand before slot ceil(t(j / units)),
its deadline. Earliest deadline first among the released blocks meets all of these, so in every prefix each source is less
than one block from its share, also while sources run out.

At whole v no block is half done, so the cycles [v, v + 1) are scheduled by themselves. All cycles in which the same sources
have a whole share are alike; a source's last, partial share is in a cycle of its kind. A run of like cycles is a phase, of
which there are at most two for each source and one more, and one cycle of each is all that is computed: a bounded fold.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections import defaultdict
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sources (counted first) that one task folds over; the schedule, which is broadcast to the rows, has at most a row for
#: each slot of a cycle and phase: both bounded by this, not by the input. With more, the schedule is a table of all
#: blocks, joined by a shuffle, and each phase's cycle is made in a task of its own.
MAX_SOURCES = 256


def _key(column: str) -> Column:
    """A null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), column), F.lit(""))


def ranked(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """_row (a struct of keep, by number), src, rank: the place from 0 of each row in its source, by md5(doc_id); rows that share
    a doc_id follow each other by a hash of all columns. A source is ranked in 256 parts by the hash's first byte, and a
    part's offset is the count of those before it: no task has a whole source."""
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    plain = [F.to_json(F.struct(F.col(f"`{c}`"))) if k.startswith(("map", "struct", "array")) else F.col(f"`{c}`") for c, k in docs.dtypes]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    rows = docs.select(row.alias("_row"), _key("source").alias("src"), h.alias("h"), F.xxhash64(*plain).alias("tie")).withColumn("part", F.substring("h", 1, 2))
    before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("src", "part").count().select("src", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("src", "part").orderBy("h", "tie"))
    return rows.withColumn("own", own).join(offsets, ["src", "part"]).withColumn("rank", F.col("offset") + F.col("own") - 1).drop("own", "offset", "part", "h", "tie")


def period(sources: Column) -> Column:
    """The source (index into sources, an array of structs with the whole numbers units and share, the blocks that it has in
    the cycle) of each slot of one cycle."""
    reached = "aggregate(s, 0L, (x, o) -> x + least(o.units * {}, o.share * e.units))"
    return F.expr(
        f"""transform(transform(array({{s}}), s -> named_struct('s', s, 'n', cast(aggregate(s, 0, (x, e) -> x + e.share) as int),
              'release', transform(s, e -> transform(sequence(0, e.share - 1), d -> {reached.format("d")} div e.units)),
              'deadline', transform(s, e -> transform(sequence(0, e.share - 1), d -> -((-{reached.format("(d + 1)")}) div e.units - if((-{reached.format("(d + 1)")}) % e.units <> 0, 1, 0)))))),
          w -> aggregate(
            sequence(0, w.n - 1),
            named_struct('done', transform(w.s, e -> 0), 'out', cast(array() as array<int>)),
            (acc, t) -> transform(array(array_min(transform(
                filter(sequence(0, size(w.s) - 1), i -> acc.done[i] < w.s[i].share and w.release[i][acc.done[i]] <= t),
                i -> named_struct('deadline', w.deadline[i][acc.done[i]], 'i', i))).i),
                pick -> named_struct('done', transform(acc.done, (d, k) -> d + if(k = pick, 1, 0)), 'out', array_append(acc.out, pick)))[0],
            acc -> acc.out))[0]""".replace("{s}", sources)
    )


def earliest_deadlines(units: list[int], share: list[int]) -> list[int]:
    """period() by a heap: the source (index into units and share) of each slot of one cycle."""
    # t(d / units[i]) * units[i] for all d, by sources in order of when they run out
    order = sorted(range(len(units)), key=lambda k: Fraction(share[k], units[k]))
    ends = [Fraction(share[k], units[k]) for k in order]
    gone, left = [0], [sum(units)]
    for k in order:
        gone.append(gone[-1] + share[k])
        left.append(left[-1] - units[k])

    def reached(d: int, u: int) -> Fraction:
        at = bisect_right(ends, Fraction(d, u))
        return gone[at] + left[at] * Fraction(d, u)

    n, done, out = sum(share), [0] * len(units), []
    ready: list[tuple[int, int]] = []
    released = defaultdict(list, {0: [i for i in range(len(units)) if share[i]]})
    for t in range(n):
        for i in released.pop(t, ()):
            heapq.heappush(ready, (math.ceil(reached(done[i] + 1, units[i])), i))
        i = heapq.heappop(ready)[1]
        out.append(i)
        done[i] += 1
        if done[i] < share[i]:
            released[max(t + 1, math.floor(reached(done[i], units[i])))].append(i)
    return out


def _phases(own: DataFrame) -> DataFrame:
    """first, last of the runs of like cycles [first, last): a row for each phase, at most twice the sources and one."""
    ends = own.select(F.explode(F.expr("if(rest > 0, array(0L, cycles, cycles + 1), array(0L, cycles))")).alias("first")).distinct()
    # two rows for a source at most: the neighbours are taken over these alone
    return ends.withColumn("last", F.lead("first").over(Window.partitionBy(F.lit(0)).orderBy("first"))).where(F.col("last").isNotNull())


#: The blocks of a source in a cycle of a phase.
_SHARE = "cast(if(cycles > first, units, if(cycles = first, rest, 0)) as int)"


def _scheduled(own: DataFrame) -> DataFrame:
    """src, block, slot of every block, by the rules of _placed(), for any number of sources (own: src, units, cycles,
    rest). The phases are at most as many as the root of the blocks in order, and their slots in all as the blocks."""
    earlier = Window.partitionBy(F.lit(0)).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    active = own.join(F.broadcast(_phases(own)), F.expr("cycles > first or (cycles = first and rest > 0)")).select("first", "last", "src", F.col("units").cast("bigint").alias("units"), F.expr(_SHARE).cast("bigint").alias("share"))
    lengths = active.groupBy("first", "last").agg(F.sum("share").alias("length"))
    lengths = lengths.withColumn("begin", F.coalesce(F.sum(F.expr("(last - first) * length")).over(earlier), F.lit(0)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("src")
        picks = earliest_deadlines(table.column("units").to_pylist(), table.column("share").to_pylist())
        count, k = [0] * table.num_rows, []
        for i in picks:
            k.append(count[i])
            count[i] += 1
        return table.take(pa.array(picks, pa.int64())).append_column("at", pa.array(range(len(picks)), pa.int64())).append_column("k", pa.array(k, pa.int64()))

    places = active.groupBy("first").applyInArrow(run, "first bigint, last bigint, src string, units bigint, share bigint, at bigint, k bigint")
    places = places.join(F.broadcast(lengths), ["first", "last"]).withColumn("c", F.explode(F.expr("sequence(0L, last - first - 1)")))
    return places.select("src", F.expr("(first + c) * units + k").alias("block"), F.expr("begin + c * length + at").alias("slot"))


def mix(docs: DataFrame, block_rows: int = 64, units: int = 200, weights: dict[str, int] | None = None, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """keep, and rank, block, slot, place: where each row stands in the mixture (slots of block_rows places; these four
    names win over columns of keep).

    weights: whole units of the sources; a source without one has 1. If None, a source has units in proportion to the
    square root of its rows, of `units` in all, and at least 1. Every row gets a place, repeated rows and those with null
    columns too. An empty table gives an empty result."""
    placed = _placed(docs, block_rows, units, weights, keep)
    added = ("rank", "block", "slot", "place")
    return placed.select(*[F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(keep) if c not in added], *added)


def _placed(docs: DataFrame, block_rows: int, units: int, weights: dict[str, int] | None, keep: tuple[str, ...]) -> DataFrame:
    docs_in = ranked(docs, keep)
    own = docs.groupBy(_key("source").alias("src")).count()
    if weights is None:
        root = F.sqrt("count")
        share = F.round(units * root / F.sum(root).over(Window.partitionBy(F.lit(0)))).cast("int")
        own = own.withColumn("units", F.greatest(F.lit(1), share))
    else:
        given = F.create_map(*[x for k, v in weights.items() for x in (F.lit("=" + k), F.lit(v))]) if weights else F.expr("cast(map() as map<string,int>)")
        own = own.withColumn("units", F.coalesce(F.try_element_at(given, F.col("src")), F.lit(1)).cast("int"))
    own = own.withColumn("blocks", F.ceil(F.col("count") / block_rows)).withColumn("cycles", F.expr("blocks div units")).withColumn("rest", (F.col("blocks") - F.col("cycles") * F.col("units")).cast("int"))
    place = F.expr(f"cast(rank % {block_rows} as int)").alias("place")
    if own.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        blocks = docs_in.withColumn("block", F.expr(f"rank div {block_rows}")).join(_scheduled(own), ["src", "block"])
        return blocks.select("_row", "rank", "block", "slot", place)
    one = own.groupBy().agg(F.sort_array(F.collect_list(F.struct("src", "units", "cycles", "rest"))).alias("all"))
    phases = _phases(own).join(F.broadcast(one)).withColumn("active", F.expr("filter(transform(all, e -> named_struct('src', e.src, 'units', e.units, 'share', cast(if(e.cycles > first, e.units, if(e.cycles = first, e.rest, 0)) as int))), e -> e.share > 0)"))
    phases = phases.select("first", "last", "active", F.expr("aggregate(active, 0, (x, e) -> x + e.share)").alias("length"))
    # One row for each phase: the running sum is over these alone.
    earlier = Window.partitionBy(F.lit(0)).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    phases = phases.withColumn("begin", F.coalesce(F.sum((F.col("last") - F.col("first")) * F.col("length")).over(earlier), F.lit(0)))
    places = phases.select("first", "active", F.posexplode(period("active")).alias("at", "i")).select("first", F.expr("active[i].src").alias("src"), "at")
    places = places.withColumn("k", F.row_number().over(Window.partitionBy("first", "src").orderBy("at")) - 1)
    by_source = phases.select("first", "last", "length", "begin", F.explode("active").alias("e")).groupBy(F.col("e.src").alias("src")).agg(F.collect_list(F.struct("first", "last", "length", "begin")).alias("phases"))
    sources = own.select("src", "units").join(by_source, "src")
    blocks = docs_in.withColumn("block", F.expr(f"rank div {block_rows}")).join(F.broadcast(sources), "src")
    blocks = blocks.withColumn("cycle", F.expr("block div units")).withColumn("k", F.expr("cast(block - cycle * units as int)"))
    blocks = blocks.withColumn("p", F.expr("filter(phases, p -> p.first <= cycle and cycle < p.last)[0]"))
    blocks = blocks.withColumn("first", F.expr("p.first")).join(F.broadcast(places), ["first", "src", "k"])
    slot = F.expr("p.begin + (cycle - p.first) * p.length + at")
    return blocks.select("_row", "rank", "block", slot.alias("slot"), place)


def in_order(docs: DataFrame, block_rows: int = 64, units: int = 200, weights: dict[str, int] | None = None) -> DataFrame:
    """docs, all rows and columns, sorted by their place in the mixture."""
    mixed = _placed(docs, block_rows, units, weights, tuple(docs.columns))
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(*[F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])
