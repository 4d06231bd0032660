"""Best-fit packing by hierarchical residual packing.

Pieces of documents are packed in rounds. In a round every task packs its items best-fit, longest first; bins that are
nearly full are done, and the underfull ones go to the next round as items of their fill, dealt over fewer tasks (a tree
of merges), until one task has them all or a round merges next to nothing. A task never has more than TASK_ITEMS items.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored
from .tokens import KEPT, encoder, library_vocabulary

TASK_ITEMS = 200_000
#: Documents whose pieces are packed together first where their order counts; ranges of them that meet in a round.
WINDOW, FAN = 2_048, 32
_MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first (a tie: by number), each into the fullest bin that has room, else a new one."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free space, the bins
    free = 0  # bit k: some bin has k free
    for i in order:
        s = sizes[i]
        fits = free >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free &= ~(1 << r)
        else:
            r, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if r > s:
            room[r - s].append(b)
            free |= 1 << (r - s)
    return bins


def pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary: tuple | None = None, order: str | None = None, kept_words: int = KEPT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every whole text's ids and then end_id (null text: empty). A special token's
    string is its one id, as by the library's defaults. Documents over
    capacity are cut into pieces of capacity, of which the first may be shorter. Repeated rows give repeated pieces.
    order: a column of docs that the pieces keep, as the column at. kept_words: words whose ids a Python worker keeps."""
    vocabulary = vocabulary or library_vocabulary()
    end = end_id.to_bytes(4, "little")
    kept = order is not None

    def run(batch: pa.RecordBatch) -> dict:
        encode = encoder(*vocabulary, most=kept_words).encode
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        counts = []
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = encode(text or "") + end
            n = len(ids) // 4
            starts = [0, *range(n % capacity or capacity, n, capacity)]
            for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                for name, v in zip(out, (i, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                    out[name].append(v)
            counts.append(len(starts))
        return out | ({"at": np.repeat(batch.column("at").to_numpy(), counts)} if kept else {})

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", at bigint" if kept else "")
    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *([F.col(order).cast("bigint").alias("at")] if kept else [])), run, schema)


def _merged(table: pa.Table, capacity: int, slack: int) -> tuple[list[bool], pa.Array, pa.ListArray, list[list[int]]]:
    """Items of fill and members packed best-fit: whether each bin is nearly full, its fill, its members, its items' places."""
    fills, members = table.column("fill").to_pylist(), table.column("members").combine_chunks()
    bins = best_fit(fills, capacity)
    total = [sum(fills[i] for i in b) for b in bins]
    taken = members.take(pa.array([i for b in bins for i in b], pa.int64()))
    ends, at = [0], 0
    lengths = pc.list_value_length(taken).to_pylist()
    for b in bins:
        n = at + len(b)
        ends.append(ends[-1] + sum(lengths[at:n]))
        at = n
    joined = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), taken.flatten())
    return [t >= capacity - slack for t in total], pa.array(total, pa.int64()), joined, bins


def best_pair(left: list[tuple[int, int]], right: list[tuple[int, int]], capacity: int) -> tuple[int, int] | None:
    """Of residuals (fill, number) on two sides, the numbers of the pair that fills a sequence best; None if none fits."""
    right = sorted(right)
    fits = [(fill + right[k - 1][0], i, right[k - 1][1]) for fill, i in left if (k := bisect.bisect_right(right, (capacity - fill, float("inf"))))]
    return max(fits)[1:] if fits else None


def pack(items: DataFrame, capacity: int = 1024, slack: int = 4, task_items: int = TASK_ITEMS) -> DataFrame:
    """The rows of items (columns of pieces()), each with sequence_id and offset: sequences hold at most capacity tokens,
    without gaps. slack: free tokens of a bin that counts as nearly full. An empty table gives an empty result."""
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    own = stored(items.select(F.col("length").alias("fill"), F.array(member).alias("members")), "packing-items")
    done, level = [own.where(F.col("fill") >= capacity)], own.where(F.col("fill") < capacity)
    left = level.count()
    schema = f"done boolean, fill bigint, members array<{_MEMBER}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if whole is None:
            return
        full, fills, joined, _ = _merged(whole, capacity, slack)
        yield pa.RecordBatch.from_arrays([pa.array(full), fills, joined], names=["done", "fill", "members"])

    while left:
        tasks = max(1, -(-left // task_items))
        packed = stored(level.repartition(tasks).mapInArrow(run, schema), "packing-round")
        done.append(packed.where("done").drop("done"))
        level = packed.where(~F.col("done")).drop("done")
        before, left = left, level.count()
        if tasks == 1 or left > 0.95 * before:
            done.append(level)
            break
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    bins = bins.select(F.monotonically_increasing_id().alias("sequence_id"), _with_offsets("members").alias("members"))
    bins = bins.select("sequence_id", F.explode("members").alias("m"))  # numbered before, not after
    return bins.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")


def _with_offsets(name: str):
    """The members of a bin, each with the sum of the lengths before it."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>>)").alias("out"))
    step = lambda acc, m: F.struct((acc["at"] + m["length"]).alias("at"), F.concat(acc["out"], F.array(F.struct(m["doc_id"].alias("doc_id"), m["piece"].alias("piece"), m["start"].alias("start"), m["length"].alias("length"), m["ids_crc32"].alias("ids_crc32"), acc["at"].alias("offset")))).alias("out"))
    return F.aggregate(name, start, step, lambda acc: acc["out"])


def pack_in_order(items: DataFrame, capacity: int = 1024, window: int = WINDOW, *, slack: int = 4, fan: int = FAN) -> DataFrame:
    """The rows of items (columns of pieces(), with at: the documents' places from 0), each with sequence_id and offset.

    Hierarchical residual packing along the places. The pieces of `window` consecutive places are packed best-fit; bins that
    are nearly full (slack) are done, the underfull ones are residuals. In a round of the tree `fan` neighbouring ranges
    meet: where two of them touch, the two residuals of the windows there that fill a sequence best become one, which lies
    between the windows' own; residuals at a range's ends go on to the next round, until one range is left. Sequences are
    numbered by window, in a window by the first of their members, so the documents come in the order of their places, to
    within a window, however many there are. An empty table gives an empty result."""
    fields = "part bigint, sequence_id bigint, fill bigint, members array<{}>".format(_MEMBER)

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("at", "piece", "doc_id")])
        part = table.column("part")[0].as_py()
        full, fills, members, bins = _merged(table, capacity, slack)
        number = np.empty(len(bins), np.int64)
        number[sorted(range(len(bins)), key=lambda k: min(bins[k]))] = (part << 33) + 1 + np.arange(len(bins))
        return pa.table([pa.array(full), pa.array([part] * len(bins), pa.int64()), pa.array(number), fills, members], names=["done", "part", "sequence_id", "fill", "members"])

    def meet(size: int):
        def run(table: pa.Table) -> pa.Table:
            rows = table.select(["part", "sequence_id", "fill", "members"]).to_pylist()
            own: dict[int, list[int]] = {}
            for i, r in enumerate(rows):
                own.setdefault(r["part"], []).append(i)
            out, ends = [], (0, size * fan - 1)
            for b in sorted(own):
                if b % size == 0 and b % (size * fan) and (pair := best_pair(*([(rows[i]["fill"], i) for i in own.get(k, [])] for k in (b - 1, b)), capacity)):
                    left, right = (rows[i] for i in pair)
                    out.append({"done": True, "part": b, "sequence_id": b << 33, "fill": left["fill"] + right["fill"], "members": left["members"] + right["members"]})
                    for k, i in zip((b - 1, b), pair, strict=True):
                        own[k].remove(i)
            out += [{"done": k % (size * fan) not in ends} | rows[i] for k, left in own.items() for i in left]
            return pa.Table.from_pylist(out, pa.schema([("done", pa.bool_()), *[table.schema.field(c) for c in ("part", "sequence_id", "fill", "members")]]))

        return run

    member = F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32"))
    own = items.select(F.expr(f"at div {window}").alias("part"), "at", "piece", "doc_id", F.col("length").alias("fill"), member.alias("members"))
    packed, done, size = stored(own.groupBy("part").applyInArrow(fit, "done boolean, " + fields), "packing-round"), [], 1
    while True:
        done.append(packed.where("done").drop("done"))
        level = packed.where(~F.col("done")).drop("done")
        parts = level.agg(F.countDistinct(F.expr(f"part div {size}"))).first()[0]
        if parts <= 1:
            done.append(level)
            break
        packed = stored(level.groupBy(F.expr(f"part div {size * fan}")).applyInArrow(meet(size), "done boolean, " + fields), "packing-round")
        size *= fan
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    bins = bins.select("sequence_id", F.explode(_with_offsets("members")).alias("m"))
    return bins.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")
