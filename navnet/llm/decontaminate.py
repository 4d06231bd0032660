"""Benchmark decontamination with suffix arrays over the words of the training texts.

The tasks that read the documents make a shard of each batch: a suffix array over its words. Every suffix of every
benchmark item is looked up in every shard by binary search, all suffixes at once and a word further each time: the range
of training suffixes that agree so far narrows until it is empty. Where it was last not empty, the match is the longest
verbatim one; the range at a window's length is the list of all places where the window stands. Documents are whole in
their shard, so what is known of one needs no shuffle.

Words that no item has end every match, and so do runs of known words shorter than the shortest match asked for: what is
left of a shard are its longer runs of known words, with an end after each, and only these are sorted. That leaves out
no match. Suffixes are sorted by as many words as the longest item has, which is all that a lookup can tell apart.

The benchmark goes to the tasks in blocks of bounded size, one after another, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored
from .licenses import words

WIDTH, BLOCK_BYTES = 10, 4 << 20


@dataclass
class Probe:
    """A block of items. vocabulary: word to number from 1; text: the items' words, 0 after each item; and of every suffix
    its place in text, item, the words it has, the words of its window (0: none begins there)."""

    vocabulary: dict[bytes, int]
    names: list
    text: np.ndarray
    start: np.ndarray
    item: np.ndarray
    left: np.ndarray
    window: np.ndarray

    @property
    def least(self) -> int:
        return int(self.window[self.window > 0].min())


def probe(items: list[tuple[object, str | None]], width: int = WIDTH) -> Probe | None:
    """None if no item has a word."""
    own = [(name, w) for name, text in items if (w := words(text))]
    if not own:
        return None
    vocabulary: dict[bytes, int] = {}
    text, start, item, left, window = [], [], [], [], []
    for k, (_, w) in enumerate(own):
        begin, n, size = len(text), len(w), min(width, len(w))
        text += [*(vocabulary.setdefault(x, len(vocabulary) + 1) for x in w), 0]
        start += range(begin, begin + n)
        item += [k] * n
        left += range(n, 0, -1)
        window += [size if n - o >= size else 0 for o in range(n)]
    return Probe(vocabulary, [name for name, _ in own], *(np.array(x, np.int64) for x in (text, start, item, left, window)))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """The places of text in the order of what stands from there on, by the first `depth` numbers at least (doubling)."""
    rank, order, k = text.astype(np.int64), np.argsort(text, kind="stable"), 1
    while k < depth and len(text):
        follow = np.zeros_like(rank)
        follow[:-k] = rank[k:] + 1
        key = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        fresh = np.append(0, np.cumsum(np.diff(key[order]) != 0))
        rank = np.empty_like(rank)
        rank[order] = fresh
        if fresh[-1] == len(text) - 1:
            break
        k *= 2
    return order


@dataclass
class Shard:
    """The runs of known words of some documents: numbers of words (0 after each run), and of each its document and its
    word there; order: the suffix array."""

    text: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    order: np.ndarray
    sizes: np.ndarray  # words of each document


def shard(texts: list[str | None], p: Probe, least: int) -> Shard:
    ids, sizes, get = [], [], p.vocabulary.get
    for t in texts:
        own = words(t)
        sizes.append(len(own))
        ids.append(np.fromiter((get(w, 0) for w in own), np.int32, len(own)))
        ids.append(np.zeros(1, np.int32))
    number, sizes = np.concatenate(ids), np.array(sizes, np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], number > 0, [0]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= least
    begin, end = begin[long], end[long] + 1  # with the number 0 that ends the run
    count = end - begin
    at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
    first = np.cumsum(sizes + 1) - sizes - 1
    doc = np.searchsorted(first, at, side="right") - 1
    own = number[at]
    return Shard(own, doc, at - first[doc], suffix_array(own, int(p.left.max())), sizes)


def _bound(s: Shard, padded: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, number: np.ndarray) -> np.ndarray:
    """The first place in [low, high) of the suffix array whose suffix has `number` or more after depth words."""
    low, high = low.copy(), high.copy()
    while len(todo := np.flatnonzero(low < high)):
        middle = (low[todo] + high[todo]) >> 1
        less = padded[s.order[middle] + depth] < number[todo]
        low[todo[less]] = middle[less] + 1
        high[todo[~less]] = middle[~less]
    return low


def look_up(s: Shard, p: Probe) -> tuple[np.ndarray, ...]:
    """Of every suffix: longest match, its range of the suffix array, and the range of its window (empty: not found)."""
    n = len(p.start)
    longest, low, high = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, len(s.order), np.int64)
    window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    padded = np.append(s.text, np.zeros(int(p.left.max()) + 1, s.text.dtype))
    alive, depth = np.arange(n), 0
    while len(alive := alive[p.left[alive] > depth]):
        number = p.text[p.start[alive] + depth]
        a = _bound(s, padded, low[alive], high[alive], depth, number)
        b = _bound(s, padded, a, high[alive], depth, number + 1)
        alive, a, b = (x[a < b] for x in (alive, a, b))
        depth += 1
        low[alive], high[alive], longest[alive] = a, b, depth
        full = p.window[alive] == depth
        window_low[alive[full]], window_high[alive[full]] = a[full], b[full]
    return longest, low, high, window_low, window_high


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range that each is of."""
    count = high - low
    of = np.repeat(np.arange(len(low)), count)
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[of], of


def occurrences(s: Shard, p: Probe) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[int]]]:
    """By document: the stretches of its words (end exclusive) inside windows, and the items whose windows stand there."""
    if not len(s.text):
        return {}, {}
    *_, low, high = look_up(s, p)
    found = np.flatnonzero(high > low)
    places, own = _spread(low[found], high[found])
    # A range of the array is the same for items that share a window: its places count once for what is hit.
    ranges, which = np.unique(np.stack([low[found], high[found], p.window[found]]), axis=1, return_index=True)
    once, of = _spread(ranges[0], ranges[1])
    change = np.zeros(len(s.text) + 1, np.int64)
    np.add.at(change, s.order[once], 1)
    np.add.at(change, s.order[once] + ranges[2][of], -1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)))
    hits: dict[int, list[tuple[int, int]]] = {}
    for b, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        hits.setdefault(int(s.doc[b]), []).append((int(s.place[b]), int(s.place[b]) + e - b))
    pairs = np.unique(s.doc[s.order[places]] * len(p.names) + p.item[found][own])
    items: dict[int, set[int]] = {}
    for d, k in zip((pairs // len(p.names)).tolist(), (pairs % len(p.names)).tolist(), strict=True):
        items.setdefault(d, set()).add(k)
    return hits, items


def joined(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted([*a, *b]):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def _blocks(benchmark: DataFrame, width: int, block_bytes: int) -> Iterator[Probe]:
    """The benchmark's items in blocks of about block_bytes of text; only one is on the driver at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("name"), "text").where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = -(-total // block_bytes)
    for k in range(many):
        if p := probe(rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(many)) == k).collect(), width):
            yield p


HITS = "hits array<struct<first:int,last:int>>, items array<string>"


def found(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """_row (a struct of docs' columns but text, by number), text, n_words, hits (stretches of words inside windows, last
    exclusive), items (the texts of the item_ids with windows there, '' for an item without id) of every row of docs."""
    row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"])
    rows = docs.select(row.alias("_row"), "text")
    schema = f"_row {dict(rows.dtypes)['_row']}, text string, n_words bigint, {HITS}"

    def search(p: Probe | None):
        def run(batch: pa.RecordBatch) -> dict:
            texts, before = batch.column("text").to_pylist(), "hits" in batch.schema.names
            hits = [[(h["first"], h["last"]) for h in x] for x in batch.column("hits").to_pylist()] if before else [[] for _ in texts]
            items = [set(x) for x in batch.column("items").to_pylist()] if before else [set() for _ in texts]
            if p is None:
                sizes = [len(words(t)) for t in texts]
            else:
                own = shard(texts, p, p.least)
                sizes, (new, named) = own.sizes, occurrences(own, p)
                for d, x in new.items():
                    hits[d] = joined(hits[d], x)
                for d, x in named.items():
                    items[d].update(p.names[k] or "" for k in x)
            return {"_row": batch.column("_row"), "text": batch.column("text"), "n_words": sizes, "hits": [[{"first": a, "last": b} for a, b in x] for x in hits], "items": [sorted(x) for x in items]}

        return run

    out, blocks = None, _blocks(benchmark, width, block_bytes)
    for p in blocks:
        out = arrow_map(rows if out is None else stored(out, "contamination"), search(p), schema)
    return arrow_map(rows, search(None), schema) if out is None else out


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, hits, items, n_hit (words inside any window's occurrence) of every row of docs, whole texts.

    A window is `width` consecutive words of an item, or all of an item of fewer. Null and empty texts have no words and
    no hits, and as items no windows; repeated rows give repeated results, repeated items count once; an item without
    item_id hits, under the name ''; an empty benchmark hits nothing; an empty table of documents gives none."""
    out = found(docs.select("doc_id", "text"), benchmark, width, block_bytes)
    return out.select(F.col("_row")["c0"].alias("doc_id"), "n_words", "hits", "items", n_hit().alias("n_hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns whatever their names, in which no window of the benchmark stands."""
    clean = found(docs, benchmark, width, block_bytes).where(F.size("hits") == 0)
    return clean.select(*[(F.col("text") if c == "text" else F.col("_row")[f"c{i}"]).alias(c) for i, c in enumerate(docs.columns)])


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id (as text), first_word (a suffix of the item), n_words (its longest verbatim match in any document, of
    least words and more), doc_id, at (the document's word where it begins: of several the smallest doc_id, then place)."""
    kind = dict(docs.dtypes)["doc_id"]
    best = None

    def search(p: Probe):
        def run(batch: pa.RecordBatch) -> dict | None:
            own = shard(batch.column("text").to_pylist(), p, least)
            if not len(own.text):
                return None
            longest, low, high, *_ = look_up(own, p)
            hit = np.flatnonzero(longest >= least)
            places, of = _spread(low[hit], high[hit])
            ids = batch.column("doc_id").to_pylist()
            first: dict[int, tuple] = {}
            for k, at in zip(of.tolist(), own.order[places].tolist(), strict=True):
                i = ids[own.doc[at]]
                own_place = (i is None, i, int(own.place[at]))
                if k not in first or own_place < first[k]:
                    first[k] = own_place
            begin = {int(k): int(s) for s, k in zip(p.start[::-1], p.item[::-1], strict=True)}
            keys = [hit[k] for k in first]
            return {"item_id": [p.names[p.item[k]] for k in keys], "first_word": [int(p.start[k]) - begin[int(p.item[k])] for k in keys], "n_words": [int(longest[k]) for k in keys], "doc_id": [x[1] for x in first.values()], "at": [x[2] for x in first.values()]}

        return run

    for p in _blocks(benchmark, least, block_bytes):
        own = arrow_map(docs.select("doc_id", "text"), search(p), f"item_id string, first_word bigint, n_words bigint, doc_id {kind}, at bigint")
        best = own if best is None else best.union(own)
    if best is None:
        return docs.sparkSession.createDataFrame([], f"item_id string, first_word bigint, n_words bigint, doc_id {kind}, at bigint")
    place = F.struct((-F.col("n_words")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    top = best.groupBy("item_id", "first_word").agg(F.min(place).alias("m"))
    return top.select("item_id", "first_word", (-F.col("m.less")).alias("n_words"), "m.doc_id", "m.at")
