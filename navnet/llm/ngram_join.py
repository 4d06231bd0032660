"""N-gram Jaccard join with token-combination prefixes.

A document's set is hashed from its whole text. Two sets of Jaccard 0.8 or more share, in any fixed order of the tokens,
at least k of their first |set| - ceil(0.8 |set|) + k tokens (the prefix, extended by k - 1). Tokens are ordered by their
frequency, rare first. Single rare tokens of the extended prefix (k = 2) are index keys; of frequent ones, pairs are: two
linked sets share a rare token there, or two frequent ones. What meets under a key is verified exactly.

1. Equal sets are one class. 2. A bounded-memory pass (`survivors`) finds the classes that can link at all: by the same
prefix argument with k in proportion to the set and tokens in order of their hashes, these share much of their prefix.
3. The index is built on the survivors. 4. Small keys give all their pairs. Under large keys (a group of near copies) a few
pivots outside the largest component are compared with the members, which leaves one component there for the most part;
then what is still outside the largest component is compared with all members. Both comparisons go by blocks (`_compared`):
no link between different components is missed, and a group's pairs are never rows. 5. Components of the verified links.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from .common import arrow_map, release, slices, settled, stored

FREQUENT, SMALL, PIVOTS, ROUNDS, LIST, BLOCK = 64, 16, 12, 1, 64, 400_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    """xxh64 of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORD = _Hashes()


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles (A-Z lower-cased); a shorter text is one shingle, none is empty."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64).view(np.int64)
    h = np.fromiter(map(_WORD.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out ^= out >> np.uint64(29)
        out = out * _MIX[k % len(_MIX)] + h[k : k + n]
    out ^= out >> np.uint64(32)
    return np.unique((out * _MIX[0]).view(np.int64))


def needed(n: int) -> int:
    """Tokens that a set of n shares at least with a linked one: ceil(0.8 n)."""
    return -(-8 * n // 10)


def text_key() -> Column:
    """Names the text of a row that has no doc_id to name it by; null in other rows."""
    return F.when(F.col("doc_id").isNull(), F.md5("text"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty), key (text_key()), and what survivors() counts: bucket lists
    of prefix tokens.

    Rows of two kinds: a row for each document (bucket null), and for each batch and bucket of hashes the tokens that
    stand in the batch's prefixes, with how often, and their document if that is once."""
    kind = dict(docs.dtypes)["doc_id"]
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b)):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            sets = [shingle_set(t) for t in texts]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            first = {k: i for i, k in reversed(list(enumerate(keys))) if k is not None}  # of equal sets in a batch, one
            chosen = sorted(first.values())
            # tokens in order of hash: the smallest 0.3 n + 1
            heads = [sets[i][: 3 * len(sets[i]) // 10 + 1] for i in chosen]
            token = np.concatenate([*heads, np.zeros(0, np.int64)])
            owner = np.repeat(np.arange(len(chosen)), [len(h) for h in heads])
            distinct, at, count = np.unique(token, return_inverse=True, return_counts=True)
            holder = np.full(len(distinct), -1, np.int64)
            holder[at] = owner
            shared = np.bincount(owner[count[at] > 1], minlength=len(chosen))  # known here already
            to = (distinct.view(np.uint64) * _MIX[2] >> np.uint64(40)).astype(np.int64) % parts
            lists = []
            for b in range(parts):
                own = to == b
                if own.any():
                    c, o = count[own], np.where(count[own] == 1, holder[own], 0)
                    lists.append((b, distinct[own].tobytes(), np.minimum(c, 2).astype(np.int8).tobytes(), o.astype(np.int32).tobytes()))
            known = dict(zip(chosen, shared.tolist(), strict=True))
            name = uuid.UUID(bytes=xxhash.xxh3_128_digest(b"".join(k or b"-" for k in keys) + repr(ids[:1] + ids[-1:]).encode())).hex
            n, m = len(ids), len(lists)
            number = {i: j for j, i in enumerate(chosen)}
            columns = [
                pa.array([*ids, *[None] * m], pa_id), pa.array([*(len(s) for s in sets), *[None] * m], pa.int64()), pa.array([*keys, *[None] * m], pa.binary()),
                pa.array([*(known.get(i, 0) for i in range(n)), *[None] * m], pa.int64()), pa.array([*batch.column("key").to_pylist(), *[None] * m], pa.string()), pa.array([name] * (n + m)), pa.array([*(number.get(i) for i in range(n)), *[None] * m], pa.int32()),
                pa.array([*[None] * n, *(x[0] for x in lists)], pa.int32()), *(pa.array([*[None] * n, *(x[k] for x in lists)], pa.binary()) for k in (1, 2, 3)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        release()

    schema = f"doc_id {kind}, n_shingles bigint, digest binary, known bigint, key string, batch string, number int, bucket int, tokens binary, counts binary, holders binary"
    names = [x.split()[0] for x in schema.split(", ")]
    pa_id = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return docs.select("doc_id", "text", text_key().alias("key")).mapInArrow(run, schema)


def survivors(rows: DataFrame) -> DataFrame:
    """digest, rep (smallest doc_id), key (the smallest of rows without one), may of the classes of equal sets that may link
    to another (may), and of those with more than one document. rows: stored digests()."""
    lists = rows.where(F.col("bucket").isNotNull()).select("bucket", "batch", "tokens", "counts", "holders")
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = T.StructType.fromDDL("batch string, hits binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tokens, counts, holders = [], [], [], []
        for b in batches:  # a token is in a batch's list once: however frequent it is, a bucket holds one for each batch
            names += b.column("batch").to_pylist()
            tokens += [np.frombuffer(x, np.int64) for x in b.column("tokens").to_pylist()]
            counts += [np.frombuffer(x, np.int8) for x in b.column("counts").to_pylist()]
            holders += [np.frombuffer(x, np.int32) for x in b.column("holders").to_pylist()]
        if not tokens:
            return
        where = np.repeat(np.arange(len(tokens), dtype=np.int32), [len(t) for t in tokens])
        token, count, holder = np.concatenate(tokens), np.concatenate(counts), np.concatenate(holders)
        order = np.argsort(token, kind="stable")
        same = token[order]
        edge = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
        total = np.add.reduceat(count[order].astype(np.int64), edge)
        many = np.repeat(total > 1, np.diff(np.r_[edge, len(same)]))
        hit = order[many & (count[order] == 1)]
        hit = hit[np.argsort(where[hit], kind="stable")]
        batch, first = np.unique(where[hit], return_index=True)
        groups = np.split(holder[hit], first[1:]) if len(batch) else []
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in batch], pa.string()), pa.array([g.tobytes() for g in groups], pa.binary())], names=["batch", "hits"])
        del where, token, count, holder, order, same, many, hit, groups, tokens, counts, holders
        release()

    def total(batch: pa.RecordBatch) -> dict:
        """Of each batch of documents, how many of a document's tokens the buckets have found elsewhere."""
        made: dict[str, list] = {"batch": [], "number": [], "more": []}
        for name, hits in zip(batch.column("batch").to_pylist(), batch.column("hits").to_pylist(), strict=True):
            number, n = np.unique(np.frombuffer(b"".join(hits), np.int32), return_counts=True)
            for key, v in zip(made, ([name] * len(n), number.tolist(), n.tolist()), strict=True):
                made[key] += v
        return made

    # a bucket's finds go back as one row for each batch; a batch holds at most its own prefix tokens
    found = lists.repartitionById(parts, F.col("bucket")).mapInArrow(run, out).groupBy("batch").agg(F.collect_list("hits").alias("hits"))
    more = arrow_map(found, total, "batch string, number int, more bigint").groupBy("batch", "number").agg(F.sum("more").alias("more"))
    sets = rows.where(F.col("digest").isNotNull())
    judged = sets.where(F.col("number").isNotNull()).join(more, ["batch", "number"], "left")
    # shared prefix tokens of x: 0.1 of the smaller set, which has 0.8 of x's at least
    may = judged.where(100 * (F.col("known") + F.coalesce("more", F.lit(0))) >= 8 * F.col("n_shingles")).select("digest").distinct()
    classes = sets.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("key").alias("key"), F.count(F.lit(1)).alias("size"))
    marked = classes.join(may.withColumn("may", F.lit(True)), "digest", "left").withColumn("may", F.coalesce("may", F.lit(False)))
    return marked.where("may or size > 1").select("digest", "rep", "key", "may")


def _keys(n: int, tokens: list[tuple[int, int]], heavy: int) -> list[tuple[int, int]]:
    """Index keys of one set from its extended prefix (frequency, token): (key, kind). Kind 0: a rare token or a pair of
    frequent ones. Over `heavy` frequent ones a set has its frequent tokens alone as keys of kind 2; the others have
    theirs as kind 1, which meets kind 2 only."""
    rare = [(t, 0) for f, t in tokens if f <= FREQUENT]
    often = np.array(sorted(t for f, t in tokens if f > FREQUENT), np.int64)
    if len(often) > heavy:
        return rare + [(int(t), 2) for t in often]
    u = often.view(np.uint64)
    i, j = np.triu_indices(len(often), 1)
    pairs = ((u[i] * _MIX[0] ^ u[j] * _MIX[1]) * _MIX[3]).view(np.int64) if len(i) else np.zeros(0, np.int64)
    return rare + [(int(p), 0) for p in pairs] + [(int(t), 1) for t in often]


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b that link: 100 * intersection >= 80 * union."""
    one, other = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(one, "a").join(other, "b").withColumn("i", F.size(F.array_intersect("ta", "tb")))
    return both.where(100 * F.col("i") >= 80 * (F.size("ta") + F.size("tb") - F.col("i"))).select("a", "b")


def link_classes(sets: DataFrame, heavy: int = 16) -> DataFrame:
    """id, component of every set (id, n, tokens) that links to another; components by smallest id."""
    spark = sets.sparkSession
    tokens = sets.select("id", "n", F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").count().where(F.col("count") > 1)
    ranked = tokens.join(often, "token").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct(F.col("count").alias("f"), "token"))).alias("t"))
    # Tokens of no other set come first: the extended prefix holds as many of the others as these leave room for.
    room = F.expr("cast(n - ceil(8 * n / 10.0) + 2 - (n - size(t)) as int)")
    ranked = ranked.withColumn("room", room).where("room > 0").withColumn("t", F.expr("slice(t, 1, room)"))

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"key": [], "kind": [], "id": [], "n": []}
        for i, n, t in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "t")), strict=True):
            for key, kind in _keys(n, [(x["f"], x["token"]) for x in t], heavy):
                for name, v in zip(out, (key, kind, i, n), strict=True):
                    out[name].append(v)
        return out

    index = arrow_map(ranked.select("id", "n", "t"), run, "key bigint, kind int, id bigint, n bigint")
    # Frequent tokens alone (kinds 1 and 2) matter only where a set of kind 2 has them.
    wide = index.groupBy("key", F.col("kind") > 0).agg(F.count(F.lit(1)).alias("size"), F.max("kind").alias("top")).withColumnRenamed("(kind > 0)", "alone")
    wide = wide.where((F.col("size") > 1) & (~F.col("alone") | (F.col("top") == 2))).select("key", "alone", "size")
    index = stored(index.withColumn("alone", F.col("kind") > 0).join(wide, ["key", "alone"]), "ngram-index")
    small, large = index.where(F.col("size") <= SMALL), index.where(F.col("size") > SMALL)
    alone = lambda df: df.withColumn("component", F.col("id"))
    links = stored(_verified(_met(alone(small), alone(small)), sets), "ngram-links")
    if not large.limit(1).count():
        return components(links, "a", "b").select(F.col("node").alias("id"), "component")
    for k in range(ROUNDS + 1):
        labels = components(links, "a", "b").select(F.col("node").alias("id"), "component")
        own = large.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        sizes = own.groupBy("key", "alone", "component").count()
        most = sizes.groupBy("key", "alone").agg(F.max_by("component", F.struct("count", "component")).alias("most"), F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > 1)
        own = stored(own.join(most, ["key", "alone"]), "ngram-open")
        if not own.limit(1).count():
            return labels
        minor = own.where(F.col("component") != F.col("most"))
        if k < ROUNDS:  # the pivots of a key are its members outside the largest component with the smallest hashes
            turn = Window.partitionBy("key", "alone").orderBy(F.xxhash64("id", F.lit(k)), "id")
            minor = minor.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= PIVOTS)
        links = stored(links.union(_compared(minor, own, sets)), "ngram-links")
    return components(links, "a", "b").select(F.col("node").alias("id"), "component")


def _compared(few: DataFrame, many: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links between sets of `few` and of `many` that meet under a key, as far as they join components. Pairs are never
    rows: the few are dealt into blocks, of about BLOCK tokens, by the smallest hash of their keys, which like sets share;
    a set of many visits each block that its keys lead to, once, and is counted against the block's token index there. A
    task keeps only links between what its links haven't joined yet, so its output is smaller than its input."""
    home = few.groupBy("id").agg(F.min(F.xxhash64("key", "alone")).alias("home"), F.first("n").alias("n"), F.first("component").alias("component"))
    parts = home.groupBy("home").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"))
    home = home.join(parts, "home").select("id", "component", F.xxhash64("home", F.pmod(F.xxhash64("id", F.lit(3)), "parts")).alias("block"))
    home = stored(home, "ngram-blocks")
    # under a frequent token alone, sets of kind 1 meet those of kind 2 only
    led = few.join(home.select("id", "block"), "id").groupBy("key", "alone").agg(F.collect_set("block").alias("blocks"), F.collect_set(F.when(F.col("kind") == 2, F.col("block"))).alias("wide"))
    to = many.join(led, ["key", "alone"]).select("id", "component", F.expr("if(kind = 1, wide, blocks)").alias("blocks"))
    visits = to.groupBy("id").agg(F.first("component").alias("component"), F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks")).select("id", "component", F.explode("blocks").alias("block"))
    guests = visits.join(sets.select("id", "n", "tokens"), "id")
    loads = visits.join(sets.select("id", "n"), "id").groupBy("block").agg(F.ceil(F.sum("n") / (4 * BLOCK)).cast("int").alias("shares"))
    guests = guests.join(loads, "block").select("block", F.expr("cast(pmod(xxhash64(id, 5), shares) as int)").alias("share"), F.lit(False).alias("host"), "id", "component", "n", "tokens")
    hosts = home.join(sets.select("id", "n", "tokens"), "id").join(loads, "block")
    hosts = hosts.select("block", F.explode(F.expr("sequence(0, shares - 1)")).alias("share"), F.lit(True).alias("host"), "id", "component", "n", "tokens")

    def run(table: pa.Table) -> pa.Table:
        host = table.column("host").to_numpy()
        ids, n, component = (table.column(c).to_numpy() for c in ("id", "n", "component"))
        tokens = table.column("tokens").combine_chunks()
        flat, edge = tokens.flatten().to_numpy(), np.r_[0, np.cumsum(n)]
        names, label = np.unique(component, return_inverse=True)  # components that links here join get one label
        own = np.flatnonzero(host)
        token = np.concatenate([flat[edge[i] : edge[i + 1]] for i in own])
        owner = np.repeat(np.arange(len(own)), n[own])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        a: list[int] = []
        b: list[int] = []
        for i in np.flatnonzero(~host):
            t = flat[edge[i] : edge[i + 1]]
            lo, hi = np.searchsorted(token, t), np.searchsorted(token, t, "right")
            many = hi - lo
            at = np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            both = np.bincount(owner[at], minlength=len(own))
            linked = np.flatnonzero((100 * both >= 80 * (n[i] + n[own] - both)) & (ids[own] != ids[i]))
            for j in own[linked]:
                if label[j] != label[i]:
                    a.append(min(ids[i], ids[j]))
                    b.append(max(ids[i], ids[j]))
                    label[label == label[j]] = label[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return hosts.unionByName(guests).groupBy("block", "share").applyInArrow(run, "a bigint, b bigint")


def _met(few: DataFrame, many: DataFrame) -> DataFrame:
    """a, b of the pairs of different components that meet under a key, one of them from `few`, and may link by their
    sizes. A key's few go to its many as lists of about LIST, and a set's partners under all its keys are made distinct
    before they are rows: a pair that meets under many keys is one row."""
    lists = few.join(few.groupBy("key", "alone").count(), ["key", "alone"]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.ceil(F.col("count") / LIST)))
    lists = lists.groupBy("key", "alone", "part").agg(F.collect_list(F.struct("id", "n", "kind", "component")).alias("few"))
    fits = F.expr("filter(few, p -> p.id <> id and p.component <> component and (p.kind <> 1 or kind <> 1) and 100 * least(p.n, n) >= 80 * greatest(p.n, n))")
    met = many.join(lists, ["key", "alone"]).select("id", F.transform(fits, lambda p: p["id"]).alias("others")).where(F.size("others") > 0)
    pairs = met.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others")).select("id", F.explode("others").alias("other"))
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _found(docs: DataFrame) -> DataFrame:
    """near_duplicates(), and the key of rows without doc_id."""
    rows = stored(digests(docs), "ngram-sets")
    alive = stored(survivors(rows), "ngram-classes")
    ids = alive.where(F.col("may") & F.col("rep").isNotNull()).select(F.col("rep").alias("doc_id"), F.col("digest").alias("wanted"))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"digest": [], "n": [], "tokens": []}
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            s = shingle_set(text)
            if xxhash.xxh3_128_digest(s.tobytes()) == wanted:  # rows may share a doc_id
                for name, v in zip(out, (wanted, len(s), s.tolist()), strict=True):
                    out[name].append(v)
        return out

    # Few rows survive; their ids are broadcast only if there are at most a million, else both sides are shuffled.
    few = ids.count() <= 1_000_000
    texts = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id").select("text", "wanted")
    # Classes of rows without doc_id alone: their texts by key.
    keys = alive.where(F.col("may") & F.col("rep").isNull()).select("key", F.col("digest").alias("wanted"))
    if n := keys.count():
        nameless = docs.where(F.col("doc_id").isNull()).select("text", text_key().alias("key"))
        texts = texts.union(nameless.join(F.broadcast(keys) if n <= 1_000_000 else keys, "key").select("text", "wanted"))
    sets = arrow_map(texts, run, "digest binary, n bigint, tokens array<bigint>").dropDuplicates(["digest"])
    sets = stored(sets.select(F.xxhash64("digest").alias("id"), "digest", "n", "tokens"), "ngram-tokens")
    found = link_classes(sets)
    named = sets.select("id", "digest").join(found, "id").join(alive.select("digest", "rep"), "digest")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    linked = named.join(least, "component").select("digest", "component_id")
    classes = alive.join(linked, "digest", "left").select("digest", F.coalesce("component_id", "rep").alias("component_id"))
    own = rows.where(F.col("bucket").isNull()).select("doc_id", "n_shingles", "digest", "key")
    out = own.join(classes, "digest", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").cast(kind).alias("component_id"), "key")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs, whole texts.

    component_id: the smallest doc_id reachable by links, itself included. A text that is null, empty or without words
    has an empty set, links with nothing and is its own component; so is a row without doc_id where nothing it reaches
    has one (null). Rows with equal doc_id are documents of their own that share it. An empty table gives none."""
    return _found(docs).drop("key")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs, all columns, without the documents that link, directly or not, to one with a smaller doc_id. Of rows that
    share doc_id and text one stays. Rows without doc_id go if they link to one that has one, else stay, once for each text."""
    found = settled(docs.sparkSession, lambda: _found(docs).select("doc_id", "component_id", "key"), "ngram-found")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    few = gone.count() <= 1_000_000  # ids; else both sides are shuffled
    again = found.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id")
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti")
    if not again.limit(1).count():
        return left
    lost = found.where("doc_id is null and component_id is not null").select("key").distinct()
    nameless = left.where(F.col("doc_id").isNull())
    nameless = nameless.withColumn("_key", text_key()).join(lost, F.col("_key") == lost["key"], "left_anti").select(*docs.columns)
    twice = nameless.unionByName(left.join(again, "doc_id", "left_semi").select(*docs.columns))
    return left.where(F.col("doc_id").isNotNull()).join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(twice.dropDuplicates(["doc_id", "text"]))
