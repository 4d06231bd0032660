"""Operators over the whole corpus: joins, search, packing, order, mixing, language model, and the pipeline."""

import inspect
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from navnet.llm import common, hpylm, materialise, mixing, ngram_join, packing, tokens, topk
from navnet.llm.tokens import Encoder, library_vocabulary, public_vocabulary


def shingles(text):
    w = (text or "").encode().lower().split()
    return set() if not w else {tuple(w)} if len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:], strict=False))


def groups(rows):
    """doc_id, set size, component of each row by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()), key=repr)


# op3


def test_ngram_join_matches_all_pairs(docs, rows):
    assert joined(docs) == groups(rows)


def test_ngram_join_of_rows_without_id(spark):
    """A near copy without id, a bridge without id between two documents, and a pair of rows without id."""
    w = [f"w{i}" for i in range(200)]
    changed = lambda own, *at: " ".join("x" + v if i in at else v for i, v in enumerate(own))
    one, two, three = w, [f"b{v}" for v in w], [f"c{v}" for v in w]
    texts = [(1, " ".join(one)), (None, changed(one, 7)), (None, changed(one, 7)), (2, changed(two, 10, 60)), (None, " ".join(two)), (3, changed(two, 110, 160)), (None, " ".join(three)), (None, changed(three, 90)), (4, "another text that links with none of them"), (None, None)]
    rows = [(i, t, None, f"s{k}", None) for k, (i, t) in enumerate(texts)]
    want = groups(rows)
    assert {i: c for i, _, c in want if i} == {1: 1, 2: 2, 3: 2, 4: 4} and sum(c is not None for i, _, c in want if i is None) == 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    assert joined(df) == want
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(r.source for r in kept.collect()) == ["s0", "s3", "s6", "s7", "s8", "s9"]


def test_ngram_join_of_frequent_tokens(spark, monkeypatch):
    """Small bounds: every class of tokens, pairs of frequent ones, heavy sets, pivots and what they leave."""
    rng = random.Random(8)
    bases = [[f"w{rng.randrange(40)}" for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(240):
        own = list(bases[i % 4])
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(60)] = f"v{rng.randrange(30)}"
        rows.append((i, " ".join(own[rng.randrange(0, 6) :]), None, None, None))
    rows += [(300 + i, " ".join(f"t{rng.randrange(3)}" for _ in range(rng.randrange(1, 9))), None, None, None) for i in range(60)]
    monkeypatch.setattr(ngram_join, "FREQUENT", 6)
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    assert joined(df) == groups(rows)


def test_ngram_join_of_odd_tables(empty, clashing, rows):
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.near_duplicates(clashing).count() == len(rows)


def test_keys_cover_linked_sets():
    """Two sets that share two tokens of their prefixes share a key, whatever their classes."""
    rng = random.Random(9)
    for _ in range(300):
        tokens = [(rng.choice([2, 500]), t) for t in rng.sample(range(1000), 12)]
        a, b = rng.sample(tokens, rng.randrange(2, 12)), rng.sample(tokens, rng.randrange(2, 12))
        if len(set(a) & set(b)) < 2:
            continue
        ka, kb = (ngram_join._keys(50, x, heavy=4) for x in (a, b))
        assert any(p == q and (k > 0) == (m > 0) and not (k == 1 and m == 1) for p, k in ka for q, m in kb)


# op1


def brute_search(rows, queries, k):
    """queries: id to a Counter of terms."""
    everyone = [Counter(topk.terms(r[1])) for r in rows]
    n, size = len(everyone), sum(sum(c.values()) for c in everyone)
    df = Counter(t for c in everyone for t in c)
    out = []
    for q, asked in queries.items():
        best = {}
        for r, c in zip(rows, everyone, strict=True):
            score = 0
            for t, times in asked.items():
                if c[t]:
                    idf = math.log((n - df[t] + 0.5) / (df[t] + 0.5) + 1)
                    score += times * int(math.floor(idf * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / (size / n))) * 1e6 + 0.5))
            if score and r[0] is not None:
                best[r[0]] = max(best.get(r[0], 0), score)
        out += [(q, i, d, -s) for i, (s, d) in enumerate(sorted((-s, d) for d, s in best.items())[:k], 1)]
    return sorted(out)


def test_search_is_exact(docs, rows, monkeypatch):
    asked = {r[0]: Counter(topk.terms(r[1])) for r in rows if r[0] is not None and r[0] % 9 == 0 and topk.terms(r[1])}
    flat = [(q, bytearray(t), n) for q, own in asked.items() for t, n in own.items()]
    queries = docs.sparkSession.createDataFrame(flat, "query_id bigint, term binary, times int")
    monkeypatch.setattr(topk, "QUERIES", 5)  # several groups
    got = sorted(tuple(r) for r in topk.search(docs, queries, k=5).select("query_id", "rank", "doc_id", "score").collect())
    assert got == brute_search(rows, asked, 5)


def test_whole_texts_are_the_queries(docs, rows):
    asked = {r[0]: Counter(topk.terms(r[1])) for r in rows if r[0] is not None and r[0] % 20 == 0}
    got = topk.similar(docs, docs.where("doc_id % 20 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.doc_id, r.score) for r in got) == brute_search(rows, asked, 10)


def test_block_max_wand_skips_and_stays_exact(monkeypatch):
    """Random shards against all scores: every way of storing a list, repeated ids, thresholds, and postings left unread."""
    monkeypatch.setattr(topk, "BLOCK", 4)
    rng, opened, postings = random.Random(10), 0, 0
    for turn in range(60):
        monkeypatch.setattr(topk, "CELLS", rng.choice([0, 400, 10**6]))
        vocabulary = [f"w{i}" for i in range(60)]
        texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(60)], k=rng.randrange(0, 12))) for _ in range(240)]
        ids = list(range(500, 740)) if turn % 3 else [rng.choice([None, *range(100)]) for _ in texts]
        rows = [topk.chunk(ids[a : a + 50], texts[a : a + 50]) for a in range(0, 240, 50)]
        words = [w.encode() for w in vocabulary]
        idf = np.array([rng.randrange(1, 90) / 10 for _ in words])
        shard = topk.Shard(rows, b" ".join(words), idf, 5.0)
        q = topk.Queries.__new__(topk.Queries)
        own = [sorted(rng.sample(range(60), rng.randrange(1, 9))) for _ in range(6)]
        q.query, q.code, q.edge = np.arange(6), np.concatenate(own), np.r_[0, np.cumsum([len(x) for x in own])]
        q.times, q.least = np.array([rng.randrange(1, 4) for _ in q.code]), np.zeros(6)
        for again in range(2):
            for i, (docs, scores) in enumerate(shard.search_all(q, 5)):
                best = {}
                for d, text in zip(ids, texts, strict=True):
                    c = Counter(text.encode().split())
                    size = sum(c.values())
                    s = sum(int(times) * math.floor(idf[code] * c[words[code]] * 2.2 / (c[words[code]] + 1.2 * (0.25 + 0.75 * size / 5.0)) * 1e6 + 0.5) for code, times in zip(own[i], q.times[q.edge[i] : q.edge[i + 1]], strict=True) if c[words[code]])
                    if s and d is not None:
                        best[d] = max(best.get(d, 0), s)
                want = sorted(((-s, d) for d, s in best.items()))[:5]
                assert list(zip((-scores).tolist(), docs.tolist(), strict=True)) == want
                if not again:
                    q.least[i] = -want[-1][0] if len(want) == 5 else 0
        opened, postings = opened + shard.opened, postings + 2 * sum(int(np.diff(shard.start)[shard.first[c] : shard.first[c + 1]].sum()) for c in q.code if shard.row[c] < 0)
    assert opened < 0.6 * postings  # of the postings that a scan of the same lists reads


def test_sums_in_single_precision_give_exact_scores(monkeypatch):
    """Dense lists are added up in single precision, scores of 10**11 that differ by a few units or tie still come out exact.
    A shard's terms are looked up in one go, whatever the number of its chunks."""
    calls, look_up, rng = [], topk.pc.index_in, random.Random(12)
    monkeypatch.setattr(topk.pc, "index_in", lambda *a, **b: calls.append(1) or look_up(*a, **b))
    monkeypatch.setattr(topk, "BLOCK", 4)
    words = [f"w{i}".encode() for i in range(30)]
    texts = [" ".join(f"w{i}" for i in rng.sample(range(30), 20)) for _ in range(100)] * 2
    idf = np.array([3 + rng.randrange(9) / 10**6 for _ in words])
    shard = topk.Shard([topk.chunk(list(range(a, a + 50)), texts[a : a + 50]) for a in range(0, 200, 50)], b" ".join(words), idf, 20.0)
    assert shard.dense.dtype == np.float32 and shard.dense.shape[1] == 30 and len(calls) == 1
    q = topk.Queries.__new__(topk.Queries)
    q.query, q.code, q.edge, q.times, q.least = np.arange(3), np.tile(np.arange(30), 3), np.arange(4) * 30, np.array([5000 + rng.randrange(2) for _ in range(90)]), np.zeros(3)
    for again in range(2):
        for i, (docs, scores) in enumerate(shard.search_all(q, 10)):
            times = q.times[30 * i : 30 * i + 30].tolist()
            want = sorted((-sum(times[c] * math.floor(idf[c] * 1.0 * 2.2 / (1.0 + 1.2) * 1e6 + 0.5) for c in (int(w[1:]) for w in text.split())), d) for d, text in enumerate(texts))[:10]
            assert list(zip((-scores).tolist(), docs.tolist(), strict=True)) == want
            if not again:
                q.least[i] = -want[-1][0]


def test_similar_of_odd_tables(empty, clashing):
    assert topk.similar(empty, empty).count() == 0
    assert topk.similar(clashing, clashing.where("doc_id % 20 = 0")).count() > 0


# op7, op4


def test_token_ids_are_the_librarys(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own, plain = Encoder(*library_vocabulary()), Encoder(*public_vocabulary())
    rng = random.Random(11)
    odd = ["".join(rng.choice([" ", "  ", "\n", "\t", "a", "The", "é", "中文", "😀", "'s", "12", "!!", "\xa0", "\x1c", "\x85", "<|endoftext|>"]) for _ in range(30)) for _ in range(400)]
    for text in [*(r[1] for r in rows if r[1]), *odd, " ", "  a", "a  ", ""]:
        t.encode_special_tokens = False
        assert np.frombuffer(own.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        t.encode_special_tokens = True
        assert np.frombuffer(plain.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_pieces_and_packing(docs, rows):
    own = Encoder(*public_vocabulary())
    want = []
    for r in rows:
        ids = own.encode(r[1] or "") + (2).to_bytes(4, "little")
        n = len(ids) // 4
        cut = [0] if n <= 64 else list(range(n % 64 or 64, n, 64))
        edges = sorted({0, *cut, n})
        want += [(r[0], k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    got = packing.pack(packing.pieces(docs, capacity=64), capacity=64, task_items=20).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own_bin in bins.values():
        at = 0
        for offset, length in sorted(own_bin):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(bins) <= 1.15 * -(-total // 64)


def test_a_shard_reads_its_rows_where_they_lie():
    """A chunk's columns may be Arrow buffers: neither they nor the terms become objects of Python."""
    words = [b"a", b"b", b"c", b"\xc3\xa9"]
    row = topk.chunk([1, 2, 3], ["a b a", "c \u00e9", "b"])
    own = [topk.Shard([r], b" ".join(words), np.ones(4), 2.0) for r in (dict(row), {k: pa.py_buffer(v) if isinstance(v, bytes) else v for k, v in row.items()})]
    assert (own[0].docs == own[1].docs).all() and (own[0].at == own[1].at).all() and (own[0].value == own[1].value).all() and (own[0].dense == own[1].dense).all()
    assert topk._split(b"").to_pylist() == [] and topk._split(b" ".join(words)).to_pylist() == words


def test_pieces_keep_the_ids_of_many_words():
    """Without a reason not to, a worker that packs keeps as many words as one that materialises, so few are encoded twice."""
    most = inspect.signature(packing.pieces).parameters["kept_words"].default
    own, calls = tokens.Encoder(*tokens.library_vocabulary(), most=most), []
    own._ids = lambda text: calls.append(text) or [1]
    text = "a " + " ".join(f"w{i}" for i in range(150_000))
    assert own.encode(text) == own.encode(text) and len(calls) == 150_002  # the first word is always encoded


def test_best_fit_is_best_fit():
    rng = random.Random(12)
    for _ in range(50):
        sizes, free, bins = [rng.randrange(1, 31) for _ in range(60)], [], []
        for i in sorted(range(60), key=lambda i: -sizes[i]):
            fit = min((f for f in free if f >= sizes[i]), default=None)
            if fit is None:
                bins.append(sizes[i])
                free.append(30 - sizes[i])
            else:
                free.remove(fit)
                free.append(fit - sizes[i])
        got = packing.best_fit(sizes, 30)
        assert len(got) == len(bins) and sorted(30 - sum(sizes[i] for i in b) for b in got) == sorted(free)
        assert sorted(i for b in got for i in b) == list(range(60))


def test_packing_of_odd_tables(empty, clashing, rows):
    assert packing.pack(packing.pieces(empty)).count() == 0
    assert packing.pack(packing.pieces(clashing)).select("doc_id").distinct().count() == len({r[0] for r in rows})


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000])
def test_feistel_is_a_permutation(size):
    one, other = (materialise.feistel(np.arange(size), size, key) for key in (1, 2))
    assert sorted(one) == list(range(size))
    assert size < 17 or (one != other).any()


def test_training_order_round_trip(spark, docs, rows, tmp_path):
    out = materialise.materialise(docs, length=16, shard_slots=100)
    got = sorted(out.collect(), key=lambda r: r.slot)
    stride = len(got[0].record) + 1
    assert [r.slot for r in got] == list(range(len(got))) and all(r.shard == r.slot // 100 and r.byte_offset == r.slot % 100 * stride for r in got)
    path = str(tmp_path / "shards")
    materialise.write_shards(out, path, length=16)
    back = sorted(materialise.read_shards(spark, path, length=16).collect(), key=lambda r: (r.file, r.at))
    assert [(r.doc_id, r.piece, zlib.crc32(np.array(r.ids, "<u2").tobytes())) for r in back] == [(r.doc_id, r.piece, r.ids_crc32) for r in got]
    for first, count in ((0, 3), (95, 130), (len(got) - 2, 9)):  # a reader takes up at any slot
        again = [(s, d, p, zlib.crc32(i.tobytes())) for s, d, p, i in materialise.resume(path, first, count)]
        assert again == [(r.slot, r.doc_id, r.piece, r.ids_crc32) for r in got[first : first + count]]
    own = Encoder(*public_vocabulary())
    whole = Counter(tuple([*np.frombuffer(own.encode(r[1] or ""), "<u4").tolist(), 50256]) for r in rows if r[0] is not None and r[0] != 3)
    texts = defaultdict(list)
    for r in sorted((r for r in back if r.doc_id is not None), key=lambda r: (r.doc_id, r.piece)):
        texts[r.doc_id] += r.ids
    assert Counter(tuple(v) for k, v in texts.items() if k != 3) == whole


def test_resume_where_shards_grew(docs, empty, tmp_path, monkeypatch):
    """More sequences than the bound on shards allows: shards are larger, and the manifest says so."""
    monkeypatch.setattr(materialise, "MOST_SHARDS", 4)
    own = materialise.materialise(docs, length=16, shard_slots=10)
    got = sorted(own.collect(), key=lambda r: r.slot)
    materialise.write_shards(own, path := str(tmp_path / "grown"), length=16)
    for first in (0, 9, 100, len(got) - 3):
        assert [(s, d, p) for s, d, p, _ in materialise.resume(path, first, 5)] == [(r.slot, r.doc_id, r.piece) for r in got[first : first + 5]]
    assert list(materialise.resume(path, len(got), 5)) == []
    materialise.write_shards(materialise.materialise(empty, length=16), path := str(tmp_path / "none"), length=16)
    assert list(materialise.resume(path, 0, 5)) == []


def test_training_order_of_odd_tables(empty, clashing, docs):
    assert materialise.materialise(empty).count() == 0
    assert materialise.materialise(clashing).count() == materialise.materialise(docs).count()


# op8


def ideal(units, blocks):
    """The slot that the ideal schedule has reached when a source of u units has j blocks."""
    return lambda j, u: sum(min(Fraction(units[k] * j, u), blocks[k]) for k in units)


@pytest.mark.parametrize(("n", "block_rows", "total"), [({"a": 900, "b": 350, "c": 120, None: 40}, 4, 20), ({"a": 30, "b": 7, "c": 3}, 1, 200), ({"a": 513, "b": 64, "c": 8, "d": 1}, 1, 9)])
def test_mixture_stays_within_a_block(spark, n, block_rows, total):
    """In every prefix, over all slots, also where sources have less than a cycle or run out inside one."""
    rows = [(1000 * k + i, s) for k, (s, c) in enumerate(n.items()) for i in range(c)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string")
    got = mixing.mix(df, block_rows=block_rows, units=total).collect()
    assert sorted((r.doc_id, r.source or "") for r in got) == sorted((i, s or "") for i, s in rows)
    slots = {r.slot: (r.source, r.block) for r in got}
    blocks = {s: -(-c // block_rows) for s, c in n.items()}
    units = {s: max(1, round(total * math.sqrt(c) / sum(math.sqrt(x) for x in n.values()))) for s, c in n.items()}
    assert sorted(slots) == list(range(sum(blocks.values())))  # one block in each slot
    reached = ideal(units, blocks)
    for slot, (s, j) in slots.items():
        assert math.floor(reached(j, units[s])) <= slot < math.ceil(reached(j + 1, units[s]))
    for s in n:  # a source's rows stay in its own order
        own = sorted((r.slot, r.place, r.rank) for r in got if r.source == s)
        assert [x[2] for x in own] == list(range(n[s]))


def test_mixture_with_given_weights(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(80)], "doc_id bigint, source string")
    got = {r.slot: r.source for r in mixing.mix(df, block_rows=1, weights={"a": 3, "b": 1}).collect()}
    seen = Counter()
    for t in range(53):
        seen[got[t]] += 1
        assert abs(seen["a"] - 0.75 * (t + 1)) < 1


def test_mixture_breaks_ties_by_all_columns(spark):
    rows = [(1, "a", f"text {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    orders = [[r.text for r in sorted(mixing.mix(df.repartition(k), block_rows=1, keep=("text",)).collect(), key=lambda r: r.slot)] for k in (3, 7)]
    assert orders[0] == orders[1]


def test_mixture_of_many_sources(spark, monkeypatch):
    """Above MAX_SOURCES the schedule is a table, with the same rows."""
    n = {"a": 300, "b": 130, "c": 40, None: 9}
    few = spark.createDataFrame([(1000 * k + i, s) for k, (s, c) in enumerate(n.items()) for i in range(c)], "doc_id bigint, source string")
    want = sorted(map(tuple, mixing.mix(few, block_rows=4, units=20).collect()))
    many = spark.createDataFrame([(i, f"s{i % 1003}") for i in range(2010)], "doc_id bigint, source string")
    got = mixing.mix(many, block_rows=1).collect()
    assert sorted(r.doc_id for r in got) == list(range(2010)) and sorted(r.slot for r in got) == list(range(2010))
    assert len({r.source for r in got if r.slot < 1003}) == 1003  # units of 1: each once in a cycle
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    assert sorted(map(tuple, mixing.mix(few, block_rows=4, units=20).collect())) == want


def test_mixture_of_odd_tables(docs, empty, clashing, rows):
    assert mixing.mix(docs).count() == len(rows) and mixing.mix(empty).count() == 0
    again = mixing.in_order(clashing)
    assert again.columns == clashing.columns and again.count() == len(rows)


def test_chunks_of_the_index_are_searched_one_at_a_time(spark, docs, monkeypatch):
    """A task doesn't hold a batch of many chunks while it searches one (F1); the session's own setting stays."""
    name, seen, stored = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, topk.stored
    usual = spark.conf.get(name)
    monkeypatch.setattr(topk, "stored", lambda df, table: (seen.setdefault(table, set()).add(spark.conf.get(name)), stored(df, table))[1])
    assert topk.similar(docs, docs.where("doc_id % 5 = 0")).count() > 0
    assert seen["topk-found"] == {"1"} and seen["topk-index"] == {usual} and spark.conf.get(name) == usual


# op6


def scored(docs):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return hpylm.score(docs.withColumn("held_out", held)).collect()


def test_base_scores_match_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(hpylm, "FREQUENT", 7)  # both ways: broadcast words and joined ones
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for r in rows if not held(r[0]) for w in hpylm.words(r[1]))
    n, v = sum(count.values()), len(count)
    want = []
    for r in rows:
        own = hpylm.words(r[1])
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        want.append((r[0], held(r[0]), len(own), sum(w in count for w in own), n, round(base, 6)))
    got = scored(docs)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    own = [r for r in got if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    # the split between broadcast and joined words changes nothing
    monkeypatch.setattr(hpylm, "FREQUENT", 100_000)
    again = {(r.doc_id, r.n_tokens): r.score for r in scored(docs)}
    assert all(again[r.doc_id, r.n_tokens] == pytest.approx(r.score, rel=1e-5) for r in got)


def test_probabilities_sum_to_one(docs):
    rows = docs.withColumn("held_out", F.lit(False))
    table = hpylm.stored(hpylm.counted(rows), "test-counts")
    history, _ = hpylm.fit(table)
    samples = hpylm.kept(history)
    back = sum(s.back_off() for s in samples) / len(samples)
    total, parent = np.zeros(hpylm.CLASSES), np.zeros(len(samples))
    for r in hpylm.predicted(table, history).collect():
        parent += r.parent
        for k, d in zip(r.classes, r.direct, strict=True):
            total[k] += d
    unknown = np.array([s.parent(np.zeros(1), np.zeros(1))[0] for s in samples])
    assert parent + unknown == pytest.approx(np.ones(len(samples)))
    used = samples[0].customers > 0
    assert (total + back)[used] == pytest.approx(np.ones(used.sum()))


def test_settled_deletes_what_was_stored_on_the_way(spark):
    paths = []

    def make():
        half = common.stored(spark.range(10), "test-half")
        paths.extend(half.inputFiles())
        return half.where("id > 4")

    out = common.settled(spark, make, "test-whole")
    assert sorted(r.id for r in out.collect()) == [5, 6, 7, 8, 9]
    assert paths and not any(Path(urlparse(p).path).exists() for p in paths)
    other = common.stored(spark.range(3), "test-other")  # outside nothing is deleted
    assert common.settled(spark, lambda: other, "test-copy").count() == other.count() == 3


def test_seats_stored_after_the_burn_in_change_nothing(docs, spark):
    table = hpylm.stored(hpylm.counted(docs.withColumn("held_out", F.lit(False))), "test-counts")
    burnt = hpylm.burnt_in(table)
    (plain, tokens), (late, again) = hpylm.fit(table), hpylm.fit(burnt)
    assert tokens == again and len(plain) == 1 + hpylm.BURN_IN + hpylm.SAMPLES and len(late) == 1 + hpylm.SAMPLES
    for x, y in zip(plain[hpylm.BURN_IN :], late, strict=True):
        assert (x.customers == y.customers).all() and (x.tables == y.tables).all()
        assert (x.parent_customers, x.parent_tables, x.known) == (y.parent_customers, y.parent_tables, y.known)
    model = lambda t, h: sorted((bytes(r.word), r.total, r.classes, r.direct, r.parent) for r in hpylm.predicted(t, h).collect())
    assert model(table, plain) == model(burnt, late)
    empty = hpylm.burnt_in(hpylm.stored(hpylm.counted(docs.withColumn("held_out", F.lit(True))), "test-counts"))
    assert empty.count() == 0 and hpylm.fit(empty)[1] == 0


def test_seats_are_within_bounds_and_repeatable():
    c = np.array([1, 2, 5, 400, 1_000_000.0])
    t = hpylm.seated(c, np.full(5, 3.0), 0.5, np.arange(5))
    assert (t >= 1).all() and (t <= c).all() and (t == hpylm.seated(c, np.full(5, 3.0), 0.5, np.arange(5))).all()
    # expected tables of a Chinese restaurant with discount 0, strength a: sum of a / (a + i)
    many = hpylm.seated(np.full(4000, 200.0), np.full(4000, 3.0), 0.0, np.arange(4000) * 7919).mean()
    assert many == pytest.approx(1 + sum(3 / (3 + i) for i in range(1, 200)), rel=0.05)


def test_blocked_sweeps_sample_the_posterior():
    """One restaurant of two dishes under a fixed base, small enough to sum over all numbers of tables: the sweeps' shares of
    each pair of table numbers are the Pitman-Yor posterior's."""
    d, strength, counts, base = 0.5, 1.5, (3, 4), (0.3, 0.2)

    def ways(c, t):  # sums over seatings of c customers at t tables of the products of (1 - d)(2 - d)... : Stirling-like numbers
        s = {(0, 0): 1.0}
        for n in range(1, c + 1):
            for k in range(n + 1):
                s[n, k] = s.get((n - 1, k - 1), 0.0) + (n - 1 - d * k) * s.get((n - 1, k), 0.0)
        return s[c, t]

    weight = {(a, b): math.prod(strength + d * i for i in range(a + b)) * base[0] ** a * base[1] ** b * ways(counts[0], a) * ways(counts[1], b) for a in range(1, 4) for b in range(1, 5)}
    total, seen = sum(weight.values()), Counter()
    t = [np.ones(6000), np.ones(6000)]
    for turn in range(12):
        for i in (0, 1):
            t[i] = hpylm.seated(np.full(6000, float(counts[i])), strength + d * t[1 - i], d, np.arange(6000) * 7919 + turn * 31 + i * 1_000_003, base[i])
        if turn >= 4:
            seen.update(zip(t[0].astype(int).tolist(), t[1].astype(int).tolist(), strict=True))
    for k, w in weight.items():
        assert seen[k] / sum(seen.values()) == pytest.approx(w / total, abs=0.012)


@pytest.mark.parametrize("c, mass, d, base", [(300, 5000.0, 0.75, 0.004), (700, 60.0, 0.75, 0.001), (900, 4000.0, 0.8, 0.02), (800, 3e5, 0.75, 0.3), (800, 3.0, 0.5, 1.0)])
def test_large_groups_are_seated_by_their_exact_distribution(c, mass, d, base):
    """The shares of the numbers of tables of groups of hundreds of customers are the weights from the recurrence of seatings."""
    ways = np.full(c + 1, -np.inf)
    ways[0] = 0.0
    for n in range(1, c + 1):
        with np.errstate(divide="ignore"):
            ways[1 : n + 1] = np.logaddexp(ways[:n], np.append(np.log(n - 1 - d * np.arange(1, n)), -np.inf) + ways[1 : n + 1])
        ways[0] = -np.inf
    t = np.arange(1, c + 1)
    weight = ways[1:] + t * np.log(base) + np.cumsum(np.log(mass + d * (t - 1)))
    p = np.exp(weight - weight.max())
    p /= p.sum()
    drawn = hpylm.seated(np.full(20_000, float(c)), np.full(20_000, mass), d, np.arange(20_000) * 7919, base)
    seen = np.bincount(drawn.astype(int), minlength=c + 1)[1:] / len(drawn)
    assert np.abs(np.cumsum(seen) - np.cumsum(p)).max() < 0.015


def test_language_model_of_odd_tables(spark, empty, clashing, rows):
    assert scored(empty) == [] and len(scored(clashing)) == len(rows)
    alone = spark.createDataFrame([(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id bigint, text string")
    assert {(r.train_tokens, r.base_score, round(r.score, 9)) for r in scored(alone)} == {(0, 0.0, 0.0)}


def test_every_word_before_is_a_context_of_its_own(spark):
    """Two words of one class are followed by different words: which of them stands before tells (F5)."""
    learnt = [(i, "naab left" if i % 2 else "noab right") for i in range(40)]
    asked = [(100, "naab left"), (101, "naab right"), (102, "noab left"), (103, "noab right"), (104, "noob right")]
    docs = spark.createDataFrame([(*r, r[0] >= 100) for r in learnt + asked], "doc_id bigint, text string, held_out boolean")
    got = {r.doc_id: r.score for r in hpylm.score(docs).collect()}
    assert len(set(hpylm.contexts([b"naab", b"noab"]) % hpylm.CLASSES)) == 1
    assert min(got[100], got[103]) > max(got[101], got[102]) + 1 and got[104] < got[103]


def test_contexts_share_out_all_of_their_words(spark, docs):
    """What a context gives its words and leaves to its class is one, and tables are within bounds, however rows are dealt."""
    pairs = hpylm.stored(hpylm.followed(docs.withColumn("held_out", F.lit(False))).withColumn("p", F.lit(1e-3)), "test-pairs")
    seats = lambda: sorted((r.before, bytes(r.word or b""), r.n, r.tables, r.direct, r.back) for r in hpylm.seat_contexts(pairs).collect())
    got = seats()
    for before in {r[0] for r in got}:
        own = [r for r in got if r[0] == before]
        assert sum(r[4] for r in own) + own[0][5] == pytest.approx(1) and len({r[5] for r in own}) == 1 and sum(r[2] == 0 for r in own) == 1
    assert all(1 <= r[3] <= r[2] for r in got if r[2]) and any(1 < r[3] < r[2] for r in got)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)  # contexts go over several batches
    try:
        assert [r[:4] for r in seats()] == [r[:4] for r in got]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


# the pipeline


def test_pipeline_stages(spark, docs, rows, tmp_path):
    d = docs.where("doc_id is not null")
    path = str(tmp_path)
    kept = [r for r in rows if r[0] is not None]
    one = corpus_pipeline.language(spark, d, path)
    assert one.columns == docs.columns
    letters = [r for r in kept if any(c.isalpha() for c in r[1] or "")]
    assert sorted(r.doc_id for r in one.collect()) == sorted(r[0] for r in letters)
    two = corpus_pipeline.near_copies(spark, one, path)
    lead = {i for i, _, c in groups(letters) if i == c}
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == sorted(lead)
    three = corpus_pipeline.secrets(spark, two, path)
    texts = {r.doc_id: r.text for r in three.collect()}
    assert sorted(texts) == sorted(lead) and "AKIA" not in texts[98] and texts[0] == rows[0][1]
    four = corpus_pipeline.mixture(spark, three, path)
    assert four.columns == docs.columns and sorted(r.doc_id for r in four.collect()) == sorted(lead)
    assert {r.doc_id for r in corpus_pipeline.packed(spark, four, path).collect()} == lead


def test_sequences_follow_the_mixture(spark, tmp_path, monkeypatch):
    """Windows of sequences hold the documents of consecutive places, so each source keeps to its weight."""
    rng = random.Random(13)
    n = {"a": 1600, "b": 400}
    rows = [(i, " ".join(["word"] * rng.choice([2, 20, 300])), "en", "a" if i < n["a"] else "b", 1) for i in range(sum(n.values()))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    monkeypatch.setattr(mixing.in_order, "__defaults__", (4, 3, None))
    monkeypatch.setattr(packing.pack_in_order, "__defaults__", (1024, 60))
    place = {r.doc_id: 4 * r.slot + r.place for r in mixing.mix(docs, block_rows=4, units=3).collect()}
    want = [i for _, i in sorted((p, i) for i, p in place.items())]
    mixed = corpus_pipeline.mixture(spark, docs, str(tmp_path))
    for four in (mixed, corpus_pipeline.stored(mixed, "test-mixture")):
        got = sorted((r.sequence_id, r.offset, r.doc_id, r.length) for r in corpus_pipeline.packed(spark, four, str(tmp_path)).collect())
        order = [r[2] for r in got]
        assert all(sorted(order[k : k + 60]) == sorted(want[k : k + 60]) for k in range(0, len(want), 60))
        used = Counter()
        for s, _, _, length in got:
            used[s] += length
        assert max(used.values()) <= 1024
        seen = Counter()
        for k in range(0, 1200, 60):  # units 2 and 1: two thirds are a's until b runs out
            seen.update("a" if i < n["a"] else "b" for i in order[k : k + 60])
            assert abs(seen["a"] - 2 / 3 * (k + 60)) <= 4


def test_pipeline_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_residual_bins_of_neighbouring_windows_share_sequences(spark):
    """Windows of 3 places, each one full and one underfull bin: the underfull ones meet over the levels of the tree (F10)."""
    items = [(10 + at, 0, 0, n, at, at) for at, n in enumerate([60, 40, 50] * 9)]
    df = spark.createDataFrame(items, "doc_id long, piece int, start long, length long, ids_crc32 long, at long")
    got = packing.pack_in_order(df, 100, 3, slack=0, fan=2).collect()
    assert sorted(r.doc_id for r in got) == [i[0] for i in items]
    bins = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sum(x.length for x in bins.get(r.sequence_id, []))
        bins.setdefault(r.sequence_id, []).append(r)
    order = [(r.doc_id - 10) // 3 for b in bins.values() for r in b]
    assert order == sorted(order)  # windows stay in order
    assert len(bins) == 9 + 5  # 9 full ones, 4 of two halves, one half left; 18 when windows were packed alone
    assert packing.best_pair([(30, 1), (70, 2)], [(40, 3), (30, 4)], 100) == (2, 4) and packing.best_pair([(90, 1)], [(20, 2)], 100) is None
