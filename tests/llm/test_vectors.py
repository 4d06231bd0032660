"""Vector codes and decontamination against plain versions, with the odd cases."""

import random

import numpy as np
import pytest

from navnet.llm import codes, decontaminate

VECTOR = "vec_id bigint, embedding array<float>, label int"


def plain_codes(rows, entries=16, rounds=6):
    """Rows of finite vectors by ids that differ: ids, codes, errors, codebooks, by loops over whole numbers."""
    vectors = [[int(np.floor(np.float64(np.float32(x)) * 4096)) for x in v] for _, v, _ in rows]
    w = len(vectors[0]) // 8
    part = lambda v, p: v[p * w : (p + 1) * w]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])[:entries]
    books = [[part(vectors[i], p) for i in order] for p in range(8)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        near = [[min(range(len(books[p])), key=lambda k: (away(part(v, p), books[p][k]), k)) for p in range(8)] for v in vectors]
        if turn < rounds:
            for p in range(8):
                for k in range(len(books[p])):
                    if own := [part(v, p) for v, n in zip(vectors, near, strict=True) if n[p] == k]:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    errors = [sum(away(part(v, p), books[p][n[p]]) for p in range(8)) for v, n in zip(vectors, near, strict=True)]
    return near, errors, books


def test_codes_match_plain_version(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 37)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(24)], rng.choice([1, 2, None])) for i in range(200)]
    rows[50] = (50, rows[49][1], 1)  # a copy
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * 23 + [None], 2), (903, [0.0] * 23 + [float("nan")], 2), (904, [float("-inf")] + [0.0] * 23, 2)]
    df = spark.createDataFrame(rows + odd, VECTOR).repartition(5).selectExpr("*", "1 as code", "2 as error", "3 as n", "4 as block", "5 as _label")
    got = {r.vec_id: r for r in codes.compress(df).collect()}
    near, errors, books = plain_codes(rows)
    assert set(got) == {r[0] for r in rows}
    by_label = {}
    for (_, _, label), e in zip(rows, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    for (i, _, label), n, e in zip(rows, near, errors, strict=True):
        assert (got[i].code, got[i].error, got[i].label_error) == ("".join(f"{k:02x}" for k in n), e, by_label[label])
    assert {r.codebooks_sha256 for r in got.values()} == {codes.Codebooks(np.array(books)).sha256()}


def test_codes_of_few_and_repeated_rows(spark):
    v = [0.1 * k for k in range(8)]
    df = spark.createDataFrame([(2, v, None), (2, v, None), (None, [0.5] * 8, 3), (7, [-x for x in v], 3)], VECTOR)
    got = sorted(((r.vec_id, r.code, r.error) for r in codes.compress(df).collect()), key=repr)
    assert [i for i, *_ in got] == [2, 2, 7, None] and got[0] == got[1] and len({r.codebooks_sha256 for r in codes.compress(df).collect()}) == 1
    for none in (df.limit(0), df.where("vec_id is null"), spark.createDataFrame([(1, None, 1)], VECTOR)):
        assert codes.compress(none).collect() == []
    with pytest.raises(ValueError, match="multiple"):
        codes.compress(spark.createDataFrame([(1, [0.5] * 9, 1)], VECTOR))


def test_codes_decoded_lie_within_their_error(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)], 0) for i in range(60)]
    packed = codes.blocks(codes.kept(spark.createDataFrame(rows, VECTOR)), 16)
    books = codes.fitted(packed, codes.first_entries(codes.kept(spark.createDataFrame(rows, VECTOR))))
    coded = codes.encoded(packed, books)
    error = {r.vec_id: r.error for r in coded.collect()}
    for r in codes.decoded(coded, books).collect():
        whole = np.floor(np.array(rows[r.vec_id][1], np.float32).astype(float) * 4096)
        assert ((whole - np.array(r.embedding) * 4096) ** 2).sum() == pytest.approx(error[r.vec_id])


# decontamination


def plain_hits(docs, items, width=10):
    """doc_id, words, stretches hit, items of each row, by looking at every place."""
    cut = lambda t: decontaminate.words(t)
    windows = {}
    for name, text in items:
        w = cut(text)
        n = min(width, len(w))
        for o in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[o : o + n]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w, hit, names = cut(text), set(), set()
        for n in {len(x) for x in windows}:
            for o in range(len(w) - n + 1):
                if own := windows.get(tuple(w[o : o + n])):
                    hit.update(range(o, o + n))
                    names |= own
        out.append((i, len(w), len(hit), tuple(sorted(names))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(9)
    word = lambda: rng.choice(["ab", "Cd", "éf", "gh", "x1"])
    items = [(k, " ".join(word() for _ in range(rng.randrange(10, 40)))) for k in range(12)]
    items += [(20, "one Two"), (21, ""), (22, None), (None, "a nameless item of just six"), (3, items[3][1]), (23, items[4][1][6:])]
    docs = []
    for i in range(80):
        text = [word() for _ in range(rng.randrange(0, 60))]
        if i % 4 == 0:
            w = items[rng.randrange(12)][1].split()
            o = rng.randrange(len(w) - 8)
            text[5:5] = w[o : o + rng.randrange(8, 14)]
        docs.append((i, ", ".join(text)))
    docs += [(90, None), (91, ""), (92, "ONE two one two, a nameless item of just six"), (92, "one two"), (None, items[5][1]), (93, " ".join(["ab"] * 30_000) + " one two")]
    return docs, items


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_contamination_matches_all_places(spark, mixed, block):
    docs, items = mixed
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).selectExpr("*", "'x' as hits", "1 as items", "2 as n_words", "3 as _row")
    b = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as name")
    got = decontaminate.contamination(d, b, block_bytes=block)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()), key=repr) == plain_hits(docs, items)
    clean = decontaminate.decontaminate(d, b, block_bytes=block)
    assert clean.columns == d.columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted((i for i, _, n, _ in plain_hits(docs, items) if not n), key=repr)


def test_contamination_of_empty_tables(spark, mixed):
    docs, items = mixed
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r.n_hit, len(r["items"])) for r in decontaminate.contamination(d, b.limit(0)).collect()} == {(0, 0)}
    assert decontaminate.contamination(d.limit(0), b).collect() == [] and decontaminate.longest_matches(d, b.limit(0)).collect() == []
    assert decontaminate.decontaminate(d, b.limit(0)).count() == len(docs)


def test_longest_matches(spark, mixed):
    docs, items = mixed
    items = [x for x in items if x[0] is not None and x[0] < 12][:12]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.item_id, r.first_word): (r.n_words, r.doc_id, r.at) for r in decontaminate.longest_matches(d, b, least=6).collect()}
    want = {}
    for name, text in items:
        w = decontaminate.words(text)
        for o in range(len(w)):
            found = []
            for i, t in docs:
                own = decontaminate.words(t)
                if len(own) > 1000:  # of one word alone
                    continue
                for p in range(len(own)):
                    n = 0
                    while o + n < len(w) and p + n < len(own) and w[o + n] == own[p + n]:
                        n += 1
                    if n >= 6:
                        found.append((-n, i is None, i, p))
            if found:
                want[str(name), o] = (-min(found)[0], *min(found)[2:])
    assert {k: v for k, v in got.items() if v[1] != 93} == {k: v for k, v in want.items() if k not in {k for k, v in got.items() if v[1] == 93}} and len(got) > 50
