"""The driver's queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, decontaminate, digest, hpylm, langid, leaderboard, licenses, materialise, mixing, ngram_join, packing, secret_scan, topk
from .common import read


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return topk.similar(docs, docs.where("doc_id % 20 = 0"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprint_with_next(read(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise.materialise(read(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf_dir, "documents"))
    base = F.transform("base", lambda b: b["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["start"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform("spans", lambda s: s["label"]))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return hpylm.score(read(spark, sf_dir, "documents").withColumn("held_out", held_out))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents")))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents"))
    # A lambda of two parameters would be given the element's index as the second one.
    of = lambda k: F.size(F.filter("base", lambda m: m["kind"] == k)).cast("bigint")
    counts = [of(k).alias(name) for k, name in enumerate(("n_assign", "n_access", "n_hex"))]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"), secret_scan.listed("spans").alias("spans"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fitted(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_leaderboard_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (read(spark, sf_dir, t) for t in ("sale_lines", "vendors", "items"))
    return leaderboard.change_feed(leaderboard.sale_batches(*tables))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def queries() -> dict:
    return {f.__name__: f for f in (op1_topk_search, op2_fingerprints, op3_ngram_jaccard, op4_training_order, op5_license_scan, op6_lm_scoring, op7_best_fit_packing, op8_source_mixing, op9_secret_scan, op10_language_id, op11_decontamination, op12_leaderboard_feed, op13_vector_codes)}


#: DuckDB, over the tables as views. Word lists and shingles are materialised once.
OP3 = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT r, doc_id, CASE WHEN len(a) < 5 THEN array_to_string(a, ' ') ELSE array_to_string(a[i:i + 4], ' ') END AS t
  FROM w, unnest(generate_series(1, greatest(len(a) - 4, least(len(a), 1)))) AS g(i)
), n AS MATERIALIZED (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM s GROUP BY r
), l AS MATERIALIZED (
  SELECT x.r AS a, y.r AS b FROM s x JOIN s y ON x.t = y.t AND x.r <> y.r JOIN n p ON p.r = x.r JOIN n q ON q.r = y.r
  GROUP BY x.r, y.r, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), c AS (SELECT r AS a, r AS b FROM w UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a
)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(m.doc_id) AS component_id
FROM w JOIN c ON c.a = w.r JOIN w m ON m.r = c.b LEFT JOIN n ON n.r = w.r GROUP BY w.r, w.doc_id
"""


OP1 = r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents
), o AS MATERIALIZED (SELECT doc_id, t AS term, count(*) AS tf, any_value(len(a)) AS size FROM w, unnest(a) AS u(t) GROUP BY doc_id, t
), g AS (SELECT count(*)::DOUBLE AS n, sum(len(a)) / greatest(count(*), 1)::DOUBLE AS mean FROM w
), d AS MATERIALIZED (SELECT term, count(*) AS df, ln((any_value(n) - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf FROM o, g GROUP BY term
), q AS MATERIALIZED (SELECT doc_id AS query_id, term, tf AS times FROM o WHERE doc_id % 20 = 0
), s AS (
  SELECT query_id, o.doc_id, sum(times * round(idf * tf::DOUBLE * 2.2 / (tf::DOUBLE + 1.2 * (0.25 + 0.75 * size / mean)) * 1000000)::BIGINT)::BIGINT AS score
  FROM q JOIN o USING (term) JOIN d USING (term), g GROUP BY query_id, o.doc_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 10
"""
#: Sources by their units, the phases of the mixture, windows of the blocks of one cycle of each phase, and earliest deadline
#: first over it, slot by slot.
OP8 = r"""
WITH RECURSIVE r AS MATERIALIZED (
  SELECT doc_id, source, coalesce('=' || source, '') AS src,
    row_number() OVER (PARTITION BY coalesce('=' || source, '') ORDER BY md5(coalesce(doc_id::VARCHAR, ''))) - 1 AS rank FROM documents
), o AS (SELECT src, count(*) AS n FROM r GROUP BY src
), u AS (SELECT src, n, greatest(1, round(200 * sqrt(n) / sum(sqrt(n)) OVER ()))::BIGINT AS units, (n + 63) // 64 AS blocks FROM o
), s AS MATERIALIZED (SELECT src, units, blocks // units AS cycles, blocks % units AS rest, row_number() OVER (ORDER BY encode(src)) AS i FROM u
), e AS (SELECT 0 AS c UNION SELECT cycles FROM s UNION SELECT cycles + 1 FROM s WHERE rest > 0
), f AS (SELECT * FROM (SELECT c AS first, lead(c) OVER (ORDER BY c) AS last FROM e) AS x WHERE last IS NOT NULL
), a AS MATERIALIZED (SELECT first, last, src, i, units, CASE WHEN cycles > first THEN units ELSE rest END AS share
  FROM f JOIN s ON s.cycles > f.first OR s.cycles = f.first AND s.rest > 0
), v AS MATERIALIZED (SELECT a.first, a.src, a.units, g.d, sum(least(k.units * g.d, k.share * a.units))::BIGINT AS reached
  FROM a, unnest(generate_series(0, a.share)) AS g(d) JOIN a k ON k.first = a.first GROUP BY ALL
), x AS MATERIALIZED (SELECT first, src, list(reached // units ORDER BY d) AS release, list((reached + units - 1) // units ORDER BY d) AS deadline FROM v GROUP BY first, src
), p AS MATERIALIZED (SELECT first, last, sum(share)::BIGINT AS length, list(share ORDER BY i) AS shares, list(src ORDER BY i) AS ss, list(release ORDER BY i) AS rs, list(deadline ORDER BY i) AS ds
  FROM a JOIN x USING (first, src) GROUP BY ALL
), b AS (SELECT *, coalesce(sum((last - first) * length) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin FROM p
), t AS (
  SELECT first, length, shares, rs, ds, -1::BIGINT AS pos, list_transform(shares, lambda x: 0::BIGINT) AS done, 0::BIGINT AS pick FROM p
  UNION ALL
  SELECT first, length, shares, rs, ds, pos + 1, list_transform(done, lambda d, k: d + CASE WHEN k = g THEN 1 ELSE 0 END), g
  FROM (SELECT *, list_min(list_transform(list_filter(generate_series(1, len(shares)), lambda k: done[k] < shares[k] AND rs[k][done[k] + 1] <= pos + 1),
      lambda k: ds[k][done[k] + 2] * 100000 + k)) % 100000 AS g FROM t WHERE pos + 1 < length) AS z
), k AS (SELECT t.first, b.ss[t.pick] AS src, t.pos, row_number() OVER (PARTITION BY t.first, t.pick ORDER BY t.pos) - 1 AS k FROM t JOIN b USING (first) WHERE t.pos >= 0
)
SELECT r.doc_id, r.source, r.rank, r.rank // 64 AS block, b.begin + (r.rank // 64 // s.units - b.first) * b.length + k.pos AS slot, (r.rank % 64)::INTEGER AS place
FROM r JOIN s USING (src) JOIN b ON b.first <= r.rank // 64 // s.units AND r.rank // 64 // s.units < b.last
JOIN k ON k.first = b.first AND k.src = r.src AND k.k = r.rank // 64 % s.units
"""
#: Every window of every item against all stretches of as many words.
OP11 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM benchmark
), w AS MATERIALIZED (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, least(len(a), 10) AS n, array_to_string(a[i:i + least(len(a), 10) - 1], ' ') AS t
  FROM b, unnest(generate_series(1, len(a) - least(len(a), 10) + 1)) AS g(i) WHERE len(a) > 0
), z AS (SELECT DISTINCT n FROM w
), x AS MATERIALIZED (SELECT r, i, n, array_to_string(a[i:i + n - 1], ' ') AS t FROM d, z, unnest(generate_series(1, len(a) - n + 1)) AS g(i)
), h AS MATERIALIZED (SELECT x.r, x.i, x.n, w.item FROM x JOIN w ON x.n = w.n AND x.t = w.t
), k AS (SELECT r, count(DISTINCT p) AS n_hit FROM h, unnest(generate_series(i, i + n - 1)) AS u(p) GROUP BY r
), m AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r)
SELECT doc_id, len(a)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (r) LEFT JOIN m USING (r)
"""
#: h is CRC-32, bit by bit for its table of 256 and byte by byte for the texts. A board needs every item of the nation on every
#: day: its revenue on the last day it changed.
OP12 = r"""
WITH z AS (
  SELECT list_transform(generate_series(0, 255), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc
), l AS (
  SELECT *, coalesce(sale_id::VARCHAR, '') || ',' || coalesce(item_id::VARCHAR, '') || ',' || coalesce(vendor_id::VARCHAR, '') || ',' || coalesce(line_no::VARCHAR, '') AS ids FROM sale_lines
), h AS MATERIALIZED (
  SELECT l.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(ids, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h FROM l, z
), s AS (SELECT *, coalesce(date_diff('day', DATE '1970-01-01', shipped_at::DATE), 19723 + h % 150) AS s FROM h
), a AS (SELECT *, s + h % 7 + CASE WHEN h % 5 = 0 THEN 20 ELSE 0 END AS a FROM s
), b AS MATERIALIZED (SELECT *, least(8, greatest(1, 1 + floor((a - 19723) * 8 / 180)))::INTEGER AS batch FROM a
), m AS (SELECT batch, max(max(s)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM b GROUP BY batch
), r AS MATERIALIZED (
  SELECT v.nation_id AS nation, b.item_id AS item, b.a AS day, any_value(b.batch) AS batch,
    sum(CASE WHEN b.flag = 'swapped' THEN -1 ELSE 1 END * coalesce(floor(100 * b.amount + 0.5), b.quantity * floor(100 * i.price + 0.5), 0))::BIGINT AS cents
  FROM b JOIN m USING (batch) JOIN vendors v ON v.vendor_id = b.vendor_id JOIN items i ON i.item_id = b.item_id
  WHERE v.nation_id IS NOT NULL AND (m.seen IS NULL OR b.s + 15 >= m.seen) GROUP BY 1, 2, 3
), c AS MATERIALIZED (
  SELECT nation, item, day, sum(cents) OVER w::BIGINT AS revenue, lead(day) OVER w AS until FROM r WINDOW w AS (PARTITION BY nation, item ORDER BY day)
), d AS MATERIALIZED (SELECT nation, day, any_value(batch) AS batch, row_number() OVER (PARTITION BY nation ORDER BY day) AS k FROM r GROUP BY nation, day
), x AS MATERIALIZED (
  SELECT d.nation, d.k, c.item, row_number() OVER (PARTITION BY d.nation, d.k ORDER BY c.revenue DESC, c.item) AS rank
  FROM d JOIN c ON c.nation = d.nation AND c.day <= d.day AND (c.until IS NULL OR c.until > d.day) WHERE c.revenue > 0 QUALIFY rank <= 10
), f AS (
  SELECT coalesce(n.nation, o.nation) AS nation, coalesce(n.k, o.k + 1) AS k, coalesce(n.item, o.item) AS item, o.rank AS old_rank, n.rank AS new_rank
  FROM x AS n FULL JOIN x AS o ON o.nation = n.nation AND o.k = n.k - 1 AND o.item = n.item WHERE o.rank IS DISTINCT FROM n.rank
)
SELECT f.nation AS nation_id, d.day AS arrival_day, f.item AS item_id, d.batch, CASE WHEN old_rank IS NULL THEN 'enter' WHEN new_rank IS NULL THEN 'exit' ELSE 'move' END AS change,
  old_rank::INTEGER AS old_rank, new_rank::INTEGER AS new_rank, c.revenue
FROM f JOIN d ON d.nation = f.nation AND d.k = f.k JOIN c ON c.nation = f.nation AND c.item = f.item AND c.day <= d.day AND (c.until IS NULL OR c.until > d.day)
"""
#: The codebooks c0 to c6 of the rounds, each from the assignment a of the one before.
OP13 = (
    r"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS MATERIALIZED (
  SELECT r, vec_id, i // (len(v) // 8) AS p, i % (len(v) // 8) AS d, floor(4096 * v[i + 1]::DOUBLE)::BIGINT AS x FROM e, unnest(generate_series(0, len(v) - 1)) AS g(i)
), f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM (SELECT DISTINCT vec_id FROM e WHERE vec_id IS NOT NULL) AS y QUALIFY k < 16
), c0 AS MATERIALIZED (SELECT p, k, d, min(x) AS c FROM q JOIN f USING (vec_id) GROUP BY p, k, d
)"""
    + "".join(
        rf""", a{n} AS MATERIALIZED (
  SELECT r, p, min(s * 16 + k) % 16 AS k, min(s * 16 + k) // 16 AS s
  FROM (SELECT r, p, k, sum((x - c) * (x - c))::BIGINT AS s FROM q JOIN c{n} USING (p, d) GROUP BY r, p, k) AS y GROUP BY r, p
)"""
        + (
            rf""", c{n + 1} AS MATERIALIZED (
  SELECT p, k, d, coalesce(m.c, o.c) AS c FROM c{n} AS o LEFT JOIN (
    SELECT p, k, d, floor(sum(x)::DOUBLE / count(*))::BIGINT AS c FROM a{n} JOIN q USING (r, p) GROUP BY p, k, d) AS m USING (p, k, d)
)"""
            if n < codes.ROUNDS
            else ""
        )
        for n in range(codes.ROUNDS + 1)
    )
    + rf""", t AS (
  SELECT r, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, sum(s)::BIGINT AS error FROM a{codes.ROUNDS} GROUP BY r
), h AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, k, d)) AS codebooks_sha256 FROM c{codes.ROUNDS}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM t JOIN e USING (r), h
"""
)


def oracle_sql() -> dict[str, str]:
    return {"op1_topk_search": OP1, "op8_source_mixing": OP8, "op3_ngram_jaccard": OP3, "op11_decontamination": OP11, "op12_leaderboard_feed": OP12, "op13_vector_codes": OP13}
