"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Every window of four bytes gives three triplets, each hashed to one of 256 buckets. A bucket's count is encoded by the
quartile of all counts that it lies in (two bits); a length code and two quartile ratios go before the 256 codes. Two
digests are compared by the steps between their codes, the length codes and the ratios, bounded by BOUND.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, BOUND = 256, 512
#: A permutation of the bytes, made by a rule (Pearson hashing needs any fixed one), and the hash of all byte pairs.
_T = np.random.RandomState(97).permutation(256).astype(np.uint8)
_PAIR = _T[_T[np.arange(65536) >> 8] ^ (np.arange(65536) & 255).astype(np.uint8)]
_STEPS = np.array([0, 1, 2, 6])


def digests(texts: list[bytes]) -> np.ndarray:
    """A row of 259 numbers for each text: length code, two ratios, 256 quartile codes. Of a text alone: equal texts have
    equal rows; texts of under three bytes have no triplet."""
    out = np.zeros((len(texts), 3 + BUCKETS), np.int16)
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - 2), 1 << 20):  # slices that share what spans them: memory stays bounded
            b = np.frombuffer(text[at : at + (1 << 20) + 3], np.uint8)
            n = min(1 << 20, len(b) - 2)
            if n <= 0:
                continue
            wide = b.astype(np.uint16)
            pair = _PAIR[(wide[:-1] << 8) | wide[1:]]
            counts[i] += np.bincount(_T[pair[:n] ^ b[2 : n + 2]], minlength=BUCKETS)
            m = min(1 << 20, len(b) - 3)
            if m > 0:
                skip = _PAIR[(wide[:m] << 8) | wide[2 : m + 2]]
                counts[i] += np.bincount(_T[pair[:m] ^ b[3 : m + 3] ^ 0x5A], minlength=BUCKETS) + np.bincount(_T[skip ^ b[3 : m + 3] ^ 0xA5], minlength=BUCKETS)
    order = np.sort(counts, axis=1)
    q = order[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    out[:, 3:] = sum((counts > q[:, [k]]).astype(np.int16) for k in range(3))
    size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    out[:, 0] = np.minimum(255, np.round(np.log1p(size) / np.log(1.12)))
    out[:, 1:3] = 15 * q[:, :2] // np.maximum(1, q[:, [2]])
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 from a difference of BOUND on."""
    apart = np.abs(a.astype(np.int32) - b)
    score = _STEPS[apart[:, 3:]].sum(1) + 4 * apart[:, 0] + 3 * apart[:, 1:3].sum(1)
    return 1.0 - np.minimum(score, BOUND) / BOUND


def encode(rows: np.ndarray) -> list[str]:
    """Hexadecimal: two digits of length, two of ratios, 128 of codes."""
    codes = rows[:, 3:].reshape(len(rows), -1, 4).astype(np.uint8)
    packed = codes[:, :, 0] << 6 | codes[:, :, 1] << 4 | codes[:, :, 2] << 2 | codes[:, :, 3]
    head = np.stack([rows[:, 0], rows[:, 1] * 16 + rows[:, 2]], 1).astype(np.uint8)
    return [x.tobytes().hex() for x in np.concatenate([head, packed], 1)]


def decode(fingerprints: list[str]) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex("".join(fingerprints)), np.uint8).reshape(len(fingerprints), -1).astype(np.int16)
    codes = np.stack([raw[:, 2:] >> s & 3 for s in (6, 4, 2, 0)], 2).reshape(len(raw), -1)
    return np.concatenate([raw[:, :1], raw[:, 1:2] >> 4, raw[:, 1:2] & 15, codes], 1)


def compare(one: str, other: str) -> float:
    return float(likeness(decode([one]), decode([other]))[0])


def fingerprint_with_next(docs: DataFrame) -> DataFrame:
    """op2: fingerprints of every whole text and of its edited text (see the contract), and their likenesses.

    Documents stand in descending order of doc_id (null last; a tie: by text, null first); the one after the last is the
    first. A null text is empty. Repeated rows each have a row, and are each other's next. An empty table gives none.

    One shuffle: rows are dealt to ranges of doc_id whose bounds are ids of the table, so the one row that a range needs
    from the next is known beforehand and is sent to both. A task streams through its range in order and holds one
    batch. Only the bounds, one id for each task, are on the driver.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.col("doc_id"), F.col("text"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = rows.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("i"))
    # bounds are ids of the table: even steps through those with the smallest hashes, and the largest of all
    some = sorted({r.i for r in known.orderBy(F.xxhash64("i"), "i").limit(64 * tasks).collect()})
    top = known.agg(F.max("i")).first()[0]
    cuts = np.array(sorted({some[len(some) * k // tasks] for k in range(1, tasks)} - {top}) if some else [], np.int64)
    last = len(cuts)

    @F.arrow_udf("array<int>")
    def ranges(ids: pa.Array) -> pa.Array:
        """The range of an id; then, as -1 - range, the one whose last row it follows."""
        known = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)  # whole numbers throughout: ids may be over 2**53
        own = np.where(pc.is_null(ids).to_numpy(zero_copy_only=False), 0, np.searchsorted(cuts, known))
        out = [[int(k)] for k in own]
        edge = np.isin(known, [*cuts.tolist(), top]) & pc.is_valid(ids).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(edge):
            out[i].append(-1 if known[i] == top else -2 - int(own[i]))
        return pa.array(out, pa.list_(pa.int32()))

    dealt = rows.withColumn("to", F.explode(ranges(F.col("doc_id").cast("bigint")))) if last else rows.withColumn("to", F.explode(F.array(F.lit(0), F.lit(-1))))
    dealt = dealt.withColumn("ahead", F.col("to") < 0).withColumn("range", F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")))
    if not last:  # one range: only the first row follows the last, which the task knows itself
        dealt = dealt.where(~F.col("ahead"))
    order = [F.col("range"), F.col("ahead"), F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    dealt = dealt.select("range", "ahead", "doc_id", "text").repartitionById(last + 1, F.col("range")).sortWithinPartitions(*order)
    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    types = [pa.int64() if kind == "bigint" else None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row = first_row = None  # (range, id, text, digest) whose next is still to come
        types[0] = types[0] or pa.int32()
        for batch in batches:
            near = [c.to_pylist() for c in batch.columns]
            texts = [t or "" for t in near[3]]
            own = digests([t.encode() for t in texts])
            here = [(r, i, t, d, a) for r, a, i, t, d in zip(near[0], near[1], near[2], texts, own, strict=True)]
            first_row = first_row or (here[0] if here else None)
            pairs = []
            for row in here:
                if open_row is not None and open_row[0] == row[0]:
                    pairs.append((open_row, row))
                open_row = None if row[4] else row
            if pairs:
                yield rows_of(pairs)
        if open_row is not None:
            yield rows_of([(open_row, first_row)])

    def rows_of(pairs: list[tuple]) -> pa.RecordBatch:
        edited = []
        for one, other in pairs:
            half = len(one[2]) // 2
            edited.append((one[2][: len(one[2]) - half] + other[2][:half]).encode())
        a, b, e = np.stack([p[0][3] for p in pairs]), np.stack([p[1][3] for p in pairs]), digests(edited)
        columns = [[p[0][1] for p in pairs], [len(p[0][2]) for p in pairs], [hashlib.sha256(x).hexdigest() for x in edited], encode(a), encode(e), likeness(a, e), likeness(a, b)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    return dealt.mapInArrow(run, schema)
