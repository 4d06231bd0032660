"""Vector code compression: every vector becomes eight numbers of entries of small codebooks, one for each of its parts.

1. A pass turns vectors into whole numbers and packs them into blocks, a row each: one NumPy array for a block, a line of
   it for each dimension, so that a dimension's values lie side by side. Blocks are stored once and read in every round.
2. A round is one RDD treeAggregate over the blocks. A block's distances to all entries accumulate dimension by dimension;
   np.add.at adds each part to its nearest entry's int64 sums and counts, and these tensors, whose size is that of the
   codebooks whatever the input, merge through a reduction tree of tasks. Sums of whole numbers are the same in any order,
   so the codebooks don't depend on blocks, tasks or lost executors.
3. The driver divides the merged sums by the counts: codebooks are all that it ever holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored

PARTS, ENTRIES, ROUNDS, SCALE, BLOCK = 8, 16, 6, 4096, 4096
#: Whole-number components below this keep all sums of squares within 64 bits.
LIMIT = 1 << 26
#: Labels at most whose sums are broadcast; with more they are joined by shuffle.
FEW = 65_536


@dataclass
class Codebooks:
    """entries: part, entry, position within the part."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def nearest(block: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each part of each vector of a block (dimension, vector), the nearest entry (a tie: the lower), and its squared
    distance."""
    parts, many, width = entries.shape
    index, least = (np.zeros((parts, block.shape[1]), np.int64) for _ in range(2))
    for p in range(parts):
        distance = np.zeros((many, block.shape[1]), np.int64)
        for d in range(width):
            away = block[p * width + d].astype(np.int64) - entries[p, :, d, None]
            distance += away * away
        index[p], least[p] = distance.argmin(0), distance.min(0)
    return index, least


def add_block(total: tuple[np.ndarray, np.ndarray], block: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """total (sums by part, entry, position; counts by part, entry) and the parts of one more block."""
    sums, counts = total
    parts, _, width = entries.shape
    index, _ = nearest(block, entries)
    for p in range(parts):
        np.add.at(sums[p], index[p], block[p * width : (p + 1) * width].T.astype(np.int64))
        np.add.at(counts[p], index[p], 1)
    return sums, counts


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] + b[0], a[1] + b[1]


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding of the rows that have a vector of at least one component, none null or not finite."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select("vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)


def first_entries(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The parts of the vectors of the smallest vec_ids: the codebooks that the rounds start from. An id counts once (of
    different vectors under one id, with the smallest); rows without id don't count. None of no rows with an id."""
    ids = [i for (i,) in rows.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    if not ids:
        return None
    found = dict(rows.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("embedding")).collect())
    if len(sizes := {len(v) for v in found.values()}) > 1 or min(sizes) % parts:
        raise ValueError(f"vectors must have one number of components, a multiple of {parts}: found {sorted(sizes)}")
    whole = np.floor(np.array([found[i] for i in ids], np.float64) * SCALE).astype(np.int64)
    return np.ascontiguousarray(whole.reshape(len(ids), parts, -1).transpose(1, 0, 2))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """ids, labels, n, block (int32, a line of n values for each dimension) of up to BLOCK vectors each."""
    kinds = dict(rows.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("ids", "labels", "n", "block")}
        for at in range(0, batch.num_rows, BLOCK):
            own = batch.slice(at, BLOCK)
            flat = own.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            if len(flat) != own.num_rows * size or set(own.column("embedding").value_lengths().to_pylist()) != {size}:
                raise ValueError(f"every vector must have {size} components")
            whole = np.floor(flat * SCALE)
            if np.abs(whole).max() >= LIMIT:
                raise ValueError(f"components of {LIMIT // SCALE} and more overflow the sums of squares")
            block = np.ascontiguousarray(whole.astype("<i4").reshape(own.num_rows, size).T)
            for name, v in zip(out, (own.column("vec_id").to_pylist(), own.column("label").to_pylist(), own.num_rows, block.tobytes()), strict=True):
                out[name].append(v)
        return out

    return arrow_map(rows, run, f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, n int, block binary")


def fitted(packed: DataFrame, start: np.ndarray, rounds: int = ROUNDS, depth: int = 2) -> Codebooks:
    """The codebooks after `rounds` rounds over the blocks, from start. An entry that no part is nearest to stays."""
    rows, entries = packed.select("n", "block").rdd.map(lambda r: np.frombuffer(r.block, "<i4").reshape(-1, r.n)), start
    for _ in range(rounds):
        zero = np.zeros(entries.shape, np.int64), np.zeros(entries.shape[:2], np.int64)
        sums, counts = rows.treeAggregate(zero, lambda total, block, now=entries: add_block(total, block, now), merged, depth)
        entries = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], entries)
    return Codebooks(entries)


def encoded(packed: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits for each part's entry), error (squared distances summed over the parts)."""
    kinds, entries = dict(packed.dtypes), books.entries
    kinds = {k: kinds[k].removeprefix("array<")[:-1] for k in ("ids", "labels")}

    def run(batch: pa.RecordBatch) -> Iterator[dict] | dict:
        ids, labels, codes, errors = [], [], [], []
        for own, label, n, block in zip(*(batch.column(c).to_pylist() for c in ("ids", "labels", "n", "block")), strict=True):
            index, least = nearest(np.frombuffer(block, "<i4").reshape(-1, n), entries)
            digits = index.T.astype(np.uint8).tobytes().hex()
            ids += own
            labels += label
            codes += [digits[k : k + 2 * len(entries)] for k in range(0, len(digits), 2 * len(entries))]
            errors += least.sum(0).tolist()
        return {"vec_id": ids, "label": labels, "code": codes, "error": errors}

    return arrow_map(packed, run, f"vec_id {kinds['ids']}, label {kinds['labels']}, code string, error bigint")


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, embedding (array<double>) that each code stands for: its entries, back at the vectors' scale."""
    kind, entries = dict(codes.dtypes)["vec_id"], books.entries

    def run(batch: pa.RecordBatch) -> dict:
        index = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, len(entries))
        vectors = np.concatenate([entries[p][index[:, p]] for p in range(len(entries))], 1) / SCALE
        return {"vec_id": batch.column("vec_id"), "embedding": vectors.tolist()}

    return arrow_map(codes.select("vec_id", "code"), run, f"vec_id {kind}, embedding array<double>")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error (error summed over all rows of the label, rows without one together),
    codebooks_sha256 of every row of vectors (vec_id, embedding, label; other columns are not read) that kept() keeps.

    Rows whose vector is null, empty, or holds a null or non-finite component go. Repeated rows count each and come out
    each; rows without vec_id are coded but never start a codebook; a table with no rows left, or none with an id, gives an
    empty result; with fewer ids than entries the codebooks are that much smaller. Vectors of different lengths, of a
    length that parts doesn't divide, or with components of 16,384 and more are an error."""
    spark, rows = vectors.sparkSession, kept(vectors)
    start = first_entries(rows, parts, entries)
    if start is None:
        kinds = dict(rows.dtypes)
        return spark.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    packed = stored(blocks(rows, parts * start.shape[2]), "vector-blocks")
    books = fitted(packed, start, rounds)
    codes = stored(encoded(packed, books), "vector-codes")
    sums = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "label-errors")
    sums = F.broadcast(sums) if sums.count() <= FEW else sums
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label").withColumn("codebooks_sha256", F.lit(books.sha256()))
