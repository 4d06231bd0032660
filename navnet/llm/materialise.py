"""Training-order materialisation: token sequences at global slots of a keyed pseudo-random order, in fixed-stride shards.

Every text's ids are cut into sequences. A sequence's dense number is its row in the stored sequence table (the offset of
its file, from the files' row counts, and its row in the file), so nothing is sorted for it. A keyed Feistel network over
the smallest even power of two that holds the M sequences, walked until it lands below M, is a permutation of 0..M-1: the
slot. A task per shard sorts its slots and writes records of one stride, so the record of any slot is at a computed byte
of a computed shard: reads are sequential, and resume at any slot.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, stored
from .tokens import KEPT, encoder, public_vocabulary

#: doc_id, whether there is one, piece, number of ids; then the ids, little-endian, padded with zeros; then a line feed, by
#: the text sink.
HEADER, HEADER_SIZE = "<qiii", 20
#: Shards at most: with more sequences the shards, which Spark sorts with spilling, are larger instead.
MOST_SHARDS = 20_000


def feistel(number: np.ndarray, size: int, key: int, rounds: int = 4) -> np.ndarray:
    """The permutation of 0..size-1 under key, at each number (cycle-walking)."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = number.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for k in range(rounds):
            f = right + np.uint64((key * 0x9E3779B97F4A7C15 + (k + 1) * 0xD1B54A32D192ED03) % 2**64)
            for s, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                f = (f ^ (f >> np.uint64(s))) * np.uint64(m)
            left, right = right, left ^ ((f ^ (f >> np.uint64(31))) & mask)
        x[todo] = left << np.uint64(half) | right
        todo &= x >= np.uint64(size)
    return x.astype(np.int64)


def sequences(docs: DataFrame, length: int = 512, end_id: int = 50256, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, n_tokens, ids (bytes, two for an id) of every whole text's ids and an end, cut at `length`. A null
    text is empty; repeated rows give repeated sequences."""
    path, pattern = vocabulary or public_vocabulary()

    def run(batch: pa.RecordBatch) -> dict:
        encode = encoder(path, pattern, most=KEPT).encode
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "n_tokens", "ids")}
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = np.append(np.frombuffer(encode(text or ""), "<u4"), end_id)
            if ids.max() > 0xFFFF:
                raise ValueError("records hold ids of 16 bits; this vocabulary has larger ones")
            ids = ids.astype("<u2")
            for k, at in enumerate(range(0, len(ids), length)):
                own = ids[at : at + length]
                for name, v in zip(out, (i, k, len(own), own.tobytes()), strict=True):
                    out[name].append(v)
        return out

    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, "doc_id bigint, piece int, n_tokens int, ids binary")


def ordered(own: DataFrame, key: int = 20, length: int = 512, shard_slots: int = 16_384) -> DataFrame:
    """slot, shard, byte_offset, doc_id, piece, n_tokens, ids_crc32, record of every sequence of own (as sequences() gives
    it, stored as Parquet): a partition for each shard, in order of slots. A null doc_id has no flag in the record. An
    empty table gives an empty result."""
    stride = HEADER_SIZE + 2 * length + 1
    files = own.select(F.col("_metadata.file_path").alias("file")).groupBy("file").count().orderBy("file").collect()
    total = sum(n for _, n in files)
    first = dict(zip((f for f, _ in files), np.cumsum([0, *(n for _, n in files)]).tolist(), strict=False))

    @F.pandas_udf("bigint")
    def slot(file: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(feistel((file.map(first) + row).to_numpy(np.int64), total, key))

    rows = own.select("doc_id", "piece", "n_tokens", "ids", slot(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("slot"))
    shard_slots = max(shard_slots, -(-total // MOST_SHARDS))
    shards = max(1, -(-total // shard_slots))
    dealt = rows.withColumn("shard", F.expr(f"cast(slot div {shard_slots} as int)")).repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")

    def run(batch: pa.RecordBatch) -> dict:
        c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        records = [(struct.pack(HEADER, d or 0, d is not None, p, n) + i).ljust(stride - 1, b"\0") for d, p, n, i in zip(c["doc_id"], c["piece"], c["n_tokens"], c["ids"], strict=True)]
        return {**c, "byte_offset": [s % shard_slots * stride for s in c["slot"]], "ids_crc32": [zlib.crc32(i) for i in c["ids"]], "record": records}

    return arrow_map(dealt, run, "slot bigint, shard int, byte_offset bigint, doc_id bigint, piece int, n_tokens int, ids_crc32 bigint, record binary")


def materialise(docs: DataFrame, key: int = 20, length: int = 512, shard_slots: int = 16_384) -> DataFrame:
    """ordered() of the sequences of docs."""
    return ordered(stored(sequences(docs, length), "sequences"), key, length, shard_slots)


def write_shards(rows: DataFrame, path: str, key: int = 20, length: int = 512) -> None:
    """A file for each shard, part-<shard>: its records in order of slots, one stride apart. Spark's committer writes it,
    to any file system and safe from lost executors; bytes pass through the text sink as they are. The folder _manifest
    has what resume() needs: stride, shard_slots, total and key, from the sizes of the files as they were written."""
    rows.select(F.col("record").cast("string").alias("value")).write.text(path)
    stride = HEADER_SIZE + 2 * length + 1
    spark = rows.sparkSession
    files = spark.read.format("binaryFile").load(path).select("length")
    most, total, odd = files.agg(F.max("length"), F.sum("length"), F.count(F.when(F.col("length") % stride != 0, 1))).first()
    if odd:
        raise ValueError(f"records aren't {stride} bytes apart: length must be the sequences' own")
    manifest = {"stride": stride, "shard_slots": max(1, (most or 0) // stride), "total": (total or 0) // stride, "key": key}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/_manifest")


def manifest(files: pa.fs.FileSystem, root: str) -> dict:
    """What write_shards() kept of the shards under root."""
    part = next(f.path for f in files.get_file_info(pa.fs.FileSelector(f"{root}/_manifest")) if f.base_name.startswith("part-"))
    with files.open_input_file(part) as f:
        return json.loads(f.read())


def resume(path: str, slot: int, count: int) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """slot, doc_id, piece, ids of `count` records from `slot` on, or as many as there are: each is read at its computed
    place, in order, and nothing before it. path: the folder of write_shards(), on any file system that pyarrow knows; how
    large its shards are stands in its manifest, also where they grew because there are more than MOST_SHARDS of them. A
    slot below 0 is an error."""
    if slot < 0:
        raise ValueError(f"no slot {slot}")
    files, root = pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)
    own = manifest(files, root)
    stride, shard_slots = own["stride"], own["shard_slots"]
    shards = sorted(f.path for f in files.get_file_info(pa.fs.FileSelector(root)) if f.base_name.startswith("part-"))
    while count > 0 and slot < own["total"]:
        with files.open_input_file(shards[slot // shard_slots]) as f:
            f.seek(slot % shard_slots * stride)
            for _ in range(min(count, shard_slots - slot % shard_slots, own["total"] - slot)):
                record = f.read(stride)
                doc, known, piece, n = struct.unpack_from(HEADER, record)
                yield slot, doc if known else None, piece, np.frombuffer(record, "<u2", n, HEADER_SIZE)
                slot, count = slot + 1, count - 1


def read_shards(spark: SparkSession, path: str, length: int = 512) -> DataFrame:
    """doc_id, piece, ids of each record, in the order of the slots within a shard."""
    stride = HEADER_SIZE + 2 * length + 1
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                parts = [struct.unpack_from(HEADER, content, at) for at in range(0, len(content), stride)]
                ids = [np.frombuffer(content, "<u2", p[3], at * stride + HEADER_SIZE).astype(np.int32) for at, p in enumerate(parts)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(parts)), pa.array(range(len(parts)), pa.int64()), pa.array([p[0] if p[1] else None for p in parts], pa.int64()), pa.array([p[2] for p in parts], pa.int32()), pa.array(ids, pa.list_(pa.int32()))], names=["file", "at", "doc_id", "piece", "ids"])

    return files.mapInArrow(run, "file string, at bigint, doc_id bigint, piece int, ids array<int>")
