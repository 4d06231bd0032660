"""A change feed of leaderboards by nation, kept by two chained transformWithState operators in Structured Streaming.

Lines come in batches, each with whole arrival days. Before the first shuffle the tasks that read a batch sum what one item
of one nation has on one day, and pack a shard's sums into one row: a hot item is a few sums, however many lines it has.

1. Shards, keyed by nation and a bucket of the item: the state is the running revenue of each item of the shard. Day by day
   the shard's own ten best are found, and what changed among them goes on. A nation of any share of all lines is dealt
   over all its buckets.
2. Mergers, keyed by nation: the state is the shards' boards, so ten items a bucket at most. An item is in one shard only,
   so the nation's ten best are among the shards' ten best, and the board is exact. What changed in it is the feed.

The query stops after each batch and starts anew on the same checkpoint, which holds the state; a lost executor's state is
loaded again from there. The feed is written by the file sink, once for each batch.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .common import release, shared_dir, stored

#: buckets: a shard's memory is 16 bytes for each of its items, so a nation's items over BUCKETS; a merger's is TOP items a
#: bucket, whatever the input. PARTITIONS: each has two stores, which every start opens anew.
PARTITIONS = 64
TOP, BUCKETS, LATENESS, CHUNK = 10, 32, 15, 1 << 20
#: One sum of a shard's packet; one change of a shard's board (on: whether the item is on it afterwards).
SUM = np.dtype([("day", "<i8"), ("item", "<i8"), ("cents", "<i8")])
CHANGE = np.dtype([("day", "<i8"), ("item", "<i8"), ("cents", "<i8"), ("on", "?")])
FEED = "nation_id int, arrival_day bigint, item_id bigint, batch int, change string, old_rank int, new_rank int, revenue bigint"
#: Settings of the session that streams. A start ends after one batch, so its stores are closed when they commit, and many
#: small stores share one cache and hold no files in advance, and write none but their own; a batch's files are listed by
#: few tasks.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.totalMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """nation_id, bucket, sums (SUM records) of lines: one row for each shard of up to CHUNK lines."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK:
            yield from _packed(held)
            held = []
    yield from _packed(held)
    held.clear()
    release()


def _packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not sum(b.num_rows for b in held):
        return
    summed = pa.Table.from_batches(held).group_by(["nation_id", "bucket", "arrival_day", "item_id"], use_threads=False).aggregate([("cents", "sum")])
    nation, bucket = summed.column("nation_id").to_numpy(), summed.column("bucket").to_numpy()
    own = np.empty(len(nation), SUM)
    own["day"], own["item"], own["cents"] = (summed.column(c).to_numpy() for c in ("arrival_day", "item_id", "cents_sum"))
    order = np.lexsort((bucket, nation))
    nation, bucket, own = nation[order], bucket[order], own[order]
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(nation) != 0) | (np.diff(bucket) != 0)]))
    parts = [x.tobytes() for x in np.split(own, edges[1:])]
    yield pa.RecordBatch.from_arrays([pa.array(nation[edges], pa.int32()), pa.array(bucket[edges], pa.int32()), pa.array(parts, pa.binary())], names=["nation_id", "bucket", "sums"])


def best(items: np.ndarray, revenue: np.ndarray, top: int) -> np.ndarray:
    """The places of the `top` highest positive revenues, highest first, ties to the smaller item."""
    least = max(1, int(np.partition(revenue, -top)[-top])) if len(revenue) > top else 1
    among = np.flatnonzero(revenue >= least)
    return among[np.lexsort((items[among], -revenue[among]))[:top]]


def by_day(rows: np.ndarray) -> list[np.ndarray]:
    rows = rows[np.argsort(rows["day"], kind="stable")]
    return np.split(rows, np.flatnonzero(np.diff(rows["day"])) + 1)


def held(items: np.ndarray, revenue: np.ndarray) -> bytes:
    """Items in order, as differences, and revenues: what a state keeps."""
    return zlib.compress(np.diff(items, prepend=0).tobytes() + revenue.tobytes(), 1)


def unheld(kept: tuple[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """Items and revenues of a state, none of none."""
    first, second = np.split(np.frombuffer(zlib.decompress(kept[0]) if kept else b"", np.int64), 2)
    return np.cumsum(first), second.copy()


class Shard(StatefulProcessor):
    """nation_id, changes (CHANGE records) of one bucket of a nation's items."""

    def __init__(self, top: int) -> None:
        self.top = top

    def init(self, handle) -> None:
        self.kept = handle.getValueState("revenues", "items binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        sums = np.frombuffer(b"".join(bytes(r.sums) for r in rows), SUM)
        items, revenue = unheld(self.kept.get())
        every = np.union1d(items, sums["item"])
        grown = np.zeros(len(every), np.int64)
        grown[np.searchsorted(every, items)] = revenue
        items, revenue, changes = every, grown, []
        was = {k: int(revenue[k]) for k in best(items, revenue, self.top).tolist()}
        for day in by_day(sums):
            np.add.at(revenue, np.searchsorted(items, day["item"]), day["cents"])
            now = {k: int(revenue[k]) for k in best(items, revenue, self.top).tolist()}
            changes += [(day["day"][0], items[k], r, True) for k, r in now.items() if was.get(k) != r]
            changes += [(day["day"][0], items[k], revenue[k], False) for k in was if k not in now]
            was = now
        self.kept.update((held(items, revenue),))
        if changes:
            yield Row(nation_id=key[0], changes=np.array(changes, CHANGE).tobytes())

    def close(self) -> None:
        pass


class Merger(StatefulProcessor):
    """The feed's rows of one nation, from the changes of its shards' boards."""

    def __init__(self, top: int) -> None:
        self.top = top

    def init(self, handle) -> None:
        self.kept = handle.getValueState("boards", "items binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        changes = np.frombuffer(b"".join(bytes(r.changes) for r in rows), CHANGE)
        own = dict(zip(*(x.tolist() for x in unheld(self.kept.get())), strict=True))
        was = self._ranks(own)
        for day in by_day(changes):
            gone = {}
            for _, item, cents, on in day.tolist():
                if on:
                    own[item] = cents
                else:
                    gone[item] = cents
                    own.pop(item, None)
            now = self._ranks(own)
            for item in sorted(was.keys() | now.keys()):
                old, new = was.get(item), now.get(item)
                if old != new:
                    change = "enter" if old is None else "exit" if new is None else "move"
                    yield Row(nation_id=key[0], arrival_day=int(day["day"][0]), item_id=item, change=change, old_rank=old, new_rank=new, revenue=own[item] if item in own else gone[item])
            was = now
        items = np.array(sorted(own), np.int64)
        self.kept.update((held(items, np.array([own[i] for i in items.tolist()], np.int64)),))

    def _ranks(self, own: dict[int, int]) -> dict[int, int]:
        items, revenue = np.array(list(own), np.int64), np.array(list(own.values()), np.int64)
        return {int(items[k]): rank for rank, k in enumerate(best(items, revenue, self.top), 1)}

    def close(self) -> None:
        pass


def change_feed(lines: DataFrame, top: int = TOP, buckets: int = BUCKETS, lateness: int = LATENESS, partitions: int = PARTITIONS) -> DataFrame:
    """nation_id, arrival_day, item_id, batch, change (enter, exit, move), old_rank, new_rank (null: off the board), revenue
    (afterwards) of every item whose rank on its nation's board differs from the board before; the first is empty.

    lines: batch (int), nation_id (int), item_id (bigint), event_day, arrival_day, cents (bigint); other columns are not
    read. Batches are fed by their numbers; an arrival day's lines are all in one batch, and days don't go back from batch
    to batch. Lines whose event_day + lateness is below the largest event_day of all earlier batches are dropped, and so
    are lines without nation_id or item_id, but these count for that largest day. Repeated rows count each; null cents
    are 0; a line without batch, event_day or arrival_day is dropped. No lines give an empty feed. partitions: of the state at
    most, or the session's shuffle partitions if these are fewer; a large cluster wants more, as many as there are shards.

    Everything is under a new folder of spark.checkpoint.dir: the batches, published one by one into the streamed folder,
    the checkpoint, and the feed."""
    spark = lines.sparkSession
    folder = f"{shared_dir(spark)}/navnet/leaderboard-{uuid.uuid4().hex}"
    columns = ["nation_id", "item_id", "event_day", "arrival_day", "cents", "batch"]
    own = lines.where("batch is not null and event_day is not null and arrival_day is not null").select(*columns)
    own.write.partitionBy("batch").parquet(f"{folder}/cut")
    # The cut batches are the table: one number of each comes to the driver.
    latest = spark.read.schema(own.schema).parquet(f"{folder}/cut").groupBy("batch").agg(F.max("event_day").alias("day")).orderBy("batch").collect()

    session = spark.newSession()
    for name, value in {"spark.sql.shuffle.partitions": str(min(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))), **STREAMING}.items():
        session.conf.set(name, value)
    seen = None
    for batch, day in latest:
        _publish(spark, f"{folder}/cut", f"{folder}/lines", f"batch={batch}")
        fed = session.readStream.schema(own.schema).parquet(f"{folder}/lines")
        kept = fed.where(F.col("nation_id").isNotNull() & F.col("item_id").isNotNull() & (F.lit(True) if seen is None else F.col("event_day") + lateness >= seen))
        shard = F.pmod(F.xxhash64("item_id"), F.lit(buckets)).cast("int").alias("bucket")
        sums = kept.select("nation_id", shard, "arrival_day", "item_id", F.coalesce("cents", F.lit(0)).alias("cents")).mapInArrow(packets, "nation_id int, bucket int, sums binary")
        boards = sums.groupBy("nation_id", "bucket").transformWithState(Shard(top), "nation_id int, changes binary", "Append", "None")
        feed = boards.groupBy("nation_id").transformWithState(Merger(top), FEED.replace(" batch int,", ""), "Append", "None")
        query = (
            feed.withColumn("batch", F.lit(batch)).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/feed")
        )
        query.awaitTermination()
        seen = day if seen is None else max(seen, day)
    if not latest:
        return spark.createDataFrame([], FEED)
    names = [f.split()[0] for f in FEED.split(", ")]
    return spark.read.schema(FEED).parquet(f"{folder}/feed").select(*names)


def _publish(spark, source: str, folder: str, name: str) -> None:
    """Move a batch's folder from source into the streamed folder, under its own name: into an empty folder itself, some file
    systems would move its files."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    if not files.rename(path(f"{source}/{name}"), path(f"{folder}/{name}")):
        raise OSError(f"can't move {source}/{name} to {folder}")


def sale_batches(sale_lines: DataFrame, vendors: DataFrame, items: DataFrame, batches: int = 8, first_day: int = 19723, days: int = 180) -> DataFrame:
    """change_feed()'s lines of a shop's sale lines: nation_id of the vendor, item_id (null without a row in items), cents,
    and the days and the batch that a hash of the line gives. Lines that arrive before first_day are in the first batch.

    An id that stands in vendors or items more than once counts with its smallest nation_id or price. The two are written
    once by id; both joins are by shuffle and let Spark split hot ids."""
    nation = stored(vendors.where("vendor_id is not null").groupBy("vendor_id").agg(F.min("nation_id").alias("_nation")).withColumnRenamed("vendor_id", "_vendor"), "vendors")
    price = stored(items.where("item_id is not null").groupBy("item_id").agg(F.min("price").alias("_price")).withColumnRenamed("item_id", "_item"), "items")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    ids = [F.lit(",") if k % 2 else text(("sale_id", "item_id", "vendor_id", "line_no")[k // 2]) for k in range(7)]
    own = sale_lines.select("vendor_id", "item_id", "quantity", "amount", "flag", "shipped_at", F.crc32(F.concat(*ids)).alias("_h"))
    event = F.coalesce(F.unix_date(F.col("shipped_at").cast("date")).cast("bigint"), F.lit(first_day) + F.col("_h") % 150)
    own = own.withColumn("event_day", event).withColumn("arrival_day", F.col("event_day") + F.col("_h") % 7 + F.when(F.col("_h") % 5 == 0, 20).otherwise(0))
    batch = F.least(F.lit(batches), F.greatest(F.lit(1), 1 + F.floor((F.col("arrival_day") - first_day) * batches / days))).cast("int")
    whole = lambda c: F.floor(100 * c.cast("double") + 0.5).cast("double")
    cents = F.coalesce(whole(F.col("amount")), F.col("quantity") * whole(F.col("_price")), F.lit(0.0))
    found = own.join(nation, own["vendor_id"] == nation["_vendor"], "left").join(price, own["item_id"] == price["_item"], "left")
    signed: Column = F.when(F.col("flag") == "swapped", -cents).otherwise(cents).cast("bigint")
    return found.select(F.col("_nation").cast("int").alias("nation_id"), F.col("_item").cast("bigint").alias("item_id"), "event_day", "arrival_day", signed.alias("cents"), batch.alias("batch"))
