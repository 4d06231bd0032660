"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of [A-Z] as small letters, everything else as it is.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Folders that stored() wrote since the innermost settled() began; None outside.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else (tests, one machine) one below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to a table of its own in the shared folder and read it back: later steps start from there, also after
    an executor is lost, and what made df runs once."""
    path = f"{shared_dir(df.sparkSession)}/navnet/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (paths := _written.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """stored(make()). The tables that make() stored on the way are deleted when this one is written: nothing reads them
    any more, and a lost executor's rows are read from this table again."""
    token = _written.set(paths := [])
    try:
        df = make()
    finally:
        _written.reset(token)
    out = stored(df, name)
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return out


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df with the column `name`: the place from 0 of each row in the table's order.

    Of files as read, that is the order in which one write made them: by the number in a file's name, then by row (a scan
    deals files to tasks by size, so its partitions don't tell). Of anything else, it is the order of the partitions."""
    if df._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation":
        file = F.col("_metadata.file_name")
        part = F.struct(F.regexp_extract(file, r"part-(\d+)", 1).try_cast("bigint").alias("number"), file.alias("file"))
        rows = df.select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_own"))
    else:
        rows = stored(df.withColumn("_id", F.monotonically_increasing_id()), "numbered")
        rows = rows.withColumns({"_part": F.shiftright("_id", 33), "_own": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")
    # One row for each file or partition: the running sum is over these alone.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_own")).drop("_part", "_own", "_before")


def slices(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about `most` bytes of text at most, or one row: what a task holds at once is bounded, whatever
    the texts' sizes."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype("int64")
    part = (sizes.cumsum() - sizes) // most
    at = 0
    for n in np.unique(part, return_counts=True)[1].tolist():
        yield batch.slice(at, n)
        at += n


def release() -> None:
    """Gives the memory that this Python worker holds free back to the machine: the worker idles while other stages run."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """df.mapInArrow of a function from one batch to a dict of columns; batches with texts come in slices."""
    names = [c.split()[0] for c in _fields(schema)]
    types = _arrow_types(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in (slices(b) if "text" in b.schema.names else [b])):
            if batch.num_rows and (out := fn(batch)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in zip(names, types, strict=True)], names=names)
        release()

    return df.mapInArrow(run, schema)


def _fields(schema: str) -> list[str]:
    out, depth = [""], 0
    for ch in schema:
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return [x.strip() for x in out]


def _arrow_types(spark: SparkSession, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields]
