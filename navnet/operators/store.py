"""Tables between the rounds of an iteration."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to a table of its own in the folder that driver and executors share (spark.checkpoint.dir; where that is
    unset, below the warehouse) and read back: what made it runs once, and a lost executor costs one step."""
    spark = df.sparkSession
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    path = f"{base}/navnet/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys over as many partitions as the session has, for rows of few bytes and much work, or many rows to come: by
    their bytes, Spark would put them together."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)
