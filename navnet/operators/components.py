"""Connected components of an edge table by contraction (GRA-04)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rounds are logarithmic in a component's size; more than this can't be needed.
ROUNDS = 200


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """node, component of every node of edges; component is the smallest node that it reaches.

    Each round points every node at the smallest of itself and its neighbours, then puts these in the edges' places, so edges
    shrink with every round: what a round costs is in proportion to what is left. Where that takes off less than half of them
    (long chains in the nodes' order), the next round goes by a hash of the nodes, which halves a chain in the mean. In the
    end the pointers are followed from the last round's back. Rounds are written to the shared folder: a lost executor costs
    one round. Edges with a null end are left out; repeated edges and self-loops don't matter; an empty table has no
    component.
    """
    spark = edges.sparkSession
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    path = f"{base}/navnet/components-{uuid.uuid4().hex}"
    rest = _stored(edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("a"), F.col(dst).alias("b")), f"{path}/links")
    rounds, many, hashed, by_hash = [], rest.count(), False, False
    while many or not rounds:
        if len(rounds) == ROUNDS:
            raise RuntimeError(f"edges are left after {ROUNDS} rounds")
        near = rest.union(rest.select("b", "a"))
        if by_hash:
            rank = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c).alias("h"), F.col(c).alias("to"))
            to = near.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("m")).select("node", F.least(rank("node"), "m")["to"].alias("to"))
        else:
            to = near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("to"))
        to = _stored(to, f"{path}/to-{len(rounds)}")
        rounds.append(to)
        a, b = to.select(F.col("node").alias("a"), F.col("to").alias("x")), to.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = rest.where("a <> b").join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        rest = _stored(moved, f"{path}/links-{len(rounds)}")
        before, many = many, rest.count()
        hashed, by_hash = hashed or by_hash, not by_hash and 2 * many > before
    labels = rounds.pop().withColumnRenamed("to", "component")
    while rounds:
        to = rounds.pop()
        on = to.join(labels.withColumnRenamed("node", "to"), "to", "left")
        labels = on.select("node", F.coalesce("component", "to").alias("component"))
    labels = _stored(labels, f"{path}/labels")
    if hashed:  # what is left of a part is one of its nodes, not the smallest
        least = labels.groupBy("component").agg(F.min("node").alias("least"))
        labels = _stored(labels.join(least, "component").select("node", F.col("least").alias("component")), f"{path}/least")
    return labels
