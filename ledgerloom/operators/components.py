"""Connected components by alternating contraction, with lineage cut in the shared folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a local master gets a temporary folder; on a cluster that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        at = spark.sparkContext.getCheckpointDir()
    return at


def cut(df: DataFrame) -> DataFrame:
    """df from a checkpoint in the shared folder: computed once, whatever reads it, and safe from lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: A key with over one in so many of the rows is hot. No more keys than that can be, which bounds what is broadcast.
HOT = 1000


def _to_smallest(rows: DataFrame, keyed: DataFrame, most: int) -> DataFrame:
    """rows (u, v) with m, the smallest of u and its partners in keyed. Where u is hot, its rows stay where they are and m
    comes to them; the others are shuffled. most: a bound of keyed's rows."""
    low = keyed.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
    hot = F.broadcast(low.where(F.col("n") > most // HOT).drop("n"))
    cold = low.where(F.col("n") <= most // HOT).drop("n")
    return rows.join(hot, "u").unionByName(rows.join(hot, "u", "left_anti").join(cold, "u"))


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for each id on an edge (a, b); component is its smallest id.

    Each round points every neighbour that is larger at a node's smallest neighbour, then does the same among smaller
    ones. It ends when a round changes nothing.
    """
    state = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = state(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = cut(_to_smallest(both.where("v > u"), both, 2 * seen[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        pairs = F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        e = cut(_to_smallest(e, e, 2 * seen[0]).select(pairs).where("u <> v").distinct())
        now = state(e)
        if now == seen:
            roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
