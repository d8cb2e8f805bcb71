"""A stored vector index, kept in step with a table: each distinct text is embedded once, ever."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import shared_folder
from ..operators.judge import Embedder, embedded


def scratch_path(spark: SparkSession) -> str:
    """A new place for a store in the folder that driver and executors share."""
    return f"{shared_folder(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def synchronise(spark: SparkSession, path: str, rows: DataFrame, embedder: Embedder, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """The index (id, vector) of rows, from the store at path (any file system that Spark reads), which gets what it lacks.

    The store is Parquet of (text_key, vector), text_key being the SHA-256 of the text; a NULL text is empty. Texts that aren't
    there are found by an anti join on the key, embedded and appended, so a row that is new, changed or back again costs
    one call at most, and one that is gone just isn't in the index. An append that fails leaves the store as it was.
    """
    keyed = rows.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("text_key", F.sha2("text", 256))
    wanted = keyed.select("text_key", "text").dropDuplicates(["text_key"])
    missing = wanted.join(spark.read.parquet(path).select("text_key"), "text_key", "left_anti") if exists(spark, path) else wanted
    embedded(missing, embedder, "text_key", "text").select(F.col("id").alias("text_key"), "vector").write.mode("append").parquet(path)
    return keyed.join(spark.read.parquet(path).dropDuplicates(["text_key"]), "text_key").select("id", "vector")
