"""Exact duplicates by content sort, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, durable, fresh

#: Equal texts are dealt over so many places, so that a text that a third of all rows share is never one task's.
SALTS = 64
#: Splitters are sampled from so many leading characters and a hash, so that a sample is small whatever the texts' length.
PREFIX = 32


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space is one space; null counts as empty. Sampled splitters
    range-partition the normalised text (its prefix, a hash of it, a salt); an external sort by the whole text puts
    equals next to each other; comparing neighbours in full gives each salt's smallest id; salts meet by SHA-256 as
    small rows. Text crosses the network once.

    Of equal texts the row with the smallest id stays; null ids come last, and of rows that repeat an id one stays, so
    each group has exactly one kept row. keep_id is null only if all ids of a group are null. No rows in, no rows out.
    Other columns are ignored.
    """
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), f"[{SPACE}]+", " ")
    rows = (
        docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        .withColumn("head", F.substring("norm", 1, PREFIX))
        .withColumn("hash", F.xxhash64("norm"))
        .repartitionByRange("head", "hash", "salt")
    )
    same = Window.partitionBy("head", "hash", "norm", "salt").orderBy(F.col("id").asc_nulls_last())
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("id", "salt", F.sha2("norm", 256).alias("sha"), F.row_number().over(same).alias("n"), F.first("id").over(whole).alias("low"), F.count(F.lit(1)).over(whole).alias("size"))
    rows = durable(rows, "content-sort")
    group = Window.partitionBy("sha").orderBy(F.col("low").asc_nulls_last(), "salt")
    every = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lead = rows.where("n = 1").select("sha", "salt", F.first("low").over(every).alias("keep_id"), F.sum("size").over(every).alias("group_size"), (F.row_number().over(group) == 1).alias("first"))
    return rows.join(lead, ["sha", "salt"]).select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("first") & (F.col("n") == 1)).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with all its columns, but one row for each normalised text: that with the smallest id.

    A row is found again by its id and its text's SHA-256; rows that repeat both are the same in all that decides, and
    the first by their remaining columns stays.
    """
    kept_id, kept_sha, own, n = fresh(docs, "kept_id", "kept_sha", "own_sha", "n")
    kept = content_sort(docs, id_col, text_col).where("kept").select(F.col(id_col).alias(kept_id), F.col("text_sha256").alias(kept_sha))
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), f"[{SPACE}]+", " ")
    marked = docs.withColumn(own, F.sha2(norm, 256))
    stays = marked.join(kept, F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_sha)), "left_semi")
    order = Window.partitionBy(id_col, own).orderBy(*[F.xxhash64(c) for c in docs.columns])
    return stays.withColumn(n, F.row_number().over(order)).where(F.col(n) == 1).select(*docs.columns)
