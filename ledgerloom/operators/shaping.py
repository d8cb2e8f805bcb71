"""Row shaping: prefixes, missing columns, keyed dedup, unpivot, fan-out, details, sequences, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unused(name: str, *frames: DataFrame) -> str:
    """name, with as many underscores before it as it takes to be no column of the frames, in any case of letters."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def with_columns_of(df: DataFrame, names: list[str], kind: str = "string") -> DataFrame:
    """df with the missing ones of names as NULL."""
    have = set(df.columns)
    return df.withColumns({n: F.lit(None).cast(kind) for n in names if n not in have}) if set(names) - have else df


def only_existing(df: DataFrame, names: list[str]) -> DataFrame:
    have = set(df.columns)
    return df.select([n for n in names if n in have])


def require(df: DataFrame, names: list[str]) -> DataFrame:
    return df.dropna(subset=names)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in order, which should end in something unique."""
    n = unused("row_n", df)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(n, F.row_number().over(w)).where(F.col(n) == 1).drop(n)


def top_by(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """At most k rows a key, with their rank; planned as a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def unpivot_amounts(df: DataFrame, fields: list[str], source: str = "amount_field", value: str = "amount_value") -> DataFrame:
    """A row for each amount that isn't NULL nor, but for the first field, equal to the first one."""
    pair = unused("pair", df)
    out = df.withColumn(pair, F.explode(F.array(*[F.struct(F.lit(f).alias("s"), F.col(f).cast("double").alias("v")) for f in fields])))
    s, v = F.col(f"{pair}.s"), F.col(f"{pair}.v")
    keep = v.isNotNull() & ((s == fields[0]) | ~F.coalesce(v == F.col(fields[0]), F.lit(False)))
    return out.where(keep).withColumns({source: s, value: v}).drop(pair)


def collapse_headers(receipts: DataFrame, key: str, customer: str, fields: list[str]) -> DataFrame:
    """One row a receipt: of each field the value of the row with the smallest customer that has one, and all customers."""
    firsts = [F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.struct(F.col(customer).cast("string"), F.col(f)))).alias(f) for f in fields]
    return receipts.groupBy(key).agg(*firsts, F.array_sort(F.collect_set(F.col(customer).cast("string"))).alias("custnos"))


def fan_out(headers: DataFrame, customers: str = "custnos", to: str = "custno") -> DataFrame:
    return headers.withColumn(to, F.explode(customers)).drop(customers)


def numbered_id(df: DataFrame, id_col: str, by: list[str], to: str) -> DataFrame:
    """A content id made unique: id and the occurrence number among rows that share it."""
    w = Window.partitionBy(id_col).orderBy(*by)
    return df.withColumn(to, F.concat_ws("#", F.col(id_col), F.row_number().over(w).cast("string")))


def reattach(inputs: DataFrame, input_key: str, matches: DataFrame, match_left: str, match_right: str, other: DataFrame, other_key: str, prefixes: tuple[str, str]) -> DataFrame:
    """Every input row with its matches and the other side's columns, prefixed; NULLs where there is no match."""
    a, b = prefixed(inputs, prefixes[0]), prefixed(other, prefixes[1])
    out = a.join(matches, F.col(prefixes[0] + input_key) == F.col(match_left), "left")
    return out.join(b, F.col(match_right) == F.col(prefixes[1] + other_key), "left")


def with_unmatched(matched: DataFrame, everyone: DataFrame, keys: list[str], fill: dict[str, Column]) -> DataFrame:
    """matched, and a row for each of everyone that has none, other columns NULL but for fill."""
    rest = everyone.join(matched.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(rest.withColumns(fill), allowMissingColumns=True)


def sequence_ids(df: DataFrame, order: list[Column], to: str = "seq", buckets: int = 64) -> DataFrame:
    """Global numbers from 1 in order, without one task for all: ranges are sorted each for itself and offset by counts."""
    n = min(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.repartitionByRange(n, *order).withColumn("__p", F.spark_partition_id())
    parts = parts.withColumn("__k", F.row_number().over(Window.partitionBy("__p").orderBy(*order)))
    counts = parts.groupBy("__p").agg(F.count("*").alias("__c"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__b", F.coalesce(F.sum("__c").over(before), F.lit(0))).select("__p", "__b")
    return parts.join(F.broadcast(counts), "__p").withColumn(to, F.col("__b") + F.col("__k")).drop("__p", "__k", "__b")


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows by a seeded hash of the key: the same ones whatever the partitions."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row a key, NULLs last."""
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
