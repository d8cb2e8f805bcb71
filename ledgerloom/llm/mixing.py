"""Mixing sources to target weights: budgets by water-filling, documents by length through a bounded knapsack."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, durable, fresh

#: Places that the documents of one source and length are dealt over.
SALTS = 64
#: Words that are left to the knapsack at most, besides one document.
EXACT = 1 << 14


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = 0) -> np.ndarray:
    """How many documents of each length to take so that their words come to budget, or as near below as any choice can
    come after the proportional part. 0 <= result <= counts.

    Each length gets its share, rounded down; long documents fill up to EXACT words from the end; a bounded knapsack
    over the lengths that have documents left fits the rest, in a seeded order.
    """
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), dtype=np.int64)
    if total <= 0 or budget <= 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take = np.array([int(c) * int(budget) // total for c in counts], dtype=np.int64)
    left = int(budget - (take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= EXACT:
            break
        if lengths[i] > 0 and (k := min(int(counts[i] - take[i]), (left - EXACT) // int(lengths[i]))) > 0:
            take[i] += k
            left -= k * int(lengths[i])
    parts: list[tuple[int, int, int]] = []  # length's place, documents, words
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        n, size, k = min(int(counts[i] - take[i]), left // max(1, int(lengths[i]))), int(lengths[i]), 1
        while size > 0 and n > 0:
            parts.append((int(i), min(k, n), min(k, n) * size))
            n, k = n - min(k, n), 2 * k
    reach, by = np.zeros(left + 1, dtype=bool), np.full(left + 1, -1, dtype=np.int64)
    reach[0] = True
    for p, (_, _, words) in enumerate(parts):
        if reach[left]:
            break
        new = np.flatnonzero(reach[: left + 1 - words] & ~reach[words:]) + words
        by[new], reach[new] = p, True
    at = int(np.flatnonzero(reach)[-1])
    while at > 0:
        i, n, words = parts[by[at]]
        take[i] += n
        at -= words
    return take


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size", ignore_index=True)
    goal, whole = int(np.floor(pdf["target"].iloc[0])), int(pdf["source_size"].iloc[0])
    copies = goal // whole if whole else 0
    pdf["base"] = copies
    pdf["quota"] = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), goal - copies * whole)
    return pdf[["source", "size", "base", "quota"]]


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) with weight and target: sources by code point, null last, weigh as weights say, again and
    again; they share `share` of all sizes; none gets over `most` times its size, the excess being reshared by weight.

    That is water-filling, whose level comes in closed form from running sums over sources ordered by size over weight.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    s = s.withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"])
    return s.select("source", "source_size", "weight", F.when(F.col("ratio") <= F.col("level"), F.col("cap")).otherwise(F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 11) -> DataFrame:
    """One row for each row of docs: id, source, size (words), source_size, target, copies, taken (copies * size).

    Only (id, source, size) leaves the scan. Documents are counted by (source, size, salt); each source's counts by
    size - as many rows as it has lengths, whatever its documents - go to one task, which fits the budget; the quota of
    a length is dealt to its salts in order, and within a salt documents are ranked by a seeded hash of their id.

    Null text has size 0, null source is a source. Rows that repeat an id are documents of their own; ties in the hash
    go by id and then by any order, as such rows are alike. A source without words has target 0 and nothing taken.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")
    rows = durable(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(SALTS)).cast("int").alias("salt")), "mix-sizes")
    by_salt = durable(rows.groupBy("source", "size", "salt").agg(F.count("*").alias("n")), "mix-counts")
    by_size = by_salt.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = durable(targets(by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, most), "mix-targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    lengths = by_size.join(sources, same(by_size, sources)).select(by_size["source"], "size", "n", "source_size", "target")
    quota = lengths.groupBy("source").applyInPandas(_fit_source, "source string, size long, base long, quota long")
    cum = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    salted = by_salt.withColumn("before", F.coalesce(F.sum("n").over(cum), F.lit(0)))
    part = salted.join(quota, same(salted, quota) & (salted["size"] == quota["size"])).select(
        salted["source"].alias("q_source"), salted["size"].alias("q_size"), F.col("salt").alias("q_salt"), "base", F.greatest(F.lit(0), F.least("n", F.col("quota") - F.col("before"))).alias("more")
    )
    part = part.join(sources.select(F.col("source").alias("s_source"), "source_size", "target"), F.col("q_source").eqNullSafe(F.col("s_source"))).drop("s_source")
    rank = F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy(F.xxhash64("id", F.lit(seed + 1)), "id"))
    out = rows.withColumn("rank", rank).join(part, rows["source"].eqNullSafe(F.col("q_source")) & (rows["size"] == F.col("q_size")) & (rows["salt"] == F.col("q_salt")))
    copies = F.col("base") + (F.col("rank") <= F.col("more")).cast("long")
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: the rows of docs, with all their columns, each as often as mix() takes it.

    Rows that repeat an id in one source and size get their copies together: ranks within them are matched one by one.
    """
    t_id, t_source, t_size, t_copies, k, own, n, copy = fresh(docs, "t_id", "t_source", "t_size", "t_copies", "k", "own_size", "n", "copy")
    taken = mix(docs, id_col, text_col, source_col, **how).select(F.col(id_col).alias(t_id), F.col(source_col).alias(t_source), F.col("size").alias(t_size), F.col("copies").alias(t_copies))
    taken = taken.withColumn(k, F.row_number().over(Window.partitionBy(t_id, t_source, t_size).orderBy(F.desc(t_copies)))).where(F.col(t_copies) > 0)
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")
    mine = docs.withColumn(own, size)
    mine = mine.withColumn(n, F.row_number().over(Window.partitionBy(id_col, source_col, own).orderBy(F.xxhash64(text_col))))
    both = mine.join(taken, mine[id_col].eqNullSafe(F.col(t_id)) & mine[source_col].eqNullSafe(F.col(t_source)) & (F.col(own) == F.col(t_size)) & (F.col(n) == F.col(k)))
    return both.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(t_copies).cast("int")))).select(*docs.columns)
