"""Candidate joins: bands as equi joins, disjunctions as unions, presolved and blocked pairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .components import cut
from .shaping import top_by, unused


#: Columns of cents on the left and right, tolerance as a share, and as cents: what amount_band() takes.
Amounts = tuple[str, str, float, int]


def _keyed(few: DataFrame, many: DataFrame, few_step: Column, many_step: Column, radius: int, few_cents: str | None, many_cents: str | None, tolerance: tuple[float, int]) -> DataFrame:
    """few joined to many where steps are at most `radius` apart, and amounts' bands at most one, as an equal join."""
    step, name = unused("step", few, many), unused("band", few, many)
    few, many, on = few.withColumn(step, F.explode(F.sequence(few_step - radius, few_step + radius))), many.withColumn(step, many_step), [step]
    if few_cents and many_cents:
        band = S.amount_band(few_cents, *tolerance)
        few, many = few.withColumn(name, F.explode(F.sequence(band - 1, band + 1))), many.withColumn(name, S.amount_band(many_cents, *tolerance))
        on.append(name)
    return few.join(many, on).drop(*on)


def week_band_join(left: DataFrame, right: DataFrame, left_date: str, right_date: str, radius: int, residual: Column | None = None, how_many: str = "left", amounts: Amounts | None = None) -> DataFrame:
    """Pairs whose dates' weeks are at most `radius` apart and that meet the residual.

    One side is repeated for each week in reach, 2 * radius + 1 rows, and joined to the other on equal weeks, which is a
    hash or sort-merge join that adaptive execution splits where a week is busy; a band condition alone would be a
    nested loop. With amounts, whose tolerance the residual must not exceed, it is repeated for three amount bands as
    well: a week then holds as many pairs as amounts agree, not all of its rows squared. how_many: the side to repeat,
    best the smaller one.
    """
    lc, rc, *tolerance = amounts or (None, None, 0.0, 0)
    if how_many == "left":
        out = _keyed(left, right, S.week(left_date), S.week(right_date), radius, lc, rc, tuple(tolerance))
    else:
        out = _keyed(right, left, S.week(right_date), S.week(left_date), radius, rc, lc, tuple(tolerance))
    return out if residual is None else out.where(residual)


def any_equal_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], keys: list[str], residual: Column | None = None) -> DataFrame:
    """Pairs with one of several columns equal: a union of equi joins, each pair once by its keys, instead of a nested loop."""
    parts = [left.join(right, F.col(a) == F.col(b)) for a, b in pairs]
    if residual is not None:
        parts = [p.where(residual) for p in parts]
    return reduce(DataFrame.unionByName, parts).dropDuplicates(keys)


def presolved(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], left_amount: str, right_amount: str, left_date: str, right_date: str, currencies: tuple[str, str], days: int = 90, cents: int = 1) -> DataFrame:
    """Exact pairs: keys equal, amounts within a cent, currencies equal or missing, dates near."""
    cond = reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in on])
    gap = F.abs(S.cents(left_amount) - S.cents(right_amount))
    return left.join(right, cond & (gap <= cents) & S.currency_ok(*currencies) & (S.days_apart(left_date, right_date) <= days))


def block_candidates(left: DataFrame, right: DataFrame, on: tuple[str, str], left_amount: str, right_amount: str, left_date: str, right_date: str, currencies: tuple[str, str], days: int = 90, most: float = 1.15) -> DataFrame:
    """Pairs of one key whose right amount is from 0 to `most` times the left one, dates near, currencies equal or missing.

    Windows of `days` days are keys beside it, so that a key with a long history makes pairs within its windows only.
    """
    window = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / days).cast("int")
    mine, theirs = unused("left_window", left, right), unused("right_window", left, right)
    left, right = left.withColumn(mine, F.explode(F.sequence(window(left_date) - 1, window(left_date) + 1))), right.withColumn(theirs, window(right_date))
    cond = (F.col(on[0]) == F.col(on[1])) & (F.col(mine) == F.col(theirs)) & (F.col(right_amount) >= 0) & (F.col(right_amount) <= F.col(left_amount) * most)
    return left.join(right, cond & S.currency_ok(*currencies) & (S.days_apart(left_date, right_date) <= days)).drop(mine, theirs)


def wide_block_join(left: DataFrame, right: DataFrame, left_date: str, right_date: str, residual: Column, days: int = 120, amounts: Amounts | None = None) -> DataFrame:
    """Keyless pairs with dates at most `days` apart: both dates fall into windows of that many days, so pairs lie in the
    same window or the next; amounts, if given, in the same band or the next; the residual decides. No cross join."""
    window = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / days).cast("int")
    lc, rc, *tolerance = amounts or (None, None, 0.0, 0)
    near = _keyed(left, right, window(left_date), window(right_date), 1, lc, rc, tuple(tolerance))
    return near.where((S.days_apart(left_date, right_date) <= days) & residual)


def bucket_prefilter(pairs: DataFrame, left_amount: str, right_amount: str, left_date: str, right_date: str, currencies: tuple[str, str], months: int = 4, band: float = 0.03) -> DataFrame:
    """Of pairs, those of one currency (missing: USD), at most `months` months apart, right amount in the left's band."""
    apart = F.abs((F.year(left_date) - F.year(right_date)) * 12 + F.month(left_date) - F.month(right_date))
    low, high = F.floor(F.col(left_amount) * (1 - band)), F.ceil(F.col(left_amount) * (1 + band))
    return pairs.where(S.currency_ok(*currencies, how="default") & (apart <= months) & F.round(right_amount).between(low, high))


def best_by_classes(left: DataFrame, right: DataFrame, left_class: list[str], right_class: list[str], ids: list[str], pairs: Callable[[DataFrame, DataFrame], DataFrame], order: list[str], extra: list[str], k: int) -> DataFrame:
    """(left_key, best): for each class of left, rows that agree in left_class, its k best rows of right in order.

    A pair's columns `order` (ascending) and `extra` depend on the classes of its rows only, so pairs(left classes, right
    classes) makes them once a pair of classes, whatever number of rows these have. Of a right class the first k rows by
    ids stand for it, which are all that a list of k can hold, and of a left class's partners those stay before which
    there are less than k rows. best: structs of order, ids and extra, sorted by them.
    """
    key = F.struct(*right_class)
    rows = top_by(right.withColumn("right_key", key), ["right_key"], [F.asc(c) for c in ids], k, "nth")
    many = cut(rows.groupBy("right_key").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(*ids))).alias("rows")))
    c = pairs(left.select(*left_class).distinct(), many.select("right_key.*", "n"))
    c = c.select(F.struct(*left_class).alias("left_key"), key.alias("right_key"), "n", *order, *[x for x in extra if x not in order])
    w = Window.partitionBy("left_key").orderBy(*order)
    c = c.withColumn("nth", F.rank().over(w)).where(F.col("nth") <= k).drop("nth")
    c = c.withColumn("before", F.sum("n").over(w) - F.sum("n").over(Window.partitionBy("left_key", *order))).where(F.col("before") < k)
    one = F.transform("rows", lambda x: F.struct(*order, *[x[i].alias(i) for i in ids], *extra))
    c = c.join(many.select("right_key", "rows"), "right_key").select("left_key", one.alias("rows"))
    return c.groupBy("left_key").agg(F.slice(F.array_sort(F.flatten(F.collect_list("rows"))), 1, k).alias("best"))


def best_by_row(rows: DataFrame, best: DataFrame, named: DataFrame, row: str, number: str, k: int) -> DataFrame:
    """(row, pos, x): each row's k best, from its class's list and what its number names.

    rows: row, left_key, number; best: left_key, best, of structs with `no`; named: row and pairs x like best's structs, of
    rows whose number equals `no`. A number only raises a pair, so what is among the k best of a row is named or in the
    list. Rows that share their id share one ranking.
    """
    mine = named.groupBy(row).agg(F.collect_list("x").alias("named"))
    rows = rows.withColumn("copies", F.count("*").over(Window.partitionBy(row))).join(mine, row, "left").join(best, "left_key", "left").drop("left_key")  # lists come last and aren't shuffled
    rest = F.filter("best", lambda x: ~F.coalesce(x["no"] == F.col(number), F.lit(False)))
    merged = lambda c: F.slice(F.array_sort(c), 1, k)
    alone = F.when(F.col("named").isNull(), F.col("best")).otherwise(merged(F.concat(F.coalesce(rest, F.array()), "named")))
    again = rows.where("copies > 1").groupBy(row).agg(F.flatten(F.collect_list(rest)).alias("rest"), F.first("named").alias("named"))
    again = again.select(row, merged(F.concat("rest", F.coalesce("named", F.array()))).alias("best"))
    return rows.where("copies = 1").select(row, alone.alias("best")).unionByName(again).select(row, F.posexplode("best").alias("pos", "x"))
