"""Sum matching in the DataFrame API: whole sets, running sums, nearest sums, batches, shadowing, and sums of up to three."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .shaping import first_by, top_by


def nearest_field(target: str, sums: dict[str, str]) -> dict[str, Column]:
    """Columns field, matched_cents and diff_cents: of several sums the nearest to the target, the first named on ties."""
    gaps = [F.abs(F.col(c) - F.col(target)) for c in sums.values()]
    best = F.least(*gaps)
    field = reduce(lambda w, x: w.when(best == x[0], F.lit(x[1])), zip(gaps, sums), F).otherwise(F.lit(None))
    value = reduce(lambda w, x: w.when(best == x[0], F.col(x[1])), zip(gaps, sums.values()), F).otherwise(F.lit(None))
    return {"matched_field": field, "matched_cents": value, "diff_cents": value - F.col(target)}


def closest_sums(receipts: DataFrame, invoices: DataFrame, pct: float = 0.01) -> DataFrame:
    """Each receipt against the sum of all its customer's invoices, in the nearest of three fields (ties: amount, balance,
    invamt), kept within pct of its size. Invoices are summed once a customer before the join."""
    fields = {"amount": "amount_c", "balance": "balance_c", "invamt": "invamt_c"}
    per = invoices.where("custno IS NOT NULL").groupBy("custno").agg(*[F.sum(F.coalesce(S.cents(f), F.lit(0))).alias(c) for f, c in fields.items()], F.count("*").alias("line_count"))
    r = receipts.select("receipt_id", F.col("payercust_custno").alias("custno"), S.cents("amount").alias("r_cents")).where("receipt_id IS NOT NULL AND custno IS NOT NULL AND r_cents IS NOT NULL")
    out = r.join(per, "custno")
    out = out.withColumns(nearest_field("r_cents", fields))
    return out.where(F.abs("diff_cents") <= F.abs("r_cents") * pct).select("receipt_id", "custno", "r_cents", "matched_field", "matched_cents", "diff_cents", "line_count")


_BASES = {"sum_amount": "s_amount", "sum_invamt": "s_invamt", "sum_balance": "s_balance", "sum_app_amount": "s_app_amount"}


def dated_candidates(receipts: DataFrame, invoices: DataFrame, months_back: int, months_forward: int, hours: int | None = None) -> DataFrame:
    """Receipts with their customer's invoices that were created and modified on one day and dated inside the window."""
    r = receipts.select("receipt_id", "payercust_custno", S.cents("amount").alias("r_cents"), F.col("receipt_date").cast("date").alias("r_date"), *([F.col("created_on").alias("r_created")] if hours is not None and "created_on" in receipts.columns else []))
    r = r.dropna(subset=["receipt_id", "payercust_custno", "r_cents", "r_date"])
    bound = r.agg(F.add_months(F.min("r_date"), -months_back).alias("b_low"), F.add_months(F.max("r_date"), months_forward).alias("b_high"))
    i = invoices.dropna(subset=["custno", "invdate", "created_on", "app_date", "duedate"]).where(F.to_date("created_on") == F.to_date("modified_on"))
    i = i.join(F.broadcast(bound), F.col("invdate").between(F.col("b_low"), F.col("b_high"))).drop("b_low", "b_high")
    i = i.withColumns({f"c_{f}": F.coalesce(S.cents(f), F.lit(0)) for f in ("amount", "invamt", "balance", "app_amount")})
    span = months_back + months_forward + 1  # windows of so many months are keys beside the customer: a receipt reaches two of them
    month = lambda c: F.year(c) * 12 + F.month(c)
    r = r.withColumn("r_window", F.explode(F.sequence(F.floor((month("r_date") - months_back) / span), F.floor((month("r_date") + months_forward) / span))))
    i = i.withColumn("i_window", F.floor(month("invdate") / span))
    near = (F.col("custno") == F.col("payercust_custno")) & (F.col("r_window") == F.col("i_window")) & F.col("invdate").between(F.add_months("r_date", -months_back), F.add_months("r_date", months_forward))
    if "r_created" in r.columns:
        near = near & (F.abs(F.unix_timestamp(F.col("created_on").cast("timestamp")) - F.unix_timestamp(F.col("r_created").cast("timestamp"))) <= hours * 3600)
    return r.join(i, near).drop("r_window", "i_window")


def consistent(candidates: DataFrame) -> DataFrame:
    """Per receipt: sums, counts, and the one application date and due date; receipts with several are left out."""
    sums = [F.sum(f"c_{f}").alias(f"s_{f}") for f in ("amount", "invamt", "balance", "app_amount")]
    dates = [F.min("app_date").alias("app_date"), F.max("app_date").alias("last_app_date"), F.min("duedate").alias("due_date"), F.max("duedate").alias("last_due_date")]
    out = candidates.groupBy("receipt_id", "custno").agg(F.min("r_cents").alias("r_cents"), *sums, F.count("*").alias("line_count"), F.countDistinct("invno").alias("invno_count"), *dates)
    return out.where("app_date = last_app_date AND due_date = last_due_date").drop("last_app_date", "last_due_date")


def whole_set_sums(receipts: DataFrame, invoices: DataFrame, months_back: int = 12, months_forward: int = 1, cents: int = 1) -> DataFrame:
    """Receipts equal to the sum of all candidates in the nearest of four fields (ties: amount, invamt, balance, app_amount)."""
    out = consistent(dated_candidates(receipts, invoices, months_back, months_forward))
    return out.withColumns(nearest_field("r_cents", _BASES)).where(F.abs("diff_cents") <= cents)


def greedy_prefix_sums(receipts: DataFrame, invoices: DataFrame, months_back: int = 24, months_forward: int = 2, cents: int = 1, hours: int = 12) -> DataFrame:
    """Receipts equal to a running sum of candidates, newest first; of four fields the nearest, then by name.

    Each field's running sum takes rows while it stays within the receipt; one pass keeps all four, as one window serves
    them and rows order ties by invoice number.
    """
    cand = dated_candidates(receipts, invoices, months_back, months_forward, hours)
    ok = consistent(cand).select("receipt_id", "custno")
    w = Window.partitionBy("receipt_id", "custno").orderBy(F.desc("invdate"), F.desc("created_on"), "invno").rowsBetween(Window.unboundedPreceding, 0)
    fields = ("amount", "invamt", "balance", "app_amount")
    run = cand.join(ok, ["receipt_id", "custno"], "left_semi").withColumns({f"run_{f}": F.sum(f"c_{f}").over(w) for f in fields})
    limit = F.col("r_cents") + cents
    per = run.groupBy("receipt_id", "custno").agg(
        F.min("r_cents").alias("r_cents"), *[F.max(F.when(F.col(f"run_{f}") <= limit, F.col(f"run_{f}"))).alias(f"max_{f}") for f in fields], *[F.count(F.when(F.col(f"run_{f}") <= limit, 1)).alias(f"n_{f}") for f in fields]
    )
    long = per.select("receipt_id", "custno", "r_cents", F.explode(F.array(*[F.struct(F.lit(f"greedy_{f}").alias("basis"), F.col(f"max_{f}").alias("total"), F.col(f"n_{f}").alias("n")) for f in fields])).alias("x"))
    long = long.select("receipt_id", "custno", "r_cents", F.col("x.basis").alias("match_basis"), F.col("x.total").alias("greedy_cents"), F.col("x.n").alias("greedy_rows")).withColumn("diff_cents", F.abs(F.col("greedy_cents") - F.col("r_cents")))
    return first_by(long.where(F.col("diff_cents") <= cents), ["receipt_id", "custno"], [F.asc("diff_cents"), F.asc("match_basis")])


def shadowing(pairs: DataFrame) -> DataFrame:
    """pairs with open_shadowed: an open invoice version whose key is there as closed for the same receipt and customer."""
    w = Window.partitionBy("receipt_id", "custno", "inv_key")
    closed = F.max((F.coalesce(F.col("rcl_open_close"), F.lit("")) == "closed").cast("int")).over(w)
    return pairs.withColumn("open_shadowed", F.coalesce((F.col("rcl_open_close") == "open") & (closed == 1), F.lit(False)))


def shadow_rows(pairs: DataFrame, selected: DataFrame) -> DataFrame:
    """The shadowed open versions whose key was selected for the receipt, to be shown with the match."""
    return pairs.where("open_shadowed").select("receipt_id", "inv_row_id", "inv_key").distinct().join(selected.select("receipt_id", "inv_key").distinct(), ["receipt_id", "inv_key"], "left_semi")


def with_pool_size(pairs: DataFrame, key: str = "receipt_id") -> DataFrame:
    return pairs.withColumn("pool_n", F.count(F.lit(1)).over(Window.partitionBy(key)))


def cluster_scores(pairs: DataFrame) -> DataFrame:
    """How many of a receipt's candidates share a line's salesperson, area and modifier, as a score."""
    n = [F.count(F.lit(1)).over(Window.partitionBy("receipt_id", c)) for c in ("salespn", "salesarea", "modified_by")]
    return pairs.withColumn("cluster_score", sum((F.log1p(x) for x in n), F.lit(0.0)) / 8.0)


def batch_groups(pairs: DataFrame, unit: str = "day", k: int = 3) -> DataFrame:
    """Sums of a receipt's candidates by batch (salesperson, area, modifier, company, address, time), the k nearest to it.

    Of three fields the nearest counts (ties: invamt, amount, balance).
    """
    key = S.hash_key("salespn", "salesarea", "modified_by", S.norm_name("company"), S.norm_name("address"), S.batch_time(F.col("modified_on").cast("timestamp"), unit).cast("date"))
    fields = {"invamt": "s_invamt", "amount": "s_amount", "balance": "s_balance"}
    g = pairs.withColumn("grp_key", key).groupBy("receipt_id", "grp_key")
    g = g.agg(F.min("r_cents").alias("r_cents"), F.min("r_tol").alias("r_tol"), *[F.sum(F.coalesce(S.cents(f), F.lit(0))).alias(c) for f, c in fields.items()], F.count("*").alias("line_count"))
    g = g.withColumns(nearest_field("r_cents", fields)).withColumn("within_tol", F.abs("diff_cents") <= F.col("r_tol"))
    return top_by(g, ["receipt_id"], [F.desc("within_tol"), F.abs("diff_cents").asc(), F.desc("line_count"), F.asc("grp_key")], k, "set_rank")


def small_sums(edges: DataFrame, size: int = 3, groups: int = 30, absolute_cents: int = 1, relative: float = 0.002) -> DataFrame:
    """Groups of one, two or three candidates of a receipt whose amounts come to its own: edges (receipt_id, r_cents,
    inv_key, i_cents, cosine). All such groups are found, by joins of a receipt's own candidates on rising keys, so the
    caller's top-k bounds them; the best `groups` by mean cosine stay."""
    e = edges.where("i_cents > 0").select("receipt_id", "r_cents", "inv_key", "i_cents", "cosine")
    reach = F.greatest(F.lit(absolute_cents).cast("double"), F.abs("r_cents") * relative)
    one = e.where(F.abs(F.col("i_cents") - F.col("r_cents")) <= reach).select("receipt_id", "r_cents", F.array("inv_key").alias("keys"), F.col("i_cents").alias("total"), F.col("cosine").alias("mean_cosine"))
    parts = [one]
    a, b, c = (e.select("receipt_id", *(["r_cents"] if n == "a" else []), F.col("inv_key").alias(f"k{n}"), F.col("i_cents").alias(f"v{n}"), F.col("cosine").alias(f"c{n}")) for n in "abc")
    if size >= 2:
        two = a.join(b, "receipt_id").where((F.col("ka") < F.col("kb")) & (F.col("va") + F.col("vb") <= F.col("r_cents") + reach))
        hit = two.where(F.abs(F.col("va") + F.col("vb") - F.col("r_cents")) <= reach)
        parts.append(hit.select("receipt_id", "r_cents", F.array("ka", "kb").alias("keys"), (F.col("va") + F.col("vb")).alias("total"), ((F.col("ca") + F.col("cb")) / 2).alias("mean_cosine")))
    if size >= 3:
        three = two.join(c, "receipt_id").where((F.col("kb") < F.col("kc")) & (F.abs(F.col("va") + F.col("vb") + F.col("vc") - F.col("r_cents")) <= reach))
        parts.append(three.select("receipt_id", "r_cents", F.array("ka", "kb", "kc").alias("keys"), (F.col("va") + F.col("vb") + F.col("vc")).alias("total"), ((F.col("ca") + F.col("cb") + F.col("cc")) / 3).alias("mean_cosine")))
    out = reduce(DataFrame.unionByName, parts).withColumns({"mean_cosine": F.round("mean_cosine", 7), "members": F.array_join("keys", ",")})
    return top_by(out, ["receipt_id"], [F.desc("mean_cosine"), F.abs(F.col("total") - F.col("r_cents")).asc(), F.size("keys").asc(), F.asc("members")], groups, "group_rank")


def prefer_single(groups: DataFrame, score: str = "mean_cosine", margin: float = 0.08) -> DataFrame:
    """A receipt's best group, but its best single match if that is within margin of the best."""
    w = Window.partitionBy("receipt_id")
    best = F.max(score).over(w)
    g = groups.withColumn("__pick", ((F.size("keys") == 1) & (F.col(score) >= best - margin)).cast("int"))
    return first_by(g, ["receipt_id"], [F.desc("__pick"), F.desc(score), F.asc("members")]).drop("__pick")
