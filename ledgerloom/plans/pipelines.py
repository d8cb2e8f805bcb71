"""Whole matching pipelines, from tables to every input row with its matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import scores as W
from ..operators import blocking, flow, judge, shaping, subset, sums


def receipt_headers(receipts: DataFrame, pct: float, floor_cents: int = 0, company: str = "payercust_company", address: str = "payercust_address1") -> DataFrame:
    """One row a receipt, that which tells most, typed and with its tolerance."""
    r = receipts.select(F.col("receipt_id").cast("string").alias("receipt_id"), S.cents("amount").alias("r_cents"), F.col("receipt_date").cast("date").alias("r_date"), S.norm_name(company).alias("r_name"), S.norm_name(address).alias("r_addr"))
    r = r.where("receipt_id IS NOT NULL AND r_cents IS NOT NULL AND r_date IS NOT NULL").withColumn("__q", S.richness("r_name", "r_addr"))
    r = shaping.first_by(r, ["receipt_id"], [F.desc("__q"), F.desc("r_cents"), F.desc("r_date"), F.asc("r_name"), F.asc("r_addr")]).drop("__q")
    return r.withColumn("r_tol", S.tolerance("r_cents", pct, floor_cents))


def remittance_headers(remittances: DataFrame) -> DataFrame:
    m = remittances.select("document_id", "remitreceipt_id", F.col("total_remittance_amount").cast("double").alias("total_remittance_amount"), F.col("total_amount_paid").cast("double").alias("total_amount_paid"), F.col("remittance_date").cast("date").alias("m_date"), S.norm_name("payer_name").alias("m_name"), S.norm_name("payer_address").alias("m_addr"))
    m = m.where("m_date IS NOT NULL").withColumn("__q", S.richness("m_name", "m_addr"))
    m = shaping.first_by(m, ["document_id", "remitreceipt_id"], [F.desc("__q"), F.asc("m_date"), F.desc("total_remittance_amount"), F.desc("total_amount_paid"), F.asc("m_name"), F.asc("m_addr")]).drop("__q")
    m = shaping.unpivot_amounts(m, ["total_remittance_amount", "total_amount_paid"])
    return m.withColumn("m_cents", S.cents("amount_value"))


def _features(pairs: DataFrame, left: tuple[str, str, str, str], right: tuple[str, str, str, str]) -> DataFrame:
    (lc, ld, ln, la), (rc, rd, rn, ra) = left, right
    return pairs.withColumns({"amt_diff": F.abs(F.col(lc) - F.col(rc)), "day_diff": S.days_apart(ld, rd), "name_sim": S.similarity(ln, rn), "addr_sim": S.similarity_or_null(la, ra)})


def receipt_remittance_scores(receipts: DataFrame, remittances: DataFrame, pct: float = 0.01, floor_cents: int = 0, days: int = 14, radius: int = 2, topk: int = 30) -> DataFrame:
    """Scored candidates: amounts in tolerance, dates within `days`, the best topk a receipt."""
    r, m = receipt_headers(receipts, pct, floor_cents), remittance_headers(remittances)
    near = (F.abs(F.col("r_cents") - F.col("m_cents")) <= F.col("r_tol")) & (S.days_apart("r_date", "m_date") <= days)
    score = W.RECEIPT_REMITTANCE.score(amount=S.amount_decay("amt_diff"), date=S.date_decay("day_diff"), name="name_sim", address="addr_sim")

    def scored(a: DataFrame, b: DataFrame) -> DataFrame:
        c = blocking.week_band_join(a, b, "r_date", "m_date", radius, near, amounts=("r_cents", "m_cents", pct, floor_cents))
        return _features(c, ("r_cents", "r_date", "r_name", "r_addr"), ("m_cents", "m_date", "m_name", "m_addr")).withColumn("low", -F.round(score, 6))

    mine, ids = ["r_cents", "r_date", "r_name", "r_addr", "r_tol"], ["document_id", "remitreceipt_id"]
    best = blocking.best_by_classes(r, m.where("m_cents IS NOT NULL"), mine, ["amount_field", "m_cents", "m_date", "m_name", "m_addr"], ids, scored, ["low", "amt_diff"], ["amount_field", "day_diff", "name_sim", "addr_sim"], topk)
    c = r.select("receipt_id", F.struct(*mine).alias("left_key")).join(best, "left_key").select("receipt_id", F.posexplode("best").alias("pos", "x"))
    return c.select("receipt_id", *[f"x.{n}" for n in (*ids, "amount_field", "amt_diff", "day_diff", "name_sim", "addr_sim")], (-F.col("x.low")).alias("pre_score"), (F.col("pos") + 1).alias("rank0"))


def receipts_to_remittances(receipts: DataFrame, remittances: DataFrame, *, pct: float = 0.01, floor_cents: int = 0, days: int = 14, radius: int = 2, topk: int = 30, most: int = 3, high: float = 0.92, second: float = 0.88, margin: float = 0.02, ask: judge.Judge | None = None) -> DataFrame:
    """(receipt_id, document_id, remitreceipt_id, match_rank, scores ...), at most `most` a receipt."""
    ids = ["document_id", "remitreceipt_id", "amount_field"]
    kept = judge.threshold_band(receipt_remittance_scores(receipts, remittances, pct, floor_cents, days, radius, topk), "receipt_id", high, second, margin)
    pre = shaping.top_by(kept, ["receipt_id"], [F.desc("pre_score"), F.asc("amt_diff"), *[F.asc(c) for c in ids]], most, "match_rank_pre")
    return judge.judged_matches(pre, ["receipt_id", "document_id", "remitreceipt_id"], "receipt_id", [F.asc("amt_diff"), *[F.asc(c) for c in ids]], high, most, ask)


def remit_line_scores(lines: DataFrame, invoices: DataFrame, pct: float = 0.01, floor_cents: int = 0, days: int = 7, radius: int = 1, topk: int = 10) -> DataFrame:
    """Remittance lines against invoices: amount, date and first letter of the name (or a blank one) block, five features score."""
    line_id = S.hash_key("invoice_number", "invoice_date", "remitreceipt_id", "payer_name", "payer_address")
    r = lines.select(line_id.alias("remit_line_id"), S.norm_name("invoice_number").alias("r_no"), F.col("invoice_date").cast("date").alias("r_date"), S.cents("invoice_amount").alias("r_cents"), S.norm_name("payer_name").alias("r_name"), S.norm_name("payer_address").alias("r_addr"))
    r = r.where("r_date IS NOT NULL AND r_cents IS NOT NULL").withColumn("r_tol", S.tolerance("r_cents", pct, floor_cents))
    i = invoices.select("invno", S.norm_name("invno").alias("i_no"), F.col("invdate").cast("date").alias("i_date"), S.cents(F.coalesce("invamt", "amount", "balance")).alias("i_cents"), S.norm_name("company").alias("i_name"), S.norm_name("address").alias("i_addr"))
    i = i.where("i_date IS NOT NULL AND i_cents IS NOT NULL")
    letter = (F.substring("r_name", 1, 1) == F.substring("i_name", 1, 1)) | (F.col("r_name") == "") | (F.col("i_name") == "")
    near = (F.abs(F.col("r_cents") - F.col("i_cents")) <= F.col("r_tol")) & (S.days_apart("r_date", "i_date") <= days) & letter
    score = lambda named: F.round(W.REMITTANCE_INVOICE.score(amount=S.amount_decay("amt_diff"), name="name_sim", date=S.date_decay("day_diff"), address="addr_sim", number=F.lit(named)), 6)
    features = lambda c: _features(c, ("r_cents", "r_date", "r_name", "r_addr"), ("i_cents", "i_date", "i_name", "i_addr"))

    def scored(a: DataFrame, b: DataFrame) -> DataFrame:
        return features(blocking.week_band_join(a, b, "r_date", "i_date", radius, near, amounts=("r_cents", "i_cents", pct, floor_cents))).withColumn("low", -score(0.0))

    mine = ["r_date", "r_cents", "r_name", "r_addr", "r_tol"]
    best = blocking.best_by_classes(r, i, mine, ["i_date", "i_cents", "i_name", "i_addr"], ["invno", "i_no"], scored, ["low", "amt_diff"], ["day_diff"], topk)
    best = best.withColumn("best", F.transform("best", lambda x: F.struct(x["low"].alias("low"), x["amt_diff"].alias("amt_diff"), x["invno"].alias("invno"), x["i_no"].alias("no"), x["day_diff"].alias("day_diff"), F.lit(False).alias("named"))))
    named = features(r.where("r_no <> ''").join(i, (F.col("r_no") == F.col("i_no")) & near)).withColumn("low", -score(1.0))
    named = named.select("remit_line_id", F.struct("low", "amt_diff", "invno", F.col("i_no").alias("no"), "day_diff", F.lit(True).alias("named")).alias("x"))
    rows = r.select("remit_line_id", F.when(F.col("r_no") != "", F.col("r_no")).alias("r_no"), F.struct(*mine).alias("left_key"))
    c = blocking.best_by_row(rows, best, named, "remit_line_id", "r_no", topk)
    return c.select("remit_line_id", "x.invno", "x.amt_diff", "x.day_diff", F.col("x.named").alias("invno_match"), (-F.col("x.low")).alias("pre_score"), (F.col("pos") + 1).alias("rank0"))


def remit_lines_to_invoices(lines: DataFrame, invoices: DataFrame, *, topk: int = 10, most: int = 3, high: float = 0.85, second: float = 0.85, margin: float = 0.0, ask: judge.Judge | None = None, **block) -> DataFrame:
    kept = judge.threshold_band(remit_line_scores(lines, invoices, topk=topk, **block), "remit_line_id", high, second, margin)
    pre = shaping.top_by(kept, ["remit_line_id"], [F.desc("pre_score"), F.asc("amt_diff"), F.asc("invno")], most, "match_rank_pre")
    return judge.judged_matches(pre, ["remit_line_id", "invno"], "remit_line_id", [F.asc("amt_diff"), F.asc("invno")], high, most, ask, doubtful=~F.col("invno_match"))


def invoice_pool(receipts: DataFrame, invoices: DataFrame, pct: float = 0.01, floor_cents: int = 0, prefer_closed: bool = True) -> DataFrame:
    """A receipt's candidates: its customers' invoice versions, keyed, with shadowed open versions marked and pool size."""
    head = receipt_headers(receipts, pct, floor_cents)
    customers = shaping.fan_out(shaping.collapse_headers(receipts.where("payercust_custno IS NOT NULL"), "receipt_id", "payercust_custno", []))
    i = invoices.where("custno IS NOT NULL").withColumns(
        {"inv_row_id": S.hash_key("custno", "invno", *[S.cents(f) for f in ("invamt", "amount", "balance")], F.col("modified_on").cast("string"), "rcl_open_close"), "inv_key": S.hash_key("custno", "invno", *[S.cents(f) for f in ("invamt", "amount", "balance")])}
    )
    pairs = sums.shadowing(head.join(customers, "receipt_id").join(i, "custno"))
    return sums.with_pool_size(pairs.where("NOT open_shadowed")) if prefer_closed else sums.with_pool_size(pairs)


def line_scores(pool: DataFrame, topk: int | None = 40, large: int | None = 120, brief: bool = False) -> DataFrame:
    """Lines of pools of at most `large`, scored, the best topk; None: no such limit. brief: by amount and name only."""
    c = (pool if large is None else pool.where(F.col("pool_n") <= large)).withColumns({f"{f}_c": S.cents(f) for f in subset.FIELDS})
    gap = F.least(*[F.abs(F.col(f"{f}_c") - F.col("r_cents")) for f in subset.FIELDS])
    name, addr = S.norm_name("company"), S.norm_name("address")
    c = sums.cluster_scores(c.withColumns({"min_diff": gap, "i_name": name, "i_addr": addr, "inv_days": S.days_apart("r_date", "invdate"), "due_days": S.days_apart("r_date", "duedate")}))
    amount, alike = S.amount_decay("min_diff"), S.similarity("r_name", "i_name")
    score = W.RECEIPT_INVOICE_BRIEF.score(amount=amount, name=alike) if brief else W.RECEIPT_INVOICE_LINE.score(amount=amount, name=alike, address=S.similarity_or_null("r_addr", "i_addr"), dates=S.soft_dates("inv_days", "due_days"), cluster="cluster_score")
    c = c.withColumn("line_score", F.round(score, 6))
    if topk is None:
        return c
    return shaping.top_by(c, ["receipt_id"], [F.desc("line_score"), F.asc("min_diff"), F.asc("inv_days"), F.asc("inv_row_id")], topk, "rank0")


def receipts_to_invoice_sets(receipts: DataFrame, invoices: DataFrame, pct: float = 0.01, large: int = 120, topk: int | None = None, most: int = 8, sets: int = 3, groups: int = 3, unit: str = "day") -> DataFrame:
    """Small pools by beam subset sums, large ones by batch sums, shadowed versions of what was selected added."""
    every = sums.shadowing(invoice_pool(receipts, invoices, pct, prefer_closed=False).drop("open_shadowed", "pool_n"))
    pool = sums.with_pool_size(every.where("NOT open_shadowed"))
    small = subset.beam_sets(line_scores(pool, topk, large).select("receipt_id", "r_cents", "r_tol", "inv_row_id", "amount_c", "balance_c", "invamt_c", "line_score"), most, sets)
    keys = pool.select("receipt_id", "inv_row_id", "inv_key").distinct()
    small = small.join(keys, ["receipt_id", "inv_row_id"])
    big = pool.where(F.col("pool_n") > large)
    best = sums.batch_groups(big, unit, groups)
    key = S.hash_key("salespn", "salesarea", "modified_by", S.norm_name("company"), S.norm_name("address"), S.batch_time(F.col("modified_on").cast("timestamp"), unit).cast("date"))
    batch = big.withColumn("grp_key", key).join(best.select("receipt_id", "grp_key", "set_rank", "matched_field", "matched_cents", "diff_cents"), ["receipt_id", "grp_key"])
    cols = ["receipt_id", "set_rank", "matched_field", "matched_cents", "diff_cents", "inv_row_id", "inv_key"]
    found = small.select(*cols).unionByName(batch.select(*cols))
    shadow = sums.shadow_rows(every, found).withColumns({"set_rank": F.lit(1), "matched_field": F.lit("shadow_open"), "matched_cents": F.lit(0).cast("long"), "diff_cents": F.lit(0).cast("long")})
    return found.unionByName(shadow.select(*cols))


def blocked_edges(receipts: DataFrame, invoices: DataFrame, days: int = 90, most: float = 1.15, topk: int = 200) -> DataFrame:
    """Receipt-invoice edges of one customer with a block score, the best topk a receipt."""
    r = receipts.select("receipt_id", "payercust_custno", F.col("amount").alias("r_amount"), F.col("receipt_date").alias("r_date"), F.col("currency").alias("r_currency"), S.norm_name("payercust_company").alias("r_name"))
    i = invoices.select("custno", "invno", F.col("invamt").alias("i_amount"), F.col("invdate").alias("i_date"), F.col("currency").alias("i_currency"), S.norm_name("company").alias("i_name"))
    c = blocking.block_candidates(r, i, ("payercust_custno", "custno"), "r_amount", "i_amount", "r_date", "i_date", ("r_currency", "i_currency"), days, most)
    score = W.BLOCK_RECEIPT.score(amount=S.amount_closeness("r_amount", "i_amount"), date=S.date_closeness(S.days_apart("r_date", "i_date")), user=F.lit(0.0), name=S.same_prefix("r_name", "i_name").cast("double"))
    c = c.withColumn("block_score", F.round(score, 6)).select("receipt_id", "invno", S.cents("r_amount").alias("r_cents"), S.cents("i_amount").alias("i_cents"), S.days_apart("r_date", "i_date").alias("day_diff"), "block_score")
    return shaping.top_by(c, ["receipt_id"], [F.desc("block_score"), F.asc("day_diff"), F.asc("invno")], topk, "rank0")


def receipts_to_invoices_flow(receipts: DataFrame, invoices: DataFrame, **block) -> DataFrame:
    """Every receipt with its least-cost allocation, labelled; what stays unmatched as such."""
    e = blocked_edges(receipts, invoices, **block).select("receipt_id", F.col("invno").alias("invoice_key"), "r_cents", "i_cents", W.cost(F.col("block_score")).alias("cost"))
    out = flow.grouping_labels(flow.allocate(e))
    fill = {"invoice_key": F.lit(flow.UNMATCHED), "allocated_cents": F.lit(0).cast("long"), "grouping_type": F.lit("unmatched"), "group_count": F.lit(0).cast("long")}
    return shaping.with_unmatched(out, receipts.select("receipt_id").distinct(), ["receipt_id"], fill)
