"""Every registered query, with the SQL that states it independently where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import blocking, flow, judge, knn, remittance_json, shaping, subset, sums, tickets
from ..sources import vector_store
from ..sources.fixtures import table, view, with_views
from . import pipelines, reconcile

NOW = "2024-02-06 00:00:00"
QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: Scalar functions in DuckDB's SQL.
_NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({0}, ''))), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g'), '\b(inc|llc|ltd|corp|co|company|incorporated|limited|corporation)\b', '', 'g'), '\s+', ' ', 'g'))"
_SIM = "(1.0 - levenshtein({0}, {1}) / CAST(greatest(length({0}), length({1}), 1) AS DOUBLE))"


def norm(x: str) -> str:
    return _NORM.format(x)


def sim(a: str, b: str) -> str:
    return _SIM.format(a, b)


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def query(oracle: str | None = None, views: tuple[str, ...] = ()):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = with_views(views, oracle) if views else oracle
        return f

    return add


_NEAREST = "CASE least(abs({a} - r_cents), abs({b} - r_cents), abs({c} - r_cents)) WHEN abs({a} - r_cents) THEN '{an}' WHEN abs({b} - r_cents) THEN '{bn}' ELSE '{cn}' END"


@query(
    f"""SELECT receipt_id, custno, r_cents, matched_field, CASE matched_field WHEN 'amount' THEN a WHEN 'balance' THEN b ELSE c END AS matched_cents,
       CASE matched_field WHEN 'amount' THEN a WHEN 'balance' THEN b ELSE c END - r_cents AS diff_cents, n AS line_count
FROM (SELECT *, {_NEAREST.format(a='a', b='b', c='c', an='amount', bn='balance', cn='invamt')} AS matched_field
  FROM (SELECT receipt_id, custno, {cents('r.amount')} AS r_cents, CAST(sum(coalesce({cents('i.amount')}, 0)) AS BIGINT) AS a, CAST(sum(coalesce({cents('i.balance')}, 0)) AS BIGINT) AS b, CAST(sum(coalesce({cents('i.invamt')}, 0)) AS BIGINT) AS c, count(*) AS n
        FROM receipts r JOIN invoices i ON payercust_custno = custno GROUP BY ALL))
WHERE abs(diff_cents) <= abs(r_cents) * 0.01""",
    ("receipts",),
)
def closest_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sums.closest_sums(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"))


_DATED = f"""dated AS (SELECT receipt_id, custno, invno, {cents('r.amount')} AS r_cents, invdate, i.created_on, app_date, duedate,
  coalesce({cents('i.amount')}, 0) AS c1, coalesce({cents('i.invamt')}, 0) AS c2, coalesce({cents('i.balance')}, 0) AS c3, coalesce({cents('i.app_amount')}, 0) AS c4
  FROM receipts r JOIN invoices i ON payercust_custno = custno AND invdate >= receipt_date - INTERVAL {{0}} MONTH AND invdate <= receipt_date + INTERVAL {{1}} MONTH)"""


_WHOLE = f"""{_DATED.format(12, 1)}, s AS (SELECT receipt_id, custno, any_value(r_cents) AS r_cents, CAST(sum(c1) AS BIGINT) AS s1, CAST(sum(c2) AS BIGINT) AS s2, CAST(sum(c3) AS BIGINT) AS s3, CAST(sum(c4) AS BIGINT) AS s4, count(*) AS line_count, count(DISTINCT invno) AS invno_count
  FROM dated GROUP BY ALL HAVING count(DISTINCT app_date) = 1 AND count(DISTINCT duedate) = 1),
b AS (SELECT *, least(abs(s1 - r_cents), abs(s2 - r_cents), abs(s3 - r_cents), abs(s4 - r_cents)) AS d FROM s),
whole AS (SELECT receipt_id, custno, r_cents, line_count, invno_count, CASE d WHEN abs(s1 - r_cents) THEN 'sum_amount' WHEN abs(s2 - r_cents) THEN 'sum_invamt' WHEN abs(s3 - r_cents) THEN 'sum_balance' ELSE 'sum_app_amount' END AS matched_field, d AS match_diff
FROM b WHERE d <= 1)"""


@query(f", {_WHOLE} SELECT * FROM whole", ("receipts",))
def whole_set_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sums.whole_set_sums(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"))
    return out.select("receipt_id", "custno", "r_cents", "line_count", "invno_count", "matched_field", F.abs("diff_cents").alias("match_diff"))


_RUN = "SELECT receipt_id, custno, r_cents, '{name}' AS match_basis, max(run) AS greedy_cents, count(*) AS greedy_rows FROM (SELECT *, CAST(sum({c}) OVER (PARTITION BY receipt_id, custno ORDER BY invdate DESC, created_on DESC, invno ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM ok) WHERE run <= r_cents + 1 GROUP BY ALL"


@query(
    f""", {_DATED.format(24, 2)}, ok AS (SELECT * FROM dated WHERE (receipt_id, custno) IN (SELECT (receipt_id, custno) FROM dated GROUP BY receipt_id, custno HAVING count(DISTINCT app_date) = 1 AND count(DISTINCT duedate) = 1)),
g AS ({' UNION ALL '.join(_RUN.format(name=n, c=c) for n, c in (('greedy_amount', 'c1'), ('greedy_invamt', 'c2'), ('greedy_balance', 'c3'), ('greedy_app_amount', 'c4')))})
SELECT receipt_id, custno, r_cents, match_basis, greedy_cents, greedy_rows, abs(greedy_cents - r_cents) AS diff_cents FROM g WHERE abs(greedy_cents - r_cents) <= 1
QUALIFY row_number() OVER (PARTITION BY receipt_id, custno ORDER BY abs(greedy_cents - r_cents), match_basis) = 1""",
    ("receipts",),
)
def greedy_prefix_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sums.greedy_prefix_sums(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"))


@query(
    f""", {_WHOLE}, {_DATED.format(24, 2).replace('dated AS', 'wider AS', 1)}, ok AS (SELECT * FROM wider WHERE (receipt_id, custno) IN (SELECT (receipt_id, custno) FROM wider GROUP BY receipt_id, custno HAVING count(DISTINCT app_date) = 1 AND count(DISTINCT duedate) = 1) AND (receipt_id, custno) NOT IN (SELECT (receipt_id, custno) FROM whole)),
g AS ({' UNION ALL '.join(_RUN.format(name=n, c=c) for n, c in (('greedy_amount', 'c1'), ('greedy_invamt', 'c2'), ('greedy_balance', 'c3'), ('greedy_app_amount', 'c4')))}),
k AS (SELECT *, abs(greedy_cents - r_cents) AS diff_cents FROM g WHERE abs(greedy_cents - r_cents) <= 1 QUALIFY row_number() OVER (PARTITION BY receipt_id, custno ORDER BY abs(greedy_cents - r_cents), match_basis) = 1)
SELECT receipt_id, custno, r_cents, 1 AS stage, matched_field AS match_basis, match_diff AS diff_cents, line_count FROM whole UNION ALL SELECT receipt_id, custno, r_cents, 2, match_basis, diff_cents, greedy_rows FROM k""",
    ("receipts",),
)
def receipts_to_invoices_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.receipts_to_invoices_staged(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"))


_SCORED = f"""h AS (SELECT document_id, remitreceipt_id, remittance_date AS m_date, {norm('payer_name')} AS m_name, {norm('payer_address')} AS m_addr, unnest([{{{{'f': 'total_remittance_amount', 'v': total_remittance_amount}}}}, {{{{'f': 'total_amount_paid', 'v': total_amount_paid}}}}]) AS a, total_remittance_amount AS t FROM remit_headers),
m AS (SELECT *, a.f AS amount_field, {cents('a.v')} AS m_cents FROM h WHERE a.v IS NOT NULL AND NOT (a.f = 'total_amount_paid' AND a.v IS NOT DISTINCT FROM t)),
r AS (SELECT receipt_id, receipt_date AS r_date, {cents('amount')} AS r_cents, {norm('payercust_company')} AS r_name, {norm('payercust_address1')} AS r_addr FROM receipts WHERE amount IS NOT NULL),
c AS (SELECT receipt_id, document_id, remitreceipt_id, amount_field, abs(r_cents - m_cents) AS amt_diff, abs(date_diff('day', r_date, m_date)) AS day_diff, {sim('r_name', 'm_name')} AS name_sim,
  CASE WHEN r_addr <> '' AND m_addr <> '' THEN {sim('r_addr', 'm_addr')} END AS addr_sim FROM r JOIN m ON abs(r_cents - m_cents) <= round(abs(r_cents) * 0.01) AND abs(date_diff('day', r_date, m_date)) <= 14),
s AS (SELECT *, round(0.45 * CASE WHEN amt_diff = 0 THEN 1 ELSE exp(-amt_diff / 500.0) END + 0.20 * exp(-day_diff / 7.0) + 0.25 * name_sim + 0.10 * coalesce(addr_sim, 0), 6) AS pre_score FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY receipt_id ORDER BY pre_score DESC, amt_diff, document_id, remitreceipt_id, amount_field) AS rank0 FROM s QUALIFY rank0 <= 30)""".replace("{{", "{").replace("}}", "}")


@query(f", {_SCORED} SELECT receipt_id, document_id, remitreceipt_id, amount_field, amt_diff, day_diff, round(name_sim, 6) AS name_sim, round(addr_sim, 6) AS addr_sim, pre_score, rank0 FROM k", ("receipts", "remit_headers"))
def band_join_receipt_remit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pipelines.receipt_remittance_scores(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "remit_headers"))
    return out.withColumns({"name_sim": F.round("name_sim", 6), "addr_sim": F.round("addr_sim", 6)})


@query(
    f""", {_SCORED}, b AS (SELECT *, max(pre_score) OVER (PARTITION BY receipt_id) AS best FROM k)
SELECT receipt_id, document_id, remitreceipt_id, amount_field, pre_score AS final_score, row_number() OVER (PARTITION BY receipt_id ORDER BY pre_score DESC, amt_diff, document_id, remitreceipt_id, amount_field) AS match_rank
FROM b WHERE pre_score >= 0.92 QUALIFY match_rank <= 3""",
    ("receipts", "remit_headers"),
)
def receipts_to_remittances(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pipelines.receipts_to_remittances(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "remit_headers"))
    return out.select("receipt_id", "document_id", "remitreceipt_id", "amount_field", "final_score", "match_rank")


_LINES = f"""r AS (SELECT sha256(concat_ws('||', coalesce(invoice_number, ''), coalesce(CAST(invoice_date AS VARCHAR), ''), coalesce(remitreceipt_id, ''), coalesce(payer_name, ''), coalesce(payer_address, ''))) AS remit_line_id, {norm('invoice_number')} AS r_no, invoice_date AS r_date, {cents('invoice_amount')} AS r_cents, {norm('payer_name')} AS r_name, {norm('payer_address')} AS r_addr FROM remit_lines WHERE invoice_amount IS NOT NULL),
i AS (SELECT invno, {norm('invno')} AS i_no, invdate AS i_date, {cents('coalesce(invamt, amount, balance)')} AS i_cents, {norm('company')} AS i_name, {norm('address')} AS i_addr FROM invoices),
c AS (SELECT remit_line_id, invno, abs(r_cents - i_cents) AS amt_diff, abs(date_diff('day', r_date, i_date)) AS day_diff, (r_no <> '' AND r_no = i_no) AS invno_match, {sim('r_name', 'i_name')} AS n, CASE WHEN r_addr <> '' AND i_addr <> '' THEN {sim('r_addr', 'i_addr')} END AS ad
  FROM r JOIN i ON abs(date_diff('day', r_date, i_date)) <= 7 AND abs(r_cents - i_cents) <= round(abs(r_cents) * 0.01) AND (left(r_name, 1) = left(i_name, 1) OR r_name = '' OR i_name = '')),
s AS (SELECT remit_line_id, invno, amt_diff, day_diff, invno_match, round(0.35 * CASE WHEN amt_diff = 0 THEN 1 ELSE exp(-amt_diff / 500.0) END + 0.25 * n + 0.20 * exp(-day_diff / 7.0) + 0.15 * coalesce(ad, 0) + 0.05 * CAST(invno_match AS INT), 6) AS pre_score FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY remit_line_id ORDER BY pre_score DESC, amt_diff, invno) AS rank0 FROM s QUALIFY rank0 <= 10)"""


@query(f", {_LINES} SELECT * FROM k", ("remit_lines",))
def remit_line_to_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.remit_line_scores(view(spark, sf_dir, "remit_lines"), view(spark, sf_dir, "invoices"))


_HASH = "sha256(concat_ws('||', custno, invno, coalesce(CAST({0} AS VARCHAR), ''), coalesce(CAST({1} AS VARCHAR), ''), coalesce(CAST({2} AS VARCHAR), '')))".format(cents("i.invamt"), cents("i.amount"), cents("i.balance"))
_POOL = f"""p AS (SELECT receipt_id, custno, invno, rcl_open_close, salespn, salesarea, modified_by, modified_on, i.company, i.address, {cents('r.amount')} AS r_cents, CAST(round(abs(round(r.amount * 100)) * 0.01) AS BIGINT) AS r_tol, receipt_date AS r_date, invdate, duedate, {_HASH} AS inv_key,
  {norm('payercust_company')} AS r_name, {norm('payercust_address1')} AS r_addr, i.amount, i.balance, i.invamt FROM receipts r JOIN shadowed i ON payercust_custno = custno WHERE r.amount IS NOT NULL),
sh AS (SELECT *, coalesce(rcl_open_close = 'open' AND bool_or(rcl_open_close = 'closed') OVER (PARTITION BY receipt_id, custno, inv_key), false) AS open_shadowed FROM p)"""


@query(f", {_POOL} SELECT receipt_id, custno, invno, rcl_open_close, inv_key, open_shadowed FROM sh", ("receipts", "shadowed"))
def open_shadowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = pipelines.invoice_pool(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "shadowed"), prefer_closed=False)
    return pool.select("receipt_id", "custno", "invno", "rcl_open_close", "inv_key", "open_shadowed")


@query(
    f""", {_POOL}, g AS (SELECT receipt_id, sha256(concat_ws('||', coalesce(salespn, ''), coalesce(salesarea, ''), coalesce(modified_by, ''), {norm('company')}, {norm('address')}, CAST(CAST(date_trunc('month', modified_on) AS DATE) AS VARCHAR))) AS grp_key, any_value(r_cents) AS r_cents, any_value(r_tol) AS r_tol,
  CAST(sum(coalesce({cents('invamt')}, 0)) AS BIGINT) AS a, CAST(sum(coalesce({cents('amount')}, 0)) AS BIGINT) AS b, CAST(sum(coalesce({cents('balance')}, 0)) AS BIGINT) AS c, count(*) AS line_count FROM sh WHERE NOT open_shadowed GROUP BY 1, 2),
f AS (SELECT *, {_NEAREST.format(a='a', b='b', c='c', an='invamt', bn='amount', cn='balance')} AS matched_field FROM g),
d AS (SELECT *, CASE matched_field WHEN 'invamt' THEN a WHEN 'amount' THEN b ELSE c END AS matched_cents FROM f)
SELECT receipt_id, grp_key, matched_field, matched_cents, matched_cents - r_cents AS diff_cents, abs(matched_cents - r_cents) <= r_tol AS within_tol, line_count,
  row_number() OVER (PARTITION BY receipt_id ORDER BY abs(matched_cents - r_cents) <= r_tol DESC, abs(matched_cents - r_cents), line_count DESC, grp_key) AS set_rank FROM d QUALIFY set_rank <= 3""",
    ("receipts", "shadowed"),
)
def batch_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = pipelines.invoice_pool(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "shadowed"))
    return sums.batch_groups(pool, "month").select("receipt_id", "grp_key", "matched_field", "matched_cents", "diff_cents", "within_tol", "line_count", "set_rank")


@query(
    f""", {_POOL}, q AS (SELECT *, count(*) OVER (PARTITION BY receipt_id) AS pool_n FROM sh WHERE NOT open_shadowed),
f AS (SELECT *, least(abs({cents('amount')} - r_cents), abs({cents('balance')} - r_cents), abs({cents('invamt')} - r_cents)) AS min_diff, {norm('company')} AS i_name, {norm('address')} AS i_addr, abs(date_diff('day', r_date, invdate)) AS d1, abs(date_diff('day', r_date, duedate)) AS d2,
  (ln(1 + count(*) OVER (PARTITION BY receipt_id, salespn)) + ln(1 + count(*) OVER (PARTITION BY receipt_id, salesarea)) + ln(1 + count(*) OVER (PARTITION BY receipt_id, modified_by))) / 8.0 AS cs FROM q WHERE pool_n <= 120),
s AS (SELECT *, round(0.55 * CASE WHEN min_diff = 0 THEN 1 ELSE exp(-min_diff / 500.0) END + 0.20 * {sim('r_name', 'i_name')} + 0.10 * CASE WHEN r_addr <> '' AND i_addr <> '' THEN {sim('r_addr', 'i_addr')} ELSE 0 END + 0.10 * (0.5 * exp(-d1 / 30.0) + 0.5 * exp(-d2 / 45.0)) + 0.05 * cs, 6) AS line_score FROM f)
SELECT receipt_id, invno, line_score, min_diff, row_number() OVER (PARTITION BY receipt_id ORDER BY line_score DESC, min_diff, d1, sha256(concat_ws('||', custno, invno, coalesce(CAST({cents('invamt')} AS VARCHAR), ''), coalesce(CAST({cents('amount')} AS VARCHAR), ''), coalesce(CAST({cents('balance')} AS VARCHAR), ''), CAST(modified_on AS VARCHAR), coalesce(rcl_open_close, '')))) AS rank0 FROM s QUALIFY rank0 <= 40""",
    ("receipts", "shadowed"),
)
def cluster_line_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = pipelines.invoice_pool(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "shadowed"))
    return pipelines.line_scores(pool).select("receipt_id", "invno", "line_score", "min_diff", "rank0")


@query("SELECT receipt_id, invno FROM receipts r JOIN invoices i ON payercust_custno = custno AND abs(round(r.amount * 100) - round(i.invamt * 100)) <= 1 AND r.currency = i.currency AND abs(date_diff('day', receipt_date, invdate)) <= 90", ("receipts",))
def presolve_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = view(spark, sf_dir, "receipts").select("receipt_id", "payercust_custno", "amount", "receipt_date", "currency")
    i = view(spark, sf_dir, "invoices").select("custno", "invno", "invamt", "invdate", F.col("currency").alias("i_currency"))
    return blocking.presolved(r, i, [("payercust_custno", "custno")], "amount", "invamt", "receipt_date", "invdate", ("currency", "i_currency")).select("receipt_id", "invno")


_ALIASED = "SELECT *, CASE WHEN CAST(invno AS BIGINT) % 3 = 0 THEN concat('S', invno) END AS srcinvoice, CASE WHEN CAST(invno AS BIGINT) % 3 = 1 THEN invno END AS invrefno, CASE WHEN CAST(invno AS BIGINT) % 3 = 2 THEN invno ELSE concat('X', invno) END AS no FROM invoices"


@query(
    f""", i AS ({_ALIASED}), l AS (SELECT *, CASE WHEN CAST(invoice_number AS BIGINT) % 3 = 0 THEN concat('s', invoice_number) ELSE invoice_number END AS n FROM remit_lines)
SELECT DISTINCT remitreceipt_id, i.invno FROM l JOIN i ON (upper(n) = no OR upper(n) = srcinvoice OR upper(n) = invrefno) AND abs(round(invoice_amount * 100) - round(invamt * 100)) <= 1 AND abs(date_diff('day', invoice_date, invdate)) <= 120""",
    ("remit_lines",),
)
def presolve_invno(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("invno").cast("long") % 3
    i = view(spark, sf_dir, "invoices").select(
        "invno", "invamt", "invdate", F.when(x == 0, F.concat(F.lit("S"), "invno")).alias("srcinvoice"), F.when(x == 1, F.col("invno")).alias("invrefno"), F.when(x == 2, F.col("invno")).otherwise(F.concat(F.lit("X"), "invno")).alias("no")
    )
    n = F.upper(F.when(F.col("invoice_number").cast("long") % 3 == 0, F.concat(F.lit("s"), "invoice_number")).otherwise(F.col("invoice_number")))
    lines = view(spark, sf_dir, "remit_lines").select("remitreceipt_id", "invoice_amount", "invoice_date", n.alias("n"))
    near = (F.abs(S.cents("invoice_amount") - S.cents("invamt")) <= 1) & (S.days_apart("invoice_date", "invdate") <= 120)
    return blocking.any_equal_join(lines, i, [("n", "no"), ("n", "srcinvoice"), ("n", "invrefno")], ["remitreceipt_id", "invno"], near).select("remitreceipt_id", "invno")


_BLOCK = f"""e AS (SELECT receipt_id, invno, {cents('r.amount')} AS r_cents, {cents('i.invamt')} AS i_cents, abs(date_diff('day', receipt_date, invdate)) AS day_diff,
  round(0.60 * least(greatest(1 - abs(r.amount - i.invamt) / greatest(1.0, abs(r.amount)), 0), 1) + 0.30 * (1 - least(abs(date_diff('day', receipt_date, invdate)), 365) / 365.0) + 0.05 * CASE WHEN left({norm('payercust_company')}, 8) = left({norm('company')}, 8) THEN 1 ELSE 0 END, 6) AS block_score
  FROM receipts r JOIN invoices i ON payercust_custno = custno AND i.invamt >= 0 AND i.invamt <= r.amount * 1.15 AND r.currency = i.currency AND abs(date_diff('day', receipt_date, invdate)) <= 90)"""


@query(f", {_BLOCK} SELECT *, row_number() OVER (PARTITION BY receipt_id ORDER BY block_score DESC, day_diff, invno) AS rank0 FROM e QUALIFY rank0 <= 200", ("receipts",))
def block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.blocked_edges(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"))


@query(
    "SELECT receipt_id, remitreceipt_id, invno FROM remit_lines l JOIN invoices i ON invamt BETWEEN 0 AND invoice_amount * 1.2 AND abs(date_diff('day', invoice_date, invdate)) <= 10 AND l.currency = i.currency AND round(invamt * 100) = round(invoice_amount * 100) JOIN receipts ON payercust_custno = custno",
    ("receipts", "remit_lines"),
)
def wide_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = view(spark, sf_dir, "remit_lines").select("remitreceipt_id", "invoice_amount", "invoice_date", F.col("currency").alias("l_currency"))
    i = view(spark, sf_dir, "invoices").select("custno", "invno", "invamt", "invdate", F.col("currency").alias("i_currency"))
    ok = F.col("invamt").between(F.lit(0), F.col("invoice_amount") * 1.2) & S.currency_ok("l_currency", "i_currency") & (S.cents("invamt") == S.cents("invoice_amount"))
    pairs = blocking.wide_block_join(lines, i, "invoice_date", "invdate", ok, 10)
    return pairs.join(view(spark, sf_dir, "receipts").select("receipt_id", "payercust_custno"), F.col("custno") == F.col("payercust_custno")).select("receipt_id", "remitreceipt_id", "invno")


@query("SELECT r.receipt_id, h.remitreceipt_id FROM receipts r JOIN remit_headers h ON r.check_num = h.check_no AND abs(date_diff('day', receipt_date, remittance_date)) <= 10 AND abs(round(amount * 100) - round(total_remittance_amount * 100)) <= 1 AND r.currency = h.currency", ("receipts", "remit_headers"))
def deterministic_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = view(spark, sf_dir, "receipts").select("receipt_id", "check_num", "amount", "receipt_date", "currency")
    h = view(spark, sf_dir, "remit_headers").select("remitreceipt_id", "check_no", "total_remittance_amount", "remittance_date", F.col("currency").alias("h_currency"))
    return blocking.presolved(r, h, [("check_num", "check_no")], "amount", "total_remittance_amount", "receipt_date", "remittance_date", ("currency", "h_currency"), days=10).select("receipt_id", "remitreceipt_id")


@query(
    "SELECT receipt_id, invno, coalesce(CAST(round(i.invamt * 100) AS BIGINT), 0) AS allocated_cents, invno IS NOT NULL AS matched FROM receipts r LEFT JOIN invoices i ON payercust_custno = custno AND abs(round(r.amount * 100) - round(i.invamt * 100)) <= 1 AND r.currency = i.currency AND abs(date_diff('day', receipt_date, invdate)) <= 90",
    ("receipts",),
)
def unmatched_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = presolve_exact(spark, sf_dir).join(view(spark, sf_dir, "invoices").select("invno", S.cents("invamt").alias("allocated_cents")), "invno").withColumn("matched", F.lit(True))
    out = shaping.with_unmatched(hits.select("receipt_id", "invno", "allocated_cents", "matched"), view(spark, sf_dir, "receipts").select("receipt_id"), ["receipt_id"], {"allocated_cents": F.lit(0).cast("long"), "matched": F.lit(False)})
    return out.select("receipt_id", "invno", "allocated_cents", "matched")


@query(f"SELECT receipt_id, {norm('payercust_company')} AS name, {norm('payercust_address1')} AS address, sha256(concat_ws('||', receipt_id, coalesce(check_num, ''))) AS key FROM receipts", ("receipts",))
def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "receipts").select("receipt_id", S.norm_name("payercust_company").alias("name"), S.norm_name("payercust_address1").alias("address"), S.hash_key("receipt_id", "check_num").alias("key"))


@query(f"SELECT a.n_nationkey AS a, b.n_nationkey AS b, round({sim(norm('a.n_name'), norm('b.n_name'))}, 6) AS similarity FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey")
def string_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", S.norm_name("n_name").alias("n"))
    a, b = (n.select("n_regionkey", F.col("n_nationkey").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    return a.join(b, "n_regionkey").select("a", "b", F.round(S.similarity("na", "nb"), 6).alias("similarity"))


@query(
    "SELECT c_custkey, upper(split_part(d, '.', -2)) AS company FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN concat('pay@mail.', lower(replace(c_mktsegment, ' ', '')), '.com') WHEN 1 THEN concat(c_name, '@', 'x', c_nationkey, '.org') END AS e, CASE WHEN e IS NULL THEN NULL ELSE split_part(e, '@', 2) END AS d FROM customer)"
)
def email_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 3
    e = F.when(k == 0, F.concat(F.lit("pay@mail."), F.lower(F.replace("c_mktsegment", F.lit(" "), F.lit(""))), F.lit(".com"))).when(k == 1, F.concat("c_name", F.lit("@x"), F.col("c_nationkey").cast("string"), F.lit(".org")))
    return table(spark, sf_dir, "customer").select("c_custkey", S.email_company(e).alias("company"))


@query(
    f"""SELECT document_id, 'M0' AS remitreceipt_id, a.f AS amount_field, {cents('a.v')} AS m_cents FROM (SELECT document_id, total_remittance_amount AS t, unnest([{{'f': 'total_remittance_amount', 'v': total_remittance_amount}}, {{'f': 'total_amount_paid', 'v': total_amount_paid}}]) AS a FROM (
  SELECT *, (length(n) > 0)::INT * 2 + (length(a) > 0)::INT + length(n) * 0.001 + length(a) * 0.0001 AS q FROM (SELECT *, {norm('payer_name')} AS n, {norm('payer_address')} AS a FROM remit_headers)
  QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY q DESC, remittance_date, total_remittance_amount DESC NULLS LAST, total_amount_paid DESC NULLS LAST, n, a) = 1))
WHERE a.v IS NOT NULL AND NOT (a.f = 'total_amount_paid' AND a.v IS NOT DISTINCT FROM t)""",
    ("remit_headers",),
)
def header_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = view(spark, sf_dir, "remit_headers").withColumn("remitreceipt_id", F.lit("M0"))
    return pipelines.remittance_headers(h).select("document_id", "remitreceipt_id", "amount_field", "m_cents")


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return e.where("id % 20 = 0"), e


_KNN = "n AS (SELECT a.vec_id AS query_id, b.vec_id AS index_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id % 20 = 0), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, index_id) AS rank FROM n QUALIFY rank <= {0})"


@query(f"WITH {_KNN.format(5)} SELECT * FROM k WHERE cosine >= 0.2")
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.knn(*_vectors(spark, sf_dir), k=5, floor=0.2)


@query(f"WITH {_KNN.format(15)}, t AS (SELECT *, coalesce(min(CASE WHEN cosine < 0.35 THEN CASE WHEN rank <= 8 THEN 8 WHEN rank <= 12 THEN 12 ELSE 15 END END) OVER (PARTITION BY query_id), 15) AS tier FROM k WHERE cosine >= 0) SELECT * FROM t WHERE rank <= tier")
def adaptive_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.adaptive_depth(knn.knn(*_vectors(spark, sf_dir), k=15, floor=0.0), "cosine < 0.35")


@query(f"WITH {_KNN.format(5)} SELECT query_id, index_id, cosine FROM k WHERE rank = 1 AND cosine >= 0.2")
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.best_one(knn_topk(spark, sf_dir), "query_id", ["cosine"], "index_id").select("query_id", "index_id", "cosine")


_EDGES = f", {_BLOCK}, x AS (SELECT receipt_id, r_cents, invno AS k, i_cents AS v, block_score AS c FROM e WHERE i_cents > 0 QUALIFY row_number() OVER (PARTITION BY receipt_id ORDER BY block_score DESC, day_diff, invno) <= 15), reach AS (SELECT DISTINCT receipt_id, greatest(1.0, abs(r_cents) * 0.002) AS w FROM x)"
_GROUPS = """, g AS (SELECT receipt_id, r_cents, 1 AS size, k AS members, v AS total, c AS m FROM x
  UNION ALL SELECT receipt_id, a.r_cents, 2, concat(a.k, ',', b.k), a.v + b.v, (a.c + b.c) / 2 FROM x a JOIN x b USING (receipt_id) WHERE a.k < b.k
  UNION ALL SELECT receipt_id, a.r_cents, 3, concat(a.k, ',', b.k, ',', d.k), a.v + b.v + d.v, (a.c + b.c + d.c) / 3 FROM x a JOIN x b USING (receipt_id) JOIN x d USING (receipt_id) WHERE a.k < b.k AND b.k < d.k),
h AS (SELECT receipt_id, members, size, total, round(m, 7) AS mean_score, row_number() OVER (PARTITION BY receipt_id ORDER BY round(m, 7) DESC, abs(total - r_cents), size, members) AS group_rank FROM g JOIN reach USING (receipt_id) WHERE abs(total - r_cents) <= w QUALIFY group_rank <= 30)"""


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = shaping.top_by(block_topk(spark, sf_dir).where("i_cents > 0"), ["receipt_id"], [F.asc("rank0")], 15, "r15")
    return sums.small_sums(e.select("receipt_id", "r_cents", F.col("invno").alias("inv_key"), "i_cents", F.col("block_score").alias("cosine")))


@query(_EDGES + _GROUPS + " SELECT * FROM h", ("receipts",))
def ksum_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(spark, sf_dir).select("receipt_id", "members", F.size("keys").alias("size"), "total", F.col("mean_cosine").alias("mean_score"), "group_rank")


@query(_EDGES + _GROUPS + ", b AS (SELECT *, max(mean_score) OVER (PARTITION BY receipt_id) AS best FROM h) SELECT receipt_id, members FROM b QUALIFY row_number() OVER (PARTITION BY receipt_id ORDER BY (size = 1 AND mean_score >= best - 0.08) DESC, mean_score DESC, members) = 1", ("receipts",))
def prefer_single_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sums.prefer_single(_groups(spark, sf_dir)).select("receipt_id", "members")


@query(
    f""", {_BLOCK}, a AS (SELECT receipt_id, invno AS invoice_key, i_cents AS allocated_cents FROM e QUALIFY row_number() OVER (PARTITION BY receipt_id ORDER BY block_score DESC, day_diff, invno) <= 200),
n AS (SELECT *, (SELECT count(DISTINCT invoice_key) FROM a y WHERE y.receipt_id = a.receipt_id AND allocated_cents > 0) AS o, (SELECT count(DISTINCT receipt_id) FROM a y WHERE y.invoice_key = a.invoice_key AND allocated_cents > 0) AS i FROM a)
SELECT receipt_id, invoice_key, allocated_cents, CASE WHEN allocated_cents <= 0 THEN 'unmatched' WHEN o > 1 AND i > 1 THEN 'many-to-many' WHEN o > 1 THEN 'one-to-many' WHEN i > 1 THEN 'many-to-one' ELSE 'one-to-one' END AS grouping_type,
  CASE WHEN allocated_cents <= 0 THEN 0 WHEN o > 1 THEN o WHEN i > 1 THEN i ELSE 1 END AS group_count FROM n""",
    ("receipts",),
)
def grouping_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.grouping_labels(block_topk(spark, sf_dir).select("receipt_id", F.col("invno").alias("invoice_key"), F.col("i_cents").alias("allocated_cents")))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "struct<k:bigint>")["k"].alias("k"))


@query(
    """, l AS (SELECT document_id, invoice_number, CAST(round(invoice_amount * 100) AS BIGINT) AS c, check_no FROM remit_lines WHERE CAST(substr(document_id, 2) AS BIGINT) % 4 <> 3)
SELECT 'D' || c_custkey AS document_id, any_value(check_no) AS check_number, count(invoice_number) AS line_count, coalesce(CAST(sum(c) AS DOUBLE) / 100, NULL) AS remit_total FROM customer LEFT JOIN l ON document_id = 'D' || c_custkey WHERE 'D' || c_custkey IN (SELECT document_id FROM remit_lines) GROUP BY c_custkey""",
    ("remit_lines",),
)
def remit_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = view(spark, sf_dir, "remit_lines").withColumn("none", F.substring("document_id", 2, 20).cast("long") % 4 == 3)
    line = F.struct(F.col("invoice_number"), F.concat(F.lit("$"), F.format_number("invoice_amount", 2)).alias("amount_paid"))
    j = lines.groupBy("document_id", "none").agg(F.collect_list(line).alias("ls"), F.min("check_no").alias("c"))
    header = F.struct(F.when(~F.col("none"), F.col("c")).alias("check_number"))
    entry = F.array(F.struct(header.alias("remit_header_related_fields"), F.when(~F.col("none"), F.col("ls")).alias("invoice_details")))
    out = remittance_json.remittance_totals(remittance_json.flatten_remittances(j.select("document_id", F.to_json(entry).alias("remittance_fields_json"))))
    return out.select("document_id", "check_number", "line_count", "remit_total")


_SNAP = "t AS (SELECT * FROM tickets WHERE number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY number ORDER BY sys_updated_on DESC NULLS LAST, as_of_date DESC NULLS LAST, event_id DESC) = 1)"


@query(f", {_SNAP} SELECT number, state, assigned_to, category, event_id FROM t", ("tickets",))
def tickets_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets.snapshot(view(spark, sf_dir, "tickets")).select("number", "state", "assigned_to", "category", "event_id")


@query(f", {_SNAP} SELECT number, state, assigned_to, category FROM t WHERE coalesce(state, '') <> 'Closed' AND sys_updated_on < TIMESTAMP '{NOW}' - INTERVAL 7 DAYS ORDER BY sys_updated_on NULLS LAST, number LIMIT 50", ("tickets",))
def tickets_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets.answer(tickets.snapshot(view(spark, sf_dir, "tickets")), "Which open tickets had no update in the last 7 days?", NOW).drop("sys_updated_on")


@query(f", {_SNAP} SELECT number, state, assigned_to, category FROM t WHERE lower(assigned_to) = 'agent3' ORDER BY sys_updated_on DESC NULLS LAST, number LIMIT 100", ("tickets",))
def tickets_assignee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets.answer(tickets.snapshot(view(spark, sf_dir, "tickets")), "What is assigned to Agent3?", NOW).drop("sys_updated_on")


@query(f", {_SNAP} SELECT number, state, assigned_to, category FROM t WHERE number = 'IN00000007' LIMIT 1", ("tickets",))
def ticket_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets.answer(tickets.snapshot(view(spark, sf_dir, "tickets")), "Status of in00000007, please", NOW).drop("sys_updated_on")


@query("SELECT conv_id, turn, concat_ws(chr(10), CASE WHEN trim(coalesce(role, '')) <> '' THEN 'role: ' || role END, CASE WHEN trim(coalesce(text, '')) <> '' THEN 'text: ' || text END) AS text FROM conversations WHERE trim(coalesce(role, '')) <> '' OR trim(coalesce(text, '')) <> ''")
def rag_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumnRenamed("text", "body")
    return c.withColumn("text", S.labelled_text({"role": "role", "text": "body"})).where("text <> ''").select("conv_id", "turn", "text")


@query(
    "SELECT receipt_id AS recpt_receipt_id, r.amount AS recpt_amount, i.invno AS inv_invno, i.invamt AS inv_invamt FROM receipts r LEFT JOIN invoices i ON payercust_custno = custno AND abs(round(r.amount * 100) - round(i.invamt * 100)) <= 1 AND r.currency = i.currency AND abs(date_diff('day', receipt_date, invdate)) <= 90",
    ("receipts",),
)
def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = presolve_exact(spark, sf_dir).select(F.col("receipt_id").alias("m_receipt"), F.col("invno").alias("m_invno"))
    out = shaping.reattach(view(spark, sf_dir, "receipts"), "receipt_id", hits, "m_receipt", "m_invno", view(spark, sf_dir, "invoices"), "invno", ("recpt_", "inv_"))
    return out.select("recpt_receipt_id", "recpt_amount", "inv_invno", "inv_invamt")


@query(
    f""", m AS (SELECT remitreceipt_id, upper(invoice_number) AS m_no, invoice_amount AS a, {cents('invoice_amount')} AS m_cents, invoice_date AS d, currency, {norm('payer_name')} AS n FROM remit_lines),
i AS (SELECT invno, invamt, {cents('invamt')} AS i_cents, invdate, currency, {norm('company')} AS n FROM invoices),
c AS (SELECT remitreceipt_id, invno, m_cents, i_cents, abs(date_diff('day', d, invdate)) AS day_diff, round(0.55 * least(greatest(1 - abs(a - invamt) / greatest(1.0, abs(a)), 0), 1) + 0.20 * (1 - least(abs(date_diff('day', d, invdate)), 365) / 365.0)
  + 0.15 * CASE WHEN m.n <> '' AND left(m.n, 8) = left(i.n, 8) THEN 1 ELSE 0 END + 0.10 * CASE WHEN m_no = upper(invno) THEN 1 ELSE 0 END, 6) AS block_score
  FROM m JOIN i ON m.currency = i.currency AND abs(date_diff('day', d, invdate)) <= 10 AND abs(m_cents - i_cents) <= round(CAST(abs(m_cents) AS DOUBLE) * CAST(0.03 AS DOUBLE)))
SELECT *, row_number() OVER (PARTITION BY remitreceipt_id ORDER BY block_score DESC, day_diff, invno) AS rank0 FROM c QUALIFY rank0 <= 250""",
    ("remit_lines",),
)
def remit_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.remit_blocked_edges(view(spark, sf_dir, "remit_lines"), view(spark, sf_dir, "invoices"))


@query(
    f"""WITH {_KNN.format(6)}, b AS (SELECT query_id, index_id, cosine FROM k WHERE query_id <> index_id AND cosine >= 0.9 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, index_id) = 1)
SELECT vec_id AS query_id, index_id, cosine, coalesce(cosine, 0) AS confidence FROM embeddings LEFT JOIN b ON query_id = vec_id WHERE vec_id % 20 = 0"""
)
def best_match_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, index = _vectors(spark, sf_dir)
    others = knn.knn(queries, index, k=6, floor=0.2).where("query_id <> index_id")
    return reconcile.best_judged(others, queries.select(F.col("id").alias("query_id")), judge.closeness_judge)


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS seq FROM events")
def row_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.sequence_ids(table(spark, sf_dir, "events").select("ts", "event_id"), [F.col("ts"), F.col("event_id")]).select("event_id", "seq")


@query(
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed_date, round(o_totalprice, 2) AS parsed_money, CAST(floor(c / 500) AS BIGINT) AS bucket, CAST(greatest(25, round(CAST(abs(c) AS DOUBLE) * CAST(0.01 AS DOUBLE))) AS BIGINT) AS tolerance,
  CAST(floor(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) / 7) AS INT) AS week_no, CASE WHEN c % 1000 = 0 THEN 1.0 ELSE round(exp(-(c % 1000) / 500.0), 6) END AS decay, strftime(o_orderdate, '%Y-%m') AS month_of FROM (SELECT *, {cents('o_totalprice')} AS c FROM orders)"""
)
def scalar_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.cents("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", S.parse_date(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("parsed_date"), S.money(F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).alias("parsed_money"), S.amount_bucket(c).alias("bucket"), S.tolerance(c, 0.01, 25).alias("tolerance"),
        S.week("o_orderdate").alias("week_no"), F.round(S.amount_decay(c % 1000), 6).alias("decay"), S.month_of("o_orderdate").alias("month_of"),
    )


# --- what SQL can't state: properties are tested in tests/ -----------------------------------------------------------


def _remitted(spark: SparkSession, sf_dir: str) -> reconcile.Reconciled:
    """The newest remittance of each document against all receipts."""
    newest = shaping.latest(view(spark, sf_dir, "remit_headers"), ["document_id"], ["remittance_date", "remitreceipt_id"])
    name = lambda *c: F.concat_ws(" ", *[S.norm_name(x) for x in c])
    m = newest.select(F.col("document_id").alias("remit_id"), "check_no", S.cents("total_remittance_amount").alias("m_cents"), F.col("remittance_date").alias("m_date"), F.col("currency").alias("m_currency"), name("payer_name", "payer_address").alias("m_text"))
    r = view(spark, sf_dir, "receipts").select("receipt_id", "check_num", S.cents("amount").alias("r_cents"), F.col("receipt_date").alias("r_date"), F.col("currency").alias("r_currency"), name("payercust_company", "payercust_address1").alias("r_text"))
    return reconcile.remittances_to_receipts(m, r, judge.trigram_embedder)


@query()
def remittances_to_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _remitted(spark, sf_dir).results


@query()
def remittances_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _remitted(spark, sf_dir).review


@query()
def remittances_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _remitted(spark, sf_dir).chosen


@query()
def vector_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.receipts_to_invoices_by_vectors(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"), judge.trigram_embedder)


@query()
def judged_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.judged_sets(receipt_invoice_sets(spark, sf_dir), judge.closeness_judge)


@query()
def tickets_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tickets.corpus(tickets.snapshot(view(spark, sf_dir, "tickets")), ["state", "assigned_to", "category"])
    return reconcile.similar_tickets(rows.select("number", "text"), judge.trigram_embedder, "purchases of agent3")


@query()
def subset_sum_beam(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = pipelines.invoice_pool(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "shadowed"))
    return subset.beam_sets(pipelines.line_scores(pool, topk=None, large=None).select("receipt_id", "r_cents", "r_tol", "inv_row_id", "amount_c", "balance_c", "invamt_c", "line_score"))


@query()
def receipt_invoice_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.receipts_to_invoice_sets(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "shadowed"))


def _remit_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = block_topk(spark, sf_dir).where(F.col("rank0") <= 15)
    return e.select(F.col("receipt_id").alias("remit_id"), F.col("r_cents").alias("m_cents"), F.col("invno").alias("receipt_id"), F.col("i_cents").alias("r_cents"), F.col("block_score").alias("composite"))


@query()
def subset_dfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subset.subset_allocations(_remit_candidates(spark, sf_dir))


@query()
def conflict_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subset.resolve_conflicts(subset_dfs(spark, sf_dir))


_ROWS = "CASE WHEN n = 1 THEN 'one-to-one' ELSE 'one-to-many' END AS grouping_type, n AS group_count"
#: Each receipt has a customer of its own here, so its cheapest edges are filled one after another. x: receipt_id, invoice_key, r_cents, i_cents, cost.
_FILLED = f"""f AS (SELECT receipt_id, invoice_key, cost, greatest(0, least(i_cents, r_cents - coalesce(sum(i_cents) OVER (PARTITION BY receipt_id ORDER BY cost, invoice_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS v FROM x WHERE r_cents > 0 AND i_cents > 0),
g AS (SELECT receipt_id, invoice_key, CAST(v AS BIGINT) AS allocated_cents, cost, count(*) OVER (PARTITION BY receipt_id) AS n FROM f WHERE v > 0),
left_ AS (SELECT receipt_id, CAST(max(r_cents) - coalesce(max(s), 0) AS BIGINT) AS v FROM x LEFT JOIN (SELECT receipt_id, sum(allocated_cents) AS s FROM g GROUP BY 1) USING (receipt_id) WHERE r_cents > 0 AND i_cents > 0 GROUP BY 1)"""


@query(
    f""", {_BLOCK}, x AS (SELECT receipt_id, invno AS invoice_key, r_cents, i_cents, CAST(round((1 - least(greatest(block_score, 0), 1)) * 1000) AS BIGINT) AS cost FROM e QUALIFY row_number() OVER (PARTITION BY receipt_id ORDER BY block_score DESC, day_diff, invno) <= 200),
{_FILLED}, z AS (SELECT receipt_id, invoice_key, allocated_cents, cost, {_ROWS} FROM g UNION ALL SELECT receipt_id, '__unmatched__', v, 10000, 'unmatched', 0 FROM left_ WHERE v > 0)
SELECT * FROM z UNION ALL SELECT receipt_id, '__unmatched__', 0, NULL, 'unmatched', 0 FROM receipts WHERE receipt_id NOT IN (SELECT receipt_id FROM z)""",
    ("receipts",),
)
def min_cost_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.receipts_to_invoices_flow(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"))


@query(
    f""", {_BLOCK}, p AS (SELECT receipt_id, invno AS invoice_key, least({cents('r.amount')}, {cents('i.invamt')}) AS v FROM receipts r JOIN invoices i ON payercust_custno = custno AND abs(round(r.amount * 100) - round(i.invamt * 100)) <= 1 AND r.currency = i.currency AND abs(date_diff('day', receipt_date, invdate)) <= 90
  QUALIFY row_number() OVER (PARTITION BY receipt_id ORDER BY abs(date_diff('day', receipt_date, invdate)), invno) = 1),
c AS (SELECT receipt_id, invno, r_cents, i_cents, day_diff, block_score, count(*) OVER (PARTITION BY receipt_id) AS candidates FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY receipt_id ORDER BY block_score DESC, day_diff, invno) <= 200) WHERE i_cents > 0 AND receipt_id NOT IN (SELECT receipt_id FROM p WHERE v > 0)),
d AS (SELECT *, 1 - least(day_diff, 365) / 365.0 AS dc, least(greatest(1 - abs(r_cents - i_cents) / 100.0 / greatest(1.0, abs(r_cents) / 100.0), 0), 1) AS ac FROM c),
w AS (SELECT *, CASE WHEN candidates <= 3 THEN least(greatest(CAST(0.75 AS DOUBLE) * ac + CAST(0.20 AS DOUBLE) * dc, 0), 1) ELSE least(greatest(block_score, 0), 1) END AS word FROM d),
x AS (SELECT receipt_id, invno AS invoice_key, r_cents, i_cents, CAST(round((1 - least(greatest(CAST(0.85 AS DOUBLE) * word + CAST(0.10 AS DOUBLE) * dc, 0), 1)) * 1000) AS BIGINT) AS cost FROM w),
{_FILLED}, z AS (SELECT receipt_id, invoice_key, v AS allocated_cents, 0 AS cost, 'presolved' AS method, 'one-to-one' AS grouping_type, 1 AS group_count FROM p WHERE v > 0
  UNION ALL SELECT receipt_id, invoice_key, allocated_cents, cost, 'flow', {_ROWS} FROM g UNION ALL SELECT receipt_id, '__unmatched__', v, 12000, 'unmatched', 'unmatched', 0 FROM left_ WHERE v > 0)
SELECT * FROM z UNION ALL SELECT receipt_id, '__unmatched__', 0, NULL, 'unmatched', 'unmatched', 0 FROM receipts WHERE receipt_id NOT IN (SELECT receipt_id FROM z)""",
    ("receipts",),
)
def presolved_receipt_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reconcile.receipts_to_invoices_presolved(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "invoices"), judge.closeness_judge)
    return out.withColumnRenamed("left_key", "receipt_id")


@query()
def presolved_remittance_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("invno").cast("long")
    paid = F.when(n % 6 == 0, F.round(F.col("invamt") / 4, 2)).otherwise(F.lit(0.0))
    i = view(spark, sf_dir, "invoices").withColumns({"srcinvoice": F.when(n % 3 == 0, F.concat(F.lit("S"), "invno")), "invrefno": F.when(n % 3 == 1, F.col("invno")), "total_amount_paid": paid})
    return reconcile.remittances_to_invoices(view(spark, sf_dir, "remit_lines"), i, judge.closeness_judge).withColumnRenamed("left_key", "remitreceipt_id")


_SAID = "least(greatest(pre_score, 0), 1)"
#: Kept rows with the closeness judge's word on those below {high}, of a worse rank or doubtful; b: ranked rows with match_rank_pre.
_JUDGED = f"""j AS (SELECT *, (pre_score < {{high}} OR match_rank_pre > 1{{doubtful}}) AS asked FROM b),
a AS (SELECT *, CASE WHEN asked THEN pre_score >= 0.9 END AS is_match, CASE WHEN asked THEN {_SAID} END AS confidence, CASE WHEN asked THEN printf('score %.3f', pre_score) END AS reason,
  CASE WHEN asked THEN CAST(0.65 AS DOUBLE) * {_SAID} + CAST(0.35 AS DOUBLE) * pre_score ELSE pre_score END AS final FROM j),
t AS (SELECT * FROM a WHERE CASE WHEN asked THEN is_match AND confidence >= 0.55 ELSE pre_score >= {{high}} END)"""


@query(
    f""", {_SCORED}, o AS (SELECT *, max(pre_score) OVER (PARTITION BY receipt_id) AS best FROM k),
b AS (SELECT *, row_number() OVER (PARTITION BY receipt_id ORDER BY pre_score DESC, amt_diff, document_id, remitreceipt_id, amount_field) AS match_rank_pre FROM o WHERE pre_score >= 0.92 OR (pre_score >= 0.70 AND pre_score >= best - CAST(0.1 AS DOUBLE)) QUALIFY match_rank_pre <= 3),
{_JUDGED.format(high=0.92, doubtful='')}
SELECT receipt_id, document_id, remitreceipt_id, amount_field, is_match, confidence, reason, round(final, 6) AS final_score, row_number() OVER (PARTITION BY receipt_id ORDER BY final DESC, amt_diff, document_id, remitreceipt_id, amount_field) AS match_rank FROM t QUALIFY match_rank <= 3""",
    ("receipts", "remit_headers"),
)
def judged_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pipelines.receipts_to_remittances(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "remit_headers"), high=0.92, second=0.70, margin=0.1, ask=judge.closeness_judge)
    return out.select("receipt_id", "document_id", "remitreceipt_id", "amount_field", "is_match", "confidence", "reason", F.round("final_score", 6).alias("final_score"), "match_rank")


@query(
    f""", {_LINES}, b AS (SELECT *, row_number() OVER (PARTITION BY remit_line_id ORDER BY pre_score DESC, amt_diff, invno) AS match_rank_pre FROM k WHERE pre_score >= 0.85 QUALIFY match_rank_pre <= 3),
{_JUDGED.format(high=0.85, doubtful=' OR NOT invno_match')}
SELECT remit_line_id, invno, is_match, confidence, reason, round(final, 6) AS final_score, row_number() OVER (PARTITION BY remit_line_id ORDER BY final DESC, amt_diff, invno) AS match_rank FROM t QUALIFY match_rank <= 3""",
    ("remit_lines",),
)
def remit_lines_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pipelines.remit_lines_to_invoices(view(spark, sf_dir, "remit_lines"), view(spark, sf_dir, "invoices"), ask=judge.closeness_judge)
    return out.select("remit_line_id", "invno", "is_match", "confidence", "reason", F.round("final_score", 6).alias("final_score"), "match_rank")


@query(
    f""", {_BLOCK}, p AS (SELECT DISTINCT receipt_id FROM receipts r JOIN invoices i ON payercust_custno = custno AND abs(round(r.amount * 100) - round(i.invamt * 100)) <= 1 AND r.currency = i.currency AND abs(date_diff('day', receipt_date, invdate)) <= 90),
o AS (SELECT *, row_number() OVER (PARTITION BY receipt_id ORDER BY block_score DESC, invno) AS k FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY receipt_id ORDER BY block_score DESC, day_diff, invno) <= 200) WHERE receipt_id NOT IN (SELECT receipt_id FROM p))
SELECT receipt_id, count(*) AS candidates, max(block_score) AS max_score, '[' || string_agg('{{"invno":"' || invno || '","block_score":' || CAST(block_score AS VARCHAR) || '}}', ',' ORDER BY k) FILTER (WHERE k <= 5) || ']' AS top_candidates FROM o GROUP BY receipt_id""",
    ("receipts",),
)
def ambiguous_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.ambiguous(block_topk(spark, sf_dir), presolve_exact(spark, sf_dir), "receipt_id", "block_score", "invno")


@query("SELECT receipt_id, 64 AS size FROM receipts", ("receipts",))
def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies' vectors from a stored index that takes in a part of the receipts, then all: what is there isn't embedded again."""
    names = view(spark, sf_dir, "receipts").select("receipt_id", S.norm_name("payercust_company").alias("text"))
    at = vector_store.scratch_path(spark)
    vector_store.synchronise(spark, at, names.where("receipt_id < 'R5'"), judge.trigram_embedder, "receipt_id")
    return vector_store.synchronise(spark, at, names, judge.trigram_embedder, "receipt_id").select(F.col("id").alias("receipt_id"), F.size("vector").alias("size"))
