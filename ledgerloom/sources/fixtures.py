"""The driver's tables as receipts, invoices, remittances and tickets: one SQL text for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

INVOICES = """
SELECT CAST(o_custkey AS STRING) AS custno, CAST(o_orderkey AS STRING) AS invno, c_name AS company,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) / 100 AS invamt, CAST(ext_c AS DOUBLE) / 100 AS amount,
       CAST(net_c AS DOUBLE) / 100 AS balance, CAST(gross_c AS DOUBLE) / 100 AS app_amount,
       CAST(o_orderdate AS DATE) AS invdate, CAST(o_orderdate AS DATE) AS created_on, CAST(o_orderdate AS DATE) AS modified_on,
       CASE WHEN o_custkey % 10 = 9 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAYS AS DATE) ELSE DATE '2002-02-01' END AS duedate,
       CASE WHEN o_custkey % 10 = 9 THEN CAST(date_trunc('month', o_orderdate) AS DATE) ELSE DATE '2002-01-01' END AS app_date,
       CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' END AS rcl_open_close,
       o_orderpriority AS salespn, c_mktsegment AS salesarea, o_orderpriority AS modified_by,
       CASE WHEN n_regionkey % 2 = 0 THEN 'USD' ELSE 'EUR' END AS currency, n_name AS address
FROM orders LEFT JOIN (
  SELECT l_orderkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS ext_c,
         CAST(sum(CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS net_c,
         CAST(sum(CAST(round(l_extendedprice * (1 - l_discount) * (1 + l_tax) * 100) AS BIGINT)) AS BIGINT) AS gross_c
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
"""

#: Each seventh open invoice once more as closed.
SHADOWED = "SELECT * FROM invoices UNION ALL SELECT custno, invno, company, invamt, amount, balance, app_amount, invdate, created_on, modified_on, duedate, app_date, 'closed' AS rcl_open_close, salespn, salesarea, modified_by, currency, address FROM invoices WHERE rcl_open_close = 'open' AND CAST(invno AS BIGINT) % 7 = 0"

RECEIPTS = """
SELECT concat('R', custno) AS receipt_id, custno AS payercust_custno, concat(company, ' Inc.') AS payercust_company, address AS payercust_address1, currency,
       CASE WHEN CAST(custno AS BIGINT) % 7 = 3 THEN NULL ELSE concat('CHK', custno) END AS check_num, receipt_date,
       CAST(CASE CAST(custno AS BIGINT) % 5 WHEN 0 THEN c1 WHEN 1 THEN c1 + coalesce(c2, 0) WHEN 2 THEN CAST(round(c1 * 1.004) AS BIGINT) WHEN 3 THEN c1 + 12345678 ELSE year_c END AS DOUBLE) / 100 AS amount
FROM (
  SELECT custno, company, address, currency, receipt_date, max(CASE WHEN rn = 1 THEN c END) AS c1, max(CASE WHEN rn = 2 THEN c END) AS c2,
         CAST(sum(CASE WHEN invdate >= CAST(receipt_date - INTERVAL 12 MONTHS AS DATE) THEN c ELSE 0 END) AS BIGINT) AS year_c
  FROM (
    SELECT custno, company, address, currency, invdate, CAST(round(invamt * 100) AS BIGINT) AS c,
           row_number() OVER (PARTITION BY custno ORDER BY invdate DESC, CAST(invno AS BIGINT)) AS rn,
           max(invdate) OVER (PARTITION BY custno) + CAST(CAST(custno AS BIGINT) % 10 AS INT) AS receipt_date
    FROM invoices) AS x
  GROUP BY custno, company, address, currency, receipt_date) AS y
"""

REMIT_LINES = """
SELECT concat('D', custno) AS document_id, concat('M', invno) AS remitreceipt_id, CASE WHEN CAST(invno AS BIGINT) % 11 = 0 THEN NULL ELSE invno END AS invoice_number,
       CAST(invdate + CAST(CAST(invno AS BIGINT) % 5 AS INT) AS DATE) AS invoice_date, invamt AS invoice_amount, coalesce(amount, 0) - coalesce(balance, 0) AS invoice_discount,
       balance AS amount_paid, CASE WHEN CAST(invno AS BIGINT) % 13 = 0 THEN '' ELSE concat(company, ', L.L.C.') END AS payer_name, address AS payer_address, currency,
       concat('CHK', custno) AS check_no
FROM invoices
"""

REMIT_HEADERS = """
SELECT document_id, remitreceipt_id, invoice_amount AS total_remittance_amount,
       CASE WHEN CAST(substr(remitreceipt_id, 2) AS BIGINT) % 2 = 0 THEN invoice_amount ELSE amount_paid END AS total_amount_paid,
       invoice_date AS remittance_date, payer_name, payer_address, currency, check_no
FROM remit_lines
"""

TICKETS = """
SELECT concat('IN', lpad(CAST(user_id AS STRING), 8, '0')) AS number, CASE event_type WHEN 'purchase' THEN 'Closed' WHEN 'click' THEN NULL ELSE event_type END AS state,
       concat('agent', CAST(user_id % 10 AS STRING)) AS assigned_to, event_type AS category, CAST(ts AS TIMESTAMP) AS sys_updated_on, CAST(ts AS DATE) AS as_of_date, event_id, props
FROM events
"""

VIEWS = {"invoices": INVOICES, "receipts": RECEIPTS, "shadowed": SHADOWED, "remit_lines": REMIT_LINES, "remit_headers": REMIT_HEADERS, "tickets": TICKETS}
_NEEDS = {"receipts": ("invoices",), "shadowed": ("invoices",), "remit_lines": ("invoices",), "remit_headers": ("remit_lines",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain view over the tables of sf_dir."""
    frames = {t: table(spark, sf_dir, t) for t in TABLES if f" {t}" in _text(name)}
    return spark.sql(with_views(name, f"SELECT * FROM {name}", "{%s}"), **frames) if frames else spark.sql(with_views(name, ""))


def _order(name: str) -> list[str]:
    return [x for n in _NEEDS.get(name, ()) for x in _order(n)] + [name]


def _text(name: str) -> str:
    return " ".join(VIEWS[n] for n in _order(name))


def with_views(names: str | tuple[str, ...], query: str, marker: str = "%s") -> str:
    """query behind the WITH clause of the views that it names; marker: how base tables are written."""
    import re

    order = list(dict.fromkeys(x for n in ([names] if isinstance(names, str) else names) for x in _order(n)))
    texts = {n: re.sub(rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b", lambda m: f"{m[1]} {marker % m[2]}", VIEWS[n]) for n in order}
    return "WITH " + ", ".join(f"{n} AS ({texts[n]})" for n in order) + " " + query
