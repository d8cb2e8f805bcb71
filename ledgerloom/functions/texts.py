"""Texts of entities for embedding: a head word, then labelled values in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Of each text its head, its labels with the columns that give them ('|': the first that is filled, '/': both
# with a slash between, '[n]': so many lines of invoice_items), and whether the length bound holds for the last value or the whole.
COMPOSITIONS: dict[str, tuple[str, tuple[tuple[str, str], ...], str]] = {
    "remittance": ("REMITTANCE", (("PAYER", "vendor_name|payer"), ("CUR", "currency"), ("AMT", "total_amount|amount"), ("DATE", "remittance_date|check_date"), ("CHECK", "check_number"), ("BANKREF", "bank_ref"), ("PO", "po_number"), ("INV", "invoice_number"), ("DESC", "memo|raw_text")), "last"),
    "receipt": ("RECEIPT", (("PAYER", "payer"), ("CUR", "currency"), ("AMT", "amount"), ("DATE", "receipt_date|posting_date|payment_date"), ("CHECK", "check_num"), ("BATCH", "batch_id"), ("TXN", "transaction_id"), ("PO", "po_number"), ("INV", "invoice_number"), ("DESC", "remarks|raw_text")), "last"),
    "remittance_with_lines": ("REMITTANCE", (("PAYER", "vendor_name"), ("CUR", "currency"), ("AMT", "total_amount"), ("DATE", "remittance_date"), ("CHECK", "check_number"), ("LINES", "[12]")), "last"),
    "remittance_with_few_lines": ("REMITTANCE", (("PAYER", "vendor_name"), ("CUR", "currency"), ("AMT", "total_amount"), ("DATE", "remittance_date"), ("CHECK", "check_number"), ("LINES", "[8]")), "last"),
    "receipt_with_account": ("RECEIPT", (("PAYER", "payer_name"), ("CUR", "currency"), ("AMT", "amount"), ("DATE", "receipt_date"), ("CHECK", "check_num"), ("BATCH", "batch_id"), ("PAYTYPE", "payment_type"), ("MICR", "micr_routing/micr_acct")), "none"),
    "receipt_short": ("RECEIPT", (("PAYER", "payer_name"), ("CUR", "currency"), ("AMT", "amount"), ("DATE", "receipt_date"), ("CHECK", "check_num"), ("BATCH", "batch_id")), "none"),
    "remittance_line": ("REMIT_LINE", (("VENDOR", "vendor_name"), ("CUR", "currency"), ("AMT", "amount_paid|invoice_amount"), ("INV", "invoice_number"), ("IDATE", "invoice_date"), ("RDATE", "remittance_date"), ("CHK", "check_number"), ("TYPE", "vendor_type")), "whole"),
    "receipt_line": ("RECEIPT_LINE", (("PAYER", "payercust_company"), ("CUR", "currcode"), ("AMT", "amount"), ("RDATE", "receipt_date"), ("CHK", "check_num"), ("BATCH", "batch_id"), ("MICR", "micr_routing/micr_acct")), "whole"),
    "receipt_line_with_bank": ("RECEIPT_LINE", (("PAYER", "payercust_company"), ("CUR", "currcode"), ("AMT", "amount"), ("RDATE", "receipt_date"), ("CHK", "check_num"), ("BATCH", "batch_id"), ("MICR", "micr_routing/micr_acct"), ("UNAP", "unapplied_amount"), ("ADDR", "payer_address"), ("BANK", "bank_name")), "whole"),
    "invoice_line": ("INVOICE_LINE", (("INVNO", "invno"), ("CUR", "trancurr"), ("AMT", "amount|invamt"), ("IDATE", "invdate"), ("DUEDATE", "duedate"), ("CUST", "custno"), ("CHK", "checknum"), ("PO", "invponum"), ("BAL", "balance"), ("ADDR", "bill_to_address")), "whole"),
}


def _filled(df: DataFrame, name: str) -> Column:
    """The column as trimmed text, NULL if it is blank or missing."""
    return F.nullif(F.trim(F.col(name).cast("string")), F.lit("")) if name in df.columns else F.lit(None).cast("string")


def _value(df: DataFrame, rule: str) -> Column:
    if rule.startswith("["):
        if "invoice_items" not in df.columns:
            return F.lit("")
        text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
        line = lambda i: F.concat(text(i["invoice_number"]), F.lit(":"), text(F.coalesce(i["amount_paid"], i["invoice_amount"])))
        return F.coalesce(F.array_join(F.transform(F.slice("invoice_items", 1, int(rule[1:-1])), line), " ; "), F.lit(""))
    if "/" in rule:
        return F.concat_ws("/", *[F.coalesce(_filled(df, c), F.lit("")) for c in rule.split("/")])
    return F.coalesce(*[_filled(df, c) for c in rule.split("|")], F.lit(""))


def composed(df: DataFrame, kind: str, most: int = 1000, to: str = "text") -> DataFrame:
    """df with the text of one of COMPOSITIONS in column `to`; missing columns count as blank, `most` bounds its length."""
    head, parts, bound = COMPOSITIONS[kind]
    values = [_value(df, rule) for _, rule in parts]
    if bound == "last":
        values[-1] = F.substring(values[-1], 1, most)
    text = F.concat_ws(" ", F.lit(head), *[F.concat(F.lit(f"{label} "), v) for (label, _), v in zip(parts, values)])
    return df.withColumn(to, F.substring(text, 1, most) if bound == "whole" else text)
