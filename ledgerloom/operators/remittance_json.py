"""Remittance and receipt JSON to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

HEADER = "struct<payer_name:string,check_number:string,check_date:string,total_amount:string,currency:string>"
LINE = "struct<invoice_number:string,invoice_date:string,invoice_amount:string,discount:string,amount_paid:string>"
ENTRY = f"struct<remit_header_related_fields:{HEADER},other_header_related_fields:map<string,string>,invoice_details:array<{LINE}>,other_invoice_related_fields:map<string,string>>"
RECEIPT = "struct<receipt_num:string,check_num:string,batch_id:string,amount:double,receipt_date:string,currcode:string,payercust_company:string,micr_routing:string,micr_acct:string,payment_type:string>"


def flatten_remittances(df: DataFrame, json_col: str = "remittance_fields_json", keys: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """A row for each invoice line of each entry, entries without lines too; money and dates typed, NULL where unreadable."""
    entries = df.select(*keys, F.from_json(S.flat_lines(json_col), f"array<{ENTRY}>").alias("e"))
    one = entries.select(*keys, F.posexplode_outer("e").alias("entry_no", "x"))
    line = one.select(*keys, "entry_no", F.col("x.remit_header_related_fields").alias("h"), F.col("x.other_header_related_fields").alias("other_header"), F.col("x.other_invoice_related_fields").alias("other_invoice"), F.posexplode_outer("x.invoice_details").alias("line_no", "l"))
    return line.select(
        *keys, "entry_no", "line_no", F.col("h.payer_name").alias("payer_name"), F.col("h.check_number").alias("check_number"), S.parse_date("h.check_date").alias("check_date"), S.money("h.total_amount").alias("total_amount"),
        F.coalesce(F.upper("h.currency"), F.lit("USD")).alias("currency"), F.col("l.invoice_number").alias("invoice_number"), S.parse_date("l.invoice_date").alias("invoice_date"), S.money("l.invoice_amount").alias("invoice_amount"),
        S.money("l.discount").alias("discount"), S.money("l.amount_paid").alias("amount_paid"), "other_header", "other_invoice",
    )


def remittance_totals(lines: DataFrame, keys: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """Per remittance the first header value that is there, and its total: what the lines pay, else the header's."""
    by = F.struct("entry_no", "line_no")
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), by)).alias(c)
    out = lines.groupBy(*keys).agg(*[first(c) for c in ("payer_name", "check_number", "check_date", "total_amount", "currency")], F.round(F.sum("amount_paid"), 2).alias("paid"), F.count("invoice_number").alias("line_count"))
    return out.withColumn("remit_total", F.coalesce("paid", "total_amount")).drop("paid")


def parse_receipts(df: DataFrame, json_col: str = "receipt_json_fields", id_col: str = "receipt_id") -> DataFrame:
    """Receipt objects as columns; a misspelt id column (receiptI_id) is taken too; unreadable text gives NULLs."""
    id_col = id_col if id_col in df.columns else "receiptI_id"
    x = df.select(F.col(id_col).alias("receipt_id"), F.from_json(json_col, RECEIPT).alias("x"))
    return x.select("receipt_id", "x.*").withColumn("receipt_date", S.parse_date("receipt_date"))


def extract(df: DataFrame, extractor, text_col: str = "transcript", partitions: int | None = None) -> DataFrame:
    """df with `extracted`: each distinct text goes through extractor(list of texts) -> list of JSON texts once."""
    import pandas as pd

    def run(frames):
        for pdf in frames:
            yield pd.DataFrame({"__text": pdf["__text"], "extracted": extractor(pdf["__text"].tolist())})

    todo = df.select(F.col(text_col).alias("__text")).where("__text IS NOT NULL").distinct()
    todo = todo.repartition(partitions) if partitions else todo
    return df.join(todo.mapInPandas(run, "__text string, extracted string"), F.col(text_col) == F.col("__text"), "left").drop("__text")
