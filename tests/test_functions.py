"""Column builders on edge rows."""

import datetime as dt
import math

from ledgerloom.functions import scalars as S
from ledgerloom.functions import scores as W
from ledgerloom.functions import texts
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], T.StructType([T.StructField(k, kind(v)) for k, v in values.items()])) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def kind(v):
    if isinstance(v, bool):
        return T.BooleanType()
    return {int: T.LongType(), float: T.DoubleType(), dt.date: T.DateType(), dt.datetime: T.TimestampType()}.get(type(v), T.StringType())


def test_names(spark):
    for raw, want in [(" ACME, Inc. ", "acme"), ("Inc.", ""), (None, ""), ("Über-Köln GmbH & Co", "ber k ln gmbh"), ("Incline  Company Ltd", "incline"), ("A1 Corp/2", "a1 2")]:
        assert one(spark, S.norm_name("a"), a=raw) == want
    assert one(spark, S.similarity("a", "b"), a="", b="") == 1
    assert one(spark, S.similarity("a", "b"), a="abcd", b="abxd") == 0.75
    assert one(spark, S.similarity_or_null("a", "b"), a="", b="x") is None


def test_money(spark):
    for raw, want in [("1,234.50", 1234.5), ("$5", 5.0), ("", None), ("x", None), (None, None), ("-3.2", -3.2)]:
        assert one(spark, S.money("a"), a=raw) == want
    assert one(spark, S.cents("a"), a=2.345) in (234, 235) and one(spark, S.cents("a"), a=0.005) == 1
    assert one(spark, S.tolerance("a", 0.01, 25), a=-100000) == 1000 and one(spark, S.tolerance("a", 0.01, 25), a=100) == 25
    assert one(spark, S.amount_bucket("a"), a=-1) == -1 and one(spark, S.tolerance_buckets("a"), a=501) == 2
    assert one(spark, S.amount_decay("a"), a=0) == 1 and math.isclose(one(spark, S.amount_decay("a"), a=500), math.exp(-1))
    assert one(spark, S.amount_ok("a", "b"), a=101.0, b=100.0) and not one(spark, S.amount_ok("a", "b"), a=103.0, b=100.0)
    assert one(spark, S.amount_close("a", "b"), a=100.1, b=100.0) and not one(spark, S.amount_close("a", "b"), a=None, b="1")


def test_dates(spark):
    d = dt.date(2024, 3, 14)
    for raw in ("2024-03-14", "03/14/2024", "14-Mar-2024", "2024/03/14", "3/14/2024", "20240314"):
        assert one(spark, S.parse_date("a"), a=raw) == d, raw
    assert one(spark, S.parse_date("a"), a="13/45/2024") is None and one(spark, S.parse_date("a"), a="") is None
    assert one(spark, S.parse_timestamp("a"), a="2024-03-14 01:02:03 GMT") == dt.datetime(2024, 3, 14, 1, 2, 3)
    assert one(spark, S.week("a"), a=dt.date(1970, 1, 7)) == 0 and one(spark, S.week("a"), a=dt.date(1970, 1, 8)) == 1 and one(spark, S.week("a"), a=dt.date(1969, 12, 31)) == -1
    assert one(spark, S.date_closeness("a"), a=0) == 1 and one(spark, S.date_closeness("a"), a=None) is not None
    assert one(spark, S.date_ok("a", "b", 5), a=None, b=None) is True


def test_currencies_keys_and_json(spark):
    assert one(spark, S.currency_ok("a", "b"), a="usd", b=None) and not one(spark, S.currency_ok("a", "b", "strict"), a="usd", b=None)
    assert one(spark, S.currency_ok("a", "b", "default"), a="usd", b=None) and not one(spark, S.currency_ok("a", "b"), a="usd", b="EUR")
    assert one(spark, S.hash_key("a", "b"), a=None, b="x") != one(spark, S.hash_key("a", "b"), a="x", b=None)
    assert one(spark, S.email_company("a"), a="me@mail.acme.co") == "ACME" and one(spark, S.email_company("a"), a="nobody") is None and one(spark, S.email_company("a"), a=None) is None
    x = one(spark, S.salvaged_json("a", "a int"), a='Sure: {"a": 3} done')
    assert x.a == 3 and one(spark, S.salvaged_json("a", "a int"), a='{"a": 4}').a == 4 and one(spark, S.salvaged_json("a", "a int"), a="none") is None
    v = one(spark, S.unit_vector(F.array(F.lit(3.0), F.lit(4.0))))
    assert math.isclose(v[0], 0.6, rel_tol=1e-9) and math.isclose(v[1], 0.8, rel_tol=1e-9)
    assert one(spark, S.labelled_text({"x": "a", "y": "b"}), a="1", b=" ") == "x: 1"
    assert one(spark, S.asked_ticket("a"), a="see in00000012 now") == "IN00000012" and one(spark, S.asked_days("a"), a="in the last 3 days") == 3 and one(spark, S.asked_days("a"), a="for 3 days") == 7 and one(spark, S.asked_days("a"), a="") == 7


def test_scores(spark):
    assert math.isclose(one(spark, W.RECEIPT_REMITTANCE.score(amount=F.lit(1.0), date=F.lit(1.0), name=F.lit(1.0), address=F.lit(None))), 0.9)
    for w in (W.RECEIPT_REMITTANCE, W.REMITTANCE_INVOICE, W.RECEIPT_INVOICE_LINE, W.RERANK, W.BLOCK_RECEIPT, W.BLOCK_REMITTANCE, W.FEW_RECEIPT, W.FEW_REMITTANCE, W.COST_GLOBAL, W.COST_BLOCK):
        assert math.isclose(sum(x for _, x in w.parts), 1.0)
    assert one(spark, W.cost(F.lit(1.2))) == 0 and one(spark, W.cost(F.lit(0.25))) == 750
    assert one(spark, W.keeps("m", "c", "p", 0.9), m=True, c=0.5, p=0.99) is False


def test_names_are_cleaned_as_step_by_step(spark):
    """One pass over the name against cleaning it step by step."""
    import random
    import re

    rng = random.Random(3)
    bits = ["Inc", "inc.", "CO", "company", "Acme", "limited_", "_llc", "co-op", "corp", " ", "  ", "-", ".", "é", "9", "incx", "xinc", "Ltd", "\t"]
    names = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) for _ in range(2000)]

    def plain(x):
        s = re.sub("[^a-z0-9 ]", " ", x.lower().strip())
        s = re.sub(r"\b(inc|llc|ltd|corp|co|company|incorporated|limited|corporation)\b", "", re.sub(r"\s+", " ", s))
        return re.sub(r"\s+", " ", s).strip()

    got = spark.createDataFrame([(x,) for x in names], "a string").select("a", S.norm_name("a").alias("n")).collect()
    assert [(r.a, r.n) for r in got if r.n != plain(r.a)] == []
    assert one(spark, S.norm_name("a"), a=None) == ""


def test_composed_texts(spark):
    df = spark.createDataFrame([("Acme", None, 5.5, [("I1", 2.0, None), ("I2", None, 3.0)], "x" * 50)], "vendor_name string, payer string, total_amount double, invoice_items array<struct<invoice_number: string, amount_paid: double, invoice_amount: double>>, memo string")
    text = lambda kind, most=1000: texts.composed(df, kind, most).first().text
    assert text("remittance", 4) == "REMITTANCE PAYER Acme CUR  AMT 5.5 DATE  CHECK  BANKREF  PO  INV  DESC xxxx"
    assert text("remittance_with_lines") == "REMITTANCE PAYER Acme CUR  AMT 5.5 DATE  CHECK  LINES I1:2.0 ; I2:3.0"
    assert text("receipt_with_account").endswith("MICR /") and len(text("invoice_line", 20)) == 20
    for kind in texts.COMPOSITIONS:
        assert text(kind).split(" ")[0] in ("REMITTANCE", "RECEIPT", "REMIT_LINE", "RECEIPT_LINE", "INVOICE_LINE")
