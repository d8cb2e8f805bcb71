"""Staged and vector matching on small frames, and amount bands against the plain condition."""

import datetime as dt
import random

from ledgerloom.functions import scalars as S
from ledgerloom.operators import blocking, judge
from ledgerloom.plans import reconcile
from pyspark.sql import functions as F


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_amount_bands_hold_every_pair(spark):
    rng = random.Random(0)
    for pct, least in ((0.01, 0), (0.05, 150), (0.2, 500), (0.0, 0), (0.0, 300)):
        rows = []
        for _ in range(3000):
            a = rng.choice([0, 1, -1, rng.randint(-500, 500), rng.randint(-(10**9), 10**9)])
            t = max(least, int(abs(a) * pct + 0.5))
            rows.append((a, a + rng.choice([t, -t, rng.randint(-t, t)])))
        far = spark.createDataFrame(rows, "a long, b long").where(F.abs(S.amount_band("a", pct, least) - S.amount_band("b", pct, least)) > 1)
        assert far.collect() == []


def test_banded_joins_are_the_theta_join(spark):
    rng = random.Random(1)
    make = lambda p, n: [(f"{p}{k}", day(rng.randint(0, 90)), rng.choice([0, rng.randint(-300, 300), rng.randint(1, 90_000)])) for k in range(n)] + [(f"{p}null", None, 5), (f"{p}none", day(3), None)]
    a, b = make("a", 120), make("b", 150)
    x, y = spark.createDataFrame(a, "x string, xd date, xv long"), spark.createDataFrame(b, "y string, yd date, yv long")
    near = F.abs(F.col("xv") - F.col("yv")) <= S.tolerance("xv", 0.1, 40)
    ok = lambda p, q, days: None not in (p[1], q[1], p[2], q[2]) and abs((p[1] - q[1]).days) <= days and abs(p[2] - q[2]) <= max(40, int(abs(p[2]) * 0.1 + 0.5))
    for days in (7, 30):
        want = sorted((p[0], q[0]) for p in a for q in b if ok(p, q, days))
        in_days = S.days_apart("xd", "yd") <= days
        for side in ("left", "right"):
            got = blocking.week_band_join(x, y, "xd", "yd", days // 7 + 1, near & in_days, side, ("xv", "yv", 0.1, 40))
            assert sorted((r.x, r.y) for r in got.collect()) == want and want
        got = blocking.wide_block_join(x, y, "xd", "yd", near, days, ("xv", "yv", 0.1, 40))
        assert sorted((r.x, r.y) for r in got.collect()) == want
        assert "NestedLoop" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()


def test_remittances_to_receipts(spark):
    m = [("m1", "c1", 1000, day(3), "USD", "acme"), ("m2", None, 700, day(3), None, "beta gmbh"), ("m3", None, 50, day(3), "USD", "nobody"), ("m4", None, 999, day(3), "USD", "gamma ag"), ("m5", "c5", 10, None, "USD", None)]
    r = [("r1", "c1", 1000, day(5), "USD", "acme"), ("r2", None, 300, day(4), "USD", "beta gmbh"), ("r3", "x", 400, day(9), "EUR", "beta gmbh"), ("r4", None, 998, day(9), "EUR", "gamma ag"), ("r5", None, 500, day(9), "USD", "gamma ag"), ("r6", None, 5000, day(3), "USD", "beta gmbh")]
    frames = spark.createDataFrame(m, "remit_id string, check_no string, m_cents long, m_date date, m_currency string, m_text string"), spark.createDataFrame(r, "receipt_id string, check_num string, r_cents long, r_date date, r_currency string, r_text string")
    results, review, chosen = reconcile.remittances_to_receipts(*frames, judge.trigram_embedder)
    assert sorted((x.remit_id, x.receipt_id or "", x.method) for x in results.collect()) == [("m1", "r1", "check"), ("m2", "r2", "subset"), ("m2", "r3", "subset"), ("m3", "", "unmatched"), ("m4", "", "unmatched"), ("m5", "", "unmatched")]
    assert [(x.remit_id, x.candidates) for x in review.collect()] == [("m4", 1)]
    assert sorted((x.remit_id, x.receipts, x.diff_cents) for x in chosen.collect()) == [("m1", 1, 0), ("m2", 2, 0)]
    empty = reconcile.remittances_to_receipts(frames[0], frames[1].limit(0), judge.trigram_embedder)
    assert {x.method for x in empty.results.collect()} == {"unmatched"} and empty.review.collect() == [] and empty.chosen.collect() == []


def test_best_judged(spark):
    pairs = spark.createDataFrame([(1, 7, 0.95), (1, 5, 0.95), (1, 2, 0.91), (2, 9, 0.3)], "query_id long, index_id long, cosine double")
    got = reconcile.best_judged(pairs, spark.createDataFrame([(1,), (2,), (3,)], "query_id long"), judge.closeness_judge).collect()
    assert sorted((r.query_id, r.index_id or 0, r.confidence) for r in got) == [(1, 5, 0.95), (2, 0, 0.0), (3, 0, 0.0)]


def test_stages_read_their_inputs_once(spark, tmp_path):
    r = spark.createDataFrame([("R1", "C", 30.0, day(20)), ("R2", "C", 20.0, day(20)), ("R3", "C", 5.0, day(20))], "receipt_id string, payercust_custno string, amount double, receipt_date date")
    i = spark.createDataFrame([("C", "1", day(3), 10.0), ("C", "2", day(5), 20.0)], "custno string, invno string, invdate date, invamt double")
    i = i.withColumns({"created_on": F.col("invdate"), "modified_on": F.col("invdate"), "app_date": F.lit(day(1)), "duedate": F.lit(day(1)), **{c: F.col("invamt") for c in ("amount", "balance", "app_amount")}})
    for name, frame in (("r", r), ("i", i)):
        frame.write.parquet(str(tmp_path / name))
    out = reconcile.receipts_to_invoices_staged(spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "i")))
    assert "FileScan" not in out._jdf.queryExecution().toString()
    assert sorted((x.receipt_id, x.stage, x.match_basis, x.line_count) for x in out.collect()) == [("R1", 1, "sum_amount", 2), ("R2", 2, "greedy_amount", 1)]


def test_vector_flow(spark):
    r = spark.createDataFrame([("R1", 100.0, day(5), "USD", "Acme Inc"), ("R2", 100.0, day(5), None, "Acme"), ("R3", 7.0, day(5), "EUR", None)], "receipt_id string, amount double, receipt_date date, currency string, payercust_company string")
    i = spark.createDataFrame([("7", 100.0, day(3), "USD", "Acme"), ("8", 104.0, day(40), "USD", "Acme Ltd"), ("9", 100.0, day(400), "USD", "Acme")], "invno string, invamt double, invdate date, currency string, company string")
    got = reconcile.receipts_to_invoices_by_vectors(r, i, judge.trigram_embedder).toPandas()
    real = got[got.invoice_key.isin(["7", "8", "9"])]
    assert set(got.receipt_id) == {"R1", "R2", "R3"} and set(real.invoice_key) == {"7", "8"}
    assert real.groupby("receipt_id").allocated_cents.sum().to_dict() == {"R1": 10000, "R2": 10000}
    assert real.groupby("invoice_key").allocated_cents.sum().le(10400).all() and set(got[got.receipt_id == "R3"].grouping_type) == {"unmatched"}


def test_vector_flow_pairs_copies_once(spark, monkeypatch):
    """Equal receipts and invoices meet once a class, and each receipt still has its invoices, the smallest keys of equal ones."""
    seen, edges, join, allocate = [], [], blocking.wide_block_join, reconcile.flow.allocate
    monkeypatch.setattr(blocking, "wide_block_join", lambda a, b, *x: seen.append((a.count(), b.count())) or join(a, b, *x))
    monkeypatch.setattr(reconcile.flow, "allocate", lambda e: edges.extend(e.collect()) or allocate(e))
    r = spark.createDataFrame([(f"R{k:02}", 100.0, day(5), None, "Acme") for k in range(12)], "receipt_id string, amount double, receipt_date date, currency string, payercust_company string")
    i = spark.createDataFrame([(f"I{k:02}", 100.0 + k % 2, day(3), "USD", "Acme") for k in range(40)], "invno string, invamt double, invdate date, currency string, company string")
    got = reconcile.receipts_to_invoices_by_vectors(r, i, judge.trigram_embedder).toPandas()
    assert seen == [(1, 2)]
    assert {(x.receipt_id, x.invoice_key) for x in edges} == {(f"R{k:02}", f"I{j:02}") for k in range(12) for j in range(0, 16, 2)}
    real = got[got.invoice_key != "__unmatched__"]
    assert real.allocated_cents.sum() == 8 * 10000 and got.groupby("receipt_id").allocated_cents.sum().eq(10000).all()


def test_judged_sets(spark):
    rows = [("R1", 1, "amount", 1000, 0, "a", "k1"), ("R1", 1, "amount", 1000, 0, "b", "k2"), ("R1", 2, "amount", 500, 400, "a", "k1"), ("R1", 1, "shadow_open", 0, 0, "c", "k1"), ("R2", 9, "amount", 5, 0, "z", "k")]
    got = reconcile.judged_sets(spark.createDataFrame(rows, "receipt_id string, set_rank int, matched_field string, matched_cents long, diff_cents long, inv_row_id string, inv_key string"), judge.closeness_judge).collect()
    assert sorted((r.receipt_id, r.set_rank, r.line_count, r.is_match) for r in got) == [("R1", 1, 2, True), ("R1", 2, 1, False), ("R2", 9, 1, None)]


def test_similar_tickets(spark):
    t = spark.createDataFrame([("IN1", "printer is broken"), ("IN2", "mail is slow"), ("IN3", "printer broke")], "number string, text string")
    got = reconcile.similar_tickets(t, judge.trigram_embedder, "broken printer", 2).orderBy("rank").collect()
    assert {r.number for r in got} == {"IN1", "IN3"} and [r["rank"] for r in got] == [1, 2]


def test_remittances_to_invoices_presolves_and_keeps_to_the_room(spark):
    """Exact numbers first, each invoice once; the rest by flow over what payments and exact pairs leave of an invoice."""
    lines = [("M1", "INV1", 100.0), ("M2", "inv1", 100.0), ("M3", None, 200.0), ("M4", "nope", 201.0), ("M5", "S5", 50.0), ("M6", None, 9000.0), ("M7", "INV7", 70.0)]
    m = spark.createDataFrame([(k, n, a, "2024-01-05", "USD", "Acme Inc") for k, n, a in lines], "remitreceipt_id string, invoice_number string, invoice_amount double, invoice_date string, currency string, payer_name string").withColumn("invoice_date", F.to_date("invoice_date"))
    inv = [("INV1", None, 100.0, None), ("INV3", None, 200.0, 20.0), ("INV4", None, 202.0, None), ("INV5", "S5", 50.0, None), ("INV7", None, 70.0, 70.0)]
    i = spark.createDataFrame([(n, s, a, p, "2024-01-03", "USD", "Acme") for n, s, a, p in inv], "invno string, srcinvoice string, invamt double, total_amount_paid double, invdate string, currency string, company string").withColumns({"invdate": F.to_date("invdate"), "invrefno": F.lit(None).cast("string")})
    got = reconcile.remittances_to_invoices(m, i, judge.closeness_judge).toPandas()
    assert set(got.left_key) == {k for k, _, _ in lines}
    sure = {(r.left_key, r.invoice_key, r.allocated_cents) for r in got[got.method == "presolved"].itertuples()}
    assert sure == {("M1", "INV1", 10000), ("M5", "INV5", 5000)}
    real = got[got.invoice_key != "__unmatched__"]
    room = {n: round((a - (p or 0)) * 100) for n, _, a, p in inv}
    assert all(g.allocated_cents.sum() <= room[k] for k, g in real.groupby("invoice_key"))
    cents = {k: round(a * 100) for k, _, a in lines}
    assert all(g.allocated_cents.sum() in (0, cents[k]) for k, g in got.groupby("left_key"))
    sent = real[real.method == "flow"].groupby("left_key").allocated_cents.sum().to_dict()
    assert sum(sent.values()) == 18000 + 20200 and set(sent) == {"M3", "M4"}  # all room within reach is used
    assert {r.left_key for r in got[got.grouping_type == "unmatched"].itertuples()} >= {"M2", "M6", "M7"}


def test_presolved_lines_make_no_candidates(spark, monkeypatch):
    """Lines with an exact pair aren't paired with invoices of like amount, as their edges would be dropped."""
    seen, edges = [], reconcile.remit_blocked_edges
    monkeypatch.setattr(reconcile, "remit_blocked_edges", lambda lines, *a: seen.append({r.remitreceipt_id for r in lines.collect()}) or edges(lines, *a))
    m = spark.createDataFrame([(f"M{k}", f"I{k}" if k else None, 100.0, day(5), "USD", "Acme") for k in range(5)], "remitreceipt_id string, invoice_number string, invoice_amount double, invoice_date date, currency string, payer_name string")
    i = spark.createDataFrame([(f"I{k}", 100.0, day(4), "USD", "Acme") for k in range(5)], "invno string, invamt double, invdate date, currency string, company string")
    got = reconcile.remittances_to_invoices(m, i.withColumns({c: F.lit(None).cast(t) for c, t in (("srcinvoice", "string"), ("invrefno", "string"), ("total_amount_paid", "double"))}), judge.closeness_judge).collect()
    assert seen == [{"M0"}]
    assert {(r.left_key, r.invoice_key, r.method) for r in got} == {("M0", "I0", "flow")} | {(f"M{k}", f"I{k}", "presolved") for k in range(1, 5)}


def test_receipts_presolved_flow_uses_an_invoice_once(spark):
    r = spark.createDataFrame([("R1", "C", 100.0, "2024-01-05"), ("R2", "C", 100.0, "2024-01-06"), ("R3", "C", 90.0, "2024-01-07")], "receipt_id string, payercust_custno string, amount double, receipt_date string").withColumns({"receipt_date": F.to_date("receipt_date"), "currency": F.lit("USD"), "payercust_company": F.lit("Acme")})
    i = spark.createDataFrame([("C", "I1", 100.0, "2024-01-05"), ("C", "I2", 80.0, "2024-01-05")], "custno string, invno string, invamt double, invdate string").withColumns({"invdate": F.to_date("invdate"), "currency": F.lit("USD"), "company": F.lit("Acme")})
    got = reconcile.receipts_to_invoices_presolved(r, i, judge.closeness_judge).toPandas()
    assert [(x.left_key, x.invoice_key, x.allocated_cents) for x in got[got.method == "presolved"].itertuples()] == [("R1", "I1", 10000)]
    assert got[got.invoice_key == "I1"].allocated_cents.sum() == 10000 and got[got.invoice_key == "I2"].allocated_cents.sum() == 8000
    assert got.groupby("left_key").allocated_cents.sum().to_dict() == {"R1": 10000, "R2": 10000, "R3": 9000}


def test_rankings_by_classes_are_the_rankings_of_rows(spark):
    """Copies of lines and invoices are paired once a class: each line still has its k best rows, named ones and shared ids too."""
    rng = random.Random(11)
    inv = [(f"i{k:03}", 100.0 + rng.randint(0, 3), day(rng.randint(0, 3)), rng.choice(["USD", None, "EUR"]), rng.choice(["Acme", "Beta"])) for k in range(90)]
    rem = [(f"m{k % 38}", rng.choice([None, "I001", f"i{k:03}", "zz"]), 100.0 + rng.randint(0, 3), day(rng.randint(0, 3)), rng.choice(["USD", None]), rng.choice(["Acme", "Beta", ""])) for k in range(40)]
    i = spark.createDataFrame(inv, "invno string, invamt double, invdate date, currency string, company string")
    m = spark.createDataFrame(rem, "remitreceipt_id string, invoice_number string, invoice_amount double, invoice_date date, currency string, payer_name string")
    want = {}
    for key, no, a, d, c, name in rem:
        for k, b, e, cc, company in inv:
            if abs(a - b) * 100 <= round(a * 3) and abs((d - e).days) <= 10 and (c is None or cc is None or c == cc):
                gap = abs((d - e).days)
                s = 0.55 * (1 - abs(a - b) / a) + 0.2 * (1 - gap / 365) + 0.15 * (name == company) + 0.1 * (no is not None and no.upper() == k.upper())
                want.setdefault(key, []).append((-round(s, 6), gap, k))
    got = {}
    for r in reconcile.remit_blocked_edges(m, i, topk=12).collect():
        got.setdefault(r.remitreceipt_id, []).append((r.rank0, r.invno, r.block_score))
    assert {k: [(n, x[2], -x[0]) for n, x in enumerate(sorted(v)[:12], 1)] for k, v in want.items()} == {k: sorted(v) for k, v in got.items()}


def test_pairs_of_classes_do_not_grow_with_copies(spark):
    left = spark.range(300).selectExpr("id AS l", "id % 3 AS a")
    right = spark.range(400).selectExpr("id AS r", "id % 4 AS b")
    seen = []

    def pairs(x, y):
        seen.extend((x.count(), y.count()))
        return x.join(y, F.col("a") <= F.col("b")).withColumn("far", F.col("b") - F.col("a"))

    best = blocking.best_by_classes(left, right, ["a"], ["b"], ["r"], pairs, ["far"], [], 105)
    assert seen == [3, 4]
    got = {x.left_key.a: [(y.far, y.r) for y in x.best] for x in best.collect()}
    assert got == {a: sorted((r % 4 - a, r) for r in range(400) if r % 4 >= a)[:105] for a in range(3)}
