"""Operators on small frames: edge rows, brute force and properties."""

import datetime as dt
import itertools
import random
from collections import defaultdict

import pandas as pd
import pytest
from ledgerloom.functions import scalars as S
from ledgerloom.operators import blocking, components, flow, judge, knn, remittance_json, shaping, subset, sums, tickets
from ledgerloom.plans import pipelines
from pyspark.sql import functions as F


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_week_band_is_the_theta_join(spark):
    rng = random.Random(1)
    a = [(f"a{i}", day(rng.randint(0, 60)), rng.randint(1, 50)) for i in range(60)] + [("null", None, 1)]
    b = [(f"b{i}", day(rng.randint(0, 60)), rng.randint(1, 50)) for i in range(80)]
    x, y = spark.createDataFrame(a, "x string, xd date, xv int"), spark.createDataFrame(b, "y string, yd date, yv int")
    for days, radius in ((7, 1), (14, 2)):
        out = blocking.week_band_join(x, y, "xd", "yd", radius, (S.days_apart("xd", "yd") <= days) & (F.abs(F.col("xv") - F.col("yv")) <= 5))
        want = {(p[0], q[0]) for p in a for q in b if p[1] and abs((p[1] - q[1]).days) <= days and abs(p[2] - q[2]) <= 5}
        got = [(r.x, r.y) for r in out.collect()]
        assert len(got) == len(set(got)) and set(got) == want
        assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)
        wide = blocking.wide_block_join(x, y, "xd", "yd", F.abs(F.col("xv") - F.col("yv")) <= 5, days)
        assert sorted((r.x, r.y) for r in wide.collect()) == sorted(want) and "NestedLoop" not in plan(wide) and "Cartesian" not in plan(wide)


def test_any_equal_join_has_no_nested_loop(spark):
    l = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None)], "id string, n string")
    r = spark.createDataFrame([("x", "A", "A"), ("y", "Z", "B"), ("z", None, None)], "k string, p string, q string")
    out = blocking.any_equal_join(l, r, [("n", "p"), ("n", "q")], ["id", "k"])
    assert sorted((x.id, x.k) for x in out.collect()) == [("1", "x"), ("2", "y")] and "NestedLoop" not in plan(out)


def test_shaping(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 3.0), ("c", None, 4.0), ("d", None, None)], "k string, t double, p double")
    assert sorted((r.k, r.amount_field, r.amount_value) for r in shaping.unpivot_amounts(df, ["t", "p"]).collect()) == [("a", "t", 1.0), ("b", "p", 3.0), ("b", "t", 2.0), ("c", "p", 4.0)]
    assert shaping.with_columns_of(df, ["k", "new"]).columns == ["k", "t", "p", "new"] and shaping.only_existing(df, ["p", "zz"]).columns == ["p"]
    assert [r.seq for r in shaping.sequence_ids(df.repartition(3), [F.col("k")]).orderBy("k").collect()] == [1, 2, 3, 4]
    assert [r.k for r in shaping.sample_n(df, 2, 3, "k").orderBy("k").collect()] == [r.k for r in shaping.sample_n(df.repartition(5), 2, 3, "k").orderBy("k").collect()]
    h = spark.createDataFrame([("r", "2", None), ("r", "1", "x"), ("r", "3", "y")], "id string, cust string, f string")
    c = shaping.collapse_headers(h, "id", "cust", ["f"]).first()
    assert c.f == "x" and c.custnos == ["1", "2", "3"]
    m = spark.createDataFrame([("a", "i1")], "l string, r string")
    other = spark.createDataFrame([("i1", 9)], "no string, v int")
    assert sorted((r.recpt_k, r.inv_v) for r in shaping.reattach(df, "k", m, "l", "r", other, "no", ("recpt_", "inv_")).collect()) == [("a", 9), ("b", None), ("c", None), ("d", None)]
    assert {r.u for r in shaping.numbered_id(spark.createDataFrame([("q", 1), ("q", 1)], "h string, z int"), "h", ["z"], "u").collect()} == {"q#1", "q#2"}


def test_components(spark):
    rng = random.Random(2)
    edges = [(str(rng.randint(0, 80)), str(rng.randint(0, 80))) for _ in range(50)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    low = {}
    for a, b in edges:
        low.setdefault(a, a), low.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    got = {r.id: r.component for r in components.connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {k: v for k, v in low.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_beam_and_depth_first_against_brute_force():
    rng = random.Random(3)
    for _ in range(80):
        items = [(f"i{k}", rng.randint(1, 60), rng.random()) for k in range(rng.randint(1, 9))]
        target = rng.randint(1, 150)
        every = [c for n in range(1, len(items) + 1) for c in itertools.combinations(items, n)]
        ids, total, diff, score = subset.beam(items, target, 0, most=10, width=5000)
        assert abs(diff) == min(abs(sum(x[1] for x in c) - target) for c in every)
        assert total == sum(x[1] for x in items if x[0] in ids) and diff == total - target and abs(score - sum(x[2] for x in items if x[0] in ids)) < 1e-9
        exact = [c for c in every if abs(sum(x[1] for x in c) - target) <= 1]
        found = subset.depth_first(items, target)
        singles = [c[0] for c in exact if len(c) == 1]
        if singles:
            assert found[0] == [max(singles, key=lambda x: x[2])[0]]
        elif exact:
            assert abs(found[1] - max(sum(x[2] for x in c) for c in exact)) < 1e-9
        else:
            assert found is None
    assert subset.beam([], 5, 1) == ([], 0, -5, 0.0)
    assert subset.beam([("a", None, 1.0), ("b", 0, 1.0), ("c", 7, 0.5)], 5, 1)[0] == ["c"]


def test_conflicts(spark):
    a = [("m1", "r1", 0.9), ("m1", "r2", 0.9), ("m2", "r2", 0.95), ("m3", "r1", 0.5), ("m4", "r9", 0.1)]
    got = {(r.remit_id, r.receipt_id) for r in subset.resolve_conflicts(spark.createDataFrame(a, "remit_id string, receipt_id string, total_score double")).collect()}
    assert got == {("m2", "r2"), ("m3", "r1"), ("m4", "r9")}


def brute_cost(supply, room, edges, unmatched):
    """Least cost by trying every split of tiny supplies."""
    best = None
    arcs = [(a, b, c, min(cap, supply[a], room[b])) for a, b, c, cap in edges]
    for amounts in itertools.product(*[range(x[3] + 1) for x in arcs]):
        out, into = defaultdict(int), defaultdict(int)
        for (a, b, _, _), v in zip(arcs, amounts):
            out[a] += v
            into[b] += v
        if all(out[a] <= supply[a] for a in supply) and all(into[b] <= room[b] for b in room):
            cost = sum(v * x[2] for v, x in zip(amounts, arcs)) + unmatched * sum(supply[a] - out[a] for a in supply)
            best = cost if best is None else min(best, cost)
    return best


def test_flow_is_optimal_and_falls_apart(spark):
    rng = random.Random(4)
    for _ in range(40):
        supply = {f"r{i}": rng.randint(1, 3) for i in range(2)}
        room = {f"i{i}": rng.randint(1, 3) for i in range(2)}
        edges = [(a, b, rng.randint(0, 20), min(supply[a], room[b])) for a in supply for b in room if rng.random() < 0.8]
        got = flow.min_cost_flow(supply, room, edges, unmatched=25)
        cost = {(a, b): c for a, b, c, _ in edges}
        assert sum(v * cost.get(k, 25) for k, v in got.items()) == brute_cost(supply, room, edges, 25)
    rows, cents = [], {}
    for r in range(12):
        for i in rng.sample(range(14), 2):
            a, b = cents.setdefault(f"r{r}", rng.randint(1, 900)), cents.setdefault(f"i{i}", rng.randint(1, 900))
            rows.append((f"r{r}", f"i{i}", a, b, rng.randint(0, 1000)))
    rows.append(("neg", "i1", -5, cents.get("i1", 3), 1))
    got = flow.allocate(spark.createDataFrame(rows, "receipt_id string, invoice_key string, r_cents long, i_cents long, cost long")).toPandas()
    whole = flow.min_cost_flow({r: c for r, c in cents.items() if r[0] == "r"}, {i: c for i, c in cents.items() if i[0] == "i"}, [(a, b, c, min(x, y)) for a, b, x, y, c in rows if x > 0])
    cost = {(a, b): c for a, b, _, _, c in rows}
    assert (got.allocated_cents * got.cost).sum() == sum(v * cost.get(k, flow.UNMATCHED_COST) for k, v in whole.items())
    assert all(g.allocated_cents.sum() == cents[r] for r, g in got.groupby("receipt_id"))
    assert all(g.allocated_cents.sum() <= cents[i] for i, g in got[got.invoice_key != flow.UNMATCHED].groupby("invoice_key"))


def test_small_sums_find_every_group(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for r in range(8):
        target = rng.randint(50, 120)
        items = [(f"k{i}", rng.randint(1, 60), round(rng.random(), 3)) for i in range(9)]
        rows += [(f"r{r}", target, *x) for x in items]
        for n in (1, 2, 3):
            want |= {(f"r{r}", ",".join(sorted(x[0] for x in c))) for c in itertools.combinations(items, n) if abs(sum(x[1] for x in c) - target) <= 1}
    df = spark.createDataFrame(rows, "receipt_id string, r_cents long, inv_key string, i_cents long, cosine double")
    assert {(r.receipt_id, r.members) for r in sums.small_sums(df, groups=1000, relative=0.0).collect()} == want


def test_knn_in_blocks(spark):
    rng = random.Random(6)
    v = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(90)] + [(None, [1.0] * 6), (200, None)]
    df = spark.createDataFrame(v, "id long, vector array<double>")
    one = sorted(map(tuple, knn.knn(df.where("id < 20"), df, 4, 0.3, blocks=1).collect()))
    assert one == sorted(map(tuple, knn.knn(df.where("id < 20"), df, 4, 0.3, blocks=3).collect()))
    assert all(r[0] == r[1] for r in one if r[3] == 1) and all(r[2] >= 0.3 for r in one)


def test_judges(spark):
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy, retry after 2 seconds")
        return "ok"

    waits = []
    assert judge.retrying(flaky, sleep=waits.append, jitter=random.Random(0))() == "ok" and len(waits) == 2 and all(2 <= w <= 2.5 for w in waits)
    with pytest.raises(OSError):
        judge.retrying(lambda: (_ for _ in ()).throw(OSError("no")), attempts=2, sleep=lambda _: None)()
    pairs = spark.createDataFrame([("a", "x", 0.95), ("a", "x", 0.95), ("b", "y", 0.2)], "l string, r string, pre_score double")
    for workers in (1, 3):
        got = judge.judged(pairs, judge.closeness_judge, ["l", "r"], partitions=2, workers=workers).collect()
        assert sorted((r.l, r.is_match) for r in got) == [("a", True), ("b", False)]
    empty = judge.judged(pairs.limit(0), judge.closeness_judge, ["l", "r"])
    assert empty.collect() == []
    e = judge.embedded(spark.createDataFrame([(1, "aa"), (2, "aa"), (3, None)], "id int, text string"), lambda t: [[len(x) + 1.0, 0.0] for x in t]).collect()
    assert len(e) == 3 and all(abs(r.vector[0] - 1) < 1e-6 for r in e)
    amb = judge.ambiguous(pairs, pairs.where("l = 'a'").select("l"), "l", "pre_score", "r").first()
    assert amb.l == "b" and amb.candidates == 1 and amb.top_candidates == '[{"r":"y","pre_score":0.2}]'


def test_json(spark):
    good = '[{"remit_header_related_fields":{"payer_name":"P","total_amount":"$1,000.00"},\r\n"invoice_details":[{"invoice_number":"1","invoice_date":"03/14/2024","amount_paid":"10.50"},{"invoice_number":"2","amount_paid":"x"}]},{"remit_header_related_fields":{"check_number":"77"}}]'
    df = spark.createDataFrame([(1, good), (2, "[]"), (3, "not json"), (4, None)], "document_id long, remittance_fields_json string")
    lines = remittance_json.flatten_remittances(df)
    got = {r.document_id: r for r in remittance_json.remittance_totals(lines).collect()}
    assert (got[1].payer_name, got[1].check_number, got[1].remit_total, got[1].line_count) == ("P", "77", 10.5, 2) and got[2].remit_total is None and set(got) == {1, 2, 3, 4}
    r = remittance_json.parse_receipts(spark.createDataFrame([("a", '{"amount": 3.5, "receipt_date": "2024-01-02"}'), ("b", "x")], "receiptI_id string, receipt_json_fields string"))
    assert {x.receipt_id: (x.amount, x.receipt_date) for x in r.collect()} == {"a": (3.5, dt.date(2024, 1, 2)), "b": (None, None)}
    calls = spark.createDataFrame([(1, "t"), (2, "t"), (3, None)], "id int, transcript string")
    assert sorted((x.id, x.extracted) for x in remittance_json.extract(calls, lambda t: [f"[{y}]" for y in t]).collect()) == [(1, "[t]"), (2, "[t]"), (3, None)]


def test_tickets(spark):
    assert tickets.route("What about in00000001?")[0] == "number" and tickets.route("Open ones with no update in the past 3 days") == ("stale", {"days": 3}) and tickets.route("stale for 3 days")[0] == "similar" and tickets.route("stale but not closed, 3 days") == ("stale", {"days": 7})
    assert tickets.route("assigned to Ann Lee?") == ("assignee", {"name": "Ann Lee"}) and tickets.route("printer broken")[0] == "similar"
    t0 = dt.datetime(2024, 1, 1)
    h = [("IN1", None, "a", t0), ("IN1", "Closed", "a", t0 + dt.timedelta(days=1)), ("IN2", None, "b", t0), ("IN3", "open", "b", None), (None, "x", "b", t0)]
    df = spark.createDataFrame(h, "number string, state string, assigned_to string, sys_updated_on timestamp")
    snap = tickets.snapshot(df)
    assert {(r.number, r.state) for r in snap.collect()} == {("IN1", "Closed"), ("IN2", None), ("IN3", "open")}
    assert {r.number for r in tickets.snapshot(df.unionByName(df)).collect()} == {"IN1", "IN2", "IN3"}
    assert [r.number for r in tickets.stale(snap, "2024-02-01 00:00:00").collect()] == ["IN2"]
    with pytest.raises(ValueError):
        tickets.answer(snap, "printer broken", "2024-02-01")


def test_pipelines_keep_every_receipt(spark):
    r = spark.createDataFrame([("R1", "1", 10.0, day(5), "USD", "Acme Inc", "x"), ("R2", "2", 99.0, day(5), None, "Beta", None), ("R3", None, 5.0, day(5), "USD", None, None)], "receipt_id string, payercust_custno string, amount double, receipt_date date, currency string, payercust_company string, payercust_address1 string")
    i = spark.createDataFrame([("1", "7", 10.0, day(3), "USD", "Acme"), ("1", "8", 4.0, day(3), "USD", "Acme")], "custno string, invno string, invamt double, invdate date, currency string, company string")
    got = pipelines.receipts_to_invoices_flow(r, i).toPandas()
    assert set(got.receipt_id) == {"R1", "R2", "R3"} and got[got.receipt_id == "R1"].allocated_cents.sum() == 1000
    assert set(got[got.receipt_id != "R1"].grouping_type) == {"unmatched"}


def test_nearest_field_ties(spark):
    df = spark.createDataFrame([(10, 9, 11, 11), (10, 11, 9, 10)], "t long, a long, b long, c long").withColumns(sums.nearest_field("t", {"A": "a", "B": "b", "C": "c"}))
    assert [(r.matched_field, r.diff_cents) for r in df.orderBy("a").collect()] == [("A", -1), ("C", 0)]




def test_flow_without_outlet_sends_most_at_least_cost(spark):
    rng = random.Random(8)
    for _ in range(40):
        supply, room = ({f"{s}{i}": rng.randint(1, 3) for i in range(2)} for s in "ri")
        edges = [(a, b, rng.randint(0, 20), min(supply[a], room[b])) for a in supply for b in room if rng.random() < 0.8]
        cost = {(a, b): c for a, b, c, _ in edges}
        best = min(((-sum(v), sum(x * e[2] for x, e in zip(v, edges))) for v in itertools.product(*[range(e[3] + 1) for e in edges]) if all(sum(x for x, e in zip(v, edges) if e[k] == n) <= m for k, side in ((0, supply), (1, room)) for n, m in side.items())), default=(0, 0))
        rows = [(a, b, supply[a], room[b], c) for a, b, c, _ in edges]
        got = flow.min_cost_flow(supply, room, edges, unmatched=None)
        assert (-sum(got.values()), sum(v * cost[k] for k, v in got.items())) == best
    got = flow.allocate(spark.createDataFrame(rows, "receipt_id string, invoice_key string, r_cents long, i_cents long, cost long"), unmatched=None).toPandas()
    assert (-got.allocated_cents.sum(), (got.allocated_cents * got.cost).sum()) == best


def test_flow_of_copies_is_solved_by_classes(spark, monkeypatch):
    """Receipts with one list and invoices on the same lists are one node each to the solver; every row still has its share."""
    seen, solve = [], flow.connected
    monkeypatch.setattr(flow, "connected", lambda e: seen.append(e.count()) or solve(e))
    rows = [(f"r{a}{k:02}", f"i{b}{j:02}", 100 + k, 90 + j, 10 * abs(a - b) + a) for a in range(3) for k in range(20) for b in range(2) for j in range(15)]
    supply, room, cost = {r[0]: r[2] for r in rows}, {r[1]: r[3] for r in rows}, {r[:2]: r[4] for r in rows}
    for outlet in (flow.UNMATCHED_COST, None):
        got = flow.allocate(spark.createDataFrame(rows, "receipt_id string, invoice_key string, r_cents long, i_cents long, cost long"), outlet).toPandas()
        whole = flow.min_cost_flow(supply, room, [(a, b, c, min(supply[a], room[b])) for (a, b), c in cost.items()], outlet)
        assert (got.allocated_cents * got.cost).sum() == sum(v * cost.get(k, flow.UNMATCHED_COST) for k, v in whole.items())
        assert (got.allocated_cents > 0).all() and not got.duplicated(["receipt_id", "invoice_key"]).any()
        sent = got.groupby("receipt_id").allocated_cents.sum()
        assert all(sent.get(a, 0) == v if outlet else sent.get(a, 0) <= v for a, v in supply.items())
        real = got[got.invoice_key != flow.UNMATCHED]
        assert all(g.allocated_cents.sum() <= room[i] for i, g in real.groupby("invoice_key"))
        assert all(cost[r.receipt_id, r.invoice_key] == r.cost for r in real.itertuples())
    assert seen == [6, 6]


def test_flow_of_stars_and_of_many_components(spark):
    """Stars are filled by running sums, other components by the solver, several to a frame: the cost is the whole network's."""
    rng = random.Random(12)
    rows = [(f"a{k}", f"x{k}-{j}", 500, rng.randint(50, 300), rng.randint(0, 900)) for k in range(20) for j in range(rng.randint(1, 5))]
    rows += [(f"b{k}-{j}", f"y{k}", 100 + 7 * j, 300, rng.randint(0, 900)) for k in range(20) for j in range(rng.randint(2, 6))]
    rows += [(f"c{k}-{i}", f"z{k}-{j}", 200 + i, 150 + 9 * j, rng.randint(0, 900)) for k in range(30) for i in range(3) for j in range(3)]
    rows.append(rows[0][:4] + (899,))  # a repeated pair: the cheaper one counts
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = flow.allocate(spark.createDataFrame(rows, "receipt_id string, invoice_key string, r_cents long, i_cents long, cost long")).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    supply, room, cost = {a: r for a, _, r, _, _ in rows}, {b: i for _, b, _, i, _ in rows}, {}
    for a, b, _, _, c in rows:
        cost[a, b] = min(c, cost.get((a, b), c))
    whole = flow.min_cost_flow(supply, room, [(a, b, c, min(supply[a], room[b])) for (a, b), c in cost.items()])
    assert (got.allocated_cents * got.cost).sum() == sum(v * cost.get(k, flow.UNMATCHED_COST) for k, v in whole.items())
    assert all(g.allocated_cents.sum() == supply[r] for r, g in got.groupby("receipt_id"))
    assert all(g.allocated_cents.sum() <= room[i] for i, g in got[got.invoice_key != flow.UNMATCHED].groupby("invoice_key"))


def test_band_joins_keep_columns_of_any_name(spark):
    left = spark.createDataFrame([(1, "2024-01-01", 100, 5, 6, 7)], "a int, d string, c long, step int, band int, __step int")
    right = spark.createDataFrame([(2, "2024-01-03", 100, 8)], "b int, e string, f long, _step int")
    got = blocking.week_band_join(left, right, "d", "e", 1, amounts=("c", "f", 0.01, 0)).collect()
    assert [(r.a, r.b, r.step, r.band, r["__step"], r["_step"]) for r in got] == [(1, 2, 5, 6, 7, 8)]


def test_edges_are_scored_by_key_and_failures_stay_where_they_are(spark):
    edges = spark.createDataFrame([("R1", "I1", 0.4), ("R1", "I2", 7.0), ("R2", "I1", 0.5), ("R3", "I3", 0.1), ("R1", "I1", 0.4)], "receipt_id string, invoice_key string, s double")

    def scorer(pdf):
        if pdf["receipt_id"].iloc[0] == "R2":
            raise RuntimeError("down")
        return pd.DataFrame({"confidence": ["none" if x < 0.2 else x for x in pdf["s"]], "explanation": ["y" * int(100 * x) for x in pdf["s"]]})

    got = {(r.receipt_id, r.invoice_key): (r.confidence, r.explanation) for r in judge.scored_edges(edges, scorer, "receipt_id", "invoice_key").collect()}
    assert got == {("R1", "I1"): (0.4, "y" * 40), ("R1", "I2"): (1.0, "y" * 117 + "..."), ("R2", "I1"): (0.0, "edge scoring failed: down"), ("R3", "I3"): (0.0, "y" * 10)}


def test_rationale(spark):
    cases = spark.createDataFrame([("R1", 2), ("R2", 3)], "receipt_id string, candidates int")
    assert all(r.next_actions == [] and r.explanations == [] for r in judge.with_rationale(cases, "receipt_id").collect())

    def adviser(context):
        if '"R2"' in context:
            raise RuntimeError("down")
        return "call the payer", ["two invoices fit"]

    got = {r.receipt_id: (r.next_actions, r.explanations) for r in judge.with_rationale(cases, "receipt_id", adviser).collect()}
    assert got == {"R1": (["call the payer"], ["two invoices fit"]), "R2": ([], ["rationale failed: down"])}


def test_depth_first_has_no_bound_of_nodes():
    items = [(f"i{k:02}", 1000 + 2 * k, 1.0 - k / 100) for k in range(20)]
    target = sum(c for _, c, _ in items[-10:])
    assert subset.depth_first(items, target) == ([f"i{k}" for k in range(10, 20)], sum(s for _, _, s in items[-10:]))


def test_beam_takes_all_lines():
    items = [(f"i{k:03}", 1000 + k, 1.0) for k in range(80)] + [("last", 7, 0.1)]
    assert subset.beam(items, 7, 0)[:3] == (["last"], 7, 0)


def test_line_scores_without_limits_keep_every_line(spark):
    pool = spark.range(150).selectExpr("'R' AS receipt_id", "CAST(id AS STRING) AS inv_row_id", "100L AS r_cents", "DATE '2024-01-01' AS r_date", "'a' AS r_name", "'b' AS r_addr", "1.0D AS amount", "1.0D AS balance", "1.0D AS invamt", "'a' AS company", "'b' AS address", "DATE '2024-01-01' AS invdate", "DATE '2024-01-01' AS duedate", "'s' AS salespn", "'t' AS salesarea", "'u' AS modified_by", "150L AS pool_n")
    assert pipelines.line_scores(pool, topk=None, large=None).count() == 150 and pipelines.line_scores(pool).count() == 0


def test_knn_by_text_is_the_knn_of_rows_and_embeds_texts_once(spark):
    words = ["acme", "acme gmbh", "beta", "beta ag", "gamma", None]
    rows = spark.createDataFrame([(k, words[k * 7 % 6]) for k in range(60)], "id long, text string")
    sizes = []

    def embed(t):
        sizes.append(t.count())
        return judge.embedded(t, judge.trigram_embedder)

    whole = judge.embedded(rows, judge.trigram_embedder)
    want = knn.knn(whole.where("id % 4 = 0"), whole, 13, 0.3).select("query_id", "index_id", "cosine")
    got = knn.knn_by_text(rows.where("id % 4 = 0"), rows, embed, 13, 0.3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and max(sizes) <= 6
