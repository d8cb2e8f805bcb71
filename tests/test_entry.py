"""The driver's contract: names, oracles, plans without nested loops, and one query against its SQL."""

import duckdb
import __spark_entry__ as entry
from ledgerloom.plans import catalog

SF = "/root/testdata/sf0.001"


def test_contract(spark):
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(catalog.QUERIES) >= 30
    df = entry.entry(spark)
    assert df.columns and df.count() >= 0


def test_blocked_plans_have_no_nested_loops(spark):
    for name in ("band_join_receipt_remit", "remit_line_to_invoice", "presolve_invno", "block_topk", "wide_block", "deterministic_check"):
        text = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name in ("closest_sum", "whole_set_sum", "presolve_exact", "grouping_labels", "tickets_snapshot", "knn_topk", "match_details", "best_match_judged", "row_sequence"):
        df = catalog.QUERIES[name](spark, SF)
        r = con.execute(catalog.ORACLE[name])
        cols = [x[0] for x in r.description]
        want = sorted(map(repr, r.fetchall()))
        assert sorted(repr(tuple(row[c] for c in cols)) for row in df.collect()) == want, name
