"""Sources, sinks and streams on files of their own."""

import datetime as dt

from ledgerloom.sources import tables
from ledgerloom.streaming import tickets as st


def test_csv_with_provenance(spark, tmp_path):
    p = tmp_path / "tickets_2024-01-05.csv"
    p.write_text('number,text\nIN1,"two\nlines ""quoted"""\n')
    r = tables.read_csv(spark, str(p)).first()
    assert r.text == 'two\nlines "quoted"' and r.as_of_date == dt.date(2024, 1, 5) and r.source_file.endswith(".csv") and r.ingested_at is not None


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    tables.append(spark.range(3), p)
    tables.append(spark.range(2).selectExpr("id", "'x' AS extra"), p)
    assert tables.read_merged(spark, p).count() == 5 and "extra" in tables.read_merged(spark, p).columns
    tables.overwrite(spark.range(1), p)
    assert spark.read.parquet(p).count() == 1
    tables.write_clustered(spark.range(100).repartition(5), p, ["id"], files=4)
    assert spark.read.parquet(p).count() == 100


def test_listing_and_moves(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir()
    for i in range(5):
        (a / f"f{i}.bin").write_bytes(b"x" * (i + 1))
    assert sorted(r.length for r in tables.list_files(spark, str(a)).collect()) == [1, 2, 3, 4, 5]
    done = tables.move_files(spark, str(a), str(b), 3).collect()
    assert len(done) == 3 and all(r.moved for r in done) and len(list(a.iterdir())) == 2 and len(list(b.iterdir())) == 3


def test_resumable(spark, tmp_path):
    src, seen = str(tmp_path / "src"), []
    spark.range(4).repartition(2).write.parquet(src)
    step = lambda df, n: seen.extend(r.id for r in df.collect())
    for _ in range(2):
        tables.resumable(spark, src, "id long", str(tmp_path / "cp"), step, 1)
    assert sorted(seen) == [0, 1, 2, 3]
    spark.range(4, 6).write.mode("append").parquet(src)
    tables.resumable(spark, src, "id long", str(tmp_path / "cp"), step, 1)
    assert sorted(seen) == [0, 1, 2, 3, 4, 5]


def events(spark, folder):
    t = dt.datetime(2024, 1, 1)
    for k, rows in enumerate([[(1, t, 7, "click"), (2, t + dt.timedelta(hours=2), 7, "view")], [(3, t + dt.timedelta(hours=1), 7, "late"), (4, t + dt.timedelta(days=3), 8, "view")]]):
        spark.createDataFrame([(*r, 1.0, "{}") for r in rows], "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.mode("append").parquet(folder)


def test_streams(spark, tmp_path):
    src = str(tmp_path / "ev")
    events(spark, src)
    got = {}
    q = st.latest_tickets(st.read_events(spark, src, 1)).writeStream.outputMode("update").foreachBatch(lambda df, n: got.update({r.number: r.state for r in df.collect()})).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert got == {"IN00000007": "view", "IN00000008": "view"}
    rows = []
    q = st.counts_by_window(st.read_events(spark, src, 1)).writeStream.outputMode("append").foreachBatch(lambda df, n: rows.extend(df.collect())).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.event_type for r in rows} <= {"click", "view", "late"}


def test_stored_index_embeds_each_text_once(spark, tmp_path):
    from ledgerloom.sources import vector_store

    calls = spark.sparkContext.accumulator(0)

    def embedder(texts):
        calls.add(len(texts))
        return [[float(len(t)), 1.0] for t in texts]

    at = f"{tmp_path}/store"
    frame = lambda *rows: spark.createDataFrame(rows, "id string, text string")
    got = vector_store.synchronise(spark, at, frame(("a", "one"), ("b", "three"), ("c", "one"), ("d", None)), embedder)
    assert {r.id for r in got.collect()} == {"a", "b", "c", "d"} and calls.value == 3
    got = {r.id: r.vector for r in vector_store.synchronise(spark, at, frame(("a", "one"), ("b", "changed"), ("e", "three")), embedder).collect()}
    assert set(got) == {"a", "b", "e"} and calls.value == 4 and abs(got["b"][0] - 7 / 50**0.5) < 1e-6
    assert vector_store.synchronise(spark, at, frame(("x", "changed")), embedder).count() == 1 and calls.value == 4
