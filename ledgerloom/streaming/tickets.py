"""Ticket events as a stream: the latest version of each ticket, and counts by time. An addition; batch is the reference form."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, folder: str, files_per_batch: int = 10) -> DataFrame:
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def latest_tickets(events: DataFrame) -> DataFrame:
    """Stream of (number, state, updated_on) whenever a ticket's newest version changes; order of arrival doesn't matter."""

    def step(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get if state.exists else None
        for pdf in frames:
            row = pdf.sort_values(["ts", "event_id"]).iloc[-1]
            now = (int(row["ts"].value), int(row["event_id"]), str(row["event_type"]))
            best = now if best is None or now[:2] > tuple(best[:2]) else best
        if best is not None and (not state.exists or tuple(state.get) != tuple(best)):
            state.update(best)
            yield pd.DataFrame({"number": [key[0]], "state": [best[2]], "updated_on": [pd.Timestamp(best[0])]})

    keyed = events.withColumn("number", F.concat(F.lit("IN"), F.lpad(F.col("user_id").cast("string"), 8, "0"))).select("number", "ts", "event_id", "event_type")
    return keyed.groupBy("number").applyInPandasWithState(step, "number string, state string, updated_on timestamp", "ts long, event_id long, event_type string", "update", GroupStateTimeout.NoTimeout)


def counts_by_window(events: DataFrame, late: str = "1 hour", width: str = "1 day", slide: str | None = None) -> DataFrame:
    """Events by type and time window, closed once the watermark has passed."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
