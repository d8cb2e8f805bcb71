"""Packing documents into sequences: bulk-synchronous best fit over runs of equal sizes."""

from __future__ import annotations

import bisect
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, durable, mapped, slices
from .tokens import KEEPS, encoded, units

#: Places that the pieces of one length are dealt over.
SALTS = 64
#: Ranges of sizes that a superstep sweeps side by side, before one goes over what they left.
RANGES = 8
#: Shares of the capacity, as divisors: pieces longer than each have their supersteps before shorter ones do.
BATCHES = (2, 4, 16)

#: Runs of places that are broadcast at most, of 48 bytes each.
RUNS = 1 << 18

#: What a run is: pieces of one length from a rank on, gaps of one size from a sequence on, or pieces that have their places.
PIECES, GAPS, PLACED = 0, 1, 2
_RUN = "kind int, size long, first long, n long, sequence long, offset long"


def sweep(runs: list[tuple[int, int, int, int]], capacity: int, least: int) -> list[tuple[int, int, int, int, int, int]]:
    """One range's part of a superstep. runs: (kind, size, first, n) of pieces and gaps of one range of sizes.

    Lengths go from the longest down. Each takes its successor, the smallest gap of the range that holds it; where many
    pieces want gaps of one size the k-th by rank gets the k-th by sequence, so no two claim one. What is left of a gap
    is a gap again, in this sweep if its size is `least` or more, else from the next superstep on.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # size: runs of (first sequence, sequences), the next one last
    sizes: list[int] = []

    def add(size: int, first: int, n: int) -> None:
        if size not in gaps:
            gaps[size] = []
            bisect.insort(sizes, size)
        gaps[size].append((first, n))

    for _, size, first, n in sorted((r for r in runs if r[0] == GAPS), key=lambda r: -r[2]):
        add(size, first, n)
    for _, length, rank, left in sorted((r for r in runs if r[0] == PIECES), key=lambda r: (-r[1], r[2])):
        while left and (at := bisect.bisect_left(sizes, length)) < len(sizes):
            gap = sizes[at]
            first, have = gaps[gap].pop()
            n = min(have, left)
            if have > n:
                gaps[gap].append((first + n, have - n))
            elif not gaps[gap]:
                del gaps[gap], sizes[at]
            out.append((PLACED, length, rank, n, first, capacity - gap))
            rest = gap - length
            if rest >= least:
                add(rest, first, n)
            elif rest:
                out.append((GAPS, rest, first, n, 0, 0))
            rank, left = rank + n, left - n
        if left:
            out.append((PIECES, length, rank, left, 0, 0))
    return out + [(GAPS, size, first, n, 0, 0) for size in sizes for first, n in gaps[size]]


def wanted(pieces: int, tokens: int, halves: int, thirds: int, capacity: int) -> int:
    """Sequences without which pieces that fit no gap can't be placed: by their tokens, and as no two of over half a sequence
    share one, nor three of over a third."""
    return max(-(-tokens // capacity), halves, -(-thirds // 2), 1 if pieces else 0)


def supersteps(counts: DataFrame, capacity: int) -> DataFrame:
    """Where pieces go, as runs (length, rank, n, sequence, offset): counts (length, n), as many rows as there are lengths.

    Batch by batch of lengths, longest first, pieces and gaps that concern the batch are range-sorted by size, RANGES
    ranges are swept side by side, and one sweep goes over what they left. Gaps are then up to date, and as nothing is
    left that fits any, so many sequences are opened as the rest can't do without; they are gaps like the others in the
    next superstep, until the batch is placed. All pieces of a length are alike, so the state is runs: its size hangs on
    the capacity, not on the corpus. Each superstep ends in a durable table; only four sums reach the driver.
    """
    spark = counts.sparkSession
    state = durable(counts.select(F.lit(PIECES).alias("kind"), F.col("length").alias("size"), F.lit(0).cast("long").alias("first"), "n", F.lit(0).cast("long").alias("sequence"), F.lit(0).cast("long").alias("offset")), "packing-runs")
    sequences = 0

    def step(state: DataFrame, least: int, ranges: int) -> DataFrame:
        live = (F.col("kind") != PLACED) & (F.col("size") >= least)
        number = F.lit(0) if ranges == 1 else F.ntile(ranges).over(Window.orderBy("size")) - 1
        keyed = state.where(live).select("kind", "size", "first", "n")
        bounds = keyed.select("size").distinct().withColumn("range", number)  # one row a size, capacity at most
        low = bounds.groupBy("range").agg(F.min("size").alias("low"))
        keyed = keyed.join(F.broadcast(bounds.join(low, "range")), "size")

        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            rows = list(zip(*(pdf[c].tolist() for c in ("kind", "size", "first", "n"))))
            return pd.DataFrame(sweep(rows, capacity, int(key[1])), columns=["kind", "size", "first", "n", "sequence", "offset"])

        swept = keyed.groupBy("range", "low").applyInPandas(run, _RUN)
        return durable(state.where(~live).unionByName(swept), "packing-runs")

    for least in [*(capacity // d + 1 for d in BATCHES), 1]:
        ranges = RANGES
        while True:
            before, state = state, step(state, least, ranges)
            discard(before)
            n, length = F.col("n"), F.col("size")
            sums = [n, n * length, F.when(2 * length > capacity, n).otherwise(0), F.when(3 * length > capacity, n).otherwise(0)]
            left = [int(x or 0) for x in state.where((F.col("kind") == PIECES) & (length >= least)).agg(*[F.sum(x) for x in sums]).first()]
            if not left[0]:
                break
            if ranges == 1:
                more = wanted(*left, capacity)
                before, state = state, durable(state.unionByName(spark.createDataFrame([(GAPS, capacity, sequences, more, 0, 0)], _RUN)), "packing-runs")
                discard(before)
                sequences += more
            ranges = 1
    return state.where(F.col("kind") == PLACED).select(F.col("size").alias("p_length"), F.col("first").alias("p_rank"), F.col("n").alias("p_n"), F.col("sequence").alias("p_sequence"), "offset")


def pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of each document: its ids, then end_id, cut into pieces of capacity from the end on."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(it):
        u = units(path, ranks_path)
        for batch in slices(it):
            where, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encoded(text or "", u) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    where.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(where, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").transform(mapped, run, f"id {kind}, piece int, start long, length long, ids_crc32 long", KEEPS)


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Texts are encoded once, where they are read; only narrow rows are shuffled. Pieces are counted by (length, salt), at
    most capacity x SALTS rows, and supersteps() finds the places of runs of equal lengths. Ranks are given within
    (length, salt) in order of id, so that no length is one task's; each piece finds its run by a join on length and rank,
    for which the runs are broadcast: their number hangs on the capacity, and more than RUNS of them are an error.

    Null text is empty: one piece, the end id. Null and repeated ids are documents of their own. No rows in, no rows out.
    """
    rows = pieces(docs, path, end_id, capacity, ranks_path, id_col, text_col)
    rows = durable(rows.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int")), "packing-pieces")
    by_salt = durable(rows.groupBy("length", "salt").agg(F.count("*").alias("n")), "packing-counts")
    places = durable(supersteps(by_salt.groupBy("length").agg(F.sum("n").alias("n")), capacity), "packing-places")
    if places.count() > RUNS:
        raise RuntimeError(f"over {RUNS} runs for a capacity of {capacity}")
    below = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = by_salt.select(F.col("length").alias("b_length"), F.col("salt").alias("b_salt"), F.coalesce(F.sum("n").over(below), F.lit(0)).alias("b_rank"))
    order = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")
    ranked = rows.withColumn("own", F.row_number().over(order).cast("long") - 1)
    ranked = ranked.join(F.broadcast(base), (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt"))).withColumn("rank", F.col("own") + F.col("b_rank"))
    hit = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_rank")) & (F.col("rank") < F.col("p_rank") + F.col("p_n"))
    out = ranked.join(F.broadcast(places), hit)
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", (F.col("p_sequence") + F.col("rank") - F.col("p_rank")).alias("sequence_id"), "offset")
