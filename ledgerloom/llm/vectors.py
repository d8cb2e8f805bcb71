"""Near-duplicate vectors: sorted projection passes, then an exact sweep that completes and counts the links."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, components, durable, join_hot, mapped

#: Passes, hashes that are concatenated in each, and neighbours that each vector is compared with on either side.
PASSES, HASHES, WINDOW = 16, 4, 48
#: Vectors of a block of the sweep: a SHARE of all within these bounds. A vector is shuffled once for each block.
BLOCK, SHARE = (4096, 32768), 16
#: Rows that are multiplied at once.
STRIP = 512
#: Products in single precision are this near to those in double precision; nearer ones to the threshold are computed again.
SLACK = 1e-4


def usable(column: pa.Array, kind: str) -> tuple[np.ndarray, list[bytes]]:
    """(rows that can be linked, their components as bytes of kind): not null, not zero, no null or non-finite component."""
    good, out = [], []
    for k, v in enumerate(column.to_pylist()):
        if v is None or not v or None in v:
            continue
        x = np.array(v, dtype=kind)
        if np.isfinite(x).all() and x.any():
            good.append(k)
            out.append(x.tobytes())
    return np.array(good, dtype=np.int64), out


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@lru_cache(512)
def _axes(dim: int, p: int, h: int, seed: int) -> np.ndarray:
    r = np.random.default_rng([seed, dim, p, h]).standard_normal((dim, min(dim, 64)))
    return np.linalg.qr(r)[0] if dim <= 64 else r / np.sqrt((r * r).sum(axis=0))


def keys(x: np.ndarray, passes: int, hashes: int, seed: int = 31) -> np.ndarray:
    """(passes x rows x hashes) bytes: which of the axes of a random rotation, with its sign, a vector is nearest to.

    Close vectors share such a hash far more often than far ones, so equal prefixes of several mean nearness.
    """
    out = np.empty((passes, len(x), hashes), dtype=np.uint8)
    for p in range(passes):
        for h in range(hashes):
            y = x @ _axes(x.shape[1], p, h, seed)
            k = np.abs(y).argmax(axis=1)
            out[p, :, h] = 2 * k + (y[np.arange(len(x)), k] < 0)
    return out


def _hits(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Boolean (x rows by y rows): cosine in double precision >= least. Single precision decides what isn't close."""
    near = x.astype(np.float32) @ y.astype(np.float32).T
    hit = near >= least
    i, j = np.nonzero(np.abs(near - np.float32(least)) <= SLACK)
    if len(i):
        hit[i, j] = np.einsum("ij,ij->i", x[i], y[j]) >= least
    return hit


def _spanning(ids: list, x: np.ndarray, window: int, least: float, only_across: int | None = None) -> list[tuple]:
    """Verified pairs within the window of a sorted run that join what wasn't joined; with only_across, pairs over that place."""
    tree, out = Forest(len(ids)), []
    for begin in range(0, len(ids), STRIP):
        low, end = max(0, begin - window), min(len(ids), begin + STRIP)
        i, j = np.nonzero(_hits(x[begin:end], x[low:end], least))
        i, j = i + begin, j + low
        near = (j < i) & (i - j <= window)
        if only_across is not None:
            near &= (j < only_across) & (i >= only_across)
        for u, v in zip(j[near].tolist(), i[near].tolist()):
            if tree.join(u, v):
                out.append((ids[u], ids[v]))
    return out


def _passes(kind: str, passes: int, hashes: int):
    def run(it):
        for batch in it:
            raw, ids = batch.column("x").to_pylist(), batch.column("id")
            size = np.array([len(v) for v in raw])
            for n in np.unique(size):
                ks = np.flatnonzero(size == n)
                own = [raw[k] for k in ks]
                found = keys(unit(own, kind), passes, hashes)
                for p in range(passes):
                    head = np.array([n, p], dtype=">u4").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([head + x.tobytes() for x in found[p]], pa.binary()), ids.take(pa.array(ks)), pa.array(own, pa.binary())], ["key", "id", "x"])

    return run


def _windows(kind: str, window: int, least: float):
    """For rows (key, id, x), sorted: links inside the partition, and each run's first and last rows, as the next partition may go on with its pass."""

    def run(it):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        head: bytes | None = None
        keep_ids: list = []
        keep_x: list[bytes] = []
        edges: list[tuple] = []
        ends: list[tuple] = []  # boundary, side, pass, id, vector
        first, of_id = True, None

        def out():
            nonlocal edges, ends
            n, m = len(edges), len(ends)
            b = pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([x for x, _ in edges] + [None] * m, of_id),
                    "b": pa.array([y for _, y in edges] + [None] * m, of_id),
                    "border": pa.array([None] * n + [e[0] for e in ends], pa.int32()),
                    "side": pa.array([None] * n + [e[1] for e in ends], pa.int32()),
                    "pass": pa.array([None] * n + [e[2] for e in ends], pa.binary()),
                    "id": pa.array([None] * n + [e[3] for e in ends], of_id),
                    "x": pa.array([None] * n + [e[4] for e in ends], pa.binary()),
                }
            )
            edges, ends = [], []
            return b

        led = 0  # rows that went to the boundary before this partition
        for batch in it:
            of_id = batch.column("id").type
            k, ids, xs = (batch.column(c).to_pylist() for c in ("key", "id", "x"))
            begin = 0
            while begin < len(k):
                h = k[begin][:8]
                end = begin
                while end < len(k) and k[end][:8] == h:
                    end += 1
                if h != head:
                    if head is not None:
                        first = False
                    head, keep_ids, keep_x = h, [], []
                if first and led < window:
                    for q in range(begin, min(end, begin + window - led)):
                        ends.append((part, 1, h, ids[q], xs[q]))
                    led += min(end - begin, window - led)
                run_ids, run_x = keep_ids + ids[begin:end], keep_x + xs[begin:end]
                edges += _spanning(run_ids, unit(run_x, kind), window, least)
                keep_ids, keep_x = run_ids[-window:], run_x[-window:]
                begin = end
            yield out()
        for i, v in zip(keep_ids, keep_x):
            ends.append((part + 1, 0, head, i, v))
        if of_id is not None:
            yield out()

    return run


def _pairs(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({"a": pd.Series([a for a, _ in rows], dtype=object), "b": pd.Series([b for _, b in rows], dtype=object)})


def _border(kind: str, window: int, least: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        before, after = pdf[pdf["side"] == 0].sort_values("key"), pdf[pdf["side"] == 1].sort_values("key")
        if not len(before) or not len(after):
            return _pairs([])
        x = unit([*before["x"], *after["x"]], kind)
        return _pairs(_spanning([*before["id"], *after["id"]], x, window, least, only_across=len(before)))

    return run


def _tile(kind: str, least: float):
    """For two blocks (id, label, w, x): links (a, b) that join labels which weren't joined, and for each id (a) the n
    vectors of the other block that it links with, itself left out."""

    def run(key, p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        p = p.rename(columns=lambda c: c.removeprefix("p_"))
        if not len(p) or not len(q):
            return pd.DataFrame({"a": [], "b": [], "n": []})
        same = key[0] == key[1]
        labels = pd.factorize(pd.concat([p["label"], q["label"]], ignore_index=True))[0]
        mine, theirs, tree, edges = labels[: len(p)], labels[len(p) :], Forest(int(labels.max()) + 1), []
        p_id, q_id = p["id"].tolist(), q["id"].tolist()
        wp, wq, np_, nq = p["w"].to_numpy(np.int64), q["w"].to_numpy(np.int64), np.zeros(len(p), np.int64), np.zeros(len(q), np.int64)
        p_size, q_size = p["x"].map(len).to_numpy(), q["x"].map(len).to_numpy()
        for size in np.intersect1d(p_size, q_size):
            rows, columns = np.flatnonzero(p_size == size), np.flatnonzero(q_size == size)
            x, y = unit(list(p["x"].iloc[rows]), kind), unit(list(q["x"].iloc[columns]), kind)
            for k in range(0, len(rows), STRIP):
                own = rows[k : k + STRIP]
                hit = _hits(x[k : k + STRIP], y, least)
                i, j = np.nonzero(hit)
                np_[own] += np.bincount(i, weights=wq[columns[j]], minlength=len(own)).astype(np.int64)
                if not same:
                    nq[columns] += np.bincount(j, weights=wp[own[i]], minlength=len(columns)).astype(np.int64)
                i, j = own[i], columns[j]
                new = np.flatnonzero(mine[i] != theirs[j])
                once = np.unique(mine[i[new]].astype(np.int64) * len(labels) + theirs[j[new]], return_index=True)[1]
                for u, v in zip(i[new[once]].tolist(), j[new[once]].tolist()):
                    if tree.join(int(mine[u]), int(theirs[v])):
                        edges.append((p_id[u], q_id[v]))
        if same:
            np_ -= 1
        some, more = np.flatnonzero(np_), np.flatnonzero(nq)
        counted = [(p_id[k], int(np_[k])) for k in some] + [(q_id[k], int(nq[k])) for k in more]
        none = [None] * len(edges)
        columns = {"a": [a for a, _ in edges] + [i for i, _ in counted], "b": [b for _, b in edges] + [None] * len(counted), "n": none + [n for _, n in counted]}
        return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in columns.items()})

    return run


def _sweep(vectors: DataFrame, kind: str, id_kind: str, least: float) -> DataFrame:
    """Links (a, b) and counts (a, n), as _tile gives them, of all pairs of blocks of vectors (id, label, w, x); each pair of
    blocks meets once. Vectors are dealt to blocks by a hash, so blocks are even whatever the vectors are."""
    n = vectors.count()
    blocks = max(1, -(-n // min(max(n // SHARE, BLOCK[0]), BLOCK[1])))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    p = dealt.withColumn("other", F.explode(F.sequence(F.col("block"), F.lit(blocks - 1)))).select(*[F.col(c).alias(f"p_{c}") for c in ("block", "other", "id", "label", "w", "x")])
    q = dealt.withColumn("mine", F.explode(F.sequence(F.lit(0), F.col("block")))).select("mine", "block", "id", "label", "w", "x")
    return p.groupBy("p_block", "p_other").cogroup(q.groupBy("mine", "block")).applyInPandas(_tile(kind, least), f"a {id_kind}, b {id_kind}, n long")


def near_vectors(vectors: DataFrame, least: float = 0.9, passes: int = PASSES, hashes: int = HASHES, window: int = WINDOW, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each row of vectors: id, n_links, component_id (smallest id reachable by links), kept (id = component_id).

    Equal vectors are one class, with a weight, from the start. In each pass classes are sorted by concatenated random
    hashes (range partitioning by sampled splitters, then a sort) and compared with the next `window` neighbours, across
    partitions' borders too; pairs whose cosine in double precision is at least `least` are links, and those that join
    two groups are kept. Components of all passes' links are first groups. A window misses links in dense regions, so
    all pairs of classes are then compared in blocks: links between different first groups are added, and every class's
    links are counted there by weight. The result is exact. The sweep is quadratic in the distinct vectors, as exact ways are
    where vectors don't cluster, but makes no pairs: a vector is shuffled once for each block of up to BLOCK[1].

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do null ids, whose
    component_id is null and which are kept. Vectors of different lengths don't link. Rows that share an id are one
    node, compared by their smallest vector. Ids may be of any type that has an order. No rows in, no rows out; other
    columns are ignored.
    """
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    id_kind = vectors.schema[id_col].dataType.simpleString()
    base = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{'float' if kind == '<f4' else 'double'}>").alias("vector"))
    once = base.where("id IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
    raw = durable(once.transform(mapped, _raw(kind), f"id {id_kind}, x binary").withColumn("class", F.sha2("x", 256)), "vectors-raw")
    classes = raw.groupBy("class").agg(F.min("id").alias("rep"), F.count("*").alias("w"))
    of_id = durable(join_hot(raw, classes.select("class", "rep", "w", F.col("w").alias("n")), ["class"], "n", raw.count()), "vectors-classes")
    reps = of_id.where("id = rep").select("id", "w", "x")
    keyed = reps.select("id", "x").transform(mapped, _passes(kind, passes, hashes), f"key binary, id {id_kind}, x binary")
    ordered = keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    found = durable(ordered.transform(mapped, _windows(kind, window, least), f"a {id_kind}, b {id_kind}, border int, side int, pass binary, id {id_kind}, x binary"), "vectors-windows")
    inside = found.where("a IS NOT NULL").select("a", "b")
    ends = found.where("border IS NOT NULL").select("border", "side", "pass", "id", "x").withColumn("key", F.monotonically_increasing_id())
    across = ends.groupBy("border", "pass").applyInPandas(_border(kind, window, least), f"a {id_kind}, b {id_kind}")
    near = durable(inside.unionByName(across), "vectors-near")
    first = components(near, "vectors-first")
    labelled = reps.join(first, "id", "left").select("id", F.coalesce("component", "id").alias("label"), "w", "x")
    swept = durable(_sweep(durable(labelled, "vectors-labelled"), kind, id_kind, least), "vectors-sweep")
    groups = components(near.unionByName(swept.where("b IS NOT NULL").select("a", "b")), "vectors-groups")
    counts = swept.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    told = reps.select("id", "w").join(groups, "id", "left").join(counts, "id", "left").select(F.col("id").alias("rep"), F.coalesce("component", "id").alias("component"), "links", F.col("w").alias("n"))
    nodes = join_hot(of_id.select("id", "rep"), told, ["rep"], "n", raw.count()).select("id", "component", "links")
    out = base.select("id").join(nodes, "id", "left")
    out = out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _raw(kind: str):
    def run(it):
        for batch in it:
            good, raw = usable(batch.column("vector"), kind)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(good, pa.int64())), pa.array(raw, pa.binary())], ["id", "x"])

    return run
