"""What the corpus operators share: durable tables in the shared folder, connected components, word hashing."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from contextlib import contextmanager
from functools import reduce, wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, for a regular expression's character class.
SPACE = r"\x20\x09-\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary folder of this
    machine serves a local master; on a cluster there is no such folder, so that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = getattr(spark, "_ledgerloom_dir", None)
    if own is None:
        own = spark._ledgerloom_dir = tempfile.mkdtemp(prefix="ledgerloom-")
    return own


#: Paths of the durable tables of each scratch() that is open, the innermost last.
_open: list[list[str]] = []


def _delete(spark: SparkSession, path: str, now: bool) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if now:
        files.delete(at, True)
    else:
        files.deleteOnExit(at)


def durable(df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends there, and a lost executor costs nothing.

    The table goes by discard(), at the end of a scratch(), unless it outlives that, or at the latest when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _delete(spark, path, now=False)
    if len(_open) > outlives:
        _open[-1 - outlives].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.durable_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete durable tables from which nothing is read any more."""
    for t in tables:
        _delete(t.sparkSession, t.durable_path, now=True)


@contextmanager
def scratch(spark: SparkSession):
    """Durable tables that are made inside, by any operator, are deleted at its end, when all that came of them is written."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            _delete(spark, path, now=True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from all columns of df in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


#: A key with over one in so many of the rows is hot. No more keys than that can be, which bounds what is broadcast.
HOT = 1000


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], n: str, rows: int) -> DataFrame:
    """left joined to right on keys. right has each key once and says in column n, which is dropped, how many rows with it
    left has at most; `rows` bounds the sum of n. Rows of hot keys stay where they are, and right's row comes to them."""
    hot = F.broadcast(right.where(F.col(n) > rows // HOT).drop(n))
    return left.join(hot, keys).unionByName(left.join(hot, keys, "left_anti").join(right.where(F.col(n) <= rows // HOT).drop(n), keys))


def _toward_low(edges: DataFrame, keyed: DataFrame, rows: int) -> DataFrame:
    """edges (u, v) with m, the smallest of u and all v that u has in keyed."""
    low = keyed.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return join_hot(edges, low.select("u", F.least("u", "m").alias("m"), "n"), ["u"], "n", rows)


def components(edges: DataFrame, name: str = "cc", rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): one row (id, component) for each id on an edge, component being its smallest id.

    Alternating large-star and small-star contraction. Each half of a round is one aggregation, combined before the
    shuffle, and a join that is split for hubs; it ends in a durable table, so lineage and memory stay flat, and the one
    before it is deleted. Only a count and a checksum reach the driver. Ids may be of any type that has an order.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    state = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    e = durable(e, name)
    seen = state(e)
    for _ in range(rounds):
        rows = 2 * seen[0]
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = durable(_toward_low(both.where("v > u"), both, rows).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), name)
        pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        small = durable(_toward_low(large, large, rows).select(pairs.alias("x")).select("x.u", "x.v").where("u <> v").distinct(), name)
        discard(e, large)
        e, now = small, state(small)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


# --- hashes of words, for NumPy over many texts at once -------------------------------------------------------------

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _pow(kind: str, base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _powers[kind] = have = np.multiply.accumulate(have)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased (A-Z) bytes of all texts, each followed by a space, and each text's start; the last entry is the end."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    at = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in raw], out=at[1:])
    b = np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)
    return _LOWER[b], at


def word_hashes(b: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For joined() bytes: each word's 64-bit hash, the number of the text that it is in, its start and its length.

    A word's hash is a polynomial over random odd 64-bit letters, by differences of one running sum, then mixed with its length.
    """
    space = _IS_SPACE[b]
    edge = np.flatnonzero(np.diff(space, prepend=True)) if len(b) else np.zeros(0, dtype=np.int64)
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * _pow("m", _MULT, len(b)), out=total[1:])
    h = (total[end] - total[start]) * _pow("i", _INV, len(b) + 1)[start]
    h = mix64(h + (end - start).astype(np.uint64))
    return h, np.searchsorted(at, start, side="right") - 1, start, end - start


def release() -> None:
    """Give freed memory of this process back to the system, which the allocators of Arrow and of C otherwise keep."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_held: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What this process keeps for the tasks of one operator; asking for it drops what it kept for any other."""
    for other in [k for k in _held if k != owner]:
        del _held[other]
    return _held.setdefault(owner, {})


#: Bytes of an Arrow batch between Spark and Python, on both sides; Spark's default is 10,000 rows of any size.
BATCH = 4 << 20


def mapped(df: DataFrame, run, schema: str, keeps: str = "") -> DataFrame:
    """df.mapInArrow(run, schema) for workers that serve tasks of further operators: batches are bounded by bytes (a setting
    of the session), what the worker holds for any operator but `keeps` is dropped, and what run freed is given back."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))

    @wraps(run)
    def wrapped(it):
        held(keeps)
        try:
            yield from run(it)
        finally:
            release()

    return df.mapInArrow(wrapped, schema)


def slices(it, most_bytes: int = 4 << 20, column: str = "text"):
    """Arrow record batches of the iterator cut so that each holds about most_bytes of text, one row at least."""
    import pyarrow.compute as pc

    for batch in it:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        begin = 0
        while begin < batch.num_rows:
            base = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, base + most_bytes, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class Forest:
    """Union-find over 0 .. n - 1, for groups of bounded size inside one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
