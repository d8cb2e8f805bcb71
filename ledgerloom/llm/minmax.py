"""Near duplicates by min-max hashing: candidates from bands, links confirmed on full shingle sets, groups by components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Forest, components, durable, fresh, join_hot, joined, mapped, mix64, slices, union_all, word_hashes

#: Permutations; each gives its minimum and its maximum.
HASHES = 50
#: A pair at the threshold of similarity shares no band at most this often.
MISSED = 1e-5
#: Agreement of sketches from which a bucket's member joins its smallest, and below which it is in the second round.
JOINS, AGAIN = 0.35, 0.9
#: A cluster of more documents or shingles is verified in blocks.
SMALL_DOCS, SMALL_SHINGLES = 256, 1_000_000
#: Documents and shingles of a block, and pivots of a large cluster.
BLOCK_DOCS, BLOCK_SHINGLES, PIVOTS, QUERIES = 512, 500_000, 64, 128

_RNG = np.random.Generator(np.random.PCG64(77))
_A = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_W = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes: of `width` words, or of all words where there are fewer."""
    b, at = joined(texts)
    h, doc, _, _ = word_hashes(b, at)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    g = np.zeros(max(0, len(h) - width + 1), dtype=np.uint64)
    for k in range(width):
        g += h[k : k + len(g)] * _W[k]
    g = mix64(g)
    out = []
    for i in range(len(texts)):
        a, z = int(first[i]), int(first[i + 1])
        if z - a >= width:
            out.append(np.unique(g[a : z - width + 1]))
        elif z > a:
            out.append(mix64(np.array([(h[a:z] * _W[: z - a]).sum(dtype=np.uint64) + np.uint64(z - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sets that aren't empty: signature values (sets x 2 HASHES), and two hashes of each set as a whole."""
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    at = np.cumsum([0, *map(len, sets)])[:-1]
    values = np.empty((len(sets), 2 * HASHES), dtype=np.uint64)
    if not sets:
        return values, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for k in range(HASHES):
        v = flat * _A[k] + _B[k]
        values[:, 2 * k] = np.minimum.reduceat(v, at)
        values[:, 2 * k + 1] = np.maximum.reduceat(v, at)
    return values, np.add.reduceat(mix64(flat), at), np.add.reduceat(mix64(flat ^ _W[63]), at)


def band_rows(percent: int) -> int:
    """Values in a band: as many as keep a pair of that similarity from sharing no band but for MISSED of all cases.

    100 values make 20 bands of 5 at 0.85 (8e-6 are missed) and 25 of 4 at 0.8 (2e-6).
    """
    missed = lambda rows: (1 - (percent / 100) ** rows) ** (2 * HASHES // rows)
    return max((r for r in range(1, 2 * HASHES + 1) if missed(r) <= MISSED), default=1)


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    n = values.shape[1] // rows
    out = np.empty((len(values), n), dtype=np.uint64)
    for j in range(n):
        x = np.full(len(values), j + 1, dtype=np.uint64)
        for r in range(rows):
            x = mix64(x * _W[62] + values[:, j * rows + r])
        out[:, j] = x
    return out


def signatures(docs: DataFrame, width: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it):
        for batch in slices(it, 1 << 20):
            sets = shingle_sets(batch.column("text").to_pylist(), width)
            full = [i for i, s in enumerate(sets) if len(s)]
            values, h1, h2 = signature([sets[i] for i in full])
            n = np.array([len(s) for s in sets], dtype=np.int64)
            a, b = np.zeros((2, len(sets)), dtype=np.int64)
            a[full], b[full] = h1.view(np.int64), h2.view(np.int64)
            keys = bands(values, rows).view(np.int64)
            per = np.zeros(len(sets), dtype=np.int64)
            per[full] = keys.shape[1]
            offsets = pa.array(np.concatenate([[0], per.cumsum()]).astype(np.int32))
            sketch = np.ascontiguousarray((mix64(values) >> np.uint64(56)).astype(np.uint8))
            marks: list[bytes | None] = [None] * len(sets)
            for k, i in enumerate(full):
                marks[i] = sketch[k].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(a), pa.array(b), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())), pa.array(marks, pa.binary())], ["id", "n", "h1", "h2", "bands", "sketch"])

    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").transform(mapped, run, f"id {kind}, n long, h1 long, h2 long, bands array<long>, sketch binary")


def linked(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean (a x b): 100 * intersection >= percent * union, on the full sets, exactly; empty sets link with nothing."""
    na, nb = np.array([len(x) for x in a], dtype=np.int64), np.array([len(x) for x in b], dtype=np.int64)
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=bool)
    every, place = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    owner = np.repeat(np.arange(len(a) + len(b)), np.concatenate([na, nb]))
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    both, step = np.zeros((len(a), len(b)), dtype=np.int64), max(256, (1 << 21) // (len(a) + len(b)))
    for begin in range(0, len(every), step):
        i, j = np.searchsorted(place, [begin, begin + step])
        m = np.zeros((len(a) + len(b), min(step, len(every) - begin)), dtype=np.float32)
        m[owner[i:j], place[i:j] - begin] = 1
        both += np.rint(m[: len(a)] @ m[len(a) :].T).astype(np.int64)
    union = na[:, None] + nb[None, :] - both
    return (100 * both >= percent * union) & (both > 0)


def _spanning(ids: list, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links of one small cluster that join what wasn't joined."""
    tree, out = Forest(len(ids)), []
    hit = linked(sets, sets, percent)
    for i, j in zip(*np.nonzero(np.triu(hit, 1))):
        if tree.join(int(i), int(j)):
            out.append((ids[i], ids[j]))
    return out


def _pairs(edges: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in edges], kind), pa.array([x for _, x in edges], kind)], ["a", "b"])


def _small(width: int, percent: int):
    def run(it):
        def done():
            return _spanning(ids, shingle_sets(texts, width), percent) if len(ids) > 1 else []

        cluster, ids, texts, edges, kind = None, [], [], [], None
        for batch in slices(it):
            kind = batch.column("id").type
            for c, i, t in zip(batch.column("cluster").to_pylist(), batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if c != cluster:
                    edges += done()
                    cluster, ids, texts = c, [], []
                ids.append(i)
                texts.append(t)
            if edges:
                yield _pairs(edges, kind)
                edges = []
        if kind is not None:
            yield _pairs(done(), kind)

    return run


def _cross(width: int, percent: int):
    def run(q: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        q = q.rename(columns=lambda c: c.removeprefix("q_"))
        edges: list[tuple] = []
        if len(q) and len(m):
            hit = linked(shingle_sets(q["text"].tolist(), width), shingle_sets(m["text"].tolist(), width), percent)
            nodes = {x: k for k, x in enumerate(dict.fromkeys([*q["id"], *m["id"]]))}
            tree, qi, mi = Forest(len(nodes)), q["id"].tolist(), m["id"].tolist()
            for i, j in zip(*np.nonzero(hit)):
                if tree.join(nodes[qi[i]], nodes[mi[j]]):
                    edges.append((qi[i], mi[j]))
        return pd.DataFrame({"a": pd.Series([x for x, _ in edges], dtype=object), "b": pd.Series([x for _, x in edges], dtype=object)})

    return run


def _agreement(it):
    """The share of places in which two sketches agree."""
    for batch in it:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for c in ("s1", "s2"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("pivot"), pa.array((a == b).mean(axis=1))], ["id", "pivot", "same"])


def _candidates(reps: DataFrame, kind: str) -> DataFrame:
    """Edges (a, b) whose components hold every pair that shares a band, but for pairs far apart by their sketches.

    Each bucket's smallest id is its pivot. A member whose sketch agrees with the pivot's at JOINS of the places or more is
    joined to it; one that agrees at less than AGAIN goes on with its like to a second round, where all are joined to the
    smallest. A linked pair g, m could only be parted where g agrees with the pivot at AGAIN and m at less than JOINS. As
    1 - J is a metric, with g and m at 0.8 their similarities to the pivot differ by 0.2 at most, so one of the two
    estimates from 100 places is far off: four times in 100,000 for one bucket if g is at 0.735, less elsewhere, and a
    linked pair shares several buckets. Counts and minima are pre-aggregated, and rows of a hot bucket or pivot stay
    where they are, so large buckets cost one row a member, never pairs.
    """
    keys = reps.select("id", F.explode("bands").alias("key"))
    rows = reps.agg(F.sum(F.size("bands"))).first()[0] or 0
    pivots = keys.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    star = durable(join_hot(keys, pivots, ["key"], "n", rows).where("id <> pivot"), "minmax-star")
    pairs = durable(star.select("id", "pivot").distinct(), "minmax-pairs")
    far = pairs.groupBy("pivot").agg(F.count("*").alias("n")).join(reps.select(F.col("id").alias("pivot"), F.col("sketch").alias("s2")), "pivot")
    near = join_hot(pairs.join(reps.select("id", F.col("sketch").alias("s1")), "id"), far, ["pivot"], "n", rows)
    near = durable(near.select("id", "pivot", "s1", "s2").transform(mapped, _agreement, f"id {kind}, pivot {kind}, same double"), "minmax-near")
    again = durable(star.join(near.where(F.col("same") < AGAIN).select("id", "pivot"), ["id", "pivot"]).select("key", "id"), "minmax-again")
    second = again.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    more = join_hot(again, second, ["key"], "n", rows).where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    return near.where(F.col("same") >= JOINS).select(F.col("pivot").alias("a"), F.col("id").alias("b")).unionByName(more).distinct()


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_shingles, component_id, kept (id = component_id).

    A document's set: its distinct shingles of `width` lower-cased words, all words as one where there are fewer, none
    without words. Documents with 100 * intersection >= percent * union are linked; component_id is the smallest id
    reachable by links.

    Equal sets become one class by pre-aggregation. Classes that share a band of the min-max signature (minimum and
    maximum under each of HASHES permutations) are candidates; the candidates' components are clusters. A small cluster
    is compared whole in one task. Of a large one, all members are compared with some pivots, in blocks; those that stayed
    outside of its largest group then meet the members of their bands' buckets, so that copies of one text cost rows in
    proportion and no text meets a whole cluster twice.

    Null or empty texts have n_shingles 0 and link with nothing. Null ids link with nothing, have a null component_id
    and are kept. Rows that share an id are one node. Ids may be of any type that has an order. Ties and repeated rows
    need no rule: links and minima decide. No rows in, no rows out; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sig = durable(signatures(docs, width, band_rows(percent), id_col, text_col), "minmax-signatures")
    named = sig.where("n > 0 AND id IS NOT NULL")
    total = named.count()
    classes = durable(named.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("members")), "minmax-classes")
    of_class = durable(join_hot(named.select("id", "h1", "h2", "n"), classes, ["h1", "h2"], "members", total), "minmax-of-class")
    owners = of_class.select("id", "rep").distinct()
    several = owners.groupBy("id").agg(F.count("*").alias("classes")).where("classes > 1")
    shared = owners.join(several, "id", "left_semi").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    reps = named.join(classes.select("h1", "h2", F.col("rep").alias("id")), ["h1", "h2", "id"]).groupBy("h1", "h2", "id").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    reps = durable(reps.select("id", "n", "bands", "sketch"), "minmax-reps")
    clusters = components(_candidates(reps, kind), "minmax-clusters").withColumnRenamed("component", "cluster")
    sizes = clusters.join(reps.groupBy("id").agg(F.sum("n").alias("n")), "id").groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    salts = F.when((F.col("docs") > SMALL_DOCS) | (F.col("shingles") > SMALL_SHINGLES), F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))).otherwise(0)
    where = join_hot(clusters, sizes.select("cluster", salts.cast("int").alias("salts"), "docs", F.col("docs").alias("n")), ["cluster"], "n", total)
    texts = durable(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(where, "id"), "minmax-texts")
    edges = [texts.where("salts = 0").select("cluster", "id", "text").repartition("cluster").sortWithinPartitions("cluster", "id").transform(mapped, _small(width, percent), f"a {kind}, b {kind}")]
    large = texts.where("salts > 0")
    if not large.isEmpty():
        edges.append(_large(large, reps, width, percent, kind))
    groups = components(union_all([*edges, shared]), "minmax-groups")
    told = classes.join(groups, F.col("rep") == F.col("id"), "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"), "members")
    out = join_hot(of_class.select("id", "h1", "h2", "n"), told, ["h1", "h2"], "members", total).select("id", "n", "component")
    out = out.unionByName(sig.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component")))
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _asked(df: DataFrame) -> DataFrame:
    """df under names of its own, as Spark can't tell two sides of a cogroup apart that come from one table."""
    return df.select(*[F.col(c).alias(f"q_{c}") for c in df.columns])


def _large(large: DataFrame, reps: DataFrame, width: int, percent: int, kind: str) -> DataFrame:
    """Links of large clusters, in blocks: all members with the pivots of their cluster, then, bucket by bucket, the members of
    buckets that have some outside of their cluster's largest group with those."""
    schema, cross = f"a {kind}, b {kind}", _cross(width, percent)
    members = large.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    by_hash = Window.partitionBy("cluster").orderBy(F.xxhash64("id", F.lit(5)), "id")
    ranked = large.select("cluster", "id").withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= PIVOTS).select("cluster", "id")
    pivots = large.join(ranked, ["cluster", "id"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    first = durable(_asked(pivots).groupBy("q_cluster", "q_salt").cogroup(members.groupBy("cluster", "salt")).applyInPandas(cross, schema), "minmax-pivots")
    found = components(first, "minmax-pivot-groups")
    placed = durable(large.select("cluster", "id", "docs").distinct().join(found, "id", "left").withColumn("component", F.coalesce("component", "id")), "minmax-placed")
    counts = placed.groupBy("cluster", "component").agg(F.count("*").alias("n"), F.max("docs").alias("docs"))
    top = counts.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("top"), F.max("docs").alias("all")).select("cluster", F.col("top.component").alias("giant"), "all")
    total = placed.count()
    keys = join_hot(placed.select("cluster", "id", "component"), top, ["cluster"], "all", total).select("id", (F.col("component") != F.col("giant")).alias("rest"))
    keys = durable(keys.join(reps.select("id", "n", F.explode("bands").alias("key")), "id"), "minmax-bucket-rows")
    buckets = keys.groupBy("key").agg(F.count("*").alias("docs"), F.count_if("rest").alias("asked"), F.sum("n").alias("shingles")).where("asked > 0 AND docs > 1")
    buckets = buckets.select("key", F.ceil(F.col("asked") / QUERIES).cast("int").alias("blocks"), F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("salts"), "docs")
    rows = durable(join_hot(keys, buckets, ["key"], "docs", keys.count()), "minmax-buckets").join(large.select("id", "text").groupBy("id").agg(F.first("text").alias("text")), "id")
    salt, block = F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"), F.pmod(F.xxhash64("id", F.lit(9)), F.col("blocks")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = rows.where("rest").withColumn("block", block).withColumn("salt", every("salts")).select("key", "salt", "block", "id", "text")
    against = rows.withColumn("salt", salt).withColumn("block", every("blocks")).select("key", "salt", "block", "id", "text")
    second = _asked(queries).groupBy("q_key", "q_salt", "q_block").cogroup(against.groupBy("key", "salt", "block")).applyInPandas(cross, schema)
    return first.unionByName(durable(second, "minmax-rest"))


def drop_near(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with all its columns, without the rows that near_groups() doesn't keep."""
    (gone_id,) = fresh(docs, "gone_id")
    gone = near_groups(docs, width, percent, id_col, text_col).where("NOT kept").select(F.col(id_col).alias(gone_id))
    return docs.join(gone, F.col(id_col) == F.col(gone_id), "left_anti")
