"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest
from ledgerloom.llm import vectors
from ledgerloom.llm.vectors import near_vectors


def rows(dim=16, n=300):
    rng = np.random.default_rng(4)
    out = []
    for i in range(n):
        v = rng.standard_normal(dim)
        out.append((i * 7 % n, v))
        if i % 5 == 0:
            for k in range(int(rng.integers(1, 5))):
                out.append((1000 + 10 * i + k, v + rng.standard_normal(dim) * rng.choice([0.0, 0.1, 0.3])))
    v = rng.standard_normal(dim)
    return out + [(9000 + k, v * (k + 1) + rng.standard_normal(dim) * 0.05 * k ** 0.3) for k in range(150)]


def brute(data, least):
    x = np.array([v for _, v in data], dtype=np.float32).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    hit = x @ x.T >= least
    ids = [i for i, _ in data]
    low = np.array(ids)
    while True:
        new = np.array([low[hit[k]].min() for k in range(len(ids))])
        if (new == low).all():
            return {i: (int(hit[k].sum()) - 1, int(low[k])) for k, i in enumerate(ids)}
        low = new


@pytest.mark.parametrize("block", [(4096, 32768), (20, 20)])
def test_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    data = rows()
    odd = [(-1, None), (-2, [0.0] * 16), (-3, [float("nan")] * 16), (-4, [1.0, None] * 8), (-5, []), (-6, [float("inf")] * 16), (None, [1.0] * 16), (-7, [1.0, 2.0]), (-8, [1.0, 2.0]), (-9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in [*data, *odd, data[0]]], "vec_id long, embedding array<float>, n_links int")
    got = near_vectors(df, passes=12).collect()
    want = brute(data, 0.9) | {i: (0, i) for i, _ in odd} | {-7: (1, -8), -8: (1, -8)}
    assert len(got) == len(data) + len(odd) + 1
    for r in got:
        assert (r.n_links, r.component_id) == want[r.vec_id], r
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_links_beyond_the_window(spark, monkeypatch):
    """A pair that no pass brings within the window is linked all the same, over several blocks."""
    monkeypatch.setattr(vectors, "BLOCK", (60, 60))
    data = sorted(rows(), key=lambda r: r[0])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in data], "vec_id long, embedding array<float>")
    want = brute(data, 0.9)
    for r in near_vectors(df, passes=1, window=1).collect():
        assert (r.n_links, r.component_id) == want[r.vec_id], r


def test_hot_vector_and_text_ids(spark):
    """A third of all rows hold one vector; ids are text."""
    data = [(f"id{i:04d}", v) for i, v in sorted(rows(), key=lambda r: r[0])]
    one = data[5][1]
    data += [(f"hot{k:04d}", one) for k in range(len(data) // 2)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in data], "vec_id string, embedding array<float>").repartition(7)
    number = {i: k for k, i in enumerate(sorted(i for i, _ in data))}
    want = brute([(number[i], v) for i, v in data], 0.9)
    got = near_vectors(df).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r.n_links, number[r.component_id]) == want[number[r.vec_id]], r


def test_passes_find_links(spark):
    """Recall of the sorted passes alone, without the sweep: the whole sf0.1 table, in which nothing links, with a turned copy of
    every twentieth vector at a cosine of 0.9 to 0.92, and a dense region of a third as many rows."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rng = np.random.default_rng(8)
    data = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in table.collect() if r.embedding]
    turned = lambda v, c: (lambda w: c * v / np.linalg.norm(v) + np.sqrt(1 - c * c) * w / np.linalg.norm(w))((lambda u: u - v * (u @ v) / (v @ v))(rng.standard_normal(len(v))))
    far = max(i for i, _ in data) + 1
    data += [(far + i, turned(v, rng.uniform(0.9005, 0.92))) for i, v in data if i % 20 == 0]
    centre = data[1][1]
    data += [(3 * far + k, turned(centre, rng.uniform(0.85, 0.95))) for k in range(len(data) // 3)]
    x = np.array([v for _, v in data], dtype=np.float32).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    linked = np.argwhere(np.triu(x @ x.T >= 0.9, 1))
    kept, sweep = [], vectors._sweep
    try:
        vectors._sweep = lambda v, *a: (kept.append(v), sweep(v.limit(0), *a))[1]
        near_vectors(spark.createDataFrame([(i, [float(y) for y in v]) for i, v in data], "vec_id long, embedding array<float>")).count()
    finally:
        vectors._sweep = sweep
    label = {r.id: r.label for r in kept[0].collect()}
    recall = np.mean([label[data[i][0]] == label[data[j][0]] for i, j in linked])
    print("recall of the passes alone", recall, "of", len(linked))
    assert recall >= 0.9
