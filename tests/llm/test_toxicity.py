"""Toxicity: accuracy on held-out labels, and rows of every kind."""

import math
import random

import numpy as np
import pytest
from ledgerloom.llm.toxicity import Model, _fit, drop_toxic, score, train


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    n, m = 4000, 12
    x = rng.random((n, m)) < 0.3
    w = rng.normal(0, 2, m)
    z = x @ w + rng.logistic(size=n)
    grade = (z[:, None] > np.quantile(z, [0.6, 0.8, 0.92])[None, :]).sum(axis=1)
    doc, word = np.nonzero(x)
    model = Model(np.arange(m, dtype=np.uint64), *_fit(word, doc, n, grade, m))
    assert (np.diff(model.thresholds) > 0).all() and np.corrcoef(model.weights, w)[0, 1] > 0.99
    up = model.at_least(x @ model.weights)
    assert (np.diff(up, axis=1) <= 0).all() and np.allclose(up.mean(axis=0), [(grade > k).mean() for k in range(3)], atol=0.02)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = train(docs, labels.where("doc_id % 3 <> 0"))
    got = score(docs, model).join(labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "truth"), "doc_id").select("toxic", "truth", "expected_severity", "grade").toPandas()
    hit = got.toxic & (got.truth == 1)
    assert hit.sum() >= 0.9 * (got.truth == 1).sum() and hit.sum() >= 0.98 * got.toxic.sum()
    assert got.expected_severity[got.truth == 1].mean() > 1 > 0.2 > got.expected_severity[got.truth == 0].mean()
    assert set(got.grade) <= {0, 1, 2, 3} and got.grade.max() >= 2


def rows():
    rng = random.Random(1)
    clean = [(i, " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(30)), 0) for i in range(200)]
    toxic = [(300 + i, " ".join(rng.choice("alpha beta gamma vile! Foul nasty".split()) for _ in range(30)), 1) for i in range(60)]
    return clean + toxic


def test_rows_of_every_kind(spark):
    labelled = rows()
    odd = [(None, "vile foul nasty"), (900, None), (901, ""), (902, "\n \t"), (300, labelled[200][1]), (903, "VILE, foul; nasty " * 20_000), (904, "alpha " * 50_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t, _ in labelled] + [(*o, 2) for o in odd], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in labelled] + [(None, 1, 0), (5, None, 0), (300, 0, 0)], "doc_id long, toxic int, quality int")
    got = score(df, train(df, labels)).collect()
    assert len(got) == len(labelled) + len(odd)
    assert {r.doc_id for r in got if r.toxic} == {i for i, _, y in labelled if y} | {None, 903}
    left = drop_toxic(df, labels)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == sorted([i for i, _, y in labelled if not y] + [900, 901, 902, 904])


@pytest.mark.parametrize("toxic", [0, 1, None])
def test_one_kind_of_labels_rejects_nothing(spark, toxic):
    df = spark.createDataFrame([(1, "a"), (2, "b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, toxic), (2, toxic)], "doc_id long, toxic int")
    assert drop_toxic(df, labels).count() == 2 and drop_toxic(df, labels.limit(0)).count() == 2
    assert score(df.limit(0), Model(np.zeros(0, np.uint64), np.zeros((0, 3)), np.full(3, 40.0))).collect() == []


def test_scores_are_those_of_a_plain_scorer(spark):
    """Features, margins, probabilities and severity word by word with plain numbers, on odd rows."""
    from ledgerloom.llm import common, toxicity

    mask = (1 << 64) - 1

    def mix(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor & mask
        return x ^ x >> 31

    def features(text):
        b = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode("utf-8", "surrogatepass"))
        words = "".join(chr(c) if c >= 128 or chr(c).isalpha() else " " for c in b).split(" ")
        words = [bytes(map(ord, w)) for w in words if w]
        n = {}
        for w in words:
            h = mix(sum(int(common._BYTE[c]) * pow(common._MULT, k, 1 << 64) for k, c in enumerate(w)) + len(w) & mask)
            for f in [h] + [mix(int.from_bytes(w[:k], "little") ^ (k << 60) & mask) for k in toxicity.STEMS if len(w) >= k]:
                n[f] = n.get(f, 0) + 1
        return {f: sum(c >= least and c >= share * len(words) for least, share in toxicity.LEVELS) for f, c in n.items()}

    rng = random.Random(6)
    words = ["vile", "Vile", "nasty!", "x", "tree", "straße", "naïve", "日本語", "a1b", "''", "ABCDEFGHIJ", "\x1c", " "]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 40, 200]))) for _ in range(80)] + [None, "", " \n", "vile" * 3000, "vile " * 3000]
    seen = sorted({f for t in texts for f in features(t)})
    chosen = rng.sample(seen, len(seen) * 2 // 3)
    model = toxicity.Model(np.array(sorted(chosen), dtype=np.uint64), np.array([[rng.uniform(-2, 2) for _ in toxicity.LEVELS] for _ in chosen]), np.array([0.3, 0.9, 2.5]))
    weight = {int(f): w for f, w in zip(model.words, model.weights)}
    rows = [(i % 60 if i else None, t, 7.0) for i, t in enumerate(texts)]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id int, text string, grade double"), model).collect()
    key = lambda r: (r[0] is None, r[0] or 0, round(r[1], 9))
    want = []
    for i, t, _ in rows:
        z = sum(weight[f][level - 1] for f, level in features(t).items() if f in weight)
        up = [1 / (1 + math.exp(min(40, max(-40, c - z)))) for c in model.thresholds]
        each = [a - b for a, b in zip([1.0, *up], [*up, 0.0])]
        want.append((i, up[0], sum(up), max(range(4), key=lambda k: (round(each[k], 12), -k)), up[0] >= 0.5))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[0] == w[0] and math.isclose(g[1], w[1], abs_tol=1e-9) and math.isclose(g[2], w[2], abs_tol=1e-9) and g[3] == w[3] and g[4] == w[4]
    assert len(got) == len(want)
