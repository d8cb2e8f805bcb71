"""Near duplicates against all pairs."""

import random
import re

import pytest
from ledgerloom.llm import minmax
from ledgerloom.llm.minmax import drop_near, near_groups


def brute(rows, width, percent):
    sets, ids = {}, {}
    for k, (i, t) in enumerate(rows):
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        ids[k] = i
    up = {i: i for i in ids.values() if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and None not in (ids[a], ids[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[a] & sets[b]:
                x, y = sorted((find(ids[a]), find(ids[b])))
                up[y] = x
    return sorted((i is None, i or 0, len(sets[k]), -1 if i is None else find(i)) for k, (i, _) in enumerate(rows))


def corpus(n=160, seed=1):
    rng = random.Random(seed)
    vocab = [f"W{k}" if k % 3 else f"wé{k}" for k in range(400)]
    rows, bases = [], [[rng.choice(vocab) for _ in range(rng.randint(1, 120))] for _ in range(12)]
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i * 3 % n + 1, rng.choice([" ", "\n", "  "]).join(w)))
    return rows + [(None, rows[0][1]), (None, None), (500, ""), (501, None), (502, " \n"), (503, "One"), (504, "one"), (505, "a b"), (506, "A  b"), (507, "x " * 3000), (508, "x " * 3000), (508, "x " * 3000)]


@pytest.mark.parametrize("blocks", [False, True])
@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_groups_are_all_pairs(spark, monkeypatch, blocks, width, percent):
    if blocks:
        for k, v in {"SMALL_DOCS": 3, "BLOCK_DOCS": 5, "PIVOTS": 1, "QUERIES": 3}.items():
            monkeypatch.setattr(minmax, k, v)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, n int, cluster string")
    got = near_groups(df, width, percent).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in got) == brute(rows, width, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_drop_near_and_empty(spark):
    rows = corpus(40)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    left = drop_near(df)
    want = {x[3] if not x[0] else None for x in brute(rows, 5, 80)}
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == want
    assert near_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_text_ids(spark):
    rows = [(None if i is None else f"d{i:05d}", t) for i, t in corpus(60)]
    got = near_groups(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    number = {i: k for k, i in enumerate(sorted({i for i, _ in rows if i}))}
    want = brute([(number.get(i), t) for i, t in rows], 5, 80)
    assert sorted((r.doc_id is None, number.get(r.doc_id, 0), r.n_shingles, -1 if r.doc_id is None else number[r.component_id]) for r in got) == want


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c", 4, 5, 6), (2, "a b c", 7, 8, 9)], "doc_id long, text string, gone_id int, __id int, id int")
    assert [tuple(r) for r in drop_near(df).collect()] == [(1, "a b c", 4, 5, 6)]


def test_recall_on_the_table(spark):
    """Every twentieth document of sf0.1 against all: of the linked pairs, at least 0.9 must be in one group (all are, when written)."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()
    sets = {}
    for r in docs:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {hash(tuple(w[j : j + 3])) for j in range(len(w) - 2)} or ({hash(tuple(w))} if w else set())
    at = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    pairs = []
    for q in sets:
        if q % 20 == 0:
            both = {}
            for x in sets[q]:
                for i in at[x]:
                    both[i] = both.get(i, 0) + 1
            pairs += [(q, i) for i, n in both.items() if i != q and 100 * n >= 85 * (len(sets[q]) + len(sets[i]) - n)]
    group = {r.doc_id: r.component_id for r in near_groups(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), 3, 85).collect()}
    found = sum(group[a] == group[b] for a, b in pairs)
    print("recall", found, "of", len(pairs))
    assert pairs and found >= 0.9 * len(pairs)
