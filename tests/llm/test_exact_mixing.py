"""Exact duplicates and the source mix against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
from ledgerloom.llm.exact import content_sort, drop_exact
from ledgerloom.llm.mixing import fit, mix, mixed


def rows():
    rng = random.Random(2)
    texts = ["a b", "a  b", "a\n\tb", " a b", "A b", "", None, " ", " ", "x" * 5000, "x" * 5000 + " ", "same"]
    out = [(i, rng.choice(texts), f"s{rng.randint(0, 4)}") for i in range(300)]
    return out + [(None, "same", None), (3, "same", "s1"), (3, "same", "s1"), (None, "only null ids", None), (None, "only null ids", None), (900, "null source", None)]


def frame(spark, data):
    return spark.createDataFrame([(*r, 5, "z") for r in data], "doc_id long, text string, source string, salt int, norm string")


def test_content_sort(spark):
    groups = defaultdict(list)
    for i, t, _ in rows():
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    got = content_sort(frame(spark, rows())).collect()
    have = defaultdict(list)
    for r in got:
        have[r.text_sha256].append(r)
    assert len(have) == len(groups)
    for t, ids in groups.items():
        g = have[hashlib.sha256(t.encode()).hexdigest()]
        low = min((i for i in ids if i is not None), default=None)
        assert Counter(r.doc_id for r in g) == Counter(ids)
        assert {r.keep_id for r in g} == {low} and {r.group_size for r in g} == {len(ids)}
        assert [r.doc_id for r in g if r.kept] == [low]
    left = drop_exact(frame(spark, rows()))
    assert left.columns == ["doc_id", "text", "source", "salt", "norm"]
    assert len(left.collect()) == len(groups)
    assert content_sort(frame(spark, [])).collect() == []


def test_fit_is_exact_where_it_can_be():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lengths = np.unique(rng.integers(0, 40, rng.integers(1, 12)))
        counts = rng.integers(1, 6, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 2))
        take = fit(lengths, counts, budget, 1)
        assert (take >= 0).all() and (take <= counts).all()
        got = int((take * lengths).sum())
        base = np.array([int(c) * budget // max(1, int((lengths * counts).sum())) for c in counts])
        sums = {0}
        for x, n in zip(lengths, counts - np.minimum(base, counts)):
            sums = {s + k * int(x) for s in sums for k in range(int(n) + 1)}
        want = max(s for s in sums if s + int((base * lengths).sum()) <= budget) + int((base * lengths).sum()) if budget < (lengths * counts).sum() else int((lengths * counts).sum())
        assert got == want


def test_mix(spark):
    rng = random.Random(4)
    data = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))), f"s{min(rng.randint(0, 9), 6)}") for i in range(1500)]
    data += [(2000 + i, "q r s", None) for i in range(5)] + [(5000, None, "s1"), (None, "u v", "s2"), (7, "dup dup", "s3"), (7, "dup dup", "s3"), (5001, None, "zz-empty")]
    sizes, src = [], Counter()
    for i, t, s in data:
        n = len(re.findall("[^\x20\x09-\x0d]+", t or ""))
        sizes.append((i, s, n))
        src[s] += n
    order = sorted(src, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    pot, capped, target = 1.5 * sum(src.values()), set(), {}
    while True:
        rest = [s for s in order if s not in capped]
        share = (pot - sum(2 * src[s] for s in capped)) / max(1, sum(w[s] for s in rest))
        over = {s for s in rest if share * w[s] > 2 * src[s]}
        if not over:
            target = {s: 2 * src[s] if s in capped else share * w[s] for s in order}
            break
        capped |= over
    got = mix(frame(spark, data)).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == src[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 1.0, s
    again = mix(frame(spark, data).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    out = mixed(frame(spark, data))
    assert out.columns == ["doc_id", "text", "source", "salt", "norm"]
    assert Counter((r.doc_id, r.source) for r in out.collect()) == sum((Counter({(r.doc_id, r.source): r.copies}) for r in got), Counter())
    assert mix(frame(spark, [])).collect() == []


def test_clashing_names(spark):
    """Columns of any name keep their values, those that look like an operator's own included."""
    names = ["__id", "__own", "__n", "__k", "kept_id", "own_sha", "N", "own_size", "t_id", "_n", "copy"]
    kinds = "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names)
    data = [(i, t, "s", *(range(5, 5 + len(names)))) for i, t in enumerate(["a b", "a  b", "c d e", None])]
    df = spark.createDataFrame(data, kinds)
    for got in (drop_exact(df), mixed(df)):
        assert got.columns == df.columns
        rows = got.collect()
        assert rows and all(tuple(r)[3:] == tuple(range(5, 5 + len(names))) for r in rows)
    assert sorted(r.doc_id for r in drop_exact(df).collect()) == [0, 2, 3]
