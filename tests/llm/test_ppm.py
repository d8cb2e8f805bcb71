"""Partial matching against a plain implementation."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from ledgerloom.llm.ppm import Scorer, Trie, grams, lm_scores, streams


def tokens(t):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def stream(t):
    return " ".join(tokens(t)).encode() + b"\n"


class Plain:
    def __init__(self, texts, order, nodes):
        self.order, self.n = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            s = b"\n" * order + stream(t)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.n[k][s[i - k : i + 1]] += 1
        self.least = max(1, math.ceil(sum(self.n[0].values()) / 2**nodes))
        self.kids = [{} for _ in range(order + 1)]
        self.total = [Counter() for _ in range(order + 1)]
        for k in range(order + 1):
            for g, c in self.n[k].items():
                self.total[k][g[:-1]] += c
                if c >= self.least:
                    self.kids[k].setdefault(g[:-1], {})[g[-1]] = c

    def probability(self, context, symbol):
        p, gone = 1.0, set()
        for k in range(self.order, -1, -1):
            c = context[len(context) - k :]
            kids = self.kids[k].get(c)
            if not kids:
                continue
            n = self.total[k][c] - sum(kids[s] for s in gone)
            if symbol in kids and symbol not in gone:
                return p * (kids[symbol] - 0.5) / n
            if n > 0:
                new = [s for s in kids if s not in gone]
                p *= (0.5 * len(new) + n - sum(kids[s] for s in new)) / n
            gone |= set(kids)
        return p / (256 - len(gone))

    def score(self, t):
        s = b"\n" * self.order + stream(t)
        return sum(math.log10(self.probability(s[i - self.order : i], s[i])) for i in range(self.order, len(s)))


def corpus():
    rng = random.Random(1)
    syllables = ["an", "the", "re", "ß", "éa", "in", "X", "y,"]
    text = lambda: rng.choice([" ", "\n", "  "]).join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 60)))
    rows = [(i, text()) for i in range(120)]
    return rows + [(200, None), (201, ""), (202, "  lead and trail \n"), (203, "日本 \x00 new"), (None, "null id"), (7, rows[7][1]), (7, "other"), (204, "z" * 3000)]


@pytest.mark.parametrize("order,nodes,words", [(3, 20, 20), (5, 7, 5), (2, 5, 20)])
def test_scores(spark, order, nodes, words):
    rows = corpus()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    train = [t for i, t in rows if not held(i)]
    plain = Plain(train, order, nodes)
    c = Counter(w for t in train for w in [*tokens(t), None])
    total, distinct = sum(c.values()), len(c)
    want = []
    for i, t in rows:
        w = [*tokens(t), None]
        base = sum(math.log10((c[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        want.append((i is None, i or 0, held(i), len(w), sum(c[x] > 0 for x in w), total, base, plain.score(t)))
    df = spark.createDataFrame([(*r, 1, 0.0) for r in rows], "doc_id long, text string, n int, score double")
    got = [(r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_scores(df, order, nodes, words).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:6] == b[:6] and a[6:] == pytest.approx(b[6:], rel=1e-9), (a, b)


def test_probabilities_sum_to_one():
    plain = Plain([t for _, t in corpus()], 3, 8)
    for context in (b"the", b"\n\n\n", b"zzz", b"qqq", b"anr"):
        assert sum(plain.probability(context, s) for s in range(256)) == pytest.approx(1)


def test_streams():
    s, coded, first = streams([None, " a\t B ", "x"], 2)
    assert bytes(s) == b"\n\n\n\n\na b\n\n\nx\n" and first.tolist() == [0, 3, 9] and bytes(s[coded]) == b"\na b\nx\n"
    assert grams(np.frombuffer(b"abc", dtype=np.uint8), 1).tolist() == [97, 97 * 256 + 98, 98 * 256 + 99]


def test_nothing(spark):
    assert lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm_scores(spark.createDataFrame([(held, "ab")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (2, 0, 0) and r.score == pytest.approx(-3 * math.log10(256))
    assert Scorer(Trie(1, [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2, [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)] * 2)).score(np.zeros(1, np.uint64)) == pytest.approx(-math.log10(256))


@pytest.mark.parametrize("listed", [0, 300, 1 << 20])
def test_whole_model(spark, monkeypatch, listed):
    """No count is dropped where training is longer than 2 ** 20 symbols, however many grams are scored in place."""
    from ledgerloom.llm import ppm

    monkeypatch.setattr(ppm, "LISTED", listed, raising=False)
    rows = [*corpus(), *((1000 + i, "abcdefgh " * 9000) for i in range(20))]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    train = [t for i, t in rows if not held(i)]
    assert sum(len(stream(t)) for t in train) > 1 << 20
    plain = Plain(train, 3, 60)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect())
    want = sorted((i is None, i or 0, len(tokens(t)) + 1, plain.score(t)) for i, t in rows)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9), (a, b)


def test_base_scores_alone_make_no_model(spark, monkeypatch):
    rows = [(k, " ".join(f"W{(k * j) % 7}" for j in range(k % 6))) for k in range(40)] + [(None, None), (41, ""), (3, "w1 again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for words in (20, 2):
        for frame in (docs, docs.limit(0), docs.where("crc32(cast(doc_id AS string)) % 5 = 1")):
            want = lm_scores(frame, words=words).drop("score")
            with monkeypatch.context() as m:
                for step in ("streams", "grams", "_levels", "_seen", "_listed"):
                    m.setattr(f"ledgerloom.llm.ppm.{step}", None)
                got = lm_scores(frame, words=words, model=False)
                assert got.columns == want.columns
                got = got.toPandas()
            key = ["doc_id", "n_tokens", "base_score"]
            assert got.sort_values(key).round(9).reset_index(drop=True).equals(want.toPandas().sort_values(key).round(9).reset_index(drop=True))
