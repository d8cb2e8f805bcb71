"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from ledgerloom.llm import suffix
from ledgerloom.llm.suffix import remove_repeats, suffix_array


def brute(rows, span):
    texts = [(t or "").encode() for _, t in rows]
    n = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = Counter()
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - span + 1):
            if n[t[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        left = bytes(c for c, g in zip(t, gone) if not g)
        out[i, len(t), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(left).hexdigest()] += 1
    return out


def corpus(span, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 9)))
    text = lambda n: "".join(word() for _ in range(n))
    shared = [text(rng.randint(span // 12, span // 2)) for _ in range(6)]
    rows = []
    for i in range(60):
        t = text(rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(t))
            t = t[:k] + rng.choice(shared) + t[k:]
        rows.append((i, t))
    rows += [(100, rows[3][1]), (101, rows[3][1][5:]), (102, "a" * (span + 30)), (103, "a" * (span - 1)), (104, "ab" * span), (105, "x" * span), (106, None), (None, rows[9][1]), (7, rows[7][1]), (107, ""), (108, "xyz" * 3 * span + "q" + "xyz" * span), (109, "y" * span + "z")]
    return rows


def test_suffix_array():
    rng = np.random.default_rng(0)
    for k in range(60):
        t = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 120)), 0).astype(np.uint16)
        if k % 3 == 0:
            t = np.append(np.tile(t[:5] + 1, 20), 0).astype(np.uint16)
        want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        assert suffix_array(t, len(t)).tolist() == want


@pytest.mark.parametrize("span,wide", [(200, None), (64, None), (40, 0)])
def test_remove_repeats(spark, monkeypatch, span, wide):
    if wide is not None:
        monkeypatch.setattr(suffix, "WIDE", wide)
    rows = corpus(span)
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n int, key string")
    got = remove_repeats(df, span, with_text=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, span)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_runs(spark):
    """Megabytes of one byte, and of a short period, are equal pieces: whole but for what no other window covers."""
    rows = [(1, "a" * 10_000_000), (2, "xyz,w" * 400_000), (3, "b" * 201 + "c"), (4, "no repeat here" * 3)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (10_000_000, 10_000_000, 1), 2: (2_000_000, 2_000_000, 1), 3: (202, 201, 1), 4: (42, 0, 0)}


def test_a_key_of_many_segments(spark, monkeypatch):
    """One passage in the middle of thousands of texts, some of which share more of what is around it: a key that is split."""
    rng = random.Random(4)
    gram = "".join(rng.choice("abcdefgh") for _ in range(100))
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    lefts, rights = [text(90) for _ in range(40)], [text(90) for _ in range(40)]
    rows = [(k, text(60) + (rng.choice(lefts) if k % 3 else text(90)) + gram + (rng.choice(rights) if k % 4 else text(90)) + text(60)) for k in range(3000)]
    monkeypatch.setattr(suffix, "WIDE", 1 << 12)
    split = []
    keep = suffix._split
    monkeypatch.setattr(suffix, "_split", lambda span: split.append(span) or keep(span))
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(split) > 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, 200)


def test_a_task_sorts_within_bounds():
    """A segment's bytes cost under a hundred of memory, so SORTED and WIDE together stay under 500 MB."""
    import tracemalloc

    rng = random.Random(1)
    segments = [bytes(rng.choices(b"abcd", k=336)) for _ in range(1500)]
    tracemalloc.start()
    suffix.repeated_windows(segments, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / sum(map(len, segments)) * (suffix.SORTED + suffix.WIDE) < 500 << 20
