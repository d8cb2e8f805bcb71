"""Token counts and packing against the library itself."""

import bisect
import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from ledgerloom.llm import packing
from ledgerloom.llm.packing import pack, supersteps, sweep, wanted
from ledgerloom.llm.tokens import count, count_tokens, counter, encoded, splice, units
from tokenizers import Tokenizer

WORD, BYTE, RANKS = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
ODD = [
    "", " ", "   ", "\n\n", "a  b", "a   b\n \n c", "don't I'LL we've 12345 x1y2", "Ünïcödé ÀÉÎ Σίσυφος ΟΔΟΣ", "<|endoftext|> a <|ENDOFTEXT|>   <|startoftext|>b", "foo  bar baz \x1c q\x85r",
    "é café ́x", "日本語 テキスト 한국어", "emoji 😀😃 👩‍👩‍👧", "a\tb\r\nc\x0bd\x0ce", "word### word*** &&&", "???!!!...,,, -- —", "'s 'S x's,y", "İstanbul K ﬁ ǅ", "trailing  ", "  leading", "﻿bom", "ªº²³½ Ⅷ",
]


def texts():
    rng = random.Random(3)
    bits = [*ODD, "the", "and ", "\n", " x,", "ing.", "%%%", "ça", "  ", "1", "'", "<", "|"]
    return ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(400)]


def test_counts_are_the_librarys():
    t, c = Tokenizer.from_file(WORD), counter(WORD)
    for x in texts():
        assert count(x, c) == len(t.encode(x, add_special_tokens=False).ids), repr(x)


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_ids_are_the_librarys(ranks):
    from ledgerloom.llm.common import held

    held("")
    t, u = Tokenizer.from_file(BYTE), units(BYTE, ranks)
    for x in texts():
        ids = t.encode(x, add_special_tokens=False).ids
        assert encoded(x, u) == struct.pack(f"<{len(ids)}I", *ids), repr(x)
    held("")


def strings(n: int):
    """Strings over letters that change with case or normal form, marks that combine, white space of all kinds and marks that units are split at."""
    rng = random.Random(17)
    letters = [*"aIKsSzé", "İ", "ı", "ß", "ẞ", "ﬁ", "ŉ", "ǅ", "Σ", "ς", "Å", "가", "ᄀ", "ᅡ", "ª", "Ⅷ", "9", "٣", "\u1c89", "ꟊ", "日", "𝐀", "😀"]
    others = ["\u0301", "\u0307", "\u0323", "\u0345", "\u200d", "\ufe0f", " ", "\t", "\n", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u200b", "\u2028", "\u3000", "\ufeff", "\x00", "\x7f", *",.;:!?#*%$&'<|>-_", "'s", "'LL"]
    for _ in range(n):
        yield "".join(rng.choice(letters if rng.random() < 0.6 else others) for _ in range(rng.randint(1, 12)))


def test_odd_characters_are_counted_as_by_the_library():
    t, c, b, u = Tokenizer.from_file(WORD), counter(WORD), Tokenizer.from_file(BYTE), units(BYTE, RANKS)
    every = [*strings(60_000), *(f"{x}İ{m}" for x in ("", "a", "İ") for m in (",", "?", "!$&", "#*%", ".;:"))]
    for x, mine, theirs in zip(every, t.encode_batch(every, add_special_tokens=False), b.encode_batch(every, add_special_tokens=False)):
        assert count(x, c) == len(mine.ids), repr(x)
        assert encoded(x, u) == struct.pack(f"<{len(theirs.ids)}I", *theirs.ids), repr(x)


def test_memo_is_bounded(monkeypatch):
    from ledgerloom.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 4000)
    c = tokens.Counter(tokens.load(WORD))
    for k in range(500):
        assert count(f"word{k}, w{k}x", c) == len(c.tok.encode(f"word{k}, w{k}x", add_special_tokens=False).ids)
        assert c.held <= 4000 and len(c) < 40


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_splicing_is_whole_encoding(path):
    t, rng = Tokenizer.from_file(path), random.Random(5)
    for x in [*texts()[-150:], "x" * 5000, "ab " * 3000, "no spaces here" .replace(" ", "") * 300, "<|endoftext|>" * 200, " " * 3000, "a <|endoftext|> b\n" * 200]:
        assert splice(t, x, rng.choice([40, 64, 200]), rng.choice([8, 16])) == t.encode(x, add_special_tokens=False).ids, repr(x[:200])


def test_count_query_rows(spark):
    rows = [(1, "Hello there"), (None, "x y"), (3, None), (3, ""), (3, "a " * 70_000), (3, "a " * 70_000)]
    got = count_tokens(spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_tokens int"), WORD, 2048).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [(0, 3, 2, False), (1, 11, 2, False), (3, 0, 0, False), (3, 0, 0, False), (3, 140_000, 70_000, True), (3, 140_000, 70_000, True)]
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), WORD).collect() == []


def best_fit(counts, capacity):
    """Sequences of best fit, longest first, piece by piece."""
    gaps, n = [], 0
    for x in sorted((x for x, k in counts.items() for _ in range(k)), reverse=True):
        at = bisect.bisect_left(gaps, x)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, n = capacity, n + 1
        if gap > x:
            bisect.insort(gaps, gap - x)
    return n


def checked(places, counts, capacity):
    """The sequences of runs (length, rank, n, sequence, offset), which must place each rank once, without gaps or overlaps."""
    filled, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, first, at in places:
        ranks[length] += range(rank, rank + n)
        for k in range(n):
            filled[first + k].append((at, length))
    assert {x: sorted(r) for x, r in ranks.items()} == {x: list(range(k)) for x, k in counts.items() if k}
    for parts in filled.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= capacity
    return len(filled)


def in_process(counts, capacity):
    """supersteps() without Spark."""
    state, opened = [(packing.PIECES, x, 0, n, 0, 0) for x, n in counts.items() if n], 0
    for least in [*(capacity // d + 1 for d in packing.BATCHES), 1]:
        ranges = packing.RANGES
        while True:
            live = [r for r in state if r[0] != packing.PLACED and r[1] >= least]
            sizes = sorted({r[1] for r in live})
            cuts = [least] if ranges == 1 else sorted({sizes[len(sizes) * k // ranges] for k in range(ranges)} if sizes else {least})
            state = [r for r in state if r[0] == packing.PLACED or r[1] < least]
            for low, high in zip(cuts, [*cuts[1:], capacity + 1]):
                state += sweep([r[:4] for r in live if low <= r[1] < high], capacity, low)
            rest = [(x, n) for kind, x, _, n, _, _ in state if kind == packing.PIECES and x >= least]
            if not rest:
                break
            if ranges == 1:
                more = wanted(sum(n for _, n in rest), sum(x * n for x, n in rest), sum(n for x, n in rest if 2 * x > capacity), sum(n for x, n in rest if 3 * x > capacity), capacity)
                state.append((packing.GAPS, capacity, opened, more, 0, 0))
                opened += more
            ranges = 1
    return [r[1:] for r in state if r[0] == packing.PLACED]


def test_supersteps_need_no_more_sequences_than_best_fit(spark):
    """As best fit, longest first, piece by piece: never two more, and in sum no more."""
    rng, more = random.Random(1), []
    for _ in range(400):
        capacity = rng.choice([7, 16, 50, 100])
        items = [rng.randint(1, rng.choice([capacity, max(1, capacity // 3)])) for _ in range(rng.randint(0, 200))]
        counts = Counter(items)
        more.append(checked(in_process(counts, capacity), counts, capacity) - best_fit(counts, capacity))
    assert max(more) <= 1 and sum(x > 0 for x in more) <= len(more) // 20, Counter(more)
    for capacity, items in ((1024, [min(1024, max(1, int(rng.lognormvariate(5.5, 1)))) for _ in range(20_000)]), (50, [26, 25, 25, 17, 17, 16, 9, 9, 8, 50, 1]), (50, [])):
        counts = Counter(items)
        got = supersteps(spark.createDataFrame(list(counts.items()), "length long, n long"), capacity).select("p_length", "p_rank", "p_n", "p_sequence", "offset").collect()
        assert checked([tuple(r) for r in got], counts, capacity) <= best_fit(counts, capacity)


def test_pack_is_a_round_trip(spark):
    t = Tokenizer.from_file(BYTE)
    rows = [(i, " ".join(f"w{i * k}" for k in range((i * 37) % 900))) for i in range(60)] + [(None, "null id"), (7, "again"), (7, "again"), (8, None), (9, ""), (5, None)]
    got = pack(spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, length int"), BYTE).collect()
    want = defaultdict(int)
    for i, x in rows:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    have, filled = defaultdict(int), defaultdict(list)
    for r in got:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        filled[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for parts in filled.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= 1024
    assert pack(spark.createDataFrame([], "doc_id long, text string"), BYTE).collect() == []
