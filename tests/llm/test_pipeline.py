"""The corpus pipeline: each stage on its own input against a plain version, and run() as their chain."""

import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

SPACE, WORD = "[\x20\x09-\x0d]+", "[^\x20\x09-\x0d]+"
KINDS = "doc_id long, text string, lang string, source string, n_chars long, size int, kept boolean, norm string"


def corpus():
    rng = random.Random(9)
    clean = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(60):
        words = [rng.choice(clean) for _ in range(rng.randint(1, 90))]
        texts.append((" ".join(words), 0))
        for _ in range(rng.randint(0, 3)):
            near = list(words)
            near[rng.randrange(len(near))] = rng.choice([near[0], "other"])
            texts.append((rng.choice([" ", "\n", "  "]).join(near), 0))
    texts += [(" ".join(rng.choice([*clean[:20], "vile", "Foul!", "nasty"]) for _ in range(40)), 1) for _ in range(50)]
    texts += [("same text " * 400, 0), ("same  text " * 400, 0), ("", 0), (None, 0), (" \n", 0), ("long " * 30_000, 0)]
    rng.shuffle(texts)
    rows = [(i, t, y) for i, (t, y) in enumerate(texts)]
    return rows + [(None, "no id here at all", 0), (3, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("pipeline")
    rng = random.Random(1)
    docs = [(i, t, "en", rng.choice(["a", "a", "b", "c", None]), len(t or ""), 7, False, "z") for i, t, _ in corpus()]
    spark.createDataFrame(docs, KINDS).repartition(5).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, y, y) for i, _, y in corpus() if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def words(t):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def no_copies(rows):
    best = {}
    for r in rows:
        key = re.sub(SPACE, " ", r.text or "")
        if key not in best or (r.doc_id is None, r.doc_id or 0) < best[key]:
            best[key] = (r.doc_id is None, r.doc_id or 0)
    return Counter((None if k[0] else k[1], t) for t, k in best.items())


def no_near(rows):
    sets = []
    for r in rows:
        w = words(r.text)
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    up = {r.doc_id: r.doc_id for r in rows if r.doc_id is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and None not in (rows[a].doc_id, rows[b].doc_id) and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(rows[a].doc_id), find(rows[b].doc_id)))
                up[high] = low
    return Counter((r.doc_id, r.text) for r in rows if r.doc_id is None or find(r.doc_id) == r.doc_id)


def wanted_words(rows):
    size = Counter()
    for r in rows:
        size[r.source] += len(re.findall(WORD, r.text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full: set = set()
    while True:
        rest = [s for s in order if s not in full]
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        over = {s for s in rest if level * weight[s] > 2 * size[s]}
        if not over:
            return {s: 2 * size[s] if s in full else level * weight[s] for s in order}
        full |= over


def fewest(lengths, capacity):
    """Sequences that best fit, longest first, takes."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        at = min((k for k, g in enumerate(gaps) if g >= x), key=lambda k: gaps[k], default=None)
        if at is None:
            gaps.append(capacity - x)
        else:
            gaps[at] -= x
    return len(gaps)


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "source_mix", "packing"]
    before, seen = docs.collect(), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, out.collect())
        if name != "packing":
            assert out.columns == docs.columns
            assert set(seen[name][1]) <= set(before)
        docs, before = out, seen[name][1]

    toxic = {i for i, _, y in corpus() if y}
    rows, left = seen["toxicity"]
    assert Counter(r.doc_id for r in left) == Counter(r.doc_id for r in rows if r.doc_id not in toxic)

    rows, left = seen["exact_dedup"]
    assert Counter((r.doc_id, re.sub(SPACE, " ", r.text or "")) for r in left) == no_copies(rows)
    rows, left = seen["near_dedup"]
    assert Counter((r.doc_id, r.text) for r in left) == no_near(rows)

    rows, left = seen["source_mix"]
    taken = Counter()
    for r in left:
        taken[r.source] += len(words(r.text))
    for source, want in wanted_words(rows).items():
        own = [len(words(r.text)) for r in rows if r.source == source]
        base = int(want) // sum(own)
        goal, reach = int(want) - base * sum(own), 1  # bits: the words that some documents' further copies come to
        for n in own if base < 2 else []:
            reach |= reach << n
        best = base * sum(own) + (reach & ((1 << goal + 1) - 1)).bit_length() - 1
        assert best - 1 <= taken[source] <= want, (source, taken[source], best, want)
    assert max(Counter((r.doc_id, r.text) for r in left).values()) <= 2

    rows, packed = seen["packing"]
    t, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for r in rows:
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += Counter((r.doc_id, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    filled = defaultdict(list)
    for r in packed:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= 1024
    assert len(filled) == fewest([r.length for r in packed], 1024)

    whole = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, whole)) == Counter(map(key, packed)) and len({r.sequence_id for r in whole}) == len(filled)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], KINDS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
