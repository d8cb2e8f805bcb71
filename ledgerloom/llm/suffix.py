"""Removal of repeated byte strings: content-keyed segments, two-stage suffix sorting, adjacent common prefixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, durable, join_hot, mapped, mix64, slices

#: Bytes of segments that are sorted at once, and of one key's distinct segments; a key with more is split.
SORTED, WIDE = 2 << 20, 1 << 19
#: Windows of a segment at most; equal pieces of a text that goes on repeating itself are one segment.
CHUNK = 4096

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _words(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as little-endian numbers; b has seven more bytes than the result."""
    return np.ndarray((len(b) - 7,), dtype="<u8", buffer=b, strides=(1,))


def gram(span: int) -> int:
    """Bytes of the grams of which a window's smallest hash is its key: the power of two next below a third of the span.

    Long grams seldom repeat but in repeated windows; short ones leave more windows to a gram.
    """
    return 1 << (span // 3).bit_length() - 1


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i : i + width], for each i that has them all."""
    size = 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def window_keys(texts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, their starts and end, hash of each gram, key of each window, whether a window lies in one text).

    A window's key is the smallest hash of its grams, so equal windows have equal keys wherever they are.
    """
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    b = np.frombuffer(b"".join([*texts, bytes(2 * span)]), dtype=np.uint8)
    h, size, whole = _words(b) * _A, 8, gram(span)
    while size < whole:
        h = (h[:-size] ^ (h[:-size] >> np.uint64(29))) * _B + h[size:] * _A
        size *= 2
    h = mix64(h)
    key = _sliding(h, span - whole + 1, np.minimum)[: at[-1]]
    ok = np.zeros(int(at[-1]), dtype=bool)
    for a, z in zip(at[:-1], at[1:]):
        ok[a : max(a, z - span + 1)] = True
    return b, at, h, key, ok


def _runs(key: np.ndarray, ok: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, text) of each run of consecutive windows of one text that have one key, CHUNK windows at most."""
    places = np.flatnonzero(ok)
    if not len(places):
        return places, places, places
    new = np.ones(len(places), dtype=bool)
    new[1:] = (np.diff(places) != 1) | (key[places[1:]] != key[places[:-1]])
    new[1:] |= np.isin(places[1:], at)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(places)))
    pieces = -(-size // CHUNK)
    run = np.repeat(np.arange(len(begin)), pieces)
    step = (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * CHUNK
    first = places[begin[run]] + step
    last = places[begin[run]] + np.minimum(step + CHUNK, size[run])
    return first, last, np.searchsorted(at, first, side="right") - 1


def _anchors(span: int):
    """(key, row, n): how many grams of a row are the smallest of a window."""

    def run(it):
        for batch in slices(it, 2 << 20):
            rows, texts = batch.column("r1").to_numpy(), [(t or "").encode() for t in batch.column("text").to_pylist()]
            _, at, h, key, ok = window_keys(texts, span)
            width = span - gram(span) + 1
            top = _sliding(np.concatenate([np.zeros(width - 1, dtype=np.uint64), np.where(ok, key, np.uint64(0))]), width, np.maximum)
            p = np.flatnonzero(h[: len(top)] == top)
            hs, doc = h[p], np.searchsorted(at, p, side="right") - 1
            order = np.lexsort((hs, doc))
            hs, doc = hs[order], doc[order]
            new = np.ones(len(hs), dtype=bool)
            new[1:] = (np.diff(doc) != 0) | (hs[1:] != hs[:-1])
            begin = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([pa.array(hs[begin].view(np.int64)), pa.array(rows[doc[begin]]), pa.array(np.diff(np.append(begin, len(hs))))], ["key", "r1", "n"])

    return run


def _segments(span: int, content: bool):
    """Each run of windows under one of the row's repeated keys: its bytes' hash and, with content, once in each task, the bytes."""

    def run(it):
        seen: set[bytes] = set()
        for batch in slices(it, 2 << 20):
            r1, r2 = batch.column("r1").to_numpy(), batch.column("r2").to_numpy()
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            b, at, _, key, ok = window_keys(texts, span)
            first, end, doc = _runs(key, ok, at)
            keys = key[first].view(np.int64)
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            hit = np.zeros(len(first), dtype=bool)
            for i, want in enumerate(batch.column("keys")):
                a, z = bounds[i], bounds[i + 1]
                hit[a:z] = np.isin(keys[a:z], np.asarray(want.values))
            first, end, doc, keys = first[hit], end[hit], doc[hit], keys[hit]
            raw = b.tobytes()
            own = [raw[x : y + span - 1] for x, y in zip(first, end)]
            marks = [hashlib.blake2b(x, digest_size=16).digest() for x in own]
            if content:
                for i, m in enumerate(marks):
                    if m in seen:
                        own[i] = None
                    seen.add(m)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(marks, pa.binary()), pa.array(own, pa.binary()), pa.array([1] * len(own), pa.int64())], ["key", "mark", "content", "n"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(marks, pa.binary()), pa.array(r1[doc]), pa.array(r2[doc]), pa.array((first - at[doc]).astype(np.int64))], ["key", "mark", "r1", "r2", "at"])

    return run


def _packed(t: np.ndarray, depth: int) -> np.ndarray:
    """At each place, and for depth places beyond the end, the seven values from there on as one number; 0 follows the end."""
    wide = np.concatenate([t, np.zeros(depth + 7, dtype=t.dtype)]).astype(np.int64)
    word = np.zeros(len(t) + depth, dtype=np.int64)
    for k in range(7):
        word = word << 9 | wide[k : k + len(word)]
    return word


def _tied(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, number of the group) of the values of sorted x that occur more than once."""
    first = np.ones(len(x), dtype=bool)
    first[1:] = x[1:] != x[:-1]
    tied = ~(first & np.append(first[1:], True))
    return np.flatnonzero(tied), np.cumsum(first)[tied]


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of t (uint16, the last value smallest) sorted by their first `depth` values at least.

    Two stages: suffixes that are smaller than their successors are sorted directly, by seven values at a time and only
    among those still equal; all others are induced. In a bucket of one first value, larger-than-successor suffixes come
    first. Buckets are scanned in order, and each suffix scanned puts the one before it, if that is of the second kind,
    next in its bucket; a bucket's own additions are scanned in waves. Values are 0 to 511.
    """
    n = len(t)
    differs = np.flatnonzero(t[:-1] != t[1:])
    nxt = np.searchsorted(differs, np.arange(n - 1))
    small = np.ones(n, dtype=bool)  # smaller than its successor; the last one counts as such
    inner = nxt < len(differs)
    d = differs[nxt[inner]]
    small[:-1][inner] = t[d] < t[d + 1]
    small[:-1][~inner] = True
    word = _packed(t, depth)
    direct = np.flatnonzero(small)
    order = direct[np.argsort(word[direct])]
    slots, group = _tied(word[order])  # places in the order that aren't settled, and which of them are still equal
    for at in range(7, depth, 7):
        if not len(slots):
            break
        sub = order[slots]
        w = word[sub + at]
        o = np.argsort(w)
        rank = np.empty(len(w), dtype=np.int64)
        rank[o] = np.cumsum(np.diff(w[o], prepend=w[o[:1]]) != 0)
        both = group << 32 | rank
        o = np.argsort(both)
        order[slots] = sub[o]
        rest, group = _tied(both[o])
        slots = slots[rest]
    values = t[order]
    starts = np.searchsorted(values, np.arange(int(t.max()) + 2))
    induced: list[list[np.ndarray]] = [[] for _ in range(int(t.max()) + 1)]
    out: list[np.ndarray] = []

    def put(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        if len(before):
            c = t[before]
            o = np.argsort(c, kind="stable")
            before, c = before[o], c[o]
            cut = np.flatnonzero(np.diff(c)) + 1
            for part in np.split(before, cut):
                induced[t[part[0]]].append(part)

    for c in range(len(induced)):
        k = 0
        while k < len(induced[c]):
            wave = np.concatenate(induced[c][k:])
            k = len(induced[c])
            out.append(wave)
            put(wave)
        own = order[starts[c] : starts[c + 1]]
        if len(own):
            out.append(own)
            put(own)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def repeated_windows(segments: list[bytes], span: int) -> list[np.ndarray]:
    """For each segment, which of its windows (by start) also start elsewhere among the segments, itself included."""
    size = np.array([len(s) for s in segments])
    at = np.concatenate([[0], np.cumsum(size + 1)])
    t = np.zeros(int(at[-1]), dtype=np.uint16)
    for a, s in zip(at, segments):
        t[a : a + len(s)] = np.frombuffer(s, dtype=np.uint8)
        t[a : a + len(s)] += 1
    whole = np.zeros(len(t), dtype=bool)
    for a, n in zip(at, size):
        whole[a : a + max(0, n - span + 1)] = True
    sa = suffix_array(t, span)
    sa = sa[whole[sa]]  # a window's prefix lies in its segment, so equal windows stay neighbours
    word = _packed(t, 0)
    pair = np.arange(max(0, len(sa) - 1))
    for k in [*range(0, span - 7, 7), span - 7]:  # common prefix of neighbours, as far as span
        pair = pair[word[sa[pair] + k] == word[sa[pair + 1] + k]]
    hit = np.zeros(len(t), dtype=bool)
    hit[sa[pair]] = hit[sa[pair + 1]] = True
    return [hit[a : a + max(0, n - span + 1)] for a, n in zip(at, size)]


def _ranges(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


_VERDICT = "mark binary, starts array<int>, ends array<int>"


def _sorted(span: int):
    def run(it):
        def flush(rows):
            out = []
            sort = {k for k, m in counts.items() if m > 1}
            todo = [r for r in rows if r[0] in sort or r[3] == 1]  # one segment that occurs more often needs no sorting
            hits = repeated_windows([r[2] for r in todo], span) if todo else []
            found = {id(r): h for r, h in zip(todo, hits)}
            for r in rows:
                if r[3] > 1:
                    out.append((r[1], [0], [len(r[2]) - span + 1]))
                elif id(r) in found:
                    a, z = _ranges(found[id(r)])
                    if a:
                        out.append((r[1], a, z))
            return pa.RecordBatch.from_pydict({"mark": pa.array([x[0] for x in out], pa.binary()), "starts": pa.array([x[1] for x in out], pa.list_(pa.int32())), "ends": pa.array([x[2] for x in out], pa.list_(pa.int32()))})

        rows: list[tuple] = []
        counts: dict[int, int] = {}
        held = 0
        for batch in slices(it, column="content"):
            for key, mark, content, n in zip(*(batch.column(c).to_pylist() for c in ("key", "mark", "content", "n"))):
                if held >= SORTED and key not in counts:
                    yield flush(rows)
                    rows, counts, held = [], {}, 0
                rows.append((key, mark, content, n))
                counts[key] = counts.get(key, 0) + 1
                held += len(content)
        if rows:
            yield flush(rows)

    return run


def _split(span: int):
    """Each segment (key, content, n, at, size) as segments of keys that say more of its windows.

    All windows of a segment hold its bytes at : at + size. A window that starts half of what is left or more before `at`
    holds as many bytes before it too; one that doesn't holds the other half behind. So the windows fall into two
    segments, with the longer common part for a key. Equal windows hold that part at one place, so they fall alike. At first
    (size null) the common part is the leftmost gram with the window's smallest hash, so a segment falls apart by these.
    """
    whole = gram(span)

    def parts(key: int, content: bytes, at: int | None, size: int | None):
        """(first window, end, common part, its size) of each run of windows with one common part."""
        windows = len(content) - span + 1
        if size is not None:
            yield 0, windows, at, size
            return
        h = window_keys([content], span)[2][: len(content) - whole + 1]
        begin = 0
        for p in np.flatnonzero(h.view(np.int64) == key).tolist():
            end = min(p + 1, windows)
            if begin < end:
                yield begin, end, p, whole
            begin = max(begin, end)

    def run(it):
        for batch in slices(it, 1 << 20, column="content"):
            out: list[tuple] = []
            for row in batch.to_pylist():
                content = row["content"]
                for begin, end, at, size in parts(row["key"], content, row["at"], row["size"]):
                    half = (span - size + 1) // 2
                    cut = max(begin, min(end, at - half + 1))
                    for side, a, z, p, q in ((b"before", begin, cut, at - half, at + size), (b"behind", cut, end, at, at + span - half + 1)):
                        if a < z:
                            own = content[a : z - 1 + span]
                            name = hashlib.blake2b(content[p:q], digest_size=8, salt=row["key"].to_bytes(8, "little", signed=True), person=side).digest()
                            out.append((int.from_bytes(name, "little", signed=True), hashlib.blake2b(own, digest_size=16).digest(), own, row["n"], p - a, q - p, row["mark"], a))
            yield pa.RecordBatch.from_pydict({f.name: pa.array([x[k] for x in out], f.type) for k, f in enumerate(_PARTS)}, schema=_PARTS)

    return run


_PARTS = pa.schema([("key", pa.int64()), ("mark", pa.binary()), ("content", pa.binary()), ("n", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("parent", pa.binary()), ("shift", pa.int32())])
_PARTS_DDL = "key long, mark binary, content binary, n long, at int, size int, parent binary, shift int"


def _cut(span: int):
    def run(it):
        for batch in slices(it):
            out: dict[str, list] = {k: [] for k in ("r1", "r2", "n_removed", "n_spans", "kept_sha256", "kept")}
            for r1, r2, text, spans in zip(*(batch.column(c).to_pylist() for c in ("r1", "r2", "text", "spans"))):
                b = np.frombuffer((text or "").encode(), dtype=np.uint8)
                depth = np.zeros(len(b) + 1, dtype=np.int64)
                for s in spans:
                    depth[s["a"]] += 1
                    depth[s["z"] + span - 1] -= 1
                gone = np.cumsum(depth)[:-1] > 0
                left = b[~gone].tobytes()
                out["r1"].append(r1)
                out["r2"].append(r2)
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(len(_ranges(gone)[0]))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["kept"].append(left)
            yield pa.RecordBatch.from_pydict({"r1": pa.array(out["r1"], pa.int64()), "r2": pa.array(out["r2"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()), "n_spans": pa.array(out["n_spans"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"]), "kept": pa.array(out["kept"], pa.binary())})

    return run


def remove_repeats(docs: DataFrame, span: int = 200, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row for each row of docs: id, n_bytes, n_removed, n_spans, kept_sha256; kept (bytes) too with with_text.

    Every byte covered by a string of `span` bytes that also starts elsewhere in any text, the same one included, goes.

    A string's key is the smallest hash of its grams; consecutive strings with one key make a segment. Keys that occur
    once are left at once: only a hash for every ninety bytes or so is shuffled. Texts with repeated keys are fetched;
    equal segments meet by their digest, one standing for all, with its count; distinct segments of a key are suffix
    sorted together, and neighbours that agree for `span` bytes are repeats. A key with over WIDE bytes of distinct
    segments is split: each of its segments falls into two by where the gram stands in its strings, under keys that say
    half of what was left more of them, and equal ones meet again; so after at most log2(span) rounds no key has
    more, no group has to fit a task, and all are sorted. Verdicts on the parts are carried back.

    Null text is empty. Strings shorter than span are never removed. Rows that repeat id and text are separate texts,
    repeating each other. Null ids are ids. No rows in, no rows out; other columns are ignored. span: 24 at least.
    """
    if span < 24:
        raise ValueError("span must be 24 at least")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("r1"), F.xxhash64(F.lit(7), text, F.col(id_col)).alias("r2"))
    long = base.where(F.octet_length("text") >= span)
    anchors = durable(long.select("r1", "text").transform(mapped, _anchors(span), "key long, r1 long, n long"), "repeats-anchors")
    keys = anchors.groupBy("key").agg(F.sum("n").alias("all")).where("all > 1").select("key")
    lists = anchors.join(keys, "key").groupBy("r1").agg(F.collect_set("key").alias("keys"))
    chosen = durable(long.select("r1", "r2", "text").join(lists, "r1"), "repeats-texts")
    discard(anchors)
    cut = chosen.transform(mapped, _segments(span, True), "key long, mark binary, content binary, n long")
    distinct = cut.groupBy("key", "mark").agg(F.sum("n").alias("n"), F.max("content").alias("content"))
    distinct = distinct.where(F.octet_length("content") >= span).withColumns({"at": F.lit(None).cast("int"), "size": F.lit(None).cast("int")})
    distinct = durable(distinct, "repeats-segments")
    verdicts, links, spent = [], [], []
    while True:
        spent.append(distinct)
        wide = distinct.groupBy("key").agg(F.sum(F.octet_length("content")).alias("bytes"), F.count("*").alias("segments")).where((F.col("bytes") > WIDE) & (F.col("segments") > 1)).select("key")
        wide = durable(wide, "repeats-wide")
        last = wide.isEmpty()
        plain = distinct if last else distinct.join(wide, "key", "left_anti")
        verdicts.append(plain.repartition("key").sortWithinPartitions("key").select("key", "mark", "content", "n").transform(mapped, _sorted(span), _VERDICT))
        if last:
            break
        parts = durable(distinct.join(wide, "key", "left_semi").select("key", "mark", "content", "n", "at", "size").transform(mapped, _split(span), _PARTS_DDL), "repeats-parts")
        links.append(parts.select("mark", "parent", "shift"))
        spent += [wide, parts]
        distinct = durable(parts.groupBy("key", "mark").agg(F.sum("n").alias("n"), F.max("content").alias("content"), F.max("at").alias("at"), F.max("size").alias("size")), "repeats-split")
    verdict = durable(verdicts.pop(), "repeats-verdicts")
    moved = lambda c: F.transform(c, lambda x: x + F.col("shift")).alias(c)
    while links:
        up = links.pop()
        shared = up.groupBy("mark").agg(F.count("*").alias("n"))
        told = verdict.groupBy("mark").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")).join(shared, "mark")
        above = join_hot(up, told, ["mark"], "n", up.count()).select(F.col("parent").alias("mark"), moved("starts"), moved("ends"))
        verdict = durable(verdicts.pop().unionByName(above), "repeats-verdicts")
    discard(*spent)
    places = chosen.transform(mapped, _segments(span, False), "key long, mark binary, r1 long, r2 long, at long")
    spans = places.join(verdict, "mark").select("r1", "r2", "at", F.explode(F.arrays_zip("starts", "ends")).alias("x"))
    spans = spans.groupBy("r1", "r2").agg(F.collect_set(F.struct((F.col("at") + F.col("x.starts")).alias("a"), (F.col("at") + F.col("x.ends")).alias("z"))).alias("spans"))
    done = chosen.select("r1", "r2", "text").dropDuplicates(["r1", "r2"]).join(spans, ["r1", "r2"])
    done = done.transform(mapped, _cut(span), "r1 long, r2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    if not with_text:
        done = done.drop("kept")
    plain_rows = base.select("id", "r1", "r2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"), *([F.encode("text", "utf-8").alias("whole")] if with_text else []))
    out = plain_rows.join(done, ["r1", "r2"], "left").select(F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *([F.coalesce("kept", "whole").alias("kept")] if with_text else []))
    return out
