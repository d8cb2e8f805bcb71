"""Language-model scores by partial matching: a byte trie with escapes and symbol exclusion, learned from the corpus."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _IS_SPACE, _LOWER, durable, held, joined, mapped, slices, word_hashes

#: Bytes of context at most.
ORDER = 5
#: The most frequent grams, at most so many, are scored in place; the others by a join.
LISTED = 1 << 18
#: Words that occur at least once in 2 ** WORDS tokens are counted in place; the others by a join.
WORDS = 20
END = 10
#: Bytes of text that are taken at once, and counts that a task holds before it passes them on.
SLICE, HELD = 2 << 20, 500_000


def streams(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, whether each is to be coded, each text's first place): for each text, `order` ENDs of context that aren't
    coded, its lower-cased words with one space between, and END."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(x) + order + 1 for x in raw], dtype=np.int64)
    at = np.concatenate([[0], size.cumsum()])
    b = np.frombuffer(b"".join(x for t in raw for x in (bytes(order), t, b"\0")), dtype=np.uint8)
    space = _IS_SPACE[b]
    b = _LOWER[b]
    first, last = at[:-1], at[1:] - 1
    edge = np.flatnonzero(np.diff(space, prepend=False, append=False))
    run, end = edge[::2], edge[1::2]  # texts end with a byte that is no space, so each run has an end
    pad = np.zeros(len(b), dtype=bool)
    for k in range(order):
        pad[first + k] = True
    stop = np.zeros(len(b), dtype=bool)
    stop[last] = True
    keep = ~space
    inner = run[~pad[run - 1] & ~stop[end]] if len(run) else run
    keep[inner] = True
    b = b.copy()
    b[inner] = 32
    b[pad | stop] = END
    moved = np.cumsum(keep) - 1
    return b[keep], ~pad[keep], moved[first]


def grams(symbols: np.ndarray, order: int) -> np.ndarray:
    """At each place the symbol and the `order` before it, as one number; the symbol lowest."""
    g = symbols.astype(np.uint64)
    out = g.copy()
    for k in range(1, order + 1):
        out[k:] |= g[:-k] << np.uint64(8 * k)
    return out


class Table:
    """From 64-bit numbers to their places in the sorted keys, by open addressing; -1 for those that aren't there."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys = np.append(keys, np.uint64(0))
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            rest = self.slots[slot] != left
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        slot = self._slot(x)
        out = self.slots[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != x))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            got = self.slots[slot[open_]]
            out[open_] = got
            open_ = open_[(got >= 0) & (self.keys[got] != x[open_])]
        return out


@dataclass
class Trie:
    """children[k]: sorted grams of k + 1 symbols with counts; nodes[k]: sorted contexts of k symbols with their total,
    distinct kept children and the children's sum."""

    order: int
    children: list[tuple[np.ndarray, np.ndarray]]
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def ready(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """log10 of the probability of a symbol after its context.

    From the longest kept context on: a kept child with count c has (c - 1/2) / n; the rest is escape, to the context
    one shorter, with the children seen so far excluded. Children of a context are children of its shorter contexts too,
    since their counts there are no less, so what is excluded below a context is what it has, and every factor is a
    property of one context.
    """

    def __init__(self, trie: Trie):
        self.order = trie.order
        self.child = [Table(k) for k, _ in trie.children]
        self.count = [c.astype(np.float64) for _, c in trie.children]
        self.node = [Table(k) for k, *_ in trie.nodes]
        self.total = [n.astype(np.float64) for _, n, _, _ in trie.nodes]
        self.distinct = [d.astype(np.float64) for _, _, d, _ in trie.nodes]
        self.pruned = [(n - s).astype(np.float64) for _, n, _, s in trie.nodes]
        self.root = float(self.distinct[0][0]) if len(self.total[0]) else 0.0
        self.escape, self.below, self.down, self.direct = [], [], [], []
        with np.errstate(divide="ignore"):
            for k in range(self.order + 1):
                keys, n = trie.nodes[k][0], self.total[k]
                self.escape.append(np.log10((0.5 * self.distinct[k] + self.pruned[k]) / n))
                at = self.node[k].find(trie.children[k][0] >> np.uint64(8)) if len(keys) else np.zeros(0, dtype=np.int32)
                self.direct.append(np.log10((self.count[k] - 0.5) / n[at]))
                if not k or not len(keys):
                    self.below.append(np.zeros(len(keys)))
                    self.down.append(np.zeros(len(keys)))
                    continue
                shorter = np.uint64((1 << (8 * (k - 1))) - 1)
                up = self.node[k - 1].find(keys & shorter)
                same = self.child[k - 1].find(trie.children[k][0] & np.uint64((1 << (8 * k)) - 1))
                taken = np.bincount(at, weights=self.count[k - 1][same], minlength=len(keys))
                below = self.total[k - 1][up] - taken
                self.below.append(below)
                left = 0.5 * (self.distinct[k - 1][up] - self.distinct[k]) + self.pruned[k - 1][up]
                self.down.append(np.where(below > 0, np.log10(np.where(below > 0, left / np.maximum(below, 1e-300), 1)), 0.0))

    def look(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.score(g), np.ones(len(g), dtype=bool)

    def score(self, g: np.ndarray) -> np.ndarray:
        """For grams of order + 1 symbols."""
        at = self.child[self.order].find(g)
        hit = at >= 0
        out = np.empty(len(g))
        out[hit] = self.direct[self.order][at[hit]]
        if not hit.all():
            some, where = np.unique(g[~hit], return_inverse=True)
            out[~hit] = self._rest(some)[where]
        return out

    def _rest(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros(len(g))
        live = np.ones(len(g), dtype=bool)
        came = np.full(len(g), -1, dtype=np.int64)  # the context one longer, where it was kept
        for k in range(self.order, -1, -1):
            i = np.flatnonzero(live)
            x = g[i] & np.uint64((1 << (8 * (k + 1))) - 1)
            node, child, frm = self.node[k].find(x >> np.uint64(8)), self.child[k].find(x), came[i]
            have = node >= 0
            hit = have & (child >= 0)
            first, later = hit & (frm < 0), hit & (frm >= 0)
            out[i[first]] += self.direct[k][child[first]]
            if later.any():
                out[i[later]] += np.log10((self.count[k][child[later]] - 0.5) / self.below[k + 1][frm[later]])
            miss = have & ~hit
            first, later = miss & (frm < 0), miss & (frm >= 0)
            out[i[first]] += self.escape[k][node[first]]
            if later.any():
                out[i[later]] += self.down[k + 1][frm[later]]
            came[i] = node
            live[i[hit]] = False
        i = np.flatnonzero(live)
        out[i] -= np.log10(256 - self.root)
        return out


@dataclass
class Listed:
    """Some grams of order + 1 symbols with their scores; the others are left open."""

    keys: np.ndarray
    scores: np.ndarray

    def ready(self) -> "Listed":
        self.table = Table(self.keys)
        return self

    def look(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.table.find(g)
        hit = at >= 0
        out = np.zeros(len(g))
        out[hit] = self.scores[at[hit]]
        return out, hit


#: Under what name workers hold the frequent grams and words between tasks.
KEEPS = "ppm"


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts])
    o = np.argsort(k, kind="stable")
    k, n = k[o], n[o]
    new = np.flatnonzero(np.diff(k, prepend=k[:1] ^ np.uint64(1)) != 0) if len(k) else np.zeros(0, dtype=np.int64)
    return k[new], np.add.reduceat(n, new) if len(new) else n[:0]


def _counts(order: int | None):
    """Counts of grams (kind 0) and words (kind 1) of training texts, merged in each task as far as memory is bounded. Without
    an order, of words only."""

    def run(it):
        parts: list[list] = [[], []]

        def out(kind: int):
            k, n = _merge(parts[kind])
            parts[kind] = []
            step = 1 << 18
            for a in range(0, len(k), step):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k[a : a + step]), kind, dtype=np.int32)), pa.array(k[a : a + step].view(np.int64)), pa.array(n[a : a + step].astype(np.int64))], ["kind", "key", "n"])

        for batch in slices(it, SLICE):
            texts = batch.column("text").to_pylist()
            if order is not None:
                symbols, coded, _ = streams(texts, order)
                parts[0].append(np.unique(grams(symbols, order)[coded], return_counts=True))
            parts[1].append(np.unique(word_hashes(*joined(texts))[0], return_counts=True))
            for kind in (0, 1):
                if sum(len(k) for k, _ in parts[kind]) > 2 * HELD:
                    parts[kind] = [_merge(parts[kind])]
                    if len(parts[kind][0][0]) > HELD:
                        yield from out(kind)
        for kind in (0, 1):
            if parts[kind]:
                yield from out(kind)

    return run


def _by_owner(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, owner, how often) for each distinct pair of them."""
    o = np.lexsort((keys, owner))
    keys, owner = keys[o], owner[o]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (keys[1:] != keys[:-1])])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[new], owner[new], np.diff(np.append(new, len(keys)))


def _scores(order: int, trie, words, name: str, constants: tuple[float, ...]):
    """One row for each text (kind 0), and rows for its words (kind 1) and grams (kind 2) that aren't among the frequent ones.
    Without a trie, no grams are looked at and scores are 0."""
    end_score, end_known, denominator = constants

    def run(it):
        from pyspark import TaskContext

        cached = held(KEEPS)
        if name not in cached:
            cached.clear()
            cached[name] = (trie and trie.value.ready(), Table(words.value[0]), words.value[1])
        scorer, frequent, counts = cached[name]
        row = TaskContext.get().partitionId() << 36
        for batch in slices(it, SLICE // 4):  # of which each byte may give a row
            texts = batch.column("text").to_pylist()
            m = len(texts)
            if trie is None:
                score, g, of, listed = np.zeros(m), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
            else:
                symbols, coded, first = streams(texts, order)
                lp = np.zeros(len(symbols))
                g = grams(symbols, order)[coded]
                lp[coded], listed = scorer.look(g)
                score = np.add.reduceat(lp, first)
                of = np.repeat(np.arange(m), np.diff(np.append(first, len(symbols))))[coded]
            h, doc, _, _ = word_hashes(*joined(texts))
            n_words = np.bincount(doc, minlength=m)
            at = frequent.find(h)
            hit = at >= 0
            base = np.bincount(doc[hit], weights=np.log10((counts[at[hit]] + 0.5) / denominator), minlength=m) + end_score
            known = np.bincount(doc[hit], minlength=m) + end_known
            rare, owner, n = _by_owner(h[~hit], doc[~hit])
            open_, open_owner, open_n = _by_owner(g[~listed], of[~listed])
            k = len(rare) + len(open_)
            rows = row + np.arange(m)
            nul = lambda kind: pa.nulls(k, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(3, dtype=np.int32), [m, len(rare), len(open_)])),
                    pa.array(np.concatenate([rows, rows[owner], rows[open_owner]])),
                    pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(np.concatenate([rare, open_]).view(np.int64))]),
                    pa.array(np.concatenate([n_words + 1, n, open_n]).astype(np.int64)),
                    pa.concat_arrays([batch.column("id"), pa.nulls(k, batch.column("id").type)]),
                    pa.concat_arrays([batch.column("held_out"), nul(pa.bool_())]),
                    pa.array(np.concatenate([known, np.zeros(k)]).astype(np.int64)),
                    pa.array(np.concatenate([base, np.zeros(k)])),
                    pa.concat_arrays([pa.array(score), nul(pa.float64())]),
                ],
                ["kind", "row", "key", "n", "id", "held_out", "known", "base", "score"],
            )
            row += m

    return run


def train(counts: DataFrame, order: int, nodes: int) -> Trie:
    """The trie of gram counts: contexts and children that occur at least once in 2 ** nodes symbols, which bounds both."""
    grams_ = counts.where("kind = 0").select("key", "n")
    total = grams_.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // (1 << nodes)))
    children: list = [None] * (order + 1)
    contexts: list = [None] * (order + 1)
    for k in range(order, -1, -1):
        grams_ = grams_ if k == order else grams_.select(F.col("key").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1)).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n"))
        if k < order:
            grams_ = durable(grams_, "ppm-grams")
        kept = grams_.where(F.col("n") >= least).toPandas()
        o = np.argsort(kept["key"].to_numpy(np.int64).view(np.uint64), kind="stable")
        children[k] = (kept["key"].to_numpy(np.int64).view(np.uint64)[o], kept["n"].to_numpy(np.int64)[o])
        big = F.col("n") >= least
        node = grams_.groupBy(F.shiftright("key", 8).alias("key")).agg(F.sum("n").alias("n"), F.count_if(big).alias("d"), F.sum(F.when(big, F.col("n")).otherwise(0)).alias("s")).where("d > 0").toPandas()
        o = np.argsort(node["key"].to_numpy(np.int64).view(np.uint64), kind="stable")
        contexts[k] = tuple(node[c].to_numpy(np.int64)[o] if c != "key" else node[c].to_numpy(np.int64).view(np.uint64)[o] for c in ("key", "n", "d", "s"))
    return Trie(order, children, contexts)


def _cut(c, size: int):
    """The last `size` symbols of a gram."""
    return c.bitwiseAND(F.lit((1 << (8 * size)) - 1))


def _levels(counts: DataFrame, order: int) -> list[DataFrame]:
    """For each k, all grams of k + 1 symbols (key) and how often they occur (n)."""
    out = [counts.where("kind = 0").select("key", "n")]
    for k in range(order - 1, -1, -1):
        out.append(durable(out[-1].select(_cut(F.col("key"), k + 1).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n")), "ppm-grams"))
    return out[::-1]


def _seen(grams_: DataFrame) -> DataFrame:
    """(key, n, lp): each gram that occurs, with its score after its whole context; a context has at most 256 rows."""
    total = F.sum("n").over(Window.partitionBy(F.shiftrightunsigned("key", 8)))
    return durable(grams_.select("key", "n", F.log10((F.col("n") - 0.5) / total).alias("lp")), "ppm-seen")


def _listed(seen: DataFrame) -> Listed:
    """The most frequent grams, LISTED at most: whole classes of counts, from the highest down."""
    kind = F.floor(F.log2("n") * 8)
    sizes = seen.groupBy(kind.alias("kind")).agg(F.count("*").alias("rows")).toPandas().sort_values("kind", ascending=False)
    fits = sizes["kind"][sizes["rows"].cumsum() <= LISTED]
    if not len(fits):
        return Listed(np.zeros(0, np.uint64), np.zeros(0))
    most = seen.where(kind >= int(fits.min())).select("key", "lp").toArrow()
    return Listed(most["key"].to_numpy().view(np.uint64), most["lp"].to_numpy())


def _unseen(keys: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(key, lp) for distinct grams that don't occur: escapes from context to context as Scorer has them, as joins.

    Only contexts of these grams are summed up. Contexts of two symbols or fewer are at most 65,536 and are broadcast.
    """
    none = F.lit(None).cast("long")
    walk = keys.select("key", F.lit(0.0).alias("lp"), F.lit(True).alias("live"), none.alias("came_d"), none.alias("came_taken"))
    for k in range(len(levels) - 1, -1, -1):
        walk = walk.withColumn("context", _cut(F.shiftrightunsigned("key", 8), k)).withColumn("gram", _cut(F.col("key"), k + 1))
        own = levels[k].select(F.shiftrightunsigned("key", 8).alias("context"), "key", "n").join(walk.select("context").distinct(), "context", "left_semi")
        own = own.withColumn("key", _cut(F.col("key"), k)).join(levels[k - 1].select("key", F.col("n").alias("m")), "key") if k else own.withColumn("m", F.lit(0))
        node = own.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("d"), F.sum("m").alias("taken"))
        child = levels[k].select(F.col("key").alias("gram"), F.col("n").alias("c"))
        walk = walk.join(F.broadcast(node) if k <= 2 else node, "context", "left").join(F.broadcast(child) if k <= 1 else child, "gram", "left")
        below = F.nullif(F.col("total") - F.coalesce("came_taken", F.lit(0)), F.lit(0))  # null: nothing is left below, or no such context
        hit, left = F.log10((F.col("c") - 0.5) / below), F.log10(0.5 * (F.col("d") - F.coalesce("came_d", F.lit(0))) / below)
        step = F.when(F.col("live"), F.coalesce(hit, left, F.lit(0.0))).otherwise(0.0)
        last = F.log10(256 - F.coalesce("d", F.lit(0))) if not k else F.lit(0.0)
        live = F.col("live") & F.col("c").isNull()
        walk = walk.select("key", (F.col("lp") + step - F.when(live, last).otherwise(0.0)).alias("lp"), live.alias("live"), F.coalesce("d", "came_d").alias("came_d"), F.coalesce("taken", "came_taken").alias("came_taken"))
    return walk.select("key", "lp")


def lm_scores(docs: DataFrame, order: int = ORDER, nodes: int | None = None, words: int = WORDS, folds: int = 5, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text", model: bool = True) -> DataFrame:
    """One row for each row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Training texts are those whose crc32(id as text) mod folds isn't held_out; a null id counts as empty text there.
    Tokens: lower-cased (A-Z) words, then one end. base_score: their add-half unigram. score: that of the byte trie for
    the words with one space between and an end symbol, so both are probabilities of the same tokens.

    All training bytes are counted, merged in tasks, then by shuffle, and all counts of all orders stay in durable tables
    that grow with the input. The LISTED most frequent grams and words that occur at least once in 2 ** words are scored in
    place from broadcasts, which bounds these at any size; the others are scored by joins on grams and on 64-bit hashes of
    words. No key of these is frequent, so none is hot. Grams that don't occur in training take their escapes by joins, once
    for each distinct gram. With `nodes`, a smaller model is made instead: a trie of what occurs at least once in 2 ** nodes
    symbols, where what is dropped goes to the escape. Without `model`, words alone are counted and there is no score.

    Null text is empty: one token, the end. Rows that repeat an id are texts of their own. Without training texts,
    train_tokens is 0 and scores are those of the empty model. No rows in, no rows out; other columns are ignored.
    """
    out_of = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == held_out
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), out_of.alias("held_out"))
    counts = base.where("NOT held_out").select("text").transform(mapped, _counts(order if model else None), "kind int, key long, n long")
    counts = durable(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "ppm-counts")
    spark = docs.sparkSession
    if not model:
        trie, ends = None, 0
    elif nodes is None:
        levels = _levels(counts, order)
        seen = _seen(levels[order])
        trie = _listed(seen)
        ends = (levels[0].where(F.col("key") == END).agg(F.sum("n")).first()[0]) or 0
    else:
        trie = train(counts, order, nodes)
        ends = int(trie.children[0][1][trie.children[0][0] == END].sum())
    sums = counts.where("kind = 1").agg(F.count("*"), F.sum("n")).first()
    if not ends:  # no model, or an end is rarer than the threshold, in very long texts
        ends = base.where("NOT held_out").count()
    total, distinct = (sums[1] or 0) + ends, sums[0] + (ends > 0)
    denominator = total + 0.5 * (distinct + 1)
    least = max(1, -(-total // (1 << words)))
    frequent = counts.where((F.col("kind") == 1) & (F.col("n") >= least)).select("key", "n").toPandas()
    keys = frequent["key"].to_numpy(np.int64).view(np.uint64)
    sc = spark.sparkContext
    listed = sc.broadcast((keys, frequent["n"].to_numpy(np.float64)))
    shared = sc.broadcast(trie) if model else None
    constants = (float(np.log10((ends + 0.5) / denominator)), float(ends > 0), float(denominator))
    kind = docs.schema[id_col].dataType.simpleString()
    name = f"{sc.applicationId}-{listed._jbroadcast.id() if hasattr(listed, '_jbroadcast') else id(listed)}"
    found = base.transform(mapped, _scores(order, shared, listed, name, constants), f"kind int, row long, key long, n long, id {kind}, held_out boolean, known long, base double, score double", KEEPS)
    found = durable(found, "ppm-scores")
    rare = counts.where((F.col("kind") == 1) & (F.col("n") < least)).select("key", F.col("n").alias("c"))
    missing = found.where("kind = 1").select("row", "key", "n").join(rare, "key", "left")
    c = F.coalesce("c", F.lit(0))
    more = missing.groupBy("row").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known2"), F.sum(F.col("n") * F.log10((c + 0.5) / denominator)).alias("base2"))
    out = found.where("kind = 0").select("row", "id", "held_out", "n", "known", "base", "score").join(more, "row", "left")
    if model and nodes is None:
        asked = found.where("kind = 2").select("row", "key", "n")
        unseen = durable(asked.select("key").distinct().join(seen, "key", "left_anti"), "ppm-unseen")
        lp = seen.select("key", "lp").unionByName(durable(_unseen(unseen, levels), "ppm-escapes"))
        out = out.join(asked.join(lp, "key").groupBy("row").agg(F.sum(F.col("n") * F.col("lp")).alias("score2")), "row", "left").withColumn("score", F.col("score") + F.coalesce("score2", F.lit(0.0)))
    return out.select(
        F.col("id").alias(id_col), "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"), *(["score"] if model else []),
    )
