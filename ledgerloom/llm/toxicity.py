"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, joined, mapped, mix64, slices, word_hashes
from .ppm import Table

#: Labelled documents to learn from at most, by a hash of their ids; all features and thresholds come from these.
TRAIN_ROWS = 8_000
#: Documents that a word must be in to become a feature, and its least z-score for or against toxicity.
LEAST_DOCS, LEAST_Z = 4, 3.5
#: Weight decay and steps of the fit.
DECAY, STEPS = 2e-4, 400
GRADES = 3
#: Leading bytes of words that are features besides the words.
STEMS = (3, 4, 5, 6, 7, 8)
#: A feature has a weight for being there, and more for (occurrences, share of the words) of at least so much.
LEVELS = ((1, 0.0), (2, 0.01), (3, 0.03))

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[[c for c in range(128) if not chr(c).isalpha()]] = 32


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, document) pairs, with repeats, and each document's words. Features: hashes of words, which are lower-cased
    runs of letters (A-Z and all beyond ASCII), and of their first bytes, as inflected languages hide a stem behind many
    endings."""
    b, at = joined(texts)
    b = _LETTERS[b]
    h, doc, start, size = word_hashes(b, at)
    parts, docs = [h], [doc]
    padded = np.concatenate([b, np.zeros(8, dtype=np.uint8)])
    lead = np.ndarray((len(b) + 1,), dtype="<u8", buffer=padded, strides=(1,))[start]
    for k in STEMS:
        long = size >= k
        parts.append(mix64((lead[long] & np.uint64((1 << (8 * k)) - 1)) ^ np.uint64(k << 60)))
        docs.append(doc[long])
    return np.concatenate(parts), np.concatenate(docs), np.bincount(doc, minlength=len(texts))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, document, levels reached), each pair once, ordered by document."""
    h, doc, words = hashed(texts)
    o = np.lexsort((h, doc))
    h, doc = h[o], doc[o]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (np.diff(doc) != 0) | (h[1:] != h[:-1])
    n = np.diff(np.append(np.flatnonzero(new), len(h)))
    return h[new], doc[new], _level(n, words[doc[new]])


def _level(n: np.ndarray, words: np.ndarray) -> np.ndarray:
    return sum((n >= c) & (n >= share * words) for c, share in LEVELS).astype(np.int32)


def margins(model: "Model", table: Table, texts: list[str | None]) -> np.ndarray:
    """Each text's sum of weights over its features."""
    h, doc, words = hashed(texts)
    hit = table.find(h)
    pair, n = np.unique((doc[hit >= 0].astype(np.int64) << 32) | hit[hit >= 0], return_counts=True)
    doc = pair >> 32
    return np.bincount(doc, weights=model.weights[pair & 0xFFFFFFFF, _level(n, words[doc]) - 1], minlength=len(texts))


@dataclass
class Model:
    """P(grade <= k) = logistic(thresholds[k] - sum of weights), the same weights for all thresholds; weights[f, l] is that
    of feature f at level l + 1, those of the levels below included."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, z: np.ndarray) -> np.ndarray:
        """(documents x GRADES): the probability of grade 1 or more, 2 or more, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))


def _fit(word: np.ndarray, doc: np.ndarray, n: int, grade: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by maximum likelihood for m binary features, given as (word, doc) pairs. Adam, full batch;
    thresholds are kept in order as the first and the logs of their gaps."""
    rate = np.array([(grade > k).mean() for k in range(GRADES)]).clip(1e-4, 1 - 1e-4)
    start = -np.log(rate / (1 - rate))
    p = np.concatenate([np.zeros(m), [start[0]], np.log(np.maximum(np.diff(start), 0.1))])
    first, second = np.zeros_like(p), np.zeros_like(p)
    sigma = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for t in range(1, STEPS + 1):
        w, gaps = p[:m], np.exp(p[m + 1 :])
        theta = p[m] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(doc, weights=w[word], minlength=n)
        low = np.concatenate([[-np.inf], theta])[grade] - z  # below the grade, and up to it
        high = np.concatenate([theta, [np.inf]])[grade] - z
        a, b = np.where(np.isinf(low), 0.0, sigma(low)), np.where(np.isinf(high), 1.0, sigma(high))
        mass = np.maximum(b - a, 1e-12)
        da, db = a * (1 - a) / mass, b * (1 - b) / mass  # d log mass / d low = -da, d high = db
        dz = (db - da) / n
        g = np.zeros_like(p)
        g[:m] = np.bincount(word, weights=dz[doc], minlength=m) + DECAY * w
        d_theta = np.array([(da[grade == k + 1].sum() - db[grade == k].sum()) / n for k in range(GRADES)])
        g[m] = d_theta.sum()
        g[m + 1 :] = np.cumsum(d_theta[::-1])[::-1][1:] * gaps
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        p -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return p[:m], p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1 :]))])


def _stats(it):
    """(feature, level, documents, toxic documents) of each slice."""
    for batch in slices(it, 1 << 19):
        toxic = np.asarray(batch.column("toxic").to_pylist(), dtype=np.int64)
        h, doc, level = features(batch.column("text").to_pylist())
        for k in range(len(LEVELS)):
            on = level > k
            key, where = np.unique(h[on], return_inverse=True)
            n, n1 = np.bincount(where, minlength=len(key)), np.bincount(where, weights=toxic[doc[on]], minlength=len(key))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(key), k, dtype=np.int32)), pa.array(n.astype(np.int64)), pa.array(n1.astype(np.int64))], ["feature", "level", "c", "c1"])


def _shown(chosen: np.ndarray, place: np.ndarray):
    """Each document's chosen (feature, level) pairs; place: (features x levels), -1 for pairs that weren't chosen."""

    def run(it):
        table = Table(chosen)
        for batch in slices(it, 1 << 19):
            h, doc, level = features(batch.column("text").to_pylist())
            at = table.find(h)
            h, doc, level, at = h[at >= 0], doc[at >= 0], level[at >= 0], at[at >= 0]
            pairs, docs = [], []
            for k in range(len(LEVELS)):
                p = place[at, k]
                on = (level > k) & (p >= 0)
                pairs.append(p[on])
                docs.append(doc[on])
            pairs, docs = np.concatenate(pairs), np.concatenate(docs)
            order = np.argsort(docs, kind="stable")
            ends = np.searchsorted(docs[order], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("mark"), batch.column("toxic"), pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs[order].astype(np.int32)))], ["mark", "toxic", "pairs"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model from at most `rows` labelled documents, those with the smallest hashes of their ids; of equal texts one counts.

    A feature at a level counts where its log-odds for or against toxicity stand LEAST_Z standard errors from 0; those
    statistics are aggregated by Spark, and only the features that count, and where they are shown, reach the driver.
    Labels only say toxic or not, so severity is graded by breadth: of toxic documents, by terciles of how many of the
    strongly toxic features they show, 1 to GRADES; 0 is not toxic. Without both kinds of labels nothing is toxic.
    """
    none = Model(np.zeros(0, np.uint64), np.zeros((0, len(LEVELS))), np.full(GRADES, 40.0))
    marked = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("l_id", F.lit(3)), "l_id").limit(rows)
    found = docs.select(F.col(id_col).alias("l_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark")).where("text IS NOT NULL").join(F.broadcast(chosen), "l_id")
    sample = durable(found.groupBy("mark").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"), F.min("text").alias("text")), "toxicity-sample")
    n, n1 = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n1 < n:
        return none
    c, c1, half = F.col("c"), F.col("c1"), 0.5
    stats = sample.select("toxic", "text").transform(mapped, _stats, "feature long, level int, c long, c1 long").groupBy("feature", "level").agg(F.sum("c").alias("c"), F.sum("c1").alias("c1")).where(c >= LEAST_DOCS)
    yes, no, yes_not, no_not = c1 + half, c - c1 + half, n1 - c1 + half, (n - n1) - (c - c1) + half
    odds = F.log(yes / yes_not) - F.log(no / no_not)
    stats = stats.withColumn("odds", odds).where(F.abs("odds") >= LEAST_Z * F.sqrt(1 / yes + 1 / no + 1 / yes_not + 1 / no_not))
    table = stats.select("feature", "level", "odds", "c1").orderBy("feature", "level").toPandas()
    if not len(table):
        return none
    key = table["feature"].to_numpy(np.int64).view(np.uint64)
    every, where = np.unique(key, return_inverse=True)
    place = np.full((len(every), len(LEVELS)), -1, dtype=np.int64)
    place[where, table["level"]] = np.arange(len(table))
    got = sample.select("mark", "toxic", "text").transform(mapped, _shown(every, place), "mark long, toxic int, pairs array<int>").toArrow().sort_by("mark")
    toxic = got.column("toxic").to_numpy()
    lists = got.column("pairs").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    pair, doc = np.asarray(lists.flatten()), np.repeat(np.arange(len(toxic)), np.asarray(lists.value_lengths()))
    strong = ((table["odds"] > 3) & (table["c1"] >= 0.05 * n1)).to_numpy()
    breadth = np.bincount(doc, weights=strong[pair].astype(float), minlength=len(toxic))
    cuts = np.quantile(breadth[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + (breadth[:, None] > cuts[None, :]).sum(axis=1), 0)
    w, thresholds = _fit(pair, doc, len(toxic), grade, len(table))
    weights = np.zeros((len(every), len(LEVELS)))
    weights[place >= 0] = w[place[place >= 0]]
    return Model(every, weights.cumsum(axis=1), thresholds)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, p_toxic (grade 1 or more), expected_severity (0 to GRADES), grade (the likeliest), toxic (p_toxic >= 0.5).

    Null and empty texts have no features: their grade comes from the thresholds alone. Null and repeated ids pass
    through row by row; no rows in, no rows out; other columns are ignored. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it):
        m = shared.value
        table = Table(m.words)
        for batch in slices(it, 1 << 19):
            texts = batch.column("text").to_pylist()
            z = margins(m, table, texts)
            up = m.at_least(z)
            each = -np.diff(np.concatenate([np.ones((len(z), 1)), up, np.zeros((len(z), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(up[:, 0]), pa.array(up.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(up[:, 0] >= 0.5)], ["id", "p_toxic", "expected_severity", "grade", "toxic"])

    out = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").transform(mapped, run, f"id {kind}, p_toxic double, expected_severity double, grade int, toxic boolean")
    return out.withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with all its columns, without the rows whose text is toxic; decided where each row is read, without a shuffle."""
    model = train(docs, labels, TRAIN_ROWS, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        m = shared.value
        table = Table(m.words)
        for batch in slices(it, 1 << 19, text_col):
            texts = batch.column(text_col).to_pylist()
            z = margins(m, table, texts)
            yield batch.filter(pa.array(m.at_least(z)[:, 0] < 0.5))

    return docs.transform(mapped, run, docs.schema)
