"""Toxicity: a convolutional text classifier trained in numpy.

Words are hashed into an embedding table; filters of several widths slide over
the word vectors, each keeps its largest response, and a logistic unit reads
them. Training takes a bounded sample of labelled documents; scoring reads every
whole text in Arrow batches. For decisions by language a threshold per language
is calibrated on labelled documents that neither training nor the holdout takes;
the score itself knows nothing but the text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.grams import MEMORY, text_bytes
from tallyloom.llm.rows import field, hinted, in_small_batches, pick
from tallyloom.session import saved

BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 16, 12, 8, (1, 2, 3)
# At most so many labelled documents of each class are trained on.
SAMPLE = 1500
EPOCHS, RATE, SEED = 12, 0.01, 7
# Letters of a stem (bytes); documents of the sample that a row must occur in to be learned.
STEM, LEAST = 6, 4
# Words around a filter response that are scored at a time, so that a text of any length needs little memory.
CHUNK = 1 << 15
STRIP = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


class Buckets:
    """Embedding rows of a text: for each word its own row and that of its first letters.

    ASCII punctuation at the ends goes, A-Z are lower-cased. Row 0 is padding,
    also for words without a row; a text of any length has windows of all widths.
    """

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[int, int]] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        for word in set(words).difference(known):
            bare = word.strip(STRIP)
            known[word] = (zlib.crc32(bare) % (BUCKETS - 1) + 1, zlib.crc32(b"^" + bare[:STEM]) % (BUCKETS - 1) + 1)
        pad = max(WIDTHS) - 1
        ids = np.zeros((len(words) + 2 * pad, 2), dtype=np.int64)
        if words:
            ids[pad:pad + len(words)] = np.array([known[w] for w in words], np.int64)
        return ids


@dataclass
class Net:
    table: np.ndarray
    filters: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float


def fresh(seed: int = SEED) -> Net:
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
    return Net(table, [rng.normal(0, (2 / (w * SIZE)) ** 0.5, (w * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
               [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.0)


def _windows(vectors: np.ndarray, width: int) -> np.ndarray:
    n = len(vectors) - width + 1
    return np.concatenate([vectors[k:k + n] for k in range(width)], axis=1)


def responses(net: Net, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The largest response of each filter and where it was; long texts are read in overlapping chunks."""
    best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
    where = [np.zeros(FILTERS, np.int64) for _ in WIDTHS]
    step = max(WIDTHS) - 1
    for start in range(0, max(1, len(ids) - step), CHUNK):
        part = ids[start:start + CHUNK + step]
        vectors = net.table[part[:, 0]] + net.table[part[:, 1]]
        for k, width in enumerate(WIDTHS):
            value = _windows(vectors, width) @ net.filters[k]
            at = value.argmax(axis=0)
            top = value[at, np.arange(FILTERS)]
            better = top > best[k]
            best[k][better], where[k][better] = top[better], at[better] + start
    return np.maximum(best + np.array(net.shifts), 0), where


def score(net: Net, ids: np.ndarray) -> float:
    best, _ = responses(net, ids)
    return float(1 / (1 + np.exp(-(best.ravel() @ net.out + net.bias))))


def train(texts: list[bytes | None], labels: list[int], seed: int = SEED, epochs: int = EPOCHS, rate: float = RATE) -> Net:
    """Adam on single documents, both classes weighted alike; embeddings are updated where a filter fired."""
    net, rng, words = fresh(seed), np.random.default_rng(seed), Buckets()
    ids, y = [words(t) for t in texts], np.array(labels, dtype=np.float32)
    seen_in = np.zeros(BUCKETS, np.int64)
    for rows in ids:
        seen_in[np.unique(rows)] += 1
    # What too few documents show is left at zero: it can be learned by heart only.
    rare = seen_in < LEAST
    rare[0] = True
    net.table[rare] = 0
    share = y.mean() if len(y) else 0.5
    if not 0 < share < 1:
        net.bias = 4.0 if share == 1 else -4.0
        return net
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    net.out = rng.normal(0, 0.3, net.out.shape).astype(np.float32)
    dense = [*net.filters, *net.shifts, net.out]
    first, second = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    table_m = np.zeros(BUCKETS, np.float32)
    step = 0
    for _ in range(epochs):
        for i in rng.permutation(len(ids)):
            step += 1
            best, where = responses(net, ids[i])
            flat = best.ravel()
            p = 1 / (1 + np.exp(-np.clip(flat @ net.out + net.bias, -30, 30)))
            slope = np.float32((p - y[i]) * weight[i])
            back = (slope * net.out).reshape(best.shape) * (best > 0)
            grads_f, grads_s = [], []
            for k, width in enumerate(WIDTHS):
                rows = ids[i][where[k][:, None] + np.arange(width)]
                seen = (net.table[rows[..., 0]] + net.table[rows[..., 1]]).reshape(FILTERS, -1)
                grads_f.append((seen * back[k][:, None]).T)
                grads_s.append(back[k])
                change = (net.filters[k].T * back[k][:, None]).reshape(FILTERS, width, SIZE)
                # Row-wise Adagrad keeps rare words fast.
                for kind in range(2):
                    at = rows[..., kind]
                    np.add.at(table_m, at, (change**2).mean(axis=2))
                    np.add.at(net.table, at, -5 * rate * change / (np.sqrt(table_m[at])[:, :, None] + 1e-4))
                    net.table[at[rare[at]]] = 0
            net.bias -= rate * float(slope)
            for j, (param, grad) in enumerate(zip(dense, [*grads_f, *grads_s, slope * flat])):
                first[j] += 0.1 * (grad - first[j])
                second[j] += 0.001 * (grad**2 - second[j])
                param -= rate * 0.3 * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(ident):
    """Rows that training never sees: the checksum of the id as text is divisible by five."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _labelled(labels: DataFrame, label_id: str, label: str) -> DataFrame:
    return pick(labels, id=label_id, y=label).select(F.col("id").cast("long"), F.col("y").cast("int")).where(
        "id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))


def _chosen(labels: DataFrame, label_id: str, label: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(id, y) of the labelled rows that training takes, at most ``most`` of each class by a hash of the id, and of all that it may take."""
    known = _labelled(labels, label_id, label).where(~held_out(F.col("id")))
    chosen = None
    for y in (0, 1):
        part = known.where((F.col("y") > 0) == bool(y)).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    return chosen, known


def sample(docs: DataFrame, labels: DataFrame, ident: str, text: str, label_id: str, label: str, most: int) -> DataFrame:
    """(text, y): at most ``most`` labelled training documents of each class, chosen by a hash of the id; one row each."""
    chosen = hinted(saved(_chosen(labels, label_id, label, most)[0], "sample"), 32)
    # A repeated id gives one row, so that the bound is on rows too: the text with the smallest hash.
    found = pick(docs, id=ident, text=text).select(F.col("id").cast("long"), F.col("text").cast("binary").alias("text")).join(chosen, "id")
    single = found.groupBy("id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return single.orderBy("id").select("text", (F.col("y") > 0).cast("int").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label_id: str = "doc_id",
        label: str = "toxic", most: int = SAMPLE) -> Net:
    """A net trained on a bounded sample; only rows that ``held_out`` leaves are learned from."""
    rows = sample(docs, labels, ident, text, label_id, label, most).collect()
    return train([r["text"] and bytes(r["text"]) for r in rows], [r["y"] for r in rows])


def _scored(sent):
    def run(batches):
        net, words = Net(*sent.value), Buckets()
        for batch in batches:
            marks = [score(net, words(t)) for t in text_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.float64())], names=["id", "lang", "score"])

    return run


def score_toxicity(docs: DataFrame, net: Net, ident: str = "doc_id", text: str = "text", lang: str | None = None) -> DataFrame:
    """(id, held_out, score, predicted) for each row, and ``lang`` where a column of that is named.

    ``score`` lies between 0 and 1 and depends on the text alone; null and blank
    texts score like a text of padding alone. ``predicted`` is 1 from 0.5 on.
    Rows are independent, so repeated rows agree; a null id is not held out; a
    null language is the empty one; other columns are ignored; an empty table
    gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast((net.table, net.filters, net.shifts, net.out, net.bias))
    named = F.lit("") if lang is None else F.coalesce(field(docs, lang).cast("string"), F.lit(""))
    rows = docs.select(field(docs, ident).cast("long").alias("id"), named.alias("lang"), field(docs, text).alias("text"))
    marked = in_small_batches(rows).mapInArrow(_scored(sent), "id long, lang string, score double")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return marked.select("id", held_out(F.col("id")).alias("held_out"), "score", predicted, *([] if lang is None else ["lang"]))


def thresholds(scored: DataFrame, labels: DataFrame, label_id: str = "doc_id", label: str = "toxic",
               precision: float = 0.9, steps: int = 100, most: int = SAMPLE) -> DataFrame:
    """(lang, threshold): the lowest score from which on ``precision`` of the calibrating rows of a language are toxic.

    ``scored`` is saved output of ``score_toxicity`` with its language. Only
    labelled rows that neither the holdout nor training (with a sample of
    ``most``) takes count; with few labels there are none. Scores are
    counted in ``steps`` bins per language, so no language is gathered in one
    task. A language without such rows, or that never reaches the precision, is
    not listed.
    """
    chosen, known = _chosen(labels, label_id, label, most)
    rows = scored.join(known.join(hinted(saved(chosen.select("id"), "trained"), 32), "id", "left_anti"), "id")
    bins = rows.groupBy("lang", F.floor(F.col("score") * steps).alias("bin")).agg(
        F.count("*").alias("n"), F.sum((F.col("y") > 0).cast("long")).alias("good"))
    above = Window.partitionBy("lang").orderBy(F.desc("bin"))
    return bins.select("lang", "bin", F.sum("n").over(above).alias("n"), F.sum("good").over(above).alias("good")).where(
        F.col("good") >= precision * F.col("n")).groupBy("lang").agg((F.min("bin") / steps).alias("threshold"))


def flagged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """``scored`` with ``flagged``: 1 from the threshold of the row's language on, 0.5 where it has none."""
    limits = limits.withColumnRenamed("lang", "limited")
    joined = scored.join(hinted(limits, 128), scored["lang"] == limits["limited"], "left")
    return joined.withColumn("flagged", (F.col("score") >= F.coalesce("threshold", F.lit(0.5))).cast("int")).drop("limited", "threshold")
