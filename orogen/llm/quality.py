"""Quality classifier: supervised subword embeddings.

A word's vector is the mean of learned vectors of the word and of its n-grams of 3 to 5 characters, hashed
into buckets; a document's vector is the mean over its words, and a softmax over two classes gives
P(label 1). The end of each text counts as a word, so that an empty text has a score too. The vectors and the softmax are trained by numpy
stochastic gradient descent on at most `max_rows` labelled rows of each class (the least hashes of
their ids); the prior of the classes is that of all labelled rows.

As document vectors are means, a trained model is one number for each bucket, and all texts are
scored whole in one pass without a shuffle. Null texts count as empty; repeated rows keep one result
each; labels that are null or repeat an id (the larger one holds) do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import hash_words, rolling, slices, table, word_ids

BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
DIMENSIONS = 8
EPOCHS = 6
RATE = 0.4
#: Labelled rows of each class that the model is fitted on, at most.
MAX_ROWS = 800
CUT = 0.7

_MARKS = pa.array(["\x00end"])
_BASE = 0x100000001B3


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int32)


def subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all words one after another, how many each word has): the word itself and its n-grams."""
    raw = words.to_pylist()
    size = np.fromiter((len(w) + 2 for w in raw), dtype=np.int64, count=len(raw))
    text = np.frombuffer("".join([f"<{w}>" for w in raw]).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    ends = np.repeat(np.cumsum(size), size)
    owners, buckets = [np.arange(len(raw))], [_mix(hash_words(words))]
    owner = np.repeat(np.arange(len(raw)), size)
    for n in GRAMS:
        h = rolling(text + np.uint64(1), n, _BASE)
        inside = np.arange(len(h)) + n <= ends[: len(h)]
        owners.append(owner[: len(h)][inside])
        buckets.append(_mix(h[inside] + np.uint64(n)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(buckets)[order], np.bincount(owner, minlength=len(raw))


def _document_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its buckets and their shares of the document's vector."""
    ids, words, counts = word_ids(texts)
    buckets, sizes = subwords(pa.concat_arrays([words.cast(pa.string()), _MARKS]))
    starts = np.cumsum(sizes) - sizes
    ends = np.cumsum(counts)
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        word, n = np.unique(ids[end - count : end], return_counts=True)
        word, n = np.append(word, len(words)).astype(np.int64), np.append(n, 1)
        span = np.repeat(starts[word] - np.cumsum(sizes[word]) + sizes[word], sizes[word]) + np.arange(sizes[word].sum())
        share = np.repeat(n / sizes[word] / n.sum(), sizes[word])
        bucket, back = np.unique(buckets[span], return_inverse=True)
        yield bucket, np.bincount(back, share).astype(np.float32)


@dataclass
class Quality:
    """P(label 1) = sigmoid(bias + mean over a text's words of their buckets' mean weight)."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        ids, words, counts = word_ids(texts)
        buckets, sizes = subwords(pa.concat_arrays([words.cast(pa.string()), _MARKS]))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        each = np.bincount(owner, self.weights[buckets], minlength=len(sizes)) / sizes
        text = np.repeat(np.arange(len(counts)), counts)
        total = np.bincount(text, each[ids], minlength=len(counts)) + each[-1]
        return 1 / (1 + np.exp(-np.clip(self.bias + total / (counts + 1), -30, 30)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 1) -> np.ndarray:
    """Stochastic gradient descent on the softmax loss; returns each bucket's difference of logits and, last, the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((2, DIMENSIONS), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            bucket, share = bags[k]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ vectors[bucket]
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            grad = p / p.sum()
            grad[labels[k]] -= 1
            back = grad @ out
            out -= rate * grad[:, None] * mean
            bias -= rate * grad
            # each bucket moves by its share of the document, scaled up as the shares are small
            vectors[bucket] -= (rate * len(bucket) ** 0.5) * share[:, None] * back
    return np.append(vectors @ (out[1] - out[0]), bias[1] - bias[0]).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> Quality:
    """Fit on the labelled documents; `labels` has the rows to learn from (id and a 0/1 label)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return Quality(np.zeros(BUCKETS), 0.0)
    chosen = None
    for y in sorted(totals):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows)
        chosen = part if chosen is None else chosen.union(part)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text", "y")

    def featured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, 0):
                bags = list(_document_features(piece.column(0)))
                columns = [pa.array([x.tobytes() for x in c], pa.binary()) for c in zip(*bags, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column(1), *columns], ["y", "buckets", "shares"])

    def trained(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in parts for r in batch.to_pylist()]
        rows.sort(key=lambda r: (r["y"], r["buckets"], r["shares"]))
        bags = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows]
        y = np.array([r["y"] for r in rows], dtype=np.int64)
        model = train(bags, y) if len(rows) else np.zeros(BUCKETS + 1)
        # the sample is balanced; move the bias to the prior of all labelled rows
        shift = [np.log(max(totals.get(v, 0), 1)) - np.log(max((y == v).sum(), 1)) for v in (0, 1)]
        model[-1] += shift[1] - shift[0]
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()])], ["model"])

    made = sample.mapInArrow(featured, "y int, buckets binary, shares binary").repartition(1).mapInArrow(trained, "model binary").first()
    model = np.frombuffer(made["model"], np.float64)
    return Quality(model[:-1].astype(np.float32), float(model[-1]))


def score(docs: DataFrame, model: Quality, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) for each row of `docs`."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(shared.value.scores(piece.column(1)))], [id_col, "score"])

    return rows.mapInArrow(scored, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, score double")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(fold("doc_id", 4) != 2))
    scored = score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
