"""Toxicity by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w . x - cut_k): one weight vector for all grades and ordered cuts. x has one
entry for each term of a learned lexicon, 1 + ln(count) where the term occurs in the document, so
long documents are not diluted. Terms are words and, with a star, the beginnings of longer words: inflected
words share their stem. The lexicon holds the terms whose log-odds of occurring in toxic rather than
clean documents lie `MIN_Z` standard errors and `MIN_ODDS` from zero (or `SURE_Z` and `SURE_ODDS`); near copies count once there. Weights and cuts are fitted by numpy gradient descent
on at most `max_rows` labelled documents of each class (the least hashes of their ids).

The labels say only toxic or not; `grade_labels` makes grades of them: 0 for clean documents, and for toxic ones
1 to 3 by terciles of the log-odds that a two-grade model gives them which was fitted on the other half of the
sample. The result is the expected severity, the sum of P(grade > k), and the flag P(grade > 0) >= FLAG.

Words are runs of non-blank bytes, lower-cased (A-Z) and trimmed of ASCII punctuation. Null, empty and
blank texts have no features and get the clean end of the scale; repeated rows keep one result each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import cut, slices, table, word_ids

#: Labelled documents of each class that the model is fitted on, at most.
MAX_ROWS = 3000
LEXICON = 512
#: Lengths of the beginnings of words that are terms.
STEMS = (4, 5, 6, 7)
MIN_Z = 3.0
#: And at least this log-odds: terms that are merely more usual in one language say nothing.
MIN_ODDS = 3.0
#: Terms that clean documents hold too, now and then, must be surer: their counts tell.
SURE_Z, SURE_ODDS = 6.0, 1.5
GRADES = 4
RIDGE = 1e-4
#: Documents are flagged from this P(grade > 0) on: clean ones that hold no term lie below 0.01.
FLAG = 0.25
STEPS = 1500
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def lexicon_counts(texts: pa.Array, lexicon: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term of the lexicon, count) of each pair that occurs."""
    ids, words, counts = word_ids(texts, lower=True)
    words = pc.utf8_trim(words.cast(pa.string()), PUNCTUATION)
    length = pc.utf8_length(words)
    ends, size = np.cumsum(counts), max(len(lexicon), 1)
    found = [np.zeros(0, np.int64)]
    for n in (None, *STEMS):
        terms = words if n is None else pc.if_else(pc.greater(length, n), pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, n), "*", ""), None)
        place = pc.fill_null(pc.index_in(terms, lexicon, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
        term = place[ids] if len(ids) else np.zeros(0, np.int32)
        at = np.flatnonzero(term >= 0)
        found.append(np.searchsorted(ends, at, side="right") * size + term[at])
    pairs, times = np.unique(np.concatenate(found), return_counts=True)
    return pairs // size, pairs % size, times


@dataclass
class Ordinal:
    """Words, their weights and the ascending cuts between grades."""

    lexicon: list[str]
    weights: np.ndarray
    cuts: np.ndarray

    def exceeds(self, texts: pa.Array) -> np.ndarray:
        """(texts, grades - 1): P(grade > k)."""
        text, word, n = lexicon_counts(texts, pa.array(self.lexicon, pa.string()))
        total = np.bincount(text, self.weights[word] * (1 + np.log(n)), minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total[:, None] - self.cuts, -30, 30)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative-link model by Adam; cuts stay ordered as a start and positive steps."""
    n, size = x.shape
    theta = np.concatenate([np.zeros(size), [1.0], np.full(grades - 2, 0.5)])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    for step in range(1, steps + 1):
        w, first, gaps = theta[:size], theta[size], np.exp(theta[size + 1 :])
        cuts = first + np.concatenate([[0.0], np.cumsum(gaps)])
        over = np.concatenate([np.ones((n, 1)), _sigmoid((x @ w)[:, None] - cuts), np.zeros((n, 1))], 1)
        slope = over * (1 - over)
        p = np.maximum(over[rows, grade] - over[rows, grade + 1], 1e-12)
        d_score = (slope[rows, grade] - slope[rows, grade + 1]) / p  # of the log-likelihood
        d_cut = np.zeros((n, grades + 1))
        d_cut[rows, grade] -= slope[rows, grade] / p
        d_cut[rows, grade + 1] += slope[rows, grade + 1] / p
        by_cut = d_cut[:, 1:-1].sum(0)
        by_gap = np.cumsum(by_cut[::-1])[::-1][1:] * gaps
        grad = -np.concatenate([x.T @ d_score, [by_cut.sum()], by_gap]) / n
        grad[:size] += ridge * w
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        theta -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return theta[:size], theta[size] + np.concatenate([[0.0], np.cumsum(np.exp(theta[size + 1 :]))])


def grade_labels(toxic: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """0 for clean rows; 1 to 3 for toxic ones by terciles of their margins."""
    terciles = np.quantile(margin[toxic > 0], [1 / 3, 2 / 3]) if (toxic > 0).any() else [0, 0]
    return np.where(toxic > 0, 1 + (margin > terciles[0]) + (margin > terciles[1]), 0).astype(np.int64)


def crossed_margins(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log-odds of each row under a two-grade model of the other half of the rows."""
    half, margin = np.arange(len(x)) % 2, np.zeros(len(x))
    for own in (0, 1):
        if (half == own).any() and (half != own).any():
            w, cuts = fit_ordinal(x[half != own], toxic[half != own], 2)
            margin[half == own] = x[half == own] @ w - cuts[0]
    return margin


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Ordinal:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y"))
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows) for y in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = F.array_remove(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), "")
    triples = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))), lambda i: F.xxhash64(F.slice("words", i + 1, 3)))
    copies = F.coalesce(F.array_min(triples), F.lit(0))  # near copies mostly share it
    # one text for each id, and for the lexicon one document of each group of near copies: the least ones, so that every run has the same
    sample = texts.join(chosen, "id").groupBy("id", "y").agg(F.min("text").alias("text")).withColumn("words", words).withColumn("copies", copies)
    sample = cut(sample.select("id", "text", "y", "copies", F.array_distinct(F.transform("words", lambda w: F.btrim(w, F.lit(PUNCTUATION)))).alias("words")))
    single = sample.groupBy("copies", "y").agg(F.min_by("words", "id").alias("words"))
    sizes = single.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = float(sizes["toxic"] or 0), float(sizes["n"] - (sizes["toxic"] or 0))
    nothing = Ordinal([], np.zeros(0), np.array([5.0 + k for k in range(GRADES - 1)]))
    if not toxic or not clean:
        return nothing
    stems = [F.transform(F.filter("words", lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS]
    terms = F.array_distinct(F.concat("words", *stems))
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (F.lit(toxic) + 1 - t)) - F.log(c / (F.lit(clean) + 1 - c))
    listed = (
        single.select("y", F.explode(terms).alias("word"))
        .where("word <> ''")
        .groupBy("word")
        .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
        .withColumn("odds", odds)
        .withColumn("z", F.col("odds") / F.sqrt(1 / t + 1 / c))
        .where(((F.abs("z") >= MIN_Z) & (F.abs("odds") >= MIN_ODDS)) | ((F.abs("z") >= SURE_Z) & (F.abs("odds") >= SURE_ODDS)))
        .orderBy(F.abs("z").desc(), "word")
        .limit(LEXICON)
    )
    lexicon = sorted(r["word"] for r in listed.collect())
    if not lexicon:
        return nothing
    known_terms = pa.array(lexicon, pa.string())

    def featured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, 0):
                text, word, n = lexicon_counts(piece.column(0), known_terms)
                x = np.zeros((piece.num_rows, len(lexicon)), dtype=np.float32)
                x[text, word] = 1 + np.log(n)
                yield pa.RecordBatch.from_arrays([piece.column(1), piece.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "y", "x"])

    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.select("text", "id", "y").mapInArrow(featured, f"id {kind}, y int, x binary").toPandas().sort_values(["y", "id"])
    x, y = np.stack([np.frombuffer(r, np.float32) for r in rows["x"]]).astype(np.float64), rows["y"].to_numpy()
    weights, cuts = fit_ordinal(x, grade_labels(y, crossed_margins(x, y)), GRADES)
    return Ordinal(lexicon, weights, cuts)


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, p_toxic, severity from 0 to grades - 1, grade: the most likely one, toxic)."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, 1):
                over = model.exceeds(piece.column(1))
                each = -np.diff(np.concatenate([np.ones((len(over), 1)), over, np.zeros((len(over), 1))], 1), axis=1)
                columns = [over[:, 0], over.sum(1), each.argmax(1).astype(np.int32), over[:, 0] >= FLAG]
                yield pa.RecordBatch.from_arrays([piece.column(0), *map(pa.array, columns)], [id_col, "p_toxic", "severity", "grade", "toxic"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(scored, f"`{id_col}` {kind}, p_toxic double, severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: Ordinal, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that the model does not flag; one pass, no join."""
    place = docs.columns.index(text_col)

    def kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, place):
                yield piece.filter(pa.array(model.exceeds(piece.column(place))[:, 0] < FLAG))

    return docs.mapInArrow(kept, docs.schema)


def op2_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
