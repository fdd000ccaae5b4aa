"""Language-model scoring by deleted interpolation of n-grams, words and a uniform floor.

    P1(w) = l1 c(w) / N + (1 - l1) / (V + 1)
    Pn(w | h) = ln c(h, w) / c(h) + (1 - ln) Pn-1(w | h without its first word)

up to `order`. The weight ln depends on the bucket of c(h), a power of two; it is 0 for a context that never occurred. Weights are
learned by expectation-maximisation on held-out counts: the counts of `DELETED_FOLD`'s documents against estimates from the
other training documents, which are rounded to `STEPS` steps a decade there. Scores then use the counts of all training documents.

Counting and looking up never move single tokens. Documents form blocks by hashes. A block sends its distinct n-grams of an order,
as sorted hashes, to shards by hash range; a shard adds up the counts and answers each block in the block's own order, so an answer
holds no keys. Orders follow one another: an n-gram that holds an (n-1)-gram which occurs once in all documents occurs once
itself, so it is not asked for. A block's documents then meet its answers and are scored. The counts grow with the corpus and stay
spread over the shards; all of it is one lazy plan that shuffles the texts once.

Tokens: runs of non-blank bytes with A-Z lower-cased, then one end for each text. Null, empty and blank texts have the end
alone. Repeated rows count and score each; rows without an id are training rows. Hashes stand for words (64 bits) and
longer n-grams (56 bits); no training row at all gives the uniform floor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import hash_words, table, word_ids
from orogen.llm.quality import fold

ORDER = 3
FOLDS = 10
#: Scored only.
HELD_OUT_FOLD = 0
#: Training documents whose counts are held out when the weights are learned.
DELETED_FOLD = 1
BLOCK_BYTES = 8 << 20
BUCKETS = 24
ROUNDS = 60
#: Steps per decade to which the estimates are rounded in the table of held-out counts.
STEPS = 8

_START, _END = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Tokens:
    """The tokens of some texts side by side: their hashes, the text each is of, and the n-grams that end at them."""

    def __init__(self, texts: pa.Array):
        ids, words, counts = word_ids(pc.fill_null(texts, ""), lower=True)
        hashes = hash_words(words)[ids] if len(ids) else np.zeros(0, np.uint64)
        self.sizes = counts + 1
        ends = np.cumsum(self.sizes) - 1
        self.firsts = ends + 1 - self.sizes
        is_end = np.zeros(int(self.sizes.sum()), dtype=bool)
        is_end[ends] = True
        self.word = np.empty(len(is_end), dtype=np.uint64)
        self.word[is_end], self.word[~is_end] = _END, hashes
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def before(self, values: np.ndarray, at_start: object) -> np.ndarray:
        """The value of the token before each one; `at_start` for the first of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.firsts] = at_start
        return out

    def longer(self, keys: np.ndarray) -> np.ndarray:
        """Keys of the n-grams that end at each token, from those of one word less."""
        key = (self.before(keys, _START) * _ODD) ^ self.word
        key = (key ^ (key >> np.uint64(32))) * _ODD
        return (key ^ (key >> np.uint64(29))) >> np.uint64(8)


def _squeezed(values: np.ndarray) -> bytes:
    """Non-negative whole numbers as compressed planes of bytes: the high planes of small ones are nearly free."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _stretched(blob: bytes, count: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=8 * count, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


class Lookup:
    """What a block knows of its tokens' n-grams, order by order: c, and whether the n-gram occurs once in all documents."""

    def __init__(self, texts: pa.Array, fold_of: np.ndarray, order: int, answers: list[dict], column: str = "total"):
        self.tokens = Tokens(texts)
        self.trained = (fold_of != HELD_OUT_FOLD)[self.tokens.text]
        self.deleted = (fold_of == DELETED_FOLD)[self.tokens.text]
        self.keys, self.counts = self.tokens.word, []
        self.lone = np.zeros(len(self.keys), dtype=bool)
        for n in range(1, order + 1):
            if n > 1:
                self._longer()
            own = sorted((r for r in answers if r["n"] == n), key=lambda r: r["shard"])
            asked, back = np.unique(self.keys[~self.known], return_inverse=True) if n > 1 else np.unique(self.keys, return_inverse=True)
            if sum(r["size"] for r in own) != len(asked):
                raise RuntimeError(f"a block got {sum(r['size'] for r in own)} answers to {len(asked)} questions")
            total, kept = (np.concatenate([np.zeros(0, np.uint64), *[_stretched(r[c], r["size"]) for r in own]]) if c == "total" or column == c else None for c in ("total", "kept"))
            # an n-gram that is not asked for is this token's own: it counts if the document does
            count = (self.trained if column == "total" else self.trained & ~self.deleted).astype(np.float64)
            lone = np.ones(len(self.keys), dtype=bool)
            asking = slice(None) if n == 1 else ~self.known
            count[asking] = (total >> np.uint64(1) if column == "total" else kept)[back]
            lone[asking] = (total & np.uint64(1)).astype(bool)[back]
            self.lone = lone
            self.counts.append(count)
        # a text starts as often as one ends
        at_end = np.flatnonzero(self.tokens.word == _END)[:1]
        starts = float(self.counts[0][at_end].sum()) if order else 0.0
        self.contexts = [self.tokens.before(c, starts) for c in self.counts[:-1]]

    def _longer(self) -> None:
        self.known = self.lone | self.tokens.before(self.lone, False)
        self.keys = self.tokens.longer(self.keys)

    def questions(self, n: int, shards: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
        """(shard, size, keys as squeezed differences, training counts, other counts) of the n-grams to ask for."""
        if n > 1:
            self._longer()
        open_ = ~self.known if n > 1 else np.ones(len(self.keys), dtype=bool)
        keys, back = np.unique(self.keys[open_], return_inverse=True)
        trained = np.bincount(back, self.trained[open_], minlength=len(keys)).astype(np.uint64)
        others = np.bincount(back, minlength=len(keys)).astype(np.uint64) - trained
        width = np.uint64((2 ** (64 if n == 1 else 56) - 1) // shards)
        place = np.minimum(keys // width, np.uint64(shards - 1)).astype(np.int64)
        cuts = np.searchsorted(place, np.arange(shards + 1))
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[shard], cuts[shard + 1])
            steps = np.diff(keys[own], prepend=np.uint64(0))
            yield shard, len(steps), _squeezed(steps), _squeezed(trained[own]), _squeezed(others[own])


def _answers(rows: list[dict]) -> Iterator[dict]:
    """Totals of a shard's keys of one order for each block; then, without a block, the shard's tokens and distinct words."""
    keys = np.concatenate([np.cumsum(_stretched(r["keys"], r["size"]), dtype=np.uint64) for r in rows])
    trained, others = (np.concatenate([_stretched(r[c], r["size"]) for r in rows]).astype(np.float64) for c in ("trained", "others"))
    deleted = np.repeat([r["deleted"] for r in rows], [r["size"] for r in rows])
    distinct, back = np.unique(keys, return_inverse=True)
    total, kept, seen = (np.bincount(back, c, minlength=len(distinct)).astype(np.uint64) for c in (trained, trained * ~deleted, trained + others))
    coded = 2 * total + (seen == 1)
    n, shard = rows[0]["n"], rows[0]["shard"]
    end = 0
    for r in rows:
        at = back[end : end + r["size"]]
        end += r["size"]
        yield {"block": r["block"], "n": n, "shard": shard, "size": r["size"], "total": _squeezed(coded[at]), "kept": _squeezed(kept[at]) if r["deleted"] else None}
    yield {"block": None, "n": n, "shard": shard, "size": 0, "tokens": int(total.sum()), "kept_tokens": int(kept.sum()), "words": int((total > 0).sum())}


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(context + 1)).astype(np.int64), BUCKETS - 1)


def _interpolated(buckets: list[np.ndarray], estimates: list[np.ndarray], weights: np.ndarray, floor: float) -> list[np.ndarray]:
    """The probabilities of each order, the floor first; estimates by order, buckets from the second order on."""
    p = [np.full(len(estimates[0]), floor)]
    for n, ml in enumerate(estimates):
        w = weights[n][buckets[n - 1]] if n else weights[0, 0]
        p.append(w * ml + (1 - w) * p[-1])
    return p


def learn_weights(cells: np.ndarray, order: int, floor: float) -> np.ndarray:
    """(order, buckets) weights by expectation-maximisation; the first row has one weight, in its first place.

    `cells` has held-out counts: buckets of the contexts of orders 2 and up, rounded -log10 of the estimates of all orders (-1: zero), and tokens.
    """
    weights = np.full((order, BUCKETS), 0.5)
    weights[0] = 0.9
    weights[1:, 0] = 0.0  # an unseen context has no estimate
    if not len(cells):
        return weights
    buckets = list(cells[:, : order - 1].T.astype(np.int64))
    estimates = [np.where(q < 0, 0.0, 10.0 ** (-q / STEPS)) for q in cells[:, order - 1 : -1].T]
    for _ in range(ROUNDS):
        p = _interpolated(buckets, estimates, weights, floor)
        left = cells[:, -1]  # tokens that are not yet drawn from a higher order
        for n in range(order - 1, -1, -1):
            w = weights[n][buckets[n - 1]] if n else weights[0, 0]
            drawn = left * w * estimates[n] / p[n + 1]
            if n:
                # a small pull to the whole corpus's weight keeps rare buckets steady
                some, all_ = (np.bincount(buckets[n - 1], x, minlength=BUCKETS) for x in (drawn, left))
                shared = some[1:].sum() / max(all_[1:].sum(), 1e-9)
                weights[n, 1:] = (some[1:] + 10 * shared) / (all_[1:] + 10)
            else:
                weights[0] = drawn.sum() / max(left.sum(), 1e-9)
            left = left - drawn
    return weights


def _estimates(known: Lookup, n_tokens: int) -> list[np.ndarray]:
    return [known.counts[0] / max(n_tokens, 1), *[c / np.maximum(h, 1) for c, h in zip(known.counts[1:], known.contexts, strict=True)]]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`."""
    part = F.coalesce(fold(id_col, FOLDS), F.lit(-1)).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), part.alias("fold"))
    deleted = F.col("fold") == DELETED_FOLD
    size = lambda cond: F.coalesce(F.sum(F.when(cond, F.octet_length("text"))), F.lit(0))
    held, others = (max(1, -(-n // block_bytes)) for n in rows.agg(size(deleted), size(~deleted)).first())
    shards = held + others
    own = F.pmod(F.xxhash64("id", "text"), F.when(deleted, held).otherwise(others))
    blocks = rows.withColumn("block", F.when(deleted, own).otherwise(own + held)).repartition("block")  # one exchange, read by each order

    def asked(n: int):
        def ask(own: pa.Table, mine: pa.Table) -> pa.Table:
            known = Lookup(own["text"].combine_chunks(), own["fold"].to_numpy(), n - 1, mine.to_pylist())
            made = list(known.questions(n, shards))
            columns = list(zip(*made, strict=True)) or [[]] * 5
            block, is_deleted = own["block"][0].as_py(), own["fold"][0].as_py() == DELETED_FOLD
            values = [[block] * len(made), [is_deleted] * len(made), [n] * len(made), *columns]
            return pa.table([pa.array(v, t.type) for v, t in zip(values, _QUESTION, strict=True)], schema=_QUESTION)

        def ask_words(own: pa.Table) -> pa.Table:
            return ask(own, _ANSWER.empty_table())

        return ask if n > 1 else ask_words

    def answered(rows: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(_answers(rows.to_pylist())), schema=_ANSWER)

    answers = None
    for n in range(1, order + 1):
        grouped = blocks.groupBy("block")
        if answers is None:
            questions = grouped.applyInArrow(asked(n), _QUESTIONS)
        else:
            questions = grouped.cogroup(answers.where("block is not null").groupBy("block")).applyInArrow(asked(n), _QUESTIONS)
        new = questions.groupBy("shard").applyInArrow(answered, _ANSWERS)
        answers = new if answers is None else answers.union(new)
        if n == 1:
            whole = new.where("block is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "kept_tokens", "words")])
    totals = F.struct("tokens", "kept_tokens", "words")
    mine = answers.where("block is not null")

    def held_counts(own: pa.Table, mine: pa.Table) -> pa.Table:
        known = Lookup(own["text"].combine_chunks(), own["fold"].to_numpy(), order, mine.to_pylist(), "kept")
        estimates = _estimates(known, mine["totals"][0].as_py()["kept_tokens"])
        with np.errstate(divide="ignore"):
            logs = [np.where(p > 0, np.rint(-STEPS * np.log10(p)), -1) for p in estimates]
        cells, times = np.unique(np.stack([*map(_bucket, known.contexts), *logs], 1), axis=0, return_counts=True)
        return pa.table({"cell": pa.array(cells.astype(np.int32).tolist(), pa.list_(pa.int32())), "n": times.astype(np.int64)})

    def learned(cells: pa.Table) -> pa.Table:
        table_ = np.array([[*c, n] for c, n in zip(cells["cell"].to_pylist(), cells["n"].to_pylist(), strict=True)], dtype=np.float64)
        table_ = table_[np.lexsort(table_.T)]
        weights = learn_weights(table_, order, 1 / (cells["totals"][0].as_py()["words"] + 1))
        return pa.table({"weights": pa.array([weights.ravel().tolist()], pa.list_(pa.float64()))})

    all_totals = whole.select(totals.alias("totals"))
    known = mine.withColumn("totals", all_totals.scalar())
    held_rows = blocks.where(deleted).groupBy("block").cogroup(known.where("kept is not null").groupBy("block")).applyInArrow(held_counts, "cell array<int>, n long")
    cells = held_rows.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("totals", all_totals.scalar())
    weights = cells.groupBy(F.lit(0).alias("all")).applyInArrow(learned, "weights array<double>")
    known = known.withColumn("weights", weights.scalar())

    def scored(own: pa.Table, mine: pa.Table) -> pa.Table:
        totals, learnt = mine["totals"][0].as_py(), mine["weights"][0].as_py()
        n_train, n_words = totals["tokens"], totals["words"]
        weights = learn_weights(np.zeros((0, 0)), order, 0.0) if learnt is None else np.array(learnt).reshape(order, BUCKETS)
        if not n_train:
            weights = np.zeros((order, BUCKETS))  # the floor alone
        fold_of = own["fold"].to_numpy()
        known = Lookup(own["text"].combine_chunks(), fold_of, order, mine.drop_columns(["totals", "weights"]).to_pylist())
        word, tokens = known.counts[0], known.tokens
        base = np.log10((word + 0.1) / (n_train + 0.1 * (n_words + 1)))
        p = _interpolated([_bucket(c) for c in known.contexts], _estimates(known, n_train), weights, 1 / (n_words + 1))[-1]
        adds = lambda x: np.bincount(tokens.text, x, minlength=len(tokens.sizes)).astype(np.float64)
        return pa.table(
            {
                "id": own["id"],
                "held_out": fold_of == HELD_OUT_FOLD,
                "n_tokens": tokens.sizes.astype(np.int64),
                "n_known": adds(word > 0).astype(np.int64),
                "train_tokens": np.full(len(fold_of), n_train, dtype=np.int64),
                "base_score": adds(base),
                "score": adds(np.log10(p)),
            }
        )

    kind = rows.schema["id"].dataType.simpleString()
    out = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        scored, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumnRenamed("id", id_col)


_QUESTION = pa.schema(
    [("block", pa.int64()), ("deleted", pa.bool_()), ("n", pa.int32()), ("shard", pa.int32()), ("size", pa.int32())] + [(c, pa.binary()) for c in ("keys", "trained", "others")]
)
_QUESTIONS = "block long, deleted boolean, n int, shard int, size int, keys binary, trained binary, others binary"
_ANSWER = pa.schema(
    [("block", pa.int64()), ("n", pa.int32()), ("shard", pa.int32()), ("size", pa.int32()), ("total", pa.binary()), ("kept", pa.binary())]
    + [(c, pa.int64()) for c in ("tokens", "kept_tokens", "words")]
)
_ANSWERS = "block long, n int, shard int, size int, total binary, kept binary, tokens long, kept_tokens long, words long"


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
