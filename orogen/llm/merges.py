"""BPE encoding and decoding: a segment tree over the ranks of adjacent pairs.

The leaf of a symbol holds the rank of the pair it makes with the next one; every node holds the least (rank, place) below it, so the
root is the leftmost of the lowest-ranked pairs. A merge changes three leaves (the pair before, its own, the one that is gone),
each in logarithmic time, and ends when the root has no rank. A word of n symbols takes n log n steps, however long it is.

A text is cut at its special tokens first, as the vocabulary's library does, and then at ASCII blanks, over which no token
reaches; the library's own normaliser and word pattern are applied to each distinct run, and each distinct run is encoded once.
Decoding is the library's without a decoder: the tokens as the vocabulary spells them, joined by one space.

Null and empty texts, and those of blanks alone, have no tokens and decode to the empty text. There are no ties: equal ranks are
equal pairs, of which the leftmost is merged. Repeated rows keep one result each; an empty table gives an empty result. Very long
texts are held whole by one task, one at a time. New columns replace columns of the same name; no other name is used inside.
The vocabulary's file is a parameter; it is read on the driver and sent to the tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orogen.llm.common import slices, table

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Bytes of words, runs and their ids that a task remembers in each of two generations.
REMEMBERED = 160 << 20
SLICE = 2 << 20
_RUNS = re.compile(r"[^ \t\n\r\f\v]+")
#: The library's word pattern where there are printable ASCII characters and blanks alone, in lower case.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 \t\n\r\f\v]+")
_ODD = re.compile(r"[^\x20-\x7e\t\n\r\f\v]")
#: The normaliser and the word pattern that `_PLAIN` stands for.
_FRONT = json.dumps(
    [
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
    ],
    sort_keys=True,
)


class Pairs:
    """A segment tree over the pairs of a word's symbols: rank and place in one number, the least of all at the root."""

    def __init__(self, ranks: list[int], none: int):
        self.leaves = leaves = 1 << max(len(ranks) - 1, 0).bit_length()
        self.least = least = [none] * leaves + ranks + [none] * (leaves - len(ranks))
        for node in range(leaves - 1, 0, -1):
            left, right = least[2 * node], least[2 * node + 1]
            least[node] = left if left < right else right

    def set(self, low: int, ranks: tuple[int, int, int], middle: int, high: int) -> None:
        """New ranks at three places in order (some may be the same place); the ways up that they share are gone once."""
        least, leaves = self.least, self.leaves
        a, b, c = leaves + low, leaves + middle, leaves + high
        least[a], least[b], least[c] = ranks
        while a > 1:
            a, b, c = a >> 1, b >> 1, c >> 1
            left, right = least[2 * a], least[2 * a + 1]
            least[a] = left if left < right else right
            if b != a:
                left, right = least[2 * b], least[2 * b + 1]
                least[b] = left if left < right else right
            if c != b:
                left, right = least[2 * c], least[2 * c + 1]
                least[c] = left if left < right else right


class Merges:
    """The vocabulary and merges of a BPE model in a tokenizer's file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("not a plain BPE model")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelt = {i: s for s, i in (self.ids | self.special).items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        pairs = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        self.ranks = {(a, b): rank for rank, (a, b, _) in enumerate(pairs)}
        self.made = [c for _, _, c in pairs]
        # the library's own front end, without its merges
        own = tokenizers.Tokenizer.from_str(source)
        self.normal, self.words = own.normalizer, own.pre_tokenizer
        self.plain = json.dumps([spec["normalizer"], spec["pre_tokenizer"]], sort_keys=True) == _FRONT
        self.cuts = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def _symbols(self, word: str) -> list[int]:
        """One id for each character, the last one with the end of the word; what the vocabulary lacks has none."""
        ids, suffix = self.ids, self.suffix
        spelt = [*word[:-1], word[-1] + suffix]
        return [ids[s] for s in spelt if s in ids]

    def word(self, word: str) -> list[int]:
        """The ids of one word."""
        symbols = self._symbols(word)
        n = len(symbols)
        if n < 2:
            return symbols
        made, rank_of, lowest = self.made, self.ranks.get, len(self.ranks)
        none = lowest * n
        # rank * n + place: the order of the numbers is by rank, then from the left
        tree = Pairs([rank_of(pair, lowest) * n + i for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))], none)
        least = tree.least
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := least[1]) < none:
            rank, at = divmod(root, n)
            gone, left = after[at], before[at]
            symbols[at] = own = made[rank]
            symbols[gone] = -1
            following = after[at] = after[gone]
            mine = none
            if following < n:
                before[following] = at
                mine = rank_of((own, symbols[following]), lowest) * n + at
            # the pair of the symbol that is gone ends; the last symbol has none anyway
            last = gone if gone < n - 1 else at
            if left < 0:
                tree.set(at, (mine, mine, none if last != at else mine), at, last)
            else:
                tree.set(left, (rank_of((symbols[left], own), lowest) * n + left, mine, none if last != at else mine), at, last)
        return [s for s in symbols if s >= 0]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.spelt.__getitem__, ids))


class Encoder:
    """Encodes whole texts; remembers the words and runs it has met, and of those before them the ones it has met again.

    A word or run is remembered as (ids as bytes, its tokens joined by spaces). Texts of printable ASCII characters are cut into words
    at once, others into runs first; runs with other characters are cut by the library's own front end.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.special = {s: (struct.pack("<I", i), s) for s, i in merges.special.items()}
        self.words: dict[str, tuple[bytes, str]] = {}
        self.runs: dict[str, tuple[bytes, str]] = {}
        self.old_words, self.old_runs, self.held = {}, {}, 0

    def _learn(self, words: Iterable[str]) -> None:
        for word in words:
            made = self.old_words.get(word)
            if made is None:
                ids = self.merges.word(word)
                made = struct.pack(f"<{len(ids)}I", *ids), self.merges.decode(ids)
            self.words[word] = made
            self.held += 260 + len(word) + len(made[0]) + len(made[1])  # with what Python adds

    def _learn_runs(self, runs: Iterable[str]) -> None:
        merges, words = self.merges, self.words
        for run in runs:
            made = self.old_runs.get(run)
            if made is None:
                if merges.plain and not _ODD.search(run):
                    cut = _PLAIN.findall(run.lower())
                else:
                    cut = [word for word, _ in merges.words.pre_tokenize_str(merges.normal.normalize_str(run))]
                self._learn([w for w in dict.fromkeys(cut) if w not in words])
                made = words[cut[0]] if len(cut) == 1 else (b"".join([words[w][0] for w in cut]), " ".join([words[w][1] for w in cut]))
            self.runs[run] = made
            self.held += 300 + len(run) + len(made[0]) + len(made[1])

    def _part(self, text: str) -> list[tuple[bytes, str]]:
        """What a text without special tokens is made of."""
        if self.merges.plain and not _ODD.search(text):
            cut, known, learn = _PLAIN.findall(text.lower()), self.words, self._learn
        else:
            cut, known, learn = _RUNS.findall(text), self.runs, self._learn_runs
        learn(set(cut).difference(known))
        return [known[c] for c in cut]

    def encode(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian 32-bit integers, the decoded text)."""
        if self.held > REMEMBERED:
            self.old_words, self.old_runs = self.words, self.runs
            self.words, self.runs, self.held = {}, {}, 0
        cuts, special = self.merges.cuts, self.special
        parts = cuts.split(text) if cuts and any(map(text.__contains__, special)) else [text]
        found = [f for part in parts for f in ([special[part]] if part in special else self._part(part))]
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[0]])


def read_merges(path: str = VOCABULARY) -> str:
    """A tokenizer's file, which the tasks build `Merges` from."""
    with open(path, encoding="utf-8") as f:
        return f.read()


#: The last vocabulary that this worker has built.
_built: list = []


def _merges(source: str) -> Merges:
    key = hashlib.sha256(source.encode()).digest()
    if not _built or _built[0] != key:
        _built[:] = [key, Merges(source)]
    return _built[1]


def _mapped(docs: DataFrame, text_col: str, source: str | None, new: list[T.StructField], made) -> DataFrame:
    """`docs` with new columns: `made` gives their arrays for a list of (ids, decoded text)."""
    shared = docs.sparkSession.sparkContext.broadcast(source or read_merges())
    names = [f.name for f in new]
    rows = docs.drop(*names) if text_col not in names else docs.drop(*[n for n in names if n != text_col])
    place = rows.columns.index(text_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_merges(shared.value))
        for batch in parts:
            for piece in slices(batch, place, SLICE):
                coded = [encoder.encode(t or "") for t in piece.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns, *made(coded)], [*piece.schema.names, *names])

    return rows.mapInArrow(batches, T.StructType([*rows.schema, *new]))


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", source: str | None = None) -> DataFrame:
    """`docs` with one more column (or that column replaced): the ids of the text, an array of longs."""

    def made(coded: list[tuple[bytes, str]]) -> list[pa.Array]:
        ends = np.cumsum([0, *(len(ids) // 4 for ids, _ in coded)]).astype(np.int32)
        return [pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids for ids, _ in coded), dtype="<u4").astype(np.int64))]

    return _mapped(docs, text_col, source, [T.StructField(ids_col, T.ArrayType(T.LongType()))], made)


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "decoded", source: str | None = None) -> DataFrame:
    """`rows` with one more column (or that column replaced): the text of the ids; null for null."""
    shared = rows.sparkSession.sparkContext.broadcast(source or read_merges())
    rows = rows.drop(text_col)
    place = rows.columns.index(ids_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(shared.value)
        for batch in parts:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                texts = [merges.decode(x.values.to_pylist()) if x.is_valid else None for x in piece.column(place)]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], [*piece.schema.names, text_col])

    return rows.mapInArrow(batches, T.StructType([*rows.schema, T.StructField(text_col, T.StringType())]))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: str | None = None) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) for each row, encoded and decoded in the same task."""

    def made(coded: list[tuple[bytes, str]]) -> list[pa.Array]:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [pa.array([len(ids) // 4 for ids, _ in coded], pa.int64()), pa.array([sha(ids) for ids, _ in coded]), pa.array([sha(text.encode()) for _, text in coded])]

    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return _mapped(rows, "text", source, new, made).select("id", "n_tokens", "ids_sha256", "decoded_sha256").withColumnRenamed("id", id_col)


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
