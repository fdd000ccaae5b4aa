"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Blanks become the mark U+2581 and one is put in front, as SentencePiece does; a marked word is a run of marks
with the characters up to the next mark or line end, and no piece of the vocabulary reaches over its end.
The distinct marked words of a batch are sorted, which lays them out as a trie in depth-first
order: the forward scores of a word are kept on a stack, and the next word resumes where its prefix
departs. A position's forward score is the best sum of the scores of the pieces that spell the word
up to it (ties: the longest last piece); a character that no piece starts with a match for is spelt
in byte pieces at the least score less `UNKNOWN`.

Decoding is exact: no blank is dropped, and a mark in the text itself is spelt in bytes. Null texts
encode like empty ones, to no pieces, and decode to the empty text; repeated rows keep one result each.
The vocabulary's file is a parameter; it is read on the driver and sent to the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orogen.llm.common import slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Stands for a mark in the text itself; no valid text holds it.
_OWN_MARK = "\ud800"
UNKNOWN = 10.0
#: Bytes of words and their ids that a task remembers before it starts afresh.
REMEMBERED = 24 << 20
SLICE = 2 << 20


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model."""

    def __init__(self, model: bytes):
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [own.id_to_piece(i) for i in range(own.get_piece_size())]
        scores = [own.get_score(i) for i in range(len(self.pieces))]
        self.bytes, self.spelt = [-1] * 256, [b""] * len(self.pieces)
        self.normal: list[tuple[str, int, float]] = []
        for i, piece in enumerate(self.pieces):
            if own.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[value], self.spelt[i] = i, bytes([value])
            elif not (own.is_control(i) or own.is_unknown(i) or own.is_unused(i)):
                self.normal.append((piece, i, scores[i]))
                self.spelt[i] = piece.replace(MARK, " ").encode()
        self.unknown = min(s for _, _, s in self.normal) - UNKNOWN
        longer = [p for p, _, _ in self.normal if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("a piece reaches over a marked word's end")
        lines = "" if any("\n" in p for p in longer) else "\n"
        self.words = re.compile(f"{MARK}*[^{MARK}{lines}]+|{MARK}+" + (f"|{lines}" if lines else ""))

    def decode(self, ids: Iterable[int]) -> str:
        out = b"".join(map(self.spelt.__getitem__, ids))
        return out[1:].decode("utf-8", "replace")


class Encoder:
    """Encodes marked words, many at a time; remembers those it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.trie: dict = {}
        for piece, number, score in vocabulary.normal:
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (number, score)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def learn(self, words: set[str]) -> None:
        """Viterbi over the sorted words; what stands on the stack for the shared prefix is reused."""
        trie, unknown = self.trie, self.vocabulary.unknown
        # per position: best score, start of the last piece, its id (-1: bytes), pieces that go on from here as (start, node)
        best, back, last, open_ = [0.0], [0], [0], [[]]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :], last[shared + 1 :], open_[shared + 1 :]
            for at in range(shared, len(word)):
                c = word[at]
                top, start, piece, going = None, at, -1, []
                for s, node in [*open_[at], (at, trie)]:
                    node = node.get(c)
                    if node is not None:
                        going.append((s, node))
                        end = node.get("")
                        if end is not None and (top is None or best[s] + end[1] > top):
                            top, start, piece = best[s] + end[1], s, end[0]
                alone = going[-1][1].get("") if going and going[-1][0] == at else None
                if alone is None and (top is None or best[at] + unknown > top):
                    top, start, piece = best[at] + unknown, at, -1
                best.append(top)
                back.append(start)
                last.append(piece)
                open_.append(going)
            before = word
            path, at = [], len(word)
            while at:
                if last[at] >= 0:
                    path.append(last[at])
                else:
                    raw = MARK if word[at - 1] == _OWN_MARK else word[at - 1]
                    path.extend(self.vocabulary.bytes[b] for b in reversed(raw.encode()))
                at = back[at]
            self.known[word] = np.array(path[::-1], dtype=np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as int32 bytes."""
        split = self.vocabulary.words.findall
        rows = [split(MARK + t.replace(MARK, _OWN_MARK).replace(" ", MARK)) if t else [] for t in texts]
        new = set().union(*rows).difference(self.known)
        if self.held > REMEMBERED:
            self.known.clear()
            self.held, new = 0, set().union(*rows)
        self.learn(new)
        self.held += sum(180 + len(word) + len(self.known[word]) for word in new)  # with what Python adds to each
        return [b"".join(map(self.known.__getitem__, row)) for row in rows]


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary(f.read())


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", vocabulary: Vocabulary | None = None, check: str | None = None) -> DataFrame:
    """`docs` with one more column (or that column replaced): the ids of the pieces, an array of ints.

    `check` names a further column: whether the ids, decoded in the same task, give the text (null: the empty text) again.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or read_vocabulary())
    rows = docs.drop(ids_col, *([check] if check else []))
    place = rows.columns.index(text_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in parts:
            for piece in slices(batch, place, SLICE):
                texts = [t or "" for t in piece.column(place).to_pylist()]
                ids = encoder.encode(texts)
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                made = [pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), dtype=np.int32))]
                if check:
                    made.append(pa.array([shared.value.decode(np.frombuffer(x, np.int32).tolist()) == t for x, t in zip(ids, texts, strict=True)]))
                yield pa.RecordBatch.from_arrays([*piece.columns, *made], [*piece.schema.names, ids_col, *([check] if check else [])])

    new = [T.StructField(ids_col, T.ArrayType(T.IntegerType())), *([T.StructField(check, T.BooleanType())] if check else [])]
    return rows.mapInArrow(batches, T.StructType([*rows.schema, *new]))


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "decoded", vocabulary: Vocabulary | None = None) -> DataFrame:
    """`rows` with one more column (or that column replaced): the text of the ids; null for null."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary or read_vocabulary())
    rows = rows.drop(text_col)
    place = rows.columns.index(ids_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                texts = [None if ids is None else shared.value.decode(ids) for ids in (x.values.to_numpy().tolist() if x.is_valid else None for x in piece.column(place))]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], [*piece.schema.names, text_col])

    return rows.mapInArrow(batches, T.StructType([*rows.schema, T.StructField(text_col, T.StringType())]))


def op6_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, check="round_trip").select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_xxhash64"), "round_trip")
