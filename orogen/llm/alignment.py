"""Cross-tokenizer alignment: which tokens of one tokenizer stand where those of another do.

A text is encoded by a byte-level BPE (A) and by a SentencePiece model (B), both over a space and the text. No token of either reaches
over the end of a word that a space follows, so a text is a row of such segments. All that Python does is to tokenise: texts
are taken in blocks of bounded size, and for each distinct segment of a block it gives the ids and the byte offsets where each
token ends, and how often the segment stands there; a text is the numbers of its segments. From there on everything is Spark's
higher-order functions, once for each distinct segment of a block: `array_intersect` of the two arrays of ends gives the
offsets where both end, which cut the tokens into groups; how many tokens lie before a cut is its place in the array of ends (in
long arrays, in a sorted merge of ends and cuts); `sequence`, `transform` and `slice` make the groups and their links, `aggregate`
adds up what the segments of a text have. A link is a pair of tokens whose bytes overlap: one for each stretch between
neighbouring ends, of either side, so a text has as many as it has tokens of both, less its groups.

The count of an id pair is how often it is linked in the whole corpus. Links are counted with map-side combine. Pairs that make
up one 524,288th of all links or more are at most so many, so they are broadcast (as are all pairs, if they are no more than
that); the links of all other pairs are shuffled, and none of those is frequent enough to weigh on one task. Each segment's sums
over its links go back to the texts of its block.

Null and empty texts have no tokens, nor have texts whose joined token bytes (of A or of B) differ from a space and the text,
such as those with the mark U+2581 itself; their counts are 0 and their digest is the empty string. Special tokens' strings in a
text are plain text. Ties: all pairs with a B id's highest count are best. Repeated rows and rows without an id keep a result each
and count each time. An empty table gives an empty result. A text and its tokens are held whole by one task, and so is a
block of some 24 MB of text. Further columns are not read, whatever their names. Tokenizers' files are parameters, read on the driver and sent to the tasks.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import cut, ensure_checkpoint_dir, slices, table

BYTES = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs with this share of all links or more are broadcast: at most so many are.
SHARE = 1 << 19
#: Ids of B up to which their highest counts are broadcast, one row each.
BROADCAST_IDS = 1 << 20
#: Tokens of a segment up to which a cut's place is counted and not merged.
FEW = 24
#: Bytes of segments and their tokens that are remembered from text to text in each of two generations.
REMEMBERED = 96 << 20
#: Bytes of text whose distinct segments are tokenised and aligned once.
BLOCK_BYTES = 24 << 20
SLICE = 1 << 20
#: Segments that are encoded as one text.
BLOCK = 1000
_MARK = "▁"
#: Blanks with what follows up to a space after a word. Spaces alone at the end stay with the word before them.
_SEGMENTS = re.compile(r"\s+\S*(?:[^\S ]\s*\S*)*(?: +\Z)?")
#: Texts in which a space does not always follow a word, or that end in a blank; blanks are those of Python's `\s`.
_BLANK = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN = rf"\A |{_BLANK} |{_BLANK}\z|\A\z"
#: Of one side: the ids and end offsets of all segments, and how many tokens each segment has.
Side = tuple[np.ndarray, np.ndarray, np.ndarray]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokens:
    """A: a byte-level BPE of the tokenizers library; special tokens are plain text."""

    def __init__(self, source: bytes):
        text = source.decode()
        self.own = tokenizers.Tokenizer.from_str(text)
        self.own.encode_special_tokens = True
        self.own.no_truncation()
        self.own.no_padding()
        spec, alphabet = json.loads(text), byte_alphabet()
        if spec["normalizer"] is not None:
            raise ValueError("a normaliser changes the text's bytes")
        known = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelt = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.spelt[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()

    def encode(self, runs: list[str]) -> list[list[int]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        return [e.ids for e in self.own.encode_batch_fast(runs, add_special_tokens=False)]


class PieceTokens:
    """B: a SentencePiece model, which puts a space in front itself. No piece reaches from a word over the space after it."""

    def __init__(self, source: bytes):
        self.own = own = sentencepiece.SentencePieceProcessor(model_proto=source)
        pieces = [own.id_to_piece(i) for i in range(own.get_piece_size())]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError("a piece reaches over a word's end")
        self.spelt = [bytes([int(p[1:-1], 16)]) if own.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, runs: list[str]) -> list[list[int]]:
        return self.own.encode([r[1:] for r in runs], num_threads=1)


class Segments:
    """Tokens of segments."""

    def __init__(self, sides: Sequence[ByteTokens | PieceTokens]):
        self.sides = sides
        self.sizes = [np.array([len(s) for s in side.spelt], dtype=np.int32) for side in sides]
        # of single texts, each segment encoded once while it is remembered: ids and end offsets of both sides as bytes, and the
        # joined bytes of each where they are not the segment's own
        self.young: dict[str, tuple[list[bytes], list[bytes] | None]] = {}
        self.old, self.held = {}, 0

    def _joined(self, block: list[str]) -> list[Side] | None:
        """Encodes segments as one text, in which each but the last is followed by a space; None if a side's bytes are not the text's or a token reaches over an end."""
        raw = [s.encode() for s in block]
        text, whole = "".join(block), b"".join(raw)
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        stops = np.cumsum(lengths)
        both = []
        for side, sizes in zip(self.sides, self.sizes, strict=True):
            ids = side.encode([text])[0]
            spelt = side.spelt
            if b"".join([spelt[i] for i in ids]) != whole:
                return None
            flat = np.array(ids, dtype=np.int32)
            ends = np.cumsum(sizes[flat], dtype=np.int64)
            cuts = np.searchsorted(ends, stops, "right")
            if (ends[cuts - 1] != stops).any():
                return None
            counts = np.diff(cuts, prepend=0)
            both.append((flat, (ends - np.repeat(stops - lengths, counts)).astype(np.int32), counts))
        return both

    def _each(self, new: list[str]) -> tuple[list[Side], dict[int, list[bytes]]]:
        """Encodes each segment alone; also the joined bytes of both sides for those where they are not the segment's own."""
        both, joined = [], []
        for side, sizes in zip(self.sides, self.sizes, strict=True):
            ids = side.encode(new)
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32)
            counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            stops = np.concatenate([[0], np.cumsum(counts)])
            ends = np.concatenate([[0], np.cumsum(sizes[flat], dtype=np.int64)])
            both.append((flat, (ends[1:] - np.repeat(ends[stops[:-1]], counts)).astype(np.int32), counts))
            joined.append([b"".join([side.spelt[i] for i in one]) for one in ids])
        return both, {k: [a, b] for k, (s, a, b) in enumerate(zip(new, *joined, strict=True)) if not a == s.encode() == b}

    def all_of(self, segments: list[str]) -> tuple[list[Side], dict[int, list[bytes]]]:
        """Both sides of many segments, and the joined bytes of both for those (by place) where they are not the segment's own."""
        parts, odd = [[np.zeros(0, np.int32)] for _ in range(6)], {}
        for at in range(0, len(segments), BLOCK):
            block = segments[at : at + BLOCK]
            # blanks at a segment's end would run into the next one
            both = None if any(s[-1].isspace() for s in block) else self._joined(block)
            if both is None:
                both, other = self._each(block)
                odd |= {at + k: joined for k, joined in other.items()}
            for part, values in zip(parts, chain.from_iterable(both), strict=True):
                part.append(values.astype(np.int32))
        whole = [np.concatenate(parts.pop(0)) for _ in range(6)]
        return [tuple(whole[:3]), tuple(whole[3:])], odd

    def _remember(self, segments: list[str], both: list[Side], odd: dict[int, list[bytes]]) -> None:
        four = []
        for flat, ends, counts in both:
            places = (4 * np.cumsum(counts)).tolist()
            for data in (flat.tobytes(), ends.tobytes()):
                four.append([data[i:j] for i, j in zip([0, *places], places, strict=False)])
        self.young.update((s, (list(known), odd.get(k))) for k, (s, known) in enumerate(zip(segments, zip(*four, strict=True), strict=True)))

    def _learn_each(self, new: list[str]) -> None:
        self._remember(new, *self._each(new))

    def _learn(self, segments: list[str]) -> None:
        old = self.old
        self.young.update((s, old[s]) for s in segments if s in old)
        new = [s for s in segments if s not in old]
        whole = [s for s in new if not s[-1].isspace()]
        alone = [s for s in new if s[-1].isspace()] if len(whole) < len(new) else []
        for some in (whole, alone):
            self._remember(some, *self.all_of(some))
        self.held += sum(480 + len(s) + sum(map(len, self.young[s][0])) for s in segments)  # with what Python adds to each

    def of(self, text: str) -> tuple[list[list[bytes]], list[int]] | None:
        """(the distinct segments' ids and ends, the number of each segment in order); None if a side's bytes are not the text's."""
        if self.held > REMEMBERED:
            self.old, self.young, self.held = self.young, {}, 0
        whole = " " + text
        found = _SEGMENTS.findall(whole)
        number = {s: k for k, s in enumerate(dict.fromkeys(found))}
        young = self.young
        if new := [s for s in number if s not in young]:
            self._learn(new)
        known = [young[s] for s in number]
        if any(odd for _, odd in known):
            for side in (0, 1):
                if b"".join([s.encode() if young[s][1] is None else young[s][1][side] for s in found]) != whole.encode():
                    return None
        return [k for k, _ in known], [number[s] for s in found]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


#: The tokenizers that this worker has built, for the files they came from.
_built: list = []


def _tokenizers(sources: tuple[bytes, bytes]) -> tuple[ByteTokens, PieceTokens]:
    if not _built or _built[0] != sources:
        _built[:] = [sources, (ByteTokens(sources[0]), PieceTokens(sources[1]))]
    return _built[1]


def cut_texts(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(an order of the texts, their distinct segments, the number of each segment text by text in that order, how many each text has)."""
    texts = pc.fill_null(texts, "")
    uneven = pc.match_substring_regex(texts, _UNEVEN)
    even = pc.split_pattern(texts.filter(pc.invert(uneven)), " ")
    # every segment begins with a space, which is left out meanwhile
    other = [[s[1:] for s in _SEGMENTS.findall(f" {t}")] if t else [] for t in texts.filter(uneven).to_pylist()]
    coded = pa.concat_arrays([even.flatten(), pa.array(list(chain.from_iterable(other)), type=texts.type)]).dictionary_encode()
    order = np.argsort(uneven.to_numpy(zero_copy_only=False), kind="stable")
    counts = np.concatenate([pc.list_value_length(even).to_numpy(zero_copy_only=False).astype(np.int64), np.array([len(o) for o in other], dtype=np.int64)])
    return order, [f" {s}" for s in coded.dictionary.to_pylist()], coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), counts


def _listed(lengths: np.ndarray | list[int], values: pa.Array | np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), values)


def _block(segments: Segments, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    order, distinct, numbers, counts = cut_texts(texts)
    pa.default_memory_pool().release_unused()
    both, odd = segments.all_of(distinct)
    whole = np.ones(len(counts), dtype=bool)
    if odd:
        ends = np.cumsum(counts)
        for k in np.unique(np.searchsorted(ends, np.flatnonzero(np.isin(numbers, list(odd))), "right")).tolist():
            own = numbers[ends[k] - counts[k] : ends[k]].tolist()
            text = b"".join([distinct[n].encode() for n in own])
            whole[k] = all(b"".join([odd[n][side] if n in odd else distinct[n].encode() for n in own]) == text for side in (0, 1))
        numbers, counts = numbers[np.repeat(whole, counts)], np.where(whole, counts, 0)
    stops = np.concatenate([[0], np.cumsum(counts)])
    sums = [np.diff(np.concatenate([[0], np.cumsum(n[numbers], dtype=np.int64)])[stops]) for _, _, n in both]
    docs = pa.StructArray.from_arrays([ids.take(pa.array(order)), *map(pa.array, sums), _listed(counts, numbers)], ["id", "n_a", "n_b", "numbers"])
    lists = [_listed(n, values) for *two, n in both for values in two]
    times = pa.array(np.bincount(numbers, minlength=len(distinct)).astype(np.int32))
    known = pa.StructArray.from_arrays([*lists, times], ["a_ids", "a_ends", "b_ids", "b_ends", "times"])
    return pa.RecordBatch.from_arrays([_listed([len(docs)], docs), _listed([len(known)], known)], ["docs", "segments"])


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = BYTES, b: str = PIECES) -> DataFrame:
    """(docs, segments) per block of texts.

    `docs` has (id, n_a, n_b, numbers) of each text: how many tokens it has and the 0-based number of each of its segments in order;
    without tokens they are 0 and empty. `segments` has (a_ids, a_ends, b_ids, b_ends, times) of each distinct segment of the block.
    """
    shared = docs.sparkSession.sparkContext.broadcast((_read(a), _read(b)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, held, size = Segments(_tokenizers(shared.value)), [], 0

        def block() -> pa.RecordBatch:
            ids, texts = (pa.concat_arrays([p.column(k) for p in held]) for k in (0, 1))
            held.clear()
            return _block(segments, ids, texts)

        for piece in chain.from_iterable(slices(batch, 1, SLICE) for batch in parts):
            held.append(piece)
            size += piece.column(1).nbytes
            if size >= BLOCK_BYTES:
                yield block()
                size = 0
        if held:
            yield block()

    kind = rows.schema["id"].dataType.simpleString()
    lists = ", ".join(f"{c}: array<int>" for c in ("a_ids", "a_ends", "b_ids", "b_ends"))
    return rows.mapInArrow(batches, f"docs array<struct<id: {kind}, n_a: bigint, n_b: bigint, numbers: array<int>>>, segments array<struct<{lists}, times: int>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is made once, however often a lambda in it uses it."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def _up_to(ends: Column, cuts: Column) -> Column:
    """How many of the rising `ends` lie at or before each of the rising `cuts`: a cut's place in the merge of both, less the cuts before it."""
    merged = F.sort_array(F.concat(F.transform(ends, lambda e: e.cast("long") * 2), F.transform(cuts, lambda c: c.cast("long") * 2 + 1)))
    places = F.filter(F.transform(merged, lambda v, p: F.when(v % 2 == 1, p)), lambda p: p.isNotNull())
    return F.transform(places, lambda p, k: p - k)


def _groups(a_ids: Column, a_ends: Column, b_ids: Column, b_ends: Column) -> Column:
    """An array of (a, b, a_from, b_from): the ids between neighbouring offsets where both sides end, and how many tokens come before them."""
    few = (F.size(a_ends) <= FEW) & (F.size(b_ends) <= FEW)

    def of(cuts: Column) -> Column:
        # in a short array the ends up to a cut are counted (array_position took longer), in a long one it is merged
        before = lambda ends, e: F.size(F.filter(ends, lambda x: x <= e))
        looked = F.transform(cuts, lambda e: F.struct(before(a_ends, e).alias("a"), before(b_ends, e).alias("b")))
        merged = F.zip_with(_up_to(a_ends, cuts), _up_to(b_ends, cuts), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return _let(F.when(few, looked).otherwise(merged), lambda upto: F.transform(F.sequence(F.lit(0), F.size(cuts) - 1), lambda k: _let(F.struct(F.get(upto, k).alias("to"), F.get(upto, k - 1).alias("from")), group)))

    def group(u: Column) -> Column:
        a, b = (F.coalesce(u["from"][side], F.lit(0)) for side in "ab")
        return F.struct(F.slice(a_ids, a + 1, u["to"]["a"] - a).alias("a"), F.slice(b_ids, b + 1, u["to"]["b"] - b).alias("b"), a.alias("a_from"), b.alias("b_from"))

    return _let(F.array_intersect(a_ends, b_ends), of)


def _pair(a: Column, b: Column) -> Column:
    return F.shiftleft(a.cast("long"), 32).bitwiseOR(b.cast("long"))


def _met(a_ids: Column, a_ends: Column, b_ids: Column, b_ends: Column) -> Column:
    """The id pairs of tokens that meet in a group: one for every stretch between neighbouring ends of either side."""
    keyed = lambda ends, side: F.transform(ends, lambda e, i: F.shiftleft(e.cast("long") * 2 + side, 32).bitwiseOR(i.cast("long")))
    merged = F.sort_array(F.concat(keyed(a_ends, 0), keyed(b_ends, 1)))

    def of(both: Column) -> Column:
        def link(v: Column, p: Column) -> Column:
            own = v.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")
            ends_with_a = (p > 0) & (F.shiftright(F.get(both, p - 1), 33) == F.shiftright(v, 33))
            pair = lambda i, j: _pair(F.get(a_ids, i), F.get(b_ids, j))
            return F.when(F.shiftright(v, 32) % 2 == 0, pair(own, p - own)).when(~ends_with_a, pair(p - own, own))

        return F.filter(F.transform(both, link), lambda x: x.isNotNull())

    return _let(merged, of)


def _links(groups: Column, a_ends: Column, b_ends: Column) -> Column:
    """An array of linked id pairs, each a * 2**32 + b. Where a side has one token in a group, it meets all of the other side."""

    def of(g: Column) -> Column:
        p, q = F.size(g["a"]), F.size(g["b"])
        one_a = F.transform(g["b"], lambda b: _pair(F.get(g["a"], F.lit(0)), b))
        one_b = F.transform(g["a"], lambda a: _pair(a, F.get(g["b"], F.lit(0))))
        return F.when(p == 1, one_a).when(q == 1, one_b).otherwise(_met(g["a"], F.slice(a_ends, g["a_from"] + 1, p), g["b"], F.slice(b_ends, g["b_from"] + 1, q)))

    return F.flatten(F.transform(groups, of))


def _of_segment(s: Column, body: Callable[[Column, Column], Column]) -> Column:
    """`body` of a segment's groups and links."""
    groups = _groups(s["a_ids"], s["a_ends"], s["b_ids"], s["b_ends"])
    return _let(groups, lambda g: body(g, _links(g, s["a_ends"], s["b_ends"])))


def align(tokenised: DataFrame) -> DataFrame:
    """`tokens` with, for each distinct segment, `groups` (an array of (a, b) id arrays) and `links` (an array of id pairs)."""
    aligned = F.transform("segments", lambda s: _of_segment(s, lambda g, links: F.struct(g.alias("groups"), links.alias("links"))))
    return tokenised.withColumn("aligned", aligned).select("docs", "segments", "aligned.groups", "aligned.links")


def spelt(groups: Column) -> Column:
    """Groups as text: `a1,a2|b1;a3|b2,b3`."""
    side = lambda ids: F.array_join(ids.cast("array<string>"), ",")
    return F.array_join(F.transform(groups, lambda g: F.concat(side(g["a"]), F.lit("|"), side(g["b"]))), ";")


def pair_counts(links: DataFrame, b_ids: int) -> DataFrame:
    """(pair, n, best: 1 if no other pair of its B id has a higher n) of links (pair, times)."""
    counts = cut(links.groupBy("pair").agg(F.sum("times").alias("n")))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    best = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    best = F.broadcast(best) if b_ids <= BROADCAST_IDS else best
    return counts.withColumn("b", b).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def _parts(tokenised: DataFrame) -> DataFrame:
    """A row for each block (docs: id, n_a, n_b, n_groups, groups_sha256, numbers of each text) and one for each of its distinct segments (k, times, links)."""
    made = F.transform("segments", lambda s: _of_segment(s, lambda g, links: F.struct(spelt(g).alias("text"), F.size(g).alias("n"), links.alias("links"), s["times"].alias("times"))))

    def text(d: Column) -> Column:
        parts = F.transform(d["numbers"], lambda k: F.get("made", k)["text"])
        n = F.aggregate(d["numbers"], F.lit(0).cast("long"), lambda so_far, k: so_far + F.get("made", k)["n"])
        digest = F.when(F.size(d["numbers"]) > 0, F.sha2(F.array_join(parts, ";"), 256)).otherwise("")
        return F.struct(d["id"].alias("id"), d["n_a"].alias("n_a"), d["n_b"].alias("n_b"), n.alias("n_groups"), digest.alias("groups_sha256"), d["numbers"].alias("numbers"))

    docs, none = F.transform("docs", text), F.lit(None)
    whole = F.array(F.struct(docs.alias("docs"), none.cast("int").alias("k"), none.cast("int").alias("times"), none.cast("array<long>").alias("links")))
    kind = tokenised.schema["docs"].dataType.elementType["id"].dataType.simpleString()
    no_docs = none.cast(f"array<struct<id: {kind}, n_a: bigint, n_b: bigint, n_groups: bigint, groups_sha256: string, numbers: array<int>>>")
    each = F.transform("made", lambda s, k: F.struct(no_docs.alias("docs"), k.alias("k"), s["times"].alias("times"), s["links"].alias("links")))
    both = F.concat(whole, each)
    return tokenised.select("docs", made.alias("made"), F.monotonically_increasing_id().alias("block")).select("block", F.inline(both))


def alignment_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = BYTES, b: str = PIECES) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/alignment-{uuid.uuid4().hex}"
    # written once, so that the numbers of blocks hold
    _parts(tokens(docs, id_col, text_col, a, b)).write.option("compression", "zstd").parquet(place)
    rows = spark.read.parquet(place)
    texts, segments = rows.where("k IS NULL"), rows.where("k IS NOT NULL")

    counts = cut(pair_counts(segments.select(F.explode("links").alias("pair"), "times"), sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()))
    total, pairs = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = F.col("n") >= (-(-total // SHARE) if pairs > SHARE else 0)
    each = segments.select("block", "k", F.explode("links").alias("pair"))
    head, tail = F.broadcast(counts.where(frequent)), counts.where(~frequent)
    scored = each.join(head, "pair")
    if pairs > SHARE:
        scored = scored.union(each.join(head.select("pair"), "pair", "left_anti").join(tail, "pair").select(*scored.columns))
    sums = scored.groupBy("block", "k").agg(F.sum("n").alias("n"), F.sum("best").alias("best"))
    # a block's segments in order, for the numbers that its texts have
    listed = sums.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("k", "n", "best"))).alias("s")).select("block", F.col("s.n").alias("ns"), F.col("s.best").alias("bests"))

    def scores(d: Column) -> Column:
        added = lambda of: F.aggregate(d["numbers"], F.lit(0).cast("long"), lambda so_far, k: so_far + F.get(of, k))
        return F.struct(d.alias("d"), added("bests").alias("n_best"), added("ns").alias("count_sum"))

    # joined by block, as each joined row holds the sums of all its segments
    joined = texts.join(listed, "block", "left").select(F.inline(F.transform("docs", scores))).select("d.*", "n_best", "count_sum")
    linked = F.col("n_a") + F.col("n_b") - F.col("n_groups")
    return joined.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", linked.alias("n_links"), "n_best", "count_sum", "groups_sha256")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_scores(table(spark, sf_dir, "documents"))
