"""Token ids packed into fixed rows: best-fit-decreasing with a segment tree over capacities.

Texts are encoded by byte-level BPE, an end id closes each document, and documents longer than a row are split
into pieces without loss. The pieces of a task's documents are packed, at most `SHARD_TOKENS` at
a time: longest first, each into the row whose free capacity is the smallest that holds it, which a
segment tree over capacities finds in logarithmic time. Nothing is shuffled. Two rows that are at most half full would have been
one, so a shard wastes little more than half a row beside what its pieces cannot fill; a source of very many tiny splits
should be coalesced first. A packed row has its ids as little-endian binary, padded to the row's length,
the cumulative segment lengths, and positions that restart with each segment.

BPE never joins a character to blanks after it, so texts are encoded in runs of blanks with the
word after them, each distinct run once. Null and empty texts have one token, the end id; repeated rows and
rows without an id are packed like any other: each row of the input has a number of its own, by which its pieces are put together. The vocabulary's file is a parameter, read on the driver.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import slices, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
LENGTH = 2048
SHARD_TOKENS = 4_000_000
#: Bytes of runs and their ids that a task remembers before it starts afresh.
REMEMBERED = 48 << 20
SLICE = 2 << 20

#: How the public vocabulary cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The white space of that pattern.
_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUNS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Tokens:
    """Encodes whole texts; remembers the runs it has met."""

    def __init__(self, ranks: dict[bytes, int], kind: np.dtype):
        self.own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind, self.known, self.held = kind, {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        rows = [_RUNS.findall(t) for t in texts]
        new = set().union(*rows).difference(self.known)
        if self.held > REMEMBERED:
            self.known.clear()
            self.held, new = 0, set().union(*rows)
        of, kind = self.own.encode_ordinary, self.kind
        self.known.update((run, np.array(of(run), dtype=kind).tobytes()) for run in new)
        self.held += sum(180 + len(run) + len(self.known[run]) for run in new)  # with what Python adds to each
        return [b"".join(map(self.known.__getitem__, row)) for row in rows]


class Capacities:
    """Rows by free capacity: a segment tree over the capacities 0 to `most` says where any are."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = self.leaves + capacity
        while at and not self.some[at]:
            self.some[at] = 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) with the smallest capacity of at least `least`, removed; None if there is none."""
        some, at = self.some, self.leaves + least
        while not some[at]:  # climb until a right neighbour has rows, then go down to its leftmost
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if some[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            some[at] = 0
            while at > 1 and not some[at ^ 1]:
                at >>= 1
                some[at] = 0
        return capacity, row


def best_fit_decreasing(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Rows of item numbers; items are taken longest first (ties: in order)."""
    free, rows = Capacities(most), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        got = free.take(size)
        if got is None:
            rows.append([item])
            left, row = most - size, len(rows) - 1
        else:
            rows[got[1]].append(item)
            left, row = got[0] - size, got[1]
        if left:
            free.add(left, row)
    return rows


def _packed(pieces: list[tuple[object, int, int, bytes]], shard: int, length: int, kind: np.dtype, end: int) -> Iterator[list[object]]:
    sizes = np.array([len(p[3]) // kind.itemsize for p in pieces], dtype=np.int64)
    count = np.arange(length, dtype=np.uint16 if length < 1 << 16 else np.int32)
    for row, items in enumerate(best_fit_decreasing(sizes, length)):
        ids = b"".join([pieces[i][3] for i in items])
        ends = np.cumsum(sizes[items])
        fill = np.full(length - int(ends[-1]), end, dtype=kind).tobytes()
        places = np.concatenate([*(count[: sizes[i]] for i in items), np.zeros(len(fill) // kind.itemsize, count.dtype)])
        yield [shard, row, int(ends[-1]), [pieces[i][0] for i in items], [pieces[i][1] for i in items], [pieces[i][2] for i in items], [0, *ends.tolist()], ids + fill, places.tobytes()]


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, ranks: dict[bytes, int] | None = None, end: int = END
) -> DataFrame:
    """(shard, row, n_tokens, doc_ids, doc_rows, pieces, cu_seqlens, ids, positions): one row for each packed row.

    `doc_rows` numbers the rows of `docs`, `pieces` the pieces of split documents. Ids take two bytes each if the vocabulary allows, else four; so do positions.
    """
    ranks = ranks or read_ranks()
    kind = np.dtype("<u2" if max(end, len(ranks)) < 1 << 16 else "<i4")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_kind = rows.schema["id"].dataType
    names = ["shard", "row", "n_tokens", "doc_ids", "doc_rows", "pieces", "cu_seqlens", "ids", "positions"]
    small = [pa.int64(), pa.int32(), pa.int32(), None, pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(shared.value, kind)
        close, width = np.array([end], kind).tobytes(), length * kind.itemsize
        waiting: list[tuple[object, int, int, bytes]] = []
        part = TaskContext.get().partitionId()
        held, shard, number, id_type = 0, part << 24, part << 33, None

        def flushed() -> Iterator[pa.RecordBatch]:
            made = list(_packed(waiting, shard, length, kind, end))
            for at in range(0, len(made), 256):
                columns = zip(*made[at : at + 256], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t or pa.list_(id_type)) for c, t in zip(columns, small, strict=True)], names)

        for batch in parts:
            for piece in slices(batch, 1, SLICE):
                id_type = piece.schema.field(0).type
                for doc, ids in zip(piece.column(0).to_pylist(), tokens.encode([t or "" for t in piece.column(1).to_pylist()]), strict=True):
                    ids += close
                    waiting += [(doc, number, n, ids[at : at + width]) for n, at in enumerate(range(0, len(ids), width))]
                    number += 1
                    held += len(ids) // kind.itemsize
                if held >= SHARD_TOKENS:
                    yield from flushed()
                    waiting, held, shard = [], 0, shard + 1
        if waiting:
            yield from flushed()

    return rows.mapInArrow(
        batches,
        f"shard long, row int, n_tokens int, doc_ids array<{id_kind.simpleString()}>, doc_rows array<long>, pieces array<int>, cu_seqlens array<int>, ids binary, positions binary",
    )


def unpack(packed: DataFrame, bytes_per_id: int = 2) -> DataFrame:
    """(doc_id, ids: binary) for each row that was packed: its ids again, pieces in order and end ids kept."""
    at = F.posexplode(F.arrays_zip("doc_ids", "doc_rows", "pieces")).alias("k", "of")
    parts = packed.select("ids", "cu_seqlens", at).select(
        F.col("of.doc_ids").alias("doc_id"),
        F.col("of.doc_rows").alias("doc_row"),
        F.col("of.pieces").alias("piece"),
        F.expr(f"substring(ids, cu_seqlens[k] * {bytes_per_id} + 1, (cu_seqlens[k + 1] - cu_seqlens[k]) * {bytes_per_id})").alias("part"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("piece", "part")))
    whole = F.aggregate(ordered, F.lit(b""), lambda all_, x: F.concat(all_, x["part"])).alias("ids")
    return parts.groupBy("doc_row").agg(F.first("doc_id").alias("doc_id"), whole).select("doc_id", "ids")


def op10_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
