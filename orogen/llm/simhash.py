"""SimHash near-dedup by a byte-position inverted index with count filtering.

The index has a posting list for each position and byte: the distinct fingerprints with that byte there. Two 64-bit
fingerprints that differ in at most `max_bits` bits share at least 8 - `max_bits` of their eight positional bytes. In a list,
the shared positional bytes of each pair are tallied; pairs that reach the guaranteed minimum are retained, and
their bits are verified.

The first shared position of a linked pair is one of the first `max_bits` + 1, the second one of the first `max_bits` + 2, and
so on. Fingerprints are posted under each choice of their first `DEPTH` shared positions with the bytes there, which splits
every list of the index alike. Lists beyond `LIST` members are split by further positions inside their task, and
lists beyond `LONG` by Spark before, up to the guaranteed minimum of positions. A list that is still long then agrees on 40
of 64 bits (`max_bits` = 3), so it has at most 2**24 members; its links are found by flipping the bits in which members
differ, not by pairs. Each batch of lists gives the edges of a spanning forest only, so a large group of near copies gives as
many edges as members.

Null, empty and blank texts have fingerprint zero and link like any other; repeated rows keep one
result each; a null id takes part but never names a component (all ids null: null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import components, cut, free_name, table

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Positions in the key of a posting, one at least.
DEPTH = 3
#: Longer lists are split by one more position inside their task.
LIST = 2048
#: Longer lists are split by one more position before they get a task.
LONG = 1 << 20
#: Pairs that are tallied at a time.
PAIRS = 1 << 19
#: Keys of long lists that may be broadcast, after they were counted; more are joined by a shuffle.
BROADCAST_KEYS = 200_000

_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)
_PLACE = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text: a bit is set if it is in over half of the shingle hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    if len(words) > shingle:
        starts = [0, *(e + 1 for e in ends[: len(words) - shingle])]
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=True)])
    else:
        hashes = xxhash.xxh64_digest(joined, SEED)
    rows = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    seen = np.bincount((rows + _PLACE).ravel(), minlength=2048).reshape(8, 256)
    ones = np.einsum("pv,vb->pb", seen, _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed long, one row for each row of `docs`."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(batches, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _posted(members: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """(key, last, fp): each member under each next position and its byte there; `depth` positions make up the key."""
    places = F.sequence(F.col("last") + 1, F.lit(depth - 1 + max_bits))

    def posting(place: Column) -> Column:
        byte = F.call_function("shiftrightunsigned", F.col("fp"), F.lit(56) - place * 8).bitwiseAND(F.lit(255))
        key = F.shiftleft("key", 11).bitwiseOR(F.shiftleft(place.cast("long"), 8)).bitwiseOR(byte)
        return F.struct(key.alias("key"), place.alias("last"))

    return members.select(F.explode(F.transform(places, posting)).alias("p"), "fp").select("p.key", "p.last", "fp")


def tallied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes each pair of fingerprints shares."""
    same = (a ^ b).view(np.uint8).reshape(-1, 8) == 0
    return same.sum(1)


def _close(fp: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs reach the minimum tally and are verified."""
    kept = np.flatnonzero(tallied(fp[i], fp[j]) >= 8 - max_bits)
    return kept[np.bitwise_count(fp[i[kept]] ^ fp[j[kept]]) <= max_bits]


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the trees of `root` that hold the ends of the links; roots are the least members, and every member points at its root."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def _flipped(members: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The links (places) of sorted distinct members, by flips of the bits in which some of them differ."""
    varies = int(np.bitwise_or.reduce(members ^ members[0]))
    bits = [np.uint64(1 << b) for b in range(64) if varies >> b & 1]
    for n in range(1, max_bits + 1):
        for flips in combinations(bits, n):
            other = members ^ np.bitwise_or.reduce(flips)
            at = np.minimum(np.searchsorted(members, other), len(members) - 1)
            i = np.flatnonzero(members[at] == other)
            yield i, at[i]


def _last(key: int) -> int:
    """The last position of a posting's key; -1 for the empty key."""
    return key >> 8 & 7 if key >= 0 else -1


def _pairs(members: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs inside lists that lie one after another in `members`, some `PAIRS` at a time."""
    partners = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(len(members))
    through = np.cumsum(partners)
    for a in range(0, int(through[-1]) if len(through) else 0, PAIRS):
        rows = np.arange(*np.searchsorted(through, [a, a + PAIRS], side="right"))
        before = through[rows] - partners[rows]
        i = np.repeat(rows, partners[rows])
        j = i + 1 + np.arange(len(i)) + before[:1].sum() - np.repeat(before, partners[rows])
        yield members[i], members[j]


def _forest(key: np.ndarray, fp: np.ndarray, depth: int, max_bits: int, longest: int) -> np.ndarray:
    """(member, its root) for what links in whole posting lists of `depth` positions, sorted by key and fingerprint."""
    root = np.arange(len(fp))
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else root
    sizes = np.diff(np.append(starts, len(key)))
    short = np.repeat(sizes <= longest, sizes)
    small = [(np.flatnonzero(short), sizes[sizes <= longest])]
    split = [(root[s : s + n].copy(), _last(int(key[s])), depth) for s, n in zip(starts[sizes > longest].tolist(), sizes[sizes > longest].tolist(), strict=True)]
    while split:
        members, last, depth = split.pop()
        if depth == 8 - max_bits:
            for i, j in _flipped(fp[members], max_bits):
                _join(root, members[i], members[j])
            continue
        for place in range(last + 1, depth + max_bits + 1):
            byte = fp[members].view(np.uint8).reshape(-1, 8)[:, 7 - place]  # little-endian
            order = np.argsort(byte, kind="stable")
            counts = np.bincount(byte, minlength=256)
            parts = np.split(members[order], np.cumsum(counts)[:-1])
            split += [(part, place, depth + 1) for part in parts if len(part) > longest]
            fine = [part for part in parts if 1 < len(part) <= longest]
            small.append((np.concatenate([root[:0], *fine]), np.array([len(part) for part in fine], dtype=np.int64)))
    for members, lengths in small:
        for i, j in _pairs(members, lengths):
            near = _close(fp, i, j, max_bits)
            _join(root, i[near], j[near])
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return np.stack([fp[linked], fp[root[linked]]], 1)


def _compared(posted: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """(a, b): the forests of posting lists."""
    longest = LIST

    def within(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def edges(k: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort((fp, k))
            found = np.unique(_forest(k[order], fp[order], depth, max_bits, longest), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, i].view(np.int64)) for i in (0, 1)], ["a", "b"])

        for batch in parts:
            k = np.concatenate([held_k, batch.column(0).to_numpy()])
            fp = np.concatenate([held_fp, batch.column(1).to_numpy().view(np.uint64)])
            whole = np.searchsorted(k, k[-1]) if len(k) else 0  # the last list may go on in the next batch
            held_k, held_fp = k[whole:], fp[whole:]
            yield edges(k[:whole], fp[:whole])
        yield edges(held_k, held_fp)

    return posted.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(within, "a long, b long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges between distinct fingerprints (column `fp`) that connect what `max_bits` connects."""
    fps = fps.select("fp").distinct()
    total, most = fps.count(), 8 - max_bits
    posted = fps.select(F.lit(0).cast("long").alias("key"), F.lit(-1).alias("last"), "fp")
    for depth in range(1, min(DEPTH, most) + 1):
        posted = _posted(posted, depth, max_bits)
    found = None
    while True:
        long = None
        if depth < most and total > LONG:  # else no list can be that long
            keys = cut(posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > LONG).select("key"))
            if count := keys.count():
                long = F.broadcast(keys) if count <= BROADCAST_KEYS else keys
        part = _compared(posted if long is None else posted.join(long, "key", "left_anti"), depth, max_bits)
        found = part if found is None else found.union(part)
        if long is None:
            return found
        depth += 1
        posted = _posted(posted.join(long, "key", "left_semi"), depth, max_bits)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(id_col, fingerprint as 16 hex digits, component_id: the smallest id reachable by links)."""
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = prints.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = components(links(classes, max_bits)).withColumnRenamed("node", "fp")
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = classes.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose id names their group; rows without an id stay."""
    named, copy = near_duplicates(docs, id_col, text_col), free_name(docs, "__copy")
    copies = named.where(f"`{id_col}` <> component_id").select(F.col(id_col).alias(copy)).distinct()
    return docs.join(copies, F.col(f"`{id_col}`") == F.col(copy), "left_anti")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
