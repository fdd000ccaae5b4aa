"""Embedding near-dedup by lattice hashing on E8.

A table projects a unit vector onto two random orthonormal 8-spaces, adds a random shift and decodes
each to the nearest point of the E8 lattice; the pair of points is the vector's cell. A vector is
posted in its own cell and in the neighbouring cells its residues lean towards, in several tables.
Vectors that meet in a cell are compared by cosine in double precision; a link is counted only
in the first cell that its two vectors share, so no list of pairs is kept: each cell gives counts
of links and a spanning forest of its linked vectors.

Equal vectors are one node with a weight. A cell that outgrows `CHUNK` is dealt into chunks by hash
and each pair of chunks is compared on its own, so no task holds an unbounded cell and none is cut.
The cells are the same at every size.

Null or zero vectors, and those with null or non-finite components, link with nothing; vectors of
different length never meet. Rows without an id have links like any other and are counted by them, but never name a component
and are never kept; their component is null if no row of it has an id. A repeated id should repeat its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import components, cut, table

THRESHOLD = 0.95
TABLES = 3
BLOCKS = 2
#: Length of a lattice unit on the projected unit sphere.
UNIT = 0.25
#: Cells a vector is posted in, per table.
POSTS = 5
CHUNK = 1024
SEED = 8


def _shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two of +-1, or eight of +-1/2 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for signs in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            out.append(v)
    halves = np.array(list(product((0.5, -0.5), repeat=8)))
    return np.concatenate([np.array(out), halves[(halves < 0).sum(1) % 2 == 0]])


_NEIGHBOURS = _shortest_vectors()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd re-round the least certain coordinate."""
    near = np.rint(x)
    rest = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(rest[odd]).argmax(1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def _mixed(points: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """64-bit hash of doubled lattice points (last axis), continuing from `start`."""
    h = np.zeros(points.shape[:-1], np.uint64) + np.uint64(start) if np.isscalar(start) else start
    for k in range(points.shape[-1]):
        h = (h ^ (points[..., k].astype(np.int64).view(np.uint64))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def cells(unit: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, scale: float = UNIT, posts: int = POSTS) -> np.ndarray:
    """(vectors, tables, posts) cell ids of unit vectors."""
    size = unit.shape[1]
    rng = np.random.default_rng([SEED, size])
    out = []
    for t in range(tables):
        h, cost = None, None
        for _ in range(blocks):
            axes = np.linalg.qr(rng.normal(size=(max(size, 8), 8)))[0][:size]
            x = unit @ axes * np.sqrt(size / 64) / scale + rng.uniform(0, 1, 8)
            home = nearest_e8(x)
            lean = (x - home) @ _NEIGHBOURS.T
            best = np.argsort(-lean, axis=1)[:, : posts - 1]
            points = np.concatenate([home[:, None], home[:, None] + _NEIGHBOURS[best]], 1) * 2
            # how much farther than its own point each neighbour is
            far = np.concatenate([np.zeros((len(x), 1)), 2 - 2 * np.take_along_axis(lean, best, 1)], 1)
            if h is None:
                h, cost = _mixed(points, (t + 1) * 1000 + size), far
            else:
                h = _mixed(np.repeat(points[:, None], h.shape[1], 1), np.repeat(h[:, :, None], posts, 2)).reshape(len(x), -1)
                cost = (cost[:, :, None] + far[:, None, :]).reshape(len(x), -1)
                keep = np.argsort(cost, axis=1, kind="stable")[:, :posts]
                h, cost = np.take_along_axis(h, keep, 1), np.take_along_axis(cost, keep, 1)
        out.append(h[:, :posts])
    return np.stack(out, 1)


def _units(vectors: pa.Array) -> np.ndarray:
    """Rows of equal length, in double precision, scaled to length one (twice, for very large or small ones)."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _posted(tables: int, blocks: int, scale: float, posts: int):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            length = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for size in np.unique(length):
                rows = batch.filter(pa.array(length == size))
                for at in range(0, rows.num_rows, 2000):
                    part = rows.slice(at, 2000)
                    codes = cells(_units(part.column(1)), tables, blocks, scale, posts).view(np.int64)
                    flat = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * (tables * posts), codes.ravel())
                    yield pa.RecordBatch.from_arrays([part.column(0), flat], ["rep", "cells"])

    return batches


def _first_met(codes: np.ndarray, i: np.ndarray, j: np.ndarray, cell: int) -> np.ndarray:
    """Whether `cell` is the first one, by table and then by id, that the vectors of each pair share."""
    a, b = codes[i], codes[j]  # (pairs, tables, posts)
    at = int(np.flatnonzero((codes[i[0]] == cell).any(1))[0])
    before = np.zeros(len(i), dtype=bool)
    for t in range(at + 1):
        for p in range(codes.shape[2]):
            same = a[:, t, p, None] == b[:, t]
            before |= (same & (b[:, t] < cell)).any(1) if t == at else same.any(1)
    return ~before


def _linked(rep: np.ndarray, weight: np.ndarray, unit: np.ndarray, codes: np.ndarray, chunk: np.ndarray, cell: int, threshold: float):
    """Per group of one cell and pair of chunks: (rep, links first met here) and the forest's edges."""
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    if len(np.unique(chunk)) > 1:
        near &= chunk[:, None] != chunk
    i, j = np.nonzero(np.triu(near))
    links = np.zeros(len(rep), dtype=np.int64)
    for at in range(0, len(i), 100_000):
        a, b = i[at : at + 100_000], j[at : at + 100_000]
        first = _first_met(codes, a, b, cell)
        np.add.at(links, a[first], weight[b[first]])
        np.add.at(links, b[first], weight[a[first]])
    lefts, rights = [], []
    rest = near.any(1)
    while rest.any():
        root = front = np.flatnonzero(rest)[:1]
        rest[front] = False
        while len(front):
            front = np.flatnonzero(near[front].any(0) & rest)
            rest[front] = False
            lefts.append(rep[front])
            rights.append(np.repeat(rep[root], len(front)))
    none = np.zeros(0, dtype=rep.dtype)
    return links, np.concatenate([none, *lefts]), np.concatenate([none, *rights])


def _compared(tables: int, posts: int, threshold: float):
    """Groups (cell, low, high) of sorted rows; the last group of a batch may go on in the next one."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.combine_chunks()
            keys = np.stack([rows[c].to_numpy().astype(np.int64) for c in ("cell", "low", "high")], 1)
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(keys, axis=0) != 0).any(1)]))
            found = []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
                if e - s < 2:
                    continue
                group = rows.slice(s, e - s).combine_chunks()
                rep, weight, chunk = (group[c].to_numpy() for c in ("rep", "weight", "chunk"))
                codes = group["cells"].combine_chunks().flatten().to_numpy().reshape(e - s, tables, posts)
                unit = _units(group["v"].combine_chunks())
                links, left, right = _linked(rep, weight, unit, codes, chunk, int(keys[s, 0]), threshold)
                some = links > 0
                found += [(rep[some], rep[some], links[some]), (left, right, np.zeros(len(left), np.int64))]
            if found:
                cols = [np.concatenate(x) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["a", "b", "n"])

        for batch in parts:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows:
                last = {c: held[c][-1].as_py() for c in ("cell", "low", "high")}
                same = np.logical_and.reduce([held[c].to_numpy() == last[c] for c in last])
                whole = int(np.flatnonzero(same)[0])
                if whole:
                    yield from done(held.slice(0, whole))
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from done(held)

    return batches


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = UNIT,
    posts: int = POSTS,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) per row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast("double")))
    usable = F.coalesce(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # one node for each vector, known by 128 bits of it; it may have no id, so it has a number of its own
    keyed = rows.withColumn("k", F.when(usable, F.struct(F.xxhash64("v").alias("x"), F.xxhash64(F.lit(1), "v").alias("y"))))
    nodes = keyed.where("k is not null").groupBy("k").agg(F.min("id").alias("first_id"), F.count("*").alias("weight"), F.first("v").alias("v"))
    nodes = cut(nodes.withColumn("rep", F.monotonically_increasing_id()))
    posted = cut(nodes.select("rep", "v").mapInArrow(_posted(tables, blocks, scale, posts), "rep long, cells array<long>"))
    posts_of = posted.select("rep", "cells", F.explode("cells").alias("cell"))
    shared = posts_of.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    dealt = (
        posts_of.join(shared, "cell")
        .withColumn("chunks", chunks)
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        .select("cell", "rep", "cells", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("cell", "rep", "cells", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
        .join(nodes.select("rep", "weight", "v"), "rep")
    )
    key = ["cell", "low", "high"]
    compared = cut(dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_compared(tables, posts, threshold), "a long, b long, n long"))
    counts = compared.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    roots = components(compared.where("n = 0").select("a", "b")).withColumnRenamed("node", "rep")
    rooted = nodes.select("k", "rep", "first_id", "weight").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = (
        rooted.join(counts, "rep", "left")
        .join(least, "root")
        .select("k", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    )
    return keyed.select("id", "k").join(named, "k", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"),
    )


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
