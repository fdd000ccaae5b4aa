"""What the text operators share: word splitting on Arrow buffers, checkpoints and components.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; that is what `bytes.split()` and
Arrow's `ascii_split_whitespace` cut at, and every module here uses one of the two.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text taken into one vectorised step; bounds the memory of a Python worker.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; a temporary one only in local mode (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="orogen-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so that it is made once and survives executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or it with underscores before it, so that no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy pieces of a batch with about `limit` bytes of text each (one row at least)."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        if stop > start:
            yield batch.slice(start, stop - start)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (null: none) in order, and how many each text has."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, per_text = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(words, "")
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(per_text)
    return words.filter(real), kept[ends] - kept[ends - per_text]


def word_ids(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(id of each word, the distinct words, words per text)."""
    words, counts = split_words(texts, lower)
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, counts


def hash_words(words: pa.Array) -> np.ndarray:
    """XXH64 of each word."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words.cast(pa.binary()).to_pylist()], dtype=np.uint64)


def rolling(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of each run of `length` hashes; made by doubling, not by a loop over the run."""
    if len(hashes) < length:
        return hashes[:0]
    out, have = None, 0  # the first `have` items of each run
    block, size, power = hashes, 1, base
    while length:
        if length & 1:
            n = len(hashes) - have - size + 1
            out = block if out is None else out[:n] * np.uint64(power) + block[have : have + n]
            have += size
        length >>= 1
        if length:
            block = block[:-size] * np.uint64(power) + block[size:]
            size, power = 2 * size, power * power % 2**64
    return out


def _with_least(edges: DataFrame, parts: int) -> DataFrame:
    """Edges (a, b) with the least b of their a as m. A node's edges are dealt into `parts`, so that no hub falls to one task."""
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(parts)))
    some = dealt.groupBy("a", "part").agg(F.min("b").alias("m"))
    least = some.groupBy("a").agg(F.min("m").alias("m"), F.collect_list("part").alias("parts"))
    return dealt.join(least.select("a", F.explode("parts").alias("part"), "m"), ["a", "part"]).drop("part")


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for each node of the undirected `edges` (a, b); root is the smallest node reachable.

    Alternates the large-star and small-star steps until the edges stay the same; each round is
    checkpointed to cut its lineage. Minima are combined before they are shuffled, and hubs are dealt into parts.
    """
    stars = cut(edges.select("a", "b").where("a <> b").distinct())
    stamp = None
    for _ in range(rounds):
        parts = 16 if stamp is None else min(max(16, stamp["n"] // 100_000), 4096)
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, parts).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _with_least(down, parts)
        stars = cut(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        new = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if new == stamp:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        stamp = new
    raise RuntimeError(f"components did not settle in {rounds} rounds")
