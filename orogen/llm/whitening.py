"""Embedding whitening by upper-triangle column aggregates.

A component c of a vector becomes the integer x = floor(1024 * c) + 100000. Sums of every dimension give the mean; then one
aggregation sums the centred products of every pair of dimensions. The pairs are laid out as the square blocks of the upper triangle,
`SIDE` dimensions by `SIDE`: a row meets each block once, and there is a generated SQL sum for each place in a block, so the plan
has as many sums whatever the length of the vectors, and they stay compiled. Each task's rows are added first, then `GROUPS` groups of
tasks, then those. The sums are put together as the covariance on the driver (d * d numbers, whatever the rows), LAPACK decomposes it,
and rows are projected by generated SQL again. No Python touches a row.

x is an integer and is centred on the rounded mean c before anything is multiplied, so x - c is exact and only the remainder of
the mean, below one half, is rounded. How far the whitened values are from unit covariance is measured by another aggregation, over them.

Nulls: rows without a vector, or with a null or non-finite component, are dropped; so are rows whose components are 2**52 or more, as
x must be a long. Vectors of another length than the most frequent one (ties: the longer) are dropped too, and empty vectors.
Repeated rows and ids count and are returned as often as they come; a null id stays null. Directions without variance (an
eigenvalue of at most 1e-12 of the largest) have no whitened value and no row; so an empty table, one row or equal rows give none.
Equal eigenvalues have no order of their own: LAPACK's is taken. `deviation` is null where it is beyond a long. Further columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.common import table

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
#: Dimensions on a side of a block of pairs.
SIDE = 8
#: Tasks' partial sums are added in so many groups, and the groups' sums then, so no task adds up what all tasks have.
GROUPS = 64
#: Components of this size or more have no x that is a long.
LARGEST = 2.0**52
#: Eigenvalues up to this share of the largest one are rounding.
LEAST = 1e-12


@dataclass
class Whitening:
    """What `fit` learns: n vectors, exact sums by dimension, eigenvalues (falling) and unit eigenvectors as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def centre(self) -> list[int]:
        """The mean of each dimension, rounded."""
        return [round(Fraction(s, self.n)) for s in self.sums]


def _usable(vectors: DataFrame, vector_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose components are all finite, as v."""
    rows = vectors.select(*keep, F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(fine, F.lit(False)))


def _x(i: int) -> str:
    return f"(cast(floor({SCALE}D * v[{i}]) as bigint) + {OFFSET}L)"


def _added(terms: Sequence[str], add: Callable[[str, str], str]) -> str:
    """One expression that adds the terms, as a balanced tree."""
    if len(terms) == 1:
        return terms[0]
    half = len(terms) // 2
    return add(_added(terms[:half], add), _added(terms[half:], add))


def _plus(a: str, b: str) -> str:
    return f"({a} + {b})"


def _totals(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> list:
    """Rows of (keys, sums) over all rows, in order of the keys: tasks, then groups of them, then all."""
    names = [f"s{k}" for k in range(len(sums))]
    of = rows.groupBy(*keys, F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("of")).agg(*[F.expr(s).alias(n) for s, n in zip(sums, names, strict=True)])
    return sorted(of.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names]).collect())


def _length(rows: DataFrame) -> tuple[int, int, int] | None:
    """(length, vectors, largest absolute x) of the most frequent length."""
    x = F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET)
    most = rows.select(F.size("v").alias("d"), F.greatest(F.abs(F.array_max(x)), F.abs(F.array_min(x))).alias("m"))
    found = most.groupBy("d").agg(F.count("*").alias("n"), F.max("m").alias("m")).orderBy(F.desc("n"), F.desc("d")).first()
    return None if found is None else (found["d"], found["n"], found["m"])


def _centred(rows: DataFrame, model: Whitening) -> DataFrame:
    """With y: each x less its mean, in double precision."""
    rest = [float(Fraction(s, model.n) - c) for s, c in zip(model.sums, model.centre, strict=True)]
    y = [f"cast({_x(i)} - {c}L as double) - ({r!r}D)" for i, (c, r) in enumerate(zip(model.centre, rest, strict=True))]
    return rows.withColumn("y", F.expr(f"array({', '.join(y)})"))


def _covariance(rows: DataFrame, model: Whitening) -> np.ndarray:
    """Means of the products of y's entries: the blocks (i, j) of the upper triangle, i <= j, each with SIDE * SIDE sums."""
    d = len(model.sums)
    blocks = -(-d // SIDE)
    upper = f"flatten(transform(sequence(0, {blocks - 1}), i -> transform(sequence(i, {blocks - 1}), j -> struct(i, j))))"
    # beyond the last dimension a value is null, and so is its product, which no sum counts
    met = _centred(rows, model).select("y", F.explode(F.expr(upper)).alias("at")).select(
        "at.i", "at.j", *[F.expr(f"get(y, at.{side} * {SIDE} + {k})").alias(f"{side}{k}") for side in "ij" for k in range(SIDE)]
    )
    out = np.zeros((blocks * SIDE, blocks * SIDE))
    for i, j, *sums in _totals(met, ["i", "j"], [f"sum(i{p} * j{q})" for p in range(SIDE) for q in range(SIDE)]):
        out[i * SIDE : (i + 1) * SIDE, j * SIDE : (j + 1) * SIDE] = np.array([s or 0.0 for s in sums]).reshape(SIDE, SIDE) / model.n
    upper_half = np.triu(out[:d, :d])
    return upper_half + np.triu(upper_half, 1).T


def fit(vectors: DataFrame, vector_col: str = "embedding") -> Whitening | None:
    """The covariance of all usable vectors, decomposed; None if there is none."""
    rows = _usable(vectors, vector_col)
    found = _length(rows)
    if found is None:
        return None
    d, n, most = found
    rows = rows.where(F.size("v") == d)
    kind = "bigint" if n * most < 2**62 else "decimal(38,0)"
    x = rows.select(F.posexplode(F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET)).alias("place", "x"))
    sums = [int(s) for _, s in _totals(x, ["place"], [f"sum(cast(x as {kind}))"])]
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), np.zeros(0))
    covariance = _covariance(rows, model)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    some = values > LEAST * max(values[0], 0.0)
    # the sign is free: the entry farthest from zero is positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(d)])
    trace = float(np.trace(covariance))
    return Whitening(n, model.sums, values[some], axes[:, some], values[some] / trace if trace > 0 else values[some])


def _projected(rows: DataFrame, model: Whitening, k: int, keep: Sequence[str]) -> DataFrame:
    """`keep` with w0, w1, ...: the whitened values of the first k components."""
    w = []
    for j in range(k):
        axis = model.vectors[:, j] / np.sqrt(model.values[j])
        w.append(F.expr(_added([f"(y[{i}] * ({float(a)!r}D))" for i, a in enumerate(axis)], _plus)).alias(f"w{j}"))
    return _centred(rows, model).select(*keep, *w)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, model: Whitening | None = None) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) for each usable row and component."""
    model = model or fit(vectors, vector_col)
    rows = _usable(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("e")), "e", ["id"])
    kind = vectors.schema[id_col].dataType.simpleString()
    if model is None or not len(model.values):
        return rows.where("false").selectExpr(f"id as `{id_col}`", "1 as component", "0L as n", "0L as deviation", "0D as whitened", "0D as explained", "0D as identity_error")
    k = min(components, len(model.values))
    d = len(model.sums)
    rows = rows.where(F.size("v") == d)

    # measured, not derived: the whitened rows' own covariance, centred by the aggregate itself
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    own = _projected(rows, model, k, []).agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max((abs(own[f"c{i}_{j}"] - (i == j)) for i, j in pairs), default=0.0) if own[0] is not None else None

    off = [f"try_add(try_multiply({model.n}L, {_x(i)} - {c}L), {model.n * c - s}L)" for i, (s, c) in enumerate(zip(model.sums, model.centre, strict=True))]
    squares = [f"try_multiply({o}, {o})" for o in off]
    deviation = F.expr(_added(squares, lambda a, b: f"try_add({a}, {b})"))
    each = [F.struct(F.lit(j + 1).alias("component"), F.col(f"w{j}").alias("whitened"), F.lit(float(model.explained[j])).alias("explained")) for j in range(k)]
    made = _projected(rows.withColumn("deviation", deviation), model, k, ["id", "deviation"]).select("id", "deviation", F.inline(F.array(*each)))
    return made.select(
        F.col("id").cast(kind).alias(id_col),
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
