"""Order statistics, ranks and quotas without a task, window or buffer that holds a whole group.

* `running`: sums of what stands before a value, within its group. Values are dealt into ranges, each range adds up its own, and
  the ranges' totals (one row for each range and group) are added in front.
* `quantiles`: a sketch of bounded size brackets each quantile; counting what lies under a bracket and inside it shows that
  the bracket holds the rank (one that does not is widened to everything); the distinct values inside it, some ten-thousandths of
  the rows, are counted and `running` finds the rank among them. Exact, whatever the sketch says.
* `placed` and `smallest`: rows of a class in order of a hash. Rows are counted in buckets of the hash; a row's place is that of its
  bucket and its place in it. A quota needs no order but in the one bucket of a class that it ends in.

Null keys are groups of their own. NaN and null values are left out by the callers.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orogen.sources.storage import kept

#: Rank error of the sketch is one in so many; so is the size of its buffer, for each group.
ACCURACY = 10_000
#: Rows in a bucket of `placed`, about.
BUCKET = 50_000
#: Buckets of a class at most: their counts are ordered in one window.
MOST_BUCKETS = 1 << 20
#: Rows of a small side up to which it is broadcast; more are joined by shuffle.
BROADCAST_ROWS = 100_000


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(operator.and_, [a[k].eqNullSafe(b[f"__{k}"]) for k in keys], F.lit(True))


def joined(rows: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null; `small` is broadcast if it is counted to be small."""
    few = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    if few.count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    return rows.join(few, _same(rows, few, keys)).drop(*[f"__{k}" for k in keys])


def running(rows: DataFrame, by: Sequence[str], x: str, values: Sequence[str], prefix: str = "below_") -> DataFrame:
    """`rows`, one for each (by, x), with a column for each of `values`: its sum over the smaller x of the same group.

    Sorting by ranges deals one group's values over many tasks. The dealt rows are written once, as two readings of an exchange by ranges could differ.
    """
    parted = kept(rows.repartitionByRange(*by, x).withColumn("__p", F.spark_partition_id()))
    own = Window.partitionBy("__p", *by).orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = parted.groupBy("__p", *by).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    zero = F.lit(0).cast("long")
    starts = kept(totals.select("__p", *by, *[F.coalesce(F.sum(f"__t_{v}").over(before), zero).alias(f"__s_{v}") for v in values]))
    inner = parted.select("*", *[F.coalesce(F.sum(v).over(own), zero).alias(f"__r_{v}") for v in values])
    both = joined(inner, starts, ["__p", *by])
    return both.select(*rows.columns, *[(F.col(f"__s_{v}") + F.col(f"__r_{v}")).alias(f"{prefix}{v}") for v in values])


def quantiles(rows: DataFrame, by: Sequence[str], x: str, shares: Sequence[float], name: str = "q") -> DataFrame:
    """(by, name: array of the exact quantiles, interpolated between neighbours); groups without values are left out."""
    if not by:
        return quantiles(rows.select(F.lit(0).alias("__all"), x), ["__all"], x, shares, name).drop("__all")
    rows = rows.select(*by, F.col(x).cast("double").alias("__x")).where(F.col("__x").isNotNull())
    at = range(len(shares))
    margin = 3.0 / ACCURACY
    ends = [s for q in shares for s in (q - margin, q + margin)]
    sketch = F.percentile_approx("__x", [min(max(s, 0.0), 1.0) for s in ends], ACCURACY)
    first = rows.groupBy(*by).agg(F.count("*").alias("__n"), F.min("__x").alias("__low"), F.max("__x").alias("__high"), sketch.alias("__e"))
    edges = [(F.col("__low") if q - margin <= 0 else F.col("__e")[2 * i], F.col("__high") if q + margin >= 1 else F.col("__e")[2 * i + 1]) for i, q in zip(at, shares, strict=True)]
    brackets = kept(first.select(*by, "__n", "__low", "__high", *[c.alias(f"__{s}{i}") for i, pair in zip(at, edges, strict=True) for s, c in zip("ab", pair, strict=True)]))

    # counting decides, not the sketch: how many lie under each bracket and in it
    lies = lambda i: F.col("__x").between(F.col(f"__a{i}"), F.col(f"__b{i}"))
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    counts = [c for i in at for c in (one(F.col("__x") < F.col(f"__a{i}")).alias(f"__u{i}"), one(lies(i)).alias(f"__w{i}"))]
    counted = joined(rows, brackets, by).groupBy(*by, *[c for c in brackets.columns if c not in by]).agg(*counts)
    rank = lambda i: (F.col("__n") - 1) * F.lit(float(shares[i]))
    found = counted
    for i in at:
        fine = (F.floor(rank(i)) >= F.col(f"__u{i}")) & (F.ceil(rank(i)) < F.col(f"__u{i}") + F.col(f"__w{i}"))
        new = {f"__a{i}": "__low", f"__b{i}": "__high"}
        found = found.withColumn("__fine", fine).withColumns({k: F.when(F.col("__fine"), F.col(k)).otherwise(F.col(v)) for k, v in new.items()} | {f"__u{i}": F.when(F.col("__fine"), F.col(f"__u{i}")).otherwise(0)})
    found = kept(found.drop("__fine", *[f"__w{i}" for i in at]))

    # the distinct values of each bracket, in order
    each = F.explode(F.array(*[F.when(lies(i), F.lit(i)) for i in at]))
    inside = joined(rows, found.drop("__n", "__low", "__high", *[f"__u{i}" for i in at]), by).select(*by, "__x", each.alias("__i")).where("__i is not null")
    values = inside.groupBy(*by, "__i", "__x").agg(F.count("*").alias("__k"))
    ranked = joined(running(values, [*by, "__i"], "__x", ["__k"]), found.select(*by, "__n", F.array(*[f"__u{i}" for i in at]).alias("__u")), by)
    share = F.get(F.array(*[F.lit(float(q)) for q in shares]), F.col("__i"))
    place = (F.col("__n") - 1) * share
    start = F.get("__u", F.col("__i")) + F.col("below___k")
    hit = lambda r: F.max(F.when((r >= start) & (r < start + F.col("__k")), F.col("__x")))
    picked = ranked.groupBy(*by, "__i").agg(hit(F.floor(place)).alias("low"), hit(F.ceil(place)).alias("high"), F.max(place - F.floor(place)).alias("part"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") * (1 - F.col("part")) + F.col("high") * F.col("part"))
    listed = F.array_sort(F.collect_list(F.struct("__i", value.alias("v"))))  # one for each share
    return picked.groupBy(*by).agg(listed.alias(name)).withColumn(name, F.transform(name, lambda s: s["v"]))


def hashed(key: Column, seed: int) -> Column:
    """A repeatable random order."""
    return F.xxhash64(F.lit(seed), key)


def _bucketed(df: DataFrame, label: str, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """`df` with its hash and bucket, and (label, bucket, rows in it, rows of the class before it, rows of the class)."""
    most = min(MOST_BUCKETS, max(1, -(-df.count() // BUCKET)))
    h = hashed(F.col(key), seed)
    # equal shares of the hashes' range, in their order
    share = (h.cast("double") / F.lit(2.0**64) + 0.5) * most
    rows = df.withColumn("__h", h).withColumn("__b", F.least(F.floor(share), F.lit(most - 1)).cast("int"))
    counts = rows.groupBy(label, "__b").agg(F.count("*").alias("__k"))
    before = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    every = F.sum("__k").over(Window.partitionBy(label))
    return rows, kept(counts.select(label, "__b", "__k", F.coalesce(F.sum("__k").over(before), F.lit(0)).alias("__start"), every.alias("__size")))


def _in_bucket(label: str, key: str) -> Column:
    return F.row_number().over(Window.partitionBy(label, "__b").orderBy("__h", key))


def placed(df: DataFrame, label: str, key: str, seed: int, place: str = "place", size: str = "size") -> DataFrame:
    """`df` with each row's 1-based place in its class by hash of its key, and the size of the class."""
    rows, buckets = _bucketed(df, label, key, seed)
    both = joined(rows.withColumn("__r", _in_bucket(label, key)), buckets.drop("__k"), [label, "__b"])
    return both.select(*df.columns, (F.col("__start") + F.col("__r")).alias(place), F.col("__size").alias(size))


def smallest(df: DataFrame, label: str, n: int | Column, key: str, seed: int) -> DataFrame:
    """The n rows of each class with the smallest hashes; n may be a scalar subquery. Only the bucket that a quota ends in is ordered."""
    rows, buckets = _bucketed(df, label, key, seed)
    open_ = buckets.withColumn("__left", (F.lit(n) if isinstance(n, int) else n) - F.col("__start")).where("__left > 0")
    both = joined(rows, open_.select(label, "__b", "__left", (F.col("__k") > F.col("__left")).alias("__ends")), [label, "__b"])
    whole = both.where("not __ends").select(*df.columns)
    border = both.where("__ends").withColumn("__r", _in_bucket(label, key)).where("__r <= __left")
    return whole.unionByName(border.select(*df.columns))
