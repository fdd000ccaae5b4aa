"""Counts, class-wise statistics, histograms, rank tests and classification metrics.

Wide tables are unpivoted to (label, feature, x) once, so any number of features costs one shuffle.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orogen.operators import selection
from orogen.operators.selection import hashed
from orogen.sources.storage import kept

QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


def real(x: Column) -> Column:
    """A number as a double; NaN is null."""
    d = x.try_cast("double")
    return F.when(~F.isnan(d), d)


def long_form(df: DataFrame, keep: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(keep, feature, x): one row for each value."""
    return df.select(*keep, *[real(F.col(f)).alias(f) for f in features]).unpivot(list(keep), list(features), "feature", "x")


def _with_quantiles(groups: DataFrame, rows: DataFrame, by: Sequence[str], shares: Iterable[float]) -> DataFrame:
    """`groups` with `q`, the quantiles of x in the rows of each; null where a group has no value."""
    found = selection.quantiles(rows, by, "x", list(shares)).withColumnsRenamed({k: f"__{k}" for k in by})
    same = [groups[k].eqNullSafe(found[f"__{k}"]) for k in by]
    return groups.join(found, reduce(operator.and_, same, F.lit(True)), "left").drop(*[f"__{k}" for k in by])


def class_statistics(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Per label (null too) and feature: total, count, missing, missing_ratio, mean, std, min, max, quantiles, skew.

    Quantiles are exact and interpolated; skew is the mean cube of deviations over the cube of the sample deviation.
    """
    rows = long_form(df, [label], features)
    x, n = F.col("x"), F.count("x")
    got = rows.groupBy(label, "feature").agg(
        F.count("*").alias("total"),
        n.alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.skewness(x).alias("g"),
        F.stddev_pop(x).alias("sigma"),
    )
    got = _with_quantiles(got, rows, [label, "feature"], QUANTILES.values())
    cube = F.col("g") * F.pow(F.col("sigma") / F.when(F.col("std") > 0, F.col("std")), F.lit(3.0))
    return got.select(
        F.col(label).alias("label"),
        "feature",
        "total",
        "count",
        (F.col("total") - F.col("count")).alias("missing"),
        ((F.col("total") - F.col("count")) / F.col("total")).alias("missing_ratio"),
        "mean",
        "std",
        "min",
        "max",
        *[F.col("q")[i].alias(name) for i, name in enumerate(QUANTILES)],
        cube.alias("skew"),
    )


def summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per column: count, mean, std, min, quantiles, max of what parses as a number."""
    rows = long_form(df, [], features).withColumnRenamed("feature", "column")
    got = rows.groupBy("column").agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    got = _with_quantiles(got, rows, ["column"], QUANTILES.values())
    return got.select("column", "count", "mean", "std", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(QUANTILES)], "max")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, count, ratio_percent) with null as a value; by count if `top` is given."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    total = df.agg(F.count("*")).scalar()  # a scalar subquery, not a window over everything
    out = counts.select("value", "count", (F.lit(100.0) * F.col("count") / total).alias("ratio_percent"))
    return out.orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(top) if top is not None else out


def histograms(df: DataFrame, label: str, features: Sequence[str], bins: int) -> DataFrame:
    """(label, feature, bin, bin_left, bin_right, count): equal widths over each group's range, the last bin closed, empty ones too."""
    rows = long_form(df, [label], features).where("x is not null")
    key = ["feature", F.coalesce(F.col(label).cast("string"), F.lit("\x00")).alias("key")]
    rows = rows.select(label, "x", *key)
    span = rows.groupBy("feature", "key").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.first(label).alias("label"))
    # a group of one value has a bin of width one around it
    flat = F.col("low") == F.col("high")
    span = span.select("feature", "key", "label", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"), F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    at = F.least(F.floor((F.col("x") - F.col("low")) / width), F.lit(bins - 1)).cast("int")
    counted = rows.join(span.select("feature", "key", "low", "high"), ["feature", "key"]).groupBy("feature", "key", at.alias("bin")).agg(F.count("*").alias("n"))
    every = span.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge = lambda k: F.col("low") + width * k
    return every.join(counted, ["feature", "key", "bin"], "left").select(
        "label", "feature", F.col("bin").cast("long").alias("bin"), edge(F.col("bin")).alias("bin_left"), edge(F.col("bin") + 1).alias("bin_right"), F.coalesce("n", F.lit(0)).cast("long").alias("count")
    )


def normal_tail(z: Column) -> Column:
    """P(|N| > z) for z >= 0 by the rational approximation of the error function (error under 2e-7)."""
    #: The coefficients of that approximation.
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    x = z / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = F.lit(0.0)
    for c in reversed(a):
        poly = (poly + F.lit(c)) * t
    return poly * F.exp(-x * x)


def rank_tests(df: DataFrame, label: str, features: Sequence[str], pairs: DataFrame, least: int = 30) -> DataFrame:
    """Mann-Whitney tests of each feature between the two labels of each pair (a, b), labels as text.

    Ranks are made once for all pairs: each distinct value of a feature has one row with a count for each label (there are few), the counts
    under it are running sums over ranges of values, and U of a pair is what one label's values have of the other label under them and
    half of what they share. p_value is the normal approximation with corrections for ties and continuity. Groups under `least` have only a note.
    """
    rows = long_form(df.where(F.col(label).isNotNull()), [label], features).where("x is not null").select(F.col(label).cast("string").alias("label"), "feature", "x")
    pairs = pairs.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).distinct()
    labels = sorted(r[0] for r in pairs.select(F.explode(F.array("a", "b"))).distinct().collect())
    at = range(len(labels))
    if not labels:
        return _tests_of_nothing(label, rows)
    rows = rows.where(F.col("label").isin(labels))
    counts = rows.groupBy("feature", "x").agg(*[F.sum(F.when(F.col("label") == name, 1).otherwise(0)).alias(f"n{i}") for i, name in zip(at, labels, strict=True)])
    ranked = selection.running(counts, ["feature"], "x", [f"n{i}" for i in at])
    present = F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"n{i}").cast("double").alias("n")) for i in at]), lambda s: s["n"] > 0))
    sums = ranked.select("*", present.alias("own")).groupBy("feature", "own.i")
    n = F.col("own.n")
    over = [F.sum(n * (F.col(f"below_n{j}") + F.col(f"n{j}") / 2)).alias(f"u{j}") for j in at]
    shared = [F.sum(3 * n * F.col(f"n{j}") * (n + F.col(f"n{j}"))).alias(f"c{j}") for j in at]
    each = rows.groupBy("feature", "label").agg(F.avg("x").alias("mean"), F.count("*").alias("size"))
    each = _with_quantiles(each, rows, ["feature", "label"], [0.5]).select("feature", "label", "mean", "size", F.col("q")[0].alias("median"))
    names = F.array(*[F.lit(name) for name in labels])
    sums = sums.agg(*over, *shared, F.sum(n * n * n - n).alias("t")).withColumn("label", F.get(names, F.col("i")))
    meets = F.explode(F.array(*[F.struct(F.lit(name).alias("b"), F.col(f"u{j}").alias("u"), F.col(f"c{j}").alias("c")) for j, name in zip(at, labels, strict=True)]))
    met = sums.select("feature", F.col("label").alias("a"), meets.alias("m")).select("feature", "a", "m.*")
    own = sums.select("feature", "label", "t")
    # every pair of which a side has values
    tests = each.join(pairs.select("a", "b", F.explode(F.array("a", "b")).alias("label")), "label").select("feature", "a", "b").distinct()
    tests = tests.join(met, ["feature", "a", "b"], "left")
    for k, of in ((1, "a"), (2, "b")):
        side = each.join(own, ["feature", "label"]).select("feature", F.col("label").alias(of), F.col("size").alias(f"n_group{k}"), F.col("mean").alias(f"mean_group{k}"), F.col("median").alias(f"median_group{k}"), F.col("t").alias(f"t{k}"))
        tests = tests.join(side, ["feature", of], "left").withColumn(f"n_group{k}", F.coalesce(f"n_group{k}", F.lit(0)).cast("long"))
    tests = tests.withColumn("ties", F.col("t1") + F.col("t2") + F.col("c"))
    n1, n2 = F.col("n_group1").cast("double"), F.col("n_group2").cast("double")
    total = n1 + n2
    enough = (n1 >= least) & (n2 >= least)
    spread = F.sqrt(n1 * n2 / F.lit(12.0) * (total + 1 - F.col("ties") / (total * (total - 1))))
    z = F.greatest(F.abs(F.col("u") - n1 * n2 / 2) - F.lit(0.5), F.lit(0.0)) / F.when(spread > 0, spread)
    auc = F.col("u") / (n1 * n2)
    shown = {"u_stat": F.col("u"), "p_value": F.least(F.coalesce(normal_tail(z), F.lit(1.0)), F.lit(1.0)), "auc": auc, "cliffs_delta": F.lit(2.0) * auc - 1}
    return tests.select(
        F.lit(label).alias("label_col"),
        "feature",
        F.col("a").alias("group1"),
        F.col("b").alias("group2"),
        "n_group1",
        "n_group2",
        "mean_group1",
        "mean_group2",
        "median_group1",
        "median_group2",
        *[F.when(enough, x).alias(name) for name, x in shown.items()],
        F.when(enough, F.lit("")).otherwise(F.lit(f"n < {least}")).alias("note"),
    )


def _tests_of_nothing(label: str, rows: DataFrame) -> DataFrame:
    """The columns of `rank_tests` without a pair."""
    of = {"label_col": F.lit(label), "feature": F.col("feature"), "group1": F.col("label"), "group2": F.col("label")}
    of |= {f"n_group{k}": F.lit(0).cast("long") for k in (1, 2)} | {f"{c}_group{k}": F.col("x") for c in ("mean", "median") for k in (1, 2)}
    of |= {c: F.col("x") for c in ("u_stat", "p_value", "auc", "cliffs_delta")} | {"note": F.lit("")}
    return rows.where("false").select(*[v.alias(k) for k, v in of.items()])


def auc_matrix(tests: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(feature, one column 'a-b' for each pair): mean AUC."""
    named = tests.withColumn("pair", F.concat_ws("-", "group1", "group2"))
    return named.groupBy("feature").pivot("pair", [f"{a}-{b}" for a, b in pairs]).agg(F.avg("auc"))


def separability(tests: DataFrame) -> DataFrame:
    """(feature, mean distance of the AUC from one half), best first."""
    return tests.groupBy("feature").agg(F.avg(F.abs(F.col("auc") - 0.5)).alias("mean_abs_auc")).orderBy(F.desc("mean_abs_auc"), "feature")


# --- classification -----------------------------------------------------------------------------------------------


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(true, pred, n, share of the true class) for every combination of the labels that occur, as text."""
    t, p = F.col(truth).cast("string"), F.col(predicted).cast("string")
    counts = df.where(t.isNotNull() & p.isNotNull()).groupBy(t.alias("true"), p.alias("pred")).agg(F.count("*").alias("n"))
    # every label meets every other one inside one small row: there are as many as classes
    labels = counts.select(F.explode(F.array("true", "pred")).alias("l")).agg(F.array_sort(F.collect_set("l")).alias("all"))
    grid = labels.select(F.explode("all").alias("true"), "all").select("true", F.explode("all").alias("pred"))
    full = grid.join(counts, ["true", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy("true"))
    return full.withColumn("share", F.when(total > 0, F.col("n") / total).otherwise(F.lit(0.0)))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(class, precision, recall, f1, support), then accuracy, macro avg and weighted avg; divisions by zero give 0."""
    cells = confusion(df, truth, predicted)
    both = cells.select(F.explode(F.array(F.struct(F.col("true").alias("class"), F.lit(1).alias("t")), F.struct(F.col("pred").alias("class"), F.lit(0).alias("t")))).alias("k"), "n", (F.col("true") == F.col("pred")).alias("hit"))
    side = lambda t, cond=None: F.sum(F.when((F.col("k.t") == t) & (F.lit(True) if cond is None else cond), F.col("n")).otherwise(0))
    per = both.groupBy(F.col("k.class").alias("class")).agg(side(1).alias("support"), side(0).alias("given"), side(1, F.col("hit")).alias("tp"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    per = per.select("class", "support", "tp", ratio(F.col("tp"), F.col("given")).alias("precision"), ratio(F.col("tp"), F.col("support")).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    per = per.withColumn("f1", ratio(F.lit(2.0) * p * r, p + r))
    metrics = ("precision", "recall", "f1")
    n = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in metrics], n.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"), *[(F.sum(F.col(m) * F.col("support")) / n).alias(m) for m in metrics], n.alias("support"))
    accuracy = per.agg(F.lit("accuracy").alias("class"), *[(F.sum("tp") / n).alias(m) for m in metrics], n.alias("support"))
    return per.select("class", *metrics, "support").unionByName(accuracy).unionByName(macro).unionByName(weighted)


def prediction_summary(df: DataFrame, predicted: str, probability: str) -> DataFrame:
    return df.groupBy(F.col(predicted).cast("string").alias("class")).agg(F.count("*").alias("count"), F.avg(probability).alias("proba_max_mean"))


def quantiles_by_class(df: DataFrame, predicted: str, features: Sequence[str]) -> DataFrame:
    which = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    rows = long_form(df, [predicted], features).select(F.col(predicted).cast("string").alias("class"), "feature", "x")
    got = _with_quantiles(rows.groupBy("class", "feature").agg(F.lit(1)), rows, ["class", "feature"], which.values())
    return got.select("class", "feature", *[F.col("q")[i].alias(n) for i, n in enumerate(which)])


def diagnostics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per true class: n_true, n_correct, recall."""
    hit = (F.col(truth).cast("string") == F.col(predicted).cast("string")).cast("int")
    return df.where(F.col(truth).isNotNull()).groupBy(F.col(truth).cast("string").alias("class")).agg(F.count("*").alias("n_true"), F.sum(hit).alias("n_correct"), F.avg(hit).alias("recall"))


def zero_crossing(df: DataFrame, x: str, effect: str, bins: int = 40, least: int = 200, per_bin: int = 10) -> DataFrame:
    """(threshold, note): where the mean effect over quantile bins of x first changes its sign, interpolated."""
    rows = df.select(real(F.col(x)).alias("x"), real(F.col(effect)).alias("e")).where("x is not null and e is not null")
    edges = kept(selection.quantiles(rows, [], "x", [i / bins for i in range(bins + 1)]).select(F.array_distinct("q").alias("q")))
    ends = edges.agg(F.first("q")).scalar()
    placed = rows.withColumn("edges", ends).withColumn("bin", F.least(F.size(F.filter("edges", lambda e: e <= F.col("x"))), F.size("edges") - 1))
    means = placed.groupBy("bin").agg(F.avg("x").alias("mx"), F.avg("e").alias("me"), F.count("*").alias("k")).where(F.col("k") >= per_bin)
    line = Window.partitionBy(F.lit(0)).orderBy("mx")  # at most `bins` rows
    step = means.select("mx", "me", F.lead("mx").over(line).alias("nx"), F.lead("me").over(line).alias("ne"))
    cross = step.where(F.col("me") * F.col("ne") < 0).select("mx", (F.col("mx") - F.col("me") * (F.col("nx") - F.col("mx")) / (F.col("ne") - F.col("me"))).alias("at"))
    out = rows.agg(F.count("*").alias("n")).select(
        "n", ends.alias("edges"), cross.agg(F.min_by("at", "mx")).scalar().alias("at"), means.agg(F.count("*")).scalar().alias("used")
    )
    note = (
        F.when(F.col("n") < least, "too_few_samples")
        .when(F.size("edges") < 3, "low_variance")
        .when(F.col("used") < 5, "bins_too_sparse")
        .when(F.col("at").isNull(), "no_crossing")
        .otherwise("")
    )
    return out.withColumn("note", note).select(F.when(F.col("note") == "", F.col("at")).alias("threshold"), "note")


# --- order, samples, sets -----------------------------------------------------------------------------------------


def numbered(df: DataFrame, order: Sequence[str], partition_by: Sequence[str] = (), name: str = "id") -> DataFrame:
    """1-based running number. Without partition columns it is exact and distributed: sorted by ranges, written once, and
    each range starts after the rows of those before it. (Two readings of one exchange by ranges could differ, hence the writing.)
    """
    if partition_by:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order)))
    # the id counts the rows of each partition from the partition's number shifted by 33 bits
    parted = kept(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    sizes = parted.groupBy(F.shiftright("__at", 33).alias("__p")).agg(F.count("*").alias("k"))
    before = Window.partitionBy(F.lit(0)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("__p", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("__start"))
    row = F.col("__at").bitwiseAND(F.lit(2**33 - 1)) + 1
    parted = parted.withColumn("__p", F.shiftright("__at", 33))
    return parted.join(F.broadcast(starts), "__p").withColumn(name, row + F.col("__start")).drop("__p", "__at", "__start")


def every_nth(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return numbered(df, order, name="__id").where((F.col("__id") - 1) % n == 0).drop("__id")


def grid_stride(df: DataFrame, step: int, ix: str = "ix", iy: str = "iy") -> DataFrame:
    return df.where((F.col(ix) % step == 0) & (F.col(iy) % step == 0))


def bernoulli(df: DataFrame, share: float, key: str, seed: int = 42) -> DataFrame:
    """Each row with the given probability, decided by a hash of its key."""
    return df.where(F.pmod(hashed(F.col(key), seed), F.lit(1_000_000)) < int(share * 1_000_000))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if fewer): a top-n by hash, which needs no full sort."""
    return df.orderBy(hashed(F.col(key), seed), key).limit(n)


def per_class(df: DataFrame, label: str, n: int | Column, key: str, seed: int = 42) -> DataFrame:
    """Up to n rows of each class; n may be a scalar subquery."""
    return selection.smallest(df, label, n, key, seed)


def undersampled(df: DataFrame, label: str, key: str, target: int | None = None, seed: int = 42) -> DataFrame:
    """Every class down to the smallest one's size, or to `target` if that is less."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("k"))
    least = sizes.agg(F.min("k")).scalar()
    most = least if target is None else F.least(least, F.lit(target))
    return per_class(df.where(F.col(label).isNotNull()), label, most, key, seed)


def undersampling_log(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    a = before.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("original_count"))
    b = after.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("sampled_count"))
    return a.join(b, "class", "left").withColumn("sampled_count", F.coalesce("sampled_count", F.lit(0)))


def top_classes(labels: Sequence[str], probabilities: Column, k: int = 3) -> Column:
    """The k most likely classes of a row as an array of (label, p); ties by label order."""
    zipped = F.transform(probabilities, lambda p, i: F.struct((-p).alias("p"), i.alias("i")))
    names = F.array(*[F.lit(x) for x in labels])
    return F.transform(F.slice(F.array_sort(zipped), 1, k), lambda x: F.struct(F.get(names, x["i"]).alias("label"), (-x["p"]).alias("p")))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns that one lacks are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def dissolve(grid: DataFrame, column: str) -> DataFrame:
    """Per class: n_points, n_cells and the box of its cells."""
    box = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    return grid.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum("n_points").alias("n_points"), F.count("*").alias("n_cells"), *box)
