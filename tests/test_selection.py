"""Order statistics, ranks and quotas against numpy and plain sorting."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orogen.operators import joins, ml, selection, stats

SHARES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def groups():
    r = random.Random(3)
    out = {"wide": [r.uniform(-1, 1) * 10 ** r.randint(-300, 300) for _ in range(3000)], "ties": [r.choice([1.0, 1.0, 1.0, 2.0]) for _ in range(2000)], "one": [4.5], "two": [1.0, 2.0], None: [float(i) for i in range(77)], "inf": [math.inf, 1.0, -math.inf, 2.0, 3.0]}
    return out | {"hot": [7.0] * 1500 + [float(i) for i in range(50)]}


@pytest.mark.parametrize("accuracy", [selection.ACCURACY, 20])
def test_quantiles(spark, accuracy, monkeypatch):
    """With a coarse sketch nearly all values stay in the brackets, and the ranks are the same."""
    monkeypatch.setattr(selection, "ACCURACY", accuracy)
    rows = [(g, v) for g, values in groups().items() for v in values] + [("none", None), ("one", None)]
    random.Random(1).shuffle(rows)
    got = {r["g"]: r["q"] for r in selection.quantiles(spark.createDataFrame(rows, "g string, x double").repartition(7), ["g"], "x", SHARES).collect()}
    assert set(got) == set(groups())
    for g, values in groups().items():
        values = sorted(values)
        for share, v in zip(SHARES, got[g], strict=True):
            at = (len(values) - 1) * share
            low, high = values[math.floor(at)], values[math.ceil(at)]
            want = low if low == high else low * (1 - (at - math.floor(at))) + high * (at - math.floor(at))
            assert v == want or v == pytest.approx(want, rel=1e-12), (g, share)


def test_a_wrong_bracket_is_widened(spark, monkeypatch):
    """Counting finds a bracket that misses its rank; the result does not rest on the sketch."""
    real = F.percentile_approx
    monkeypatch.setattr(selection.F, "percentile_approx", lambda c, p, a: F.transform(real(c, p, a), lambda v: v + 1000))
    df = spark.createDataFrame([(float(i),) for i in range(500)], "x double")
    assert selection.quantiles(df, [], "x", [0.25, 0.5]).first()["q"] == [124.75, 249.5]
    assert selection.quantiles(df.where("false"), [], "x", [0.5]).collect() == []


def test_running(spark):
    r = random.Random(2)
    rows = [(g, float(x), r.randint(0, 5), r.randint(0, 5)) for g in ("a", "b", None) for x in r.sample(range(-500, 500), 300)]
    df = spark.createDataFrame(rows, "g string, x double, n long, m long").repartition(6)
    got = {(q["g"], q["x"]): (q["below_n"], q["below_m"]) for q in selection.running(df, ["g"], "x", ["n", "m"]).collect()}
    assert got == {(g, x): (sum(q[2] for q in rows if q[0] == g and q[1] < x), sum(q[3] for q in rows if q[0] == g and q[1] < x)) for g, x, _, _ in rows}


def test_one_group_is_dealt_over_tasks(spark):
    """The values of a single group lie in several ranges, each summed by itself."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("x"), F.lit(1).cast("long").alias("n"))
    got = selection.running(df, ["g"], "x", ["n"])
    assert got.where("below_n <> x").count() == 0
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "__p" in text[text.index("Window") :]


@pytest.mark.parametrize("bucket", [selection.BUCKET, 7])
def test_places_and_quotas(spark, bucket, monkeypatch):
    monkeypatch.setattr(selection, "BUCKET", bucket)
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") < 490, "b").alias("g"), F.lit(1).alias("n")).repartition(5)
    order = {r["id"]: r["h"] for r in df.select("id", selection.hashed(F.col("id"), 5).alias("h")).collect()}
    classes = collections.defaultdict(list)
    for r in df.collect():
        classes[r["g"]].append(r["id"])
    want = {i: k for ids in classes.values() for k, i in enumerate(sorted(ids, key=order.get), 1)}
    placed = selection.placed(df, "g", "id", 5).collect()
    assert {r["id"]: r["place"] for r in placed} == want and all(r["size"] == len(classes[r["g"]]) for r in placed)
    for n in (0, 1, 20, 10_000):
        assert sorted(r["id"] for r in selection.smallest(df, "g", n, "id", 5).collect()) == sorted(i for i, k in want.items() if k <= n)
    assert selection.placed(df.where("false"), "g", "id", 5).collect() == []


def test_splits_use_places(spark):
    df = spark.range(103).select("id", (F.col("id") % 2).alias("g"))
    train, test = ml.holdout(df, "g", "id", 0.2)
    assert test.groupBy("g").count().orderBy("g").collect() == [(0, 10), (1, 10)] and train.count() == 83
    folds = ml.with_folds(df, "g", "id", 5).groupBy("g", "fold").count().collect()
    assert {r["count"] for r in folds} <= {10, 11} and len(folds) == 10
    assert stats.undersampled(df, "g", "id", 7).groupBy("g").count().collect() == [(0, 7), (1, 7)]


def test_rank_tests_of_all_pairs(spark):
    r = random.Random(8)
    rows = [(g, float(r.choice([1, 2, 2, 3, 9, r.random()])), r.random() if g != "c" else None) for g in "aabbbcd" for _ in range(12)] + [(None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(t["feature"], t["group1"], t["group2"]): t for t in stats.rank_tests(df, "g", ["x", "y"], joins.label_pairs(df, "g"), least=1).collect()}
    assert len(got) == 12
    for (feature, a, b), t in got.items():
        of = lambda g: [q["xy".index(feature) + 1] for q in rows if q[0] == g and q["xy".index(feature) + 1] is not None]  # noqa: E731, B023
        p, q = of(a), of(b)
        assert (t["n_group1"], t["n_group2"]) == (len(p), len(q))
        if p and q:
            u = sum((x > y) + 0.5 * (x == y) for x in p for y in q)
            n, ties = len(p) + len(q), sum(k**3 - k for k in collections.Counter(p + q).values())
            sigma = math.sqrt(len(p) * len(q) / 12 * (n + 1 - ties / (n * (n - 1))))
            z = max(abs(u - len(p) * len(q) / 2) - 0.5, 0) / sigma
            assert t["u_stat"] == pytest.approx(u) and t["auc"] == pytest.approx(u / (len(p) * len(q))) and t["median_group1"] == pytest.approx(np.median(p))
            assert t["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-6)
    assert stats.rank_tests(df, "g", ["x"], joins.label_pairs(df.where("false"), "g")).collect() == []
