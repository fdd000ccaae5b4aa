"""Nearest points by the pyramid against brute force, and how many points a cell meets."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from orogen.operators import nearest


def by_hand(cells, points):
    out = {}
    for g, x, y in cells:
        known = [((p - x) ** 2 + (q - y) ** 2, c) for p, q, c in points if None not in (c, p, q, x, y)]
        out[g] = min(known) if known else None
    return out


@pytest.mark.parametrize("leaf", [nearest.LEAF, 1])
def test_nearest(spark, leaf, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", leaf)
    r = random.Random(5)
    points = [(r.gauss(0, 1), r.gauss(0, 1), r.choice("abc")) for _ in range(300)] + [(r.uniform(500, 501), 500.0, "d") for _ in range(50)]
    points += [(1.0, 1.0, "z"), (1.0, 1.0, "a"), (3.0, 1.0, "b"), (2.0, 0.0, None), (None, 2.0, "a"), (float("nan"), 0.0, "a")]
    cells = [(i, r.uniform(-5, 5), r.uniform(-5, 5)) for i in range(60)] + [(100, 1e4, -1e4), (101, 2.0, 1.0), (102, 500.5, 499.0), (103, None, 1.0), (104, 1.0, 1.0)]
    got = nearest.nearest_class(spark.createDataFrame(cells, "grid_id long, center_x double, center_y double"), spark.createDataFrame(points, "x double, y double, class string")).collect()
    want = by_hand(cells, [p for p in points if p[0] is None or not math.isnan(p[0])])
    assert len(got) == len(cells)
    for row in got:
        if want[row["grid_id"]] is None:
            assert row["class"] is None and row["dist_to_point"] is None
        else:
            assert row["dist_to_point"] == pytest.approx(math.sqrt(want[row["grid_id"]][0]), abs=1e-12) and row["class"] == want[row["grid_id"]][1]


def test_nothing_to_find(spark):
    cells = spark.createDataFrame([(1, 0.0, 0.0)], "grid_id long, center_x double, center_y double")
    none = spark.createDataFrame([], "x double, y double, class string")
    assert nearest.nearest_class(cells, none).collect() == [(1, None, None, None)]
    one = spark.createDataFrame([(3.0, 4.0, "a")] * 3, "x double, y double, class string")
    assert nearest.nearest_class(cells, one).collect() == [(1, "a", 5.0, 1)] and nearest.nearest_class(cells.where("false"), one).collect() == []


def test_a_far_cell_meets_few_points(spark):
    """A far outlier, a near one and one inside a dense spot among 200,000 points."""
    n = 200_000
    spread = spark.range(n).select(F.rand(3).alias("x"), (F.rand(4) * F.when(F.col("id") % 2 == 0, 1e-4).otherwise(1.0)).alias("y"), F.lit("a").alias("class"))
    cells = spark.createDataFrame([(1, 900.0, -700.0), (2, 0.5, 0.5), (3, 0.5, 5e-5), (4, -0.2, 0.3)], "grid_id long, center_x double, center_y double")
    met = {r["grid_id"]: r["n"] for r in nearest.compared(cells, spread).groupBy("grid_id").agg(F.count("*").alias("n")).collect()}
    assert set(met) == {1, 2, 3, 4} and max(met.values()) < 1000


@pytest.mark.parametrize("leaf", [nearest.LEAF, 1])
def test_within_a_radius(spark, leaf, monkeypatch):
    """Whole squares by their counts, the border by its points; a dense spot, points at one place and points on the border."""
    monkeypatch.setattr(nearest, "LEAF", leaf)
    r = random.Random(9)
    points = [(r.uniform(-5, 5), r.uniform(-5, 5), r.choice(["a", "b", None])) for _ in range(200)] + [(r.gauss(1, 0.01), r.gauss(1, 0.01), "c") for _ in range(200)]
    points += [(0.0, 0.0, "a")] * 30 + [(3.0, 0.0, "b"), (-3.0, 0.0, "b"), (None, 1.0, "a"), (float("nan"), 1.0, "a")]
    cells = [(i, r.uniform(-7, 7), r.uniform(-7, 7)) for i in range(25)] + [(50, 0.0, 0.0), (51, 1.0, 1.0), (52, 100.0, 100.0), (53, None, 0.0)]
    net = spark.createDataFrame(cells, "grid_id long, center_x double, center_y double")
    df = spark.createDataFrame(points, "x double, y double, class string")
    most = {q["grid_id"]: q for q in nearest.majority_class(net, df, 3.0).collect()}
    weighted = {q["grid_id"]: q for q in nearest.weighted_class(net, df, 3.0).collect()}
    for g, x, y in cells:
        met = [(math.sqrt((p - x) ** 2 + (q - y) ** 2), c) for p, q, c in points if None not in (p, q, x) and (p - x) ** 2 + (q - y) ** 2 <= 9.0]
        counts = collections.Counter(c for _, c in met if c is not None)
        best = min(counts, key=lambda c: (-counts[c], c), default=None)
        assert (most[g]["class"], most[g]["n_points"]) == (best, sum(counts.values()))
        weights = collections.Counter()
        for d, c in met:
            weights[c] += 1 / (d**2 + 1e-6)
        total = sum(w for c, w in weights.items() if c is not None)
        best = min((c for c in weights if c is not None), key=lambda c: (-weights[c], c), default=None)
        assert (weighted[g]["class"], weighted[g]["n_points"]) == (best, len(met))
        assert weighted[g]["class_conf"] == (pytest.approx(weights[best] / total) if best else None)


def test_a_dense_spot_enters_by_counts(spark):
    spread = spark.range(100_000).select((F.rand(3) * 0.2).alias("x"), (F.rand(4) * 0.2).alias("y"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("class"))
    net = spark.createDataFrame([(1, 0.1, 0.1), (2, 1.0, 0.1)], "grid_id long, center_x double, center_y double")
    rows = {q["grid_id"]: q["n"] for q in nearest.within(net, spread, 1.0, summed=True).groupBy("grid_id").agg(F.count("*").alias("n")).collect()}
    assert rows[1] < 100 and rows[2] < 10_000
    got = {q["grid_id"]: q["n_points"] for q in nearest.majority_class(net, spread, 1.0).collect()}
    assert got == {1: 100_000, 2: spread.where("pow(x - 1.0, 2) + pow(y - 0.1, 2) <= 1").count()}
