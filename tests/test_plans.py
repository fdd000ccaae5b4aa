"""What Spark makes of the operators: shuffles, pushed filters, pruned columns, no cross joins."""

import re

from pyspark.sql import functions as F

from orogen.operators import focal, joins, nearest, selection, stats, tables
from orogen.plans.features import scale_features
from orogen.plans.inputs import dem, points, rectangles, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", plan(df)))


def test_all_scales_share_two_shuffles(spark, data):
    cells = dem(spark, data)
    assert shuffles(focal.window_features(cells, [3])) == shuffles(focal.window_features(cells, [3, 5, 7, 9])) == 2
    assert shuffles(focal.horn(cells, 1.0)) == shuffles(focal.evans_features(cells, 1.0, 7)) == shuffles(focal.gradient_features(cells, 1.0)) == 2
    assert "Python" not in plan(scale_features(cells, (3, 7), 1.0, 10, 100))


def test_scans_are_pruned_and_filtered(spark, data):
    got = plan(tables.filtered(table(spark, data, "customer"), [{"col": "c_acctbal", "op": ">", "values": [5000]}]).select("c_custkey"))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,5000.0)]" in got
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in got
    assert "c_name" not in plan(stats.value_counts(table(spark, data, "customer"), "c_mktsegment"))


def test_no_cross_joins(spark, data):
    pts, rects = points(spark, data), rectangles(spark, data)
    cells = joins.fishnet(spark, (0.0, 0.0, 50.0, 30.0), 5.0)
    for df in (
        joins.in_rectangles(pts, rects, 10.0, "pid"),
        nearest.majority_class(cells, pts, 3.0),
        nearest.weighted_class(cells, pts, 3.0),
        nearest.nearest_class(cells, pts),
        selection.quantiles(pts, ["class"], "v", [0.5]),
        selection.placed(pts, "class", "pid", 1),
        joins.sample_cells(pts, dem(spark, data), (2.0, -1.0, -2.0, 40.0), ["z"]),
        stats.value_counts(pts, "class"),
        stats.undersampled(pts, "class", "pid"),
        stats.rank_tests(pts, "class", ["v"], joins.label_pairs(pts, "class")),
    ):
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(df))


def test_top_values_keep_the_heads_only(spark, data):
    assert "TakeOrderedAndProject" in plan(stats.sample_n(table(spark, data, "customer").select(F.col("c_custkey")), 5, "c_custkey"))
