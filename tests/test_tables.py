"""Helpers and table operators on small rows: nulls, ties, bad values."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orogen.functions import names, scales
from orogen.operators import joins, ml, nearest, stats, tables
from orogen.sources import readers, sinks


def test_scales():
    assert [scales.odd_window(r, 1.0) for r in (0.4, 2.5, 4, 5.4)] == [3, 3, 5, 5]
    assert scales.block_scale(2.5, 1.0) == 2 and scales.half_distance(7) == 3
    assert scales.openness_radius(5, 2.0, 3) == 4.0 and scales.fraction("1/10") == 0.1
    assert scales.scale_tag(5.0, 5, 1.0) == "rin5m_k5_reff2m" and scales.block_size(100, 15) is None
    assert scales.evans_constants(3) == {"k": 3, "s2": 2, "s4": 2, "second": 2, "cross": 4}
    assert scales.readable_bytes(2048) == "2.0 KB" and scales.gauss_sigma(0.3, 1.0) == 0.5


def test_names():
    cols = ["a", "b", "c", "d"]
    assert names.columns("0,c,1-2", cols) == ["a", "c", "b"] and names.columns("", cols) == cols
    assert names.indices("1-3,2", 4, base=1) == [0, 1, 2]
    with pytest.raises(ValueError):
        names.columns("9", cols)
    assert names.columns("9,a", cols, strict=False) == ["a"]
    assert names.xy_columns(["Lon", "lat", "v"]) == ("Lon", "lat") and names.xy_columns(["v"]) is None
    assert names.strip_quotes(" 'x' ") == "x" and names.kind_of_sql("VARCHAR(3)") == "string"


def test_names_of_files_runs_and_kinds(spark, tmp_path):
    assert [readers.format_of(p) for p in ("a.CSV", "b/c.pq", "x.gpkg", "x.geojson", "d.TIF", "d.orc/")] == ["csv", "parquet", "geopackage", "geojson", "geotiff", "orc"]
    assert readers.output_name("a.1/t1.gpkg", "csv") == "a.1/t1.csv" and scales.experiment_tag(0.2, 42, 200, None, None) == "ts0.2_rs42_n200_dnone_wnone"
    assert scales.memory_estimate(10_000, 190)["bytes"] == 22_800_000 and not scales.memory_estimate(10**8, 190)["geopackage"]
    assert [names.kind_of_sql(t) for t in ("BIGINT", "DATETIME", "TEXT", "BLOB")] == ["numeric", "datetime", "string", "other"]
    assert names.indices("2,5-7,6", 8, base=1) == [1, 4, 5, 6] and names.xy_columns(["center_x", "center_y"]) == ("center_x", "center_y")
    runs = ml.config_template(["rf", "gbt"], [2, 4], "label", ["f"], "id", ["holdout", "kfold"])["runs"]
    assert [(r["name"], r["backend"], r["trees"]) for r in runs[:2]] == [("rf_n2_holdout", "rf", 2), ("rf_n2_kfold", "rf", 2)] and len(runs) == 8
    got = ml.merged({"global": {"depth": 5, "trees": 3}, "runs": [{"name": "a", "trees": 7}, {"name": "b", "depth": 9}]})
    assert [(r["name"], r["depth"], r["trees"]) for r in got] == [("a", 5, 7), ("b", 9, 3)]
    sinks.save_json(spark, f"{tmp_path}/m.json", {"run_id": "run", "feature_cols": ["a"], "runs": []})
    assert readers.load_config(spark, f"{tmp_path}/m.json")["feature_cols"] == ["a"]
    assert scales.odd_window(5 / 4, 2.0) == 3 and scales.readable_bytes(3**20) == "3.2 GB"


def test_conditions_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "n long, s string")
    ne = tables.filtered(df, [{"col": "n", "op": "!=", "values": [1]}])
    assert ne.count() == 2  # a null differs from 1
    text, args = tables.where_clause([{"col": "n", "op": "!=", "values": [1]}])
    assert spark.sql(f"SELECT * FROM {{d}} WHERE {text}", args=args, d=df).count() == 1
    assert tables.filtered(df, [{"col": "zzz", "op": "==", "values": [1]}]).count() == 3
    with pytest.raises(ValueError):
        tables.filtered(df, [{"col": "s", "op": ">", "values": ["a"]}])
    assert tables.delete(df, F.col("n") == 1).count() == 2
    assert df.where(tables.one_of("s", [], with_null=True)).count() == 1


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("1",), ("1d",), (" 2.5e1 ",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(tables.number(F.col("t"))).collect()] == [1.0, None, 25.0, None, None]
    assert dict(tables.coerced(df.where("t = '1'"), "t", "numeric").dtypes)["t"] == "bigint"
    assert tables.parse_rates(df, ["t"]).first()["kind"] == "mixed"


def test_statistics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", 9.0), (None, float("nan"))], "label string, x double")
    rows = {r["label"]: r for r in stats.class_statistics(df, "label", ["x"]).collect()}
    assert rows["a"]["q25"] == 1.75 and rows["a"]["count"] == 4 and rows[None]["missing"] == 1
    mu, sd = 4.0, (38 / 3) ** 0.5
    assert rows["a"]["skew"] == pytest.approx(sum((v - mu) ** 3 for v in (1, 2, 4, 9)) / 4 / sd**3)
    one = spark.createDataFrame([("a", 3.0)], "label string, x double")
    assert [r["count"] for r in stats.histograms(one, "label", ["x"], 2).orderBy("bin").collect()] == [0, 1]


def test_rank_tests_by_brute_force(spark):
    a, b = [1, 2, 2, 5, 7], [2, 3, 3, 8]
    df = spark.createDataFrame([("p", float(x)) for x in a] + [("q", float(x)) for x in b], "g string, x double")
    got = stats.rank_tests(df, "g", ["x"], joins.label_pairs(df, "g"), least=1).first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert got["u_stat"] == u and got["auc"] == u / 20 and got["cliffs_delta"] == pytest.approx(2 * u / 20 - 1)
    assert stats.rank_tests(df, "g", ["x"], joins.label_pairs(df, "g")).first()["note"] == "n < 30"
    assert abs(spark.range(1).select(stats.normal_tail(F.lit(1.96))).first()[0] - 0.05) < 1e-4


def test_samples_and_numbers(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 10, "s").otherwise("b"))
    assert [r["n"] for r in stats.numbered(df, ["id"], name="n").orderBy("id").select("n").collect()] == list(range(1, 101))
    under = stats.undersampled(df, "g", "id").groupBy("g").count().collect()
    assert {r["count"] for r in under} == {10}
    assert stats.sample_n(df, 7, "id").collect() == stats.sample_n(df, 7, "id").collect()
    train, test = ml.holdout(df, "g", "id", 0.2)
    assert test.groupBy("g").count().orderBy("g").collect()[0]["count"] == 18 and train.count() == 80
    assert {r["count"] for r in ml.with_folds(df.where("g = 's'"), "g", "id", 5).groupBy("fold").count().collect()} == {2}


def test_numbers_of_many_wide_rows(spark):
    """Rows that are wide enough for the exchange to be coalesced otherwise than a pruned one."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        k = F.xxhash64("id")
        df = spark.range(1_000_000).select(k.alias("k"), F.repeat(F.hex(k), 8).alias("wide"))
        got = stats.numbered(df, ["k"], name="n")
        row = got.agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n"), F.sum(F.length("wide"))).first()
        assert row[:4] == (1_000_000, 1_000_000, 1, 1_000_000)
        last = Window.partitionBy(F.floor(F.col("n") / 1000)).orderBy("n")
        assert got.withColumn("p", F.lag("k").over(last)).where("p >= k").count() == 0
        assert stats.every_nth(df, 10, ["k"]).count() == 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_attributions_by_all_subsets(spark, tmp_path):
    """Shapley values of a small forest against the definition: a weighted mean over all subsets of features."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 4))
    y = (x[:, 0] > 0).astype(int) + ((x[:, 1] > 0.3) & (x[:, 2] < 0.5)).astype(int)
    rows = [(i, *map(float, r), int(k)) for i, (r, k) in enumerate(zip(x, y))]
    names_ = [f"f{i}" for i in range(4)]
    df = spark.createDataFrame(rows, "id long, f0 double, f1 double, f2 double, f3 double, label int")
    run = ml.Training("label", names_, "id", trees=3, depth=4)
    model = ml.fit(df, run)
    got = {r["key"]: r for r in ml.shap_values(model, df, run, str(tmp_path / "forest")).collect()}
    found = ml.leaves(model, str(tmp_path / "forest"))

    def value(row, known):
        return sum(leaf.value * np.prod([float(lo < row[f] <= hi) if f in known else z for f, lo, hi, z in zip(leaf.features, leaf.low, leaf.high, leaf.share)]) for leaf in found)

    for i in range(0, 200, 20):
        for j in range(4):
            others, want = [k for k in range(4) if k != j], 0
            for size in range(4):
                for known in itertools.combinations(others, size):
                    want = want + (value(x[i], {*known, j}) - value(x[i], set(known))) / (4 * math.comb(3, size))
            assert np.allclose([by[j] for by in got[i]["shap"]], want)
        assert np.allclose(np.sum(got[i]["shap"], axis=1) + got[i]["base"], got[i]["probabilities"])
    mean = {(r["class"], r["feature"]): r["mean_abs_shap"] for r in ml.mean_abs_shap(df.sparkSession.createDataFrame(list(got.values())), ml.class_names(model), names_).collect()}
    assert mean["0", "f0"] == pytest.approx(np.mean([abs(r["shap"][0][0]) for r in got.values()])) and mean["0", "f0"] > mean["0", "f3"]


def test_nearest_beyond_the_first_radius(spark):
    cells = joins.fishnet(spark, (0.0, 0.0, 4.0, 2.0), 2.0)
    pts = spark.createDataFrame([(40.0, 1.0, "far"), (1.0, 1.0, None)], "x double, y double, class string")
    got = nearest.nearest_class(cells, pts).orderBy("grid_id").collect()
    assert [(r["class"], r["dist_to_point"]) for r in got] == [("far", 39.0), ("far", 37.0)]
    with pytest.raises(ValueError):
        joins.fishnet(spark, (0, 0, 100, 100), 1.0, most=10)


def test_ties_go_to_the_smallest_class(spark):
    cells = joins.fishnet(spark, (0.0, 0.0, 2.0, 2.0), 2.0)
    pts = spark.createDataFrame([(0.5, 1.0, "b"), (1.5, 1.0, "a"), (1.0, 1.5, None)], "x double, y double, class string")
    assert nearest.majority_class(cells, pts, 1.0).first()["class"] == "a"
    got = nearest.weighted_class(cells, pts, 1.0).first()
    assert got["class"] == "a" and got["class_conf"] == pytest.approx(0.5) and got["n_points"] == 3


def test_polygons_with_holes(spark):
    ring = lambda *p: [{"x": float(a), "y": float(b)} for a, b in p]
    shape = "gid long, rings array<array<struct<x double, y double>>>"
    poly = spark.createDataFrame([(1, [ring((0, 0), (10, 0), (5, 10)), ring((4, 2), (6, 2), (5, 4))])], shape)
    pts = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.5), (3, 1.0, 9.0), (4, 5.0, 6.0)], "pid long, x double, y double")
    assert sorted(r["pid"] for r in joins.in_polygons(pts, poly, 4.0, "pid").collect()) == [1, 4]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "label string, x double")
    assert stats.class_statistics(none, "label", ["x"]).count() == 0
    assert stats.value_counts(none, "label").count() == 0
    assert stats.confusion(none.withColumn("p", F.col("label")), "label", "p").count() == 0


def test_boosted_models_have_importances(spark):
    df = spark.range(120).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 3 + F.rand(1) / 4).alias("f"), F.rand(2).alias("noise"))
    run = ml.Training("g", ["f", "noise"], "id", backend="gbt", trees=2, depth=2)
    model = ml.fit(df, run)
    got = {r["feature"]: r["importance"] for r in ml.importances(spark, model, run.features).collect()}
    assert got["f"] > got["noise"] >= 0 and sum(got.values()) == pytest.approx(1)
    with pytest.raises(ValueError, match="forests"):
        ml.forest_of(model)
