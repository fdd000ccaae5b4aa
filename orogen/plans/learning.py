"""Queries that train, validate, predict and explain; rows only, as SQL has no learners."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.operators import ml, stats
from orogen.plans.inputs import FEATURES, SQL, features
from orogen.sources.storage import shared_folder

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        f.__name__ = name
        QUERIES[name] = (f, sql)
        return f

    return add


def _run(**other: object) -> ml.Training:
    return ml.Training(**({"label": "label", "features": FEATURES, "key": "vec_id", "trees": 10, "depth": 5} | other))


@query("M01_M02_M03_M05_M11_M12_M22_forest_predictions")
def _(spark: SparkSession, d: str) -> DataFrame:
    train, test = ml.holdout(features(spark, d), "label", "vec_id")
    return ml.predict(ml.fit(train, _run()), test, FEATURES).select("vec_id", "label", "pred_label", "proba_max")


@query("M14_M15_balanced_forest_top_classes")
def _(spark: SparkSession, d: str) -> DataFrame:
    df = features(spark, d)
    return ml.predict(ml.fit(df, _run(balanced=True, undersample=30)), df, FEATURES).select("vec_id", "pred_label", "proba_max", "top_classes")


@query("M04_boosted_trees")
def _(spark: SparkSession, d: str) -> DataFrame:
    df = features(spark, d)
    return ml.predict(ml.fit(df, _run(backend="gbt", trees=3, depth=6)), df, FEATURES).select("vec_id", "pred_label", "proba_max")


@query(
    "M06_holdout_sizes",
    f"WITH {SQL['feat']}, k AS (SELECT label, count(*) AS n FROM feat WHERE label IS NOT NULL GROUP BY label) SELECT label::DOUBLE AS label, n - floor(n * 0.2)::BIGINT AS n_train, floor(n * 0.2)::BIGINT AS n_test FROM k",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    train, test = ml.holdout(features(spark, d), "label", "vec_id")
    sizes = [part.groupBy(F.col("label").cast("double").alias("label")).agg(F.count("*").alias(n)) for part, n in ((train, "n_train"), (test, "n_test"))]
    return sizes[0].join(sizes[1], "label")


@query("M08_fold_sizes", f"WITH {SQL['feat']}, k AS (SELECT label, row_number() OVER (PARTITION BY label) AS i FROM feat WHERE label IS NOT NULL) SELECT ((i - 1) % 5)::BIGINT AS fold, count(*) AS n FROM k GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return ml.with_folds(features(spark, d), "label", "vec_id").groupBy(F.col("fold").cast("long").alias("fold")).agg(F.count("*").alias("n"))


@query("M08_kfold_out_of_fold")
def _(spark: SparkSession, d: str) -> DataFrame:
    return ml.cross_validated(features(spark, d), _run(trees=5), 3).select("vec_id", "fold", "label", "pred_label")


@query("M07_A26_monte_carlo")
def _(spark: SparkSession, d: str) -> DataFrame:
    return ml.mean_scores(ml.monte_carlo(features(spark, d), _run(trees=5), 2))


@query("M09_learning_curve")
def _(spark: SparkSession, d: str) -> DataFrame:
    return ml.learning_curve(features(spark, d), _run(), [2, 5])


@query("M13_O01_importances")
def _(spark: SparkSession, d: str) -> DataFrame:
    return ml.importances(spark, ml.fit(features(spark, d), _run()), FEATURES)


@query("M18_M19_O02_tree_nodes")
def _(spark: SparkSession, d: str) -> DataFrame:
    model = ml.fit(features(spark, d), _run(trees=4, depth=3))
    return ml.tree_nodes(model, FEATURES, f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}")


@query("M20_one_vote_a_tree_and_row", f"WITH {SQL['feat']} SELECT t.tree_id::INT AS tree_id, count(*) AS n_votes, count(*) AS n_known FROM feat, range(4) t(tree_id) WHERE label IS NOT NULL GROUP BY t.tree_id")
def _(spark: SparkSession, d: str) -> DataFrame:
    df, run = features(spark, d).where("label is not null"), _run(trees=4)
    known = df.select(F.col("label").cast("string").alias("vote")).distinct()
    votes = ml.tree_votes(ml.fit(df, run), df, run)
    known_votes = votes.join(F.broadcast(known), "vote", "left_semi").groupBy("tree_id").agg(F.countDistinct("key").alias("n_known"))
    return votes.groupBy("tree_id").agg(F.count("*").alias("n_votes")).join(known_votes, "tree_id")


@query("M20_A16_tree_scores")
def _(spark: SparkSession, d: str) -> DataFrame:
    df, run = features(spark, d).where("label is not null"), _run(trees=4)
    return ml.tree_scores(ml.tree_votes(ml.fit(df, run), df, run))


@query("A17_W61_tree_contributions")
def _(spark: SparkSession, d: str) -> DataFrame:
    df, run = features(spark, d).where("label is not null"), _run(trees=4)
    return ml.tree_contributions(ml.tree_votes(ml.fit(df, run), df, run), top=2)


def _forest_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"


@query("M21_tree_shap_adds_up", "SELECT vec_id, 0.0::DOUBLE AS gap FROM embeddings")
def _(spark: SparkSession, d: str) -> DataFrame:
    df, run = features(spark, d), _run(trees=4)
    got = ml.shap_values(ml.fit(df, run), df, run, _forest_folder(spark))
    total = F.transform("shap", lambda by, k: F.aggregate(by, F.get("base", k), lambda a, b: a + b))
    gaps = F.zip_with(total, "probabilities", lambda a, b: F.abs(a - b))
    return got.select(F.col("key").alias("vec_id"), (F.round(F.array_max(gaps), 9) + 0.0).alias("gap"))


@query("A18_mean_abs_shap", f"WITH {SQL['feat']} SELECT DISTINCT label::VARCHAR AS class, feature, true AS sane FROM long WHERE label IS NOT NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    df, run = features(spark, d), _run(trees=4)
    model = ml.fit(df, run)
    got = ml.mean_abs_shap(ml.shap_values(model, df, run, _forest_folder(spark)), ml.class_names(model), run.features)
    return got.select("class", "feature", F.col("mean_abs_shap").between(0.0, 1.0).alias("sane"))


@query("M21_A18_W62_permutation_importance")
def _(spark: SparkSession, d: str) -> DataFrame:
    df, run = features(spark, d), _run(trees=4, features=FEATURES[:3])
    got = ml.permutation_importance(ml.fit(df, run), df, run)
    return stats.numbered(got.withColumn("k", -F.col("drop")), ["k", "feature"], ["class"], "rank").drop("k")


@query("M23_M24_M25_M30_J28_K31_batch_of_runs")
def _(spark: SparkSession, d: str) -> DataFrame:
    config = ml.config_template(["rf"], [2, 4], "label", FEATURES, "vec_id")
    config["global"] |= {"depth": 3}
    return ml.run_batch(features(spark, d), config)
