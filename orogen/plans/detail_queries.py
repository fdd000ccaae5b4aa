"""One behaviour for each query, where the wider queries show several at once.

Samples, folds and models are decided by hashes and trees, which SQL has not; these queries show what must hold for
any of them (sizes, subsets, repeats, the same rows on other partitions), and SQL says what that is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.functions import names
from orogen.operators import ml, stats, tables
from orogen.plans.inputs import COMPONENTS, FEATURES, SQL, features, table
from orogen.sources import readers
from orogen.sources.storage import shared_folder

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        f.__name__ = name
        QUERIES[name] = (f, sql)
        return f

    return add


# --- names and numbers --------------------------------------------------------------------------------------------


@query(
    "P57_P58_P59_kinds_of_columns",
    "SELECT column_name AS name, CASE WHEN data_type IN ('VARCHAR') THEN 'string' WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' THEN 'datetime' WHEN data_type LIKE '%INT%' OR data_type IN ('DOUBLE', 'FLOAT') OR data_type LIKE 'DECIMAL%' THEN 'numeric' ELSE 'other' END AS kind "
    "FROM information_schema.columns WHERE table_name IN ('events', 'part', 'embeddings')",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = [(f.name, names.kind_of(f.dataType)) for t in ("events", "part", "embeddings") for f in table(spark, d, t).schema]
    return spark.createDataFrame(rows, "name string, kind string")


@query("P36_P37_filter_by_attribute", "SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 3)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.by_attribute_or_all(table(spark, d, "nation"), "n_regionkey", [1, 3]).select("n_nationkey")


@query("S16_S12_head_rows", "SELECT 7 AS n, count(*) AS n_columns FROM information_schema.columns WHERE table_name = 'customer'")
def _(spark: SparkSession, d: str) -> DataFrame:
    head = readers.read_table(spark, f"{d}/customer.parquet", head=7)
    return head.agg(F.count("*").cast("int").alias("n")).withColumn("n_columns", F.lit(len(head.columns)).cast("long"))


# --- samples ------------------------------------------------------------------------------------------------------


def _compared(sample: DataFrame, again: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """(n, n_distinct, n_foreign: rows that the table lacks, n_other: rows that another partitioning gives or lacks)."""
    foreign = sample.join(whole, key, "left_anti").agg(F.count("*")).scalar()
    other = sample.select(key).exceptAll(again.select(key)).union(again.select(key).exceptAll(sample.select(key))).agg(F.count("*")).scalar()
    return sample.agg(F.count("*").alias("n"), F.countDistinct(key).alias("n_distinct")).select("n", "n_distinct", foreign.alias("n_foreign"), other.alias("n_other"))


@query("O07_O08_O09_S13_samples_of_n", "SELECT least(50, count(*)) AS n, least(50, count(*)) AS n_distinct, 0::BIGINT AS n_foreign, 0::BIGINT AS n_other FROM customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    whole = table(spark, d, "customer").select("c_custkey")
    return _compared(stats.sample_n(whole, 50, "c_custkey"), stats.sample_n(whole.repartition(7), 50, "c_custkey"), whole, "c_custkey")


@query("P40_bernoulli_properties", "SELECT true AS near_a_quarter, 0::BIGINT AS n_repeated, 0::BIGINT AS n_foreign, 0::BIGINT AS n_other FROM (SELECT count(*) FROM customer)")
def _(spark: SparkSession, d: str) -> DataFrame:
    whole = table(spark, d, "customer").select("c_custkey")
    got = _compared(stats.bernoulli(whole, 0.25, "c_custkey"), stats.bernoulli(whole.repartition(7), 0.25, "c_custkey"), whole, "c_custkey")
    total = whole.agg(F.count("*")).scalar()
    within = F.abs(F.col("n") - 0.25 * total) <= 6 * F.sqrt(0.1875 * total)
    return got.select(within.alias("near_a_quarter"), (F.col("n") - F.col("n_distinct")).alias("n_repeated"), "n_foreign", "n_other")


# --- learning -----------------------------------------------------------------------------------------------------

_LABELLED = f"WITH {SQL['feat']} SELECT vec_id, label::DOUBLE AS label FROM feat WHERE label IS NOT NULL"


def _run(**other: object) -> ml.Training:
    return ml.Training(**({"label": "label", "features": FEATURES, "key": "vec_id", "trees": 4, "depth": 4} | other))


@query("M02_medians", f"WITH {SQL['feat']} SELECT feature, round(quantile_cont(x, 0.5), 9) + 0.0 AS median FROM long GROUP BY feature")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = ml.medians(features(spark, d), FEATURES)
    return spark.createDataFrame(list(got.items()), "feature string, median double").withColumn("median", F.round("median", 9) + 0.0)


@query("M05_label_ids", f"WITH {SQL['feat']} SELECT label, row_number() OVER (ORDER BY label) - 1 AS id FROM (SELECT DISTINCT label::VARCHAR AS label FROM feat WHERE label IS NOT NULL)")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = ml.class_names(ml.fit(features(spark, d), _run(trees=2)))
    return spark.createDataFrame(list(zip(got, range(len(got)), strict=True)), "label string, id long")


@query("M14_class_weights", f"WITH {SQL['feat']}, k AS (SELECT label, count(*) AS n FROM feat WHERE label IS NOT NULL GROUP BY label) SELECT label::DOUBLE AS label, round((SELECT sum(n) FROM k) / ((SELECT count(*) FROM k) * n), 9) + 0.0 AS weight FROM k")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = ml.class_weights(features(spark, d).where("label is not null"), "label").select("label", "__weight").distinct()
    return got.select(F.col("label").cast("double").alias("label"), (F.round("__weight", 9) + 0.0).alias("weight"))


@query("M01_M11_M12_M22_every_row_is_predicted", "SELECT vec_id, true AS known, true AS probable FROM embeddings")
def _(spark: SparkSession, d: str) -> DataFrame:
    df = features(spark, d)
    model = ml.fit(df, _run())
    got = ml.predict(model, df, FEATURES)
    return got.select("vec_id", F.col("pred_label").isin(ml.class_names(model)).alias("known"), F.col("proba_max").between(0.0, 1.0).alias("probable"))


@query("M06_every_row_on_one_side", _LABELLED)
def _(spark: SparkSession, d: str) -> DataFrame:
    train, test = ml.holdout(features(spark, d), "label", "vec_id")
    return train.union(test).select("vec_id", F.col("label").cast("double").alias("label"))


@query("M08_every_row_out_of_one_fold", _LABELLED)
def _(spark: SparkSession, d: str) -> DataFrame:
    got = ml.cross_validated(features(spark, d), _run(trees=2), 3).where("pred_label is not null")
    return got.select("vec_id", F.col("label").cast("double").alias("label"))


@query("M07_split_scores", "SELECT i::INT AS split, true AS sane FROM range(3) t(i)")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = ml.monte_carlo(features(spark, d), _run(trees=2), 3)
    return got.select("split", F.least("accuracy", "f1_macro", "f1_weighted").between(0.0, 1.0).alias("sane"))


@query("M09_sizes_of_a_learning_curve", "SELECT * FROM (VALUES (2, true), (4, true)) t(n_estimators, sane)")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = ml.learning_curve(features(spark, d), _run(), [4, 2, 4])
    return got.select("n_estimators", ((F.col("train_logloss") > 0) & (F.col("val_logloss") > 0) & F.col("val_acc").between(0.0, 1.0)).alias("sane"))


@query("M13_shares_of_importance", f"SELECT {COMPONENTS}::BIGINT AS n, 1.0::DOUBLE AS total, true AS none_negative")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = ml.importances(spark, ml.fit(features(spark, d), _run()), FEATURES)
    return got.agg(F.count("*").alias("n"), F.round(F.sum("importance"), 9).alias("total"), (F.min("importance") >= 0).alias("none_negative"))


@query("M18_roots_of_trees", "SELECT i::INT AS tree_id, 1::BIGINT AS n_roots, true AS whole FROM range(4) t(i)")
def _(spark: SparkSession, d: str) -> DataFrame:
    nodes = ml.tree_nodes(ml.fit(features(spark, d), _run()), FEATURES, f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}")
    whole = (F.max("depth") < 4) & (F.count("*") <= 15) & (F.count("threshold") == F.count("*")) & (F.count("feature") == F.count("*"))
    return nodes.groupBy("tree_id").agg(F.sum((F.col("depth") == 0).cast("long")).alias("n_roots"), whole.alias("whole"))


@query("A16_scores_of_trees", "SELECT i::INT AS tree_id, true AS sane FROM range(4) t(i)")
def _(spark: SparkSession, d: str) -> DataFrame:
    df, run = features(spark, d).where("label is not null"), _run()
    got = ml.tree_scores(ml.tree_votes(ml.fit(df, run), df, run))
    return got.select("tree_id", F.least("tree_acc_vs_true", "tree_agree_with_rf").between(0.0, 1.0).alias("sane"))


@query("M23_M24_M30_rows_of_a_batch", "SELECT * FROM (VALUES ('rf_n2_holdout', 'rf', 2, true), ('rf_n3_holdout', 'rf', 3, true)) t(name, backend, trees, sane)")
def _(spark: SparkSession, d: str) -> DataFrame:
    config = ml.config_template(["rf"], [2, 3], "label", FEATURES, "vec_id")
    config["global"] |= {"depth": 3}
    got = ml.run_batch(features(spark, d), config)
    return got.select("name", "backend", "trees", F.least("accuracy", "f1_macro", "f1_weighted").between(0.0, 1.0).alias("sane"))
