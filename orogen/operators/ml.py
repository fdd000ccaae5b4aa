"""Training, validation, prediction and explanation of classifiers with Spark ML.

Splits and folds come from a hash of a key, so they repeat on any cluster. Missing values are replaced by exact medians of the
training rows, kept in the pipeline as one SQL stage.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orogen.operators import selection, stats
from orogen.operators.tables import aligned
from orogen.sources.sinks import load_json, save_json


@dataclass
class Training:
    """Parameters of a run; defaults are those of a usual forest."""

    label: str
    features: list[str]
    key: str
    backend: str = "rf"
    trees: int = 200
    depth: int = 10
    seed: int = 42
    balanced: bool = False
    undersample: int | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.backend not in ("rf", "gbt"):
            raise ValueError("backend must be 'rf' or 'gbt'")


def medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact medians; 0 for a feature without values."""
    found = selection.quantiles(stats.long_form(df, [], features), ["feature"], "x", [0.5]).collect()
    return dict.fromkeys(features, 0.0) | {r["feature"]: float(r["q"][0]) for r in found}


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """With a column `__weight`: n / (classes * n of the class)."""
    sizes = df.groupBy(label).agg(F.count("*").alias("__k"))
    rows, classes = sizes.agg(F.sum("__k")).scalar(), sizes.agg(F.count("*")).scalar()
    weights = sizes.select(F.col(label), (rows / (classes * F.col("__k"))).alias("__weight"))
    return df.join(weights, label)


def fit(df: DataFrame, run: Training) -> PipelineModel:
    """A pipeline from raw columns to the predicted label (as text) and its probabilities."""
    rows = df.where(F.col(run.label).isNotNull())
    if run.undersample is not None:
        rows = stats.undersampled(rows, run.label, run.key, run.undersample, run.seed)
    rows = aligned(rows, run.features).withColumn("__label", F.col(run.label).cast("string"))
    if run.balanced:
        rows = class_weights(rows, "__label")
    fill = ", ".join(f"coalesce(nanvl(try_cast(`{f}` AS DOUBLE), NULL), {m!r}D) AS `__f{i}`" for i, (f, m) in enumerate(medians(rows, run.features).items()))
    inputs = [f"__f{i}" for i in range(len(run.features))]
    options = {"labelCol": "__y", "featuresCol": "__x", "seed": run.seed}
    weight = {"weightCol": "__weight"} if run.balanced else {}
    if run.backend == "rf":
        model = RandomForestClassifier(numTrees=run.trees, maxDepth=min(run.depth, 30), featureSubsetStrategy="sqrt", predictionCol="__p", probabilityCol="__proba", rawPredictionCol="__raw", **options, **weight, **run.extra)
    else:
        one = GBTClassifier(maxIter=run.trees, maxDepth=min(run.depth, 30), stepSize=0.1, subsamplingRate=0.8, **options, **run.extra).setRawPredictionCol("__raw")
        model = OneVsRest(classifier=one, labelCol="__y", featuresCol="__x", predictionCol="__p", rawPredictionCol="__raw", **weight)
    indexer = StringIndexer(inputCol="__label", outputCol="__y", stringOrderType="alphabetAsc", handleInvalid="keep").fit(rows)
    labels = indexer.labels
    stages = [SQLTransformer(statement=f"SELECT *, {fill} FROM __THIS__"), VectorAssembler(inputCols=inputs, outputCol="__x")]
    ready = Pipeline(stages=stages).fit(rows)
    prepared = ready.transform(indexer.transform(rows))
    fitted = model.fit(prepared)
    return PipelineModel([*ready.stages, fitted, IndexToString(inputCol="__p", outputCol="pred_label", labels=labels)])


def class_names(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].getLabels())


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str], top: int = 3) -> DataFrame:
    """`df` with pred_label, proba_max and the `top` classes; features are found under other spellings or count as missing."""
    names = class_names(model)
    got = model.transform(aligned(df, features))
    if "__proba" in got.columns:
        p = vector_to_array("__proba")
    else:  # one-against-rest margins, as shares by softmax
        raw = F.transform(vector_to_array("__raw"), lambda x: F.exp(x))
        p = F.transform(raw, lambda x: x / F.aggregate(raw, F.lit(0.0), lambda a, b: a + b))
    p = F.slice(p, 1, len(names))
    new = [F.array_max(p).alias("proba_max"), stats.top_classes(names, p, top).alias("top_classes"), p.alias("probabilities")]
    kept = [c for c in df.columns if c not in ("pred_label", "proba_max", "top_classes", "probabilities")]
    return got.select(*kept, "pred_label", *new)


# --- splits and validation ----------------------------------------------------------------------------------------


def holdout(df: DataFrame, label: str, key: str, share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): the same share of each class, rounded down."""
    marked = selection.placed(df.where(F.col(label).isNotNull()), label, key, seed, "__place", "__size").withColumn("__test", F.col("__place") <= F.floor(F.col("__size") * F.lit(share)))
    return tuple(marked.where(side).select(df.columns) for side in ("not __test", "__test"))


def with_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """With a column `fold`: each class is dealt evenly over the folds."""
    placed = selection.placed(df.where(F.col(label).isNotNull()), label, key, seed, "__place", "__size")
    return placed.withColumn("fold", ((F.col("__place") - 1) % k).cast("int")).drop("__place", "__size")


def scores(predicted: DataFrame, label: str) -> dict[str, float]:
    """accuracy, f1_macro and f1_weighted, from the class report."""
    rows = {r["class"]: r for r in stats.class_report(predicted, label, "pred_label").collect()}
    return {"accuracy": rows["accuracy"]["f1"], "f1_macro": rows["macro avg"]["f1"], "f1_weighted": rows["weighted avg"]["f1"]}


def monte_carlo(df: DataFrame, run: Training, splits: int = 10, share: float = 0.2) -> DataFrame:
    """(split, accuracy, f1_macro, f1_weighted) of repeated hold-outs."""
    rows = []
    for i in range(splits):
        train, test = holdout(df, run.label, run.key, share, run.seed + i)
        got = scores(predict(fit(train, run), test, run.features), run.label)
        rows.append((i, got["accuracy"], got["f1_macro"], got["f1_weighted"]))
    return df.sparkSession.createDataFrame(rows, "split int, accuracy double, f1_macro double, f1_weighted double")


def cross_validated(df: DataFrame, run: Training, k: int = 5) -> DataFrame:
    """Every labelled row with the prediction of the model that did not see it."""
    folded, out = with_folds(df, run.label, run.key, k, run.seed), None
    for i in range(k):
        part = predict(fit(folded.where(F.col("fold") != i), run), folded.where(F.col("fold") == i), run.features)
        out = part if out is None else out.unionByName(part)
    return out


def mean_scores(per_split: DataFrame) -> DataFrame:
    """(metric, mean, std) with the population deviation."""
    long = per_split.unpivot([], ["accuracy", "f1_macro", "f1_weighted"], "metric", "x")
    return long.groupBy("metric").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))


def log_loss(predicted: DataFrame, label: str, names: Sequence[str]) -> Column:
    """Aggregate: mean negative log probability of the true class."""
    at = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(label).cast("string"))
    p = F.try_element_at("probabilities", at.cast("int"))
    return F.avg(-F.log(F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(1e-15))))


def learning_curve(df: DataFrame, run: Training, sizes: Sequence[int], share: float = 0.2) -> DataFrame:
    """(n_estimators, train_logloss, val_logloss, val_acc, val_f1) for up to ten sizes of forest."""
    train, test = holdout(df, run.label, run.key, share, run.seed)
    rows = []
    for n in sorted(set(sizes))[:10]:
        model = fit(train, Training(**(asdict(run) | {"trees": n})))
        losses = [predict(model, part, run.features).agg(log_loss(part, run.label, class_names(model))).first()[0] for part in (train, test)]
        got = scores(predict(model, test, run.features), run.label)
        rows.append((n, *losses, got["accuracy"], got["f1_macro"]))
    return df.sparkSession.createDataFrame(rows, "n_estimators int, train_logloss double, val_logloss double, val_acc double, val_f1 double")


# --- explanation --------------------------------------------------------------------------------------------------


def forest_of(model: PipelineModel):
    """The forest of a pipeline; boosted pipelines have one sequence of regression trees for each class instead."""
    found = next((s for s in model.stages if isinstance(s, RandomForestClassificationModel)), None)
    if found is None:
        raise ValueError("only forests ('rf') are explained tree by tree; boosted models have importances and permutation_importance")
    return found


def importances(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance): Spark's own shares; for boosted models the mean over the classes' models, scaled to a sum of one."""
    each = [m.featureImportances.toArray() for s in model.stages for m in getattr(s, "models", [s]) if hasattr(m, "featureImportances")]
    mean = np.mean(each, axis=0)
    values = (mean / (mean.sum() or 1.0)).tolist()
    return spark.createDataFrame(list(zip(features, values, strict=True)), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def permutation_importance(model: PipelineModel, df: DataFrame, run: Training) -> DataFrame:
    """(class, feature, drop): how much a true class's recall falls when the feature's values change places among the rows."""
    rows = stats.numbered(df.where(F.col(run.label).isNotNull()), [run.key], name="__n")
    base = predict(model, rows, run.features)
    hit = (F.col(run.label).cast("string") == F.col("pred_label")).cast("double")
    out = base.groupBy(F.col(run.label).cast("string").alias("class")).agg(F.avg(hit).alias("base"))
    parts = None
    for feature in run.features:
        shuffled = rows.select(F.col(feature).alias("__v"), stats.hashed(F.col(run.key), run.seed).alias("__h"), F.col(run.key).alias("__k"))
        shuffled = stats.numbered(shuffled, ["__h", "__k"], name="__n").select("__n", "__v")
        moved = rows.drop(feature).join(shuffled, "__n").withColumnRenamed("__v", feature)
        part = predict(model, moved, run.features).groupBy(F.col(run.label).cast("string").alias("class")).agg(F.avg(hit).alias("now"))
        part = part.withColumn("feature", F.lit(feature))
        parts = part if parts is None else parts.unionByName(part)
    return parts.join(out, "class").select("class", "feature", (F.col("base") - F.col("now")).alias("drop"))


@dataclass
class Leaf:
    """A leaf of one tree: the features on its way with the range (low, high] that leads here, the share of rows that the ranges let through, and its class shares."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaves(model: PipelineModel, path: str) -> list[Leaf]:
    """The leaves of all trees, read from the model as it is stored at `path`; values are divided by the number of trees."""
    forest = forest_of(model)
    forest.write().overwrite().save(path)
    n = F.col("nodeData")
    data = SparkSession.active().read.parquet(f"{path}/data")
    rows = data.select(F.col("treeID").alias("tree"), n["id"].alias("id"), n["leftChild"].alias("l"), n["rightChild"].alias("r"), n["split"]["featureIndex"].alias("f"), n["split"]["leftCategoriesOrThreshold"].alias("t"), n["impurityStats"].alias("stats"))
    nodes = {(r["tree"], r["id"]): r for r in rows.collect()}  # a model: trees times 2 ** depth rows
    trees = len({tree for tree, _ in nodes})
    out = []
    waiting = [(tree, 0, {}) for tree in sorted({tree for tree, _ in nodes})]
    while waiting:
        tree, at, way = waiting.pop()
        node = nodes[tree, at]
        total = sum(node["stats"])
        if node["l"] < 0:
            keys = sorted(way)
            low, high, share = (np.array([way[k][i] for k in keys]) for i in range(3))
            out.append(Leaf(np.array(keys, dtype=int), low, high, share, np.array(node["stats"]) / total / trees))
            continue
        low, high, share = way.get(node["f"], (-np.inf, np.inf, 1.0))
        threshold = node["t"][0]
        for child, ends in ((node["l"], (low, min(high, threshold))), (node["r"], (max(low, threshold), high))):
            waiting.append((tree, child, {**way, node["f"]: (*ends, share * sum(nodes[tree, child]["stats"]) / total)}))
    return out


def attributions(x: np.ndarray, found: Sequence[Leaf]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, classes, features) Shapley values of the class shares, and the shares that are expected without any feature.

    A leaf's value times, for each feature on its way, either whether the row is in its range (the feature is known) or
    the share of rows that are (unknown): in such a product game a feature's value needs only the elementary symmetric sums
    of the others, one polynomial for each feature of a leaf.
    """
    out, base = np.zeros((len(x), len(found[0].value), x.shape[1])), np.zeros(len(found[0].value))
    for leaf in found:
        m = len(leaf.features)
        base += leaf.value * leaf.share.prod()
        own = x[:, leaf.features]
        inside = ((own > leaf.low) & (own <= leaf.high)).astype(float)
        weights = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
        for j in range(m):
            sums = np.zeros((len(x), m))
            sums[:, 0] = 1.0
            for i in range(m):
                if i != j:
                    sums[:, 1:] = sums[:, 1:] * leaf.share[i] + sums[:, :-1] * inside[:, i : i + 1]
                    sums[:, 0] *= leaf.share[i]
            out[:, :, leaf.features[j]] += ((inside[:, j] - leaf.share[j]) * (sums @ weights))[:, None] * leaf.value
    return out, base


def shap_values(model: PipelineModel, df: DataFrame, run: Training, path: str) -> DataFrame:
    """(key, truth, pred_label, probabilities, base, shap: by class and feature): base and the row's values of a class add up to its probability."""
    found = leaves(model, path)
    rows = model.transform(aligned(df, run.features)).select(
        F.col(run.key).alias("key"), F.col(run.label).cast("string").alias("truth"), "pred_label", vector_to_array("__proba").alias("probabilities"), vector_to_array("__x").alias("x")
    )

    def explained(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at : at + 1000]
                values, base = attributions(np.stack(part["x"].to_list()), found)
                yield part.drop(columns="x").assign(base=[base] * len(part), shap=[list(v) for v in values])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInPandas(explained, f"key {kind}, truth string, pred_label string, probabilities array<double>, base array<double>, shap array<array<double>>")


def mean_abs_shap(values: DataFrame, names: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(class, feature, mean_abs_shap)."""
    long = values.select(F.posexplode("shap").alias("c", "by_feature")).select("c", F.posexplode("by_feature").alias("f", "v"))
    named = [F.get(F.array(*[F.lit(n) for n in of]), F.col(at)).alias(to) for of, at, to in ((names, "c", "class"), (features, "f", "feature"))]
    return long.groupBy("c", "f").agg(F.avg(F.abs("v")).alias("mean_abs_shap")).select(*named, "mean_abs_shap").where("class is not null")


def tree_votes(model: PipelineModel, df: DataFrame, run: Training) -> DataFrame:
    """(key, truth, pred_label, tree_id, vote): each tree's class for each row. Trees run one after another on the same columns."""
    forest, names = forest_of(model), class_names(model)
    got = model.transform(aligned(df, run.features))
    columns = []
    for i, tree in enumerate(forest.trees):
        tree.setFeaturesCol("__x").setPredictionCol(f"__t{i}").setProbabilityCol(f"__tp{i}").setRawPredictionCol(f"__tr{i}")
        got = tree.transform(got)
        columns.append(f"__t{i}")
    votes = F.posexplode(F.array(*[F.col(c) for c in columns])).alias("tree_id", "__v")
    rows = got.select(F.col(run.key).alias("key"), F.col(run.label).cast("string").alias("truth"), "pred_label", votes)
    return rows.select("key", "truth", "pred_label", "tree_id", F.get(F.array(*[F.lit(n) for n in names]), F.col("__v").cast("int")).alias("vote"))


def tree_scores(votes: DataFrame) -> DataFrame:
    """Per tree: accuracy against the truth and agreement with the forest."""
    ratio = lambda c: F.avg((F.col("vote") == F.col(c)).cast("int"))
    return votes.groupBy("tree_id").agg(ratio("truth").alias("tree_acc_vs_true"), ratio("pred_label").alias("tree_agree_with_rf"))


def tree_contributions(votes: DataFrame, top: int) -> DataFrame:
    """Per class and tree, over rows the forest has right: right votes, rows, rate, rank, and whether among the `top`."""
    right = votes.where("truth = pred_label")
    got = right.groupBy(F.col("truth").alias("class"), "tree_id").agg(F.sum((F.col("vote") == F.col("truth")).cast("int")).alias("correct_votes"), F.count("*").alias("n_samples"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("correct_votes"), "tree_id"))
    return got.withColumns({"rate": F.col("correct_votes") / F.col("n_samples"), "rank_all": rank}).withColumn("selected", F.col("rank_all") <= top)


def tree_nodes(model: PipelineModel, features: Sequence[str], path: str) -> DataFrame:
    """(tree_id, node_id, depth, feature, threshold) of the inner nodes, read from the model as it is stored at `path`."""
    forest = forest_of(model)
    forest.write().overwrite().save(path)
    n = F.col("nodeData")
    data = SparkSession.active().read.parquet(f"{path}/data")
    nodes = data.select(F.col("treeID").alias("tree_id"), n["id"].alias("node_id"), n["leftChild"].alias("l"), n["rightChild"].alias("r"), n["split"]["featureIndex"].alias("f"), n["split"]["leftCategoriesOrThreshold"][0].alias("threshold"))
    inner = nodes.where("l >= 0")
    level, out = inner.where("node_id = 0").withColumn("depth", F.lit(0)), None
    for _ in range(forest.getMaxDepth()):
        out = level if out is None else out.unionByName(level)
        below = level.select("tree_id", F.explode(F.array("l", "r")).alias("node_id"), (F.col("depth") + 1).alias("depth"))
        level = inner.join(below, ["tree_id", "node_id"])
    names = F.array(*[F.lit(f) for f in features])
    return out.select("tree_id", "node_id", "depth", F.get(names, F.col("f")).alias("feature"), "threshold")


def split_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("tree_id", "feature").agg(F.count("*").alias("split_count")).orderBy("tree_id", F.desc("split_count"), "feature")


def tree_texts(model: PipelineModel, which: Sequence[int] | None = None) -> dict[int, str]:
    """Readable rules of some trees."""
    trees = forest_of(model).trees
    return {i: trees[i].toDebugString for i in (which if which is not None else range(len(trees)))}


# --- runs ---------------------------------------------------------------------------------------------------------


def metadata(model: PipelineModel, run: Training, run_id: str, source: str, validation: dict | None = None) -> dict:
    names = class_names(model)
    return {
        "run_id": run_id,
        "source_path": source,
        "target_col": run.label,
        "feature_cols": run.features,
        "class_names": names,
        "label_encoder": {n: i for i, n in enumerate(names)},
        "validation": validation or {},
        "train_params": asdict(run),
    }


def save(model: PipelineModel, meta: dict, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    save_json(SparkSession.active(), f"{path}/meta", meta)


def load(path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), load_json(SparkSession.active(), f"{path}/meta")


def merged(config: dict) -> list[dict]:
    """The runs of a batch, each over the global settings."""
    if "runs" not in config:
        raise ValueError("a batch needs 'runs'")
    return [{**config.get("global", {}), **run} for run in config["runs"]]


def config_template(backends: Sequence[str], tree_counts: Sequence[int], label: str, features: Sequence[str], key: str, validations: Sequence[str] = ("holdout",)) -> dict:
    """A sweep over backends, forest sizes and ways of validation."""
    runs = [{"name": f"{b}_n{n}_{v}", "backend": b, "trees": n, "validation": v} for b in backends for n in tree_counts for v in validations]
    return {"global": {"label": label, "features": list(features), "key": key}, "runs": runs}


def run_batch(df: DataFrame, config: dict) -> DataFrame:
    """(name, backend, trees, accuracy, f1_macro, f1_weighted): the runs of a batch one after another."""
    rows = []
    for settings in merged(config):
        own = {k: v for k, v in settings.items() if k in Training.__dataclass_fields__}
        run = Training(**own)
        kind = settings.get("validation", "holdout")
        if kind == "kfold":
            got = scores(cross_validated(df, run, settings.get("folds", 5)), run.label)
        elif kind == "montecarlo":
            means = {r["metric"]: r["mean"] for r in mean_scores(monte_carlo(df, run, settings.get("splits", 10))).collect()}
            got = {m: means[m] for m in ("accuracy", "f1_macro", "f1_weighted")}
        else:
            train, test = holdout(df, run.label, run.key, settings.get("test_size", 0.2), run.seed)
            got = scores(predict(fit(train, run), test, run.features), run.label)
        rows.append((settings.get("name", ""), run.backend, run.trees, got["accuracy"], got["f1_macro"], got["f1_weighted"]))
    return df.sparkSession.createDataFrame(rows, "name string, backend string, trees int, accuracy double, f1_macro double, f1_weighted double")
