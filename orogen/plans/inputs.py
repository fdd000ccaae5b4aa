"""How the test tables stand for rasters, points, rectangles and labels; `SQL` has the same as common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 100
#: Components of a vector of the test tables; each is a feature.
COMPONENTS = 64
FEATURES = [f"f{i}" for i in range(COMPONENTS)]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dem(spark: SparkSession, d: str, gaps: bool = False) -> DataFrame:
    """A grid of `WIDTH` columns from events; with gaps, one in five cells has no data."""
    z = F.when(F.col("event_type") != "error", F.col("value")) if gaps else F.col("value")
    return table(spark, d, "events").select(F.expr(f"event_id div {WIDTH}").alias("r"), (F.col("event_id") % WIDTH).alias("c"), z.alias("z"))


def dem_rows(spark: SparkSession, d: str) -> int:
    return -(-table(spark, d, "events").count() // WIDTH)


def points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("pid"),
        (F.col("c_custkey") % 50 + 0.25).cast("double").alias("x"),
        (F.expr("c_custkey div 50") + 0.25).cast("double").alias("y"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("class"),
        F.col("c_acctbal").alias("v"),
    )


def rectangles(spark: SparkSession, d: str, side: int = 10) -> DataFrame:
    x, y = F.col("n_nationkey") % 5 * 10, F.expr("n_nationkey div 5") * 10
    return table(spark, d, "nation").select(
        F.col("n_nationkey").cast("long").alias("gid"),
        *[v.cast("double").alias(n) for v, n in ((x, "xmin"), (y, "ymin"), (x + side, "xmax"), (y + side, "ymax"))],
        F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).alias("attr"),
        F.col("n_regionkey").cast("long").alias("region"),
    )


def features(spark: SparkSession, d: str) -> DataFrame:
    got = table(spark, d, "embeddings")
    return got.select("vec_id", F.when(F.col("label") != 9, F.col("label")).cast("long").alias("label"), *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(COMPONENTS)])


def codes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where("p_size % 5 <> 0").select(F.col("p_size").cast("long").alias("five"), (F.col("p_size") * 100 + 1).cast("long").alias("seven")).distinct()


def judged(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a truth and a prediction: a quality label against a rule on the length."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return docs.join(labels, "doc_id").select(
        "doc_id",
        (F.col("quality") * 2 + F.col("toxic")).cast("long").alias("truth"),
        F.when(F.col("n_chars") > 3000, 2).when(F.col("n_chars") > 1000, 3).otherwise(0).cast("long").alias("pred"),
        (F.col("n_chars") % 100 / 100.0).cast("double").alias("proba_max"),
    )


def mixed(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(k).alias("t"), "value", "event_type")


#: The same inputs for the SQL oracles.
SQL = {
    "dem": f"dem AS (SELECT event_id // {WIDTH} AS r, event_id % {WIDTH} AS c, value AS z FROM events)",
    "demn": f"dem AS (SELECT event_id // {WIDTH} AS r, event_id % {WIDTH} AS c, CASE WHEN event_type <> 'error' THEN value END AS z FROM events)",
    "pts": "pts AS (SELECT c_custkey AS pid, c_custkey % 50 + 0.25::DOUBLE AS x, c_custkey // 50 + 0.25::DOUBLE AS y, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS class, c_acctbal AS v FROM customer)",
    "rects": "rects AS (SELECT n_nationkey::BIGINT AS gid, (n_nationkey % 5 * 10)::DOUBLE AS xmin, (n_nationkey // 5 * 10)::DOUBLE AS ymin, (n_nationkey % 5 * 10 + {side})::DOUBLE AS xmax, (n_nationkey // 5 * 10 + {side})::DOUBLE AS ymax, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS attr, n_regionkey::BIGINT AS region FROM nation)",
    "feat": "feat AS (SELECT vec_id, CASE WHEN label <> 9 THEN label END::BIGINT AS label, "
    + ", ".join(f"embedding[{i + 1}]::DOUBLE AS f{i}" for i in range(COMPONENTS))
    + f" FROM embeddings), long AS (UNPIVOT feat ON {', '.join(FEATURES)} INTO NAME feature VALUE x)",
    "codes": "codes AS (SELECT DISTINCT p_size::BIGINT AS five, (p_size * 100 + 1)::BIGINT AS seven FROM part WHERE p_size % 5 <> 0)",
    "judged": "judged AS (SELECT doc_id, (quality * 2 + toxic)::BIGINT AS truth, CASE WHEN n_chars > 3000 THEN 2 WHEN n_chars > 1000 THEN 3 ELSE 0 END::BIGINT AS pred, (n_chars % 100 / 100.0)::DOUBLE AS proba_max FROM documents JOIN labels USING (doc_id))",
    "mixed": "mixed AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS t, value, event_type FROM events)",
}
