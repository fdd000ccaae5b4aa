"""Queries over tables: filters, edits, counts, statistics, joins, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.functions import geometry, names
from orogen.operators import joins, nearest, outlines, stats, tables
from orogen.plans.features import training_points
from orogen.plans.inputs import COMPONENTS, FEATURES, SQL, codes, dem, features, judged, mixed, points, rectangles, table
from orogen.sources.sinks import split_parts

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
#: Values on exact halves would round by their last bit; moved by this, both sides round them alike.
SHIFT = 3e-9
RECTS = SQL["rects"].format(side=10)
#: Neighbours overlap: a point lies in up to four.
OVERLAP = SQL["rects"].format(side=12)
#: Wide enough for all rectangles to have a common part.
COMMON = SQL["rects"].format(side=60)


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        f.__name__ = name
        QUERIES[name] = (f, sql)
        return f

    return add


def near(x: str | Column, digits: int = 6) -> Column:
    return F.round((F.col(x) if isinstance(x, str) else x) + F.lit(SHIFT), digits) + F.lit(0.0)


def near_sql(x: str, digits: int = 6) -> str:
    return f"round(({x}) + {SHIFT}, {digits}) + 0.0"


# --- filters and edits --------------------------------------------------------------------------------------------

_CONDITIONS = [{"col": "value", "op": "between", "values": [10, 200]}, {"col": "event_type", "op": "!=", "values": ["error"]}, {"col": "t", "op": "in", "values": ["1", "5", "9", "n/a"]}]


@query("P01_P04_P05_filter_conditions", f"WITH {SQL['mixed']} SELECT event_id, t, value, event_type FROM mixed WHERE value BETWEEN 10 AND 200 AND event_type IS DISTINCT FROM 'error' AND t IN ('1', '5', '9', 'n/a')")
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.filtered(mixed(spark, d), [*_CONDITIONS, {"col": "absent", "op": "==", "values": [1]}])


@query("P02_P03_sql_where_clause", f"WITH {SQL['mixed']} SELECT event_id FROM mixed WHERE value BETWEEN 10 AND 200 AND event_type <> 'error' AND t IN ('1', '5', '9', 'n/a')")
def _(spark: SparkSession, d: str) -> DataFrame:
    text, args = tables.where_clause(_CONDITIONS)
    return spark.sql(f"SELECT event_id FROM {{m}} WHERE {text}", args=args, m=mixed(spark, d))


@query("P06_set_filter_with_null", f"WITH {SQL['pts']} SELECT pid, class FROM pts WHERE class IN ('BUILDING', 'MACHINERY') OR class IS NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d).where(tables.one_of("class", ["BUILDING", "MACHINERY"], with_null=True)).select("pid", "class")


@query("P07_regex_filter", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^s.*(ing|t)$')")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(tables.matches("p_name", "^s.*(ing|t)$")).select("p_partkey", "p_name")


@query(
    "P08_P09_overwrite_and_replace",
    "SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL WHEN p_size < 5 THEN 'tiny' ELSE p_type END AS p_type, CASE WHEN p_size > 10 THEN regexp_replace(p_brand, '#(\\d)', '-\\1', 'g') ELSE p_brand END AS p_brand FROM part",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    out = tables.overwrite(table(spark, d, "part"), "p_type", F.col("p_size") > 40, "")
    out = tables.overwrite(out, "p_type", F.col("p_size") < 5, "tiny")
    return tables.replace_text(out, "p_brand", F.col("p_size") > 10, r"#(\d)", "-$1").select("p_partkey", "p_type", "p_brand")


@query(
    "P10_P11_P17_add_and_multiply",
    f"WITH {SQL['mixed']} SELECT event_id, CASE WHEN value > 50 THEN TRY_CAST(t AS DOUBLE) + 2.5 ELSE TRY_CAST(t AS DOUBLE) END AS t, {near_sql('CASE WHEN value > 50 THEN value * 1.5 ELSE value END')} AS value FROM mixed",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    big = F.col("value") > 50
    out = tables.add(mixed(spark, d), "t", big, 2.5)
    return tables.multiply(out, "value", big, 1.5).select("event_id", "t", near("value").alias("value"))


@query("P12_delete_rows", f"WITH {SQL['pts']} SELECT pid FROM pts WHERE NOT coalesce(v < 0, FALSE)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.delete(points(spark, d), F.col("v") < 0).select("pid")


@query("P13_P15_coerce_for_write", f"WITH {SQL['mixed']} SELECT event_id, TRY_CAST(TRY_CAST(t AS DOUBLE) AS BIGINT)::DOUBLE AS t, value::VARCHAR AS value FROM mixed")
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.coerced(tables.coerced(mixed(spark, d), "t", "numeric"), "value", "string").select("event_id", F.col("t").cast("double").alias("t"), "value")


@query(
    "P14_A29_parse_rates",
    f"WITH {SQL['mixed']}, x AS (SELECT 't' AS \"column\", avg((TRY_CAST(t AS DOUBLE) IS NOT NULL)::INT) AS rate FROM mixed UNION ALL SELECT 'event_type', avg((TRY_CAST(event_type AS DOUBLE) IS NOT NULL)::INT) FROM mixed UNION ALL SELECT 'value', avg((value IS NOT NULL)::INT) FROM mixed) SELECT \"column\", {near_sql('rate')} AS rate, CASE WHEN rate >= 0.95 THEN 'numeric' WHEN rate <= 0.05 THEN 'string' ELSE 'mixed' END AS kind FROM x",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.parse_rates(mixed(spark, d), ["t", "event_type", "value"]).withColumn("rate", near("rate"))


@query("P16_P33_P34_missing_values", f"WITH {SQL['pts']} SELECT pid FROM pts WHERE class IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.present(points(spark, d).where(~tables.is_missing(F.col("class"), numeric=False)), ["x", "y"]).select("pid")


@query("P18_P28_projection_by_pattern", "SELECT p_partkey, p_size, p_brand FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return tables.projected(part, ["P_PARTKEY", "p_Size", "nothing", *names.columns_like(part, "brand$")])


@query("P19_P20_P21_P22_P23_P24_P25_P26_P27_column_specs", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return part.select(*names.columns("0, p_brand, 2-4", part.columns))


@query("P29_P30_P56_align_features", "SELECT p_partkey, p_size::DOUBLE AS \"P-SIZE\", NULL::DOUBLE AS slope FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.aligned(table(spark, d, "part"), ["P-SIZE", "slope"]).select("p_partkey", "P-SIZE", "slope")


@query("P31_P32_confidence_and_correctness", f"WITH {SQL['judged']} SELECT doc_id, proba_max >= 0.6 AS is_confident, CASE WHEN proba_max >= 0.6 THEN pred END::DOUBLE AS pred_masked, truth = pred AS is_correct FROM judged")
def _(spark: SparkSession, d: str) -> DataFrame:
    out = tables.with_correctness(tables.confident(judged(spark, d), "pred", "proba_max", 0.6), "truth", "pred")
    return out.select("doc_id", "is_confident", F.col("pred_masked").cast("double").alias("pred_masked"), "is_correct")


@query("P36_P37_filter_or_all", "SELECT n_nationkey FROM nation")
def _(spark: SparkSession, d: str) -> DataFrame:
    return tables.by_attribute_or_all(table(spark, d, "nation"), "n_name", ["NOWHERE"]).select("n_nationkey")


@query("P38_O12_W60_thin_every_nth", "SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS n FROM customer) WHERE (n - 1) % 7 = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.every_nth(table(spark, d, "customer"), 7, ["c_acctbal", "c_custkey"]).select("c_custkey")


@query("P39_grid_stride", f"WITH {SQL['dem']} SELECT r, c, z FROM dem WHERE r % 4 = 0 AND c % 4 = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.grid_stride(dem(spark, d), 4, "c", "r")


@query("P40_bernoulli_sample")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.bernoulli(table(spark, d, "customer"), 0.25, "c_custkey").select("c_custkey")


@query(
    "P41_P42_P43_P44_rename_files",
    "SELECT p_partkey, CASE WHEN contains(n, 'red') OR contains(n, 'bolt') THEN regexp_replace(n, '\\.[^.]*$', '') || '_v2.tif' ELSE n END AS file, regexp_replace(p_name, '[\\\\/:*?\"<>|\\s]+', '_', 'g') AS safe FROM (SELECT *, replace(p_name, ' ring', '') || '.tif' AS n FROM part)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    file = names.without_patterns(F.concat("p_name", F.lit(".tif")), [" ring"])
    file = names.renamed_if(file, ["red", "bolt"], "_v2", "tail", every=False)
    return table(spark, d, "part").select("p_partkey", file.alias("file"), names.safe_filename(F.col("p_name")).alias("safe"))


@query(
    "P45_P46_P47_P57_P58_P59_P60_P61_column_kinds",
    "SELECT 'x' AS x_column, 'y' AS y_column, 'numeric' AS kind_of_v, 'string' AS kind_of_class, 6673 AS epsg",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    df = points(spark, d).withColumn("epsg", F.when(F.col("pid") % 2 == 0, 6673))
    x, y = names.xy_columns(df.columns)
    kind = lambda c: F.lit(names.kind_of(df.schema[c].dataType))
    return df.agg(F.lit(x).alias("x_column"), F.lit(y).alias("y_column"), kind("v").alias("kind_of_v"), kind("class").alias("kind_of_class"), names.epsg_of(df).alias("epsg"))


@query(
    "P48_P49_P50_P51_P52_P53_P54_P55_geometry_round_trip",
    f"WITH {SQL['pts']} SELECT pid, x, y, x AS wkb_x, y AS wkb_y, x AS wkt_x FROM pts",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    df = points(spark, d).withColumns({"wkb": F.hex(geometry.point_wkb("x", "y")), "wkt": geometry.point_wkt(F.col("x"), F.col("y"))})
    back = df.withColumns({"p": geometry.geometry_point(F.col("wkb")), "q": geometry.wkt_point(F.col("wkt"))})
    return back.select("pid", "x", "y", F.col("p.x").alias("wkb_x"), F.col("p.y").alias("wkb_y"), F.col("q.x").alias("wkt_x"))


# --- counts and statistics ----------------------------------------------------------------------------------------


@query("A04_A05_A07_A08_A23_A24_W64_label_counts", f"WITH {SQL['pts']} SELECT class AS value, count(*) AS count, {near_sql('100.0 * count(*) / (SELECT count(*) FROM pts WHERE v > 0)')} AS ratio_percent FROM pts WHERE v > 0 GROUP BY class")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = stats.value_counts(tables.filtered(points(spark, d), [{"col": "v", "op": ">", "values": [0]}]), "class")
    return got.withColumn("ratio_percent", near("ratio_percent"))


_Q = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
_STATS = ["mean", "std", "min", "max", *_Q]
_STAT_SQL = {"mean": "avg(x)", "std": "stddev_samp(x)", "min": "min(x)", "max": "max(x)"} | {n: f"quantile_cont(x, {q})" for n, q in _Q.items()}


@query(
    "A01_A28_class_statistics",
    f"""WITH {SQL['feat']}, m AS (SELECT *, avg(x) OVER (PARTITION BY label, feature) AS mu FROM long)
SELECT label::DOUBLE AS label, feature, count(*) AS total, count(x) AS count, count(*) - count(x) AS missing, 0.0::DOUBLE AS missing_ratio, {', '.join(f'{near_sql(x)} AS {n}' for n, x in _STAT_SQL.items())},
{near_sql('avg(pow(x - mu, 3)) / pow(stddev_samp(x), 3)', 5)} AS skew FROM m GROUP BY label, feature""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    got = stats.class_statistics(features(spark, d), "label", FEATURES)
    return got.withColumns({c: near(c) for c in _STATS} | {"skew": near("skew", 5), "label": F.col("label").cast("double")})


@query("A02_A31_univariate_summary", f"WITH {SQL['feat']} SELECT feature AS \"column\", count(x) AS count, {', '.join(f'{near_sql(x)} AS {n}' for n, x in _STAT_SQL.items())} FROM long GROUP BY feature")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.summary(features(spark, d), FEATURES).withColumns({c: near(c) for c in _STATS})


@query(
    "A03_A06_histograms",
    f"""WITH {SQL['feat']}, s AS (SELECT label, feature, min(x) AS low, max(x) AS high FROM long GROUP BY ALL), e AS (SELECT s.*, unnest(range(8)) AS bin FROM s),
k AS (SELECT l.label, l.feature, least(floor((x - low) / ((high - low) / 8)), 7)::BIGINT AS bin, count(*) AS n FROM long l JOIN s ON l.feature = s.feature AND l.label IS NOT DISTINCT FROM s.label GROUP BY ALL)
SELECT e.label::DOUBLE AS label, e.feature, e.bin, {near_sql('low + (high - low) / 8 * e.bin')} AS bin_left, {near_sql('low + (high - low) / 8 * (e.bin + 1)')} AS bin_right, coalesce(n, 0) AS count
FROM e LEFT JOIN k ON k.feature = e.feature AND k.bin = e.bin AND k.label IS NOT DISTINCT FROM e.label""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.histograms(features(spark, d), "label", FEATURES, 8).withColumns({c: near(c) for c in ("bin_left", "bin_right")} | {"label": F.col("label").cast("double")})


@query("A09_A11_M16_M17_confusion_matrix", f"""WITH {SQL['judged']}, l AS (SELECT DISTINCT truth::VARCHAR AS l FROM judged UNION SELECT DISTINCT pred::VARCHAR FROM judged), m AS (
SELECT a.l AS "true", b.l AS pred, count(doc_id) AS n FROM l a CROSS JOIN l b LEFT JOIN judged j ON j.truth::VARCHAR = a.l AND j.pred::VARCHAR = b.l GROUP BY ALL)
SELECT "true", pred, n, {near_sql('coalesce(n / nullif(sum(n) OVER (PARTITION BY "true"), 0), 0)')} AS share FROM m""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.confusion(judged(spark, d), "truth", "pred").withColumn("share", near("share"))


@query("A10_A26_A27_class_report", f"""WITH {SQL['judged']}, l AS (SELECT truth::VARCHAR AS l FROM judged UNION SELECT pred::VARCHAR FROM judged),
k AS (SELECT l AS class, count(*) FILTER (truth::VARCHAR = l) AS support, count(*) FILTER (pred::VARCHAR = l) AS given, count(*) FILTER (truth::VARCHAR = l AND pred::VARCHAR = l) AS tp FROM l CROSS JOIN judged GROUP BY l),
p AS (SELECT class, support, tp, coalesce(tp / nullif(given, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall FROM k),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p),
u AS (SELECT class, precision, recall, f1, support FROM f UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f)
SELECT class, {near_sql('precision')} AS precision, {near_sql('recall')} AS recall, {near_sql('f1')} AS f1, support::BIGINT AS support FROM u""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.class_report(judged(spark, d), "truth", "pred").withColumns({c: near(c) for c in ("precision", "recall", "f1")})


@query("A12_prediction_summary", f"WITH {SQL['judged']} SELECT pred::VARCHAR AS class, count(*) AS count, {near_sql('avg(proba_max)')} AS proba_max_mean FROM judged GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.prediction_summary(judged(spark, d), "pred", "proba_max").withColumn("proba_max_mean", near("proba_max_mean"))


_TESTS = f"""{SQL['feat']}, x AS (SELECT l.feature, a, b, CASE WHEN l.label = a THEN 1 ELSE 2 END AS g, x FROM long l JOIN pairs ON l.label IN (a, b)),
k AS (SELECT *, rank() OVER (PARTITION BY feature, a, b ORDER BY x) + (count(*) OVER (PARTITION BY feature, a, b, x) - 1) / 2.0 AS rk FROM x),
t AS (SELECT feature, a, b, count(*) FILTER (g = 1) AS n1, count(*) FILTER (g = 2) AS n2, avg(x) FILTER (g = 1) AS m1, median(x) FILTER (g = 2) AS d2, sum(rk) FILTER (g = 1) AS s FROM k GROUP BY feature, a, b),
u AS (SELECT *, s - n1 * (n1 + 1) / 2.0 AS u FROM t)"""


@query("A14_J20_J21_rank_tests", f"""WITH {_TESTS.replace('pairs ON', '(SELECT p.label AS a, q.label AS b FROM (SELECT DISTINCT label FROM feat) p JOIN (SELECT DISTINCT label FROM feat) q ON p.label < q.label) ON')}
SELECT feature, a::VARCHAR AS group1, b::VARCHAR AS group2, n1 AS n_group1, n2 AS n_group2, {near_sql('m1')} AS mean_group1, {near_sql('d2')} AS median_group2, CASE WHEN n1 >= 30 AND n2 >= 30 THEN {near_sql('u', 3)} END AS u_stat,
CASE WHEN n1 >= 30 AND n2 >= 30 THEN {near_sql('u / (n1 * n2)')} END AS auc, CASE WHEN n1 >= 30 AND n2 >= 30 THEN {near_sql('2 * (u / (n1 * n2)) - 1')} END AS cliffs_delta FROM u""")
def _(spark: SparkSession, d: str) -> DataFrame:
    df = features(spark, d)
    got = stats.rank_tests(df, "label", FEATURES, joins.label_pairs(df, "label"))
    return got.select("feature", "group1", "group2", "n_group1", "n_group2", near("mean_group1").alias("mean_group1"), near("median_group2").alias("median_group2"), near("u_stat", 3).alias("u_stat"), near("auc").alias("auc"), near("cliffs_delta").alias("cliffs_delta"))


@query("A13_A30_O04_auc_matrix", f"""WITH {_TESTS.replace('pairs ON', '(VALUES (0, 1), (2, 3)) pairs(a, b) ON')}, v AS (SELECT feature, max(u / (n1 * n2)) FILTER (a = 0) AS p, max(u / (n1 * n2)) FILTER (a = 2) AS q FROM u GROUP BY feature)
SELECT feature, {near_sql('p')} AS "0-1", {near_sql('q')} AS "2-3", {near_sql('(abs(p - 0.5) + abs(q - 0.5)) / 2')} AS mean_abs_auc FROM v""")
def _(spark: SparkSession, d: str) -> DataFrame:
    pairs = spark.createDataFrame([("0", "1"), ("2", "3")], "a string, b string")
    tests = stats.rank_tests(features(spark, d), "label", FEATURES, pairs, least=1)
    got = stats.auc_matrix(tests, [("0", "1"), ("2", "3")]).join(stats.separability(tests), "feature")
    return got.select("feature", near(F.col("`0-1`")).alias("0-1"), near(F.col("`2-3`")).alias("2-3"), near("mean_abs_auc").alias("mean_abs_auc"))


@query("A15_quantiles_by_class", f"WITH {SQL['feat']} SELECT label::VARCHAR AS class, feature, {near_sql('quantile_cont(x, 0.05)')} AS p05, {near_sql('quantile_cont(x, 0.5)')} AS p50, {near_sql('quantile_cont(x, 0.95)')} AS p95 FROM long GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.quantiles_by_class(features(spark, d), "label", FEATURES).withColumns({c: near(c) for c in ("p05", "p50", "p95")})


@query(
    "A19_zero_crossing",
    f"""WITH x AS (SELECT value AS x, value - 20 AS e FROM events), q AS (SELECT list_sort(list_distinct(quantile_cont(x, [{', '.join(str(i / 40) for i in range(41))}]))) AS edges, count(*) AS n FROM x),
b AS (SELECT x, e, least(len(list_filter(edges, lambda k: k <= x)), len(edges) - 1) AS bin FROM x, q), m AS (SELECT bin, avg(x) AS mx, avg(e) AS me FROM b GROUP BY bin HAVING count(*) >= 10),
s AS (SELECT mx, me, lead(mx) OVER (ORDER BY mx) AS nx, lead(me) OVER (ORDER BY mx) AS ne FROM m) SELECT {near_sql('arg_min(mx - me * (nx - mx) / (ne - me), mx)', 4)} AS threshold, '' AS note FROM s WHERE me * ne < 0""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    got = stats.zero_crossing(table(spark, d, "events").withColumn("effect", F.col("value") - 20), "value", "effect")
    return got.withColumn("threshold", near("threshold", 4))


@query("A20_dissolve", f"WITH {RECTS} SELECT region, sum(gid)::BIGINT AS n_points, count(*) AS n_cells, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM rects GROUP BY region")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.dissolve(rectangles(spark, d).withColumn("n_points", F.col("gid")), "region")


_CORNERS = "corner AS (SELECT class, i + a AS x, j + b AS y, count(*) AS n, count(DISTINCT (a + b) % 2) AS k FROM cells, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) t(a, b) GROUP BY ALL)"
_SIDES = "side AS (SELECT class, i + a AS x, j + b AS y, up, count(*) AS n FROM cells, (VALUES (0, 0, 0), (0, 1, 0), (0, 0, 1), (1, 0, 1)) t(a, b, up) GROUP BY ALL)"
_OUTLINE = f"""{_CORNERS}, {_SIDES}, k AS (SELECT class, sum(CASE WHEN n % 2 = 1 THEN 1 WHEN n = 2 AND k = 1 THEN 2 ELSE 0 END)::BIGINT AS corners FROM corner GROUP BY class),
o AS (SELECT class, count(*) FILTER (n = 1) AS outline FROM side GROUP BY class), a AS (SELECT class, count(*) AS area FROM cells GROUP BY class)"""


def _event_cells(spark: SparkSession, d: str, kind: Column) -> DataFrame:
    return table(spark, d, "events").select(kind.alias("class"), (F.col("event_id") % 100).alias("i"), F.expr("event_id div 100").alias("j"))


@query(
    "A20_united_polygons",
    f"""WITH RECURSIVE cells AS (SELECT event_type AS class, event_id % 100 AS i, event_id // 100 AS j FROM events),
reach AS (SELECT class, i, j, i AS si, j AS sj FROM cells UNION SELECT c.class, c.i, c.j, si, sj FROM reach q JOIN (SELECT c.*, i + a AS ni, j + b AS nj FROM cells c, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) t(a, b)) c ON c.class = q.class AND c.ni = q.i AND c.nj = q.j),
{_OUTLINE}, first AS (SELECT class, i, j, min((sj, si)) AS s FROM reach GROUP BY ALL), p AS (SELECT class, count(*) AS polygons FROM first WHERE s = (j, i) GROUP BY class)
SELECT class, polygons, corners, outline, area FROM p JOIN k USING (class) JOIN o USING (class) JOIN a USING (class)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return outlines.summary(outlines.rings(_event_cells(spark, d, F.col("event_type")), "class")).select("class", "polygons", "corners", "outline", "area")


@query(
    "A20_outlines_with_holes",
    f"WITH cells AS (SELECT CASE WHEN event_type <> 'error' THEN 'other' ELSE 'error' END AS class, event_id % 100 AS i, event_id // 100 AS j FROM events), {_OUTLINE} SELECT class, corners, outline, area, area AS held FROM k JOIN o USING (class) JOIN a USING (class)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """Large polygons with many holes; `held` adds up the areas of all polygons with their own holes taken out."""
    corners = outlines.rings(_event_cells(spark, d, F.when(F.col("event_type") != "error", "other").otherwise("error")), "class")
    held = outlines.polygons(corners, 0.5).groupBy("class").agg((F.sum("area") * 4).cast("long").alias("held"))
    return outlines.summary(corners).select("class", "corners", "outline", "area").join(held, "class")


@query("A21_J26_extent", f"WITH {RECTS} SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM rects")
def _(spark: SparkSession, d: str) -> DataFrame:
    return joins.extent(rectangles(spark, d))


@query("A22_distinct_counts", f"WITH {SQL['pts']} SELECT count(DISTINCT class) AS classes, count(DISTINCT x) AS xs FROM pts")
def _(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d).agg(F.count_distinct("class").alias("classes"), F.count_distinct("x").alias("xs"))


@query("A25_diagnostics", f"WITH {SQL['judged']} SELECT truth::VARCHAR AS class, count(*) AS n_true, sum((truth = pred)::INT)::BIGINT AS n_correct, {near_sql('avg((truth = pred)::INT)')} AS recall FROM judged GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.diagnostics(judged(spark, d), "truth", "pred").withColumn("recall", near("recall"))


# --- joins --------------------------------------------------------------------------------------------------------

_INSIDE = "x > xmin AND x < xmax AND y > ymin AND y < ymax"


@query("J01_J10_W65_polygon_join_first", f"""WITH {SQL['pts']}, {OVERLAP}, m AS (SELECT pid, arg_min(attr, gid) FILTER (attr IS NOT NULL) AS attr, arg_min(region, gid) AS region FROM pts JOIN rects ON {_INSIDE} GROUP BY pid)
SELECT pts.pid, attr, region::DOUBLE AS region FROM pts LEFT JOIN m ON m.pid = pts.pid""")
def _(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    pairs = joins.in_rectangles(pts.select("pid", "x", "y"), rectangles(spark, d, 12), 10.0, "pid")
    return joins.attach_polygon_attributes(pts, pairs, ["attr", "region"], "pid", "gid").select("pid", "attr", F.col("region").cast("double").alias("region"))


@query("J02_polygon_join_all", f"WITH {SQL['pts']}, {OVERLAP} SELECT pid, attr, region::DOUBLE AS region FROM pts LEFT JOIN rects ON x >= xmin AND x <= xmax AND y >= ymin AND y <= ymax")
def _(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    pairs = joins.in_rectangles(pts.select("pid", "x", "y"), rectangles(spark, d, 12), 10.0, "pid", closed=True)
    return joins.attach_polygon_attributes(pts, pairs, ["attr", "region"], "pid", "gid", dedup="all").select("pid", "attr", F.col("region").cast("double").alias("region"))


@query("J24_S27_points_in_polygons", f"WITH {SQL['pts']}, {RECTS} SELECT pid, gid FROM pts JOIN rects ON {_INSIDE} AND NOT (x > xmin + 2 AND x < xmin + 5 AND y > ymin + 2 AND y < ymin + 5)")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    outer = geometry.rectangle_ring(c("xmin"), c("ymin"), c("xmax"), c("ymax"))
    hole = geometry.rectangle_ring(c("xmin") + 2, c("ymin") + 2, c("xmin") + 5, c("ymin") + 5)
    polygons = rectangles(spark, d).select("gid", F.array(outer, hole).alias("rings"))
    return joins.in_polygons(points(spark, d).select("pid", "x", "y"), polygons, 10.0, "pid").select("pid", "gid")


@query("J03_J11_merge_with_prefix", f"WITH {SQL['pts']} SELECT a.pid, a.v, b.v AS r_v FROM pts a LEFT JOIN (SELECT x, y, v * 2 AS v FROM pts WHERE v > 0) b ON a.x = b.x AND a.y = b.y")
def _(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    right = pts.where("v > 0").select("x", "y", (F.col("v") * 2).alias("v"))
    return joins.join_prefixed(pts, right, ["x", "y"], "r_").select("pid", "v", "r_v")


_NET = "net AS (SELECT i AS grid_id, (i % 10) * 5.0 + 2.5 AS center_x, (i // 10) * 5.0 + 2.5 AS center_y FROM range(60) t(i))"
_DIST = "sqrt((center_x - x) * (center_x - x) + (center_y - y) * (center_y - y))"


def _net(spark: SparkSession) -> DataFrame:
    return joins.fishnet(spark, (0.0, 0.0, 50.0, 30.0), 5.0).select("grid_id", "center_x", "center_y")


@query("J04_J07_nearest_class", f"""WITH {SQL['pts']}, {_NET}, p AS (SELECT grid_id, class, {_DIST} AS d FROM net CROSS JOIN pts WHERE class IS NOT NULL),
m AS (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY round(d, 9), class) AS k FROM p) SELECT grid_id, class, {near_sql('d')} AS dist_to_point, 1::BIGINT AS n_points FROM m WHERE k = 1""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return nearest.nearest_class(_net(spark), points(spark, d)).withColumn("dist_to_point", near("dist_to_point"))


@query("J05_radius_majority", f"""WITH {SQL['pts']}, {_NET}, k AS (SELECT grid_id, class, count(*) AS k FROM net JOIN pts ON {_DIST} <= 3 WHERE class IS NOT NULL GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY k DESC, class) AS i, sum(k) OVER (PARTITION BY grid_id) AS n FROM k)
SELECT net.grid_id, class, coalesce(n, 0)::BIGINT AS n_points FROM net LEFT JOIN m ON m.grid_id = net.grid_id AND i = 1""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return nearest.majority_class(_net(spark), points(spark, d), 3.0)


@query("J06_radius_weighted", f"""WITH {SQL['pts']}, {_NET}, k AS (SELECT grid_id, class, sum(1 / (pow({_DIST}, 2.0) + 1e-6)) AS w, count(*) AS k FROM net JOIN pts ON {_DIST} <= 3 GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY class IS NULL, round(w, 9) DESC, class) AS i, sum(w) FILTER (class IS NOT NULL) OVER (PARTITION BY grid_id) AS t, sum(k) OVER (PARTITION BY grid_id) AS n FROM k)
SELECT net.grid_id, class, {near_sql('CASE WHEN class IS NOT NULL THEN w / t END')} AS class_conf, coalesce(n, 0)::BIGINT AS n_points FROM net LEFT JOIN m ON m.grid_id = net.grid_id AND i = 1""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return nearest.weighted_class(_net(spark), points(spark, d), 3.0).withColumn("class_conf", near("class_conf"))


@query("J08_J09_sample_raster", f"WITH {SQL['pts']}, {SQL['demn']} SELECT pid, z FROM pts LEFT JOIN dem ON r = floor((y - 40) / -2.0) AND c = floor((x + 1) / 2.0)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return joins.sample_cells(points(spark, d), dem(spark, d, gaps=True), (2.0, -1.0, -2.0, 40.0), ["z"]).select("pid", "z")


@query("J12_J13_J14_J15_lookup_codes", f"WITH {SQL['codes']} SELECT p_partkey, seven::DOUBLE AS seven FROM part LEFT JOIN codes ON five = p_size")
def _(spark: SparkSession, d: str) -> DataFrame:
    return joins.lookup(table(spark, d, "part"), "p_size", codes(spark, d), "five", "seven", "seven").select("p_partkey", F.col("seven").cast("double").alias("seven"))


@query("J16_J17_normalised_truth", "SELECT p_partkey, (p_size // 10)::DOUBLE AS truth_id FROM part WHERE p_size IN (10, 20, 30)")
def _(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").withColumn("t", F.concat(F.lit(" "), F.col("p_size").cast("double").cast("string")))
    return joins.normalised_truth(part, "t", {"10": 1, "20": 2, "30": 3}).select("p_partkey", F.col("truth_id").cast("double").alias("truth_id"))


_BOX = "box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts)"


def _box(spark: SparkSession, d: str) -> tuple[float, float, float, float]:
    return tuple(points(spark, d).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first())


@query("J18_grid_centers_over_points", f"""WITH {SQL['pts']}, {_BOX}, k AS (SELECT x0, y0, unnest(range(ceil((x1 - x0) / 1.5 - 0.5)::BIGINT)) AS ix, ceil((y1 - y0) / 1.5 - 0.5)::BIGINT AS ny FROM box),
n AS (SELECT x0, y0, ix, unnest(range(ny)) AS iy FROM k) SELECT ix, iy, {near_sql('x0 + 0.75 + ix * 1.5')} AS x, {near_sql('y0 + 0.75 + iy * 1.5')} AS y FROM n""")
def _(spark: SparkSession, d: str) -> DataFrame:
    return joins.grid_centers(spark, _box(spark, d), 1.5).select("ix", "iy", near("x").alias("x"), near("y").alias("y"))


@query("J19_fishnet_over_points", f"""WITH {SQL['pts']}, {_BOX}, k AS (SELECT x0, y0, greatest(1, ceil((x1 - x0) / 3))::BIGINT AS nx, greatest(1, ceil((y1 - y0) / 3))::BIGINT AS ny FROM box), n AS (SELECT *, unnest(range(nx * ny)) AS i FROM k)
SELECT i AS grid_id, {near_sql('x0 + (i % nx) * 3 + 1.5')} AS center_x, {near_sql('y0 + (i // nx) * 3 + 1.5')} AS center_y, {near_sql('x0 + (i % nx) * 3')} AS xmin, {near_sql('y0 + (i // nx) * 3')} AS ymin, {near_sql('x0 + (i % nx) * 3 + 3')} AS xmax, {near_sql('y0 + (i // nx) * 3 + 3')} AS ymax FROM n""")
def _(spark: SparkSession, d: str) -> DataFrame:
    x0, y0, x1, y1 = _box(spark, d)
    got = joins.fishnet(spark, (x0, y0, x1, y1), 3.0)
    return got.select("grid_id", *[near(c).alias(c) for c in got.columns if c != "grid_id"])


@query("J22_common_extent", f"WITH {COMMON} SELECT max(xmin) AS xmin, max(ymin) AS ymin, min(xmax) AS xmax, min(ymax) AS ymax FROM rects")
def _(spark: SparkSession, d: str) -> DataFrame:
    return joins.common_extent(rectangles(spark, d, 60))


@query("J23_clamped_boxes", f"WITH {RECTS}, k AS (SELECT gid, greatest(xmin, 5) AS xmin, greatest(ymin, 5) AS ymin, least(xmax, 33) AS xmax, least(ymax, 21) AS ymax FROM rects) SELECT * FROM k WHERE xmin < xmax AND ymin < ymax")
def _(spark: SparkSession, d: str) -> DataFrame:
    return joins.clamped(rectangles(spark, d), (5, 5, 33, 21)).select("gid", "xmin", "ymin", "xmax", "ymax")


@query("J25_clip_to_box", f"WITH {SQL['pts']} SELECT pid FROM pts WHERE x BETWEEN 3 AND 17 AND y BETWEEN 2 AND 9")
def _(spark: SparkSession, d: str) -> DataFrame:
    return joins.clipped(points(spark, d), (3, 2, 17, 9)).select("pid")


@query("J24_mask_cells", f"WITH {SQL['dem']} SELECT r, c, CASE WHEN c BETWEEN 10 AND 19 AND r BETWEEN 2 AND 5 THEN z END AS z FROM dem")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = dem(spark, d)
    return joins.masked_cells(cells, cells.where("c BETWEEN 10 AND 19 AND r BETWEEN 2 AND 5")).select("r", "c", "z")


@query("J27_U03_label_difference", f"WITH {SQL['judged']} SELECT DISTINCT truth AS label FROM judged EXCEPT SELECT DISTINCT pred FROM judged")
def _(spark: SparkSession, d: str) -> DataFrame:
    df = judged(spark, d)
    return joins.only_in_first(df.select(F.col("truth").alias("label")), df.select(F.col("pred").alias("label")), "label")


@query("P35_U04_kept_in_layers", f"WITH {SQL['pts']}, {RECTS}, m AS (SELECT pid, attr, region FROM pts LEFT JOIN rects ON {_INSIDE}) SELECT pid FROM m WHERE attr IS NOT NULL AND region IS NOT NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    pairs = joins.in_rectangles(pts.select("pid", "x", "y"), rectangles(spark, d), 10.0, "pid")
    return joins.kept_in_layers(joins.attach_polygon_attributes(pts, pairs, ["attr", "region"], "pid", "gid"), [["attr"], ["region"]], every=True).select("pid")


# --- order, samples, sets -----------------------------------------------------------------------------------------


@query("O01_O02_O03_O05_O06_O13_top_values", f"WITH {SQL['pts']} SELECT class AS value, count(*) AS count, {near_sql('100.0 * count(*) / (SELECT count(*) FROM pts)')} AS ratio_percent FROM pts GROUP BY class ORDER BY count(*) DESC, class NULLS LAST LIMIT 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.value_counts(points(spark, d), "class", top=3).withColumn("ratio_percent", near("ratio_percent"))


@query("O07_O08_O09_S12_S13_sample_n")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.sample_n(table(spark, d, "customer"), 50, "c_custkey").select("c_custkey")


@query("O10_stratified_sample", f"WITH {SQL['pts']} SELECT class, least(count(*), 5) AS n FROM pts WHERE class IS NOT NULL GROUP BY class")
def _(spark: SparkSession, d: str) -> DataFrame:
    return stats.per_class(points(spark, d).where("class is not null"), "class", 5, "pid").groupBy("class").agg(F.count("*").alias("n"))


@query("O11_M10_undersample", f"WITH {SQL['feat']}, k AS (SELECT label, count(*) AS n FROM feat WHERE label IS NOT NULL GROUP BY label) SELECT label AS class, n AS original_count, least((SELECT min(n) FROM k), 40) AS sampled_count FROM k")
def _(spark: SparkSession, d: str) -> DataFrame:
    df = features(spark, d).where("label is not null")
    return stats.undersampling_log(df, stats.undersampled(df, "label", "vec_id", target=40), "label")


@query("W61_W62_rank_per_class", "SELECT c_mktsegment AS class, c_custkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "customer").select(F.col("c_mktsegment").alias("class"), "c_custkey", (-F.col("c_acctbal")).alias("k"))
    return stats.numbered(df, ["k", "c_custkey"], ["class"], "rank").where("rank <= 3").select("class", "c_custkey", F.col("rank").cast("long").alias("rank"))


@query("W63_top_classes", """WITH l AS (SELECT vec_id, unnest(embedding)::DOUBLE AS p, generate_subscripts(embedding, 1) AS nth FROM embeddings),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, nth) AS i FROM l) SELECT vec_id, 'c' || max(nth) FILTER (i = 1) AS top1, 'c' || max(nth) FILTER (i = 2) AS top2 FROM k GROUP BY vec_id""")
def _(spark: SparkSession, d: str) -> DataFrame:
    p = F.transform("embedding", lambda x: x.cast("double"))
    top = table(spark, d, "embeddings").select("vec_id", stats.top_classes([f"c{i + 1}" for i in range(COMPONENTS)], p, 2).alias("t"))
    return top.select("vec_id", F.col("t")[0]["label"].alias("top1"), F.col("t")[1]["label"].alias("top2"))


@query("U01_U02_U05_U06_O14_union_by_name", f"WITH {RECTS} SELECT gid, region::DOUBLE AS region, NULL::VARCHAR AS attr FROM rects UNION ALL SELECT gid, NULL, attr FROM rects")
def _(spark: SparkSession, d: str) -> DataFrame:
    r = rectangles(spark, d)
    return stats.union_all([r.select("gid", "region"), r.select("gid", "attr")]).withColumn("region", F.col("region").cast("double"))


@query("K14_split_parts", "SELECT n AS id, ceil(n / ceil((SELECT count(*) FROM customer) / 4.0))::BIGINT AS part, c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS n FROM customer)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return split_parts(table(spark, d, "customer").select("c_custkey"), 4, ["c_custkey"]).select("id", "part", "c_custkey")


@query(
    "M26_M27_training_points",
    f"""WITH {SQL['pts']}, {RECTS}, {SQL['dem']}, m AS (SELECT pid, attr, region FROM pts JOIN rects ON {_INSIDE})
SELECT pts.pid, z, attr, region::DOUBLE AS region FROM pts LEFT JOIN dem ON r = floor((y - 40) / -2.0) AND c = floor((x + 1) / 2.0) LEFT JOIN m ON m.pid = pts.pid""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return training_points(points(spark, d).select("pid", "x", "y"), dem(spark, d), (2.0, -1.0, -2.0, 40.0), ["z"], rectangles(spark, d), ["attr", "region"]).select("pid", "z", "attr", F.col("region").cast("double").alias("region"))
