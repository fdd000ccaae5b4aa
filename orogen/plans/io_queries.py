"""Queries over sources, sinks and scales: what is written comes back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.functions import scales
from orogen.plans.inputs import SQL, dem, points, rectangles, table
from orogen.sources import geopackage, rasters, readers, sinks
from orogen.sources.storage import shared_folder

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        f.__name__ = name
        QUERIES[name] = (f, sql)
        return f

    return add


def _place(spark: SparkSession, ext: str) -> str:
    return f"{shared_folder(spark)}/io-{uuid.uuid4().hex}.{ext}"


_POINTS = f"WITH {SQL['pts']} SELECT pid::DOUBLE AS pid, x, y, class, v FROM pts"


@query("S01_S02_K01_K02_K03_K06_geotiff_round_trip", f"WITH {SQL['demn']} SELECT r, c, round(z, 2) + 0.0 AS z FROM dem")
def _(spark: SparkSession, d: str) -> DataFrame:
    files = rasters.as_tiffs(sinks.tiles_of(dem(spark, d, gaps=True), 64), 64, 2.0, 0.0, 0.0, sinks.NODATA)
    cells = rasters.cells_from(files.select(F.concat_ws("_", F.lit("t"), "tile_r", "tile_c").alias("path"), "content"))
    # a cell's place in the whole grid from its coordinates
    return cells.select(F.floor(-F.col("y") / 2.0).alias("r"), F.floor(F.col("x") / 2.0).alias("c"), (F.round("z", 2) + 0.0).alias("z"))


def _tiffs(spark: SparkSession, d: str, **options: object) -> DataFrame:
    files = rasters.as_tiffs(sinks.tiles_of(dem(spark, d, gaps=True), 64), 64, 2.0, 0.0, 0.0, sinks.NODATA, epsg=6673, **options)
    return files.select(F.concat_ws("_", F.lit("t"), "tile_r", "tile_c").alias("path"), "content")


@query("K05_lzw_tiles", f"WITH {SQL['demn']} SELECT r, c, round(z, 2) + 0.0 AS z FROM dem")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = rasters.cells_from(_tiffs(spark, d, codec=rasters.LZW, block=16))
    return cells.select(F.floor(-F.col("y") / 2.0).alias("r"), F.floor(F.col("x") / 2.0).alias("c"), (F.round("z", 2) + 0.0).alias("z"))


@query(
    "S34_crs_and_resolution",
    f"WITH {SQL['dem']} SELECT 't_' || (r // 64) || '_' || (c // 64) AS raster_id, (max(r % 64) + 1)::INT AS n_rows, (max(c % 64) + 1)::INT AS n_cols, 2.0::DOUBLE AS px, -2.0::DOUBLE AS py, 6673 AS epsg FROM dem GROUP BY r // 64, c // 64",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rasters.geometry_of(_tiffs(spark, d)).select("raster_id", F.col("rows").alias("n_rows"), F.col("cols").alias("n_cols"), "px", "py", "epsg")


@query("S03_S20_S21_S23_D4_bands_side_by_side", f"WITH {SQL['dem']} SELECT r, c, z AS a_b1, z * 2 AS b_b1 FROM dem")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = dem(spark, d).withColumn("band", F.lit(1))
    both = cells.withColumn("raster_id", F.lit("a")).union(cells.withColumns({"z": F.col("z") * 2, "raster_id": F.lit("b")}))
    return rasters.wide(both)


@query("K04_K24_tiles_round_trip", f"WITH {SQL['demn']} SELECT r, c, round(z, 2) + 0.0 AS z FROM dem")
def _(spark: SparkSession, d: str) -> DataFrame:
    size = scales.block_size(100, 100)
    back = sinks.cells_of(sinks.tiles_of(dem(spark, d, gaps=True), size), size)
    return back.select("r", "c", (F.round("z", 2) + 0.0).alias("z"))


@query("S10_S11_S19_S24_S25_S26_K07_K12_K13_geopackage_round_trip", _POINTS)
def _(spark: SparkSession, d: str) -> DataFrame:
    files = geopackage.packages(points(spark, d).withColumns({"east": F.col("x"), "north": F.col("y")}), "pts", 6673, "east", "north")
    back = geopackage.read_from(files.select(F.col("part").cast("string").alias("path"), "content"), centroid=True)
    return back.select("pid", "x", "y", "class", "v")


@query("S04_S05_S06_S08_S17_S18_S35_S36_S37_K09_K11_K17_K19_csv_round_trip", _POINTS)
def _(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "csv")
    sinks.write_table(points(spark, d), path, "csv")
    return readers.read_table(spark, path).select(F.col("pid").cast("double").alias("pid"), "x", "y", "class", "v")


@query("S14_geoparquet_footer", "SELECT 'EPSG' AS authority, 6673 AS code, 'geometry' AS primary_column")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "parquet")
    sinks.write_geoparquet(points(spark, d), path, 6673)
    geo = readers.geo_footer(spark, path)
    crs = geo["columns"][geo["primary_column"]]["crs"]["id"]
    return spark.createDataFrame([(crs["authority"], crs["code"], geo["primary_column"])], "authority string, code int, primary_column string")


@query("S07_S09_K08_K10_K21_geoparquet_round_trip", f"WITH {SQL['pts']} SELECT pid, x, y, class, v FROM pts WHERE x BETWEEN 3 AND 17 AND y BETWEEN 2 AND 9")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "parquet")
    sinks.write_geoparquet(points(spark, d), path, 6673)
    return readers.read_table(spark, path, bbox=(3, 2, 17, 9))


@query("S15_S16_inspect_table", "SELECT 5 AS n_columns, count(*) AS n_rows FROM customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    got = readers.inspect(spark, f"{d}/customer.parquet")
    return spark.createDataFrame([(len(got["columns"]), got["rows"])], "n_columns int, n_rows long")


@query("S32_K22_bbox_rows", f"WITH {SQL['rects'].format(side=10)} SELECT gid, xmin, ymin, xmax, ymax FROM rects")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "csv")
    boxes = rectangles(spark, d).select(F.col("gid").cast("string").alias("name"), F.col("xmin").alias("Xmin"), F.col("ymin").alias("Ymin"), F.col("xmax").alias("Xmax"), F.col("ymax").alias("Ymax"))
    bad = readers.boxes_from_rows(spark, [("bad", 0.0, 0.0, 1.0, 1.0)]).select("name", F.lit("x").alias("Xmin"), "Ymin", "Xmax", "Ymax")
    sinks.write_table(boxes.select("name", F.col("Xmin").cast("string"), "Ymin", "Xmax", "Ymax").union(bad), path, "csv")
    return readers.boxes(spark, path).select(F.col("name").cast("long").alias("gid"), F.col("Xmin").alias("xmin"), F.col("Ymin").alias("ymin"), F.col("Xmax").alias("xmax"), F.col("Ymax").alias("ymax"))


@query("K15_sample_to_csv", "SELECT greatest(1, floor(count(*) * 0.1))::BIGINT AS n FROM customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "csv")
    sinks.write_csv_sample(table(spark, d, "customer"), path, scales.fraction("1/10"), "c_custkey")
    return readers.read_csv(spark, path).agg(F.count("*").alias("n"))


@query("K16_per_class_folders", "SELECT coalesce(replace(c_mktsegment, ' ', '_'), 'NaN') AS class_dir, count(*) AS n FROM customer GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "csv")
    sinks.write_per_class(table(spark, d, "customer"), path, "c_mktsegment")
    return readers.read_csv(spark, path).groupBy("class_dir").agg(F.count("*").alias("n"))
