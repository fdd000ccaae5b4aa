"""Joins of rasters, points and polygons, and lookups.

Points meet cells by an equi-join on computed row and column; polygons are listed in the squares that their
boxes touch, and points meet those of their square. Nearest points and points within a radius are in `nearest`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orogen.functions.geometry import inside_polygon


# --- grids --------------------------------------------------------------------------------------------------------


def grid_centers(spark: SparkSession, bbox: tuple[float, float, float, float], res: float) -> DataFrame:
    """(ix, iy, x, y): centres of the squares of side `res` from the lower left corner of (xmin, ymin, xmax, ymax)."""
    xmin, ymin, xmax, ymax = bbox
    nx, ny = (max(0, math.ceil((high - low) / res - 0.5)) for low, high in ((xmin, xmax), (ymin, ymax)))
    cells = spark.range(nx * ny).select((F.col("id") % max(nx, 1)).alias("ix"), F.expr(f"id div {max(nx, 1)}").alias("iy"))
    return cells.select("ix", "iy", *[(F.lit(low + res / 2) + F.col(i) * F.lit(res)).alias(v) for v, i, low in (("x", "ix", xmin), ("y", "iy", ymin))])


def fishnet(spark: SparkSession, bounds: tuple[float, float, float, float], size: float, most: int | None = None) -> DataFrame:
    """(grid_id, center_x, center_y, xmin, ymin, xmax, ymax) of the squares that cover the bounds, row by row from below."""
    x0, y0, x1, y1 = bounds
    nx, ny = (max(1, math.ceil((b - a) / size)) for a, b in ((x0, x1), (y0, y1)))
    if most is not None and nx * ny > most:
        raise ValueError(f"{nx * ny} cells are more than {most}")
    at = spark.range(nx * ny).select(F.col("id").alias("grid_id"), (F.col("id") % nx).alias("ix"), F.expr(f"id div {nx}").alias("iy"))
    left, low = F.lit(float(x0)) + F.col("ix") * F.lit(size), F.lit(float(y0)) + F.col("iy") * F.lit(size)
    half, full = F.lit(size / 2), F.lit(size)
    return at.select("grid_id", (left + half).alias("center_x"), (low + half).alias("center_y"), left.alias("xmin"), low.alias("ymin"), (left + full).alias("xmax"), (low + full).alias("ymax"))


# --- rasters and points -------------------------------------------------------------------------------------------


def cell_of(x: Column, y: Column, a: float, c: float, e: float, f: float) -> list[Column]:
    """Row and column of a point in a north-up raster with the affine transform (a, 0, c, 0, e, f)."""
    row, col = F.floor((y - F.lit(float(f))) / F.lit(float(e))), F.floor((x - F.lit(float(c))) / F.lit(float(a)))
    return [row.cast("long").alias("r"), col.cast("long").alias("c")]


def sample_cells(points: DataFrame, cells: DataFrame, transform: tuple[float, float, float, float], values: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """`points` with the values of the cell each lies in; outside the raster or without data they are null."""
    at = dict(zip(("__r", "__c"), cell_of(F.col(x), F.col(y), *transform), strict=True))
    source = cells.select(F.col("r").alias("__r"), F.col("c").alias("__c"), *values)
    return points.withColumns(at).join(source, ["__r", "__c"], "left").drop("__r", "__c")


def stacked(grids: Sequence[tuple[str, DataFrame]], keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """Rasters of one grid side by side: (keys, one column for each name), by key and in one shuffle."""
    parts = None
    for name, grid in grids:
        one = grid.select(*keys, F.lit(name).alias("__name"), F.col("z").alias("__z"))
        parts = one if parts is None else parts.unionByName(one)
    value = [F.max(F.when(F.col("__name") == n, F.col("__z"))).alias(n) for n, _ in grids]
    return parts.groupBy(*keys).agg(*value)


# --- points and polygons ------------------------------------------------------------------------------------------


def in_rectangles(points: DataFrame, rects: DataFrame, size: float, point_id: str, closed: bool = False) -> DataFrame:
    """All pairs (points' columns, rects' columns) of a point inside a rectangle; borders count if `closed`.

    Rectangles (xmin, ymin, xmax, ymax) are listed in the squares of side `size` that they touch. Other column names must differ.
    """
    span = lambda low, high: F.sequence(F.floor(F.col(low) / F.lit(size)), F.floor(F.col(high) / F.lit(size)))
    listed = rects.select("*", F.explode(span("xmin", "xmax")).alias("__bx")).select("*", F.explode(span("ymin", "ymax")).alias("__by"))
    held = points.withColumns({"__bx": F.floor(F.col("x") / F.lit(size)), "__by": F.floor(F.col("y") / F.lit(size))})
    x, y = F.col("x"), F.col("y")
    if closed:
        met = x.between(F.col("xmin"), F.col("xmax")) & y.between(F.col("ymin"), F.col("ymax"))
    else:
        met = (x > F.col("xmin")) & (x < F.col("xmax")) & (y > F.col("ymin")) & (y < F.col("ymax"))
    return held.join(listed, ["__bx", "__by"]).where(met).drop("__bx", "__by")


def in_polygons(points: DataFrame, polygons: DataFrame, size: float, point_id: str, closed: bool = False) -> DataFrame:
    """As `in_rectangles` for polygons: `rings` is an array of rings, each an array of (x, y); holes are further rings.

    The boxes of the polygons choose candidates, crossing numbers decide.
    """
    xs = F.flatten(F.transform("rings", lambda ring: F.transform(ring, lambda p: p["x"])))
    ys = F.flatten(F.transform("rings", lambda ring: F.transform(ring, lambda p: p["y"])))
    boxed = polygons.withColumns({"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)})
    candidates = in_rectangles(points, boxed, size, point_id, closed=True)
    return candidates.where(inside_polygon(F.col("x"), F.col("y"), F.col("rings"))).drop("rings", "xmin", "ymin", "xmax", "ymax")


def attach_polygon_attributes(
    points: DataFrame, pairs: DataFrame, attributes: Sequence[str], point_id: str, polygon_id: str, dedup: str = "first", prefix: str = ""
) -> DataFrame:
    """Left spatial join from pairs made by `in_polygons` or `in_rectangles`.

    dedup 'first': one row for each point, per attribute the first non-null by polygon id; 'all': one row for each match.
    """
    names = {a: f"{prefix}{a}" for a in attributes}
    if dedup == "all":
        found = pairs.select(point_id, *[F.col(a).alias(n) for a, n in names.items()])
    elif dedup == "first":
        firsts = [F.min(F.when(F.col(a).isNotNull(), F.struct(F.col(polygon_id).alias("k"), F.col(a).alias("v"))))["v"].alias(n) for a, n in names.items()]
        found = pairs.groupBy(point_id).agg(*firsts)
    else:
        raise ValueError("dedup must be 'first' or 'all'")
    return points.join(found, point_id, "left")


def kept_in_layers(points: DataFrame, layers: Sequence[Sequence[str]], every: bool) -> DataFrame:
    """Rows that lie in all (or any) of the layers: a layer holds a row if any of its columns is not null."""
    met = F.lit(every)
    for columns in layers:
        hit = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
        met = met & hit if every else met | hit
    return points.where(met)


def masked_cells(cells: DataFrame, inside: DataFrame, crop: bool = False) -> DataFrame:
    """Cells as null, or left out with `crop`, where (r, c) is not in `inside`."""
    marks = inside.select("r", "c").distinct().withColumn("__in", F.lit(True))
    if crop:
        return cells.join(marks.drop("__in"), ["r", "c"], "left_semi")
    return cells.join(marks, ["r", "c"], "left").withColumn("z", F.when(F.col("__in"), F.col("z"))).drop("__in")


# --- boxes --------------------------------------------------------------------------------------------------------


def extent(boxes: DataFrame) -> DataFrame:
    return boxes.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def common_extent(boxes: DataFrame) -> DataFrame:
    """The box that all share; no row if they share none."""
    both = boxes.agg(F.max("xmin").alias("xmin"), F.max("ymin").alias("ymin"), F.min("xmax").alias("xmax"), F.min("ymax").alias("ymax"))
    return both.where("xmin < xmax and ymin < ymax")


def clamped(boxes: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Each box cut to `box`; those outside are dropped."""
    low = {n: F.greatest(F.col(n), F.lit(float(v))) for n, v in zip(("xmin", "ymin"), box[:2], strict=True)}
    high = {n: F.least(F.col(n), F.lit(float(v))) for n, v in zip(("xmax", "ymax"), box[2:], strict=True)}
    return boxes.withColumns(low | high).where("xmin < xmax and ymin < ymax")


def clipped(points: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    return points.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3]))


# --- lookups ------------------------------------------------------------------------------------------------------


def join_prefixed(left: DataFrame, right: DataFrame, on: Sequence[str], prefix: str) -> DataFrame:
    """Left equi-join; columns of `right` that `left` has too get the prefix."""
    renamed = right.withColumnsRenamed({c: f"{prefix}{c}" for c in right.columns if c in left.columns and c not in on})
    return left.join(renamed, list(on), "left")


def lookup(df: DataFrame, column: str, codes: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """`df` with the code's value, null where there is none; the smallest value if a key repeats. Small code tables are broadcast by Spark itself."""
    single = codes.groupBy(F.col(key).alias("__key")).agg(F.min(value).alias(out))
    return df.join(single, F.col(column) == F.col("__key"), "left").drop("__key")


def normalised_truth(df: DataFrame, column: str, ids: dict[str, int], out: str = "truth_id") -> DataFrame:
    """Rows whose trimmed label, as text or as a whole number, is known; with its id."""
    text = F.trim(F.col(column).cast("string"))
    whole = F.regexp_replace(text, r"\.0+$", "")
    table = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair]) if ids else F.lit(None).cast("map<string,int>")
    return df.withColumn(out, F.coalesce(F.try_element_at(table, text), F.try_element_at(table, whole))).where(F.col(out).isNotNull())


def label_pairs(df: DataFrame, label: str) -> DataFrame:
    """(a, b) for a < b over the distinct labels: the C(n, 2) pairs of the few labels there are."""
    labels = df.where(F.col(label).isNotNull()).select(F.col(label).alias("a")).distinct()
    others = labels.groupBy().agg(F.array_sort(F.collect_set("a")).alias("all"))
    return others.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b")).where("a < b")


def only_in_first(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Distinct values of `a` that `b` lacks."""
    return a.select(column).distinct().join(b.select(column).distinct(), column, "left_anti")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__n = 1").drop("__n")
