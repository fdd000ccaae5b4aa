"""Coarser and finer grids (R01 to R11): block aggregates, interpolation, and features that go through them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DOWN = ("average", "max", "min")
UP = ("nearest", "bilinear", "cubic")


@dataclass(frozen=True)
class Coarse:
    """Geometry of a coarse grid: block size and the fine cells left over before the first block (maybe half ones)."""

    scale: int
    rows: int
    cols: int
    row_off: float
    col_off: float


def centred(rows: int, cols: int, scale: int) -> Coarse:
    """Whole blocks, with the remainder split evenly between both sides."""
    r, c = max(1, rows // scale), max(1, cols // scale)
    return Coarse(scale, r, c, (rows - r * scale) / 2, (cols - c * scale) / 2)


def _overlaps(at: Column, off: float, scale: int, count: int) -> Column:
    """Array of (block, weight) that the cell [at, at + 1) lies in; two if it straddles a border."""
    low = F.floor((at - F.lit(off)) / F.lit(float(scale)))
    if off == int(off):
        parts = F.array(F.struct(low.alias("i"), F.lit(1.0).alias("w")))
    else:
        high = F.floor((at - F.lit(off) + F.lit(0.5)) / F.lit(float(scale)))
        parts = F.array(F.struct(low.alias("i"), F.lit(0.5).alias("w")), F.struct(high.alias("i"), F.lit(0.5).alias("w")))
    return F.filter(parts, lambda p: (p["i"] >= 0) & (p["i"] < count))


def block_average(cells: DataFrame, geometry: Coarse, keys: Sequence[str] = ()) -> DataFrame:
    """Area-weighted mean of the valid cells in each block; weights are combined before the shuffle."""
    g = geometry
    spread = cells.select(*keys, "z", F.explode(_overlaps(F.col("r"), g.row_off, g.scale, g.rows)).alias("a"), "c").select(
        *keys, "z", "a", F.explode(_overlaps(F.col("c"), g.col_off, g.scale, g.cols)).alias("b")
    )
    w = F.col("a.w") * F.col("b.w")
    valid = F.when(F.col("z").isNotNull(), w)
    total = F.sum(valid)
    return spread.groupBy(*keys, F.col("a.i").cast("long").alias("r"), F.col("b.i").cast("long").alias("c")).agg((F.sum(F.col("z") * w) / F.when(total > 0, total)).alias("z"))


def resampled_size(rows: int, cols: int, px: float, target: float) -> tuple[int, int]:
    """Rows and columns at another pixel size; the bounds stay."""
    return max(1, round(rows * px / target)), max(1, round(cols * px / target))


def shrink(cells: DataFrame, rows: int, cols: int, new_rows: int, new_cols: int, method: str = "average", keys: Sequence[str] = ()) -> DataFrame:
    """Each fine cell goes to the target cell that holds its centre."""
    if method not in DOWN:
        raise ValueError(f"method must be one of {DOWN}")
    agg = {"average": F.avg, "max": F.max, "min": F.min}[method]
    r = F.floor((F.col("r") + F.lit(0.5)) * F.lit(new_rows / rows)).cast("long")
    c = F.floor((F.col("c") + F.lit(0.5)) * F.lit(new_cols / cols)).cast("long")
    return cells.groupBy(*keys, r.alias("r"), c.alias("c")).agg(agg("z").alias("z"))


def _cubic(t: Column) -> list[Column]:
    """Weights of the four cells around a point a fraction t past the second (Catmull-Rom)."""
    half, one = F.lit(0.5), F.lit(1.0)
    return [
        half * t * (t * (F.lit(2.0) - t) - one),
        half * (t * t * (F.lit(3.0) * t - F.lit(5.0)) + F.lit(2.0)),
        half * t * ((F.lit(4.0) - F.lit(3.0) * t) * t + one),
        half * t * t * (t - one),
    ]


def grow(
    coarse: DataFrame,
    fine: DataFrame,
    rows: int,
    cols: int,
    row_scale: float,
    col_scale: float,
    row_off: float = 0.0,
    col_off: float = 0.0,
    method: str = "bilinear",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Values of a rows x cols `coarse` grid at the cells (keys, r, c) of a finer one.

    A coarse cell is row_scale x col_scale fine cells, the first one starts row_off, col_off in. Neighbours beyond
    the coarse edge repeat the edge cell; missing neighbours give their weight to the others.
    """
    if method not in UP:
        raise ValueError(f"method must be one of {UP}")
    y = (F.col("r") + F.lit(0.5 - row_off)) / F.lit(float(row_scale)) - F.lit(0.5)
    x = (F.col("c") + F.lit(0.5 - col_off)) / F.lit(float(col_scale)) - F.lit(0.5)

    def around(at: Column, count: int) -> tuple[Column, list[Column]]:
        """The cell that a neighbourhood is named by, and the weights of its cells."""
        low = F.floor(at + F.lit(0.5)) if method == "nearest" else F.floor(at)
        weights = {"nearest": lambda t: [F.lit(1.0)], "bilinear": lambda t: [F.lit(1.0) - t, t], "cubic": _cubic}[method](at - low)
        return F.least(F.greatest(low, F.lit(-2)), F.lit(count)).cast("long"), weights

    (row, row_weights), (col, col_weights) = around(y, rows), around(x, cols)
    placed = fine.select(*keys, "r", "c", row.alias("cr"), col.alias("cc"), *[w.alias(f"y{i}") for i, w in enumerate(row_weights)], *[w.alias(f"x{j}") for j, w in enumerate(col_weights)])
    met = placed.join(_neighbourhoods(coarse, rows, cols, _STEPS[method], keys), [*keys, "cr", "cc"], "left")
    parts = [(F.col(f"v{i}_{j}"), F.col(f"y{i}") * F.col(f"x{j}")) for i in range(len(row_weights)) for j in range(len(col_weights))]
    none = F.lit(0.0)
    total = sum((F.when(v.isNotNull(), w).otherwise(none) for v, w in parts), none)
    value = sum((F.coalesce(v * w, none) for v, w in parts), none)
    return met.select(*keys, "r", "c", F.when(F.abs(total) > 1e-9, value / total).alias("z"))


#: Cells of a neighbourhood, counted from the one before the point.
_STEPS = {"nearest": (0,), "bilinear": (0, 1), "cubic": (-1, 0, 1, 2)}


def _neighbourhoods(coarse: DataFrame, rows: int, cols: int, steps: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """(keys, cr, cc, v0_0, v0_1, ...): values of the cells at `steps` from (cr, cc), rows first, edge cells repeated beyond the edge.

    Made in two passes of windows over the cells' lines. Every place from two before the first row and column to one past the last
    has a row, also where `coarse` has no cell.
    """
    wide = cols + 3
    places = coarse.sparkSession.range((rows + 3) * wide).select((F.expr(f"id div {wide}") - 2).alias("cr"), (F.col("id") % wide - 2).alias("cc"), F.lit(None).cast("double").alias("z"), F.lit(True).alias("place"))
    if keys:
        places = places.crossJoin(coarse.select(*keys).distinct())
    cells = coarse.select(*keys, F.col("r").cast("long").alias("cr"), F.col("c").cast("long").alias("cc"), F.col("z").cast("double").alias("z"), F.lit(False).alias("place"))

    def seen(value: str, fixed: str, at: str, count: int, step: int) -> Column:
        line = Window.partitionBy(*keys, fixed).orderBy(at)
        whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        edge = lambda i: F.max(F.when(F.col(at) == i, F.col(value))).over(whole)
        there = F.col(at) + F.lit(step)
        return F.when(there < 0, edge(0)).when(there >= count, edge(count - 1)).otherwise(F.max(value).over(line.rangeBetween(step, step)))

    along = cells.unionByName(places).select(*keys, "cr", "cc", "place", *[seen("z", "cr", "cc", cols, s).alias(f"v{j}") for j, s in enumerate(steps)]).where("place")
    down = {f"v{i}_{j}": seen(f"v{j}", "cc", "cr", rows, s) for i, s in enumerate(steps) for j in range(len(steps))}
    return along.select(*keys, "cr", "cc", *[x.alias(n) for n, x in down.items()])


def through_blocks(cells: DataFrame, rows: int, cols: int, scale: int, method: str = "bilinear", keys: Sequence[str] = ()) -> DataFrame:
    """The fine grid again after averaging into centred blocks: a low-pass version of it."""
    g = centred(rows, cols, scale)
    return grow(block_average(cells, g, keys), cells, g.rows, g.cols, scale, scale, g.row_off, g.col_off, method, keys)


def cropped(coarse: DataFrame, geometry: Coarse, radius_px: float) -> DataFrame:
    """Without the coarse cells whose radius leaves the grid."""
    n = math.ceil(radius_px / geometry.scale)
    return coarse.where(F.col("r").between(n, geometry.rows - 1 - n) & F.col("c").between(n, geometry.cols - 1 - n))
