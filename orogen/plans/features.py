"""Whole feature sets: one scale stack as one lazy plan, and the training table made of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orogen.operators import focal, joins, resample, tiles

METRICS = ("slope", "aspect", "laplacian", "curvature", "relief", "stddev")


def scale_features(cells: DataFrame, widths: Sequence[int], px: float, rows: int | None, cols: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Window statistics at each width and Horn derivatives, per cell; masked at the edge if the grid's size is given."""
    windows = focal.window_features(cells, widths, keys)
    slopes = focal.horn(cells, px, keys)
    out = windows.join(slopes, [*keys, "r", "c"])
    if rows and cols:
        out = focal.edge_masked(out, [c for c in out.columns if c not in (*keys, "r", "c", "z")], max(widths), rows, cols)
    return out


def metrics(cells: DataFrame, k: int, px: float, keys: Sequence[str] = ()) -> DataFrame:
    """The six metrics of one surface that residuals compare."""
    on = [*keys, "r", "c"]
    derived = focal.gradient_features(cells, px, keys)
    spread = focal.window_features(cells, [k], keys).select(*on, F.col(f"relief_{k}").alias("relief"), F.col(f"stddev_{k}").alias("stddev"))
    return derived.join(spread, on)


def variants(
    cells: DataFrame, rows: int, cols: int, scale: int, k: int, px: float, which: Sequence[str] = ("rsu", "sm", "res"), sigma: float | None = None, method: str = "bilinear"
) -> DataFrame:
    """Metrics of resampled and smoothed surfaces, as (r, c, metric_variant).

    'rsu' averages into blocks and interpolates back, 'sm' smooths (box, or Gaussian with `sigma`), 'res' is the metric of the
    surface less that of the 'rsu' one; 'rsd' (coarse cells) is `coarse_metrics`.
    """
    surfaces = {}
    if {"rsu", "res"} & set(which):
        surfaces["rsu"] = resample.through_blocks(cells, rows, cols, scale, method)
    if "sm" in which:
        surfaces["sm"] = focal.smooth_gauss(cells, sigma) if sigma else focal.smooth_box(cells, k)
    made = {name: metrics(surface, k, px) for name, surface in surfaces.items() if name in which or "res" in which}
    if "res" in which:
        made["res"] = focal.residual(metrics(cells, k, px), made["rsu"], METRICS)
    out = None
    for name in which:
        part = made[name].select("r", "c", *[F.col(m).alias(f"{m}_{name}") for m in METRICS])
        out = part if out is None else out.join(part, ["r", "c"])
    return out


def coarse_metrics(cells: DataFrame, rows: int, cols: int, scale: int, k: int, px: float, crop_px: float = 0.0) -> DataFrame:
    """Relief and deviation made fine and then averaged, derivatives of the averaged surface, per coarse cell."""
    g = resample.centred(rows, cols, scale)
    coarse = resample.block_average(cells, g)
    derived = focal.gradient_features(coarse, px * scale)
    fine = focal.window_features(cells, [k])
    for name in ("relief", "stddev"):
        part = resample.block_average(fine.select("r", "c", F.col(f"{name}_{k}").alias("z")), g)
        derived = derived.join(part.withColumnRenamed("z", name), ["r", "c"])
    return resample.cropped(derived, g, crop_px) if crop_px else derived


def openness_stack(cells: DataFrame, px: float, radii: Sequence[float], **options: object) -> DataFrame:
    out = None
    for radius in radii:
        part = tiles.openness(cells, px, radius, **options).withColumnsRenamed({n: f"{n}_{radius:g}" for n in ("pos", "neg")})
        out = part if out is None else out.join(part, ["r", "c"])
    return out


def training_points(
    spark_points: DataFrame,
    stack: DataFrame,
    transform: tuple[float, float, float, float],
    values: Sequence[str],
    labels: DataFrame | None = None,
    attributes: Sequence[str] = (),
    size: float = 10.0,
    point_id: str = "pid",
    polygon_id: str = "gid",
    dedup: str = "first",
    inside_only: bool = False,
) -> DataFrame:
    """Points with the features of their cells and the attributes of the rectangles they lie in."""
    out = joins.sample_cells(spark_points, stack, transform, values)
    if labels is not None:
        pairs = joins.in_rectangles(spark_points.select(point_id, "x", "y"), labels, size, point_id)
        out = joins.attach_polygon_attributes(out, pairs, attributes, point_id, polygon_id, dedup)
        if inside_only:
            out = joins.kept_in_layers(out, [list(attributes)], every=True)
    return out
