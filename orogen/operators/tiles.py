"""Kernels that no window expresses: square tiles with a halo, one shuffle, numpy on each tile.

A cell goes to the tile it lies in and to those whose halo it lies in, so with tiles wider than the
halo at most to four; a tile is a bounded array whatever the raster's size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogen.functions.scales import directions

TILE = 256


def _touched(at: Column, halo: int, size: int) -> Column:
    low = F.floor(F.greatest(at - F.lit(halo), F.lit(0)) / F.lit(size))
    return F.sequence(low, F.floor((at + F.lit(halo)) / F.lit(size)))


def tiled(
    cells: DataFrame,
    halo: int,
    kernel: Callable[[np.ndarray], dict[str, np.ndarray]],
    names: Sequence[str],
    keys: Sequence[str] = (),
    size: int = TILE,
) -> DataFrame:
    """Run `kernel` on each tile's z (NaN: no data or outside the grid); it returns arrays of the same shape by name.

    The result has (keys, r, c, names) for each cell of `cells`, which must not be negative.
    """
    size = max(size, halo)
    key_types = [cells.schema[k].dataType.simpleString() for k in keys]
    spread = (
        cells.select(*keys, F.col("r").cast("long"), F.col("c").cast("long"), F.col("z").cast("double"))
        .select("*", F.explode(_touched(F.col("r"), halo, size)).alias("tr"))
        .select("*", F.explode(_touched(F.col("c"), halo, size)).alias("tc"))
    )

    def run(rows: pa.Table) -> pa.Table:
        r, c, tr, tc = (rows[n].to_numpy() for n in ("r", "c", "tr", "tc"))
        z = rows["z"].to_numpy()  # nulls come as NaN
        r0, c0 = int(tr[0]) * size - halo, int(tc[0]) * size - halo
        field = np.full((size + 2 * halo, size + 2 * halo), np.nan)
        field[r - r0, c - c0] = z
        own = (r // size == tr) & (c // size == tc)
        out = kernel(field) if own.any() else {n: field for n in names}
        columns = {k: rows[k].filter(pa.array(own)) for k in keys}
        columns |= {"r": r[own], "c": c[own]}
        for n in names:
            columns[n] = pa.array(out[n][r[own] - r0, c[own] - c0], from_pandas=True)
        return pa.table(columns)

    shape = ", ".join([*(f"`{k}` {t}" for k, t in zip(keys, key_types, strict=True)), "r long", "c long", *(f"`{n}` double" for n in names)])
    return spread.groupBy(*keys, "tr", "tc").applyInArrow(run, shape)


def _shifted(field: np.ndarray, dr: int, dc: int) -> np.ndarray:
    """The value at (r + dr, c + dc); NaN beyond the array."""
    out = np.full_like(field, np.nan)
    h, w = field.shape
    if abs(dr) < h and abs(dc) < w:
        out[max(0, -dr) : h - max(0, dr), max(0, -dc) : w - max(0, dc)] = field[max(0, dr) : h - max(0, -dr), max(0, dc) : w - max(0, -dc)]
    return out


def _half_even(x: float) -> int:
    return int(round(x))


def ray_offsets(radius_px: float, n_dirs: int, stride: int = 1, full_circle: bool = False) -> list[tuple[int, int, int]]:
    """(ray, row step, column step) of the nearest cells along each ray, once each; the centre is left out."""
    out = []
    for k, (east, north) in enumerate(directions(n_dirs, full_circle)):
        for s in range(1, max(1, int(radius_px)) + 1, stride):
            # rays of the nearest-cell form run southwards
            step = (k, _half_even(round(north * s, 9)), _half_even(round(east * s, 9)))
            if step[1:] != (0, 0) and step not in out:
                out.append(step)
    return out


def openness(
    cells: DataFrame,
    px: float,
    radius_m: float,
    n_dirs: int = 8,
    stride: int = 1,
    method: str = "bilinear",
    full_circle: bool = False,
    keys: Sequence[str] = (),
    size: int = TILE,
) -> DataFrame:
    """(keys, r, c, pos, neg): 90 degrees less the mean over rays of the steepest angle up (pos) and down (neg).

    method 'nearest' takes the nearest cell and its true distance, 'bilinear' interpolates and needs all four
    neighbours in the grid. Only rays that meet data count; a cell whose rays meet none has null.
    """
    reach = max(1, int(radius_m / px))
    if method not in ("nearest", "bilinear"):
        raise ValueError("method must be 'nearest' or 'bilinear'")

    def kernel(field: np.ndarray) -> dict[str, np.ndarray]:
        up = np.zeros_like(field)
        down = np.zeros_like(field)
        met = np.zeros_like(field)
        offsets = ray_offsets(radius_m / px, n_dirs, stride, full_circle)
        for k, (east, north) in enumerate(directions(n_dirs, full_circle)):
            high = np.full_like(field, -np.inf)
            low = np.full_like(field, -np.inf)
            if method == "nearest":
                steps = [(_shifted(field, dr, dc), np.hypot(dr, dc) * px) for ray, dr, dc in offsets if ray == k]
            else:
                steps = [(_bilinear(field, -north * s, east * s), s * px) for s in range(1, reach + 1, stride)]
            for z, distance in steps:
                tangent = (z - field) / distance
                high = np.fmax(high, tangent)
                low = np.fmax(low, -tangent)
            hit = np.isfinite(high)
            up += np.where(hit, np.arctan(np.where(hit, high, 0)), 0)
            down += np.where(hit, np.arctan(np.where(hit, low, 0)), 0)
            met += hit
        n = np.where(met > 0, met, np.nan)
        gap = np.isnan(field)
        return {"pos": np.where(gap, np.nan, 90 - np.degrees(up / n)), "neg": np.where(gap, np.nan, 90 - np.degrees(down / n))}

    return tiled(cells, reach + 1, kernel, ["pos", "neg"], keys, size)


def _bilinear(field: np.ndarray, dr: float, dc: float) -> np.ndarray:
    r0, c0 = int(np.floor(round(dr, 9))), int(np.floor(round(dc, 9)))
    wr, wc = dr - r0, dc - c0
    return (
        _shifted(field, r0, c0) * (1 - wr) * (1 - wc)
        + _shifted(field, r0, c0 + 1) * (1 - wr) * wc
        + _shifted(field, r0 + 1, c0) * wr * (1 - wc)
        + _shifted(field, r0 + 1, c0 + 1) * wr * wc
    )
