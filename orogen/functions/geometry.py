"""Points and polygons without a geometry library: WKB and WKT of points, crossing numbers, boxes."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.BinaryType())
def point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    """Little-endian WKB of points; null if a coordinate is."""
    kind = np.dtype([("order", "u1"), ("type", "<u4"), ("x", "<f8"), ("y", "<f8")])
    rows = np.zeros(len(x), dtype=kind)
    rows["order"], rows["type"] = 1, 1
    rows["x"], rows["y"] = x.to_numpy(float), y.to_numpy(float)
    made = pd.Series([r.tobytes() for r in rows], dtype=object)
    return made.where(~(np.isnan(rows["x"]) | np.isnan(rows["y"])), None)


@F.pandas_udf(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
def wkb_point(wkb: pd.Series) -> pd.DataFrame:
    """Coordinates of a WKB point, or the mean of the vertices of the first ring of a polygon; null for anything else."""

    def read(raw: bytes | None) -> tuple[float, float] | tuple[None, None]:
        try:
            order = "<" if raw[0] == 1 else ">"
            kind = struct.unpack_from(order + "I", raw, 1)[0] % 1000
            if kind == 1:
                return struct.unpack_from(order + "2d", raw, 5)
            if kind == 3:
                n = struct.unpack_from(order + "I", raw, 9)[0]
                ring = np.frombuffer(raw, order + "f8", 2 * n, 13).reshape(-1, 2)
                ring = ring[:-1] if n > 1 and (ring[0] == ring[-1]).all() else ring
                return tuple(ring.mean(0).tolist())
        except (TypeError, IndexError, struct.error, ValueError):
            pass
        return (None, None)

    return pd.DataFrame([read(r) for r in wkb], columns=["x", "y"], dtype="float64")


def point_wkt(x: Column, y: Column) -> Column:
    return F.when(x.isNotNull() & y.isNotNull(), F.concat(F.lit("POINT ("), x.cast("double").cast("string"), F.lit(" "), y.cast("double").cast("string"), F.lit(")")))


def wkt_point(text: Column) -> Column:
    """(x, y) of a WKT point; null if it is none."""
    pattern = r"(?i)^\s*POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)\s*$"
    part = lambda n: F.regexp_extract(text, pattern, n).try_cast("double")
    return F.when(text.rlike(pattern), F.struct(part(1).alias("x"), part(2).alias("y")))


def geometry_point(value: Column) -> Column:
    """(x, y) of hexadecimal WKB or of WKT; null for bad values."""
    hexed = F.when(value.rlike("^([0-9A-Fa-f]{2})+$"), F.unhex(value))
    return F.coalesce(wkt_point(value), F.when(hexed.isNotNull(), wkb_point(hexed)))


def rectangle_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(corner(xmin, ymin), corner(xmax, ymin), corner(xmax, ymax), corner(xmin, ymax), corner(xmin, ymin))


@F.pandas_udf(T.BooleanType())
def inside_polygon(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Even-odd rule over all rings (closed or not): holes and separate parts need no marks."""
    for xs, ys, rings in parts:
        out = []
        for x, y, polygon in zip(xs, ys, rings, strict=True):
            crossings = 0
            for ring in polygon if x is not None and polygon is not None else ():
                a = np.array([(p["x"], p["y"]) for p in ring], dtype=float).reshape(-1, 2)
                b = np.roll(a, -1, axis=0)
                spans = (a[:, 1] > y) != (b[:, 1] > y)
                with np.errstate(divide="ignore", invalid="ignore"):
                    at = a[:, 0] + (y - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])
                crossings += int((spans & (x < at)).sum())
            out.append(crossings % 2 == 1)
        yield pd.Series(out, dtype=bool)
