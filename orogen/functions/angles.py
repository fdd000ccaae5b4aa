"""Angles as columns. All literals are doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How an aspect is read: (clockwise from north or counter-clockwise from east, up or down the slope, whether rows count southwards).
CONVENTIONS = ("compass_down", "compass_up", "math_down", "math_up_rows")


def slope(gx: Column, gy: Column) -> Column:
    return F.degrees(F.atan(F.sqrt(gx * gx + gy * gy)))


def turned(angle: Column) -> Column:
    """Into 0 up to 360."""
    return F.pmod(angle, F.lit(360.0))


#: A quarter turn is the sum of these two.
_QUARTER = (1.5707963267948966, 6.123233995736766e-17)


def direction(y: Column, x: Column) -> Column:
    """atan2, rounded once near the y axis. Spark's own rounds twice west of it, and an azimuth a last bit west of north is 360 or 0."""
    high, low = (F.lit(part) for part in _QUARTER)
    off_axis = high + (low - F.atan(x / F.abs(y)))
    return F.when(F.abs(y) > F.abs(x), F.signum(y) * off_axis).otherwise(F.atan2(y, x))


def aspect(east: Column, north: Column, convention: str = "compass_down") -> Column:
    """Azimuth of a slope from its upward gradient (east, north)."""
    if convention == "compass_down":
        return turned(F.lit(90.0) - F.degrees(direction(-north, -east)))
    if convention == "compass_up":
        return turned(F.lit(90.0) - F.degrees(direction(north, east)))
    if convention == "math_down":
        return turned(F.degrees(direction(-north, -east)))
    if convention == "math_up_rows":
        return turned(F.degrees(direction(-north, east)))
    raise ValueError(f"convention must be one of {CONVENTIONS}")


def difference(a: Column, b: Column) -> Column:
    """a - b on the circle, -180 up to 180."""
    return F.pmod(a - b + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def mean_curvature(p: Column, q: Column, r: Column, s: Column, t: Column) -> Column:
    """Of a surface with first derivatives p, q and second derivatives r (xx), s (xy), t (yy)."""
    one = F.lit(1.0)
    top = (one + q * q) * r - F.lit(2.0) * p * q * s + (one + p * p) * t
    return top / (F.lit(2.0) * F.pow(one + p * p + q * q, F.lit(1.5)))
