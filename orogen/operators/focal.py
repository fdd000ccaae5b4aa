"""Moving windows over raster cells.

A raster is a table of cells (r, c, z): row southwards, column eastwards, null where there is no data. Every
cell of the grid has to be there (`dense` adds the missing ones).

Everything is made in two passes over the cells, along rows and then along columns, however many
metrics and scales are asked for: windows of one pass share one shuffle and one sort. A k x k aggregate
is an aggregate of aggregates; the eight neighbours at a distance are the west and east ones of the row pass,
seen north and south in the column pass. Frames stop at the grid's edge, and neighbours beyond it are
the edge cell itself.

`keys` are further columns that tell rasters apart. A raster's rows are partitions of the first pass and its columns
of the second, so no task holds more than some lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from orogen.functions import angles
from orogen.functions.scales import evans_constants


def lines(axis: str, keys: Sequence[str] = ()) -> WindowSpec:
    """Cells of one row in column order (axis 'r'), or of one column in row order ('c')."""
    fixed, moving = ("r", "c") if axis == "r" else ("c", "r")
    return Window.partitionBy(*keys, fixed).orderBy(moving)


def dense(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """One row for each cell of a rows x cols grid; those that `cells` lacks are null."""
    grid = cells.sparkSession.range(rows * cols).select(F.expr(f"id div {cols}").alias("r"), (F.col("id") % cols).alias("c"))
    return grid.join(cells.select("r", "c", "z"), ["r", "c"], "left")


def _two_pass(cells: DataFrame, first: dict[str, Column], second: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    kept = [*keys, "r", "c", "z"]
    along = cells.select(*kept, *[x.alias(n) for n, x in first.items()])
    return along.select(*kept, *[x.alias(n) for n, x in second.items()])


# --- k x k aggregates ---------------------------------------------------------------------------------------------


#: Windows wider than this are put together by doubling instead of one frame per cell.
WIDE = 33


def box_sums(cells: DataFrame, widths: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """For each width k: n, s1, s2 (sum of squares), hi and lo of the window's valid cells, named n_k and so on."""
    z = F.col("z")
    start = {"n": z.isNotNull().cast("long"), "s1": F.coalesce(z, F.lit(0.0)), "s2": F.coalesce(z * z, F.lit(0.0)), "hi": z, "lo": z}
    out = cells.select(*keys, "r", "c", "z", *[x.alias(f"{n}_{k}") for k in widths for n, x in start.items()])
    for axis in "rc":
        line = lines(axis, keys)
        short = {f"{n}_{k}": _AGGREGATE[n](f"{n}_{k}").over(line.rangeBetween(-(k // 2), k // 2)) for k in widths if k <= WIDE for n in start}
        out = out.select(*[short.get(c, F.col(c)).alias(c) for c in out.columns])
        for k in widths:
            if k > WIDE:
                out = _doubled(out, {f"{n}_{k}": _COMBINE[n] for n in start}, line, k // 2)
    return out


_AGGREGATE = {"n": F.sum, "s1": F.sum, "s2": F.sum, "hi": F.max, "lo": F.min}
_COMBINE = {n: "sum" for n in ("n", "s1", "s2")} | {"hi": "max", "lo": "min"}


def _combined(how: str, parts: Sequence[Column]) -> Column:
    """Sum, maximum or minimum of what is there; parts beyond the end of a line are null."""
    if how == "sum":
        out = parts[0]
        for part in parts[1:]:
            out = out + F.coalesce(part, F.lit(0))
        return out
    if len(parts) == 1:
        return parts[0]
    return F.greatest(*parts) if how == "max" else F.least(*parts)


def _doubled(df: DataFrame, columns: dict[str, str], line: WindowSpec, d: int) -> DataFrame:
    """Each column combined over the cells from d before to d after, in about log2(d) steps of one shift each.

    Blocks of 1, 2, 4 ... cells onwards from a cell, and the same backwards up to it, add up to d + 1 cells from the cell
    on and d cells before it. All steps share the line's order, so they add neither shuffles nor sorts.
    """
    base = df.columns

    def shifted(name: str, steps: int) -> Column:
        return F.col(name) if not steps else (F.lead if steps > 0 else F.lag)(name, abs(steps)).over(line)

    size, made = 1, df.withColumns({f"__{way}1_{c}": F.col(c) for c in columns for way in "fb"})
    while 2 * size <= d + 1:
        new = {}
        for c, how in columns.items():
            for way, sign in (("f", 1), ("b", -1)):
                old = f"__{way}{size}_{c}"
                new[f"__{way}{2 * size}_{c}"] = _combined(how, [F.col(old), shifted(old, sign * size)])
        made, size = made.withColumns(new), 2 * size
    out = {}
    for c, how in columns.items():
        parts = []
        for way, sign, width, at in (("f", 1, d + 1, 0), ("b", -1, d, -1)):
            block = size
            while width:
                if block <= width:
                    parts.append(shifted(f"__{way}{block}_{c}", at))
                    at, width = at + sign * block, width - block
                else:
                    block //= 2
        out[c] = _combined(how, parts)
    return made.select(*[out.get(c, F.col(c)).alias(c) for c in base])


def where_valid(x: Column) -> Column:
    """Null at cells without data."""
    return F.when(F.col("z").isNotNull(), x)


def relief(k: int) -> Column:
    return where_valid(F.col(f"hi_{k}") - F.col(f"lo_{k}"))


def mean(k: int) -> Column:
    """Of the valid cells; also where the centre is missing, so it smooths over gaps."""
    return F.col(f"s1_{k}") / F.when(F.col(f"n_{k}") > 0, F.col(f"n_{k}"))


def stddev(k: int, fill: bool = False) -> Column:
    """Population standard deviation of the valid cells; with `fill` also where the centre is missing."""
    n = F.when(F.col(f"n_{k}") > 0, F.col(f"n_{k}"))
    out = F.sqrt(F.greatest(F.col(f"s2_{k}") / n - F.pow(F.col(f"s1_{k}") / n, F.lit(2.0)), F.lit(0.0)))
    return out if fill else where_valid(out)


def tpi(k: int) -> Column:
    return F.col("z") - mean(k)


def tri_rms(k: int) -> Column:
    """Root mean square difference to the window's cells."""
    return F.sqrt(F.pow(stddev(k), F.lit(2.0)) + F.pow(tpi(k), F.lit(2.0)))


def window_features(cells: DataFrame, widths: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """relief, stddev, mean, tpi and tri_rms at each width."""
    sums = box_sums(cells, widths, keys)
    made = [f(k).alias(f"{n}_{k}") for k in widths for n, f in (("relief", relief), ("stddev", stddev), ("mean", mean), ("tpi", tpi), ("tri_rms", tri_rms))]
    return sums.select(*keys, "r", "c", "z", *made)


def smooth_box(cells: DataFrame, k: int, keys: Sequence[str] = ()) -> DataFrame:
    """The same cells with z replaced by the window's mean; gaps with any neighbour are filled."""
    return box_sums(cells, [k], keys).select(*keys, "r", "c", mean(k).alias("z"))


def smooth_gauss(cells: DataFrame, sigma: float, keys: Sequence[str] = ()) -> DataFrame:
    """z replaced by the Gaussian mean of the valid cells within four sigma; cells beyond the edge repeat the edge cell.

    Each pass adds up weighted neighbours as one expression over lag-like frames, as many as eight sigma.
    """
    reach = int(4 * sigma + 0.5)
    weights = {i: 2.718281828459045 ** (-0.5 * (i / sigma) ** 2) for i in range(-reach, reach + 1)}
    total = sum(weights.values())

    def passed(value: str, axis: str) -> Column:
        out = None
        for i, w in weights.items():
            part = neighbour(F.col(value), lines(axis, keys), i) * F.lit(w / total)
            out = part if out is None else out + part
        return out

    start = cells.select(*keys, "r", "c", F.coalesce("z", F.lit(0.0)).alias("a"), F.col("z").isNotNull().cast("double").alias("b"))
    along = start.select(*keys, "r", "c", passed("a", "r").alias("a"), passed("b", "r").alias("b"))
    down = along.select(*keys, "r", "c", passed("a", "c").alias("a"), passed("b", "c").alias("b"))
    return down.select(*keys, "r", "c", F.when(F.col("b") > 1e-12, F.col("a") / F.col("b")).alias("z"))


# --- neighbours and derivatives -----------------------------------------------------------------------------------


def neighbour(value: Column, line: WindowSpec, step: int) -> Column:
    """The value `step` cells on along a line; beyond its end, the end cell's (W10). Constant work however far it looks."""
    if step == 0:
        return value
    # in a struct, a missing value differs from a missing cell
    found = (F.lag if step < 0 else F.lead)(F.struct(value.alias("v")), abs(step)).over(line)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.when(found.isNull(), (F.first if step < 0 else F.last)(value).over(whole)).otherwise(found["v"])


def neighbours(cells: DataFrame, d: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """The cells at distance d in the eight directions, as nw, n, ne, w, e, sw, s, se."""
    row, col = lines("r", keys), lines("c", keys)
    first = {"w": neighbour(F.col("z"), row, -d), "e": neighbour(F.col("z"), row, d)}
    second = {"w": F.col("w"), "e": F.col("e")}
    for name, value in (("n", "z"), ("nw", "w"), ("ne", "e")):
        second[name] = neighbour(F.col(value), col, -d)
        second[name.replace("n", "s", 1)] = neighbour(F.col(value), col, d)
    return _two_pass(cells, first, second, keys)


def _all(*names: str) -> list[Column]:
    return [F.col(n) for n in names]


def tri(cells: DataFrame, d: int, keys: Sequence[str] = ()) -> DataFrame:
    """Mean absolute difference to the eight cells at distance d (those with data)."""
    around = _all("nw", "n", "ne", "w", "e", "sw", "s", "se")
    diffs = [F.abs(x - F.col("z")) for x in around]
    count = sum((x.isNotNull().cast("int") for x in around), F.lit(0))
    total = sum((F.coalesce(x, F.lit(0.0)) for x in diffs), F.lit(0.0))
    return neighbours(cells, d, keys).select(*keys, "r", "c", where_valid(total / F.when(count > 0, count)).alias("tri"))


def horn(cells: DataFrame, px: float, keys: Sequence[str] = (), convention: str = "compass_down") -> DataFrame:
    """Slope and aspect from Horn's 3 x 3 gradient, and the eight-neighbour Laplacian; null next to a gap."""
    nw, n, ne, w, e, sw, s, se = _all("nw", "n", "ne", "w", "e", "sw", "s", "se")
    z, two, eight = F.col("z"), F.lit(2.0), F.lit(8.0)
    east = ((ne + two * e + se) - (nw + two * w + sw)) / F.lit(8.0 * px)
    north = ((nw + two * n + ne) - (sw + two * s + se)) / F.lit(8.0 * px)
    lap = (nw + n + ne + w + e + sw + s + se - eight * z) / F.lit(px * px)
    found = neighbours(cells, 1, keys).select(*keys, "r", "c", "z", east.alias("gx"), north.alias("gy"), lap.alias("laplacian"))
    gx, gy = F.col("gx"), F.col("gy")
    whole = F.col("z").isNotNull() & gx.isNotNull() & gy.isNotNull()
    shown = {"slope": angles.slope(gx, gy), "aspect": angles.aspect(gx, gy, convention), "laplacian": F.col("laplacian")}
    return found.select(*keys, "r", "c", *[F.when(whole, x).alias(name) for name, x in shown.items()])


def gradient(value: Column, axis: str, px: float, keys: Sequence[str] = ()) -> Column:
    """Central difference along a line, one-sided at its ends; positive towards higher row or column numbers."""
    line = lines(axis, keys)
    at = F.col("c" if axis == "r" else "r")
    near = line.rowsBetween(-1, 1)
    span = (F.last(at).over(near) - F.first(at).over(near)) * F.lit(float(px))
    return (F.last(value).over(near) - F.first(value).over(near)) / F.when(span != 0, span)


def derivatives(cells: DataFrame, px: float, keys: Sequence[str] = ()) -> DataFrame:
    """p, q (first) and rr, ss, tt (second: xx, xy, yy) by repeated central differences; y counts southwards."""
    base = [*keys, "r", "c", "z"]
    x1 = cells.select(*base, gradient(F.col("z"), "r", px, keys).alias("p"))
    x2 = x1.select(*base, "p", gradient(F.col("p"), "r", px, keys).alias("rr"))
    y1 = x2.select(*base, "p", "rr", gradient(F.col("z"), "c", px, keys).alias("q"), gradient(F.col("p"), "c", px, keys).alias("ss"))
    return y1.select(*base, "p", "q", "rr", "ss", gradient(F.col("q"), "c", px, keys).alias("tt"))


def gradient_features(cells: DataFrame, px: float, keys: Sequence[str] = (), convention: str = "math_up_rows") -> DataFrame:
    """Slope, aspect, Laplacian and mean curvature by repeated central differences."""
    d = derivatives(cells, px, keys)
    p, q, r, s, t = (F.col(x) for x in ("p", "q", "rr", "ss", "tt"))
    whole = F.col("z").isNotNull() & p.isNotNull() & q.isNotNull()
    return d.select(
        *keys,
        "r",
        "c",
        F.when(whole, angles.slope(p, q)).alias("slope"),
        F.when(whole, angles.aspect(p, -q, convention)).alias("aspect"),
        where_valid(r + t).alias("laplacian"),
        where_valid(angles.mean_curvature(p, q, r, s, t)).alias("curvature"),
    )


def distant_features(cells: DataFrame, px: float, d: int, keys: Sequence[str] = (), convention: str = "compass_up") -> DataFrame:
    """Slope, aspect, Laplacian and mean curvature from the eight cells at distance d."""
    nw, n, ne, w, e, sw, s, se = _all("nw", "n", "ne", "w", "e", "sw", "s", "se")
    z, h = F.col("z"), d * px
    p, q = (e - w) / F.lit(2.0 * h), (n - s) / F.lit(2.0 * h)
    r = (e - F.lit(2.0) * z + w) / F.lit(h * h)
    t = (n - F.lit(2.0) * z + s) / F.lit(h * h)
    cross = (ne - nw - se + sw) / F.lit(4.0 * h * h)
    names = ("p", "q", "rr", "ss", "tt")
    found = neighbours(cells, d, keys).select(*keys, "r", "c", "z", *[x.alias(k) for k, x in zip(names, (p, q, r, cross, t), strict=True)])
    return _shown(found, keys, convention)


def _shown(found: DataFrame, keys: Sequence[str], convention: str) -> DataFrame:
    p, q, r, s, t = (F.col(x) for x in ("p", "q", "rr", "ss", "tt"))
    return found.select(
        *keys,
        "r",
        "c",
        angles.slope(p, q).alias("slope"),
        F.when(p.isNotNull() & q.isNotNull(), angles.aspect(p, q, convention)).alias("aspect"),
        (r + t).alias("laplacian"),
        angles.mean_curvature(p, q, r, s, t).alias("curvature"),
    )


# --- least-squares quadratics -------------------------------------------------------------------------------------


def _moved(m: Sequence[Column], at: int) -> list[Column]:
    """Sums of z, i z and i² z of a block, when its first offset becomes `at` instead of 0."""
    out = [m[0]]
    if len(m) > 1:
        out.append(m[1] + F.lit(float(at)) * m[0])
    if len(m) > 2:
        out.append(m[2] + F.lit(2.0 * at) * m[1] + F.lit(float(at * at)) * m[0])
    return out


def _moments(df: DataFrame, values: dict[str, int], axis: str, d: int, keys: Sequence[str]) -> DataFrame:
    """For each column, up to its power e: sums over the cells from d before to d after of the value times the offset to the power e.

    Blocks of 1, 2, 4 ... cells onwards from a cell, and backwards from it, carry their moments; two blocks make the next one. Beyond
    a line's end a block holds its end cell alone. All steps share the line's order, so they add neither shuffles nor sorts.
    """
    line = lines(axis, keys)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = df.columns
    made = df.withColumns({f"__{way}_{v}": how(v).over(whole) for v in values for way, how in (("f", F.last), ("b", F.first))})

    def block(v: str, way: str, size: int, steps: int) -> list[Column]:
        """The moments of the block that starts so many steps from here."""
        name, power = f"__{way}{size}_{v}", values[v]
        own = [F.col(name)[f"m{e}"] for e in range(power + 1)]
        if not steps:
            return own
        there = (F.lead if way == "f" else F.lag)(name, steps).over(line)
        end = F.col(f"__{way}_{v}")
        flat = [end * F.lit(float(sum(i**e for i in range(size)))) for e in range(power + 1)]
        return [F.when(there.isNull(), x).otherwise(there[f"m{e}"]) for e, x in enumerate(flat)]

    def struct(moments: Sequence[Column]) -> Column:
        return F.struct(*[m.alias(f"m{e}") for e, m in enumerate(moments)])

    def total(x: Sequence[Column], y: Sequence[Column]) -> list[Column]:
        return [a + b for a, b in zip(x, y, strict=True)]

    size = 1
    made = made.withColumns({f"__{way}1_{v}": struct([F.col(v), *[F.col(v) * 0.0] * power]) for v, power in values.items() for way in "fb"})
    while 2 * size <= d + 1:
        new = {f"__{way}{2 * size}_{v}": struct(total(block(v, way, size, 0), _moved(block(v, way, size, size), size))) for v in values for way in "fb"}
        made, size = made.withColumns(new), 2 * size
    out = {}
    for v, power in values.items():
        sums = None
        for way, cells, at in (("f", d + 1, 0), ("b", d, 1)):
            width = size
            while cells:
                if width <= cells:
                    part = _moved(block(v, way, width, at), at)
                    if way == "b":  # offsets count backwards there
                        part = [-m if e == 1 else m for e, m in enumerate(part)]
                    sums = part if sums is None else total(sums, part)
                    at, cells = at + width, cells - width
                else:
                    width //= 2
        out |= {f"{v}{e}": sums[e] for e in range(power + 1)}
    return made.select(*kept, *[m.alias(n) for n, m in out.items()])


def quadratic(cells: DataFrame, px: float, k: int, keys: Sequence[str] = (), zero_fill: bool = False) -> DataFrame:
    """p, q, rr, ss, tt of the least-squares quadratic over k x k cells (north positive).

    The moments are window sums weighted by powers of the offset from the centre, put together by doubling: the work
    for a cell grows with log2(k), and offsets stay small, so nothing large cancels. A window with a missing cell gives null, unless
    `zero_fill` counts missing cells as 0. Cells beyond the edge repeat the edge cell.
    """
    d, con = k // 2, evans_constants(k)
    z = F.coalesce("z", F.lit(0.0)) if zero_fill else F.col("z")
    kept = [*keys, "r", "c", "z"]
    along = _moments(cells.select(*kept, z.alias("x")), {"x": 2}, "r", d, keys).select(*kept, "x0", "x1", "x2")
    down = _moments(along, {"x0": 2, "x1": 1, "x2": 0}, "c", d, keys)
    m = down.select(*kept, *[F.col(f"x{e}{f}").alias(f"m{e}{f}") for e, f in ((0, 0), (1, 0), (2, 0), (0, 1), (0, 2), (1, 1))])
    s2, h = float(con["s2"]), float(px)
    one = float(k * con["s2"]) * h
    curve = 2.0 / (con["second"] * h * h)
    # gaps may count as 0 in a window, but a cell without data has no result
    m = m.withColumns({n: where_valid(F.col(n)) for n in ("m00", "m10", "m20", "m01", "m02", "m11")})
    return m.select(
        *keys,
        "r",
        "c",
        "z",
        (F.col("m10") / F.lit(one)).alias("p"),
        (-F.col("m01") / F.lit(one)).alias("q"),
        ((F.col("m20") - F.lit(s2 / k) * F.col("m00")) * F.lit(curve)).alias("rr"),
        (-F.col("m11") / F.lit(con["cross"] * h * h)).alias("ss"),
        ((F.col("m02") - F.lit(s2 / k) * F.col("m00")) * F.lit(curve)).alias("tt"),
    )


def evans_features(cells: DataFrame, px: float, k: int, keys: Sequence[str] = (), convention: str = "compass_up", zero_fill: bool = False) -> DataFrame:
    """Slope, aspect, Laplacian and mean curvature of the least-squares quadratic."""
    found = quadratic(cells, px, k, keys, zero_fill)
    return _shown(found, keys, convention)


def wood_features(cells: DataFrame, px: float, k: int, keys: Sequence[str] = (), zero_fill: bool = False) -> DataFrame:
    """Slope, upslope azimuth, and plan, profile and mean curvature of the quadratic (curvatures: convex is positive)."""
    found = quadratic(cells, px, k, keys, zero_fill)
    p, q, r, s, t = (F.col(x) for x in ("p", "q", "rr", "ss", "tt"))
    g2 = p * p + q * q
    flat, rise = g2 + F.lit(1e-10), F.lit(1.0) + g2  # the constant keeps level ground finite
    plan = -(q * q * r - F.lit(2.0) * p * q * s + p * p * t) / (flat * F.sqrt(rise))
    profile = -(p * p * r + F.lit(2.0) * p * q * s + q * q * t) / (flat * F.pow(rise, F.lit(1.5)))
    return found.select(
        *keys,
        "r",
        "c",
        angles.slope(p, q).alias("slope"),
        F.when(p.isNotNull() & q.isNotNull(), angles.aspect(p, q, "compass_up")).alias("aspect"),
        plan.alias("plan"),
        profile.alias("profile"),
        (-angles.mean_curvature(p, q, r, s, t)).alias("curvature"),
    )


# --- masks and residuals ------------------------------------------------------------------------------------------


def inside(k: int, rows: int, cols: int) -> Column:
    """Whether a k x k window around the cell lies in the grid."""
    d = k // 2
    return F.col("r").between(d, rows - 1 - d) & F.col("c").between(d, cols - 1 - d)


def edge_masked(df: DataFrame, names: Sequence[str], k: int, rows: int, cols: int) -> DataFrame:
    """These columns as null where the widest window leaves the grid."""
    return df.withColumns({n: F.when(inside(k, rows, cols), F.col(n)) for n in names})


def residual(fine: DataFrame, base: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Metric minus the same metric of a smoother base, per cell; aspects as differences on the circle."""
    on = [*keys, "r", "c"]
    both = fine.select(*on, *[F.col(n).alias(f"{n}__a") for n in names]).join(base.select(*on, *[F.col(n).alias(f"{n}__b") for n in names]), on)
    minus = {n: angles.difference(F.col(f"{n}__a"), F.col(f"{n}__b")) if n == "aspect" else F.col(f"{n}__a") - F.col(f"{n}__b") for n in names}
    return both.select(*on, *[x.alias(n) for n, x in minus.items()])
