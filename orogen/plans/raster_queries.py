"""Queries over the events grid: windows, derivatives, openness, resampling."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.functions import angles
from orogen.functions.scales import directions
from orogen.operators import focal, resample, tiles
from orogen.plans import features
from orogen.plans.inputs import SQL, WIDTH, dem, dem_rows

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
PX = 2.0


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        f.__name__ = name
        QUERIES[name] = (f, sql)
        return f

    return add


#: Values on exact halves would round by their last bit; moved by this, both sides round them alike.
SHIFT = 3e-8


def rounded(df: DataFrame, names: list[str], digits: int = 5) -> DataFrame:
    return df.select("r", "c", *[(F.round(F.col(n) + F.lit(SHIFT), digits) + F.lit(0.0)).alias(n) for n in names])


def _rounded_sql(columns: dict[str, str], digits: int = 5) -> str:
    return ", ".join(f"round(({x}) + {SHIFT}, {digits}) + 0.0 AS {n}" for n, x in columns.items())


# --- k x k windows ------------------------------------------------------------------------------------------------


def _focal_of(source: str, k: int, name: str = "v") -> str:
    """`name`(r, c, z, n, s1, s2, hi, lo) of a table of cells."""
    d = k // 2
    frame = f"RANGE BETWEEN {d} PRECEDING AND {d} FOLLOWING"
    return f"""{name}_h AS (
  SELECT r, c, z, count(z) OVER w AS n, sum(z) OVER w AS s1, sum(z * z) OVER w AS s2, max(z) OVER w AS hi, min(z) OVER w AS lo
  FROM {source} WINDOW w AS (PARTITION BY r ORDER BY c {frame})
), {name} AS (
  SELECT r, c, z, sum(n) OVER w AS n, sum(s1) OVER w AS s1, sum(s2) OVER w AS s2, max(hi) OVER w AS hi, min(lo) OVER w AS lo
  FROM {name}_h WINDOW w AS (PARTITION BY c ORDER BY r {frame})
)"""


def _focal_sql(k: int, source: str = "demn") -> str:
    return f"{SQL[source]}, {_focal_of('dem', k)}"


_WINDOW = {
    "relief": "CASE WHEN z IS NOT NULL THEN hi - lo END",
    "stddev": "CASE WHEN z IS NOT NULL THEN sqrt(greatest(s2 / n - (s1 / n) * (s1 / n), 0)) END",
    "mean": "s1 / nullif(n, 0)",
    "tpi": "z - s1 / nullif(n, 0)",
    "tri_rms": "CASE WHEN z IS NOT NULL THEN sqrt(greatest(s2 / n - (s1 / n) * (s1 / n), 0) + (z - s1 / n) * (z - s1 / n)) END",
}
_ONE = {
    "W01_W02_W52_local_relief": ("relief", 3),
    "W03_W04_W05_local_stddev": ("stddev", 5),
    "W06_local_mean": ("mean", 5),
    "W07_local_tpi": ("tpi", 7),
    "W09_tri_rms": ("tri_rms", 5),
    "W11_W13_smooth_box": ("mean", 3),
}
for _name, (_metric, _k) in _ONE.items():

    def _window(spark: SparkSession, d: str, m: str = _metric, k: int = _k) -> DataFrame:
        got = focal.window_features(dem(spark, d, gaps=True), [k])
        return rounded(got.withColumnRenamed(f"{m}_{k}", m), [m])

    query(_name, f"WITH {_focal_sql(_k)} SELECT r, c, {_rounded_sql({_metric: _WINDOW[_metric]})} FROM v")(_window)


@query(
    "W45_W46_edge_mask",
    f"WITH {_focal_sql(7)}, e AS (SELECT max(r) AS last FROM dem) SELECT r, c, {_rounded_sql({'relief': f'CASE WHEN r BETWEEN 3 AND last - 3 AND c BETWEEN 3 AND {WIDTH - 4} AND z IS NOT NULL THEN hi - lo END'})} FROM v, e",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    got = focal.window_features(dem(spark, d, gaps=True), [7]).withColumnRenamed("relief_7", "relief")
    return rounded(focal.edge_masked(got, ["relief"], 7, dem_rows(spark, d), WIDTH), ["relief"])


_SIGMA = 1.2
_GAUSS = f"(VALUES {', '.join(f'({i}, {2.718281828459045 ** (-0.5 * (i / _SIGMA) ** 2)}::DOUBLE)' for i in range(-5, 6))})"


@query(
    "W12_W14_smooth_gauss",
    f"""WITH {SQL['demn']}, e AS (SELECT max(r) AS last_r, max(c) AS last_c FROM dem)
SELECT a.r, a.c, {_rounded_sql({'z': 'sum(y.w * x.w * b.z) / sum(CASE WHEN b.z IS NOT NULL THEN y.w * x.w END)'})}
FROM dem a CROSS JOIN e CROSS JOIN {_GAUSS} y(i, w) CROSS JOIN {_GAUSS} x(i, w)
JOIN dem b ON b.r = least(greatest(a.r + y.i, 0), last_r) AND b.c = least(greatest(a.c + x.i, 0), last_c) GROUP BY a.r, a.c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.smooth_gauss(dem(spark, d, gaps=True), _SIGMA), ["z"])


# --- neighbours ---------------------------------------------------------------------------------------------------


def _around_sql(dist: int, source: str = "demn") -> str:
    """Ends in a(r, c, z, nw, n, ne, w, e, sw, s, se): neighbours at a distance, edge cells repeated."""
    names = {"nw": (-1, -1), "n": (-1, 0), "ne": (-1, 1), "w": (0, -1), "e": (0, 1), "sw": (1, -1), "s": (1, 0), "se": (1, 1)}
    joined = " ".join(
        f"LEFT JOIN dem {n} ON {n}.r = least(greatest(o.r + {dr * dist}, 0), last_r) AND {n}.c = least(greatest(o.c + {dc * dist}, 0), last_c)" for n, (dr, dc) in names.items()
    )
    return f"{SQL[source]}, e AS (SELECT max(r) AS last_r, max(c) AS last_c FROM dem), a AS (SELECT o.r, o.c, o.z, {', '.join(f'{n}.z AS {n}' for n in names)} FROM dem o CROSS JOIN e {joined})"


@query("W10_shift_edge", f"WITH {_around_sql(2)} SELECT r, c, nw, e FROM a")
def _(spark: SparkSession, d: str) -> DataFrame:
    return focal.neighbours(dem(spark, d, gaps=True), 2).select("r", "c", "nw", "e")


_DIRS = ("nw", "n", "ne", "w", "e", "sw", "s", "se")
_TRI = f"CASE WHEN z IS NOT NULL THEN ({' + '.join(f'coalesce(abs({x} - z), 0)' for x in _DIRS)}) / nullif({' + '.join(f'({x} IS NOT NULL)::INT' for x in _DIRS)}, 0) END"


@query(
    "W08_local_tri",
    f"WITH {_around_sql(2)} SELECT r, c, {_rounded_sql({'tri': _TRI})} FROM a",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.tri(dem(spark, d, gaps=True), 2), ["tri"])


_HORN = f"""h AS (SELECT r, c, z, ((ne + 2 * e + se) - (nw + 2 * w + sw)) / {8 * PX} AS gx, ((nw + 2 * n + ne) - (sw + 2 * s + se)) / {8 * PX} AS gy,
  (nw + n + ne + w + e + sw + s + se - 8 * z) / {PX * PX} AS lap FROM a)"""
_ASPECTS = {
    "compass_down": "90.0 - degrees(atan2(-gy, -gx))",
    "compass_up": "90.0 - degrees(atan2(gy, gx))",
    "math_down": "degrees(atan2(-gy, -gx))",
    "math_up_rows": "degrees(atan2(-gy, gx))",
}


def _mod_sql(angle: str) -> str:
    return f"(({angle}) % 360.0 + 360.0) % 360.0"


@query(
    "W15_W16_W19_horn_slope_laplacian",
    f"WITH {_around_sql(1)}, {_HORN} SELECT r, c, {_rounded_sql({'slope': 'CASE WHEN z IS NOT NULL THEN degrees(atan(sqrt(gx * gx + gy * gy))) END', 'laplacian': 'CASE WHEN z IS NOT NULL AND gx IS NOT NULL AND gy IS NOT NULL THEN lap END'})} FROM h",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.horn(dem(spark, d, gaps=True), PX), ["slope", "laplacian"])


for _convention, _angle in _ASPECTS.items():

    def _aspect(spark: SparkSession, d: str, convention: str = _convention) -> DataFrame:
        return rounded(focal.horn(dem(spark, d), PX, convention=convention), ["aspect"], 4)

    query(f"W17_W18_W22_W27_aspect_{_convention}", f"WITH {_around_sql(1, 'dem')}, {_HORN} SELECT r, c, {_rounded_sql({'aspect': _mod_sql(_angle)}, 4)} FROM h")(_aspect)


def _gradient_sql(source: str = "dem", name: str = "g", px: float = PX) -> str:
    """`name`(r, c, z, p, q, rr, ss, tt) of a table by repeated central differences, one-sided at the edges."""

    def diff(value: str, axis: str) -> str:
        fixed, moving = ("r", "c") if axis == "r" else ("c", "r")
        w = f"OVER (PARTITION BY {fixed} ORDER BY {moving} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"
        return f"(last_value({value}) {w} - first_value({value}) {w}) / ((last_value({moving}) {w} - first_value({moving}) {w}) * {px})"

    return f"""{name}1 AS (SELECT *, {diff('z', 'r')} AS p, {diff('z', 'c')} AS q FROM {source}),
{name} AS (SELECT *, {diff('p', 'r')} AS rr, {diff('p', 'c')} AS ss, {diff('q', 'c')} AS tt FROM {name}1)"""


_H = "((1 + q * q) * rr - 2 * p * q * ss + (1 + p * p) * tt) / (2 * pow(1 + p * p + q * q, 1.5))"


@query(
    "W20_W21_W23_W24_gradient_features",
    f"WITH {SQL['dem']}, {_gradient_sql()} SELECT r, c, {_rounded_sql({'slope': 'degrees(atan(sqrt(p * p + q * q)))', 'laplacian': 'rr + tt', 'curvature': _H})} FROM g",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.gradient_features(dem(spark, d), PX), ["slope", "laplacian", "curvature"])


def _distant_sql(dist: int) -> str:
    h = dist * PX
    return f"""{_around_sql(dist)}, g AS (SELECT r, c, z, (e - w) / {2 * h} AS p, (n - s) / {2 * h} AS q, (e - 2 * z + w) / {h * h} AS rr, (n - 2 * z + s) / {h * h} AS tt,
  (ne - nw - se + sw) / {4 * h * h} AS ss FROM a)"""


@query(
    "W25_W26_W28_W29_distant_features",
    f"WITH {_distant_sql(3)} SELECT r, c, {_rounded_sql({'slope': 'degrees(atan(sqrt(p * p + q * q)))', 'laplacian': 'rr + tt', 'curvature': _H})} FROM g",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.distant_features(dem(spark, d, gaps=True), PX, 3), ["slope", "laplacian", "curvature"])


# --- least squares ------------------------------------------------------------------------------------------------


def _quadratic_sql(k: int, zero_fill: bool, source: str) -> str:
    """Ends in g(r, c, z, p, q, rr, ss, tt): moments of the window by a join with its offsets."""
    con = focal.evans_constants(k)
    s2, h, half = con["s2"], PX, k // 2
    value = "coalesce(b.z, 0)" if zero_fill else "b.z"
    whole = "a.z IS NOT NULL" if zero_fill else f"count(b.z) = {k * k}"
    return f"""{SQL[source]}, e AS (SELECT max(r) AS last_r, max(c) AS last_c FROM dem),
o AS (SELECT i, j FROM (SELECT unnest(range({-half}, {half + 1})) AS i), (SELECT unnest(range({-half}, {half + 1})) AS j)),
m AS (SELECT a.r, a.c, a.z, {whole} AS whole, sum({value}) AS m00, sum(j * {value}) AS m10, sum(i * {value}) AS m01, sum(j * j * {value}) AS m20, sum(i * i * {value}) AS m02, sum(i * j * {value}) AS m11
  FROM dem a CROSS JOIN e CROSS JOIN o JOIN dem b ON b.r = least(greatest(a.r + i, 0), last_r) AND b.c = least(greatest(a.c + j, 0), last_c) GROUP BY a.r, a.c, a.z),
g AS (SELECT r, c, CASE WHEN whole THEN m10 / {k * s2 * h} END AS p, CASE WHEN whole THEN -m01 / {k * s2 * h} END AS q, CASE WHEN whole THEN 2 * (m20 - {s2 / k} * m00) / {con['second'] * h * h} END AS rr,
  CASE WHEN whole THEN 2 * (m02 - {s2 / k} * m00) / {con['second'] * h * h} END AS tt, CASE WHEN whole THEN -m11 / {con['cross'] * h * h} END AS ss FROM m)"""


@query(
    "W30_W31_W32_W34_W35_W36_W37_evans_features",
    f"WITH {_quadratic_sql(5, True, 'demn')} SELECT r, c, {_rounded_sql({'slope': 'degrees(atan(sqrt(p * p + q * q)))', 'laplacian': 'rr + tt', 'curvature': _H})} FROM g",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.evans_features(dem(spark, d, gaps=True), PX, 5, zero_fill=True), ["slope", "laplacian", "curvature"])


@query("W33_evans_aspect", f"WITH {_quadratic_sql(5, False, 'dem')} SELECT r, c, {_rounded_sql({'aspect': _mod_sql('90.0 - degrees(atan2(q, p))')}, 4)} FROM g")
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.evans_features(dem(spark, d), PX, 5), ["aspect"], 4)


_FLAT = "(p * p + q * q + 1e-10)"


@query(
    "W38_W39_wood_features",
    f"""WITH {_quadratic_sql(3, False, 'demn')} SELECT r, c, {_rounded_sql({'slope': 'degrees(atan(sqrt(p * p + q * q)))', 'plan': f'-(q * q * rr - 2 * p * q * ss + p * p * tt) / ({_FLAT} * sqrt(1 + p * p + q * q))', 'profile': f'-(p * p * rr + 2 * p * q * ss + q * q * tt) / ({_FLAT} * pow(1 + p * p + q * q, 1.5))', 'curvature': f'-({_H})'})} FROM g""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(focal.wood_features(dem(spark, d, gaps=True), PX, 3), ["slope", "plan", "profile", "curvature"])


# --- openness -----------------------------------------------------------------------------------------------------

_OFFSETS = ", ".join(f"({k}, {dr}, {dc})" for k, dr, dc in tiles.ray_offsets(4, 8))


@query(
    "W41_W42_W43_W44_openness_nearest",
    f"""WITH {SQL['demn']}, o(k, dr, dc) AS (VALUES {_OFFSETS}), t AS (
  SELECT a.r, a.c, k, max((b.z - a.z) / (sqrt(dr * dr + dc * dc) * {PX})) AS up, max((a.z - b.z) / (sqrt(dr * dr + dc * dc) * {PX})) AS down
  FROM dem a CROSS JOIN o JOIN dem b ON b.r = a.r + dr AND b.c = a.c + dc WHERE a.z IS NOT NULL AND b.z IS NOT NULL GROUP BY a.r, a.c, k
), m AS (SELECT r, c, 90 - degrees(avg(atan(up))) AS pos, 90 - degrees(avg(atan(down))) AS neg FROM t GROUP BY r, c)
SELECT dem.r, dem.c, {_rounded_sql({'pos': 'pos', 'neg': 'neg'}, 4)} FROM dem LEFT JOIN m ON m.r = dem.r AND m.c = dem.c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(tiles.openness(dem(spark, d, gaps=True), PX, 4 * PX, 8, method="nearest", size=32), ["pos", "neg"], 4)


def _bilinear_values(radius: int, n_dirs: int) -> str:
    """(ray, step, row and column offset, weight) of the four cells around each point of each ray."""
    rows = []
    for k, (east, north) in enumerate(directions(n_dirs)):
        for s in range(1, radius + 1):
            dr, dc = round(-north * s, 9), round(east * s, 9)
            r0, c0 = math.floor(dr), math.floor(dc)
            wr, wc = -north * s - r0, east * s - c0
            rows += [f"({k}, {s}, {r0 + i}, {c0 + j}, {(wr if i else 1 - wr) * (wc if j else 1 - wc)!r})" for i in (0, 1) for j in (0, 1)]
    return ", ".join(rows)


@query(
    "W40_openness_bilinear",
    f"""WITH {SQL['demn']}, o(k, s, dr, dc, w) AS (VALUES {_bilinear_values(4, 8)}), p AS (
  SELECT a.r, a.c, any_value(a.z) AS z, k, s, sum(w * b.z) AS v FROM dem a CROSS JOIN o JOIN dem b ON b.r = a.r + dr AND b.c = a.c + dc
  WHERE a.z IS NOT NULL AND b.z IS NOT NULL GROUP BY a.r, a.c, k, s HAVING count(*) = 4
), t AS (SELECT r, c, k, max((v - z) / (s * {PX})) AS up, max((z - v) / (s * {PX})) AS down FROM p GROUP BY r, c, k),
m AS (SELECT r, c, 90 - degrees(avg(atan(up))) AS pos, 90 - degrees(avg(atan(down))) AS neg FROM t GROUP BY r, c)
SELECT dem.r, dem.c, {_rounded_sql({'pos': 'pos', 'neg': 'neg'}, 4)} FROM dem LEFT JOIN m ON m.r = dem.r AND m.c = dem.c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(tiles.openness(dem(spark, d, gaps=True), PX, 4 * PX, 8), ["pos", "neg"], 4)


# --- resampling ---------------------------------------------------------------------------------------------------


@query(
    "R01_R03_A32_block_average",
    f"""WITH {SQL['demn']}, e AS (SELECT max(r) + 1 AS rows FROM dem), g AS (SELECT rows, rows // 7 AS nr, (rows - rows // 7 * 7) / 2.0 AS ro FROM e),
x AS (SELECT z, rw * cw AS w, br, bc FROM dem, g,
  LATERAL (SELECT floor((r - ro) / 7)::BIGINT AS br, 0.5 AS rw UNION ALL SELECT floor((r - ro + 0.5) / 7)::BIGINT, 0.5),
  LATERAL (SELECT floor((c - 1.0) / 7)::BIGINT AS bc, 1.0 AS cw) WHERE br BETWEEN 0 AND nr - 1 AND bc BETWEEN 0 AND {WIDTH // 7 - 1})
SELECT br AS r, bc AS c, {_rounded_sql({'z': 'sum(z * w) / nullif(sum(CASE WHEN z IS NOT NULL THEN w END), 0)'})} FROM x GROUP BY br, bc""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(resample.block_average(dem(spark, d, gaps=True), resample.centred(dem_rows(spark, d), WIDTH, 7)), ["z"])


def _shrink_sql(agg: str) -> str:
    return f"WITH {SQL['demn']}, e AS (SELECT max(r) + 1 AS rows FROM dem) SELECT floor((r + 0.5) * (round_even(rows / 3.0, 0) / rows))::BIGINT AS r, floor((c + 0.5) * ({round(WIDTH / 3)} / {float(WIDTH)}))::BIGINT AS c, {_rounded_sql({'z': f'{agg}(z)'})} FROM dem, e GROUP BY 1, 2"


for _method, _agg in (("average", "avg"), ("max", "max"), ("min", "min")):

    def _shrunk(spark: SparkSession, d: str, method: str = _method) -> DataFrame:
        rows = dem_rows(spark, d)
        new = resample.resampled_size(rows, WIDTH, 1.0, 3.0)
        return rounded(resample.shrink(dem(spark, d, gaps=True), rows, WIDTH, *new, method), ["z"])

    query(f"R08_R09_R11_shrink_{_method}", _shrink_sql(_agg))(_shrunk)


_UP = f"""WITH {SQL['demn']}, e AS (SELECT max(r) + 1 AS rows FROM dem), k AS (SELECT floor(r / 4)::BIGINT AS r, floor(c / 4)::BIGINT AS c, avg(z) AS z FROM dem, e WHERE r < rows // 4 * 4 AND c < {WIDTH // 4 * 4} GROUP BY 1, 2),
y AS (SELECT r, c, (r + 0.5) / 4 - 0.5 AS y, (c + 0.5) / 4 - 0.5 AS x, rows // 4 AS nr, {WIDTH // 4} AS nc FROM dem, e),
n AS (SELECT y.r, y.c, least(greatest(floor(y) + i, 0), nr - 1)::BIGINT AS kr, least(greatest(floor(x) + j, 0), nc - 1)::BIGINT AS kc,
  (CASE WHEN i = 0 THEN 1 - (y - floor(y)) ELSE y - floor(y) END) * (CASE WHEN j = 0 THEN 1 - (x - floor(x)) ELSE x - floor(x) END) AS w FROM y, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j))
SELECT n.r, n.c, {_rounded_sql({'z': 'sum(k.z * w) / nullif(sum(CASE WHEN k.z IS NOT NULL THEN w END), 0)'})} FROM n LEFT JOIN k ON k.r = kr AND k.c = kc GROUP BY n.r, n.c"""


@query("R02_R06_grow_bilinear", _UP)
def _(spark: SparkSession, d: str) -> DataFrame:
    cells, rows = dem(spark, d, gaps=True), dem_rows(spark, d)
    g = resample.Coarse(4, rows // 4, WIDTH // 4, 0.0, 0.0)
    return rounded(resample.grow(resample.block_average(cells, g), cells, g.rows, g.cols, 4, 4), ["z"])


@query("R10_grow_nearest", f"""WITH {SQL['dem']}, e AS (SELECT max(r) + 1 AS rows FROM dem) SELECT a.r, a.c, b.z FROM dem a CROSS JOIN e JOIN dem b ON b.r = least(a.r // 2, rows - 1) AND b.c = a.c // 2""")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = dem(spark, d)
    return resample.grow(cells, cells, dem_rows(spark, d), WIDTH, 2, 2, method="nearest").select("r", "c", "z")


_CUBIC = {-1: "0.5 * t * (t * (2 - t) - 1)", 0: "0.5 * (t * t * (3 * t - 5) + 2)", 1: "0.5 * t * ((4 - 3 * t) * t + 1)", 2: "0.5 * t * t * (t - 1)"}
_WEIGHT = lambda i, t: "CASE " + i + " " + " ".join(f"WHEN {k} THEN {x.replace('t', t)}" for k, x in _CUBIC.items()) + " END"


@query(
    "R10_grow_cubic",
    f"""WITH {SQL['demn']}, e AS (SELECT max(r) + 1 AS rows FROM dem), y AS (SELECT r, c, (r + 0.5::DOUBLE) / 2 - 0.5 AS y, (c + 0.5::DOUBLE) / 2 - 0.5 AS x, rows FROM dem, e),
n AS (SELECT y.r, y.c, least(greatest(floor(y) + i, 0), rows - 1)::BIGINT AS kr, least(greatest(floor(x) + j, 0), {WIDTH - 1})::BIGINT AS kc, ({_WEIGHT('i', '(y-floor(y))')}) * ({_WEIGHT('j', '(x-floor(x))')}) AS w
  FROM y, (VALUES (-1), (0), (1), (2)) a(i), (VALUES (-1), (0), (1), (2)) b(j)), s AS (
  SELECT n.r, n.c, sum(k.z * w) AS v, sum(CASE WHEN k.z IS NOT NULL THEN w END) AS w FROM n LEFT JOIN dem k ON k.r = kr AND k.c = kc GROUP BY n.r, n.c)
SELECT r, c, {_rounded_sql({'z': 'CASE WHEN abs(w) > 1e-9 THEN v / w END'}, 4)} FROM s""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = dem(spark, d, gaps=True)
    return rounded(resample.grow(cells, cells, dem_rows(spark, d), WIDTH, 2, 2, method="cubic"), ["z"], 4)


_SIX = {"slope": "degrees(atan(sqrt(p * p + q * q)))", "aspect": _mod_sql("degrees(atan2(q, p))"), "laplacian": "rr + tt", "curvature": _H, "relief": _WINDOW["relief"], "stddev": _WINDOW["stddev"]}
#: Geometry of blocks of four: remainders of both grids are even.
_BLOCKS = f"e AS (SELECT (rows - rows // 4 * 4) / 2.0 AS ro, rows // 4 AS nr, {WIDTH // 4} AS nc FROM (SELECT max(r) + 1 AS rows FROM dem))"


@query(
    "R04_R05_coarse_metrics",
    f"""WITH {_focal_sql(5, 'dem')}, {_BLOCKS}, f AS (SELECT r, c, z, {_WINDOW['relief']} AS relief, {_WINDOW['stddev']} AS stddev FROM v),
b AS (SELECT floor((r - ro) / 4)::BIGINT AS r, floor(c / 4)::BIGINT AS c, avg(z) AS z, avg(relief) AS relief, avg(stddev) AS stddev FROM f, e WHERE floor((r - ro) / 4) BETWEEN 0 AND nr - 1 GROUP BY 1, 2),
{_gradient_sql('b', 'g', 4 * PX)} SELECT r, c, {_rounded_sql({n: x for n, x in _SIX.items() if n in ('slope', 'laplacian', 'curvature')} | {'relief': 'relief', 'stddev': 'stddev'})} FROM g, e WHERE r BETWEEN 1 AND nr - 2 AND c BETWEEN 1 AND nc - 2""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.coarse_metrics(dem(spark, d), dem_rows(spark, d), WIDTH, 4, 5, PX, crop_px=4), ["slope", "laplacian", "curvature", "relief", "stddev"])


def _six_of(source: str, name: str) -> str:
    """`name`(r, c, slope ... stddev) of a table of cells."""
    return f"""{_focal_of(source, 5, name + '_v')}, {_gradient_sql(source, name + '_g')},
{name} AS (SELECT v.r, v.c, {', '.join(f'{x} AS {n}' for n, x in _SIX.items())} FROM {name}_v v JOIN (SELECT r, c, p, q, rr, ss, tt FROM {name}_g) g ON g.r = v.r AND g.c = v.c)"""


_VARIANTS = [f"{m}_{v}" for v in ("rsu", "sm", "res") for m in features.METRICS if m != "aspect"]


@query(
    "R07_W51_M28_scale_variants",
    f"""WITH {SQL['dem']}, {_BLOCKS}, b AS (SELECT floor((r - ro) / 4)::BIGINT AS r, floor(c / 4)::BIGINT AS c, avg(z) AS z FROM dem, e WHERE floor((r - ro) / 4) BETWEEN 0 AND nr - 1 GROUP BY 1, 2),
y AS (SELECT r, c, (r + 0.5 - ro)::DOUBLE / 4 - 0.5 AS y, (c + 0.5)::DOUBLE / 4 - 0.5 AS x, nr, nc FROM dem, e),
n AS (SELECT y.r, y.c, least(greatest(floor(y) + i, 0), nr - 1)::BIGINT AS kr, least(greatest(floor(x) + j, 0), nc - 1)::BIGINT AS kc,
  (CASE WHEN i = 0 THEN 1 - (y - floor(y)) ELSE y - floor(y) END) * (CASE WHEN j = 0 THEN 1 - (x - floor(x)) ELSE x - floor(x) END) AS w FROM y, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)),
up AS (SELECT n.r, n.c, sum(b.z * w) / sum(w) AS z FROM n JOIN b ON b.r = kr AND b.c = kc GROUP BY n.r, n.c),
{_focal_of('dem', 5, 'box')}, sm0 AS (SELECT r, c, s1 / n AS z FROM box), {_six_of('dem', 'own')}, {_six_of('up', 'rsu')}, {_six_of('sm0', 'sm')}
SELECT own.r, own.c, {_rounded_sql({f'{m}_{v}': f'{v}.{m}' if v != 'res' else f'own.{m} - rsu.{m}' for v in ('rsu', 'sm', 'res') for m in features.METRICS if m != 'aspect'}, 3)}
FROM own JOIN rsu ON rsu.r = own.r AND rsu.c = own.c JOIN sm ON sm.r = own.r AND sm.c = own.c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.variants(dem(spark, d), dem_rows(spark, d), WIDTH, 4, 5, PX), _VARIANTS, 3)


@query(
    "W49_W50_residual",
    f"""WITH {_focal_sql(5, 'dem')}, s AS (SELECT r, c, s1 / n AS z FROM v), {_gradient_sql('dem')}, {_gradient_sql('s', 'k')}
SELECT g.r, g.c, {_rounded_sql({'slope': 'degrees(atan(sqrt(g.p * g.p + g.q * g.q))) - degrees(atan(sqrt(k.p * k.p + k.q * k.q)))', 'aspect': _mod_sql('degrees(atan2(g.q, g.p)) - degrees(atan2(k.q, k.p)) + 180.0') + ' - 180.0'}, 4)}
FROM g JOIN k ON k.r = g.r AND k.c = g.c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = dem(spark, d)
    fine, base = focal.gradient_features(cells, PX), focal.gradient_features(focal.smooth_box(cells, 5), PX)
    return rounded(focal.residual(fine, base, ["slope", "aspect"]), ["slope", "aspect"], 4)


@query("W49_angle_difference", f"WITH {SQL['dem']} SELECT r, c, {_rounded_sql({'z': '((z - c * 3.0 + 180.0) % 360.0 + 360.0) % 360.0 - 180.0'}, 4)} FROM dem")
def _(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dem(spark, d).withColumn("z", angles.difference(F.col("z"), F.col("c") * F.lit(3.0))), ["z"], 4)
