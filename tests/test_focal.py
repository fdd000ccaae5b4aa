"""Windows, derivatives and tiles against numpy on small grids with gaps, and surfaces with known answers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orogen.functions import angles
from orogen.operators import focal, resample, tiles

RNG = np.random.default_rng(7)


def frame(spark, z):
    rows = [(int(r), int(c), None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(z)]
    return spark.createDataFrame(rows, "r long, c long, z double")


def grid(df, name, shape):
    out = np.full(shape, np.nan)
    for row in df.select("r", "c", name).collect():
        out[row[0], row[1]] = np.nan if row[2] is None else row[2]
    return out


@pytest.fixture(scope="module")
def holed():
    z = RNG.normal(100, 5, (12, 9))
    z[RNG.random(z.shape) < 0.2] = np.nan
    return z


def windows(z, k):
    d = k // 2
    for r in range(z.shape[0]):
        for c in range(z.shape[1]):
            yield r, c, z[max(0, r - d) : r + d + 1, max(0, c - d) : c + d + 1]


@pytest.mark.parametrize("k", [3, 5])
def test_window_features(spark, holed, k):
    df = focal.window_features(frame(spark, holed), [k]).cache()
    got = {n: grid(df, f"{n}_{k}", holed.shape) for n in ("relief", "stddev", "mean", "tpi", "tri_rms")}
    for r, c, w in windows(holed, k):
        v = w[~np.isnan(w)]
        assert np.isclose(got["mean"][r, c], v.mean(), equal_nan=True)
        if np.isnan(holed[r, c]):
            assert np.isnan(got["relief"][r, c]) and np.isnan(got["stddev"][r, c])
        else:
            assert np.isclose(got["relief"][r, c], v.max() - v.min())
            assert np.isclose(got["stddev"][r, c], v.std(), atol=1e-5)
            assert np.isclose(got["tpi"][r, c], holed[r, c] - v.mean())
            assert np.isclose(got["tri_rms"][r, c] ** 2, got["stddev"][r, c] ** 2 + got["tpi"][r, c] ** 2, atol=1e-6)


@pytest.mark.parametrize("k", [5, 7, 11, 23])
def test_wide_windows_by_doubling(spark, holed, k, monkeypatch):
    short = focal.box_sums(frame(spark, holed), [k]).cache()
    monkeypatch.setattr(focal, "WIDE", 1)
    wide = focal.box_sums(frame(spark, holed), [k])
    assert plan_shuffles(wide) == 2
    wide = wide.cache()
    for n in ("n", "s1", "s2", "hi", "lo"):
        assert np.allclose(grid(short, f"{n}_{k}", holed.shape), grid(wide, f"{n}_{k}", holed.shape), equal_nan=True)


def plan_shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_neighbours_repeat_the_edge(spark, holed):
    df = focal.neighbours(frame(spark, holed), 2).cache()
    padded = np.pad(holed, 2, mode="edge")
    h, w = holed.shape
    for name, dr, dc in (("nw", -2, -2), ("n", -2, 0), ("e", 0, 2), ("se", 2, 2), ("sw", 2, -2)):
        want = padded[2 + dr : 2 + dr + h, 2 + dc : 2 + dc + w]
        assert np.array_equal(grid(df, name, holed.shape), want, equal_nan=True)


def plane(a, b, shape=(7, 8), px=2.0):
    r, c = np.indices(shape)
    return a * c * px - b * r * px + 50


@pytest.mark.parametrize(("a", "b"), [(1.0, 0.0), (0.0, 1.0), (0.3, -0.7)])
def test_planes(spark, a, b):
    df = frame(spark, plane(a, b))
    inner = (slice(2, 5), slice(2, 6))
    steep = np.degrees(np.arctan(np.hypot(a, b)))
    up = (90 - np.degrees(np.arctan2(b, a))) % 360
    for made, convention in ((focal.horn(df, 2.0), "down"), (focal.distant_features(df, 2.0, 2), "up"), (focal.evans_features(df, 2.0, 3), "up"), (focal.wood_features(df, 2.0, 5), "up")):
        made = made.cache()
        assert np.allclose(grid(made, "slope", (7, 8))[inner], steep)
        want = up if convention == "up" else (up + 180) % 360
        assert np.allclose((grid(made, "aspect", (7, 8))[inner] - want + 180) % 360, 180)
        for flat in {"laplacian", "curvature"} & set(made.columns):
            assert np.allclose(grid(made, flat, (7, 8))[inner], 0, atol=1e-9)


def test_gradient_matches_numpy(spark):
    z = RNG.normal(size=(6, 7))
    df = focal.derivatives(frame(spark, z), 3.0).cache()
    q, p = np.gradient(z, 3.0)
    assert np.allclose(grid(df, "p", z.shape), p) and np.allclose(grid(df, "q", z.shape), q)
    assert np.allclose(grid(df, "rr", z.shape), np.gradient(p, 3.0, axis=1))
    assert np.allclose(grid(df, "ss", z.shape), np.gradient(p, 3.0, axis=0))
    assert np.allclose(grid(df, "tt", z.shape), np.gradient(q, 3.0, axis=0))


@pytest.mark.parametrize("k", [3, 5])
def test_quadratic_is_least_squares(spark, k):
    z, px, d = RNG.normal(size=(9, 9)), 2.0, k // 2
    df = focal.quadratic(frame(spark, z), px, k).cache()
    got = {n: grid(df, n, z.shape) for n in ("p", "q", "rr", "ss", "tt")}
    i, j = np.mgrid[-d : d + 1, -d : d + 1]
    x, y = (j * px).ravel(), (-i * px).ravel()
    design = np.stack([x**2, y**2, x * y, x, y, np.ones(k * k)], 1)
    for r in range(d, 9 - d):
        for c in range(d, 9 - d):
            s = np.linalg.lstsq(design, z[r - d : r + d + 1, c - d : c + d + 1].ravel(), rcond=None)[0]
            assert np.allclose([got[n][r, c] for n in ("rr", "tt", "ss", "p", "q")], [2 * s[0], 2 * s[1], s[2], s[3], s[4]])


def test_gauss_is_a_weighted_mean_of_valid_cells(spark, holed):
    sigma = 1.0
    got = grid(focal.smooth_gauss(frame(spark, holed), sigma), "z", holed.shape)
    w = np.exp(-0.5 * (np.arange(-4, 5) / sigma) ** 2)
    padded = np.pad(holed, 4, mode="edge")
    for r in range(holed.shape[0]):
        for c in range(holed.shape[1]):
            part = padded[r : r + 9, c : c + 9]
            ok = ~np.isnan(part)
            weight = np.outer(w, w) * ok
            assert np.isclose(got[r, c], (weight * np.where(ok, part, 0)).sum() / weight.sum())


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_openness(spark, holed, method):
    df = frame(spark, holed)
    whole = tiles.openness(df, 1.0, 3.0, 8, method=method, size=64).cache()
    split = tiles.openness(df, 1.0, 3.0, 8, method=method, size=4).cache()
    for n in ("pos", "neg"):
        assert np.allclose(grid(whole, n, holed.shape), grid(split, n, holed.shape), equal_nan=True)
    turned = tiles.openness(frame(spark, -holed), 1.0, 3.0, 8, method=method)
    assert np.allclose(grid(whole, "pos", holed.shape), grid(turned, "neg", holed.shape), equal_nan=True)
    flat = tiles.openness(frame(spark, np.zeros((8, 8))), 1.0, 2.0, 8, method=method)
    assert np.allclose(grid(flat, "pos", (8, 8))[2:6, 2:6], 90)


def test_block_average_and_back(spark, holed):
    g = resample.centred(12, 9, 3)
    got = grid(resample.block_average(frame(spark, holed), g), "z", (4, 3))
    want = np.array([[np.nanmean(holed[3 * i : 3 * i + 3, 3 * j : 3 * j + 3]) for j in range(3)] for i in range(4)])
    assert np.allclose(got, want)
    odd = resample.centred(12, 9, 2)  # one column is left over: half a cell on either side
    z = np.where(np.isnan(holed), 0, holed)
    got = grid(resample.block_average(frame(spark, z), odd), "z", (6, 4))
    assert np.isclose(got[0, 0], (z[:2, 0] * 0.5 + z[:2, 1] + z[:2, 2] * 0.5).sum() / 4)
    same = resample.grow(frame(spark, z), frame(spark, z), 12, 9, 1, 1, method="cubic")
    assert np.allclose(grid(same, "z", z.shape), z)


def test_mask_residual_and_empty(spark, holed):
    df = focal.window_features(frame(spark, holed), [3])
    masked = grid(focal.edge_masked(df, ["mean_3"], 5, 12, 9), "mean_3", holed.shape)
    assert np.isnan(masked[:2]).all() and np.isnan(masked[:, -2:]).all() and not np.isnan(masked[5, 4])
    a = frame(spark, np.full((2, 2), 350.0)).withColumnRenamed("z", "aspect")
    b = frame(spark, np.full((2, 2), 10.0)).withColumnRenamed("z", "aspect")
    assert np.allclose(grid(focal.residual(a, b, ["aspect"]), "aspect", (2, 2)), -20)
    none = frame(spark, np.zeros((1, 1))).where("false")
    assert focal.window_features(none, [3]).count() == 0 and tiles.openness(none, 1.0, 2.0).count() == 0


def test_azimuths_a_last_bit_from_north(spark):
    """A gradient whose eastward part is rounding noise: one rounding of atan2, as the C library has it, decides between 0 and 360."""
    rows = [(-1.7763568394002505e-15, 3.7225), (-8.881784197001252e-16, 2.1249999999999982), (1.7763568394002505e-15, -4.24625), (0.0, 0.0), (0.0, 2.0), (-3.0, 0.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "e double, n double")
    got = df.select("e", "n", angles.direction(F.col("n"), F.col("e")), angles.aspect(F.col("e"), F.col("n"), "compass_up")).collect()
    for e, n, turn, azimuth in got:
        want = None if e is None else math.atan2(n, e)
        assert turn == want and azimuth == (None if want is None else (90.0 - math.degrees(want)) % 360.0 % 360.0)


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubic"])
def test_growing_beyond_a_sparse_grid(spark, method):
    """Cells that are not there are missing like null ones, edges repeat, and no fine cell becomes several rows."""
    z = RNG.normal(100, 5, (4, 3))
    z[0, 1] = z[2, 2] = np.nan
    coarse = frame(spark, z).where("z is not null").withColumn("k", F.lit("a"))
    fine = frame(spark, np.zeros((12, 10))).withColumn("k", F.lit("a"))
    grown = resample.grow(coarse, fine, 4, 3, 2, 3, 1.5, 0.5, method, ["k"])
    assert "Generate" not in grown._jdf.queryExecution().optimizedPlan().toString()
    got = grid(grown, "z", (12, 10))
    for r in range(12):
        for c in range(10):
            total = value = 0.0
            y, x = (r + 0.5 - 1.5) / 2 - 0.5, (c + 0.5 - 0.5) / 3 - 0.5
            for i, wy in _kernel(method, y):
                for j, wx in _kernel(method, x):
                    v = z[min(max(i, 0), 3), min(max(j, 0), 2)]
                    if not np.isnan(v):
                        total, value = total + wy * wx, value + wy * wx * v
            assert np.isnan(got[r, c]) if abs(total) <= 1e-9 else np.isclose(got[r, c], value / total)


def _kernel(method, at):
    if method == "nearest":
        return [(math.floor(at + 0.5), 1.0)]
    low = math.floor(at)
    t = at - low
    if method == "bilinear":
        return [(low, 1 - t), (low + 1, t)]
    return [(low - 1, 0.5 * t * (t * (2 - t) - 1)), (low, 0.5 * (t * t * (3 * t - 5) + 2)), (low + 1, 0.5 * t * ((4 - 3 * t) * t + 1)), (low + 2, 0.5 * t * t * (t - 1))]
