"""United polygons against flood fills and crossing numbers."""

import random

import pytest
from pyspark.sql import functions as F

from orogen.operators import joins, outlines


def components(cells):
    """{cell: number of its component}, cells meeting at sides."""
    at, n = {}, 0
    for start in sorted(cells):
        if start in at:
            continue
        n, todo = n + 1, [start]
        while todo:
            i, j = todo.pop()
            if (i, j) in cells and (i, j) not in at:
                at[i, j] = n
                todo += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
    return at


def inside(x, y, rings):
    crossings = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            crossings += (ay > y) != (by > y) and x < ax
    return crossings % 2 == 1


def area(ring):
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False)) / 2


def check(spark, classes):
    rows = [(i, j, c) for (i, j), c in classes.items()]
    corners = outlines.rings(spark.createDataFrame(rows, "i long, j long, class string"), "class")
    got = [(r["class"], r["n_cells"], [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]]) for r in outlines.polygons(corners, 1.0).collect()]
    for c in {c for c in classes.values() if c is not None}:
        cells = {k for k, v in classes.items() if v == c}
        comps = components(cells)
        mine = [(n, rings) for k, n, rings in got if k == c]
        assert len(mine) == len(set(comps.values()))
        for n, rings in mine:
            outer, *holes = rings
            assert area(outer) > 0 and all(area(h) < 0 for h in holes)
            for ring in rings:
                assert ring[0] == ring[-1] and len(set(ring)) == len(ring) - 1  # simple: no corner twice
                assert all((a[0] == b[0]) != (b[0] == d[0]) for a, b, d in zip(ring, ring[1:], [*ring[2:], ring[1]], strict=False))  # corners only
            held = {k for k in classes if inside(k[0] + 0.5, k[1] + 0.5, rings)}
            assert held and held == {k for k in cells if comps[k] == comps[next(iter(held))]} and n == len(held)


@pytest.mark.parametrize(("seed", "share"), [(1, 0.5), (2, 0.65), (3, 0.8)])
def test_random_grids(spark, seed, share):
    r = random.Random(seed)
    check(spark, {(i, j): "a" if r.random() < share else r.choice(["b", "b", None]) for i in range(-6, 12) for j in range(15)})


def drawn(*lines):
    return {(i, -j): c for j, line in enumerate(lines) for i, c in enumerate(line) if c != " "}


@pytest.mark.parametrize(
    "picture",
    [
        ("a",),
        ("a a", " a ", "a a"),  # corners only
        ("aaa", "a a", "aa "),  # a hole that touches the outside at a corner
        ("aaaa", "a aa", "aa a", "aaaa"),  # two holes that touch
        ("aaaaaaa", "a     a", "a aaa a", "a a a a", "a aaa a", "a     a", "aaaaaaa"),  # an island with a hole in a hole
        ("aaaaaaaaa", "a a a a a", "aaaaaaaaa", "aa a a aa", "aaaaaaaaa"),  # holes west of holes
    ],
)
def test_pictures(spark, picture):
    check(spark, drawn(*picture))


def test_long_spiral_ends_and_repeats_count_once(spark):
    """One ring of some thousand corners: rounds grow with the logarithm."""
    comb = [(i, j) for i in range(0, 601, 2) for j in range(4)] + [(i, 0) for i in range(601)]
    corners = outlines.rings(spark.createDataFrame([(*c, "a") for c in comb * 2], "i long, j long, class string"), "class")
    assert [tuple(r) for r in outlines.summary(corners).collect()] == [("a", 1, 0, 1204, 2 * 601 + 2 * 4 + 300 * 2 * 3, len(set(comb)))]


def test_nothing_and_no_class(spark):
    none = spark.createDataFrame([(0, 0, None)], "i long, j long, class string")
    assert outlines.rings(none, "class").collect() == [] and outlines.polygons(outlines.rings(none, "class"), 1.0).collect() == []


def test_united_grid_finds_points(spark):
    grid = joins.fishnet(spark, (10.0, 20.0, 40.0, 44.0), 3.0)
    grid = grid.withColumn("kind", F.when(F.col("grid_id") % 7 != 0, F.col("grid_id") % 2)).withColumn("n_points", F.lit(2)).withColumn("x", F.lit("clash"))
    got = outlines.united(grid, "kind", 3.0, 10.0, 20.0)
    totals = {r["kind"]: (r["n_points"], r["n_cells"]) for r in got.collect()}
    assert totals == {r["kind"]: (2 * r["n"], r["n"]) for r in grid.where("kind is not null").groupBy("kind").agg(F.count("*").alias("n")).collect()}
    shapes = got.select("kind", F.flatten("polygons").alias("rings"))
    points = grid.select(F.col("grid_id").alias("pid"), F.col("center_x").alias("x"), F.col("center_y").alias("y"), F.col("kind").alias("own"))
    pairs = joins.in_polygons(points, shapes, 10.0, "pid").select("pid", "kind").collect()
    assert sorted(map(tuple, pairs)) == sorted(map(tuple, grid.where("kind is not null").select("grid_id", "kind").collect()))


@pytest.mark.parametrize(("seed", "tile"), [(4, 3), (5, 8)])
def test_rings_across_tiles(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(outlines, "TILE", tile)
    test_random_grids(spark, seed, 0.6)


def test_rounds_do_not_write_all_segments(spark, monkeypatch):
    """A long ring takes rounds; its segments are written a fixed number of times, and only chains of them again in each round."""
    rows, kept = [], outlines.written
    monkeypatch.setattr(outlines, "written", lambda df: rows.append((made := kept(df)).count()) or made)
    comb = [(i, j) for i in range(0, 1201, 2) for j in range(4)] + [(i, 0) for i in range(1201)]
    corners = outlines.rings(spark.createDataFrame([(*c, "a") for c in comb], "i long, j long, class string"), "class")
    assert corners.count() == 2404 and sum(rows) < 5 * 2404


def test_sides_are_shuffled_once(spark):
    """One shuffle from cells to segments; repeated cells need none of their own."""
    cells = spark.createDataFrame([(i, j, "a") for i in range(9) for j in range(7)] * 2, "i long, j long, class string")
    runs = outlines.segments(outlines.outline(cells, "class"))
    assert sorted((r["x"], r["y"], r["d"], r["length"]) for r in runs.collect()) == [(0, 0, 0, 9), (0, 7, 3, 7), (9, 0, 1, 7), (9, 7, 2, 9)]
    plan = runs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("tile", [128, 5])
def test_rings_cut_in_two_are_the_only_ones_followed_again(spark, monkeypatch, tile):
    """Two holes that touch, beside 300 single cells: of all segments only those of rings across tiles are written again."""
    monkeypatch.setattr(outlines, "TILE", tile)
    lines = ["aaaaaaaa", "aaa aaaa", "aaaa aaa", "aaaaaaaa"]
    cells = [(i, j, "a") for j, line in enumerate(lines) for i, c in enumerate(line) if c != " "] + [(2 * k, 10 + 5 * (k % 3), "b") for k in range(300)]
    rows, kept = [], outlines.written
    monkeypatch.setattr(outlines, "written", lambda df: rows.append((made := kept(df)).count()) or made)
    corners = outlines.rings(spark.createDataFrame(cells, "i long, j long, class string"), "class")
    got = [tuple(r) for r in outlines.summary(corners).orderBy("class").collect()]
    assert got == [("a", 1, 2, 12, 24 + 8, 30), ("b", 300, 0, 1200, 1200, 300)]
    assert sum(rows) < (3.2 if tile == 128 else 5) * 1212
