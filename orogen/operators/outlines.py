"""United polygons of grid cells, by class.

Each cell has four directed sides with its inside to the left. Sides that two cells of a class share run both ways and cancel; what is left
is the outline. Runs along a line are joined into segments, and each segment is followed by the one that starts where it ends.
Where two cells touch at a corner alone, four segments meet: a ring turns left there, so the cells stay apart, unless that
would lead one ring twice through the corner; then it turns right, which cuts the ring in two. So every ring is simple.

Rings are found in two steps. In each tile of `TILE` x `TILE` corners, segments find the ones that start at their ends and become chains; a ring
within one tile is done there, cut in two where it has to be. A segment that ends in another tile is sent there too, to learn what follows it. Chains of
different tiles, some hundredth of all segments, are joined by pointer doubling: each round a chain learns of twice
as many followers, and with the smallest number among them its ring's name and its place in it. Rounds grow with the logarithm of the longest
ring. Only those of these rings that lead twice through a corner are followed again, with the other turn there. A side is shuffled once, its segment twice.
No task or window holds more than a line of the raster, no group more than a tile; only `polygons`, whose rows are whole polygons, gathers what belongs together.

Cells without a class are left out, repeated cells count once in the outline; an empty grid gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orogen.operators.stats import numbered
from orogen.sources.storage import written

#: Directions in quarter turns: east, north, west, south. A turn to the left adds one.
_DX, _DY = (1, 0, -1, 0), (0, 1, 0, -1)
#: Corners along a side of the squares in which segments are chained.
TILE = 128


def outline(cells: DataFrame, column: str) -> DataFrame:
    """(class, x, y, d, upright, line, along): the unit sides between cells (class, i, j) of a class and anything else, from (x, y) in direction d.

    `upright` and `line` tell the line of the raster that a side lies in, `along` rises on it in direction d; rows are dealt out by class and line.
    """
    known = cells.where(F.col(column).isNotNull()).select(F.col(column).alias("class"), F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"))
    # a side is named by its lower left end, whichever way it runs
    named = ((0, F.col("j"), F.col("i")), (1, F.col("i") + 1, F.col("j")), (0, F.col("j") + 1, F.col("i")), (1, F.col("i"), F.col("j")))
    ways = F.array(*[F.struct(F.lit(upright).alias("upright"), line.alias("line"), at.alias("at"), F.lit(d).alias("d")) for d, (upright, line, at) in enumerate(named)])
    sides = known.select("class", F.inline(ways)).repartition("class", "upright", "line")
    # repeated cells give one way only, two cells that share the side give both
    single = sides.groupBy("class", "upright", "line", "at").agg(F.min("d").alias("d"), F.max("d").alias("other")).where("d = other")
    begin = F.col("at") + (F.col("d") >= 2).cast("long")
    return single.select(
        "class",
        F.when(F.col("upright") == 1, F.col("line")).otherwise(begin).alias("x"),
        F.when(F.col("upright") == 1, begin).otherwise(F.col("line")).alias("y"),
        "d",
        "upright",
        "line",
        F.when(F.col("d") < 2, begin).otherwise(-begin).alias("along"),
    )


def _ahead(x: Column, steps: tuple[int, ...], d: Column, by: Column | int = 1) -> Column:
    return x + F.element_at(F.array(*[F.lit(s) for s in steps]), d + 1) * by


def segments(sides: DataFrame) -> DataFrame:
    """(class, d, x, y, length): maximal straight runs of `outline`. A corner ends each, also where four of them meet."""
    gap = F.col("along") - F.row_number().over(Window.partitionBy("class", "upright", "line", "d").orderBy("along"))
    runs = sides.withColumn("run", gap).groupBy("class", "upright", "line", "d", "run")
    got = runs.agg(F.min(F.struct("along", "x", "y")).alias("first"), F.count("*").alias("length"))
    return got.select("class", "d", F.col("first.x").alias("x"), F.col("first.y").alias("y"), "length")


def _end(c: str, steps: tuple[int, ...]) -> Column:
    return _ahead(F.col(c), steps, F.col("d"), F.col("length"))


_CHAINED = (
    ("here", T.BooleanType()),
    ("next", T.LongType()),
    ("crossed", T.BooleanType()),
    ("last", T.LongType()),
    ("left", T.LongType()),
    ("low", T.LongType()),
    ("ahead", T.LongType()),
    ("first", T.BooleanType()),
)


def _doubled(ids: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, ...]:
    """(the last row on the way from each, steps to it, the smallest id up to it, steps to that) where `to` is the row itself at an end."""
    left, low, ahead = (to != np.arange(len(ids))).astype("int64"), ids, np.zeros(len(ids), "int64")
    for _ in range(len(ids).bit_length()):
        ahead = np.where(low <= low[to], ahead, left + ahead[to])
        low, left, to = np.minimum(low, low[to]), left + left[to], to[to]
    return to, left, low, ahead


def _chained(rows: pa.Table, tile: int, apart: bool) -> pa.Table:
    """Segments that start or end in a tile. `here`: it starts here; next: of those that do not, the segment after it; `crossed`: two start at its end.

    For those that start here, the way to where it leaves the tile: the last segment in it (null: the way comes back), steps to the last (left),
    the smallest id up to it (low) and steps to that (ahead), and whether it begins here (first). With `apart`, rings of this
    tile that lead twice through a corner are cut in two there.
    """
    ids, x, y, d, length, right, tx, ty = (rows[c].to_numpy() for c in ("id", "x", "y", "d", "length", "right", "tx", "ty"))
    x, y = x - tx * tile, y - ty * tile
    ex, ey = x + np.array(_DX)[d] * length, y + np.array(_DY)[d] * length
    here, ends = ((0 <= u) & (u < tile) & (0 <= v) & (v < tile) for u, v in ((x, y), (ex, ey)))
    begin, end = x * tile + y, ex * tile + ey
    own = np.flatnonzero(here)
    own = own[np.argsort(begin[own], kind="stable")]
    low, high = (np.searchsorted(begin[own], end, side) for side in ("left", "right"))
    crossed = ends & (high - low == 2)
    one, two = own[np.minimum(low, len(own) - 1)], own[np.maximum(high - 1, 0)]
    turned = crossed & (d[two] == (d + np.where(right, 3, 1)) % 4)
    following, other = np.where(turned, two, one), np.where(turned, one, two)
    goes, rank = here & ends, np.arange(len(ids))
    to, left, low, ahead = _doubled(ids, np.where(goes, following, rank))
    if apart:
        met = np.flatnonzero(crossed & here & goes[to])
        met = met[np.lexsort((end[met], low[met]))]
        twice = np.flatnonzero((low[met[1:]] == low[met[:-1]]) & (end[met[1:]] == end[met[:-1]]))
        if len(twice):
            met = met[np.concatenate([twice, twice + 1])]
            following[met] = other[met]
            to, left, low, ahead = _doubled(ids, np.where(goes, following, rank))
    first = here.copy()
    first[following[goes]] = False
    made = (here, pa.array(ids[following], mask=here), crossed, pa.array(ids[to], mask=goes[to]), left, low, ahead, first)
    for (name, _), values in zip(_CHAINED, made, strict=True):
        rows = rows.append_column(name, pa.array(values))
    return rows.select(["class", "d", "x", "y", "length", "id", *[n for n, _ in _CHAINED]])


def _joined(chains: DataFrame) -> DataFrame:
    """(id, ring, ahead): the smallest id `low` of each cycle of (id, to, low, ahead, steps), and steps from id to it.

    A row knows the smallest id before `to`, and how many steps ahead it first comes. A row that hears
    the same smallest id again from `to` has been all round; a row whose `to` is done is done as well.
    """
    state = written(chains.withColumn("done", F.lit(False)))
    while not state.where("not done").isEmpty():
        seen = state.select(F.col("id").alias("to"), F.col("to").alias("then"), F.col("low").alias("their_low"), F.col("ahead").alias("their_ahead"), F.col("steps").alias("their_steps"), F.col("done").alias("they_are_done"))
        new = state.where("not done").join(seen, "to").select(
            "id",
            F.col("then").alias("to"),
            F.least("low", "their_low").alias("low"),
            F.when(F.col("low") <= F.col("their_low"), F.col("ahead")).otherwise(F.col("steps") + F.col("their_ahead")).alias("ahead"),
            (F.col("steps") + F.col("their_steps")).alias("steps"),
            ((F.col("low") == F.col("their_low")) | F.col("they_are_done")).alias("done"),
        )
        state = written(state.where("done").unionByName(new).repartition("id"))  # a union alone would add up partitions
    return state.select("id", F.col("low").alias("ring"), "ahead")


def _followed(runs: DataFrame, apart: bool) -> tuple[DataFrame, DataFrame]:
    """Segments (class, d, x, y, length, id, right: of two that start at its end the right one follows, not the left one) of rings within a tile and of others,
    each with ring, the smallest id of its ring, and place, which rises along it up to 0 at that id; the others with `crossed`, true where two may start at the end."""
    size, kept = TILE, ["class", "d", "x", "y", "length", "id"]
    tile = lambda x, y: F.struct(F.floor(x / size).alias("tx"), F.floor(y / size).alias("ty"))
    both = F.array_distinct(F.array(tile(F.col("x"), F.col("y")), tile(_end("x", _DX), _end("y", _DY))))
    schema = T.StructType([*[runs.schema[c] for c in kept], *[T.StructField(n, kind) for n, kind in _CHAINED]])
    dealt = runs.select(*kept, "right", F.explode(both).alias("tile")).select(*kept, "right", "tile.*")
    found = written(dealt.groupBy("class", "tx", "ty").applyInArrow(lambda rows: _chained(rows, size, apart), schema))
    own = found.where("here")
    within = own.where("last is null").select(*kept, F.col("low").alias("ring"), (-F.col("ahead")).alias("place"))
    across = own.where("last is not null")
    chains = across.where("first").select("id", "low", "ahead", (F.col("left") + 1).alias("steps"), "last")
    chains = chains.join(found.where("not here").select(F.col("id").alias("last"), F.col("next").alias("to")), "last")
    joined = _joined(chains.select("id", "to", "low", "ahead", "steps")).join(chains.select("id", "last", F.col("steps").alias("size")), "id")
    known = joined.join(joined.groupBy("ring").agg(F.sum("size").alias("around")), "ring").select("last", "ring", F.col("ahead").alias("begin"), "size", "around")
    step = F.col("begin") - (F.col("size") - 1 - F.col("left"))
    placed = across.join(known, "last").select(*kept, "ring", (-F.pmod(step, "around")).alias("place"), (F.col("crossed") | (F.col("id") == F.col("last"))).alias("crossed"))
    return within, placed


def rings(cells: DataFrame, column: str) -> DataFrame:
    """(class, ring, place, x, y, d, length): the corners of all simple rings of cells (class, i, j), outer ones leftwards, holes rightwards.

    Places rise along a ring and end at 0; d and length lead from a corner to the next one.
    """
    runs = numbered(written(segments(outline(cells, column))), ["class", "y", "x", "d"])
    within, across = _followed(runs.withColumn("right", F.lit(False)), True)
    across = written(across)
    corner = {"ex": _end("x", _DX), "ey": _end("y", _DY)}
    twice = across.where("crossed").withColumns(corner).groupBy("class", "ring", "ex", "ey").agg(F.count("*").alias("n")).where("n = 2")
    twice = written(twice.select("class", "ring", "ex", "ey", F.lit(True).alias("right")))
    cut = twice.select("ring").distinct()
    again = across.join(cut, "ring", "left_semi").withColumns(corner).join(twice.drop("ring"), ["class", "ex", "ey"], "left").withColumn("right", F.coalesce("right", F.lit(False)))
    parts = [within, across.join(cut, "ring", "left_anti"), *_followed(again, False)]
    columns = ["class", "ring", "place", "x", "y", "d", "length"]
    done, *more = [p.select(columns) for p in parts]
    for part in more:
        done = done.unionByName(part)
    return written(done)


def ring_measures(corners: DataFrame) -> DataFrame:
    """(class, ring, corners, length, area): cells inside a ring, negative for a hole."""
    dx = lambda c, steps: F.element_at(F.array(*[F.lit(s) for s in steps]), F.col(c) + 1)
    swept = F.col("x") * dx("d", _DY) * F.col("length")  # the integral of x dy
    return corners.groupBy("class", "ring").agg(F.count("*").alias("corners"), F.sum("length").alias("length"), F.sum(swept).alias("area"))


def holders(corners: DataFrame) -> DataFrame:
    """(class, ring, polygon): the outer ring around each ring; an outer ring is its own.

    West of a hole's leftmost side lies a run of cells; the ring at the run's other end is further left and belongs to the
    same polygon. From hole to hole this ends at the outer ring, by pointer doubling.
    """
    upright = corners.where("d % 2 = 1")
    low = F.when(F.col("d") == 1, F.col("y")).otherwise(F.col("y") - F.col("length"))
    units = upright.select("class", "ring", "x", "d", F.explode(F.sequence(low, low + F.col("length") - 1)).alias("row"))
    line = Window.partitionBy("class", "row").orderBy("x", F.col("d").desc())
    known = units.select("class", "ring", "x", "row", F.lag("ring").over(line).alias("before"))
    leftmost = known.groupBy("class", "ring").agg(F.min_by("before", F.struct("x", "row")).alias("before"))
    own = ring_measures(corners).select("class", "ring", (F.col("area") > 0).alias("outer")).join(leftmost, ["class", "ring"])
    state = written(own.select("class", "ring", F.when(F.col("outer"), F.col("ring")).otherwise(F.col("before")).alias("polygon"), "outer"))
    while not state.where("not outer").isEmpty():
        above = state.select(F.col("ring").alias("polygon"), F.col("polygon").alias("then"), F.col("outer").alias("ends"))
        moved = state.where("not outer").join(above, "polygon").select("class", "ring", F.col("then").alias("polygon"), F.col("ends").alias("outer"))
        state = written(state.where("outer").unionByName(moved).repartition("ring"))
    return state.select("class", "ring", "polygon")


def summary(corners: DataFrame) -> DataFrame:
    """(class, polygons, holes, corners, outline, area), in cells."""
    got = ring_measures(corners)
    count = lambda test: F.count_if(test)
    return got.groupBy("class").agg(
        count(F.col("area") > 0).alias("polygons"), count(F.col("area") < 0).alias("holes"), F.sum("corners").alias("corners"), F.sum("length").alias("outline"), F.sum("area").alias("area")
    )


def polygons(corners: DataFrame, size: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """(class, polygon, n_cells, area, rings): rings are closed arrays of (x, y) in map units, the outer one first, as `in_polygons` takes them."""
    at = F.struct((F.lit(x0) + F.col("x") * F.lit(size)).alias("x"), (F.lit(y0) + F.col("y") * F.lit(size)).alias("y"))
    placed = F.array_sort(F.collect_list(F.struct("place", at.alias("at"))))
    made = corners.groupBy("class", "ring").agg(F.transform(placed, lambda p: p["at"]).alias("open")).join(ring_measures(corners), ["class", "ring"]).join(holders(corners), ["class", "ring"])
    closed = made.withColumn("line", F.concat("open", F.slice("open", 1, 1)))
    held = F.array_sort(F.collect_list(F.struct((F.col("area") < 0).alias("hole"), "ring", "line")))
    got = closed.groupBy("class", "polygon").agg(F.sum("area").alias("n_cells"), F.transform(held, lambda r: r["line"]).alias("rings"))
    return got.select("class", "polygon", "n_cells", (F.col("n_cells") * F.lit(size * size)).alias("area"), "rings")


def united(grid: DataFrame, column: str, size: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """Per class of a grid with xmin, ymin (as `joins.fishnet` makes it): n_points, n_cells and its polygons, an array of arrays of rings."""
    cells = grid.where(F.col(column).isNotNull())
    place = lambda c, zero: F.round((F.col(c) - F.lit(zero)) / F.lit(size)).cast("long")
    corners = rings(cells.select(F.col(column), place("xmin", x0).alias("i"), place("ymin", y0).alias("j")), column)
    shapes = polygons(corners, size, x0, y0).groupBy("class").agg(F.transform(F.array_sort(F.collect_list(F.struct("polygon", "rings"))), lambda p: p["rings"]).alias("polygons"))
    n_points = F.sum("n_points") if "n_points" in grid.columns else F.count("*")
    counted = cells.groupBy(F.col(column).alias("class")).agg(n_points.alias("n_points"), F.count("*").alias("n_cells"))
    return counted.join(shapes, "class").withColumnRenamed("class", column)
