"""Nearest points, and points within a radius, by pyramids of counted squares.

Squares halve from the points' extent down; each occupied one has its count and one of its points. A square of at most `LEAF` different
points is not divided further. A cell starts with the whole extent and descends one level a round: squares that it holds are
replaced by their occupied quarters, the points known of them bound its distance from above, and squares beyond that bound
are left out. So a cell compares with the points of the few squares that can hold its nearest one, however dense the points are and
however far it lies from them; there are about as many rounds as the logarithm of the points.

Within a radius, squares as wide as the radius are halved where they hold more than `LEAF` points: those beyond the radius are left out, those wholly
inside enter by their counts of each class, and only points of undivided squares on the border are compared one by one. What a
dense spot holds is dealt over its small squares, so no task meets all of it.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orogen.operators.selection import joined
from orogen.sources.storage import kept

#: Different points in a square that is not divided.
LEAF = 32
#: Halvings at most; a square of the last level is not divided, whatever it holds.
DEEPEST = 26


def _halvings(n: int) -> int:
    """Levels for n points, with six more for dense spots than points spread evenly need."""
    return min(DEEPEST, max(1, math.ceil(math.log2(max(n, 2)) / 2)) + 6)


def _apart(value: Column, low: Column, high: Column) -> Column:
    """How far a coordinate is from an interval."""
    return F.greatest(low - value, value - high, F.lit(0.0))


class Pyramid:
    """Squares (level, i, j) over the different places of `points` (x, y, class); of a place the smallest class counts."""

    def __init__(self, points: DataFrame):
        usable = F.col("class").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
        self.places = kept(points.where(usable).groupBy(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).agg(F.min("class").alias("class")))
        self.n, *box = self.places.agg(F.count("*"), F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
        if not self.n:
            return
        self.x0, self.y0 = box[:2]
        self.side = max(box[2] - box[0], box[3] - box[1]) or 1.0
        self.levels = _halvings(self.n)
        most = 2**self.levels
        at = lambda v, low: F.least(F.floor((F.col(v) - low) / self.side * most), F.lit(most - 1))
        deep = self.places.select("x", "y", "class", at("x", self.x0).alias("__i"), at("y", self.y0).alias("__j"))
        every = deep.select("*", F.explode(F.sequence(F.lit(0), F.lit(self.levels))).alias("level"))
        up = lambda c: F.call_function("shiftright", F.col(c), F.lit(self.levels) - F.col("level"))
        every = every.select("level", up("__i").alias("i"), up("__j").alias("j"), "x", "y", "class")
        counted = every.groupBy("level", "i", "j").agg(F.count("*").alias("n"), F.min(F.struct("x", "y")).alias("one"))
        counted = kept(counted.withColumn("whole", (F.col("n") <= LEAF) | (F.col("level") == self.levels)))
        parents = counted.where("not whole").select((F.col("level") + 1).alias("level"), F.col("i").alias("pi"), F.col("j").alias("pj"))
        half = lambda c: F.shiftright(c, 1).alias(f"p{c}")
        quarters = counted.where("level > 0").select("*", half("i"), half("j")).join(parents, ["level", "pi", "pj"], "left_semi")
        root = counted.where("level = 0")
        #: Squares that are not divided, beneath ones that are.
        leaves = quarters.where("whole").select("level", "i", "j").union(root.where("whole").select("level", "i", "j"))
        self.members = kept(every.join(leaves, ["level", "i", "j"], "left_semi"))
        held = F.collect_list(F.struct("i", "j", "whole", "one"))  # four at most
        self.quarters = kept(quarters.groupBy((F.col("level") - 1).alias("level"), F.col("pi").alias("i"), F.col("pj").alias("j")).agg(held.alias("quarters")))
        self.root_is_whole = self.n <= LEAF

    def _distances(self, rows: DataFrame) -> DataFrame:
        """With `near`, the least squared distance that a point of the square may have (a little less, for rounding)."""
        size = F.lit(self.side) / F.pow(F.lit(2.0), F.col("level"))
        slack = self.side * 1e-9
        ends = lambda v, low, k: (F.lit(low) + F.col(k) * size - slack, F.lit(low) + (F.col(k) + 1) * size + slack)
        dx, dy = _apart(F.col("center_x"), *ends("x", self.x0, "i")), _apart(F.col("center_y"), *ends("y", self.y0, "j"))
        return rows.withColumn("near", dx * dx + dy * dy)

    def leaves_of(self, cells: DataFrame) -> DataFrame:
        """(grid_id, center_x, center_y, level, i, j): the undivided squares that can hold a cell's nearest point."""
        zero = F.lit(0).cast("long")
        front = cells.select("grid_id", "center_x", "center_y", F.lit(0).alias("level"), zero.alias("i"), zero.alias("j"), F.lit(self.root_is_whole).alias("whole"), F.lit(float("inf")).alias("bound"))
        front = kept(front)
        names = front.columns
        for _ in range(self.levels):
            open_ = front.where("not whole")
            if open_.isEmpty():
                break
            below = joined(open_.select("grid_id", "center_x", "center_y", "bound", "level", "i", "j"), self.quarters, ["level", "i", "j"])
            below = below.select("grid_id", "center_x", "center_y", "bound", (F.col("level") + 1).alias("level"), F.inline("quarters"))
            seen = F.pow(F.col("center_x") - F.col("one.x"), F.lit(2.0)) + F.pow(F.col("center_y") - F.col("one.y"), F.lit(2.0))
            below = below.withColumn("bound", F.least("bound", seen)).select(*names)
            both = front.where("whole").select(*names).unionByName(below)
            both = both.withColumn("bound", F.min("bound").over(Window.partitionBy("grid_id")))
            front = kept(self._distances(both).where("near <= bound").select(*names))
        return front.select("grid_id", "center_x", "center_y", "level", "i", "j")


def compared(cells: DataFrame, points: DataFrame) -> DataFrame:
    """(grid_id, class, d2) of every point that a cell (grid_id, center_x, center_y) is compared with; its nearest ones are among them."""
    pyramid = Pyramid(points)
    usable = cells.where(F.col("center_x").isNotNull() & F.col("center_y").isNotNull())
    if not pyramid.n:
        return usable.where("false").select("grid_id", F.lit(None).cast(points.schema["class"].dataType).alias("class"), F.lit(0.0).alias("d2"))
    d2 = F.pow(F.col("center_x") - F.col("x"), F.lit(2.0)) + F.pow(F.col("center_y") - F.col("y"), F.lit(2.0))
    return joined(pyramid.leaves_of(usable), pyramid.members, ["level", "i", "j"]).select("grid_id", "class", d2.alias("d2"))


def nearest_class(cells: DataFrame, points: DataFrame) -> DataFrame:
    """(grid_id, class, dist_to_point, n_points) of the nearest point with a class (ties: the smallest class); nulls if there is none."""
    best = compared(cells, points).groupBy("grid_id").agg(F.min(F.struct("d2", "class")).alias("m"))
    found = best.select("grid_id", F.col("m.class").alias("class"), F.sqrt("m.d2").alias("dist_to_point"), F.lit(1).cast("long").alias("n_points"))
    return cells.select("grid_id").join(found, "grid_id", "left")


# --- within a radius ----------------------------------------------------------------------------------------------

#: Halvings of a square as wide as the radius, at most.
FINEST = 10


def within(cells: DataFrame, points: DataFrame, radius: float, summed: bool) -> DataFrame:
    """(grid_id, class, n, d2): what lies within the radius of each cell (grid_id, center_x, center_y), borders included.

    Points at one place with one class are one row with their number n. With `summed`, squares wholly inside are one row for each class, without d2.
    """
    known = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    spots = kept(points.where(known).groupBy(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "class").agg(F.count("*").alias("n")))
    size = F.lit(float(radius)) / F.pow(F.lit(2.0), F.col("level"))
    # numbers of halves of halves, so that a quarter's number is always twice its square's or one more
    deep = float(radius) / 2**FINEST
    at = spots.select("*", F.floor(F.col("x") / deep).alias("__i"), F.floor(F.col("y") / deep).alias("__j"), F.explode(F.sequence(F.lit(0), F.lit(FINEST))).alias("level"))
    up = lambda c: F.call_function("shiftright", F.col(c), F.lit(FINEST) - F.col("level"))
    every = at.select("level", up("__i").alias("i"), up("__j").alias("j"), "x", "y", "class", "n")
    squares = kept(every.groupBy("level", "i", "j").agg(F.sum("n").alias("total"), F.count("*").alias("spots")).withColumn("whole", (F.col("spots") <= LEAF) | (F.col("level") == FINEST)))
    half = lambda c: F.shiftright(c, 1).alias(f"p{c}")
    parents = squares.where("not whole").select((F.col("level") + 1).alias("level"), F.col("i").alias("pi"), F.col("j").alias("pj"))
    beneath = kept(squares.where("level > 0").select("*", half("i"), half("j")).join(parents, ["level", "pi", "pj"], "left_semi"))
    quarters = kept(beneath.groupBy((F.col("level") - 1).alias("level"), F.col("pi").alias("i"), F.col("pj").alias("j")).agg(F.collect_list(F.struct("i", "j", "whole")).alias("quarters")))
    leaves = beneath.where("whole").select("level", "i", "j").union(squares.where("level = 0 and whole").select("level", "i", "j"))

    usable = cells.where(F.col("center_x").isNotNull() & F.col("center_y").isNotNull()).select("grid_id", F.col("center_x").cast("double").alias("center_x"), F.col("center_y").cast("double").alias("center_y"))
    near = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    top = lambda c: F.shiftright(F.floor(F.col(c) / deep), FINEST)
    around = usable.select("*", F.explode(near).alias("di")).select("*", F.explode(near).alias("dj"))
    front = around.select("grid_id", "center_x", "center_y", F.lit(0).alias("level"), (top("center_x") + F.col("di")).alias("i"), (top("center_y") + F.col("dj")).alias("j"))
    front = kept(joined(front, squares.where("level = 0").select("level", "i", "j", "whole"), ["level", "i", "j"]))
    r2, slack = float(radius) ** 2, 1e-9
    low = {c: F.col(k) * size for c, k in (("x", "i"), ("y", "j"))}
    gap = {c: _apart(F.col(f"center_{c}"), low[c], low[c] + size) for c in "xy"}
    most = {c: F.greatest(F.abs(F.col(f"center_{c}") - low[c]), F.abs(low[c] + size - F.col(f"center_{c}"))) for c in "xy"}
    beyond = gap["x"] * gap["x"] + gap["y"] * gap["y"] > r2 * (1 + slack)
    inside = most["x"] * most["x"] + most["y"] * most["y"] < r2 * (1 - slack)
    names, taken, single = front.columns, [], []
    for _ in range(FINEST + 1):
        left = front.where(~beyond)
        if summed:
            taken.append(left.where(inside))
            left = left.where(~inside)
        single.append(left.where("whole"))
        open_ = left.where("not whole")
        if open_.isEmpty():
            break
        below = joined(open_.drop("whole"), quarters, ["level", "i", "j"])
        front = kept(below.select("grid_id", "center_x", "center_y", (F.col("level") + 1).alias("level"), F.inline("quarters")).select(*names))
    d2 = F.pow(F.col("center_x") - F.col("x"), F.lit(2.0)) + F.pow(F.col("center_y") - F.col("y"), F.lit(2.0))
    members = kept(every.join(leaves, ["level", "i", "j"], "left_semi"))
    found = joined(reduce(DataFrame.unionByName, single), members, ["level", "i", "j"]).select("grid_id", "class", "n", d2.alias("d2")).where(F.col("d2") <= r2)
    if summed:
        counts = kept(every.groupBy("level", "i", "j", "class").agg(F.sum("n").alias("n")))
        whole = joined(reduce(DataFrame.unionByName, taken), counts, ["level", "i", "j"])
        found = found.unionByName(whole.select("grid_id", "class", "n", F.lit(None).cast("double").alias("d2")))
    return found


def majority_class(cells: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """(grid_id, class, n_points): the class of most points within the radius (ties: the smallest); none: null and 0."""
    counts = within(cells, points.where("class is not null"), radius, summed=True).groupBy("grid_id", "class").agg(F.sum("n").alias("k"))
    won = counts.groupBy("grid_id").agg(F.min(F.struct((-F.col("k")).alias("k"), "class")).alias("m"), F.sum("k").alias("n"))
    won = won.select("grid_id", F.col("m.class").alias("class"), F.col("n").alias("n_points"))
    return cells.select("grid_id").join(won, "grid_id", "left").withColumn("n_points", F.coalesce("n_points", F.lit(0)).cast("long"))


def weighted_class(cells: DataFrame, points: DataFrame, radius: float, power: float = 2.0, eps: float = 1e-6) -> DataFrame:
    """(grid_id, class, class_conf, n_points): the class of most weight 1 / (d**power + eps) and its share; n_points counts all."""
    pairs = within(cells, points, radius, summed=False).withColumn("w", F.col("n") / (F.pow(F.sqrt("d2"), F.lit(power)) + F.lit(eps)))
    sums = pairs.groupBy("grid_id", "class").agg(F.sum("w").alias("w"), F.sum("n").alias("k"))
    known = F.col("class").isNotNull()
    won = sums.groupBy("grid_id").agg(
        F.min(F.when(known, F.struct((-F.col("w")).alias("w"), "class"))).alias("m"), F.sum(F.when(known, F.col("w"))).alias("t"), F.sum("k").alias("n")
    )
    won = won.select("grid_id", F.col("m.class").alias("class"), (-F.col("m.w") / F.col("t")).alias("class_conf"), F.col("n").alias("n_points"))
    return cells.select("grid_id").join(won, "grid_id", "left").withColumn("n_points", F.coalesce("n_points", F.lit(0)).cast("long"))
