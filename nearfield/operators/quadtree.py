"""The spatial tree under the search: an adaptive quadtree over index rows, one leaf per point.

A cell of level l is 1/2^l of the longitudes by 1/2^l of the latitudes. The tree is a forest whose roots are the cells of
``LEVELS[0]``, which are those of the first four geohash characters; a cell with more than ``LEAF_POINTS`` points is divided into
the 16 cells two levels deeper, down to ``LEVELS[-1]`` (about 19 by 30 metres at 37 degrees north). So every point lies in
exactly one leaf, and what lies below a root depends on the points of that geohash prefix alone: a stored index renews the
trees of the prefixes that a change touches, and no others.

Counts are rolled up level by level, each from the one below, so the shuffles shrink on the way up.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions import geo
from nearfield.operators.discs import Cells
from nearfield.session import Scratch

LEVELS = tuple(range(10, 21, 2))
ROOT, DEEPEST = LEVELS[0], LEVELS[-1]
LEAF_POINTS = 64
# Points that a task holds at once to answer searches; see ``Tree.tiles``.
TILE_POINTS = 1 << 16
CELL = ["level", "x", "y"]


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later expressions refer to by value: through a one-row generator, so that Catalyst neither repeats their
    expressions in each use nor moves filters on them below the joins, where they would be worked out twice."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def deep_cells(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Adds _x, _y: the point's cell at the deepest level."""
    return staged(df, _x=geo.axis_cell(F.col(lon), -180.0, 360.0, DEEPEST), _y=geo.axis_cell(F.col(lat), -90.0, 180.0, DEEPEST))


def _up(column: str, levels: int) -> Column:
    return F.shiftright(F.col(column), levels)


def cell_counts(points: DataFrame) -> DataFrame:
    """(level, x, y, n): the points of every cell that holds one; ``points`` has _x and _y."""
    now = points.groupBy(F.col("_x").alias("x"), F.col("_y").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    out = [now.select(F.lit(DEEPEST).alias("level"), "x", "y", "n")]
    for level in LEVELS[-2::-1]:
        now = now.groupBy(_up("x", 2).alias("x"), _up("y", 2).alias("y")).agg(F.sum("n").alias("n"))
        out.append(now.select(F.lit(level).alias("level"), "x", "y", "n"))
    return reduce(DataFrame.unionByName, out)


def tree_cells(counts: DataFrame) -> DataFrame:
    """(level, x, y, n, leaf): the cells of the tree, that is the roots and the cells whose parent is divided."""
    divided = counts.filter((F.col("n") > LEAF_POINTS) & (F.col("level") < DEEPEST))
    divided = divided.select((F.col("level") + 2).alias("level"), F.col("x").alias("_px"), F.col("y").alias("_py"))
    under = counts.withColumns({"_px": _up("x", 2), "_py": _up("y", 2)}).join(divided, ["level", "_px", "_py"], "left_semi").drop("_px", "_py")
    leaf = (F.col("n") <= LEAF_POINTS) | (F.col("level") == DEEPEST)
    return counts.filter(F.col("level") == ROOT).unionByName(under).withColumn("leaf", leaf)


def leaf_points(points: DataFrame, counts: DataFrame) -> DataFrame:
    """``points`` (with _x and _y) with the level, x and y of their leaf in place of _x and _y; as many rows as before.

    The leaf level comes down from the roots over the counted cells, then to the points by their deepest cell."""
    found = None
    for level in LEVELS:
        own = F.when((F.col("n") <= LEAF_POINTS) | (F.lit(level) == DEEPEST), F.lit(level))
        here = counts.filter(F.col("level") == level).select("x", "y", own.alias("own"))
        if found is not None:
            above = found.select(F.col("x").alias("_px"), F.col("y").alias("_py"), F.col("own").alias("_above"))
            here = (here.withColumns({"_px": _up("x", 2), "_py": _up("y", 2)}).join(above, ["_px", "_py"])
                    .select("x", "y", F.coalesce("_above", "own").alias("own")))
        found = here
    out = points.join(found.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("own").alias("level")), ["_x", "_y"])
    deeper = F.lit(DEEPEST) - F.col("level")
    return out.withColumns({"x": F.call_function("shiftright", F.col("_x"), deeper), "y": F.call_function("shiftright", F.col("_y"), deeper)}).drop("_x", "_y")


@dataclass
class Tree:
    """``points``: business_id, latitude, longitude and the level, x, y of the point's leaf; ``cells``: level, x, y, n, leaf."""

    points: DataFrame
    cells: DataFrame
    _tiles: tuple | None = field(default=None, repr=False)
    _upper: Cells | None = field(default=None, repr=False)

    def at(self, level: int) -> DataFrame:
        """The cells of one level (x, y, n, leaf); over a stored tree this reads that level's folder."""
        return self.cells.filter(F.col("level") == level).select("x", "y", "n", "leaf")

    def tiles(self) -> tuple[DataFrame, DataFrame]:
        """(cells, points): the tree cut off at cells of at most TILE_POINTS points (level, x, y, n, open, parts), and the points with
        their tile and its part (level, x, y, part). A cell that holds more and cannot be divided has several parts."""
        if self._tiles is None:
            work = Scratch(self.cells.sparkSession, "tiles")
            cells = self.cells.withColumn("open", (F.col("n") > TILE_POINTS) & ~F.col("leaf") & (F.col("level") < DEEPEST))
            divided = cells.filter("open").select((F.col("level") + 2).alias("level"), F.col("x").alias("_px"), F.col("y").alias("_py"))
            under = cells.withColumns({"_px": _up("x", 2), "_py": _up("y", 2)}).join(divided, ["level", "_px", "_py"], "left_semi")
            top = cells.filter(F.col("level") == ROOT).unionByName(under.drop("_px", "_py"))
            top = work.written(top.select(*CELL, "n", "open", F.ceil(F.col("n") / TILE_POINTS).alias("parts")))
            up = lambda c: F.call_function("shiftright", F.col(c), F.col("level") - F.col("_l"))
            above = self.points.withColumn("_l", F.explode(F.sequence(F.lit(ROOT), F.col("level"), F.lit(2))))
            above = above.select(F.col("_l").alias("level"), up("x").alias("x"), up("y").alias("y"), "business_id", "latitude", "longitude")
            tiles = top.filter(~F.col("open")).select(*CELL, "parts")
            held = above.join(tiles, CELL).withColumn("part", F.pmod(F.xxhash64("business_id"), "parts")).drop("parts")
            self._tiles = top, work.written(held)
        return self._tiles

    def upper(self) -> Cells:
        """The cells down to the tiles as tasks hold them: 32^4 roots and, below, sixteen for each 65,536 points at most, some 40 bytes each."""
        if self._upper is None:
            top = self.tiles()[0].select(*CELL, "n", "open", "parts").toArrow()
            self._upper = Cells(*(top[c].to_numpy().astype(bool if c == "open" else np.int64) for c in (*CELL, "n", "open", "parts")))
        return self._upper


def tree_of(index: DataFrame | Tree) -> Tree:
    """The tree of index rows; one that is given stays as it is."""
    if isinstance(index, Tree):
        return index
    work = Scratch(index.sparkSession, "tree")
    points = deep_cells(index.select("business_id", "latitude", "longitude"))
    counts = work.written(cell_counts(points), "level")
    tree = Tree(work.written(leaf_points(points, counts)), work.written(tree_cells(counts), "level"))
    work.drop(counts)
    return tree


def without(tree: Tree, gone: DataFrame) -> Tree:
    """The tree without the points of some business ids (a table expected to be small beside the tree): counts fall, the division
    into cells stays."""
    work = Scratch(gone.sparkSession, "gone")
    ids = gone.select("business_id").distinct()
    dead = work.written(tree.points.join(ids, "business_id", "left_semi").select("business_id", *CELL))
    # A dead point lies in its leaf and in the cells above it.
    steps = F.explode(F.sequence(F.lit(0), F.col("level") - F.lit(ROOT), F.lit(2)))
    lost = dead.select(*CELL, steps.alias("_up")).groupBy(
        (F.col("level") - F.col("_up")).alias("level"), F.call_function("shiftright", F.col("x"), F.col("_up")).alias("x"),
        F.call_function("shiftright", F.col("y"), F.col("_up")).alias("y")).agg(F.count(F.lit(1)).alias("_lost"))
    cells = tree.cells.join(lost, CELL, "left").withColumn("n", F.col("n") - F.coalesce("_lost", F.lit(0))).drop("_lost").filter(F.col("n") > 0)
    return Tree(tree.points.join(dead.select("business_id"), "business_id", "left_anti"), work.written(cells, "level"))
