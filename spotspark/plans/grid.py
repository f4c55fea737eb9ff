"""The one distance join: grid cells as equi-join keys, split where points crowd.

The side of a grid cell is two radii; the points of one side are copied to the cells that their radius reaches (2^d of them on average;
at a side of one radius it would be 3^d), the other side stays, and the pairs in a cell are filtered by distance. No pair appears twice,
since the cells of a point are distinct. Keys are
(keys, gx, gy[, gz]), so a dataset that holds most rows is spread over its grid cells.

The side that stays is counted by grid cell before. A cell with more than CROWD rows is a quadtree node of the level at which its
quadrants hold CROWD rows on average; a quadrant that holds more (the same place over and over) is dealt into parts by a hash of
its rows. Copies go only to quadrants within the radius of their point, and to every part of those. So what meets under one key is
bounded on the side that stays, wherever the points lie.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import cut, small

#: Rows of the side that stays which may meet under one key.
CROWD = 4096
#: Most quadrants of one grid cell.
QUADRANTS = 1024
#: Side of a grid cell in radii: wider cells mean fewer copies to shuffle, and more comparisons.
STRETCH = 2


def _grid(dims: tuple[str, ...]) -> list[str]:
    return [f"__g{k}" for k in range(len(dims))]


def _at(dims: tuple[str, ...], side: float, prefix: str = "") -> dict:
    return {g: F.floor(F.col(f"{prefix}{d}") / F.lit(float(side))) for g, d in zip(_grid(dims), dims, strict=True)}


def crowded(df: DataFrame, side: float, keys: tuple[str, ...], dims: tuple[str, ...], crowd: int = CROWD) -> DataFrame | None:
    """(keys, __g0 .., __level, __n) of the grid cells with more than `crowd` rows, saved; None where there are none."""
    n = df.groupBy(*keys, *[c.alias(g) for g, c in _at(dims, side).items()]).agg(F.count("*").alias("__n")).where(F.col("__n") > crowd)
    most = int(math.log(QUADRANTS, 2 ** len(dims)))
    level = F.least(F.lit(most), F.ceil(F.log(F.col("__n") / crowd) / math.log(2 ** len(dims))))
    return None if n.isEmpty() else cut(n.withColumn("__level", level.cast("int")))


class Quadrants:
    """The split of crowded cells: a code for each quadrant, and the parts of the quadrants that are still crowded."""

    def __init__(self, right: DataFrame, side: float, keys: tuple[str, ...], dims: tuple[str, ...], crowd: int):
        self.side, self.keys, self.dims, self.grid = float(side), keys, dims, _grid(dims)
        self.cells = crowded(right, side, keys, dims, crowd)
        if self.cells is not None:
            levels = small(self.cells.drop("__n"))
            rows = right.withColumns(_at(dims, side)).join(levels, [*keys, *self.grid])
            n = rows.groupBy(*keys, *self.grid, self._quadrant().alias("__q")).agg(F.count("*").alias("__n"))
            self.parts = cut(n.select(*keys, *self.grid, "__q", F.ceil(F.col("__n") / crowd).cast("int").alias("__parts")))

    def _quadrant(self):
        """Code of the quadrant of a row with dims and __level."""
        code = F.lit(0).cast("long")
        wide = F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), F.col("__level")).cast("long")
        for g, d in zip(self.grid, self.dims, strict=True):
            inside = F.floor((F.col(d) - F.col(g) * F.lit(self.side)) / F.lit(self.side) * wide)
            code = code * wide + F.greatest(F.lit(0).cast("long"), F.least(wide - 1, inside))
        return code

    def stay(self, right: DataFrame) -> DataFrame:
        """right (with the grid columns) with __q and __part."""
        none = F.lit(0).cast("long")
        if self.cells is None:
            return right
        own = right.join(small(self.cells.drop("__n")), [*self.keys, *self.grid], "left")
        own = own.withColumn("__q", F.when(F.col("__level").isNull(), none).otherwise(self._quadrant())).drop("__level")
        own = own.join(small(self.parts), [*self.keys, *self.grid, "__q"], "left")
        return own.withColumn("__part", F.when(F.col("__parts") > 1, F.pmod(F.xxhash64(*right.columns), F.col("__parts").cast("long"))).otherwise(none)).drop("__parts")

    def copies(self, left: DataFrame, radius: float) -> DataFrame:
        """left (copied to grid cells) copied to the occupied quadrants within the radius, and to their parts."""
        if self.cells is None:
            return left
        none = F.lit(0).cast("long")
        own = left.join(small(self.cells.drop("__n")), [*self.keys, *self.grid], "left")
        wide = F.pow(F.lit(2), F.col("__level")).cast("long")
        d = len(self.dims)
        every = F.sequence(none, F.pow(F.lit(2 ** d), F.col("__level")).cast("long") - 1)

        def near(q):
            apart = F.lit(0.0)
            for k, (g, c) in enumerate(zip(self.grid, self.dims, strict=True)):
                place = F.floor(q / F.pow(wide, F.lit(d - 1 - k))) % wide
                low = F.col(g) * F.lit(self.side) + place * F.lit(self.side) / wide
                off = F.greatest(low - F.col(c), F.col(c) - low - F.lit(self.side) / wide, F.lit(0.0))
                apart = apart + off * off
            return apart <= F.lit(float(radius) * radius * (1 + 1e-9))

        codes = F.when(F.col("__level").isNull(), F.array(none)).otherwise(F.filter(every, near))
        own = own.withColumn("__q", F.explode(codes)).drop("__level")
        own = own.join(small(self.parts), [*self.keys, *self.grid, "__q"], "left")
        return own.withColumn("__part", F.explode(F.sequence(none, F.coalesce("__parts", F.lit(1)).cast("long") - 1))).drop("__parts")

    @property
    def names(self) -> list[str]:
        return [*self.grid, *(["__q", "__part"] if self.cells is not None else [])]


def _d2(dims: tuple[str, ...]):
    parts = [(F.col(d) - F.col(f"o_{d}")) * (F.col(d) - F.col(f"o_{d}")) for d in dims]
    return sum(parts[1:], parts[0])


def _met(a: DataFrame, b: DataFrame, right: DataFrame, keys: tuple[str, ...], names: list[str]) -> DataFrame:
    """Join of the copies a and the rows b that stay (columns of right and the names)."""
    b = b.select(*[F.col(c).alias(f"o_{c}") for c in right.columns], *[F.col(c).alias(f"o{c}") for c in names])
    return a.join(b, [F.col(k) == F.col(f"o_{k}") for k in keys] + [F.col(c) == F.col(f"o{c}") for c in names])


def pairs_within(left: DataFrame, right: DataFrame, radius: float, keys: tuple[str, ...], dims: tuple[str, ...] = ("x_m", "y_m"), crowd: int = CROWD, stretch: int = STRETCH) -> DataFrame:
    """Columns of left, columns of right prefixed by o_, d2 (squared distance): all pairs with d <= radius and equal keys.

    left is what is copied: give the smaller table there.
    """
    side = float(radius * stretch)
    split = Quadrants(right, side, keys, dims, crowd)
    a = left
    for g, d in zip(split.grid, dims, strict=True):
        first, last = (F.floor((F.col(d) + F.lit(off)) / F.lit(side)) for off in (-radius * (1 + 1e-9), radius * (1 + 1e-9)))
        a = a.select(*a.columns, F.explode(F.sequence(first, last)).alias(g))
    a = split.copies(a, radius)
    b = split.stay(right.withColumns(_at(dims, side)))
    met = _met(a, b, right, keys, split.names).withColumn("d2", _d2(dims)).where(F.col("d2") <= radius * radius)
    return met.drop(*split.names, *[f"o{c}" for c in split.names])


def pairs_once(df: DataFrame, radius: float, keys: tuple[str, ...], dims: tuple[str, ...] = ("x_m", "y_m"), number: str = "loc_id", stretch: int = 1, crowd: int = CROWD) -> DataFrame:
    """As pairs_within for a table with itself, without pairs of a row with itself and each pair in one of its two orders.

    A row is copied to its own grid cell and to those that follow it in order and are within the radius: half as many copies and
    comparisons. stretch: the side of a grid cell in radii; wider cells suit thin tables, where copies cost more than comparisons.
    """
    side = float(radius * stretch)
    split = Quadrants(df, side, keys, dims, crowd)
    grid = split.grid
    steps = [s for s in itertools.product((-1, 0, 1), repeat=len(dims)) if s >= (0,) * len(dims)]
    near = F.array(*[F.struct(*[F.lit(v).alias(g) for g, v in zip(grid, s, strict=True)]) for s in steps])
    at = _at(dims, side)
    a = df.select(*df.columns, F.explode(near).alias("__s"))
    if stretch > 1:
        for g, d in zip(grid, dims, strict=True):
            inside = F.col(d) - at[g] * F.lit(side)
            step = F.col(f"__s.{g}")
            a = a.where((step == 0) | ((step == 1) & (inside >= side - radius)) | ((step == -1) & (inside <= radius)))
    a = a.withColumns({g: at[g] + F.col(f"__s.{g}") for g in grid})
    own = F.lit(True)
    for g in grid:
        own &= F.col(f"__s.{g}") == 0
    a = split.copies(a.withColumn("__own", own).drop("__s"), radius)
    b = split.stay(df.withColumns(at))
    met = _met(a, b, df, keys, split.names).withColumn("d2", _d2(dims)).where((F.col("d2") <= radius * radius) & (~F.col("__own") | (F.col(number) < F.col(f"o_{number}"))))
    return met.drop(*split.names, "__own", *[f"o{c}" for c in split.names])
