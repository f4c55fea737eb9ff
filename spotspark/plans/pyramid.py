"""Counts of pairs by distance without the pairs: two nodes of a pyramid of grid cells meet, not their points.

A pair of nodes whose least and greatest distances (of the boxes around their points) fall between the same two radii adds the product
of their counts at once, and one that is farther apart than the last radius is dropped. Of the others those with few pairs of points are
opened into points; the rest go on with their quadrants. What is left at each level are pairs of nodes on the border of a ring, so the work
on points packed n times denser grows about as n ^ 1.5 at most, not as its square. Only grid cells with more than CROWD points
and their neighbours are counted so; all others are cheaper to join.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import cut, small
from .grid import CROWD, crowded, pairs_once

#: Pairs of points that two nodes may be opened into.
OPEN = 2048


def bucket(d2: Column, radii: list) -> Column:
    """Index of the first radius that is at or above the distance; their number if there is none."""
    out = F.lit(len(radii))
    for k in reversed(range(len(radii))):
        out = F.when(d2 <= radii[k] * radii[k], F.lit(k)).otherwise(out)
    return out


def counted_pairs(df: DataFrame, radii: list, keys: tuple[str, ...], by: str | None = None, dims: tuple[str, ...] = ("x_m", "y_m"), number: str = "loc_id", stretch: int = 1, crowd: int = CROWD) -> DataFrame:
    """(keys[, a, b], bucket, n): unordered pairs of different rows with equal keys by the first radius at or above their distance.

    by: a column; a and b are its values of the two rows, in either order (a pair of values may stand in both).
    """
    side = float(max(radii))
    rows = df.select(number, *dims, *keys, *([by] if by else []))
    cells = crowded(rows, side, keys, dims, crowd)
    names = ["a", "b"] if by else []
    if cells is None:
        return _opened(pairs_once(rows, side, keys, dims, number, stretch, crowd=1 << 62), radii, keys, by)
    grid = [f"__g{k}" for k in range(len(dims))]
    at = {g: F.floor(F.col(d) / F.lit(side)) for g, d in zip(grid, dims, strict=True)}
    placed = rows.withColumns(at)
    hot = small(cells.select(*keys, *grid))
    plain = placed.join(hot, [*keys, *grid], "left_anti").drop(*grid)
    parts = [_opened(pairs_once(plain, side, keys, dims, number, stretch, crowd=1 << 62), radii, keys, by)]
    steps = F.array(*[F.struct(*[F.lit(v).alias(g) for g, v in zip(grid, s, strict=True)]) for s in itertools.product((-1, 0, 1), repeat=len(dims))])
    around = cells.select(*keys, *grid, F.explode(steps).alias("__s"))
    around = around.select(*keys, *[F.col(g).alias(f"l{g}") for g in grid], *[(F.col(g) + F.col(f"__s.{g}")).alias(g) for g in grid])
    near = cut(placed.join(small(cut(around.select(*keys, *grid).distinct())), [*keys, *grid], "left_semi").drop(*grid))
    # pairs of grid cells of which one at least is crowded, each once
    both = cut(around.join(hot.withColumn("hot", F.lit(True)), [*keys, *grid], "left"))
    low, high = F.struct(*[f"l{g}" for g in grid]), F.struct(*grid)
    pairs = both.where(F.col("hot").isNull() | (low <= high)).select(*keys, *[F.col(f"l{g}").alias(f"a{k}") for k, g in enumerate(grid)], *[F.col(g).alias(f"b{k}") for k, g in enumerate(grid)])
    for level in itertools.count():
        width = side / 2**level
        nodes = cut(_nodes(near, width, keys, by, dims))
        found = cut(_classified(pairs, nodes, radii, keys, dims))
        parts.append(_settled(found.where("kind = 'settled'"), keys, by))
        opened = found.where("kind = 'opened'")
        p = near.withColumns({f"u{k}": F.floor(F.col(d) / F.lit(width)) for k, d in enumerate(dims)})
        one = opened.select(*keys, *[f"a{k}" for k in range(len(dims))], *[f"b{k}" for k in range(len(dims))])
        one = one.join(p.withColumnsRenamed({f"u{k}": f"a{k}" for k in range(len(dims))}), [*keys, *[f"a{k}" for k in range(len(dims))]])
        other = p.select(*[F.col(k) for k in keys], *[F.col(f"u{k}").alias(f"b{k}") for k in range(len(dims))], *[F.col(c).alias(f"o_{c}") for c in (number, *dims, *([by] if by else []))])
        same = F.lit(True)
        for k in range(len(dims)):
            same &= F.col(f"a{k}") == F.col(f"b{k}")
        met = one.join(other, [*keys, *[f"b{k}" for k in range(len(dims))]]).where(~same | (F.col(number) < F.col(f"o_{number}")))
        d2 = sum(((F.col(d) - F.col(f"o_{d}")) * (F.col(d) - F.col(f"o_{d}")) for d in dims), F.lit(0))
        parts.append(_opened(met.withColumn("d2", d2).where(F.col("d2") <= side * side), radii, keys, by))
        rest = found.where("kind = 'split'").select(*keys, *[f"a{k}" for k in range(len(dims))], *[f"b{k}" for k in range(len(dims))])
        if rest.limit(1).count() == 0:
            break
        pairs = _children(rest, len(dims))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy(*keys, *names, "bucket").agg(F.sum("n").alias("n"))


def touching(points: DataFrame, pairs: DataFrame, reach: float, width: float, keys: tuple[str, ...], dims: tuple[str, ...]) -> DataFrame:
    """Rows of pairs (keys, a0 .., b0 ..: cells of side `width`, id) whose two cells hold points within reach of each other: (id).

    A pair is settled by the boxes around the points where all of them, or none, are within reach; of the others those with few pairs of points
    are opened, and the rest go on with their quadrants until one pair of quadrants settles them. Points are never paired in bulk.
    """
    u = [f"u{k}" for k in range(len(dims))]
    found = None
    pairs = cut(pairs.select(*keys, *[f"{s}{k}" for s in "ab" for k in range(len(dims))], "id"))
    for level in itertools.count():
        side = width / 2**level
        kinds = cut(_classified(pairs, _nodes(points, side, keys, None, dims), [reach], keys, dims, ("id",)))
        p = points.select(*keys, *dims, *[F.floor(F.col(d) / F.lit(side)).alias(c) for d, c in zip(dims, u, strict=True)])
        one = kinds.where("kind = 'opened'").select(*keys, "id", *[f"{s}{k}" for s in "ab" for k in range(len(dims))])
        one = one.join(p.withColumnsRenamed({f"u{k}": f"a{k}" for k in range(len(dims))}), [*keys, *[f"a{k}" for k in range(len(dims))]])
        other = p.select(*keys, *[F.col(c).alias(f"b{k}") for k, c in enumerate(u)], *[F.col(c).alias(f"o_{c}") for c in dims])
        d2 = sum(((F.col(d) - F.col(f"o_{d}")) * (F.col(d) - F.col(f"o_{d}")) for d in dims), F.lit(0))
        met = one.join(other, [*keys, *[f"b{k}" for k in range(len(dims))]]).where(d2 <= reach * reach).select("id")
        new = cut(kinds.where("kind = 'settled'").select("id").unionByName(met).distinct())
        found = new if found is None else found.unionByName(new)
        rest = kinds.where("kind = 'split'").drop("kind", "bucket", "a_kinds", "b_kinds").join(new, "id", "left_anti")
        if rest.limit(1).count() == 0:
            return found.distinct()
        pairs = cut(_children(rest, len(dims)))


def _opened(met: DataFrame, radii: list, keys: tuple[str, ...], by: str | None) -> DataFrame:
    """Counts of pairs of points."""
    names = [F.col(by).alias("a"), F.col(f"o_{by}").alias("b")] if by else []
    return met.groupBy(*keys, *names, bucket(F.col("d2"), radii).alias("bucket")).agg(F.count("*").alias("n"))


def _nodes(points: DataFrame, width: float, keys: tuple[str, ...], by: str | None, dims: tuple[str, ...]) -> DataFrame:
    """(keys, u0 .., box: lo and hi of each dimension, n, kinds: array of (value of by, count))."""
    at = [F.floor(F.col(d) / F.lit(width)).alias(f"u{k}") for k, d in enumerate(dims)]
    kind = F.col(by) if by else F.lit(0)
    box = [f(d).alias(f"{e}{k}") for k, d in enumerate(dims) for e, f in (("lo", F.min), ("hi", F.max))]
    u = [f"u{k}" for k in range(len(dims))]
    each = points.groupBy(*keys, *at, kind.alias("kind")).agg(F.count("*").alias("n"), *box)
    edges = [f(f"{e}{k}").alias(f"{e}{k}") for k in range(len(dims)) for e, f in (("lo", F.min), ("hi", F.max))]
    return each.groupBy(*keys, *u).agg(F.sum("n").alias("n"), F.collect_list(F.struct("kind", "n")).alias("kinds"), *edges)


def _classified(pairs: DataFrame, nodes: DataFrame, radii: list, keys: tuple[str, ...], dims: tuple[str, ...], carry: tuple[str, ...] = ()) -> DataFrame:
    """pairs of occupied nodes with kind (settled, opened, split), bucket and the kinds of points; those out of reach are gone."""
    d = range(len(dims))
    for side in "ab":
        named = nodes.select(*keys, *[F.col(c).alias(f"{side}_{c}" if c[0] != "u" else f"{side}{c[1:]}") for c in nodes.columns if c not in keys])
        pairs = pairs.join(named, [*keys, *[f"{side}{k}" for k in d]])
    least = sum((F.pow(F.greatest(F.col(f"a_lo{k}") - F.col(f"b_hi{k}"), F.col(f"b_lo{k}") - F.col(f"a_hi{k}"), F.lit(0)), F.lit(2.0)) for k in d), F.lit(0.0))
    most = sum((F.pow(F.greatest(F.abs(F.col(f"a_hi{k}") - F.col(f"b_lo{k}")), F.abs(F.col(f"b_hi{k}") - F.col(f"a_lo{k}"))), F.lit(2.0)) for k in d), F.lit(0.0))
    out = pairs.withColumns({"bucket": bucket(least, radii), "__far": bucket(most, radii)}).where(F.col("bucket") < len(radii))
    kind = F.when(F.col("bucket") == F.col("__far"), "settled").when(F.col("a_n") * F.col("b_n") <= OPEN, "opened").otherwise("split")
    return out.select(*keys, *carry, *[f"{s}{k}" for s in "ab" for k in d], "bucket", "a_kinds", "b_kinds", kind.alias("kind"))


def _settled(pairs: DataFrame, keys: tuple[str, ...], by: str | None) -> DataFrame:
    """Products of the counts of two nodes; of a node with itself (all at one place) each pair once."""
    u = [c for c in pairs.columns if c[0] in "ab" and c[1:].isdigit()]
    own = F.lit(True)
    for k in range(len(u) // 2):
        own &= F.col(f"a{k}") == F.col(f"b{k}")
    each = pairs.select(*keys, "bucket", own.alias("own"), F.explode("a_kinds").alias("a"), "b_kinds").select("*", F.explode("b_kinds").alias("other"))
    each = each.where(~F.col("own") | (F.col("a.kind") <= F.col("other.kind")))
    n = F.when(F.col("own") & (F.col("a.kind") == F.col("other.kind")), F.expr("a.n * (a.n - 1) div 2")).otherwise(F.col("a.n") * F.col("other.n"))
    names = [F.col("a.kind").alias("a"), F.col("other.kind").alias("b")] if by else []
    each = each.select(*keys, *names, "bucket", n.alias("n"))
    return each.groupBy(*keys, *(["a", "b"] if by else []), "bucket").agg(F.sum("n").alias("n")).where("n > 0")


def _children(pairs: DataFrame, d: int) -> DataFrame:
    """Pairs of the quadrants of two nodes; of a node with itself each pair of quadrants once."""
    half = list(itertools.product((0, 1), repeat=d))
    steps = F.array(*[F.struct(*[F.lit(v).alias(f"{s}{k}") for s, p in (("a", x), ("b", y)) for k, v in enumerate(p)], F.lit(x <= y).alias("first")) for x in half for y in half])
    same = F.lit(True)
    for k in range(d):
        same &= F.col(f"a{k}") == F.col(f"b{k}")
    keys = [c for c in pairs.columns if not (c[0] in "ab" and c[1:].isdigit())]
    each = pairs.select("*", F.explode(steps).alias("s")).where(~same | F.col("s.first"))
    return each.select(*keys, *[(F.col(f"{c}{k}") * 2 + F.col(f"s.{c}{k}")).alias(f"{c}{k}") for c in "ab" for k in range(d)])
