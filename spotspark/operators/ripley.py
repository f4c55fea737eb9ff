"""Masks, controls, Ripley curves and interaction matrices."""

from __future__ import annotations

import math
import operator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.grid import CROWD
from ..sources.io import cut, small
from .neighbors import CELL_ROWS, pair_counts_controls, pair_counts_cross, pair_counts_drawn, rings_jittered


def occupancy_mask(df: DataFrame, pixel: int, size: int) -> DataFrame:
    """M1: (cell, i, j): 3 x 3 dilation of the occupied pixels, clipped to the field."""
    at = df.select("cell", F.floor(F.col("x_m") / pixel).alias("i"), F.floor(F.col("y_m") / pixel).alias("j")).distinct()
    near = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    out = at.select("cell", "i", "j", F.explode(near).alias("o")).select("cell", (F.col("i") + F.col("o.a")).alias("i"), (F.col("j") + F.col("o.b")).alias("j")).distinct()
    return out.where(F.col("i").between(0, size - 1) & F.col("j").between(0, size - 1))


def render_counts(df: DataFrame, bin_: int, keys: tuple[str, ...] = ("cell", "channel")) -> DataFrame:
    """D1."""
    return df.groupBy(*keys, F.floor(F.col("x_m") / bin_).alias("gx"), F.floor(F.col("y_m") / bin_).alias("gy")).agg(F.count("*").alias("n"))


def density_mask(df: DataFrame, bin_: int, sigma: float = 1.0, up: int = 2) -> DataFrame:
    """M2: (cell, i, j) of the raster refined `up` times: blurred counts over a third of Otsu's threshold."""
    reach = int(4 * sigma + 0.5)
    raw = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    kernel = F.array(*[F.struct(F.lit(k - reach).alias("o"), F.lit(w / sum(raw)).alias("w")) for k, w in enumerate(raw)])
    g = render_counts(df, bin_, ("cell",)).select("cell", "gx", "gy", F.col("n").cast("double").alias("v"))
    for axis, other in (("gx", "gy"), ("gy", "gx")):
        g = g.select("cell", axis, other, "v", F.explode(kernel).alias("k")).groupBy("cell", (F.col(axis) + F.col("k.o")).alias(axis), other).agg(F.sum(F.col("v") * F.col("k.w")).alias("v"))
    span = g.groupBy("cell").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    binned = g.join(span, "cell").withColumn("b", F.least(F.lit(255), F.floor((F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * 256)))
    hist = binned.groupBy("cell", "b", "lo", "hi").agg(F.count("*").alias("n")).withColumn("c", F.col("lo") + (F.col("b") + 0.5) * (F.col("hi") - F.col("lo")) / 256)
    w = Window.partitionBy("cell").orderBy("b")
    low, high = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(1, Window.unboundedFollowing)
    m = lambda x: F.sum(F.col("n") * F.col("c")).over(x) / F.sum("n").over(x)
    split = hist.withColumn("between", F.sum("n").over(low) * F.sum("n").over(high) * F.pow(m(low) - m(high), F.lit(2.0)))
    otsu = split.groupBy("cell").agg(F.max_by("c", F.struct("between", -F.col("b"))).alias("otsu"))
    keep = g.join(otsu, "cell").where(F.col("v") >= F.col("otsu") / 3)
    fine = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(up) for b in range(up)])
    return keep.select("cell", "gx", "gy", F.explode(fine).alias("o")).select("cell", (F.col("gx") * up + F.col("o.a")).alias("i"), (F.col("gy") * up + F.col("o.b")).alias("j"))


def in_mask(df: DataFrame, mask: DataFrame, pixel: int) -> DataFrame:
    """Rows whose pixel is in the mask. A shuffled semi-join: masks can be fine."""
    at = df.withColumns({"i": F.floor(F.col("x_m") / pixel), "j": F.floor(F.col("y_m") / pixel)})
    return at.join(mask, ["cell", "i", "j"], "left_semi").drop("i", "j")


def mask_density(df: DataFrame, mask: DataFrame, pixel: int) -> DataFrame:
    """Points of each tag inside the mask over its area (square pixels)."""
    area = mask.groupBy("cell").agg((F.count("*") * F.lit(pixel * pixel / 1e6)).alias("area"))
    n = in_mask(df, mask, pixel).groupBy("cell", "tag").agg(F.count("*").alias("n"))
    return n.join(area, "cell").select("cell", "tag", "n", "area", (F.col("n") / F.col("area")).alias("density"))


P = 2147483647


def hashed(i, control_id, cell, channel=None, rest=operator.mod):
    """M3: two nonlinear integer hashes of a point's number, as column expressions (or of arrays, with np.fmod as rest)."""
    h0 = rest(i * 48271 + control_id * (16807 * 1009) + cell * (69621 * 10007) + 12345, P)
    if channel is not None:
        h0 = rest(h0 + channel * 31337, P)
    h1 = rest(h0 * h0 + h0, P)
    h2 = rest(rest(h1 * h1, P) * 39373 + 11, P)
    return h2, rest(rest(h2 * h2, P) + h1 * 40692, P)


#: Points of one control that one row stands for before they are made, and points that are made from one row of a cell.
POINTS, DEALT = 10_000, 500_000


def mask_pixels(mask: DataFrame) -> DataFrame:
    """(cell, pixels): the mask's pixels in the order of i, j, each as i * 2^32 + j + 2^31. A raster is bounded by its resolution."""
    code = F.shiftleft(F.col("i").cast("long"), 32) + F.col("j").cast("long") + F.lit(1 << 31)
    return mask.groupBy("cell").agg(F.array_sort(F.collect_list(code)).alias("pixels"))


def random_points(sizes: DataFrame, repeats: int, mask: DataFrame, pixel: int) -> DataFrame:
    """M3: uniform points in the mask (cell, i, j; pixels of side `pixel`), as many as `sizes` (cell, channel, n) says.
    -> cell, channel, control_id, loc_id, x_m, y_m.

    A point draws one of its cell's mask pixels and a place in it, so none is rejected and n are made. What is shuffled are a cell's pixels, once
    for each DEALT of its points, and ranges of ids; points are made last and never joined. A cell without mask has no points.
    """
    sizes = sizes.where("n > 0").select("cell", "channel", "n")
    deals = sizes.groupBy("cell").agg(F.ceil(F.sum("n") * repeats / DEALT).cast("long").alias("deals"))
    each = sizes.join(deals, "cell").withColumn("control_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(repeats - 1).cast("long"))))
    each = each.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / POINTS))))
    first = F.col("part") * POINTS
    range_ = F.struct("channel", "control_id", first.alias("first"), F.least(F.col("n"), first + POINTS).alias("end"))
    each = each.groupBy("cell", F.pmod(F.xxhash64("channel", "control_id", "part"), "deals").alias("deal")).agg(F.collect_list(range_).alias("ranges"))
    held = mask_pixels(mask).join(deals, "cell").select("cell", "pixels", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"))
    tasks = int(mask.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = each.join(held, ["cell", "deal"]).repartition(tasks, "cell", "deal")
    each = each.select("cell", "pixels", F.explode("ranges").alias("s")).select("cell", "pixels", "s.*")
    each = each.select("cell", "channel", "control_id", "pixels", F.explode(F.sequence("first", F.col("end") - 1)).alias("i"))
    h2, h3 = hashed(F.col("i"), F.col("control_id"), F.col("cell").cast("long"), F.col("channel").cast("long"))
    each = each.withColumn("__h", F.struct(h2.alias("a"), h3.alias("b")))
    which, where = F.floor(F.col("__h.a") / 7) % F.size("pixels"), F.floor(F.col("__h.b") / 7)
    at = each.select("cell", "channel", "control_id", F.col("i").alias("loc_id"), F.get("pixels", which.cast("int")).alias("p"), where.alias("w"))
    i, j = F.shiftright("p", 32), F.col("p").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)
    return at.where("p is not null").select("cell", "channel", "control_id", "loc_id", (i * pixel + F.col("w") % pixel).alias("x_m"), (j * pixel + F.floor(F.col("w") / pixel) % pixel).alias("y_m"))


def jitter_control(df: DataFrame, repeats: int, radius: int) -> DataFrame:
    """M4: df `repeats` times over (control_id from 0), each point moved within a disc; the radius is R u^(1/3)."""
    each = df.withColumn("control_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(repeats - 1).cast("long"))))
    h2, h3 = hashed(F.col("loc_id"), F.col("control_id"), F.col("cell"))
    r = F.lit(float(radius)) * F.pow((h2 + F.lit(0.5)) / F.lit(float(P)), F.lit(1.0 / 3.0))
    phi = F.lit(2 * math.pi) * (h3 + F.lit(0.5)) / F.lit(float(P))
    return each.withColumns({"x_m": (F.col("x_m") + F.round(r * F.cos(phi))).cast("long"), "y_m": (F.col("y_m") + F.round(r * F.sin(phi))).cast("long")})


def jittered_rings(df: DataFrame, radii: list[int], repeats: int, radius: int, cell_rows: int = CROWD) -> DataFrame:
    """(cell, a, b, r, r2, pairs, n): how many of the controls of M4 hold so many ordered pairs of channels a and b between r and r2, the next
    radius. Controls of a cell of up to cell_rows rows are made where they are counted; those of larger cells are joined."""

    def moved(loc_id, control_id, cell, x, y):
        h2, h3 = hashed(loc_id, control_id, cell, None, np.fmod)
        r, phi = radius * ((h2 + 0.5) / P) ** (1 / 3), 2 * math.pi * (h3 + 0.5) / P
        near = lambda v: (np.sign(v) * np.floor(np.abs(v) + 0.5)).astype(np.int64)
        return x + near(r * np.cos(phi)), y + near(r * np.sin(phi))

    size = cut(df.groupBy("cell").agg(F.count("*").alias("n")))
    out = rings_jittered(df, size.where(F.col("n") <= cell_rows), radii, repeats, moved)
    large = size.where(F.col("n") > cell_rows).select("cell")
    if large.isEmpty():
        return out
    rows = jitter_control(df.join(small(large), "cell", "left_semi"), repeats, radius)
    counts = rings(pair_counts_cross(cut(rows), radii, ("cell", "control_id")), ("cell", "control_id", "a", "b"))
    return out.unionByName(counts.groupBy("cell", "a", "b", "r", "r2", F.col("ring").alias("pairs")).agg(F.count("*").alias("n")))


def rings(counts: DataFrame, keys: tuple[str, ...] = ("cell", "a", "b")) -> DataFrame:
    """counts (keys, r, pairs) with r2, the next radius, and ring, the pairs between both; the last radius has none."""
    w = Window.partitionBy(*keys).orderBy("r")
    return counts.withColumns({"r2": F.lead("r").over(w), "ring": F.lead("pairs").over(w) - F.col("pairs")}).where("r2 is not null")


def mask_area(mask: DataFrame, pixel: int) -> DataFrame:
    """(cell, area) of a mask, in squared coordinates."""
    return mask.groupBy("cell").agg((F.count("*") * F.lit(float(pixel * pixel))).alias("area"))


def _with_k(counts: DataFrame, df: DataFrame, areas: DataFrame) -> DataFrame:
    """counts with k = area * pairs / Na^2, the estimator of the curves' definition. areas: cell, area."""
    sizes = df.groupBy("cell", F.col("channel").alias("a")).agg(F.count("*").alias("na"))
    k = F.col("area") * F.col("pairs") / (F.col("na") * F.col("na"))
    return counts.join(sizes, ["cell", "a"]).join(areas, "cell").withColumn("k", k).drop("na", "area")


def ripley_curves(df: DataFrame, radii: list[int], areas: DataFrame) -> DataFrame:
    """K, L, H for every pair of channels. areas: cell, area of its mask."""
    out = _with_k(pair_counts_cross(df, radii), df, areas)
    half = F.sqrt(F.col("k") / math.pi)
    return out.select("cell", "a", "b", "r", "pairs", "k", half.alias("l"), (half - F.col("r")).alias("h"))


def ripley_controls(df: DataFrame, radii: list[int], mask: DataFrame, pixel: int, repeats: int = 100, cell_rows: int = CELL_ROWS) -> DataFrame:
    """M6: (cell, control_id, a, b, r, pairs, k) for random controls in the mask. Self pairs of channels are within the control; cross
    pairs are of a control's channel a with the real b. Controls of a cell of up to cell_rows rows are drawn where they are counted; those of
    larger cells are drawn by random_points and joined. Either way they are the same points."""
    size = cut(df.groupBy("cell").agg(F.count("*").alias("n")))
    out = pair_counts_drawn(df, size.where(F.col("n") <= cell_rows), mask_pixels(mask), pixel, radii, repeats, hashed)
    large = size.where(F.col("n") > cell_rows).select("cell")
    if large.isEmpty():
        return out
    large = small(large)
    rows, mask = df.join(large, "cell", "left_semi"), mask.join(large, "cell", "left_semi")
    sizes = rows.groupBy("cell", "channel").agg(F.count("*").alias("n"))
    met = pair_counts_controls(random_points(sizes, repeats, mask, pixel), rows, radii, repeats, cell_rows)
    return out.unionByName(_with_k(met, rows, mask_area(mask, pixel)))


def control_envelope(controls: DataFrame, value: str = "k", number: str | None = None) -> DataFrame:
    """Mean and 2.5 / 97.5 % quantiles of the controls at each radius (one value for each control: a bounded group). number: a column with
    the controls that a row stands for."""
    n = F.col(number) if number else F.lit(1)
    q = F.percentile(value, F.array(F.lit(0.025), F.lit(0.975)), n)
    mean = F.sum(F.col(value) * n) / F.sum(n) if number else F.avg(value)
    return controls.groupBy("cell", "a", "b", "r").agg(mean.alias("mean"), q.alias("q")).select("cell", "a", "b", "r", "mean", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))


def ripley_normalized(curves: DataFrame, envelope: DataFrame, value: str = "k") -> DataFrame:
    """M7: (K - mean) over the width of the envelope on its side; null where that is 0 but for rounding."""
    d = F.col(value) - F.col("mean")
    side = F.when(d >= 0, F.abs(F.col("hi") - F.col("mean"))).otherwise(F.abs(F.col("lo") - F.col("mean")))
    return curves.join(envelope, ["cell", "a", "b", "r"]).withColumn("norm", F.when(side > F.lit(1e-9) * F.abs(F.col("mean")), d / side))


def curve_integral(df: DataFrame, value: str, keys: tuple[str, ...] = ("cell", "a", "b")) -> DataFrame:
    """Trapezoids over r without null, NaN or infinite points, and the integral over the greatest r."""
    x = F.col(value)
    good = df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    w = Window.partitionBy(*keys).orderBy("r")
    part = (x + F.lead(value).over(w)) / 2 * (F.lead("r").over(w) - F.col("r"))
    top = df.groupBy(*keys).agg(F.max("r").alias("top"))
    out = good.withColumn("__p", part).groupBy(*keys).agg(F.coalesce(F.sum("__p"), F.lit(0.0)).alias("integral"))
    return out.join(top, list(keys)).withColumn("matrix", F.col("integral") / F.nullif(F.col("top"), F.lit(0))).drop("top")


def annulus(counts: DataFrame, keys: tuple[str, ...] = ("cell", "a", "b")) -> DataFrame:
    """Pairs in the ring after each radius; the last value repeats."""
    w = Window.partitionBy(*keys).orderBy("r")
    ring = F.lead("pairs").over(w) - F.col("pairs")
    return counts.withColumn("ring", ring).withColumn("ring", F.coalesce("ring", F.lag("ring").over(w)))


def rdf_matrix(data: DataFrame, controls: DataFrame) -> DataFrame:
    """M9: sum over rings of area * (density - control mean) where the density is outside the control quantiles.

    data: cell, a, b, r, r2 (outer radius), g; controls: the same with n, the controls that a row stands for.
    """
    env = control_envelope(controls, "g", "n")
    out = data.join(env, ["cell", "a", "b", "r"]).where((F.col("g") > F.col("hi")) | (F.col("g") < F.col("lo")))
    ring = F.lit(math.pi) * (F.col("r2") * F.col("r2") - F.col("r") * F.col("r"))
    return out.groupBy("cell", "a", "b").agg(F.sum(ring * (F.col("g") - F.col("mean"))).alias("value"))


def matrix_average(matrices: DataFrame, value: str, ignore_nan: bool = True) -> DataFrame:
    """G14 (NaN ignored), G15 (null if any is null or NaN): mean and population deviation over cells."""
    x = F.when(~F.isnan(F.col(value).cast("double")), F.col(value))
    mean, std = F.avg(x), F.stddev_pop(x)
    if not ignore_nan:
        whole = F.count(x) == F.count("*")
        mean, std = F.when(whole, mean), F.when(whole, std)
    return matrices.groupBy("a", "b").agg(F.count("*").alias("n"), mean.alias("mean"), std.alias("std"))


def significant_pairs(matrix: DataFrame, value: str, threshold: float) -> DataFrame:
    """M10."""
    return matrix.where((F.col("a") <= F.col("b")) & (F.col(value) > threshold))


def csr_nn_pdf(densities: DataFrame, ks: int, r_max: int, d: int = 2) -> DataFrame:
    """(cell, k, r, p): density of the k-th neighbour distance at whole radii under complete randomness. densities: cell, density."""
    ball = math.pi ** (d / 2) / math.gamma(d / 2 + 1)
    facts = F.array(*[F.lit(float(math.factorial(k))) for k in range(ks)])
    each = densities.select("cell", (F.col("density") * F.lit(ball)).alias("lam"), F.explode(F.sequence(F.lit(1), F.lit(ks))).alias("k"))
    each = each.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(r_max).cast("long"))).alias("r"))
    r, k = F.col("r").cast("double"), F.col("k").cast("double")
    head = F.lit(float(d)) / F.get(facts, F.col("k") - 1) * F.pow(F.col("lam"), k)
    p = head * F.pow(r, d * k - 1) * F.exp(-F.col("lam") * F.pow(r, F.lit(float(d))))
    return each.select("cell", F.col("k").cast("long").alias("k"), "r", p.alias("p"))


def density_summary(by_rdf: DataFrame, by_mask: DataFrame) -> DataFrame:
    """By tag over cells: mean of the RDF densities and of the mask densities (the sizes of a graph's nodes), number of cells, median.
    by_rdf, by_mask: cell, tag, density."""
    both = by_mask.select("cell", "tag", F.col("density").alias("mask")).join(by_rdf.select("cell", "tag", F.col("density").alias("rdf")), ["cell", "tag"], "full")
    return both.groupBy("tag").agg(F.count("*").alias("n_cells"), F.avg("rdf").alias("mean_rdf"), F.avg("mask").alias("mean_mask"), F.median("mask").alias("median_mask"))
