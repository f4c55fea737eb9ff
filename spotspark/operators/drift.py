"""Picks, drift, channel registration, localization precision and interactions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.grid import pairs_within
from ..sources.io import cut, small
from .frames import interpolate


def picked_locs(df: DataFrame, centers: DataFrame, diameter: int) -> DataFrame:
    """Rows within half a diameter of a center, once for each center. centers: cell, pick, x_m, y_m. Centers are what is copied."""
    met = pairs_within(centers.select("cell", "pick", "x_m", "y_m"), df, diameter / 2, ("cell",))
    return met.select(*[F.col(f"o_{c}").alias(c) for c in df.columns], "pick")


def nonpicked(df: DataFrame, picked: DataFrame, keys: tuple[str, ...] = ("cell", "loc_id")) -> DataFrame:
    """J5."""
    return df.join(picked.select(*keys).distinct(), list(keys), "left_anti")


def subtract_drift(df: DataFrame, drift: DataFrame) -> DataFrame:
    """Drift: cell, frame, dx, dy. Rows of a frame without drift stay as they are."""
    moved = {"x_m": F.col("x_m") - F.coalesce("dx", F.lit(0)), "y_m": F.col("y_m") - F.coalesce("dy", F.lit(0))}
    return df.join(drift, ["cell", "frame"], "left").withColumns(moved).drop("dx", "dy")


def undrift_from_picked(picked: DataFrame, n_frames: int) -> DataFrame:
    """(cell, frame, dx, dy) for every frame. picked: cell, pick, frame, loc_id, x_m, y_m. A pick's mean is over all of its rows; of
    rows that share pick and frame the one with the greatest loc_id tells the offset in that frame. A pick weighs, in each coordinate, by its
    mean square deviation from the mean over picks in that coordinate."""
    rows = picked.groupBy("cell", "pick", "frame").agg(F.max_by("x_m", "loc_id").alias("x"), F.max_by("y_m", "loc_id").alias("y"))
    means = picked.groupBy("cell", "pick").agg(F.avg("x_m").alias("mx"), F.avg("y_m").alias("my"))
    off = cut(rows.join(means, ["cell", "pick"]).select("cell", "pick", "frame", (F.col("x") - F.col("mx")).alias("ox"), (F.col("y") - F.col("my")).alias("oy")))
    first = off.groupBy("cell", "frame").agg(F.avg("ox").alias("ax"), F.avg("oy").alias("ay"))
    msd = [F.greatest(F.avg(F.pow(F.col(f"o{c}") - F.col(f"a{c}"), F.lit(2.0))), F.lit(1e-12)) for c in "xy"]
    weights = off.join(first, ["cell", "frame"]).groupBy("cell", "pick").agg(*[(F.lit(1.0) / m).alias(f"w{c}") for m, c in zip(msd, "xy", strict=True)])
    mean = [(F.sum(F.col(f"o{c}") * F.col(f"w{c}")) / F.sum(f"w{c}")).alias(f"d{c}") for c in "xy"]
    known = off.join(weights, ["cell", "pick"]).groupBy("cell", "frame").agg(*mean)
    spine = picked.select("cell").distinct().crossJoin(picked.sparkSession.range(n_frames).select(F.col("id").alias("frame")))
    return interpolate(spine.join(known, ["cell", "frame"], "left"), ["cell"], "frame", "dx", "dy")


def find_gold(df: DataFrame, n_frames: int, diameter: int = 2000, std_range: float = 1.4, share: float = 0.25, rmsd: tuple[float, float] = (0.0, 400.0)) -> DataFrame:
    """(cell, pick, x_m, y_m, n): centers of beads. Candidates come from occupied places of a hexagonal grid only."""
    dy = diameter / 2
    dx = math.sqrt(3) / 2 * diameter
    col = F.round(F.col("x_m") / F.lit(dx)).cast("long")
    shift = F.when(F.pmod(col, F.lit(2)) == 1, F.lit(dy)).otherwise(F.lit(0.0))
    row = F.round((F.col("y_m") - shift) / F.lit(float(diameter))).cast("long")
    places = df.select("cell", col.alias("c"), row.alias("r"), shift.alias("s")).distinct()
    centers = places.select("cell", (F.col("c") * 1_000_003 + F.col("r")).alias("pick"), (F.col("c") * F.lit(dx)).alias("x_m"), (F.col("r") * F.lit(float(diameter)) + F.col("s")).alias("y_m"))
    rows = df.select("cell", "loc_id", "x_m", "y_m")
    for _ in range(2):  # to the center of mass once, then counted again
        own = picked_locs(rows, centers, diameter).groupBy("cell", "pick").agg(F.avg("x_m").alias("mx"), F.avg("y_m").alias("my"), F.count("*").alias("n"), F.sqrt(F.var_pop("x_m") + F.var_pop("y_m")).alias("rmsd"))
        centers = cut(own.select("cell", "pick", F.col("mx").alias("x_m"), F.col("my").alias("y_m"), "n", "rmsd"))
    good = centers.where(F.col("n").between(n_frames * (1 - share * std_range), n_frames * (1 + share * std_range)) & F.col("rmsd").between(*rmsd))
    # of centers closer than a diameter the one with most rows stays
    met = pairs_within(good, good, diameter, ("cell",)).where("pick <> o_pick")
    beaten = met.where("o_n > n or (o_n = n and o_pick < pick)").select("cell", "pick").distinct()
    return good.join(beaten, ["cell", "pick"], "left_anti").select("cell", "pick", "x_m", "y_m", "n")


def split_gold(df: DataFrame, gold: DataFrame, diameter: int = 2500, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """(rows of gold with pick, all other rows): picks are wider than the search. Cells with fewer than `least` have no gold."""
    enough = gold.groupBy("cell").agg(F.count("*").alias("k")).where(F.col("k") >= least).select("cell")
    picked = cut(picked_locs(df, gold.join(enough, "cell", "left_semi"), diameter))
    return picked, nonpicked(df, picked)


def _bins(bin_: int) -> list:
    return [F.floor(F.col("x_m") / bin_).alias("gx"), F.floor(F.col("y_m") / bin_).alias("gy")]


def _overlaid(a: DataFrame, b: DataFrame, reach: int, keys: tuple[str, ...]) -> DataFrame:
    """Rows of two images (gx, gy and others; o_ before the columns of b) at most `reach` bins apart in each coordinate, with dx, dy: by how
    much a is moved to lie on b. A row is copied to the few grid cells around it, never to the offsets."""
    met = pairs_within(a, b, reach * math.sqrt(2) * (1 + 1e-9), keys, ("gx", "gy")).withColumns({"dx": F.col("o_gx") - F.col("gx"), "dy": F.col("o_gy") - F.col("gy")})
    return met.where(F.col("dx").between(-reach, reach) & F.col("dy").between(-reach, reach)).withColumns({c: F.col(c).cast("int") for c in ("dx", "dy")})


def correlation(df: DataFrame, part: str, bin_: int, reach: int, keys: tuple[str, ...] = ("cell",), consecutive: bool = False) -> DataFrame:
    """(keys, i, j, dx, dy, corr) of the images of parts i < j: sum of products at each offset (in bins)."""
    img = df.groupBy(*keys, part, *_bins(bin_)).agg(F.count("*").alias("n"))
    if consecutive:  # part i meets i + 1 only: it is a key
        met = _overlaid(img.withColumn("__part", F.col(part) + 1), img.withColumn("__part", F.col(part)), reach, (*keys, "__part"))
    else:
        met = _overlaid(img, img, reach, keys).where(F.col(part) < F.col(f"o_{part}"))
    return met.groupBy(*keys, F.col(part).alias("i"), F.col(f"o_{part}").alias("j"), "dx", "dy").agg(F.sum(F.col("n") * F.col("o_n")).alias("corr"))


def peaks(corr: DataFrame, bin_: int, keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """(keys, i, j, sx, sy): offset of the greatest correlation, with a three-point parabola along each axis, in milli-pixels."""
    d2 = F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")
    top = corr.groupBy(*keys, "i", "j").agg(F.max_by(F.struct("dx", "dy", "corr"), F.struct("corr", -d2, -F.col("dx"), -F.col("dy"))).alias("p"))
    top = top.select(*keys, "i", "j", F.col("p.dx").alias("px"), F.col("p.dy").alias("py"), F.col("p.corr").alias("c0"))
    near = corr.join(top, [*keys, "i", "j"])
    at = lambda x, y: F.coalesce(F.max(F.when((F.col("dx") == F.col("px") + x) & (F.col("dy") == F.col("py") + y), F.col("corr"))), F.lit(0))
    got = near.groupBy(*keys, "i", "j", "px", "py", "c0").agg(at(-1, 0).alias("l"), at(1, 0).alias("r"), at(0, -1).alias("d"), at(0, 1).alias("u"))
    bend = lambda a, b: F.coalesce(F.lit(0.5) * (F.col(a) - F.col(b)) / F.nullif((F.col(a) - 2 * F.col("c0") + F.col(b)).cast("double"), F.lit(0.0)), F.lit(0.0))
    return got.select(*keys, "i", "j", ((F.col("px") + bend("l", "r")) * bin_).alias("sx"), ((F.col("py") + bend("d", "u")) * bin_).alias("sy"))


def undrift_rcc(df: DataFrame, n_frames: int, segmentation: int, bin_: int = 100, reach: int = 8, tries: int = 3) -> DataFrame:
    """(cell, frame, dx, dy). Shifts of segments by least squares over the pairs that overlap, anchored at the first, linear between mid frames.

    A cell whose overlapping segments do not hang together doubles its segmentation, at most `tries` times, on its own. What then still has
    no link to the greatest connected part keeps its data: drift 0 in all frames of those segments, which take no part in the interpolation.
    """
    parts, open_ = [], df
    for k in range(tries + 1):
        step = segmentation * 2**k
        seg = open_.withColumn("seg", F.floor(F.col("frame") / step))
        pairs = peaks(correlation(seg, "seg", bin_, reach), bin_).select("cell", "i", "j", "sx", "sy")
        here = seg.groupBy("cell", "seg").agg(F.count("*").alias("n")).select("cell", F.col("seg").alias("i"), F.col("seg").alias("j"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))
        solved = pairs.unionByName(here).groupBy("cell").applyInPandas(_least_squares, "cell long, seg long, dx double, dy double, linked boolean, whole boolean")
        solved = cut(solved.withColumn("step", F.lit(step).cast("long")))
        last = k == tries or step >= n_frames
        parts.append(solved if last else solved.where("whole"))
        torn = solved.where("not whole").select("cell").distinct()
        if last or torn.limit(1).count() == 0:
            break
        open_ = open_.join(small(torn), "cell", "left_semi")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    spine = df.select("cell").distinct().crossJoin(df.sparkSession.range(n_frames).select(F.col("id").alias("frame")))
    mean = every.where("linked").select("cell", (F.col("seg") * F.col("step") + F.floor(F.col("step") / 2)).alias("frame"), "dx", "dy")
    full = interpolate(spine.join(mean, ["cell", "frame"], "left"), ["cell"], "frame", "dx", "dy")
    steps = every.groupBy("cell").agg(F.max("step").alias("step"))
    alone = every.where("not linked").select("cell", "seg", F.lit(True).alias("alone"))
    full = full.join(steps, "cell").withColumn("seg", F.floor(F.col("frame") / F.col("step"))).join(alone, ["cell", "seg"], "left")
    return full.select("cell", "frame", *[F.when(F.col("alone"), F.lit(0.0)).otherwise(F.coalesce(c, F.lit(0.0))).alias(c) for c in ("dx", "dy")])


def _least_squares(pairs: pd.DataFrame) -> pd.DataFrame:
    """Shifts of one cell's segments from x_j - x_i = s over its pairs (pairs of a segment with itself only name it): one row a segment, of which
    there are n_frames / segmentation. The greatest part of linked segments is anchored at its first; others have no shift."""
    seg, at = np.unique(pairs[["i", "j"]].to_numpy(), return_inverse=True)
    i, j = at.reshape(-1, 2).T
    part = np.arange(len(seg))
    while True:  # least number along the links
        low = part.copy()
        np.minimum.at(low, i, part[j])
        np.minimum.at(low, j, part[i])
        if (low == part).all():
            break
        part = low
    name, size = np.unique(part, return_counts=True)
    linked = part == name[np.argmax(size)]
    use = linked[i] & (i != j)
    laplacian, moved = np.zeros((len(seg), len(seg))), np.zeros((len(seg), 2))
    for sign, here, there in ((1, j[use], i[use]), (-1, i[use], j[use])):
        np.add.at(laplacian, (here, here), 1.0)
        np.add.at(laplacian, (here, there), -1.0)
        np.add.at(moved, here, sign * pairs[["sx", "sy"]].to_numpy()[use])
    shift = np.zeros((len(seg), 2))
    shift[linked] = np.linalg.lstsq(laplacian[np.ix_(linked, linked)], moved[linked], rcond=None)[0]
    shift[linked] -= shift[np.flatnonzero(linked)[0]]
    return pd.DataFrame({"cell": pairs["cell"].iloc[0], "seg": seg, "dx": shift[:, 0], "dy": shift[:, 1], "linked": linked, "whole": linked.all()})


def undrift_aim(df: DataFrame, n_frames: int, segmentation: int, intersect: int = 150, roi: int = 450) -> DataFrame:
    """D3: (cell, frame, dx, dy) by intersection counts. Round 1: neighbouring segments and a running sum; round 2: each segment against
    the occupied places of all corrected segments, which keeps errors from adding up."""
    seg = df.withColumn("seg", F.floor(F.col("frame") / segmentation))
    reach = max(1, roi // intersect)
    step = cut(peaks(correlation(_occupied(seg, intersect, "seg"), "seg", intersect, reach, consecutive=True), intersect))
    w = Window.partitionBy("cell").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    middle = lambda c: (F.col(c) * segmentation + segmentation // 2).alias("frame")
    known = step.select("cell", middle("j"), F.sum("sx").over(w).alias("dx"), F.sum("sy").over(w).alias("dy"))
    first = df.select("cell").distinct().select("cell", F.lit(segmentation // 2).cast("long").alias("frame"), F.lit(0.0).alias("dx"), F.lit(0.0).alias("dy"))
    spine = df.select("cell").distinct().crossJoin(df.sparkSession.range(n_frames).select(F.col("id").alias("frame")))
    one = cut(interpolate(spine.join(first.unionByName(known), ["cell", "frame"], "left"), ["cell"], "frame", "dx", "dy"))
    right = subtract_drift(seg, one)
    # how often a place is occupied by corrected segments: segment s lies where (dx, dy) brings it onto most of these
    own = cut(_occupied(right, intersect, "seg"))
    every = own.groupBy("cell", "x_m", "y_m").agg(F.count("*").alias("weight"))
    met = _overlaid(own.select("cell", F.col("seg").alias("i"), *_bins(intersect)), every.select("cell", F.col("weight").alias("nb"), *_bins(intersect)), reach, ("cell",))
    corr = met.groupBy("cell", "i", F.lit(0).alias("j"), "dx", "dy").agg(F.sum("o_nb").alias("corr"))
    rest = peaks(corr, intersect).select("cell", middle("i"), (-F.col("sx")).alias("rx"), (-F.col("sy")).alias("ry"))
    both = interpolate(one.join(rest, ["cell", "frame"], "left"), ["cell"], "frame", "rx", "ry")
    return both.select("cell", "frame", (F.col("dx") + F.coalesce("rx", F.lit(0.0))).alias("dx"), (F.col("dy") + F.coalesce("ry", F.lit(0.0))).alias("dy"))


def _occupied(df: DataFrame, side: int, *keys: str) -> DataFrame:
    """Distinct places of that side."""
    return df.select("cell", *keys, *[(F.floor(F.col(c) / side) * side).alias(c) for c in ("x_m", "y_m")]).distinct()


def align_channels(df: DataFrame, bin_: int = 100, reach: int = 8, max_iter: int = 5, convergence: float = 1.0, fiducials: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(aligned rows, shifts: cell, channel, iteration, sx, sy, cum_sx, cum_sy). Stops when all shifts are within the convergence.

    fiducials: rows (cell, channel, x_m, y_m) that tell the shifts; df then follows them by the final sums.
    """
    shifts, rows = None, df if fiducials is None else fiducials
    for it in range(max_iter):
        pairs = peaks(correlation(rows, "channel", bin_, reach), bin_)
        back = pairs.select("cell", F.col("i").alias("channel"), (-F.col("sx")).alias("sx"), (-F.col("sy")).alias("sy"))
        both = pairs.select("cell", F.col("j").alias("channel"), "sx", "sy").unionByName(back)
        n = rows.groupBy("cell").agg(F.count_distinct("channel").alias("k"))
        one = both.groupBy("cell", "channel").agg(F.sum("sx").alias("tx"), F.sum("sy").alias("ty")).join(n, "cell")
        whole = [F.round(F.col(t) / F.col("k")).cast("long").alias(s) for t, s in (("tx", "sx"), ("ty", "sy"))]
        one = cut(one.select("cell", "channel", F.lit(it).alias("iteration"), *whole))
        shifts = one if shifts is None else shifts.unionByName(one)
        rows = cut(_moved(rows, one.select("cell", "channel", F.col("sx").alias("mx"), F.col("sy").alias("my"))))
        if one.where(F.abs("sx") + F.abs("sy") > convergence).limit(1).count() == 0:
            break
    w = Window.partitionBy("cell", "channel").orderBy("iteration").rowsBetween(Window.unboundedPreceding, 0)
    if fiducials is not None:
        rows = _moved(df, shifts.groupBy("cell", "channel").agg(F.sum("sx").alias("mx"), F.sum("sy").alias("my")))
    return rows, shifts.withColumns({"cum_sx": F.sum("sx").over(w), "cum_sy": F.sum("sy").over(w)})


def _moved(rows: DataFrame, move: DataFrame) -> DataFrame:
    """rows less mx, my of their cell and channel."""
    moved = {"x_m": F.col("x_m") - F.coalesce("mx", F.lit(0)), "y_m": F.col("y_m") - F.coalesce("my", F.lit(0))}
    return rows.join(move, ["cell", "channel"], "left").withColumns(moved).drop("mx", "my")


def nena(distances: DataFrame, most: float, bins: int = 50) -> tuple[float, float]:
    """(precision, amplitude) from the histogram of next-frame distances: only the bins reach the driver.

    Model: a d / (2 s^2) exp(-d^2 / (4 s^2)) plus a normal bump; damped Gauss-Newton.
    """
    step = most / bins
    got = {r["bin"]: r["n"] for r in distances.where(F.col("d") < most).groupBy(F.floor(F.col("d") / step).cast("int").alias("bin")).agg(F.count("*").alias("n")).collect()}
    d = (np.arange(bins) + 0.5) * step
    y = np.array([got.get(k, 0) for k in range(bins)], float)

    def model(p: np.ndarray) -> np.ndarray:
        a, s, ac, dc, sc = p
        return a * d / (2 * s * s) * np.exp(-d * d / (4 * s * s)) + ac * np.exp(-((d - dc) ** 2) / (2 * sc * sc)) / np.sqrt(2 * np.pi * sc * sc)

    p = np.array([y.sum() * step, d[np.argmax(y)] / math.sqrt(2) + step / 2, y.mean() * most / 2, most * 0.7, most / 3])
    damp = 1e-2
    for _ in range(200):
        f = model(p)
        jac = np.stack([(model(p + e) - f) / e[k] for k in range(5) for e in [np.eye(5)[k] * max(abs(p[k]) * 1e-5, 1e-8)]], axis=1)
        a = jac.T @ jac
        move = np.linalg.lstsq(a + damp * np.diag(np.diag(a) + 1e-12), jac.T @ (y - f), rcond=None)[0]
        if ((y - model(p + move)) ** 2).sum() < ((y - f) ** 2).sum():
            p, damp = p + move, damp / 3
        else:
            damp *= 4
        if damp > 1e12:
            break
    return float(abs(p[1])), float(p[0])


def colocalized_pairs(df: DataFrame, distance: int) -> DataFrame:
    """For channels a < b: mutual nearest neighbours within the distance are dimers. -> cell, a, b, n_a, n_b, n_ab (singles and dimers)."""
    p = df.select("loc_id", "cell", "channel", "x_m", "y_m")
    met = pairs_within(p, p, distance, ("cell",)).where("channel <> o_channel")
    best = cut(met.groupBy("cell", "loc_id", "channel", "o_channel").agg(F.min_by("o_loc_id", F.struct("d2", "o_loc_id")).alias("o_loc_id")))
    back = best.select("cell", F.col("loc_id").alias("o_loc_id"), F.col("channel").alias("o_channel"), F.col("o_channel").alias("channel"), F.col("o_loc_id").alias("loc_id"))
    dimers = best.join(back, ["cell", "loc_id", "channel", "o_loc_id", "o_channel"]).where("channel < o_channel").groupBy("cell", F.col("channel").alias("a"), F.col("o_channel").alias("b")).agg(F.count("*").alias("n_ab"))
    n = p.groupBy("cell", "channel").agg(F.count("*").alias("n"))
    both = n.toDF("cell", "a", "na").join(n.toDF("cell", "b", "nb"), "cell").where("a < b")
    full = both.join(dimers, ["cell", "a", "b"], "left").fillna(0, ["n_ab"])
    return full.select("cell", "a", "b", (F.col("na") - F.col("n_ab")).alias("n_a"), (F.col("nb") - F.col("n_ab")).alias("n_b"), "n_ab")


def labeling_efficiency(pairs: DataFrame) -> DataFrame:
    """of the first and of the second channel."""
    safe = lambda x: F.col("n_ab") / F.nullif(F.col("n_ab") + F.col(x), F.lit(0))
    return pairs.withColumns({"le_b": safe("n_a"), "le_a": safe("n_b")})


def direct_interaction(shares: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """F8: shares: keys, tag_a, tag_b, a, aa, b, bb, ab, aabb -> keys, from_tag, to_tag, percent interacting, in both directions."""
    pct = lambda x, y: F.lit(100.0) * x / F.nullif(y, F.lit(0.0))
    own = F.col("tag_a") == F.col("tag_b")
    c = F.col
    fwd = shares.select(*keys, c("tag_a").alias("from_tag"), c("tag_b").alias("to_tag"), F.when(own, pct(2 * c("aa"), c("a") + 2 * c("aa"))).otherwise(pct(c("ab") + 2 * c("aabb"), c("a") + 2 * c("aa") + c("ab") + 2 * c("aabb"))).alias("percent"))
    rev = shares.where(~own).select(*keys, c("tag_b").alias("from_tag"), c("tag_a").alias("to_tag"), pct(c("ab") + 2 * c("aabb"), c("b") + 2 * c("bb") + c("ab") + 2 * c("aabb")).alias("percent"))
    return fwd.unionByName(rev)


def target_fractions(df: DataFrame, n_simulate: int, density: float) -> DataFrame:
    """By tag: n, share, simulated number; width of a field with the density."""
    n = df.groupBy("tag").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())  # a row for each tag
    return n.select("tag", "n", share.alias("share"), (share * n_simulate).alias("n_simulated"), F.lit(math.sqrt(n_simulate / density)).alias("width"))


def expected_nn_peak(densities: DataFrame, d: int = 2) -> DataFrame:
    """peak of the nearest-neighbour distance, bin width and range for a density."""
    peak = F.pow(F.lit(2.0) / (F.lit(2.0 * d * math.pi) * F.nullif(F.col("density"), F.lit(0.0))), F.lit(1.0 / d))
    return densities.withColumn("peak", peak).withColumns({"bin": F.col("peak") / 3, "max": F.col("peak") * 20})


