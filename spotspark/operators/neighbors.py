"""Neighbour statistics on the grid join: pair counts, nearest neighbours, densities, links."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.grid import CROWD, pairs_within
from ..plans.pyramid import bucket, counted_pairs
from ..sources.io import cut, small
from .quantiles import quantiles


def _cumulative(counts: DataFrame, spine: DataFrame, radii: list[int], keys: list[str]) -> DataFrame:
    """counts: keys, bucket, n -> keys, r, pairs for every key of spine and every radius."""
    steps = F.array(*[F.struct(F.lit(k).alias("bucket"), F.lit(r).cast("long").alias("r")) for k, r in enumerate(radii)])
    full = spine.select(*keys, F.explode(steps).alias("s")).select(*keys, "s.bucket", "s.r")
    w = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return full.join(counts, [*keys, "bucket"], "left").select(*keys, "r", F.sum(F.coalesce("n", F.lit(0))).over(w).cast("long").alias("pairs"))


def pair_counts_self(df: DataFrame, radii: list[int], keys: tuple[str, ...] = ("cell",), dims: tuple[str, ...] = ("x_m", "y_m"), crowd: int = CROWD) -> DataFrame:
    """Ordered pairs (self excluded) within each radius. Crowded places are counted by nodes of a pyramid, others by pairs; either way
    distances become radius indices before the shuffle."""
    p = df.select("loc_id", *dims, *keys)
    counts = counted_pairs(p, radii, keys, None, dims, crowd=crowd).withColumn("n", F.col("n") * 2)
    return _cumulative(counts, p.select(*keys).distinct(), radii, list(keys))


def pair_counts_cross(df: DataFrame, radii: list[int], keys: tuple[str, ...] = ("cell",), dims: tuple[str, ...] = ("x_m", "y_m"), crowd: int = CROWD) -> DataFrame:
    """Ordered pairs within each radius for every pair of channels (a, b), equal channels without self pairs."""
    p = df.select("loc_id", *dims, "channel", *keys)
    one = counted_pairs(p, radii, keys, "channel", dims, crowd=crowd)
    both = F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = one.select(*keys, F.explode(both).alias("p"), "bucket", "n").groupBy(*keys, "p.a", "p.b", "bucket").agg(F.sum("n").alias("n"))
    own = p.select(*keys, F.col("channel").alias("a")).distinct()
    spine = own.join(p.select(*keys, F.col("channel").alias("b")).distinct(), list(keys))
    return _cumulative(counts, spine, radii, [*keys, "a", "b"])


#: Real points of a cell, and points of its controls, that one task holds.
CELL_ROWS, CONTROL_ROWS = 20_000, 200_000


def pair_counts_controls(controls: DataFrame, real: DataFrame, radii: list[int], repeats: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """J2 of controls (cell, control_id, channel, loc_id, x_m, y_m): self pairs within a control's channel, cross pairs of a control's
    channel a with the real b. -> cell, control_id, a, b, r, pairs. control_id runs from 0 to repeats - 1.

    A cell of up to cell_rows real points goes with as many of its controls as make CONTROL_ROWS points to one task, which sweeps them in
    the order of x. In larger cells own pairs are counted as in J1, and the real table is what is copied to neighbouring grid cells, once for all
    controls; control_id is no key of that join.
    """
    keys = ["cell", "control_id", "a", "b"]
    names = ["loc_id", "x_m", "y_m", "channel", "cell", "control_id"]
    c = controls.select(*names).toDF(*names)  # controls may come from real
    size = cut(real.groupBy("cell").agg(F.count("*").alias("n")))
    few = small(size.where(F.col("n") <= cell_rows).select("cell", F.greatest(F.lit(1), F.floor(F.lit(CONTROL_ROWS) / F.col("n"))).alias("each")))
    chunk = F.floor(F.col("control_id") / F.col("each")).alias("chunk")
    mine = c.join(few, "cell").select("cell", chunk, "control_id", "channel", F.col("x_m").alias("x"), F.col("y_m").alias("y"))
    mine = mine.toDF(*mine.columns)
    chunks = few.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.lit(repeats - 1) / F.col("each")))).alias("chunk"))
    theirs = real.join(chunks, "cell").select("cell", "chunk", "channel", F.col("x_m").alias("x"), F.col("y_m").alias("y"))
    out = mine.groupBy("cell", "chunk").cogroup(theirs.groupBy("cell", "chunk")).applyInPandas(_swept(radii), "cell long, control_id long, a int, b int, r long, pairs long")
    large = size.where(F.col("n") > cell_rows).select("cell")
    if large.isEmpty():
        return out
    big, theirs = cut(c.join(small(large), "cell")), real.join(small(large), "cell")
    own = counted_pairs(big, radii, ("cell", "control_id", "channel"), stretch=4)
    own = own.groupBy("cell", "control_id", F.col("channel").alias("a"), F.col("channel").alias("b"), "bucket").agg((F.sum("n") * 2).alias("n"))
    met = pairs_within(theirs.select("x_m", "y_m", "channel", "cell"), big, max(radii), ("cell",)).where("channel <> o_channel")
    met = met.groupBy("cell", F.col("o_control_id").alias("control_id"), F.col("o_channel").alias("a"), F.col("channel").alias("b"), bucket(F.col("d2"), radii).alias("bucket")).agg(F.count("*").alias("n"))
    spine = big.select("cell", "control_id", F.col("channel").alias("a")).distinct().join(theirs.select("cell", F.col("channel").alias("b")).distinct(), "cell")
    return out.unionByName(_cumulative(own.unionByName(met), spine, radii, keys))


def pair_counts_drawn(real: DataFrame, sizes: DataFrame, pixels: DataFrame, pixel: int, radii: list[int], repeats: int, hashed) -> DataFrame:
    """As pair_counts_controls, with k = area * pairs / Na^2, for the cells of sizes (cell, n) and random controls in their masks (cell, pixels).

    A task gets a cell's pixels and real points, draws as many of its controls as make CONTROL_ROWS points (hashed tells the places) and sweeps
    them: no control is ever shuffled.
    """
    few = sizes.select("cell", F.greatest(F.lit(1), F.floor(F.lit(CONTROL_ROWS) / F.col("n"))).cast("long").alias("each"))
    few = few.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.lit(repeats - 1) / F.col("each")))))
    seeds = few.join(pixels, "cell").select("cell", "chunk", "each", "pixels")
    theirs = real.join(few.select("cell", "chunk"), "cell").select("cell", "chunk", "channel", F.col("x_m").alias("x"), F.col("y_m").alias("y"))
    swept = _swept(radii)

    def run(seed: pd.DataFrame, real: pd.DataFrame) -> pd.DataFrame:
        names = ["cell", "control_id", "a", "b", "r", "pairs", "k"]
        if seed.empty or real.empty:
            return pd.DataFrame(columns=names)
        cell, chunk, each = (int(seed[c].iloc[0]) for c in ("cell", "chunk", "each"))
        controls, place = np.arange(chunk * each, min(repeats, (chunk + 1) * each)), np.asarray(seed["pixels"].iloc[0], np.int64)
        channel, n = np.unique(real["channel"].to_numpy(np.int64), return_counts=True)
        number = np.tile(np.concatenate([np.arange(k) for k in n]), len(controls))
        own, control = np.tile(np.repeat(channel, n), len(controls)), np.repeat(controls, n.sum())
        h2, h3 = hashed(number, control, cell, own, np.fmod)
        which, w = np.fmod(h2 // 7, len(place)), h3 // 7
        at = place[which]
        x = (at >> 32) * pixel + np.fmod(w, pixel)
        y = ((at & 0xFFFFFFFF) - (1 << 31)) * pixel + np.fmod(w // pixel, pixel)
        drawn = pd.DataFrame({"cell": cell, "control_id": control, "channel": own, "x": x, "y": y})[which >= 0]
        out = swept(drawn, real)
        na = n[np.searchsorted(channel, out["a"].to_numpy())]
        return out.assign(k=float(len(place)) * float(pixel * pixel) * out["pairs"].to_numpy() / (na * na))[names]

    seeds, theirs = seeds.toDF(*seeds.columns), theirs.toDF(*theirs.columns)  # both come from real
    return seeds.groupBy("cell", "chunk").cogroup(theirs.groupBy("cell", "chunk")).applyInPandas(run, "cell long, control_id long, a int, b int, r long, pairs long, k double")


def rings_jittered(real: DataFrame, sizes: DataFrame, radii: list[int], repeats: int, moved) -> DataFrame:
    """(cell, a, b, r, r2, pairs, n): for the cells of sizes (cell, n), the number n of jittered controls with so many ordered pairs of channels
    a and b farther than r and up to r2, the next radius. One row of a cell may stand for some of its controls only.

    A task gets a cell's real points, moves them itself (moved tells the places from loc_id, control_id, cell, x, y) and counts as many controls as make
    CONTROL_ROWS points in the order of x: no control is ever shuffled, and what leaves the task does not grow with their number of points.
    """
    few = sizes.select("cell", F.greatest(F.lit(1), F.floor(F.lit(CONTROL_ROWS) / F.col("n"))).cast("long").alias("each"))
    few = few.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.lit(repeats - 1) / F.col("each")))))
    rows = real.join(few, "cell").select("cell", "chunk", "each", "loc_id", "channel", F.col("x_m").alias("x"), F.col("y_m").alias("y"))
    steps, most, m = np.array(radii, np.int64) ** 2, max(radii), len(radii)

    def run(own: pd.DataFrame) -> pd.DataFrame:
        cell, chunk, each = (int(own[c].iloc[0]) for c in ("cell", "chunk", "each"))
        channel, ch = np.unique(own["channel"].to_numpy(np.int64), return_inverse=True)
        controls, c = np.arange(chunk * each, min(repeats, (chunk + 1) * each)), len(channel)
        control = np.repeat(np.arange(len(controls)), len(own))
        loc, x, y, ch = (np.tile(v, len(controls)) for v in (*(own[v].to_numpy(np.int64) for v in ("loc_id", "x", "y")), ch))
        x, y = moved(loc, controls[control], cell, x, y)
        order = np.lexsort((x, control))
        k, u, v, ch = control[order], x[order], y[order], ch[order]
        counts = np.zeros(len(controls) * c * c * m, np.int64)
        at, j = np.arange(len(k) - 1), 1
        while len(at):
            at = at[at + j < len(k)]
            at = at[(k[at] == k[at + j]) & (u[at + j] - u[at] <= most)]
            d2 = (u[at + j] - u[at]) ** 2 + (v[at + j] - v[at]) ** 2
            near = d2 <= steps[-1]
            one = at[near]
            counts += np.bincount(((k[one] * c + ch[one]) * c + ch[one + j]) * m + np.searchsorted(steps, d2[near]), minlength=len(counts))
            j += 1
        pairs = counts.reshape(len(controls), c, c, m)
        rings = (pairs + pairs.transpose(0, 2, 1, 3))[..., 1:].reshape(len(controls), -1)
        wide = int(rings.max()) + 1
        seen, n = np.unique(np.arange(rings.shape[1]) * wide + rings, return_counts=True)
        a, b, step = np.unravel_index(seen // wide, (c, c, m - 1))
        r = np.array(radii)
        return pd.DataFrame({"cell": cell, "a": channel[a], "b": channel[b], "r": r[step], "r2": r[step + 1], "pairs": seen % wide, "n": n})

    return rows.groupBy("cell", "chunk").applyInPandas(run, "cell long, a int, b int, r long, r2 long, pairs long, n long")


def _swept(radii: list[int]):
    """Counts of a cell's controls (control_id, channel, x, y) with themselves and with the real points (channel, x, y)."""
    steps, most = np.array(radii, np.int64) ** 2, max(radii)

    def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        names = ["cell", "control_id", "a", "b", "r", "pairs"]
        if mine.empty:
            return pd.DataFrame(columns=names)
        control, cn = np.unique(mine["control_id"].to_numpy(), return_inverse=True)
        channel, ch = np.unique(np.r_[mine["channel"].to_numpy(), theirs["channel"].to_numpy()], return_inverse=True)
        ch, other = ch[: len(mine)], ch[len(mine) :]
        kind, x, y = cn * len(channel) + ch, mine["x"].to_numpy(np.int64), mine["y"].to_numpy(np.int64)
        shape = (len(channel), len(control), len(channel), len(radii))
        counts = np.zeros(shape, np.int64).reshape(len(channel), -1)
        # own pairs: rows of one control and channel in the order of x, each with the j-th after it
        order = np.lexsort((x, kind))
        k, u, v = kind[order], x[order], y[order]
        own = np.zeros(len(control) * len(channel) * len(radii), np.int64)
        at = np.arange(len(k) - 1)
        j = 1
        while len(at):
            at = at[at + j < len(k)]
            at = at[(k[at] == k[at + j]) & (u[at + j] - u[at] <= most)]
            d2 = (u[at + j] - u[at]) ** 2 + (v[at + j] - v[at]) ** 2
            near = d2 <= steps[-1]
            own += np.bincount(k[at][near] * len(radii) + np.searchsorted(steps, d2[near]), minlength=len(own))
            j += 1
        # cross pairs: the slice of x around each real point
        order = np.argsort(x, kind="stable")
        u, v, k = x[order], y[order], kind[order] * len(radii)
        for b in np.unique(other).tolist():
            rx, ry = theirs["x"].to_numpy(np.int64)[other == b], theirs["y"].to_numpy(np.int64)[other == b]
            held, n = [], 0
            for lo, hi, px, py in zip(np.searchsorted(u, rx - most), np.searchsorted(u, rx + most, "right"), rx, ry, strict=True):
                d2 = (u[lo:hi] - px) ** 2 + (v[lo:hi] - py) ** 2
                near = np.flatnonzero(d2 <= steps[-1])
                held.append(k[lo:hi][near] + np.searchsorted(steps, d2[near]))
                n += len(near)
                if n > 1_000_000:
                    counts[b] += np.bincount(np.concatenate(held), minlength=counts.shape[1])
                    held, n = [], 0
            if held:
                counts[b] += np.bincount(np.concatenate(held), minlength=counts.shape[1])
        every = counts.reshape(shape)
        for b in range(len(channel)):
            every[b, :, b, :] = 2 * own.reshape(shape[1:])[:, b, :]
        upto = every.cumsum(axis=3)
        has = np.zeros((len(control), len(channel)), bool)
        has[cn, ch] = True
        c, a = np.nonzero(has)
        bs = np.unique(other)
        n, m = len(c) * len(bs), len(radii)
        wide = lambda v: np.repeat(np.repeat(v, len(bs)), m)
        each = np.repeat(np.tile(bs, len(c)), m)
        step = np.tile(np.arange(m), n)
        return pd.DataFrame({"cell": mine["cell"].iloc[0], "control_id": control[wide(c)], "a": channel[wide(a)], "b": channel[each], "r": np.array(radii)[step], "pairs": upto[each, wide(c), wide(a), step]})

    return run


def knn(df: DataFrame, k: int, keys: tuple[str, ...] = ("cell",), radius: int | None = None, dims: tuple[str, ...] = ("x_m", "y_m"), fine: int = 8) -> DataFrame:
    """(loc_id, keys, k, d): the k nearest others (ties by id); fewer rows where a cell has fewer points.

    A pyramid of counted grid cells tells each point the smallest cell around it with more than k points; k + 1 of these bound its k-th
    distance. Points search once, on the level whose side is above that bound, in coordinates scaled by the side; other points are
    copied to the levels on which someone near them searches: one join for all levels. radius: side of the smallest cells; where it is
    not given, a `fine`-th of one that holds k points at the mean density. Spark keeps the k least of each task before it shuffles.
    """
    d, keys = len(dims), list(keys)
    p = df.select("loc_id", *dims, *keys)
    seen = p.groupBy(*keys).agg(F.count("*").alias("n"), *[f(c).alias(f"{e}{i}") for i, c in enumerate(dims) for e, f in (("lo", F.min), ("hi", F.max))])
    seen = seen.agg(F.sum("n").alias("n"), F.count("*").alias("groups"), *[f(f"{e}{i}").alias(f"{e}{i}") for i in range(d) for e, f in (("lo", F.min), ("hi", F.max))]).first()
    if not seen["n"]:
        return p.select("loc_id", *keys, F.lit(1).alias("k"), F.lit(0.0).alias("d"))
    low = [seen[f"lo{i}"] for i in range(d)]
    width = max(max(seen[f"hi{i}"] - low[i] for i in range(d)), 1)
    side = float(radius or max(1.0, width * ((k + 1) * seen["groups"] / seen["n"]) ** (1 / d) / fine))
    top = max(0, math.ceil(math.log2((width + 1) / side)))
    at = [f"__f{i}" for i in range(d)]
    placed = p.withColumns({c: F.floor((F.col(x) - F.lit(lo)) / F.lit(side)).cast("long") for c, x, lo in zip(at, dims, low, strict=True)})
    # the smallest level whose cell around a finest cell holds more than k points; the greatest one holds all
    cells = cut(placed.groupBy(*keys, *at).agg(F.count("*").alias("n")))
    up = [f"__u{i}" for i in range(d)]
    each = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumns({u: F.expr(f"shiftright({c}, level)") for u, c in zip(up, at, strict=True)})
    full = each.groupBy(*keys, "level", *up).agg(F.sum("n").alias("held")).where((F.col("held") > k) | (F.col("level") == top))
    level = cut(each.join(full, [*keys, "level", *up]).groupBy(*keys, *at).agg(F.min("level").alias("level")))
    own = placed.join(small(level), [*keys, *at]).withColumns({u: F.expr(f"shiftright({c}, level)") for u, c in zip(up, at, strict=True)})
    own = cut(own.select("loc_id", *dims, *keys, "level", *up))
    # k + 1 points of each such cell bound the k-th distance of all points in it
    held = placed.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumns({u: F.expr(f"shiftright({c}, level)") for u, c in zip(up, at, strict=True)})
    held = held.join(small(cut(own.select(*keys, "level", *up).distinct())), [*keys, "level", *up], "left_semi")
    some = held.withColumn("at", F.row_number().over(Window.partitionBy(*keys, "level", *up).orderBy("loc_id"))).where(F.col("at") <= k + 1)
    d2 = lambda c: sum((F.col(x) - F.col(f"{c}{x}")) * (F.col(x) - F.col(f"{c}{x}")) for x in dims)
    some = own.join(some.select(*keys, "level", *up, *[F.col(x).alias(f"s_{x}") for x in ("loc_id", *dims)]), [*keys, "level", *up]).where("loc_id <> s_loc_id")
    most = some.groupBy("loc_id", *dims, *keys).agg(F.array_sort(F.collect_list(d2("s_").cast("double"))).alias("far"))
    most = most.withColumn("far", F.element_at("far", F.least(F.lit(k), F.size("far"))))
    own = cut(most.withColumn("level", F.when(F.col("far") > 0, F.greatest(F.lit(0), F.ceil(F.log2(F.sqrt("far") / F.lit(side)) - 1e-9)).cast("int")).otherwise(0)))
    reach = 1.0 + 1e-6
    scaled = lambda rows: rows.withColumns({f"__x{i}": (F.col(x) - F.lit(lo)) / (F.lit(side) * F.pow(F.lit(2.0), F.col("level"))) for i, (x, lo) in enumerate(zip(dims, low, strict=True))})
    place = [f"__x{i}" for i in range(d)]
    near = F.array(*[F.struct(*[F.lit(v).alias(f"s{i}") for i, v in enumerate(s)]) for s in itertools.product((-1, 0, 1), repeat=d)])
    grid = {u: F.floor(F.col(x) / F.lit(reach)) for u, x in zip(up, place, strict=True)}
    asked = scaled(own).withColumns(grid).select(*keys, "level", *up).distinct().withColumn("s", F.explode(near))
    asked = cut(asked.select(*keys, "level", *[(F.col(u) + F.col(f"s.s{i}")).alias(u) for i, u in enumerate(up)]).distinct())
    levels = own.select(*keys, "level").distinct()
    others = scaled(p.join(small(cut(levels)), keys)).withColumns(grid).join(small(asked), [*keys, "level", *up], "left_semi")
    met = pairs_within(scaled(own).select("loc_id", *dims, "far", *place, *keys, "level"), others.select("loc_id", *dims, *place, *keys, "level"), reach, (*keys, "level"), tuple(place))
    met = met.withColumn("d2", d2("o_")).where("loc_id <> o_loc_id AND d2 <= far")
    met = met.withColumn("k", F.row_number().over(Window.partitionBy("loc_id", *keys).orderBy("d2", "o_loc_id"))).where(f"k <= {k}")
    return met.select("loc_id", *keys, F.col("k").cast("int").alias("k"), F.sqrt(F.col("d2").cast("double")).alias("d"))


def local_density(df: DataFrame, radius: int, dims: tuple[str, ...] = ("x_m", "y_m")) -> DataFrame:
    """Points within the radius of each, itself counted."""
    p = df.select("loc_id", *dims, "cell")
    return pairs_within(p, p, radius, ("cell",), dims).groupBy("cell", "loc_id").agg(F.count("*").alias("n"))


def next_frame_neighbors(df: DataFrame, radius: int) -> DataFrame:
    """Distance to the nearest point of the next frame."""
    p = df.select("loc_id", "x_m", "y_m", "cell", "frame")
    q = p.withColumn("frame", F.col("frame") - 1)
    return pairs_within(p, q, radius, ("cell", "frame")).groupBy("cell", "loc_id").agg(F.sqrt(F.min("d2").cast("double")).alias("d"))


def link_edges(df: DataFrame, d_max: int, tolerance: int) -> DataFrame:
    """Edges (cell, a, b) between a point and its successor: mutual best within d_max and tolerance + 1 frames.

    An interval join: frames are dealt into buckets of tolerance + 1, so that the frames that may follow lie in two buckets, whatever the tolerance.
    """
    wide = tolerance + 1
    p = df.select("loc_id", "x_m", "y_m", "cell", "frame", F.floor(F.col("frame") / wide).alias("bucket"))
    twice = p.withColumn("bucket", F.explode(F.array("bucket", F.col("bucket") + 1)))
    met = pairs_within(twice, p, d_max, ("cell", "bucket")).where((F.col("o_frame") - F.col("frame")).between(1, wide))
    best = met.groupBy("cell", F.col("loc_id").alias("a"), F.col("frame").alias("fa")).agg(F.min(F.struct(F.col("o_frame").alias("fb"), "d2", F.col("o_loc_id").alias("b"))).alias("e"))
    best = best.select("cell", "a", "fa", F.col("e.b").alias("b"), F.col("e.d2").alias("d2"))
    return best.groupBy("cell", "b").agg(F.max_by("a", F.struct("fa", -F.col("d2"), -F.col("a"))).alias("a")).select("cell", "a", "b")


def link_locs(df: DataFrame, d_max: int, tolerance: int) -> DataFrame:
    """One row a track; chains are followed by pointer jumping (log rounds)."""
    edges = link_edges(df, d_max, tolerance)
    state = cut(df.select("cell", F.col("loc_id").alias("b")).join(edges, ["cell", "b"], "left").select("cell", F.col("b").alias("loc_id"), F.coalesce("a", "b").alias("head")))
    while True:
        up = state.select("cell", F.col("loc_id").alias("head"), F.col("head").alias("far"))
        state = cut(state.join(up, ["cell", "head"]).select("cell", "loc_id", F.col("head").alias("old"), F.col("far").alias("head")))
        if state.where("old <> head").limit(1).count() == 0:
            break
        state = state.drop("old")
    rows = df.join(state.select("cell", "loc_id", F.col("head").alias("track")), ["cell", "loc_id"])
    first, last = F.min("frame"), F.max("frame")
    means = [F.avg(c).alias(c) for c in ("sx_raw", "sy_raw", "bg", "lpx", "lpy") if c in df.columns]
    return rows.groupBy("cell", "track").agg(
        first.alias("frame"), last.alias("last_frame"), (last - first + 1).alias("len"), F.count("*").alias("n"),
        F.avg("x_m").alias("x"), F.avg("y_m").alias("y"), F.sum("photons").alias("photons"), *means,
    )


def nn_scales(near: DataFrame, nth: int) -> DataFrame:
    """From J3: median nearest distance, bin width, 95 % quantile of the nth distance."""
    nearest = quantiles(near.where("k = 1"), ["cell"], "d", [0.5]).select("cell", F.col("q")[0].alias("nn1"))
    far = quantiles(near.where(F.col("k") == nth), ["cell"], "d", [0.95]).select("cell", F.col("q")[0].alias("q95"))
    return nearest.join(far, "cell", "full").select("cell", "nn1", (F.col("nn1") / 20).alias("dr"), "q95")


def nn_histogram(near: DataFrame, step: float, most: float) -> DataFrame:
    """Counts by neighbour number and bin; the last bin is closed."""
    last = int(round(most / step)) - 1
    return near.where(F.col("d") <= most).groupBy("k", F.least(F.lit(last), F.floor(F.col("d") / step)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def nn_density_histogram(near: DataFrame, nth: int, bins: int = 49) -> DataFrame:
    """G21, normalised: by cell and k the density of distances in `bins` bins up to the 99 % quantile of the nth distance."""
    top = quantiles(near.where(F.col("k") == nth), ["cell"], "d", [0.99]).select("cell", F.col("q")[0].alias("top"))
    step = F.col("top") / F.lit(float(bins))
    inside = near.join(top, "cell").where((F.col("d") <= F.col("top")) & (F.col("top") > 0))
    n = inside.groupBy("cell", "k", "top", F.least(F.lit(bins - 1), F.floor(F.col("d") / step)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return n.select("cell", "k", "bin", (F.col("n") / (F.sum("n").over(Window.partitionBy("cell", "k")) * step)).alias("density"))


def csr_density_mle(near: DataFrame, d: int = 2, kmin: int = 1) -> DataFrame:
    """Density by maximum likelihood in closed form, within a factor of ten of the first estimate, from the distances of the kmin-th and
    later neighbours."""
    ball = math.pi ** (d / 2) / math.gamma(d / 2 + 1)
    nearest = quantiles(near.where("k = 1"), ["cell"], "d", [0.5]).select("cell", F.col("q")[0].alias("nn1"))
    init = F.lit(2.0) / (F.lit(2.0 * d * math.pi) * F.nullif(F.pow("nn1", F.lit(float(d))), F.lit(0.0)))
    rho = F.sum("k") / F.nullif(F.sum(F.pow("d", F.lit(float(d)))), F.lit(0.0)) / ball
    free = near.where(F.col("k") >= kmin).groupBy("cell").agg(rho.alias("free")).join(nearest, "cell", "left").withColumn("rho_init", init)
    return free.select("cell", "rho_init", F.greatest(F.col("rho_init") / 10, F.least(F.col("rho_init") * 10, F.col("free"))).alias("rho"))


def rdf(df: DataFrame, dr: int, r_max: int, keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """Ring densities and their median over the second half, by the keys."""
    radii = list(range(0, r_max + dr, dr))
    counts = pair_counts_self(df, radii, keys)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    before = F.lag("pairs").over(Window.partitionBy(*keys).orderBy("r"))
    ring = counts.withColumn("ring", F.col("pairs") - before).where("ring is not null").join(sizes, list(keys))
    ring = ring.select(*keys, "r", (F.col("ring") / F.col("n") / (F.lit(2 * math.pi) * F.col("r") * F.lit(dr))).alias("g"))
    half = radii[1:][(len(radii) - 1) // 2]
    return ring.withColumn("density", F.median(F.when(F.col("r") >= half, F.col("g"))).over(Window.partitionBy(*keys)))
