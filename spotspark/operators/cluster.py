"""Density clustering, local-maximum clustering, cluster shapes and composition."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..plans.grid import pairs_within
from ..plans.pyramid import OPEN, touching
from ..plans.subcells import clustered, groups, values, whole_datasets
from ..plans.trees import kth_nearest, spanning_tree
from ..sources.io import cut, numbered, small, small_count


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label): least id reachable over edges (a, b), both directions given. Each round hangs the label of every node's tree below the least label
    beside it, and shortens the way to it: about log2 of the longest way rounds."""
    edges = cut(edges.select("a", "b"))
    state = cut(nodes.select("id", F.col("id").alias("label")))
    while True:
        ends = edges.join(state.toDF("b", "lb"), "b").join(state.toDF("a", "la"), "a").where("lb < la")
        roots = ends.groupBy(F.col("la").alias("label")).agg(F.min("lb").alias("m"))
        low = state.join(roots, "label", "left").select("id", F.col("label").alias("old"), F.least("label", F.coalesce("m", "label")).alias("label"))
        jump = low.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = cut(low.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("far", "label")).alias("label")))
        state = new.select("id", "label")
        if new.where("old <> label").isEmpty():
            return state


#: Rows of a dataset that dbscan clusters in one task, which holds some hundred bytes a row and does not open the pairs of crowded places.
WHOLE = 250_000
#: Rows of a cell that hdbscan does in one task, at about 1 KB a row.
CONDENSED = 500_000


def dbscan(df: DataFrame, eps: int, minpts: int, dims: tuple[str, ...] = ("x_m", "y_m"), keys: tuple[str, ...] = ("cell",), whole: int = WHOLE) -> DataFrame:
    """Df with group (-1: noise). Distances include eps, a point counts itself; border points go to the least label.

    keys: datasets that are clustered side by side in one call, such as (origin, iter, cell) for data and all their controls (controls_beside);
    loc_id is unique within them, and groups are numbered within them by their least core loc_id.

    Datasets of up to `whole` rows are shuffled once, by their keys and with all columns of df (select those you need), and clustered many at a
    time in the tasks they come to; larger ones are clustered by joins of their sub-cells, for which no task holds a dataset.
    """
    large = cut(df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > whole).select(*keys))
    own = df
    if not large.isEmpty():
        large = small(large)
        own = df.join(large, list(keys), "left_anti").select(*df.columns)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([*df.schema.fields, StructField("group", IntegerType())])
    out = own.repartition(tasks, *keys).sortWithinPartitions(*keys).mapInArrow(clustered(keys, dims, eps, minpts), schema)
    return out if own is df else out.unionByName(_joined(df.join(large, list(keys), "left_semi").select(*df.columns), eps, minpts, dims, keys))


def _joined(df: DataFrame, eps: int, minpts: int, dims: tuple[str, ...], keys: tuple[str, ...]) -> DataFrame:
    """C1 by joins, for datasets of any size.

    Two points of one sub-cell of side eps / sqrt(dims) are within eps of each other. So all points of a sub-cell with minpts points are
    core without a count, and all core points of a sub-cell are one node. Two nodes are linked by a test of the boxes around their points,
    then of their quadrants, which ends at the first pair within eps: core points are not paired. Points of thin sub-cells (fewer than
    minpts of them in each) are the only ones that are met with their neighbours.
    """
    side = eps / math.sqrt(len(dims)) * (1 - 1e-9)
    sub = [f"__c{k}" for k in range(len(dims))]
    p = df.select("loc_id", *dims, *keys, *[F.floor(F.col(d) / F.lit(side)).alias(c) for c, d in zip(sub, dims, strict=True)])
    full = small(cut(p.groupBy(*keys, *sub).agg(F.count("*").alias("n")).where(F.col("n") >= minpts).select(*keys, *sub)))
    plain = p.select("loc_id", *dims, *keys)
    sparse = p.join(full, [*keys, *sub], "left_anti")
    thin = pairs_within(sparse.select("loc_id", *dims, *keys), plain, eps, keys, dims).groupBy(*keys, "loc_id").agg(F.count("*").alias("n")).where(F.col("n") >= minpts)
    core = cut(p.join(full, [*keys, *sub], "left_semi").unionByName(sparse.join(thin.select(*keys, "loc_id"), [*keys, "loc_id"], "left_semi")))
    box = [f(d).alias(f"{e}{k}") for k, d in enumerate(dims) for e, f in (("lo", F.min), ("hi", F.max))]
    nodes = core.groupBy(*keys, *sub).agg(F.min("loc_id").alias("first"), F.count("*").alias("n"), *box)
    nodes = cut(nodes.withColumn("id", F.monotonically_increasing_id()))
    links = _links(core, _near_nodes(nodes, eps, len(dims), keys, sub), eps, side, keys, dims, sub)
    label = components(nodes.select("id"), links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    named = nodes.join(label, "id")
    least = named.groupBy("label").agg(F.min("first").alias("name"))
    named = cut(named.join(least, "label").select(*keys, *sub, "name"))
    labelled = core.join(small(named), [*keys, *sub]).select("loc_id", *dims, *keys, "name")
    rest = sparse.join(thin.select(*keys, "loc_id"), [*keys, "loc_id"], "left_anti").select("loc_id", *dims, *keys)
    border = pairs_within(rest, labelled, eps, keys, dims).groupBy("loc_id", *keys).agg(F.min("o_name").alias("name"))
    groups = cut(labelled.select("loc_id", *keys, "name").unionByName(border))
    names = named.select(*keys, "name").distinct()
    if small_count(names):
        numbers = names.withColumn("group", F.row_number().over(Window.partitionBy(*keys).orderBy("name")) - 1)
    else:
        numbers = numbered(names, list(keys), ["name"], "group")
    found = groups.join(small(numbers), [*keys, "name"]).select("loc_id", *keys, F.col("group").cast("int").alias("group"))
    return df.join(found, [*keys, "loc_id"], "left").select(*df.columns, F.coalesce("group", F.lit(-1)).alias("group"))


def _near_nodes(nodes: DataFrame, eps: int, d: int, keys: tuple[str, ...], sub: list[str]) -> DataFrame:
    """Pairs of sub-cells with core points whose boxes are within eps, each once: keys, a0 .., b0 .. (sub-cells), a, b (ids), pairs (of points),
    sure (all of which are within eps), link (number of the pair)."""
    reach = math.ceil(math.sqrt(d))
    steps = [s for s in itertools.product(range(-reach, reach + 1), repeat=d) if s > (0,) * d]
    around = F.array(*[F.struct(*[F.lit(v).alias(f"s{k}") for k, v in enumerate(s)]) for s in steps])
    named = lambda x: [F.col("id").alias(x), F.col("n").alias(f"{x}_n"), *[F.col(c).alias(f"{x}{k}") for k, c in enumerate(sub)], *[F.col(f"{e}{k}").alias(f"{x}_{e}{k}") for k in range(d) for e in ("lo", "hi")]]
    one = nodes.select(*keys, *named("a"), F.explode(around).alias("s")).withColumns({f"b{k}": F.col(f"a{k}") + F.col(f"s.s{k}") for k in range(d)}).drop("s")
    square = lambda f: sum((F.pow(f(k), F.lit(2.0)) for k in range(d)), F.lit(0.0))
    gap = square(lambda k: F.greatest(F.col(f"a_lo{k}") - F.col(f"b_hi{k}"), F.col(f"b_lo{k}") - F.col(f"a_hi{k}"), F.lit(0)))
    most = square(lambda k: F.greatest(F.col(f"a_hi{k}") - F.col(f"b_lo{k}"), F.col(f"b_hi{k}") - F.col(f"a_lo{k}")))
    met = one.join(nodes.select(*keys, *named("b")), [*keys, *[f"b{k}" for k in range(d)]]).where(gap <= eps * eps)
    return cut(met.select(*keys, *[f"{s}{k}" for s in "ab" for k in range(d)], "a", "b", (F.col("a_n") * F.col("b_n")).alias("pairs"), (most <= eps * eps).alias("sure"), F.monotonically_increasing_id().alias("link")))


def _links(core: DataFrame, near: DataFrame, eps: int, side: float, keys: tuple[str, ...], dims: tuple[str, ...], sub: list[str]) -> DataFrame:
    """(a, b), saved: pairs of near sub-cells that hold core points within eps. Pairs of boxes within eps throughout need no look at points; few
    pairs of points are opened; others are told by their quadrants."""
    d = range(len(dims))
    few = near.where(~F.col("sure") & (F.col("pairs") <= OPEN))
    points = core.select(*keys, *dims, *sub)
    one = few.join(points.withColumnsRenamed({c: f"a{k}" for k, c in enumerate(sub)}), [*keys, *[f"a{k}" for k in d]])
    other = points.select(*keys, *[F.col(c).alias(f"b{k}") for k, c in enumerate(sub)], *[F.col(c).alias(f"o_{c}") for c in dims])
    d2 = sum(((F.col(c) - F.col(f"o_{c}")) * (F.col(c) - F.col(f"o_{c}")) for c in dims), F.lit(0))
    links = near.where("sure").select("a", "b").unionByName(one.join(other, [*keys, *[f"b{k}" for k in d]]).where(d2 <= eps * eps).select("a", "b").distinct())
    many = near.where(~F.col("sure") & (F.col("pairs") > OPEN))
    if not many.isEmpty():
        found = touching(core, many.withColumn("id", F.col("link")), eps, side, keys, dims)
        links = links.unionByName(many.join(found.withColumnRenamed("id", "link"), "link").select("a", "b"))
    return cut(links)


def controls_beside(df: DataFrame, controls: DataFrame) -> DataFrame:
    """Data and their controls as one table for a keyed call of dbscan: origin (exp, csr), iter (0 for data, else control_id), cell, loc_id,
    channel, tag, x_m, y_m. controls: cell, channel, control_id, loc_id (from 0 by channel), x_m, y_m; the loc_id of a control is made unique in it."""
    tags = small(df.select("channel", "tag").distinct())
    one = df.select(F.lit("exp").alias("origin"), F.lit(0).cast("long").alias("iter"), "cell", "loc_id", "channel", "tag", "x_m", "y_m")
    number = (F.col("channel").cast("long") * (1 << 40) + F.col("loc_id")).alias("loc_id")
    other = controls.join(tags, "channel").select(F.lit("csr").alias("origin"), F.col("control_id").alias("iter"), "cell", number, "channel", "tag", "x_m", "y_m")
    return one.unionByName(other)


def smlm_cluster(df: DataFrame, radius: int, min_locs: int, basic_fa: bool = False, n_frames: int | None = None, radius_z: int | None = None, z: str = "z_nm") -> DataFrame:
    """(loc_id, cell, peak): each point joins its nearest local maximum of the neighbour count within the radius.

    radius_z: neighbours are within an ellipsoid. basic_fa (needs n_frames): clusters stay whose mean frame is within 20 to 80 % of the
    frames and no twentieth of them has more than 80 % of the cluster.
    """
    p = df.select("loc_id", "x_m", "y_m", "cell", *([z] if radius_z else []))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        out = pairs_within(left, right, radius, ("cell",))
        if not radius_z:
            return out
        dz = F.col(z) - F.col(f"o_{z}")
        # squared distances are compared as whole numbers of 1 / (radius_z ** 2)
        return out.withColumn("d2", F.col("d2") * radius_z * radius_z + dz * dz * radius * radius).where(F.col("d2") <= radius * radius * radius_z * radius_z)

    # pairs are met again rather than written: each time they end in a partial aggregate
    count = met(p, p).groupBy("loc_id").agg(F.count("*").alias("n"))
    counted = cut(p.join(count, "loc_id"))
    # one flag a point: the greatest struct of its neighbours would be a sort of all pairs before they are aggregated
    beaten = (F.col("o_n") > F.col("n")) | ((F.col("o_n") == F.col("n")) & (F.col("o_loc_id") < F.col("loc_id")))
    best = met(counted, counted).groupBy("loc_id").agg(F.max(beaten).alias("beaten"))
    peaks = cut(best.where(~F.col("beaten")).select("loc_id"))
    joined = met(p.join(peaks, "loc_id"), p).groupBy("cell", F.col("o_loc_id").alias("loc_id")).agg(F.min_by("loc_id", F.struct("d2", "loc_id")).alias("peak"))
    if not basic_fa:
        many = joined.groupBy("peak").agg(F.count("*").alias("n")).where(F.col("n") >= min_locs).select("peak")
        return joined.join(many, "peak").select("loc_id", "cell", "peak")
    joined = cut(joined)
    framed = joined.join(df.select("loc_id", "frame"), "loc_id")
    part = framed.groupBy("peak", F.floor(F.col("frame") * 20 / n_frames).alias("part")).agg(F.count("*").alias("n"), F.sum("frame").alias("frames"))
    whole = part.groupBy("peak").agg(F.sum("n").alias("n"), F.max("n").alias("most"), (F.sum("frames") / F.sum("n")).alias("mean"))
    good = whole.where((F.col("n") >= min_locs) & F.col("mean").between(0.2 * n_frames, 0.8 * n_frames) & (F.col("most") <= 0.8 * F.col("n")))
    return joined.join(good.select("peak"), "peak").select("loc_id", "cell", "peak")


def condensed_clusters(n: int, edges: Iterable[tuple[float, int, int]], least: int) -> np.ndarray:
    """Labels by excess of mass of the condensed tree; -1 is noise. Merges are undone from the widest edge down."""
    parent, tree = list(range(n)), []

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    kids: dict[int, tuple[int, int, float]] = {}
    name = list(range(n))
    size = [1] * n
    for w, a, b in edges:
        a, b = root(a), root(b)
        new = len(size)
        kids[new] = (name[a], name[b], w)
        size.append(size[name[a]] + size[name[b]])
        parent[b] = a
        name[a] = new
        tree.append(new)
    labels = np.full(n, -1)
    if n < least or not tree:
        return labels

    def leaves(node: int) -> list[int]:
        out, stack = [], [node]
        while stack:
            k = stack.pop()
            if k in kids:
                stack += kids[k][:2]
            else:
                out.append(k)
        return out

    # a cluster lives from the density at which it splits off until it splits or dies; points leave it one by one
    top = tree[-1]
    order, born, mass, children = [top], {top: 0.0}, {}, {}
    for c in order:
        node, total = c, 0.0
        while True:
            if node not in kids:
                break
            a, b, w = kids[node]
            lam = 1 / w if w > 0 else 1e12
            big = [k for k in (a, b) if size[k] >= least]
            if len(big) == 2:
                total += size[node] * (lam - born[c])
                children[c] = big
                for k in big:
                    born[k] = lam
                    order.append(k)
                break
            if not big:
                total += size[node] * (lam - born[c])
                break
            total += (size[node] - size[big[0]]) * (lam - born[c])
            node = big[0]
        mass[c] = total
    chosen = {}
    for c in reversed(order):
        below = sum(mass[k] for k in children.get(c, ()))
        if c in children and (below >= mass[c] or c == top):
            mass[c] = below
            chosen[c] = False
        else:
            chosen[c] = c != top or c not in children
    stack, number = [top], 0
    while stack:
        c = stack.pop()
        if chosen[c]:
            labels[leaves(c)] = number
            number += 1
        else:
            stack += children.get(c, ())
    return labels


def condensed_part(x: np.ndarray, y: np.ndarray, core: np.ndarray, least: int) -> np.ndarray:
    """Labels of the points of one part, in the order of their loc_id. core: squared distances."""
    if len(x) < max(least, 2):
        return np.full(len(x), -1)
    w, a, b = spanning_tree(x, y, core)
    return condensed_clusters(len(x), zip(np.sqrt(w).tolist(), a.tolist(), b.tolist(), strict=True), least)


def hdbscan(df: DataFrame, min_cluster: int, min_samples: int, cut_radius: int, whole: int = CONDENSED) -> DataFrame:
    """(loc_id, cell, part, label). Points within the cut radius of each other make a part (C1 with one point enough), numbered in its
    cell; the tree of each part is condensed in one task. Points of cells with fewer than min_samples points have no row.

    Ties of distances decide trees by loc_id (spanning_tree). Cells of up to `whole` rows are shuffled once and done in the
    task they come to, neighbours, parts and trees; of larger ones the neighbours and parts are found by joins, and a task gets a part.
    """
    from .neighbors import knn

    schema = "loc_id long, cell long, part long, label int"
    p = df.select("loc_id", "x_m", "y_m", "cell").where("loc_id is not null and cell is not null and x_m is not null and y_m is not null")
    large = cut(p.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > whole).select("cell"))
    own, big = p, not large.isEmpty()
    if big:
        large = small(large)
        own = p.join(large, "cell", "left_anti").select(*p.columns)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = own.repartition(tasks, "cell").sortWithinPartitions("cell").mapInArrow(_condensed_cells(min_cluster, min_samples, cut_radius), schema)
    if not big:
        return out
    p = p.join(large, "cell", "left_semi").select(*p.columns)
    core = p.select("loc_id", F.lit(0.0).alias("core"))
    if min_samples > 1:
        core = knn(p, min_samples - 1).where(F.col("k") == min_samples - 1).select("loc_id", F.col("d").alias("core"))
    part = dbscan(p, cut_radius, 1, whole=whole).select("loc_id", F.col("group").cast("long").alias("part"))
    rows = p.join(core, "loc_id").join(part, "loc_id")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("loc_id").reset_index(drop=True)
        x, y = (frame[c].to_numpy(float) for c in ("x_m", "y_m"))
        core = np.rint(frame["core"].to_numpy() ** 2)  # places are whole numbers
        return frame[["loc_id", "cell", "part"]].assign(label=condensed_part(x, y, core, min_cluster))

    return out.unionByName(rows.groupBy("cell", "part").applyInPandas(one, schema))


def _condensed_cells(min_cluster: int, min_samples: int, cut_radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function of the batches of a task, whose rows are in the order of cell: hdbscan of each cell."""

    def found(rows: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        dataset = np.cumsum(new) - 1
        dataset_n = np.bincount(dataset)
        good = np.flatnonzero(dataset_n[dataset] >= min_samples)
        if not len(good):
            return
        dataset, cell, loc, x, y = (v[good] for v in (dataset, *(values(rows[c]) for c in ("cell", "loc_id", "x_m", "y_m"))))
        part = groups(dataset, loc, [x, y], cut_radius, 1)
        by = np.lexsort((loc, part, dataset))
        dataset, cell, loc, x, y, part = (v[by] for v in (dataset, cell, loc, x, y, part))
        # cells lie so far apart that the nearest points are of the same one
        apart = 3.0 * (max(x.max() - x.min(), y.max() - y.min()) + 1)
        core = kth_nearest(x + dataset * apart, y.astype(float), min_samples - 1) if min_samples > 1 else np.zeros(len(x))
        at = np.flatnonzero(np.append(True, (np.diff(part) != 0) | (np.diff(dataset) != 0)))
        label = np.full(len(x), -1, np.int32)
        for a, b in zip(at, np.append(at[1:], len(x)), strict=True):
            if b - a >= min_cluster:
                label[a:b] = condensed_part(x[a:b].astype(float), y[a:b].astype(float), core[a:b], min_cluster)
        yield pa.RecordBatch.from_arrays([pa.array(loc), pa.array(cell), pa.array(part.astype(np.int64)), pa.array(label)], names=["loc_id", "cell", "part", "label"])

    return whole_datasets(("cell",), found)


def cluster_centers(df: DataFrame) -> DataFrame:
    """By cell and group without noise: means, population deviations, count."""
    stats = [f(c).alias(f"{n}_{c}") for c in ("frame", "x_m", "y_m") for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return df.where(F.col("group") >= 0).groupBy("cell", "group").agg(*stats, F.count("*").alias("n"))


def hull(points: np.ndarray) -> tuple[float, float]:
    """(area, perimeter) of the convex hull; 0, 0 where it is degenerate."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return 0.0, 0.0

    def half(rows: Iterator) -> list:
        out: list = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    ring = np.array(half(iter(pts)) + half(iter(pts[::-1])), float)
    if len(ring) < 3:
        return 0.0, 0.0
    nxt = np.roll(ring, -1, axis=0)
    area = abs((ring[:, 0] * nxt[:, 1] - nxt[:, 0] * ring[:, 1]).sum()) / 2
    return float(area), float(np.sqrt(((nxt - ring) ** 2).sum(1)).sum())


#: Directions whose extreme points make the inner polygon of a group, and rim points of a group that one task holds.
DIRECTIONS, RIM = 16, 20_000


def outside_polygon(rows: DataFrame) -> DataFrame:
    """Rows (cell, group, x_m, y_m) without those strictly inside the polygon of their group's extreme points in DIRECTIONS directions:
    corners of the hull all stay. Aggregates and expressions only."""
    ways = [(math.cos(2 * math.pi * k / DIRECTIONS), math.sin(2 * math.pi * k / DIRECTIONS)) for k in range(DIRECTIONS)]
    far = [F.expr(f"max_by(struct(x_m AS x, y_m AS y), x_m * {c!r}D + y_m * {s!r}D) AS p{k}") for k, (c, s) in enumerate(ways)]
    corners = rows.groupBy("cell", "group").agg(*far)
    left = [f"((p{(k + 1) % DIRECTIONS}.x - p{k}.x) * (y_m - p{k}.y) > (p{(k + 1) % DIRECTIONS}.y - p{k}.y) * (x_m - p{k}.x) OR p{k} = p{(k + 1) % DIRECTIONS})" for k in range(DIRECTIONS)]
    inside = F.expr(" AND ".join(left)) & F.expr("p0 <> p4")
    return rows.join(small(cut(corners)), ["cell", "group"]).where(~inside).select(*rows.columns)


def hull_metrics(df: DataFrame, parts: int = 16, rim: int = RIM) -> DataFrame:
    """C4: hull area, perimeter and circularity by cell and group.

    Points strictly inside the polygon of a group's extreme points are dropped by expressions; the rest meets in one task. A group with more than
    `rim` of them is first dealt into parts, which are reduced to the corners of their own hulls (a corner of the whole hull is a corner there).
    """
    rows = df.where(F.col("group") >= 0).select("cell", "group", "x_m", "y_m").distinct()
    edge = cut(outside_polygon(rows))
    wide = edge.groupBy("cell", "group").agg(F.count("*").alias("n")).where(F.col("n") > rim).select("cell", "group")
    if not wide.isEmpty():

        def part(frame: pd.DataFrame) -> pd.DataFrame:
            pts = np.unique(frame[["x_m", "y_m"]].to_numpy(), axis=0)
            keep = pts[_rim(pts)]
            return pd.DataFrame({"cell": frame["cell"].iloc[0], "group": frame["group"].iloc[0], "x_m": keep[:, 0], "y_m": keep[:, 1]})

        wide = small(cut(wide))
        salted = edge.join(wide, ["cell", "group"], "left_semi").withColumn("salt", F.pmod(F.xxhash64("x_m", "y_m"), F.lit(parts).cast("long")))
        corners = salted.groupBy("cell", "group", "salt").applyInPandas(part, "cell long, group int, x_m long, y_m long")
        edge = edge.join(wide, ["cell", "group"], "left_anti").unionByName(corners)
    # many groups a call: a task sorts its rows and cuts them at the groups
    dealt = edge.repartition("cell", "group").sortWithinPartitions("cell", "group")
    return dealt.mapInPandas(_hulls, "cell long, group int, convex_area double, convex_perimeter double, convex_circularity double")


def _hulls(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hull of each run of rows with equal (cell, group); a run may go on in the next frame."""
    held: list = []

    def measured(run: list) -> tuple:
        pts = np.concatenate([x[1] for x in run])
        area, around = hull(pts.astype(float))
        return (*run[0][0], area, around, 4 * np.pi * area / around**2 if around else 0.0)

    names = ["cell", "group", "convex_area", "convex_perimeter", "convex_circularity"]
    for frame in frames:
        done = []
        cell, group, pts = frame["cell"].to_numpy(), frame["group"].to_numpy(), frame[["x_m", "y_m"]].to_numpy()
        at = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (group[1:] != group[:-1])]) if len(frame) else []
        for a, b in zip(at, [*at[1:], len(frame)], strict=True):
            key = (int(cell[a]), int(group[a]))
            if held and held[0][0] != key:
                done.append(measured(held))
                held = []
            held.append((key, pts[a:b]))
        yield pd.DataFrame(done, columns=names)
    if held:
        yield pd.DataFrame([measured(held)], columns=names)


def _rim(pts: np.ndarray) -> np.ndarray:
    """Indices of the hull's corners (points of a subset that are not corners of its hull are on no larger hull)."""
    order = np.lexsort((pts[:, 1], pts[:, 0]))
    keep: set[int] = set()
    for seq in (order, order[::-1]):
        out: list[int] = []
        for k in seq:
            q = pts[k]
            while len(out) > 1:
                a, b = pts[out[-2]], pts[out[-1]]
                if (b[0] - a[0]) * (q[1] - a[1]) <= (b[1] - a[1]) * (q[0] - a[0]):
                    out.pop()
                else:
                    break
            out.append(int(k))
        keep |= set(out)
    return np.array(sorted(keep), int)


def occupied_area(df: DataFrame, pixel: int, keys: tuple[str, ...] = ("cell", "group")) -> DataFrame:
    """(keys, n, area, density) of each group: area of the pixels (square of side `pixel`) that hold its points, in square pixels
    of the camera. Pixels are counted with partial sums."""
    at = df.where(F.col("group") >= 0).groupBy(*keys, F.floor(F.col("x_m") / pixel).alias("i"), F.floor(F.col("y_m") / pixel).alias("j")).agg(F.count("*").alias("n"))
    out = at.groupBy(*keys).agg(F.sum("n").alias("n"), (F.count("*") * F.lit(pixel * pixel / 1e6)).alias("area"))
    return out.withColumn("density", F.when(F.col("area") > 0, F.col("n") / F.col("area")))


def cluster_shape(props: DataFrame, sigma: float) -> DataFrame:
    """area = hull + perimeter * sigma; density null where the area is 0."""
    area = F.col("convex_area") + F.col("convex_perimeter") * sigma
    return props.withColumns({"area": area, "density": F.when(area > 0, F.col("n") / area)})


def attach_cluster_props(members: DataFrame, props: DataFrame) -> DataFrame:
    """J7."""
    return members.join(props, ["cell", "group"], "left")


def cluster_composition(df: DataFrame) -> DataFrame:
    """N and percent of each tag in each group, zero-filled (long form)."""
    own = df.where(F.col("group") >= 0)
    spine = own.select("cell", "group").distinct().crossJoin(small(own.select("tag").distinct()))  # tags: a few
    n = own.groupBy("cell", "group", "tag").agg(F.count("*").alias("n"))
    full = spine.join(n, ["cell", "group", "tag"], "left").fillna(0, ["n"])
    return full.withColumn("percent", F.col("n") * F.lit(100.0) / F.sum("n").over(Window.partitionBy("cell", "group")))


def composition_wide(df: DataFrame, tags: list[str]) -> DataFrame:
    """G4, wide: explicit tags, so that the pivot needs no extra pass."""
    return df.where(F.col("group") >= 0).groupBy("cell", "group").pivot("tag", tags).agg(F.count(F.lit(1))).fillna(0)


def cluster_info(df: DataFrame) -> DataFrame:
    """G5."""
    return df.groupBy("cell").agg(F.count("*").alias("n"), F.sum((F.col("group") >= 0).cast("long")).alias("clustered"), F.sum((F.col("group") < 0).cast("long")).alias("nonclustered"), F.count_distinct(F.when(F.col("group") >= 0, F.col("group"))).alias("clusters"))


def split_by_threshold(props: DataFrame, field: str, threshold: float) -> DataFrame:
    """Class large or small; null where the field is null."""
    return props.withColumn("class", F.when(F.col(field) >= threshold, "large").when(F.col(field) < threshold, "small"))


def cluster_report(df: DataFrame, eps: int, minpts: int, sigma: float) -> tuple[DataFrame, DataFrame]:
    """(members with properties, cluster properties)."""
    grouped = cut(dbscan(df, eps, minpts))
    props = cut(cluster_shape(cluster_centers(grouped).join(hull_metrics(grouped), ["cell", "group"]), sigma))
    return attach_cluster_props(grouped, props.select("cell", "group", "convex_area", "area", "density")), props
