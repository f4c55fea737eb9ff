"""Operators where points crowd, cells are many or parts are missing: against brute force, with bounds so low that every path is taken."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotspark import queries
from spotspark.operators import cluster, drift, frames, neighbors, quantiles, ripley
from spotspark.plans import grid, pyramid, subcells, trees
from spotspark.sources import io


@pytest.fixture(scope="module")
def rows():
    """loc_id, cell, iter, x_m, y_m, channel: half of all points in one place of one cell, some of them at one point."""
    rng = np.random.default_rng(1)
    out = []
    for i in range(1500):
        x, y = rng.normal(500, 60, 2) if i % 2 else (777, 777) if i % 7 == 0 else rng.uniform(-1500, 1500, 2)
        out.append((i, int(i % 6 == 0), i % 5 % 2, int(x), int(y), int(rng.integers(0, 3))))
    return out


@pytest.fixture(scope="module")
def locs(spark, rows):
    return spark.createDataFrame(rows, "loc_id long, cell long, iter long, x_m long, y_m long, channel int").repartition(4).cache()


def far(rows):
    p = np.array([(r[3], r[4]) for r in rows])
    return ((p[:, None] - p[None]) ** 2).sum(-1)


@pytest.mark.parametrize("crowd", [1 << 40, 60, 15])
def test_pair_counts_of_crowded_cells(locs, rows, crowd, monkeypatch):
    monkeypatch.setattr(pyramid, "OPEN", 64)
    radii = [0, 50, 100, 200]
    want = {}
    for cell in (0, 1):
        own = [r for r in rows if r[1] == cell]
        d2, ch = far(own), np.array([r[5] for r in own])
        for a in range(3):
            for b in range(3):
                for r in radii:
                    want[cell, a, b, r] = int((d2[np.ix_(ch == a, ch == b)] <= r * r).sum()) - int((ch == a).sum() if a == b else 0)
    got = {(r.cell, r.a, r.b, r.r): r.pairs for r in neighbors.pair_counts_cross(locs, radii, crowd=crowd).collect()}
    assert got == want


def test_settled_nodes_stand_for_most_pairs(spark, monkeypatch):
    """Ten times the points in the same places: pairs grow a hundredfold, pairs that are opened far less."""
    monkeypatch.setattr(pyramid, "OPEN", 64)
    opened = []
    before = pyramid._opened
    monkeypatch.setattr(pyramid, "_opened", lambda met, *rest: opened.append(met) or before(met, *rest))
    work = []
    for n in (400, 4000):
        rng = np.random.default_rng(3)
        p = [(i, 0, int(x), int(y)) for i, (x, y) in enumerate(rng.uniform(0, 1000, (n, 2)))]
        opened.clear()
        got = pyramid.counted_pairs(spark.createDataFrame(p, "loc_id long, cell long, x_m long, y_m long"), [250, 1000], ("cell",), crowd=50)
        total = got.agg(F.sum("n")).first()[0]
        work.append((total, sum(m.count() for m in opened)))
    assert work[1][0] > 80 * work[0][0] and work[1][1] < 32 * work[0][1] and work[1][1] < 0.25 * work[1][0], work


def test_crowded_grid_cell_meets_in_many_keys(locs, rows):
    p = locs.select("loc_id", "x_m", "y_m", "cell")
    split = grid.Quadrants(p, 200, ("cell",), ("x_m", "y_m"), 40)
    stay = split.stay(p.withColumns(grid._at(("x_m", "y_m"), 200)))
    assert stay.count() == len(rows)
    assert stay.groupBy("cell", *split.names).count().agg(F.max("count")).first()[0] <= 2 * 40
    plain, dealt = (grid.pairs_within(p.where("loc_id % 5 = 0"), p, 200, ("cell",), crowd=c).select("loc_id", "o_loc_id", "d2") for c in (1 << 40, 40))
    assert plain.count() == dealt.count() == dealt.distinct().count() and plain.exceptAll(dealt).isEmpty()
    plain, dealt = (grid.pairs_once(p, 100, ("cell",), crowd=c, stretch=2).select(F.least("loc_id", "o_loc_id"), F.greatest("loc_id", "o_loc_id")) for c in (1 << 40, 40))
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()


def plain_dbscan(rows, eps, minpts):
    near = far(rows) <= eps * eps
    core, ids = near.sum(1) >= minpts, [r[0] for r in rows]
    label = {}
    for i in sorted(range(len(rows)), key=lambda k: ids[k]):
        if core[i] and i not in label:
            label[i], todo = ids[i], [i]
            while todo:
                for m in np.flatnonzero(near[todo.pop()] & core):
                    if m not in label:
                        label[m] = ids[i]
                        todo.append(m)
    full = label | {i: min(label[m] for m in np.flatnonzero(near[i] & core)) for i in range(len(rows)) if not core[i] and (near[i] & core).any()}
    names = sorted(set(full.values()))
    return {ids[i]: names.index(full[i]) if i in full else -1 for i in range(len(rows))}


@pytest.mark.parametrize("bound", [1 << 14, 4])
def test_dbscan_of_keyed_datasets(locs, rows, bound, monkeypatch):
    monkeypatch.setattr(cluster, "OPEN", bound)
    monkeypatch.setattr(pyramid, "OPEN", bound)
    got = cluster.dbscan(locs, 90, 6, keys=("iter", "cell")).collect()
    for cell in (0, 1):
        for it in (0, 1):
            assert {r.loc_id: r.group for r in got if (r.cell, r.iter) == (cell, it)} == plain_dbscan([r for r in rows if r[1:3] == (cell, it)], 90, 6)


def test_quantiles_of_large_groups(spark):
    rng = np.random.default_rng(2)
    groups = {0: rng.exponential(5, 4000), 1: np.r_[np.full(3000, 7.0), rng.uniform(0, 9, 500)], 2: rng.normal(size=9), 3: np.full(2000, 1.5)}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [(0, None), (4, None)], "g long, v double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    for held in (100_000, 50):
        got = {r["g"]: r["q"] for r in quantiles.quantiles(df, ["g"], "v", probs, held=held, bins=16).collect()}
        assert {k: pytest.approx(list(np.quantile(x, probs)), rel=1e-12) for k, x in groups.items()} == got


def test_controls_of_small_and_large_cells(spark, locs):
    rng = np.random.default_rng(4)
    made = [(c, k, h, i, int(x), int(y)) for c in (0, 1) for k in range(4) for h in range(3) for i, (x, y) in enumerate(rng.uniform(-800, 800, (30, 2)))]
    controls = spark.createDataFrame(made, "cell long, control_id long, channel int, loc_id long, x_m long, y_m long")
    one, other = (neighbors.pair_counts_controls(controls, locs, [0, 60, 200], 4, cell_rows=n).select("cell", "control_id", "a", "b", "r", "pairs") for n in (20_000, 0))
    assert one.count() == 2 * 4 * 9 * 3 and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    assert one.agg(F.sum("pairs")).first()[0] > 1000


def test_links_with_a_long_tolerance(spark):
    rng = np.random.default_rng(5)
    p = [(i, 0, int(f), int(x), int(y)) for i, (f, x, y) in enumerate(np.c_[rng.integers(0, 200, 300), rng.integers(0, 400, (300, 2))])]
    for tolerance in (0, 3, 40):
        want = {}
        for a in p:
            met = [(b[2], (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2, b[0]) for b in p if 1 <= b[2] - a[2] <= tolerance + 1 and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= 3600]
            if met:
                _, d2, b = min(met)
                want[b] = max(want.get(b, (-1,)), (a[2], -d2, -a[0]))
        got = neighbors.link_edges(spark.createDataFrame(p, "loc_id long, cell long, frame long, x_m long, y_m long"), 60, tolerance).collect()
        assert {r["b"]: r["a"] for r in got} == {b: -k[2] for b, k in want.items()}


def test_hulls_by_parts_equal_whole_hulls(spark):
    rng = np.random.default_rng(6)
    groups = {0: rng.normal(0, 300, (400, 2)), 1: [(math.cos(t) * 5000, math.sin(t) * 5000) for t in np.linspace(0, 6.2, 300)], 2: [(5, 5)], 3: [(k, 2 * k) for k in range(50)], 4: [(0, 0), (0, 9), (9, 0)], 5: [(0, 0), (0, 90), (90, 0), (90, 90), (40, 40)]}
    df = spark.createDataFrame([(1, g, int(x), int(y)) for g, pts in groups.items() for x, y in pts], "cell long, group int, x_m long, y_m long")
    for rim in (20_000, 10):
        got = {r["group"]: (r["convex_area"], r["convex_perimeter"]) for r in cluster.hull_metrics(df, rim=rim).collect()}
        assert got == {g: pytest.approx(cluster.hull(np.array([(int(x), int(y)) for x, y in pts], float))) for g, pts in groups.items()}
    assert cluster.outside_polygon(df.where("group = 0")).count() < 60


def test_drift_of_segments_that_overlap_nothing(spark):
    """Three segments show the same places, moved by (100, 0) each; the second shows other places, in one of two cells."""
    rng = np.random.default_rng(7)
    places = rng.integers(0, 20_000, (60, 2))
    other = rng.integers(0, 20_000, (60, 2))
    rows = [(c, s * 10 + int(k % 10), int(x) + 100 * s + (50_000 if c == 1 and s == 1 else 0), int(y)) for c in (0, 1) for s in range(4) for k, (x, y) in enumerate(other if c == 1 and s == 1 else places)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "loc_id long, cell long, frame long, x_m long, y_m long")
    got = {(r["cell"], r["frame"]): (r["dx"], r["dy"]) for r in drift.undrift_rcc(df, 40, 10, 100, 4, tries=0).collect()}
    for f in (5, 15, 25, 35):
        assert got[0, f] == pytest.approx((10.0 * (f - 5), 0.0), abs=30)
    assert all(got[1, f] == (0.0, 0.0) for f in range(10, 20))
    assert got[1, 25] == pytest.approx((200.0, 0.0), abs=30) and got[1, 35] == pytest.approx((300.0, 0.0), abs=30)


def test_picks_weigh_by_coordinate(spark):
    rng = np.random.default_rng(8)
    picked = [(0, p, f, p * 100 + f, float(p * 1000 + rng.normal(0, (1, 9)[p % 2])), float(rng.normal(0, (9, 1)[p % 2]))) for p in range(6) for f in range(20)]
    x = np.array([[r[4] for r in picked if r[1] == p] for p in range(6)])
    y = np.array([[r[5] for r in picked if r[1] == p] for p in range(6)])
    want = []
    for v in (x, y):
        off = v - v.mean(axis=1, keepdims=True)
        want.append(np.average(off, axis=0, weights=1 / ((off - off.mean(axis=0)) ** 2).mean(axis=1)))
    got = drift.undrift_from_picked(spark.createDataFrame(picked, "cell long, pick long, frame long, loc_id long, x_m double, y_m double"), 20).orderBy("frame").collect()
    assert [r["dx"] for r in got] == pytest.approx(want[0]) and [r["dy"] for r in got] == pytest.approx(want[1])


def test_centers_are_what_picks_copy(spark, locs):
    centers = spark.createDataFrame([(0, 7, 500, 500)], "cell long, pick long, x_m long, y_m long")
    plan = drift.picked_locs(locs, centers, 300)._jdf.queryExecution().optimizedPlan().toString()
    generate = [line for line in plan.split("\n") if "Generate explode" in line]
    assert generate and all("loc_id" not in line for line in generate)


def test_rows_are_in_the_order_of_frames(spark):
    df = spark.createDataFrame([(i, i % 2, (i * 7) % 50, 0, 0) for i in range(200)], "loc_id long, cell long, frame long, x_m long, y_m long").repartition(6)
    got = [(r["cell"], r["frame"]) for r in frames.sort_by_frame(df).collect()]
    frames_only = [f for _, f in got]
    assert got == sorted(got) or frames_only == sorted(frames_only)


def test_random_points_feed_a_keyed_call(spark, locs):
    mask = ripley.occupancy_mask(locs, 250, 128)
    controls = ripley.random_points(locs.groupBy("cell", "channel").agg(F.count("*").alias("n")), 2, mask, 250)
    tagged = locs.withColumn("tag", F.col("channel").cast("string"))
    beside = cluster.controls_beside(tagged, controls)
    assert beside.groupBy("origin", "iter", "cell", "loc_id").count().where("count > 1").isEmpty()
    assert {(r["origin"], r["iter"]) for r in beside.select("origin", "iter").distinct().collect()} == {("exp", 0), ("csr", 0), ("csr", 1)}


def test_knn_of_clustered_and_lonely_points(locs, rows, spark):
    for cell in (0, 1):
        own = [r for r in rows if r[1] == cell]
        want = {}
        d2 = far(own)
        for i, r in enumerate(own):
            want[r[0]] = sorted(d2[i, j] for j in range(len(own)) if j != i)[:5]
        got = {}
        for r in neighbors.knn(locs.where(F.col("cell") == cell), 5).orderBy("loc_id", "k").collect():
            got.setdefault(r["loc_id"], []).append(round(r["d"] ** 2))
        assert got == want
    few = spark.createDataFrame([(i, c, 10**i, 0) for c in (0, 1, 2) for i in range(c + 1)], "loc_id long, cell long, x_m long, y_m long")
    got = sorted((r["cell"], r["loc_id"], r["k"], r["d"]) for r in neighbors.knn(few, 4).collect())
    assert got == [(1, 0, 1, 9.0), (1, 1, 1, 9.0), (2, 0, 1, 9.0), (2, 0, 2, 99.0), (2, 1, 1, 9.0), (2, 1, 2, 90.0), (2, 2, 1, 90.0), (2, 2, 2, 99.0)]


def test_saved_tables_are_not_broadcast_for_the_size_of_their_files(spark):
    saved = io.cut(spark.range(2_000_000).select((F.col("id") % 9).alias("cell"), F.pmod(F.xxhash64("id"), F.lit(128)).alias("gx"), F.pmod(F.xxhash64("id"), F.lit(999)).alias("n")))
    plan = saved.join(spark.range(9_000_000).select((F.col("id") % 9).alias("cell")), "cell")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan  # a file of less than 10 MB, 64 MB of rows


def test_correlation_copies_rows_to_grid_cells_and_not_to_offsets(locs, rows):
    got = drift.correlation(locs, "channel", 100, 6)
    assert "explode([[" not in got._jdf.queryExecution().optimizedPlan().toString()  # 13 x 13 copies of a row, which a broadcast took for one
    want = {}
    for a in rows:
        for b in rows:
            dx, dy = b[3] // 100 - a[3] // 100, b[4] // 100 - a[4] // 100
            if a[1] == b[1] and a[5] < b[5] and max(abs(dx), abs(dy)) <= 6:
                want[a[1], a[5], b[5], dx, dy] = want.get((a[1], a[5], b[5], dx, dy), 0) + 1
    assert {tuple(r)[:5]: r["corr"] for r in got.collect()} == want


def test_controls_drawn_in_their_task_equal_joined_ones(spark, locs):
    own = locs.withColumns({"x_m": F.col("x_m") + 2000, "y_m": F.col("y_m") + 2000})
    mask = ripley.occupancy_mask(own, 250, 128)
    plan = ripley.ripley_controls(own, [0, 50, 200], mask, 250, 7)
    assert "loc_id" not in plan._jdf.queryExecution().optimizedPlan().toString().split("FlatMapCoGroups")[0]  # no table of points is met with another
    drawn, joined = (sorted(map(tuple, ripley.ripley_controls(own, [0, 50, 200], mask, 250, 7, n).collect())) for n in (neighbors.CELL_ROWS, 0))
    assert drawn == joined and len(drawn) == 2 * 7 * 9 * 3


def test_density_at_the_threshold_is_large(spark):
    d = spark.createDataFrame([(0, 0, k % 40 * 50, 0) for k in range(42)], "cell long, group int, x_m long, y_m long")
    area = cluster.occupied_area(d, 50)
    assert [(r["density"], r["class"]) for r in cluster.split_by_threshold(area, "density", 420).collect()] == [(420.0, "large")]


def test_ties_of_quotients_are_rounded_by_their_value(spark):
    below = np.nextafter(15.84375, 0)
    d = spark.createDataFrame([(float(below),), (15.84375,), (15.84374,)], "v double")
    assert [r[0] for r in d.select(queries.to_4(F.col("v"))).collect()] == [15.8438, 15.8438, 15.8437]


def test_jittered_controls_counted_in_their_task_equal_joined_ones(spark, locs):
    got = ripley.jittered_rings(locs, [0, 50, 200], 7, 300)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "control_id" not in plan  # controls were saved, copied to grid cells and met in pairs
    moved, joined = (sorted(map(tuple, ripley.jittered_rings(locs, [0, 50, 200], 7, 300, n).collect())) for n in (4096, 0))
    assert moved == joined and sum(r[-1] for r in moved) == 2 * 9 * 2 * 7
    jittered = [(r["cell"], r["control_id"], r["x_m"], r["y_m"], r["channel"]) for r in ripley.jitter_control(locs, 7, 300).collect()]
    c, k, x, y, ch = np.array(jittered).T
    one = [i for i in range(len(c)) if (c[i], k[i]) == (1, 3)]
    d2 = (x[one][:, None] - x[one]) ** 2 + (y[one][:, None] - y[one]) ** 2
    far = int(((d2 > 2500) & (d2 <= 40_000))[np.ix_(ch[one] == 0, ch[one] == 2)].sum())
    assert far in [r[5] for r in moved if r[:4] == (1, 0, 2, 50)]


def test_parts_of_hdbscan_are_found_without_pairs_of_points(spark, locs, rows, monkeypatch):
    """Half of all points lie in one place: pairs within the cut radius are many times the points."""
    saved = []
    before = cluster.components
    monkeypatch.setattr(cluster, "components", lambda nodes, edges: saved.append(edges.count()) or before(nodes, edges))
    own = [r for r in rows if r[1] == 0]
    got = {(r["part"], r["loc_id"]) for r in cluster.hdbscan(locs.where("cell = 0"), 8, 5, 90).collect()}
    want = plain_dbscan(own, 90, 1)
    assert sum(saved) < 10 * len(own) < (far(own) <= 90 * 90).sum()
    assert got == {(want[r[0]], r[0]) for r in own}


def test_hdbscan_in_the_task_of_a_cell_equals_joins(spark, locs):
    plan = cluster.hdbscan(locs, 8, 5, 90)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan  # neighbours were joined, and each part was a group of its own
    odd = [(10**6 + k, 77, 0, *xy) for k, xy in enumerate([(5, 5), (6, 6), (7, 7), (8, 8), (None, 9)])]  # fewer than five places
    p = locs.where("iter = 0").select("loc_id", "cell", "x_m", "y_m")
    p = p.unionByName(spark.createDataFrame(odd, "loc_id long, cell long, iter long, x_m long, y_m long").select(*p.columns))
    held, mixed, joined = (sorted(map(tuple, cluster.hdbscan(p, 8, 5, 90, n).collect())) for n in (20_000, 400, 0))
    assert held == mixed == joined and len(held) == p.count() - 5 and {r[3] for r in held} > {-1, 0}


def plain_tree(x, y, core):
    """Kruskal's tree over all pairs in the order of (weight, a, b)."""
    i, j = np.triu_indices(len(x), 1)
    w = np.maximum(np.maximum(core[i], core[j]), (x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2)
    label, out = np.arange(len(x)), []
    for e in np.lexsort((j, i, w)):
        a, b = label[i[e]], label[j[e]]
        if a != b:
            label[label == b] = a
            out.append((w[e], i[e], j[e]))
    return out


@pytest.mark.parametrize("pairs, together", [(64, 1), (1 << 20, 1 << 11)])
def test_trees_by_boxes_equal_brute_force(pairs, together, monkeypatch):
    for name, value in (("PAIRS", pairs), ("TOGETHER", together), ("FEW", 1)):
        monkeypatch.setattr(trees, name, value)
    rng = np.random.default_rng(8)
    for n, wide in ((6, 4), (9, 1000), (70, 12), (260, 25), (300, 30_000)):  # the narrow ones are full of ties and equal places
        x, y = rng.integers(0, wide, (2, n)).astype(float)
        x[: n // 2] += 40_000 * (n > 200)
        core = np.sort((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2, axis=1)[:, 4]
        assert (trees.kth_nearest(x, y, 4) == core).all()
        assert list(zip(*trees.spanning_tree(x, y, core), strict=True)) == plain_tree(x, y, core)
        few = trees._tree_of_few(x, y, core)
        assert (few[0] == [e[0] for e in plain_tree(x, y, core)]).all()


def test_a_part_of_many_points_does_not_meet_all_of_them(monkeypatch):
    """Each of them was measured to all others, once for every point."""
    met = []
    before = trees.Boxes.points
    monkeypatch.setattr(trees.Boxes, "points", lambda self, leaf: met.append(np.size(leaf)) or before(self, leaf))
    x, y = np.random.default_rng(9).integers(0, 3000, (2, 20_000)).astype(float)
    w, a, b = trees.spanning_tree(x, y, trees.kth_nearest(x, y, 4))
    assert len(w) == len(x) - 1 and sum(met) * trees.LEAF**2 < len(x) ** 2 / 4


def test_dbscan_in_one_task_equals_joins(locs, rows):
    plan = cluster.dbscan(locs, 90, 6)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # a dataset's rows were copied to grid cells, met in pairs and joined to their groups
    dims = ("x_m", "y_m", "channel")
    # 400: three of four datasets in their task, the largest by joins
    held, mixed = (sorted(map(tuple, cluster.dbscan(locs, 90, 6, dims, ("iter", "cell"), n).select("iter", "cell", "loc_id", "group").collect())) for n in (20_000, 400))
    assert held == mixed and len(held) == len(rows) and {r[3] for r in held} > {-1, 0}


@pytest.mark.parametrize("chunk, pairs", [(1, 1), (700, 50), (1 << 16, 1 << 20)])
def test_groups_of_sub_cells_equal_brute_force(rows, chunk, pairs, monkeypatch):
    monkeypatch.setattr(subcells, "CHUNK", chunk)
    monkeypatch.setattr(subcells, "PAIRS", pairs)
    own = [(*r[:3], r[3] + (1 << 30) * (r[0] % 2), *r[4:]) for r in rows] if chunk > 1 else rows[:400]  # sub-cells far apart
    table = pa.table({n: [r[k] for r in sorted(own, key=lambda r: r[2])] for k, n in enumerate(("loc_id", "cell", "iter", "x_m", "y_m"))})
    got = pa.Table.from_batches(subcells.clustered(("iter",), ("x_m", "y_m"), 90, 6)(iter(table.to_batches(max_chunksize=97)))).to_pylist()
    for it in (0, 1):
        assert {r["loc_id"]: r["group"] for r in got if r["iter"] == it} == plain_dbscan([r for r in own if r[2] == it], 90, 6)


def test_dbscan_leaves_rows_without_key_or_place_alone(spark):
    rows = [(i, 0 if i < 9 else None, 5, None if i == 3 else 5 + i) for i in range(12)]
    d = spark.createDataFrame(rows, "loc_id long, cell long, x_m long, y_m long")
    got = {r["loc_id"]: r["group"] for r in cluster.dbscan(d, 2, 3).collect()}
    assert got == {i: 0 if i < 9 and i != 3 else -1 for i in range(12)}


def test_peaks_are_found_without_a_sort_of_pairs(locs, rows, monkeypatch):
    """Half of all points lie in one place: pairs within the radius are many times the points."""
    plans = []
    before = cluster.cut
    monkeypatch.setattr(cluster, "cut", lambda df, *name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or before(df, *name))
    got = {r["loc_id"]: r["peak"] for r in cluster.smlm_cluster(locs, 90, 6).collect()}
    assert len(plans) == 2 and not any("SortAggregate" in p for p in plans)
    want = {}
    for cell in (0, 1):
        own = [r for r in rows if r[1] == cell]
        d2, ids = far(own), [r[0] for r in own]
        near = d2 <= 90 * 90
        n = near.sum(1)
        peaks = [i for i in range(len(own)) if max((n[j], -ids[j]) for j in np.flatnonzero(near[i])) == (n[i], -ids[i])]
        want |= {ids[i]: min((d2[i, k], ids[k]) for k in peaks if near[i, k])[1] for i in range(len(own)) if any(near[i, k] for k in peaks)}
    size = {p: list(want.values()).count(p) for p in set(want.values())}
    assert got == {i: p for i, p in want.items() if size[p] >= 6} and len(got) > 300


@pytest.mark.parametrize("bound", [1, 6, 1 << 10])
def test_groups_of_quadrants_equal_brute_force(rows, bound, monkeypatch):
    monkeypatch.setattr(subcells, "OPEN", bound)
    monkeypatch.setattr(subcells, "PAIRS", 300)
    for dims, turn in ((2, 1), (2, 0.37), (3, 1)):
        at = [np.array([r[3 + k] for r in rows]) * turn if k < 2 else np.array([r[5] * 30 for r in rows]) for k in range(dims)]
        got = subcells.groups(np.zeros(len(rows), np.int64), np.array([r[0] for r in rows]), at, 90 * turn, 6)
        near = sum((x[:, None] - x[None]) ** 2 for x in at) <= (90 * turn) ** 2
        monkeypatch.setattr(f"{__name__}.far", lambda _, near=near: np.where(near, 0, 2))
        assert dict(zip((r[0] for r in rows), got.tolist(), strict=True)) == plain_dbscan(rows, 1, 6)
        monkeypatch.undo()
        monkeypatch.setattr(subcells, "OPEN", bound)
        monkeypatch.setattr(subcells, "PAIRS", 300)


def test_pairs_of_crowded_sub_cells_are_not_opened(monkeypatch):
    """Two walls of 4,000 points each, just beyond and just within eps of each other."""
    opened = []
    before = subcells._d2
    monkeypatch.setattr(subcells, "_d2", lambda at, a, b: opened.append(len(a)) or before(at, a, b))
    rng = np.random.default_rng(9)
    y = rng.uniform(0, 60, 8000)
    for gap, want in ((101, 2), (99, 1)):
        x = np.r_[rng.uniform(-20, 0, 4000), gap + rng.uniform(0, 20, 4000)]
        x[[0, 4000]], y[[0, 4000]] = (0, gap), 30
        got = subcells.groups(np.zeros(8000, np.int64), np.arange(8000), [x, y], 100, 8)
        assert len(set(got.tolist())) == want and sum(opened) < 100_000
        opened.clear()


def test_datasets_of_40_000_rows_are_clustered_in_their_task(spark):
    d = spark.range(40_000).select(F.col("id").alias("loc_id"), (F.col("id") % 2 * 0).alias("cell"), (F.col("id") * 48271 % 907).alias("x_m"), (F.col("id") * 69621 % 811).alias("y_m"))
    got = cluster.dbscan(d, 150, 8)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in got.groupBy("group").count().collect()] == [(0, 40_000)]
