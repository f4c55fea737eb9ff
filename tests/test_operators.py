"""Properties, planted truths and edge cases of the operators without an SQL oracle."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotspark.operators import barcodes, cluster, drift, frames, neighbors, ripley
from spotspark.plans.grid import pairs_once
from spotspark.sources import fixture, io

DIR = "/root/testdata/sf0.001"
SCHEMA = "loc_id long, cell long, frame long, channel int, tag string, x_m long, y_m long, photons double"


def points(spark, rows):
    return spark.createDataFrame([(i, 0, i, 0, "a", int(x), int(y), 1.0) for i, (x, y) in enumerate(rows)], SCHEMA)


def test_empty_and_single_row(spark):
    for rows in ([], [(5, 5)]):
        d = points(spark, rows)
        assert neighbors.knn(d, 3).count() == 0
        assert cluster.dbscan(d, 100, 2).where("group >= 0").count() == 0
        assert sum(r["pairs"] for r in neighbors.pair_counts_self(d, [0, 10]).collect()) == 0


def test_pairs_of_equal_and_negative_points_and_grid_borders(spark):
    d = points(spark, [(0, 0), (0, 0), (-100, 0), (100, 0), (200, 0)])
    got = {r["r"]: r["pairs"] for r in neighbors.pair_counts_self(d, [0, 100, 200]).collect()}
    assert got == {0: 2, 100: 12, 200: 18}


def test_knn_finds_a_far_outlier(spark):
    d = points(spark, [(0, 0), (10, 0), (0, 10), (90_000, 90_000)])
    got = {r["loc_id"]: r["d"] for r in neighbors.knn(d, 1).collect()}
    assert got[3] == pytest.approx(math.dist((90_000, 90_000), (10, 0)))


def test_dbscan_does_not_depend_on_order_or_partitions(spark):
    d = fixture.locs(spark, DIR)
    a = {r["loc_id"]: r["group"] for r in cluster.dbscan(d, 150, 8).collect()}
    b = {r["loc_id"]: r["group"] for r in cluster.dbscan(d.repartition(7).orderBy(F.desc("loc_id")), 150, 8).collect()}
    assert a == b


def test_hull():
    square = np.array([(0, 0), (4, 0), (4, 4), (0, 4), (2, 2), (1, 3), (4, 2)])
    assert cluster.hull(square) == (16.0, 16.0)
    assert cluster.hull(np.array([(0, 0), (1, 1), (2, 2)])) == (0.0, 0.0)
    rng = np.random.default_rng(1)
    pts = rng.integers(0, 1000, (400, 2))
    parts = np.concatenate([p[cluster._rim(p)] for p in np.array_split(pts, 5)])
    assert cluster.hull(parts) == cluster.hull(pts)


def test_hull_metrics_equal_the_whole_hull(spark):
    rng = np.random.default_rng(2)
    pts = rng.integers(0, 500, (60, 2))
    d = points(spark, pts).withColumn("group", F.lit(0))
    r = cluster.hull_metrics(d).first()
    assert (r["convex_area"], r["convex_perimeter"]) == pytest.approx(cluster.hull(pts.astype(float)))


def test_hdbscan_finds_two_blobs(spark):
    rng = np.random.default_rng(3)
    blobs = np.concatenate([rng.normal((0, 0), 20, (40, 2)), rng.normal((1000, 0), 20, (40, 2)), [(5000, 5000)]])
    got = {r["loc_id"]: (r["part"], r["label"]) for r in cluster.hdbscan(points(spark, blobs), 10, 5, 3000).collect()}
    one, two = {got[i] for i in range(40) if got[i][1] >= 0}, {got[i] for i in range(40, 80) if got[i][1] >= 0}
    assert len(one) == 1 and len(two) == 1 and one != two


def test_mle_recovers_a_density(spark):
    rng = np.random.default_rng(4)
    n, width = 4000, 100_000
    d = points(spark, rng.integers(0, width, (n, 2)))
    rho = neighbors.csr_density_mle(neighbors.knn(d, 4, radius=2000)).first()["rho"]
    assert rho == pytest.approx(n / width**2, rel=0.1)


def test_planted_drift_is_found(spark):
    b = fixture.beads(spark, DIR).where("cell = 0").withColumn("loc_id", F.col("frame") * 3 + F.col("bead"))
    own = {r["frame"]: (r["dx"], r["dy"]) for r in drift.undrift_from_picked(b.withColumnRenamed("bead", "pick"), 1440).collect()}
    assert own[1400][0] - own[100][0] == pytest.approx(2600, abs=40) and own[1400][1] - own[100][1] == pytest.approx(-1300, abs=40)
    for found in (drift.undrift_rcc(b, 1440, 360, 200, 16), drift.undrift_aim(b, 1440, 120, 100, 400)):
        got = {r["frame"]: (r["dx"], r["dy"]) for r in found.collect()}
        assert got[1200][0] - got[240][0] == pytest.approx(1920, abs=250) and got[1200][1] - got[240][1] == pytest.approx(-960, abs=250)


def test_gold_is_found(spark):
    b = fixture.beads(spark, DIR).where("cell = 0").withColumn("loc_id", F.col("frame") * 3 + F.col("bead"))
    assert drift.find_gold(b, 1440, 5000, rmsd=(0.0, 2000.0)).count() == 3


def test_planted_shift_is_found(spark):
    d = fixture.locs(spark, DIR).where("cell = 0 and channel < 2 and not is_noise").drop("channel")
    both = d.withColumn("channel", F.lit(0)).unionByName(d.withColumns({"channel": F.lit(1), "x_m": F.col("x_m") + 400, "y_m": F.col("y_m") - 200}))
    both = both.where("channel < 2")
    _, shifts = drift.align_channels(both, 100, 6, 2)
    s = {r["channel"]: (r["sx"], r["sy"]) for r in shifts.where("iteration = 0").collect()}
    assert s[1][0] - s[0][0] == pytest.approx(400, abs=60) and s[1][1] - s[0][1] == pytest.approx(-200, abs=60)


def test_student_p():
    assert barcodes.student_p(0.0, 10) == pytest.approx(1.0)
    assert barcodes.student_p(2.228138852, 10) == pytest.approx(0.05, abs=1e-6)
    assert barcodes.student_p(12.7062047, 1) == pytest.approx(0.05, abs=1e-6)
    assert barcodes.student_p(None, 3) is None


def test_nan_is_ignored_or_spreads(spark):
    m = spark.createDataFrame([(0, 0, 1.0), (0, 0, float("nan")), (0, 0, 3.0)], "a int, b int, v double")
    assert ripley.matrix_average(m, "v").first()["mean"] == 2.0
    assert ripley.matrix_average(m, "v", False).first()["mean"] is None


def test_scale_columns_rejects_mixed_types(spark):
    with pytest.raises(ValueError):
        frames.scale_columns(points(spark, [(1, 2)]), ["x_m", "photons"], 2.0)


def test_nena_recovers_the_precision(spark):
    rng = np.random.default_rng(5)
    d = np.hypot(*rng.normal(0, 20 * math.sqrt(2), (2, 20000)))
    s, _ = drift.nena(spark.createDataFrame([(float(x),) for x in d], "d double"), 200.0)
    assert s == pytest.approx(20, rel=0.1)


def test_controls_lie_in_the_mask_and_spread_evenly(spark):
    d = points(spark, [(x, y) for x in range(1000, 4000, 40) for y in (1000, 1100)])
    mask = ripley.occupancy_mask(d, 250, 32)
    n = d.count()
    got = ripley.random_points(d.groupBy("cell", "channel").agg(F.count("*").alias("n")), 60, mask, 250)
    assert got.count() == 60 * n and ripley.in_mask(got, mask, 250).count() == 60 * n
    per = [r["count"] for r in got.groupBy(F.floor(F.col("x_m") / 250).alias("i"), F.floor(F.col("y_m") / 250).alias("j")).count().collect()]
    assert len(per) == mask.count() and np.std(per) < 3 * math.sqrt(np.mean(per))
    assert ripley.random_points(d.limit(0).groupBy("cell", "channel").agg(F.count("*").alias("n")), 3, mask, 250).count() == 0


def test_controls_made_in_ranges_are_the_same(spark, monkeypatch):
    d = fixture.locs(spark, DIR)
    sizes, mask = d.groupBy("cell", "channel").agg(F.count("*").alias("n")), ripley.occupancy_mask(d, 250, 128)
    whole = sorted(map(tuple, ripley.random_points(sizes, 2, mask, 250).collect()))
    monkeypatch.setattr(ripley, "POINTS", 7)
    assert sorted(map(tuple, ripley.random_points(sizes, 2, mask, 250).collect())) == whole


def test_interpolation_keeps_known_values_and_ends(spark):
    rows = [(0, f, y, None if y is None else -2 * y) for f, y in enumerate([None, 2.0, None, None, 8.0, None])] + [(1, 0, None, 1.0)]
    got = frames.interpolate(spark.createDataFrame(rows, "cell int, frame int, x double, y double"), ["cell"], "frame", "x", "y").orderBy("cell", "frame").collect()
    assert [r["x"] for r in got] == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0, None] and [r["y"] for r in got] == [-4.0, -4.0, -8.0, -12.0, -16.0, -16.0, 1.0]


def test_rows_without_drift_stay(spark):
    d = points(spark, [(5, 6), (7, 8)])
    known = spark.createDataFrame([(0, 1, 2.0, 3.0)], "cell long, frame long, dx double, dy double")
    assert sorted((r["x_m"], r["y_m"]) for r in drift.subtract_drift(d, known).collect()) == [(5.0, 5.0), (5.0, 6.0)]


def test_gold_is_split_from_the_rest(spark):
    b = fixture.beads(spark, DIR).where("cell = 0").withColumn("loc_id", F.col("frame") * 3 + F.col("bead"))
    gold = drift.find_gold(b, 1440, 5000, rmsd=(0.0, 2000.0))
    picked, rest = drift.split_gold(b, gold, 6250)
    assert picked.select("pick").distinct().count() == 3 and picked.count() + rest.count() == b.count()
    picked, rest = drift.split_gold(b, gold.limit(2), 6250)
    assert picked.count() == 0 and rest.count() == b.count()  # two picks are no gold


def test_fiducials_move_the_channels(spark):
    d = fixture.locs(spark, DIR).where("cell = 0 and not is_noise").drop("channel")
    marks = d.withColumn("channel", F.lit(0)).unionByName(d.withColumns({"channel": F.lit(1), "x_m": F.col("x_m") + 400}))
    df = points(spark, [(100, 100), (300, 300)]).withColumn("channel", F.col("loc_id").cast("int"))
    rows, shifts = drift.align_channels(df, 100, 6, 2, fiducials=marks)
    got = {r["channel"]: r["x_m"] for r in rows.collect()}
    assert got[1] - got[0] == pytest.approx(200 - 400, abs=60) and shifts.count() >= 2


def test_smlm_in_three_dimensions(spark):
    rows = [(0, 0, 0), (10, 0, 0), (0, 10, 10), (0, 0, 500), (5, 5, 505)]
    d = spark.createDataFrame([(i, 0, x, y, z, i) for i, (x, y, z) in enumerate(rows)], "loc_id long, cell long, x_m long, y_m long, z_nm long, frame long")
    flat = cluster.smlm_cluster(d, 50, 2).select("peak").distinct().count()
    deep = {r["loc_id"]: r["peak"] for r in cluster.smlm_cluster(d, 50, 2, radius_z=30).collect()}
    assert flat == 1 and deep[0] == deep[1] == deep[2] != deep[3] == deep[4]


def test_dbscan_of_crowded_cells_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    pts = np.concatenate([rng.integers(0, 60, (80, 2)), rng.integers(100, 400, (60, 2)), rng.integers(0, 2000, (40, 2))])
    got = {r["loc_id"]: r["group"] for r in cluster.dbscan(points(spark, pts), 40, 5).collect()}
    near = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(2) <= 1600
    core = near.sum(1) >= 5
    label = np.where(core, np.arange(len(pts)), len(pts))
    while True:
        new = np.where(core, np.where(near & core[None, :], label[None, :], len(pts)).min(1), len(pts))
        if (new == label).all():
            break
        label = new
    label = np.where(core, label, np.where(near & core[None, :], label[None, :], len(pts)).min(1))
    number = {x: k for k, x in enumerate(sorted(set(label) - {len(pts)}))}
    assert got == {i: number.get(x, -1) for i, x in enumerate(label)}


def test_errors_that_the_inventory_asks_for(spark):
    d = fixture.locs(spark, DIR)
    assert io.gather_cells(d, strict=True).count() == 2
    with pytest.raises(ValueError):
        io.gather_cells(d.where("cell = 0 or channel < 2"), strict=True)
    with pytest.raises(ValueError):
        barcodes.filter_by_barcode(d, [1, 0], 5)


def test_significant_barcodes_of_known_numbers(spark):
    rows = [("exp", c, "a", 10.0 + c) for c in range(6)] + [("csr", c, "a", 2.0 + c % 2) for c in range(6)] + [(o, c, "b", float(c % 3)) for o in ("exp", "csr") for c in range(6)]
    got = {r["barcode"]: r for r in barcodes.significant_barcodes(spark.createDataFrame(rows, "origin string, cell int, barcode string, v double"), 0.05, 0.1, 0.5).collect()}
    assert got["a"]["significant"] and got["a"]["label"] == "p<0.001" and not got["b"]["significant"] and got["b"]["p"] == pytest.approx(1)
    assert got["a"]["share"] == pytest.approx(75 / 81) and got["b"]["cell_share"] == pytest.approx(4 / 6)


def test_clusters_without_density_are_in_neither_part(spark):
    props = spark.createDataFrame([(1, 5.0), (2, 1.0), (3, None)], "group int, density double")
    got = {r["group"]: r["class"] for r in cluster.split_by_threshold(props, "density", 2.0).collect()}
    assert got == {1: "large", 2: "small", 3: None}


@pytest.mark.parametrize("stretch", [1, 3])
def test_each_pair_is_met_once(spark, stretch):
    rng = np.random.default_rng(8)
    pts = rng.integers(-300, 300, (120, 3))
    d = spark.createDataFrame([(i, i % 2, *map(int, p)) for i, p in enumerate(pts)], "loc_id long, cell int, x_m long, y_m long, z_nm long")
    for dims in (("x_m", "y_m"), ("x_m", "y_m", "z_nm")):
        got = [(r["loc_id"], r["o_loc_id"]) for r in pairs_once(d, 60, ("cell",), dims, stretch=stretch).collect()]
        near = ((pts[:, None, : len(dims)] - pts[None, :, : len(dims)]) ** 2).sum(2) <= 3600
        want = {(i, j) for i in range(120) for j in range(i + 1, 120) if near[i, j] and i % 2 == j % 2}
        assert len(got) == len(want) and {tuple(sorted(p)) for p in got} == want
