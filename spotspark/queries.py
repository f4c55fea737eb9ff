"""Registered queries of the localization operators and their SQL oracles (both over the projection in sources.fixture)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import barcodes, cluster, drift, frames, neighbors, ripley
from .sources import fixture, io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RADII = list(range(0, 501, 50))
TAGS = ["click", "error", "purchase", "signup", "view"]
EPS, MINPTS, N_FRAMES = 150, 8, 1440
#: Controls of a pair of channels, mask pixel and raster, pixel and threshold of cluster areas, localizations from which a channel is present.
N_CONTROLS, PIXEL, RASTER, AREA_PIXEL, LARGE, PRESENT = 100, 250, 128, 50, 0.12, 13
#: Clusters found in data and in controls: controls of a cell, radius, points, localizations from which a channel is present.
FOUND_CONTROLS, FOUND_EPS, FOUND_MINPTS, FOUND_PRESENT = 3, 400, 5, 2


def query(name: str, sql: str | None = None, ctes: str = ""):
    def add(f: Callable[[DataFrame], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(fixture.locs(spark, sf_dir))
        if sql:
            ORACLES[name] = f"WITH RECURSIVE locs AS MATERIALIZED ({fixture.LOCS_SQL}){ctes} {sql}"
        return f

    return add


r6 = lambda c: F.round(c, 6)
#: To 4 digits, where exact ties are usual (quotients of counts): the last bits of a sum don't decide which way a tie goes.
to_4 = lambda c: F.round(F.round(c, 9), 4)
_D2 = "(a.x_m-b.x_m)*(a.x_m-b.x_m)+(a.y_m-b.y_m)*(a.y_m-b.y_m)"

# ---------------------------------------------------------------- sources


@query("read_localizations", "SELECT cell, count(*) AS nlocs FROM locs GROUP BY 1")
def _(d):
    path = io.scratch(d.sparkSession, "locs")
    d.select(*[c.split()[0] for c in io.LOCS.split(", ")]).write.parquet(path)
    return io.read_localizations(d.sparkSession, path).groupBy("cell").agg(F.count("*").alias("nlocs"))


@query("read_channels", "SELECT channel, tag, count(*) AS nlocs FROM locs GROUP BY 1, 2")
def _(d):
    paths = [io.scratch(d.sparkSession, "channel") for _ in TAGS]
    for p, t in zip(paths, sorted(TAGS), strict=True):
        d.where(F.col("tag") == t).drop("channel", "tag").write.parquet(p)
    return io.read_channels(d.sparkSession, paths, sorted(TAGS)).groupBy("channel", "tag").agg(F.count("*").alias("nlocs"))


@query("write_localizations", "SELECT cell, tag, count(*) AS n, CAST(sum(x_m) AS BIGINT) AS sx FROM locs GROUP BY 1, 2")
def _(d):
    path = io.scratch(d.sparkSession, "locs")
    io.write_localizations(d, path)
    return d.sparkSession.read.parquet(path).select(F.col("cell").cast("long").alias("cell"), "tag", "x_m").groupBy("cell", "tag").agg(F.count("*").alias("n"), F.sum("x_m").alias("sx"))


@query("append_provenance", "SELECT DISTINCT cell, s AS step, CASE s WHEN 0 THEN 'filter' ELSE 'dbscan' END AS generated_by, CASE s WHEN 0 THEN '10' ELSE '150' END AS param FROM locs, (SELECT CAST(unnest(range(2)) AS INT) AS s)")
def _(d):
    info = d.sparkSession.createDataFrame([], "cell long, step int, generated_by string, params map<string,string>")
    info = io.append_provenance(io.append_provenance(info, d, "filter", {"value": "10"}), d, "dbscan", {"value": "150"})
    return info.select("cell", "step", "generated_by", F.col("params")["value"].alias("param"))


@query("cluster_csv", "SELECT cell, count(*) AS n FROM locs GROUP BY 1")
def _(d):
    path = io.scratch(d.sparkSession, "csv")
    own = d.groupBy("cell").agg(F.count("*").alias("n"))
    io.write_cluster_csv(own, path)
    return io.read_cluster_csv(d.sparkSession, path, own.schema)


@query("gather_cells", "SELECT cell, tags, (SELECT count(DISTINCT tags) = 1 FROM g) AS same_tags FROM g", ", g AS (SELECT cell, string_agg(DISTINCT tag, ',' ORDER BY tag) AS tags FROM locs GROUP BY 1)")
def _(d):
    return io.gather_cells(d)


# ---------------------------------------------------------------- projections, filters, sets


@query("filter_range", "SELECT loc_id, round(photons, 6) AS photons FROM locs WHERE photons BETWEEN 20 AND 80")
def _(d):
    return frames.filter_range(d, "photons", 20, 80).select("loc_id", r6("photons").alias("photons"))


@query("to_nm", "SELECT loc_id, round(x_m / 1000.0::DOUBLE * 130.0::DOUBLE, 4) AS x_nm, round(y_m / 1000.0::DOUBLE * 130.0::DOUBLE, 4) AS y_nm, z_nm FROM locs")
def _(d):
    return frames.to_nm(d).select("loc_id", F.round("x_nm", 4).alias("x_nm"), F.round("y_nm", 4).alias("y_nm"), "z_nm")


@query("scale_columns", "SELECT loc_id, round(sx_raw * 2.5::DOUBLE, 6) AS sx_raw, round(sy_raw * 2.5::DOUBLE, 6) AS sy_raw FROM locs")
def _(d):
    return frames.scale_columns(d, ["sx_raw", "sy_raw"], 2.5).select("loc_id", r6("sx_raw").alias("sx_raw"), r6("sy_raw").alias("sy_raw"))


@query("sample_frames", "SELECT loc_id, frame FROM locs WHERE frame >= 144 AND frame < 1296 AND (frame - 144) % 144 = 0")
def _(d):
    return frames.sample_frames(d, N_FRAMES, 10, 10).select("loc_id", "frame")


@query("apply_shift", "SELECT loc_id, x_m - 300 * channel AS x_m, y_m + 200 * channel AS y_m FROM locs")
def _(d):
    shifts = d.select("channel").distinct().select("channel", (F.col("channel") * 300).cast("long").alias("dx"), (F.col("channel") * -200).cast("long").alias("dy"))
    return frames.apply_shift(d, shifts).select("loc_id", "x_m", "y_m")


@query("locs_per_frame", "SELECT f.frame, count(l.loc_id) AS n FROM (SELECT unnest(range(1440)) AS frame) f LEFT JOIN locs l ON l.frame = f.frame GROUP BY 1")
def _(d):
    return frames.locs_per_frame(d, N_FRAMES)


@query("frame_stats", "SELECT cell, frame, round(avg(photons), 6) AS mean_photons, round(stddev_samp(photons), 6) AS std_photons FROM locs GROUP BY 1, 2")
def _(d):
    return frames.frame_stats(d, ("photons",)).select("cell", "frame", r6("mean_photons").alias("mean_photons"), r6("std_photons").alias("std_photons"))


@query("nearest_to_threshold", "SELECT loc_id, net_gradient FROM locs ORDER BY abs(net_gradient - 1000), net_gradient, loc_id LIMIT 20")
def _(d):
    return frames.nearest_to_threshold(d, "net_gradient", 1000.0, 20).select("loc_id", "net_gradient")


@query("sort_by_frame", "SELECT cell, frame, loc_id FROM locs")
def _(d):
    return frames.sort_by_frame(d).select("cell", "frame", "loc_id")


@query("combine_channels", "SELECT loc_id, channel, CASE WHEN channel = 0 THEN z_nm END AS z_nm FROM locs")
def _(d):
    return frames.combine_channels([d.where("channel = 0").select("loc_id", "channel", "z_nm"), *[d.where(f"channel = {k}").select("loc_id", "channel") for k in range(1, 5)]])


@query("union_exp_csr", "SELECT 'exp' AS origin, cell, count(*) AS n FROM locs WHERE NOT is_noise GROUP BY 2 UNION ALL SELECT 'csr', cell, count(*) FROM locs WHERE is_noise GROUP BY 2")
def _(d):
    part = lambda c, o: d.where(c).groupBy("cell").agg(F.count("*").alias("n")).select(F.lit(o).alias("origin"), "cell", "n")
    return part("not is_noise", "exp").unionByName(part("is_noise", "csr"))


@query("distinct_groups", "SELECT DISTINCT cell, true_cluster FROM locs")
def _(d):
    return d.select("cell", "true_cluster").distinct()


@query("same_barcode_map", "SELECT 'halves' AS compared, true AS same UNION ALL SELECT 'shifted', false")
def _(d):
    maps = lambda c: d.where(c).select("tag", "channel").distinct()
    halves = frames.same_table(maps("frame % 2 = 0"), maps("frame % 2 = 1")).withColumn("compared", F.lit("halves"))
    shifted = frames.same_table(maps("true"), maps("true").withColumn("channel", (F.col("channel") + 1) % 5)).withColumn("compared", F.lit("shifted"))
    return halves.unionByName(shifted)


@query("top_picks", "SELECT cell, frame AS peak_frame, n FROM (SELECT cell, frame, count(*) AS n, row_number() OVER (PARTITION BY cell ORDER BY count(*) DESC, frame) AS k FROM locs GROUP BY 1, 2) WHERE k = 1")
def _(d):
    n = d.groupBy("cell", "frame").agg(F.count("*").alias("n"))
    return n.groupBy("cell").agg(F.max_by("frame", F.struct("n", -F.col("frame"))).alias("peak_frame"), F.max("n").alias("n"))


@query(
    "net_gradient_threshold",
    """SELECT peak, half, round(CASE WHEN half IS NOT NULL THEN least(499, peak + floor(3 * 2 * (peak - half) / sqrt(4.0::DOUBLE * ln(2.0::DOUBLE)))) * top / 499 END, 6) AS threshold FROM (
  SELECT any_value(peak) AS peak, any_value(top) AS top, arg_min(bin, abs(n - height / 2.0::DOUBLE) * 1000 + bin) FILTER (bin < peak) AS half FROM f, (SELECT max(n) AS height, arg_max(bin, n * 1000 - bin) AS peak FROM f))""",
    """, t AS (SELECT quantile_disc(net_gradient, 0.9995) AS top FROM locs WHERE net_gradient >= 0), h AS (SELECT CAST(least(498, floor(net_gradient / (top / 499.0::DOUBLE))) AS INT) AS bin, count(*) AS n FROM locs, t WHERE net_gradient >= 0 AND net_gradient <= top GROUP BY 1),
f AS (SELECT CAST(b AS INT) AS bin, coalesce(n, 0) AS n, top FROM (SELECT unnest(range(499)) AS b) LEFT JOIN h ON h.bin = b, t)""",
)
def _(d):
    return frames.net_gradient_threshold(d).withColumn("threshold", r6("threshold"))


@query("cumulative_shift", "SELECT cell AS channel, frame AS iteration, n AS shift, CAST(sum(n) OVER (PARTITION BY cell ORDER BY frame) AS BIGINT) AS cum_shift FROM (SELECT cell, frame, count(*) AS n FROM locs GROUP BY 1, 2)")
def _(d):
    return frames.cumulative_shift(d.groupBy(F.col("cell").alias("channel"), F.col("frame").alias("iteration")).agg(F.count("*").alias("shift")))


@query(
    "interpolate_drift",
    """SELECT cell, frame, round(CASE WHEN p IS NULL THEN ny WHEN q IS NULL THEN py WHEN q = p THEN py ELSE py + (ny - py) * (frame - p) / (q - p) END, 6) AS y FROM (
  SELECT cell, frame, last_value(CASE WHEN y IS NOT NULL THEN frame END IGNORE NULLS) OVER b AS p, last_value(y IGNORE NULLS) OVER b AS py, first_value(CASE WHEN y IS NOT NULL THEN frame END IGNORE NULLS) OVER f AS q, first_value(y IGNORE NULLS) OVER f AS ny FROM s
  WINDOW b AS (PARTITION BY cell ORDER BY frame ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY cell ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    ", s AS (SELECT c.cell, f.frame, m.y FROM (SELECT DISTINCT cell FROM locs) c CROSS JOIN (SELECT unnest(range(1440)) AS frame) f LEFT JOIN (SELECT cell, frame, avg(CAST(x_m AS DOUBLE)) AS y FROM locs GROUP BY 1, 2) m ON m.cell = c.cell AND m.frame = f.frame)",
)
def _(d):
    known = d.groupBy("cell", "frame").agg(F.avg("x_m").alias("y"))
    spine = d.select("cell").distinct().crossJoin(d.sparkSession.range(N_FRAMES).select(F.col("id").alias("frame")))
    return frames.interpolate(spine.join(known, ["cell", "frame"], "left"), ["cell"], "frame", "y").select("cell", "frame", r6("y").alias("y"))


# ---------------------------------------------------------------- neighbours

_RAD = ", radii AS (SELECT unnest([" + ",".join(map(str, RADII)) + "]) AS r)"


@query("pair_counts_self", f"SELECT c.cell, CAST(c.r AS BIGINT) AS r, count(p.d2) AS pairs FROM (SELECT DISTINCT cell, r FROM locs, radii) c LEFT JOIN p ON p.cell = c.cell AND p.d2 <= c.r * c.r GROUP BY 1, 2", _RAD + f", p AS (SELECT a.cell, {_D2} AS d2 FROM locs a JOIN locs b ON a.cell = b.cell AND a.loc_id <> b.loc_id WHERE {_D2} <= 250000)")
def _(d):
    return neighbors.pair_counts_self(d, RADII)


_CROSS = _RAD + f", p AS (SELECT a.cell, a.channel AS a, b.channel AS b, {_D2} AS d2 FROM locs a JOIN locs b ON a.cell = b.cell AND a.loc_id <> b.loc_id WHERE {_D2} <= 250000), spine AS (SELECT DISTINCT x.cell, x.channel AS a, y.channel AS b, r FROM locs x JOIN (SELECT DISTINCT cell, channel FROM locs) y ON x.cell = y.cell, radii), counts AS (SELECT s.cell, s.a, s.b, CAST(s.r AS BIGINT) AS r, count(p.d2) AS pairs FROM spine s LEFT JOIN p ON p.cell = s.cell AND p.a = s.a AND p.b = s.b AND p.d2 <= s.r * s.r GROUP BY 1, 2, 3, 4)"


@query("pair_counts_cross", "SELECT * FROM counts", _CROSS)
def _(d):
    return neighbors.pair_counts_cross(d, RADII)


_KNN = f", nn AS (SELECT loc_id, cell, CAST(k AS INT) AS k, sqrt(CAST(d2 AS DOUBLE)) AS d FROM (SELECT a.loc_id, a.cell, {_D2} AS d2, row_number() OVER (PARTITION BY a.loc_id ORDER BY {_D2}, b.loc_id) AS k FROM locs a JOIN locs b ON a.cell = b.cell AND a.loc_id <> b.loc_id) WHERE k <= 4)"


_D3 = f"({_D2}+(a.z_nm-b.z_nm)*(a.z_nm-b.z_nm))"
_XYZ = ("x_m", "y_m", "z_nm")


@query("pair_counts_self_3d", "SELECT c.cell, CAST(c.r AS BIGINT) AS r, count(p.d2) AS pairs FROM (SELECT DISTINCT cell, r FROM locs, radii) c LEFT JOIN p ON p.cell = c.cell AND p.d2 <= c.r * c.r GROUP BY 1, 2", _RAD + f", p AS (SELECT a.cell, {_D3} AS d2 FROM locs a JOIN locs b ON a.cell = b.cell AND a.loc_id <> b.loc_id WHERE {_D3} <= 250000)")
def _(d):
    return neighbors.pair_counts_self(d, RADII, dims=_XYZ)


@query("knn_3d", f"SELECT loc_id, cell, CAST(k AS INT) AS k, round(sqrt(CAST(d2 AS DOUBLE)), 6) AS d FROM (SELECT a.loc_id, a.cell, {_D3} AS d2, row_number() OVER (PARTITION BY a.loc_id ORDER BY {_D3}, b.loc_id) AS k FROM locs a JOIN locs b ON a.cell = b.cell AND a.loc_id <> b.loc_id) WHERE k <= 3")
def _(d):
    return neighbors.knn(d, 3, dims=_XYZ).select("loc_id", "cell", "k", r6("d").alias("d"))


@query("knn", "SELECT loc_id, cell, k, round(d, 6) AS d FROM nn", _KNN)
def _(d):
    return neighbors.knn(d, 4).select("loc_id", "cell", "k", r6("d").alias("d"))


@query("nn_scales", "SELECT cell, round(median(d) FILTER (k = 1), 6) AS nn1, round((median(d) FILTER (k = 1)) / 20, 6) AS dr, round(quantile_cont(d, 0.95) FILTER (k = 4), 6) AS q95 FROM nn GROUP BY 1", _KNN)
def _(d):
    return neighbors.nn_scales(neighbors.knn(d, 4), 4).select("cell", r6("nn1").alias("nn1"), r6("dr").alias("dr"), r6("q95").alias("q95"))


@query("nn_histogram", "SELECT k, least(19, CAST(floor(d / 50) AS INT)) AS bin, count(*) AS n FROM nn WHERE d <= 1000 GROUP BY 1, 2", _KNN)
def _(d):
    return neighbors.nn_histogram(neighbors.knn(d, 4), 50, 1000)


@query("nn_density_histogram", "SELECT cell, k, bin, round(n / (sum(n) OVER (PARTITION BY cell, k) * top / 49) * 1e6, 6) AS density FROM (SELECT cell, k, top, CAST(least(48, floor(d / (top / 49.0::DOUBLE))) AS INT) AS bin, count(*) AS n FROM nn JOIN (SELECT cell, quantile_cont(d, 0.99) FILTER (k = 4) AS top FROM nn GROUP BY 1) USING (cell) WHERE d <= top GROUP BY 1, 2, 3, 4)", _KNN)
def _(d):
    return neighbors.nn_density_histogram(neighbors.knn(d, 4), 4).select("cell", "k", "bin", r6(F.col("density") * 1e6).alias("density"))


@query("csr_density_mle", "SELECT cell, round(rho_init * 1e6, 6) AS rho_init, round(greatest(rho_init / 10, least(rho_init * 10, free)) * 1e6, 6) AS rho FROM (SELECT cell, 2.0::DOUBLE / (4 * pi() * pow(median(d) FILTER (k = 1), 2)) AS rho_init, sum(k) / sum(d * d) / pi() AS free FROM nn GROUP BY 1)", _KNN)
def _(d):
    return neighbors.csr_density_mle(neighbors.knn(d, 4)).select("cell", r6(F.col("rho_init") * 1e6).alias("rho_init"), r6(F.col("rho") * 1e6).alias("rho"))


@query("local_density", f"SELECT a.cell, a.loc_id, count(*) AS n FROM locs a JOIN locs b ON a.cell = b.cell AND {_D2} <= 22500 GROUP BY 1, 2")
def _(d):
    return neighbors.local_density(d, EPS)


@query("next_frame_neighbors", f"SELECT a.cell, a.loc_id, round(sqrt(CAST(min({_D2}) AS DOUBLE)), 6) AS d FROM locs a JOIN locs b ON a.cell = b.cell AND b.frame = a.frame + 1 AND {_D2} <= 1000000 GROUP BY 1, 2")
def _(d):
    return neighbors.next_frame_neighbors(d, 1000).select("cell", "loc_id", r6("d").alias("d"))


_LINK = f", e AS (SELECT a.cell, a.loc_id AS a, a.frame AS fa, b.loc_id AS b, b.frame AS fb, {_D2} AS d2 FROM locs a JOIN locs b ON a.cell = b.cell AND b.frame - a.frame BETWEEN 1 AND 4 AND {_D2} <= 10000), s AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY cell, a ORDER BY fb, d2, b) = 1), m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY cell, b ORDER BY fa DESC, d2, a) = 1)"


@query("link_edges", "SELECT cell, a, b FROM m", _LINK)
def _(d):
    return neighbors.link_edges(d, 100, 3)


@query(
    "link_locs",
    'SELECT l.cell, t.head AS track, min(frame) AS frame, max(frame) AS last_frame, max(frame) - min(frame) + 1 AS len, count(*) AS n, round(avg(x_m), 6) AS x, round(avg(y_m), 6) AS y, round(sum(photons), 4) AS photons, round(avg(bg), 6) AS bg, round(avg(lpx), 6) AS lpx, round(avg(sx_raw), 6) AS sx_raw FROM locs l JOIN t ON t.loc_id = l.loc_id GROUP BY 1, 2',
    _LINK + ", t AS (SELECT loc_id AS head, loc_id FROM locs WHERE loc_id NOT IN (SELECT b FROM m) UNION ALL SELECT t.head, m.b FROM t JOIN m ON m.a = t.loc_id)",
)
def _(d):
    t = neighbors.link_locs(d, 100, 3)
    return t.select("cell", "track", "frame", "last_frame", "len", "n", r6("x").alias("x"), r6("y").alias("y"), F.round("photons", 4).alias("photons"), *[r6(c).alias(c) for c in ("bg", "lpx", "sx_raw")])


@query(
    "rdf",
    f"SELECT cell, r, round(g * 1e6, 6) AS g, round(median(g) FILTER (r >= 300) OVER (PARTITION BY cell) * 1e6, 6) AS density FROM (SELECT c.cell, c.r, (c.pairs - b.pairs) / CAST(n AS DOUBLE) / ({2 * math.pi!r} * c.r * 50) AS g FROM counts c JOIN counts b ON b.cell = c.cell AND b.r = c.r - 50 JOIN (SELECT cell, count(*) AS n FROM locs GROUP BY 1) s ON s.cell = c.cell)",
    _RAD + f", p AS (SELECT a.cell, {_D2} AS d2 FROM locs a JOIN locs b ON a.cell = b.cell AND a.loc_id <> b.loc_id WHERE {_D2} <= 250000), counts AS (SELECT c.cell, CAST(c.r AS BIGINT) AS r, count(p.d2) AS pairs FROM (SELECT DISTINCT cell, r FROM locs, radii) c LEFT JOIN p ON p.cell = c.cell AND p.d2 <= c.r * c.r GROUP BY 1, 2)",
)
def _(d):
    return neighbors.rdf(d, 50, 500).select("cell", "r", r6(F.col("g") * 1e6).alias("g"), r6(F.col("density") * 1e6).alias("density"))


@query("picked_locs", "SELECT l.loc_id, c.pick FROM locs l JOIN c ON l.cell = c.cell AND (l.x_m - c.x_m) * (l.x_m - c.x_m) + (l.y_m - c.y_m) * (l.y_m - c.y_m) <= 160000", ", c AS (SELECT cell, loc_id AS pick, x_m, y_m FROM locs WHERE loc_id % 50 = 1)")
def _(d):
    return drift.picked_locs(d, d.where("loc_id % 50 = 1").withColumn("pick", F.col("loc_id")), 800).select("loc_id", "pick")


@query("nonpicked", "SELECT loc_id FROM locs WHERE loc_id NOT IN (SELECT l.loc_id FROM locs l JOIN c ON l.cell = c.cell AND (l.x_m - c.x_m) * (l.x_m - c.x_m) + (l.y_m - c.y_m) * (l.y_m - c.y_m) <= 160000)", ", c AS (SELECT cell, x_m, y_m FROM locs WHERE loc_id % 50 = 1)")
def _(d):
    return drift.nonpicked(d, drift.picked_locs(d, d.where("loc_id % 50 = 1").withColumn("pick", F.col("loc_id")), 800)).select("loc_id")


# ---------------------------------------------------------------- clusters

_DB = f""", pr AS MATERIALIZED (SELECT a.loc_id AS a, b.loc_id AS b FROM locs a JOIN locs b ON a.cell = b.cell AND {_D2} <= {EPS * EPS}),
core AS MATERIALIZED (SELECT a AS id FROM pr GROUP BY 1 HAVING count(*) >= {MINPTS}), ce AS MATERIALIZED (SELECT a, b FROM pr WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(id, lab) AS (SELECT id, id FROM core UNION SELECT ce.b, r.lab FROM reach r JOIN ce ON ce.a = r.id WHERE r.lab < ce.b), lab AS (SELECT id, min(lab) AS lab FROM reach GROUP BY 1),
al AS (SELECT id, lab FROM lab UNION ALL SELECT pr.a, min(lab) FROM pr JOIN lab ON lab.id = pr.b WHERE pr.a NOT IN (SELECT id FROM core) GROUP BY 1),
g AS MATERIALIZED (SELECT l.*, CASE WHEN lab IS NULL THEN -1 ELSE CAST(dense_rank() OVER (PARTITION BY l.cell ORDER BY lab NULLS LAST) - 1 AS INT) END AS "group" FROM locs l LEFT JOIN al ON al.id = l.loc_id)"""


_PLACED = ["loc_id", "cell", "x_m", "y_m"]  # dbscan shuffles all columns it is given


def _grouped(d: DataFrame) -> DataFrame:
    return io.cut(cluster.dbscan(d.select(*_PLACED, "tag", "frame"), EPS, MINPTS))


@query("dbscan", 'SELECT loc_id, cell, "group" FROM g', _DB)
def _(d):
    return cluster.dbscan(d.select(*_PLACED), EPS, MINPTS).select("loc_id", "cell", "group")


@query("cluster_centers", 'SELECT cell, "group", round(avg(x_m), 6) AS mean_x, round(stddev_pop(x_m), 6) AS std_x, round(avg(frame), 6) AS mean_frame, count(*) AS n FROM g WHERE "group" >= 0 GROUP BY 1, 2', _DB)
def _(d):
    return cluster.cluster_centers(_grouped(d)).select("cell", "group", r6("mean_x_m").alias("mean_x"), r6("std_x_m").alias("std_x"), r6("mean_frame").alias("mean_frame"), "n")


@query("cluster_composition", """SELECT s.cell, s."group", s.tag, count(g.loc_id) AS n, round(count(g.loc_id) * 100.0::DOUBLE / sum(count(g.loc_id)) OVER (PARTITION BY s.cell, s."group"), 6) AS percent FROM (SELECT DISTINCT x.cell, x."group", y.tag FROM g x, (SELECT DISTINCT tag FROM g WHERE "group" >= 0) y WHERE x."group" >= 0) s LEFT JOIN g ON g.cell = s.cell AND g."group" = s."group" AND g.tag = s.tag GROUP BY 1, 2, 3""", _DB)
def _(d):
    return cluster.cluster_composition(_grouped(d)).select("cell", "group", "tag", "n", r6("percent").alias("percent"))


@query("complete_grid", """SELECT cell, "group", """ + ", ".join(f"count(*) FILTER (tag = '{t}') AS {t}" for t in TAGS) + """ FROM g WHERE "group" >= 0 GROUP BY 1, 2""", _DB)
def _(d):
    return cluster.composition_wide(_grouped(d), TAGS)


@query("cluster_info", 'SELECT cell, count(*) AS n, count(*) FILTER ("group" >= 0) AS clustered, count(*) FILTER ("group" < 0) AS nonclustered, count(DISTINCT "group") FILTER ("group" >= 0) AS clusters FROM g GROUP BY 1', _DB)
def _(d):
    return cluster.cluster_info(_grouped(d))


_SM = f""", pr AS MATERIALIZED (SELECT a.cell, a.loc_id AS a, b.loc_id AS b, {_D2} AS d2 FROM locs a JOIN locs b ON a.cell = b.cell AND {_D2} <= {EPS * EPS}), deg AS (SELECT a AS id, count(*) AS n FROM pr GROUP BY 1),
pk AS (SELECT a FROM (SELECT pr.a, pr.b, row_number() OVER (PARTITION BY pr.a ORDER BY n DESC, pr.b) AS k FROM pr JOIN deg ON deg.id = pr.b) WHERE k = 1 AND a = b),
jn AS (SELECT cell, a AS loc_id, b AS peak FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d2, b) AS k FROM pr WHERE b IN (SELECT a FROM pk)) WHERE k = 1)"""


@query("smlm_cluster", "SELECT loc_id, cell, peak FROM jn WHERE peak IN (SELECT peak FROM jn GROUP BY 1 HAVING count(*) >= 8)", _SM)
def _(d):
    return cluster.smlm_cluster(d, EPS, 8)


@query("smlm_cluster_basic_fa", "SELECT loc_id, cell, peak FROM jn WHERE peak IN (SELECT peak FROM (SELECT peak, floor(frame * 20 / 1440.0::DOUBLE) AS part, count(*) AS n, sum(frame) AS f FROM jn JOIN locs USING (loc_id) GROUP BY 1, 2) GROUP BY 1 HAVING sum(n) >= 8 AND sum(f) / sum(n) BETWEEN 288 AND 1152 AND max(n) <= 0.8::DOUBLE * sum(n))", _SM)
def _(d):
    return cluster.smlm_cluster(d, EPS, 8, True, N_FRAMES)


@query("hdbscan")
def _(d):
    return cluster.hdbscan(d, 8, 5, 300).groupBy("cell").agg(F.count("*").alias("n"), F.sum((F.col("label") >= 0).cast("long")).alias("clustered"), F.count_distinct(F.when(F.col("label") >= 0, F.struct("part", "label"))).alias("clusters"))


_HULL = _DB + """, u AS MATERIALIZED (SELECT DISTINCT cell, "group" AS q, x_m AS x, y_m AS y FROM g WHERE "group" >= 0),
he AS (SELECT a.cell, a.q, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS byy FROM u a JOIN u b ON a.cell = b.cell AND a.q = b.q AND (a.x <> b.x OR a.y <> b.y) WHERE NOT EXISTS (SELECT 1 FROM u c WHERE c.cell = a.cell AND c.q = a.q AND (
  (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) < 0 OR ((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) = 0 AND (a.x - c.x) * (b.x - c.x) + (a.y - c.y) * (b.y - c.y) > 0)))),
hu AS (SELECT s.cell, s.q, coalesce(area, 0) AS area, CASE WHEN coalesce(area, 0) > 0 THEN around ELSE 0 END AS around FROM (SELECT DISTINCT cell, q FROM u) s LEFT JOIN (SELECT cell, q, sum(ax * byy - bx * ay) / 2.0::DOUBLE AS area, sum(sqrt(CAST((ax - bx) * (ax - bx) + (ay - byy) * (ay - byy) AS DOUBLE))) AS around FROM he GROUP BY 1, 2) h ON h.cell = s.cell AND h.q = s.q)"""


@query("hull_metrics", 'SELECT cell, q AS "group", round(area, 6) AS convex_area, round(around, 4) AS convex_perimeter, round(CASE WHEN around > 0 THEN 4 * pi() * area / (around * around) ELSE 0 END, 6) AS convex_circularity FROM hu', _HULL)
def _(d):
    return cluster.hull_metrics(_grouped(d)).select("cell", "group", r6("convex_area").alias("convex_area"), F.round("convex_perimeter", 4).alias("convex_perimeter"), r6("convex_circularity").alias("convex_circularity"))


@query("cluster_report", 'SELECT g.loc_id, g.cell, g."group", round(h.area + h.around * 10, 4) AS area, round(CASE WHEN h.area + h.around > 0 THEN c.n / (h.area + h.around * 10) END, 9) AS density FROM g LEFT JOIN hu h ON h.cell = g.cell AND h.q = g."group" LEFT JOIN (SELECT cell, "group" AS q, count(*) AS n FROM g GROUP BY 1, 2) c ON c.cell = h.cell AND c.q = h.q', _HULL)
def _(d):
    members, _ = cluster.cluster_report(d.select(*_PLACED, "frame"), EPS, MINPTS, 10.0)
    return members.select("loc_id", "cell", "group", F.round("area", 4).alias("area"), F.round("density", 9).alias("density"))


@query("split_by_threshold", """SELECT cell, "group", n, round(area, 6) AS area, CASE WHEN area >= 0.12 THEN 'large' ELSE 'small' END AS by_area, CASE WHEN n / area >= 420 THEN 'large' ELSE 'small' END AS by_density FROM (
  SELECT cell, "group", count(*) AS n, count(DISTINCT (x_m // 50) * 1000000 + y_m // 50) * 0.0025::DOUBLE AS area FROM g WHERE "group" >= 0 GROUP BY 1, 2)""", _DB)
def _(d):
    props = io.cut(cluster.occupied_area(_grouped(d), AREA_PIXEL))
    by_area = cluster.split_by_threshold(props, "area", LARGE).withColumnRenamed("class", "by_area")
    return cluster.split_by_threshold(by_area, "density", 420).select("cell", "group", "n", r6("area").alias("area"), "by_area", F.col("class").alias("by_density"))


@query("attach_cluster_props", 'SELECT g.loc_id, g."group", p.n FROM g LEFT JOIN (SELECT cell, "group", count(*) AS n FROM g WHERE "group" >= 0 GROUP BY 1, 2) p ON p.cell = g.cell AND p."group" = g."group"', _DB)
def _(d):
    g = _grouped(d)
    return cluster.attach_cluster_props(g, cluster.cluster_centers(g).select("cell", "group", "n")).select("loc_id", "group", "n")


# ---------------------------------------------------------------- barcodes and statistics (planted clusters as groups)

_BC = f""", cn AS (SELECT cell, true_cluster AS "group", channel, tag, count(*) AS n FROM locs GROUP BY 1, 2, 3, 4), bm AS (SELECT cell, "group", CAST(sum(CASE WHEN n >= {PRESENT} THEN 1 << (4 - channel) ELSE 0 END) AS BIGINT) AS mask, CAST(sum(n) AS BIGINT) AS n FROM cn GROUP BY 1, 2), bc AS (SELECT *, '0b' || lpad(bin(mask), 5, '0') AS barcode FROM bm)"""
def _counts(d: DataFrame) -> DataFrame:
    return d.groupBy("cell", F.col("true_cluster").alias("group"), "channel", "tag").agg(F.count("*").alias("n"))


def _coded(d: DataFrame) -> DataFrame:
    return barcodes.barcode(_counts(d), 5, PRESENT)


@query("barcode", 'SELECT cell, "group", mask, n, barcode FROM bc', _BC)
def _(d):
    return _coded(d)


@query("barcode_map", "SELECT '0b' || lpad(bin(i), 5, '0') AS barcode, " + ", ".join(f"CAST((i >> {4 - k}) & 1 AS INT) AS {t}" for k, t in enumerate(TAGS)) + " FROM (SELECT unnest(range(32)) AS i)")
def _(d):
    return barcodes.barcode_map(d)


@query("filter_by_barcode", 'SELECT cell, "group" FROM bc WHERE mask = 31', _BC)
def _(d):
    return barcodes.filter_by_barcode(_coded(d), [1, 1, 1, 1, 1], 5).select("cell", "group")


@query("barcode_describe", 'SELECT barcode, count(*) AS "count", round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS "min", round(quantile_cont(n, 0.25), 6) AS q25, round(quantile_cont(n, 0.5), 6) AS q50, round(quantile_cont(n, 0.75), 6) AS q75, max(n) AS "max" FROM bc GROUP BY 1', _BC)
def _(d):
    return barcodes.barcode_describe(_coded(d)).select("barcode", "count", r6("mean").alias("mean"), r6("std").alias("std"), "min", r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"), "max")


_PROPS = ["n", "area", "density"]
_STATS = [*_PROPS, *[f"{k}_{t}" for k in ("n", "percent") for t in TAGS]]
_CELLS = f""", mem AS (SELECT *, CASE WHEN is_noise THEN -1 ELSE true_cluster END AS g FROM locs),
cl AS (SELECT *, n / area AS density, {", ".join(f"n_{t} * 100.0::DOUBLE / n AS percent_{t}" for t in TAGS)} FROM (SELECT cell, g, count(*) AS n, count(DISTINCT (x_m // 50) * 1000000 + y_m // 50) * 0.0025::DOUBLE AS area, {", ".join(f"count(*) FILTER (tag = '{t}') AS n_{t}" for t in TAGS)} FROM mem WHERE g >= 0 GROUP BY 1, 2)),
ks AS (SELECT *, 'all' AS class FROM cl UNION ALL SELECT *, CASE WHEN area >= {LARGE} THEN 'large' ELSE 'small' END FROM cl),
whole AS (SELECT cell, count(*) AS n_in_cell, {", ".join(f"count(*) FILTER (tag = '{t}') AS n_{t}_in_cell" for t in TAGS)} FROM locs GROUP BY 1),
cm AS (SELECT *, n_in_cell - n_in_clusters AS n_out_clusters, {", ".join(f"n_{t}_in_cell - n_{t}_in_clusters AS n_{t}_out_clusters" for t in TAGS)} FROM (SELECT cell, class, count(*) AS n_clusters, CAST(sum(n) AS BIGINT) AS n_in_clusters, {", ".join(f"CAST(sum(n_{t}) AS BIGINT) AS n_{t}_in_clusters" for t in TAGS)}, {", ".join(f"round(avg({c}), 6) AS mean_{c}, round(stddev_samp({c}), 6) AS std_{c}" for c in _STATS)} FROM ks GROUP BY 1, 2) JOIN whole USING (cell))"""
_SEM = ["n_clusters", "n_in_cell", "n_in_clusters", "n_out_clusters", "mean_n", "mean_area", "mean_density", "n_click_in_clusters", "mean_percent_click"]


def _report(d: DataFrame) -> DataFrame:
    members = d.withColumn("group", F.when(F.col("is_noise"), -1).otherwise(F.col("true_cluster")))
    clusters = cluster.split_by_threshold(cluster.occupied_area(members, AREA_PIXEL), "area", LARGE)
    return barcodes.cell_report(members, clusters, TAGS, _PROPS).withColumns({f"{k}_{c}": r6(f"{k}_{c}") for c in _STATS for k in ("mean", "std")})


@query("cell_means", "SELECT * FROM cm", _CELLS)
def _(d):
    return _report(d)


@query("stimulation_means", "SELECT CASE WHEN cell % 2 = 0 THEN 'ctrl' ELSE 'stim' END AS stimulation, class, count(*) AS n_cells, " + ", ".join(f"round(avg({c}), 4) AS mean_{c}, round(stddev_samp({c}) / sqrt(count({c})), 4) AS sem_{c}" for c in _SEM) + " FROM cm GROUP BY 1, 2", _CELLS)
def _(d):
    cells = _report(d).withColumn("stimulation", F.when(F.col("cell") % 2 == 0, "ctrl").otherwise("stim"))
    out = barcodes.stimulation_means(cells, _SEM, ("stimulation", "class"))
    return out.withColumns({f"{k}_{c}": F.round(f"{k}_{c}", 4) for c in _SEM for k in ("mean", "sem")})


@query("merge_cells", "SELECT cell, stimulation, count(*) AS n FROM locs GROUP BY 1, 2")
def _(d):
    halves = [d.where(f"cell % 2 = {k}").groupBy("cell", "stimulation").agg(F.count("*").alias("n")) for k in (0, 1)]
    return frames.combine_channels(halves)


@query("ttest_ind", "SELECT channel, n1, n2, round(m1, 6) AS m1, round(m2, 6) AS m2, n1 + n2 - 2 AS df, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)), 6) AS t FROM (SELECT channel, count(photons) FILTER (stimulation = 'stim') AS n1, count(photons) FILTER (stimulation = 'ctrl') AS n2, avg(photons) FILTER (stimulation = 'stim') AS m1, avg(photons) FILTER (stimulation = 'ctrl') AS m2, var_samp(photons) FILTER (stimulation = 'stim') AS v1, var_samp(photons) FILTER (stimulation = 'ctrl') AS v2 FROM locs GROUP BY 1)")
def _(d):
    t = barcodes.ttest_ind(d, ["channel"], "photons", "stimulation", "stim", "ctrl")
    return t.select("channel", "n1", "n2", r6("m1").alias("m1"), r6("m2").alias("m2"), "df", r6("t").alias("t"))


@query("significance_label", "SELECT loc_id, CASE WHEN photons / 1000 < 0.001 THEN 'p<0.001' WHEN photons / 1000 < 0.01 THEN 'p<0.01' WHEN photons / 1000 < 0.05 THEN 'p<0.05' ELSE 'n.s.' END AS label FROM locs")
def _(d):
    return d.select("loc_id", barcodes.significance_label(F.col("photons") / 1000).alias("label"))


# ---------------------------------------------------------------- masks, controls, Ripley

_MASK = ", mask AS (SELECT DISTINCT cell, i + a AS i, j + b AS j FROM (SELECT DISTINCT cell, x_m // 250 AS i, y_m // 250 AS j FROM locs), (SELECT unnest(range(-1, 2)) AS a), (SELECT unnest(range(-1, 2)) AS b) WHERE i + a BETWEEN 0 AND 127 AND j + b BETWEEN 0 AND 127)"


def _mask(d: DataFrame) -> DataFrame:
    return ripley.occupancy_mask(d, PIXEL, RASTER)


@query("occupancy_mask", "SELECT cell, i, j FROM mask", _MASK)
def _(d):
    return _mask(d)


@query("render_counts", "SELECT cell, channel, x_m // 1000 AS gx, y_m // 1000 AS gy, count(*) AS n FROM locs GROUP BY 1, 2, 3, 4")
def _(d):
    return ripley.render_counts(d, 1000)


_W = [math.exp(-k * k / 2) for k in range(-4, 5)]
_BLUR = "(SELECT unnest(range(-4, 5)) AS o, unnest([" + ", ".join(f"{w / sum(_W)!r}::DOUBLE" for w in _W) + "]) AS w)"


@query(
    "density_mask",
    "SELECT cell, gx * 2 + a AS i, gy * 2 + b AS j FROM g2 JOIN ot USING (cell), (SELECT unnest(range(2)) AS a), (SELECT unnest(range(2)) AS b) WHERE v >= otsu / 3",
    f""", g1 AS (SELECT cell, gx + o AS gx, gy, sum(n * w) AS v FROM (SELECT cell, x_m // 500 AS gx, y_m // 500 AS gy, count(*) AS n FROM locs GROUP BY 1, 2, 3), {_BLUR} GROUP BY 1, 2, 3), g2 AS MATERIALIZED (SELECT cell, gx, gy + o AS gy, sum(v * w) AS v FROM g1, {_BLUR} GROUP BY 1, 2, 3),
hs AS (SELECT cell, b, count(*) AS n, any_value(lo) + (b + 0.5::DOUBLE) * (any_value(hi) - any_value(lo)) / 256 AS c FROM (SELECT cell, lo, hi, least(255, floor((v - lo) / (hi - lo) * 256)) AS b FROM g2 JOIN (SELECT cell, min(v) AS lo, max(v) AS hi FROM g2 GROUP BY 1) USING (cell)) GROUP BY 1, 2),
ot AS (SELECT cell, arg_max(c, bt) AS otsu FROM (SELECT cell, c, sum(n) OVER l * sum(n) OVER h * pow(sum(n * c) OVER l / sum(n) OVER l - sum(n * c) OVER h / sum(n) OVER h, 2) AS bt FROM hs WINDOW l AS (PARTITION BY cell ORDER BY b ROWS UNBOUNDED PRECEDING), h AS (PARTITION BY cell ORDER BY b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) GROUP BY 1)""",
)
def _(d):
    return ripley.density_mask(d, 500)


@query("in_mask", "SELECT loc_id FROM locs l WHERE EXISTS (SELECT 1 FROM mask m WHERE m.cell = l.cell AND m.i = l.x_m // 250 AND m.j = l.y_m // 250)", _MASK)
def _(d):
    return ripley.in_mask(d, _mask(d), PIXEL).select("loc_id")


@query("mask_density", "SELECT l.cell, tag, count(*) AS n, round(any_value(area), 6) AS area, round(count(*) / any_value(area), 6) AS density FROM locs l JOIN (SELECT cell, count(*) * 0.0625::DOUBLE AS area FROM mask GROUP BY 1) a ON a.cell = l.cell WHERE EXISTS (SELECT 1 FROM mask m WHERE m.cell = l.cell AND m.i = l.x_m // 250 AND m.j = l.y_m // 250) GROUP BY 1, 2", _MASK)
def _(d):
    return ripley.mask_density(d, _mask(d), PIXEL).select("cell", "tag", "n", r6("area").alias("area"), r6("density").alias("density"))


_GTAG = _MASK + _RAD + f""", sp AS (SELECT DISTINCT cell, tag, r FROM locs, radii), pt AS (SELECT a.cell, a.tag, {_D2} AS d2 FROM locs a JOIN locs b ON a.cell = b.cell AND a.tag = b.tag AND a.loc_id <> b.loc_id WHERE {_D2} <= 250000),
ct AS (SELECT s.cell, s.tag, s.r, count(d2) AS pairs FROM sp s LEFT JOIN pt ON pt.cell = s.cell AND pt.tag = s.tag AND d2 <= s.r * s.r GROUP BY 1, 2, 3),
rd AS (SELECT cell, tag, median(x) FILTER (r >= 300) AS rdf FROM (SELECT cell, tag, r, (pairs - lag(pairs) OVER (PARTITION BY cell, tag ORDER BY r)) / CAST(n AS DOUBLE) / ({2 * math.pi!r}::DOUBLE * r * 50) AS x FROM ct JOIN (SELECT cell, tag, count(*) AS n FROM locs GROUP BY 1, 2) USING (cell, tag)) WHERE r > 0 GROUP BY 1, 2),
md AS (SELECT l.cell, tag, count(*) / any_value(area) AS mask FROM locs l JOIN (SELECT cell, count(*) * 0.0625::DOUBLE AS area FROM mask GROUP BY 1) a ON a.cell = l.cell WHERE EXISTS (SELECT 1 FROM mask m WHERE m.cell = l.cell AND m.i = l.x_m // 250 AND m.j = l.y_m // 250) GROUP BY 1, 2)"""


@query("density_summary", "SELECT tag, count(*) AS n_cells, round(avg(rdf) * 1e6, 6) AS mean_rdf, round(avg(mask), 6) AS mean_mask, round(median(mask), 6) AS median_mask FROM rd JOIN md USING (cell, tag) GROUP BY 1", _GTAG)
def _(d):
    by_rdf = neighbors.rdf(d, 50, 500, ("cell", "tag")).groupBy("cell", "tag").agg(F.max("density").alias("density"))
    by_mask = ripley.mask_density(d, _mask(d), PIXEL)
    out = ripley.density_summary(by_rdf, by_mask)
    return out.select("tag", "n_cells", r6(F.col("mean_rdf") * 1e6).alias("mean_rdf"), r6("mean_mask").alias("mean_mask"), r6("median_mask").alias("median_mask"))


_H0 = "((i * 48271 + control_id * 16958263 + cell * 696697347 + 12345) % 2147483647 + channel * 31337) % 2147483647"
_PTS = f", z AS (SELECT cell, channel, count(*) AS n FROM locs GROUP BY 1, 2), mk AS MATERIALIZED (SELECT cell, i, j, row_number() OVER (PARTITION BY cell ORDER BY i, j) - 1 AS k FROM mask), mm AS (SELECT cell, count(*) AS m FROM mask GROUP BY 1), rh AS (SELECT cell, channel, control_id, i AS loc_id, h2 // 7 AS q, ((h2 * h2) % 2147483647 + h1 * 40692) % 2147483647 // 7 AS w FROM (SELECT *, ((h1 * h1 % 2147483647) * 39373 + 11) % 2147483647 AS h2 FROM (SELECT *, (h0 * h0 + h0) % 2147483647 AS h1 FROM (SELECT cell, channel, control_id, i, {_H0} AS h0 FROM (SELECT cell, channel, unnest(range({N_CONTROLS})) AS control_id, n FROM z) z3, LATERAL (SELECT unnest(range(z3.n)) AS i) t)))), rp AS MATERIALIZED (SELECT rh.cell, channel, control_id, loc_id, mk.i * 250 + w % 250 AS x_m, mk.j * 250 + w // 250 % 250 AS y_m FROM rh JOIN mm ON mm.cell = rh.cell JOIN mk ON mk.cell = rh.cell AND mk.k = rh.q % mm.m)"
_RAND = _MASK + _PTS


@query("random_points_in_mask", "SELECT cell, channel, control_id, loc_id, x_m, y_m FROM rp", _RAND)
def _(d):
    return ripley.random_points(d.groupBy("cell", "channel").agg(F.count("*").alias("n")), N_CONTROLS, _mask(d), PIXEL)


# ---------------------------------------------------------------- clusters and barcodes of data and of random controls, found in one call

_FD2 = f"""{_MASK}{_PTS.replace(f"range({N_CONTROLS})", f"range({FOUND_CONTROLS})")}, tg AS (SELECT DISTINCT channel, tag FROM locs),
aw AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY origin, iter, cell, loc_id) AS id FROM (SELECT 'exp' AS origin, 0 AS iter, cell, loc_id, channel, tag, x_m, y_m FROM locs
  UNION ALL SELECT 'csr', control_id, rp.cell, rp.channel * 1099511627776 + loc_id, rp.channel, tag, x_m, y_m FROM rp JOIN tg ON tg.channel = rp.channel)),
pr AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM aw a JOIN aw b ON a.origin = b.origin AND a.iter = b.iter AND a.cell = b.cell AND {_D2} <= {FOUND_EPS * FOUND_EPS}),
core AS MATERIALIZED (SELECT a AS id FROM pr GROUP BY 1 HAVING count(*) >= {FOUND_MINPTS}), ce AS MATERIALIZED (SELECT a, b FROM pr WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(id, lab) AS (SELECT id, id FROM core UNION SELECT ce.b, r.lab FROM reach r JOIN ce ON ce.a = r.id WHERE r.lab < ce.b), lab AS (SELECT id, min(lab) AS lab FROM reach GROUP BY 1),
al AS (SELECT id, lab FROM lab UNION ALL SELECT pr.a, min(lab) FROM pr JOIN lab ON lab.id = pr.b WHERE pr.a NOT IN (SELECT id FROM core) GROUP BY 1),
g AS MATERIALIZED (SELECT l.*, CASE WHEN lab IS NULL THEN -1 ELSE CAST(dense_rank() OVER (PARTITION BY l.origin, l.iter, l.cell ORDER BY lab NULLS LAST) - 1 AS INT) END AS q FROM aw l LEFT JOIN al ON al.id = l.id)"""
_FOUND = _FD2 + f""", cn AS (SELECT origin, iter, cell, q, channel, tag, count(*) AS n FROM g WHERE q >= 0 GROUP BY 1, 2, 3, 4, 5, 6),
ar AS (SELECT origin, iter, cell, q, count(DISTINCT (x_m // {AREA_PIXEL}) * 1000000 + y_m // {AREA_PIXEL}) * 0.0025::DOUBLE AS area FROM g WHERE q >= 0 GROUP BY 1, 2, 3, 4),
ex AS MATERIALIZED (SELECT *, '0b' || lpad(bin(mask), 5, '0') AS barcode FROM (SELECT origin, iter, cell, q, CAST(sum(CASE WHEN n >= {FOUND_PRESENT} THEN 1 << (4 - channel) ELSE 0 END) AS BIGINT) AS mask FROM cn GROUP BY 1, 2, 3, 4))"""
_KEYED, _CLUSTER = ("origin", "iter", "cell"), ("origin", "iter", "cell", "group")


def _found(d: DataFrame) -> DataFrame:
    controls = ripley.random_points(d.groupBy("cell", "channel").agg(F.count("*").alias("n")), FOUND_CONTROLS, _mask(d), PIXEL)
    return io.cut(cluster.dbscan(io.cut(cluster.controls_beside(d, controls)), FOUND_EPS, FOUND_MINPTS, keys=_KEYED))


def _found_counts(found: DataFrame) -> DataFrame:
    return found.where(F.col("group") >= 0).groupBy(*_CLUSTER, "channel", "tag").agg(F.count("*").alias("n"))


def _found_codes(found: DataFrame) -> DataFrame:
    return barcodes.barcode(_found_counts(found), 5, FOUND_PRESENT, _CLUSTER)


@query("dbscan_controls", 'SELECT origin, iter, cell, loc_id, q AS "group" FROM g', _FD2)
def _(d):
    return _found(d).select(*_KEYED, "loc_id", "group")


_PER = "SELECT origin, cell, barcode, avg(v) AS v FROM (SELECT s.origin, s.cell, s.iter, b.barcode, {v} AS v FROM (SELECT DISTINCT origin, cell, iter FROM ex) s CROSS JOIN (SELECT DISTINCT barcode FROM ex) b LEFT JOIN ex ON ex.origin = s.origin AND ex.cell = s.cell AND ex.iter = s.iter AND ex.barcode = b.barcode LEFT JOIN ar ON ar.origin = ex.origin AND ar.iter = ex.iter AND ar.cell = ex.cell AND ar.q = ex.q GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3"
_NUMBERS = _PER.format(v="count(ex.mask)")


@query("barcode_numbers", f"SELECT origin, cell, barcode, round(v, 6) AS v FROM ({_NUMBERS})", _FOUND)
def _(d):
    return barcodes.per_iteration(_found_codes(_found(d))).withColumn("v", r6("v"))


@query("barcode_areas", f"SELECT origin, cell, barcode, round(v, 6) AS v FROM ({_PER.format(v='coalesce(sum(ar.area), 0)')})", _FOUND)
def _(d):
    found = _found(d)
    areas = cluster.occupied_area(found, AREA_PIXEL, _CLUSTER).select(*_CLUSTER, "area")
    return barcodes.per_iteration(_found_codes(found).join(areas, list(_CLUSTER)), "area").withColumn("v", r6("v"))


@query("ntargets_in_barcode", "SELECT origin, cell, barcode, tag, round(avg(m), 6) AS mean_n FROM (SELECT ex.origin, ex.cell, ex.iter, ex.barcode, cn.tag, avg(cn.n) AS m FROM ex JOIN cn ON cn.origin = ex.origin AND cn.iter = ex.iter AND cn.cell = ex.cell AND cn.q = ex.q GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4", _FOUND)
def _(d):
    found = _found(d)
    targets = _found_codes(found).drop("n").join(_found_counts(found).drop("channel"), list(_CLUSTER))
    return barcodes.ntargets_in_barcode(targets).withColumn("mean_n", r6("mean_n"))


@query(
    "degree_of_clustering",
    "SELECT origin, cell, round(avg(c), 6) AS clustered, round(avg(n - c), 6) AS nonclustered, round(avg(c) / (avg(c) + avg(n - c)), 6) AS fraction FROM (SELECT origin, cell, iter, count(*) AS n, count(*) FILTER (q >= 0) AS c FROM g GROUP BY 1, 2, 3) GROUP BY 1, 2",
    _FD2,
)
def _(d):
    info = _found(d).groupBy(*_KEYED).agg(F.count("*").alias("n"), F.sum((F.col("group") >= 0).cast("long")).alias("clustered"))
    return barcodes.degree_of_clustering(info).select("origin", "cell", *[r6(c).alias(c) for c in ("clustered", "nonclustered", "fraction")])


# p: Simpson's rule over the density of Student's t
_TEST = f""", nu AS MATERIALIZED ({_NUMBERS}),
st AS (SELECT barcode, count(v) FILTER (origin = 'exp') AS n1, count(v) FILTER (origin = 'csr') AS n2, avg(v) FILTER (origin = 'exp') AS m1, avg(v) FILTER (origin = 'csr') AS m2, var_samp(v) FILTER (origin = 'exp') AS v1, var_samp(v) FILTER (origin = 'csr') AS v2 FROM nu GROUP BY 1),
tt AS (SELECT barcode, n1 + n2 - 2 AS df, (m1 - m2) / nullif(sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)), 0) AS t FROM st),
pv AS (SELECT barcode, any_value(t) AS t, CASE WHEN any_value(t) IS NOT NULL THEN greatest(0, 1 - 2 * any_value(abs(t)) / 12000 * any_value(exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()))
    * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(1 + t * t * i * i / 16e6::DOUBLE / df, -(df + 1) / 2))) END AS p FROM tt, (SELECT unnest(range(4001)) AS i) GROUP BY 1),
xp AS (SELECT barcode, sum(v) / nullif(sum(sum(v)) OVER (), 0) AS share, avg(CASE WHEN v >= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS cell_share FROM nu WHERE origin = 'exp' GROUP BY 1)"""


@query(
    "significant_barcodes",
    """SELECT barcode, round(t, 6) AS t, round(p, 6) AS p, round(share, 6) AS share, round(cell_share, 6) AS cell_share, coalesce(p < 0.05 AND share > 0.01 AND cell_share > 0.5, false) AS significant,
  CASE WHEN p < 0.001 THEN 'p<0.001' WHEN p < 0.01 THEN 'p<0.01' WHEN p < 0.05 THEN 'p<0.05' ELSE 'n.s.' END AS label FROM pv JOIN xp USING (barcode)""",
    _FOUND + _TEST,
)
def _(d):
    numbers = io.cut(barcodes.per_iteration(_found_codes(_found(d))))
    return barcodes.significant_barcodes(numbers, 0.05, 0.01, 0.5).select("barcode", r6("t").alias("t"), r6("p").alias("p"), r6("share").alias("share"), r6("cell_share").alias("cell_share"), "significant", "label")


_JH = "(SELECT *, ((h1 * h1 % 2147483647) * 39373 + 11) % 2147483647 AS h2 FROM (SELECT *, (h0 * h0 + h0) % 2147483647 AS h1 FROM (SELECT *, (loc_id * 48271 + control_id * 16958263 + cell * 696697347 + 12345) % 2147483647 AS h0 FROM (SELECT *, unnest(range({n})) AS control_id FROM locs))))"
_JIT = f", jh AS (SELECT *, 300.0::DOUBLE * pow((h2 + 0.5::DOUBLE) / 2147483647.0::DOUBLE, 1.0::DOUBLE / 3.0::DOUBLE) AS jr, {2 * math.pi!r}::DOUBLE * (((h2 * h2) % 2147483647 + h1 * 40692) % 2147483647 + 0.5::DOUBLE) / 2147483647.0::DOUBLE AS phi FROM {_JH.format(n=N_CONTROLS)}), jt AS MATERIALIZED (SELECT loc_id, cell, channel, control_id, CAST(x_m + round(jr * cos(phi)) AS BIGINT) AS x_m, CAST(y_m + round(jr * sin(phi)) AS BIGINT) AS y_m FROM jh)"


@query("jitter_control", "SELECT loc_id, x_m, y_m, control_id FROM jt", _JIT)
def _(d):
    return ripley.jitter_control(d, N_CONTROLS, 300).select("loc_id", "x_m", "y_m", "control_id")


_CURVE = _CROSS + _MASK + ", ar AS (SELECT cell, count(*) * 62500.0::DOUBLE AS area FROM mask GROUP BY 1), na AS (SELECT cell, channel AS a, count(*) AS na FROM locs GROUP BY 1, 2), curve AS (SELECT c.*, area * pairs / (na * na) AS k FROM counts c JOIN na ON na.cell = c.cell AND na.a = c.a JOIN ar ON ar.cell = c.cell)"


@query("ripley_curves", "SELECT cell, a, b, r, pairs, round(k, 4) AS k, round(sqrt(k / pi()), 6) AS l, round(sqrt(k / pi()) - r, 6) AS h FROM curve", _CURVE)
def _(d):
    return ripley.ripley_curves(d, RADII, ripley.mask_area(_mask(d), PIXEL)).select("cell", "a", "b", "r", "pairs", F.round("k", 4).alias("k"), r6("l").alias("l"), r6("h").alias("h"))


_CTRL = _CURVE + _PTS + f""", cp AS (SELECT a.cell, a.control_id, a.channel AS a, b.channel AS b, {_D2} AS d2 FROM rp a JOIN rp b ON a.cell = b.cell AND a.control_id = b.control_id AND a.channel = b.channel AND a.loc_id <> b.loc_id WHERE {_D2} <= 250000
UNION ALL SELECT a.cell, a.control_id, a.channel, b.channel, {_D2} FROM rp a JOIN locs b ON a.cell = b.cell AND a.channel <> b.channel WHERE {_D2} <= 250000),
cc AS (SELECT s.cell, t.control_id, s.a, s.b, CAST(s.r AS BIGINT) AS r, count(cp.d2) AS pairs FROM spine s CROSS JOIN (SELECT unnest(range({N_CONTROLS})) AS control_id) t LEFT JOIN cp ON cp.cell = s.cell AND cp.control_id = t.control_id AND cp.a = s.a AND cp.b = s.b AND cp.d2 <= s.r * s.r GROUP BY 1, 2, 3, 4, 5),
ck AS (SELECT cc.*, area * pairs / (na * na) AS k FROM cc JOIN na ON na.cell = cc.cell AND na.a = cc.a JOIN ar ON ar.cell = cc.cell),
env AS (SELECT cell, a, b, r, avg(k) AS mean, quantile_cont(k, 0.025) AS lo, quantile_cont(k, 0.975) AS hi FROM ck GROUP BY 1, 2, 3, 4)"""


def _controls(d: DataFrame) -> DataFrame:
    return ripley.ripley_controls(d, RADII, _mask(d), PIXEL, N_CONTROLS)


@query("ripley_controls", "SELECT cell, control_id, a, b, r, pairs FROM cc", _CTRL)
def _(d):
    return _controls(d).select("cell", "control_id", "a", "b", "r", "pairs")


# shown as L = sqrt(K / pi): means of K are often exact ties of a rounding, which sums in another order tip over
@query("control_envelope", "SELECT cell, a, b, r, " + ", ".join(f"round(sqrt({c} / pi()), 6) AS {c}" for c in ("mean", "lo", "hi")) + " FROM env", _CTRL)
def _(d):
    return ripley.control_envelope(_controls(d)).select("cell", "a", "b", "r", *[r6(F.sqrt(F.col(c) / math.pi)).alias(c) for c in ("mean", "lo", "hi")])


_NORM = _CTRL + ", nm AS (SELECT c.cell, c.a, c.b, c.r, CASE WHEN CASE WHEN c.k >= mean THEN abs(hi - mean) ELSE abs(lo - mean) END > 1e-9 * abs(mean) THEN (c.k - mean) / CASE WHEN c.k >= mean THEN abs(hi - mean) ELSE abs(lo - mean) END END AS norm FROM curve c JOIN env e ON e.cell = c.cell AND e.a = c.a AND e.b = c.b AND e.r = c.r)"


def _normalized(d: DataFrame) -> DataFrame:
    return ripley.ripley_normalized(ripley.ripley_curves(d, RADII, ripley.mask_area(_mask(d), PIXEL)), ripley.control_envelope(_controls(d)))


@query("ripley_normalized", "SELECT cell, a, b, r, round(norm, 4) AS norm FROM nm", _NORM)
def _(d):
    return _normalized(d).select("cell", "a", "b", "r", to_4(F.col("norm")).alias("norm"))


_MAT = _NORM + ", mt AS (SELECT cell, a, b, coalesce(sum((norm + nx) / 2 * (rx - r)), 0) / 500 AS value FROM (SELECT *, lead(norm) OVER w AS nx, lead(r) OVER w AS rx FROM nm WHERE norm IS NOT NULL WINDOW w AS (PARTITION BY cell, a, b ORDER BY r)) GROUP BY 1, 2, 3)"


def _matrix(d: DataFrame) -> DataFrame:
    return ripley.curve_integral(_normalized(d), "norm").withColumnRenamed("matrix", "value")


@query("ripley_matrix", "SELECT cell, a, b, round(value, 4) AS value FROM mt", _MAT)
def _(d):
    return _matrix(d).select("cell", "a", "b", F.round("value", 4).alias("value"))


@query("ripley_average", "SELECT a, b, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std FROM mt GROUP BY 1, 2", _MAT)
def _(d):
    return ripley.matrix_average(_matrix(d), "value").select("a", "b", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query("significant_pairs", "SELECT cell, a, b, round(value, 4) AS value FROM mt WHERE a <= b AND value > 1.5", _MAT)
def _(d):
    return ripley.significant_pairs(_matrix(d), "value", 1.5).select("cell", "a", "b", F.round("value", 4).alias("value"))


@query("annulus_diff", "SELECT cell, a, b, r, CAST(coalesce(x, lag(x) OVER w) AS BIGINT) AS ring FROM (SELECT cell, a, b, r, lead(pairs) OVER w - pairs AS x FROM counts WINDOW w AS (PARTITION BY cell, a, b ORDER BY r)) WINDOW w AS (PARTITION BY cell, a, b ORDER BY r)", _CROSS)
def _(d):
    return ripley.annulus(neighbors.pair_counts_cross(d, RADII)).select("cell", "a", "b", "r", "ring")


@query("curve_integral", "SELECT cell, a, b, round(coalesce(sum((pairs + nx) / 2.0::DOUBLE * (rx - r)), 0), 4) AS integral FROM (SELECT *, lead(pairs) OVER w AS nx, lead(r) OVER w AS rx FROM counts WINDOW w AS (PARTITION BY cell, a, b ORDER BY r)) GROUP BY 1, 2, 3", _CROSS)
def _(d):
    c = neighbors.pair_counts_cross(d, RADII).withColumn("pairs", F.col("pairs").cast("double"))
    return ripley.curve_integral(c, "pairs").select("cell", "a", "b", F.round("integral", 4).alias("integral"))


@query(
    "rdf_matrix",
    f"SELECT cell, a, b, round(sum({math.pi!r}::DOUBLE * (2 * r * 50 + 2500) * (g - mean)), 4) AS value FROM gd JOIN ge USING (cell, a, b, r) WHERE g > hi OR g < lo GROUP BY 1, 2, 3",
    _CROSS + _JIT + f""", jp AS (SELECT a.cell, a.control_id, a.channel AS a, b.channel AS b, {_D2} AS d2 FROM jt a JOIN jt b ON a.cell = b.cell AND a.control_id = b.control_id AND a.loc_id <> b.loc_id WHERE {_D2} <= 250000),
js AS (SELECT s.cell, t.control_id, s.a, s.b, CAST(s.r AS BIGINT) AS r FROM spine s CROSS JOIN (SELECT unnest(range({N_CONTROLS})) AS control_id) t), jb AS (SELECT cell, control_id, a, b, CAST(ceil(sqrt(CAST(d2 AS DOUBLE)) / 50) * 50 AS BIGINT) AS r, count(*) AS n FROM jp GROUP BY 1, 2, 3, 4, 5),
jn AS (SELECT js.*, coalesce(n, 0) AS n FROM js LEFT JOIN jb USING (cell, control_id, a, b, r)), gc AS (SELECT cell, control_id, a, b, r - 50 AS r, n / ({math.pi!r}::DOUBLE * (r * r - (r - 50) * (r - 50))) AS g FROM jn WHERE r > 0),
ge AS (SELECT cell, a, b, r, avg(g) AS mean, quantile_cont(g, 0.025) AS lo, quantile_cont(g, 0.975) AS hi FROM gc GROUP BY 1, 2, 3, 4),
gd AS (SELECT cell, a, b, r, x / ({math.pi!r}::DOUBLE * ((r + 50) * (r + 50) - r * r)) AS g FROM (SELECT cell, a, b, r, lead(pairs) OVER (PARTITION BY cell, a, b ORDER BY r) - pairs AS x FROM counts) WHERE x IS NOT NULL)""",
)
def _(d):
    ring = F.lit(math.pi) * (F.col("r2") * F.col("r2") - F.col("r") * F.col("r"))
    data = ripley.rings(neighbors.pair_counts_cross(d, RADII)).withColumn("g", F.col("ring") / ring)
    controls = ripley.jittered_rings(d, RADII, N_CONTROLS, 300).withColumn("g", F.col("pairs") / ring)
    return ripley.rdf_matrix(data, controls).select("cell", "a", "b", F.round("value", 4).alias("value"))


@query("csr_nn_pdf", "SELECT cell, k, r, round(2.0::DOUBLE / CASE k WHEN 3 THEN 2 ELSE 1 END * pow(lam, k) * pow(CAST(r AS DOUBLE), 2 * k - 1) * exp(-lam * r * r), 9) AS p FROM (SELECT cell, count(*) / 1024e6::DOUBLE * pi() AS lam FROM locs GROUP BY 1), (SELECT CAST(unnest(range(401)) AS BIGINT) AS r), (SELECT CAST(unnest(range(1, 4)) AS BIGINT) AS k)")
def _(d):
    return ripley.csr_nn_pdf(d.groupBy("cell").agg((F.count("*") / F.lit(1024e6)).alias("density")), 3, 400).withColumn("p", F.round("p", 9))


# ---------------------------------------------------------------- drift, registration, interactions


@query("subtract_drift", "SELECT loc_id, x_m - 2 * frame AS x_m, y_m + frame AS y_m FROM locs")
def _(d):
    t = d.select("cell", "frame").distinct().select("cell", "frame", (F.col("frame") * 2).alias("dx"), (-F.col("frame")).alias("dy"))
    return drift.subtract_drift(d, t).select("loc_id", "x_m", "y_m")


_COLOC = f", nb AS (SELECT cell, a, c, b, oc FROM (SELECT a.cell, a.loc_id AS a, a.channel AS c, b.loc_id AS b, b.channel AS oc, row_number() OVER (PARTITION BY a.loc_id, b.channel ORDER BY {_D2}, b.loc_id) AS k FROM locs a JOIN locs b ON a.cell = b.cell AND a.channel <> b.channel AND {_D2} <= 10000) WHERE k = 1), m AS (SELECT p.* FROM nb p JOIN nb q ON p.a = q.b AND p.b = q.a WHERE p.c < p.oc), cp AS (SELECT x.cell, x.a, y.b, x.na - count(m.c) AS n_a, y.nb - count(m.c) AS n_b, count(m.c) AS n_ab FROM (SELECT cell, channel AS a, count(*) AS na FROM locs GROUP BY 1, 2) x JOIN (SELECT cell, channel AS b, count(*) AS nb FROM locs GROUP BY 1, 2) y ON x.cell = y.cell AND x.a < y.b LEFT JOIN m ON m.cell = x.cell AND m.c = x.a AND m.oc = y.b GROUP BY 1, 2, 3, x.na, y.nb)"


@query("colocalized_pairs", "SELECT * FROM cp", _COLOC)
def _(d):
    return drift.colocalized_pairs(d, 100)


@query("labeling_efficiency", "SELECT cell, a, b, round(n_ab / CAST(n_b + n_ab AS DOUBLE), 6) AS le_a, round(n_ab / CAST(n_a + n_ab AS DOUBLE), 6) AS le_b FROM cp", _COLOC)
def _(d):
    return drift.labeling_efficiency(drift.colocalized_pairs(d, 100)).select("cell", "a", "b", r6("le_a").alias("le_a"), r6("le_b").alias("le_b"))


@query("direct_interaction", "SELECT a AS from_tag, b AS to_tag, round(100.0::DOUBLE * ab / (n_a + ab), 6) AS percent FROM s UNION ALL SELECT b, a, round(100.0::DOUBLE * ab / (n_b + ab), 6) FROM s", _COLOC + ", s AS (SELECT a, b, CAST(sum(n_a) AS DOUBLE) AS n_a, CAST(sum(n_b) AS DOUBLE) AS n_b, CAST(sum(n_ab) AS DOUBLE) AS ab FROM cp GROUP BY 1, 2)")
def _(d):
    total = lambda c: F.sum(c).cast("double")
    none = {c: F.lit(0.0) for c in ("aa", "bb", "aabb")}  # pairs are looked for between channels
    shares = drift.colocalized_pairs(d, 100).groupBy(F.col("a").alias("tag_a"), F.col("b").alias("tag_b")).agg(total("n_a").alias("a"), total("n_b").alias("b"), total("n_ab").alias("ab"))
    return drift.direct_interaction(shares.withColumns(none)).withColumn("percent", r6("percent"))


_MAPS = """, mp AS (SELECT cell, a, b, 100.0::DOUBLE * n_ab / nullif(n_a + n_ab, 0) AS percent FROM cp UNION ALL SELECT cell, b, a, 100.0::DOUBLE * n_ab / nullif(n_b + n_ab, 0) FROM cp)"""


@query(
    "interaction_map_average",
    "SELECT a, b, count(*) AS n, round(CASE WHEN count(percent) = count(*) THEN avg(percent) END, 6) AS mean, round(CASE WHEN count(percent) = count(*) THEN stddev_pop(percent) END, 6) AS std FROM mp GROUP BY 1, 2",
    _COLOC + _MAPS,
)
def _(d):
    none = {c: F.lit(0.0) for c in ("aa", "bb", "aabb")}
    shares = drift.colocalized_pairs(d, 100).select("cell", F.col("a").alias("tag_a"), F.col("b").alias("tag_b"), *[F.col(f"n_{c}").cast("double").alias(c) for c in ("a", "b", "ab")]).withColumns(none)
    maps = drift.direct_interaction(shares, ("cell",)).withColumnsRenamed({"from_tag": "a", "to_tag": "b"})
    return ripley.matrix_average(maps, "percent", False).select("a", "b", "n", r6("mean").alias("mean"), r6("std").alias("std"))


@query("target_fractions", "SELECT tag, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 50000, 4) AS n_simulated FROM locs GROUP BY 1")
def _(d):
    return drift.target_fractions(d, 50000, 1e-4).select("tag", "n", r6("share").alias("share"), F.round("n_simulated", 4).alias("n_simulated"))


@query("expected_nn_peak", "SELECT cell, round(sqrt(2.0::DOUBLE / (4 * pi() * dn)), 4) AS peak FROM (SELECT cell, count(*) / 1024e6::DOUBLE AS dn FROM locs GROUP BY 1)")
def _(d):
    return drift.expected_nn_peak(d.groupBy("cell").agg((F.count("*") / F.lit(1024e6)).alias("density"))).select("cell", F.round("peak", 4).alias("peak"))


def _drifting(d: DataFrame) -> DataFrame:
    """Localizations with a drift of (2, -1) every eight frames added to their coordinates."""
    step = F.floor(F.col("frame") / 8)
    return d.withColumns({"x_m": F.col("x_m") + 2 * step, "y_m": F.col("y_m") - step})


_GOLD = """, pl AS (SELECT DISTINCT cell, c, CAST(round((y_m - s) / 1600.0::DOUBLE) AS BIGINT) AS r, s FROM (SELECT *, CASE WHEN c % 2 = 1 THEN 800.0::DOUBLE ELSE 0.0::DOUBLE END AS s FROM (SELECT cell, y_m, CAST(round(x_m / {dx!r}::DOUBLE) AS BIGINT) AS c FROM locs))),
c0 AS (SELECT cell, c * 1000003 + r AS pick, c * {dx!r}::DOUBLE AS x, r * 1600.0::DOUBLE + s AS y FROM pl),
c1 AS (SELECT c0.cell, pick, avg(x_m) AS x, avg(y_m) AS y FROM c0 JOIN locs l ON l.cell = c0.cell AND (l.x_m - x) * (l.x_m - x) + (l.y_m - y) * (l.y_m - y) <= 640000 GROUP BY 1, 2),
c2 AS (SELECT c1.cell, pick, avg(x_m) AS x, avg(y_m) AS y, count(*) AS n, sqrt(var_pop(x_m) + var_pop(y_m)) AS rmsd FROM c1 JOIN locs l ON l.cell = c1.cell AND (l.x_m - x) * (l.x_m - x) + (l.y_m - y) * (l.y_m - y) <= 640000 GROUP BY 1, 2),
gd AS (SELECT * FROM c2 WHERE n BETWEEN 60 * (1 - 0.25::DOUBLE * 1.4::DOUBLE) AND 60 * (1 + 0.25::DOUBLE * 1.4::DOUBLE) AND rmsd BETWEEN 0 AND 400),
gold AS (SELECT * FROM gd a WHERE NOT EXISTS (SELECT 1 FROM gd b WHERE b.cell = a.cell AND b.pick <> a.pick AND (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) <= 2560000 AND (b.n > a.n OR (b.n = a.n AND b.pick < a.pick))))""".format(dx=math.sqrt(3) / 2 * 1600)


@query("find_gold", "SELECT cell, round(x, 4) AS x_m, round(y, 4) AS y_m, n FROM gold", _GOLD)
def _(d):
    return drift.find_gold(d, 60, 1600).select("cell", F.round("x_m", 4).alias("x_m"), F.round("y_m", 4).alias("y_m"), "n")


_LINE = "CASE WHEN p IS NULL THEN n{0} WHEN q IS NULL OR q = p THEN p{0} ELSE p{0} + (n{0} - p{0}) * (frame - p) / (q - p) END"


@query(
    "undrift_from_picked",
    "SELECT cell, frame, " + ", ".join(f"round({_LINE.format(a)}, 6) AS d{a}" for a in "xy") + """ FROM (SELECT cell, frame, last_value(CASE WHEN dx IS NOT NULL THEN frame END IGNORE NULLS) OVER b AS p, last_value(dx IGNORE NULLS) OVER b AS px, last_value(dy IGNORE NULLS) OVER b AS py,
  first_value(CASE WHEN dx IS NOT NULL THEN frame END IGNORE NULLS) OVER f AS q, first_value(dx IGNORE NULLS) OVER f AS nx, first_value(dy IGNORE NULLS) OVER f AS ny FROM sp
  WINDOW b AS (PARTITION BY cell ORDER BY frame ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY cell ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    """, pk AS (SELECT cell, true_cluster AS pick, frame, loc_id, x_m + 2 * (frame // 8) AS x_m, y_m - frame // 8 AS y_m FROM locs WHERE NOT is_noise), rw AS (SELECT cell, pick, frame, arg_max(x_m, loc_id) AS x, arg_max(y_m, loc_id) AS y FROM pk GROUP BY 1, 2, 3),
of AS (SELECT cell, pick, frame, x - mx AS ox, y - my AS oy FROM rw JOIN (SELECT cell, pick, avg(x_m) AS mx, avg(y_m) AS my FROM pk GROUP BY 1, 2) USING (cell, pick)),
ms AS (SELECT cell, pick, 1 / greatest(avg((ox - ax) * (ox - ax)), 1e-12::DOUBLE) AS wx, 1 / greatest(avg((oy - ay) * (oy - ay)), 1e-12::DOUBLE) AS wy FROM of JOIN (SELECT cell, frame, avg(ox) AS ax, avg(oy) AS ay FROM of GROUP BY 1, 2) USING (cell, frame) GROUP BY 1, 2),
kn AS (SELECT cell, frame, sum(ox * wx) / sum(wx) AS dx, sum(oy * wy) / sum(wy) AS dy FROM of JOIN ms USING (cell, pick) GROUP BY 1, 2),
sp AS (SELECT c.cell, f.frame, dx, dy FROM (SELECT DISTINCT cell FROM pk) c CROSS JOIN (SELECT unnest(range(1440)) AS frame) f LEFT JOIN kn ON kn.cell = c.cell AND kn.frame = f.frame)""",
)
def _(d):
    picked = _drifting(d).where("not is_noise").withColumn("pick", F.col("true_cluster"))
    return drift.undrift_from_picked(picked, N_FRAMES).select("cell", "frame", r6("dx").alias("dx"), r6("dy").alias("dy"))


_SEG = ", im AS MATERIALIZED (SELECT cell, frame // 360 AS seg, CAST(floor((x_m + 2 * (frame // 8)) / 200.0) AS BIGINT) AS gx, CAST(floor((y_m - frame // 8) / 200.0) AS BIGINT) AS gy, count(*) AS n FROM locs GROUP BY 1, 2, 3, 4)"


@query("segment_correlation", "SELECT a.cell, a.seg AS i, b.seg AS j, b.gx - a.gx AS dx, b.gy - a.gy AS dy, CAST(sum(a.n * b.n) AS BIGINT) AS corr FROM im a JOIN im b ON a.cell = b.cell AND a.seg < b.seg AND abs(b.gx - a.gx) <= 4 AND abs(b.gy - a.gy) <= 4 GROUP BY 1, 2, 3, 4, 5", _SEG)
def _(d):
    return drift.correlation(_drifting(d).withColumn("seg", F.floor(F.col("frame") / 360)), "seg", 200, 4).select("cell", "i", "j", F.col("dx").cast("long").alias("dx"), F.col("dy").cast("long").alias("dy"), "corr")


@query("undrift_rcc")
def _(d):
    return drift.undrift_rcc(_drifting(d), N_FRAMES, 360, 200, 4).select("cell", "frame", F.round("dx", 3).alias("dx"), F.round("dy", 3).alias("dy"))


@query("undrift_aim")
def _(d):
    return drift.undrift_aim(_drifting(d), N_FRAMES, 240, 100, 400).select("cell", "frame", F.round("dx", 3).alias("dx"), F.round("dy", 3).alias("dy"))


@query("align_channels")
def _(d):
    moved = d.withColumns({"x_m": F.col("x_m") + 300 * F.col("channel"), "y_m": F.col("y_m") - 200 * F.col("channel")})
    return drift.align_channels(moved, 200, 8)[1].select("cell", "channel", "iteration", "sx", "sy", "cum_sx", "cum_sy")


@query("nena")
def _(d):
    near = io.cut(neighbors.next_frame_neighbors(d, 1000))
    s, a = drift.nena(near, 1000.0)
    return near.groupBy().agg(F.count("*").alias("n"), F.lit(round(s, 3)).alias("precision"), F.lit(round(a, 3)).alias("amplitude"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
