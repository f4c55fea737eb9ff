"""Localization tables projected from the events table (one text for Spark and for the SQL oracles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .io import unpacked

_LOCS = """SELECT event_id AS loc_id, user_id AS true_cluster, event_type AS tag,
  CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS INT) AS channel,
  CAST(floor(user_id / 10.0) AS BIGINT) AS cell,
  CASE WHEN CAST(floor(user_id / 10.0) AS BIGINT) % 2 = 0 THEN 'ctrl' ELSE 'stim' END AS stimulation,
  CAST(floor(({EPOCH} - 1704067200) / 1800) AS BIGINT) AS frame,
  event_id % 5 = 0 AS is_noise,
  CASE WHEN event_id % 5 = 0 THEN (event_id * 48271) % 31991
       ELSE (user_id * 7919) % 30000 + 1000 + (event_id * 48271) % 401 + (event_id * 16807) % 409 - 404 END AS x_m,
  CASE WHEN event_id % 5 = 0 THEN (event_id * 69621) % 31981
       ELSE (user_id * 104729) % 30000 + 1000 + (event_id * 69621) % 397 + (event_id * 39373) % 389 - 392 END AS y_m,
  (event_id * 40692) % 401 - 200 AS z_nm,
  value AS photons,
  CAST((event_id * 31) % 100 AS DOUBLE) / 250 AS sx_raw, CAST((event_id * 37) % 100 AS DOUBLE) / 250 AS sy_raw,
  CAST((event_id * 41) % 50 AS DOUBLE) AS bg,
  CAST((event_id * 43) % 100 + 50 AS DOUBLE) / 5000 AS lpx, CAST((event_id * 47) % 100 + 50 AS DOUBLE) / 5000 AS lpy,
  CAST((event_id * 53) % 9973 - 3000 AS DOUBLE) AS net_gradient
FROM {EVENTS}"""

#: The locs table as a common table expression of DuckDB.
LOCS_SQL = _LOCS.format(EPOCH="epoch(ts)", EVENTS="events")
_BEADS = """SELECT cell, bead, f AS frame,
  CAST(4000 + bead * 10000 + f * 2 + (f * 48271 + bead * 16807 + cell * 69621) % 41 - 20 AS BIGINT) AS x_m,
  CAST(5000 + bead * 9000 - f + (f * 39373 + bead * 40692 + cell * 16807) % 41 - 20 AS BIGINT) AS y_m
FROM (SELECT DISTINCT cell FROM {LOCS}) c CROSS JOIN (SELECT {R3} AS bead) b CROSS JOIN (SELECT {RF} AS f) t"""
BEADS_SQL = _BEADS.format(LOCS="locs", R3="unnest(range(3))", RF="unnest(range(1440))")


def locs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """loc_id, cell, tag, channel, stimulation, frame, x_m, y_m (milli-pixels), z_nm, photons, ..."""
    unpacked(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(_LOCS.format(EPOCH="CAST(CAST(ts AS TIMESTAMP) AS DOUBLE)", EVENTS="{events}"), events=events)


def beads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three beads a cell in every frame with a planted drift of (2, -1) milli-pixels a frame."""
    return spark.sql(_BEADS.format(LOCS="{locs}", R3="explode(sequence(0, 2))", RF="explode(sequence(0, 1439))"), locs=locs(spark, sf_dir))
