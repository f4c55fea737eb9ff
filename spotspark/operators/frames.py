"""Filters, projections, per-frame statistics, sorts and set operations on localization tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import small


def filter_range(df: DataFrame, field: str, low: float, high: float) -> DataFrame:
    """Both ends belong to the range; nulls drop."""
    return df.where(F.col(field).between(low, high))


def to_nm(df: DataFrame, pixelsize: float = 130.0) -> DataFrame:
    """X, y from milli-pixels to nanometres; z stays."""
    return df.withColumns({"x_nm": F.col("x_m") / F.lit(1000.0) * F.lit(pixelsize), "y_nm": F.col("y_m") / F.lit(1000.0) * F.lit(pixelsize)})


def scale_columns(df: DataFrame, columns: list[str], factor: float) -> DataFrame:
    """All columns must have one type."""
    kinds = {df.schema[c].dataType.simpleString() for c in columns}
    if len(kinds) > 1:
        raise ValueError(f"columns have different types: {sorted(kinds)}")
    return df.withColumns({c: F.col(c) * F.lit(factor) for c in columns})


def sample_frames(df: DataFrame, n_frames: int, start_percent: float, n: int) -> DataFrame:
    """Rows of evenly spaced frames from a share of the movie on."""
    start = int(start_percent / 100 * n_frames)
    rest = n_frames - start
    step = max(1, int(rest / (n - 1)))
    return df.where(F.col("frame").isin(list(range(start, rest, step)))) if rest > start else df.limit(0)


def apply_shift(df: DataFrame, shifts: DataFrame) -> DataFrame:
    """Shifts: channel, dx, dy; a row a channel."""
    return df.join(small(shifts), "channel").withColumns({"x_m": F.col("x_m") - F.col("dx"), "y_m": F.col("y_m") - F.col("dy")}).drop("dx", "dy")


def locs_per_frame(df: DataFrame, n_frames: int) -> DataFrame:
    """G1: counts with 0 for empty frames."""
    spine = df.sparkSession.range(n_frames).select(F.col("id").alias("frame"))
    return spine.join(df.groupBy("frame").agg(F.count("*").alias("n")), "frame", "left").select("frame", F.coalesce("n", F.lit(0)).alias("n"))


def frame_stats(df: DataFrame, columns: tuple[str, ...] = ("photons", "sx_raw", "sy_raw")) -> DataFrame:
    """Mean and sample standard deviation by cell and frame."""
    return df.groupBy("cell", "frame").agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_samp))])


def nearest_to_threshold(df: DataFrame, field: str, threshold: float, n: int) -> DataFrame:
    """The n rows nearest to a value (a top-n report)."""
    return df.orderBy(F.abs(F.col(field) - threshold), field, "loc_id").limit(n)


def sort_by_frame(df: DataFrame) -> DataFrame:
    """By cell and frame in ranges, stable: a large cell is many tasks, whose order is that of their partitions."""
    return df.repartitionByRange("cell", "frame", "loc_id").sortWithinPartitions("cell", "frame", "loc_id")


def combine_channels(parts: list[DataFrame]) -> DataFrame:
    """Stacked; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def same_table(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: one row that says whether both hold the same rows."""
    return a.exceptAll(b).limit(1).unionAll(b.exceptAll(a).limit(1)).agg((F.count("*") == 0).alias("same"))


def net_gradient_threshold(df: DataFrame, field: str = "net_gradient", zscore: int = 3, start: float = 0.0, bins: int = 499, accuracy: int = 1_000_000) -> DataFrame:
    """Threshold from the peak of a histogram and its half height on the low side; null where the peak has no low side.

    The 99.95 % quantile is the value of that rank up to 1 / accuracy of all rows, from mergeable summaries.
    """
    top = df.where(F.col(field) >= start).agg(F.percentile_approx(field, 0.9995, accuracy).cast("double").alias("top"))
    one = df.where(F.col(field) >= start).crossJoin(F.broadcast(top)).where(F.col(field) <= F.col("top"))  # one row
    step = (F.col("top") - start) / F.lit(float(bins))
    hist = one.select(F.least(F.lit(bins - 1), F.floor((F.col(field) - start) / step)).cast("int").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(top))
    full = spine.join(hist, "bin", "left").fillna(0, ["n"])
    peak = full.agg(F.max_by("bin", F.struct("n", -F.col("bin"))).alias("peak"), F.max("n").alias("height"), F.max("top").alias("top"))
    low = full.select("bin", "n").crossJoin(F.broadcast(peak))
    nearest = F.min_by("bin", F.when(F.col("bin") < F.col("peak"), F.struct(F.abs(F.col("n") - F.col("height") / 2.0), "bin")))
    half = low.groupBy("peak", "top").agg(nearest.alias("half"))
    sigma = 2 * (F.col("peak") - F.col("half")) / F.sqrt(F.lit(4.0) * F.log(F.lit(2.0)))
    edge = F.least(F.lit(bins), F.col("peak") + F.floor(F.lit(zscore) * sigma))
    edge = F.when(F.col("half").isNotNull(), edge)
    return half.select("peak", "half", (F.lit(start) + edge * (F.col("top") - start) / F.lit(float(bins))).alias("threshold"))


def cumulative_shift(shifts: DataFrame) -> DataFrame:
    """Shifts: channel, iteration, shift."""
    w = Window.partitionBy("channel").orderBy("iteration").rowsBetween(Window.unboundedPreceding, 0)
    return shifts.withColumn("cum_shift", F.sum("shift").over(w))


def interpolate(df: DataFrame, keys: list[str], x: str, *values: str) -> DataFrame:
    """Fills nulls of each value linearly in x between known neighbours, flat at both ends. One pass each way: both frames grow
    from the start of their order, so each row is added once."""
    upto = lambda order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    known = {y: F.when(F.col(y).isNotNull(), F.struct(F.col(x).alias("x"), F.col(y).alias("y"))) for y in values}
    df = df.withColumns({f"__a_{y}": F.last(k, True).over(upto(F.col(x).asc())) for y, k in known.items()})
    df = df.withColumns({f"__b_{y}": F.last(k, True).over(upto(F.col(x).desc())) for y, k in known.items()})
    filled = {}
    for y in values:
        a, b = F.col(f"__a_{y}"), F.col(f"__b_{y}")
        line = a["y"] + (b["y"] - a["y"]) * (F.col(x) - a["x"]) / F.nullif(b["x"] - a["x"], F.lit(0))
        filled[y] = F.coalesce(F.col(y), line, a["y"], b["y"])
    return df.withColumns(filled).drop(*[f"__{k}_{y}" for y in values for k in "ab"])
