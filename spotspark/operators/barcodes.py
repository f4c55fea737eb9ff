"""Presence patterns (barcodes) of clusters, cell and condition statistics, significance."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import small
from .quantiles import quantiles


def barcode(groups: DataFrame, n_channels: int, least: int = 1, keys: tuple[str, ...] = ("cell", "group")) -> DataFrame:
    """keys with mask, n and text; the first channel is the highest bit. groups: keys, channel, n. A channel is present
    from `least` localizations on."""
    bit = F.call_function("shiftleft", F.lit(1), (n_channels - 1 - F.col("channel")).cast("int"))
    mask = F.sum(F.when(F.col("n") >= least, bit).otherwise(0)).cast("long")
    out = groups.groupBy(*keys).agg(mask.alias("mask"), F.sum("n").cast("long").alias("n"))
    text = F.bin("mask")
    return out.withColumn("barcode", F.concat(F.lit("0b"), F.lpad(text, F.greatest(F.lit(n_channels), F.length(text)), F.lit("0"))))


def barcode_map(channels: DataFrame) -> DataFrame:
    """all patterns with 0 or 1 for each tag. channels: tag, channel of any rows (a few distinct ones reach the driver)."""
    tags = [r["tag"] for r in channels.select("tag", "channel").distinct().orderBy("channel", "tag").limit(25).collect()]
    n = len(tags)
    if n > 24:
        raise ValueError("more than 24 channels: patterns are not listed")
    bit = lambda k: F.shiftright("id", n - 1 - k).bitwiseAND(F.lit(1)).cast("int").alias(tags[k])
    return channels.sparkSession.range(1 << n).select(F.concat(F.lit("0b"), F.lpad(F.bin("id"), n, "0")).alias("barcode"), *[bit(k) for k in range(n)])


def filter_by_barcode(coded: DataFrame, pattern: list[int], n_channels: int | None = None) -> DataFrame:
    """P5: clusters whose pattern is exactly this one; n_channels: an error if the pattern has another length."""
    if n_channels is not None and len(pattern) != n_channels:
        raise ValueError(f"a pattern of {len(pattern)} for {n_channels} channels")
    return coded.where(F.col("mask") == int("".join(map(str, pattern)), 2))


def barcode_describe(coded: DataFrame, value: str = "n") -> DataFrame:
    """Count, mean, std, min, quartiles (linear), max by barcode."""
    q = quantiles(coded, ["barcode"], value, [0.25, 0.5, 0.75])
    out = coded.groupBy("barcode").agg(F.count("*").alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max")).join(q, "barcode", "left")
    return out.select("barcode", "count", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def per_iteration(coded: DataFrame, value=None) -> DataFrame:
    """Count (or sum of value) by barcode x (origin, cell, iter) that has any cluster, 0 where missing, then the mean over iter."""
    amount = F.count("*") if value is None else F.sum(value)
    own = coded.groupBy("origin", "cell", "iter", "barcode").agg(amount.alias("v"))
    spine = coded.select("origin", "cell", "iter").distinct().crossJoin(small(coded.select("barcode").distinct()))  # at most 2^channels
    full = spine.join(own, ["origin", "cell", "iter", "barcode"], "left").fillna(0, ["v"])
    return full.groupBy("origin", "cell", "barcode").agg(F.avg("v").alias("v"))


def ntargets_in_barcode(targets: DataFrame) -> DataFrame:
    """Targets: origin, cell, iter, barcode, tag, n. Mean of n by iteration, then over iterations; missing is left out."""
    one = targets.groupBy("origin", "cell", "iter", "barcode", "tag").agg(F.avg("n").alias("m"))
    return one.groupBy("origin", "cell", "barcode", "tag").agg(F.avg("m").alias("mean_n"))


def cell_means(props: DataFrame, columns: list[str], keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """G6, clusters only: number of clusters, mean and sample deviation of the columns."""
    return props.groupBy(*keys).agg(F.count("*").alias("n_clusters"), *[f(c).alias(f"{k}_{c}") for c in columns for k, f in (("mean", F.avg), ("std", F.stddev_samp))])


def cell_report(members: DataFrame, clusters: DataFrame, tags: list[str], columns: list[str]) -> DataFrame:
    """One row for each cell and class (all, and those that clusters has): localizations in the cell, in and out of clusters, over all
    and by tag; means and sample deviations over clusters of the columns and of the number and percentage of each tag.

    members: cell, group (-1: none), tag; clusters: cell, group, class, columns. Cells without any cluster of a class have no row there.
    """
    kinds = F.explode(F.array_distinct(F.array(F.lit("all"), F.coalesce("class", F.lit("all")))))
    each = clusters.select("cell", "group", kinds.alias("class"), *columns)
    n = members.where(F.col("group") >= 0).groupBy("cell", "group").agg(*[F.sum((F.col("tag") == t).cast("long")).alias(f"n_{t}") for t in tags], F.count("*").alias("__all"))
    each = each.join(n, ["cell", "group"]).withColumns({f"percent_{t}": F.col(f"n_{t}") * 100.0 / F.col("__all") for t in tags})
    inside = [F.sum("__all").alias("n_in_clusters"), *[F.sum(f"n_{t}").alias(f"n_{t}_in_clusters") for t in tags]]
    stats = [*columns, *[f"{k}_{t}" for k in ("n", "percent") for t in tags]]
    spread = [f(c).alias(f"{k}_{c}") for c in stats for k, f in (("mean", F.avg), ("std", F.stddev_samp))]
    out = each.groupBy("cell", "class").agg(F.count("*").alias("n_clusters"), *inside, *spread)
    whole = members.groupBy("cell").agg(F.count("*").alias("n_in_cell"), *[F.sum((F.col("tag") == t).cast("long")).alias(f"n_{t}_in_cell") for t in tags])
    out = out.join(whole, "cell")
    rest = {f"n_{t}out_clusters": F.col(f"n_{t}in_cell") - F.col(f"n_{t}in_clusters") for t in ["", *[f"{t}_" for t in tags]]}
    return out.withColumns(rest)


def stimulation_means(cells: DataFrame, columns: list[str], by: tuple[str, ...] = ("stimulation",)) -> DataFrame:
    """Over cells: mean and standard error."""
    return cells.groupBy(*by).agg(F.count("*").alias("n_cells"), *[x for c in columns for x in (F.avg(c).alias(f"mean_{c}"), (F.stddev_samp(c) / F.sqrt(F.count(c))).alias(f"sem_{c}"))])


def degree_of_clustering(info: DataFrame) -> DataFrame:
    """Info: origin, cell, iter, n, clustered; iterations are averaged first."""
    one = info.groupBy("origin", "cell").agg(F.avg("clustered").alias("clustered"), F.avg(F.col("n") - F.col("clustered")).alias("nonclustered"))
    return one.withColumn("fraction", F.col("clustered") / F.nullif(F.col("clustered") + F.col("nonclustered"), F.lit(0.0)))


def student_p(t: float | None, df: int | None) -> float | None:
    """Two-sided p of Student's t: the incomplete beta function I_x(df / 2, 1 / 2) by its continued fraction (Lentz)."""
    if t is None or df is None or df <= 0:
        return None
    x, a, b = df / (df + t * t), df / 2, 0.5

    def fraction(a: float, b: float, x: float) -> float:
        tiny = 1e-300
        c, d = 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 300):
            for up in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 + up * d, 1 + up / c
                d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return h

    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def _p_values(t: pd.Series, df: pd.Series) -> pd.Series:
    """student_p of each row: one row for each key of a test."""
    none = t.isna() | df.isna()
    return pd.Series([None if x else student_p(a, b) for a, b, x in zip(t, df, none, strict=True)], dtype="float64")


def ttest_ind(df: DataFrame, keys: list[str], value: str, origin: str = "origin", first: str = "exp", second: str = "csr") -> DataFrame:
    """Pooled-variance t, degrees of freedom and p by key. One aggregate; p is computed on its few rows."""
    side = lambda s: F.when(F.col(origin) == s, F.col(value))
    agg = [f(side(s)).alias(f"{k}{i}") for i, s in ((1, first), (2, second)) for k, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))]
    g = df.groupBy(*keys).agg(*agg).withColumn("df", F.col("n1") + F.col("n2") - 2)
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / F.nullif(F.col("df"), F.lit(0))
    width = F.nullif(F.sqrt(pooled * (1 / F.nullif(F.col("n1"), F.lit(0)) + 1 / F.nullif(F.col("n2"), F.lit(0)))), F.lit(0.0))
    g = g.withColumn("t", (F.col("m1") - F.col("m2")) / width)
    return g.select(*keys, "n1", "n2", "m1", "m2", "df", "t", F.pandas_udf(_p_values, "double")("t", "df").alias("p"))


def significance_label(p, p_max: float = 0.05):
    """F6."""
    return F.when(p < 0.001, "p<0.001").when(p < 0.01, "p<0.01").when(p < p_max, f"p<{p_max:g}").otherwise("n.s.")


def significant_barcodes(numbers: DataFrame, p_max: float, population: float, cells: float) -> DataFrame:
    """Numbers: origin, cell, barcode, v (as G9)."""
    tests = ttest_ind(numbers, ["barcode"], "v")
    exp = numbers.where("origin = 'exp'").groupBy("barcode").agg(F.sum("v").alias("total"), F.avg((F.col("v") >= 1).cast("double")).alias("cell_share"))
    exp = exp.withColumn("share", F.col("total") / F.nullif(F.sum("total").over(Window.partitionBy()), F.lit(0.0)))  # a row for each barcode
    out = tests.join(exp, "barcode")
    good = (F.col("p") < p_max) & (F.col("share") > population) & (F.col("cell_share") > cells)
    return out.select("barcode", "t", "p", "share", "cell_share", F.coalesce(good, F.lit(False)).alias("significant"), significance_label(F.col("p"), p_max).alias("label"))
