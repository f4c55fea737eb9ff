"""Exact order statistics of groups of any size: ranks are narrowed bin by bin, no group is held in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import cut, small

#: Rows of a group, or of the interval that holds a rank, that may meet in one task; bins of one round.
HELD, BINS = 100_000, 1024


def quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], held: int = HELD, bins: int = BINS) -> DataFrame:
    """(keys, q: array of the quantiles, linear between ranks). Null values take no part; a group without values has none. Values are finite.

    Groups of up to `held` rows are aggregated as they are. For others each needed rank starts with the interval from least to greatest value,
    counts it in `bins` bins, goes on with the span of the bin that holds the rank, and ends when the span is one value or holds few rows.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    sizes = cut(rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")))
    big = sizes.where(F.col("__n") > held)
    exact = F.percentile("__v", F.array(*[F.lit(float(p)) for p in probs])).alias("q")
    if big.limit(1).count() == 0:
        return rows.groupBy(*keys).agg(exact)
    few = rows.join(small(big.select(*keys)), keys, "left_anti").groupBy(*keys).agg(exact)
    own = rows.join(small(big.select(*keys)), keys, "left_semi")
    place = (F.col("__n") - 1) * F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__k") + 1)
    each = big.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(len(probs) - 1)))).withColumn("__place", place)
    each = each.withColumn("__rank", F.explode(F.array_distinct(F.array(F.floor("__place"), F.ceil("__place")))))
    weights = cut(each.select(*keys, "__k", "__place", "__rank"))
    open_ = cut(each.select(*keys, "__rank", F.col("__n").alias("__in"), "__lo", "__hi", F.lit(0).cast("long").alias("__below")).distinct())
    done = None
    while True:
        one = open_.where("__lo = __hi").select(*keys, "__rank", F.col("__lo").alias("__v"))
        less = open_.where(F.expr("__lo < __hi") & (F.col("__in") <= held))
        at = F.row_number().over(Window.partitionBy(*keys, "__rank").orderBy("__v")) - 1 + F.col("__below")
        few_rows = own.join(small(less), keys).where("__v BETWEEN __lo AND __hi").withColumn("__at", at).where("__at = __rank").select(*keys, "__rank", "__v")
        new = cut(one.unionByName(few_rows))
        done = new if done is None else done.unionByName(new)
        rest = open_.where(F.expr("__lo < __hi") & (F.col("__in") > held))
        if rest.limit(1).count() == 0:
            break
        bin_ = F.least(F.lit(bins - 1), F.floor((F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins))
        counts = own.join(small(rest), keys).where("__v BETWEEN __lo AND __hi").groupBy(*keys, "__rank", "__below", bin_.alias("__b")).agg(F.count("*").alias("__in"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        upto = F.col("__below") + F.sum("__in").over(Window.partitionBy(*keys, "__rank").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0))
        counts = counts.withColumn("__upto", upto).where((F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__in")))
        open_ = cut(counts.select(*keys, "__rank", "__in", "__lo", "__hi", (F.col("__upto") - F.col("__in")).alias("__below")))
    part = F.col("__v") * F.when(F.col("__rank") == F.col("__place"), 1.0).otherwise(F.lit(1.0) - F.abs(F.col("__place") - F.col("__rank")))
    found = weights.join(done, [*keys, "__rank"]).groupBy(*keys, "__k").agg(F.sum(part).alias("__q"))
    found = found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", "__q"))), lambda x: x["__q"]).alias("q"))
    return few.unionByName(found)
