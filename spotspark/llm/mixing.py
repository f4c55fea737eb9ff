"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its share of all words by weight, but at most `most` times its own size; the
excess goes to the others by weight (water filling). Within a source a document's expected copies are in proportion to its odds
class (long documents are repeated less, see LONG), at most `most`, scaled so that the source meets its target (water filling again, over
the classes). floor(rate) whole copies are certain, and the fraction p left is an inclusion probability: documents are ranked by the
random odds u / (1 - u) over the inclusion odds p / (1 - p), and the least are taken while they fit into the words that are still
missing. What is then missing is less than the next document; it is filled by those of the next ones in rank that fit, of which as many
are tried as have FILL times the missing words together, and at last by the least of them if that comes nearer. u comes from a hash of the doc_id, so reruns agree.

The borders are found by sums over ranges of the rank (twice 4096 ranges), so no source is ever ordered in one task; only
the rows of the one range that holds a source's border are ordered, and those that are tried after it.

Defined cases: null or empty text has size 0 and is taken 0 times; null source is a source of its own, ordered last;
sources whose size is 0 have target 0; null doc_ids are one id; ties in the rank go by doc_id, then size; repeated rows count as rows, and
rows alike in doc_id, source and size are taken alike.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, save

WORD = r"[^\x20\x09-\x0D]+"
#: Ranges of the rank at either level, as bits; words that are tried for each missing one.
BITS, FILL = 12, 16
#: Odds class of a document: halved at each of these sizes.
LONG = (1_000, 10_000)
#: Odds classes are powers of two within this exponent either way.
MOST_CLASS = 20


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the words of each whole text."""
    return docs.select("doc_id", "source", size_of("text").alias("size"))


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def odds_class(size: Column) -> Column:
    """Exponent of two of a document's odds."""
    return -sum(((size >= F.lit(n)).cast("int") for n in LONG[1:]), (size >= F.lit(LONG[0])).cast("int"))


def _level(amount: Column, cap: Column, weight: Column, size: Column, by: list, order: list) -> Column:
    """Water level: the share a unit of weight gets when rows beyond their cap are held to it. amount is dealt among the rows of
    `by`; order has the rows that reach their cap first in front. Null if all reach it."""
    everything = Window.partitionBy(*by)
    before = everything.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = amount - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    over = F.sum(weight * size).over(everything) - F.coalesce(F.sum(weight * size).over(before), F.lit(0.0))
    return left / F.nullif(over, F.lit(0.0))


def targets(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, target): one row for each source, found with windows over that one table of sources."""
    own = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.lit([float(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    own = own.select("source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(float(most))).alias("cap"))
    total = F.sum("source_size").over(Window.partitionBy())
    level = _level(total, F.col("cap"), F.col("w"), F.lit(1.0), [], [F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()])
    filled = own.withColumn("level", level)
    # past the first source that its share fits, the level only falls: the greatest that fits is the water level
    top = F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(Window.partitionBy())
    share = F.when(F.col("top").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * F.col("top")))
    return filled.withColumn("top", top).select("source", "source_size", share.alias("target"))


def rates(rows: DataFrame, per: DataFrame, most: float) -> DataFrame:
    """(source, class, rate): expected copies by source and odds class (at most 2 MOST_CLASS + 1 a source)."""
    classes = rows.groupBy("source", "class").agg(F.sum("size").alias("size"))
    classes = classes.join(per.select(F.col("source").alias("s"), "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    weight, cap = F.pow(F.lit(2.0), F.col("class").cast("double")), F.col("size") * F.lit(float(most))
    filled = classes.withColumn("level", _level(F.col("target"), cap, weight, F.col("size"), ["source"], [F.desc("class")]))
    top = F.max(F.when(F.col("level") * weight <= F.lit(float(most)), F.col("level"))).over(Window.partitionBy("source"))
    full = F.when(F.col("target") > 0, F.lit(float(most))).otherwise(F.lit(0.0))
    return filled.withColumn("top", top).select("source", "class", F.when(F.col("top").isNull(), full).otherwise(F.least(F.lit(float(most)), weight * F.col("top"))).alias("rate"))


def uniform(key: Column) -> Column:
    """A number in (0, 1) from the key alone."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


_KEY = ("v", "doc_id", "size")


def _within(r1: str, r2: str, edge: str) -> Column:
    """Whether a row's rank is at or before a border: range, range inside it, last key taken in there. A null range takes everything."""
    inner = F.when(F.col("r2") != F.col(r2), F.col("r2") < F.col(r2)).otherwise(F.coalesce(F.struct(*_KEY) <= F.col(edge), F.lit(False)))
    rank = F.when(F.col(r1).isNull(), True).when(F.col("r1") != F.col(r1), F.col("r1") < F.col(r1)).otherwise(inner)
    return F.coalesce(F.col("v").isNotNull() & rank, F.lit(False))


def _fitting(frame: pd.DataFrame) -> pd.DataFrame:
    """Of the rows after a source's border, in rank: those that fit into what is missing, and the least other one if that comes nearer."""
    frame = frame.sort_values(list(_KEY), na_position="first")
    missing, tried, most, taken, left = float(frame["missing"].iloc[0]), 0, FILL * float(frame["missing"].iloc[0]), [], []
    for k, size in enumerate(frame["size"]):
        taken.append(tried < most and size <= missing)
        if tried < most and not taken[-1]:
            left.append((size, k))
        tried += size
        missing -= size * taken[-1]
    if left and min(left)[0] < 2 * missing:
        taken[min(left)[1]] = True
    return frame.loc[taken, ["source", "doc_id", "size"]]


def allot(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, factor: str | None = None) -> DataFrame:
    """sized (doc_id, source, size) with source_size, target, taken, copies.

    factor: a column whose nearest power of two is a document's odds class within its source, instead of the class by its size.
    """
    kind = odds_class(F.col("size"))
    if factor:
        log = F.round(F.log2(F.greatest(F.coalesce(F.col(factor).cast("double"), F.lit(1.0)), F.lit(2.0**-MOST_CLASS))))
        kind = F.least(F.lit(MOST_CLASS), F.greatest(F.lit(-MOST_CLASS), log)).cast("int")
    u = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = save(sized.select("doc_id", "source", "size", kind.alias("class"), u.alias("u")), "mix-sizes")
    per = save(targets(rows, weights, most), "mix-sources")
    few = per.limit(200_001).count() <= 200_000

    def with_source(df: DataFrame, dim: DataFrame) -> DataFrame:
        """Joins one row for each source; sources are few but unbounded, so the size decides how (a hot one is split by Spark)."""
        dim = dim.withColumnRenamed("source", "s")
        on = df["source"].eqNullSafe(dim["s"])
        return df.join(F.broadcast(dim) if few else dim, on).drop("s")

    rate = save(rates(rows, per, most), "mix-rates").toDF("s", "c", "rate")
    ranked = rows.join(F.broadcast(rate) if few else rate, rows["source"].eqNullSafe(rate["s"]) & (rows["class"] == rate["c"])).drop("s", "c")
    ranked = ranked.withColumn("rate", F.when(F.col("size") > 0, F.col("rate")).otherwise(0.0))
    ranked = ranked.withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = ranked.withColumn("v", F.when((F.col("p") > 0) & (F.col("size") > 0), odds / (1 + odds)))
    top = F.lit((1 << BITS) - 1)
    ranked = ranked.withColumn("r1", F.least(top, F.floor(F.col("v") * (1 << BITS))))
    ranked = ranked.withColumn("r2", F.least(top, F.floor((F.col("v") * (1 << BITS) - F.col("r1")) * (1 << BITS))))
    sure = ranked.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"))
    state = with_source(sure, per).select("source", "source_size", "target", F.greatest(F.lit(0.0), F.col("target") - F.col("sure")).alias("missing"))
    state = save(state, "mix-state")

    def border(frame: DataFrame, level: str, open_: DataFrame) -> DataFrame:
        """For each source the range that holds its border, with what is still missing there. open_: source, missing."""
        sums = with_source(frame.groupBy("source", level).agg(F.sum("size").alias("n")), open_)
        upto = F.sum("n").over(Window.partitionBy("source").orderBy(level))  # at most 2 ** BITS rows a source
        here = (F.col("upto") > F.col("missing")) & (F.col("upto") - F.col("n") <= F.col("missing"))
        return sums.withColumn("upto", upto).where(here).select("source", F.col(level).alias(f"b{level}"), (F.col("missing") - F.col("upto") + F.col("n")).alias("missing"))

    def borders(rest: DataFrame, open_: DataFrame) -> tuple[DataFrame, DataFrame]:
        one = save(border(rest, "r1", open_), "mix-border")
        in_one = with_source(rest, one.select("source", "br1")).where(F.col("r1") == F.col("br1"))
        return in_one.drop("br1"), save(with_source(one.select("source", "br1"), border(in_one, "r2", one.select("source", "missing"))), "mix-border")

    choosable = ranked.where("v is not null").select("source", "doc_id", "size", "v", "r1", "r2")
    in_one, two = borders(choosable, state.select("source", "missing"))
    last = with_source(in_one, two).where(F.col("r2") == F.col("br2"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, 0))
    last = last.withColumn("upto", upto).where(F.col("upto") <= F.col("missing"))
    edge = last.groupBy("source").agg(F.max(F.struct(*_KEY)).alias("edge"), F.max("upto").alias("filled"))
    found = two.join(edge.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    found = found.select("source", "br1", "br2", "edge", (F.col("missing") - F.coalesce("filled", F.lit(0))).alias("missing"))
    found = save(found, "mix-edge")  # a source without a border takes all that is choosable
    # the next ones in rank that fit: ranges up to FILL times what is missing, then one small group a source
    after = with_source(choosable, found).where(~_within("br1", "br2", "edge") & (F.col("size") < 2 * F.col("missing")))
    after = after.select("source", "doc_id", "size", "v", "r1", "r2", "missing")
    _, far = borders(after.drop("missing"), found.select("source", (F.col("missing") * FILL).alias("missing")))
    far = found.select("source").join(far.select(F.col("source").alias("s"), "br1", "br2"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    near = (F.col("br1").isNull()) | (F.col("r1") < F.col("br1")) | ((F.col("r1") == F.col("br1")) & (F.col("r2") <= F.col("br2")))
    tried = with_source(after, far).where(near).select("source", "doc_id", "size", "v", "missing")
    filled = tried.groupBy("source").applyInPandas(_fitting, tried.select("source", "doc_id", "size").schema)
    filled = save(filled.distinct().toDF("f_source", "f_id", "f_size"), "mix-filled")
    out = with_source(ranked, state.join(found.drop("missing").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))
    small = filled.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    on = out["source"].eqNullSafe(F.col("f_source")) & out["doc_id"].eqNullSafe(F.col("f_id")) & (out["size"] == F.col("f_size"))
    out = out.join(F.broadcast(filled) if small else filled, on, "left")
    copies = F.col("whole") + (_within("br1", "br2", "edge") | F.col("f_size").isNotNull()).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"), copies.cast("long").alias("copies"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The mix: those of docs that are taken, with all their columns, copies (how often) and taken (words with repeats). Columns of docs
    named copies or taken are replaced. Rows with a null doc_id are mixed as well.

    What is taken depends on doc_id, source and size only, so the allotment meets its rows again by these three.
    """
    plan = allot(sizes(docs), weights, most).where("copies > 0").groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    plan = save(plan.toDF("__id", "__source", "__size", "copies"), "mix-plan")
    small = plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    kept = [c for c in docs.columns if c not in ("copies", "taken")]
    own = docs.select(*[F.col(f"`{c}`") for c in kept], size_of("text").alias("__own"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__size"))
    out = own.join(F.broadcast(plan) if small else plan, on)
    return out.select(*[F.col(f"`{c}`") for c in kept], "copies", (F.col("copies") * F.col("__own")).alias("taken"))


def _oracle() -> str:
    """The rules above in SQL; the filling goes from one document to the next by recursion."""
    over = "(PARTITION BY source, cand ORDER BY odds, doc_id, size ROWS UNBOUNDED PRECEDING)"
    class_ = "-(" + " + ".join(f"CAST(size >= {n} AS INT)" for n in LONG) + ")"
    return rf"""
WITH RECURSIVE t AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, (CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656 AS u FROM documents),
d AS (SELECT *, pow(2.0::DOUBLE, {class_}) AS f FROM t),
own AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, sum(size) * 3.0::DOUBLE AS cap, [1.0::DOUBLE, 2.0, 3.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY 1),
lv AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM own WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tg AS (SELECT source, source_size, coalesce(least(cap, w * max(CASE WHEN level * w <= cap THEN level END) OVER ()), cap) AS target FROM lv),
cl AS (SELECT d.source, f, CAST(sum(size) AS DOUBLE) AS s, any_value(target) AS target FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source GROUP BY 1, 2),
cv AS (SELECT *, (target - coalesce(sum(3.0::DOUBLE * s) OVER b, 0)) / nullif(sum(f * s) OVER (PARTITION BY source) - coalesce(sum(f * s) OVER b, 0), 0) AS level FROM cl WINDOW b AS (PARTITION BY source ORDER BY f DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rt AS (SELECT source, f, coalesce(least(3.0::DOUBLE, f * max(CASE WHEN level * f <= 3.0::DOUBLE THEN level END) OVER (PARTITION BY source)), CASE WHEN target > 0 THEN 3.0::DOUBLE ELSE 0 END) AS rate FROM cv),
q AS (SELECT d.*, source_size, target, CASE WHEN size > 0 THEN floor(rate) ELSE 0 END AS whole, CASE WHEN size > 0 THEN rate - floor(rate) ELSE 0 END AS p FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source JOIN rt ON d.source IS NOT DISTINCT FROM rt.source AND d.f = rt.f),
c AS (SELECT *, (u / (1 - u)) / (p / (1 - p)) AS odds, p > 0 AS cand, greatest(0::DOUBLE, target - sum(whole * size) OVER (PARTITION BY source)) AS missing FROM q),
g AS MATERIALIZED (SELECT *, cand AND upto <= missing AS got, missing - coalesce(sum(CASE WHEN cand AND upto <= missing THEN size END) OVER (PARTITION BY source), 0) AS open FROM (SELECT *, sum(size) OVER {over} AS upto FROM c)),
a AS MATERIALIZED (SELECT * FROM (SELECT source, doc_id, size, open, row_number() OVER w AS k, sum(size) OVER w - size AS tried FROM g WHERE cand AND NOT got AND size < 2 * open WINDOW w AS (PARTITION BY source ORDER BY odds, doc_id, size ROWS UNBOUNDED PRECEDING)) WHERE tried < {FILL} * open),
s AS (SELECT source, doc_id, size, k, open - CASE WHEN size <= open THEN size ELSE 0 END AS open, size <= open AS fits FROM a WHERE k = 1
  UNION ALL SELECT a.source, a.doc_id, a.size, a.k, s.open - CASE WHEN a.size <= s.open THEN a.size ELSE 0 END, a.size <= s.open FROM s JOIN a ON a.source IS NOT DISTINCT FROM s.source AND a.k = s.k + 1),
l AS (SELECT source, doc_id, size, fits, CASE WHEN NOT fits THEN row_number() OVER (PARTITION BY source, fits ORDER BY size, k) END AS least, last_value(open) OVER (PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS open FROM s),
x AS (SELECT g.*, whole + CAST(got OR coalesce(l.fits OR (l.least = 1 AND l.size < 2 * l.open), false) AS INT) AS copies FROM g LEFT JOIN l ON l.source IS NOT DISTINCT FROM g.source AND l.doc_id = g.doc_id AND l.size = g.size)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM x"""


ORACLE = _oracle()
