"""Reading and writing of localization tables (Parquet), cluster tables (CSV) and provenance."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir; one of its own only where unset and local)."""
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not top:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        top = sc.getCheckpointDir()
    return f"{top}/{name}-{uuid.uuid4().hex}"


#: Bytes in memory that the planner takes a byte of a Parquet file for. Rows of keys and small numbers are saved at 2 to 10 bytes, and
#: broadcast at 100 to 170.
UNPACKED = 40.0


def unpacked(spark: SparkSession) -> None:
    """Lets the planner take saved tables for what they hold, not for the size of their files: by the latter it broadcasts millions of rows
    through the driver. Sides that prove small when they were shuffled are still broadcast, by the bytes that were counted."""
    name = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(name)) < UNPACKED:
        spark.conf.set(name, str(UNPACKED))


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes and rereads: cuts the lineage of an iteration, and survives lost executors."""
    unpacked(df.sparkSession)
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """rows with their place (from 0) among those of equal keys by `order`. Rows are dealt by ranges of (keys, order): a key of any size
    is many tasks, and what meets in a window is one count a range."""
    ranged = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ranged = cut(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("__at", 33)
    ranges = ranged.groupBy(*keys, part.alias("__p")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut(ranges.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))), "ranges")
    met = ranged.withColumn("__p", part).join(small(ranges), [*keys, "__p"])
    return met.select(*rows.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias(name))


#: Columns of a localization table (coordinates in thousandths of a pixel); others may follow.
LOCS = "loc_id long, cell long, channel int, tag string, frame long, x_m long, y_m long, photons double"
#: Most rows of a table of one row a channel, cell, pattern or frame that is broadcast.
SMALL_ROWS = 100_000


def small_count(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df, to be broadcast if its counted rows are few: for tables that are dear to shuffle the other side for."""
    return F.broadcast(df) if small_count(df, rows) else df


def read_localizations(spark: SparkSession, path: str, schema: str = LOCS) -> DataFrame:
    """Only the columns of the schema are read; a column of another type is an error, not a guess."""
    return spark.read.schema(schema).parquet(path)


def read_channels(spark: SparkSession, paths: list[str], tags: list[str]) -> DataFrame:
    """One table out of several; channel is the position."""
    out = None
    for k, (path, tag) in enumerate(zip(paths, tags, strict=True)):
        one = spark.read.parquet(path).withColumns({"channel": F.lit(k).cast("int"), "tag": F.lit(tag)})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def write_localizations(locs: DataFrame, path: str) -> None:
    """S3: a folder for each cell and tag; files hold ranges of frames and are ordered, so a large cell is many tasks and files."""
    order = ["cell", "tag", "frame", "loc_id"]
    locs.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("cell", "tag").parquet(path)


def append_provenance(info: DataFrame, cells: DataFrame, generated_by: str, params: dict[str, str]) -> DataFrame:
    """One more step for each cell. info: cell, step, generated_by, params."""
    flat = [F.lit(x) for kv in sorted(params.items()) for x in kv]
    last = info.groupBy("cell").agg(F.max("step").alias("last"))
    step = cells.select("cell").distinct().join(last, "cell", "left")
    return info.unionByName(step.select("cell", (F.coalesce("last", F.lit(-1)) + 1).cast("int").alias("step"), F.lit(generated_by).alias("generated_by"), F.create_map(*flat).alias("params")))


def write_cluster_csv(clusters: DataFrame, path: str) -> None:
    """S5."""
    clusters.write.csv(path, header=True)


def read_cluster_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """S5."""
    return spark.read.schema(schema).csv(path, header=True)


def gather_cells(locs: DataFrame, strict: bool = False) -> DataFrame:
    """Tags of each cell, and whether all cells have the same; strict: an error where they have not."""
    if strict and locs.groupBy("cell").agg(F.array_sort(F.collect_set("tag")).alias("tags")).select("tags").distinct().limit(2).count() > 1:
        raise ValueError("cells have different channel tags")
    own = locs.groupBy("cell").agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tags"))
    kinds = own.agg((F.count_distinct("tags") == 1).alias("same_tags"))
    return own.crossJoin(F.broadcast(kinds))  # one row
