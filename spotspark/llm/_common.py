"""Shared pieces of the training-data operators: shared-folder tables, size-checked joins, vectorised word hashing.

Word hashing works on the UTF-8 bytes of a block of texts at once with numpy inside Arrow tasks; a task needs
memory in proportion to its longest single text (about 60 bytes a byte), never to a group or a partition.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most rows of one long column that are broadcast; beyond it the same join runs as a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that are hashed at once.
BLOCK_BYTES = 1 << 18
#: Most rows of one batch between Spark and a Python worker: both sides hold a batch, and texts may be long.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir; a new one only where it is unset and the master is local."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = sc.getCheckpointDir()
    return found


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with the session's batches held to BATCH_ROWS rows; a smaller setting of the session stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def keep_ids(df: DataFrame, ids: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows of df whose key is (keep) or is not in the one-column table ids, which should be a saved table.

    ids is broadcast only after its rows were counted; a larger one takes a shuffled join. Null keys are in no ids.
    """
    ids = ids.toDF(key)
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi" if keep else "left_anti").select(*df.columns)


def labelled_sample(docs: DataFrame, marked: DataFrame, rows: int, most_words: int) -> DataFrame:
    """(columns of marked, text), saved: labelled documents to fit on, at most `rows` of them with at most `most_words` words in all.

    marked holds one row for each doc_id (not null). Documents are taken by the least hashes of doc_id; one whose rows repeat is one
    row with its least text; one that alone has more than most_words words is left out. The order is found over at most `rows` pairs of id
    and size.
    """
    assert rows <= BROADCAST_ROWS
    sample = save(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "sample")
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = save(one, "sample-texts")
    size = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long")
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    kept = texts.select("doc_id", size.alias("size")).where(F.col("size") <= most_words).withColumn("upto", upto).where(F.col("upto") <= most_words).select("doc_id")
    kept = sample.join(F.broadcast(kept), "doc_id")
    return save(texts.join(F.broadcast(kept), "doc_id").select(*sample.columns, "text"), "sample-rows")


# ---------------------------------------------------------------- hashing of words in blocks of texts

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_S27, _S30, _S31 = np.uint64(27), np.uint64(30), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S30)) * _M1
        x = (x ^ (x >> _S27)) * _M2
        return x ^ (x >> _S31)


with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BASE = 0xD1342543DE82EF95
_INV = pow(_BASE, -1, 1 << 64)
#: ASCII white space: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: All but ASCII letters, digits and the bytes of other scripts.
NOT_ALNUM = np.array([not (chr(i).isalnum() or i >= 128) for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            _powers = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in (_BASE, _INV))
    return _powers


def strings(column: pa.Array) -> pa.Array:
    """Null as empty, with 64-bit offsets."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, start of each text and the end) for runs of whole texts of about limit bytes."""
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, at: np.ndarray, apart: np.ndarray = SPACE, most: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block: (hash, start byte, end byte, index of each text's first word and the end). A-Z count as a-z.

    most: hash the first so many code points of each word only, and give 0 to words that have no more than that.
    """
    low = _LOWER[data]
    word = ~apart[low]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    first[heads] = word[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(at), np.int64)
    power, inverse = _power(len(data) + 1)
    with np.errstate(over="ignore"):
        part = word
        if most:
            begun = np.cumsum((low & 0xC0) != 0x80)  # code points begun so far
            base = np.concatenate([np.zeros(starts[0], begun.dtype), np.repeat(begun[starts] - 1, np.diff(starts, append=len(data)))])
            part = word & (begun - base <= most)
        terms = np.where(part, _BYTE[low] * power[: len(data)], np.uint64(0))
        hashed = mix(np.add.reduceat(terms, starts) * inverse[starts])
        if most:
            hashed[np.add.reduceat((word & ~part).astype(np.int64), starts) == 0] = 0
    lengths = np.add.reduceat(word.astype(np.int64), starts)
    return hashed, starts, starts + lengths, np.searchsorted(starts, at)


def word_hash(word: str) -> int:
    """The hash that words() gives to one lower-case word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(words(data, np.array([0, len(data)]), np.zeros(256, bool))[0][0])


def owner(bounds: np.ndarray) -> np.ndarray:
    """Index of the text that each word belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
