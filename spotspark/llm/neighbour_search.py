"""Approximate nearest neighbours by inner product: multi-index hashing of learned rotated binary codes.

Vectors are given one more component that makes their lengths equal, so that the largest inner product is the smallest angle; a
rotation learned on a bounded sample turns them into codes of 64 bits. Codes are cut into substrings, and each substring is an
index: buckets of (substring, value), dealt into parts. By the pigeonhole principle every code within a Hamming radius of the
query's lies, in some substring, within that substring's share of the radius, so probing those values retrieves all of them;
they are reranked by their floats where they are met. The radius is read off the true neighbours of a bounded set of queries, which
are found by one scan of all rows. A first round probes the query's own values only; its k-th best score is a bound below which
nothing is handed on in the round that probes the whole radius. Queries that found too few go on with a wider one, up to all codes.

Rows with the same vector are one point with its k + 1 least ids, which is exact, whatever the number of copies.

Cases: rows with a null id, and vectors that are null, empty, zero or hold a null, NaN or infinite component take no part; nor do vectors of
another length than the commonest one (of equally common ones the shortest). Rows that repeat id and vector are one row; a query
skips all rows of its own id. Ties go to the smaller id. An empty table, or one without queries, gives no rows; with fewer than k
candidates all are returned. Columns other than those named take no part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, map_arrow, save

K = 20
BITS = 64
#: Bits of a substring. Wider ones suit more points to a bucket, and cost more probes for a wide radius.
WIDTH = 8
#: Vectors the rotation is learned on, at most so many numbers of them, and queries the radius is read off.
SAMPLE, SAMPLE_NUMBERS, CALIBRATION = 10_000, 4_000_000, 64
#: Share of the true neighbours of those queries that lies within the radius.
TARGET = 0.97
#: Points of a bucket, and queries, that meet in one group.
BLOCK, QUERY_BLOCK = 8192, 20_000


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the valid vectors of each length."""
    values = pc.fill_null(column.values.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    offsets = np.asarray(column.offsets)
    size = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
    for n in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == n)
        x = values[offsets[at][:, None] + np.arange(n)] + 0.0  # -0.0 becomes 0.0
        good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        yield at[good], x[good]


def encoded(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): the rows that take part; vec holds the components as doubles. All have one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id")
            for at, x in _matrices(b.column("vec")):
                yield pa.record_batch({"id": ids.take(pa.array(at)), "vec": pa.array([r.tobytes() for r in x], pa.binary())})

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    rows = save(map_arrow(rows, run, "id long, vec binary"), "vectors")
    size = rows.groupBy(F.octet_length("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.octet_length("vec") == (size["size"] if size else 0))


def points(rows: DataFrame, most: int) -> DataFrame:
    """(vec, ids): distinct vectors with their `most` least ids, saved. Copies meet in salted groups first, `most` of each."""
    some = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(16)))
    some = some.withColumn("at", F.row_number().over(Window.partitionBy("vec", "salt").orderBy("id"))).where(F.col("at") <= most)
    some = some.withColumn("at", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("at") <= most)
    return save(some.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "points")


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


class Rotation:
    """x -> 64 bits. Learned by principal components and alternating rotations (each towards the signs of the last)."""

    def __init__(self, sample: np.ndarray, longest: float, seed: int = 7):
        self.longest = longest
        x = self.even(sample)
        self.mean = x.mean(axis=0)
        rng = np.random.default_rng(seed)
        _, vectors = np.linalg.eigh((x - self.mean).T @ (x - self.mean))
        axes = vectors[:, ::-1][:, : min(BITS, x.shape[1])]
        low = (x - self.mean) @ axes
        turns = []
        for _ in range(-(-BITS // axes.shape[1])):
            turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(30):
                u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
                turn = (u @ v).T
            turns.append(axes @ turn)
        self.planes = np.concatenate(turns, axis=1)[:, :BITS]

    def even(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0.0))
        return np.concatenate([x, rest[:, None]], axis=1) / self.longest

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1).view(np.uint64).ravel()

    def codes(self, x: np.ndarray) -> np.ndarray:
        return self._packed((self.even(x) - self.mean) @ self.planes > 0)

    def query_codes(self, q: np.ndarray) -> np.ndarray:
        """q has no part of the added component, and is not moved: q times (x - mean) orders x as q times x does."""
        return self._packed(q @ self.planes[:-1] > 0)


def learned(pts: DataFrame) -> Rotation | None:
    """From the vectors of least hash, and the greatest length of all."""
    longest = map_arrow(pts.select("vec"), _longest, "d double").agg(F.max("d")).first()[0]
    if longest is None:
        return None
    size = pts.select(F.octet_length("vec")).first()[0] // 8
    sample = pts.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(max(2, min(SAMPLE, SAMPLE_NUMBERS // size))).collect()
    return Rotation(np.frombuffer(b"".join(r[0] for r in sample), np.float64).reshape(len(sample), -1), longest)


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield pa.record_batch({"d": [float(np.sqrt((matrix(b.column("vec")) ** 2).sum(axis=1).max()))]})


def radius(pts: DataFrame, queries: DataFrame, rotation: Rotation, k: int, target: float = TARGET) -> int:
    """Hamming radius that holds `target` of the k true nearest points of CALIBRATION queries (by least hash), found by a scan of all."""
    some = queries.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(CALIBRATION).collect()
    q = np.frombuffer(b"".join(r[0] for r in some), np.float64).reshape(len(some), -1)
    codes = rotation.query_codes(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, apart = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), np.int64)
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("vec"))
                best = np.concatenate([best, q @ x.T], axis=1)
                apart = np.concatenate([apart, np.bitwise_count(codes[:, None] ^ rotation.codes(x)[None, :]).astype(np.int64)], axis=1)
                top = np.argsort(-best, axis=1, kind="stable")[:, :k]
                best, apart = np.take_along_axis(best, top, axis=1), np.take_along_axis(apart, top, axis=1)
        yield pa.record_batch({"q": np.repeat(np.arange(len(q)), best.shape[1]), "score": best.ravel(), "apart": apart.ravel()})

    found = map_arrow(pts.select("vec"), run, "q long, score double, apart long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "apart"))
    apart = [r["apart"] for r in found.withColumn("place", place).where(F.col("place") <= k).select("apart").collect()]
    return int(np.sort(apart)[min(len(apart) - 1, int(np.ceil(target * len(apart))) - 1)]) if apart else BITS


def shares(r: int, subs: int) -> list[int]:
    """Radius of each substring, -1 where it is not probed: the sum of (share + 1) is r + 1, so a code within r is within some share."""
    each, more = divmod(r + 1, subs)
    return [each - (i >= more) for i in range(subs)]


def _substrings(codes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, substrings)."""
    return (codes[:, None] >> (np.arange(BITS // bits, dtype=np.uint64) * np.uint64(bits))[None, :]) & np.uint64((1 << bits) - 1)


class Index:
    """Every point under each of its substrings, in parts of about BLOCK points of a bucket."""

    def __init__(self, pts: DataFrame, rotation: Rotation, block: int = BLOCK, width: int = WIDTH):
        self.rotation, self.bits = rotation, width
        self.subs = BITS // self.bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                codes = self.rotation.codes(matrix(b.column("vec"))) if b.num_rows else np.zeros(0, np.uint64)
                value = _substrings(codes, self.bits).astype(np.int64)
                for i in range(self.subs):
                    yield pa.record_batch({"sub": np.full(b.num_rows, i, np.int32), "value": value[:, i], "code": codes.view(np.int64), "ids": b.column("ids"), "vec": b.column("vec")})

        rows = save(map_arrow(pts, run, "sub int, value long, code long, ids array<long>, vec binary"), "index")
        #: (sub, value, parts): at most substrings x 2^bits rows.
        self.buckets = save(rows.groupBy("sub", "value").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")), "buckets")
        small = self._small(self.buckets)
        self.rows = rows.join(small, ["sub", "value"]).withColumn("part", F.pmod(F.xxhash64("vec"), F.col("parts").cast("long"))).drop("parts")

    @staticmethod
    def _small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df

    def probe(self, queries: DataFrame, r: int, k: int, own_values: bool = False) -> DataFrame:
        """(qid, id, score): of each query (qid, vec, bound) the k best ids of every group it meets that are within the Hamming radius
        r and reach the bound. own_values: all codes that share a substring's value with the query instead."""
        bits, subs, rotation = self.bits, self.subs, self.rotation
        near = [0] * subs if own_values else shares(r, subs)
        r = BITS if own_values else r

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            every = np.arange(1 << bits)
            for b in batches:
                if not b.num_rows:
                    continue
                codes = rotation.query_codes(matrix(b.column("vec")))
                value = _substrings(codes, bits).astype(np.int64)
                for i, share in enumerate(near):
                    if share < 0:
                        continue
                    steps = every[np.bitwise_count(every) <= share]
                    for j in range(0, b.num_rows, max(1, 100_000 // len(steps))):
                        at = np.arange(j, min(b.num_rows, j + max(1, 100_000 // len(steps))))
                        take = np.repeat(at, len(steps))
                        probed = (value[at, i][:, None] ^ steps[None, :]).ravel()
                        yield pa.record_batch({"sub": np.full(len(take), i, np.int32), "value": probed, **{c: b.column(c).take(pa.array(take)) for c in ("qid", "vec", "bound")}, "code": codes[take].view(np.int64)})

        def meet(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            parts = []
            if len(own) and len(asked):
                x, q = (np.frombuffer(b"".join(f["vec"]), np.float64).reshape(len(f), -1) for f in (own, asked))
                cx, cq = (f["code"].to_numpy(np.int64).view(np.uint64) for f in (own, asked))
                slack = 1e-9 * np.sqrt((q * q).sum(axis=1)) * rotation.longest
                floor, sub = asked["bound"].to_numpy() - slack, int(own["sub"].iloc[0])
                ids, count = own["ids"].to_numpy(), own["ids"].map(len).to_numpy()
                flat = np.concatenate(list(ids))
                first = np.cumsum(count) - count
                step = max(1, 1_000_000 // len(x))
                for j in range(0, len(q), step):
                    a = slice(j, j + step)
                    xor = cq[a][:, None] ^ cx[None, :]
                    good = np.bitwise_count(xor) <= r
                    for i in range(sub):  # met before under an earlier substring
                        if near[i] >= 0:
                            good &= np.bitwise_count((xor >> np.uint64(i * bits)) & np.uint64((1 << bits) - 1)) > near[i]
                    score = np.where(good, q[a] @ x.T, -np.inf)
                    good &= score >= floor[a][:, None]
                    if len(x) > k:
                        good &= score >= (np.partition(score, len(x) - k, axis=1)[:, len(x) - k] - slack[a])[:, None]
                    at, to = np.nonzero(good)
                    exact = np.zeros(len(at))
                    for d in range(x.shape[1]):  # one order of addition, whatever meets
                        exact += q[j + at, d] * x[to, d]
                    many = count[to]
                    where = np.repeat(first[to], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    parts.append(pd.DataFrame({"qid": np.repeat(asked["qid"].to_numpy()[j + at], many), "id": flat[where], "score": np.repeat(exact, many)}))
            return pd.concat(parts) if parts else pd.DataFrame({"qid": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

        blocks = max(1, -(-queries.count() // QUERY_BLOCK))
        asked = map_arrow(queries.select("qid", "vec", "bound"), spread, "sub int, value long, qid long, vec binary, bound double, code long")
        asked = asked.join(self._small(self.buckets), ["sub", "value"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))).drop("parts")
        asked = asked.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks).cast("long")))
        own = self.rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        key = ["sub", "value", "part", "block"]
        return own.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(meet, "qid long, id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each qid, once for each id."""
    once = found.groupBy("qid", "id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "id"))
    return once.withColumn("place", place).where(F.col("place") <= k)


def nearest(df: DataFrame, query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", target: float = TARGET, block: int = BLOCK, width: int = WIDTH) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each row where `query` (a condition on `id`) holds the k nearest others that were found."""
    rows = save(encoded(df, key, vector), "rows")
    pts = points(rows, k + 1)
    asked = rows.where(query).distinct()
    queries = save(asked.select("vec").distinct().withColumn("qid", F.monotonically_increasing_id()), "queries")
    rotation = learned(pts)
    if rotation is None or queries.limit(1).count() == 0:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = Index(pts, rotation, block, width)
    r = radius(pts, queries, rotation, k, target)
    # the query's own row is among those found: one more than k
    found = save(_best(index.probe(queries.withColumn("bound", F.lit(float("-inf"))), r, k + 1, own_values=True), k + 1), "near")
    open_ = queries
    for _ in itertools.count():
        bound = found.where(F.col("place") == k + 1).select("qid", F.col("score").alias("bound"))
        more = index.probe(open_.join(bound, "qid", "left").fillna(float("-inf"), ["bound"]), r, k + 1)
        found = save(_best(found.drop("place").unionByName(more), k + 1), "found")
        if r >= BITS:
            break
        full = found.groupBy("qid").agg(F.count("*").alias("n")).where(F.col("n") > k)
        open_ = save(open_.join(full, "qid", "left_anti"), "open")
        if open_.limit(1).count() == 0:
            break
        r = min(BITS, r + 8)
    lists = found.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("list"))
    each = asked.select(F.col("id").alias("query_id"), "vec").join(queries, "vec").join(lists, "qid")
    others = F.slice(F.filter("list", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = each.select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))

