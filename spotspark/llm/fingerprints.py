"""Document fingerprints by content-defined chunking.

A 32-character rolling gear hash marks boundaries; chunk sizes are normalised (a strict mask before the normal size, a
loose one after it, with least and greatest sizes). The set of chunk digests, each weighted by the chunk's length,
is the fingerprint; the weighted share of one set found in another measures containment. An edit changes only the chunks
that it touches, wherever the rest moves to.

Defined cases: null text is empty; an empty text has the empty fingerprint, which is wholly contained in anything and
contains nothing but the empty one; equal texts (ties, repeated rows) have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import _GOLD, map_arrow, mix, strings

LEAST, NORMAL, MOST = 8, 24, 63
STRICT_BITS, LOOSE_BITS = 5, 3
#: Code points that are hashed at once.
BLOCK = 1 << 19
_CODE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
_ALPHABET = np.frombuffer(_CODE, np.uint8)


def _gear() -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(np.arange(1, 0x110001, dtype=np.uint64) * _GOLD) >> np.uint64(32)).astype(np.uint32)


class Chunker:
    """Cuts texts; holds the gear table (one number for each code point, from a rule)."""

    def __init__(self, least: int = LEAST, normal: int = NORMAL, most: int = MOST):
        self.least, self.normal, self.most, self.gear = least, normal, most, _gear()

    def cuts(self, texts: list[str]) -> tuple[bytes, np.ndarray, list[list[int]]]:
        """(UTF-32 of all texts, offsets, ends of the chunks of each text as offsets in the whole)."""
        raw = "".join(texts).encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(raw, np.uint32)
        n = len(points)
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=at[1:])
        inside = np.arange(n, dtype=np.int32) - np.repeat(at[:-1], np.diff(at)).astype(np.int32)
        with np.errstate(over="ignore"):
            h = self.gear[points]
            for step in (1, 2, 4, 8, 16):  # sums of 32 shifted gears by doubling: the window is 32 characters
                if n > step:  # never over the start of a text
                    h[step:] += np.where(inside[step:] >= step, h[:-step] << np.uint32(step), np.uint32(0))
        far = n + self.most + 1
        top = np.uint32(32)
        where = np.arange(n, dtype=np.int32)

        def following(bits: int) -> np.ndarray:
            """For each i the least boundary end (position after a marked character) that is i or more."""
            out = np.full(far + 1, far, np.int32)
            marked = np.flatnonzero(h >> (top - np.uint32(bits)) == 0)
            out[marked + 1] = marked + 1
            return np.minimum.accumulate(out[::-1])[::-1]

        strict, loose = following(STRICT_BITS), following(LOOSE_BITS)
        least, normal = (np.minimum(where + k, far) for k in (self.least, self.normal))
        jump = strict[least]
        late = jump > where + self.normal
        jump[late] = loose[normal[late]]
        np.minimum(jump, where + self.most, out=jump)
        step, ends = memoryview(jump), []
        for k in range(len(texts)):
            i, end, own = int(at[k]), int(at[k + 1]), []
            while i < end:
                i = step[i]
                own.append(i)
            if own:
                own[-1] = end
            ends.append(own)
        return raw, at, ends

    def chunks(self, texts: list[str]) -> list[dict[int, int]]:
        """For each text {48-bit digest: length in code points}."""
        out: list[dict[int, int]] = []
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK):
                size += len(texts[j])
                j += 1
            raw, at, ends = self.cuts(texts[i:j])
            view = memoryview(raw)
            for k, own in enumerate(ends):
                a, sets = int(at[k]), {}
                for b in own:
                    sets[xxhash.xxh3_64_intdigest(view[4 * a : 4 * b]) >> 16] = b - a
                    a = b
                out.append(sets)
            i = j
        return out


def encode(chunks: dict[int, int]) -> str:
    """Nine characters a chunk, ordered: eight of the digest and one of the length."""
    if not chunks:
        return ""
    digests = np.fromiter(chunks, np.uint64, len(chunks))
    lengths = np.fromiter(chunks.values(), np.uint64, len(chunks))
    order = np.argsort(digests)
    out = np.empty((len(chunks), 9), np.uint8)
    for k in range(8):
        out[:, k] = _ALPHABET[((digests[order] >> np.uint64(42 - 6 * k)) & np.uint64(63)).astype(np.int64)]
    out[:, 8] = _ALPHABET[lengths[order].astype(np.int64)]
    return out.tobytes().decode()


def decode(fingerprint: str) -> dict[int, int]:
    rank = {c: i for i, c in enumerate(_CODE.decode())}
    out = {}
    for i in range(0, len(fingerprint), 9):
        digest = 0
        for c in fingerprint[i : i + 8]:
            digest = digest << 6 | rank[c]
        out[digest] = rank[fingerprint[i + 8]]
    return out


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's length whose chunks are also in b. 1 for an empty a in anything empty, else 0."""
    total = sum(a.values())
    if not total:
        return 1.0 if not b else 0.0
    return sum(n for d, n in a.items() if d in b) / total


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each whole text as a string; all columns of df stay (one named out is replaced)."""
    fields = [f for f in df.schema.fields if f.name != out]
    kept = df.select(*[F.col(f"`{f.name}`") for f in fields])
    schema = type(df.schema)([*fields]).add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Chunker()
        for batch in batches:
            texts = strings(batch.column(batch.schema.get_field_index(text))).to_pylist()
            got = pa.array([encode(x) for x in cut.chunks(texts)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, out])

    return map_arrow(kept, run, schema)


def _bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """Quantiles of the key: at most parts - 1 numbers whatever the rows."""
    at = [i / parts for i in range(1, parts)]
    got = df.select(F.percentile_approx(key, at, 100 * parts).alias("q")).first()["q"]
    return sorted(set(got or []))


def _range_of(key, bounds: list[int]):
    """How many of the bounds are at or below the key, found in two levels (about 2 sqrt(bounds) comparisons)."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    count = lambda a: F.size(F.filter(a, lambda b: b <= key))
    top = count(F.lit([g[0] for g in groups]))
    inner = count(F.element_at(F.array(*[F.lit(g) for g in groups]), F.greatest(top, F.lit(1))))
    return F.coalesce(F.when(top > 0, (top - 1) * step + inner), F.lit(0)).cast("int")


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, rank, doc_id, text) such that ordering a part by rank, doc_id, text puts each row before its successor.

    The last row of each range of doc_id is followed by a copy (rank 1) of the first row of the next range that has rows,
    and the very last by the first of all. Only the first ids of the ranges (parts rows) are gathered; the texts are
    shuffled once. Null doc_ids come first; equal doc_ids go by text.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = _bounds(rows, "doc_id", parts)
    rows = rows.withColumn("part", _range_of(F.col("doc_id"), bounds))
    firsts = rows.select("part", "doc_id").groupBy("part").agg(F.min_by("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("none"))
    heads = sorted((r["part"], None if r["none"] else r["doc_id"]) for r in firsts.collect())  # at most parts rows
    if not heads:
        return rows.select("part", F.lit(0).alias("rank"), "doc_id", "text")
    ghosts = [(heads[i - 1][0], heads[i][1]) for i in range(len(heads))]
    ghosts = spark.createDataFrame(ghosts, "part int, head long")
    first = rows.drop("part").join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("part", "doc_id").agg(F.min("text").alias("text"))
    return rows.select("part", F.lit(0).alias("rank"), "doc_id", "text").unionByName(first.select("part", F.lit(1).alias("rank"), "doc_id", "text"))


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_chunks int"


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness (see EDITED).

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document's. Rows stream through sorted ranges; one row is held back at a time.
    """
    ordered = with_next(docs).repartition("part").sortWithinPartitions("part", "rank", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Chunker()
        kept: list[tuple] = []
        size = 0

        def done(rows: list[tuple]) -> pa.RecordBatch:
            texts = [r[3] for r in rows]
            own = cut.chunks(texts)
            out: list[list] = [[] for _ in range(8)]
            edited = []
            for k in range(len(rows) - 1):
                drop = len(texts[k]) // 4
                edited.append(texts[k][: len(texts[k]) - drop] + texts[k + 1][:drop])
            changed = cut.chunks(edited)
            for k in range(len(rows) - 1):
                part, rank, doc_id, text = rows[k]
                if rank or rows[k + 1][0] != part:
                    continue
                values = (doc_id, len(text), hashlib.sha256(edited[k].encode("utf-8", "surrogatepass")).hexdigest(), encode(own[k]), encode(changed[k]), containment(own[k], changed[k]), containment(own[k], own[k + 1]), len(own[k]))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_chunks"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for row in zip(*columns, strict=True):
                kept.append(row)
                size += len(row[3])
                if len(kept) > 1 and size > BLOCK:
                    yield done(kept)
                    kept = kept[-1:]
                    size = len(row[3])
        if len(kept) > 1:
            yield done(kept)

    return map_arrow(ordered, run, EDITED)
