"""N-gram Jaccard self-join by grouped prefixes: documents linked when their sets of 5-word shingles are alike enough.

1. Every set is ordered by (rarity, hash). Rarity is the count of a fixed number of hash buckets over all documents: any
   order that is a function of the shingle is right for prefix filtering; a good one keeps common passages out of prefixes.
2. A set of n shingles has a prefix of n - ceil(t n) + 1; two sets that link share a shingle of their prefixes.
   Documents with the same prefix and size are one group. Groups that share a prefix shingle are joined.
3. First each group proposes only the group that it shares most with (a star: at most one pair a group), each member of a
   group the group's first. Verified pairs give components. Then every pair of groups that share a prefix shingle,
   have sizes that can link and do not already lie in one component is expanded to members: no pair within a family of
   copies is ever made, and no pair that could add to a component is left out. Members of one group that are not in one component
   meet by a prefix of the rest of their sets: they share the first p shingles, so what they still must share begins there.
4. Pairs are verified on the whole sets, after a bound from parity bitmaps (symmetric difference is at least the number of
   differing bits), which is exact in what it removes.

The result is the exact set of components (up to equal 64-bit hashes of different shingles).

Common shingles: lists of LIST members or more by the sketch (which counts at least as many) are not gathered by key but joined to
their first member, and lists are met block by block, so no task holds more than LIST members of a list.

Defined cases: null or empty text, or white space only: no shingles, a component of its own; fewer than n words: the whole
sequence is the one shingle; equal texts have one set; a doc_id is one node, so rows that repeat it are linked with each other and
with all that any of them links with; a null doc_id is in no pair and its component_id is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import _GOLD, SPACE, blocks, keep_ids, map_arrow, mix, owner, save, strings, words

N_WORDS, PERCENT = 5, 75
#: Buckets of the rarity sketch, as bits: a fixed size (4 bytes each) whatever the input.
SKETCH_BITS = 20
_CHUNK = 1 << 13
#: Members of an inverted list that one task gathers, and of a block of it that meets another; tasks whose sketches are added at once.
LIST, FAN = 1000, 64
_BITS = ("b0", "b1", "b2", "b3")


def shingle_sets(data: np.ndarray, at: np.ndarray, n: int = N_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, ordered by text and hash; bounds of each text) of a block of texts."""
    hashed, _, _, bounds = words(data, at, SPACE)
    own, counts = owner(bounds), np.diff(bounds)
    with np.errstate(over="ignore"):
        short = np.flatnonzero((counts > 0) & (counts < n))
        out = np.zeros(0, np.uint64)
        whose = np.zeros(0, np.int64)
        if len(hashed) >= n:
            full = own[: len(hashed) - n + 1] == own[n - 1 :]
            s = hashed[: len(hashed) - n + 1].copy()
            for j in range(1, n):
                s = (s * _GOLD) ^ (s >> np.uint64(29))
                s += hashed[j : len(hashed) - n + 1 + j]
            out, whose = mix(s[full]), own[: len(hashed) - n + 1][full]
        few = []
        for k in short:
            s = np.uint64(counts[k])
            for w in hashed[bounds[k] : bounds[k + 1]]:
                s = ((s * _GOLD) ^ (s >> np.uint64(29))) + w
            few.append(s)
        if few:
            out = np.concatenate([out, mix(np.array(few, np.uint64) + np.uint64(1))])
            whose = np.concatenate([whose, short])
    order = np.lexsort((out, whose))
    out, whose = out[order], whose[order]
    if len(out):
        new = np.ones(len(out), bool)
        new[1:] = (out[1:] != out[:-1]) | (whose[1:] != whose[:-1])
        out, whose = out[new], whose[new]
    return out, np.searchsorted(whose, np.arange(len(at)))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum for each text; 0 where it has none."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    with np.errstate(over="ignore"):
        return total[bounds[1:]] - total[bounds[:-1]]


def _members_and_sketch(docs: DataFrame, n: int) -> DataFrame:
    """One pass: (doc_id, n, k1, k2) of each document (k1, k2 name its set), and rows (chunk, counts) of each task's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "k1", "k2", "chunk", "part", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        part = TaskContext.get().partitionId()
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, at in blocks(strings(batch.column(1))):
                s, bounds = shingle_sets(data, at, n)
                np.add.at(counts, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
                none = [pa.nulls(j - i, k) for k in kinds[4:]]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(np.diff(bounds)), _signed(_sums(mix(s), bounds)), _signed(_sums(mix(s ^ _GOLD), bounds)), *none], names=names)
        for c in np.flatnonzero(counts.reshape(-1, _CHUNK).any(axis=1)):
            own = [pa.nulls(1, k) for k in kinds[:4]]
            mine = counts[c * _CHUNK : (c + 1) * _CHUNK].tobytes()
            yield pa.RecordBatch.from_arrays([*own, pa.array([c], pa.int32()), pa.array([part], pa.int32()), pa.array([mine], pa.binary())], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, run, "doc_id long, n long, k1 long, k2 long, chunk int, part int, counts binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """Adds up the tasks' counts by chunk, FAN tasks at a time; the driver gets one array of fixed size. parts: chunk, part, counts."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_CHUNK, np.uint64)
        for c in frame["counts"]:
            total += np.frombuffer(c, np.uint32)
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "part": frame["part"].iloc[:1], "counts": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})

    schema = "chunk int, part int, counts binary"
    tasks = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        parts = save(parts.withColumn("part", F.pmod("part", F.lit(tasks)).cast("int")).groupBy("chunk", "part").applyInPandas(add, schema), "join-sketch")
    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in parts.groupBy("chunk").applyInPandas(add, schema).collect():
        out[r["chunk"] * _CHUNK : (r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["counts"], np.uint32)
    return out


def _prefix_mask(s: np.ndarray, bounds: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the shingles by text, rarity and hash; which of the ordered are in the prefix)."""
    own, n = owner(bounds), np.diff(bounds)
    order = np.lexsort((s, sketch[s >> np.uint64(64 - SKETCH_BITS)], own))
    length = np.where(n > 0, n - (n * percent + 99) // 100 + 1, 0)
    return order, np.arange(len(s)) - bounds[:-1][own] < length[own]


def _groups(docs: DataFrame, sketch, n: int, percent: int) -> DataFrame:
    """(rep, n, g1, g2, bitmap, b0 .. b3): g1, g2 name the prefix; bitmap holds the parity of shingles by hash bucket (a bit for each
    shingle or more), b0 .. b3 the same in 256 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = sketch.value
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, at in blocks(strings(batch.column(1))):
                s, bounds = shingle_sets(data, at, n)
                size, own = np.diff(bounds), owner(bounds)
                order, inside = _prefix_mask(s, bounds, rare, percent)
                keyed = s[order]
                g1 = _sums(np.where(inside, mix(keyed), np.uint64(0)), bounds)
                g2 = _sums(np.where(inside, mix(keyed ^ _GOLD), np.uint64(0)), bounds)
                bits = 1 << np.ceil(np.log2(np.maximum(64, size))).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(bits)])
                place = first[own] + (s & (bits[own] - 1).astype(np.uint64)).astype(np.int64)
                packed = np.packbits((np.bincount(place, minlength=first[-1]) & 1).astype(np.uint8)).tobytes()
                few = np.bincount(own * 256 + (s & np.uint64(255)).astype(np.int64), minlength=256 * len(size)) & 1
                few = np.packbits(few.astype(np.uint8)).view(np.int64).reshape(-1, 4)
                maps = [packed[a // 8 : b // 8] for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(size), _signed(g1), _signed(g2), pa.array(maps, pa.binary()), *(pa.array(few[:, k]) for k in range(4))], names=["rep", "n", "g1", "g2", "bitmap", *_BITS])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "rep long, n long, g1 long, g2 long, bitmap binary, b0 long, b1 long, b2 long, b3 long").where("n > 0")


def _postings(docs: DataFrame, sketch, n: int, percent: int, least: int = 0, most: int = 1 << 32) -> DataFrame:
    """(shingle, gid, n, at): the prefix of each group's first document, and the place of each shingle in the order. Only shingles
    whose count in the sketch is from least to below most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = sketch.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, at in blocks(strings(batch.column(1))):
                s, bounds = shingle_sets(data, at, n)
                own = owner(bounds)
                order, inside = _prefix_mask(s, bounds, rare, percent)
                count = rare[s[order] >> np.uint64(64 - SKETCH_BITS)]
                inside &= (count >= least) & (count < most)
                whose = own[inside]
                place = (np.arange(len(s)) - bounds[:-1][own])[inside]
                columns = [_signed(s[order][inside]), pa.array(ids[i:j][whose]), pa.array(np.diff(bounds)[whose].astype(np.int32)), pa.array(place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["shingle", "gid", "n", "at"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "shingle long, gid long, n int, at int")


def _rest(docs: DataFrame, sketch, n: int, percent: int) -> DataFrame:
    """(shingle, rep, at): what follows each prefix, as far as two sets of one group and size must share a first further shingle.

    Such sets must share alpha shingles and have their whole prefixes in common; the next shared one is among the n - alpha + 1 that follow.
    at counts from the end of the prefix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = sketch.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, at in blocks(strings(batch.column(1))):
                s, bounds = shingle_sets(data, at, n)
                own, size = owner(bounds), np.diff(bounds)
                order, inside = _prefix_mask(s, bounds, rare, percent)
                place = np.arange(len(s)) - bounds[:-1][own] - np.bincount(own[inside], minlength=len(size))[own]
                alpha = -(-2 * size * percent // (100 + percent))
                after = (place >= 0) & (place <= (size - alpha)[own])
                columns = [_signed(s[order][after]), pa.array(ids[i:j][own[after]]), pa.array(place[after].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["shingle", "rep", "at"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "shingle long, rep long, at int")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, at in blocks(strings(batch.column(1))):
                s, bounds = shingle_sets(data, at, n)
                raw = s.tobytes()
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array([raw[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], names=["id", "shingles"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "id long, shingles binary")


def linked(docs: DataFrame, pairs: DataFrame, n: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) of doc_ids whose whole sets link: percent * union <= 100 * intersection."""

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(p) + len(q) - len(np.union1d(p, q))
            out.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
        return pd.Series(out)

    pairs = save(pairs.select("a", "b").distinct(), "join-pairs")
    ends = save(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "join-ends")
    sets = save(_sets(keep_ids(docs, ends, "doc_id"), n), "join-sets")
    a, b = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    return pairs.join(a, "a").join(b, "b").where(alike("sa", "sb")).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): least id that can be reached, for every id in the edges (a, b). Rounds of least label and jump."""
    edges = save(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "cc-edges")
    state = save(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "id"), "cc-state")
    while True:
        near = edges.join(state, edges["b"] == state["id"]).groupBy("a").agg(F.min("component").alias("m"))
        low = state.join(near, state["id"] == near["a"], "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("component"))
        jump = state.select(F.col("id").alias("component"), F.col("component").alias("far"))
        new = save(low.join(jump, "component", "left").select("id", "old", F.least(F.col("component"), F.coalesce("far", "component")).alias("component")), "cc-state")
        moved = new.where("old <> component").limit(1).count()
        state = new.select("id", "component")
        if not moved:
            return state


def _fits(na: str, pa_: str, nb: str, pb: str, percent: int):
    """Whether a shingle at these places can be the first one that two sets of these sizes share, if they link.

    They must share alpha = ceil(t / (1 + t) (na + nb)), all of them at this place or after it. The first shared shingle of
    any pair that links passes, so the pair is found there.
    """
    alpha = _shared(na, nb, percent)
    return (F.col(na) - F.col(pa_) >= alpha) & (F.col(nb) - F.col(pb) >= alpha)


def _shared(na: str, nb: str, percent: int):
    """Least number of shingles that sets of these sizes share if they link."""
    return F.ceil((F.lit(percent) * (F.col(na) + F.col(nb))) / F.lit(float(100 + percent)) - F.lit(1e-9))


def _live(docs: DataFrame, sketch, n: int, percent: int) -> DataFrame:
    """Lists of two groups or more: (shingle, gid, n, at), and the first group of the list as center, center_n, center_at."""
    counts = sketch.value
    columns = ["shingle", "gid", "n", "at", F.col("head.gid").alias("center"), F.col("head.n").alias("center_n"), F.col("head.at").alias("center_at")]
    same = Window.partitionBy("shingle")
    first = F.min(F.struct("gid", "n", "at"))
    short = _postings(docs, sketch, n, percent, most=LIST)
    short = short.withColumn("c", F.count("*").over(same)).where("c > 1").withColumn("head", first.over(same)).select(*columns)
    if int(counts.max()) < LIST:
        return short
    # lists that may be long: counted with partial sums, then joined to their heads (a join whose large keys Spark can split)
    common = save(_postings(docs, sketch, n, percent, least=LIST), "join-common")
    heads = common.groupBy("shingle").agg(F.count("*").alias("c"), first.alias("head")).where("c > 1")
    long_ = common.join(heads, "shingle").select(*columns)
    return long_ if int(counts.min()) >= LIST else short.unionByName(long_)


def _across(member: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one list in different components that can link. member: shingle, rep, component, n, at, bits.

    In each list the members outside its largest component meet all others: never two of the largest. Both sides are dealt into blocks
    of about LIST members; each pair of blocks is a key of its own.
    """
    sizes = member.groupBy("shingle", "component").agg(F.count("*").alias("c"))
    sizes = sizes.groupBy("shingle").agg(F.max_by("component", F.struct("c", "component")).alias("major"), F.sum("c").alias("all"), F.max("c").alias("of_major")).where("all > of_major")
    blocks = lambda c: F.ceil(c / F.lit(float(LIST))).cast("int")
    sizes = sizes.select("shingle", "major", blocks(F.col("all")).alias("blocks"), F.greatest(blocks(F.col("all") - F.col("of_major")), F.lit(1)).alias("minor_blocks"))
    member = save(member.join(sizes, "shingle"), "join-members")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    block_of = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    minor = member.where("component <> major").withColumn("mine", block_of("minor_blocks")).withColumn("its", each("blocks"))
    other = member.withColumn("its", block_of("blocks")).withColumn("mine", each("minor_blocks"))
    other = other.select("shingle", "mine", "its", *[F.col(c).alias(f"o_{c}") for c in ("rep", "component", "n", "at", *_BITS)])
    apart = sum((F.bit_count(F.col(k).bitwiseXOR(F.col(f"o_{k}"))) for k in _BITS[1:]), F.bit_count(F.col("b0").bitwiseXOR(F.col("o_b0"))))
    size = F.col("n") + F.col("o_n")
    once = (F.col("o_component") == F.col("major")) | (F.col("rep") < F.col("o_rep"))
    meet = (F.col("component") != F.col("o_component")) & once & _fits("n", "at", "o_n", "o_at", percent)
    meet &= 100 * (size - apart) >= percent * (size + apart)
    same = (minor["shingle"] == other["shingle"]) & (minor["mine"] == other["mine"]) & (minor["its"] == other["its"])
    return minor.join(other, same & meet).select(F.least("rep", "o_rep").alias("a"), F.greatest("rep", "o_rep").alias("b")).distinct()


def jaccard_components(docs: DataFrame, n: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs."""
    spark = docs.sparkSession
    first = save(_members_and_sketch(docs, n), "join-members")
    sketch = spark.sparkContext.broadcast(_sketch(first.where("chunk is not null").select("chunk", "part", "counts")))
    members = first.where("n is not null").select("doc_id", "n", "k1", "k2")
    named = members.where("n > 0 and doc_id is not null")
    reps = save(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "join-reps")
    keys = save(reps.select("rep").distinct(), "join-ids")
    groups = save(_groups(keep_ids(docs, keys, "doc_id"), sketch, n, percent), "join-groups")
    # doc_ids whose rows have different sets: one node, so the first documents of these sets are linked by it
    mixed_ids = members.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("n", "k1", "k2")).alias("lo"), F.max(F.struct("n", "k1", "k2")).alias("hi"))
    mixed_ids = save(mixed_ids.where("lo <> hi").select("doc_id"), "join-mixed")
    several = mixed_ids.limit(1).count() > 0
    led = groups.groupBy("g1", "g2", "n").agg(F.min("rep").alias("gid"))
    grouped = save(groups.join(led, ["g1", "g2", "n"]).select("rep", "gid", F.col("n").cast("int").alias("n"), "bitmap", *_BITS), "join-grouped")
    leaders = save(grouped.select("gid").distinct(), "join-leaders")
    live = save(_live(keep_ids(docs, leaders, "doc_id"), sketch, n, percent), "join-live")

    # stars
    votes = live.where((F.col("gid") != F.col("center")) & _fits("n", "at", "center_n", "center_at", percent)).groupBy("gid", "center").agg(F.count("*").alias("v"))
    stars = votes.groupBy("gid").agg(F.max_by("center", F.struct("v", -F.col("center"))).alias("center")).select(F.col("center").alias("a"), F.col("gid").alias("b"))
    own = grouped.where("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    sure = linked(docs, stars.unionByName(own), n, percent)
    if several:
        ends = save(keep_ids(named, mixed_ids, "doc_id").join(reps, ["k1", "k2"]).select("doc_id", "rep").distinct(), "join-mixed-ends")
        least = ends.groupBy("doc_id").agg(F.min("rep").alias("a"))
        sure = sure.unionByName(ends.join(least, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")))
    sure = save(sure, "join-sure")
    part = components(sure)

    # pairs across components
    placed = save(grouped.join(part, grouped["rep"] == part["id"], "left").select("rep", "gid", "n", *_BITS, F.coalesce("component", "rep").alias("component")), "join-placed")
    kinds = placed.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    kinds = kinds.select("gid", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(-1 - F.col("gid")).alias("kind"))
    lists = save(live.select("shingle", "gid", "n", "at").join(kinds, "gid"), "join-lists")
    mixed = lists.groupBy("shingle").agg(F.min("kind").alias("lo"), F.max("kind").alias("hi"), F.min("n").alias("least")).where("lo <> hi").select("shingle", "least")
    mixed = lists.join(mixed, "shingle").where(F.col("n") - F.col("at") >= _shared("n", "least", percent)).select("shingle", "gid", "at")
    across = _across(mixed.join(placed, "gid"), percent)
    # members of one group that are not in one component
    split = save(placed.join(kinds.where("kind < 0").select("gid"), "gid").select("rep", "gid", "component", "n", *_BITS), "join-split")
    apart = save(split.select("rep").distinct(), "join-split-ids")
    pairs = across
    if apart.limit(1).count():
        rest = _rest(keep_ids(docs, apart, "doc_id"), sketch, n, percent)
        inside = rest.join(split, "rep").withColumn("shingle", F.xxhash64("gid", "shingle"))
        pairs = pairs.unionByName(_across(inside.drop("gid"), percent))
    pairs = pairs.where("a <> b").distinct()

    @F.pandas_udf("boolean")
    def possible(x: pd.Series, y: pd.Series, nx: pd.Series, ny: pd.Series) -> pd.Series:
        out = []
        for p, q, size in zip(x, y, nx + ny, strict=True):
            p, q = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
            k = min(len(p), len(q))
            p, q = (np.bitwise_xor.reduce(z.reshape(-1, k), axis=0) for z in (p, q))
            apart = int(np.bitwise_count(p ^ q).sum())
            out.append(100 * (size - apart) >= percent * (size + apart))
        return pd.Series(out)

    bits = grouped.select("rep", "n", "bitmap")
    pairs = pairs.join(bits.toDF("a", "na", "ba"), "a").join(bits.toDF("b", "nb", "bb"), "b").where(possible("ba", "bb", "na", "nb"))
    more = linked(docs, pairs.select("a", "b"), n, percent)
    label = components(sure.unionByName(more))
    named = reps.join(label, reps["rep"] == label["id"], "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    out = members.join(named, ["k1", "k2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    if several:  # one of its rows may have no shingle and yet lie in the component of the others
        least = keep_ids(out, mixed_ids, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("least"))
        out = out.join(save(least, "join-least"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))
    return out


def one_of_each(docs: DataFrame, n: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """docs without those that are linked to a document of lesser doc_id (all columns stay)."""
    gone = save(jaccard_components(docs, n, percent).where("component_id < doc_id").select("doc_id").distinct(), "join-gone")
    return keep_ids(docs, gone, "doc_id", keep=False)


#: The same components over all pairs of documents that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS sh FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach(id, lab) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.lab FROM reach r JOIN e ON e.a = r.id WHERE r.lab < e.b),
lab AS (SELECT id, min(lab) AS lab FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(lab.lab, d.doc_id) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN lab ON lab.id = d.doc_id"""
