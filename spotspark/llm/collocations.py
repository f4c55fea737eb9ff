"""Phrase collocations by vertical partitioning of the suffixes of a corpus.

Suffixes of word sequences are grouped by their first words, so that each group fits a memory budget; each group builds its suffix
subtree, cut at four words, on its own, and counts are read from the totals of its leaves. The range is elastic: a first round reads
two words of each suffix, and only suffixes that go on through pairs of two words which are frequent are read to four. Prefixes whose
suffixes pass the budget are extended to whole suffixes, whose counts a task sums before they are dealt.

Words are known by 64-bit hashes of (language, word); a phrase by its tuple of hashes, so results are exact up to equal word hashes.
What the workers get is a bitmap of FILTER_BITS bits that holds the frequent words or pairs: a wrong hit costs a suffix, never a count.

Cases: null texts are empty; null languages are `und` (and one with the language of that name); rows that repeat are counted as
often as they stand; texts without words, phrases or candidates, and an empty table, give no rows; a task needs about 100 bytes for each
byte of its longest text. Columns other than text and lang take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, blocks, map_arrow, mix, owner, save, strings, words

#: Least occurrences of a candidate, and most words.
LEAST, DEPTH = 30, 4
#: Candidates of a language that are returned.
BEST = 2000
#: Distinct suffixes that a group should hold (at most 40 bytes each), and words that a task gathers before it hands them on.
BUDGET, GATHER = 250_000, 1_200_000
#: Bits of the bitmap of frequent words or pairs, and of the histogram of prefixes.
FILTER_BITS, BINS = 1 << 26, 1 << 16
#: White space and the marks at which texts are split into pieces.
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
APART = MARK.copy()
APART[[9, 32]] = True
_SEEDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _tuple_hash(columns: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.zeros(len(columns[0]), np.uint64)
        for c, seed in zip(columns, _SEEDS, strict=False):
            out = mix(out * seed + c + seed)
    return out


def _tokens(batches: Iterator[pa.RecordBatch], gather: int = GATHER) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """(word hashes, piece numbers, [(language, bytes, starts, ends, first word)]) of about `gather` words at a time, whole texts each."""
    held: list = []
    n = pieces = 0
    for batch in batches:
        langs, text = pc.fill_null(batch.column("lang").cast(pa.string()), "und"), strings(batch.column("text"))
        for lang in pc.unique(langs).to_pylist():
            salt = words(np.frombuffer(lang.encode() or b"\xff", np.uint8), np.array([0, len(lang.encode() or b"\xff")]), np.zeros(256, bool))[0][0]
            for _, _, data, at in blocks(text.filter(pc.equal(langs, lang))):
                h, start, end, first = words(data, at, APART)
                if not len(h):
                    continue
                with np.errstate(over="ignore"):
                    h = mix(h ^ (salt * _SEEDS[0]))
                h[h == 0] = 1  # 0 stands for no word
                piece = np.cumsum(MARK[data])[start] + owner(first) + pieces
                pieces = int(piece[-1]) + 1
                held.append((h, piece, (lang, data, start, end)))
                n += len(h)
                if n >= gather:
                    yield _joined(held)
                    held, n = [], 0
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple[np.ndarray, np.ndarray, list]:
    at = np.cumsum([0, *[len(x[0]) for x in held]])
    return np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), [(*x[2], int(a)) for x, a in zip(held, at, strict=False)]


def vocabulary(docs: DataFrame) -> DataFrame:
    """(w, lang, word, n): hash, language, lower-cased word and number of occurrences, saved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, _, sources in _tokens(batches):
            w, first, n = np.unique(h, return_index=True, return_counts=True)
            which = np.searchsorted([s[4] for s in sources], first, "right") - 1
            langs, names = [], []
            for k, i in zip(which.tolist(), first.tolist(), strict=True):
                lang, data, start, end, at = sources[k]
                langs.append(lang)
                names.append(bytes(data[start[i - at] : end[i - at]]).lower())
            for i in range(0, len(w), 50_000):
                part = slice(i, i + 50_000)
                yield pa.record_batch({"w": w[part].view(np.int64), "lang": langs[part], "word": pa.array(names[part], pa.binary()).cast(pa.string()), "n": n[part].astype(np.int64)})

    every = map_arrow(docs.select("lang", "text"), run, "w long, lang string, word string, n long")
    return save(every.groupBy("w").agg(F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("n").alias("n")), "words")


def bitmap(rows: DataFrame, columns: list[str], bits: int = FILTER_BITS) -> np.ndarray:
    """Bytes of a bitmap in which every tuple of the columns has its bit. Its size is fixed; only distinct bits of a block meet."""
    block = min(bits, 1 << 16)

    def at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bit = np.unique(_tuple_hash([b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in columns]) % np.uint64(bits)).astype(np.int64)
            yield pa.record_batch({"block": bit // block, "bit": (bit % block).astype(np.int32)})

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(block, bool)
        flags[frame["bit"].to_numpy()] = True
        return pd.DataFrame({"block": frame["block"].iloc[:1], "bytes": [np.packbits(flags).tobytes()]})

    found = map_arrow(rows.select(*columns), at, "block long, bit int").distinct().groupBy("block").applyInPandas(packed, "block long, bytes binary")
    out = np.zeros((bits // block, block // 8), np.uint8)
    for r in found.collect():
        out[r["block"]] = np.frombuffer(r["bytes"], np.uint8)
    return out.reshape(-1)


def _has(flags: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    at = _tuple_hash(columns) % np.uint64(len(flags) * 8)
    return (flags[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1


def _suffixes(h: np.ndarray, piece: np.ndarray, depth: int, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of `depth` word hashes, counts) of the distinct suffixes that may hold a frequent phrase, cut where none can go on.

    depth 2: flags holds the frequent words; both words have to be there. Greater: flags holds the frequent pairs; the first three words
    have to run through them.
    """
    none = np.zeros((0, depth), np.uint64), np.zeros(0, np.int64)
    if len(h) < 2:
        return none
    same = piece[:-1] == piece[1:]
    if depth == 2:
        good = _has(flags, [h])
        first = np.flatnonzero(same & good[:-1] & good[1:])
        rows = np.stack([h[first], h[first + 1]], axis=1)
    else:
        link = np.zeros(len(h) + depth, bool)
        link[: len(h) - 1] = same & _has(flags, [h[:-1], h[1:]])
        first = np.flatnonzero(link[: len(h)] & link[1 : len(h) + 1])
        rows, on = np.zeros((len(first), depth), np.uint64), np.ones(len(first), bool)
        for k in range(depth):
            if k:
                on = on & link[first + k - 1]
            rows[on, k] = h[first[on] + k]
    if not len(rows):
        return none
    return _summed(rows, np.ones(len(rows), np.int64))


def _summed(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in the order of a suffix tree, with the sums of their counts."""
    order = np.lexsort(rows.T[::-1])
    rows, n = rows[order], n[order]
    new = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]
    return rows[new], np.add.reduceat(n, np.flatnonzero(new))


def _subtree(rows: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nodes of each depth from 2 on of the subtree of a group: (prefixes, totals of the leaves below)."""
    out = []
    for k in range(2, rows.shape[1] + 1):
        deep = rows[:, k - 1] != 0
        if deep.any():
            own, m = rows[deep, :k], n[deep]
            new = np.r_[True, (own[1:] != own[:-1]).any(axis=1)]
            nodes = np.zeros((int(new.sum()), rows.shape[1]), np.uint64)
            nodes[:, :k] = own[new]
            out.append((nodes, np.add.reduceat(m, np.flatnonzero(new))))
    return out


def phrases(docs: DataFrame, depth: int, flags: np.ndarray, weights: DataFrame, budget: int = BUDGET, least: int = LEAST) -> DataFrame:
    """(w1 .. w<depth>, n): phrases of two words (depth 2), or of three to `depth` words, with n >= least, saved; 0 stands for no word.

    weights: (w1[, w2], n): the prefixes (one word, or a pair of words) with the occurrences that start with them. Light prefixes are
    grouped by a histogram of BINS bins of their hashes, which is cut into groups of the budget (a prefix is never cut); heavy ones are
    extended to whole suffixes.
    """
    sc = docs.sparkSession.sparkContext
    prefix = [c for c in weights.columns if c != "n"]

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(BINS, np.int64)
        for b in batches:
            n = b.column("n").to_numpy(zero_copy_only=False)
            light = n <= budget
            hashed = _tuple_hash([b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in prefix])
            np.add.at(load, (hashed % np.uint64(BINS)).astype(np.int64)[light], n[light])
        at = np.flatnonzero(load)
        yield pa.record_batch({"bin": at, "n": load[at]})

    load = np.zeros(BINS, np.int64)
    heavy_total = weights.where(F.col("n") > budget).agg(F.sum("n")).first()[0] or 0
    for r in map_arrow(weights, to_bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        load[r["bin"]] = r["n"]
    before = np.cumsum(load) - load
    n_light, n_heavy = int(load.sum()) // budget + 1, -(-int(heavy_total) // budget)
    # a prefix above the budget: at most (occurrences / budget) of them; they are told apart by a bitmap, so nothing grows on the workers
    heavy = bitmap(weights.where(F.col("n") > budget), prefix, 1 << 23)
    shared = sc.broadcast((flags, heavy, before, load))
    names = [f"w{k + 1}" for k in range(depth)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, heavy, before, load = shared.value
        for h, piece, _ in _tokens(batches):
            rows, n = _suffixes(h, piece, depth, flags)
            if not len(rows):
                continue
            start = [np.ascontiguousarray(rows[:, k]) for k in range(len(prefix))]
            hashed = _tuple_hash(start)
            at = (hashed % np.uint64(BINS)).astype(np.int64)
            within = ((hashed >> np.uint64(32)) & np.uint64(0xFFFFFF)).astype(np.float64) / (1 << 24)
            group = ((before[at] + within * load[at]) // budget).astype(np.int64)
            if n_heavy:
                split = _has(heavy, start)
                whole = _tuple_hash([np.ascontiguousarray(rows[split, k]) for k in range(depth)])
                group[split] = n_light + ((whole >> np.uint64(32)) % np.uint64(n_heavy)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            group, rows, n = group[order], rows[order], n[order]
            at = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
            for i in range(0, len(at) - 1, 64):
                ends = list(zip(at[i : i + 64], at[i + 1 : i + 65], strict=False))
                blobs, sums = [rows[a:b].tobytes() for a, b in ends], [n[a:b].astype(np.int64).tobytes() for a, b in ends]
                yield pa.record_batch({"group": group[[a for a, _ in ends]], "rows": pa.array(blobs, pa.binary()), "n": pa.array(sums, pa.binary())})

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        rows = np.concatenate([np.frombuffer(x, np.uint64) for x in frame["rows"]]).reshape(-1, depth)
        rows, n = _summed(rows, np.concatenate([np.frombuffer(x, np.int64) for x in frame["n"]]))
        out = []
        for nodes, total in _subtree(rows, n):
            if frame["group"].iloc[0] < n_light:  # no other group has these prefixes
                nodes, total = nodes[total >= least], total[total >= least]
            out.append(pd.DataFrame({**{c: nodes[:, k].view(np.int64) for k, c in enumerate(names)}, "n": total}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in [*names, "n"]})

    blobs = map_arrow(docs.select("lang", "text"), run, "group long, rows binary, n binary")
    nodes = blobs.groupBy("group").applyInPandas(build, ", ".join(f"{c} long" for c in [*names, "n"]))
    if depth > 2:
        nodes = nodes.where("w3 <> 0")  # pairs were counted in the round before
    return save(nodes.groupBy(*names).agg(F.sum("n").alias("n")).where(F.col("n") >= least), "phrases")


def frequent(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, counts): counts has lang, w1 .. w4 (0: none), k words, n of all phrases of 1 to 4 words with n >= least."""
    vocab = vocabulary(docs)
    common = vocab.where(F.col("n") >= least)
    pairs = phrases(docs, 2, bitmap(common, ["w"]), common.select(F.col("w").alias("w1"), "n"), budget, least)
    longer = phrases(docs, DEPTH, bitmap(pairs, ["w1", "w2"]), pairs, budget, least)
    none = F.lit(0).cast("long")
    one = common.select(F.col("w").alias("w1"), none.alias("w2"), none.alias("w3"), none.alias("w4"), F.lit(1).alias("k"), "n")
    two = pairs.select("w1", "w2", none.alias("w3"), none.alias("w4"), F.lit(2).alias("k"), "n")
    more = longer.select("w1", "w2", "w3", "w4", F.when(F.col("w4") == 0, 3).otherwise(4).alias("k"), "n")
    return vocab, save(one.unionByName(two).unionByName(more), "counts")


_KEY = ["w1", "w2", "w3", "w4"]


def _sub(start, size, prefix: str = "") -> list:
    """Columns of the phrase of `size` words from word `start` (0-based) on of the row's phrase."""
    word = F.array(*_KEY)
    return [F.when(F.lit(k) < size, F.get(word, start + k)).otherwise(F.lit(0).cast("long")).alias(f"{prefix}w{k + 1}") for k in range(4)]


def scored(counts: DataFrame) -> DataFrame:
    """Candidates (two words or more): w1 .. w4, k, a, l, r, score of the lowest-scoring cut (ties to the smallest)."""
    cands = counts.where("k > 1").withColumnRenamed("n", "a")
    cut = cands.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.select(*_KEY, "k", "a", "cut", *_sub(F.lit(0), F.col("cut"), "l_"), *_sub(F.col("cut"), F.col("k") - F.col("cut"), "r_"))
    for side in ("l", "r"):
        part = counts.select(*[F.col(c).alias(f"{side}_{c}") for c in _KEY], F.col("n").alias(side))
        cut = cut.join(part, [f"{side}_{c}" for c in _KEY])
    # 2,000,000 a may pass 64 bits
    cut = cut.withColumn("score", F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000BD div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))").cast("long"))
    best = cut.groupBy(*_KEY, "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select(*_KEY, "k", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))


def undominated(cands: DataFrame) -> DataFrame:
    """Candidates but those that lie in a longer candidate with at least 80 % of their occurrences."""
    long_ = cands.where("k > 2").select(*_KEY, "k", "a")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda s: F.transform(F.sequence(F.lit(0), F.col("k") - s), lambda i: F.struct(i.alias("start"), s.alias("size")))))
    inner = long_.select("*", F.explode(spans).alias("s"))
    inner = inner.select(*_sub(F.col("s.start"), F.col("s.size")), "a").groupBy(*_KEY).agg(F.max("a").alias("longer"))
    return cands.join(inner, _KEY, "left").where("longer IS NULL OR longer * 5 < a * 4").drop("longer")


def collocations(docs: DataFrame, best: int = BEST, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `best` candidates of each language by score, a (both descending) and phrase."""
    vocab, counts = frequent(docs, least, budget)
    left = undominated(save(scored(counts), "scored"))
    names = vocab.where(F.col("n") >= least)
    left = left.join(names.select(F.col("w").alias("w1"), "lang", F.col("word").alias("p1")), "w1")
    for k in (2, 3, 4):
        left = left.join(names.select(F.col("w").alias(f"w{k}"), F.col("word").alias(f"p{k}")), f"w{k}", "left")
    left = save(left.select("lang", F.concat_ws(" ", "p1", "p2", "p3", "p4").alias("phrase"), "a", "l", "r", "score"), "kept")
    sizes = vocab.groupBy("lang").agg(F.sum("n").alias("n"))
    return first_of(left, best).join(F.broadcast(save(sizes, "sizes")) if sizes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def first_of(rows: DataFrame, best: int, meet: int = 50_000, fan: int = 16) -> DataFrame:
    """The first `best` rows of each lang by score and a (descending) and phrase, with rank. Rows of a language meet in parts of about
    `meet` rows; the first of `fan` parts meet in the next round, so that no task holds a language."""
    parts = -(-rows.count() // meet)
    part = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(max(1, parts))))
    while True:
        order = Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a"), "phrase")
        part = part.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
        if parts <= 1:
            return part.drop("part")
        parts = -(-parts // fan)
        part = save(part.drop("rank").withColumn("part", F.expr(f"part div {fan}")), "first")


ORACLE = f"""WITH t AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
s AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
f AS MATERIALIZED (SELECT lang, g, len(g) AS k, count(*)::HUGEINT AS n FROM (
    SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k: list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])))) AS g FROM s) GROUP BY 1, 2, 3 HAVING count(*) >= {LEAST}),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM s GROUP BY 1),
cuts AS (SELECT lang, g, k, n AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
score AS (SELECT c.lang, c.g, c.k, c.a, c.cut, x.n AS l, y.n AS r, 2000000 * c.a // (x.n + y.n) AS score FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.cut + 1:]),
low AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, sub, max(a) AS longer FROM (
    SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda z: list_transform(range(1, k - z + 2), lambda i: g[i:i + z - 1])))) AS sub FROM low WHERE k > 2) GROUP BY 1, 2),
kept AS (SELECT low.*, array_to_string(g, ' ') AS phrase FROM low LEFT JOIN inner_ i ON i.lang = low.lang AND i.sub = low.g WHERE i.longer IS NULL OR 100 * i.longer < 80 * low.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= {BEST}"""
