"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found through a block-max inverted index.

Terms are all words of the examples (a bounded sample of labelled rows) and, beside them, the beginnings of words that speak for the
label; terms that speak most for it (signed chi-square over the sample) weigh BOOST times their idf. Document counts are taken over
all documents; words that no example has count in a text's length with the weight of the rarest. Examples with the same vector are
one entry that holds how many there are and how many of them are toxic.

Neighbours are the K nearest examples that have any word of the text, however far they are (a least cosine can be given; it is 0).
The index has two parts. The DENSE terms that most entries have are held by entry, and their products with BATCH texts at a time
are one product of matrices; all others are inverted lists whose entries lie in blocks, with the greatest weight of each term in each
block. The k-th best of the dense products is a first bound. A block whose greatest weights and best dense product add up to less is
skipped; the others are read by the lists, best first, and the k-th best sum raises the bound. What may lie within it gets its exact
cosine in double precision. Votes weighted by cosine are
turned into probabilities by isotonic regression on leave-one-out votes of the examples, which are made by a Spark job.

Defined cases: null or empty text, texts without any word of the examples, and texts none of whose neighbours is toxic get the
share of toxic examples among examples of that kind; without labelled rows every score is 0; ties of cosine at the k-th place all
vote; null labels are left out; a doc_id that is labelled twice counts as its highest label, one whose rows repeat is one example with its
least text; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NOT_ALNUM, blocks, labelled_sample, map_arrow, owner, save, strings, word_hash, words

#: Most labelled rows that examples are taken from, and most words that they have together.
FIT_ROWS, FIT_WORDS = 12_000, 8_000_000
#: Terms of more weight, neighbours, entries in a block, terms held by entry.
TERMS, K, BLOCK, DENSE = 384, 15, 64, 512
#: Least cosine of an example that votes (0: all vote), and texts whose dense parts are multiplied at once.
LEAST_COSINE, BATCH = 0.0, 128
#: Blocks that are read before the bound is raised.
FIRST_BLOCKS = 16
#: Code points of the word beginnings that are terms beside the words, and the least chi-square of a term of more weight.
STEM, LEAST_CHI = 5, 25.0
#: How many times its idf a term that speaks for the label weighs.
BOOST = 6.0
_STEM_MARK = np.uint64(0xA5A5A5A5A5A5A5A5)
PRIOR_WEIGHT = 0.25
THRESHOLD = 0.3
#: Room for rounding of sums, in double and in single precision.
_SLACK, _SLACK32 = 1e-9, 1e-5


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each length, one after another."""
    return np.arange(length.sum()) + np.repeat(start - np.cumsum(length) + length, length)


class Index:
    """Entries (distinct example vectors) out of triples (entry, term, count); term is a place in terms (ascending hashes).

    It is built where it is unpacked, on the workers: the driver holds the triples only.
    """

    def __init__(self, terms: np.ndarray, idf: np.ndarray, entry: np.ndarray, term: np.ndarray, counts: np.ndarray, count: np.ndarray, toxic: np.ndarray, example: np.ndarray, unknown: float = 0.0, stems: np.ndarray | None = None):
        self.terms, self.idf, self.unknown = terms, idf, unknown
        self.stems = np.zeros(0, np.uint64) if stems is None else stems
        self.count, self.toxic, self.example = count.astype(float), toxic.astype(float), example
        self.prior = float(self.toxic.sum() / self.count.sum()) if len(count) else 0.0
        self.triples = [x.astype(np.int32, copy=False) for x in (entry, term, counts)]

    def __getstate__(self) -> dict:
        """What the rest follows from."""
        kept = ("terms", "idf", "unknown", "stems", "count", "toxic", "example", "prior")
        return {k: self.__dict__[k] for k in kept} | {"packed": [zlib.compress(x.tobytes(), 1) for x in self.triples]}

    def __setstate__(self, state: dict) -> None:
        self.triples = [np.frombuffer(zlib.decompress(x), np.int32) for x in state.pop("packed")]
        self.__dict__.update(state)
        self.build()
        del self.triples

    def build(self) -> None:
        entry, term, counts = self.triples
        n = len(self.count)
        self.size = n
        weight = (1 + np.log(counts)) * self.idf[term] if len(term) else np.zeros(0)
        weight = weight / np.sqrt(np.maximum(np.bincount(entry, weight * weight, n), 1e-300))[entry] if len(term) else weight
        lists = np.bincount(term, minlength=len(self.terms)) if len(term) else np.zeros(len(self.terms), np.int64)
        chosen = np.argsort(-lists, kind="stable")[:DENSE]
        chosen = chosen[lists[chosen] > 0]
        self.column = np.full(len(self.terms), -1, np.int32)
        self.column[chosen] = np.arange(len(chosen))
        held = self.column[term] >= 0 if len(term) else np.zeros(0, bool)
        self.dense = np.zeros((n, len(chosen)))
        self.dense[entry[held], self.column[term[held]]] = weight[held]
        # blocks of entries with dense parts of about one length
        by_norm = np.argsort((self.dense * self.dense).sum(1), kind="stable")
        self.place = np.empty(n, np.int64)
        self.place[by_norm] = np.arange(n)
        block_of = (self.place // BLOCK).astype(np.int32)
        self.n_blocks = -(-n // BLOCK)
        self.members = np.append(by_norm, np.full(self.n_blocks * BLOCK - n, -1)).reshape(-1, BLOCK)
        self.by_place = np.zeros((self.n_blocks * BLOCK, len(chosen)), np.float32)
        self.by_place[:n] = self.dense[by_norm]
        entry, term, weight = entry[~held], term[~held], weight[~held]
        by = np.lexsort((entry, block_of[entry], term))
        self.entry, self.weight, term = entry[by], weight[by], term[by]
        # runs of one term in one block: where they start, the block, the greatest weight; and the runs of each term
        block = block_of[self.entry]
        self.start = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(block, prepend=-1)) if len(term) else np.zeros(0, np.int64)
        self.length = np.diff(self.start, append=len(term))
        self.block = block[self.start]
        self.most = np.maximum.reduceat(self.weight, self.start) if len(term) else np.zeros(0)
        self.runs = np.searchsorted(term[self.start], np.arange(len(self.terms) + 1))

    def vector(self, terms: np.ndarray, counts: np.ndarray, others: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """others: what words that no example has add to the squared length."""
        w = (1 + np.log(counts)) * self.idf[terms]
        return terms, w / np.sqrt(max((w * w).sum() + others, 1e-300))

    def products(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Products of the dense parts of vectors and entries, in single precision: a row for each vector, entries in the order of blocks."""
        q = np.zeros((len(vectors), self.by_place.shape[1]), np.float32)
        for row, (terms, weights) in zip(q, vectors, strict=True):
            column = self.column[terms]
            row[column[column >= 0]] = weights[column >= 0]
        return q @ self.by_place.T

    def nearest(self, terms: np.ndarray, weights: np.ndarray, skip: int = -1, k: int = K, least: float = LEAST_COSINE, product: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entries, cosines, votes each): the entries of the k nearest examples within the least cosine and all that tie with the
        last of them. skip: an entry of which one example is left out. product: its row of products()."""
        product = self.products([(terms, weights)])[0] if product is None else product
        kth = lambda x, low: max(low, float(np.partition(x, -k - 1)[-k - 1])) if len(x) > k else low  # noqa: E731  (k + 1: one may be left out)
        low = kth(product[: self.size], least)
        column = self.column[terms]
        held = column >= 0
        t = terms[~held]
        own = self.runs[t + 1] - self.runs[t]
        run, w = _ranges(self.runs[t], own), np.repeat(weights[~held], own)
        block = self.block[run]
        bound = np.bincount(block, w * self.most[run], self.n_blocks) + product.reshape(self.n_blocks, BLOCK).max(1) if self.n_blocks else np.zeros(0)
        best = np.zeros(self.n_blocks, bool)
        best[np.argsort(-bound)[:FIRST_BLOCKS]] = True
        e, sums = np.zeros(0, np.int64), np.zeros(0)
        for these in (best, ~best):
            these = these & (bound >= low - _SLACK32)
            mine = these[block]
            r = run[mine]
            size = self.length[r]
            p = _ranges(self.start[r], size)
            found = np.bincount(self.entry[p], np.repeat(w[mine], size) * self.weight[p], self.size)
            more = self.members[these].ravel()
            more = more[more >= 0]
            e, sums = np.concatenate([e, more]), np.concatenate([sums, found[more]])
            near = sums + product[self.place[e]]
            low = kth(near, low)
            good = near >= low - 2 * _SLACK32
            e, sums = e[good], sums[good]
        cosine = sums + self.dense[e[:, None], column[held]] @ weights[held]
        n = self.count[e] - (e == skip)
        good = (cosine >= least - _SLACK) & (cosine > 0) & (n > 0)
        e, cosine, n = e[good], cosine[good], n[good]
        order = np.lexsort((e, -cosine))
        e, cosine, n = e[order], cosine[order], n[order]
        last = np.searchsorted(np.cumsum(n), k)
        if last < len(e):
            upto = np.searchsorted(-cosine, -(cosine[last] - _SLACK), "right")
            e, cosine, n = e[:upto], cosine[:upto], n[:upto]
        return e, cosine, n

    def vote(self, terms: np.ndarray, weights: np.ndarray, skip: int = -1, own: float = 0.0, product: np.ndarray | None = None) -> tuple[float | None, np.ndarray, np.ndarray]:
        """(vote, or None if no neighbour is toxic; entries, cosines)."""
        e, s, n = self.nearest(terms, weights, skip, product=product)
        y = self.toxic[e] - own * (e == skip)
        w = s * s
        return float(((w * y).sum() + PRIOR_WEIGHT * self.prior) / ((w * n).sum() + PRIOR_WEIGHT)) if y.any() else None, e, s

    def read_vectors(self, batch_column: pa.Array, known=()) -> Iterator[tuple[int, bytes, tuple | None, np.ndarray | None]]:
        """(row, digest, vector, its row of products) of each text, BATCH texts at a time; no vector where no word is known or the
        digest was."""
        rows = self.read(batch_column)
        while some := list(itertools.islice(rows, BATCH)):
            vectors = [self.vector(t, c, others) if len(t) and key not in known else None for _, key, t, c, others in some]
            products = iter(self.products([v for v in vectors if v]))
            for (row, key, *_), v in zip(some, vectors, strict=True):
                yield row, key, v, next(products) if v else None

    def read(self, batch_column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, float]]:
        """(row, digest of the vector, terms, counts, squared weight of the words that no example has) of each text."""
        row = 0
        for i, j, text, hashed, c in _found(batch_column, self.stems):
            cut = np.searchsorted(text, np.arange(j - i + 1))
            term, there = _place(hashed, self.terms)
            c = c.astype(np.float64)
            stray = np.concatenate([[0.0], np.cumsum(np.where(there, 0.0, ((1 + np.log(c)) * self.unknown) ** 2))])
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                key = hashlib.blake2b(hashed[a:b].tobytes() + c[a:b].tobytes(), digest_size=16).digest()
                own = there[a:b]
                yield row, key, term[a:b][own], c[a:b][own], float(stray[b] - stray[a])
                row += 1


class Model:
    """A broadcast index with the probabilities of its votes."""

    def __init__(self, index, empty: float = 0.0, knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))):
        self.index, self.empty, self.knots = index, empty, knots

    def probability(self, vote: float | None) -> float:
        return self.empty if vote is None else float(np.clip(np.interp(vote, *self.knots), 0, 1))


def calibrated(votes: list[tuple[float | None, float, float]], prior: float) -> tuple[float, tuple[np.ndarray, np.ndarray]]:
    """(probability without a vote, knots): isotonic regression (pool adjacent violators) of votes (vote, label, number)."""
    none = sum(n for v, _, n in votes if v is None)
    none_toxic = sum(y * n for v, y, n in votes if v is None)
    pools: list[list[float]] = []
    for x, y, n in sorted(v for v in votes if v[0] is not None):
        pools.append([x * n, y * n, n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x = np.array([0.0, *(p[0] / p[2] for p in pools), 1.0])
    y = np.array([0.0, *((p[1] + 0.5) / (p[2] + 1) for p in pools), 1.0])
    return float((none_toxic + prior) / (none + 1)), (x, y)


SPLIT = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def _found(column: pa.Array, stems: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, end, text, hash, count) of the distinct words, and of the given beginnings of words, in blocks of texts."""
    for i, j, data, at in blocks(pc.utf8_lower(strings(column))):
        hashed, _, _, bounds = words(data, at, NOT_ALNUM)
        whose = owner(bounds)
        if len(stems):
            begin = words(data, at, NOT_ALNUM, STEM)[0]
            marked = np.where(begin == 0, begin, begin ^ _STEM_MARK)
            hit = stems[np.minimum(np.searchsorted(stems, marked), len(stems) - 1)] == marked
            hashed, whose = np.concatenate([hashed, marked[hit]]), np.concatenate([whose, whose[hit]])
        by = np.lexsort((hashed, whose))
        hashed, whose = hashed[by], whose[by]
        first = np.flatnonzero(np.concatenate([[True], (hashed[1:] != hashed[:-1]) | (whose[1:] != whose[:-1])])) if len(by) else by
        yield i, j, whose[first], hashed[first], np.diff(first, append=len(by))


def _place(hashed: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each hash in terms, whether it is there)."""
    if not len(terms):
        return np.zeros(len(hashed), np.int64), np.zeros(len(hashed), bool)
    place = np.minimum(np.searchsorted(terms, hashed), len(terms) - 1)
    return place, terms[place] == hashed


def _hash(term: str) -> int:
    return word_hash(term[:-1]) ^ int(_STEM_MARK) if term.endswith("*") else word_hash(term)


def _chosen(examples: DataFrame, n: int, p: int, most: int) -> list[str]:
    """The words and beginnings (marked *) that speak most for the label; at most `most` rows reach the driver."""
    each = examples.select("y", F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), SPLIT)).alias("w"))
    stems = F.transform(F.filter("w", lambda w: F.length(w) > STEM), lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*")))
    each = each.select("y", F.explode(F.array_distinct(F.concat("w", stems))).alias("term")).where("term <> ''")
    seen = each.groupBy("term").agg(F.count("*").alias("c"), F.sum("y").alias("t")).where("c >= 4")
    # 2 x 2 table of term and label; only terms that are commoner among the toxic
    lean = F.col("t") * F.lit(float(n)) - F.col("c") * F.lit(float(p))
    chi = lean * lean / (F.col("c") * (F.lit(float(n)) - F.col("c")) + F.lit(1.0)) * F.lit(n / max(1.0, p * float(n - p)))
    best = seen.where((lean > 0) & (chi >= LEAST_CHI)).orderBy(chi.desc(), "term").limit(most)
    return [r["term"] for r in best.select("term").collect()]


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, most_words: int = FIT_WORDS, terms: int = TERMS) -> Model:
    """labels: (doc_id, label) rows to learn from. At most `rows` of them (least hashes, with `most_words` words) are examples."""
    spark = docs.sparkSession
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    examples = labelled_sample(docs, marked, rows, most_words)
    total = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p")).first()
    none = np.zeros(0, np.int64)
    if not total["n"]:
        return Model(spark.sparkContext.broadcast(Index(np.zeros(0, np.uint64), np.zeros(0), none, none, none, none, none, none)))
    best = _chosen(examples, total["n"], total["p"], terms)
    boosted = np.array(sorted({_hash(t) for t in best}), np.uint64)
    stems = np.array(sorted({_hash(t) for t in best if t.endswith("*")}), np.uint64)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, text, hashed, c in _found(batch.column(2), stems):
                cut = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
                key = [hashlib.blake2b(hashed[a:b].tobytes() + c[a:b].tobytes(), digest_size=16).digest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (hashed.view(np.int64), c.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(key, pa.binary()), *lists], names=["doc_id", "y", "key", "hashes", "counts"])

    made = save(map_arrow(examples.select("doc_id", "y", "text"), vectors, "doc_id long, y int, key binary, hashes array<long>, counts array<int>"), "toxic-vectors")
    entries = made.where(F.size("hashes") > 0).groupBy("key").agg(F.count("*").alias("n"), F.sum("y").alias("t"), F.min("doc_id").alias("doc_id"))
    got = entries.join(made.select("doc_id", "hashes", "counts"), "doc_id").select("doc_id", "n", "t", "hashes", "counts").orderBy("doc_id").toArrow()  # bounded by rows and words
    hashes, counts = (got[c].combine_chunks() for c in ("hashes", "counts"))
    entry = np.repeat(np.arange(len(got), dtype=np.int32), pc.list_value_length(hashes).to_numpy(zero_copy_only=False).astype(np.int64))
    flat = hashes.flatten().to_numpy().view(np.uint64)
    counts = counts.flatten().to_numpy()
    count_, toxic, example = (got[c].to_numpy() for c in ("n", "t", "doc_id"))
    known = np.unique(flat)  # all words of the examples
    term = np.empty(len(flat), np.int32)
    for a in range(0, len(flat), 1 << 18):  # in pieces, as the driver has little memory
        term[a : a + (1 << 18)] = np.searchsorted(known, flat[a : a + (1 << 18)])
    del got, hashes, flat
    sent = spark.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total_n = np.zeros(len(sent.value), np.int64), 0
        for batch in batches:
            total_n += batch.num_rows
            for _, _, _, hashed, _ in _found(batch.column(0), stems):
                place, there = _place(hashed, sent.value)
                np.add.at(df, place[there], 1)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*some, -1], pa.int32()), pa.array([*df[some], total_n], pa.int64())], names=["term", "n"])

    seen = map_arrow(docs.select("text"), count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row a term
    place, n_docs = seen["term"].to_numpy(), seen["n"].to_numpy()
    df = np.zeros(len(known), np.int64)
    df[place[place >= 0]] = n_docs[place >= 0]
    most = int(n_docs[place < 0].sum())
    idf = (np.log((1 + most) / (1 + df)) + 1) * np.where(np.isin(known, boosted), BOOST, 1.0)
    index = Index(known, idf, entry, term, counts, count_, toxic, example, float(np.log(1 + most) + 1), stems)
    prior = index.prior
    shared = spark.sparkContext.broadcast(index)
    del index, entry, term, counts, known, idf, seen

    def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            for row, _, vector, product in own.read_vectors(batch.column(2)):
                e = int(np.searchsorted(own.example, ids[row]))
                if vector is None:
                    out.append((None, float(batch.column(1)[row].as_py()), 1.0))
                elif e < own.size and own.example[e] == ids[row]:  # of equal examples one stands for all
                    out += [(own.vote(*vector, e, y, product)[0], y, n) for y, n in ((1.0, own.toxic[e]), (0.0, own.count[e] - own.toxic[e])) if n > 0]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], names=["vote", "y", "n"])

    votes = map_arrow(examples.select("doc_id", "y", "text"), leave_one_out, "vote double, y double, n double").collect()  # at most two a row of the sample
    return Model(shared, *calibrated([tuple(r) for r in votes], prior))


SCORES = "doc_id long, score double, evidence array<long>, cosines array<double>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, evidence, cosines): evidence holds the nearest example documents."""
    sent, known_model = model.index, Model(None, model.empty, model.knots)  # the index is bounded by FIT_ROWS entries and FIT_WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        known: dict[bytes, tuple] = {}
        for batch in batches:
            out = []
            if len(known) > 50_000:
                known.clear()
            for _, key, vector, product in index.read_vectors(batch.column(1), known):
                if key not in known:
                    vote, e, s = index.vote(*vector, product=product) if vector else (None, [], [])
                    known[key] = round(known_model.probability(vote), 9), [int(x) for x in index.example[e[:3]]] if len(e) else [], [round(float(x), 9) for x in s[:3]]
                out.append(known[key])
            columns = [pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.list_(pa.int64())), pa.array([x[2] for x in out], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "score", "evidence", "cosines"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCORES)
