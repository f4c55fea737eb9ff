"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Words (lower-case runs of letters and digits) of test items and of training texts are hashed under fixed masks: a mask of
span s ignores some of s consecutive words, so a hit survives a substitution at an ignored place. Training hashes are
joined to test hashes on the hash; each hit fixes an alignment (diagonal), along which the whole item is then compared
word by word with the text. A pair counts if the aligned equal words are many enough: substitutions anywhere are tolerated.

What is joined first is small rows of fixed size (hash, item, place): they are broadcast if their counted rows are under a
bound; the join is then done in the scan's own stage, with no shuffle of the corpus. Beyond it, hashes are joined by a
shuffle. Diagonals are aggregated where they are found and carry no words; they meet their texts again by (doc_id, hash of the
text), and items come in last, by a broadcast if their counted bytes are few. Both ways give the same rows.

Defined cases: null texts have no words; texts with fewer words than the shortest mask's span never match, nor do items with
fewer than `least` words (they can't have as many equal ones); a null doc_id or item_id is a value of its own and carried as null;
rows that repeat a doc_id give its best pairs over all of their texts; repeated rows are one pair; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import keep_ids, save

#: Masks as positions that are kept (span, positions): weight 6 in spans of 8 and 10.
MASKS = ((0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 8, 9))
SPLIT = r"[^\p{L}\p{N}]+"
#: Least aligned equal words, share of the item's words, and number of equal words that is enough whatever the share.
LEAST, SHARE, ENOUGH = 10, 0.6, 20
BROADCAST_HASHES, BROADCAST_BYTES = 500_000, 32 << 20


def _exploded(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, seed): the seeds of all masks at each start with a whole span.

    The words are exploded and the seeds computed from their array after it, so that all of this and a broadcast join of the
    seeds are one stage of generated code. (Seeds from a lambda over the starts are interpreted: several times slower.)
    """
    cut = df.select(*keys, F.split(F.lower("text"), SPLIT).alias("words"))
    # outer: else Spark infers a filter on the size of the array and splits each text once more at the scan
    each = cut.select(*keys, "words", F.posexplode_outer("words").alias("start", "word")).drop("word")
    n = F.size("words")

    def seed(number: int, mask: tuple[int, ...]) -> Column:
        kept = [F.get("words", F.col("start") + p) for p in mask]
        return F.when(F.col("start") + mask[-1] < n, F.xxhash64(F.lit(number), *kept))

    seeds = F.explode_outer(F.array(*[seed(k, m) for k, m in enumerate(MASKS)]))
    return each.select(*keys, "start", seeds.alias("seed")).where(F.col("seed").isNotNull())


#: Rows that the diagonals of one text are dealt to: each splits the text once.
DEALT = 16


def _compared(docs: DataFrame, pairs: DataFrame, known: DataFrame, few_bytes: bool) -> DataFrame:
    """(doc_id, text_hash, key, n_item, start_word, n_equal) of each diagonal in pairs (doc_id, text_hash, key, n_item, shift).

    Texts that have a diagonal meet a few arrays of them; a diagonal then carries as many words of its text as its item has, never the whole
    text. Words are compared by exploding the item into a partial aggregate: generated code holds all rows that one row makes until it is
    done with it, unless an aggregate takes them.
    """
    ids = save(pairs.select("text_hash").distinct(), "test-found")
    texts = keep_ids(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), ids, "text_hash")
    dealt = pairs.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.pmod("key", F.lit(DEALT)).alias("deal")).agg(F.collect_list(F.struct("key", "n_item", "shift")).alias("pairs"))
    met = texts.join(dealt, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    each = met.select("doc_id", "text_hash", F.split(F.lower("text"), SPLIT).alias("words"), "pairs").select("doc_id", "text_hash", "words", F.explode("pairs").alias("p"))
    shift = F.col("p.shift")
    before = F.least(shift, F.lit(0))  # less than 0: so many words of the item lie before the text
    window = F.slice("words", F.greatest(shift, F.lit(0)) + 1, F.col("p.n_item") + before)
    lead = F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0)  # what splits off before a text's first word
    each = each.select("doc_id", "text_hash", F.col("p.key").alias("key"), F.col("p.n_item").alias("n_item"), (shift - lead).alias("start_word"), before.alias("before"), window.alias("window"))
    item = known.select("key", "item")
    words = each.join(F.broadcast(item) if few_bytes else item, "key").select("doc_id", "text_hash", "key", "n_item", "start_word", "before", "window", F.posexplode("item").alias("at", "word"))
    same = F.coalesce(F.get("window", F.col("at") + F.col("before")) == F.col("word"), F.lit(False))
    # a text whose row repeats meets its diagonals as often
    n_equal = F.sum(same.cast("int")) / F.sum((F.col("at") == 0).cast("int"))
    return words.groupBy("doc_id", "text_hash", "key", "n_item", "start_word").agg(n_equal.cast("long").alias("n_equal"))


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, share: float = SHARE, enough: int = ENOUGH) -> DataFrame:
    """(doc_id, item_id, n_equal, n_item, start_word): one row for each contaminated pair, its best alignment.

    start_word is the place of the item's first word among the text's words, from 0; it is negative where the text has only the rest.
    """
    bare = F.regexp_replace(F.lower("text"), f"^{SPLIT}|{SPLIT}$", "")
    items = save(benchmark.select("item_id", bare.alias("text")).distinct(), "test-items")
    # equal texts of items are looked for once
    known = items.select("text").distinct().select("text", F.split("text", SPLIT).alias("item")).where(F.size("item") >= least)
    known = save(known.withColumn("key", F.monotonically_increasing_id()), "test-texts")
    # one row for each text, seed and start; equal seeds stay apart as they tell different pairs
    test = _exploded(known.withColumn("n_item", F.size("item")), ["key", "n_item"]).withColumnRenamed("start", "item_start")
    few_hashes = test.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES
    size = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    few_bytes = size <= BROADCAST_BYTES and few_hashes  # an item has at least one hash, so its rows are few as well
    own = _exploded(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), ["doc_id", "text_hash"])
    hits = own.join(F.broadcast(test) if few_hashes else test, "seed")
    pairs = save(hits.select("doc_id", "text_hash", "key", "n_item", (F.col("start") - F.col("item_start")).alias("shift")).distinct(), "test-hits")
    enough_words = (F.col("n_equal") >= share * F.col("n_item")) | (F.col("n_equal") >= enough)
    found = _compared(docs, pairs, known, few_bytes).where((F.col("n_equal") >= least) & enough_words)
    names = items.join(known.select("text", "key"), "text").select("item_id", "key")
    best = F.max_by(F.struct("n_equal", "n_item", "start_word"), F.struct("n_equal", -F.col("n_item"), -F.col("start_word")))
    found = found.join(names, "key").groupBy("doc_id", "item_id").agg(best.alias("best"))
    return found.select("doc_id", "item_id", *[F.col(f"best.{c}").cast("long").alias(c) for c in ("n_equal", "n_item", "start_word")])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs whose text holds no benchmark passage, with all their columns. Whether it does is a matter of the text alone, so rows with a
    null or repeated doc_id are judged by their own texts."""
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    leaks = save(overlaps(texts, benchmark).select("doc_id").distinct(), "leaks")
    marked = keep_ids(docs.withColumn("__text_hash", F.xxhash64("text")), leaks, "__text_hash", keep=False)
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns])


def _oracle() -> str:
    """The same rules in SQL: seeds as texts of the kept words, then whole items along each diagonal."""
    words = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

    def seeds(table: str, keys: str) -> str:
        each = []
        for k, mask in enumerate(MASKS):
            kept = " || ' ' || ".join(f"w[i + {m + 1}]" for m in mask)
            each.append(f"SELECT {keys}, i, '{k} ' || {kept} AS seed FROM (SELECT {keys}, w, unnest(range(greatest(len(w) - {mask[-1]}, 0))) AS i FROM {table})")
        return " UNION ALL ".join(each)

    return f"""
WITH it AS MATERIALIZED (SELECT DISTINCT item_id, {words} AS w FROM benchmark), ok AS MATERIALIZED (SELECT item_id, w, row_number() OVER () AS item FROM it WHERE len(w) >= {LEAST}),
dd AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
si AS MATERIALIZED ({seeds("ok", "item")}), sd AS ({seeds("dd", "doc_id")}),
hit AS MATERIALIZED (SELECT DISTINCT sd.doc_id, si.item, sd.i - si.i AS shift FROM sd JOIN si ON si.seed = sd.seed),
eq AS (SELECT h.doc_id, o.item_id, len(o.w) AS n_item, shift, len(list_filter(range(1, len(o.w) + 1), lambda k: k + shift >= 1 AND k + shift <= len(d.w) AND d.w[k + shift] = o.w[k])) AS n_equal FROM hit h JOIN ok o ON o.item = h.item JOIN dd d ON d.doc_id = h.doc_id)
SELECT doc_id, item_id, CAST(n_equal AS BIGINT) AS n_equal, CAST(n_item AS BIGINT) AS n_item, CAST(shift AS BIGINT) AS start_word FROM eq
WHERE n_equal >= {LEAST} AND (n_equal >= {SHARE}::DOUBLE * n_item OR n_equal >= {ENOUGH})
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, n_item, shift) = 1"""


ORACLE = _oracle()
