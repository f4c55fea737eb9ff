"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

A value that follows a credential word is split by dynamic programming into the segments that are cheapest to guess: words by
their rank (of a short list, and of the corpus' own commonest words where those were counted) with common letter swaps and
capitals, dates, repeats, keyboard walks, runs of following characters, and brute force for what is left. The least total cost, in
decimal digits of guesses, says how hard the value is to guess: a machine-made secret costs much, a placeholder or word little. Values
above a threshold are added as spans of kind "guess", whatever characters they have, unless a span of kind "assign" has the same value
to its end or an earlier "guess" span holds it.

Time is linear in the text: a run of value characters is segmented once, from its end on, which gives the costs of all values that
end there, wherever they start.

Defined cases: null or empty text has no spans; values of any length are segmented whole; repeated rows give their spans each; null
doc_ids are carried; extra columns stay in redact(), are ignored in scan().
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow, strings

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_VALUE = r"[^\s\"'<>,;|]"
#: Wider contexts for values whose guess cost decides. Possessive, so that blanks are read once.
CONTEXT = re.compile(rf"""(?:password|passwd|pwd|passphrase|passcode|secret|token|api_?key|access_?key|private_?key|auth_?key|credentials?|bearer)["']?+\x20*+(?:(?:[:=]|(?<=\x20)is\b)\x20*+)?+["']?+(?={_VALUE}{{8}})""", re.I | re.A)
#: The same for Java, with the value.
_BEHIND = r"""(?:password|passwd|pwd|passphrase|passcode|secret|token|api_?key|access_?key|private_?key|auth_?key|credentials?|bearer)["']?\x20*+(?:(?:[:=]|(?<=\x20)is\b)\x20*+)["']?[^\s"'<>,;|]+"""
#: A value behind a credential word without a mark between: letters alone, but for a sentence's marks, are prose.
_MARKED = re.compile(r"[:=]|\bis\b")
_RUN = re.compile(rf"{_VALUE}*+", re.A)
#: A text without any of these has no assign span and no context.
HINTS = ("passw", "pwd", "passphrase", "passcode", "secret", "token", "apikey", "api_key", "accesskey", "access_key", "privatekey", "private_key", "authkey", "auth_key", "credential", "bearer")
KINDS = ("assign", "access", "hex", "guess")
#: Decimal digits of guesses from which a value counts as a secret; what the choice of each further segment costs.
THRESHOLD, CHOICE = 12.0, 0.3
#: Words of the corpus that count as words of a value: so many, of at least so many documents.
LEARNED, LEAST_DOCS = 10_000, 5

# Common words of passwords and placeholders by rank.
WORDS = """password pass admin user root test example demo sample secret token login welcome default change changeme me my your the
placeholder dummy value here key api access none null true false unknown letmein monkey dragon master hello love sunshine princess football
baseball shadow michael jordan super hunter buster soccer batman andrew tigger charlie robert thomas hockey ranger daniel starwars george computer
michelle jessica pepper freedom summer winter spring autumn secure security system server database local localhost public private production
staging development dev prod guest service account email data config setting environment variable string text insert enter todo required
redacted hidden masked removed x xx xxx abc qwerty iloveyou trustno god money""".split()
_SWAPS = str.maketrans("@4310$57!", "aaelosstii"[:9])
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d|(?:19|20)\d\d")
_REPEAT = re.compile(r"(.{1,12}?)\1++", re.S)


def _prose_end(value: str) -> str:
    """The letters at the end of a value, with a sentence's marks after them."""
    k = len(value.rstrip(".:!?)"))
    while k and value[k - 1].isalpha():
        k -= 1
    return value[k:]


def _near() -> dict[str, set[str]]:
    """Keys beside each key on a keyboard whose rows are set off by half a key."""
    near: dict[str, set[str]] = {}
    spot = {c: (r, i + r / 2) for r, row in enumerate(_ROWS) for i, c in enumerate(row)}
    for a, (ra, xa) in spot.items():
        near[a] = {b for b, (rb, xb) in spot.items() if a != b and abs(ra - rb) <= 1 and abs(xa - xb) <= 1}
    return near


_BESIDE = _near()


def brute_force(c: str) -> float:
    return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() and (c.islower() or c.isupper()) else math.log10(33)


class Guesser:
    """Costs of values; holds the words by rank."""

    def __init__(self, learned: tuple[str, ...] = ()):
        self.rank = {w: i + 1 for i, w in reversed(list(enumerate(dict.fromkeys([*WORDS, *learned]))))}
        self.finder = ahocorasick.Automaton()
        for w in self.rank:
            self.finder.add_word(w, w)
        self.finder.make_automaton()

    def segments(self, v: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, cost) of every segment that a pattern explains."""
        n = len(v)
        low = v.lower()
        if len(low) != n:  # a letter whose lower case is longer
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in v)
        plain = low.translate(_SWAPS)
        for form in (low, plain) if plain != low else (low,):
            for last, w in self.finder.iter(form):
                i, j = last + 1 - len(w), last + 1
                caps = 0.0 if v[i:j] == low[i:j] else 0.4 if v[i:j] in (low[i:j].upper(), low[i:j].capitalize()) else 1.5
                yield i, j, math.log10(self.rank[w] + 1) + caps + (0.0 if w == low[i:j] else 0.5)
        for m in _DATE.finditer(v):
            yield m.start(), m.end(), math.log10(366 * 120) if m.end() - m.start() > 4 else math.log10(120)
        for m in _REPEAT.finditer(v):
            yield m.start(), m.end(), sum(map(brute_force, m[1])) + math.log10((m.end() - m.start()) / len(m[1]))
        i = 0
        while i < n:  # keyboard walks
            j, turns, last = i + 1, 0, None
            while j < n and low[j] in _BESIDE.get(low[j - 1], ()):
                step = ord(low[j]) - ord(low[j - 1])
                turns += step != last
                last = step
                j += 1
            if j - i >= 3:
                yield i, j, math.log10(94) + 0.3 * (j - i) + 0.3 * min(turns, 3)
            i = j if j - i >= 3 else i + 1
        i = 0
        while i < n:  # abcdef, 987654
            j = i + 1
            while j < n and ord(v[j]) - ord(v[j - 1]) == (ord(v[i + 1]) - ord(v[i])) and abs(ord(v[j]) - ord(v[j - 1])) == 1:
                j += 1
            if j - i >= 3:
                yield i, j, 1.0 + math.log10(j - i)
            i = max(i + 1, j - 1)

    def costs(self, value: str) -> list[float]:
        """For each i the least decimal digits of guesses over all segmentations of value[i:]."""
        n = len(value)
        starts: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for i, j, cost in self.segments(value):
            starts[i].append((j, cost))
        best = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            least = best[i + 1] + brute_force(value[i])
            for j, cost in starts[i]:
                least = min(least, best[j] + cost + CHOICE)
            best[i] = least
        return best

    def cost(self, value: str) -> float:
        return self.costs(value)[0]

    def spans(self, text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, int, float]]:
        """(start, end, kind as index of KINDS, guess cost) ordered by start, kind. Costs are 0 for access and hex."""
        out = []
        low = text.lower()
        if any(h in low for h in HINTS):
            reach: dict[int, int] = {}  # end of the assign span by the start of its value
            for m in ASSIGN.finditer(text):
                if len(m[2]) >= 8:
                    out.append((m.start(), m.end(), 0, self.cost(m[2])))
                    reach[m.start(2)] = m.end(2)
            done = begin = end = 0
            costs: list[float] = []
            for m in CONTEXT.finditer(text):  # the value is looked ahead at, so a credential word in it is tried as well
                a = m.end()
                if a >= end:  # a new run of value characters
                    begin, end, costs = a, _RUN.match(text, a).end(), []
                    prose = end - len(_prose_end(text[begin:end]))  # from here on a value is prose
                if end > max(done, reach.get(a, 0)) and (a < prose or _MARKED.search(m[0])):
                    costs = costs or self.costs(text[begin:end])
                    if costs[a - begin] >= threshold:
                        out.append((a, end, 3, costs[a - begin]))
                        done = end
        if "AKIA" in text:
            out += [(m.start(), m.end(), 1, 0.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        out += [(m.start(), m.end(), 2, 0.0) for m in HEX.finditer(text)]
        return sorted(out, key=lambda x: (x[0], x[2]))


def learn_words(docs: DataFrame, most: int = LEARNED, least_docs: int = LEAST_DOCS) -> tuple[str, ...]:
    """The commonest words (4 to 24 letters a-z, by documents) over all documents: at most `most` rows reach the driver.

    What stands behind a credential word is not learned from, so a secret that many documents hold stays one.
    """
    said = F.regexp_replace(F.lower("text"), _BEHIND, " ")
    words = F.array_distinct(F.regexp_extract_all(said, F.lit("[a-z]{4,}"), F.lit(0)))
    each = docs.select(F.explode(words).alias("w")).where("length(w) <= 24")
    seen = each.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= least_docs)
    return tuple(r["w"] for r in seen.orderBy(F.desc("n"), "w").limit(most).collect())


def _plain(found: list[tuple[int, int, int, float]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k, _ in found)


SCAN = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, highest_cost double"


def scan(docs: DataFrame, threshold: float = THRESHOLD, words: tuple[str, ...] | None = None) -> DataFrame:
    """One row for each document: counts and spans (code points, end exclusive), see SCAN. words: as of learn_words(), which are else
    learned from docs."""
    names = [x.split()[0] for x in SCAN.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
    learned = learn_words(docs) if words is None else words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = Guesser(learned)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                found = guesser.spans(text.as_py(), threshold)
                base = [x for x in found if x[2] < 3]
                count = [sum(x[2] == k for x in found) for k in range(4)]
                rows.append((doc_id, *count[:3], hashlib.sha256(_plain(base).encode()).hexdigest(), _plain(found), count[3], max((x[3] for x in found), default=0.0)))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCAN)


def redact(docs: DataFrame, mark: str = "[SECRET]", threshold: float = THRESHOLD, words: tuple[str, ...] | None = None) -> DataFrame:
    """docs with every span of the text replaced by the mark (overlapping spans by one); n_chars, where it exists, follows."""
    fields = docs.columns
    at = fields.index("text")
    learned = learn_words(docs) if words is None else words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = Guesser(learned)
        for batch in batches:
            out, sizes = [], []
            for text in batch.column(at):
                text = text.as_py()
                found = guesser.spans(text, threshold) if text else []
                if found:
                    parts, done = [], 0
                    for a, b, _, _ in found:
                        if a >= done:
                            parts += [text[done:a], mark]
                        done = max(done, b)
                    text = "".join([*parts, text[done:]])
                out.append(text)
                sizes.append(None if text is None else len(text))
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            if "n_chars" in fields:
                k = fields.index("n_chars")
                columns[k] = pa.array(sizes, pa.int64()).cast(columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    return map_arrow(docs, run, docs.schema)
