"""Collocations against plain counting, and odd rows."""

import collections
import random
import re

import pytest

from spotspark.llm import collocations

SCHEMA = "text string, lang string, word string, w1 string, n string"


def plain(rows, best, least):
    """(lang, rank, phrase, a, l, r, n, score) by counting every run of 1 to 4 words."""
    f, total = collections.Counter(), collections.Counter()
    for text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cands = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    longer = collections.Counter()
    for (lang, w), a in cands.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i : i + k]] = max(longer[lang, w[i : i + k]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in cands.items():
        if 100 * longer[lang, w] < 80 * a:
            score, _, left, right = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for lang, every in out.items() for i, (s, a, p, left, right) in enumerate(sorted(every)[:best]))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = []
    for i in range(400):
        w = [rng.choice(["Alpha", "beta", "ÉTÉ", "été", "字", "zeta x", "eta"]) for _ in range(rng.randrange(60))]
        text = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for x in w)
        made.append((text, rng.choice([None, "en", "en", "und", ""])))
    passage = "one two three four five six seven"
    made += [(passage, "en")] * 40 + [(None, "en"), ("", None), (" .,;", "fr"), ("lone", "fr"), ("of the " * 30_000, "de"), ("x" * 50_000 + " y", "de")]
    return [(*r, "clash", "clash", "clash") for r in made]


def found(df, **kw):
    return sorted(tuple(r) for r in collocations.collocations(df, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("parts", "budget"), [(1, 250_000), (7, 150)])
def test_collocations_equal_plain_counts(spark, rows, parts, budget):
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(parts), best=25, least=5, budget=budget)
    assert got == plain(rows, 25, 5)
    assert {r[0] for r in got} >= {"en", "und", "", "de"}


def test_collocations_of_nothing(spark):
    for rows in ([], [(None, None, "", "", "")], [("a b", "en", "", "", "")]):
        assert found(spark.createDataFrame(rows, SCHEMA), best=5, least=2) == []


def test_first_of_meets_in_small_parts(spark):
    rows = [("en", f"p{i:04}", i % 7, 1, 1, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, score long")
    got = [tuple(r) for r in collocations.first_of(df, 20, meet=100, fan=3).select("phrase", "rank").orderBy("rank").collect()]
    want = sorted(rows, key=lambda r: (-r[5], -r[2], r[1]))[:20]
    assert got == [(r[1], i + 1) for i, r in enumerate(want)]
