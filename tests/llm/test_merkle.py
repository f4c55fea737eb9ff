"""Merkle manifest against plain loops: proofs, folded roots, odd rows."""

import hashlib
import random
import zlib

import pytest

from spotspark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, pos string, gid string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, n_chars):
    return sha("".join(encoded(v) for v in (r[0], r[1], r[2], n_chars, r[4])))


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def plain(rows, fanout=2):
    """doc_id, leaf, subroot, root, proof, folded root, verified of every row, by loops over lists."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    trees = []
    for name in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[3])))
        trees.append((own, levels([leaf(r, r[3]) for r in own], fanout)))
    top = levels([t[1][-1][0] for t in trees], fanout)
    root, out = top[-1][0], []
    for g, (own, tree) in enumerate(trees):
        for k, r in enumerate(own):
            tampered = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h, proof = leaf(r, r[3] + 1) if tampered else leaf(r, r[3]), ""
            for every, at in ((tree, k), (top, g)):
                for level in every[:-1]:
                    run = level[at // fanout * fanout : at // fanout * fanout + fanout]
                    left, right = "".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])
                    proof += left + right
                    h = sha(left + h + right)
                    at //= fanout
            out.append((r[0], leaf(r, r[3]), tree[-1][0], root, sha(proof), h, h == root))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    made = [
        (None if i % 37 == 0 else i % 150, rng.choice([None, "s1", "ü"]), rng.choice([None, "en", "en", "en", "de", "Fr"]), None if i % 5 == 0 else i, rng.choice([None, "", "hello ü", "x" * 100_000]))
        for i in range(300)
    ]
    return [(*r, "clash", "clash", "clash") for r in [*made, (900, "a", "zz", 3, "t"), made[7], made[7]]]


@pytest.mark.parametrize("fanout", [2, 3])
def test_merkle_equals_plain_loops(spark, rows, fanout):
    got = merkle.verify(spark.createDataFrame(rows, SCHEMA).repartition(5), fanout)
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == plain(rows, fanout)
    assert {r[-1] for r in found} == {True, False}


def test_merkle_of_one_row_and_of_none(spark, rows):
    df = spark.createDataFrame([rows[300]], SCHEMA)
    assert [tuple(r) for r in merkle.verify(df).collect()] == plain([rows[300]])
    assert merkle.verify(df.limit(0)).collect() == []


def test_merkle_does_not_depend_on_partitions(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    every = [sorted(map(tuple, merkle.verify(df.repartition(n)).collect()), key=str) for n in (1, 9)]
    assert every[0] == every[1]


def test_manifest_groups(spark, rows):
    _, groups = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    found = groups.orderBy("gid").collect()
    assert [r["lang"] for r in found] == [None, "Fr", "de", "en", "zz"]
    assert sum(r["n"] for r in found) == len(rows)
