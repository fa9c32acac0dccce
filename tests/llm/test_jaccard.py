"""The n-gram join against all pairs compared by hand."""

import re
from itertools import combinations

import duckdb
import numpy as np
import pytest

from tests.conftest import SMALL
from wirecount.llm import jaccard
from wirecount.llm.components import components
from wirecount.llm.oracle import SQL

SCHEMA = "doc_id long, text string, size long, sig string, id string"


def sets_of(texts):
    out = {}
    for i, text in texts:
        words = re.findall(r"\w+", (text or "").lower())
        if len(words) < 5:
            out[i] = frozenset([" ".join(words)] if words else [("no words", text or "")])
        else:
            out[i] = frozenset(" ".join(words[k:k + 5]) for k in range(len(words) - 4))
    return out


def by_hand(texts, threshold=0.8):
    sets = sets_of(texts)
    links, group = dict.fromkeys(sets, 0), {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and common / len(sets[a] | sets[b]) >= threshold - 1e-12:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            group[y] = x
    return {(i, min(k for k in sets if sets[k] == sets[i]), links[i], find(i)) for i in sets}


def joined(spark, texts, **more):
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in texts], SCHEMA)
    return {tuple(r) for r in jaccard.near_duplicates(df, **more).collect()}


def copies(n, seed=0, length=60):
    """Near copies of one text: each changes its own words at either end."""
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(10_000)}" for _ in range(length)]
    out = []
    for i in range(n):
        words = list(base)
        for k in rng.integers(0, length, int(rng.integers(0, 4))):
            words[k] = f"own{i}x{k}"
        out.append((i, " ".join(words)))
    return out


def test_given_documents(spark):
    docs = [(r["doc_id"], r["text"])
            for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert joined(spark, docs) == by_hand(docs)


def test_a_group_of_near_copies_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    docs = copies(90) + [(i + 1000, t) for i, t in copies(40, seed=1, length=300)]
    docs += [(2000 + i, docs[3][1]) for i in range(30)]
    assert joined(spark, docs) == by_hand(docs)


def test_blocks_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 400)
    docs = copies(60)
    assert joined(spark, docs) == by_hand(docs)


def test_short_empty_null_and_repeated(spark):
    docs = [(1, None), (2, ""), (3, "!!"), (4, "a b"), (5, "A, b"), (6, "a b c"), (7, "..."),
            (8, "one two three four five"), (9, "one two three four five six")]
    assert joined(spark, docs) == by_hand(docs)
    again = joined(spark, [(4, "a b"), (4, "a b"), (None, "a b")])
    assert again == {(4, 4, 1, 4)}


def test_rows_that_share_an_identifier(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (3, b + " y"), (4, "alone here"),
            (4, "alone there"), (4, "alone there")]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)
    got = sorted(tuple(r) for r in jaccard.near_duplicates(df).collect())
    # 1 stands for two classes, so it names neither group; 4 has no other name.
    assert got == [(1, 1, 1, 2), (1, 1, 2, 3), (2, 2, 1, 2), (3, 3, 2, 3), (3, 3, 2, 3),
                   (4, 4, 0, 4), (4, 4, 1, 4), (4, 4, 1, 4)]
    con = duckdb.connect()
    documents = df.select("doc_id", "text").toPandas()
    assert sorted(con.execute(SQL["op2_ngram_jaccard_join"]).fetchall()) == got, documents


def test_a_very_long_text(spark):
    words = " ".join(f"w{i}" for i in range(60_000))
    docs = [(1, words), (2, words + " tail of it"), (3, "other")]
    assert joined(spark, docs) == by_hand(docs)


def test_empty(spark):
    assert joined(spark, []) == set()


def test_posterior():
    # Against the integral of the density.
    x = np.linspace(0, 1, 200_001)
    density = x ** 12 * (1 - x) ** 4
    want = density[x >= 0.8].sum() / density.sum()
    assert jaccard.posterior(12, 16) == pytest.approx(want, abs=1e-4)
    needed = jaccard.least_matches()
    assert needed == sorted(needed) and needed[-1] < 0.8 * jaccard.HASHES


def test_components(spark):
    # A chain, a hub and a loop.
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 200)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 200), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_connects_what_the_pairs_connect():
    a, b = jaccard._forest(np.array([5, 3, 2, 8]), np.array([3, 2, 7, 9]), 10)
    assert set(zip(a.tolist(), b.tolist())) == {(2, 3), (2, 5), (2, 7), (8, 9)}
