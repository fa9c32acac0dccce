"""Greedy string tiling against a plain version, reordered and clean texts."""

import random
import time

import numpy as np

from tests.conftest import SMALL
from wirecount.llm import contamination
from wirecount.llm.queries import op4_benchmark_decontamination

ITEM = " ".join(f"word{i}" for i in range(30))


def plain_tiles(doc, item, least):
    """The longest common run of unmarked tokens, again and again."""
    marked_d, marked_i, out = [x == 0 for x in doc], [x == 0 for x in item], []
    while True:
        best = None
        for d in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while (d + n < len(doc) and p + n < len(item) and doc[d + n] == item[p + n]
                       and not marked_d[d + n] and not marked_i[p + n]):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (d, p, n)
        if best is None:
            return out
        d, p, n = best
        marked_d[d:d + n] = marked_i[p:p + n] = [True] * n
        out.append(best)


def test_tiling_equals_the_plain_version():
    rng = random.Random(1)
    for _ in range(150):
        doc = np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 60))])
        item = np.array([rng.randint(1, 4) for _ in range(rng.randint(1, 25))])
        got = contamination.tile(doc, item, 3)
        want = plain_tiles(doc.tolist(), item.tolist(), 3)
        # Ties may be broken in another order; the longest tile is the same.
        assert max((n for *_, n in got), default=0) == max((n for *_, n in want), default=0)
        used_d, used_i = [], []
        for d, p, n in got:
            assert (doc[d:d + n] == item[p:p + n]).all() and n >= 3
            used_d += range(d, d + n)
            used_i += range(p, p + n)
        assert len(set(used_d)) == len(used_d) and len(set(used_i)) == len(used_i)
        # Nothing of the least length is left.
        left_d, left_i = doc.copy(), item.copy()
        left_d[used_d], left_i[used_i] = 0, -1
        assert not plain_tiles(left_d.tolist(), [max(x, 0) for x in left_i.tolist()], 3)


def found(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 1.0, 5) for i, t in docs],
                              "doc_id long, text string, coverage double, item long")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r
            for r in contamination.contaminated(d, b, **more).collect()}


def test_reordered_cut_and_clean(spark):
    words = ITEM.split()
    reordered = words[20:] + ["x"] + words[10:20] + ["y", "z"] + words[:10]
    docs = [(1, "before " + ITEM + " after"), (2, " ".join(reordered)),
            (3, " ".join(words[:10])), (4, "nothing of it " * 50),
            (5, " ".join(w for pair in zip(words, ["x"] * 30) for w in pair)),
            (6, ITEM.upper().replace(" ", ", ")), (None, ITEM)]
    got = found(spark, docs, [(7, ITEM), (8, "quite another text of several words")])
    assert set(got) == {(1, 7), (2, 7), (6, 7), (None, 7)}
    assert got[2, 7]["tiles"] == 3 and got[2, 7]["coverage"] == 1.0
    assert got[1, 7]["longest"] == 30


def test_short_empty_null_and_repeated(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (4, "x a b y"), (4, "x a b y"), (5, "b a")]
    items = [(1, "a b"), (2, None), (3, ""), (4, "?!")]
    assert set(found(spark, docs, items)) == {(3, 1), (4, 1)}
    rows = contamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items + [(1, "a b")], "item_id long, text string"))
    assert rows.count() == 6
    assert found(spark, [], items) == {} and found(spark, docs, []) == {}


def test_blocks_change_nothing(spark):
    docs = [(i, f"start {i} " + " ".join(f"t{i}x{k}" for k in range(40))) for i in range(20)]
    items = [(100 + i, " ".join(f"t{i}x{k}" for k in range(5, 30))) for i in range(20)]
    assert found(spark, docs, items, block_bytes=700).keys() == found(spark, docs, items).keys()
    assert len(found(spark, docs, items)) == 20


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    number = {}

    def tokens(text):
        return np.array([number.setdefault(w, len(number) + 1)
                         for w in contamination.WORD.findall((text or "").lower())], np.int64)

    items = [(i, tokens(t)) for i, t in items]
    want = set()
    for d, t in docs:
        doc = tokens(t)
        for i, item in items:
            if len(item) and sum(n for *_, n in contamination.tile(
                    doc, item, min(5, len(item)))) / len(item) >= 0.5:
                want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in
           op4_benchmark_decontamination(spark, SMALL).collect()}
    assert got == want and want


def test_seeds_as_a_table_find_what_blocks_find(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    odd = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (None, "x a b y"), (3, "?!")],
                                "item_id long, text string")
    more = spark.createDataFrame([(-1, "so a b it is"), (-1, "so a b it is"), (-2, None), (-3, ""),
                                  (None, "x a b y")], "doc_id long, text string")
    docs, items = (x.select(*y.columns).unionByName(y) for x, y in ((docs, more), (items, odd)))
    one = sorted((tuple(r) for r in contamination.contaminated(docs, items).collect()), key=str)
    two = sorted((tuple(r) for r in contamination.contaminated(
        docs, items, block_bytes=0).collect()), key=str)
    assert one == two and sum(r[0] == -1 for r in one) == 4
    assert contamination.contaminated(docs.where("false"), items, block_bytes=0).count() == 0


def test_a_filter_of_few_bits_lets_all_seeds_through(spark, monkeypatch):
    monkeypatch.setattr(contamination, "FILTER_BITS", 1 << 6)
    docs = [(i, f"start {i} " + " ".join(f"t{i}x{k}" for k in range(40))) for i in range(20)]
    items = [(100 + i, " ".join(f"t{i}x{k}" for k in range(5, 30))) for i in range(20)]
    assert len(found(spark, docs, items, block_bytes=0)) == 20


def test_repetitive_texts_take_seconds():
    start = time.time()
    doc, item = np.array([1, 2] * 10_000), np.array([1, 2] * 10_000)
    assert contamination.tile(doc, item, 5) == [(0, 0, 20_000)]
    item = np.array([1, 2] * 2000 + [3] + [2, 1] * 2000)
    got = contamination.tile(doc, item, 5)
    assert sum(n for *_, n in got) >= 7990
    assert contamination.tile(np.ones(20_000, int), np.ones(300, int), 5) == [(0, 0, 300)]
    assert time.time() - start < 60


def test_a_very_long_text(spark):
    words = " ".join(f"w{i % 5000}" for i in range(120_000))
    got = found(spark, [(1, words + " " + ITEM), (2, words)], [(7, ITEM)], block_bytes=0)
    assert set(got) == {(1, 7)}
