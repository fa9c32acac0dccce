"""Quality rules against counting by hand, walking single trees, and held-out labels."""

import random
import re

import numpy as np
import pytest

from tests.conftest import SMALL
from wirecount.llm import quality


def by_hand(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(again))


ODD = [None, "", " \t\r\n\x0b\x0c", "a", "   \u0085", "a b c", "\U0001d518 x \U0001f600",
       "a b c d e a b c d e", "a b c d e f g h i j", "x x x x x x x", "a b c d e\na b c d e\n\n \na",
       "a\r\na\r\nb", "#*$%&|<>" * 3, "one two three four five six seven eight nine ten",
       "w " * 20_000, "\n".join(["same line here"] * 3000)]


def test_counts():
    rng = random.Random(3)
    made = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(60)]
    made += ["".join(rng.choice("ab# \n\t ") for _ in range(200)) for _ in range(60)]
    for text in [t for t in ODD if len(t or "") < 2000] + made:
        assert quality.counts(text or "")[:5] == by_hand(text), text
    assert quality.counts("w " * 20_000)[:5] == (20_000, 20_000, 0, 0, 20_000)
    long = "\n".join(["same line here"] * 3000)
    assert quality.counts(long)[:5] == (9000, 36_000, 0, 2999, 9000)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert tuple(r)[1:6] == by_hand(texts[i])
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    good = [i for i, q in labels.select("doc_id", "quality").collect() if q == 1]
    bad = [i for i, q in labels.select("doc_id", "quality").collect() if q == 0]
    passed = [i for i in good if not got[i]["base_failed"]]
    assert sum(got[i]["kept"] for i in passed) >= 0.97 * len(passed)
    assert sum(got[i]["kept"] for i in bad) <= 0.1 * len(bad)


def test_held_out_labels(spark):
    """Trained without a quarter of the labels, judged on that quarter."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = quality.stored(quality.statistics(docs))
    model = quality.train(*quality.sample(stats, labels.where("doc_id % 4 != 2")))
    got = {r["id"]: r["kept"] for r in quality.judged(stats, model).where("NOT base_failed").collect()}
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.where("doc_id % 4 = 2").collect()
            if r["doc_id"] in got]
    assert np.mean([k for q, k in held if q == 1]) >= 0.97
    assert np.mean([k for q, k in held if q == 0]) <= 0.15


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (7, "x y"), (7, "x y")]
    docs = spark.createDataFrame([(*r, 1, 0.5, True) for r in rows],
                                 "doc_id long, text string, id int, score double, kept boolean")
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 0), (2, 0), (7, 0), (None, 1), (8, None), (13, 1)],
        "doc_id long, quality int")
    got = quality.quality(docs, labels)
    assert got.columns == ["doc_id", *quality.COUNTS, "base_failed", "kept", "score"]
    assert got.count() == len(rows)
    none = quality.quality(docs, labels.where("false")).collect()
    assert all(r["kept"] != r["base_failed"] for r in none)
    assert quality.quality(docs.where("false"), labels).count() == 0
    stats = quality.stored(quality.statistics(docs))
    x, y = quality.sample(stats, labels)
    assert sorted(y.tolist()) == [0, 0, 0, 1, 1]  # both texts of 7, its copy once; 1 counts as good
    assert len(quality.sample(stats, labels, most=1)[1]) == 2


def test_hot_identifier_leaves_the_sample_bounded(spark):
    docs = spark.createDataFrame([(1, f"{i} words of one") for i in range(300)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 200, "doc_id long, quality int")
    x, y = quality.sample(quality.stored(quality.statistics(docs)), labels, most=50)
    assert len(y) <= 50


@pytest.mark.parametrize("seed", range(3))
def test_flat_trees_and_monotonic_features(seed):
    rng = np.random.default_rng(seed)
    x = rng.random((1500, len(quality.FEATURES)))
    y = ((x[:, 2] - 0.5) ** 2 + x[:, 6] * 0.3 + rng.random(1500) * 0.2 > 0.3).astype(np.int64)
    signs = np.array(list(quality.FEATURES.values()))
    t = quality.grow(x, y, signs)
    score = t.score(x)

    def walk(row):
        total = 0.0
        for at in t.roots.tolist():
            while t.left[at] != at:
                at = t.left[at] if row[t.feature[at]] <= t.cut[at] else t.right[at]
            total += t.value[at]
        return total

    assert np.allclose(score[:200], [walk(r) for r in x[:200]])
    assert np.mean((score > 0) == y) > 0.75
    for f in np.flatnonzero(signs).tolist():
        grid = np.repeat(x[:50], 40, axis=0)
        grid[:, f] = np.tile(np.linspace(-0.1, 1.1, 40), 50)
        steps = np.diff(t.score(grid).reshape(50, 40), axis=1) * signs[f]
        assert steps.min() >= -1e-9
