"""Fingerprints against the same method in plain Python, and against true similarities."""

import hashlib
import re

from pyspark.sql import functions as F

from tests.conftest import SMALL
from wirecount.llm import prints
from wirecount.llm.queries import op7_document_fingerprints

SCHEMA = "doc_id long, text string, bins string, words_ string"


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def true_likeness(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_bins_by_hand(spark):
    """Least hash per bin and the first filled bin of each empty one's order."""
    texts = ["one", "a b c d e f g h", " ".join(f"w{i}" for i in range(40)),
             " ".join(f"x{i % 300}y{i}" for i in range(1500))]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["bins"] for r in prints.fingerprints(df).collect()}

    def hashes(rows, *columns):
        frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                      "i int, " + ", ".join(columns))
        names = [c.split()[0] for c in columns]
        return [r[0] for r in frame.orderBy("i").select(F.xxhash64(*names)).collect()]

    asked = [h % prints.BINS for h in hashes(
        [(k,) for k in range(prints.BINS * prints.PROBES)], "k int")]
    for i, text in enumerate(texts):
        words = text.split()
        if len(words) < 5:
            found = hashes([(" ".join(words),)], "w string")
        else:
            found = hashes([tuple(words[k:k + 5]) for k in range(len(words) - 4)],
                           *(f"w{k} string" for k in range(5)))
        least = {}
        for h in found:
            least[h >> prints.TOP] = min(h, least.get(h >> prints.TOP, h))
        half = prints.BINS // 2
        bins = [least[b - half] & 255 if b - half in least else None for b in range(prints.BINS)]
        want = list(bins)
        for j in [j for j in range(prints.BINS) if bins[j] is None]:
            tried = [bins[a] for a in asked[j * prints.PROBES:(j + 1) * prints.PROBES]
                     if bins[a] is not None]
            if tried:
                want[j] = tried[0]
                continue
            order = hashes([(j, b) for b in least], "j int", "b long")
            best = min(zip(order, least), key=lambda o: (o[0] & ~255 | least[o[1]] & 255))
            want[j] = least[best[1]] & 255
        assert got[i] == want


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs = sorted((r["doc_id"], r["text"] or "") for r in docs)
    got = {r["doc_id"]: r for r in op7_document_fingerprints(spark, SMALL).collect()}
    assert got.keys() == {i for i, _ in docs}
    errors, by_text = [], {}
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        errors.append(abs(r["near_edited"] - true_likeness(text, edited)))
        errors.append(abs(r["near_next"] - true_likeness(text, after)))
    assert sum(errors) / len(errors) < 0.04 and max(errors) < 0.25


def test_rows(spark):
    df = spark.createDataFrame(
        [(1, None, "", ""), (2, "", "", ""), (3, "?!", "", ""), (4, "One", "", ""),
         (4, "one", "", ""), (None, "a b c d e", "", ""), (5, "w " * 100_000, "", "")], SCHEMA)
    got = prints.fingerprints(df).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by[1] == by[2] == by[3] == {""}
    assert len(by[4]) == 1 and len(by[4].pop()) == 2 * prints.BINS
    assert len(got) == 7 and len(by[None].pop()) == 256
    assert prints.fingerprints(df.where("false")).count() == 0


def test_likeness(spark):
    one, other = list(range(128)), [*range(64), *[300] * 64]
    df = spark.createDataFrame([(one, one), (one, other), ([], []), ([], one)],
                               "a array<int>, b array<int>")
    got = [r[0] for r in df.select(prints.likeness("a", "b")).collect()]
    assert got == [1.0, (0.5 - 1 / 256) / (1 - 1 / 256), 1.0, 0.0]


def test_next_row(spark):
    def after(rows):
        df = spark.createDataFrame(rows, "k long, t string")
        return sorted((r["k"] is not None, r["k"] or 0, r["t"], r["next"]["t"]) for r in
                      prints.with_next(df, "k", "t", ["t"]).collect())

    rows = [(i * 7 % 100, f"t{i * 7 % 100}") for i in range(100)]
    assert after(rows) == [(True, k, f"t{k}", f"t{(k + 1) % 100}") for k in range(100)]
    assert after([(3, "a")]) == [(True, 3, "a", "a")]
    assert after([(3, "a"), (3, "b"), (None, "n"), (9, "z")]) == [
        (False, 0, "n", "a"), (True, 3, "a", "b"), (True, 3, "b", "z"), (True, 9, "z", "n")]
    assert after([]) == []


def test_next_row_of_a_hot_key(spark):
    """Rows without key, and of one key, lie in several ranges; every row is followed once."""
    rows = [(None, f"n{i:04d}") for i in range(300)]
    rows += [(5, "the same head of more than 32 signs " + str(i)) for i in range(300)]
    rows += [(i, f"t{i}") for i in range(6, 56)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    least, cuts = prints._cuts(df.select(prints._order("k", "t").alias("at")), 8)
    assert least is not None and len(cuts) == 7
    after = {(r["k"], r["t"]): (r["next"]["k"], r["next"]["t"]) for r in
             prints.with_next(df, "k", "t", ["k", "t"]).collect()}
    assert len(after) == len(rows)
    walked, at = [], (None, "n0000")
    while at not in walked[:1]:
        walked.append(at)
        at = after[at]
    assert len(walked) == len(rows) and set(walked) == set(rows)
    assert walked[:300] == rows[:300] and walked[600:] == rows[600:]


def test_no_python_in_the_plan(spark):
    plan = op7_document_fingerprints(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
