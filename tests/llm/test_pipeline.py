"""The pipeline: stages, columns, planted cases and defined ones."""

import hashlib

import numpy as np

import corpus_pipeline as cp
from tests.conftest import SMALL
from tests.llm.test_jaccard import by_hand
from wirecount.llm import contamination
from wirecount.session import scratch_dir


def stages(spark, docs, sf_dir, last=len(cp.STAGES)):
    out = [docs]
    for _, stage in cp.STAGES[:last]:
        out.append(cp.stored(stage(spark, out[-1], sf_dir)))
    return out


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination", "secret scans",
        "BPE encoding and decoding"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = stages(spark, docs, SMALL)
    assert all(sorted(f.columns) == sorted(docs.columns) for f in found[:-1])
    start, spoken, single, clean, masked, coded = (
        {r["doc_id"]: r.asDict() for r in f.collect()} for f in found)
    assert len(spoken) >= 0.99 * len(start)
    texts = [(i, r["text"]) for i, r in spoken.items()]
    assert set(single) == {i for i, _, _, group in by_hand(texts) if i == group}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    index = contamination.Index(list(enumerate(items)))
    assert set(clean) == {i for i, r in single.items() if not list(index.matches(r["text"], 0.5))}
    assert set(masked) == set(clean) == set(coded)
    changed = [i for i in clean if masked[i]["text"] != clean[i]["text"]]
    assert all("[secret]" in masked[i]["text"] for i in changed)
    assert all(r["n_chars"] == len(r["text"]) for r in masked.values())
    assert all(len(np.frombuffer(r["ids"], "<u4")) == r["n_tokens"] for r in coded.values())
    whole = {r["doc_id"]: r["ids_sha256"] for r in cp.run(spark, SMALL).collect()}
    assert whole == {i: r["ids_sha256"] for i, r in coded.items()}


def test_nulls_repeats_and_clashing_names(spark):
    words = "and the water of the house with the people in the old town at the river of light"
    rows = [(1, words, "en"), (1, words, "en"), (2, words, "en"), (None, words + " x", "en"),
            (None, words + " x", "en"), (3, None, "en"), (4, "", None), (5, "a", "en")]
    folder = scratch_dir(spark)
    df = spark.createDataFrame(
        [(i, t, lang, None, len(t or ""), "e", 1, "g") for i, t, lang in rows],
        "doc_id long, text string, lang string, source string, n_chars long, row string, "
        "gone int, doc string")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    found = stages(spark, df, folder)
    assert all(f.columns == df.columns for f in found[:-1])
    # Both rows without identifier are near copies of 1.
    assert sorted(r["doc_id"] or 0 for r in found[-2].collect()) == [1, 5]
    empty = stages(spark, df.where("false"), folder)
    assert empty[-1].count() == 0


def test_rows_of_one_identifier_are_dropped_one_by_one(spark):
    copied = "and the water of the house with the people in the old town at the river of light"
    alone = "a green stone under small paper never great for every other thing that time saw"
    other = "we went up the hill once more before dawn because nobody had told us not to go"
    item = "which of these seven planets has the longest day and the shortest year of all"
    rows = [(1, copied), (2, copied + " x"), (2, alone), (3, other), (3, "so " + item),
            (None, item + " x"), (4, item), (5, alone[::-1]), (5, other[::-1]),
            (None, "without " + copied[::-1]), (None, "with " + copied[::-1])]
    df = spark.createDataFrame([(i, t, "en", None, len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, "
                               "n_chars long")
    folder = scratch_dir(spark)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")

    def left(stage, docs):
        return {(r["doc_id"], r["text"]) for r in stage(spark, docs, folder).collect()}

    single = left(cp.join_near_duplicates, df)
    nameless = {r for r in single if r[0] is None and copied[::-1] in r[1]}
    assert len(nameless) == 1  # of two near copies without identifier one stays
    assert single - nameless == set(rows[:-2]) - {
        (2, copied + " x"), (4, item), (None, item + " x")}
    assert left(cp.join_near_duplicates, df.orderBy("text").repartition(3)) == single
    assert left(cp.decontaminate, df) == {r for r in rows if item not in r[1]}


def test_the_last_stage_decodes(spark):
    text = "the water \u00e9 of the house"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = cp.encode(spark, df, "").first()
    assert got["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
