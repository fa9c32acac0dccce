"""Tops that count only the n-grams that can be among them."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from wirecount.operators import keywords as kw
from workload import inputs


@pytest.fixture(scope="module")
def titles(spark):
    # Groups of few and of many titles, one without a name, one whose words are equally rare.
    heads = inputs.headlines(spark, SMALL).select(
        F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 * F.col("doc_id") % 7).alias("g"),
        "title")
    odd = spark.createDataFrame(
        [(9, "a b"), (9, "c c c c"), (9, None), (9, ""), (10, "x"), (11, " ".join("lmnopqrstuvwz"))],
        "g long, title string")
    return heads.unionByName(odd)


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("sizes", [(1, 2), (2, 1, 3), (2,), (1,)])
@pytest.mark.parametrize("k, max_bytes", [(1, 64 << 20), (20, 64 << 20), (20, 0)])
def test_the_top_of_all_counts(titles, by, sizes, k, max_bytes):
    whole = kw.top_k(kw.keyword_counts(titles, by=by, sizes=sizes), k, by)
    got = kw.top_keywords(titles, k, by, sizes=sizes, max_bytes=max_bytes)

    def told(df):
        return sorted(map(str, rows(df.select(*by, "keyword", "count")))) if not by else sorted(
            str(tuple(r)) for r in df.select(*by, "keyword", "count").collect())

    assert told(got) == told(whole)


def test_other_options_hold(titles):
    options = dict(by=["g"], stop_words=inputs.STOP_WORDS, dedupe_titles=True)
    whole = kw.top_k(kw.keyword_counts(titles, **options), 5, ["g"])
    got = kw.top_keywords(titles, 5, **options)
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(
        map(str, whole.collect()))


@pytest.mark.parametrize("group_bytes", [-1, 0, 10, 20_000, 64 << 20])
def test_groups_of_any_size_hold_their_words(titles, group_bytes):
    """All groups in a task each, all counted by all tasks, and some of either kind; the group
    without a name among the large ones too."""
    measured = titles.groupBy("g").agg(F.sum(F.octet_length("title")).alias("n"))
    large = {r["g"] for r in measured.collect() if (r["n"] or 0) > group_bytes}
    assert (None in large) == (group_bytes <= 20_000)
    whole = kw.top_k(kw.keyword_counts(titles, by=["g"]), 5, ["g"])
    got = kw.top_keywords(titles, 5, ["g"], group_bytes=group_bytes)
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(
        map(str, whole.collect()))


def test_words_of_a_group_are_counted_where_its_titles_are(spark, titles, monkeypatch):
    """Titles are dealt by group; their words are counted and ranked without another shuffle."""
    from pyspark.sql.classic.dataframe import DataFrame

    from tests.conftest import plan

    shown = []
    kept = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda df: shown.append(plan(df)) or kept(df))
    kw.top_keywords(titles, 5, ["g"])
    words = [p for p in shown if "_rank" in p]
    assert len(words) == 1
    assert words[0].count("Exchange") == 1
    assert words[0].index("Generate") < words[0].index("Exchange")


def test_few_pairs_are_shuffled(spark):
    """Pairs that meet their counts: those of two frequent words, not all of them."""
    heads = inputs.headlines(spark, SMALL)
    every = kw.keyword_counts(heads, sizes=(2,)).count()
    top = kw.top_keywords(heads)
    assert top.count() == 20
    words = kw.keyword_counts(heads, sizes=(1,)).orderBy(F.desc("count")).limit(20)
    few = kw.keyword_counts(heads, sizes=(2,), among=words.select(
        F.col("keyword").alias("_word"))).count()
    assert 0 < few <= 400 < every


def test_summaries_are_made_once(spark):
    """What merges summaries reads them as stored: titles are not tokenized for every use."""
    from tests.conftest import plan
    from workload.queries import QUERIES

    shown = plan(QUERIES["daily_from_summaries"](spark, SMALL))
    assert shown.count("/rows") > 1 and shown.count("regexp_extract_all") == 1
