from datetime import datetime

from hypothesis import HealthCheck, given, settings, strategies as st

from tests.conftest import rows
from wirecount.operators import keywords as kw, registry as reg
from wirecount.operators.rollup import roll_up
from wirecount.schemas import ENTRY, REGISTRY

QUICK = settings(max_examples=8, deadline=None, database=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])
TITLE = st.one_of(st.none(), st.text(alphabet="ab É'-1 ", max_size=12))
TITLES = st.lists(TITLE, min_size=1, max_size=12)


def counted(spark, titles):
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    return dict(rows(kw.keyword_counts(df)))


@QUICK
@given(first=TITLES, second=TITLES)
def test_counts_of_a_union_are_the_sums(spark, first, second):
    a, b = counted(spark, first), counted(spark, second)
    both = {k: a.get(k, 0) + b.get(k, 0) for k in {*a, *b}}
    assert counted(spark, first + second) == both


@QUICK
@given(titles=TITLES)
def test_against_plain_python(spark, titles):
    import regex

    expected = {}
    for t in titles:
        words = regex.findall(r"\p{L}+", (t or "").lower())
        for gram in words + [" ".join(p) for p in zip(words, words[1:])]:
            expected[gram] = expected.get(gram, 0) + 1
    assert counted(spark, titles) == expected


HOURS = st.lists(st.tuples(st.integers(0, 47), st.sampled_from("abc"), st.integers(1, 9)),
                 min_size=1, max_size=30)


@QUICK
@given(data=HOURS)
def test_a_rollup_of_tops_never_exceeds_the_exact_one(spark, data):
    df = spark.createDataFrame(
        [(f"2024-01-{1 + h // 24:02d} {h % 24:02d}", k, n) for h, k, n in data],
        "hour string, keyword string, count long")
    exact = {r[:2]: r[2] for r in rows(roll_up(df, "day", k=None))}
    assert sum(exact.values()) == sum(n for _, _, n in data)
    tops = kw.top_k(df, 1, by=["hour"])
    for day, keyword, count in rows(roll_up(tops, "day")):
        assert count <= exact[day, keyword]


ENTRIES = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 59)), min_size=1, max_size=20)


@QUICK
@given(runs=st.lists(ENTRIES, min_size=2, max_size=3))
def test_marks_never_go_back_and_nothing_is_sent_twice(spark, runs):
    registry = spark.createDataFrame([(i, f"c{i}", f"u{i}", None) for i in (1, 2, 3)], REGISTRY)
    marks, sent = {1: 0, 2: 0, 3: 0}, set()
    for run in runs:
        data = [(c, "t", f"2024-01-01T00:{m:02d}:00Z") for c, m in run]
        fresh = reg.new_entries(reg.read_entries(spark.createDataFrame(data, ENTRY)), registry)
        now = {(r["channel_id"], r["published_ms"]) for r in fresh.collect()}
        assert not now & sent
        sent |= now
        after = reg.advance_marks(registry, fresh).collect()
        for r in after:
            assert (r["last_updated"] or 0) >= marks[r["id"]]
            marks[r["id"]] = r["last_updated"] or 0
        registry = spark.createDataFrame([tuple(r[c] for c in REGISTRY.fieldNames())
                                          for r in after], REGISTRY)
    base = int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds() * 1000)
    for c in marks:
        taken = [base + m * 60000 for run in runs for k, m in run if k == c]
        assert marks[c] == max(taken, default=0)
