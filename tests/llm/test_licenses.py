"""Licence scan: families, unknown texts and defined cases."""

import re
import textwrap

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from wirecount.llm import licenses
from wirecount.llm.queries import op5_license_scan

PROSE = ["the river ran under the old stone house with light from above",
         "people of the small town never saw such a great thing on any day"] * 60


@pytest.fixture(scope="module")
def model():
    return licenses.train(PROSE)


def scanned(spark, model, rows):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows],
                               "doc_id long, text string, family string, line string")
    return {(r["doc_id"], r["line"]): r for r in licenses.scan(df, model).collect()}


def test_templates_and_others(spark, model):
    rows = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    got = scanned(spark, model, list(enumerate(t for _, t in rows)))
    wrong = [(f, t, got[i, 0]["family"]) for i, (f, t) in enumerate(rows)
             if got[i, 0]["family"] != f or not got[i, 0]["confirmed"]]
    assert not wrong
    got = scanned(spark, model, list(enumerate(licenses.OTHERS)))
    assert {r["family"] for r in got.values()} == {licenses.UNKNOWN}


@pytest.mark.parametrize("text, family", [
    ("### RELEASED### UNDER%%% THE$$$ MIT*** LICENSE.###", "MIT"),
    ("the town. Licensed under CC BY-NC 4.0. never saw such a great thing", "CC-BY-NC"),
    ("This work is licensed under the GNU General Public License, version 3", "GPL"),
    ("A licence to fish in the river", None), ("people of the old stone house", None)])
def test_texts(spark, model, text, family):
    got = scanned(spark, model, [(1, f"first line\n{text}")])
    assert [r["family"] for r in got.values() if r["family"] != licenses.UNKNOWN] == (
        [family] if family else [])


def test_rows(spark, model):
    mit = "Released under the MIT License."
    got = scanned(spark, model, [(1, None), (2, ""), (3, "\n\n"), (4, f"{mit}\n{mit}"),
                                 (None, mit), (5, "stone " * 100_000 + mit)])
    assert {k for k, r in got.items() if r["family"] == "MIT"} == {
        (4, 0), (4, 1), (None, 0), (5, 0)}
    df = spark.createDataFrame([(1, mit), (1, mit)], "doc_id long, text string")
    assert licenses.scan(df, model).count() == 2
    assert licenses.scan(df.where("false"), model).count() == 0
    assert licenses.train([]).families == sorted(licenses.TEMPLATES)


def test_score_equals_the_model(spark, model):
    """The joins give what the weights give by hand."""
    text = "Licensed under the Apache License, Version 2.0 by the people"
    got = scanned(spark, model, [(1, text)])[1, 0]
    z = list(model.bias)
    for g in licenses.grams_of(licenses.words_of(text)):
        for c, w in enumerate(model.weights.get(g, [])):
            z[c] += w
    shares = licenses._softmax(licenses.np.array([z]) / model.temperature)[0]
    assert got["probability"] == pytest.approx(shares[:-1].max(), abs=1e-6)


def test_planted_lines_of_the_given_table(spark):
    known = {"MIT License": "MIT", "CC BY-NC 4.0": "CC-BY-NC", "Apache License": "Apache-2.0",
             "GNU General Public License": "GPL"}
    want = set()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        for n, line in enumerate(r["text"].split("\n")):
            plain = re.sub(r"[\W_]+", " ", line).lower()
            want |= {(r["doc_id"], n, f) for k, f in known.items()
                     if re.sub(r"[\W_]+", " ", k).lower() in plain}
    got = {(r["doc_id"], r["line"], r["family"]) for r in
           op5_license_scan(spark, SMALL).where(F.col("confirmed")).collect()}
    assert got == want


def test_no_python_in_the_plan(spark, model):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = licenses.scan(df, model)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


NOTICES = [licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["BSD"][0],
           licenses.TEMPLATES["Unlicense"][1]]


@pytest.mark.parametrize("notice", NOTICES)
def test_a_frequent_notice_is_still_found(spark, notice):
    cut = notice.split()
    parts = [" ".join(cut[i:i + 10]) for i in range(0, len(cut), 10)]
    for lines in ([notice] * 60, ["# " + p for p in parts] * 30):
        frequent = licenses.train(PROSE + lines)
        got = scanned(spark, frequent, [(1, notice)])
        assert got[1, 0]["confirmed"] and got[1, 0]["probability"] > 0.9


def test_every_template_has_an_anchor():
    words = sorted({w for ts in licenses.TEMPLATES.values() for t in ts
                    for w in licenses.words_of(t)})
    anchors = set(licenses.train([f"{w} x {v}" for w in words for v in ("a", "b")] * 5).anchors)
    assert all(anchors & set(licenses.words_of(t))
               for ts in licenses.TEMPLATES.values() for t in ts)


@pytest.mark.parametrize("width, sign", [(30, "# "), (72, " * "), (76, "")])
def test_wrapped_templates(spark, model, width, sign):
    templates = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    rows = [(i, "\n".join(["people of the town", ""]
                          + [sign + x for x in textwrap.wrap(t, width)] + ["", "a river"]))
            for i, (_, t) in enumerate(templates)]
    found = [r for r in scanned(spark, model, rows).values() if r["confirmed"]]
    assert {(r["doc_id"], r["family"]) for r in found} == {
        (i, f) for i, (f, _) in enumerate(templates)}
    assert all(r["line"] == 2 for r in found if "\n" in r["paragraph"])


def plain_scan(text, model):
    """Lines and joined lines of a text with their verdicts, without a join."""
    follow = {(a, b) for ts in licenses.TEMPLATES.values() for t in ts
              for words in [licenses.words_of(t)]
              for a, b in [*zip(words, words[1:]), *zip(words, words[2:])]}

    def verdict(words):
        grams = licenses.grams_of(words)
        z = list(model.bias)
        for g in grams:
            for c, w in enumerate(model.weights.get(g, [])):
                z[c] += w
        shares = licenses._softmax(licenses.np.array([z]) / model.temperature)[0][:-1]
        family = model.families[int(shares.argmax())]
        if not any(g in model.weights for g in grams):
            return None
        if shares.max() < model.threshold:
            return licenses.UNKNOWN, float(shares.max()), 0.0, False
        like = max(len(set(grams) & held) / len(held) for t in licenses.TEMPLATES[family]
                   for held in [set(licenses.grams_of(licenses.words_of(t)))])
        return family, float(shares.max()), like, like >= licenses.CONFIRMED - 1e-12

    lines = (text or "").split("\n")
    words, anchors = [licenses.words_of(x) for x in lines], set(model.anchors)
    starts = [i for i in range(len(lines)) if i == 0 or not (
        words[i - 1] and words[i] and (words[i - 1][-1], words[i][0]) in follow)]
    out = []
    for a, z in zip(starts, [*starts[1:], len(lines)]):
        joined = [w for ws in words[a:z] for w in ws]
        if not anchors & set(joined):
            continue
        each = [(i, lines[i], verdict(words[i])) for i in range(a, z) if anchors & set(words[i])]
        each = [x for x in each if x[2]]
        whole = verdict(joined) if z - a > 1 else None
        if whole and whole[3] and whole[0] not in {v[0] for _, _, v in each if v[3]}:
            each = [x for x in each if x[2][3] or x[2][0] != whole[0]]
            each.append((a, "\n".join(lines[a:z]), whole))
        out += each
    return out


def test_scan_against_a_plain_one(spark, model):
    docs = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    wrapped = [(10_000 + i, "the town\n" + "\n".join(textwrap.wrap(t, 40)) + "\nwith light\n" + t)
               for i, t in enumerate(t for ts in licenses.TEMPLATES.values() for t in ts)]
    rows = docs + wrapped + [(20_000, None), (20_001, "MIT"), (20_001, "MIT")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["line"], r["paragraph"], r["family"], r["confirmed"])
                 for r in licenses.scan(df, model).collect())
    want = sorted((i, line, paragraph, v[0], v[3]) for i, t in rows
                  for line, paragraph, v in plain_scan(t, model))
    assert got == want and len(got) > len(wrapped)
