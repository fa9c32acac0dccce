"""Archives written and read back in chunks."""

import base64
import gzip
import hashlib
import os

import pytest

from wirecount.llm import warc
from wirecount.llm.common import stored
from wirecount.session import scratch_dir


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def round_trip(spark, rows, least=0, size=7):
    records = warc.with_references(pages(spark, rows), least=least)
    folder = scratch_dir(spark)
    manifest = stored(warc.write(records, f"{folder}/archives", size=size))
    return manifest, warc.read(spark, manifest, size=size)


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/1", "<p>häé\r\n\r\nWARC/1.1</p>" * 5, "x"), (2, "http://a/2", "same", "x"),
    (9, "http://a/9", "same", "x"), (5, None, "same", None), (3, "u\r\nX-Page-Id: 7", None, "x"),
    (4, "u", "", "x"), (6, "u", "x" * 1000, "x"),
]


def test_round_trip(spark):
    _, chunks = round_trip(spark, ROWS)
    found = {}
    for r in sorted(chunks.collect(), key=lambda r: (r["record_id"], r["chunk"])):
        found.setdefault(r["page_id"], []).append(r)
        assert len(r["data"]) <= 7
    want = {i: html or "" for i, _, html, _ in ROWS}
    refers = {2: 9, 5: 9, 3: 4}
    assert found.keys() == want.keys()
    for i, parts in found.items():
        last = parts[-1]
        assert [p["chunk"] for p in parts] == list(range(len(parts)))
        assert [p["last"] for p in parts] == [False] * (len(parts) - 1) + [True]
        assert last["digest"] == b32(want[i])
        assert last["payload_bytes"] == len(want[i].encode())
        assert last["refers_to"] == refers.get(i)
        assert last["record_type"] == ("revisit" if i in refers else "response")
        body = b"".join(bytes(p["data"]) for p in parts)
        assert body == (b"" if i in refers else want[i].encode())


def test_small_payloads_are_all_responses(spark):
    _, chunks = round_trip(spark, ROWS, least=4)
    kinds = {r["page_id"]: r["record_type"] for r in chunks.where("last").collect()}
    assert {i for i, k in kinds.items() if k == "revisit"} == {2, 5}


def test_repeated_rows_and_null_identifiers(spark):
    rows = [(1, "u", "a", ""), (1, "u", "a", ""), (0, "u", "a", ""), (None, "u", "a", "")]
    got = sorted((r["page_id"] is not None, r["page_id"] or 0, r["record_type"],
                  r["refers_to"] or -1)
                 for r in round_trip(spark, rows)[1].where("last").collect())
    assert got == [(False, 0, "response", -1), (True, 0, "revisit", 1),
                   (True, 1, "response", -1), (True, 1, "response", -1)]


def test_empty(spark):
    manifest, chunks = round_trip(spark, [ROWS[0]][:0] or [])
    assert manifest.count() == 0 and chunks.count() == 0


def test_unreported_files_are_not_read(spark):
    manifest, _ = round_trip(spark, ROWS)
    path = manifest.first()["path"].removeprefix("file://").removeprefix("file:")
    with open(os.path.join(os.path.dirname(path), "left-behind.warc.gz"), "w") as f:
        f.write("junk")
    assert warc.read(spark, manifest).where("last").count() == len(ROWS)


def test_a_changed_payload_is_refused(spark):
    manifest, _ = round_trip(spark, [(1, "u", "hello there", "")])
    path = manifest.first()["path"].removeprefix("file://").removeprefix("file:")
    with gzip.open(path) as f:
        content = f.read()
    with gzip.open(path, "wb") as f:
        f.write(content.replace(b"hello", b"jello"))
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, manifest).collect()
