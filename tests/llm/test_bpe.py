"""Encoding and decoding against the tokenizers library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.conftest import SMALL
from wirecount.llm import bpe
from wirecount.llm.queries import BYTE_BPE, op9_byte_bpe

STRANGE = [
    "", " ", "   \n\n ", "a" * 5000, "ab" * 3000, "aaaaaaa bbbb aabbaabb", "it's we'll I'M don''t",
    "<|endoftext|>a<|endoftext|>  b", "<|endoftext|", "\x1c\x1d x y　z", "½²Ⅷ 12² a½b",
    "一二三 漢字かな", "é é", "\U0001f600\U0001f468‍\U0001f469", "\u0085a b",
    "tab\tnew\r\nline  end ", "x" * 20_000 + " " + "é" * 20_000, "_a_b__ $%&/()",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.file_content(BYTE_BPE))


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def wanted(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_strange_texts(library, own):
    packed = own.encode(STRANGE)
    assert [ids(p) for p in packed] == [wanted(library, t) for t in STRANGE]
    assert [own.decode(p) for p in packed] == STRANGE


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_texts(library, own, texts):
    assert [ids(p) for p in own.encode(texts)] == [wanted(library, t) for t in texts]


def test_many_positions_of_one_rank(library, own, monkeypatch):
    texts = [" ".join(f"theatre{i}other" for i in range(500)), "aaa aaaa aaaaa " * 50]
    for at_once in (1, 10_000):
        monkeypatch.setattr(bpe, "AT_ONCE", at_once)
        own.known.clear()
        assert [ids(p) for p in own.encode(texts)] == [wanted(library, t) for t in texts]


def test_memory_and_index_bounds(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "INDEXED", 7)
    for text in ("one two three four", "a much longer text about other things", "one"):
        assert ids(own.encode([text])[0]) == wanted(library, text)


def test_rows(spark, library):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "a b", "x"), (3, "a b", "x"), (None, "c", None)],
        "doc_id long, text string, ids string").withColumnRenamed("ids", "decoded")
    got = {(r["doc_id"], r["decoded"], tuple(ids(r["ids"])))
           for r in bpe.encode_decode(df, BYTE_BPE).collect()}
    assert got == {(1, "", ()), (2, "", ()), (3, "a b", tuple(wanted(library, "a b"))),
                   (None, "c", tuple(wanted(library, "c")))}
    assert bpe.encode_decode(df, BYTE_BPE).count() == 5
    assert bpe.encode(df.where("false"), BYTE_BPE).count() == 0
    back = bpe.decode(bpe.encode(df, BYTE_BPE), BYTE_BPE)
    assert sorted(r["decoded"] for r in back.collect()) == ["", "", "a b", "a b", "c"]


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] or ""
             for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op9_byte_bpe(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        want = wanted(library, texts[r["doc_id"]])
        decoded = library.decode(want, skip_special_tokens=False)
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
