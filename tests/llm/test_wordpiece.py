"""Token counts against the tokenizers library's greedy longest match."""

from hypothesis import given, settings, strategies as st
from tokenizers import models

from tests.conftest import SMALL
from wirecount.llm import wordpiece
from wirecount.llm.bpe import byte_letters
from wirecount.llm.queries import BYTE_BPE, op8_token_counts

PIECES = ["a", "ab", "abc", "abcdx", "b", "##b", "##c", "##cd", "##cdy", "##dz", "##z", "x",
          "un", "##aff", "##able", "é", "##é"]


def library_count(model, word):
    found = model.tokenize(word)
    return 0 if [t.value for t in found] == ["[UNK]"] else len(found)


def model(pieces, prefix):
    vocab = {p: i for i, p in enumerate(["[UNK]", *pieces])}
    return models.WordPiece(vocab=vocab, unk_token="[UNK]", max_input_chars_per_word=10**6,
                            continuing_subword_prefix=prefix)


@settings(max_examples=500, deadline=None)
@given(st.text("abcdxyzuné", min_size=1, max_size=12))
def test_words(word):
    automaton = wordpiece.Automaton(*wordpiece.word_pieces(PIECES))
    assert automaton.count(word) == library_count(model(PIECES, "##"), word)


def test_known_words():
    automaton = wordpiece.Automaton(*wordpiece.word_pieces(PIECES))
    assert [automaton.count(w) for w in ("abcdz", "unaffable", "abcdx", "q", "abq")] == \
        [2, 3, 1, 0, 0]
    assert wordpiece.Automaton([], []).count("a") == 0


def test_query(spark):
    library = model(wordpiece.byte_pieces(BYTE_BPE), "")
    letters = byte_letters()
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words = wordpiece.WORD.findall(r["text"] or "")
        counts = [library_count(library, "".join(letters[b] for b in (" " + w).encode()))
                  for w in words]
        want[r["doc_id"]] = (len(words), sum(c or 1 for c in counts), counts.count(0))
    got = {r["doc_id"]: tuple(r)[1:] for r in op8_token_counts(spark, SMALL).collect()}
    assert got == want


def test_rows(spark):
    df = spark.createDataFrame(
        [(1, None, 3), (2, "", 3), (3, "abc q abcd!", 3), (3, "abc q abcd!", 3), (None, "a", 1),
         (4, "ab" * 50_000, 1)], "doc_id long, text string, n_tokens long")
    first, later = wordpiece.word_pieces(PIECES)
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_tokens"], r["n_unknown"])
                 for r in wordpiece.token_counts(df, first, later).collect())
    # Only abc is known: greedy matching takes abc of abcd and cannot go on.
    assert got == [(0, 1, 1, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 4, 4, 3), (3, 4, 4, 3),
                   (4, 1, 1, 1)]
    assert wordpiece.token_counts(df.where("false"), first, later).count() == 0
