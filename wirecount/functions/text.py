"""Headline text as token and n-gram arrays, built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# What a token is.
LETTERS = r"\p{L}+"             # "letters": every run of letters is a token
NOT_KEPT = r"[^\p{L}+\s]"       # "clean": signs are deleted (a plus sign stays) ...
WORD = r"\S+"                   # ... and what white space separates is a token

MODES = ("letters", "clean")


def tokens(text: Column, mode: str = "letters") -> Column:
    """Lower-cased tokens of ``text``, in order.

    ``letters`` turns ``don't`` into ``don``, ``t``; ``clean`` turns it into ``dont``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    lowered = F.lower(text)
    if mode == "letters":
        return F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))
    return F.regexp_extract_all(F.regexp_replace(lowered, NOT_KEPT, ""), F.lit(WORD), F.lit(0))


def without(words: Column, listed: Sequence[str]) -> Column:
    """``words`` less the listed ones. Tokens are lower case, so the list is lowered too."""
    lowered = sorted({w.lower() for w in listed})
    if not lowered:
        return words
    return F.filter(words, lambda w: ~w.isin(lowered))


def following(words: Column, k: int) -> Column:
    """The words from the ``k``-th on, so position i holds the word k-1 places later."""
    return F.slice(words, k, F.size(words))


def padded_ngrams(words: Column, n: int) -> Column:
    """One n-gram per start position; the last n-1 positions hold null."""
    grams = words
    for k in range(2, n + 1):
        grams = F.zip_with(grams, following(words, k), lambda g, w: F.concat(g, F.lit(" "), w))
    return grams


def ngrams(words: Column, n: int = 2) -> Column:
    """All runs of ``n`` neighbouring words, joined by a space."""
    return F.array_compact(padded_ngrams(words, n))
