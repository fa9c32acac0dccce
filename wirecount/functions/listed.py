"""Long word lists, or what is known of them, as one literal that rows look into where they stand."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from zlib import crc32

from pyspark.sql import Column, DataFrame, functions as F

#: Signs no token has: before an entry, between a word and its value, between buckets.
ENTRY, VALUE, BUCKET = "\x01", "\x02", "\x03"


class Listed:
    """Words, or words with values, hashed into buckets of about two.

    The buckets are one constant string that the optimizer splits once, before the query runs;
    a row's token looks into its own bucket, so a list of a million words costs a token no more
    than one of ten. The comparison is exact.
    """

    def __init__(self, entries: Iterable[str] | Mapping[str, str]):
        pairs = entries.items() if isinstance(entries, Mapping) else ((w, "") for w in entries)
        good = [(w, v) for w, v in pairs if not _signs(w)]
        if any(_signs(v) for _, v in good):
            raise ValueError("values hold control characters")
        self.size = max(1, len(good) // 2)
        buckets = [[] for _ in range(self.size)]
        for word, value in good:
            buckets[crc32(word.encode()) % self.size].append(f"{ENTRY}{word}{VALUE}{value}")
        self.table = F.split(F.lit(BUCKET.join(map("".join, buckets))), BUCKET)

    def _bucket(self, token: Column) -> Column:
        return F.get(self.table, (F.crc32(token) % self.size).cast("int"))

    def has(self, token: Column) -> Column:
        return self._bucket(token).contains(F.concat(F.lit(ENTRY), token, F.lit(VALUE)))

    def value(self, token: Column) -> Column:
        """The value of a listed token; another token stays as it is."""
        entry = F.concat(F.lit(ENTRY), token, F.lit(VALUE))
        after = F.call_function("substring_index", self._bucket(token), entry, F.lit(-1))
        found = F.substring_index(after, ENTRY, 1)
        return F.when(self.has(token), found).otherwise(token)


class Sieve:
    """Which words may be in a table, looked up where rows stand; its size is bounded.

    A bit per hash of a word, in one constant array of longs, a long for each word but no more than
    ``NUMBERS``. A word of the table is always let through, another one seldom as long as the array
    has more bits than the table words. So a table too long for a literal can still spare its
    join the rows it says nothing about.
    """

    NUMBERS = 1 << 17

    def __init__(self, words: DataFrame):
        self.size = max(1, min(self.NUMBERS, words.count()))
        number, bit = self._place(F.col(words.columns[0]))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        found = words.groupBy(number.alias("number")).agg(F.bit_or(one).alias("bits")).collect()
        held = [0] * self.size
        for r in found:
            held[r["number"]] = r["bits"]
        self.table = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")

    def _place(self, word: Column) -> tuple[Column, Column]:
        """A number of the array and a bit in it, from two hashes, so that a row makes each once."""
        return (F.pmod(F.xxhash64(word), F.lit(self.size)).cast("int"),
                F.pmod(F.hash(word), F.lit(64)))

    def lets(self, word: Column) -> Column:
        number, bit = self._place(word)
        return F.getbit(F.get(self.table, number), bit) == 1


def _signs(text: str) -> bool:
    return any(c in text for c in (ENTRY, VALUE, BUCKET))
