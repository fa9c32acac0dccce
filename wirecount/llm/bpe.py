"""Byte-level BPE encoding and decoding with a pair occurrence index.

Of a partition, the distinct pre-tokens that each Arrow batch of texts adds to those already known
are laid out as one row of symbols. An index maps every adjacent pair that has a rank to all its positions. Ranks present in the index wait in a heap;
the lowest one is applied at all its positions from left to right, and each merge updates the
neighbours' entries. Applying ranks in ascending order over all pre-tokens at once gives what
encoding each of them alone gives, as a merge never reaches over a pre-token's end.

Defined results: a null text is an empty text and has no ids; special tokens written in a text
are one id each; equal rows are encoded alike and all returned; other columns are ignored,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wirecount.llm.common import Memory, map_batches, text_of

#: Bytes of pre-tokens and their ids that a worker remembers before it starts anew.
REMEMBERED = 128 << 20
#: Symbols indexed at a time; a single longer pre-token is indexed alone.
INDEXED = 2_000_000
#: From so many positions on a rank is applied to all of them in one array operation.
AT_ONCE = 40
SHIFT = 20


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def split_patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """The byte-level split into words, numbers, signs and white space, for ``re``.

    ``re`` has no Unicode properties. Its own classes mean the same but for a few characters,
    such as fractions and Roman numerals; the first pattern finds these. The second is the
    split by ``re``'s classes, the third the one by classes written out as ranges, which is
    slower and used for texts that hold such a character.
    """
    def ranges(wanted) -> str:
        parts, start = [], None
        for code in range(sys.maxunicode + 2):
            inside = code <= sys.maxunicode and wanted(chr(code))
            if inside and start is None:
                start = code
            elif not inside and start is not None:
                parts.append(f"\\U{start:08x}-\\U{code - 1:08x}")
                start = None
        return "".join(parts)

    def kind(c):
        return unicodedata.category(c)[0]

    def space(c):
        return c.isspace() and not "\x1c" <= c <= "\x1f"

    def as_re(c):
        return "N" if c.isdecimal() else "L" if c.isalnum() else "S" if c.isspace() else "-"

    def as_wanted(c):
        return kind(c) if kind(c) in "LN" else "S" if space(c) else "-"

    letter, number = ranges(lambda c: kind(c) == "L"), ranges(lambda c: kind(c) == "N")
    space_ranges = ranges(space)
    return (
        re.compile("[" + ranges(lambda c: as_re(c) != as_wanted(c)) + "]"),
        re.compile(r" ?(?:[^\W\d_]+|\d+|(?!'(?:s|t|re|ve|m|ll|d))(?:[^\s\w]|_)+)"
                   r"|'(?:s|t|re|ve|m|ll|d)|\s+(?!\S)|\s+"),
        re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+"
                   f"| ?[^{space_ranges}{letter}{number}]+"
                   f"|[{space_ranges}]+(?![^{space_ranges}])|[{space_ranges}]+"))


class Bpe:
    """A vocabulary and its merges, read from a tokenizer file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.special_split = re.compile(
            "(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        letters = byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        byte_of = {c: b for b, c in letters.items()}
        self.bytes = {i: bytes(byte_of[c] for c in piece) for piece, i in vocab.items()
                      if all(c in byte_of for c in piece)}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.left = [vocab[a] for a, _ in merges]
        self.right = [vocab[b] for _, b in merges]
        self.product = [vocab[a + b] for a, b in merges]
        keys = np.array(self.left, np.int64) << SHIFT | np.array(self.right, np.int64)
        # A pair named twice keeps its last rank, as in a table filled in order.
        self.rank = dict(zip(keys.tolist(), range(len(merges))))
        self.keys = np.array(sorted(self.rank), np.int64)
        self.key_rank = np.array([self.rank[k] for k in self.keys.tolist()], np.int32)
        self.known = Memory()
        self.odd: set[str] = set()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; -1 where a pair has none."""
        key = left.astype(np.int64) << SHIFT | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.key_rank[at], -1)

    def learn(self, words: list[str]) -> None:
        """Find the ids of new pre-tokens, a bounded number of symbols at a time."""
        batch, size = [], 0
        for word in words:
            raw = word.encode()
            if batch and size + len(raw) > INDEXED:
                self._merge(batch)
                batch, size = [], 0
            batch.append((word, raw))
            size += len(raw)
        if batch:
            self._merge(batch)

    def _merge(self, batch: list[tuple[str, bytes]]) -> None:
        raw = np.frombuffer(b"".join(r for _, r in batch), np.uint8)
        n = len(raw)
        ends = np.cumsum([len(r) for _, r in batch])
        # Each list has an array view of the same memory: single entries go through the
        # list, whole positions lists through the view.
        symbols, after, before = (array("i", bytes(4 * n)) for _ in range(3))
        symbols_v, after_v, before_v = (np.frombuffer(x, np.int32)
                                        for x in (symbols, after, before))
        symbols_v[:] = self.first[raw]
        after_v[:] = np.arange(1, n + 1)
        before_v[:] = np.arange(-1, n - 1)
        after_v[ends - 1] = -1
        before_v[np.concatenate([[0], ends[:-1]])] = -1

        index: dict[int, list[int]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
            have = ranks >= 0
            positions, ranks = positions[have], ranks[have]
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            at = positions.tolist()
            for r, a, b in zip(ranks[cuts].tolist(), cuts.tolist(),
                               [*cuts[1:].tolist(), len(at)]):
                if r in index:
                    index[r] += at[a:b]
                else:
                    index[r] = at[a:b]
                    heapq.heappush(active, r)

        inner = np.flatnonzero(after_v >= 0)
        enter(inner, self.ranks(symbols_v[inner], symbols_v[inner + 1]))
        rank = self.rank
        while active:
            r = heapq.heappop(active)
            left, right, new = self.left[r], self.right[r], self.product[r]
            positions = index.pop(r)
            if len(positions) >= AT_ONCE and left != right:
                p = np.sort(np.array(positions, np.int32))
                p = p[np.diff(p, prepend=-1) > 0]
                q = after_v[p]
                p, q = (x[(symbols_v[p] == left) & (q >= 0) & (symbols_v[q] == right)]
                        for x in (p, q))
                o = after_v[q]
                symbols_v[p], symbols_v[q] = new, -1
                after_v[p], after_v[q] = o, -1
                before_v[o[o >= 0]] = p[o >= 0]
                # Pairs are read after all merges of the rank: a neighbour may have merged too.
                follow, o = p[o >= 0], o[o >= 0]
                b = before_v[p]
                lead, b = p[b >= 0], b[b >= 0]
                enter(np.concatenate([follow, b]), np.concatenate(
                    [self.ranks(symbols_v[follow], symbols_v[o]),
                     self.ranks(symbols_v[b], symbols_v[lead])]))
                continue
            for p in sorted(positions):
                q = after[p]
                # Entries whose symbols have been merged meanwhile are passed over.
                if symbols[p] != left or q < 0 or symbols[q] != right:
                    continue
                symbols[p], symbols[q] = new, -1
                o = after[p] = after[q]
                after[q] = -1
                if o >= 0:
                    before[o] = p
                    f = rank.get(new << SHIFT | symbols[o])
                    if f is not None:
                        if f in index:
                            index[f].append(p)
                        else:
                            index[f] = [p]
                            heapq.heappush(active, f)
                b = before[p]
                if b >= 0:
                    f = rank.get(symbols[b] << SHIFT | new)
                    if f is not None:
                        if f in index:
                            index[f].append(b)
                        else:
                            index[f] = [b]
                            heapq.heappush(active, f)
        kept = symbols_v >= 0
        packed = symbols_v[kept].astype("<u4").tobytes()
        stops = (4 * np.cumsum(kept)[ends - 1]).tolist()
        at = 0
        for (word, _), stop in zip(batch, stops):
            self.known[word] = packed[at:stop]
            at = stop
        self.known.spend(len(batch), len(packed) + sum(len(w) for w, _ in batch))

    def pieces(self, text: str, pattern: re.Pattern) -> list[str]:
        """Pre-tokens of a text; special tokens stand as they are."""
        if self.special_split is None or not any(s in text for s in self.special):
            return pattern.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.special_split.split(text)):
            out.extend([part] if i % 2 else pattern.findall(part))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if self.known.spent > REMEMBERED:
            self.known.clear()
        if not self.known:
            self.known.update((s, int(i).to_bytes(4, "little")) for s, i in self.special.items())
            self.odd = set()
        odd, usual, exact = split_patterns()
        parts = [self.pieces(t, usual) for t in texts]
        new = set().union(*parts) - self.known.keys()
        # Every character stands in some pre-token, so the few that need the exact split are
        # looked for in new pre-tokens only.
        if odd.search("".join(new)):
            self.odd.update(w for w in new if odd.search(w))
        if self.odd:
            parts = [w if self.odd.isdisjoint(w) else self.pieces(t, exact)
                     for t, w in zip(texts, parts)]
            new = set().union(*parts) - self.known.keys()
            self.odd.update(w for w in new if odd.search(w))
        self.learn(list(new))
        look = self.known.__getitem__
        return [b"".join(map(look, words)) for words in parts]

    def decode(self, ids: bytes) -> str:
        """The text of packed ids, special tokens included."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes.__getitem__, numbers)).decode("utf-8", "replace")


def file_content(path: str) -> str:
    """A tokenizer file, read once on the driver; its size is that of a vocabulary."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _workers_bpe(shared) -> Bpe:
    """One vocabulary for each Python worker, kept between its tasks."""
    cache = _workers_bpe.__dict__
    if cache.get("of") != shared.id:
        cache["of"], cache["bpe"] = shared.id, Bpe(shared.value)
    return cache["bpe"]


class _Shared:
    """A broadcast and its number, which tells one file from another in a worker."""

    def __init__(self, broadcast, number):
        self.broadcast, self.id = broadcast, number

    @property
    def value(self):
        return self.broadcast.value


def _share(df: DataFrame, path: str) -> _Shared:
    broadcast = df.sparkSession.sparkContext.broadcast(file_content(path))
    return _Shared(broadcast, (path, id(broadcast)))


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``: token ids as little-endian unsigned 32-bit integers, packed."""
    return _run(df, path, key, text, decoded=False)


def encode_decode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode``, and ``decoded``: the text made from the ids alone."""
    return _run(df, path, key, text, decoded=True)


def _run(df, path, key, text, decoded):
    rows = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    shared = _share(df, path)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bpe = _workers_bpe(shared)
            ids = bpe.encode(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([bpe.decode(i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(
                columns, names=["key", "ids", "decoded"][:len(columns)])

    out = map_batches(rows, run, f"key {kind}, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``decoded``: the text of packed ids; null ids are no ids."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(ids, F.lit(b"")).alias("ids"))
    shared = _share(df, path)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bpe = _workers_bpe(shared)
            texts = [bpe.decode(b) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["key", "decoded"])

    return map_batches(rows, run, f"key {kind}, decoded string").withColumnRenamed("key", key)
