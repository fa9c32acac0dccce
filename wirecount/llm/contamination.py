"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet on shared seeds, hashes of five tokens in a row. For every
pair that shares one the item is tiled with the document: the longest common runs of unmarked
tokens are marked first, found by Karp-Rabin hashes of a search length that shrinks round by
round, until no run of the least length is left. An item is held by a document when the tiles
cover a given share of its tokens, in whatever order they stand in the document.

A benchmark is measured. One of up to ``BLOCK_BYTES`` is sent to the tasks, which scan the documents
without a shuffle; only rows over the threshold leave a task. The seeds of a larger one are a
table. Documents are scanned once as well: a bit filter of bounded size lets through those that may
hold a seed, their seeds meet the table, a common seed spread over salts, and the pairs that share
one are tiled where their texts meet.

Defined results: tokens are runs of letters, digits and underscores in lower case; an item of
fewer than five tokens must be found whole; null and empty texts and texts without tokens are in
no result; equal rows, and equal items, are reported each; rows without identifier are reported
with a null one; other columns are ignored, whatever their names; an empty table of either kind
gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wirecount.llm.common import map_batches, stored, text_of
from wirecount.operators.lookup import lookup_join, measured_bytes

LEAST, COVERAGE = 5, 0.5
#: Bytes of benchmark texts in one block.
BLOCK_BYTES = 16 << 20
#: Pairs of places compared at a time, and the most bits of a filter of seeds.
PAIRS, FILTER_BITS = 1_000_000, 1 << 27
WORD = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = ("doc long, item long, coverage double, tiles int, matched int, item_tokens int, "
          "longest int")


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _prefix_hashes(tokens: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Sums of tokens times powers, so that runs compare after multiplying up."""
    out = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens.astype(np.uint64) * powers[:len(tokens)], dtype=np.uint64, out=out[1:])
    return out


def _run_hashes(prefix: np.ndarray, powers: np.ndarray, at: np.ndarray, length: int,
                top: int) -> np.ndarray:
    """Karp-Rabin hashes of the runs of ``length`` at ``at``, brought to one power."""
    return (prefix[at + length] - prefix[at]) * powers[top - at]


def _free_runs(marked: np.ndarray, length: int) -> np.ndarray:
    """Where runs of ``length`` unmarked tokens begin."""
    if len(marked) < length:
        return np.empty(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(taken[length:] == taken[:-length])


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles ``(place in doc, place in item, length)``; token 0 never matches.

    Each round searches runs of ``length`` tokens, extends them as far as both sides agree, and
    marks what it found from the longest to the shortest.
    """
    top = max(len(doc), len(item))
    powers = _powers(top)
    hashes = _prefix_hashes(doc, powers), _prefix_hashes(item, powers)
    marked = doc == 0, item == 0
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(doc), len(item)))
    while True:
        waiting = [(-n, d, p) for d, p, n in _longest(doc, item, marked, hashes, powers, length)]
        heapq.heapify(waiting)
        while waiting:
            n, d, p = heapq.heappop(waiting)
            n = -n
            open_ = ~(marked[0][d:d + n] | marked[1][p:p + n])
            if open_.all():
                marked[0][d:d + n] = True
                marked[1][p:p + n] = True
                out.append((d, p, n))
                continue
            # What a longer tile left of the run, if it is long enough, waits its turn.
            edges = np.flatnonzero(np.diff(np.concatenate([[0], open_, [0]])))
            for a, z in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if z - a >= length:
                    heapq.heappush(waiting, (a - z, d + a, p + a))
        if length == least:
            return out
        length = max(least, length // 2)


def _left_open(marked: np.ndarray) -> np.ndarray:
    """How many unmarked tokens follow from each place on."""
    stops = np.append(np.flatnonzero(marked), len(marked))
    at = np.arange(len(marked))
    return stops[np.searchsorted(stops, at)] - at


def _longest(doc: np.ndarray, item: np.ndarray, marked, hashes, powers: np.ndarray,
             length: int) -> Iterator[tuple[int, int, int]]:
    """Unmarked common runs of at least ``length`` tokens that cannot grow to either side."""
    top = len(powers) - 1
    free = [_free_runs(m, length) for m in marked]
    keys = [_run_hashes(h, powers, f, length, top) for h, f in zip(hashes, free)]
    order = np.argsort(keys[1], kind="stable")
    known, places = keys[1][order], free[1][order]
    first, last = (np.searchsorted(known, keys[0], side) for side in ("left", "right"))
    several = last - first
    at = np.flatnonzero(several)
    open_ = [_left_open(m) for m in marked]
    while len(at):
        # Pairs of places with equal hashes, a bounded number at a time.
        part = max(1, int(np.searchsorted(np.cumsum(several[at]), PAIRS, "right")))
        now, at = at[:part], at[part:]
        d = np.repeat(free[0][now], several[now])
        inside = np.arange(len(d)) - np.repeat(np.cumsum(several[now]) - several[now], several[now])
        p = places[np.repeat(first[now], several[now]) + inside]
        # A run that can grow to the left is part of one found further left.
        before = (d > 0) & (p > 0)
        grows = before & (doc[d - 1] == item[p - 1]) & ~marked[0][d - 1] & ~marked[1][p - 1]
        d, p = d[~grows], p[~grows]
        most = np.minimum(open_[0][d], open_[1][p])
        # The longest common run by halving, on hashes; tokens decide in the end.
        low, high = np.full(len(d), length), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = ((hashes[0][d + middle] - hashes[0][d]) * powers[top - d]
                    == (hashes[1][p + middle] - hashes[1][p]) * powers[top - p])
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        for a, b, n in zip(d.tolist(), p.tolist(), low.tolist()):
            differ = np.flatnonzero(doc[a:a + n] != item[b:b + n])
            n = int(differ[0]) if len(differ) else n
            if n >= length:
                yield a, b, n


class Index:
    """Tokens, items and seeds of a block of the benchmark."""

    def __init__(self, items: list[tuple[int | None, str]], least: int = LEAST):
        self.number: dict[str, int] = {}
        self.items, seeds, self.least = [], {}, least
        for name, text in items:
            tokens = np.array([self.number.setdefault(w, len(self.number) + 1)
                               for w in WORD.findall((text or "").lower())], np.int64)
            if not len(tokens):
                continue
            n = min(least, len(tokens))
            self.items.append((name, tokens, n))
            for h in set(self._hashes(tokens, n).tolist()):
                seeds.setdefault((n, h), []).append(len(self.items) - 1)
        self.seeds = seeds
        self.lengths = {n: np.array(sorted(h for m, h in seeds if m == n), np.uint64)
                        for n in {m for m, _ in seeds}}

    @staticmethod
    def _hashes(tokens: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
        powers = _powers(n)
        at = np.arange(len(tokens) - n + 1) if at is None else at
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            total += tokens[at + k].astype(np.uint64) * powers[k]
        return total

    def matches(self, text: str, coverage: float) -> Iterator[tuple]:
        words = WORD.findall(text.lower())
        number = self.number
        tokens = np.fromiter((number.get(w, 0) for w in words), np.int64, len(words))
        strange = np.concatenate([[0], np.cumsum(tokens == 0)])
        shared: dict[int, list[np.ndarray]] = {}
        for n, known in self.lengths.items():
            if len(tokens) < n:
                continue
            at = np.flatnonzero(strange[n:] == strange[:-n])
            hashes = self._hashes(tokens, n, at)
            place = np.searchsorted(known, hashes)
            place[place == len(known)] = 0
            hit = known[place] == hashes
            for h in np.unique(hashes[hit]).tolist():
                where = at[hit][hashes[hit] == h]
                for i in self.seeds[n, h]:
                    shared.setdefault(i, []).append(where)
        for i, where in shared.items():
            name, item, least = self.items[i]
            # Every run of the least length begins at a seed: the rest of the text can go.
            near = np.unique(np.concatenate(where)[:, None] + np.arange(least))
            gaps = np.flatnonzero(np.diff(near) > 1) + 1
            part = np.insert(tokens[near], gaps, 0)
            tiles = tile(part, item, least)
            matched = sum(n for _, _, n in tiles)
            share = matched / len(item)
            if tiles and share >= coverage:
                yield (name, share, len(tiles), matched, len(item),
                       max(n for _, _, n in tiles))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
                 least: int = LEAST, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and item it holds: ``key, item_key, coverage, tiles, matched,
    item_tokens, longest``."""
    items = benchmark.select(F.col(item_key).cast("long").alias("item"),
                             text_of(item_text).alias("words"))
    rows = docs.select(F.col(key).cast("long").alias("doc"), text_of(text).alias("text"))
    way = _in_block if measured_bytes(items) <= block_bytes else _by_seeds
    return way(rows, items, coverage, least).withColumnsRenamed({"doc": key, "item": item_key})


def _seeds(text: str, sizes: list[int]) -> np.ndarray:
    """The distinct seeds of a text, runs of each of the sizes, as 64-bit numbers."""
    words = WORD.findall(text.lower())
    tokens = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return np.unique(np.concatenate([np.empty(0, np.uint64), *(
        Index._hashes(tokens, n) * BASE + np.uint64(n) for n in sizes if n <= len(tokens))]))


def _filter(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the seeds' hashes in words of 64, and their number, a power of two."""
    bits = 1 << 10
    while bits < min(16 * seeds.count(), FILTER_BITS):
        bits *= 2
    at = F.pmod("seed", F.lit(bits))
    words = seeds.groupBy(F.floor(at / 64).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(seed, {bits}) % 64 AS INT))")).alias("b"))
    out = np.zeros(bits // 64, np.int64)
    for r in words.toLocalIterator():
        out[r["w"]] = r["b"]
    return out.view(np.uint64), bits


def _by_seeds(rows: DataFrame, items: DataFrame, coverage: float, least: int) -> DataFrame:
    numbered = stored(items.withColumn("no", F.monotonically_increasing_id()))

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(no, n, s) for no, t in zip(*(c.to_pylist() for c in batch.columns))
                   if (n := min(least, len(WORD.findall(t.lower()))))
                   for s in _seeds(t, [n]).view(np.int64).tolist()]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(),
                                                               pa.int64()))],
                    names=["no", "n", "seed"])

    seeds = stored(map_batches(numbered.select("no", "words"), item_seeds,
                               "no long, n int, seed long"))
    sizes = sorted(r["n"] for r in seeds.select("n").distinct().collect())
    known = rows.sparkSession.sparkContext.broadcast(_filter(seeds.select("seed").distinct()))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits = known.value
        for batch in batches:
            keep, found = [], []
            for i, t in enumerate(batch.column(1)):
                own = _seeds(t.as_py(), sizes)
                place = own & np.uint64(bits - 1)
                own = own[(words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)
                          == 1]
                if len(own):
                    keep.append(i)
                    found.append(own.view(np.int64))
            if keep:
                kept = batch.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(found, pa.list_(pa.int64()))],
                    names=["doc", "text", "seeds"])

    held = stored(map_batches(rows, candidates, "doc long, text string, seeds array<long>")
                  .withColumn("row", F.monotonically_increasing_id()))
    meeting = lookup_join(held.select("row", F.explode("seeds").alias("seed")),
                          seeds.select("seed", "no"), ["seed"], spread_by=["row"])
    pairs = stored(meeting.select("row", "no").distinct())
    both = lookup_join(lookup_join(pairs, numbered, ["no"], spread_by=["row"]),
                       held.select("row", "doc", "text"), ["row"], spread_by=["no"])

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of = None, None
        for batch in batches:
            out = []
            for item, words, doc, t in zip(*(c.to_pylist() for c in batch.columns)):
                if index is None or of != (item, words):
                    index, of = Index([(item, words)], least), (item, words)
                out += [(doc, *m) for m in index.matches(t, coverage)]
            if out:
                yield _found(out)

    return map_batches(both.select("item", "words", "doc", "text"), tiled, SCHEMA)


def _found(out: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.float64(), *[pa.int32()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                      names=[f.split()[0] for f in SCHEMA.split(", ")])


def _in_block(rows: DataFrame, items: DataFrame, coverage: float, least: int) -> DataFrame:
    known = [(r["item"], r["words"]) for r in items.orderBy("item", "words").collect()]
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            index = index or Index(shared.value, least)
            out = [(name, *m) for name, t in zip(*(c.to_pylist() for c in batch.columns))
                   for m in index.matches(t, coverage)]
            if out:
                yield _found(out)

    return map_batches(rows, run, SCHEMA)
