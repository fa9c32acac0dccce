"""Near-duplicate join on word n-grams with Bayesian candidate pruning.

1. Every text becomes its set of five-word shingles, a key of that set and a MinHash signature.
   Documents with one set are one class; from here on a class is one row.
2. Signatures are cut into bands; classes that share a band are candidates. With 32 bands of 4
   values a pair at the threshold shares none with a probability of 5e-8.
3. Members of a bucket meet in blocks of bounded size, of which a hot bucket has several. The
   signatures of a pair are compared 16 values at a time; after each step the posterior of the
   similarity (uniform prior) is looked at, and a pair is dropped when its probability of
   reaching the threshold falls below the tolerance. A pair is handled in the first band that
   it shares, so once. Blocks pass on a spanning forest of what is left, not the pairs.
4. Inside each component of these forests all pairs are verified exactly on their shingle sets,
   again in blocks of bounded size. Blocks pass on numbers of links and a spanning forest.

Nothing but sums and forests leaves a block: a group of n near copies costs n rows there, though
its n * n / 2 pairs are all compared.

Defined results: words are runs of letters, digits and underscores in lower case; a text of
fewer than five words is one shingle; texts without a word are copies of one another only if
equal, and null is an empty text; rows without an identifier are left out; every other row gives
one row, a repeated one too, which counts as one more copy; rows that share an identifier but not
their text are apart in everything but their name; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wirecount.llm.common import Memory, map_batches, stored, text_of
from wirecount.llm.components import components
from wirecount.operators.lookup import lookup_join

WIDTH, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
HASHES, BANDS, STEP = 128, 32, 16
ROWS = HASHES // BANDS
#: Members and shingles of one block; a group of two blocks is what a task holds at a time.
BLOCK, BLOCK_SHINGLES = 1024, 500_000
#: Members of a block compared at a time with the rest, shingles at a time, and candidate pairs
#: held before they are joined to a forest.
STRIP, COLUMNS, HELD = 256, 1024, 300_000
#: Bytes of word hashes that a worker remembers before it starts anew.
REMEMBERED = 24 << 20
WORD = re.compile(r"\w+")
_seeds = np.random.default_rng(20240101)
FACTORS = (_seeds.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1))[:, None]
OFFSETS = _seeds.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
POWERS = _seeds.integers(0, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(Memory):
    def __missing__(self, word: str) -> int:
        if self.spent > REMEMBERED:
            self.clear()
        self.spend(1, len(word))
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = WORD.findall(text.lower())
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    if n < WIDTH:
        return _mixed((ids * POWERS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    total = np.zeros(n - WIDTH + 1, np.uint64)
    for k in range(WIDTH):
        total += ids[k:n - WIDTH + 1 + k] * POWERS[k]
    total = np.sort(_mixed(total))
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def signature(found: np.ndarray) -> bytes:
    """MinHash values of a non-empty set, packed as 32-bit integers."""
    least = np.full((HASHES, 1), 0xFFFFFFFF, np.uint32)
    narrow = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(narrow), 2048):
        values = narrow[None, at:at + 2048] * FACTORS
        values += OFFSETS
        np.minimum(least, values.min(axis=1, keepdims=True), out=least)
    return least.astype("<u4").tobytes()


def set_key(text: str, found: np.ndarray) -> bytes:
    own = found.tobytes() if len(found) else b"no words" + text.encode()
    return hashlib.blake2b(own, digest_size=16).digest()


def posterior(matches: int, compared: int, threshold: float = THRESHOLD) -> float:
    """Probability that a pair's similarity reaches the threshold, from a uniform prior."""
    # The upper tail of Beta(m + 1, n - m + 1) is a lower tail of a binomial of n + 1 trials.
    n = compared + 1
    return sum(math.comb(n, k) * threshold ** k * (1 - threshold) ** (n - k)
               for k in range(matches + 1))


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """Per step: the fewest equal values with which a pair is kept."""
    return [next(m for m in range(n + 1) if posterior(m, n, threshold) >= tolerance)
            for n in range(STEP, HASHES + 1, STEP)]


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, digest, set_key, sig, n``: digest of the text, class key, signature (null without
    words), size of the set."""
    rows = docs.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, keys, sigs, sizes = [], [], [], []
            for t in batch.column(1).to_pylist():
                found = shingles(t)
                digests.append(hashlib.md5(t.encode(), usedforsecurity=False).digest())
                keys.append(set_key(t, found))
                sigs.append(signature(found) if len(found) else None)
                sizes.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.binary()) for c in (digests, keys, sigs)),
                 pa.array(sizes, pa.int64())], names=["id", "digest", "set_key", "sig", "n"])

    return map_batches(rows, run,
                       "id long, digest binary, set_key binary, sig binary, n long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    """Columns of complete runs of equal first values, many runs at a time, and their starts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        gid = table.column(0).to_numpy()
        if len(gid) == 0 or gid[0] == gid[-1]:
            continue
        cut = int(np.flatnonzero(gid != gid[-1])[-1]) + 1
        yield _columns(table.slice(0, cut)), _starts(gid[:cut])
        held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield _columns(table), _starts(table.column(0).to_numpy())


def _columns(table: pa.Table) -> list:
    return [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns]


def _starts(gid: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(np.diff(gid)) + 1])


def _pairs(starts: np.ndarray, n: int, at_once: int = 100_000):
    """Index pairs inside each run, a bounded number at a time."""
    sizes = np.diff(np.append(starts, n))
    for size in np.unique(sizes[sizes > 1]).tolist():
        first = starts[sizes == size]
        if size <= 64:
            i, j = np.triu_indices(size, 1)
            step = max(1, at_once // len(i))
            for k in range(0, len(first), step):
                base = first[k:k + step, None]
                yield (base + i).ravel(), (base + j).ravel()
            continue
        rows = max(1, at_once // size)
        for base in first.tolist():
            for a in range(0, size - 1, rows):
                i, j = np.meshgrid(np.arange(a, min(a + rows, size)), np.arange(a + 1, size),
                                   indexing="ij")
                keep = i < j
                yield base + i[keep], base + j[keep]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the smallest index of each component of the pairs."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = np.minimum(new, new[new])
        if (new == label).all():
            moved = np.flatnonzero(label != np.arange(n))
            return label[moved], moved
        label = new


def _prune(needed: list[int]):
    """Blocks of candidates to forests of the pairs that the posterior leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, cross, side, band, ids, sigs), starts in _groups(batches):
            n = len(ids)
            cross, side, band, ids = (c.to_numpy(zero_copy_only=False)
                                      for c in (cross, side, band, ids))
            values = np.frombuffer(b"".join(sigs.to_pylist()), "<u4").reshape(n, HASHES)
            wide = values.view(np.uint64).reshape(n, BANDS, ROWS // 2)
            left, right = [], []
            for i, j in _pairs(starts, n):
                keep = ~cross[i] | (side[i] != side[j])
                i, j = i[keep], j[keep]
                first, second = [], []
                for b in range(BANDS):
                    if not len(i):
                        break
                    equal = (wide[i, b] == wide[j, b]).all(axis=1)
                    now = equal & (band[i] == b)
                    first.append(i[now])
                    second.append(j[now])
                    later = ~equal & (band[i] > b)
                    i, j = i[later], j[later]
                if not first:
                    continue
                i, j = np.concatenate(first), np.concatenate(second)
                same = np.zeros(len(i), np.int64)
                for k, least in enumerate(needed):
                    part = slice(k * STEP, (k + 1) * STEP)
                    same += (values[i, part] == values[j, part]).sum(axis=1)
                    keep = same >= least
                    i, j, same = i[keep], j[keep], same[keep]
                left.append(i)
                right.append(j)
                if sum(map(len, left)) > HELD:
                    i, j = _forest(np.concatenate(left), np.concatenate(right), n)
                    left, right = [i], [j]
            if left:
                a, b = _forest(np.concatenate(left), np.concatenate(right), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a], pa.int64()), pa.array(ids[b], pa.int64())],
                    names=["a", "b"])

    return run


def _in_blocks(rows: DataFrame, group: str, blocks: str, member: str, *columns: str) -> DataFrame:
    """Rows of a group dealt to pairs of blocks: ``gid, cross, side`` and ``columns``.

    Rows of one pair of blocks stand together, sorted by ``gid``.
    """
    own = F.pmod(F.xxhash64(member, F.lit(7)), F.col(blocks))
    dealt = (
        rows.withColumn("side", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
        .select(
            F.xxhash64(group, F.least("side", "other"), F.greatest("side", "other"))
            .alias("gid"),
            (F.col("side") != F.col("other")).alias("differ"), "side", "other", *columns))
    # A row of block s stands in the pair (s, s) and in each pair (s, t).
    dealt = dealt.withColumnRenamed("differ", "cross").drop("other")
    return dealt.repartition("gid").sortWithinPartitions("gid")


def candidate_forest(classes: DataFrame, threshold: float = THRESHOLD,
                     tolerance: float = TOLERANCE) -> DataFrame:
    """Edges ``a, b`` that connect every pair of classes the posterior has not dropped."""
    known = classes.where("sig IS NOT NULL")
    width = 4 * ROWS
    keys = F.array(*(F.xxhash64(F.lit(b), F.substring("sig", b * width + 1, width))
                     for b in range(BANDS)))
    banded = known.select("rep", F.posexplode(keys).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = banded.join(shared, "bucket").withColumn(
        "blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    signed = members.join(known.select("rep", "sig"), "rep")
    dealt = _in_blocks(signed, "bucket", "blocks", "rep", "band", "rep", "sig")
    return map_batches(dealt, _prune(least_matches(threshold, tolerance)), "a long, b long")


class _Shared:
    """Sizes of intersections of some members with others, a strip at a time."""

    def __init__(self, sets: list[np.ndarray]):
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        column = np.cumsum(np.concatenate([[0], every[1:] != every[:-1]]))
        # Shingles of one member alone are in no intersection.
        several = np.bincount(column) > 1
        keep = several[column]
        self.column, self.owner = (np.cumsum(several) - 1)[column[keep]], owner[keep]
        self.n = len(sets)

    def common(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        total = np.zeros((len(rows), len(others)), np.float32)
        end = int(self.column[-1]) + 1 if len(self.column) else 0
        for at in range(0, end, COLUMNS):
            a, b = np.searchsorted(self.column, [at, at + COLUMNS])
            part = np.zeros((self.n, COLUMNS), np.float32)
            part[self.owner[a:b], self.column[a:b] - at] = 1
            total += part[rows] @ part[others].T
        return total


def _strips(cross: bool, side: np.ndarray):
    """Members and others of every strip, and whether only others after a member count."""
    if cross:
        first, rest = np.flatnonzero(side == side[0]), np.flatnonzero(side != side[0])
        for at in range(0, len(first), STRIP):
            yield first[at:at + STRIP], rest, False
    else:
        every = np.arange(len(side))
        for at in range(0, len(side), STRIP):
            yield every[at:at + STRIP], every[at:], True


def _linked(sets: list[np.ndarray], cross: bool, side: np.ndarray, weights: np.ndarray,
            threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of links of every member, and a forest of the linked pairs."""
    shared, size = _Shared(sets), np.array([len(s) for s in sets], np.float64)
    links = np.zeros(len(sets), np.int64)
    left, right = [], []
    for rows, others, after in _strips(cross, side):
        if not len(others):
            continue
        common = shared.common(rows, others)
        linked = common >= threshold * (size[rows, None] + size[others] - common) - 1e-9
        if after:
            linked &= others > rows[:, None]
        links[rows] += linked @ weights[others]
        links[others] += weights[rows] @ linked
        i, j = np.nonzero(linked)
        i, j = _forest(rows[i], others[j], len(sets))
        left.append(i)
        right.append(j)
    i, j = (np.concatenate(c) if c else np.empty(0, np.int64) for c in (left, right))
    return links, *_forest(i, j, len(sets))


def _verify(threshold: float):
    """Blocks of components to numbers of links and forests of the linked pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, starts in _groups(batches):
            stops = np.append(starts[1:], len(columns[0]))
            out: list[tuple] = []
            for a, z in zip(starts.tolist(), stops.tolist()):
                _, cross, side, ids, weights, texts = (c.slice(a, z - a) for c in columns)
                sets = [shingles(t.as_py()) for t in texts]
                side, ids, weights = (c.to_numpy(zero_copy_only=False)
                                      for c in (side, ids, weights))
                links, i, j = _linked(sets, cross[0].as_py(), side, weights, threshold)
                out += [(int(ids[k]), None, int(links[k])) for k in np.flatnonzero(links)]
                out += [(int(ids[x]), int(ids[y]), None) for x, y in zip(i.tolist(), j.tolist())]
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                      names=["a", "b", "links"])


def verified(docs: DataFrame, sketched: DataFrame, classes: DataFrame, groups: DataFrame,
             threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``a, links`` per class and block, and ``a, b`` edges of the linked pairs."""
    members = groups.join(classes.select(F.col("rep").alias("node"), "first", "size", "n"), "node")
    sizes = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
        .cast("long").alias("blocks"))
    # A class's text is that of its first row. Where rows are equal in both, one of them is taken.
    rows = (sketched.groupBy("id", "digest").count().where("count > 1")
            .select("id", "digest", F.lit(True).alias("again")))
    wanted = stored(lookup_join(
        members.join(sizes, "component").select(
            F.col("first.id").alias("id"), F.col("first.digest").alias("digest"),
            F.col("node").alias("rep"), "component", "blocks", "size"),
        rows, ["id", "digest"], "left"))
    named = docs.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    named = named.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    repeated = wanted.where("again")
    texts = lookup_join(named, wanted.where("again IS NULL"), ["id", "digest"])
    if not repeated.isEmpty():
        texts = texts.unionByName(
            lookup_join(named, repeated, ["id", "digest"]).dropDuplicates(["rep"]))
    dealt = _in_blocks(texts, "component", "blocks", "rep", "rep", "size", "text")
    return map_batches(dealt, _verify(threshold), "a long, b long, links long")


def _names(sketched: DataFrame, classes: DataFrame) -> DataFrame:
    """``rep, least, own``: the smallest identifier of every class, and the smallest one that no
    other class has."""
    placed = sketched.select("id", "set_key").join(classes.select("set_key", "rep"), "set_key")
    shared = stored(placed.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
                    .where("a < b").select("id", F.lit(True).alias("shared")))
    if shared.isEmpty():
        return classes.select("rep", F.col("first.id").alias("least"),
                              F.col("first.id").alias("own"))
    return lookup_join(placed, shared, ["id"], "left").groupBy("rep").agg(
        F.min("id").alias("least"), F.min(F.when(F.col("shared").isNull(), F.col("id")))
        .alias("own"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document of all its links to documents at the threshold or above.

    ``key``; ``class_id``: the smallest identifier with the same shingles; ``n_links``: linked
    documents, those of the own class included; ``group_id``: the smallest identifier that can
    be reached over links. An identifier that several classes share names a class or group only
    if that has no other.
    """
    sketched = stored(sketches(docs, key, text))
    # From here on classes go by a number of their own, whatever identifiers they share.
    classes = stored(
        sketched.groupBy("set_key", "sig", "n")
        .agg(F.min(F.struct("id", "digest")).alias("first"), F.count("*").alias("size"))
        .withColumn("rep", F.monotonically_increasing_id()))
    groups = components(candidate_forest(classes, threshold, tolerance))
    found = stored(verified(docs, sketched, classes, groups, threshold, key, text))
    links = found.where("links IS NOT NULL").groupBy("a").agg(F.sum("links").alias("links"))
    reached = components(found.where("b IS NOT NULL").select("a", "b"))
    names = stored(_names(sketched, classes))
    several = reached.withColumnRenamed("node", "rep").join(names, "rep")
    groups = lookup_join(
        several.select("rep", "component"),
        several.groupBy("component").agg(
            F.coalesce(F.min("own"), F.min("least")).alias("group_id")),
        ["component"], spread_by=["rep"])
    named = (
        classes.select("set_key", "rep", "size").join(names, "rep")
        .join(links.withColumnRenamed("a", "rep"), "rep", "left")
        .join(groups, "rep", "left")
        .select("set_key", F.coalesce("own", "least").alias("class_id"),
                (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("group_id", "own", "least").alias("group_id")))
    return sketched.select("id", "set_key").join(named, "set_key").select(
        F.col("id").alias(key), "class_id", "n_links", "group_id")
