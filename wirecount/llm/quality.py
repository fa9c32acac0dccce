"""Quality rules: base rules on counts, then gradient-boosted trees over document statistics.

1. A pass over the texts turns each whole text into counts. Words are runs of anything but ASCII
   white space. Repeated windows of words are found exactly: windows get numbers by pairs, so a
   window of five is a number and no hash stands for it.
2. Base rules refuse texts of few words or of many repeated ones.
3. Trees are grown on a bounded sample of labelled documents, by second-order boosting of the
   logistic loss over histograms. Features named in ``FEATURES`` with a sign are monotonic: a split
   that would turn the sign is not made, and each side's values stay on their side of the
   middle of a split below it, so the whole sum keeps the sign. The verdict's threshold comes from
   folds that were not trained on: it keeps the share ``KEEP`` of the good ones.
4. All trees together are five numpy arrays of nodes (feature, cut, left, right, value); a batch
   walks all trees level by level without a loop over rows.

Defined results: a null text has no words; a text without words is refused by the base rules;
every row of ``documents`` gives one row, repeated ones and those without identifier too, which
get no label; labels with a null in identifier or label are ignored, and an identifier with
several labels counts as good only if most of them are; with labels of one kind or none the base
rules alone decide. The sample has at most ``SAMPLE`` rows of either label, those with the least
hashes of identifier and statistics, each distinct row once. Other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wirecount.llm.common import map_batches, stored, text_of

WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Labelled rows of either kind that trees are grown on.
SAMPLE = 10_000
#: Good documents that the threshold keeps, in folds that were not trained on.
KEEP, FOLDS = 0.995, 4
TREES, DEPTH, RATE, BINS, SMOOTH, LEAST_WEIGHT = 60, 4, 0.15, 64, 1.0, 4.0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_letters", "n_digits", "n_upper", "n_distinct", "n_symbol_words",
        "n_marks")
#: Features of the trees and the sign that the score must have in each (0: any).
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "symbol_words": -1, "dup_lines": -1,
            "repeated": -1, "letters": 1, "digits": -1, "upper": 0, "distinct": 0,
            "line_words": 0, "marks": 0}
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
#: Kinds of characters; those beyond the basic plane are counted as none of them.
_OTHER, _LOWER, _UPPER, _DIGIT, _MARK, _SIGN = range(6)


def _kind(char: str) -> int:
    return (_SIGN if _SYMBOL.match(char) else _MARK if char in ".!?,;:" else
            _DIGIT if char in "0123456789" else
            (_UPPER if char.isupper() else _LOWER) if char.isalpha() else _OTHER)


_KINDS = np.zeros(0x10001, np.uint8)
_KINDS[:0x10000] = [_kind(chr(i)) for i in range(0x10000)]


def repeated_words(words: list[str]) -> int:
    """Words in five-word windows that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    one = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0

    def numbered(a, b):
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)

    two = numbered(one[:-1], one[1:])
    four = numbered(two[:-2], two[2:])
    five = numbered(four[:n], one[WINDOW - 1:])
    again = np.flatnonzero(np.bincount(five)[five] > 1)
    held = np.zeros(len(words) + 1, np.int64)
    np.add.at(held, again, 1)
    np.add.at(held, again + WINDOW, -1)
    return int((np.cumsum(held) > 0).sum())


def counts(text: str) -> tuple[int, ...]:
    """``COUNTS`` and ``MORE`` of a whole text."""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.bincount(_KINDS[np.minimum(points, 0x10000)], minlength=6).tolist()
    return (len(words), sum(map(len, words)), kinds[_SIGN], len(lines) - len(set(lines)),
            repeated_words(words), len(text), len(lines), kinds[_LOWER] + kinds[_UPPER],
            kinds[_DIGIT], kinds[_UPPER], len(set(words)),
            sum(1 for w in words if _SYMBOL.search(w)) if kinds[_SIGN] else 0, kinds[_MARK])


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and the counts of every row's text."""
    kind = docs.schema[key].dataType.simpleString()
    names = COUNTS + MORE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*found))]
                if found else [batch.column(0), *(pa.array([], pa.int64()) for _ in names)],
                names=["id", *names])

    return map_batches(docs.select(F.col(key).alias("id"), text_of(text).alias("text")), run,
                       ", ".join([f"id {kind}", *(f"{c} long" for c in names)]))


def features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """A row of ``FEATURES`` for every row of counts."""
    c = {k: v.astype(np.float64) for k, v in columns.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words,
        c["n_symbol_words"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        c["n_letters"] / chars, c["n_digits"] / chars, c["n_upper"] / chars,
        c["n_distinct"] / words, np.log1p(c["n_words"] / lines), c["n_marks"] / words])


@dataclass
class Trees:
    """All nodes of all trees; a leaf points to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of being good for every row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            below = x[rows, self.feature[at]] <= self.cut[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def grow(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = TREES) -> Trees:
    """Boosted trees for labels 0 and 1; both kinds are weighed alike."""
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    binned = np.column_stack([np.searchsorted(c, col) for c, col in zip(cuts, x.T)])
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    nodes: list[list[float]] = []
    roots, score = [], np.zeros(len(y))

    def value(g, h, low, high):
        return np.clip(-g / (h + SMOOTH), low, high)

    def gain(g, h, v):
        return -(g * v + 0.5 * (h + SMOOTH) * v * v)

    def split(rows, depth, low, high) -> int:
        g, h = grad[rows], hess[rows]
        own = float(value(g.sum(), h.sum(), low, high))
        here = len(nodes)
        nodes.append([0, np.inf, here, here, RATE * own])
        best = None
        if depth < DEPTH:
            for f, edges in enumerate(cuts):
                if not len(edges):
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, g, len(edges) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h, len(edges) + 1))[:-1]
                gr, hr = g.sum() - gl, h.sum() - hl
                vl, vr = value(gl, hl, low, high), value(gr, hr, low, high)
                won = gain(gl, hl, vl) + gain(gr, hr, vr) - gain(g.sum(), h.sum(), own)
                good = (hl >= LEAST_WEIGHT) & (hr >= LEAST_WEIGHT) & (signs[f] * (vr - vl) >= 0)
                won = np.where(good, won, -np.inf)
                k = int(won.argmax())
                if won[k] > 1e-6 and (best is None or won[k] > best[0]):
                    best = (won[k], f, k, float(vl[k]), float(vr[k]))
        if best is None:
            score[rows] += RATE * own
            return here
        _, f, k, vl, vr = best
        below = binned[rows, f] <= k
        middle = (vl + vr) / 2
        sides = ((low, middle, middle, high) if signs[f] > 0 else
                 (middle, high, low, middle) if signs[f] < 0 else (low, high, low, high))
        left = split(rows[below], depth + 1, *sides[:2])
        right = split(rows[~below], depth + 1, *sides[2:])
        nodes[here] = [f, cuts[f][k], left, right, 0.0]
        return here

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = weight * (p - y), weight * p * (1 - p)
        roots.append(split(np.arange(len(y)), 0, -np.inf, np.inf))
    table = np.array(nodes, np.float64).reshape(-1, 5)
    return Trees(*(table[:, i].astype(np.int64) if i in (0, 2, 3) else table[:, i].copy()
                   for i in range(5)), np.array(roots, np.int64), 0.0)


@dataclass
class Model:
    trees: Trees | None
    threshold: float

    def kept(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and whether they reach the threshold."""
        if self.trees is None:
            return np.zeros(len(x)), np.ones(len(x), bool)
        score = self.trees.score(x)
        return score, score >= self.threshold


def train(x: np.ndarray, y: np.ndarray, keep: float = KEEP) -> Model:
    """Trees and their threshold from feature rows and labels 0 or 1."""
    if not (y == 0).any() or not (y == 1).any():
        return Model(None, 0.0)
    signs = np.array(list(FEATURES.values()))
    fold = np.arange(len(y)) % FOLDS
    unseen = np.full(len(y), np.nan)
    for k in range(FOLDS):
        learn = fold != k
        if (y[learn] == 0).any() and (y[learn] == 1).any():
            unseen[fold == k] = grow(x[learn], y[learn], signs).score(x[fold == k])
    good = unseen[(y == 1) & ~np.isnan(unseen)]
    # Never above even odds: without good ones left over, that is the verdict.
    threshold = min(0.0, float(np.quantile(good, 1 - keep, method="lower"))) if len(good) else 0.0
    return Model(grow(x, y, signs), threshold)


def sample(stats: DataFrame, labels: DataFrame, most: int = SAMPLE, key: str = "doc_id",
           label: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of at most ``most`` documents of either label, on the driver."""
    names = list(COUNTS + MORE)
    good = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col(key).alias("id"))
            .agg((F.avg(F.col(label).cast("double")) > 0.5).cast("int").alias("y")))
    # A row of one identifier and equal counts is one row, so a hot identifier stays small.
    named = stats.where(F.col("id").isNotNull()).distinct().join(good, "id")
    named = named.withColumn("rank", F.xxhash64("id", *names))
    both = None
    for y in (0, 1):
        some = named.where(F.col("y") == y).orderBy("rank", "id").limit(most)
        both = some if both is None else both.unionByName(some)
    rows = both.select("rank", "y", *names).collect()
    rows.sort()
    columns = {c: np.array([r[c] for r in rows], np.int64) for c in names}
    return features(columns), np.array([r["y"] for r in rows], np.int64)


def judged(stats: DataFrame, model: Model) -> DataFrame:
    """``id``, ``COUNTS``, ``base_failed``, ``kept`` and ``score`` of every row."""
    kind = stats.schema["id"].dataType.simpleString()
    names = list(COUNTS + MORE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(i + 1).to_numpy() for i, n in enumerate(names)}
            failed = (c["n_words"] < LEAST_WORDS) | (
                100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
            score, kept = model.kept(features(c))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:1 + len(COUNTS)], pa.array(failed), pa.array(kept & ~failed),
                 pa.array(score)], names=["id", *COUNTS, "base_failed", "kept", "score"])

    return map_batches(stats.select("id", *names), run, ", ".join(
        [f"id {kind}", *(f"{c} long" for c in COUNTS),
         "base_failed boolean, kept boolean, score double"]))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
            label: str = "quality") -> DataFrame:
    """``key``, the counts, ``base_failed``, ``kept`` and ``score`` of every document."""
    stats = stored(statistics(docs, key, text))
    model = train(*sample(stats, labels, key=key, label=label))
    return judged(stats, model).withColumnRenamed("id", key)
