"""Language identification by averaged hashed subword embeddings.

A text's subwords are the runs of 2, 3 and 4 characters of its lower-cased words, with a mark at
either end of a word, hashed to rows of an embedding table. The average of the rows goes through
a linear softmax. Both are trained here by stochastic gradient descent in numpy, on a bounded
sample of labelled texts. As average and softmax layer are linear, a trained model scores a text
by adding one row of class scores per subword.

Rejection is calibrated on texts of the sample that training did not see, and on pieces of them
from one word up: the temperature is the one of least log loss. What decides is the share of the
subwords that the texts of the language knowing most of them held; a text between two learned
languages is known and stays, whatever its score. The bounds belong to a length: all but
``REJECTED`` of the pieces reach them, and they lie halfway to what should go, which is pieces with shuffled letters and pieces whose own language is left out,
where the two can be told apart. Short texts say little, so their bounds are lowered.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; every
other text gets a learned language, ties going to the first in alphabetic order; a sample of one
language or of none gives that one or ``und``; texts without label are not learned from; equal
rows get equal results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wirecount.llm.common import map_batches, prepare_workers, text_of

UNKNOWN = "und"
BUCKETS, DIMENSION, SIZES = 1 << 16, 16, (2, 3, 4)
#: Bounds of the training sample: texts of a language, code points of all of them together, and
#: languages. Texts over ``DRAWN`` code points are drawn after the shorter ones, and whole.
SAMPLE, LANGUAGES, DRAWN = 400, 1000, 8_000
PASSES, RATE, HELD, REJECTED = 8, 0.5, 0.2, 0.001
#: Pieces of a length that a bound needs, and subwords that count as one word.
LEAST_PIECES, A_WORD = 10, 9
#: Code points hashed at a time.
AT_ONCE = 1 << 17


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(text: str) -> np.ndarray:
    """Embedding rows of the subwords of a text, with repeats."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    # One zero between words, and one at either end.
    codes = np.where(letter, codes, 0)
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    rows = []
    for size in SIZES:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        total = np.full(n, size, np.uint32)
        inside = np.ones(n, bool)
        for k in range(size):
            part = codes[k:k + n]
            total = (total ^ part) * np.uint32(0x01000193)
            if 0 < k < size - 1:
                inside &= part != 0
        total ^= total >> np.uint32(15)
        rows.append((total[inside] % np.uint32(BUCKETS)).astype(np.int64))
    return np.concatenate(rows)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # a row of class scores per embedding row
    bias: np.ndarray
    temperature: float = 1.0
    known: np.ndarray | None = None  # whether a language's texts held an embedding row
    bounds: np.ndarray | None = None  # least share of known subwords by length

    def logits(self, text: str) -> np.ndarray | None:
        """Class scores of a whole text, hashed piece by piece; None without a letter."""
        return self._measured(text)[0]

    def _measured(self, text: str) -> tuple[np.ndarray | None, np.ndarray | None, int]:
        """Class scores, the share of the subwords each language knows, and their number."""
        total, held, n = np.zeros(len(self.bias)), np.zeros(len(self.bias)), 0
        for piece in _pieces(text):
            rows = subwords(piece)
            total += self.scores[rows].sum(axis=0, dtype=np.float64)
            if self.bounds is not None:
                held += self.known[rows].sum(axis=0)
            n += len(rows)
        return (total / n + self.bias, held / n, n) if n else (None, None, 0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        logits, held, n = self._measured(text) if text and self.languages else (None, None, 0)
        if logits is None:
            return UNKNOWN, 0.0, True
        shares = _softmax(logits[None, :] / self.temperature)[0]
        best = int(shares.argmax())
        score = float(shares[best])
        if self.bounds is None:
            return self.languages[best], score, False
        least = self.bounds[min(_length(n), len(self.bounds) - 1)]
        return self.languages[best], score, bool(held.max() < least)


def _length(n: int) -> int:
    return n.bit_length() - 1


def _pieces(text: str) -> Iterator[str]:
    """A text in bounded pieces, cut between words where there is a place to."""
    at = 0
    while at < len(text):
        end = at + AT_ONCE
        if end < len(text):
            space = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = space + 1 if space > at else end
        yield text[at:end]
        at = end


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Fit a model; the lists are a sample that fits one machine."""
    languages = sorted(set(labels))
    found = [subwords(t) for t in texts]
    kept = [i for i, rows in enumerate(found) if len(rows)]
    number = {language: i for i, language in enumerate(languages)}
    goal = np.array([number[labels[i]] for i in kept], np.int64)
    found = [found[i] for i in kept]
    rng = np.random.default_rng(seed)
    embeddings = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION))
    weights, bias = np.zeros((DIMENSION, len(languages))), np.zeros(len(languages))
    order = rng.permutation(len(found))
    held = order[:int(len(order) * HELD)] if len(order) >= 20 else order[:0]
    learned = order[len(held):]
    steps, done = max(1, PASSES * len(learned)), 0
    for _ in range(PASSES):
        for i in rng.permutation(learned):
            rate = RATE * (1 - done / steps)
            done += 1
            rows, counts = np.unique(found[i], return_counts=True)
            share = counts / counts.sum()
            average = share @ embeddings[rows]
            error = _softmax((average @ weights + bias)[None, :])[0]
            error[goal[i]] -= 1
            step = weights @ error
            weights -= rate * np.outer(average, error)
            bias -= 0.1 * rate * error
            # Each row's share of the gradient, scaled up as rows share one average.
            embeddings[rows] -= rate * np.sqrt(share)[:, None] * step
    model = Model(languages, (embeddings @ weights).astype(np.float32), bias)
    if len(held):
        logits = np.array([model.scores[found[i]].mean(axis=0) + bias for i in held])
        model.temperature = _temperature(logits, goal[held])
        model.known = np.zeros((BUCKETS, len(languages)), bool)
        for i in learned:
            model.known[found[i], goal[i]] = True
        model.bounds = _bounds(model, [texts[kept[i]] for i in held], goal[held], rng)
    return model


def _temperature(logits: np.ndarray, goal: np.ndarray) -> float:
    at = np.arange(len(goal))
    grid = np.geomspace(0.1, 10, 41)
    loss = [-np.log(_softmax(logits / t)[at, goal] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _cuts(text: str, rng) -> Iterator[str]:
    """A text, and pieces of it of 1, 2, 4 and more words."""
    words, size = text.split(), 1
    while size < len(words):
        at = int(rng.integers(len(words) - size + 1))
        yield " ".join(words[at:at + size])
        size *= 2
    yield text


def _bounds(model: Model, texts: list[str], goal: np.ndarray, rng) -> np.ndarray:
    """Least share of known subwords, for each power of two of subwords."""
    stay: dict[int, list] = {}
    go: dict[int, list] = {}

    def measured(into, piece: str, left_out: int | None = None) -> None:
        rows = subwords(piece)
        if len(rows):
            held = model.known[rows].mean(axis=0)
            if left_out is not None:
                held[left_out] = 0
            into.setdefault(_length(len(rows)), []).append(held.max())

    for text, own in zip(texts, goal.tolist()):
        for piece in _cuts(text, rng):
            measured(stay, piece)
            letters = np.array(list(piece))
            at = np.flatnonzero([c.isalpha() for c in piece])
            letters[at] = letters[rng.permutation(at)]
            measured(go, "".join(letters))
            if len(model.languages) > 1:
                measured(go, piece, own)
    out = [0.0]
    for length in range(max(stay, default=0) + 1):
        if len(stay.get(length, ())) < LEAST_PIECES:
            out.append(out[-1])
            continue
        low = np.quantile(stay[length], REJECTED)
        high = np.quantile(go[length], 1 - REJECTED) if length in go else 1.0
        bound = (low + high) / 2 if high < low else 0.9 * low
        # The fewer words, the more their share may lie off that of other texts.
        bound -= 1 / np.sqrt(max(1.0, (1 << length) / A_WORD))
        out.append(max(float(bound), 0.0))
    return np.array(out[1:])


def sample(docs: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text",
           label: str = "lang") -> tuple[list[str], list[str]]:
    """Texts and labels to learn from: for each language a fixed number by the hash of the row.

    Equal rows are drawn once. Long texts are drawn where a language has too few short ones, as
    long as all its texts have no more than ``SAMPLE * DRAWN`` code points, or one of them alone.
    The ranking moves hashes, lengths and labels only; the texts are read after that.
    """
    fit = (allowed & F.col(label).isNotNull() & F.col(key).isNotNull() & (F.length(text) > 0))
    row = F.xxhash64(key, text, F.lit(11))
    scale = 1 << 40
    given = docs.where(fit).select(
        F.col(label).alias("l"), row.alias("h"), F.length(text).alias("n")).withColumn(
        "long", F.col("n") > DRAWN)
    place = F.pmod("h", F.lit(scale))
    # The most frequent languages, and the share of each one's hashes that holds about twice the
    # sample: what is ranked does not grow with the input.
    shares = given.groupBy("l").agg(
        F.count("*").alias("rows"),
        F.approx_count_distinct(F.when(~F.col("long"), F.col("h"))).alias("short_"),
        F.approx_count_distinct(F.when(F.col("long"), F.col("h"))).alias("long_"))
    top = (2 * SAMPLE + 50) * scale
    shares = shares.orderBy(F.desc("rows"), "l").limit(LANGUAGES).select(
        F.col("l").alias("l_"), (top / F.greatest("short_", F.lit(1))).alias("top_short"),
        F.when(F.col("short_") < SAMPLE, top / F.greatest("long_", F.lit(1)))
        .otherwise(-1).alias("top_long"))
    drawn = given.join(F.broadcast(shares), (F.col("l") == F.col("l_")) & (
        place <= F.when(F.col("long"), F.col("top_long")).otherwise(F.col("top_short"))))
    order = Window.partitionBy("l").orderBy("long", "h")
    keys = (
        drawn.select("l", "h", "n", "long").distinct()
        .withColumn("r", F.row_number().over(order))
        .withColumn("sum", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("r") == 1) | ((F.col("r") <= SAMPLE) & (F.col("sum") <= SAMPLE * DRAWN)))
        .select(F.col("l").alias("l_"), F.col("h").alias("h_"), "r"))
    chosen = docs.where(fit).join(
        F.broadcast(keys), (row == F.col("h_")) & (F.col(label) == F.col("l_")))
    # As many rows as keys again, however often a row is repeated.
    rows = chosen.groupBy(F.col("l_").alias("l"), "r").agg(F.min(text).alias("t")).collect()
    rows = sorted(rows, key=lambda r: (r["r"], r["l"]))
    return [r["t"] for r in rows], [r["l"] for r in rows]


def identify(docs: DataFrame, model: Model, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``key, lang_pred, score, rejected`` for every row."""
    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            names, scores, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                names=["key", "lang_pred", "score", "rejected"])

    out = map_batches(rows, run, f"key {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("key", key)


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    prepare_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: not shared.value.predict(t)[2])

    return docs.where(keep(text_of(text)))
