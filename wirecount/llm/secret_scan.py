"""Secret scan: patterns propose candidates, a random forest removes the false positives.

Candidates are long runs of key characters, values given to names such as ``password``, quoted
ones with their spaces, and passwords in addresses. The forest looks at their length and make-up, the changes between kinds of characters, how likely
their letter pairs are in ordinary words, how much of them the dictionary covers, the path and
the neighbouring words. It is grown here, in numpy, from labelled findings.

The dictionary is counted over all texts: every word with at least ``SHARE`` of all word
occurrences, so it can have no more than ``1 / SHARE`` words whatever the input.

Defined results: null and empty texts have no findings; a null path is an empty one; equal rows
are reported each; overlapping candidates are one; a candidate is scored whole, however long;
rows without identifier are reported with a null one; other columns are ignored, whatever their
names; an empty table has no findings and an empty dictionary.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wirecount.llm.common import map_batches, prepare_workers, text_of

SHARE, SHORTEST, LONGEST = 1e-5, 3, 12
#: Labelled findings made for training, trees, depth, and the share of votes of a secret.
FINDINGS, TREES, DEPTH, VOTES = 4000, 30, 9, 0.5
MASK = "[secret]"

# Names of secrets, words beside things that only look like one, and prefixes.
NAMES = ("apikey", "auth", "authorization", "bearer", "credential", "credentials", "key",
         "passphrase", "passwd", "password", "pwd", "secret", "token")
INNOCENT = ("checksum", "commit", "digest", "dummy", "example", "fingerprint", "hash", "id",
            "integrity", "md5", "placeholder", "revision", "sample", "sha", "sha1", "sha256",
            "uuid", "your")
PREFIXES = (("aws", "AKIA"), ("aws", "ASIA"), ("github", "ghp_"), ("github", "gho_"),
            ("stripe", "sk_live_"), ("slack", "xoxb-"), ("slack", "xoxp-"), ("jwt", "eyJ"),
            ("google", "AIza"), ("gitlab", "glpat-"))
TEST_PATHS = ("test", "example", "sample", "mock", "fixture", "doc", "vendor", "lock")

RUN = re.compile(r"(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{16,}={0,2}")
#: Short names stand in other words, such as ``author`` and ``monkey``.
_APART = {"auth": r"auth(?-i:(?![a-z]))", "key": r"(?-i:(?<![a-z]))key(?-i:(?![a-z]))"}
NAMED = re.compile(
    r"(?i:" + "|".join(_APART.get(n, n) for n in sorted(NAMES, key=len, reverse=True))
    + r")[A-Za-z0-9_.\-]{0,40}"
    r"[\"']?\s{0,3}(?:[:=]=?|=>)\s{0,3}(?i:(?:bearer|basic|token)\s{1,3})?"
    r"(?P<value>\"[^\"\n]{8,}\"|'[^'\n]{8,}'|[^\s\"']{8,})")
#: A password between user and host of an address.
IN_ADDRESS = re.compile(r"://[^\s/:@]{0,64}:(?P<value>[^\s/@]{4,64})@")
#: A run before a value is its name, and no candidate, with so many digits at most.
NAME_DIGITS = 4
NEAR = re.compile(r"[^\W_]+")
LETTERS = re.compile(r"[a-z]+")
FEATURES = 22


def dictionary(docs: DataFrame, text: str = "text", share: float = SHARE) -> dict[str, int]:
    """Words of 3 to 12 letters by number, those with ``share`` of all such words or more."""
    words = docs.select(F.explode(F.split(F.lower(text_of(text)), r"[^\p{L}]+")).alias("w"))
    counted = words.where(F.length("w").between(SHORTEST, LONGEST)).groupBy("w").agg(
        F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    kept = counted.where((F.col("n") >= share * total) & (F.col("n") > 1))
    return {r["w"]: r["n"] for r in kept.collect()}


@dataclass
class Words:
    """The dictionary, and how likely one letter follows another in it."""

    words: frozenset[str]
    follow: np.ndarray

    @staticmethod
    def of(counts: dict[str, int]) -> Words:
        follow = np.ones((27, 27))
        for word, n in counts.items():
            codes = [min(max(ord(c) - 96, 0), 27) % 27 for c in f" {word} "]
            for a, b in zip(codes, codes[1:]):
                follow[a, b] += n
        return Words(frozenset(counts), np.log(follow / follow.sum(axis=1, keepdims=True)))

    def coverage(self, value: str) -> float:
        """Share of the characters in dictionary words, taken greedily from the left."""
        covered = 0
        for run in LETTERS.findall(value.lower()):
            at = 0
            while at < len(run):
                for n in range(min(LONGEST, len(run) - at), SHORTEST - 1, -1):
                    if run[at:at + n] in self.words:
                        covered += n
                        at += n
                        break
                else:
                    at += 1
        return covered / max(1, len(value))

    def likeness(self, value: str) -> float:
        """Mean log-likelihood of the changes from character to character."""
        codes = np.frombuffer(value.lower().encode("latin-1", "replace"), np.uint8).astype(int)
        codes = np.where((codes >= 97) & (codes <= 122), codes - 96, 0)
        return float(self.follow[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each candidate, in order and without overlaps.

    Named values are looked for apart from runs, as a long name is a run itself.
    """
    spans, names = [], []
    for found in NAMED.finditer(text):
        start, end = found.span("value")
        names.append((found.start(), start))
        if text[start] in "\"'" and text[end - 1] == text[start]:
            start, end = start + 1, end - 1
        spans.append((start, end))
    spans += [found.span("value") for found in IN_ADDRESS.finditer(text)]
    at = 0
    for found in RUN.finditer(text):
        start, end = found.span()
        while at < len(names) and names[at][1] < end:
            at += 1
        if at < len(names) and names[at][0] < end and sum(
                c.isdigit() for c in found.group()) <= NAME_DIGITS:
            continue
        spans.append((start, end))
    last = None
    for start, end in sorted(spans):
        if last and start < last[1]:
            last = (last[0], max(last[1], end))
            continue
        if last:
            yield last
        last = (start, end)
    if last:
        yield last


def kind_of(value: str) -> str:
    for kind, prefix in PREFIXES:
        if value.startswith(prefix):
            return kind
    if re.fullmatch(r"[0-9a-fA-F]+", value):
        return "hex"
    return "key"


def features(text: str, start: int, end: int, path: str, words: Words) -> list[float]:
    value = text[start:end]
    n = len(value)
    counts = Counter(value)
    kinds = [("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s")
             for c in value]
    of = Counter(kinds)
    before = [w.lower() for w in NEAR.findall(text[max(0, start - 60):start])][-4:]
    after = [w.lower() for w in NEAR.findall(text[end:end + 40])][:2]
    left, right = text[max(0, start - 3):start], text[end:end + 1]
    low = path.lower()
    return [
        math.log2(n), of["d"] / n, of["u"] / n, of["l"] / n, of["s"] / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        len(counts) / min(n, 64),
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        max(counts.values()) / n, words.likeness(value), words.coverage(value),
        float(kind_of(value) == "hex"), float(kind_of(value) not in ("hex", "key")),
        value.count("/") + value.count("-") + value.count("_"),
        float(bool(re.search(r"[/.@#]$", left)) or right in ("/", "@")),
        float(any(p in low for p in TEST_PATHS)),
        float(any(w in NAMES for w in before)), float(any(w in INNOCENT for w in before + after)),
        float(bool(re.search(r"[:=]\s*[\"']?$", left))), float(right in ("\"", "'") and right != ""),
        float(right == "@" and bool(re.search(r"://[^\s/:@]*:$", text[max(0, start - 68):start]))),
        value.count(" ") / n,
    ]


@dataclass
class Tree:
    feature: np.ndarray  # -1 at a leaf
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    def votes(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return self.share[at]
            go_low = rows[np.arange(len(rows)), np.maximum(feature, 0)] <= self.limit[at]
            at = np.where(inner, np.where(go_low, self.low[at], self.high[at]), at)


def grow(rows: np.ndarray, secret: np.ndarray, rng: np.random.Generator,
         depth: int = DEPTH, least: int = 3) -> Tree:
    """A tree on a bootstrap sample; each node looks at some of the features."""
    nodes: list[list[float]] = []
    tried = max(1, int(math.sqrt(rows.shape[1])) + 1)

    def best_split(x: np.ndarray, y: np.ndarray) -> tuple[float, int, float] | None:
        best, n = None, len(y)
        for f in rng.choice(x.shape[1], tried, replace=False).tolist():
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            k = cut + 1
            a, b = ones[cut] / k, (ones[-1] - ones[cut]) / (n - k)
            impurity = k * a * (1 - a) + (n - k) * b * (1 - b)
            i = int(impurity.argmin())
            if best is None or impurity[i] < best[0]:
                best = (float(impurity[i]), f, float(v[cut[i]]))
        return best

    def build(picked: np.ndarray, left: int) -> int:
        at, y = len(nodes), secret[picked]
        nodes.append([-1, 0.0, 0, 0, float(y.mean())])
        found = None
        if left and len(picked) >= 2 * least and 0 < y.mean() < 1:
            found = best_split(rows[picked], y)
        if found:
            _, f, limit = found
            low = rows[picked, f] <= limit
            nodes[at][:2] = [f, limit]
            nodes[at][2] = build(picked[low], left - 1)
            nodes[at][3] = build(picked[~low], left - 1)
        return at

    build(rng.integers(0, len(rows), len(rows)), depth)
    f, limit, low, high, share = zip(*nodes)
    return Tree(np.array(f, np.int64), np.array(limit), np.array(low, np.int64),
                np.array(high, np.int64), np.array(share))


@dataclass
class Scanner:
    words: Words
    trees: list[Tree]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sum(t.votes(rows) for t in self.trees) / len(self.trees)

    def findings(self, text: str, path: str = "", votes: float = VOTES
                 ) -> list[tuple[int, int, float]]:
        spans = list(candidates(text))
        if not spans:
            return []
        scores = self.score(np.array([features(text, a, b, path, self.words) for a, b in spans]))
        return [(a, b, float(s)) for (a, b), s in zip(spans, scores) if s >= votes]


def labelled_findings(words: dict[str, int], n: int = FINDINGS, seed: int = 5
                      ) -> list[tuple[str, int, int, str, bool]]:
    """Findings to learn from: text, start, end, path, and whether it is a secret.

    Made by rule around the dictionary's words: keys of the usual forms given to the usual names,
    and what scanners take for them, such as compounds, commit and file hashes, identifiers,
    paths and placeholders.
    """
    rng = np.random.default_rng(seed)
    known = sorted(w for w in words if w.isalpha()) or ["the", "and", "with", "this", "from"]
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every = low + low.upper() + digits

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def draw(alphabet, size):
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), size))

    def prose(size):
        return " ".join(pick(known) + pick(["", "", "", ".", ","]) for _ in range(size))

    def secret():
        form = int(rng.integers(10))
        if form == 9:
            # A sentence that someone keeps in mind, with a number in it.
            return f"{prose(int(rng.integers(2, 5)))} {draw(digits, int(rng.integers(1, 5)))}" \
                + pick(["", "!", "?"])
        if form <= 1:
            return draw("0123456789abcdef", pick([32, 40, 40, 48, 64]))
        if form == 2:
            return draw(every + "+/", pick([32, 40, 44, 64])) + pick(["", "="])
        if form == 3:
            kind, prefix = pick(PREFIXES)
            return prefix + draw(low.upper() + digits if kind == "aws" else every,
                                 16 if kind == "aws" else pick([24, 36, 48]))
        if form == 4:
            return draw(every, pick([20, 24, 32]))
        if form == 5:
            return draw(every + "_-", pick([22, 36, 43]))
        if form == 6:
            return draw(every + "!$%&*", pick([10, 14, 18]))
        if form == 7:
            return draw(low + digits, int(rng.integers(8, 16)))
        # Passwords that people make: words with digits and signs in or behind them.
        value = "".join(pick([pick(known), draw(low, int(rng.integers(3, 7)))])
                        + draw(digits, int(rng.integers(1, 4))) + pick(["", "", "!", "#", "@"])
                        for _ in range(2))
        return (value + draw(digits, 8))[:max(8, min(len(value), 15))]

    def named(value):
        name = pick(["token", "api_key", "secret", "password", "access_token", "auth_token",
                     "API_KEY", "secret_key", "client_secret",
                     "POSTGRES_PASSWORD", "SPRING_DATASOURCE_PASSWORD", "github_access_token",
                     "AWS_SECRET_ACCESS_KEY", "registry_auth_token", "stripe_webhook_secret",
                     "auth", "db_auth", "credential", "credentials", "bearer", "passphrase", "key",
                     "db_pwd", "passwd", "Authorization", "PRIVATE_KEY"])
        quote = pick(['"', "'"] if " " in value else ['"', "'", ""])
        if " " not in value and rng.random() < 0.1:
            return f"{pick(['Authorization', 'authorization', 'auth'])}: " \
                f"{pick(['Bearer', 'bearer', 'Basic', 'Token'])} ", value, ""
        if re.fullmatch(r"[^\s/@]{4,64}", value) and rng.random() < 0.12:
            return f"{pick(['postgres', 'mysql', 'amqp', 'https', 'redis'])}://" \
                f"{pick(['admin', 'root', 'app', '', pick(known)])}:", value, \
                f"@{pick(known)}{pick([':5432', '', '.example.org'])}/{pick(known)}"
        return f"{name}{pick([' = ', '=', ': ', ' : '])}{quote}", value, quote

    def innocent():
        form = int(rng.integers(11))
        if form <= 3:
            value = ""
            while len(value) < int(rng.integers(16, 60)):
                value += pick(known)
            return pick(["", "", "(", '"']), re.sub("[^a-z]", pick("aeiou"), value), pick(
                ["", ".", ","])
        if form == 4:
            return pick(["commit ", "sha256:", "checksum ", "md5 = ", "digest: ", "revision "]), \
                draw("0123456789abcdef", pick([32, 40, 64])), ""
        if form == 5:
            h = draw("0123456789abcdef", 32)
            return pick(["id = ", "uuid: ", ""]), \
                f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}", ""
        if form == 6:
            return pick(["https://", "see /", "./", "http://www."]), "/".join(
                pick(known) for _ in range(int(rng.integers(4, 8)))), pick([".html", "/", ""])
        if form == 7 and rng.random() < 0.3:
            return f"{pick(['http', 'https', 'postgres'])}://{pick(['user', 'admin', 'name'])}:", \
                pick(["password", "pass", "changeme", "yourpassword", "passwd", "xxxxxxxx"]), \
                f"@{pick(['host', 'localhost', pick(known)])}{pick(['', '/x', ':8080'])}"
        if form == 7:
            return named(pick(["your_api_key_here", "xxxxxxxxxxxxxxxxxxxx", "changeme_changeme",
                               "example_secret_value", "00000000000000000000",
                               "placeholder-token-here", "************", "insert-token-here"]))
        if form == 8:
            return pick(["", "| "]), pick("-=_*#ax") * int(rng.integers(16, 80)), ""
        if form == 9 and rng.random() < 0.3:
            return named(prose(int(rng.integers(3, 7))))
        if form == 9:
            return named(pick(["", "get_", "the-"]) + pick(known) + pick(["_", "-", ""])
                         + pick(known) + pick(["", "", "()", ","]))
        return pick(["", "no ", "card "]), draw(digits, pick([16, 18, 20])), ""

    out = []
    while len(out) < n:
        is_secret = bool(len(out) % 2)
        value = secret() if is_secret else ""
        # Keys with a prefix of their own also stand alone.
        alone = kind_of(value) not in ("hex", "key") and rng.random() < 0.6
        head, value, tail = ("", value, "") if alone else named(value) if is_secret else innocent()
        head = pick(["", "", "### ", "| "]) + head
        text, at = f"{prose(int(rng.integers(0, 6)))} {head}", 0
        text, at = text + value + tail, len(text)
        text += pick([" ", "### ", "% ", "\n"]) + prose(int(rng.integers(0, 6)))
        if rng.random() < 0.1:
            text = text.upper() if len(text.upper()) == len(text) else text
        path = pick(["", "", "src3", f"app/{pick(known)}.py"]) if is_secret or rng.random() < 0.7 \
            else f"{pick(TEST_PATHS)}s/{pick(known)}.py"
        spans = [s for s in candidates(text) if s[0] < at + len(value) and s[1] > at]
        out += [(text, a, b, path, is_secret) for a, b in spans[:1]]
        if not spans:
            out.append((text, at, at + len(value), path, is_secret))
    return out[:n]


def train(words: dict[str, int], findings=None, trees: int = TREES, seed: int = 3) -> Scanner:
    """Grow the forest from labelled findings (see ``labelled_findings`` for their form)."""
    known = Words.of(words)
    findings = labelled_findings(words) if findings is None else findings
    rows = np.array([features(t, a, b, path, known) for t, a, b, path, _ in findings])
    secret = np.array([s for *_, s in findings], float)
    rng = np.random.default_rng(seed)
    return Scanner(known, [grow(rows, secret, rng) for _ in range(trees)])


SCHEMA = "doc long, start int, length int, kind string, score double, secret string"


def scan(docs: DataFrame, scanner: Scanner, key: str = "doc_id", text: str = "text",
         path: str | Column | None = None) -> DataFrame:
    """``key, start, length, kind, score, secret`` of every finding; places in code points."""
    where = F.lit("") if path is None else text_of(path)
    rows = docs.select(F.col(key).cast("long").alias("doc"), text_of(text).alias("text"),
                       where.cast("string").alias("path"))
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(doc, a, b - a, kind_of(t[a:b]), s, t[a:b])
                   for doc, t, p in zip(*(c.to_pylist() for c in batch.columns))
                   for a, b, s in shared.value.findings(t, p)]
            if out:
                types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(),
                         pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)],
                    names=["doc", "start", "length", "kind", "score", "secret"])

    return map_batches(rows, run, SCHEMA).withColumnRenamed("doc", key)


def redacted(text: str, spans: list[tuple[int, int, float]]) -> str:
    parts, at = [], 0
    for a, b, _ in spans:
        parts += [text[at:a], MASK]
        at = b
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, scanner: Scanner, text: str = "text",
           path: str | None = None) -> DataFrame:
    """``docs`` with every finding masked, all columns kept; a null text stays null."""
    prepare_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    @F.pandas_udf("string")
    def masked(texts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([
            None if t is None else redacted(t, shared.value.findings(t, p or ""))
            for t, p in zip(texts, paths)], dtype=object)

    where = F.lit("") if path is None else text_of(path)
    return docs.withColumn(text, masked(F.col(text), where.cast("string")))
