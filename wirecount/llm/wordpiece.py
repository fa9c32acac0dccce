"""Token counts by greedy longest match, in time linear in the text.

The vocabulary is a trie with a failure link and the number of popped tokens at every node: when
no edge goes on, the link leads to where matching continues after the tokens that are then
certain, and only their number is kept. No piece is ever built and no character is read twice.

Words and single signs are counted one by one; a worker remembers the counts of words it met.

Defined results: a word that pieces cannot make up is one unknown token; null is an empty text
with no tokens; equal rows are counted alike and all returned; other columns are ignored,
whatever their names; an empty table gives an empty result; an empty vocabulary makes every word
unknown.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wirecount.llm.bpe import byte_letters
from wirecount.llm.common import map_batches, text_of

WORD = re.compile(r"\w+|[^\w\s]")
#: Words whose counts a worker remembers before it starts anew.
REMEMBERED = 1_000_000


class Automaton:
    """Trie of ``first`` pieces, which begin a word, and ``later`` ones, which go on."""

    def __init__(self, first: Iterable[str], later: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        self.start, self.onward = 0, 1
        whole = [False, False]
        for root, pieces in ((self.start, first), (self.onward, later)):
            for piece in pieces:
                at = root
                for c in piece:
                    nodes = self.edges[at]
                    if c not in nodes:
                        nodes[c] = len(self.edges)
                        self.edges.append({})
                        whole.append(False)
                    at = nodes[c]
                if piece:
                    whole[at] = True
        n = len(self.edges)
        #: -1: matching fails here.
        self.link, self.popped = [-1] * n, [0] * n
        queue = deque((self.start, self.onward))
        while queue:
            u = queue.popleft()
            for c, v in self.edges[u].items():
                queue.append(v)
                if whole[v]:
                    self.link[v], self.popped[v] = self.onward, 1
                    continue
                z, count = self.link[u], self.popped[u]
                while z >= 0 and c not in self.edges[z]:
                    count += self.popped[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[v], self.popped[v] = self.edges[z][c], count

    def count(self, word: str) -> int:
        """Tokens of a word; 0 if it cannot be made up of pieces."""
        edges, link, popped = self.edges, self.link, self.popped
        u, count = self.start, 0
        for c in word:
            while c not in edges[u]:
                count += popped[u]
                u = link[u]
                if u < 0:
                    return 0
            u = edges[u][c]
        while u != self.onward:
            count += popped[u]
            u = link[u]
            if u < 0:
                return 0
        return count


def word_pieces(pieces: Iterable[str], mark: str = "##") -> tuple[list[str], list[str]]:
    """First and later pieces of a vocabulary that marks the later ones."""
    pieces = list(pieces)
    return ([p for p in pieces if not p.startswith(mark)],
            [p[len(mark):] for p in pieces if p.startswith(mark) and p != mark])


def byte_pieces(path: str) -> list[str]:
    """Pieces of a byte-level vocabulary file, in its own letters, without special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens") or []}
    return [p for p in spec["model"]["vocab"] if p not in special]


class _Counts(dict):
    def __init__(self, automaton: Automaton, letters: list[str] | None):
        super().__init__()
        self.automaton, self.letters = automaton, letters

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        form = word
        if self.letters:
            # Every word is taken as standing behind a space, as in running text.
            form = "".join(map(self.letters.__getitem__, b" " + word.encode()))
        count = self[word] = self.automaton.count(form)
        return count


def token_counts(docs: DataFrame, first: list[str], later: list[str], bytewise: bool = False,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_tokens, n_unknown``; ``bytewise``: pieces are in byte-level letters."""
    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((first, later))
    letters = [c for _, c in sorted(byte_letters().items())] if bytewise else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            if counts is None:
                counts = _Counts(Automaton(*shared.value), letters)
            words, tokens, unknown = [], [], []
            for t in batch.column(1).to_pylist():
                found = list(map(counts.__getitem__, WORD.findall(t)))
                missing = found.count(0)
                words.append(len(found))
                tokens.append(sum(found) + missing)
                unknown.append(missing)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (words, tokens, unknown))],
                names=["key", "n_words", "n_tokens", "n_unknown"])

    return map_batches(rows, run, f"key {kind}, n_words long, n_tokens long, n_unknown long"
                       ).withColumnRenamed("key", key)
