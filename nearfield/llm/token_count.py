"""Greedy word-piece counts with a linear longest-match automaton.

The vocabulary is a trie over bytes. Each state has a failure link and a count of popped tokens: reading a byte for which
a state has no edge, the automaton emits the greedy pieces that surely start the matched string (only their number is
kept), goes to the state of what is left, and tries again. A word's length in pieces falls out after one pass over its
bytes, without a piece being built.

Words are the runs of non-blank bytes (ASCII blanks), each read with one blank before it. A word's first piece comes from the
word-initial vocabulary, the tokens with the leading blank, the rest from the continuation vocabulary, those without.
A word with a byte that no piece covers counts as one unknown token.

Defined results: null or empty text: no words, no tokens; texts are read whole; repeated rows each give a row; null ids stay
null; an empty table gives an empty result; other columns play no role. The cache of counted words is bounded by
``CACHE_WORDS``; it changes the time, never the result.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.bpe import byte_letters
from nearfield.llm.common import map_batches, text_of

CACHE_WORDS = 500_000
_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


class LongestMatch:
    """The automaton of word-initial and continuation pieces (bytes)."""

    INITIAL, REST = 0, 1  # the two roots

    def __init__(self, initial, rest):
        self.edges: list[dict[int, int]] = [{}, {}]
        self.fail = [-1, -1]
        self.popped = [0, 0]
        final: list[bool] = [False, False]
        for root, pieces in ((self.INITIAL, initial), (self.REST, rest)):
            for piece in pieces:
                at = root
                for b in piece:
                    to = self.edges[at].get(b)
                    if to is None:
                        to = self.edges[at][b] = len(self.edges)
                        self.edges.append({})
                        self.fail.append(-1)
                        self.popped.append(0)
                        final.append(False)
                    at = to
                final[at] = bool(piece) or final[at]
        # Breadth first: a state that is a piece pops itself and goes on from the continuation root; any other state pops
        # what its parent would pop until an edge for its last byte is found.
        queue = deque([self.INITIAL, self.REST])
        while queue:
            at = queue.popleft()
            for b, to in self.edges[at].items():
                if final[to]:
                    self.fail[to], self.popped[to] = self.REST, 1
                else:
                    link, count = self.fail[at], self.popped[at]
                    while link >= 0 and b not in self.edges[link]:
                        count += self.popped[link]
                        link = self.fail[link]
                    if link >= 0:
                        self.fail[to], self.popped[to] = self.edges[link][b], count
                queue.append(to)

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match split; 1 if some byte stays uncovered, 0 for the empty word."""
        edges, fail, popped = self.edges, self.fail, self.popped
        at, total = self.INITIAL, 0
        for b in word:
            while (to := edges[at].get(b)) is None:
                total += popped[at]
                at = fail[at]
                if at < 0:
                    return 1
            at = to
        while at != self.REST and word:
            total += popped[at]
            at = fail[at]
            if at < 0:
                return 1
        return total


@lru_cache(maxsize=2)
def automaton(path: str) -> LongestMatch:
    """The automaton of a byte-level tokenizer file: pieces with the leading blank start a word."""
    letters = byte_letters()
    with open(path, encoding="utf-8") as f:
        pieces = [bytes(letters[c] for c in s) for s in json.load(f)["model"]["vocab"]]
    return LongestMatch([p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "])


class _Counts(dict):
    def __init__(self, count):
        self.count = count

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self[word] = self.count(b" " + word.encode())
        return n


@lru_cache(maxsize=2)
def _counts(path: str) -> _Counts:
    return _Counts(automaton(path).count)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens of each text; ``vocabulary`` is the path of a tokenizer file that every worker can read."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = _counts(vocabulary)
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column(1):
                words = _WORDS(text.as_py())
                n_words.append(len(words))
                n_tokens.append(sum(map(counts.__getitem__, words)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), run, "doc_id long, n_words long, n_tokens long")
