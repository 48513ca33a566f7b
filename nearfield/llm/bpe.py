"""Byte-level BPE encoding and decoding by a prefix-sharing trie traversal.

The distinct words (pre-tokens) of a batch are put in byte order: that order is their trie in depth-first order,
because neighbours share their common prefix. Along the path the encoder keeps, for each prefix, the last token of
the prefix's encoding: the one token t that ends there and may stand after the last token of the prefix without t.
A shared prefix is worked out once. "May stand after" holds when merging the bytes of both tokens gives just these two
tokens; it is asked once per pair of tokens and remembered. It is read off the tokens' merge histories: no token along the
right edge of the first, as it grows, may merge with one along the left edge of the second before either is merged further.

Texts equal to a special token's string become that token's id, as the tokenizer file declares; no other special
tokens are added, and truncation and padding play no role.

Defined results: null text is the empty text (no ids, empty decoded text); texts are worked on whole, whatever their
length; repeated rows each give a row; null ids stay null; an empty table gives an empty result; other columns play no
role. The caches are bounded by ``CACHE_WORDS`` and ``CACHE_PAIRS``; they change the time, never the result.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import map_batches, text_of

CACHE_WORDS = 200_000
CACHE_PAIRS = 1_000_000
BATCH_CHARS = 4_000_000
# Fixed value: the word pattern of the byte-level tokenizers.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OUTPUTS = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes for themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class TrieEncoder:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {as_bytes(s): i for s, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.ids.items()}
        self.merged: dict[int, int] = {}     # pair of ids -> rank and id of the merged token, as one number
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (as_bytes(x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self.merged[self.ids[a] << 20 | self.ids[b]] = rank << 20 | self.ids[a + b]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.split = regex.compile(WORD_PATTERN).findall
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.uncut = re.compile(r" (?=\s|\Z)").search
        self._grow_trie()
        self._read_histories()
        self.known = {s: (i,) for s, i in self.special.items()}
        self.pieces: dict[str, tuple] = {}
        self.after: dict[str, tuple] = {}    # the same for pieces after a blank, which the key leaves out
        self.older: dict[str, tuple] = {}    # what ``after`` held before
        self.pairs: dict[int, bool] = {}

    def _merge(self, data: bytes) -> list[int]:
        """Plain merging by rank; only ever asked about one or two tokens' bytes."""
        parts = [self.ids[data[n:n + 1]] for n in range(len(data))]
        while True:
            best = at = None
            for n in range(len(parts) - 1):
                got = self.merged.get(parts[n] << 20 | parts[n + 1])
                if got is not None and (best is None or got < best):
                    best, at = got, n
            if best is None:
                return parts
            parts[at:at + 2] = [best & 0xFFFFF]

    def _grow_trie(self) -> None:
        """The vocabulary's trie: ``step`` leads from node << 8 | byte to the next node, ``fail`` from a node to that of its longest proper
        end which the trie holds, and ``ends`` gives the tokens that a node's bytes end with, longest first, each with its size."""
        self.step: dict[int, int] = {}
        token, nodes = [-1], [[]]  # nodes: by depth, each with its parent and last byte
        for data, i in self.ids.items():
            node = 0
            for depth, byte in enumerate(data, 1):
                key = node << 8 | byte
                up, node = node, self.step.get(key, 0)
                if not node:
                    node = self.step[key] = len(token)
                    token.append(-1)
                    if depth == len(nodes):
                        nodes.append([])
                    nodes[depth].append((node, up, byte))
            token[node] = i
        self.fail, self.ends = [0] * len(token), [()] * len(token)
        for depth, level in enumerate(nodes):
            for node, up, byte in level:
                end = 0
                if up:
                    end = self.fail[up]
                    while (end << 8 | byte) not in self.step:  # the root has a step for every byte
                        end = self.fail[end]
                    end = self.step[end << 8 | byte]
                self.fail[node] = end
                self.ends[node] = ((token[node], depth), *self.ends[end]) if token[node] >= 0 else self.ends[end]
        self.single = [token[self.step[b]] for b in range(256)]

    def _read_histories(self) -> None:
        """``made``: token -> (rank, left, right) of the one merge that makes it. Files in which two merges make one token, or a merge comes
        before those that make its parts, have no such histories (None); pairs are then merged byte by byte."""
        made: dict[int, tuple[int, int, int]] | None = {}
        for pair, rank_id in self.merged.items():
            token = rank_id & 0xFFFFF
            if token in made:
                made = None
                break
            made[token] = rank_id >> 20, pair >> 20, pair & 0xFFFFF
        if made and any(made[x][0] >= rank for rank, a, b in made.values() for x in (a, b) if x in made):
            made = None
        self.made = made
        self.edges: dict[int, tuple] = {}

    def _whole(self, token: int) -> bool:
        """Merging the token's bytes gives the token."""
        key = -2 << 20 | token
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.pairs[key] = self._merge(self.bytes_of[token]) == [token]
        return ok

    def _edge(self, token: int, side: int) -> tuple:
        """((token, rank of the merge that takes it up), ...) from a single byte up to the token itself, along its left (1) or right (2) edge."""
        key = token << 2 | side
        edge = self.edges.get(key)
        if edge is None:
            up, edge = 1 << 40, ()
            while True:
                edge = ((token, up), *edge)
                if token not in self.made:
                    break
                up, token = self.made[token][0], self.made[token][side]
            self.edges[key] = edge
        return edge

    def _stay_apart(self, before: int, token: int) -> bool:
        """Merging the bytes of both tokens, each whole by itself, gives the two of them. Of equal ranks the merge further left comes first."""
        if self.made is None:
            return self._merge(self.bytes_of[before] + self.bytes_of[token]) == [before, token]
        left, right = self._edge(before, 2), self._edge(token, 1)
        i = j = 0
        while True:
            (a, a_up), (b, b_up) = left[i], right[j]
            got = self.merged.get(a << 20 | b)
            if got is not None and got >> 20 < a_up and got >> 20 <= b_up:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if a_up <= b_up:
                i += 1
            else:
                j += 1

    def _may_follow(self, before: int, token: int) -> bool:
        """before -1: the token opens the word."""
        key = before << 20 | token
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.pairs[key] = self._whole(token) and (before < 0 or self._stay_apart(before, token))
        return ok

    def encode_words(self, words: set[str]) -> dict[str, tuple]:
        """The words' tokens; one depth-first walk over the trie of the words."""
        step, fail, ends, single, pairs, follow, made = self.step.get, self.fail, self.ends, self.single, self.pairs.get, self._may_follow, {}
        path, last, size, nodes = b"", [-1], [0], [0]
        # For path[:i]: last[i] the last token of its encoding, size[i] that token's bytes, nodes[i] the vocabulary trie's node of the
        # longest end of path[:i] which is the start of some token.
        for word in sorted(words):  # the order of code points is that of their UTF-8 bytes
            data = word.encode()
            n, top = 0, min(len(path), len(data))
            if path[:top] == data[:top]:
                n = top
            else:
                while path[n] == data[n]:
                    n += 1
            del last[n + 1:], size[n + 1:], nodes[n + 1:]
            node, at = nodes[n], n
            for byte in data[n:]:
                here = step(node << 8 | byte)
                while here is None:
                    node = fail[node]
                    here = step(node << 8 | byte)
                node = here
                at += 1
                for token, taken in ends[node]:
                    before = last[at - taken]
                    ok = pairs(before << 20 | token)
                    if ok if ok is not None else follow(before, token):
                        break
                else:  # the byte itself
                    token, taken = single[byte], 1
                last.append(token)
                size.append(taken)
                nodes.append(node)
            path = data
            out, at = [], len(data)
            while at:
                out.append(last[at])
                at -= size[at]
            made[word] = tuple(out[::-1])
        return made

    def words(self, text: str) -> list[str]:
        """The text's words; special tokens' strings stand as words of their own."""
        if not any(s in text for s in self.special):
            return self.split(text)
        out = []
        for part in self.marks.split(text):
            out += [part] if part in self.special else self.split(part)
        return out

    def _learn(self, pieces: set[str], into: dict, blank: str) -> None:
        """Encodes blank + piece, a run of words, for every piece not seen yet; only pieces without a blank before them may hold a
        special token's string. Letters alone are one word."""
        new = pieces - into.keys()
        plain = {p for p in new if p.isalpha()}
        split = self.split if blank else self.words
        mixed = {p: split(blank + p) for p in new - plain}
        made = self.encode_words({blank + p for p in plain}.union(*mixed.values()) - self.known.keys())
        special = self.known
        for p in plain:
            into[p] = made[blank + p]
        for p, words in mixed.items():
            into[p] = tuple(chain.from_iterable([made[w] if w in made else special[w] for w in words]))

    def encode_batch(self, texts: list[str]) -> list[array]:
        # A blank before a non-blank always opens a word, so texts may be cut there and the pieces looked up
        # one by one; texts with other blanks at blanks, or special tokens, are cut into words only.
        heads, tails = [], []
        for text in texts:
            if self.uncut(text) or any(s in text for s in self.special):
                heads.append(self.words(text))
                tails.append(())
            else:
                first, *rest = text.split(" ")
                heads.append([first])
                tails.append(rest)
        if len(self.pieces) > CACHE_WORDS:
            self.pieces.clear()
        if len(self.after) > CACHE_WORDS:  # those met again since then are taken back
            self.older, self.after = self.after, {}
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        self._learn(set().union(*heads), self.pieces, "")
        met = set().union(*tails)
        self.after.update((p, self.older[p]) for p in met & self.older.keys())
        self._learn(met, self.after, " ")
        piece, after = self.pieces.__getitem__, self.after.__getitem__
        return [array("I", list(chain(chain.from_iterable(map(piece, head)), chain.from_iterable(map(after, tail)))))
                for head, tail in zip(heads, tails)]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    """One encoder per worker process and file."""
    return TrieEncoder(path)


def _little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def bpe_table(docs: DataFrame, vocabulary: str, outputs=("ids", "decoded"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the outputs asked for (see OUTPUTS); ``vocabulary`` is the path of a tokenizer file that every worker can read."""
    outputs = tuple(outputs)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder = encoder(vocabulary)
        types = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded": pa.string(), "decoded_sha256": pa.string()}
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= BATCH_CHARS):
                    chars += len(texts[end])
                    end += 1
                made = {k: [] for k in outputs}
                for ids in coder.encode_batch(texts[at:end]):
                    text = coder.decode(ids) if "decoded" in made or "decoded_sha256" in made else ""
                    for k, out in made.items():
                        out.append(list(ids) if k == "ids" else len(ids) if k == "n_tokens" else text if k == "decoded"
                                   else hashlib.sha256(_little(ids) if k == "ids_sha256" else text.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *(pa.array(made[k], types[k]) for k in outputs)], ["doc_id", *outputs])
                at = end

    schema = ", ".join(["doc_id long", *(f"{k} {OUTPUTS[k]}" for k in outputs)])
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), run, schema)
