"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Every run of words of a text that is as long as some item is a window. A window's fingerprint has 64 bits; bit b is set when
the words whose hash has bit b set carry more than half of the window's weight (words of over 3 bytes weigh double). Sliding
sums give all windows of a size from one pass. An item's fingerprint is that of its first ``size`` words; sizes
are the item's own up to 16 words and lie at most an eighth below it beyond, so that a text is not passed over once per
distinct item length.

Search: the 64 bits fall into three blocks. Fingerprints within ``RADIUS`` bits differ in at most 3, 3 and 2 bits in at least
one of the blocks (were it more in each, it would be more than 10 together), so looking up each block of a window
in a table of the items' blocks with so many bits flipped finds every
item within the radius, without exception. Survivors of the full distance are verified: the weighted Jaccard
similarity of the five-word shingles (a shingle weighs as much as its words) of window and item, at least ``THRESHOLD``.

Items edited so far that their fingerprint lies beyond the radius, though their shingles do not, are found without loss as well: a window at
the threshold shares at least one of an item's rarest shingles that together weigh more than the rest may miss. Around each
place of such a shingle the item-sized windows are bounded by the weight of the item's shingles that they hold, and those whose bound
reaches the threshold are compared, best bound first.

Windows that the end of the text clips, down to the shortest that can reach the threshold, have no fingerprint of their size.
A text has fewer of them than the longest item has words, so each item of which a rare shingle stands there is held against all its
windows at the text's end.

The benchmark is the stated query set; it goes to the tasks in blocks of ``ITEM_BLOCK`` items, each of which passes
over the documents once.

Defined results: null or empty texts hold nothing; items with no word match nothing; an item of fewer words than a shingle is
one shingle and matches an equal run of words; every row has its own result, so repeated rows repeat their hits and null
ids stay null; an empty benchmark or table gives no hits; other columns play no role and pass through ``clean`` unchanged.
A document's text is read whole, in pieces that overlap by the longest item.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import map_batches, text_of
from nearfield.llm.words import column_words, shingles

WIDTH = 5
THRESHOLD = 0.75
RADIUS = 10
ITEM_BLOCK = 2_000
_CHUNK = 16384
_BLOCKS = ((0, 21), (21, 21), (42, 22))  # shift and bits
_HELD_BITS = 22
_HELD = np.uint64((1 << _HELD_BITS) - 1)
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int8) * 2 - 1)  # a byte's bits as +1 and -1


def word_weights(sizes: np.ndarray) -> np.ndarray:
    """1 for words of up to 3 bytes, 2 for longer ones."""
    return (1 + (sizes > 3)).astype(np.int8)


def window_size(n: int) -> int:
    """The largest size of the grid 1 .. 16, then steps of an eighth, that is at most n."""
    size = min(n, 16)
    while n > 16 and size + size // 8 <= n:
        size += size // 8
    return size


def fingerprints(hashes: np.ndarray, weights: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(size, first window, fingerprints) for all windows of each size."""
    top = max(sizes)
    # Running sums may wrap around; the difference of two, at most twice the size, may not.
    lane = np.int8 if 2 * top < 128 else np.int16 if 2 * top < 32768 else np.int32
    for low in range(0, len(hashes), _CHUNK):
        h, w = hashes[low:low + _CHUNK + top - 1], weights[low:low + _CHUNK + top - 1].astype(lane)
        sums = np.zeros((len(h) + 1, 64), lane)
        np.multiply(_SIGNS[h.view(np.uint8)].reshape(len(h), 64), w[:, None], out=sums[1:])
        np.cumsum(sums, axis=0, dtype=lane, out=sums)
        for size in sizes:
            n = min(_CHUNK, len(h) - size + 1)
            if n > 0:
                yield size, low, np.packbits(np.subtract(sums[size:size + n], sums[:n]) > 0, axis=1).view(np.uint64).ravel()


def _masks(bits: int, flips: int) -> np.ndarray:
    """All numbers of so many bits with at most ``flips`` of them set."""
    return np.array([sum(1 << i for i in c) for k in range(flips + 1) for c in combinations(range(bits), k)], np.int64)


class BlockTable:
    """The items' values of one block of bits, with up to ``flips`` bits flipped: a table to ask fast, and the items by value."""

    def __init__(self, own: np.ndarray, shift: int, bits: int, flips: int):
        self.shift, self.mask = np.uint64(shift), (1 << bits) - 1
        keys = (self.keys(own)[:, None] ^ _masks(bits, flips)[None, :])
        order = np.argsort(keys.ravel(), kind="stable")
        self.sorted, self.item = keys.ravel()[order], (order // keys.shape[1])
        self.held = np.zeros(1 << bits, bool)
        self.held[self.sorted] = True

    def keys(self, prints: np.ndarray) -> np.ndarray:
        return (prints >> self.shift).view(np.int64) & self.mask

    def maybe(self, prints: np.ndarray) -> np.ndarray:
        return self.held.take(self.keys(prints), mode="clip")

    def pairs(self, prints: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) for the windows ``at``."""
        keys = self.keys(prints[at])
        low = np.searchsorted(self.sorted, keys, "left")
        counts = np.searchsorted(self.sorted, keys, "right") - low
        run = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(at, counts), self.item[np.repeat(low, counts) + run]


class ItemIndex:
    """The items of one block, by window size: fingerprints, block tables, shingles with their weights."""

    def __init__(self, items: list[tuple[int, str]], width: int, radius: int, threshold: float = THRESHOLD):
        import pyarrow as pa

        self.width, self.radius, self.threshold = width, radius, threshold
        self.ids, self.words, self.sets, by_size = [], [], [], {}
        for low, _, hashes, sizes, first in column_words(pa.array([t for _, t in items], pa.string())):
            for i in range(len(first) - 1):
                h, w = hashes[first[i]:first[i + 1]], word_weights(sizes[first[i]:first[i + 1]])
                if len(h):
                    by_size.setdefault(window_size(len(h)), []).append(len(self.ids))
                    self.ids.append(items[low + i][0])
                    self.words.append(len(h))
                    self.sets.append(self.weighted(h, w))
                    self.sets[-1]["print"] = next(fingerprints(h[:window_size(len(h))], w[:window_size(len(h))], [window_size(len(h))]))[2][:1]
        # Allowed flips of the blocks add up to radius - 2: a pair within the radius stays within them in some block.
        flips = [(radius - 2 + n) // 3 for n in (2, 1, 0)]
        self.sizes = {}
        for size, members in sorted(by_size.items()):
            own = np.concatenate([self.sets[m]["print"] for m in members])
            self.sizes[size] = (np.array(members), own, [BlockTable(own, at, bits, f) for (at, bits), f in zip(_BLOCKS, flips)])
        rare = self._rarest()
        order = np.argsort(np.array([s for s, _ in rare], np.uint64), kind="stable")
        self.rare, self.rare_item = np.array([s for s, _ in rare], np.uint64)[order], np.array([m for _, m in rare], np.int64)[order]
        self.held = np.zeros(1 << _HELD_BITS, bool)  # by a shingle's low bits: few places of a text are asked further
        self.held[self.rare & _HELD] = True
        self.bags = [np.array(sorted(own["bag"]), np.uint64) for own in self.sets]
        self.longest = max(self.words, default=0)

    def _rarest(self) -> list[tuple[int, int]]:
        """(shingle, item): of each item the shingles in fewest items, until the rest weighs too little for the threshold. An item
        shorter than a shingle has none: a clipped window cannot equal it."""
        among: dict = {}
        for own in self.sets:
            for s in own["bag"]:
                among[s] = among.get(s, 0) + 1
        out = []
        for m, own in enumerate(self.sets):
            if self.words[m] >= self.width:
                rest = own["all"]
                for s in sorted(own["bag"], key=lambda s: (among[s], s)):
                    if rest < self.threshold * own["all"] - 1e-9:
                        break
                    out.append((s, m))
                    rest -= own["bag"][s]
        return out

    def weighted(self, h: np.ndarray, w: np.ndarray) -> dict:
        """Shingle -> weight, repeats adding up, of a run of words."""
        width = min(self.width, len(h))
        total = np.cumsum(np.concatenate([[0], w.astype(np.int64)]))
        out: dict = {}
        for s, x in zip(shingles(h, width).tolist(), (total[width:] - total[:-width]).tolist()):
            out[s] = out.get(s, 0) + x
        return {"bag": out, "all": sum(out.values())}

    def similarity(self, item: int, h: np.ndarray, w: np.ndarray) -> float:
        window, own = self.weighted(h, w), self.sets[item]
        shared = sum(min(x, own["bag"].get(s, 0)) for s, x in window["bag"].items())
        return shared / (window["all"] + own["all"] - shared)

    def clipped(self, hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """As ``hits``, of the windows that reach the end of their text with at most the item's words."""
        if not len(self.rare) or len(hashes) < self.width:
            return
        runs = shingles(hashes, self.width)
        total = np.cumsum(np.concatenate([[0], weights.astype(np.int64)]))
        heavy = total[self.width:] - total[:-self.width]
        begin = np.maximum(first[:-1], first[1:] - self.longest)
        counts = np.maximum(first[1:] - self.width + 1 - begin, 0)
        at = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        low = np.searchsorted(self.rare, runs[at], "left")
        found = np.searchsorted(self.rare, runs[at], "right") - low
        rows = np.repeat(np.repeat(np.arange(len(counts)), counts), found)
        items = self.rare_item[np.repeat(low - (np.cumsum(found) - found), found) + np.arange(found.sum())]
        for row, member in sorted({*zip(rows.tolist(), items.tolist())}):
            own, bag, shared, everything = self.sets[member], {}, 0, 0
            start, end = int(first[row]), int(first[row + 1])
            for p in range(end - self.width, max(start, end - self.words[member]) - 1, -1):  # the window grows to the left
                s, x = int(runs[p]), int(heavy[p])
                old, most = bag.get(s, 0), own["bag"].get(s, 0)
                bag[s] = old + x
                shared += min(old + x, most) - min(old, most)
                everything += x
                similarity = shared / (everything + own["all"] - shared)
                if similarity >= self.threshold:
                    yield row, member, p - start, end - start, similarity

    def edited(self, hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """As ``hits``: of each row and item the best item-sized window, wherever the fingerprints lie."""
        if not len(self.rare) or len(hashes) < self.width:
            return
        runs = shingles(hashes, self.width)
        at = np.flatnonzero(self.held.take((runs & _HELD).view(np.int64)))
        low = np.searchsorted(self.rare, runs[at], "left")
        found = np.searchsorted(self.rare, runs[at], "right") - low
        items = self.rare_item[np.repeat(low - (np.cumsum(found) - found), found) + np.arange(found.sum())]
        at = np.repeat(at, found)
        rows = np.searchsorted(first, at, "right") - 1
        inside = at + self.width <= first[rows + 1]
        order = np.lexsort((at[inside], items[inside], rows[inside]))
        rows, items, at = rows[inside][order], items[inside][order], at[inside][order]
        if not len(rows):
            return
        total = np.cumsum(np.concatenate([[0], weights.astype(np.int64)]))
        pairs = np.flatnonzero(np.concatenate([[True], (np.diff(rows) != 0) | (np.diff(items) != 0)]))
        for a, z in zip(pairs.tolist(), [*pairs[1:].tolist(), len(rows)]):
            row, member = int(rows[a]), int(items[a])
            best = self._best(member, at[a:z], int(first[row]), int(first[row + 1]), hashes, weights, runs, total)
            if best:
                yield row, member, best[1] - int(first[row]), best[1] + self.words[member] - int(first[row]), best[0]

    def _best(self, member: int, places: np.ndarray, begin: int, end: int, hashes, weights, runs, total) -> tuple[float, int] | None:
        """(similarity, start) of the best window in [begin, end) that holds one of the ``places``, the first of equal ones."""
        n, own, best = self.words[member], self.sets[member], None
        back = n - self.width  # a window that holds a shingle begins at most so far before it
        breaks = np.flatnonzero(np.diff(places) > 2 * back + 1)
        for a, z in zip([0, *(breaks + 1).tolist()], [*breaks.tolist(), len(places) - 1]):
            low, high = max(begin, int(places[a]) - back), min(int(places[z]), end - n)
            if low > high:
                continue
            part = slice(low, high + back + 1)
            heavy = total[low + self.width:high + n + 1] - total[low:high + back + 1]
            bag = self.bags[member]
            held = np.minimum(np.searchsorted(bag, runs[part]), len(bag) - 1)
            sums = np.cumsum(np.concatenate([[0], np.where(bag[held] == runs[part], heavy, 0)]))
            every = np.cumsum(np.concatenate([[0], heavy]))
            shared = np.minimum(sums[back + 1:] - sums[:-back - 1], own["all"])
            bound = shared / (every[back + 1:] - every[:-back - 1] + own["all"] - shared)
            open_ = np.flatnonzero(bound >= (self.threshold if best is None else max(self.threshold, best[0])) - 1e-9)
            for k in open_[np.argsort(-bound[open_], kind="stable")].tolist():
                if best and bound[k] < best[0] - 1e-12:
                    break
                start = low + k
                if best and start >= best[1] and bound[k] <= best[0] + 1e-12:
                    continue
                x = self.similarity(member, hashes[start:start + n], weights[start:start + n])
                if x >= self.threshold and (best is None or (x, -start) > (best[0], -best[1])):
                    best = (x, start)
        return best

    def hits(self, hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, item, first word in the row, word after the last, similarity) of windows that hold an item, the best of each row and
        item among them; ``first`` as in column_words."""
        if not self.sizes or not len(hashes):
            return
        yield from self.clipped(hashes, weights, first)
        yield from self.edited(hashes, weights, first)
        for size, low, prints in fingerprints(hashes, weights, list(self.sizes)):
            members, own, tables = self.sizes[size]
            maybe = np.flatnonzero(tables[0].maybe(prints) | tables[1].maybe(prints) | tables[2].maybe(prints))
            if not len(maybe):
                continue
            pairs = [t.pairs(prints, maybe) for t in tables]
            at, item = (np.concatenate(x) for x in zip(*pairs))
            near = np.bitwise_count(prints[at] ^ own[item]) <= self.radius
            for start, member in sorted({*zip((at[near] + low).tolist(), members[item[near]].tolist())}):
                row = int(np.searchsorted(first, start, "right")) - 1
                if start + size > first[row + 1]:  # a window of the search above
                    continue
                end = min(start + self.words[member], int(first[row + 1]))
                found = self.similarity(member, hashes[start:end], weights[start:end])
                if found >= self.threshold:
                    yield row, member, start - int(first[row]), end - int(first[row]), found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items, a block at a time; the driver never holds more than one block."""
    block = []
    for r in benchmark.select(F.col(id_col).cast("long").alias("i"), text_of(text_col).alias("t")).toLocalIterator():
        block.append((r["i"], r["t"]))
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row per document row and item it holds: doc_id, item_id, similarity (best window), start_word, end_word."""
    schema = "doc_id long, item_id long, similarity double, start_word long, end_word long"
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, item_text):

        def run(batches: Iterator, items=items) -> Iterator:
            import pyarrow as pa

            index = ItemIndex(items, width, radius, threshold)
            for batch in batches:
                best: dict = {}
                for low, _, hashes, sizes, first in column_words(batch.column(1)):
                    for row, item, start, end, found in index.hits(hashes, word_weights(sizes), first):
                        key = (low + row, item)
                        if key not in best or (found, -start) > (best[key][0], -best[key][1]):
                            best[key] = (found, start, end)
                if best:
                    rows = [r for r, _ in best]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(rows)), pa.array([index.ids[i] for _, i in best], pa.int64()),
                        pa.array([f for f, _, _ in best.values()], pa.float64()), pa.array([s for _, s, _ in best.values()], pa.int64()),
                        pa.array([e for _, _, e in best.values()], pa.int64())],
                        ["doc_id", "item_id", "similarity", "start_word", "end_word"])

        out = out.unionByName(map_batches(source, run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged; rows are judged where they are, without a shuffle."""
    for items in _blocks(benchmark, item_col, item_text):

        def run(batches: Iterator, items=items, at=docs.columns.index(text_col)) -> Iterator:
            import pyarrow as pa
            import pyarrow.compute as pc

            index = ItemIndex(items, width, radius, threshold)
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for low, _, hashes, sizes, first in column_words(pc.fill_null(batch.column(at), "")):
                    for row, *_ in index.hits(hashes, word_weights(sizes), first):
                        keep[low + row] = False
                yield batch.filter(pa.array(keep))

        docs = map_batches(docs, run, docs.schema)
    return docs
