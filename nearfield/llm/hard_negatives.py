"""Hard negatives: rows of other labels whose score lies in a window below that of an anchor's nearest rows of its own label.

Scores are inner products of integer vectors. Anchors are a stated query set; they meet all rows in blocks of ``BLOCK`` anchors:
one block at a time goes to the tasks, which read the table where it lies, so no row is shuffled and neither driver nor task holds
more than a block. A task multiplies tiles of anchors and candidates by Strassen's recursion: seven products of half-size
blocks in place of eight, padded with zeros to even sizes, all in int64. Additions and products wrap modulo 2^64, so the result is
exact whenever the score itself fits (components are held within 2^24: up to 2^14 components).

A block takes two passes. The first keeps, per anchor, a heap of the ``POSITIVES`` best rows of its label; the second, per anchor
and positive, a heap of the ``NEGATIVES`` best rows of other labels inside the positive's window. Heaps merge: a task
merges its tiles, and a window function with a limit merges the tasks. Each block's rows are written to the shared folder.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part; shorter vectors are
padded with zeros; components beyond +-2^24 are held at that bound; rows of the anchor's own id are neither its positives nor its
negatives; repeated rows count each, and so do anchors of one id; an anchor without a positive, and a positive without a
negative in its window (always so for a positive score below 0), give no rows; an empty table gives an empty result; other columns
play no role.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfield.llm.common import cut, map_batches
from nearfield.llm.vectors import dimension, integer_vector, matrix
from nearfield.session import work_dir

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
BLOCK = 8192        # anchors on the driver and in a task at a time: 4 MB at 64 components
ANCHOR_TILE = 512
CANDIDATE_TILE = 4096
STRASSEN_LEAF = 32  # products with a side of at most so many are worked out plainly


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices (rows are vectors on both sides)."""
    m, k, n = len(a), a.shape[1], len(b)
    if min(m, k, n) <= STRASSEN_LEAF:
        return np.einsum("ik,jk->ij", a, b)
    if m % 2 or k % 2 or n % 2:
        return strassen(np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, n % 2), (0, k % 2))))[:m, :n]
    i, l, j = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :l], a[:i, l:], a[i:, :l], a[i:, l:]
    b11, b21, b12, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]  # blocks of b.T, each kept transposed
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    out = np.empty((m, n), np.int64)
    out[:i, j:] = m3 + m5
    out[i:, :j] = m2 + m4
    out[:i, :j] = m1 + m4 - m5 + strassen(a12 - a22, b21 + b22)
    out[i:, j:] = m1 + m3 - m2 + strassen(a21 - a11, b11 + b12)
    return out


class Heap:
    """The best ``size`` (score, id) pairs seen so far: high scores first, ties by smaller id."""

    __slots__ = ("size", "score", "id")

    def __init__(self, size: int):
        self.size, self.score, self.id = size, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self, floor: int) -> int:
        """The least score that may still enter."""
        return max(floor, int(self.score[-1])) if len(self.score) == self.size else floor

    def merge(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        best = np.lexsort((ids, -score))[:self.size]
        self.score, self.id = score[best], ids[best]


class Block:
    """A block of anchors: numbers within the block, ids, labels and vectors; windows once the positives are known."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.windows: list[list[tuple[int, int, int, int]]] = [[] for _ in ids]  # (positive id, its score, least, most) by rank


def _tiles(batches: Iterator, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(labels, ids, vectors) of about CANDIDATE_TILE rows, ordered by label."""
    held, rows = [], 0

    def joined():
        labels, ids, vectors = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(labels, kind="stable")
        return labels[order], ids[order], vectors[order]

    for batch in batches:
        held.append((batch.column(1).to_numpy(), batch.column(0).to_numpy(), matrix(batch.column(2), dim)))
        rows += batch.num_rows
        if rows >= CANDIDATE_TILE:
            yield joined()
            held, rows = [], 0
    if rows:
        yield joined()


def _scored(batches: Iterator, block: Block, dim: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, int]]:
    """(anchor, scores of a tile, ids of the tile, first and end of the rows of the anchor's label)."""
    for labels, ids, vectors in _tiles(batches, dim):
        low = np.searchsorted(labels, block.labels, "left")
        high = np.searchsorted(labels, block.labels, "right")
        for at in range(0, len(block.ids), ANCHOR_TILE):
            scores = strassen(block.vectors[at:at + ANCHOR_TILE], vectors)
            for n in range(len(scores)):
                yield at + n, scores[n], ids, int(low[at + n]), int(high[at + n])


def _positives(rows: DataFrame, block: Block, dim: int, k: int) -> list:
    """(anchor, rank, positive_id, positive_score): at most k for each anchor of the block."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(block)  # a block, at most BLOCK anchors

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        block = sent.value
        heaps = [Heap(k) for _ in block.ids]
        lowest = np.iinfo(np.int64).min
        for a, score, ids, low, high in _scored(batches, block, dim):
            score, ids = score[low:high], ids[low:high]
            new = np.flatnonzero((score >= heaps[a].least(lowest)) & (ids != block.ids[a]))
            if len(new):
                heaps[a].merge(score[new], ids[new])
        sizes = [len(h.id) for h in heaps]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(heaps)), sizes), pa.int64()), pa.array(np.concatenate([h.id for h in heaps])),
                                              pa.array(np.concatenate([h.score for h in heaps]))], ["anchor", "positive_id", "positive_score"])

    heaps = map_batches(rows, run, "anchor long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    got = heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).collect()  # at most k rows an anchor of the block
    sent.destroy()
    return sorted(got, key=lambda r: (r["anchor"], r["rank"]))


def _negatives(rows: DataFrame, block: Block, dim: int, k: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the block's windows."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        block = sent.value
        heaps = {(a, p): Heap(k) for a, w in enumerate(block.windows) for p in range(len(w))}
        for a, score, ids, low, high in _scored(batches, block, dim):
            if not block.windows[a]:
                continue
            ends = [(heaps[a, p].least(least), most) for p, (_, _, least, most) in enumerate(block.windows[a])]
            fits = (score >= min(x for x, _ in ends)) & (score <= max(x for _, x in ends)) & (ids != block.ids[a])
            fits[low:high] = False
            new = np.flatnonzero(fits)
            if not len(new):
                continue
            score, ids = score[new], ids[new]
            for p, (least, most) in enumerate(ends):
                inside = (score >= least) & (score <= most)
                if inside.any():
                    heaps[a, p].merge(score[inside], ids[inside])
        out = [(a, p, *block.windows[a][p][:2], h) for (a, p), h in heaps.items() if len(h.id)]
        if out:
            sizes = [len(h.id) for *_, h in out]
            spread = lambda x: pa.array(np.repeat(np.array(x, np.int64), sizes))
            yield pa.RecordBatch.from_arrays(
                [spread([a for a, *_ in out]), spread([p for _, p, *_ in out]), spread([block.ids[a] for a, *_ in out]), spread([i for _, _, i, *_ in out]),
                 spread([s for *_, s, _ in out]), pa.array(np.concatenate([h.id for *_, h in out])), pa.array(np.concatenate([h.score for *_, h in out]))],
                ["anchor", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    heaps = map_batches(rows, run, "anchor long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def hard_negatives(df: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives of the rows that ``is_anchor`` marks
    (a condition on the columns of ``df``), with ``label`` in place of the label column if given."""
    spark = df.sparkSession
    own = F.col(label_col) if label is None else label
    marked = df.select(F.col(id_col).cast("long").alias("vec_id"), own.cast("long").alias("label"), integer_vector(vector_col).alias("v"), is_anchor.alias("is_anchor"))
    marked = marked.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    rows = marked.select("vec_id", "label", "v")
    dim = max(1, dimension(rows))
    asked = marked.filter("is_anchor").select("vec_id", "label", "v")
    count = asked.count()
    blocks = -(-count // block)
    base = work_dir(spark, f"hard-negatives-{uuid.uuid4().hex}")
    if blocks:  # dealt out evenly; a partition is a block
        asked = cut(asked.repartition(blocks)).withColumn("_block", F.shiftright(F.monotonically_increasing_id(), 33))
    for b in range(blocks):
        some = asked.filter(F.col("_block") == b).drop("_block").toArrow().combine_chunks()  # one block
        made = Block(some["vec_id"].to_numpy(), some["label"].to_numpy(), matrix(some["v"], dim))
        for r in _positives(rows, made, dim, positives):
            s = r["positive_score"]
            made.windows[r["anchor"]].append((r["positive_id"], s, -(-low_percent * s // 100), high_percent * s // 100))
        _negatives(rows, made, dim, negatives).write.parquet(f"{base}/block={b}")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(schema).parquet(*[f"{base}/block={b}" for b in range(blocks)]) if blocks else spark.createDataFrame([], schema)
