"""Vector code compression: a codebook per part of the vector, learned in integer rounds, with exact nearest entries from a GNAT.

A vector of integer components is cut into ``PARTS`` equal consecutive parts; a part is stored as the number of the nearest
entry of its position's codebook (squared Euclidean distance, ties to the lower number). Codebooks start as the parts of the
first vectors by id; a round assigns every part and moves each entry to the componentwise floor of the mean of its parts.

The nearest entry comes from a geometric near-neighbour access tree (GNAT) per codebook. A node has up to ``DEGREE`` split
points, far apart; every other entry hangs below its nearest split point, and for each split point i and child j the node keeps
the range of distances from i to the entries below j. A query at distance d from i, which already knows an entry at distance
b, needs nothing below j if [d - b, d + b] misses that range. The test is strict and widened by more than the rounding of the
square roots, so no nearer or equally near entry is ever lost; distances themselves are compared as integers, then by number.
Queries descend in batches, first those whose nearest split point is the child's own.

Per round, a task sums parts and counts per entry (``PARTS`` x ``ENTRIES`` rows at most), so the shuffle does not grow
with the rows of a task, and the driver sees only codebooks.

Defined results: rows whose vector is null or has a null or non-finite component are dropped; components beyond +-2^24 are held
at that bound; vectors shorter than the longest, and the longest up to a multiple of 16, are padded with zeros; rows of one id
count each (order by id, then vector); a null id comes last, so it seeds a codebook only where there are too few ids; with fewer
rows than entries the codebooks are smaller; an empty table gives an empty result; other columns play no role.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import cut, map_batches
from nearfield.llm.vectors import dimension, integer_vector, matrix

PARTS = 16
ENTRIES = 64
ROUNDS = 2
DEGREE = 8
LEAF = 8
SALTS = 16
_ROUNDING = 2.0 ** -45  # relative; the roots below are right to 2^-52


class Gnat:
    """The tree over the entries of one codebook (an integer matrix, one row per entry)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _squares(self, queries: np.ndarray, members: np.ndarray) -> np.ndarray:
        gap = queries[:, None, :] - self.entries[members][None, :, :]
        return np.einsum("qmd,qmd->qm", gap, gap)

    def _node(self, members: np.ndarray):
        """(members, None) for a leaf, else (splits, [(entries below, low per split, high per split)])."""
        if len(members) <= LEAF:
            return members, None
        picked = [0]
        far = self._squares(self.entries[members], members[:1])[:, 0]
        while len(picked) < DEGREE:
            nxt = int(far.argmax())
            if far[nxt] == 0:  # the rest are copies of split points
                break
            picked.append(nxt)
            far = np.minimum(far, self._squares(self.entries[members], members[nxt:nxt + 1])[:, 0])
        splits = members[picked]
        rest = np.delete(members, picked)
        squares = self._squares(self.entries[rest], splits)
        owner, away = squares.argmin(axis=1), np.sqrt(squares.astype(np.float64))
        below = []
        for j in range(len(splits)):
            own = owner == j
            if own.any():
                below.append((j, self._node(rest[own]), away[own].min(axis=0), away[own].max(axis=0)))
        return splits, below

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each query's nearest entry."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        number = np.full(len(queries), len(self.entries))
        self._descend(self.root, queries, np.arange(len(queries)), best, number)
        return number, best

    def _descend(self, node, queries, active, best, number) -> None:
        members, below = node
        squares = self._squares(queries[active], members)
        least = squares.min(axis=1)
        # The lowest number among the equally near members.
        at = np.where(squares == least[:, None], members[None, :], len(self.entries)).min(axis=1)
        better = (least < best[active]) | ((least == best[active]) & (at < number[active]))
        best[active[better]], number[active[better]] = least[better], at[better]
        if not below:
            return
        away = np.sqrt(squares.astype(np.float64))
        home = squares.argmin(axis=1)
        for own in (True, False):
            for j, child, low, high in below:
                mine = np.flatnonzero((home == j) == own)
                if len(mine):
                    reach, d = np.sqrt(best[active[mine]].astype(np.float64))[:, None], away[mine]
                    slack = (reach + d + high) * _ROUNDING
                    gone = ((d + reach + slack < low) | (d - reach - slack > high)).any(axis=1)
                    mine = mine[~gone]
                if len(mine):
                    self._descend(child, queries, active[mine], best, number)


def _encode(vectors: np.ndarray, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x parts) and the sum of a row's squared distances."""
    width = vectors.shape[1] // len(trees)
    codes, error = np.empty((len(vectors), len(trees)), np.uint8), np.zeros(len(vectors), np.int64)
    for p, tree in enumerate(trees):
        number, square = tree.nearest(vectors[:, p * width:(p + 1) * width])
        codes[:, p] = number
        error += square
    return codes, error


def _totals(rows: DataFrame, books: list[np.ndarray], dim: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> how many parts it is nearest to and their componentwise sum."""
    width = dim // len(books)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        count = np.zeros((len(books), ENTRIES), np.int64)
        total = np.zeros((len(books), ENTRIES, width), np.int64)
        for batch in batches:
            vectors = matrix(batch.column(0), dim)
            codes, _ = _encode(vectors, trees)
            for p in range(len(books)):
                np.add.at(total[p], codes[:, p], vectors[:, p * width:(p + 1) * width])
                count[p] += np.bincount(codes[:, p], minlength=ENTRIES)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
                                          pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    sums = map_batches(rows.select("v"), run, "part int, entry int, n long, s array<bigint>")
    sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"))
    return {(r["part"], r["entry"]): (r["n"], r["s"]) for r in sums.collect()}  # PARTS x ENTRIES rows at most


def _seeds(rows: DataFrame, dim: int) -> list[np.ndarray]:
    """The first codebooks: the parts of the first ENTRIES rows."""
    first = [r["v"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(ENTRIES).collect()]
    table = np.zeros((len(first), dim), np.int64)
    for k, v in enumerate(first):
        table[k, :len(v)] = v
    return np.split(table, PARTS, axis=1)


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): rows have vec_id, label, codes (binary, one byte per part) and error; codebooks are integer matrices, one per
    part, that the codes refer to."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), integer_vector(vector_col).alias("v")).filter(F.col("v").isNotNull())
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    dim = -(-max(1, dimension(rows)) // PARTS) * PARTS
    books = _seeds(rows, dim)
    for _ in range(ROUNDS if len(books[0]) else 0):
        for (p, e), (n, s) in _totals(rows, books, dim).items():
            books[p][e] = [x // n for x in s]  # whole-number division goes down

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        for batch in batches:
            codes, error = _encode(matrix(batch.column(2), dim), trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                                             ["vec_id", "label", "codes", "error"])

    schema = f"vec_id {kinds['vec_id'].simpleString()}, label {kinds['label'].simpleString()}, codes binary, error long"
    return map_batches(rows, run, schema), books


def decode(codes: bytes, books: list[np.ndarray]) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([b[c] for b, c in zip(books, codes)])


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def vector_report(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, code (two hexadecimal digits a part), error, label_error (errors summed over equal labels, nulls together) and the
    digest of the codebooks. The sums per label meet the rows under SALTS salts, so that a hot label is no one task's."""
    coded = cut(rows.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error"))
    part = coded.groupBy("label", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("_s")).agg(F.sum("error").alias("e"))
    sums = part.groupBy("label").agg(F.sum("e").alias("label_error"))
    sums = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")) & (salt == F.col("_salt")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
