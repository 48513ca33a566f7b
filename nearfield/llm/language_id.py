"""Language identification: averaged hashed subword embeddings with a linear softmax, and calibrated rejection.

A text's subwords are the runs of 2, 3 and 4 bytes of its lower-case text, in which every run of ASCII characters other than letters
is one blank, with a blank at both ends. Each subword has the embedding of its hash bucket; a text is the mean of its subwords'
embeddings, and a linear layer with softmax gives the languages' probabilities. Embeddings and layer are trained together by
stochastic gradient descent in numpy on the driver. As mean and layer are both linear, tasks score with one table of
bucket x language values.

Training takes a bounded sample: up to ``PER_LANG`` rows of a language by a hash of the id, ``SAMPLE_ROWS`` in all, evenly over the
languages; a row goes to the driver as its bucket frequencies (at most ``BUCKETS``, 6 bytes each). A fifth of the sample is
left out of the descent and calibrates the probabilities (temperature) and the rejection: the least probability at and above which at
most ``MAX_ERROR`` of these rows are wrong. A text below it is not ``accepted``; its likeliest language is still named.

Defined results: null text, text without a letter and everything where no language could be learned: 'und', score 0, not accepted;
texts are read whole; rows with a null id, and those ``learn`` does not mark, are not learned from, nor is a text without a letter; repeated rows each give a
row and count once in training; an empty table gives an empty result; other columns play no role.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfield.llm.common import map_batches, text_of
from nearfield.llm.words import mix

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
DIM = 16
PER_LANG = 1000
SAMPLE_ROWS = 4000
EPOCHS = 6
RATE = 2.0
MAX_ERROR = 0.01
SALTS = 32
PIECE = 1 << 20  # subwords worked on at a time
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = np.arange(97, 123)


def subwords(body: np.ndarray) -> Iterator[np.ndarray]:
    """The buckets of a lower-case text's subwords (bytes of UTF-8), in pieces."""
    edge = np.full(1, 32, np.uint8)
    data = np.concatenate([edge, _LETTER[body], edge])
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    data = data[keep]
    for at in range(0, len(data), PIECE):
        piece = data[at:at + PIECE + SIZES[-1] - 1].astype(np.uint64)
        for size in SIZES:
            n = min(PIECE, len(piece) - size + 1)
            if n > 0:
                run = np.full(n, size, np.uint64)
                for k in range(size):
                    run = run << np.uint64(8) | piece[k:k + n]
                yield (mix(run) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _bodies(column) -> Iterator[np.ndarray]:
    """The bytes of each text of an Arrow column without nulls."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield data[a:b]


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0)))  # bucket x language
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, body: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(self.languages)), 0
        for buckets in subwords(body):
            total += self.table[buckets].sum(axis=0)
            count += len(buckets)
        return softmax((total / max(1, count) + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _readable(text_col: str) -> Column:
    """The text has a letter."""
    return F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))


def _sample(docs: DataFrame, learn: Column, per_lang: int, rows: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text): the bounded sample, one row per language and id."""
    known = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & _readable(text_col) & learn)
    ids = known.select(F.col(lang_col).alias("lang"), F.col(id_col).cast("long").alias("doc_id")).distinct()
    order = [F.xxhash64("doc_id"), "doc_id"]
    first = lambda df, *keys: (df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
                               .filter(F.col("place") <= per_lang))
    # A language may hold most rows, so its first ids are found under salts before they meet.
    few = first(ids.withColumn("_salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS))), "lang", "_salt").drop("_salt", "place")
    picked = first(few, "lang").orderBy("place", *order, "lang").limit(rows).drop("place")  # at most ``rows`` ids, so they may be broadcast
    texts = known.select(F.col(lang_col).alias("lang"), F.col(id_col).cast("long").alias("doc_id"), F.lower(F.col(text_col)).alias("text"))
    return texts.join(F.broadcast(picked), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.max("text").alias("text"))


def _descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_lang: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, layer and bias by stochastic gradient descent; the rate falls linearly to 0."""
    emb, layer, bias = rng.normal(0, 1 / np.sqrt(DIM), (BUCKETS, DIM)), np.zeros((n_lang, DIM)), np.zeros(n_lang)
    step, steps = 0, EPOCHS * len(rows)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, share = rows[i]
            rate = RATE * (1 - step / steps)
            mean = share @ emb[at]
            off = softmax(layer @ mean + bias)
            off[y[i]] -= 1
            back = layer.T @ off
            layer -= rate * np.outer(off, mean)
            bias -= rate * off
            # The mean has small shares; each subword moves by the whole step of the mean, as the shares' squares would fade it.
            emb[at] -= rate * np.outer(share / share.max(), back)
            step += 1
    return emb, layer, bias


def fit(docs: DataFrame, learn: Column, per_lang: int = PER_LANG, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> LanguageModel:
    """Learns from the rows that ``learn`` marks."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at, share = [], []
            for body in _bodies(batch.column(2)):
                count = np.zeros(BUCKETS)
                for buckets in subwords(body):
                    count += np.bincount(buckets, minlength=BUCKETS)
                some = np.flatnonzero(count)
                at.append(some.astype("<u2").tobytes())
                share.append((count[some] / max(1.0, count.sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.binary()), pa.array(share, pa.binary())], ["lang", "doc_id", "at", "share"])

    sample = _sample(docs, learn, per_lang, rows, id_col, text_col, lang_col).select("lang", "doc_id", "text")
    got = map_batches(sample, run, "lang string, doc_id long, at binary, share binary").collect()  # bounded by the sample
    got.sort(key=lambda r: (r["lang"], r["doc_id"]))
    names = sorted({r["lang"] for r in got})
    if not names:
        return LanguageModel()
    x = [(np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["share"], "<f4").astype(np.float64)) for r in got]
    y = np.array([names.index(r["lang"]) for r in got])
    rng = np.random.default_rng(11)
    order = rng.permutation(len(x))
    aside = order[:len(x) // 5] if len(x) >= 20 else order[:0]
    train = np.setdiff1d(order, aside)
    emb, layer, bias = _descend([x[i] for i in train], y[train], len(names), rng)
    model = LanguageModel(names, emb @ layer.T, bias)
    if len(aside):
        z = np.array([x[i][1] @ model.table[x[i][0]] + bias for i in aside])
        model.temperature, model.threshold = _calibrated(z, y[aside])
    return model


def _calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the least probability from which on at most MAX_ERROR of the rows are wrong. The
    targets are smoothed by one row, so that a sample without errors does not make the model certain."""
    smooth = 1.0 / (len(y) + 2)
    target = np.full(z.shape, smooth / max(1, z.shape[1] - 1))
    target[np.arange(len(y)), y] = 1 - smooth

    def logs(t: float) -> np.ndarray:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return s - np.log(np.exp(s).sum(axis=1, keepdims=True))

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    best = float(min(grid, key=lambda t: -(target * logs(t)).sum()))
    p = np.exp(logs(best))
    top, wrong = p.max(axis=1), p.argmax(axis=1) != y
    order = np.argsort(-top)
    good = np.flatnonzero(np.cumsum(wrong[order]) <= MAX_ERROR * np.arange(1, len(y) + 1))
    return best, float(top[order][good[-1]]) if len(good) else 1.0


def language_id(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (calibrated probability of lang_pred) and accepted of each text."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            names, scores = [], []
            for ok, body in zip(batch.column(1).to_pylist(), _bodies(batch.column(2))):
                p = model.probabilities(body) if ok and model.languages else None
                best = int(p.argmax()) if p is not None else -1
                names.append(model.languages[best] if p is not None else UNKNOWN)
                scores.append(float(p[best]) if p is not None else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array([n != UNKNOWN and s >= model.threshold for n, s in zip(names, scores)], pa.bool_())],
                                             ["doc_id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _readable(text_col).alias("readable"), F.lower(text_of(text_col)).alias("text"))
    return map_batches(rows, run, "doc_id long, lang_pred string, score double, accepted boolean")
