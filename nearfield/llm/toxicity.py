"""Toxicity by a weighted finite-state pattern grammar.

A clause is read as a row of symbols: INSULT, THREAT, TARGET (whom it is said to), NOT, SAYS (reported speech), INTENT, other
words and the clause's end. Each transducer rewrites the row and has a factor: ``Aim`` marks insults and threats with a target
within a few words, ``Insult`` and ``Threat`` turn them into hits (a threat only if it is aimed; intent before it makes it
heavier), ``Near`` softens a hit after a negation, ``Until`` one in reported speech. The row passes ``Aim`` from its end to its
start first, which marks targets that follow, then the composition of all five from start to end: one machine whose states are the tuples
of theirs. A clause scores the sum of its hits, the factor times the weight of the word, and a document is scored on its
clauses by a logistic model.

The lexicon is learned from labelled rows: words, and word beginnings of 4 to 7 letters, that stand in far more toxic than
clean texts (log-likelihood ratio), as far as they explain toxic texts that no better entry explains; they are weighted by their
log odds. Entries that are threats by the fixed list, or follow a word of intent in a third of their toxic places, are threats, the
others insults. In scripts without blanks every run of 2 to 4 letters counts as a word when learning, and there and in runs of over
``LONG_RUN`` letters the longest entry at each place is read, wherever it begins. The lists of the other symbols are fixed values.

Learning uses up to ``PER_CLASS`` labelled rows of each label, one text an id (the greatest of several), and never a row whose
crc32(id) mod 5 is 0; the counts over their texts run as a Spark job, and all entries that pass the tests come to the driver, at most
so many as the sample has texts times their words. Scores use nothing but the text.

Defined results: null or empty text has no clauses and scores as such; without any toxic and clean labelled row the lexicon is
empty and every text scores 0; repeated rows each give a row; null ids stay null and are not held out; an empty table gives an
empty result; other columns play no role and pass through ``clean`` unchanged. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import held_out, map_batches, text_of, written
from nearfield.llm.learning import logistic, sample_labels

PER_CLASS = 10_000
MIN_TOXIC_TEXTS, MIN_RATIO, MIN_ODDS = 4, 20.0, 2.5
MIN_GAIN, MIN_GAIN_SHARE = 3, 0.002
STRONG_SHARE, STRONG_ODDS = 0.03, 4.0
STEMS = range(4, 8)
COUNTED_ENTRIES = 100_000  # entries a task counts before it hands them on
# Words of the symbols that are not learned (English, German, French, Spanish).
SEED_THREATS = "kill hurt destroy beat stab shoot burn strangle töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your yours youre u he she they them him her his their du dich dein ihr euch tu toi ton ta vous votre vos usted tus te".split()
NEGATIONS = "not no never isnt arent wasnt dont doesnt didnt nicht kein keine nie niemals ne pas jamais nunca ni".split()
REPORTS = "said says say told wrote quoted claimed reported called sagte sagt schrieb dit disait écrit dijo dice escribió".split()
INTENTS = "will ll gonna going want werde will voy va vais".split()
# The same symbols in scripts without blanks.
UNSPACED_TARGETS, UNSPACED_NEGATIONS, UNSPACED_REPORTS = "你 您 君 お前 あなた".split(), "不 没 沒 ない".split(), "说 說 言".split()
UNSPACED_THREATS = "杀 殺 打死".split()
SEED_WEIGHT = 0.5
THREAT_SHARE = 1 / 3

INSULT, THREAT, TARGET, NOT, SAYS, WORD, END, INTENT, AIMED_INSULT, AIMED_THREAT, HIT = range(11)
READ = 10  # symbols that a row may hold before the composed machine reads it


@dataclass(frozen=True)
class Aim:
    """Marks insults and threats that have a target among the ``reach`` words before, in the direction of reading."""
    reach: int

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == END:
            return 0, symbol, 1.0
        if symbol == TARGET:
            return self.reach, symbol, 1.0
        aimed = {INSULT: AIMED_INSULT, THREAT: AIMED_THREAT}.get(symbol, symbol) if state else symbol
        return max(0, state - 1), aimed, 1.0


@dataclass(frozen=True)
class Insult:
    """Every insult is a hit, an aimed one a heavier one."""
    aimed: float

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return 0, HIT if symbol in (INSULT, AIMED_INSULT) else symbol, self.aimed if symbol == AIMED_INSULT else 1.0


@dataclass(frozen=True)
class Threat:
    """An aimed threat is a hit, a heavier one up to ``reach`` words after a word of intent; without a target it is a plain word."""
    reach: int
    aimed: float
    meant: float

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == END:
            return 0, symbol, 1.0
        if symbol == INTENT:
            return self.reach, WORD, 1.0
        after = max(0, state - 1)
        if symbol == AIMED_THREAT:
            return after, HIT, self.meant if state else self.aimed
        return after, WORD if symbol == THREAT else symbol, 1.0


@dataclass(frozen=True)
class Near:
    """Remembers a marker for ``reach`` words; multiplies the hits read meanwhile."""
    marker: int
    reach: int
    factor: float

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == END:
            return 0, symbol, 1.0
        if symbol == self.marker:
            return self.reach, symbol, 1.0
        return max(0, state - 1), symbol, self.factor if state and symbol == HIT else 1.0


@dataclass(frozen=True)
class Until:
    """Remembers a marker to the end of the clause; multiplies the hits read meanwhile."""
    marker: int
    factor: float

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == END:
            return 0, symbol, 1.0
        return int(state or symbol == self.marker), symbol, self.factor if state and symbol == HIT else 1.0


AHEAD = Aim(4)  # reads clauses from the end
GRAMMAR = (Aim(4), Insult(1.5), Threat(4, 1.25, 1.75), Near(NOT, 3, 0.25), Until(SAYS, 0.5))


def compose(parts=GRAMMAR) -> list[list[tuple[int, float]]]:
    """The machine of all parts, each reading what the one before writes: for each reachable state and symbol the next state and the
    factor of a hit, 0 where nothing is hit."""
    names, table, queue = {(0,) * len(parts): 0}, [], [(0,) * len(parts)]
    for state in queue:
        row = []
        for symbol in range(READ):
            to, factor, at = [], 1.0, symbol
            for part, own in zip(parts, state):
                own, at, more = part.step(own, at)
                to.append(own)
                factor *= more
            if tuple(to) not in names:
                names[tuple(to)] = len(names)
                queue.append(tuple(to))
            row.append((names[tuple(to)], factor if at == HIT else 0.0))
        table.append(row)
    return table


@dataclass
class Model:
    words: dict[str, float]                  # learned insults and threats, whole words
    stems: dict[str, float]                  # learned beginnings
    threats: set[str] = field(default_factory=set)  # entries that are threats
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def build(self) -> "Scorer":
        return Scorer(self)


_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n。！？；：]")
_ENDS = re.compile(r"[.!?;:\n。！？；：]")
_END_LETTERS = frozenset(".!?;:\n。！？；：")
# Thai, Lao, Burmese, Khmer, kana and Han letters: scripts that set no blanks between words.
_UNSPACED = re.compile(r"[฀-໿က-႟ក-៿ぁ-ヿ㐀-䶿一-鿿]+")
GRAMS = range(2, 5)
LONG_RUN = 40
_RUNS = re.compile(rf"[^\W\d_]{{{LONG_RUN + 1},}}")
FEATURES = 5


def _vocabulary(low: str) -> tuple[set[str], set[str]]:
    """The words of a lower-case text, and the runs of letters that may be words where a script sets no blanks."""
    words, grams = set(re.findall(r"[^\W\d_]+", low)), set()
    if not low.isascii():
        for word in words:
            for run in _UNSPACED.findall(word):
                grams |= {run[at:at + n] for n in GRAMS for at in range(len(run) - n + 1)}
    return words | grams, grams


class Scorer:
    """Reads texts with the composed machine; made once per task."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model, self.table = model, compose()
        threats, words = {*SEED_THREATS, *UNSPACED_THREATS}, {}
        for symbol, lists in ((INTENT, INTENTS), (TARGET, TARGETS + UNSPACED_TARGETS), (NOT, NEGATIONS + UNSPACED_NEGATIONS),
                              (SAYS, REPORTS + UNSPACED_REPORTS), (THREAT, threats)):
            words |= dict.fromkeys(lists, symbol)
        self.symbol = words
        self.find = ahocorasick.Automaton()
        for entry in {*model.words, *model.stems, *threats}:
            self.find.add_word(entry, len(entry))
        self.find.make_automaton()
        self.inside = ahocorasick.Automaton()  # what may stand inside a run of letters without blanks
        for entry in {*model.words, *model.stems, *threats, *UNSPACED_TARGETS, *UNSPACED_NEGATIONS, *UNSPACED_REPORTS}:
            if len(entry) > 3 or _UNSPACED.match(entry):
                self.inside.add_word(entry, entry)
        for entry in (e for e in (*TARGETS, *NEGATIONS, *REPORTS) if len(e) > 2):
            self.inside.add_word(entry, entry)
        self.inside.make_automaton()

    def weight(self, word: str) -> tuple[float, bool]:
        """Weight of a word as an insult or threat, its own or that of its longest learned beginning, and whether it is a threat."""
        if word in self.model.words:
            return self.model.words[word], word in self.model.threats
        for n in reversed(STEMS):
            if word[:n] in self.model.stems:
                return self.model.stems[word[:n]], word[:n] in self.model.threats
        return 0.0, False

    def split(self, run: str) -> list[str]:
        """The entries and symbols inside a run of letters without blanks: the longest at each place, from left to right."""
        best: dict[int, str] = {}
        for last, entry in self.inside.iter(run):
            at = last + 1 - len(entry)
            if len(entry) > len(best.get(at, "")):
                best[at] = entry
        out, done = [], 0
        for at in sorted(best):
            if at >= done:
                out.append(best[at])
                done = at + len(best[at])
        return out

    def tokens(self, low: str, begin: int, end: int) -> list[str]:
        out = []
        for token in _TOKEN.findall(low, begin, end):
            if len(token) > LONG_RUN or not token.isascii() and _UNSPACED.search(token):
                out += self.split(token)
            else:
                out.append(token)
        return out

    def clauses(self, text: str) -> list[tuple[float, int, int]]:
        """(score, hits, those negated or reported) of every clause that has a hit. The automaton finds where the lexicon's entries
        begin a word, or stand anywhere in a run without blanks; only clauses around such places are read."""
        low, out, done = text.lower(), [], 0
        runs = None
        for last, size in self.find.iter(low):
            at = last + 1 - size
            if at < done:
                continue
            if at and low[at - 1].isalpha() and not _UNSPACED.match(low[at]):
                if runs is None:
                    runs, here = [m.span() for m in _RUNS.finditer(low)], 0
                while here < len(runs) and runs[here][1] <= at:
                    here += 1
                if here == len(runs) or at < runs[here][0]:
                    continue
            begin = at
            while begin > done and low[begin - 1] not in _END_LETTERS:
                begin -= 1
            end = _ENDS.search(low, at)
            done = end.start() if end else len(low)
            got = self._read(self.tokens(low, begin, done))
            if got[1]:
                out.append(got)
        return out

    def _read(self, tokens: list[str]) -> tuple[float, int, int]:
        row, weights = [], []
        for token in tokens:
            weight, threat = self.weight(token)
            row.append((THREAT if threat else INSULT) if weight else self.symbol.get(token, WORD))
            weights.append(weight or SEED_WEIGHT)
        state = 0
        for n in range(len(row) - 1, -1, -1):
            state, row[n], _ = AHEAD.step(state, row[n])
        state, score, hits, softened = 0, 0.0, 0, 0
        for symbol, weight in zip(row, weights):
            state, factor = self.table[state][symbol]
            if factor:
                score += factor * weight
                hits += 1
                softened += factor < 1
        return score, hits, softened

    def features(self, text: str) -> list[float]:
        found = self.clauses(text)
        total, hits = sum(c[0] for c in found), sum(c[1] for c in found)
        return [math.log1p(total), max((c[0] for c in found), default=0.0), math.log1p(hits), math.log1p(len(found)),
                float(sum(c[2] for c in found))]

    def score(self, text: str) -> float:
        z = self.model.bias + sum(w * x for w, x in zip(self.model.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _entry_counts(texts: DataFrame) -> DataFrame:
    """(entry, stem, toxic, clean): number of texts of either label that hold a word, or a word with the beginning; counted in
    each task first, then merged."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def packed(counts: dict):
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.bool_()),
                 pa.array([v[1] for v in counts.values()], pa.int64()), pa.array([v[0] for v in counts.values()], pa.int64())],
                ["entry", "stem", "toxic", "clean"])

        counts: dict = {}
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                words, grams = _vocabulary(text.as_py().lower())
                for k in {(w, False) for w in words if len(w) > 2 or w in grams} | {(w[:n], True) for w in words for n in STEMS if len(w) >= n}:
                    counts.setdefault(k, [0, 0])[y] += 1
                if len(counts) > COUNTED_ENTRIES:
                    yield packed(counts)
                    counts = {}
        yield packed(counts)

    parts = map_batches(texts, run, "entry string, stem boolean, toxic long, clean long")
    return parts.groupBy("entry", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _strong(toxic: dict[tuple[str, bool], int]) -> set[tuple[str, bool]]:
    """Of frequent, pure entries: the words, and the beginnings that stand for several words; the longest of those that do so alike."""
    kept = {e for e in toxic if not e[1]}
    for stem, n in sorted(((e, n) for (e, is_stem), n in toxic.items() if is_stem), key=lambda x: (-len(x[0]), x[0])):
        one = max((m for (e, is_stem), m in toxic.items() if not is_stem and e.startswith(stem)), default=0)
        if n >= 1.5 * one and not any(e.startswith(stem) and toxic[e, True] >= 0.9 * n for e, is_stem in kept if is_stem):
            kept.add((stem, True))
    return kept


def _cover(texts: DataFrame, entries: list[tuple[str, bool, float]], strong: set[tuple[str, bool]]) -> list[tuple[str, bool, float]]:
    """The strong entries, and the entries that explain toxic texts no better entry explains: one after the other, that which adds
    most toxic texts and fewest clean ones, down to a gain of ``MIN_GAIN``. Words that merely share long toxic texts with
    insults fall away."""
    words = {e: n for n, (e, stem, _) in enumerate(entries) if not stem}
    stems = {e: n for n, (e, stem, _) in enumerate(entries) if stem}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            held = []
            for text in batch.column(0):
                text = text.as_py()
                seen, _ = _vocabulary(text.lower())
                held.append(sorted({words[w] for w in seen if w in words} | {stems[w[:n]] for w in seen for n in STEMS if w[:n] in stems and len(w) >= n}))
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), batch.column(1)], ["held", "y"])

    rows = map_batches(texts.select("text", "y"), run, "held array<int>, y int").filter(F.size("held") > 0).collect()  # one row an id of the sample
    of: dict[int, set[int]] = {}
    for n, r in enumerate(rows):
        for e in r["held"]:
            of.setdefault(e, set()).add(n)
    toxic = {n for n, r in enumerate(rows) if r["y"] == 1}
    least, chosen = max(MIN_GAIN, MIN_GAIN_SHARE * len(toxic)), [x for x in entries if x[:2] in strong]
    known = set().union(*(of.pop((stems if stem else words)[e], set()) for e, stem, _ in chosen))
    of = {e: t - known for e, t in of.items()}
    gain = {e: len(t & toxic) - len(t - toxic) for e, t in of.items()}
    while gain:
        best = max(gain, key=lambda e: (gain[e], not entries[e][1], len(entries[e][0]), entries[e][0]))
        if gain[best] < least:
            break
        chosen.append(entries[best])
        new = of.pop(best)
        del gain[best]
        for e in list(of):
            if not new.isdisjoint(of[e]):
                of[e] -= new
                gain[e] = len(of[e] & toxic) - len(of[e] - toxic)
    return chosen


def _threats(texts: DataFrame, model: Model) -> set[str]:
    """The entries that are threats: those of the fixed list with their forms, and those that follow a word of intent, by at most four
    words, in a third of their places in toxic texts."""
    intents, seeds = frozenset(INTENTS), tuple([*SEED_THREATS, *UNSPACED_THREATS])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text in batch.column(0):
                left = 0
                for token in _TOKEN.findall(text.as_py().lower()):
                    entry = token if token in model.words else next((token[:n] for n in reversed(STEMS) if token[:n] in model.stems), None)
                    if entry:
                        count = seen.setdefault(entry, [0, 0])
                        count[0] += 1
                        count[1] += left > 0
                    left = 4 if token in intents else 0 if token in _END_LETTERS else max(0, left - 1)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                                          pa.array([v[1] for v in seen.values()], pa.int64())], ["entry", "n", "meant"])

    counts = (map_batches(texts.filter("y = 1").select("text"), run, "entry string, n long, meant long").groupBy("entry")
              .agg((F.sum("meant") / F.sum("n")).alias("share")).filter(F.col("share") >= THREAT_SHARE).collect())
    return {r["entry"] for r in counts} | {e for e in (*model.words, *model.stems) if e.startswith(seeds)}


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns the lexicon and the clause weights."""
    sample = sample_labels(labels, target, per_class, id_col)  # bounded: at most 2 * per_class ids
    texts = written(docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
                    .join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.max("text").alias("text")).select("text", "y"))
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    t, c = totals.get(1, 0), totals.get(0, 0)
    if not t or not c:
        return Model({}, {}, weights=[0.0] * FEATURES, bias=-30.0)
    x, y = F.col("toxic"), F.col("clean")
    odds = F.log((x + 0.5) / (t + 1)) - F.log((y + 0.5) / (c + 1))
    part = lambda n, total, share: F.when(n > 0, n * F.log(n / (total * share))).otherwise(0.0)
    ratio = 2 * (part(x, x + y, t / (t + c)) + part(y, x + y, c / (t + c)))
    picked = (_entry_counts(texts.select("text", "y")).filter(x >= MIN_TOXIC_TEXTS)
              .withColumns({"odds": odds, "ratio": ratio}).filter((F.col("odds") >= MIN_ODDS) & (F.col("ratio") >= MIN_RATIO))
              .orderBy(F.desc("ratio"), "entry", "stem").select("entry", "stem", "odds", "toxic").collect())
    strong = _strong({(r["entry"], r["stem"]): r["toxic"] for r in picked if r["toxic"] >= STRONG_SHARE * t and r["odds"] >= STRONG_ODDS})
    picked = _cover(texts, [(r["entry"], r["stem"], r["odds"]) for r in picked], strong)
    top = max((odds for *_, odds in picked), default=1.0)
    model = Model({e: odds / top for e, stem, odds in picked if not stem}, {e: odds / top for e, stem, odds in picked if stem})
    model.threats = _threats(texts, model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = model.build()
        for batch in batches:
            rows = [scorer.features(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    got = map_batches(texts.select("text", "y"), run, "x array<double>, y int").collect()  # one row an id of the sample
    got.sort(key=lambda r: (r["y"], r["x"]))
    labels_ = np.array([float(r["y"]) for r in got])
    # The sample is balanced differently from the corpus of labels; both classes weigh the same.
    share = np.where(labels_ == 1, 0.5 / max(1.0, labels_.sum()), 0.5 / max(1.0, (1 - labels_).sum()))
    weights, model.bias = logistic(np.array([r["x"] for r in got]).reshape(-1, FEATURES), labels_, l2=1e-3, weights=share)
    model.weights = weights.tolist()
    return model


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of each text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = model.build()
        for batch in batches:
            scores = [scorer.score(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                                              pa.array([int(s >= threshold) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns unchanged; judged where they are, without a shuffle."""

    def run(batches: Iterator, at=docs.columns.index(text_col)) -> Iterator:
        import pyarrow as pa

        scorer = model.build()
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(text.as_py() or "") < threshold for text in batch.column(at)], pa.bool_()))

    return map_batches(docs, run, docs.schema)
