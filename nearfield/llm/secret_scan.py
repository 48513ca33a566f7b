"""Secret scan with a trigram inverted index, DataFrame operations only.

Each rule has a Boolean trigram query: an OR of clauses, each an AND of the trigrams (lower case) of a literal that
every match of that alternative holds. The index keeps, for the trigrams that any rule asks for, the posting list
of documents; intersecting the postings of a clause gives the rule's candidates, and only those are matched.
Rules without a mandatory trigram (``hex``) have no query and scan every text.

Positions come from the regular expression alone: ``\\G(gap)(match)`` tiles the text from its start, so the code
points of the gaps and matches before a match add up to its start. A rule passes over a candidate text twice, for the gaps and
for the matches (``hex`` a third time to see whether there are any); the work grows as n log n with its n matches.

Defined results: null text is empty; a row is looked up by a hash of (id, text), so null ids, repeated rows and
rows of one id with different texts keep their own result, one output row per input row; an empty table gives
an empty result; other columns play no role. Texts are scanned whole, whatever their length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import running_sums, text_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str             # Java regular expression without capturing groups of its own besides ``value``
    literals: tuple          # alternatives; each a tuple of literals that all stand in a match of it
    least: int = 0           # code points that the value needs
    value: str | None = None  # expression of the value inside a match; None: the whole match


_ASSIGN_HEAD = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
# Base rules first, in the order that breaks ties of equal starts; then the rules this method adds. The credential
# shapes are fixed public formats.
RULES = (
    Rule("assign", _ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+",
         (("password",), ("passwd",), ("secret",), ("token",), ("apikey",), ("api_key",)), 8, _ASSIGN_HEAD),
    Rule("access", r"AKIA[A-Z0-9]+", (("akia",),), 16),
    Rule("hex", r"[0-9a-f]{32,}", (), 32),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", (("-----begin ", "private key-----"),)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", (("ghp_",), ("gho_",), ("ghu_",), ("ghs_",), ("ghr_",))),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", (("xoxa-",), ("xoxb-",), ("xoxp-",), ("xoxr-",), ("xoxs-",))),
    Rule("google", r"AIza[0-9A-Za-z_-]{35,}", (("aiza",),)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", (("eyj", ".eyj"),)),
)
BASE = ("assign", "access", "hex")


def trigrams(literal: str) -> list[str]:
    return sorted({literal[i:i + 3] for i in range(len(literal) - 2)})


def trigram_queries(rules=RULES) -> list[tuple[str, int, list[str]]]:
    """(rule, clause number, mandatory trigrams) of every rule that has a query."""
    return [(r.kind, n, sorted({g for lit in alt for g in trigrams(lit)})) for r in rules for n, alt in enumerate(r.literals)]


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), text_of(text_col))


def postings(docs: DataFrame, grams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index for the trigrams asked for: (gram, row_key), one row per text that holds the trigram.
    A clash of row keys can only add candidates, never lose one."""
    low = docs.select(_row_key(id_col, text_col).alias("row_key"), F.lower(text_of(text_col)).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("row_key", F.explode(held).alias("gram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(row_key, kinds): the rules of which some clause has all its trigrams in the row's text."""
    spark = index.sparkSession
    clauses = trigram_queries(rules)
    terms = spark.createDataFrame([(g, k, n, len(gs)) for k, n, gs in clauses for g in gs],
                                  "gram string, kind string, clause int, needed int")
    met = (index.join(F.broadcast(terms), "gram")  # bounded by the rules
           .groupBy("row_key", "kind", "clause", "needed").agg(F.countDistinct("gram").alias("found"))
           .filter(F.col("found") == F.col("needed")))
    return met.groupBy("row_key").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, text: Column) -> Column:
    """array of (start, end, kind) of one rule in a text, leftmost first, not overlapping."""
    tiled = rf"(?s)\G(.*?)({rule.pattern})"
    gaps, hits = F.regexp_extract_all(text, F.lit(tiled), F.lit(1)), F.regexp_extract_all(text, F.lit(tiled), F.lit(2))
    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("size"), h.alias("hit")))

    def placed(tiles):
        ends = running_sums(F.transform(tiles, lambda x: x["gap"] + x["size"]))
        return F.zip_with(ends, tiles, lambda e, x: F.struct((e - x["size"]).alias("start"), e.alias("end"), x["hit"]))

    found = F.transform(F.array(pairs), placed)[0]  # the tiles are a lambda variable, so that they are made once
    if rule.value:
        found = F.filter(found, lambda x: F.length(F.regexp_replace(x["hit"], "^" + rule.value, "")) >= rule.least)
    elif rule.least:
        found = F.filter(found, lambda x: x["end"] - x["start"] >= rule.least)
    return F.transform(found, lambda x: F.struct(x["start"], x["end"], F.lit(rule.kind).alias("kind")))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """doc_id and spans: array of (start, end, kind), ends exclusive, by start and then rule order."""
    grams = sorted({g for _, _, gs in trigram_queries(rules) for g in gs})
    kinds = candidates(postings(docs, grams, id_col, text_col), rules)
    rows = docs.select(_row_key(id_col, text_col).alias("row_key"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.join(kinds, "row_key", "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    parts = []
    for r in rules:
        test = F.array_contains("kinds", r.kind) if r.literals else F.col("text").rlike(r.pattern)
        parts.append(F.when(test, _spans(r, F.col("text"))).otherwise(none))
    order = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(n))])
    ranked = F.array_sort(F.transform(F.concat(*parts), lambda s: F.struct(
        s["start"], order[s["kind"]].alias("rank"), s["end"], s["kind"])))
    return rows.select("doc_id", F.transform(ranked, lambda s: F.struct(s["start"], s["end"], s["kind"])).alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(scanned: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select("doc_id", *[count(k) for k in BASE], F.sha2(joined_spans(base), 256).alias("base_sha256"),
                          joined_spans(F.col("spans")).alias("spans"))
