"""License scan as an exact set-similarity join, DataFrame operations only.

Templates are the word sets of known license notices. A text meets a template when some run of about the template's length
(``span`` words), wherever it starts and whatever lines it stands on, holds at least ``threshold`` of the template's words
(containment). Blocks, as sets of words, are overlapping runs of the text such that each run of a template's span lies in one. The join
of blocks and templates is exact:

* words are ordered by how many texts hold them, rarest first, counted over all texts (only template words matter);
* prefix filter: of a template's T words a block needs a = ceil(threshold T), so it holds one of the T - a + 1 rarest;
* length filter: a block with fewer than a template words cannot meet it;
* positional filter: when the first shared word stands at place i of the template and place j of the block's ordered
  template words, at most 1 + min(T - i, B - j) words are shared;
* survivors are compared on their full sets, then on each run of the template's span within the block;
* such a run must also say what tells the template from look-alike notices (``TELLING``), whose other words are the same.

``license_blocks`` is the same join with the lines of the texts as blocks. Only texts that hold some prefix word are cut into blocks. The base search beside it finds the fixed phrases as
consecutive words anywhere in the text; its labels always stay, the join adds labels.

Defined results: null or empty text has no words and no labels, score 0; repeated rows each give a row; rows of one id with
different texts keep their own result; null ids stay null; an empty table gives an empty result; other columns play no role.
Texts are read whole, whatever their length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import running_sums, text_of

THRESHOLD = 0.8
# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Public license notices by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "You may not use this file except in compliance with the License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
)
# What a run must say, besides the containment, to be the template's and not a look-alike's notice; patterns over the run's
# words with a blank before and after each. The "except in compliance" sentence stands alike in other licenses; nothing in it tells them apart.
TELLING = {
    TEMPLATES[0][1]: ("( the mit | mit (x11 |expat )?license )",),
    TEMPLATES[1][1]: (" associated ", " files "),
    TEMPLATES[2][1]: (" apache (software )?license ", " version 2 "),
    TEMPLATES[4][1]: (" cc by nc ",),
    TEMPLATES[5][1]: (" creative commons attribution non ?commercial ",),
    TEMPLATES[6][1]: (" gnu general public license ", " version 3 "),
    TEMPLATES[7][1]: (" gnu general public license ",),
    TEMPLATES[8][1]: (" redistribution ", " binary "),
}
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text as an array; letters in lower case, everything else in ASCII but digits splits."""
    return F.filter(F.split(F.lower(text), _GAP), lambda w: w != "")


def _template_words(text: str) -> list[str]:
    import re

    return sorted(set(re.findall(r"[0-9a-z]+", text.lower())))


def span(text: str) -> int:
    """Words of a run that is held against a template: as many as the template has, and some inserted ones."""
    n = len(text.replace("-", " ").replace("/", " ").replace(".", " ").split())
    return n + max(4, n // 4)


def _telling(text: str) -> str:
    """One pattern for all that a run must say of a template."""
    return "^" + "".join(f"(?=.*{p})" for p in TELLING.get(text, ()))


def _runs(text: Column, step: int) -> Column:
    """The words of a text in runs of 2 ``step`` words, one from each ``step``-th word on: any ``step`` consecutive words lie
    in one of them. The words are a lambda variable, so that they are made once a text."""
    def cut(w):
        last = F.greatest(F.lit(0), F.ceil(F.size(w) / F.lit(step)).cast("int") - 2)
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(w, k * step + 1, 2 * step))
    return F.transform(F.array(words(text)), cut)[0]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a key of (id, text). A clash of keys joins candidates of both texts, which cannot add a match:
    blocks are compared on their own words."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"),
                       F.xxhash64(F.col(id_col), text_of(text_col)).alias("row_key"))


def word_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> DataFrame:
    """(word, place): the template words ordered by the number of texts that hold them, over all texts; a word that
    no text holds comes first. As many rows as the templates have words."""
    held = F.array_intersect(words(text_of(text_col)), F.array(*map(F.lit, vocabulary)))
    seen = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    every = docs.sparkSession.createDataFrame([(w,) for w in vocabulary], "word string")
    counted = every.join(seen, "word", "left").select("word", F.coalesce("count", F.lit(0)).alias("n"))
    ordered = counted.agg(F.sort_array(F.collect_list(F.struct("n", "word"))).alias("o"))  # bounded by the templates
    return ordered.select(F.posexplode("o").alias("place", "x")).select(F.col("x.word").alias("word"), "place")


def _met(docs: DataFrame, cut, templates, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(row_key, doc_id, block, run, template, label, size, need, template_words, shared) of every block and template that meet the
    threshold; ``cut`` makes an array of blocks, each an array of words, of a text."""
    spark = docs.sparkSession
    sets = [(n, label, _template_words(t)) for n, (label, t) in enumerate(templates)]
    vocabulary = sorted({w for _, _, ws in sets for w in ws})
    order = word_order(docs, vocabulary, text_col)
    table = spark.createDataFrame([(n, label, w, len(ws), math.ceil(threshold * len(ws) - 1e-9)) for n, label, ws in sets for w in ws],
                                  "template int, label string, word string, size int, need int")
    placed = table.join(F.broadcast(order), "word")
    whole = placed.groupBy("template", "label", "size", "need").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("o"))
    prefixes = whole.select("template", "label", "size", "need", F.transform("o", lambda x: x["word"]).alias("template_words"),
                            F.posexplode("o").alias("i", "x")).filter(F.col("i") <= F.col("size") - F.col("need"))
    prefixes = prefixes.select("template", "label", "size", "need", "template_words", "i", F.col("x.word").alias("word"))
    # Both are one value, bounded by the templates: scalar subqueries.
    ordered = order.agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("o")).select(F.transform("o", lambda x: x["word"])).scalar()
    rare = prefixes.agg(F.collect_set("word")).scalar()
    runs = (_keyed(docs, id_col, text_col).filter(F.arrays_overlap(words(F.col("text")), rare))
            .select("row_key", "doc_id", F.posexplode(cut(F.col("text"))).alias("block", "run")).filter(F.arrays_overlap("run", rare)))
    # array_intersect keeps the order of its first argument: the block's template words, rarest first.
    blocks = runs.select("row_key", "doc_id", "block", "run", F.array_intersect(ordered, F.col("run")).alias("held"))
    starts = blocks.select("row_key", "doc_id", "block", "run", "held", F.posexplode("held").alias("j", "word"))
    met = starts.join(F.broadcast(prefixes), "word").filter(F.size("held") >= F.col("need"))
    met = met.filter(F.lit(1) + F.least(F.col("size") - 1 - F.col("i"), F.size("held") - 1 - F.col("j")) >= F.col("need"))
    shared = met.withColumn("shared", F.array_intersect("held", "template_words"))
    return shared.filter((F.size("shared") >= F.col("need")) & (F.col("shared")[0] == F.col("word")))  # each pair once, at its first shared word


def license_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Every (row_key, doc_id, block, template, label, containment) that meets the threshold; block is the line number."""
    exact = _met(docs, lambda text: F.transform(F.split(text, "\n"), words), templates, threshold, id_col, text_col)
    return exact.select("row_key", "doc_id", "block", "template", "label", (F.size("shared") / F.col("size")).alias("containment"))


def license_runs(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(row_key, doc_id, template, label, containment) of every block that holds a run of a template's span that meets the
    threshold and says what tells the template from look-alikes, with the best such run; a text may repeat a template."""
    spans = [span(t) for _, t in templates]
    near = _met(docs, lambda text: _runs(text, max(spans, default=1)), templates, threshold, id_col, text_col)
    near = near.withColumns({"span": F.array(*map(F.lit, spans))[F.col("template")],
                             "telling": F.array(*[F.lit(_telling(t)) for _, t in templates])[F.col("template")]})

    def held(k):
        part = F.slice("run", k + 1, F.col("span"))
        said = F.regexp_like(F.concat(F.lit(" "), F.array_join(part, " "), F.lit(" ")), F.col("telling"))
        return F.when(said, F.size(F.array_intersect("template_words", part))).otherwise(0)

    places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("run") - F.col("span")))
    best = near.withColumn("best", F.array_max(F.transform(places, held))).filter(F.col("best") >= F.col("need"))
    return best.select("row_key", "doc_id", "template", "label", (F.col("best") / F.col("size")).alias("containment"))


def _places(before: Column, label: str, step: int) -> Column:
    """(at, label) of each phrase: the blanks before it, and the ``step`` - 1 inside each phrase that stands before it."""
    return F.transform(running_sums(before), lambda total, i: F.struct((total - 1 + i * F.lit(step - 1)).alias("at"), F.lit(label).alias("label")))


def base_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: row_key, doc_id, n_words and places, the array of (at, label) of the phrases."""
    rows = _keyed(docs, id_col, text_col)
    rows = rows.select("row_key", "doc_id", F.trim(F.regexp_replace(F.lower("text"), _GAP, " ")).alias("flat"))
    none = F.array().cast("array<struct<at:int,label:string>>")
    hay = F.concat(F.lit(" "), F.col("flat"), F.lit(" "))
    parts = []
    for phrase, label in PHRASES.items():
        # The pieces between the places tell how many words stand before each: blanks are the only separators left.
        pieces = F.split(hay, rf"(?<= ){phrase}(?= )")
        step = len(phrase.split(" "))
        before = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1),
                             lambda p: F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))))
        found = F.transform(F.array(before), lambda b: _places(b, label, step))[0]  # a lambda variable is made once
        parts.append(F.when(F.contains(hay, F.lit(f" {phrase} ")), found).otherwise(none))
    n = F.when(F.col("flat") == "", F.lit(0)).otherwise(F.length("flat") - F.length(F.replace("flat", F.lit(" "), F.lit(""))) + 1)
    return rows.select("row_key", "doc_id", n.cast("long").alias("n_words"), F.concat(*parts).alias("places"))


def license_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (1 with a phrase, else
    the best containment of its runs, else 0)."""
    base = base_scan(docs, id_col, text_col)
    found = license_runs(docs, templates, threshold, id_col, text_col).groupBy("row_key").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    out = base.join(found, "row_key", "left")
    at = F.transform("places", lambda p: p["at"].cast("long"))
    labels = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(labels, F.coalesce("more", F.array().cast("array<string>"))))
    return out.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"),
                      F.array_max(at).alias("last_word"), F.array_join(labels, ",").alias("base_labels"),
                      F.array_join(every, ",").alias("labels"),
                      F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
