"""Language identification: held-out accuracy, calibration, rejection and edge cases."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from nearfield.llm import language_id as li
from nearfield.llm import queries

LARGER = "/root/testdata/sf0.01"
WORDS = {"aa": "lomi pera suna tiko veral monda", "bb": "schtra grumpf kloetz wurzt brack zwirn", "cc": "øya å blåbær fjø smør ålesund"}


def made(spark, extra=()):
    rng = np.random.default_rng(0)
    rows = [(n, " ".join(rng.choice(WORDS[lang].split(), 12)), lang) for n, lang in enumerate(list(WORDS) * 40)]
    rows = [(*r, "x", "y", 1.0) for r in [*rows, *extra]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, readable string, place string, score double").repartition(3)


def test_held_out_accuracy_and_calibration(spark):
    truth = dict(duckdb.connect().execute(f"SELECT doc_id, lang FROM '{LARGER}/documents.parquet'").fetchall())
    got = queries.QUERIES["op12_language_id"](spark, LARGER).collect()
    assert len(got) == len(truth)
    aside = [r for r in got if r.held_out]
    right = np.array([r.lang_pred == truth[r.doc_id] for r in aside])
    assert 0.25 < len(aside) / len(got) < 0.42 and right.mean() >= 0.98
    accepted = np.array([r.accepted for r in aside])
    assert accepted.mean() > 0.9 and (~right & accepted).mean() <= 0.01
    assert abs(np.mean([r.score for r in aside]) - right.mean()) < 0.03


def test_edge_cases(spark):
    extra = [(900, None, "aa"), (901, "", "aa"), (902, "1234 !? --", "bb"), (903, "lomi pera", None), (904, "LOMI Pera SUNA", None), (904, "LOMI Pera SUNA", None),
             (None, "grumpf kloetz wurzt", "aa"), (905, "smør " * 300_000, None), (906, "é", None)]
    docs = made(spark, extra)
    model = li.fit(docs, F.lit(True))
    assert model.languages == ["aa", "bb", "cc"] and 0 < model.threshold <= 1
    got = {}
    for r in li.language_id(docs, model).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.accepted))
    for i in (900, 901, 902):
        assert got[i] == [("und", 0.0, False)]
    assert [x[0] for i in (903, 904, 905, None) for x in got[i]] == ["aa", "aa", "aa", "cc", "bb"]
    assert len(got[904]) == 2 and got[904][0] == got[904][1]
    assert got[906][0][0] in model.languages
    assert all(0 <= s <= 1 for v in got.values() for _, s, _ in v)


def test_strange_text_is_not_accepted(spark):
    model = li.fit(made(spark), F.lit(True))
    odd = spark.createDataFrame([(1, "qqxx yyzz"), (2, "veral monda suna pera lomi tiko veral")], "doc_id long, text string")
    got = {r.doc_id: r for r in li.language_id(odd, model).collect()}
    assert got[2].accepted and got[1].score < got[2].score


def test_nothing_to_learn_from(spark):
    docs = made(spark)
    model = li.fit(docs, F.lit(False))
    assert {(r.lang_pred, r.score) for r in li.language_id(docs, model).collect()} == {("und", 0.0)}
    none = docs.limit(0)
    assert li.language_id(none, li.fit(none, F.lit(True))).count() == 0


def test_the_sample_is_bounded_and_even(spark):
    rows = li._sample(made(spark), F.lit(True), 10, 24, "doc_id", "text", "lang").collect()
    assert len(rows) == 24 and {x: sum(r.lang == x for r in rows) for x in WORDS} == {"aa": 8, "bb": 8, "cc": 8}


def test_subwords_of_long_texts_in_pieces(monkeypatch):
    body = np.frombuffer(("abc def, ghi-jkl " * 50).encode(), np.uint8)
    whole = np.sort(np.concatenate(list(li.subwords(body))))
    monkeypatch.setattr(li, "PIECE", 37)
    assert (np.sort(np.concatenate(list(li.subwords(body)))) == whole).all()
