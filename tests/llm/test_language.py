"""Operator 1: held-out accuracy, the fusion against a direct computation, and its edges."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import language

SF = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ba", "ko", "ri", "ta"], "bb": ["sch", "ein", "ung", "ß"], "cc": ["ção", "lh", "que", "ê"]}


def corpus(n=240, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60)))
        rows.append((i, text, lang, f"{lang}.example" if i % 3 else "mixed.example", len(text)))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_languages_of_texts_without_labels(spark):
    rows = corpus()
    labelled = spark.createDataFrame(rows, SCHEMA)
    models = language.fit(labelled.filter("doc_id < 120"), "text", "lang", "doc_id")
    assert models.languages == ["aa", "bb", "cc"]
    fresh = labelled.filter("doc_id >= 120").withColumn("language", F.lit("clash"))
    got = {r.doc_id: r for r in language.identify(fresh, models, text_col="text", keep=["doc_id"]).collect()}
    right = sum(got[r[0]].language == r[2] for r in rows if r[0] >= 120)
    assert len(got) == 120 and right >= 117


def test_training_rows_are_bounded(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    few = language.fit(df, "text", "lang", "doc_id", train_rows=5)
    again = language.fit(df.repartition(7), "text", "lang", "doc_id", train_rows=5)
    assert (few.table == again.table).all()


def test_odd_rows(spark):
    rows = corpus()
    models = language.fit(spark.createDataFrame(rows, SCHEMA), "text", "lang", "doc_id")
    odd = [(1, None, "aa", "h", 0), (2, "", "aa", "h", 0), (3, "   ", None, None, 0), (4, "ba", "aa", None, 2), (5, rows[0][1], "zz", None, 0),
           (6, rows[0][1], rows[0][2], "h", 0), (6, rows[0][1], rows[0][2], "h", 0), (7, rows[0][1] * 2000, None, "h", 0), (None, rows[0][1], None, "h", 0)]
    df = spark.createDataFrame(odd, SCHEMA)
    got = language.identify(df, models, text_col="text", keep=["doc_id"], declared=F.col("lang"), host=F.col("source")).collect()
    assert len(got) == len(odd)
    by_id = {r.doc_id: r for r in got}
    assert not by_id[1].accepted and not by_id[2].accepted and by_id[1].language == "und"
    assert by_id[4].accepted and by_id[4].language == "aa"            # no trigram: what is declared decides
    assert by_id[5].language == by_id[6].language == by_id[7].language == by_id[None].language == rows[0][2]
    kept = language.accepted_documents(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert {r.doc_id for r in kept if r.doc_id is None or r.doc_id > 7} == {None, *range(8, 240)}
    assert [len(r.text or "") > 1 for r in kept] == [True] * len(kept)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    models = language.fit(none, "text", "lang", "doc_id")
    assert models.languages == [] and language.identify(none, models, text_col="text", keep=["doc_id"]).collect() == []
    got = language.identify(spark.createDataFrame(corpus(5), SCHEMA), models, text_col="text", keep=["doc_id"]).collect()
    assert {(r.language, r.accepted) for r in got} == {("und", False)}


def softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def test_fusion_as_computed_directly(spark):
    """Host over suffix over corpus, declarations and suffixes weighed by their agreement with the texts."""
    rows = [(i, f"http://{'x' if i % 2 else 'y'}.example.{'aa' if i % 3 else 'bb'}/p", ["aa", "bb", None, "zz"][i % 4]) for i in range(24)]
    evidence = [[-((i * 7) % 5) / 2.0, -((i * 3) % 4) / 2.0, -3.0] for i in range(24)]
    models = language.Models(["aa", "bb"], None)
    df = spark.createDataFrame([(i, u, d, e) for (i, u, d), e in zip(rows, evidence)], "doc_id long, url string, lang string, e array<double>")
    original = language.text_evidence
    language.text_evidence = lambda docs, m, text_col, keep: docs.select(*keep, F.col(text_col).alias("evidence"))
    try:
        got = {r.doc_id: r for r in language.identify(df, models, text_col="e", keep=["doc_id"], declared=F.col("lang"),
                                                       **language.address_parts(F.col("url"))).collect()}
    finally:
        language.text_evidence = original
    p = [softmax(e) for e in evidence]
    host = [u.split("/")[2] for _, u, _ in rows]
    suffix = [h.rsplit(".", 1)[1] for h in host]

    def mean(keep, parent, weight):
        chosen = [q for q, k in zip(p, keep) if k]
        return [(sum(q[j] for q in chosen) + weight * parent[j]) / (len(chosen) + weight) for j in range(3)]

    corpus_prior = mean([True] * 24, [1 / 3] * 3, 1.0)
    trust = {}
    for name, labels in (("declared", [d for _, _, d in rows]), ("suffix", suffix)):
        both = [q[["aa", "bb"].index(d)] for q, d in zip(p, labels) if d in ("aa", "bb")]
        trust[name] = min(0.99, max(1 / 3, (sum(both) + 1) / (len(both) + 2)))
    for i, (_, _, declared) in enumerate(rows):
        of_suffix = mean([s == suffix[i] for s in suffix], corpus_prior, language.HOST_WEIGHT)
        prior = mean([h == host[i] for h in host], of_suffix, language.HOST_WEIGHT)
        total = [math.log(q) + e for q, e in zip(prior, evidence[i])]
        for name, label in (("declared", declared), ("suffix", suffix[i])):
            if label in ("aa", "bb"):
                total = [t + math.log(trust[name] if x == label else (1 - trust[name]) / 2) for t, x in zip(total, ("aa", "bb", "und"))]
        posterior = softmax(total)
        assert got[i].confidence == pytest.approx(max(posterior), abs=1e-5)
        assert got[i].language == ("aa", "bb", "und")[posterior.index(max(posterior))]


def test_addresses_and_markup(spark):
    df = spark.createDataFrame([("http://A.example.de/fr/x", '<!doctype html>\n<HTML dir="ltr" LANG=\'pt-BR\'>'), ("https://u@b.org:80?q", "<html><p lang=en>"),
                                ("no address", None), (None, "")], "url string, html string")
    parts = language.address_parts(F.col("url"))
    got = [tuple(r) for r in df.select(parts["host"], parts["suffix"], language.markup_language(F.col("html"))).collect()]
    assert got == [("a.example.de", "fr", "pt"), ("b.org", "org", None), ("", "", None), (None, None, None)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_accuracy_on_documents_that_the_models_have_not_seen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    models = language.fit(docs.filter("doc_id % 2 = 0"), "text", "lang", "doc_id")
    held_out = docs.filter("doc_id % 2 = 1")
    got = language.identify(held_out, models, text_col="text", keep=["doc_id"], host=F.col("source"))
    total = held_out.count()
    right = got.join(held_out, "doc_id").filter(F.col("language") == F.col("lang")).count()
    accepted = language.accepted_documents(docs).count()
    assert right >= 0.97 * total and accepted >= 0.99 * docs.count()


def test_short_texts_go_by_declaration_and_prior(spark):
    """One or two bytes have no trigram: what is declared decides; blanks stay unknown."""
    long = {"en": "the weather of the day was fine and the wind came from the sea ", "de": "das Wetter war heute schön und der Wind kam von der See her "}
    rows = [(i, long[lang] * 3, lang, "s") for i, lang in enumerate(["en", "de"] * 20)]
    rows += [(100, "ok", "en", "t"), (101, "A.", "de", "t"), (102, " ", "en", "t"), (103, "", "en", "t"), (104, None, "en", "t"), (105, "\t\n", "de", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.language, r.accepted) for r in language.identified_documents(df, ["doc_id"]).collect()}
    assert got[100] == ("en", True) and got[101] == ("de", True)
    assert all(got[i] == ("und", False) for i in (102, 103, 104, 105))
    assert all(got[i] == (rows[i][2], True) for i in range(40))


def test_priors_dealt_with_salt_are_the_same(spark, monkeypatch):
    rows = [(i, "the weather of the day was fine " * 2 if i % 3 else "das Wetter war heute schön " * 2, "en" if i % 3 else "de", f"s{i % 5}" if i % 7 else None) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    one = sorted(map(tuple, language.identified_documents(df, ["doc_id"]).collect()))
    monkeypatch.setattr(language, "MAX_BROADCAST", 0)
    assert sorted(map(tuple, language.identified_documents(df, ["doc_id"]).collect())) == one
    monkeypatch.setattr(language, "MAX_LANGUAGES", 1)
    assert {r[1] for r in language.identified_documents(df, ["doc_id"]).collect()} <= {"en", "und"}
