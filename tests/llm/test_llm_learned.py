"""Learned operators: held-out accuracy, odd rows and the text operators without an exact form."""

import brute
import numpy as np
import pytest

from tidegate.llm import html_blocks, language, neighbours, queries, toxicity

MEDIUM = "/root/testdata/sf0.01"


def joined(spark, query, other, column):
    scored = queries.QUERIES[query](spark, MEDIUM)
    truth = spark.read.parquet(f"{MEDIUM}/{other}.parquet").select("doc_id", column)
    return [r.asDict() for r in scored.join(truth, "doc_id").where("held_out").collect()]


def auc(rows, label):
    good = np.array([r["score"] for r in rows if r[label] == 1])
    bad = np.array([r["score"] for r in rows if r[label] == 0])
    return ((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])).mean()


def test_language_held_out(spark):
    rows = joined(spark, "op2_cross_parsing", "documents", "lang")
    assert len(rows) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98


def test_toxicity_held_out(spark):
    assert auc(joined(spark, "op6_noisy_or", "labels", "toxic"), "toxic") > 0.85


def test_quality_held_out(spark):
    rows = joined(spark, "op10_neighbour_vote", "labels", "quality")
    assert auc(rows, "quality") > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


@pytest.fixture(scope="module")
def odd(spark):
    rows = brute.odd_rows() + [(200 + i, "you are a nasty thing . fine day") for i in range(20)] + [(300 + i, "what a fine day it is") for i in range(20)]
    docs = brute.documents(spark, rows)
    labels = spark.createDataFrame(
        [(i, 1 if 200 <= i < 220 else 0, 0 if 200 <= i < 220 else 1) for i, _ in rows if i is not None and i >= 200] + [(None, 1, 1), (5, None, None)],
        "doc_id bigint, toxic int, quality int")
    return rows, docs, labels


def test_toxicity_odd_rows(spark, odd):
    rows, docs, labels = odd
    scored = toxicity.toxicity(docs, labels)
    got = [r.asDict() for r in scored.collect()]
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (200 <= r["doc_id"] < 220) for r in got if r["doc_id"] and r["doc_id"] >= 200)
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (0, 1, 2, 3))
    model = toxicity.train(docs, labels)
    text = dict(rows)
    found = toxicity.offending_sentences(docs, model).collect()
    assert found and all("nasty" in text[r["doc_id"]][r["start"]:r["end"]] for r in found)


def test_quality_odd_rows(spark, odd):
    rows, docs, labels = odd
    got = [r.asDict() for r in neighbours.quality(docs, labels).collect()]
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["doc_id"] >= 300) for r in got if r["doc_id"] and r["doc_id"] >= 200)
    model = neighbours.train(docs, labels)
    left = neighbours.accepted(docs, model)
    assert left.columns == docs.columns and left.where("doc_id BETWEEN 200 AND 219").isEmpty()
    assert neighbours.accepted(docs, neighbours.train(docs, labels.limit(0))).count() == len(rows)


def test_language_odd_rows(spark, odd):
    rows, docs, _ = odd
    got = {r["doc_id"]: r for r in language.language_id(docs).collect()}
    assert got[0]["lang_pred"] == "und" and all(r["score"] == 0 for r in got.values())  # nothing is labelled
    model = language.Model({"aa": "la le li lo lu " * 40, "bb": "zu zo zi ze za " * 40})
    found = {r["doc_id"]: r for r in language.predict_language(brute.documents(spark, [
        (1, "lo li la"), (2, "za ze"), (3, None), (4, "12 !"), (5, "漢"), (6, "zu " * 9000)]), model).collect()}
    assert [found[i]["lang_pred"] for i in range(1, 7)] == ["aa", "bb", "und", "und", "aa", "bb"]


ARTICLE = "This is the text of the article and it is one that was written for you by the people who have it. " * 3


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p>", ""), ("<!-- never closed <p>x</p>", ""), ("<script>var a = '<p>no</p>'", ""),
    (f"<nav><p>{ARTICLE}</p></nav><p>{ARTICLE}</p><footer>{ARTICLE}</footer>", ARTICLE.strip()),
    (f"<body><div class='sidebar'>{ARTICLE}</div><h1>Head</h1><p>{ARTICLE}<p>Short.</p></body>", f"Head\n{ARTICLE.strip()}\nShort."),
    (f"<main><h1>A &amp; B</h1><p>x <b>y</b>z<br>w\n\t v</p></main><p>{ARTICLE}</p>", "A & B\nx yz w v"),
    (f"<article><p>{ARTICLE}</p><section id='comments'><p>{ARTICLE}</p></section><form><p>{ARTICLE}</p></form></article>", ARTICLE.strip()),
    (f"<p><a href='/x'>{ARTICLE}</a></p>", ""), ("<p>1 &lt; 2 a < b</p>", ""), ("<article>1 &lt; 2 and a < b &eacute;</article>", "1 < 2 and a < b é"),
    (f"<div>{ARTICLE}</div><div style='display: none'>{ARTICLE}</div><div hidden>{ARTICLE}</div>", ARTICLE.strip()),
    ("<article><p class='ad'>Buy.</p><p>One | two</p></article>", "One | two"),
])
def test_main_text(page, text):
    assert html_blocks.main_text(page) == text


def test_pages(spark):
    made = html_blocks.extract_text(spark.createDataFrame(
        [(1, "u", None, "x"), (None, None, f"<p>{ARTICLE}</p>", "y"), (2, "u", f"<p>{ARTICLE * 2000}</p>", "z")],
        "page_id bigint, url string, html string, text string")).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["n_chars"]) for r in made) == [
        (0, "", len(ARTICLE) - 1), (1, "u", 0), (2, "u", len(ARTICLE) * 2000 - 1)]
    assert all(len(r["text"]) == r["n_chars"] for r in made)
