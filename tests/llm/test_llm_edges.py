"""Inputs the given tables do not hold: special strings, unmarked pages, copies of a labelled id, very long labelled texts."""

import zlib

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tidegate.llm import html_blocks, labelled, packing

END = "<|endoftext|>"


def test_special_strings_have_the_ids_of_the_json_tokenizer(spark):
    texts = [END, f"hello {END} world", f"{END}{END}x", f"a{END} \n{END}", "<|endoftext |>", "word " * 1023 + END, f"{'word ' * 1100}{END}{'word ' * 1100}"]
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, text in enumerate(texts):
        ids = np.array(encoder.encode(text, add_special_tokens=False).ids + [2], "<u4")
        edges = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        want += [(i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(edges, edges[1:]))]
    rows = brute.documents(spark, list(enumerate(texts)))
    got = packing.packed_digest(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)


def plain_best_fit(lengths, limits):
    """The sequence of every piece by looking at every sequence, the first of equals as the library numbers them."""
    size = limits.capacities()
    weights, bins, out = np.array(limits.weights), [], []
    for n in lengths:
        piece = np.array([n, 1, n * n]) / size
        score = []
        for b in bins:
            left = b - piece
            fits = (left >= -1e-12).all()
            score.append(np.inf if not fits else -(weights * piece) @ b if limits.rule == "dot" else weights @ left ** 2)
        at = int(np.argmin(score)) if score and min(score) < np.inf else len(bins)
        if at == len(bins):
            bins.append(np.ones(3))
        bins[at] = bins[at] - piece
        out.append((at, score[at] if at < len(score) else None))
    return out


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents,attention", [(None, None), (5, 6000)])
def test_best_fit_chooses_like_a_plain_one(rule, documents, attention):
    """Equal residuals may swap sequences, so the residual chosen at every step is compared, not its number."""
    limits = packing.Limits(tokens=100, documents=documents, attention=attention, rule=rule)
    lengths = np.sort(np.random.default_rng(4).integers(1, 101, 300))[::-1]
    sequence, _ = packing.best_fit(lengths, limits)
    size, weights = limits.capacities(), np.array(limits.weights)
    bins, got = {}, []
    for n, s in zip(lengths, sequence):
        piece = np.array([n, 1, n * n]) / size
        b = bins.get(s)
        got.append(None if b is None else -(weights * piece) @ b if rule == "dot" else weights @ (b - piece) ** 2)
        bins[s] = (np.ones(3) if b is None else b) - piece
    want = [score for _, score in plain_best_fit(lengths, limits)]
    assert [g is None for g in got] == [w is None for w in want]
    assert np.allclose([g for g in got if g is not None], [w for w in want if w is not None])


def test_copies_of_a_labelled_id_are_one_text(spark):
    docs = spark.range(100_000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "concat('copy ', id) AS text").union(
        spark.range(40).selectExpr("id + 100 AS doc_id", "concat('text ', id) AS text"))
    labels = spark.range(200).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    sample, share = labelled.labelled_sample(docs, labels, "quality", {0: 100, 1: 100})
    assert share == {0: 1.0, 1: 1.0} and sample["doc_id"].to_pylist() == [7, *range(100, 140)]
    again, _ = labelled.labelled_sample(docs.repartition(7), labels, "quality", {0: 100, 1: 100})
    assert again.equals(sample)


def test_long_labelled_texts_stay_below_the_byte_bound(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat('long text ', IF(id % 3 = 0, 100000, 10)) AS text")
    labels = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    sample, share = labelled.labelled_sample(docs, labels, "quality", {0: 100, 1: 100}, most=4_000_000)
    assert sum(len(t) for t in sample["text"].to_pylist()) <= 4_000_000
    ids = sample["doc_id"].to_pylist()
    assert {i for i in range(60) if i % 3} <= set(ids) and len(ids) == 42
    assert share == {k: sum(i % 2 == k for i in ids) / 30 for k in (0, 1)}


P = "The council said on Monday that it would open the old bridge to traffic for the first time in years"  # 100 characters
LONG = f"{P} of repairs. {P} and more. {P}."
BESIDE = f"<div class='sidebar'><p>{LONG}</p></div>"


@pytest.mark.parametrize("page,text", [
    ("<div>" + f"<p>{P}.</p>" * 8 + "</div>", "\n".join([f"{P}."] * 8)),
    ("<div>" + f"<p>{P}.</p>" * 3 + "</div><div><a href='/'>Home</a> <a href='/a'>All of the news and what is in it for you today and every day</a></div>",
     "\n".join([f"{P}."] * 3)),
    *((f"<div class='{name}'><p>{LONG}</p></div>{BESIDE}", LONG) for name in (
        "site has-sidebar", "layout-no-sidebar", "social-science", "post notice-board", "with-comments", "menu-of-the-day")),
    *((f"<div class='{name}'><p>{LONG}</p></div><p>{LONG} End.</p>", f"{LONG} End.") for name in (
        "sidebar", "left-sidebar", "main-nav", "cookie-notice", "post-comments", "related posts", "ad-slot-3")),
    (f"<div class='has-sidebar'><article><h1>Head</h1><p>{LONG}</p></article></div>", f"Head\n{LONG}"),
    (f"<form action='/page.aspx'><div><h1>Head</h1><p>{LONG}</p></div><div class='footer'>© 2020</div></form>", f"Head\n{LONG}"),
    (f"<form><p>{LONG}</p></form>", LONG),
    (f"<p>{LONG}</p><form><p>{P}, and you can have it by mail.</p></form>", LONG),
    (f"<p>{LONG}</p><svg viewBox='0 0 1 1'/><math /><p>{LONG} End.</p>", f"{LONG}\n{LONG} End."),
    (f"<title-card></title-card><p>{LONG}</p><object-viewer></object-viewer><p>{LONG} End.</p>", f"{LONG}\n{LONG} End."),
    (f"<p>{LONG}</p><svg><text>in a picture</text></svg><select><option>x</select><p>{LONG} End.</p>", f"{LONG}\n{LONG} End."),
])
def test_articles_without_marks_stay(page, text):
    assert html_blocks.main_text(f"<html><body>{page}</body></html>") == text
