"""Operators whose registered query must do the whole job, not a cut of it."""

import math
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

import public_tokenizers
from tidegate.llm import html_blocks, language, odd_sketch, packing, pii, queries

SMALL = "/root/testdata/sf0.001"


def whole_model(rows, discount=0.75):
    """Score of each (doc_id, text) row under a trigram model that keeps every pair and triple of training."""
    tokens = [(i, brute.SPACED.findall(brute.lower(t)) + [None]) for i, t in rows]
    train = [t for i, t in tokens if brute.crc_rest(i, 10)]
    one, two, three = (Counter(g for t in train for g in zip(*(t[k:] for k in range(n)))) for n in (1, 2, 3))
    total, words = sum(one.values()), len(one)
    once, twice = (sum(c == k for c in one.values()) for k in (1, 2))
    first = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    rest = defaultdict(lambda: 1.0)
    for grams, below in ((two, one), (three, two)):
        for gram, n in grams.items():
            rest[gram[:-1]] -= (n - discount) / below[gram[:-1]]
    out = []
    for i, text in tokens:
        score = 0.0
        for k, w in enumerate(text):
            p = (one[w,] - first if one[w,] else first * words) / total
            for grams, below, gram in ((two, one, tuple(text[max(0, k - 1):k + 1])), (three, two, tuple(text[max(0, k - 2):k + 1]))):
                if len(gram) == (2 if grams is two else 3) and below[gram[:-1]]:
                    p = p * rest[gram[:-1]] + max(grams[gram] - discount, 0) / below[gram[:-1]]
            score += math.log10(min(1.0, p))
        out.append((i, score))
    return out


def test_language_model_keeps_what_is_seen_once(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op1_ngram_trie"](spark, SMALL).collect()}
    want = dict(whole_model(rows))
    assert got.keys() == want.keys()
    assert np.allclose([got[i] for i in want], list(want.values()), rtol=0.005)


@pytest.mark.parametrize("account", [
    "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "NO93 8601 1117 947",
    "MT84 MALT 0110 0001 2345 MTLC AST0 01S"])
@pytest.mark.parametrize("after", ["", ".", " BIC COBADEFFXXX", " BIC X", " 2024-05-01", " 12 34", " EUR 100", " OR CALL US", " AND MORE WORDS IN CAPITALS FOLLOW", " and"])
def test_accounts_before_other_words(account, after):
    text = f"Pay to {account}{after}"
    assert [s for s in pii.text_spans(text) if s[0] == "iban"] == [("iban", 7, 7 + len(account))]
    assert pii.redact(text, [s for s in pii.text_spans(text) if s[0] == "iban"]) == f"Pay to <IBAN>{after}"


def test_accounts_of_unlisted_countries_and_none():
    spans = lambda text: [s for s in pii.text_spans(text) if s[0] == "iban"]
    assert spans("ZZ22 3704 0044 0532 0130 00 BIC X") == [("iban", 0, 27)]  # the longest end that passes
    assert spans("DE88 3704 0044 0532 0130 00 BIC X") == [] and spans("ZZ72 WORD") == [] and spans("QQ11 A B C D E F G H I J K L M N O") == []
    two = "DE89370400440532013000 GB82WEST12345698765432 X"
    assert spans(two) == [("iban", 0, 22), ("iban", 23, 45)]


PROSE = ("This is the text of the article and it is one that was written for you by the people who have it. " * 3).strip()
BODY = f"<div><h1>Head</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p></div>"
TEXT = f"Head\n{PROSE}\nShort.\n{PROSE}"
TEASERS = "".join(f"<article><h2>Other {i}</h2><p>One | two</p></article>" for i in range(4))


@pytest.mark.parametrize("page,text", [
    (BODY, TEXT), (BODY + TEASERS, TEXT), (TEASERS + BODY, TEXT),  # no mark, teasers after and before the body
    (f"<nav><a href='/'>Home</a></nav>{BODY}<article class='comment-body'><p>{PROSE}</p></article>", TEXT),
    (f"{BODY}<article id='comment-7'><p>{PROSE}</p></article><article class='promo card'><p>{PROSE}</p></article>", TEXT),
    (f"<article>{BODY}<article class='comment'><p>{PROSE}</p></article></article>", TEXT),
    (f"{BODY}<main class='comments'><p>{PROSE}</p></main>", TEXT),
    (f"<article class='post no-comments has-sidebar'>{BODY}</article>", TEXT), (f"<article class='post social'>{BODY}</article>", TEXT),
    (f"<main class='with-sidebar'>{BODY}</main>", TEXT), (f"<article>{BODY}</article><p>By me</p>", TEXT),
    (f"<div><p>{PROSE}</p></div>" + "<article><p>Goal for us.</p></article>" * 40, "\n".join([PROSE] + ["Goal for us."] * 40)),
])
def test_marks_are_a_feature(page, text):
    assert html_blocks.main_text(page) == text


@pytest.mark.parametrize("prose", [
    "Gemeenten bouwen volgend jaar duizenden woningen langs nieuwe spoorlijnen, zegt minister Jansen tegenover onze krant. " * 2,
    "Rada miasta przyjęła wczoraj nowy plan zagospodarowania przestrzennego, który obejmuje wszystkie dzielnice nad rzeką. " * 2,
    "Городской совет вчера принял новый план развития, который охватывает все районы вдоль реки и новые линии метро. " * 2,
    "市议会昨天通过了新的发展规划,覆盖沿河所有城区以及新的地铁线路。" * 5])
def test_pages_in_other_languages(prose):
    prose = prose.strip()
    page = f"<nav><a href='/'>Start</a></nav><div><h1>Nieuws</h1><p>{prose}</p><p>{prose}</p></div><footer>{prose}</footer>"
    assert html_blocks.main_text(page) == f"Nieuws\n{prose}\n{prose}"


def test_short_blocks_with_a_linked_word():
    link = "<p>See the <a href='/r'>report</a> of last week.</p>"
    for page in (f"<article><p>{PROSE}</p>{link}<p>{PROSE}</p></article>", f"<div><p>{PROSE}</p>{link}<p>{PROSE}</p></div>"):
        assert html_blocks.main_text(page) == f"{PROSE}\nSee the report of last week.\n{PROSE}"
    assert html_blocks.main_text(f"<p>{PROSE}</p><p><a href='/'>Next</a> page</p>") == PROSE


def test_unlike_texts_of_one_id_stay(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one), (7, one), (7, two), (7, two), (8, two), (9, three), (9, f"{three} more"), (9, None), (None, one), (5, "kept"), (5, "as well")]
    left = odd_sketch.first_of_group(brute.documents(spark, rows))
    assert len(left.columns) == 12
    kept = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr)
    texts = [t for _, t in kept]
    assert (1, one) in kept and (7, one) not in kept and (None, one) in kept
    assert texts.count(two) == 1 and texts.count(three) + texts.count(f"{three} more") == 1
    assert (9, None) in kept and (5, "kept") in kept and (5, "as well") in kept and len(kept) == 7


def test_groups_are_sized_by_pieces(spark, monkeypatch):
    """Few long documents fill as many groups as many short ones."""
    monkeypatch.setattr(packing, "GROUP", 16)
    docs = spark.createDataFrame([(i, f"word{i} and more " * 10_000) for i in range(4)], "doc_id bigint, text string").repartition(1)
    got = packing.packed_digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    sizes = np.unique([r["sequence_id"] >> 32 for r in got], return_counts=True)[1]
    assert len(got) > 100 and len(sizes) == -(-len(got) // 16) and sizes.max() <= 17


def test_language_sample_is_filled_with_distinct_text(spark):
    bound = language.PASSAGES * language.PASSAGE_CHARS
    rows = [(i, f"short text number {i:06d} of many others".ljust(40, "x"), "aa") for i in range(4000)]
    rows += [(9000 + i, "copy " * 100, "bb") for i in range(4000)] + [(20_000 + i, f"other {i:05d} " * 40, "bb") for i in range(200)]
    made = language.passages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert bound <= len(made["aa"]) <= 1.05 * bound and bound <= len(made["bb"]) <= 1.05 * bound
    assert made["bb"].count("copy " * 100) <= 1
