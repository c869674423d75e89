"""Prefix join, importance resampling and hard negatives against plain forms, with odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from tidegate.llm import hard_negatives, importance, prefix_join


# Prefix join

def sets_of(text, n):
    words = tuple(brute.SPACED.findall(brute.lower(text)))
    return {words[i:i + n] for i in range(len(words) - n + 1)} if len(words) >= n else ({words} if words else set())


def linked_components(rows, n, percent):
    """(doc_id, set size, smallest id reachable) of every row; an id on several rows is one document."""
    made = [(i, sets_of(t, n)) for i, t in rows]
    root = {i: i for i, _ in made if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for k, (i, a) in enumerate(made):
        for j, b in made[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else find(i)) for i, s in made)


def family_rows(size=60, seed=3):
    """Near copies of a few texts around the limit, a shared passage, short texts, odd texts and repeated ids."""
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") + str(draw.randrange(400))
    passage = [word() for _ in range(25)]
    rows = []
    for family in range(3):
        base = [word() for _ in range(80)]
        for copy in range(size):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                text[draw.randrange(len(text))] = word()
            rows.append((1000 + 100 * family + copy, " ".join(text)))
    rows += [(2000 + i, " ".join([*passage, *(word() for _ in range(draw.randrange(60)))])) for i in range(size)]
    rows += [(3000 + i, " ".join(word() for _ in range(i % 4))) for i in range(12)]
    return [*rows, *brute.odd_rows(), (1000, rows[-1][1]), (1005, "a text of its own under an id that is taken")]


@pytest.mark.parametrize("block", [1024, 8])
def test_prefix_join(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_join, "BLOCK", block)
    rows = family_rows()
    got = prefix_join.similar_documents(brute.documents(spark, rows), 4, 85).collect()
    assert Counter(map(tuple, got)) == linked_components(rows, 4, 85)


def test_prefix_join_defaults_and_empty_table(spark):
    rows = family_rows(15)
    got = prefix_join.similar_documents(brute.documents(spark, rows)).collect()
    assert Counter(map(tuple, got)) == linked_components(rows, 5, 80)
    assert prefix_join.similar_documents(brute.documents(spark, [])).collect() == []
    alone = brute.documents(spark, [(None, None), (None, "x y z"), (7, "")])
    assert sorted(map(tuple, prefix_join.similar_documents(alone).collect()), key=str) == [(7, 0, 7), (None, 0, None), (None, 1, None)]


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_prefix_lengths_leave_no_pair_out(percent):
    """Sets that just reach the limit share a member within both prefixes."""
    for n in range(1, 60):
        for m in range(n, 60):
            least = prefix_join.least_overlap(n, m, percent)
            if least <= n:
                assert n - least + 1 <= prefix_join.index_length(n, percent)
                assert m - least + 1 <= prefix_join.probe_length(m, percent)


def test_common_grams_count_all_texts(spark):
    rows = [(i, "one two three four five " + " ".join(f"w{i}x{k}" for k in range(4))) for i in range(40)]
    texts = brute.documents(spark, rows).repartition(3)
    grams, power = prefix_join.common_grams(texts, 3, 4)
    # Two runs of four words are in every text.
    assert len(grams) == 2 and set(power.tolist()) == {5}
    assert len(prefix_join.common_grams(texts, 1, 4, most=1)[0]) == 0


def test_prefixes_that_one_text_has_are_not_stored(spark, monkeypatch):
    """Of the prefixes only n-grams of several texts are written, whatever the number of ranges they are dealt over."""
    stored, keep = {}, prefix_join.written

    def written(df, label):
        stored[label] = keep(df, label)
        return stored[label]
    monkeypatch.setattr(prefix_join, "written", written)
    monkeypatch.setattr(prefix_join, "RANGE", 64)
    text = " ".join(f"s{k}" for k in range(60))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(40)] + [(100, text), (101, text + " more")]
    got = prefix_join.similar_documents(brute.documents(spark, rows).repartition(3), 4, 85).collect()
    assert Counter(map(tuple, got)) == linked_components(rows, 4, 85)
    assert {r["node"] for r in stored["postings"].collect()} == {100, 101}


def test_rounds_end_when_one_joins_nothing(spark, monkeypatch):
    """Groups of several blocks whose texts share passages and are unlike: one round, then all are compared in the same groups."""
    labels, keep = [], prefix_join.written

    def written(df, label):
        labels.append(label)
        return keep(df, label)
    monkeypatch.setattr(prefix_join, "written", written)
    monkeypatch.setattr(prefix_join, "BLOCK", 4)
    draw = random.Random(8)
    passages = [" ".join(f"p{k}x{i}" for i in range(30)) for k in range(20)]
    chosen = {tuple(sorted(draw.sample(range(20), 3))) for _ in range(60)}
    rows = [(i, " ".join(passages[k] for k in mine)) for i, mine in enumerate(sorted(chosen))]
    got = prefix_join.similar_documents(brute.documents(spark, rows), 4, 85).collect()
    assert Counter(map(tuple, got)) == linked_components(rows, 4, 85) == Counter((i, 87, i) for i, _ in rows)
    assert labels.count("groups") == 1 and labels.count("links") == 2


# Importance resampling

def importance_rows(rows, target, longest, percent=10, buckets=10_000):
    def features(text):
        words = brute.ALNUM.findall(brute.lower(text))
        return [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)
    made = [(i, *features(t)) for i, t in rows]
    source, wanted = Counter(b for _, f, _ in made for b in f), Counter(b for t in target for b in features(t)[0])
    total, other = sum(source.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (total + buckets) / ((n + 1) * (other + buckets)))) for b, n in source.items()}
    out = []
    for i, f, n in made:
        weight, score = sum(gain[b] for b in f), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score, n))
    able = sorted((r for r in out if r[4] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))
    left = Counter()
    ranks = {}
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        ranks[r, left[r]] = rank
        left[r] += 1
    seen, result = Counter(), []
    for r in out:
        result.append((*r[:4], ranks.get((r, seen[r]))))
        seen[r] += 1
    return Counter(result)


@pytest.mark.parametrize("longest,percent", [(1, 10), (2, 40), (3, 100)])
def test_importance(spark, longest, percent):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice(["alpha", "beta-x", "GAMMA", "déjà", "q1"]) for _ in range(draw.randrange(60)))) for i in range(80)]
    rows = [*rows, *brute.odd_rows(100), rows[3], rows[3], (3, rows[4][1])]
    target = ["alpha beta x alpha", None, "", "déjà vu"]
    items = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id int, text string, doc_id int")
    got = importance.resample(brute.documents(spark, rows), items, longest, percent=percent).collect()
    assert Counter(map(tuple, got)) == importance_rows(rows, target, longest, percent)


def test_importance_without_rows(spark):
    items = spark.createDataFrame([("a", "alpha beta")], "item_id string, text string")
    assert importance.resample(brute.documents(spark, []), items).collect() == []
    rows = [(1, "alpha " * 30), (2, None)]
    got = importance.resample(brute.documents(spark, rows), items.limit(0), percent=100).collect()
    assert Counter(map(tuple, got)) == importance_rows(rows, [], 1, 100)


def test_grams_overlap_and_keep_to_words():
    text = importance.collapse("  Don't--STOP, now\n été ".encode())
    assert text == "don t stop now été".encode()
    assert [g.decode() for g in importance.grams(text, 2)] == ["don t", "t stop", "stop now", "now été"]
    assert list(importance.grams(b"", 1)) == []
    assert importance.text_buckets(b"word " * 1_000_000, 1)[1] == 1_000_000


# Hard negatives

def mined(rows):
    """All results by sorting every row for every anchor."""
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    vectors = {i: (label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a, (own, x) in vectors.items():
        if a % 100:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y)), i, label) for i, (label, y) in vectors.items() if i != a)
        for s, i, _ in [r for r in scores if r[2] == own][:5]:
            found = [r for r in scores if r[2] != own and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, i, k, r[1], -s, -r[0]) for k, r in enumerate(found, 1)]
    return sorted(out)


def vector_rows(n=700, width=6, seed=9):
    draw = random.Random(seed)
    rows = [(i, [draw.gauss(0, 1) for _ in range(width)], draw.randrange(3)) for i in range(n)]
    rows += [(n + i, rows[5][1], i % 3) for i in range(40)]
    rows += [(1000, None, 1), (1100, [1.0] * width, None), (None, [1.0] * width, 1), (1200, [1.0, None] * 3, 1), (1300, [math.nan] * width, 1),
             (1400, [math.inf] * width, 1), (1500, [0.0] * width, 1), (1600, [], 2), (1700, [3.0, -1.0], 0), rows[100], (200, rows[7][1], 2)]
    return rows


def table(spark, rows):
    made = [(i, v, label, "x", 1) for i, v, label in rows]
    return spark.createDataFrame(made, "vec_id bigint, embedding array<float>, label int, vector string, tree int")


@pytest.mark.parametrize("block,leaf,least,anchors", [(4096, 1024, 256, 4096), (90, 4, 2, 3)])
def test_hard_negatives(spark, monkeypatch, block, leaf, least, anchors):
    for name, value in (("BLOCK", block), ("LEAF", leaf), ("LEAST", least), ("ANCHORS", anchors)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vector_rows()
    got = sorted(map(tuple, hard_negatives.hard_negatives(table(spark, rows)).collect()))
    assert got == mined(rows) and got


def test_hard_negatives_without_rows(spark):
    rows = [(100, [1.0, 2.0], 1), (101, [1.0, 2.0], 1)]
    assert hard_negatives.hard_negatives(table(spark, [])).collect() == []
    assert hard_negatives.hard_negatives(table(spark, rows)).collect() == []
    assert hard_negatives.hard_negatives(table(spark, [(None, None, None), (100, None, 1)])).collect() == []


def test_tree_covers_its_rows_and_skips():
    draw = np.random.default_rng(2)
    centres = draw.integers(-2000, 2000, (40, 8))
    vectors = np.concatenate([c + draw.integers(-20, 20, (50, 8)) for c in centres]).astype(float)
    made = hard_negatives.build_tree(vectors)
    assert sorted(made["order"].tolist()) == list(range(len(vectors)))
    points = hard_negatives.augmented(vectors, made["longest"])[made["order"]]
    for centre, radius, start, stop in zip(*(made[k] for k in ("centre", "radius", "start", "stop"))):
        assert np.linalg.norm(points[start:stop] - points[centre], axis=1).max() <= radius + 1e-9
    row = {k: v.tobytes() for k, v in made.items() if isinstance(v, np.ndarray)} | {
        "vec_id": made["order"].tobytes(), "label": np.zeros(len(vectors), np.int64).tobytes(),
        "vectors": vectors[made["order"]].tobytes(), "longest": made["longest"]}
    tree, scored = hard_negatives.Tree(row), []
    query = vectors[3]
    found = tree.search(query, lambda rows: scored.append(len(rows)) or np.ones(len(rows), bool), [(-np.inf, np.inf)], 5)[0]
    every = sorted((-int(v @ query), i) for i, v in enumerate(vectors))
    assert found == every[:5]
    assert sum(scored) < len(vectors) // 2
