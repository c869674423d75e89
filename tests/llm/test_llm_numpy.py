"""Array helpers of the text operators against plain Python."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegate.llm import language, odd_sketch, words
from tidegate.llm.elias_fano import Sequence, _pack, _unpack, encode

TEXT = st.text(st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT, st.sampled_from(["a b  c", " a", "A\tb\n", "ab ab ab ab ab"])), max_size=8))
def test_words(column):
    found = words.Words(brute.texts(column))
    expected = [brute.SPACED.findall(brute.lower(t)) for t in column]
    raw = found.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(found.start, found.end)] == [w for ws in expected for w in ws]
    assert found.counts().tolist() == [len(ws) for ws in expected]
    flat = [w for ws in expected for w in ws]
    assert len(set(found.hashes().tolist())) == len(set(flat))
    assert dict(zip(flat, found.hashes().tolist())) == {w: h for w, h in zip(flat, found.hashes().tolist())}


def test_hashes_do_not_depend_on_place(monkeypatch):
    text = " ".join(random.Random(3).choices(["alpha", "beta", "x" * 700, "é", "漢字"], k=900))
    whole = words.Words(pa.array([text])).hashes()
    monkeypatch.setattr(words, "_BLOCK", 64)
    assert (words.Words(pa.array(["pad", text])).hashes()[1:] == whole).all()


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 90, 7, 1, 1)] + [None, "b"]})
    parts = list(words.slices(batch, limit=10))
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    assert len(parts) > 2


@pytest.mark.parametrize("n,universe", [(0, 1), (1, 1), (7, 9), (500, 500), (500, 10 ** 6), (3000, 2 ** 64 - 1), (9000, 20000)])
def test_elias_fano(n, universe):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, universe, n, np.uint64)) if n else np.zeros(0, np.uint64)
    asked = np.concatenate([draw.integers(0, universe, 500, np.uint64), values])
    sequence = Sequence(np.concatenate([np.zeros(3, np.uint64), encode(values, universe)]), 3)
    assert (sequence.access(np.arange(n)) == values).all()
    assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()
    if n == len(np.unique(values)):
        place = np.searchsorted(values, asked)
        there = (place < n) & (values[np.minimum(place, max(n - 1, 0))] == asked) if n else np.zeros(len(asked), bool)
        assert (sequence.find(asked) == np.where(there, place, -1)).all()


def test_packed_bits():
    for width in (0, 1, 7, 31, 64):
        values = np.random.default_rng(width).integers(0, max(1, 2 ** width - 1), 333, np.uint64)
        assert (_unpack(_pack(values, width), np.arange(333), width) == (values if width else 0)).all()


def test_odd_sketch_estimate():
    draw = np.random.default_rng(5)
    for share in (0.8, 0.9, 0.97):
        n = 2000
        both = int(2 * n * share / (1 + share))
        pool = draw.integers(0, 1 << 63, 2 * n, np.uint64)
        keys = [np.unique(pool[:n]), np.unique(np.concatenate([pool[:both], pool[n:2 * n - both]]))]
        made = odd_sketch.sketches(np.repeat([0, 1], [len(k) for k in keys]), np.concatenate(keys), 2)
        differ = np.bitwise_count(made["bits"][0] ^ made["bits"][1]).sum()
        assert abs(odd_sketch.estimate(differ) - share) < 0.15


def test_join_block_confirms_on_whole_sets():
    keys = words.mix(np.arange(1, 300, dtype=np.uint64))
    sets = [np.sort(keys[part]) for part in (slice(0, 100), slice(0, 80), slice(20, 100), slice(150, 250), slice(0, 100))]
    made = odd_sketch.sketches(np.repeat(np.arange(5), [len(s) for s in sets]), np.concatenate(sets), 5)
    label = odd_sketch.join_block(np.zeros(5, int), made["bits"].view(np.uint64), sets)
    assert label.tolist() == [0, 0, 0, 3, 0]


def _phrases(text, sample):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at:at + size] in sample:
            size += 1
        at += max(1, size - 1)
        count += 1
    return count


def test_cross_parsing_is_greedy_longest_match():
    draw = random.Random(1)
    samples = {k: "".join(draw.choices(a, k=300)) for k, a in (("x", "ab "), ("y", "abc "), ("z", "bcd "))}
    model = language.Model(samples)
    cleaned = {k: bytes(language.clean(pa.array([v]))[0]) for k, v in samples.items()}
    column = ["".join(draw.choices("abcde ", k=n)) for n in (1, 5, 80, 255, 700)] + ["", "a"]
    data, offsets = language.clean(pa.array(column))
    got = model.phrases(data, offsets)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        text = bytes(data[a:b])
        pieces = [text[k:k + language.PIECE] for k in range(0, len(text), language.PIECE)]
        assert got[i].tolist() == [sum(_phrases(p, cleaned[k]) for p in pieces) for k in model.languages]
