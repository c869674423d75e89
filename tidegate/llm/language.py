"""Language identification by cross-parsing against suffix automata.

For every language a suffix automaton is built over a bounded sample of labelled text.
A new text is parsed against it greedily: each phrase is the longest match with any part
of the sample, and the next phrase begins where the match ends. The fewer phrases a text
needs, weighted by the cost log2(sample size) of pointing into the sample, the closer it
is to the language; the language with the cheapest parse wins.

The sample is drawn from the distinct passages (of ``PASSAGE_CHARS`` characters, or a shorter text's) of the
labelled training text, by a hash of the passage, up to ``PASSAGES`` times ``PASSAGE_CHARS`` characters a language.
The number of learned languages is the number of distinct labels.

Texts are lower-cased; runs of bytes that are no letters become one blank. All texts of a
slice advance together, one byte a step, in pieces of ``PIECE`` bytes; a phrase ends with
its piece, which costs every language the same.

A null text or one without a letter gets ``und`` and score 0, as does every text when no
label is known. Ties go to the language that sorts first. Rows with a null id or label are
not learned from; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import crc_rest, map_slices
from .words import text_bytes

PASSAGES, PASSAGE_CHARS = 64, 512
PIECE = 256
UNDETERMINED = "und"
_FLAG = 1 << 30
_BLANK = 0x20

_KEEP = np.zeros(256, np.uint8)
_KEEP[:] = _BLANK
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def clean(column) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letter bytes of each row, runs of other bytes as one blank, and row offsets."""
    data, offsets = text_bytes(pc.utf8_lower(column))
    data = _KEEP[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != _BLANK) | (data[:-1] != _BLANK)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return data[keep], before[offsets]


def suffix_automaton(text: np.ndarray, symbols: int) -> np.ndarray:
    """Transitions of the smallest automaton of all parts of ``text``; -1 where there is none."""
    follow: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in text.tolist():
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in follow[at]:
            follow[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = follow[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and follow[at].get(symbol) == target:
                    follow[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    table = np.full((len(follow), symbols), -1, np.int32)
    for state, edges in enumerate(follow):
        for symbol, target in edges.items():
            table[state, symbol] = target
    return table


def parser(table: np.ndarray) -> np.ndarray:
    """The parsing steps of an automaton: row offset of the next state, flagged where a new phrase begins.

    One more state, the last, stands before the first symbol and behind a symbol that the sample
    lacks: every symbol begins a phrase there. The last symbol pads a piece and changes nothing.
    """
    states, symbols = table.shape
    restart = np.where(table[0] >= 0, table[0], states)
    steps = np.empty((states + 1, symbols), np.int64)
    steps[:states] = np.where(table >= 0, table * symbols, restart * symbols + _FLAG)
    steps[states] = restart * symbols + _FLAG
    steps[:, symbols - 1] = np.arange(states + 1) * symbols
    return steps.astype(np.int32).ravel()


class Model:
    """Parsers of all languages over one alphabet of bytes."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        cleaned = [clean(pa.array([samples[name]]))[0] for name in self.languages]
        used = np.unique(np.concatenate([*cleaned, np.array([_BLANK], np.uint8)]))
        self.symbols = len(used) + 2  # byte 0: never seen; last: padding
        self.symbol = np.zeros(256, np.int32)
        self.symbol[used] = np.arange(1, len(used) + 1)
        self.cost = np.log2([max(2, len(text)) for text in cleaned])
        self.steps = [parser(suffix_automaton(self.symbol[text], self.symbols)) for text in cleaned]

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of phrases of each row (first axis) against each language."""
        size = np.diff(offsets)
        pieces = -(-size // PIECE)
        row = np.repeat(np.arange(len(size)), pieces)
        begin = offsets[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
        place = begin[None, :] + np.arange(PIECE)[:, None]
        codes = np.full(place.shape, self.symbols - 1, np.int32)
        inside = place < offsets[1:][row][None, :]
        codes[inside] = self.symbol[data[place[inside]]]
        out = np.zeros((len(size), len(self.languages)), np.int64)
        for k, steps in enumerate(self.steps):
            state, count = np.full(len(row), len(steps) - self.symbols, np.int32), np.zeros(len(row), np.int32)
            for symbol in codes:
                moved = steps[state + symbol]
                count += moved >> 30
                state = moved & (_FLAG - 1)
            out[:, k] = np.bincount(row, weights=count, minlength=len(size))
        return out

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the share of 2^-cost that the winner holds."""
        data, offsets = clean(column)
        letters = np.concatenate([np.zeros(1, np.int64), np.cumsum((data >= 97) & (data < 123))])[offsets]
        high = np.concatenate([np.zeros(1, np.int64), np.cumsum(data >= 128)])[offsets]
        known = np.diff(letters) > 0
        for i in np.flatnonzero(~known & (np.diff(high) > 0)):
            known[i] = any(c.isalpha() for c in column[int(i)].as_py())
        if not self.languages:
            return [UNDETERMINED] * len(known), np.zeros(len(known))
        bits = self.phrases(data, offsets) * self.cost
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
        return [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)], np.where(known, share, 0.0)


def passages(labelled: DataFrame) -> dict[str, str]:
    """A bounded sample of the labelled text of each language, as one text; columns doc_id, text, lang."""
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    parts = known.select("lang", "text", F.explode(F.expr(f"sequence(0, (length(text) - 1) div {PASSAGE_CHARS})")).alias("part")).select(
        "lang", F.expr(f"substring(text, CAST(part * {PASSAGE_CHARS} + 1 AS INT), {PASSAGE_CHARS})").alias("passage"))
    parts = parts.withColumn("draw", F.pmod(F.xxhash64("passage"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    # Copies add nothing, so shares are of distinct passages: their characters by hash, without a shuffle of the texts.
    marks = parts.select("lang", "draw", F.xxhash64("passage", F.lit(1)).alias("mark"), F.length("passage").alias("n")).distinct()
    sizes = {r["lang"]: r["n"] for r in marks.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return {}
    # Twice the wanted share, so that the bound is reached and not left to chance.
    bound = PASSAGES * PASSAGE_CHARS
    share = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, 2.0 * bound / n))))
    found: dict[str, list[tuple[float, str]]] = {}
    for r in parts.where(F.col("draw") < share[F.col("lang")]).distinct().collect():
        found.setdefault(r["lang"], []).append((r["draw"], r["passage"]))
    sample: dict[str, str] = {}
    for name, rows in found.items():
        chosen, left = [], bound
        for _, passage in sorted(rows):
            if left <= 0:
                break
            chosen.append(passage[:left])
            left -= len(passage)
        sample[name] = " ".join(chosen)
    return sample


def predict_language(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = model.predict(batch.column(1))
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": scores})
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_slices(rows, work, "doc_id bigint, lang_pred string, score double")


def language_id(documents: DataFrame) -> DataFrame:
    """Languages of all documents, learned from those whose id's crc32 modulo 3 is not 1."""
    rest = crc_rest("doc_id", 3)
    model = Model(passages(documents.where(rest != 1).select("doc_id", "text", "lang")))
    found = predict_language(documents, model)
    return found.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
