"""Quality rules on repetition: characters inside repeated n-grams and lines.

Rolling hashes of several n-gram lengths are computed over all words of an Arrow slice
at once; an n-gram is repeated when its hash occurs twice or more in the same text. The
rules look at the share of word characters covered by repeated long n-grams, by the most
frequent short n-gram, and by repeated lines, with limits that widen for short n-grams.

Words are separated by blanks and \\x09-\\x0D and compared as they are. A null or empty
text has no words and fails; repeated rows give equal results; columns other than the id
and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_slices
from .words import Words, _byte_set, char_counts, hash_spans, mix, windows

#: Largest share of characters inside n-grams that occur twice or more, by n.
REPEATED_SHARE = {5: 0.30, 6: 0.28, 8: 0.24, 10: 0.20}
#: Largest share of characters inside the most frequent n-gram, by n.
TOP_SHARE = {2: 0.30, 3: 0.26, 4: 0.24}
LINE_SHARE = 0.30
SYMBOL_SHARE = 0.10
MIN_TOP_COUNT = 4

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NEWLINE = _byte_set((0x0A, 0x0A))

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "repeated_share double, top_share double, dup_line_share double, rules array<string>")


def _owned(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Keys that also tell the row apart."""
    return mix(keys + rows.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def _occurrences(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.ones(len(keys), np.int64)
    if len(twice):
        count = np.searchsorted(ordered, twice, "right") - np.searchsorted(ordered, twice)
        at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        hit = twice[at] == keys
        out[hit] = count[at[hit]]
    return out


def _seen_before(keys: np.ndarray) -> np.ndarray:
    """Whether an earlier key equals this one."""
    out = np.ones(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = False
    return out


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in one of the ``n``-word windows that begin at ``starts``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _sum(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def measure(column) -> dict[str, np.ndarray]:
    """All measures of the texts of one Arrow column, as one array per measure."""
    words = Words(column, lower=False)
    rows, hashes, chars = words.rows, words.hashes(), char_counts(words.data)
    length = chars[words.end] - chars[words.start]
    word_chars = _sum(length, words.row, rows)
    whole = np.maximum(word_chars, 1)
    repeated, top = {}, {}
    for n in sorted({*REPEATED_SHARE, *TOP_SHARE}):
        keys, at = windows(hashes, words.row, n)
        count = _occurrences(_owned(keys, words.row[at]))
        if n in REPEATED_SHARE:
            inside = _covered(at[count > 1], n, len(words))
            repeated[n] = _sum(length * inside, words.row, rows) / whole
            if n == 5:
                repeat_words = _sum(inside, words.row, rows)
        else:
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
            size = (ends[at + n] - ends[at]) * np.where(count >= MIN_TOP_COUNT, count, 0)
            best = np.zeros(rows, np.int64)
            np.maximum.at(best, words.row[at], size)
            top[n] = best / whole
    lines = Words(column, _NEWLINE, lower=False)
    position = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
    filled = position[1] > position[0]
    start, end, row = lines.start[filled], lines.end[filled], lines.row[filled]
    later = _seen_before(_owned(hash_spans(lines.data, start, end), row))
    line_chars = chars[end] - chars[start]
    marks = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_SYMBOLS[words.data], out=marks[1:])
    return {
        "n_words": words.counts(), "word_chars": word_chars, "n_symbols": marks[words.offsets[1:]] - marks[words.offsets[:-1]],
        "n_dup_lines": _sum(later, row, rows), "n_repeat_words": repeat_words, "repeated": repeated, "top": top,
        "dup_line_share": _sum(line_chars * later, row, rows) / np.maximum(_sum(line_chars, row, rows), 1),
    }


def rules_broken(found: dict[str, np.ndarray]) -> list[list[str]]:
    """Names of the rules that each text breaks."""
    tests = {f"repeated_{n}": found["repeated"][n] > most for n, most in REPEATED_SHARE.items()}
    tests |= {f"top_{n}": found["top"][n] > most for n, most in TOP_SHARE.items()}
    tests["dup_lines"] = found["dup_line_share"] > LINE_SHARE
    tests["symbols"] = found["n_symbols"] > SYMBOL_SHARE * np.maximum(found["word_chars"], 1)
    tests["short"] = found["n_words"] < 10
    broken: list[list[str]] = [[] for _ in found["n_words"]]
    for name, failed in tests.items():
        for i in np.flatnonzero(failed):
            broken[i].append(name)
    return broken


def repetition(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures and broken rules of every text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(batch.column(1))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), **{k: found[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
            "repeated_share": np.maximum.reduce(list(found["repeated"].values())),
            "top_share": np.maximum.reduce(list(found["top"].values())), "dup_line_share": found["dup_line_share"],
            "rules": pa.array(rules_broken(found), pa.list_(pa.string())),
        })
    return map_slices(documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")), work, SCHEMA)


def quality_rules(documents: DataFrame) -> DataFrame:
    """The base counts and the verdict per document."""
    found = repetition(documents)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.size("rules") == 0)).alias("kept"), "rules")
