"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become weighted counts of hashed words and of token shapes (case, length, digits,
last byte, repetition of the token before). A bounded sample of labelled texts gives the
inverse document frequencies and, by a truncated singular value decomposition, ``RANK``
latent directions. The labelled vectors are broadcast; every text is projected, compared
with all of them by exact cosine products in blocks, and the ``K`` nearest vote for their
label with weight ``max(cosine, 0) ** POWER``.

The sample has at most about ``SAMPLE`` texts a label, so the broadcast has a fixed bound.
Votes are weighted back to the share of each label. A null, empty or unlike text has no
neighbour and scores the share of label 1; without labels every score is 0. Which of
several equally near texts is the K-th depends on their places in the sample alone, which is
sorted by id, so runs agree. Repeated rows score alike; columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample
from .tables import crc_rest, free_name, map_slices
from .words import SPACES, Words, slices

SAMPLE = {0: 1500, 1: 1500}
WORD_BITS, SHAPE_BITS = 12, 12
RANK, K, POWER = 48, 25, 4
#: Least share of votes of a text that is not rejected.
ACCEPTED = 0.7
BLOCK = 512
FIT_SLICE = 1 << 20
FEATURES = (1 << WORD_BITS) + (1 << SHAPE_BITS)


def _has(flags: np.ndarray, words: Words) -> np.ndarray:
    """How many bytes of each word are flagged."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[words.end] - sums[words.start]


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row, feature and damped count of every distinct feature of each text, and the number of rows."""
    words = Words(column, SPACES, lower=False)
    data, size = words.data, words.end - words.start
    hashes = words.hashes()
    upper, lower = _has((data >= 65) & (data < 91), words), _has((data >= 97) & (data < 123), words)
    digits = _has((data >= 48) & (data < 58), words)
    case = np.where(upper == 0, 0, np.where(lower == 0, 2, 1))
    same = np.zeros(len(words), np.int64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    last = data[words.end - 1].astype(np.int64) if len(words) else np.zeros(0, np.int64)
    last = np.where((last >= 128) | ((last | 32) >= 97) & ((last | 32) < 123), 97, last)
    length = np.minimum(np.log2(size + 0.0).astype(np.int64), 5) if len(words) else size
    shape = ((((case * 6 + length) * 2 + (digits > 0)) * 2 + same) * 128 + last).astype(np.uint64)
    shape = (shape * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SHAPE_BITS)
    word = hashes >> np.uint64(64 - WORD_BITS)
    both = np.concatenate([word, shape + np.uint64(1 << WORD_BITS)]).astype(np.int64)
    keys, count = np.unique(np.concatenate([words.row, words.row]) * FEATURES + both, return_counts=True)
    return keys // FEATURES, keys % FEATURES, 1 + np.log(count), words.rows


def sample_features(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``features`` of a long column, made slice by slice."""
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    made, rows = [], 0
    for part in slices(pa.RecordBatch.from_pydict({"text": column}), limit=FIT_SLICE):
        row, feature, value, count = features(part.column(0))
        made.append((row + rows, feature, value.astype(np.float32)))
        rows += count
    if not made:
        return *features(column)[:3], 0
    return *(np.concatenate(x) for x in zip(*made)), rows


class Model:
    """Directions, labelled vectors, their labels and vote weights."""

    def __init__(self, texts, labels: np.ndarray, importance: np.ndarray):
        self.prior = float((labels * importance).sum() / importance.sum()) if len(labels) else 0.0
        row, feature, value, rows = found = sample_features(texts)
        seen = np.bincount(feature, minlength=FEATURES)
        idf = np.where(seen > 0, np.log((1 + rows) / (1 + seen)) + 1, 0)
        self.directions = idf[:, None].astype(np.float32)
        rank = min(RANK, rows)
        if rank:
            value = (value * idf[feature]).astype(np.float32)
            norm = np.sqrt(np.bincount(row, weights=value * value, minlength=rows))
            matrix = np.zeros((rows, FEATURES), np.float32)
            matrix[row, feature] = value / norm[row]
            # Randomised range finder with two power iterations, then an exact decomposition of the small matrix.
            probe = np.random.default_rng(7).standard_normal((FEATURES, rank + 16)).astype(np.float32)
            basis = np.linalg.qr(matrix @ probe)[0]
            for _ in range(2):
                basis = np.linalg.qr(matrix @ np.linalg.qr(matrix.T @ basis)[0])[0]
            right = np.linalg.svd(basis.T @ matrix, full_matrices=False)[2][:rank]
            self.directions = (idf[:, None] * right.T).astype(np.float32)
        self.vectors = self.project(found)
        self.labels, self.importance = labels.astype(np.float32), importance.astype(np.float32)

    def project(self, found: tuple[np.ndarray, np.ndarray, np.ndarray, int]) -> np.ndarray:
        """Unit vectors in the latent space of texts given by their features; zero where nothing is known."""
        row, feature, value, rows = found
        out = np.zeros((rows, self.directions.shape[1]), np.float32)
        step = 1 << 17
        for begin in range(0, len(row), step):  # blocks of features bound the memory of a long text
            part = slice(begin, begin + step)
            made = value[part, None].astype(np.float32) * self.directions[feature[part]]
            first = np.flatnonzero(np.diff(row[part], prepend=-1))
            out[row[part][first]] += np.add.reduceat(made, first, axis=0)
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=np.zeros_like(out), where=size > 0)

    def scores(self, texts) -> np.ndarray:
        vectors, out = self.project(features(texts)), []
        if not len(self.labels):
            return np.zeros(len(vectors))
        k = min(K, len(self.labels))
        for begin in range(0, len(vectors), BLOCK):
            near = vectors[begin:begin + BLOCK] @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0) ** POWER * self.importance[best]
            total = weight.sum(axis=1)
            vote = (weight * self.labels[best]).sum(axis=1)
            out.append(np.where(total > 0, vote / np.where(total > 0, total, 1), self.prior))
        return np.clip(np.concatenate(out).astype(float), 0, 1) if out else np.zeros(0)


def train(documents: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on a bounded sample of the labelled documents."""
    sample, share = labelled_sample(documents, labels, label, SAMPLE)
    y = sample["label"].to_numpy().astype(float)
    return Model(sample["text"], y, np.array([1 / share[int(v)] for v in y]))


def score_documents(documents: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``documents`` with the vote of every text; a column of that name is replaced."""
    rows = documents.drop(name)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = pa.array(model.scores(batch.column(batch.schema.get_field_index(text))), pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])
    schema = rows.withColumn(name, F.lit(0.0)).schema
    return map_slices(rows, work, schema, text)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from labels whose id's crc32 modulo 4 is not 2."""
    rest = crc_rest("doc_id", 4)
    found = score_documents(documents.select("doc_id", "text"), train(documents, labels.where(rest != 2)))
    return found.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


def accepted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, that their neighbours do not reject; all of them without labels."""
    if not len(model.labels):
        return documents
    name = free_name(documents, "vote")
    return score_documents(documents, model, name=name).where(F.col(name) >= ACCEPTED).select(*documents.columns)
