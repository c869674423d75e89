"""Toxicity by multiple-instance learning: sentences scored alone, documents by noisy-or.

A document is a bag of sentences. Sentence scores ``s = sigmoid(b + sum of word weights)``
combine to the document's ``1 - prod(1 - s)``: one offending sentence is enough. Weights
are fitted to document labels only, by gradient descent on the log loss of the bags; the
same sentence scores then locate the offending sentences.

Features are lower-cased runs of letters and digits and their first few bytes, so that
inflected forms of a stem share a weight; they are hashed to ``2 ** BUCKET_BITS`` buckets and
count once a sentence. Sentences end at ``.``, ``!``, ``?`` or a line break. The fit uses
at most about ``SAMPLE`` labelled texts a class; the log loss is weighted back to the share
of each label.

A null or empty text has no sentence and scores 0, as does every text without both labels
to learn from. Repeated rows score alike; columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample
from .tables import crc_rest, map_slices
from .words import NOT_ALNUM, Words, char_counts, hash_prefixes, mix, slices

BUCKET_BITS = 20
PREFIXES = (4, 5, 6, 7)
SAMPLE = {0: 6000, 1: 1500}
MIN_DOCUMENTS, EVIDENCE = 4, 3.5
STEPS, RATE, DECAY = 200, 0.3, 1e-2
START_BIAS = -9.0
FIT_SLICE = 1 << 20

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


class Sentences:
    """Distinct feature buckets of every sentence of a text column, or those of them that are ``used``."""

    def __init__(self, column, used: np.ndarray | None = None):
        words = Words(column, NOT_ALNUM)
        ends = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum(_ENDS[words.data], out=ends[1:])
        at = ends[words.start]
        new = np.ones(len(words), bool)
        new[1:] = (at[1:] != at[:-1]) | (words.row[1:] != words.row[:-1])
        sentence = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(words)) - 1 if len(words) else first
        self.rows, self.row, self.count = words.rows, words.row[first], len(first)
        self.start, self.end, self.data, self.offsets = words.start[first], words.end[last], words.data, words.offsets
        shift, size, made = np.uint64(64 - BUCKET_BITS), words.end - words.start, []
        for prefix, hashes in zip((None, *PREFIXES), hash_prefixes(words.data, words.start, words.end, (None, *PREFIXES))):
            long = slice(None) if prefix is None else size > prefix
            owner, bucket = sentence[long], (mix(hashes[long] + np.uint64(prefix or 0)) >> shift).astype(np.int64)
            if used is not None:
                owner, bucket = owner[used[bucket]], bucket[used[bucket]]
            made.append((owner << BUCKET_BITS) | bucket)
        pairs = np.unique(np.concatenate(made))
        self.sentence, self.bucket = pairs >> BUCKET_BITS, pairs & ((1 << BUCKET_BITS) - 1)


class Model:
    """Word weights and a bias; ``scores`` gives sentence and document scores."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.used, self.bias = weights, weights != 0, bias

    def bags(self, column) -> Sentences:
        """Sentences with the features that weigh anything."""
        return Sentences(column, self.used)

    def scores(self, bags: Sentences) -> tuple[np.ndarray, np.ndarray]:
        logit = self.bias + np.bincount(bags.sentence, weights=self.weights[bags.bucket], minlength=bags.count)
        total = np.bincount(bags.row, weights=np.logaddexp(0, logit), minlength=bags.rows)
        return 1 / (1 + np.exp(-logit)), -np.expm1(-total)


def fit(texts, labels: np.ndarray, importance: np.ndarray) -> Model:
    """Fit weights to document labels; ``importance`` weighs the documents."""
    weights = np.zeros(1 << BUCKET_BITS, np.float32)
    if len(np.unique(labels)) < 2:
        return Model(weights, -np.inf)
    size = 1 << BUCKET_BITS
    hits, toxic = np.zeros(size, np.int64), np.zeros(size)
    batch = pa.RecordBatch.from_pydict({"text": texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts})
    parts = list(slices(batch, limit=FIT_SLICE))
    first = 0
    for part in parts:
        bags = Sentences(part.column(0))
        document = np.unique((bags.row[bags.sentence] << BUCKET_BITS) | bags.bucket)
        owner, bucket = (document >> BUCKET_BITS) + first, document & (size - 1)
        hits += np.bincount(bucket, minlength=size)
        toxic += np.bincount(bucket, weights=labels[owner], minlength=size)
        first += part.num_rows
    base = labels.mean()
    # Features that toxic texts hold more often than chance explains; few texts cannot show it.
    used = (hits >= MIN_DOCUMENTS) & (toxic - hits * base > EVIDENCE * np.sqrt(hits * base * (1 - base)))
    # Start from the smoothed log odds of each feature against the share of toxic texts.
    start = np.log((toxic + base) / (hits - toxic + 1 - base)) - np.log(base / (1 - base))
    w = np.where(used, np.maximum(0, start), 0.0)
    sentences, buckets, rows, first, count = [], [], [], 0, 0
    for part in parts:
        bags = Sentences(part.column(0), used)
        sentences.append(bags.sentence + count)
        buckets.append(bags.bucket)
        rows.append(bags.row + first)
        first, count = first + part.num_rows, count + bags.count
    sentence, bucket, row = np.concatenate(sentences), np.concatenate(buckets), np.concatenate(rows)
    bias, rate_w, rate_b = START_BIAS, np.full(len(w), 1e-8), 1e-8
    scale = importance / importance.sum()
    for _ in range(STEPS):
        logit = bias + np.bincount(sentence, weights=w[bucket], minlength=count)
        s = 1 / (1 + np.exp(-logit))
        total = np.bincount(row, weights=np.logaddexp(0, logit), minlength=len(labels))
        slope = scale * np.where(labels == 1, -1 / np.maximum(np.expm1(np.minimum(total, 500)), 1e-6), 1.0)
        back = slope[row] * s
        grad = np.bincount(bucket, weights=back[sentence], minlength=len(w)) + DECAY * scale.mean() * w
        grad_b = back.sum()
        rate_w += grad * grad
        rate_b += grad_b * grad_b
        w -= RATE * grad / np.sqrt(rate_w) * used
        bias -= RATE * grad_b / np.sqrt(rate_b)
    return Model(w.astype(np.float32), float(bias))


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on a bounded sample of the labelled documents."""
    sample, share = labelled_sample(documents, labels, label, SAMPLE)
    y = sample["label"].to_numpy().astype(float)
    return fit(sample["text"], y, np.array([1 / share[int(v)] for v in y]))


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and the noisy-or score of every text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": model.scores(model.bags(batch.column(1)))[1]})
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_slices(rows, work, "doc_id bigint, score double")


def offending_sentences(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Sentences that score ``least`` or more: id, code point bounds from first to last word, score."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = model.bags(batch.column(1))
        scores = model.scores(bags)[0]
        found = np.flatnonzero(scores >= least)
        chars, owner = char_counts(bags.data), bags.row[found]
        origin = chars[bags.offsets[owner]]
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0).take(pa.array(owner)), "start": chars[bags.start[found]] - origin,
            "end": chars[bags.end[found]] - origin, "score": scores[found]})
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_slices(rows, work, "doc_id bigint, start bigint, end bigint, score double")


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from labels whose id's crc32 modulo 5 is not 0."""
    rest = crc_rest("doc_id", 5)
    found = score_documents(documents, train(documents, labels.where(rest != 0)))
    return found.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
