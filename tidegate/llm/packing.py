"""Packing documents into training sequences by vector best fit.

A text becomes token ids and a closing id; a document longer than a sequence is cut into
full pieces behind one shorter first piece. Each sequence has three capacities: tokens,
documents and attention cost (the sum of squared piece lengths). Pieces are placed in falling
order of length; among the sequences that can take a piece under every capacity, the one is
chosen whose weighted residual after placement has the smallest norm (``rule="norm"``), or whose
residual has the largest weighted dot product with the piece (``rule="dot"``). If none can, a
new sequence begins. A capacity left unset cannot bind: a piece has a token at least, and the sum of
squares is at most the square of the sum. The registered query and the pipeline set tokens only, so
their choice is best fit by tokens, and the other two only weigh a little among sequences.

Pieces are dealt evenly over groups of about ``GROUP`` pieces that are packed apart, so no
task holds more, whatever the length of the documents. Only lengths move; ids need not.

A null or empty text is the closing id alone. Repeated rows are packed each for themselves;
an empty table gives an empty result. A piece that alone exceeds a capacity other than tokens
gets a sequence of its own. Pieces of one length go by id, then by their place in the document. A long text
is encoded whole and leaves one row a piece. Columns other than id and text are ignored, whatever their names.

The ids come from the rank file of the vocabulary, which the library reads several times
faster than its JSON form, and from its special tokens: the string of one is that token, as the JSON
form has it. Tests hold ids against the JSON form.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_slices, written

END_ID = 2
#: Special tokens of the vocabulary, which its rank file leaves out.
SPECIAL = {"<|endoftext|>": 50256}
SEQUENCE_TOKENS = 1024
GROUP = 8192


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence and the weights of their residuals."""

    tokens: int = SEQUENCE_TOKENS
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def capacities(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens ** 2], float)


def load_encoder(ranks_path: str, pattern: str, special: dict[str, int] = SPECIAL):
    """An encoder over a rank file; ``pattern`` splits a text before merging, between the strings of special tokens."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def cut_pieces(documents: DataFrame, ranks_path: str, pattern: str, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Every piece of every document: doc_id, piece, start, length and the ids as little-endian 32-bit integers."""
    encoders: list = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not encoders:
            encoders.append(load_encoder(ranks_path, pattern))
        owner, piece, start, length, ids = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            whole = np.array([*encoders[0].encode(text or "", allowed_special="all"), END_ID], "<u4")
            edges = [0, *range((len(whole) - 1) % tokens + 1, len(whole) + 1, tokens)]
            for n, (a, b) in enumerate(zip(edges, edges[1:])):
                owner.append(i)
                piece.append(n)
                start.append(a)
                length.append(b - a)
                ids.append(whole[a:b].tobytes())
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0).take(pa.array(owner, pa.int64())), "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids": pa.array(ids, pa.binary())})
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_slices(rows, work, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; ``lengths`` must fall."""
    capacity, weights = limits.capacities(), np.array(limits.weights)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    vectors = np.stack([lengths, np.ones(len(lengths)), np.square(lengths, dtype=float)]) / capacity[:, None]
    # Residuals of sequences that can still take something; a full one leaves the front.
    residual, number, used = np.empty((3, len(lengths))), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = made = 0
    smallest = vectors[0, -1] if len(lengths) else 0.0
    for i in range(len(lengths)):
        piece = vectors[:, i]
        left = residual[:, :opened] - piece[:, None]
        fits = np.flatnonzero((left >= -1e-12).all(axis=0))
        if len(fits):
            if limits.rule == "dot":
                at = fits[np.argmax((weights * piece) @ residual[:, fits])]
            else:
                at = fits[np.argmin(weights @ np.square(left[:, fits]))]
        else:
            at, opened = opened, opened + 1
            residual[:, at], number[at], used[at] = 1.0, made, 0
            made += 1
        sequence[i], offset[i] = number[at], used[at]
        residual[:, at] -= piece
        used[at] += int(lengths[i])
        if residual[0, at] < smallest - 1e-12:
            opened -= 1
            residual[:, at], number[at], used[at] = residual[:, opened], number[opened], used[opened]
    return sequence, offset


def pack(pieces: DataFrame, count: int, limits: Limits = Limits()) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; columns of these names are replaced.

    ``count`` is the number of pieces, which sets the number of groups.
    """
    rows = pieces.drop("sequence_id", "offset")
    groups = max(1, -(-count // GROUP))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema) if schema else None
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        table = table.sort_by(order) if table.num_rows else table
        sequence, offset = best_fit(table["length"].to_numpy(), limits)
        first = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
        yield from table.to_batches()

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(rows.schema)
    out = rows.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).schema
    return rows.repartition(groups).mapInArrow(run, out)


def packed_digest(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Every piece with the checksum of its ids and its place."""
    pieces = cut_pieces(documents, ranks_path, pattern)
    narrow = written(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(narrow, narrow.count())
