"""Language-model scoring with an Elias-Fano n-gram trie.

A trigram model with absolute discounting is counted over the training texts and held in
three levels of files in the shared folder, which scoring tasks memory-map:

* words: their 64-bit hashes as a monotone sequence, whose places are the word ids, and exact counts;
* pairs: per first word, the second words in ascending order, with monotone pointers from the
  first word, quantised discounted probabilities and back-off weights, and counts;
* triples: per pair ``(a, b)``, the third words, stored as their rank among the words that
  follow ``b`` in the pair level, with pointers, quantised probabilities and back-off weights.

Within a level each parent's range is lifted above the range before it, so the whole level is
one ascending Elias-Fano sequence; a child is found by successor search relative to its context.
Pairs and triples counted less than ``min_count`` times are pruned, their mass stays with the
back-off weights; with ``min_count`` 1, as the registered query has it, all are kept::

    p(c | a b) = max(n(abc) - D, 0) / n(ab) + L(ab) p(c | b)
    p(c | b)   = max(n(bc) - D, 0) / n(b) + L(b) p(c),   p(c) = (n(c) - D1) / N,  unseen: D1 V / N

Levels are cut into shards of about ``SHARD_BYTES`` of training text: words by hash, pairs and
triples by the first word, and a first word that holds more than half a shard by the second word
too. Counts are summed per task before they move, as sorted and compressed arrays, one row a
shard; each shard is built by one task and written under a temporary name, so a repeated task
changes nothing. The driver sees the sizes of each shard and the words that are split. A task maps the
shards it needs, at most ``OPEN`` at a time. Words with equal hashes count as one
(n^2 / 2^65 expected pairs among n distinct words); a vocabulary of 2^32 words or more is refused.

A null or empty text is one end token. Repeated rows count and score each for themselves; rows with
a null id are scored and not learned from; without training text every score is 0. The shared
folder must be a mounted file system, as memory mapping needs files.
"""

from __future__ import annotations

import mmap
import os
import sys
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import run_folder
from .elias_fano import Sequence, _pack, _unpack, encode
from .tables import crc_rest, written
from .words import Words, slices

SHARD_BYTES = 24 << 20
MIN_COUNT = 2
DISCOUNT = 0.75
LM_SLICE = 6 << 20
FLUSH = 2 << 20
#: Shards that a task keeps mapped; the one unused longest goes first.
OPEN = 512
_END = np.uint64(0x2545F4914F6CDD1D)
_CODES = 4096
_LOW32 = np.uint64(0xFFFFFFFF)


# Files: sections of 64-bit words behind a table of their lengths.

def local_path(uri: str) -> str:
    """The mounted path of a file URI."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped levels need a mounted shared folder, not {uri}")
    return unquote(parts.path)


def write_sections(path: str, sections: list[np.ndarray]) -> None:
    """Write arrays to a file that appears whole or not at all."""
    words = []
    for section in sections:
        raw = np.ascontiguousarray(section).view(np.uint8)
        words.append(np.pad(raw, (0, -len(raw) % 8)).view(np.uint64))
    head = np.array([len(words), *map(len, words)], np.uint64)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    held = f"{path}.{uuid.uuid4().hex}"
    with open(held, "wb") as out:
        for part in (head, *words):
            out.write(part.tobytes())
    os.replace(held, path)


def open_sections(path: str) -> list[np.ndarray]:
    """The sections of a file, memory-mapped; where Python can, the mapping holds no file descriptor."""
    with open(path, "rb") as file:
        held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **({"trackfd": False} if sys.version_info >= (3, 13) else {}))
    words = np.frombuffer(held, np.uint64)
    count = int(words[0])
    edges = np.cumsum(np.concatenate([[1 + count], words[1:1 + count].astype(np.int64)]))
    return [words[a:b] for a, b in zip(edges, edges[1:])]


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two-byte codes and their codebook of positive values; few distinct values are kept as they are."""
    if not len(values):
        return np.zeros(0, np.uint16), np.zeros(1, np.float32)
    book = np.unique(values.astype(np.float32))
    if len(book) > _CODES:
        book = np.unique(np.quantile(values, np.linspace(0, 1, _CODES)).astype(np.float32))
    middle = np.sqrt(book[1:].astype(float) * book[:-1])
    return np.searchsorted(middle, values).astype(np.uint16), book


# Counting: sorted keys with counts, summed per task, dealt to shards as compressed rows.

def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)) != 0) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _squeeze(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, byte planes apart."""
    planes = values.view(np.uint8).reshape(len(values), 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _expand(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view(np.uint64).ravel()


class _Counter:
    """Counts of keys per shard, emitted as one row a shard."""

    SCHEMA = "shard int, n bigint, keys binary, counts binary"

    def __init__(self):
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add sorted distinct keys of one shard."""
        if len(keys):
            self.held.setdefault(shard, []).append((keys, counts))
            self.size += len(keys)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for shard, parts in self.held.items():
            keys, counts = _summed(*(np.concatenate(x) for x in zip(*parts)))
            delta = np.diff(keys, prepend=np.uint64(0))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()),
                "keys": pa.array([_squeeze(delta)], pa.binary()), "counts": pa.array([_squeeze(counts.astype(np.uint64))], pa.binary())})
        self.held, self.size = {}, 0


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of all rows of one shard."""
    sizes = table["n"].to_pylist()
    keys = [np.cumsum(_expand(d, n), dtype=np.uint64) for d, n in zip(table["keys"].to_pylist(), sizes)]
    counts = [_expand(d, n) for d, n in zip(table["counts"].to_pylist(), sizes)]
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values and the place of each value among them."""
    codes, found = pd.factorize(values)
    order = np.argsort(found)
    place = np.empty(len(found), np.int64)
    place[order] = np.arange(len(found))
    return found[order], place[codes]


def _segments(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal shards."""
    edges = np.flatnonzero(np.diff(shard, prepend=-1)).tolist() if len(shard) else []
    for a, b in zip(edges, [*edges[1:], len(shard)]):
        yield int(shard[a]), slice(a, b)


class Tokens:
    """Hashes and rows of all tokens of a text column: the words of each row, then its end."""

    def __init__(self, column):
        words = Words(column)
        rows = np.arange(words.rows)
        self.rows, self.hash = words.rows, np.full(len(words) + words.rows, _END, np.uint64)
        self.row = np.empty(len(self.hash), np.int64)
        place = np.arange(len(words)) + words.row
        self.hash[place], self.row[place] = words.hashes(), words.row
        self.row[words.first[1:] + rows] = rows


def _with_parents(parent: np.ndarray, child: np.ndarray, parents: int) -> tuple[np.ndarray, np.ndarray]:
    """Pointers of each parent's range and the lifted, ascending values of a level sorted by parent, child."""
    start = np.searchsorted(parent, np.arange(parents + 1))
    last = np.flatnonzero(np.diff(parent, append=parents))
    lift = np.cumsum(child[last].astype(np.uint64) + np.uint64(1))
    base = np.concatenate([np.zeros(1, np.uint64), lift[:-1]]) if len(lift) else lift
    group = np.cumsum(np.diff(parent, prepend=parent[:1]) != 0) if len(parent) else parent
    values = child.astype(np.uint64) + base[group]
    return encode(start, len(parent) + 1), encode(values, int(lift[-1]) if len(lift) else 1)


class Level:
    """Children of a run of parents: pointers, lifted children, probability codes."""

    def __init__(self, pointers: np.ndarray, values: np.ndarray, codes: np.ndarray, book: np.ndarray):
        self.pointers, self.values = Sequence(pointers), Sequence(values)
        self.codes, self.book = codes.view(np.uint16), book.view(np.float32)

    def find(self, parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each child below its parent (-1: none) and the start of the parent's range; parents ascend."""
        new = np.diff(parent, prepend=parent[:1] - 1) != 0
        distinct, inverse = parent[new], np.cumsum(new) - 1
        start = self.pointers.access(distinct).astype(np.int64)
        stop = self.pointers.access(distinct + 1).astype(np.int64)
        base = np.zeros(len(distinct), np.uint64)
        later = np.flatnonzero(start > 0)
        base[later] = self.values.access(start[later] - 1) + np.uint64(1)
        place = self.values.find(base[inverse] + child.astype(np.uint64))
        start, stop = start[inverse], stop[inverse]
        return np.where((place >= start) & (place < stop), place, -1), start

    def probability(self, place: np.ndarray) -> np.ndarray:
        """Discounted probability at each place; 0 at -1."""
        return np.where(place >= 0, self.book[self.codes[np.maximum(place, 0)]], 0.0) if self.values.n else np.zeros(len(place))


class Trie:
    """The levels of a model below one folder; up to ``OPEN`` shards stay mapped."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards
        self.first_id = np.zeros(shards + 1, np.int64)  # of each word shard
        self.tokens = self.words = 0
        self.discount = 0.5
        self.split = np.zeros(0, np.uint64)  # first key of each pair shard
        self.first_pair = np.zeros(1, np.int64)
        self.spread: dict[int, tuple[int, float]] = {}  # words over several pair shards: first pair, back-off weight
        self.opened: dict[tuple[str, int], list] = {}

    def __getstate__(self):
        return self.__dict__ | {"opened": {}}

    def path(self, level: str, shard: int) -> str:
        return f"{self.folder}/{level}-{shard:06d}.bin"

    def sections(self, level: str, shard: int) -> list:
        key = (level, shard)
        parts = self.opened.pop(key, None)
        if parts is None:
            parts = open_sections(self.path(level, shard))
            if level == "words":
                parts = [Sequence(parts[0]), parts[1], int(parts[2][0])]
            else:
                parts = [Level(*parts[:4]), *parts[4:]]
            while len(self.opened) >= OPEN:
                del self.opened[next(iter(self.opened))]
        self.opened[key] = parts  # the last in order is the one used last
        return parts

    # words

    def word_shard(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)

    def word_counts(self, shard: int, index: np.ndarray) -> np.ndarray:
        _, packed, width = self.sections("words", shard)
        return _unpack(packed, index, width).astype(np.int64)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1: unknown) and count of ascending hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for shard, part in _segments(self.word_shard(hashes)):
            if self.first_id[shard] == self.first_id[shard + 1]:
                continue
            place = self.sections("words", shard)[0].find(hashes[part])
            there = np.flatnonzero(place >= 0)
            ids[part.start + there] = self.first_id[shard] + place[there]
            counts[part.start + there] = self.word_counts(shard, place[there])
        return ids, counts

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ascending word ids."""
        out = np.empty(len(ids), np.int64)
        for shard, part in _segments(np.searchsorted(self.first_id, ids, "right") - 1):
            out[part] = self.word_counts(shard, ids[part] - self.first_id[shard])
        return out

    # pairs and triples

    def pair_shard(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.split, keys, "right") - 1

    def has_pairs(self, shard: int) -> bool:
        return self.first_pair[shard] < self.first_pair[shard + 1]

    def parents(self, shard: int) -> tuple[int, int]:
        """Word ids below which the pairs of a shard lie."""
        first = int(self.split[shard] >> np.uint64(32))
        if shard + 1 == len(self.split):
            return first, self.words
        after = self.split[shard + 1]
        return first, int(after >> np.uint64(32)) + bool(after & _LOW32)

    def find_pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of ascending keys (first id << 32 | second id): pair (-1: pruned), probability, first pair of the first word."""
        pair, probability, start = np.full(len(keys), -1, np.int64), np.zeros(len(keys)), np.zeros(len(keys), np.int64)
        for shard, part in _segments(self.pair_shard(keys)):
            if not self.has_pairs(shard):
                continue
            level, low = self.sections("pairs", shard)[0], self.parents(shard)[0]
            first = (keys[part] >> np.uint64(32)).astype(np.int64)
            place, begin = level.find(first - low, keys[part] & _LOW32)
            pair[part] = np.where(place >= 0, place + self.first_pair[shard], -1)
            probability[part] = level.probability(place)
            start[part] = begin + self.first_pair[shard]
            if int(first[0]) in self.spread:
                start[part] = np.where(first == first[0], self.spread[int(first[0])][0], start[part])
        return pair, probability, start

    def word_backoff(self, ids: np.ndarray) -> np.ndarray:
        """Back-off weight of ascending word ids."""
        out = np.ones(len(ids))
        for shard, part in _segments(self.pair_shard(ids.astype(np.uint64) << np.uint64(32))):
            if self.has_pairs(shard):
                _, codes, book = self.sections("pairs", shard)[:3]
                out[part] = book.view(np.float32)[codes.view(np.uint16)[ids[part] - self.parents(shard)[0]]]
        for i, word in enumerate(ids.tolist()) if self.spread else ():
            if word in self.spread:
                out[i] = self.spread[word][1]
        return out

    def pair_backoff(self, pairs: np.ndarray) -> np.ndarray:
        """Back-off weight of ascending pairs."""
        out = np.ones(len(pairs))
        for shard, part in _segments(np.searchsorted(self.first_pair, pairs, "right") - 1):
            _, codes, book = self.sections("triples", shard)[:3]
            out[part] = book.view(np.float32)[codes.view(np.uint16)[pairs[part] - self.first_pair[shard]]]
        return out

    def find_triples(self, pairs: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Probability of the third words given by rank below ascending pairs; 0 where pruned."""
        out = np.zeros(len(pairs))
        for shard, part in _segments(np.searchsorted(self.first_pair, pairs, "right") - 1):
            level = self.sections("triples", shard)[0]
            if level.values.n:
                out[part] = level.probability(level.find(pairs[part] - self.first_pair[shard], ranks[part])[0])
        return out

    # whole texts

    def resolve(self, column) -> dict[str, np.ndarray]:
        """Tokens of a text column: row, word id, and place in ``count``, which has the counts of distinct words."""
        tokens = Tokens(column)
        distinct, inverse = _distinct(tokens.hash)
        ids, counts = self.look_up(distinct)
        return {"rows": tokens.rows, "row": tokens.row, "id": ids[inverse], "count": counts, "word": inverse}

    def pairs_of(self, found: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of tokens that end a pair of known words, their distinct keys, and the key of each place."""
        ids, row = found["id"], found["row"]
        at = np.flatnonzero((row[1:] == row[:-1]) & (ids[1:] >= 0) & (ids[:-1] >= 0)) + 1
        keys = (ids[at - 1].astype(np.uint64) << np.uint64(32)) | ids[at].astype(np.uint64)
        return at, *_distinct(keys)

    def triples_of(self, found: dict, at: np.ndarray, pair: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of tokens that end two kept pairs, the pair before and the rank of the token; ``pair``, ``start`` by place in ``at``."""
        kept = np.full(len(found["id"]), -1, np.int64)
        kept[at] = pair
        begin = np.zeros(len(kept), np.int64)
        begin[at] = start
        third = np.flatnonzero((kept[1:] >= 0) & (kept[:-1] >= 0) & (found["row"][1:] == found["row"][:-1])) + 1
        return third, kept[third - 1], kept[third] - begin[third]

    def score(self, column) -> dict[str, np.ndarray]:
        """Token counts and log10 probabilities of each text."""
        found = self.resolve(column)
        ids, row, rows, count, word = found["id"], found["row"], found["rows"], found["count"], found["word"]
        known = ids >= 0
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.words + 1)))[word]
        if self.tokens:
            p = (np.where(count > 0, count - self.discount, self.discount * self.words) / self.tokens)[word]
        else:
            p = np.ones(len(ids))
        if self.words:
            follows = np.flatnonzero(row[1:] == row[:-1]) + 1
            follows = follows[ids[follows - 1] >= 0]
            words, inverse = _distinct(ids[follows - 1])
            p[follows] *= self.word_backoff(words)[inverse]
            at, keys, inverse = self.pairs_of(found)
            pair, probability, start = (x[inverse] for x in self.find_pairs(keys))
            p[at] += probability
            before = np.zeros(len(ids), np.int64) - 1
            before[at] = pair
            context = np.flatnonzero((before[:-1] >= 0) & (row[1:] == row[:-1])) + 1
            pairs, inverse = _distinct(before[context - 1])
            p[context] *= self.pair_backoff(pairs)[inverse]
            third, pairs, ranks = self.triples_of(found, at, pair, start)
            order = np.argsort(pairs)
            made = np.empty(len(third))
            made[order] = self.find_triples(pairs[order], ranks[order])
            p[third] += made
        total = lambda values: np.bincount(row, weights=values, minlength=rows)
        return {"n_tokens": np.bincount(row, minlength=rows), "n_known": total(known).astype(np.int64),
                "base_score": total(base), "score": total(np.log10(np.minimum(p, 1.0)))}


def _counted(texts: DataFrame, count) -> DataFrame:
    """Rows of counts per shard from ``count(batch, counter)`` over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in batches:
            for part in slices(batch, limit=LM_SLICE):
                count(part.column(0), counter)
                if counter.size > FLUSH:
                    yield from counter.rows()
        yield from counter.rows()
    return texts.mapInArrow(run, _Counter.SCHEMA)


def _built(counts: DataFrame, shards: int, build) -> DataFrame:
    """The lines of ``build(table)`` for every shard, written; with as many tasks as shards where the session has fewer."""
    if shards > int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        counts = counts.repartition(shards, "shard")
    return written(counts.groupBy("shard").applyInArrow(build, _BUILT), "trie-lines")


_BUILT = "shard int, n bigint, tokens bigint, once bigint, twice bigint, mass double, hot array<struct<id:bigint,count:bigint>>"


def _line(shard: int, n: int, tokens: int = 0, once: int = 0, twice: int = 0, mass: float = 0.0, hot=()) -> pa.Table:
    return pa.table({
        "shard": pa.array([shard], pa.int32()), "n": pa.array([n], pa.int64()), "tokens": pa.array([tokens], pa.int64()),
        "once": pa.array([once], pa.int64()), "twice": pa.array([twice], pa.int64()), "mass": pa.array([mass], pa.float64()),
        "hot": pa.array([[{"id": int(i), "count": int(c)} for i, c in hot]], pa.list_(pa.struct([("id", pa.int64()), ("count", pa.int64())])))})


def _build_words(trie: Trie, texts: DataFrame) -> None:
    def count(column, counter: _Counter) -> None:
        keys, counts = np.unique(Tokens(column).hash, return_counts=True)
        for shard, part in _segments(trie.word_shard(keys)):
            counter.add(shard, keys[part], counts[part].astype(np.uint64))

    def build(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys, counts = _merged(table)
        width = int(counts.max()).bit_length()
        write_sections(trie.path("words", shard), [encode(keys, 1 << 64), _pack(counts, width), np.array([width], np.uint64)])
        # Words of more than a hundredth of the shard may be hot; whether they are follows from the total.
        top = np.flatnonzero(counts > max(1, int(counts.sum()) // 100))
        return _line(shard, len(keys), int(counts.sum()), int((counts == 1).sum()), int((counts == 2).sum()),
                     hot=zip(top.tolist(), counts[top].tolist()))

    built = _built(_counted(texts, count), trie.shards, build)
    lines = built.drop("hot").collect()
    sizes = np.zeros(trie.shards, np.int64)
    for line in lines:
        sizes[line["shard"]] = line["n"]
    trie.first_id = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    trie.words, trie.tokens = int(trie.first_id[-1]), sum(line["tokens"] for line in lines)
    if trie.words >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")
    once, twice = sum(line["once"] for line in lines), sum(line["twice"] for line in lines)
    trie.discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))

    split = {int(first) << 32 for first, n in zip(trie.first_id, sizes) if n} | {0}
    # A word of more than half a shard's tokens: at most two a shard in all, whatever the vocabulary.
    hot_words = built.select("shard", F.inline("hot")).where(F.col("count") * (2 * trie.shards) > trie.tokens).collect()
    for line in hot_words:
        parts = -(-line["count"] * trie.shards // trie.tokens)
        word = int(trie.first_id[line["shard"]]) + line["id"]
        split |= {(word << 32) + trie.words * k // parts for k in range(parts)} | {(word + 1) << 32}
    trie.split = np.array(sorted(s for s in split if s >> 32 < max(1, trie.words)), np.uint64)


def _build_pairs(trie: Trie, texts: DataFrame, min_count: int) -> None:
    def count(column, counter: _Counter) -> None:
        _, keys, inverse = trie.pairs_of(trie.resolve(column))
        counts = np.bincount(inverse, minlength=len(keys)).astype(np.uint64)
        for shard, part in _segments(trie.pair_shard(keys)):
            counter.add(shard, keys[part], counts[part])

    def build(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys, counts = _merged(table)
        keys, counts = keys[counts >= min_count], counts[counts >= min_count].astype(np.int64)
        if not len(keys):
            return _line(shard, 0)
        low, high = trie.parents(shard)
        parent, child = (keys >> np.uint64(32)).astype(np.int64) - low, keys & _LOW32
        share = (counts - DISCOUNT) / np.maximum(trie.counts_of(parent + low), 1)
        mass = np.bincount(parent, weights=share, minlength=high - low)
        codes, book = quantise(share)
        backoff, weights = quantise(np.maximum(1 - mass, 1e-9))
        width = int(counts.max()).bit_length()
        write_sections(trie.path("pairs", shard), [
            *_with_parents(parent, child, high - low), codes, book, backoff, weights,
            _pack(counts.astype(np.uint64), width), np.array([width], np.uint64)])
        return _line(shard, len(keys), mass=float(mass[0]))

    lines = _built(_counted(texts, count), len(trie.split), build).select("shard", "n", "mass").collect()
    sizes = np.zeros(len(trie.split), np.int64)
    mass = np.zeros(len(trie.split))
    for line in lines:
        sizes[line["shard"]], mass[line["shard"]] = line["n"], line["mass"]
    trie.first_pair = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    owner = (trie.split >> np.uint64(32)).astype(np.int64)
    for word in np.unique(owner[1:][owner[1:] == owner[:-1]]).tolist():
        parts = np.flatnonzero(owner == word)
        trie.spread[word] = (int(trie.first_pair[parts[0]]), max(1e-9, 1 - float(mass[parts].sum())))


def _build_triples(trie: Trie, texts: DataFrame, min_count: int) -> None:
    def count(column, counter: _Counter) -> None:
        found = trie.resolve(column)
        at, keys, inverse = trie.pairs_of(found)
        pair, _, start = (x[inverse] for x in trie.find_pairs(keys))
        _, pairs, ranks = trie.triples_of(found, at, pair, start)
        shard = np.searchsorted(trie.first_pair, pairs, "right") - 1
        order = np.argsort(shard, kind="stable")
        local = ((pairs - trie.first_pair[shard]).astype(np.uint64) << np.uint64(32)) | ranks.astype(np.uint64)
        for owner, part in _segments(shard[order]):
            made, counts = np.unique(local[order[part]], return_counts=True)
            counter.add(owner, made, counts.astype(np.uint64))

    def write(shard: int, keys: np.ndarray, counts: np.ndarray) -> int:
        packed, width = trie.sections("pairs", shard)[3:5]
        pairs = int(trie.first_pair[shard + 1] - trie.first_pair[shard])
        whole = _unpack(packed, np.arange(pairs), int(width[0])).astype(float)
        keys, counts = keys[counts >= min_count], counts[counts >= min_count].astype(np.int64)
        parent = (keys >> np.uint64(32)).astype(np.int64)
        share = (counts - DISCOUNT) / whole[parent]
        codes, book = quantise(share)
        backoff, weights = quantise(np.maximum(1 - np.bincount(parent, weights=share, minlength=pairs), 1e-9))
        write_sections(trie.path("triples", shard), [*_with_parents(parent, keys & _LOW32, pairs), codes, book, backoff, weights])
        return len(keys)

    def build(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        return _line(shard, write(shard, *_merged(table)))

    # Shards with pairs but no triple to count still get their (empty) level.
    spark = texts.sparkSession
    filled = [(int(s),) for s in np.flatnonzero(np.diff(trie.first_pair))]
    if not filled:
        return
    blank = np.zeros(0, np.uint64)
    empty = (0, _squeeze(blank), _squeeze(blank))
    every = spark.createDataFrame([(s, *empty) for s, in filled], _Counter.SCHEMA)
    _built(_counted(texts, count).unionByName(every), len(trie.split), build)


def train(texts: DataFrame, min_count: int = MIN_COUNT) -> Trie:
    """Count the texts of column ``text`` and write the levels, less pairs and triples below ``min_count``, to the shared folder."""
    texts = texts.select("text")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    trie = Trie(local_path(run_folder(texts.sparkSession, "ngram-trie")), max(1, -(-size // SHARD_BYTES)))
    _build_words(trie, texts)
    if trie.words:
        _build_pairs(trie, texts, min_count)
        _build_triples(trie, texts, min_count)
    return trie


def score_texts(documents: DataFrame, trie: Trie) -> DataFrame:
    """Token counts, the base score and the model's log10 probability of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=LM_SLICE):
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), **trie.score(part.column(1))})
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def language_model_scores(documents: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Scores of all documents under a model of those whose id's crc32 modulo 10 is not 0."""
    rest = crc_rest("doc_id", 10)
    trie = train(documents.where(rest != 0), min_count)
    return score_texts(documents, trie).select(
        "doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(trie.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
