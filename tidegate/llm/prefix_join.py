"""Similarity join of n-gram sets by rare-first prefix filtering.

A text's set holds its distinct runs of ``words`` lower-cased words, or its whole word sequence when
it is shorter. Two texts are linked when their sets overlap to ``percent`` percent or more (Jaccard);
components of linked texts share the smallest id.

1. One pass makes the size, two checksums and the sizes of ``PARTS`` parts of every set. Texts with equal sets are one class,
   named by its smallest id; only that text goes on.
2. N-grams are put in one order, rare before frequent. Tasks merge their n-grams and send them in
   packed ranges; document frequencies are counted over all of them. The order needs only n-grams
   that are common: those of the highest powers of two of frequency, as many as fit in ``COMMON``
   entries, come last by power; all others come first, and the hash decides within a power. Any order
   is right for the filters; this one keeps shared lines and passages out of prefixes.
3. Linked sets share an n-gram among the first n - ceil(percent n / 100) + 1 of each, and the shorter
   has it among its still fewer first. Prefixes move once, packed, to where n-grams of one set only are
   dropped; the others are joined on n-grams, through the smallest member
   (by a hash) of each n-gram's documents: all n-grams with the same smallest member form a group.
4. A group is dealt into cells of ``BLOCK`` members. In a cell each member looks up the others by prefix
   n-grams; sizes, the place of the first shared n-gram and the differences of the parts bound the overlap from
   above. Only the sets of members that fit another are sent to the cells. There the suffix filter
   compares the parts, by ``PIVOTS`` pivots, of what follows the first shared n-gram, and what is left is verified on
   full sets: once, in the one group that the pair's first shared n-gram belongs to, and only
   while its texts are in different components.
5. Where a group has more than ``BLOCK`` members, they are first compared with its smallest and up to ``LEADERS`` more
   alone, each set moving once, for up to ``ROUNDS`` rounds of other smallest members, while a round joins any. What that
   has joined meets only the members still apart; a pair that a round refused may be verified again.
6. Components are joined over all groups by smallest-neighbour steps and pointer jumps.

A null or empty text has an empty set and no links. Rows with a null id have a null component and
link nothing. Rows that share an id are one document: the links of all their texts add up; equal
rows are returned as often as they come. Ties of size or place need no rule, as filters hold both
ways. A long text is one row of eight bytes a word. An empty table gives no rows. Columns other than
id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import join_back
from .odd_sketch import _groups, _words, components, shingles
from .tables import map_slices, sent_if_small, written
from .words import mix, slices

SHINGLE, SIMILARITY = 5, 80
#: N-grams with a frequency of their own in the order.
COMMON = 1 << 20
#: Hashes of one range of document frequencies, and of a task before it sends them on.
RANGE = 1 << 21
#: Members, and n-grams, of one side of a cell.
BLOCK, BLOCK_GRAMS = 1024, 1 << 19
ROUNDS, LEADERS, PIVOTS, PARTS = 4, 3, 16, 128


def _ceil(above, below: int):
    return -(-above // below)


def probe_length(size, percent: int):
    """N-grams of a set that must hold one of any linked set's."""
    return size - _ceil(percent * size, 100) + 1


def index_length(size, percent: int):
    """The same for a linked set of this size or more."""
    return size - _ceil(2 * percent * size, 100 + percent) + 1


def least_overlap(left, right, percent: int):
    return _ceil(percent * (left + right), 100 + percent)


# Frequencies

def gram_keys(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a hash, by its upper half, and its lower half: what is counted and joined instead of the hash.

    A range holds about ``RANGE`` n-grams however many there are, so few of them agree in the lower
    half. Those that do only make an n-gram look more frequent, or bring together a pair that the filters part.
    """
    part = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return (part << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _packed(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Distinct keys and their counts, a row a range."""
    found, counts = np.unique(keys, return_counts=True)
    part = (found >> np.uint64(32)).astype(np.int64)
    edges = [*np.flatnonzero(np.diff(part, prepend=-1)), len(part)]
    for start, stop in zip(edges, edges[1:]):
        yield pa.RecordBatch.from_pydict({
            "part": part[start:start + 1], "grams": pa.array([found[start:stop].astype(np.uint32).tobytes()], pa.binary()),
            "counts": pa.array([counts[start:stop].astype(np.uint32).tobytes()], pa.binary())})


def key_counts(rows: DataFrame, keys, least: int) -> DataFrame:
    """Keys that occur ``least`` times or more, with the power of two of their number; ``keys`` makes them of a batch.

    Every task adds up its keys before it sends them, four bytes each, to the task of their range.
    """
    def send(batches):
        held, size = [], 0
        for batch in batches:
            for made in keys(batch):
                held.append(made)
                size += len(made)
                if size > RANGE:
                    yield from _packed(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield from _packed(np.concatenate(held))

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found, counts = (np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column(c)]) for c in ("grams", "counts"))
        order = np.argsort(found, kind="stable")
        found, counts = found[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.diff(found.astype(np.int64), prepend=-1))
        total = np.add.reduceat(counts, first)
        gram = (found[first][total >= least].astype(np.uint64) | np.uint64(key[0].as_py() << 32)).view(np.int64)
        return pa.table({"gram": gram, "power": np.log2(total[total >= least]).astype(np.int32)})
    sent = rows.mapInArrow(send, "part bigint, grams binary, counts binary")
    return sent.groupBy("part").applyInArrow(add, "gram bigint, power int")


def common_grams(texts: DataFrame, ranges: int, words: int, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the most frequent n-grams, sorted, and the power of two of each one's document frequency; at most ``most``."""
    keys = lambda batch: (gram_keys(shingles(part.column(0), words)[1], ranges) for part in slices(batch))
    found = written(key_counts(texts.select("text"), keys, 4), "frequencies")
    sizes = {r["power"]: r["count"] for r in found.groupBy("power").count().collect()}
    floor, kept = 64, 0
    while floor > 2 and kept + sizes.get(floor - 1, 0) <= most:
        floor, kept = floor - 1, kept + sizes.get(floor - 1, 0)
    rows = found.where(F.col("power") >= floor).toArrow()
    grams = rows.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], rows.column("power").to_numpy().astype(np.int8)[order]


def part_sizes(row: np.ndarray, hashes: np.ndarray, rows: int) -> list[bytes]:
    """Members of each set in each of ``PARTS`` parts, two bytes each.

    Sets that share enough members differ by few of them in every part. A part of 65535 members or more
    counts as 65535, which brings sets no farther apart.
    """
    out = np.bincount(row * PARTS + (mix(hashes) >> np.uint64(64 - 7)).astype(np.int64), minlength=rows * PARTS)
    return [x.tobytes() for x in np.minimum(out, 0xFFFF).astype(np.uint16).reshape(rows, PARTS)]


def ordered(row: np.ndarray, hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray], ranges: int) -> np.ndarray:
    """``hashes`` of each row rare first: by power of frequency, then by hash; ``row`` and ``hashes`` ascend."""
    grams, power = common
    if not len(grams):
        return hashes
    keys = gram_keys(hashes, ranges)
    at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
    level = np.where(grams[at] == keys, power[at], 0)
    return hashes[np.lexsort((level, row))]


# Cells

class Sides:
    """What the filters read of the members of one cell: sizes, places of the group's n-grams, sizes of ``PARTS`` parts of the sets."""

    def __init__(self, size: np.ndarray, grams: list[np.ndarray], places: list[np.ndarray], parts: np.ndarray, percent: int):
        self.size, self.parts, self.percent = size, parts, percent
        many = np.array([len(g) for g in grams])
        self.first = np.cumsum(many) - many
        self.owner, self.place = np.repeat(np.arange(len(size)), many), np.concatenate(places)
        _, self.gram = np.unique(np.concatenate(grams), return_inverse=True)
        self.mark = np.zeros(len(self.gram) + 1, np.int64)

    def fits(self, x: int, usable: np.ndarray) -> np.ndarray:
        """Members among ``usable`` that sizes, first places and parts allow to be linked with ``x``."""
        own = slice(self.first[x], self.first[x + 1] if x + 1 < len(self.first) else len(self.gram))
        self.mark[self.gram[own]] = self.place[own] + 1
        hit = np.flatnonzero((self.mark[self.gram] > 0) & usable[self.owner])
        y, at = np.unique(self.owner[hit], return_index=True)
        p, q = self.mark[self.gram[hit[at]]] - 1, self.place[hit[at]]
        self.mark[self.gram[own]] = 0
        y = y[within(int(self.size[x]), self.size[y], p, q, self.percent)]
        apart = np.abs(self.parts[y] - self.parts[x]).sum(axis=1)
        return y[apart <= self.size[x] + self.size[y] - 2 * least_overlap(self.size[x], self.size[y], self.percent)]


def within(n: int, m: np.ndarray, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` members may be linked if the first they share are at places ``p`` and ``q``."""
    keep = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    short_place = np.where(m < n, q, np.where(m > n, p, np.minimum(p, q)))
    keep &= short_place < index_length(np.minimum(n, m), percent)
    return keep & (np.minimum(n - p, m - q) >= least_overlap(n, m, percent))


def fitting(sides: Sides, component: np.ndarray, block: np.ndarray, leaders: np.ndarray | None) -> np.ndarray:
    """Places of the members that fit another member of another component (and block, in a cell of two)."""
    across = leaders is None and block.min() != block.max()
    found = np.zeros(len(component), bool)
    for x in range(len(component)) if leaders is None else leaders:
        usable = component != component[x]
        usable &= (block != block[x]) if across else (np.arange(len(component)) > x) | (leaders is not None)
        y = sides.fits(x, usable) if usable.any() else []
        if len(y):
            found[y] = found[x] = True
    return np.flatnonzero(found)


class Cell:
    """Members of one cell, their sets in the common order, and what the filters read."""

    def __init__(self, sets: list[np.ndarray], mine: list[np.ndarray], percent: int):
        self.percent, self.size = percent, np.array([len(s) for s in sets])
        self.start = np.cumsum(self.size) - self.size
        flat = np.concatenate(sets)
        _, self.flat = np.unique(flat, return_inverse=True)
        self.mark = np.zeros(int(self.flat.max()) + 1, np.int64)
        probe = probe_length(self.size, percent)
        self.first = np.cumsum(probe) - probe
        self.owner = np.repeat(np.arange(len(sets)), probe)
        self.place = np.arange(len(self.owner)) - self.first[self.owner]
        entry = self.start[self.owner] + self.place
        self.gram = self.flat[entry]
        self.mine = np.zeros(len(entry), bool)
        for i, places in enumerate(mine):
            self.mine[self.first[i] + places] = True
        # Sizes of the parts of every set, and of what follows each prefix place.
        part = (mix(flat) >> np.uint64(60)).astype(np.int64)
        whole = np.zeros((len(sets), PIVOTS), np.int32)
        np.add.at(whole, (np.repeat(np.arange(len(sets)), self.size), part), 1)
        passed = np.zeros((len(entry) + 1, PIVOTS), np.int32)
        passed[np.arange(1, len(entry) + 1), part[entry]] = 1
        np.cumsum(passed, axis=0, out=passed)
        self.after = whole[self.owner] - passed[1:] + passed[self.first[self.owner]]

    def candidates(self, x: int, usable: np.ndarray) -> np.ndarray:
        """Members among ``usable`` that may be linked with ``x`` and whose first shared n-gram is of this group."""
        own = slice(self.first[x], self.first[x] + probe_length(int(self.size[x]), self.percent))
        self.mark[self.gram[own]] = np.arange(1, own.stop - own.start + 1)
        hit = np.flatnonzero((self.mark[self.gram] > 0) & usable[self.owner])
        y, at = np.unique(self.owner[hit], return_index=True)
        there, n, m = hit[at], int(self.size[x]), self.size[y]
        here = own.start + self.mark[self.gram[there]] - 1
        self.mark[self.gram[own]] = 0
        p, q = self.place[here], self.place[there]
        least = least_overlap(n, m, self.percent)
        keep = self.mine[there] & self.mine[here] & within(n, m, p, q, self.percent)
        y, here, there, least, p, q, m = (a[keep] for a in (y, here, there, least, p, q, m))
        apart = np.abs(self.after[here] - self.after[there]).sum(axis=1)
        return y[p + q + apart <= n + m - 2 * least]

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` overlap with ``x`` as far as wanted, on full sets."""
        if not len(others):
            return others
        own = self.flat[self.start[x]:self.start[x] + self.size[x]]
        self.mark[own] = 1
        if len(others) > 64:
            shared = np.add.reduceat(self.mark[self.flat], self.start)[others]
        else:
            shared = np.array([self.mark[self.flat[self.start[y]:self.start[y] + self.size[y]]].sum() for y in others])
        self.mark[own] = 0
        union = self.size[x] + self.size[others] - shared
        return others[100 * shared >= self.percent * union]


def join_cell(sets: list[np.ndarray], mine: list[np.ndarray], component: np.ndarray, block: np.ndarray, percent: int,
              leaders: np.ndarray | None = None) -> np.ndarray:
    """Component, as the place of its first member, of every member; members start joined by ``component``.

    Members of two blocks are compared across, those of one block with each other, and with
    ``leaders`` they alone are compared with all.
    """
    cell = Cell(sets, mine, percent)
    _, first, label = np.unique(component, return_index=True, return_inverse=True)
    label = first[label]
    across = leaders is None and block.min() != block.max()
    for x in range(len(sets)) if leaders is None else leaders:
        usable = label != label[x]
        usable &= (block != block[x]) if across else (np.arange(len(sets)) > x) | (leaders is not None)
        if not usable.any():
            continue
        for y in cell.linked(x, cell.candidates(x, usable)):
            a, b = label[x], label[y]
            if a != b:
                label[label == max(a, b)] = min(a, b)
    return label


def _leaders(rows: pa.RecordBatch) -> np.ndarray:
    """Places of the members that are compared with all of their group."""
    return np.flatnonzero(rows.column("leads").to_numpy(zero_copy_only=False))


def _arrays(column) -> list[np.ndarray]:
    flat, bounds = column.flatten().to_numpy(), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(bounds - bounds[0], bounds[1:] - bounds[0])]


def _fitting_cells(batches, percent: int, led: bool):
    """Members that may be linked with another, cell by cell; columns leader, low, high, node, ..."""
    for rows in _groups(batches, 3):
        node, component, block, size = (rows.column(c).to_numpy() for c in ("node", "component", "block", "size"))
        parts = np.frombuffer(b"".join(x.as_py() for x in rows.column("parts")), np.uint16).reshape(len(node), -1).astype(np.int64)
        sides = Sides(size.astype(np.int64), _arrays(rows.column("grams")), _arrays(rows.column("places")), parts, percent)
        kept = fitting(sides, component, block, _leaders(rows) if led else None)
        yield pa.RecordBatch.from_pydict({"leader": rows.column("leader").to_numpy()[kept], "node": node[kept]})


def _cells(batches, percent: int, led: bool):
    """Links between components, cell by cell; columns leader, low, high, node, ..."""
    for rows in _groups(batches, 3):
        leaders, component, block = _leaders(rows) if led else None, rows.column("component").to_numpy(), rows.column("block").to_numpy()
        if led and not len(leaders):
            continue
        label = join_cell(_words(rows.column("keys")), _arrays(rows.column("places")), component, block, percent, leaders)
        _, first, given = np.unique(component, return_index=True, return_inverse=True)
        joined = np.flatnonzero(label != first[given])
        yield pa.RecordBatch.from_pydict({"a": component[label[joined]], "b": component[joined]})


# Join

def _shared_postings(texts: DataFrame, words: int, percent: int, common, ranges: int) -> DataFrame:
    """Prefix n-grams that more than one posting has: gram, node, size, place.

    Postings move once, in packed columns, to the task of their range, which drops those of one set only.
    """
    kinds = {"grams": np.uint32, "nodes": np.int64, "sizes": np.int32, "places": np.int32}

    def postings(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        row, hashes, rows = shingles(batch.column(1), words)
        hashes = ordered(row, hashes, common, ranges)
        size = np.bincount(row, minlength=rows)
        place = np.arange(len(row)) - (np.cumsum(size) - size)[row]
        kept = place < probe_length(size, percent)[row]
        keys, row = gram_keys(hashes[kept], ranges), row[kept]
        return (keys >> np.uint64(32)).astype(np.int64), keys, batch.column(0).to_numpy()[row], size[row], place[kept]

    def packed(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        part, *columns = (np.concatenate(made) for made in zip(*held))
        order = np.argsort(part, kind="stable")
        part, columns = part[order], [made[order].astype(kind) for made, kind in zip(columns, kinds.values())]
        edges = [*np.flatnonzero(np.diff(part, prepend=-1)), len(part)]
        for start, stop in zip(edges, edges[1:]):
            yield pa.RecordBatch.from_pydict({"part": part[start:start + 1], **{
                name: pa.array([made[start:stop].tobytes()], pa.binary()) for name, made in zip(kinds, columns)}})

    def send(batches):
        held, size = [], 0
        for batch in batches:
            for cut in slices(batch):
                held.append(postings(cut))
                size += len(held[-1][0])
                if size > RANGE // 2:
                    yield from packed(held)
                    held, size = [], 0
        if size:
            yield from packed(held)

    def shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        grams, *rest = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(c)]) for c, kind in kinds.items())
        order = np.argsort(grams, kind="stable")
        same = np.diff(grams[order].astype(np.int64)) == 0
        order = order[np.append(same, False) | np.insert(same, 0, False)]
        gram = (grams[order].astype(np.uint64) | np.uint64(key[0].as_py() << 32)).view(np.int64)
        return pa.table({"gram": gram, **{name: made[order] for name, made in zip(("node", "size", "place"), rest)}})
    sent = texts.select("node", "text").mapInArrow(send, "part bigint, grams binary, nodes binary, sizes binary, places binary")
    return sent.groupBy("part").applyInArrow(shared, "gram bigint, node bigint, size int, place int")


def _sets(texts: DataFrame, words: int, common, ranges: int) -> DataFrame:
    """Whole sets in the common order, eight bytes an n-gram."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, hashes, rows = shingles(batch.column(1), words)
        hashes, first = ordered(row, hashes, common, ranges), np.searchsorted(row, np.arange(rows + 1))
        return pa.RecordBatch.from_pydict({
            "node": batch.column(0), "keys": pa.array([hashes[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())})
    return map_slices(texts.select("node", "text"), work, "node bigint, keys binary")


def _led(live: DataFrame, seed: int) -> DataFrame:
    """Members of n-grams whose documents are in several components, with the n-gram's smallest member by a hash, and its component."""
    leader, main = F.min("node"), F.min("node")  # at first every node is a component
    if seed:
        smallest = F.min(F.struct(F.xxhash64("node", F.lit(seed)), "node", "component"))
        leader, main = smallest["node"], smallest["component"]
    grams = live.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), leader.alias("leader"), main.alias("main"))
    grams = written(grams.where("low <> high").select("gram", "leader", "main"), "grams")
    # Both sides are tables that no aggregation dealt out: a hash of the key would only be moved along.
    return live.join(sent_if_small(grams, 64), "gram")


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with their component after ``links`` between components."""
    labels = components(links).select(F.col("node").alias("component"), F.col("component").alias("joined"))
    return join_back(rows, labels, ["component"]).withColumn("component", F.coalesce("joined", "component")).drop("joined")


def _blocks(size: str, which=None):
    """Blocks of the rows of a group, or of those ``which`` holds for."""
    which = F.lit(True) if which is None else which
    return F.greatest(F.ceil(F.count_if(which) / BLOCK), F.ceil(F.sum(F.when(which, F.col(size)).otherwise(0)) / BLOCK_GRAMS), F.lit(1)).cast("int")


def _dealt(members: DataFrame, seed: int) -> tuple[DataFrame, bool]:
    """Members of groups with the number of blocks for all, for those of the smallest member's component and for the rest.

    ``leads`` marks the smallest member and up to ``LEADERS`` others of a group of several blocks. Also whether there is such a group.
    """
    members = members.withColumn("rest", F.col("component") != F.col("main"))
    mark = F.xxhash64("node", F.lit(seed + ROUNDS))
    drawn = [F.min(F.when(F.pmod(mark, F.lit(LEADERS)) == i, F.struct(mark, "node")))["node"] for i in range(LEADERS)]
    groups = members.groupBy("leader").agg(
        _blocks("size").alias("blocks"), _blocks("size", ~F.col("rest")).alias("mains"), _blocks("size", F.col("rest")).alias("rests"),
        F.array("leader", *drawn).alias("drawn"))
    large = written(groups.where("blocks > 1"), "large-groups")
    dealt = join_back(members, sent_if_small(large, 128), ["leader"]).withColumns({
        "blocks": F.coalesce("blocks", F.lit(1)), "leads": F.coalesce(F.array_contains("drawn", F.col("node")), F.lit(False))})
    return dealt.drop("drawn"), not large.isEmpty()


def _in_cells(dealt: DataFrame, led: bool) -> DataFrame:
    """Rows of members a cell (leader, low, high): all with those that lead, or all pairs but those of the smallest member's component."""
    if led:
        rows = dealt.where("blocks > 1").withColumn("block", F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)"))
        return rows.withColumn("low", F.explode(F.expr("IF(leads, sequence(0, blocks - 1), array(block))"))).withColumn("high", F.col("low"))
    place = F.expr("IF(blocks = 1, 0, IF(rest, mains + CAST(pmod(xxhash64(node), rests) AS INT), CAST(pmod(xxhash64(node), mains) AS INT)))")
    others = F.expr("IF(blocks = 1, array(0), IF(rest, sequence(0, mains + rests - 1), sequence(mains, mains + rests - 1)))")
    return dealt.withColumn("block", place).withColumn("other", F.explode(others)).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")})


def find_links(texts: DataFrame, parts: DataFrame, total: int, words: int, percent: int) -> DataFrame:
    """Links (a, b) between the ``node``s of ``texts``, all of different sets, enough to connect every component.

    ``parts`` has the sizes of the parts of each node's set, ``total`` is the number of n-grams in all.
    """
    ranges = max(1, math.ceil(total / RANGE))
    common = common_grams(texts, ranges, words)
    live = written(_shared_postings(texts, words, percent, common, ranges), "postings").withColumn("component", F.col("node"))
    order, found = ["leader", "low", "high"], None

    def compared(dealt: DataFrame, led: bool) -> DataFrame:
        light = _in_cells(dealt, led).join(parts, "node").select(*order, "node", "component", "block", "leads", "size", "places", "grams", "parts")
        light = light.repartition(*order).sortWithinPartitions(*order, "node")
        able = written(light.mapInArrow(lambda batches: _fitting_cells(batches, percent, led), "leader bigint, node bigint").distinct(), "able")
        able = sent_if_small(able, 64)
        rows = join_back(_in_cells(dealt, led).drop("grams"), able, ["leader", "node"], "left_semi")
        sets = _sets(texts.join(able.select("node"), "node", "left_semi"), words, common, ranges)
        rows = rows.join(sets, "node").select(*order, "node", "component", "block", "leads", "places", "keys")
        rows = rows.repartition(*order).sortWithinPartitions(*order, "node")
        return written(rows.mapInArrow(lambda batches: _cells(batches, percent, led), "a bigint, b bigint"), "links")

    for attempt in range(ROUNDS + 1):
        live = written(_led(live, attempt), "live")
        met = live.groupBy("leader", "main", "node", "component", "size").agg(F.array_sort(F.collect_list(F.struct("place", "gram"))).alias("mine"))
        met = met.select("leader", "main", "node", "component", "size", F.col("mine.place").alias("places"), F.col("mine.gram").alias("grams"))
        dealt, large = _dealt(written(met, "groups"), attempt)
        if large and attempt < ROUNDS:
            links = compared(dealt, True)
            if not links.isEmpty():
                found = links if found is None else found.unionByName(links)
                live = _labelled(live.drop("leader", "main"), links)
                continue
        # Nothing was joined since these groups were made, so they hold for the comparison of all members as well.
        links = compared(dealt, False)
        return links if found is None else found.unionByName(links)


def _nodes(documents: DataFrame) -> tuple[DataFrame, bool]:
    """``doc_id``, ``node`` and text; the texts of an id on several rows are nodes of their own."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    repeated = written(rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("node", F.col("doc_id")), False
    own = F.expr("(xxhash64(doc_id, text) & 4611686018427387903) | 4611686018427387904")
    few = sent_if_small(repeated).withColumn("many", F.lit(True))
    return rows.join(few, "doc_id", "left").withColumn("node", F.when(F.col("many"), own).otherwise(F.col("doc_id"))).drop("many"), True


def similar_documents(documents: DataFrame, words: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """``doc_id``, set size and component of every row."""
    rows, repeated = _nodes(documents)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, keys, count = shingles(batch.column(2), words)
        sums = np.zeros((2, count), np.uint64)
        size = np.bincount(row, minlength=count)
        filled = np.flatnonzero(size)
        for out, salt in zip(sums, (1, 2)):
            if len(filled):
                out[filled] = np.add.reduceat(mix(keys + np.uint64(salt)), (np.cumsum(size) - size)[filled])
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "node": batch.column(1), "n_shingles": size.astype(np.int64),
            "sum_1": sums[0].view(np.int64), "sum_2": sums[1].view(np.int64), "parts": pa.array(part_sizes(row, keys, count), pa.binary())})
    made = written(map_slices(rows.select("doc_id", "node", "text"), work,
                              "doc_id bigint, node bigint, n_shingles bigint, sum_1 bigint, sum_2 bigint, parts binary"), "sums")
    same = ["n_shingles", "sum_1", "sum_2"]
    classes = made.where("node IS NOT NULL AND n_shingles > 0").groupBy(*same).agg(F.min("node").alias("class_id"))
    classes = written(classes, "classes")
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    member = written(join_back(made, classes, same).select(
        "doc_id", "node", "n_shingles", F.when(F.col("node").isNotNull(), F.col("class_id")).alias("class_id")), "members")
    chosen = sent_if_small(classes.select(F.col("class_id").alias("node")), 48)
    texts, parts = (df.join(chosen, "node", "left_semi") for df in (rows.select("node", "text"), made.select("node", "parts")))
    links = find_links(texts, parts, total, words, percent)
    if repeated:
        # Equal rows of a repeated id hold one text; its nodes are one document.
        tied = member.where("class_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("class_id").alias("all")).where("size(all) > 1")
        links = links.unionByName(tied.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b"))
    joined = components(written(links, "all-links")).withColumnsRenamed({"node": "class_id", "component": "joined"})
    found = join_back(member, joined, ["class_id"]).withColumn("component", F.coalesce("joined", "class_id", "doc_id"))
    if repeated:
        found = written(found, "found")
        least = found.groupBy("component").agg(F.min("doc_id").alias("least"))
        found = join_back(found, least, ["component"]).withColumn("component", F.when(F.col("doc_id").isNotNull(), F.col("least")))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


#: ``similar_documents`` with n-grams of four words at 85 percent, by comparing all documents that share one.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS said
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.said = b.said AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)),
r(doc_id, root) AS (SELECT x, x FROM e UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
