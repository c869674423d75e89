"""Near duplicates by MinHash bands, odd sketches and exact confirmation.

A text's set holds its distinct shingles of a number of lower-cased words (five, unless the
caller says otherwise), or its whole word sequence when it is shorter. Two texts are linked when their sets overlap to ``SIMILARITY``
percent or more; components of linked texts share the smallest id.

1. One pass over the texts makes, per document, ``SAMPLES`` MinHash samples, their hashes in
   ``BANDS`` bands, an odd sketch (a parity bitmap into which every sample flips one bit) and
   a checksum of the set. Texts with equal sets are one class, named by its smallest id.
2. Classes that share a band meet in a bucket. Two sketches differ in a number of bits that
   estimates how many samples differ, so unlike pairs are dropped before any set is read; the
   limit lies far below the similarity wanted, and every pair above it is confirmed on full sets.
3. Buckets are not expanded into pairs. All buckets with the same smallest member form one
   group, so a document is in few groups, however many bands it shares. A group is cut into
   cells of ``BLOCK`` members, each with the group's smallest member as its leader. A task
   compares the sketches of a cell, confirms pairs from the most to the least alike on full sets, and only
   while the two are in different components. Members that no cell connects with the leader are then
   compared with all cells, in blocks. No possible link is left out. A group of copies costs about one
   confirmation a member and moves each set once; each further ``BLOCK`` of unconnected
   members moves it once more. Only one link a member leaves the task.
4. Components are joined over all groups by smallest-neighbour steps and pointer jumps.

Pairs at the limit of similarity miss all bands with probability (1 - 0.8^4)^32, about 5e-8.

A null or empty text has an empty set and no links. Rows with a null id are returned with a
null component and not kept, and link nothing. Rows that share an id are one document to
``near_duplicates``: their links add up. Columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import free_name, map_slices, sent_if_small, written
from .words import Words, mix, windows

SHINGLE, SIMILARITY = 5, 80
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Estimated similarity below which a pair is not confirmed: five deviations of 128 samples below 0.8, and more for bits that meet.
ESTIMATE_LIMIT = 0.45
#: Members, and shingles, of one block.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
STRIP = 64

_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(column, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and hash of every distinct shingle, ascending, and the number of rows."""
    words = Words(column)
    hashes = words.hashes()
    keys, at = windows(hashes, words.row, n)
    row, count = words.row[at], words.counts()
    made = [(row, keys)]
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for i in range(size):
                whole = whole * np.uint64(0xD6E8FEB86659FD93) + hashes[words.first[short] + i]
            made.append((short, mix(whole + np.uint64(size))))
    row, keys = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
    order = np.lexsort((keys, row))
    row, keys = row[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return row[new], keys[new], words.rows


def sketches(row: np.ndarray, keys: np.ndarray, rows: int) -> dict[str, np.ndarray]:
    """Set size, two checksums, band hashes and odd sketch of each row."""
    size = np.bincount(row, minlength=rows)
    filled = np.flatnonzero(size)
    first = (np.cumsum(size) - size)[filled]
    sums = np.zeros((2, rows), np.uint64)
    bands = np.zeros((rows, BANDS), np.uint64)
    bits = np.zeros((rows, SKETCH_BITS // 8), np.uint8)
    if len(filled):
        for out, salt in zip(sums, (1, 2)):
            out[filled] = np.add.reduceat(mix(keys + np.uint64(salt)), first)
        for i, factor in enumerate(_FACTORS):
            least = mix(np.minimum.reduceat(keys * factor, first) + np.uint64(i))
            bands[filled, i // ROWS] = mix(bands[filled, i // ROWS] * np.uint64(31) + least)
            place = least >> np.uint64(64 - 9)
            bits[filled, (place >> np.uint64(3)).astype(np.int64)] ^= np.left_shift(1, (place & np.uint64(7)).astype(np.int64)).astype(np.uint8)
    return {"size": size, "sums": sums, "bands": bands, "bits": bits}


def estimate(different_bits: np.ndarray) -> np.ndarray:
    """Similarity estimated from the number of bits in which two sketches differ."""
    share = np.minimum(2 * different_bits / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS * np.log1p(-share) / (4 * SAMPLES)


FEATURES = "doc_id bigint, n_shingles bigint, sum_1 bigint, sum_2 bigint, bands array<bigint>, sketch binary"


def features(documents: DataFrame, words: int = SHINGLE) -> DataFrame:
    """Set size, set checksums, bands and sketch of every document."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = sketches(*shingles(batch.column(1), words))
        rows = batch.num_rows
        bands = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS), pa.array(made["bands"].view(np.int64).ravel()))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_shingles": made["size"].astype(np.int64), "sum_1": made["sums"][0].view(np.int64),
            "sum_2": made["sums"][1].view(np.int64), "bands": bands, "sketch": pa.array([b.tobytes() for b in made["bits"]], pa.binary())})
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_slices(rows, work, FEATURES)


def _words(column: pa.BinaryArray) -> list[np.ndarray]:
    """The values of an Arrow binary column as arrays of 64-bit words, without a copy."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [whole[a:b].view(np.uint64) for a, b in zip(bounds, bounds[1:])]


def _linked(left: np.ndarray, right: np.ndarray) -> bool:
    same = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * same >= SIMILARITY * (len(left) + len(right) - same)


def join_block(block: np.ndarray, bits: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Component, as the place of its first member, of every member of one block or pair of blocks.

    Members of a pair of blocks are compared across it, those of a single block with each
    other. ``STRIP`` members at a time meet all later ones; their pairs are confirmed in falling
    order of estimated similarity, and only while the two are in different components.
    """
    size = np.array([len(s) for s in sets])
    label = np.arange(len(sets))
    across = block.min() != block.max()
    for begin in range(0, len(sets) - 1, STRIP):
        found = []
        for a in range(begin, min(begin + STRIP, len(sets) - 1)):
            b = np.flatnonzero(label[a + 1:] != label[a]) + a + 1
            if across:
                b = b[block[b] != block[a]]
            low, high = np.minimum(size[b], size[a]), np.maximum(size[b], size[a])
            b = b[100 * low >= SIMILARITY * high]
            near = estimate(np.bitwise_count(bits[b] ^ bits[a]).sum(axis=1, dtype=np.int64))
            b, near = b[near >= ESTIMATE_LIMIT], near[near >= ESTIMATE_LIMIT]
            found.append((near.astype(np.float32), np.full(len(b), a, np.int32), b.astype(np.int32)))
        near, left, right = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(-near, kind="stable")
        left, right = left[order], right[order]
        for first in range(0, len(left), 4096):
            part = slice(first, first + 4096)
            for k in np.flatnonzero(label[left[part]] != label[right[part]]) + first:
                a, b = label[left[k]], label[right[k]]
                if a != b and _linked(sets[left[k]], sets[right[k]]):
                    label[label == max(a, b)] = min(a, b)
    return label


def _groups(batches, keys: int):
    """The rows of one key each, from batches sorted by their first ``keys`` columns; a copy, so that batches can go."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(max(0, batch.num_rows - 1), bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            if start == stop:
                continue
            key = tuple(int(column[start]) for column in columns)
            if held and key != last:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.concat_batches(held)


def _stars(batches):
    """Group by group, links from the first member of each component to its others.

    Where the group is a cell of a larger one, a row (doc_id, null, leader) names each member that is
    not connected with the leader here.
    """
    made, held = [], 0
    for group in _groups(batches, 3):
        node = group.column("doc_id").to_numpy()
        sets, bits = (_words(group.column(name)) for name in ("keys", "sketch"))
        label = join_block(group.column("block").to_numpy(), np.stack(bits), sets)
        joined = np.flatnonzero(label != np.arange(len(label)))
        left, right, lead = node[label[joined]], node[joined], np.full(len(joined), -1)
        leader = group.column("leader")[0].as_py()
        if group.column("cells")[0].as_py() > 1:
            led = np.isin(label, label[node == leader])
            apart = np.setdiff1d(node, node[led])
            left, right, lead = (np.concatenate(x) for x in ((left, apart), (right, np.full(len(apart), -1)), (lead, np.full(len(apart), leader))))
        is_link = np.arange(len(left)) < len(joined)
        made.append(pa.RecordBatch.from_arrays(
            [pa.array(left), pa.array(right, mask=~is_link), pa.array(lead, mask=is_link)], names=["a", "b", "leader"]))
        held += len(left)
        if held > 1 << 16:
            yield pa.concat_batches(made)
            made, held = [], 0
    if made:
        yield pa.concat_batches(made)


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every linked node, by smallest-neighbour steps and pointer jumps; columns a, b."""
    edges = written(links.where("a <> b").selectExpr("a", "b").union(links.where("a <> b").selectExpr("b", "a")).distinct(), "links")
    labels = written(edges.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("middle"))
        jump = labels.select(F.col("node").alias("middle"), F.col("component").alias("beyond"))
        moved = written(step.join(jump, "middle", "left").select(
            "node", "before", F.least("middle", "beyond").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.where("before <> component").isEmpty():
            return labels


def once_per_id(df: DataFrame, repeated: DataFrame, key: list[str]) -> DataFrame:
    """``df`` without repeated ``key``s, which only ids in the written table ``repeated`` can have; other rows do not move."""
    if repeated.isEmpty():
        return df
    few = sent_if_small(repeated)
    once = df.join(few, "doc_id", "left_anti").select(*df.columns)
    return once.unionByName(df.join(few, "doc_id", "left_semi").select(*df.columns).dropDuplicates(key))


def _blocks():
    return F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")


def _place(blocks: str):
    return F.expr(f"CAST(pmod(xxhash64(doc_id), {blocks}) AS INT)")


def _sets(documents: DataFrame, nodes: DataFrame, repeated: DataFrame, words: int) -> DataFrame:
    """``doc_id``, set and sketch of the documents in the written table ``nodes``."""
    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, keys, rows = shingles(batch.column(1), words)
        first = np.searchsorted(row, np.arange(rows + 1))
        made = sketches(row, keys, rows)["bits"]
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "keys": pa.array([keys[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()),
            "sketch": pa.array([b.tobytes() for b in made], pa.binary())})
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sent_if_small(nodes), "doc_id", "left_semi")
    held = map_slices(texts.select("doc_id", "text"), sets, "doc_id bigint, keys binary, sketch binary").where("length(keys) > 0")
    return once_per_id(held, repeated, ["doc_id", "keys"])


def _compared(dealt: DataFrame, held: DataFrame) -> DataFrame:
    """What ``_stars`` finds in each (leader, low, high) of ``dealt``."""
    order = ["leader", "low", "high"]
    rows = dealt.join(held, "doc_id").select(*order, "doc_id", "block", "cells", "keys", "sketch")
    return rows.repartition(*order).sortWithinPartitions(*order, "doc_id").mapInArrow(_stars, "a bigint, b bigint, leader bigint")


def find_links(documents: DataFrame, sketched: DataFrame, words: int = SHINGLE) -> DataFrame:
    """Confirmed links (a, b) between class representatives, enough to connect every component.

    A group is cut into cells, and its leader is in each of them. Members of a cell are compared with each other. What is
    connected with the leader needs no comparison with what is so in other cells. The members that
    are not are then compared with all cells, in blocks. A set therefore moves once in its group, and once more for each
    block of members that no cell connects with the leader.
    """
    banded = sketched.select("doc_id", F.posexplode("bands")).select("doc_id", F.xxhash64("pos", "col").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).where("leader <> last")
    met = banded.join(leaders.select("band", "leader"), "band").select("leader", "doc_id").distinct()
    met = written(met, "groups")
    sizes = sketched.groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles"), F.count("*").alias("rows"))
    large = written(met.join(sizes, "doc_id").groupBy("leader").agg(_blocks().alias("cells")).where("cells > 1"), "large-groups")
    placed = met.join(sent_if_small(large, 16), "leader", "left").select("leader", "doc_id", F.coalesce("cells", F.lit(1)).alias("cells"))
    cells = F.when(F.col("doc_id") == F.col("leader"), F.sequence(F.lit(0), F.col("cells") - 1)).otherwise(F.array(_place("cells")))
    dealt = placed.select("leader", "doc_id", "cells", F.explode(cells).alias("low")).withColumns({"high": F.lit(-1), "block": F.lit(0)})

    nodes = written(met.select("doc_id").distinct(), "nodes")
    repeated = written(sizes.where("rows > 1").select("doc_id"), "repeated")
    found = written(_compared(dealt, _sets(documents, nodes, repeated, words)), "cells")
    links = found.where("leader IS NULL").select("a", "b")
    apart = written(found.where("leader IS NOT NULL").select("leader", F.col("a").alias("doc_id")), "apart")
    if apart.isEmpty():
        return links
    open_groups = written(apart.join(sizes, "doc_id").groupBy("leader").agg(_blocks().alias("blocks")).join(large, "leader"), "open-groups")
    sent = sent_if_small(open_groups, 24)
    members = met.join(sent, "leader").select(
        "leader", "doc_id", _place("cells").alias("low"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("high"), F.lit(0).alias("block"))
    others = apart.join(sent, "leader").select(
        "leader", "doc_id", F.explode(F.expr("sequence(0, cells - 1)")).alias("low"), _place("blocks").alias("high"), F.lit(1).alias("block"))
    across = members.unionByName(others).withColumn("cells", F.lit(1))
    again = written(members.select("doc_id").distinct(), "open-nodes")
    return links.union(_compared(across, _sets(documents, again, repeated, words)).select("a", "b"))


def near_duplicates(documents: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id``, set size, component and whether the document stays, for every row; sets of ``words``-word shingles."""
    made = written(features(documents, words), "features")
    usable = made.where("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["n_shingles", "sum_1", "sum_2"]
    classes = usable.groupBy(*same).agg(F.min("doc_id").alias("class_id"))
    member = written(made.select("doc_id", *same).join(classes, same, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")), "classes")
    chosen = member.select("class_id").where("class_id IS NOT NULL").distinct().withColumnRenamed("class_id", "doc_id")
    links = find_links(documents, usable.join(chosen, "doc_id", "left_semi"), words)
    # An id on several rows ties their classes together.
    tied = member.where("class_id IS NOT NULL").groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).where("a <> b")
    joined = components(written(links.union(tied.select("a", "b")), "stars"))
    found = member.join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
    component = F.coalesce("component", "class_id", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _keyed(documents: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """``documents`` with a key per row; of ids in ``repeated`` one row of each text, with keys of their own after the first."""
    keyed = documents.withColumn(key, F.col("doc_id").cast("bigint"))
    if repeated.isEmpty():
        return keyed
    few, names = sent_if_small(repeated), documents.columns
    row = F.struct(*(documents[c] for c in names))
    texts = documents.join(few, "doc_id", "left_semi").groupBy("doc_id", "text").agg(
        F.min_by(row, F.struct(F.xxhash64(F.to_json(row)), F.to_json(row))).alias("row"))
    texts = written(texts.select("row", F.xxhash64("doc_id", "text").alias("mark")), "repeated-texts")
    first = texts.groupBy(F.col("row.doc_id").alias("doc_id")).agg(F.min("mark").alias("first"))
    own = F.expr("CASE WHEN mark = first THEN CAST(row.doc_id AS BIGINT) ELSE (mark & 4611686018427387903) | 4611686018427387904 END")
    texts = texts.join(first, F.col("row.doc_id") == F.col("doc_id")).select(*(F.col("row")[c].alias(c) for c in names), own.alias(key))
    return keyed.join(few, "doc_id", "left_anti").select(*keyed.columns).unionByName(texts)


def first_of_group(documents: DataFrame, words: int = SHINGLE) -> DataFrame:
    """The documents, all columns, with one row of each group of near duplicates; rows without an id stay.

    Rows that share an id and the text are one row, the first by a hash of all columns. Rows that share an id but
    not the text are documents of their own: each stays unless its own text has a near duplicate that stays.
    """
    ids = documents.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    key = free_name(documents, "row_key")
    keyed = _keyed(documents, written(ids, "repeated"), key)
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), words)
    gone = written(found.where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(key)).distinct(), "gone")
    return keyed.join(sent_if_small(gone), key, "left_anti").select(*documents.columns)


#: ``near_duplicates`` with shingles of four words, by comparing all documents that share one.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS said
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.said = b.said AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 80 * (p.n + q.n - common)),
r(doc_id, root) AS (SELECT x, x FROM e UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
