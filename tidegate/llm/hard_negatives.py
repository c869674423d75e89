"""Hard negatives by cover trees over norm-augmented vectors.

A row's score for an anchor is the inner product of their vectors, whose components are
floor(``SCALE`` x). An anchor's positives are the ``POSITIVES`` rows of its label with the highest
scores; for each of them the ``NEGATIVES`` highest rows of other labels are wanted whose score
is ``LOWEST`` to 100 percent of the positive's.

1. Rows are dealt by a hash of the id into blocks of about ``BLOCK``, each with a cover tree. Vectors get one more component that gives all
   of them the length of the longest, so the inner product falls as the distance grows. A node of covering radius r has
   children of radius r / ``SPREAD`` at most, each centre outside the others' balls; every node keeps the
   measured distance to the farthest row below it. Children of fewer than ``LEAST`` rows share leaves of ``LEAF``. The trees are written to the shared folder, one row a tree.
2. Anchors and trees meet in cells of one tree and at most ``ANCHORS`` anchors. A search goes down the
   tree best first: a node's centre and radius bound the inner products below it from both sides, nodes outside
   every open window are skipped, and rows of a leaf are scored exactly. The first search looks for the highest
   rows of the anchor's own label; the second, with the positives of all trees known, fills the window of
   each positive.
3. Each tree gives at most ``POSITIVES`` (``NEGATIVES``) rows per anchor (and positive); ranking windows
   keep the first of them, and Spark cuts them before they are shuffled.

Rows with a null id, label or vector, or with a null or non-finite component take no part. Of rows that share an
id the first by label, then vector, does. Ties go to the smaller id. A vector shorter than the longest is
continued with zeros. Inner products are exact as long as they stay below 2**53. A negative score has
no window, and a score of zero only zero. Empty tables, and anchors without a positive or negative, give no
rows. Columns other than the three are ignored, whatever their names; vectors of any length are held a block at a time.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import sent_if_small, written

SCALE, POSITIVES, NEGATIVES, LOWEST = 256, 5, 5, 80
#: Rows of one tree, of a leaf, and of a child that gets a node of its own; ratio of covering radii between levels; anchors of a cell.
BLOCK, LEAF, LEAST, SPREAD, ANCHORS = 4096, 1024, 256, 1.3, 4096

VECTOR = "vec_id bigint, label bigint, vector binary"
TREE = ("tree bigint, vec_id binary, label binary, vectors binary, centre binary, radius binary, "
        "child binary, fan binary, start binary, stop binary, longest double")


# Trees

def augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    """``vectors`` with one more component, after which every row has the squared length ``longest``."""
    rest = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.column_stack([vectors, rest])


def build_tree(vectors: np.ndarray) -> dict[str, np.ndarray]:
    """A cover tree over rows: an order of them, and per node its centre row, covering radius, rows and children.

    Children of a node follow one another from ``child`` on; ``fan`` is their number, 0 for a leaf.
    """
    longest = float(np.einsum("ij,ij->i", vectors, vectors).max())
    points = augmented(vectors, longest)
    order = np.arange(len(points))
    centre, radius, child, fan, start, stop = [0], [0.0], [0], [0], [0], [len(points)]
    todo = [0]
    while todo:
        node = todo.pop()
        low, high = start[node], stop[node]
        rows = order[low:high]
        far = np.linalg.norm(points[rows] - points[centre[node]], axis=1)
        radius[node] = float(far.max())
        if len(rows) <= LEAF or radius[node] == 0.0:
            continue
        reach = radius[node] / SPREAD
        left, distance, groups, loose = rows, far, [], []
        middle = centre[node]
        while True:
            inside = distance <= reach
            (groups if inside.sum() >= LEAST else loose).append((middle, left[inside]))
            left = left[~inside]
            if not len(left):
                break
            middle = int(left[0])
            distance = np.linalg.norm(points[left] - points[middle], axis=1)
        if loose:
            # Rows that cover few others: leaves of up to LEAF rows around the node's own centre.
            alone = np.concatenate([rows for _, rows in loose])
            groups += [(centre[node], alone[i:i + LEAF]) for i in range(0, len(alone), LEAF)]
        if len(groups) == 1:
            continue
        child[node], fan[node], at = len(centre), len(groups), low
        for middle, members in groups:
            order[at:at + len(members)] = members
            todo.append(len(centre))
            centre.append(middle)
            radius.append(0.0)
            child.append(0)
            fan.append(0)
            start.append(at)
            stop.append(at + len(members))
            at += len(members)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return {"order": order, "centre": place[np.array(centre)], "radius": np.array(radius), "child": np.array(child), "fan": np.array(fan),
            "start": np.array(start), "stop": np.array(stop), "longest": longest}


class Tree:
    """One stored tree; rows stand in tree order."""

    def __init__(self, row: dict):
        for name in ("vec_id", "label", "centre", "child", "fan", "start", "stop"):
            setattr(self, name, np.frombuffer(row[name], np.int64))
        self.radius, self.longest = np.frombuffer(row["radius"], float), row["longest"]
        self.vectors = np.frombuffer(row["vectors"], float).reshape(len(self.vec_id), -1)
        self.points = augmented(self.vectors, self.longest)

    def bounds(self, query: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of a row below each node, rounded outwards."""
        length = float(query @ query)
        inner = self.vectors[self.centre[nodes]] @ query
        apart = np.sqrt(np.maximum(length + self.longest - 2 * inner, 0))
        near, far = np.maximum(apart - self.radius[nodes], 0), apart + self.radius[nodes]
        slack = 1e-9 * (length + self.longest) + 1e-6
        sphere = (length + self.longest - far * far) / 2, (length + self.longest - near * near) / 2
        reach = np.sqrt(length) * self.radius[nodes]
        return np.maximum(sphere[0], inner - reach) - slack, np.minimum(sphere[1], inner + reach) + slack

    def search(self, query: np.ndarray, usable, windows: list[tuple[float, float]], k: int) -> list[list[tuple[int, int]]]:
        """The first ``k`` usable rows of every window (low, high) of scores, as (-score, id) in order."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        floor, highest = [low for low, _ in windows], max(high for _, high in windows)
        least, most = self.bounds(query, np.zeros(1, np.int64))
        heap = [(-most[0], 0, least[0])]
        while heap:
            upper, node, lower = heapq.heappop(heap)
            upper = -upper
            if upper < min(floor):
                break
            if not any(upper >= f and lower <= high for f, (_, high) in zip(floor, windows)):
                continue
            if self.fan[node]:
                nodes = np.arange(self.child[node], self.child[node] + self.fan[node])
                for item in zip(*(x.tolist() for x in self.bounds(query, nodes)), nodes.tolist()):
                    heapq.heappush(heap, (-item[1], item[2], item[0]))
                continue
            score = self.vectors[self.start[node]:self.stop[node]] @ query
            hit = np.flatnonzero((score >= min(floor)) & (score <= highest))
            hit = hit[usable(self.start[node] + hit)]
            score, row = score[hit], self.vec_id[self.start[node] + hit]
            for i, (_, high) in enumerate(windows):
                best = np.flatnonzero((score >= floor[i]) & (score <= high)) if len(hit) else hit
                if len(best):
                    if len(best) > k:
                        best = best[np.lexsort((row[best], -score[best]))[:k]]
                    made = zip((-score[best]).astype(np.int64).tolist(), row[best].tolist())
                    found[i] = sorted([*found[i], *made])[:k]
                    if len(found[i]) == k:
                        floor[i] = -found[i][-1][0]
        return found


def _stored(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The tree of one block as a row."""
    vectors = np.stack([np.frombuffer(x.as_buffer(), float) for x in rows.column("vector")])
    made = build_tree(vectors)
    order = made["order"]
    out = {"vec_id": rows.column("vec_id").to_numpy()[order], "label": rows.column("label").to_numpy()[order], "vectors": vectors[order]}
    out |= {name: made[name] for name in ("centre", "radius", "child", "fan", "start", "stop")}
    return pa.table({"tree": [key[0].as_py()]} | {name: pa.array([x.tobytes()], pa.binary()) for name, x in out.items()} | {"longest": [made["longest"]]})


# Mining

def usable_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, label and packed scaled vector of the rows that take part, one an id."""
    real = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding").where(
        f"vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {real}")
    repeated = written(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    if not repeated.isEmpty():
        few = sent_if_small(repeated)
        first = rows.join(few, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
        rows = rows.join(few, "vec_id", "left_anti").unionByName(first.select("vec_id", "row.label", "row.embedding"))
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0

    def pack(batches):
        for batch in batches:
            column = batch.column(2)
            size = column.value_lengths().to_numpy()
            flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(float))
            full = np.zeros((len(size), width))
            full[np.arange(width) < size[:, None]] = flat
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0), "label": batch.column(1), "vector": pa.array([x.tobytes() for x in full], pa.binary())})
    return written(rows.mapInArrow(pack, VECTOR), "vectors") if width else rows.select("vec_id", "label", F.lit(b"").alias("vector")).limit(0)


def _in_cells(anchors: DataFrame, asked: int, trees: DataFrame, blocks: int, work, schema: str) -> DataFrame:
    """``work(tree, anchors)`` for every tree and anchor, in cells of one tree and about ``ANCHORS`` anchors."""
    chunks = -(-asked // ANCHORS)
    left = trees.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = anchors.withColumn("chunk", F.expr(f"CAST(pmod(xxhash64(anchor_id, 1), {chunks}) AS INT)")).withColumn(
        "tree", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    empty = pa.schema([(c.split()[0], pa.int64()) for c in schema.split(", ")]).empty_table()

    def cell(tree: pa.Table, some: pa.Table) -> pa.Table:
        return work(Tree(tree.to_pylist()[0]), some) if tree.num_rows and some.num_rows else empty
    return left.groupBy("tree", "chunk").cogroup(right.groupBy("tree", "chunk")).applyInArrow(cell, schema)


def _highest(tree: Tree, anchors: pa.Table, k: int) -> pa.Table:
    """Rows of the anchor's label with the highest scores."""
    out = []
    for a, label, vector in zip(*(anchors.column(c).to_pylist() for c in ("anchor_id", "label", "vector"))):
        own = lambda rows: (tree.label[rows] == label) & (tree.vec_id[rows] != a)  # noqa: B023, E731
        out += [(a, -s, i) for s, i in tree.search(np.frombuffer(vector, float), own, [(-np.inf, np.inf)], k)[0]]
    return pa.Table.from_arrays(list(np.array(out, np.int64).reshape(-1, 3).T), ["anchor_id", "positive_score", "positive_id"])


def _windowed(tree: Tree, anchors: pa.Table, k: int, lowest: int) -> pa.Table:
    """Rows of other labels with the highest scores in the window of each positive."""
    out = []
    for a, label, vector, positives in zip(*(anchors.column(c).to_pylist() for c in ("anchor_id", "label", "vector", "positives"))):
        open_ = [p for p in positives if p["positive_score"] >= 0]
        if not open_:
            continue
        windows = [(-(-lowest * p["positive_score"] // 100), p["positive_score"]) for p in open_]
        found = tree.search(np.frombuffer(vector, float), lambda rows: tree.label[rows] != label, windows, k)  # noqa: B023
        out += [(a, p["positive_id"], p["positive_score"], -s, i) for p, rows in zip(open_, found) for s, i in rows]
    return pa.Table.from_arrays(list(np.array(out, np.int64).reshape(-1, 5).T), [
        "anchor_id", "positive_id", "positive_score", "negative_score", "negative_id"])


def _first(rows: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(tie))
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST) -> DataFrame:
    """Negatives of every positive of ``anchors``, both in the form of ``usable_vectors``."""
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    blocks, asked = -(-vectors.count() // BLOCK), anchors.count()
    if not blocks or not asked:
        return vectors.sparkSession.createDataFrame([], result)
    dealt = vectors.withColumn("tree", F.expr(f"pmod(xxhash64(vec_id), {blocks})"))
    trees = written(dealt.groupBy("tree").applyInArrow(_stored, TREE), "trees")
    anchors = anchors.withColumnRenamed("vec_id", "anchor_id")
    cells = lambda rows, work, schema: _in_cells(rows, asked, trees, blocks, work, schema)
    near = cells(anchors, lambda tree, some: _highest(tree, some, positives), "anchor_id bigint, positive_score bigint, positive_id bigint")
    near = _first(near, ["anchor_id"], "positive_score", "positive_id", positives).groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    pairs = written(anchors.join(near, "anchor_id"), "positives")
    far = cells(pairs, lambda tree, some: _windowed(tree, some, negatives, lowest),
                "anchor_id bigint, positive_id bigint, positive_score bigint, negative_score bigint, negative_id bigint")
    far = _first(far, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
    return far.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives for every id divisible by 100, against all rows; ids divisible by 7 have the next label of ten."""
    rows = embeddings.withColumn("label", F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label")))
    vectors = usable_vectors(rows)
    return mine(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
