"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


#: Bytes of text of a sample, in equal shares of its labels.
SAMPLE_BYTES = 128 << 20


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int],
                    most: int = SAMPLE_BYTES) -> tuple[pa.Table, dict[int, float]]:
    """About ``per_class`` texts of each label, drawn by a hash of the id, and the share drawn of each label.

    Returns doc_id, text and label sorted by id. The ids are drawn from the narrow label
    table first and sent to every executor, which their number bounds; only the texts of the sample move. Null ids and
    labels are left out. An id on several rows gives one text, the first by a hash, which tasks choose before
    anything is sent. The texts come to the driver in the order of the draw as far as ``most`` bytes reach, so neither
    many copies of an id nor long texts make the sample larger; a text that does not fit is passed over.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL").where(
        F.col("label").isin(*per_class)).distinct()
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = {k: min(1.0, n / sizes[k]) for k, n in per_class.items() if sizes.get(k)}
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("label", pa.int32())])
    if not share:
        return schema.empty_table(), {}
    wanted = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))
    known = known.withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 30)))
    drawn = known.where(F.col("draw") / F.lit(float(1 << 30)) < wanted[F.col("label")])
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL").join(F.broadcast(drawn), "doc_id")
    # A hash that two texts share puts the smaller first.
    one = rows.groupBy("doc_id", "label", "draw").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))
    one = written(one, "sample")
    left, taken, count = dict.fromkeys(share, most // len(share)), [], dict.fromkeys(share, [0, 0])
    for r in one.select("doc_id", "label", "draw", F.octet_length("text").alias("bytes")).orderBy("label", "draw", "doc_id").collect():
        fits = r["bytes"] <= left[r["label"]]
        count[r["label"]] = [a + b for a, b in zip(count[r["label"]], (fits, 1))]
        if fits:
            left[r["label"]] -= r["bytes"]
            taken.append((r["doc_id"], r["label"]))
    share = {k: v * count[k][0] / count[k][1] if count[k][1] else v for k, v in share.items()}
    if len(taken) < sum(n for _, n in count.values()):
        few = one.sparkSession.createDataFrame(taken, "doc_id bigint, label int")
        one = one.join(F.broadcast(few), ["doc_id", "label"], "left_semi")
    table = one.select("doc_id", "text", "label").toArrow().cast(schema)
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")]), share
