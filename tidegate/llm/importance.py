"""Target-distribution importance resampling over hashed n-grams.

Text is lower-cased (A-Z), separators are collapsed to single blanks, and one regular expression
per n-gram length is scanned with overlapping matches: look-arounds hold its ends to word
boundaries, so every match is one run of words as it stands in the collapsed text. The crc32 of the
run's bytes, modulo ``BUCKETS``, is its bucket.

1. One pass over the documents leaves each text's buckets, two bytes a feature, in the shared
   folder; one over the target texts does the same. Every task adds up its buckets, so at most
   ``BUCKETS`` rows a task are shuffled, and two tables of ``BUCKETS`` counts come to the driver.
2. A bucket's gain is floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B)))); a document's weight is the sum
   of the gains of its features, read from the kept buckets.
3. Weight plus Gumbel noise from the id is the score; the highest are drawn without replacement.
   Ranks come from ranges of the order and a count per range: no task holds more than a range, and rows that
   are equal in all else are split by their place in the scan.

A null or empty text, and one of separators only, has no features and weight 0. A null id has a
null score and is never drawn, as is a document of fewer than ``MIN_WORDS`` words. Ties go to the
smaller id. Rows that share an id are rows of their own, ranked among themselves by number of features, then
weight. Texts of any length are walked match by match. An empty table gives no rows; without
target texts t and T are 0. Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written
from .words import _LOWER, NOT_ALNUM, slices, text_bytes

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
_ROW_BITS = 33
_BLANKED = np.where(NOT_ALNUM[_LOWER], 0x20, _LOWER).astype(np.uint8).tobytes()
_BLANKS = regex.compile(rb" {2,}")


def collapse(text: bytes) -> bytes:
    """Lower-cased bytes with runs of separators as one blank and none at the ends."""
    return _BLANKS.sub(b" ", text.translate(_BLANKED)).strip(b" ")


def gram_pattern(n: int) -> regex.Pattern:
    """Exactly ``n`` words of collapsed text, from one word boundary to another."""
    return regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++){%d}" % (n - 1) + rb"(?![^ ])")


def grams(text: bytes, n: int) -> Iterator[bytes]:
    """The spans of all runs of ``n`` words in collapsed text, in order, overlapping."""
    return (m[0] for m in gram_pattern(n).finditer(text, overlapped=True))


def text_buckets(text: bytes, longest: int, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """Bucket of every feature of a text, shorter runs first, and its number of words."""
    said = collapse(text)
    parts = [np.fromiter(map(zlib.crc32, grams(said, n)), np.uint32) for n in range(1, longest + 1)]
    return np.concatenate(parts) % buckets, len(parts[0])


def _kept_buckets(texts: DataFrame, keep: str, longest: int, buckets: int) -> DataFrame:
    """The first column of ``texts`` with the words, features and packed buckets of the second."""
    code = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, bounds = text_bytes(part.column(1))
                made = [text_buckets(data[a:b].tobytes(), longest, buckets) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_pydict({
                    keep: part.column(0), "n_words": np.array([n for _, n in made], np.int64),
                    "n_features": np.array([len(b) for b, _ in made], np.int64),
                    "buckets": pa.array([b.astype(code).tobytes() for b, _ in made], pa.binary())})
    return texts.mapInArrow(run, f"{keep} bigint, n_words bigint, n_features bigint, buckets binary")


def _flat(column: pa.Array, code: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All packed buckets of a batch, and where each row's begin."""
    data, bounds = text_bytes(column)
    return np.frombuffer(data.tobytes(), code), bounds // code.itemsize


def bucket_counts(kept: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of every bucket: each task adds up its own, and a table of ``buckets`` numbers comes back."""
    code = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0), code)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": seen.astype(np.int32), "n": total[seen]})
    rows = kept.select("buckets").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of smoothed bucket shares, target to source, rounded down."""
    size = len(source)
    above = (target + 1).astype(float) * float(source.sum() + size)
    below = (source + 1).astype(float) * float(target.sum() + size)
    return np.floor(1000.0 * np.log(above / below)).astype(np.int64)


def weights(kept: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, words, features and weight of every row of kept buckets."""
    code = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def run(batches):
        for batch in batches:
            flat, bounds = _flat(batch.column(3), code)
            sums = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(gain[flat], out=sums[1:])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_words": batch.column(1), "n_features": batch.column(2), "weight": np.diff(sums[bounds])})
    return kept.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel value of the id, rounded down; null for a null id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8)
    drawn = F.conv(digits, 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def ranked(scored: DataFrame, may: Column, percent: int = PERCENT) -> DataFrame:
    """``scored`` with the rank of the highest ``percent`` of the rows that ``may`` be drawn, null for others."""
    spark = scored.sparkSession
    rows = scored.withColumns({"may": F.coalesce(may, F.lit(False)), "scanned": F.monotonically_increasing_id()})
    order = [F.col("may").desc(), F.col("score").desc_nulls_last(), F.col("doc_id").asc(), F.col("n_features").asc(), F.col("weight").asc(), F.col("scanned").asc()]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # Bounds of ranges come from a sample and would differ in a second run of the plan, so the ranges are written once.
    dealt = written(dealt.withColumns({"place": place, "part": F.spark_partition_id()}), "ranges")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"), F.count_if("may").alias("able")).withColumn("all", F.lit(1))
    before = Window.partitionBy("all").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One line a range.
    starts = sizes.select(F.col("part").alias("of_part"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
                          F.floor(F.sum("able").over(Window.partitionBy("all")) * percent / 100).alias("drawn"))
    rank = F.col("start") + F.col("place") + 1
    found = dealt.join(F.broadcast(starts), F.col("part") == F.col("of_part"))
    return found.withColumn("rank", F.when(F.col("may") & (rank <= F.col("drawn")), rank).cast("bigint")).select(*scored.columns, "rank")


def resample(documents: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Features, weight, score and rank of every document under the distribution of the target texts."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    kept = written(_kept_buckets(texts, "doc_id", longest, buckets), "buckets")
    wanted = _kept_buckets(target.select(F.lit(0).cast("bigint").alias("item"), "text"), "item", longest, buckets)
    gain = gains(bucket_counts(kept, buckets), bucket_counts(wanted, buckets))
    scored = weights(kept, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    able = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    return ranked(scored, able, percent).select("doc_id", "n_features", "weight", "score", "rank")


#: The crc32 of every distinct word, from a table of 256 entries made by the polynomial's rule.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) GROUP BY ALL),
steps AS (SELECT list(v ORDER BY i) AS crcs FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM (SELECT unnest(range(256)) AS i))),
h AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
x AS (SELECT word, xor(list_reduce(list_transform(range(CAST(length(h) / 2 AS BIGINT)), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)),
    lambda c, o: xor(c >> 8, crcs[(xor(c, o) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM h, steps),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN x USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN x USING (word) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(s), 0) FROM s) + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(t), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
p AS (SELECT doc_id, sum(n * gain) AS weight FROM dw JOIN x USING (word) JOIN g USING (bucket) GROUP BY doc_id),
v AS (SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM d LEFT JOIN p USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM v WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM r) THEN rank END AS rank FROM v LEFT JOIN r USING (doc_id)
"""
