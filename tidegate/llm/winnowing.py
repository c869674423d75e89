"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters. A window is
``SPAN`` consecutive words of a benchmark item; an item with fewer words is one window of its
own length. Texts are fingerprinted by winnowing: of every ``WINDOW`` consecutive hashes of
``GRAM``-word shingles the smallest is kept, so two texts that share ``GRAM + WINDOW - 1 = SPAN``
words share a fingerprint. Documents and items meet on fingerprints; in documents with a hit
every window is then compared with the item windows of the same fingerprint word by word, and
runs of equal windows extend to the whole shared passage.

A null or empty text has no words and no hit; a null ``item_id`` marks words but is not listed.
Equal rows get equal results, each its own row. Columns other than ids and texts are ignored;
an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import BROADCAST_BYTES, free_name, sent_if_small, written

SPAN, GRAM = 10, 6
WINDOW = SPAN - GRAM + 1
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str):
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lowered, _GAP), "")


def _hashed(df: DataFrame) -> DataFrame:
    """``df`` with the hash of every word and of every shingle of ``words``."""
    hashed = df.withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
    return hashed.withColumn("grams", F.expr(
        f"IF(size(hashes) < {SPAN}, CAST(array() AS array<bigint>), "
        f"transform(sequence(1, size(hashes) - {GRAM - 1}), i -> xxhash64(slice(hashes, i, {GRAM}))))"))


def _whole(length: int) -> str:
    """Hashes of all windows of one short length."""
    return (f"IF(size(hashes) < {length}, CAST(array() AS array<bigint>), transform(sequence(1, size(hashes) - {length - 1}), "
            f"i -> xxhash64({length}, slice(hashes, i, {length}))))")


def _minima() -> str:
    """The smallest shingle hash of every window of ``SPAN`` words, in order."""
    return (f"IF(size(grams) < {WINDOW}, CAST(array() AS array<bigint>), transform(sequence(1, size(grams) - {WINDOW - 1}), "
            f"i -> array_min(slice(grams, i, {WINDOW}))))")


def _windows(hashed: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """Every window as (first word, number of words, fingerprint, words)."""
    cut = [f"transform({_minima()}, (p, i) -> struct(i + 1 AS at, {SPAN} AS size, p AS print, "
           f"array_join(slice(words, i + 1, {SPAN}), ' ') AS said))"]
    cut += [f"transform({_whole(n)}, (p, i) -> struct(i + 1 AS at, {n} AS size, p AS print, "
            f"array_join(slice(words, i + 1, {n}), ' ') AS said))" for n in lengths]
    return hashed.select(*keep, F.inline(F.expr(f"concat({', '.join(cut)})")))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of all items: item_id, size, print, said; an item of fewer words is one window."""
    items = benchmark.select("item_id", _words("text").alias("words")).where(F.size("words") > 0)
    long = _windows(_hashed(items.where(F.size("words") >= SPAN)), [], "item_id")
    short = items.where(F.size("words") < SPAN).withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
    short = short.select("item_id", F.lit(1).alias("at"), F.size("words").alias("size"),
                         F.expr("xxhash64(size(hashes), hashes)").alias("print"), F.array_join("words", " ").alias("said"))
    return long.unionByName(short).select("item_id", "size", "print", "said").distinct()


def _sent(windows: DataFrame) -> DataFrame:
    """Written windows, marked for broadcast where their measured text is small; adaptive execution splits hot windows beyond."""
    size = windows.agg(F.sum(F.octet_length("said") + F.lit(64)).alias("n")).first()["n"] or 0
    return F.broadcast(windows) if size <= BROADCAST_BYTES else windows


def _survey(keyed: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Per document: doc_id, row_key, n_words, n_rows (equal rows of one task) and whether an item shares a fingerprint.

    The only pass that splits every text. A document's first line is not a fingerprint but its own
    key, so documents without a window are there too and no key is shared by all of them.
    """
    known = written(windows.select("print").distinct(), "item-prints")
    hashed = _hashed(keyed.select("doc_id", "row_key", F.spark_partition_id().alias("part"), _words("text").alias("words")))
    cut = ", ".join([_minima(), *map(_whole, lengths)])
    prints = hashed.select("doc_id", "row_key", "part", F.size("words").cast("bigint").alias("n_words"),
                           F.posexplode(F.expr(f"concat(array(xxhash64(row_key, part)), array_distinct(concat({cut})))")).alias("place", "print"))
    met = prints.join(sent_if_small(known).withColumn("met", F.lit(True)), "print", "left")
    return met.groupBy("doc_id", "row_key", "part", "n_words").agg(
        F.count_if(F.col("place") == 0).alias("n_rows"), F.coalesce(F.bool_or("met"), F.lit(False)).alias("suspect")).drop("part")


def _same(left: str, right: str):
    return F.col(f"{left}.row_key").eqNullSafe(F.col(f"{right}.row_key")) & F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))


def window_hits(documents: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The survey of all documents, the item windows, and the places of item windows in documents; equal rows share theirs.

    All three are written to the shared folder, so their size is known when a join is planned.
    Texts are read twice: every one for the survey, those under suspicion again for their windows.
    """
    windows = written(item_windows(benchmark), "item-windows")
    lengths = sorted(r["size"] for r in windows.where(F.col("size") < SPAN).select("size").distinct().collect())
    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row_key"))
    survey = written(_survey(keyed, windows, lengths), "survey")
    suspects = written(survey.where("suspect").select("doc_id", "row_key").distinct(), "suspects")
    texts = keyed.alias("d").join(sent_if_small(suspects, 16).alias("s"), _same("d", "s"), "left_semi").distinct()
    cut = _windows(_hashed(texts.select("doc_id", "row_key", _words("text").alias("words"))), lengths, "doc_id", "row_key")
    plain = written(windows.select("print", "said", "size").distinct(), "plain-windows")
    return survey, windows, written(cut.join(_sent(plain), ["print", "said", "size"], "left_semi"), "window-hits")


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words, hit words and items of every document."""
    survey, windows, hits = window_hits(documents, benchmark)
    covered = hits.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("at", "size")).alias("spans")).select(
        "doc_id", "row_key", F.expr(
            "CAST(size(array_distinct(flatten(transform(spans, s -> sequence(s.at, s.at + s.size - 1))))) AS BIGINT)").alias("n_hit"))
    named = hits.select("doc_id", "row_key", "print", "said").distinct().join(
        _sent(windows).select("item_id", "print", "said"), ["print", "said"]).where("item_id IS NOT NULL")
    items = named.select("doc_id", "row_key", F.col("item_id").cast("string").alias("item_id")).distinct().groupBy(
        "doc_id", "row_key").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    found = survey.alias("d").join(covered.alias("h"), _same("d", "h"), "left").join(items.alias("s"), _same("d", "s"), "left")
    listed = F.coalesce("items", F.expr("CAST(array() AS array<string>)"))
    one = found.select("d.doc_id", "n_words", "n_hit", listed.alias("items"), F.explode(F.expr("array_repeat(0, CAST(n_rows AS INT))")))
    return one.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that share no window with the benchmark."""
    key = free_name(documents, "row_key")
    keyed = documents.withColumn(key, F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text"))).alias("d")
    hits = window_hits(documents, benchmark)[2].select(F.col("doc_id").alias("hit_id"), F.col("row_key").alias("hit_key")).distinct()
    few = sent_if_small(written(hits, "contaminated"), 16).alias("h")
    same = F.col(f"d.{key}").eqNullSafe(F.col("h.hit_key")) & F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("h.hit_id"))
    return keyed.join(few, same, "left_anti").select(*documents.columns)


_SQL_WORDS = (r"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS.format(text='text')} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS.format(text='text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least({SPAN}, len(w)) AS n, array_to_string(w[i:i + least({SPAN}, len(w)) - 1], ' ') AS said
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - {SPAN - 1}))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS said
       FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, said)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
