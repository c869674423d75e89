"""The pipeline stages against plain forms of what each is to keep."""

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidegate.llm import pii

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows that go into and come out of each stage."""
    folder = tmp_path_factory.mktemp("steps")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        made.append((name, docs))
    return dict(made)


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(steps):
    names = list(steps)
    assert names == ["documents", "quality_classifier", "near_duplicates", "benchmark_decontamination", "personal_data", "best_fit_packing"]
    assert all(steps[n].columns == steps["documents"].columns for n in names[:-1])


def test_quality(spark, steps):
    labels = dict((r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect())
    kept, given = rows(steps["quality_classifier"]), rows(steps["documents"])
    good, bad = [i for i in given if labels.get(i) == 1], [i for i in given if labels.get(i) == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_near_duplicates(steps):
    given = rows(steps["quality_classifier"])
    assert sorted(rows(steps["near_duplicates"])) == [i for i, _, _, kept in sorted(brute.near_duplicates(list(given.items()))) if kept]


def test_decontamination(spark, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    given = rows(steps["near_duplicates"])
    assert set(rows(steps["benchmark_decontamination"])) == {i for i, t in given.items() if not brute.contamination(t, items)[-1]}


def test_personal_data(steps):
    given, made = rows(steps["benchmark_decontamination"]), rows(steps["personal_data"])
    assert set(given) == set(made)
    for i, text in given.items():
        assert made[i] == pii.redact(text, pii.text_spans(text))
        assert not brute.base_spans(made[i])
    assert all(r["n_chars"] == len(r["text"]) for r in steps["personal_data"].collect())


def test_packing(steps):
    given, packed = rows(steps["personal_data"]), steps["best_fit_packing"].collect()
    assert {r["doc_id"] for r in packed} == set(given)
    total = {}
    for r in packed:
        total[r["sequence_id"]] = total.get(r["sequence_id"], 0) + r["length"]
    assert max(total.values()) <= 1024


def test_run_equals_the_stages(spark, steps):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, SMALL).select(key).collect()) == sorted(steps["best_fit_packing"].select(key).collect())
    assert "pipeline" in entry.queries() and sum(n.startswith("op") and n[2].isdigit() for n in entry.queries()) == 10


def test_stages_take_empty_tables_and_odd_rows(spark, tmp_path):
    for docs in (brute.documents(spark, brute.odd_rows()), brute.documents(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SMALL)
            assert made.columns == docs.columns or name == "best_fit_packing"
            assert made.count() >= 0
