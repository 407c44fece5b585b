"""The pipeline's stages against plain versions, and on odd documents."""

import brute
import pytest
from pyspark.sql import functions as F
from samples import TEXTS, prose

import corpus_pipeline
from fareloom.session import written

FOLDER = "/root/testdata/sf0.01"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before and after each stage, as the pipeline writes them."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], FOLDER), name.replace(" ", "-")))
    return found


def _texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "substring dedup", "best-fit packing",
    ]
    assert all(s.schema == stages[0].schema for s in stages[1:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage_keeps_clean_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = _texts(stages[1])
    good = [k for k, q in labels.items() if q == 1]
    bad = [k for k, q in labels.items() if q == 0]
    assert sum(k in kept for k in good) >= 0.98 * len(good)
    assert sum(k in kept for k in bad) <= 0.05 * len(bad)


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    before, after = _texts(stages[1]), _texts(stages[2])
    groups = brute.components({key: brute.fingerprint(text) for key, text in before.items()})
    assert after == {key: before[key] for key in set(groups.values())}
    assert len(after) < len(before)


def test_substring_stage_equals_sets(stages):
    before, after = _texts(stages[2]), _texts(stages[3])
    expected = brute.repeats(list(before.items()), corpus_pipeline.WINDOW)
    assert after == {k: expected[k][2] if expected[k][1] else before[k] for k in before}
    assert sum(e[1] > 0 for e in expected.values()) > 10


def test_packing_stage_places_every_piece(stages):
    pieces = stages[4].collect()
    assert {p["doc_id"] for p in pieces} == set(_texts(stages[3]))
    filled = {}
    for p in pieces:
        filled[p["sequence_id"]] = filled.get(p["sequence_id"], 0) + p["length"]
    assert max(filled.values()) <= 2048
    assert len(filled) <= 1.01 * sum(filled.values()) / 2048 + 1


@pytest.mark.parametrize("rows", [[], TEXTS, [*TEXTS, *TEXTS], [(1, prose(1, 300)), (2, prose(1, 300))]])
def test_odd_documents_pass_every_stage(spark, rows):
    docs = spark.createDataFrame([(k, t, None, "s", 1, 0.5, "r") for k, t in rows], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, written(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert name == "best-fit packing" or docs.columns == columns
    lengths = {r["sequence_id"]: r["n"] for r in docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert all(0 < n <= 2048 for n in lengths.values())
    ids = {k for k, _ in rows}
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} <= ids


def test_run_is_the_stages_in_order(spark, stages):
    whole = corpus_pipeline.run(spark, FOLDER)
    kept = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(whole.select(*kept).collect()) == sorted(stages[4].select(*kept).collect())
