"""The quality classifier by held-out accuracy, against one machine's arithmetic, and on odd tables."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import TEXTS, prose, texts

from fareloom.llm import quality
from fareloom.llm.quality import document_statistics, fit, keep_good, score_quality, statistics
from fareloom.llm.registry import held_out_ids, op1_quality_classifier

EVERY = "true"


def labels(spark, rows):
    return spark.createDataFrame([(k, q, 5.0) for k, q in rows], "doc_id bigint, quality int, score double")


def good_and_bad(n):
    rows = [(i, prose(i, 80) + ".") for i in range(n)]
    return rows + [(n + i, " | ".join(prose(i, 80).upper().split()) + "!!") for i in range(n)]


def test_separates_kinds_of_text(spark):
    rows = good_and_bad(150)
    known = labels(spark, [(k, int(k < 150)) for k, _ in rows] + [(0, None), (0, 1), (9999, 0), (None, 0)])
    scored = score_quality(texts(spark, rows), known, held_out_ids(F.col("doc_id")) == False).collect()  # noqa: E712
    assert len(scored) == 300
    assert all((r["score"] >= 0.7) == (r["doc_id"] < 150) for r in scored)
    kept = keep_good(texts(spark, rows), known, EVERY)
    assert kept.columns == texts(spark, []).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(150))


def test_odd_texts_are_scored(spark):
    scored = score_quality(texts(spark), labels(spark, [(4, 1), (5, 0)]), EVERY).collect()
    assert len(scored) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if r["doc_id"] in (1, 2, 3)}) == 1
    assert len(set(map(len, map(statistics, (t for _, t in TEXTS))))) == 1
    assert all(np.isfinite(statistics(t)).all() for _, t in TEXTS)


def test_no_label_and_no_text(spark):
    assert {r["score"] for r in score_quality(texts(spark), labels(spark, []), EVERY).collect()} == {0.5}
    assert score_quality(texts(spark, []), labels(spark, [(1, 1)]), EVERY).collect() == []
    assert keep_good(texts(spark), labels(spark, []), EVERY).count() == len(TEXTS)
    assert keep_good(texts(spark, []), labels(spark, [(1, 1)]), EVERY).collect() == []


def test_equations_summed_by_partition_equal_those_of_all_rows(spark):
    rows = good_and_bad(60)
    stats = document_statistics(texts(spark, rows)).repartition(7)
    labelled = stats.withColumn("label", (F.col("doc_id") < 60).cast("double"))
    found = fit(labelled, ridge=1e-2)
    all_stats = np.array([statistics(t) for _, t in rows])
    y = np.array([float(k < 60) for k, _ in rows])
    z = found.features(all_stats)
    penalty = 1e-2 * len(y) * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-9
    expected = np.linalg.solve(z.T @ z + penalty, z.T @ y)
    assert np.allclose(z @ found.weights, z @ expected, atol=1e-6)


def test_random_features_approach_the_gaussian_kernel(spark):
    stats = document_statistics(texts(spark, good_and_bad(40))).withColumn("label", F.lit(1.0))
    found = fit(stats, bandwidth=0.02)
    points = np.array([statistics(t) for _, t in good_and_bad(40)])
    z = found.features(points)[:, :-1]
    scaled = np.clip((points - found.middle) / found.width, -8, 8)
    apart = ((scaled[:, None] - scaled[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-0.02 * apart)).mean() < 0.06


def test_isotonic_against_a_plain_search():
    scores, chances = quality._isotonic(
        np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 2.0, 0.0, 3.0]), np.array([1, 2, 2, 3])
    )
    assert scores == pytest.approx([0.1, 0.25, 0.4]) and chances == pytest.approx([0, 0.5, 1])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op1_quality_classifier(spark, folder).collect() if r["held_out"] and r["doc_id"] in known]
    right = sum(r["predicted"] == known[r["doc_id"]] for r in rows)
    assert len(rows) > 500 and right >= 0.97 * len(rows)


def test_query_equals_a_plain_fit_of_all_rows(spark):
    """Features, folds, ridge and calibration again, over plain arrays of the whole test table."""
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    known = {r["doc_id"]: float(r["quality"]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    learnt = sorted(k for k in known if k in docs and zlib.crc32(str(k).encode()) % 4 != 2)
    points = np.array([statistics(docs[k]) for k in learnt])
    y = np.array([known[k] for k in learnt])
    table = spark.createDataFrame(list(zip(learnt, points.tolist(), strict=True)), "doc_id bigint, stats array<double>")
    folds = {r[0]: r[1] for r in table.select("doc_id", F.expr("pmod(xxhash64(doc_id, stats), 4)")).collect()}
    fold = np.array([folds[k] for k in learnt])

    draw = np.random.default_rng(3)
    middle, width = points.mean(axis=0), points.std(axis=0)
    width = np.where(width > 1e-9, width, 1.0)
    directions = draw.standard_normal((20, quality.FEATURES)) * np.sqrt(2 * 0.01)
    phases = draw.uniform(0, 2 * np.pi, quality.FEATURES)

    def waves(stats):
        scaled = np.clip((stats - middle) / width, -8, 8)
        z = np.cos(scaled @ directions + phases) * np.sqrt(2 / quality.FEATURES)
        return np.hstack([z, np.ones((len(stats), 1))])

    def ridge(z, y):
        penalty = 1e-5 * max(len(y), 1) * np.eye(z.shape[1])
        penalty[-1, -1] = 1e-9
        return np.linalg.solve(z.T @ z + penalty, z.T @ y)

    z = waves(points)
    raw = np.zeros(len(y))
    for f in range(quality.FOLDS):
        raw[fold == f] = z[fold == f] @ ridge(z[fold != f], y[fold != f])
    # isotonic regression by its max-min formula over the bins of equal scores
    bins = (np.clip((raw + 1) / 3, 0, 1) * (quality.BINS - 1)).astype(int)
    places = np.unique(bins)
    n = np.array([(bins == p).sum() for p in places])
    ones = np.array([y[bins == p].sum() for p in places])
    middles = np.array([raw[bins == p].mean() for p in places])
    before = np.concatenate(([0], np.cumsum(n)))
    good = np.concatenate(([0], np.cumsum(ones)))
    share = lambda a, b: (good[b] - good[a]) / (before[b] - before[a])
    size = len(places)
    fitted = np.array([
        max(min(share(a, b) for b in range(i + 1, size + 1)) for a in range(i + 1)) for i in range(size)
    ])
    levels = np.unique(fitted)
    at = np.array([np.average(middles[fitted == c], weights=n[fitted == c]) for c in levels])

    keys = list(docs)
    scores = waves(np.array([statistics(docs[k]) for k in keys])) @ ridge(z, y)
    expected = dict(zip(keys, np.interp(scores, at, levels), strict=True))
    found = {r["doc_id"]: r["score"] for r in op1_quality_classifier(spark, folder).collect()}
    assert found.keys() == expected.keys()
    off = np.array([abs(found[k] - expected[k]) for k in keys])
    assert np.quantile(off, 0.99) < 1e-6 and off.max() < 0.05
