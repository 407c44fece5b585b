"""Neighbour search and top-k products against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import forest, topk, vectors
from fareloom.llm.forest import forest_index, index_candidates, nearest, nearest_by_index
from fareloom.llm.topk import largest_products

NAN, INF = float("nan"), float("inf")


def table(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(key, value, 1, 2.0, 3) for key, value in rows],
        f"vec_id bigint, embedding array<{kind}>, label int, score double, part int",
    )


def drawn(seed, n, dims=16, clusters=20):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((clusters, dims))
    return centres[draw.integers(clusters, size=n)] + 0.3 * draw.standard_normal((n, dims))


def products(ids, matrix, queries, k):
    scaled = [[int(np.floor(256 * x)) for x in row] for row in matrix]
    found = []
    for q in queries:
        own = scaled[ids.index(q)]
        scores = [(-sum(a * b for a, b in zip(own, s, strict=True)), i) for i, s in zip(ids, scaled, strict=True) if i != q]
        found += [(q, rank + 1, i, -score) for rank, (score, i) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def rows_of(frame):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in frame.collect())


ODD = [(1000, None), (1010, [NAN] * 16), (1020, [INF] + [1.0] * 15), (1030, [None] + [1.0] * 15), (None, [1.0] * 16)]


def test_products_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ROW_BLOCK", 32)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 17)
    matrix = drawn(1, 400) * np.random.default_rng(2).lognormal(0, 1, (400, 1))
    matrix[10] = 0
    matrix[20:40] = matrix[19]  # ties
    matrix = matrix.astype(np.float32).astype(float)
    ids = list(range(400))
    rows = list(zip(ids, matrix.tolist(), strict=True)) + ODD
    found = rows_of(largest_products(table(spark, rows + rows[:30]), F.col("vec_id") % 10 == 0))
    assert found == products(ids, matrix, range(0, 400, 10), 5)


def test_coordinates_prune_and_lose_nothing(spark, monkeypatch):
    calls = []
    kept = topk._in_region

    def counted(bucket, query, cosine):
        possible = kept(bucket, query, cosine)
        calls.append((len(possible), int(possible.sum())))
        reach = bucket @ query >= cosine
        assert (possible | ~reach).all()
        return possible

    monkeypatch.setattr(topk, "_in_region", counted)
    best = vectors.Best(1, 3, np.int64)
    matrix = np.floor(256 * drawn(3, 3000, clusters=40))
    query = matrix[:1]
    scores = (matrix @ query[0]).astype(np.int64)
    best.offer(0, np.sort(scores)[-4:-1], np.array([7, 8, 9]))
    cosine = float(best.least(0)) / (np.linalg.norm(query) * np.linalg.norm(matrix, axis=1).max())
    units = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    topk._in_region(units, query[0] / np.linalg.norm(query), cosine)
    topk._in_region(units, query[0] / np.linalg.norm(query), 0.9)
    assert calls[1][1] < 0.5 * calls[1][0]


def test_large_products_are_exact(spark):
    rows = [(0, [3e15, 1.0]), (1, [2e15, 7.0]), (2, [2e15, 8.0]), (3, [1e300, 0.0]), (4, [-1e300, 0.0]), (5, [1e-3, -1e-3])]
    found = rows_of(largest_products(table(spark, rows, "double"), F.col("vec_id") == 5, k=10))
    assert [f[2:] for f in found] == [(3, 0), (4, 0), (0, -256), (1, -7 * 256), (2, -8 * 256)]
    limits = np.iinfo(np.int64)
    top = rows_of(largest_products(table(spark, rows, "double"), F.col("vec_id") == 0, k=10))
    assert {f[2]: f[3] for f in top}[3] == limits.max and {f[2]: f[3] for f in top}[4] == limits.min
    assert [f[2] for f in top][:3] == [1, 2, 3]


def test_searches_of_little(spark):
    every = F.lit(True)
    for search in (nearest, largest_products):
        assert search(table(spark, []), every).collect() == []
        assert search(table(spark, ODD), every).collect() == []
        assert search(table(spark, [(1, [1.0, 2.0])]), every).collect() == []
        mixed = [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0]), (4, [2.0]), (5, []), (6, [])]
        found = {(r["query_id"], r["vec_id"]) for r in search(table(spark, mixed), every).collect()}
        alike = {(1, 2), (2, 1), (3, 4), (4, 3)}
        assert found == (alike if search is nearest else alike | {(5, 6), (6, 5)})


def test_neighbours_recall_and_distances(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ROW_BLOCK", 512)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 40)
    matrix = drawn(5, 3000, dims=32).astype(np.float32).astype(float)
    ids = list(range(3000))
    rows = list(zip(ids, matrix.tolist(), strict=True)) + [(5000, [0.0] * 32), *ODD]
    found = nearest(table(spark, rows), F.col("vec_id") % 100 == 0).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append(r)
    assert sorted(by_query) == list(range(0, 3000, 100))
    hits = 0
    for q, answers in by_query.items():
        apart = np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
        apart[q] = np.inf
        assert [a["rank"] for a in answers] == list(range(1, 11))
        scores = [a["score"] for a in answers]
        assert scores == sorted(scores) and np.allclose(scores, apart[[a["vec_id"] for a in answers]], rtol=1e-14)
        hits += len({a["vec_id"] for a in answers} & set(np.argsort(apart, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 10 * len(by_query)


def test_neighbour_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(50)]
    found = rows_of(nearest(table(spark, rows), F.col("vec_id") == 20, k=5, share=1.0))
    assert found == [(20, i + 1, i, 0.0) for i in range(5)]


def recall(matrix, found):
    hits, queries = 0, sorted({r["query_id"] for r in found})
    for q in queries:
        apart = np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
        apart[q] = np.inf
        own = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        scores = [r["score"] for r in own]
        assert scores == sorted(scores) and np.allclose(scores, apart[[r["vec_id"] for r in own]], rtol=1e-12)
        hits += len({r["vec_id"] for r in own} & set(np.argsort(apart, kind="stable")[:10].tolist()))
    return hits / (10 * len(queries))


def test_whole_index_finds_neighbours_among_few_candidates(spark, monkeypatch):
    """Vectors in families: nine in ten neighbours among two in a hundred rows."""
    monkeypatch.setattr(forest, "INDEX_BLOCK", 700)
    draw = np.random.default_rng(6)
    matrix = drawn(6, 12_000, dims=32, clusters=900).astype(np.float32).astype(float)
    rows = list(zip(range(12_000), matrix.tolist(), strict=True)) + [(50_000, [0.0] * 32), *ODD]
    given = table(spark, [rows[i] for i in draw.permutation(len(rows))])
    found = nearest_by_index(given, F.col("vec_id") % 100 == 0, most=240).collect()
    assert len(found) == 1200 and recall(matrix, found) >= 0.9
    kept = vectors.whole_vectors(given, "vec_id", "embedding").where("vec_id < 12000")
    candidates = index_candidates(forest_index(kept), F.col("vec_id") % 100 == 0, 64, 240)
    counts = [r["count"] for r in candidates.groupBy("query_id").count().collect()]
    assert len(counts) == 120 and max(counts) <= 240 == 0.02 * 12_000


def test_whole_index_of_little_and_of_equal_vectors(spark, monkeypatch):
    every = F.lit(True)
    assert nearest_by_index(table(spark, []), every).collect() == []
    assert nearest_by_index(table(spark, ODD), every).collect() == []
    mixed = [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0]), (4, [2.0])]
    found = {(r["query_id"], r["vec_id"]) for r in nearest_by_index(table(spark, mixed), every).collect()}
    assert found == {(1, 2), (2, 1), (3, 4), (4, 3)}
    monkeypatch.setattr(forest, "INDEX_BLOCK", 16)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)]
    found = rows_of(nearest_by_index(table(spark, rows), F.col("vec_id") % 50 == 0, k=5, width=20))
    assert len(found) == 30 and all(f[3] == 0.0 and f[0] != f[2] for f in found)
    with pytest.raises(ValueError, match="at least"):
        nearest_by_index(table(spark, rows), every, k=100)
