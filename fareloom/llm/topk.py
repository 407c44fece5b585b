"""Exact top-k by inner product over vectors grouped by length."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.vectors import Best, search, whole_vectors

#: Local cosine threshold from which a bucket is pruned by coordinates.
COORDINATES_FROM = 0.8
FOCUS = 5
#: Products that are exact in double precision.
EXACT = 2.0**53


def _in_region(bucket: np.ndarray, query: np.ndarray, cosine: float) -> np.ndarray:
    """Which unit vectors may reach the cosine: by the feasible interval of some coordinates each."""
    possible = np.ones(len(bucket), dtype=bool)
    across = np.sqrt(max(0.0, 1 - cosine**2))
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        width = across * np.sqrt(max(0.0, 1 - query[f] ** 2))
        low = query[f] * cosine - width if query[f] > -cosine else -1.0
        high = query[f] * cosine + width if query[f] < cosine else 1.0
        possible &= (bucket[:, f] >= low - 1e-9) & (bucket[:, f] <= high + 1e-9)
    return possible


def largest_products(
    table: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products of ``floor(scale * x)``.

    A part's rows come longest first, so each block is a bucket of like lengths. What a query has
    found gives it a local cosine threshold per bucket: over 1, the bucket and all after it are
    skipped; from ``COORDINATES_FROM`` on, only rows inside the feasible intervals of its largest
    coordinates are multiplied; below that, only rows long enough. Products are exact: in double
    precision while they cannot pass 2 ** 53, in whole numbers beyond; scores outside 64 bits are
    the nearest 64-bit number. Rows that :func:`whole_vectors` leaves out take no part.
    """
    rows = whole_vectors(table, key, vector)
    rows = rows.withColumn("vector", F.transform("vector", lambda x: _floor(x * scale)))
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)

    def start(queries: np.ndarray, query_ids: np.ndarray, best: Best):
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        units = queries / np.where(lengths > 0, lengths, 1)[:, None]

        def take(matrix: np.ndarray, ids: np.ndarray) -> None:
            sizes = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
            order = np.argsort(-sizes, kind="stable")
            matrix, ids, sizes = matrix[order], ids[order], sizes[order]
            exact = sizes[0] * lengths.max() < EXACT
            bucket = matrix / np.where(sizes > 0, sizes, 1)[:, None]
            whole: list[int] = []
            for q in range(len(queries)):
                least = best.least(q)
                if not exact or least is None or least <= 0 or not lengths[q]:
                    whole.append(q)
                    continue
                cosine = float(least) * (1 - 1e-9) / (lengths[q] * sizes[0])
                if cosine > 1:
                    continue
                long_enough = int(np.searchsorted(-sizes, -float(least) * (1 - 1e-9) / lengths[q], "right"))
                if cosine < COORDINATES_FROM and long_enough == len(ids):
                    whole.append(q)
                    continue
                near = np.arange(long_enough)
                if cosine >= COORDINATES_FROM:
                    near = near[_in_region(bucket[:long_enough], units[q], cosine)]
                scores = _products(queries[q : q + 1], matrix[near], exact)[0]
                _offer(best, q, scores, ids[near], query_ids[q])
            for i in range(0, len(whole), 256):
                some = whole[i : i + 256]
                for q, scores in zip(some, _products(queries[some], matrix, exact), strict=True):
                    _offer(best, q, scores, ids, query_ids[q])

        return take

    return search(rows, is_query, k, start, F.desc(length), "bigint")


def _floor(x: Column) -> Column:
    """The floor as a double. Large doubles are whole already; those past the largest become it."""
    most = float(np.finfo(np.float64).max)
    within = F.greatest(F.least(x, F.lit(most)), F.lit(-most))
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(within)


def _products(queries: np.ndarray, matrix: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (queries @ matrix.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    if not matrix.size or not queries.size:
        return np.zeros((len(queries), len(matrix)), dtype=np.int64)
    products = whole(queries) @ whole(matrix).T
    limits = np.iinfo(np.int64)
    return np.minimum(np.maximum(products, limits.min), limits.max).astype(np.int64)


def _offer(best: Best, q: int, scores: np.ndarray, ids: np.ndarray, own: int) -> None:
    least = best.least(q)
    good = ids != own
    if least is not None:
        good &= scores >= least
    scores, ids = scores[good], ids[good]
    if len(scores) > best.k:
        edge = np.partition(scores, len(scores) - best.k)[len(scores) - best.k]
        scores, ids = scores[scores >= edge], ids[scores >= edge]
    if len(scores):
        best.offer(q, scores, ids)
