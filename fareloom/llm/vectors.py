"""Searches of stated queries against all vectors: the same deal of rows for every method."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import written

#: Queries that a task holds at once, and candidate rows that it looks at together.
QUERY_BLOCK = 16_384
ROW_BLOCK = 4_096



class Best:
    """The best ``k`` of each query so far: highest score first, ties to the smaller id."""

    def __init__(self, queries: int, k: int, kind: type):
        self.k, self.kind = k, kind
        self.found: list[tuple[np.ndarray, np.ndarray]] = [
            (np.empty(0, dtype=kind), np.empty(0, dtype=np.int64)) for _ in range(queries)
        ]

    def least(self, query: int) -> float | int | None:
        """The score that a candidate must reach, if there are ``k`` already."""
        scores = self.found[query][0]
        return scores[-1] if len(scores) == self.k else None

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        old = self.found[query]
        scores = np.concatenate((old[0], scores.astype(self.kind)))
        ids = np.concatenate((old[1], ids))
        # descending without negating: the smallest integer has no opposite
        order = np.lexsort((-ids, scores))[::-1][: self.k]
        self.found[query] = (scores[order], ids[order])


def whole_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part, one per id.

    Null ids, null vectors and vectors that hold null, NaN or an infinity take no part. Of rows that
    share an id the one with the smallest vector counts. Other columns are left out.
    """
    values = F.col(f"`{vector}`").cast("array<double>")
    inf = float("inf")
    whole = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))
    rows = table.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), values.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & whole)
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def search(
    vectors: DataFrame, is_query: Column, k: int, start: Callable, order: Column, score: str
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's best ``k`` among all other rows.

    ``vectors`` are ``(vec_id, vector)``. Candidates are dealt by id into as many parts as there are
    shuffle partitions, once for each block of ``QUERY_BLOCK`` queries; the queries of a block go to
    every part, before its rows. A task holds one block of queries and ``ROW_BLOCK`` candidates, so
    its memory does not grow with the table, and sends on ``k`` rows a query.
    ``start(queries, query_ids, best)`` returns a function that is given block after block of
    candidates in ``order`` and offers what it finds to ``best``. Vectors meet those of their own
    length only.
    """
    spark = vectors.sparkSession
    rows = written(vectors.withColumn("dims", F.size("vector")), "vectors")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = rows.where(is_query)
    blocks = -(-queries.count() // QUERY_BLOCK) or 1
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    asked = queries.select(
        block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(True).alias("asks"), "vec_id", "dims", "vector",
    )
    looked = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part.alias("part"),
        F.lit(False).alias("asks"), "vec_id", "dims", "vector",
    )
    dealt = (
        asked.unionByName(looked).repartition("dims", "block", "part")
        .sortWithinPartitions("dims", "block", "part", F.desc("asks"), order, "vec_id")
    )
    kind = np.int64 if score == "bigint" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"deal": None}
        for deal, asks, ids, matrix in _deals(batches):
            if deal != state["deal"]:
                yield from _answers(state)
                state = {"deal": deal, "ids": ids[:0], "matrix": matrix[:0], "take": None}
            if asks:
                state["ids"] = np.concatenate((state["ids"], ids))
                state["matrix"] = np.concatenate((state["matrix"], matrix))
                continue
            if not len(state["ids"]):
                continue
            if state["take"] is None:
                state["best"] = Best(len(state["ids"]), k, kind)
                state["take"] = start(state["matrix"], state["ids"], state["best"])
            for i in range(0, len(ids), ROW_BLOCK):
                state["take"](matrix[i : i + ROW_BLOCK], ids[i : i + ROW_BLOCK])
        yield from _answers(state)

    found = dealt.mapInArrow(run, f"query_id bigint, vec_id bigint, score {score}")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _deals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Batches cut where the length, block, part or side changes; candidates joined to row blocks."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = [batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 0, 1, 2, 3)]
        keys = np.stack([c.astype(np.int64) for c in cells[:4]], axis=1)
        ends = [*np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            key = tuple(keys[a].tolist())
            if key != last or sum(len(h[0]) for h in held) >= ROW_BLOCK:
                if held:
                    yield last[:3], last[3], *(np.concatenate(x) for x in zip(*held, strict=True))
                held, last = [], key
            values = batch.column("vector").slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
            held.append((cells[4][a:b].astype(np.int64), values.reshape(b - a, key[0])))
    if held:
        yield last[:3], last[3], *(np.concatenate(x) for x in zip(*held, strict=True))


def _answers(state: dict) -> Iterator[pa.RecordBatch]:
    if state.get("take") is None:
        return
    found = state["best"].found
    sizes = [len(ids) for _, ids in found]
    if sum(sizes):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(state["ids"], sizes)),
                pa.array(np.concatenate([ids for _, ids in found])),
                pa.array(np.concatenate([scores for scores, _ in found])),
            ],
            names=["query_id", "vec_id", "score"],
        )
