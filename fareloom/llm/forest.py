"""Approximate nearest neighbours by a forest of hash prefixes.

Two ways to keep the sorted arrays: one forest over the whole table, written once, where a query looks
at its neighbours in order only (:func:`nearest_by_index`), for vectors with structure; and forests of
blocks, of which a query looks at a stated share (:func:`nearest`), for vectors without, whose
neighbours share few hash bits with a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.places import in_order
from fareloom.llm.vectors import Best, search, whole_vectors
from fareloom.session import written

BITS = 32
#: Rows, about, that the medians of the whole forest are taken from.
FIT_ROWS = 1 << 14
#: Neighbours in the order of a tree that one task holds, and searches that it answers at once.
INDEX_BLOCK, SEARCHES_AT_ONCE = 1 << 13, 1 << 10


class Forest:
    """Sorted arrays of ``BITS``-bit hash strings, one per tree, over a block of vectors.

    A bit tells on which side of a random hyperplane a vector lies; each plane passes through the
    block's median in its direction, so that a bit halves the block.
    """

    def __init__(self, matrix: np.ndarray, trees: int, seed: int):
        self.trees, dims = trees, matrix.shape[1]
        self.planes = np.random.default_rng(seed).standard_normal((dims, trees * BITS))
        sides = matrix @ self.planes
        self.middle = np.median(sides, axis=0)
        strings = self._strings(sides)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def _strings(self, sides: np.ndarray) -> np.ndarray:
        bits = (sides > self.middle).reshape(len(sides), self.trees, BITS)
        return np.packbits(bits, axis=2).view(">u4")[:, :, 0].astype(np.int64)

    def ranges(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each prefix length, from 0 on, where each query's matches begin and end in each tree."""
        strings = self._strings(queries @ self.planes)
        found = []
        for length in range(BITS + 1):
            low = strings >> (BITS - length) << (BITS - length)
            high = low + (1 << (BITS - length))
            found.append(tuple(
                np.stack(
                    [np.searchsorted(self.sorted[:, t], edge[:, t]) for t in range(self.trees)], axis=1
                )
                for edge in (low, high)
            ))
            if (found[-1][0] == found[-1][1]).all():
                break
        return found

    def candidates(self, ranges: list, query: int, least: int) -> np.ndarray:
        """Rows under the longest common prefixes, shortened in all trees at once up to ``least``."""
        n = len(self.order)
        marked = np.zeros(n, dtype=bool)
        for low, high in reversed(ranges):
            if (high[query] - low[query]).sum() < min(least, n):
                continue
            for t in range(self.trees):
                marked[self.order[low[query, t] : high[query, t], t]] = True
            if np.count_nonzero(marked) >= min(least, n):
                break
        return np.flatnonzero(marked)


def nearest(
    table: DataFrame, is_query: Column, k: int = 10, trees: int = 16, share: float = 0.6,
    key: str = "vec_id", vector: str = "embedding", seed: int = 7,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found, by Euclidean distance.

    ``is_query`` is a condition on ``vec_id``. In each block of rows a query descends every tree to
    its longest matches and ascends until ``share`` of the block and ``k`` more are candidates; their
    distances are taken in double precision on the vectors as given. Every row is indexed. Vectors
    of zeros take no part, nor do those that :func:`whole_vectors` leaves out; fewer candidates than
    ``k`` are all returned. ``share`` trades time for recall: neighbours at random distances, which
    share few hash bits with a query, need a large one.
    """
    rows = whole_vectors(table, key, vector).where(F.exists("vector", lambda x: x != 0))

    def start(queries: np.ndarray, query_ids: np.ndarray, best: Best):
        squares = np.einsum("ij,ij->i", queries, queries)

        def take(matrix: np.ndarray, ids: np.ndarray) -> None:
            forest = Forest(matrix, trees, seed)
            ranges = forest.ranges(queries)
            sizes = np.einsum("ij,ij->i", matrix, matrix)
            slack = 1e-9 * (sizes.max() + squares)
            for q, own in enumerate(query_ids):
                rows = forest.candidates(ranges, q, int(share * len(ids)) + k)
                rows = rows[ids[rows] != own]
                if not len(rows):
                    continue
                about = sizes[rows] - 2 * (matrix[rows] @ queries[q]) + squares[q]
                if len(rows) > k:
                    close = about <= np.partition(about, k - 1)[k - 1] + slack[q]
                    rows = rows[close | ~np.isfinite(about)]
                apart = np.sqrt(((matrix[rows] - queries[q]) ** 2).sum(axis=1))
                best.offer(q, -apart, ids[rows])

        return take

    found = search(rows, is_query, k, start, F.xxhash64("vec_id", F.lit(2)), "double")
    return found.withColumn("score", -F.col("score"))


def _planes(dims: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, trees * BITS))


def _middles(rows: DataFrame, trees: int, seed: int) -> dict[int, np.ndarray]:
    """For each length in a sample of about ``FIT_ROWS`` rows, the medians that hyperplanes pass through."""
    share = min(1.0, FIT_ROWS / max(1, rows.count()))
    chosen = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    lengths: dict[int, list] = {}
    for row in rows.where(chosen).select("vector").toLocalIterator():
        lengths.setdefault(len(row["vector"]), []).append(row["vector"])
    return {
        dims: np.median(np.array(vectors) @ _planes(dims, trees, seed), axis=0)
        for dims, vectors in lengths.items() if dims
    }


def forest_index(rows: DataFrame, trees: int = 16, seed: int = 7) -> DataFrame:
    """``(dims, tree, string, vec_id, pos, block)`` of all ``rows(vec_id, vector)``, written.

    Each tree orders every vector by its ``BITS``-bit string: which side of a random hyperplane it lies
    on, bit by bit. The planes pass through the medians of a bounded sample, which decides how evenly
    a bit parts the rows and nothing else. Rows are dealt by ranges of (tree, string) and numbered;
    ``INDEX_BLOCK`` neighbours in order are a block, however many strings are equal.
    """
    middles = _middles(rows, trees, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.diff(lists.offsets.to_numpy())
            ids = batch.column("vec_id").to_numpy()
            for dims in np.unique(sizes):
                own = np.flatnonzero(sizes == dims)
                matrix = lists.take(pa.array(own)).flatten().to_numpy().reshape(len(own), dims)
                if dims not in planes:
                    planes[dims] = _planes(int(dims), trees, seed)
                sides = matrix @ planes[dims] > middles.get(int(dims), 0.0)
                packed = np.packbits(sides.reshape(len(own), trees, BITS), axis=2)
                strings = packed.view(">u4")[:, :, 0].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(strings.size, dims, np.int32)),
                        pa.array(np.tile(np.arange(trees, dtype=np.int32), len(own))),
                        pa.array(strings.ravel()), pa.array(np.repeat(ids[own], trees)),
                    ],
                    names=["dims", "tree", "string", "vec_id"],
                )

    entries = rows.mapInArrow(run, "dims int, tree int, string bigint, vec_id bigint")
    placed = in_order(entries, ["dims", "tree"], ["string", "vec_id"], "forest-order")
    block = F.floor((F.col("pos") - 1) / INDEX_BLOCK).cast("bigint")
    return written(placed.withColumn("block", block), "forest-index")


def _shared_bits(strings: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The length of the common prefix."""
    return BITS - np.frexp((strings ^ own).astype(np.float64))[1]


def index_candidates(index: DataFrame, is_query: Column, width: int, most: int) -> DataFrame:
    """``(query_id, vec_id)``: of each query's neighbours in all trees those with the longest prefixes.

    In order, the longest matches of a query are next to it, and shorter ones follow. ``width``
    neighbours on each side are what a tree can offer; ascending from the longest prefix in all trees
    at once, the first ``most`` different rows are taken, ties by id. Queries go to the blocks that hold
    these places, two at most for a tree, and no two rows meet otherwise.
    """
    places = lambda c: F.floor((F.greatest(c, F.lit(1)) - 1) / INDEX_BLOCK).cast("bigint")
    reach = F.sequence(places(F.col("pos") - width), places(F.col("pos") + width))
    asked = index.where(is_query).withColumn("block", F.explode(reach)).withColumn("asks", F.lit(True))
    both = index.withColumn("asks", F.lit(False)).unionByName(asked)
    dealt = both.repartition("dims", "tree", "block").sortWithinPartitions("dims", "tree", "block", "asks", "pos")

    def answer(held: list, asking: list) -> Iterator[pa.RecordBatch]:
        ids, strings, pos = (np.concatenate(c) for c in zip(*held, strict=True))
        queries = [np.concatenate(c) for c in zip(*asking, strict=True)]
        steps = np.concatenate((np.arange(-width, 0), np.arange(1, width + 1)))
        for part in range(0, len(queries[0]), SEARCHES_AT_ONCE):
            own, string, place = (q[part : part + SEARCHES_AT_ONCE] for q in queries)
            at = place[:, None] - pos[0] + steps
            query, step = np.nonzero((at >= 0) & (at < len(pos)))
            at = at[query, step]
            shared = _shared_bits(strings[at], string[query])
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[query]), pa.array(ids[at]), pa.array(shared.astype(np.int32))],
                names=["query_id", "vec_id", "shared"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, asking = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dims", "tree", "block")], axis=1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            columns = [batch.column(c).to_numpy() for c in ("vec_id", "string", "pos")]
            new = (keys[1:] != keys[:-1]).any(axis=1) | (asks[1:] != asks[:-1])
            ends = [*np.flatnonzero(new) + 1, len(keys)]
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                key = tuple(keys[a].tolist())
                if key != last:
                    if held and asking:
                        yield from answer(held, asking)
                    last, held, asking = key, [], []
                (asking if asks[a] else held).append([c[a:b] for c in columns])
        if held and asking:
            yield from answer(held, asking)

    found = dealt.mapInArrow(run, "query_id bigint, vec_id bigint, shared int")
    found = found.groupBy("query_id", "vec_id").agg(F.max("shared").alias("shared"))
    longest = Window.partitionBy("query_id").orderBy(F.desc("shared"), "vec_id")
    ranked = found.withColumn("place", F.row_number().over(longest)).where(F.col("place") <= most)
    return ranked.select("query_id", "vec_id")


def nearest_by_index(
    table: DataFrame, is_query: Column, k: int = 10, trees: int = 16, width: int = 64, most: int = 400,
    key: str = "vec_id", vector: str = "embedding", seed: int = 7,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` as :func:`nearest` gives them, from a whole sorted index.

    Work grows with the table and with ``most`` times the queries, not with their product: each query
    looks at ``most`` rows at most, however large the table. Recall follows from the vectors: neighbours
    must share long prefixes with a query. The same rows take part as there.
    """
    if width < k or most < k:
        raise ValueError("width and most must be k at least")
    rows = whole_vectors(table, key, vector).where(F.exists("vector", lambda x: x != 0))
    rows = written(rows, "vectors")
    index = forest_index(rows, trees, seed)
    pairs = written(index_candidates(index, is_query, width, most), "candidates")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    squares = F.zip_with("query", "vector", lambda a, b: (a - b) * (a - b))
    apart = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    scored = pairs.join(rows, "vec_id").join(asked, "query_id").select("query_id", "vec_id", apart.alias("score"))
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
