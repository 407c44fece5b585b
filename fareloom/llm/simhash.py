"""SimHash fingerprints and near-duplicate groups by an inverted index on byte positions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.batches import chunks, one_row_per
from fareloom.llm.components import components
from fareloom.session import written

BYTES = 8
SEED = 42
#: Prints of a list whose pairs are tallied one by one, and prints that stay in one list at most.
TALLIED, LONG_LIST = 256, 1 << 16


def shingles(text: str | None, size: int) -> list[bytes]:
    """Runs of ``size`` words, A-Z lower-cased; fewer words are one run, no words none."""
    tokens = text.encode("utf-8", "replace").lower().split() if text else []
    if len(tokens) <= size:
        return [b" ".join(tokens)] if tokens else []
    return list(map(b" ".join, zip(*(tokens[i:] for i in range(size)), strict=False)))


def fingerprint(features: list[bytes]) -> int:
    """A bit is set if over half the hashes have it; as a signed number."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in features], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(
            hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, BYTES),
            axis=1, bitorder="little",
        )
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """``(doc_id, row, fp)``: a bit of ``fp`` is set if it is in over half the hashes of the shingles.

    Words are lower-cased in A-Z only; a shingle is ``size`` words joined by a space, repeats count,
    and fewer words are one shingle. Null, empty and blank texts have the fingerprint zero. ``row``
    tells texts of one id apart. One row per row, repeated and null ids included; other columns are
    left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            prints = [fingerprint(shingles(t, size)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(prints, pa.int64())],
                names=["doc_id", "row", "fp"],
            )

    rows = one_row_per(docs, key, text).withColumn("row", F.xxhash64("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, fp bigint")


def keys(bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which prints ``bits`` bits apart agree in one at least.

    Differing bits lie in at most as many bytes, and these in as many of four pairs of neighbouring
    bytes, so the other pairs agree. Four differing pairs would leave no key, so three bits choose
    among single bytes.
    """
    pieces = [(0, 1), (2, 3), (4, 5), (6, 7)] if bits < 3 else [(i,) for i in range(BYTES)]
    return [sum(chosen, ()) for chosen in combinations(pieces, len(pieces) - bits)]


def least_shared(bits: int) -> int:
    """Bytes that prints ``bits`` bits apart share by position, at least."""
    return BYTES - bits


def _narrower(key: tuple[int, ...], bits: int) -> list[tuple[int, ...]]:
    """A key with further positions, as many as the least count: prints in reach agree in one such."""
    free = [i for i in range(BYTES) if i not in key]
    return [(*key, *more) for more in combinations(free, max(0, least_shared(bits) - len(key)))]


def _postings(fp: Column, chosen: list[tuple[int, tuple[int, ...]]]) -> Column:
    """``(choice, shared)``: the bytes of a print at the positions of each numbered key."""
    entries = []
    for number, key in chosen:
        mask = reduce(lambda m, p: m | 0xFF << (8 * p), key, 0)
        signed = mask - (1 << 64) if mask >> 63 else mask
        entries.append(F.struct(
            F.lit(number).cast("smallint").alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("shared")
        ))
    return F.array(*entries)


def postings(prints: DataFrame, bits: int) -> DataFrame:
    """``(choice, shared, fp)``: the inverted index of distinct prints by bytes at positions.

    A list holds the prints that agree at the positions of a key. One of more than ``LONG_LIST`` is
    split by further positions up to the least count, so that no list holds more than 256 ** bits.
    """
    chosen = keys(bits)
    listed = prints.select("fp", F.explode(_postings(F.col("fp"), list(enumerate(chosen)))).alias("entry"))
    listed = listed.select("entry.choice", "entry.shared", "fp")
    if len(chosen[0]) >= least_shared(bits):
        return listed
    sizes = listed.groupBy("choice", "shared").agg(F.count("*").alias("n"))
    long = written(sizes.where(F.col("n") > LONG_LIST).drop("n"), "long-lists")
    if long.isEmpty():
        return listed
    first, numbers, narrower = len(chosen), F.lit(None), []
    for number, key in enumerate(chosen):
        own = [(first + i, k) for i, k in enumerate(_narrower(key, bits))]
        numbers = F.when(F.col("choice") == number, _postings(F.col("fp"), own)).otherwise(numbers)
        first += len(own)
    split = listed.join(long, ["choice", "shared"]).select("fp", F.explode(numbers).alias("entry"))
    short = listed.join(long, ["choice", "shared"], "left_anti")
    return short.unionByName(split.select("entry.choice", "entry.shared", "fp"))


def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The lists of two or more entries out of rows sorted by ``choice, shared``.

    Each comes as the columns after these two, which are whole numbers.
    """
    held: list[np.ndarray] | None = None
    for batch in _ended(batches):
        if batch is None:
            if held is None:
                return
            columns, held = held, None
            ends = len(columns[0])
        else:
            columns = [
                batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                for i in range(batch.num_columns)
            ]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
            ends = int(np.argmax(last))  # the last list may go on in the next batch
            held = [c[ends:] for c in columns]
        if not ends:
            continue
        choice, shared = columns[0][:ends], columns[1][:ends]
        new = (choice[1:] != choice[:-1]) | (shared[1:] != shared[:-1])
        starts = np.concatenate(([0], np.flatnonzero(new) + 1, [ends]))
        for i in np.flatnonzero(np.diff(starts) > 1):
            yield [c[starts[i] : starts[i + 1]] for c in columns[2:]]


def tallied(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a list that share enough bytes by position: the only ones whose bits are compared."""
    left, right = np.triu_indices(len(prints), 1)
    shared = np.zeros(len(left), dtype=np.int8)
    for column in prints.view(np.uint8).reshape(-1, BYTES).T:
        shared += column[left] == column[right]
    enough = shared >= least_shared(bits)
    return left[enough], right[enough]


def _local_links(prints: np.ndarray, masks: _Masks) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the prints of one list as all pairs within the distance would.

    Short lists are tallied pair by pair. Longer ones are parted by further positions in which prints
    in reach must agree. Where no such position is left, a list holds prints that agree in all but
    ``bits`` bytes: each print's possible neighbours are looked up, so the work grows with the list.
    """
    if len(prints) <= TALLIED:
        left, right = tallied(prints, masks.max_bits)
        near = np.bitwise_count(prints[left] ^ prints[right]) <= masks.max_bits
        return prints[left[near]], prints[right[near]]
    apart = np.bitwise_or.reduce(prints ^ prints[0])
    free = [i for i in range(BYTES) if int(apart) >> (8 * i) & 0xFF]
    if len(free) <= masks.max_bits:
        return _looked_up(prints, masks)
    found = []
    for agreed in combinations(free, len(free) - masks.max_bits):
        mask = np.uint64(reduce(lambda m, p: m | 0xFF << (8 * p), agreed, 0))
        order = np.argsort(prints & mask, kind="stable")
        value = (prints & mask)[order]
        ends = np.append(np.flatnonzero(value[1:] != value[:-1]) + 1, len(value))
        starts = np.append(0, ends[:-1])
        for i in np.flatnonzero(ends - starts > 1):
            found.append(_local_links(prints[order[starts[i] : ends[i]]], masks))
    a, b = zip(*found, strict=True) if found else ((prints[:0],), (prints[:0],))
    return np.concatenate(a), np.concatenate(b)


def _looked_up(prints: np.ndarray, masks: _Masks) -> tuple[np.ndarray, np.ndarray]:
    """One link at most for each print, by trying every pattern of few bits."""
    prints = np.sort(prints)
    n = len(prints)
    root = np.arange(n)
    allowed = masks.within(prints)
    while True:
        before = root.copy()
        for mask in allowed:
            at = np.minimum(np.searchsorted(prints, prints ^ mask), n - 1)
            hit = prints[at] == prints ^ mask
            root[hit] = np.minimum(root[hit], root[at[hit]])
        root = root[root]
        if (root == before).all():
            moved = root != np.arange(n)
            return prints[moved], prints[root[moved]]


class _Masks:
    """Bit patterns of one up to ``max_bits`` bits among the bits in which a list differs."""

    def __init__(self, max_bits: int):
        self.max_bits = max_bits

    def within(self, prints: np.ndarray) -> np.ndarray:
        apart = np.bitwise_or.reduce(prints ^ prints[0])
        bits = [np.uint64(1 << i) for i in range(64) if int(apart) >> i & 1]
        found = [
            reduce(np.bitwise_or, c) for k in range(1, self.max_bits + 1) for c in combinations(bits, k)
        ]
        return np.array(found, dtype=np.uint64)


def links(prints: DataFrame, bits: int = 2) -> DataFrame:
    """``(a, b)`` between distinct prints at ``bits`` or fewer differing bits, enough to connect all.

    Each list of the index comes to one task, sorted. A short one counts the bytes that each pair
    shares by position, and pairs that reach the least count are verified by their bits. A long one
    is looked through without expanding it into pairs: see :func:`_local_links`.
    """
    masks = _Masks(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (fp,) in lists(batches):
            a, b = _local_links(fp.view(np.uint64), masks)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"]
                )

    dealt = postings(prints, bits).repartition("choice", "shared")
    return dealt.sortWithinPartitions("choice", "shared").mapInArrow(run, "a bigint, b bigint")


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _grouped(
    docs: DataFrame, key: str, text: str, size: int, bits: int
) -> tuple[DataFrame, DataFrame]:
    """All rows with their prints, and ``(fp, first)``: the first row of each print's component.

    Rows with an id come first, by id and then by the hash of their text. Copies are counted as one
    print before any list is made, so a group of copies costs one entry a list.
    """
    if not 1 <= bits <= 3:
        raise ValueError("bits must be 1, 2 or 3")
    prints = written(fingerprints(docs, key, text, size), "prints")
    place = F.struct(F.col("doc_id").isNull().alias("lacking"), "doc_id", "row")
    distinct = written(prints.groupBy("fp").agg(F.min(place).alias("first")), "distinct-prints")
    roots = components(links(distinct.select("fp"), bits))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    named = written(named, "named-prints")
    smallest = written(named.groupBy("root").agg(F.min("first").alias("first")), "smallest")
    return prints, written(named.drop("first").join(smallest, "root").select("fp", "first"), "classes")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, bits: int = 2
) -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest id reachable over prints ``bits`` bits apart.

    Null ids belong to their component but never name it; a component of null ids only is named
    null. Repeated rows come back as often as they came. An empty table gives no rows.
    """
    prints, classes = _grouped(docs, key, text, size, bits)
    return prints.join(classes, "fp").select("doc_id", "fp", F.col("first.doc_id").alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, bits: int = 2
) -> DataFrame:
    """The rows of ``docs``, one of each component of :func:`near_duplicates`, with all their columns.

    The row with the smallest id stays, rows without an id only where none of their component has
    one; of texts that share that id, the one with the smaller hash. Rows alike in id and text are one
    row. Null, empty and blank texts are alike. An empty table stays empty.
    """
    prints, classes = _grouped(docs, key, text, size, bits)
    kept = classes.select("first").distinct()
    kept = written(kept.select(F.col("first.row").alias("row_kept"), F.col("first.doc_id").alias("id_kept")), "kept")
    repeated = prints.groupBy("doc_id", "row").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = written(repeated, "repeated-rows")
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.xxhash64(f"`{key}`", f"`{text}`").alias("row"), F.col(f"`{key}`").alias("id"),
    )
    found = (packed["row"] == kept["row_kept"]) & packed["id"].eqNullSafe(kept["id_kept"])
    staying = packed.join(kept, found, "left_semi")
    if not repeated.isEmpty():
        twice = (F.col("row") == F.col("twice_row")) & F.col("id").eqNullSafe(F.col("twice_id"))
        named = repeated.select(F.col("row").alias("twice_row"), F.col("doc_id").alias("twice_id"))
        once = staying.join(named, twice, "left_semi").groupBy("row", "id").agg(F.first("doc").alias("doc"))
        staying = staying.join(named, twice, "left_anti").unionByName(once)
    return staying.select("doc.*")
