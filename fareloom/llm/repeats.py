"""Removal of word windows that start earlier in the collection, exact and without long groups.

Every window of ``window`` words has an anchor: its smallest hashed run of ``ANCHOR_WORDS`` words,
the leftmost on a tie. Equal windows have equal anchors at equal places, so all that can make a
window a repeat lies under its anchor. Anchors that occur once are dropped, the rest are small
reference shards: the passages around one anchor. A suffix automaton per shard reads its passages in
order of the collection and gives matching statistics against all earlier ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.automaton import seen_windows
from fareloom.llm.batches import chunks, words
from fareloom.session import written

ANCHOR_WORDS = 8
#: Anchors with more occurrences are split into one shard per window.
MOST_PASSAGES = 200


_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
#: An odd base of the hash of a word's bytes, and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


#: Bytes that are summed up at once.
_BLOCK = 1 << 20


@cache
def _powers(base: int) -> np.ndarray:
    powers = np.full(_BLOCK, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _long_hash(word: np.ndarray) -> np.uint64:
    """The hash of a word that goes on over several blocks."""
    total = 0
    for at in range(0, len(word), _BLOCK):
        part = word[at : at + _BLOCK].astype(np.uint64) + np.uint64(1)
        total += int((part * _powers(_BASE)[: len(part)]).sum()) * pow(_BASE, at, 1 << 64)
    return np.uint64(total % (1 << 64))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    return hashes


class Words:
    """The words of several texts end to end: where they lie, a hash of each, and whose they are.

    Hashes are differences of running sums over all bytes, so no word is taken out for them. Equal
    words have equal hashes; unequal ones that share a hash cost time only, as words decide.
    """

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").encode("utf-8", "replace") for t in texts]
        self.data = b"\n".join(parts)
        raw = np.frombuffer(self.data, np.uint8)
        blank = np.concatenate(([True], _BLANK[raw], [True]))
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        self.begin, self.end = edges[::2], edges[1::2]
        ends = np.cumsum(np.array([len(p) + 1 for p in parts], dtype=np.int64))
        self.text_of = np.searchsorted(ends, self.begin, "right")
        self.hashes = _mixed(self._hashed(raw))
        #: The first word of each text.
        self.first = np.searchsorted(self.text_of, np.arange(len(parts)))

    def _hashed(self, raw: np.ndarray) -> np.ndarray:
        hashes = np.zeros(len(self.begin), dtype=np.uint64)
        sums = np.zeros(min(len(raw), _BLOCK) + 1, dtype=np.uint64)
        for low in range(0, len(raw), _BLOCK):
            part = raw[low : low + _BLOCK].astype(np.uint64) + np.uint64(1)
            np.cumsum(part * _powers(_BASE)[: len(part)], out=sums[1 : len(part) + 1])
            a, b = np.searchsorted(self.begin, (low, low + len(part)))
            start, stop = self.begin[a:b] - low, self.end[a:b] - low
            whole = np.minimum(stop, len(part))
            hashes[a:b] = (sums[whole] - sums[start]) * _powers(_INVERSE)[start]
            if b > a and stop[-1] > len(part):
                hashes[b - 1] = _long_hash(raw[self.begin[b - 1] : self.end[b - 1]])
        return hashes

    def joined(self, start: int, stop: int) -> bytes:
        """Words by number, with one space between them."""
        return b" ".join(self.data[self.begin[start] : self.end[stop - 1]].split())


def _runs_of(flat: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    base = np.uint64(_BASE)
    total = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
    for i in range(size):
        total *= base
        total += flat[i : i + len(total)]
    return _mixed(total)


def _anchors(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """Starts of the windows that lie within a text, their anchors' places, and all run hashes."""
    size = min(ANCHOR_WORDS, window)
    flat, text_of = words.hashes, words.text_of
    runs = _runs_of(flat, size)
    if len(flat) < window:
        none = np.empty(0, dtype=np.int64)
        return none, none, runs
    width, wanted = 1, window - size + 1
    place = np.arange(len(runs))
    while width < wanted:
        step = min(width, wanted - width)
        left, right = place[:-step], place[step:]
        place = np.where(runs[right] < runs[left], right, left)
        width += step
    starts = np.flatnonzero(text_of[: len(flat) - window + 1] == text_of[window - 1 :])
    return starts, place[starts], runs


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(hashes).view(np.int64))


def _groups(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    if len(values):
        ends = [*np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]
        yield from zip([0, *ends[:-1]], ends, strict=True)


def _all_anchors(rows: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = Words(batch.column("text").to_pylist())
            _, places, runs = _anchors(found, window)
            if not len(places):
                continue
            places = places[np.concatenate(([True], places[1:] != places[:-1]))]
            texts = found.text_of[places]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(runs[places]),
                    batch.column("row").take(pa.array(texts)),
                    pa.array((places - found.first[texts]).astype(np.int32)),
                ],
                names=["anchor", "row", "at"],
            )

    return rows.select("row", "text").mapInArrow(run, "anchor bigint, row bigint, at int")


def _spans(rows: DataFrame, window: int) -> DataFrame:
    """Maximal stretches of words whose windows all have an anchor that occurs again."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            tokens = Words(batch.column("text").to_pylist())
            starts, places, runs = _anchors(tokens, window)
            first, text_of, size = tokens.first, tokens.text_of, len(tokens.hashes)
            again = batch.column("again")
            counts = np.diff(again.offsets.to_numpy())
            found = again.flatten()
            owner = np.repeat(np.arange(batch.num_rows), counts)
            repeated, hot = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
            at = first[owner] + found.field("at").to_numpy()
            good = at < size
            repeated[at[good]] = True
            hot[at[good]] = found.field("hot").to_numpy(zero_copy_only=False)[good]
            kept = repeated[places]
            starts, places = starts[kept], places[kept]
            out = []
            # windows that start in neighbouring places of one text belong to one stretch
            apart = (np.diff(starts) != 1) | (text_of[starts[1:]] != text_of[starts[:-1]])
            stretch = np.concatenate(([0], np.cumsum(apart)))[: len(starts)]
            for a, b in _groups(stretch):
                i = int(text_of[starts[a]])
                begin, end = int(starts[a] - first[i]), int(starts[b - 1] - first[i]) + window
                span = tokens.joined(int(starts[a]), int(starts[b - 1]) + window)
                own = np.unique(places[a:b])
                marked = runs[own[hot[own]]].view(np.int64)
                out.append((i, begin, end - begin, span.decode(), xxhash.xxh128_digest(span), marked))
            if out:
                row, begin, size, span, digest, anchors = zip(*out, strict=True)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(taken), batch.column("row").take(taken),
                        pa.array(begin, pa.int32()), pa.array(size, pa.int32()),
                        pa.array(span, pa.string()), pa.array(digest, pa.binary()),
                        pa.array(anchors, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "row", "start", "length", "text", "digest", "hot"],
                )

    return rows.select("doc_id", "row", "text", "again").mapInArrow(
        run,
        f"doc_id {kind}, row bigint, start int, length int, text string, digest binary, "
        "hot array<bigint>",
    )


def _passages(spans: DataFrame, window: int, hot: bool) -> DataFrame:
    """The passage around every anchor of a span that is hot, or around every other one.

    The shard of a passage is its anchor; a hot anchor's passages are shards by themselves. Of equal
    ones that a task reads together all but the first are told at once: as ``told`` stretches, joined
    where they touch, without words.
    """
    kind = spans.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "row", "start", "length", "shard", "passage", *["told"] * hot]

    def combined(found: list[tuple], ids: list, rows: list) -> list[tuple]:
        place = lambda f: (ids[f[0]] is not None, ids[f[0]], rows[f[0]], f[1])
        first: dict[bytes, tuple] = {}
        for f in found:
            held = first.setdefault(f[3], f)
            if held is not f and place(f) < place(held):
                first[f[3]] = f
        result = [(*f, False) for f in first.values()]
        told: list[list] = []
        for f in found:
            if f is first[f[3]]:
                continue
            if told and told[-1][0] == f[0] and f[1] <= told[-1][1] + told[-1][2]:
                told[-1][2] = f[1] + f[2] - told[-1][1]
            else:
                told.append([*f[:3], None, None, True])
        return result + list(map(tuple, told))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            tokens = Words(batch.column("text").to_pylist())
            starts, places, runs = _anchors(tokens, window)
            first, text_of = tokens.first, tokens.text_of
            marks = [set(m.as_py() or ()) for m in batch.column("hot")]
            texts, begins = text_of[places], batch.column("start").to_pylist()
            anchors = runs[places].view(np.int64)
            found = []
            for a, b in _groups(places):
                i = int(texts[a])
                if (int(anchors[a]) in marks[i]) != hot:
                    continue
                begin, end = int(starts[a] - first[i]), int(starts[b - 1] - first[i]) + window
                passage = tokens.joined(int(starts[a]), int(starts[b - 1]) + window)
                shard = xxhash.xxh128_digest(passage) if hot else int(anchors[a])
                found.append((i, begins[i] + begin, end - begin, shard, passage.decode()))
            if not found:
                continue
            if hot:
                found = combined(found, batch.column("doc_id").to_pylist(), batch.column("row").to_pylist())
            row, start, length, shard, passage, *told = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)), batch.column("row").take(pa.array(row)),
                    pa.array(start, pa.int32()), pa.array(length, pa.int32()),
                    pa.array(shard, pa.binary() if hot else pa.int64()), pa.array(passage, pa.string()),
                    *map(pa.array, told),
                ],
                names=names,
            )

    chosen = spans.where(F.size("hot") > 0) if hot else spans
    return chosen.select("doc_id", "row", "start", "text", "hot").mapInArrow(
        run,
        f"doc_id {kind}, row bigint, start int, length int, "
        + ("shard binary, passage string, told boolean" if hot else "shard bigint, passage string"),
    )


def _windows(passages: DataFrame, window: int) -> DataFrame:
    """Every window of the passages, each a shard by itself."""
    kind = passages.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "passage"):
            row, start, shard = [], [], []
            starts = batch.column("start").to_pylist()
            for i, passage in enumerate(batch.column("passage").to_pylist()):
                tokens = words(passage)
                for s in range(len(tokens) - window + 1):
                    row.append(i)
                    start.append(starts[i] + s)
                    shard.append(xxhash.xxh128_digest(b" ".join(tokens[s : s + window])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    batch.column("row").take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int32()), pa.array(shard, pa.binary()),
                ],
                names=["doc_id", "row", "start", "shard"],
            )

    return passages.select("doc_id", "row", "start", "passage").mapInArrow(
        run, f"doc_id {kind}, row bigint, start int, shard binary"
    )


def _judged(passages: DataFrame, window: int) -> DataFrame:
    """Stretches of windows that an earlier passage of their shard holds, by suffix automaton.

    A task reads its shards one after another, in order; only one is in memory, and it has at most
    ``MOST_PASSAGES`` passages of less than ``2 * window`` words.
    """
    kind = passages.schema["doc_id"].dataType.simpleString()

    rest = passages.select("doc_id", "row", "start", "shard", "passage")

    def flush(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        masks = seen_windows([words(r[4]) for r in rows], window)
        return [
            (doc, row, start + a, b - a - 1 + window)
            for (doc, row, start, _, _), mask in zip(rows, masks, strict=True)
            for a, b in _groups(np.array(mask))
            if mask[a]
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in _with_end(batches):
            found: list[tuple] = []
            if batch is not None:
                ids = batch.schema.field("doc_id").type
                for item in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    if held and held[0][3] != item[3]:
                        found += flush(held)
                        held = []
                    if not held or held[-1][:3] != item[:3]:  # rows alike are one document
                        held.append(item)
            else:
                found = flush(held)
            if found:
                kinds = (ids, pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
                    names=["doc_id", "row", "start", "length"],
                )

    ordered = rest.repartition("shard").sortWithinPartitions("shard", "doc_id", "row", "start")
    return ordered.mapInArrow(run, f"doc_id {kind}, row bigint, start int, length int")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _told_apart(occurrences: DataFrame, shard: str, name: str) -> DataFrame:
    """The occurrences with ``later``: true for all but the first of a shard of equal words.

    The result is written, without ``shard``; pass a written table, as ranges are fitted to a sample of
    it first. Occurrences are dealt by ranges of (shard, place), so that a shard that many share spreads over
    tasks, and each task tells a row from the one before it. Only its first row can belong to a shard
    that began in a task before it: these rows, one a task, are told by the last rows of the tasks.
    ``shard`` is 16 bytes.
    """
    order = [shard, "doc_id", "row", "start"]
    dealt = occurrences.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = [c for c in occurrences.columns if c != shard]
    kinds = ", ".join(f"`{c}` {occurrences.schema[c].dataType.simpleString()}" for c in (*columns, shard))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def told(batch: pa.RecordBatch, later: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            first = [batch.column(shard)[0].as_py() if edge[0] else None]  # no other row is at an edge
            named = pa.concat_arrays([pa.array(first, pa.binary()), pa.nulls(len(later) - 1, pa.binary())])
            more = (named, pa.array(later), pa.array(edge.astype(np.int32)), pa.array(np.full(len(later), task, np.int32)))
            return pa.RecordBatch.from_arrays(
                [*map(batch.column, columns), *more], names=[*columns, shard, "later", "edge", "task"]
            )

        before, end = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            digests = batch.column(shard).cast(pa.binary(16))
            data = np.frombuffer(digests.buffers()[1], np.int64).reshape(-1, 2)
            data = data[digests.offset : digests.offset + batch.num_rows]
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = (data[1:] != data[:-1]).any(axis=1)
            edge = np.zeros(batch.num_rows)
            if before is None:
                edge[0] = 1
            else:
                new[0] = (data[0] != before).any()
            before, end = data[-1].copy(), batch.slice(batch.num_rows - 1, 1)
            yield told(batch, ~new, edge)
        if end is not None:
            yield told(end, np.array([False]), np.array([2]))

    marked = written(dealt.mapInArrow(run, f"{kinds}, later boolean, edge int, task int"), name)
    ends = marked.where("edge = 2").groupBy(shard).agg(F.min("task").alias("since"))
    heads = marked.where("edge = 1").join(ends, shard, "left")
    heads = heads.withColumn("later", F.coalesce(F.col("since") < F.col("task"), F.lit(False)))
    parts = [table.select(*columns, "later") for table in (marked.where("edge = 0"), heads)]
    return parts[0].unionByName(parts[1])


def repeated_stretches(docs: DataFrame, window: int = 20) -> DataFrame:
    """``(doc_id, row, start, length)``: stretches of words to remove; they may overlap.

    ``docs`` are ``(doc_id, text, row)`` with ``row`` a hash of both. See :func:`mark_repeats`.
    """
    anchors = written(_all_anchors(docs, window), "anchors")
    repeated = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    repeated = written(repeated.select("anchor", (F.col("n") > MOST_PASSAGES).alias("hot")), "repeated")
    places = anchors.join(repeated, "anchor").groupBy("row").agg(
        F.collect_list(F.struct("at", "hot")).alias("again")
    )
    spans = written(_spans(docs.join(places, "row"), window), "spans")
    judged = _told_apart(spans, "digest", "judged-spans")
    fresh = judged.where("not later")
    by_automaton = _judged(_passages(fresh, window, hot=False), window)
    # Under a hot anchor equal passages go first, whole; what is left of it is told by its windows.
    hot = written(_passages(fresh, window, hot=True), "hot-passages")
    early = hot.where("told")
    hot = _told_apart(hot.where("not told").drop("told"), "shard", "judged-passages")
    windows = written(_windows(hot.where("not later"), window), "hot-windows")
    windows = _told_apart(windows, "shard", "judged-windows")
    windows = windows.withColumn("length", F.lit(window))
    place = ("doc_id", "row", "start", "length")
    told = [table.where("later").select(*place) for table in (judged, hot, windows)]
    told.append(early.select(*place))
    return reduce(DataFrame.unionByName, told, by_automaton)


def _once(rows: DataFrame) -> DataFrame:
    """``(doc_id, text, row)`` with rows alike in id and text once: they are one document.

    Only rows that come more than once are gathered; tasks keep one of each before they meet.
    """
    rows = rows.select("doc_id", "text", "row")
    several = rows.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row")
    several = written(several, "several")
    if several.isEmpty():
        return rows
    once = rows.join(several, "row", "left_semi").groupBy("row", "doc_id").agg(F.first("text").alias("text"))
    return rows.join(several, "row", "left_anti").unionByName(once)


def mark_repeats(
    docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, carried)``: every row with its words, repeats taken out.

    A word goes if a window of ``window`` words that covers it also starts earlier: in a smaller
    ``doc_id`` or earlier in the same text. Windows are judged on the input. ``kept`` joins the words
    left by one space. Null ids come before all others; of texts that share an id, the one with the
    smaller hash is first; rows alike in id and text are one document, and each gets its result.
    Null and empty texts have no words. ``carried`` holds the columns named in ``carry``.
    """
    carried = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(None).cast("boolean")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), carried.alias("carried")
    ).withColumn("row", F.xxhash64("doc_id", "text"))
    stretches = written(repeated_stretches(_once(rows), window), "stretches")
    gone = stretches.groupBy("row", "doc_id").agg(
        F.collect_list(F.struct("start", "length")).alias("gone")
    )
    gone = gone.select(F.col("row").alias("of_row"), F.col("doc_id").alias("of_id"), "gone")
    same = (F.col("row") == F.col("of_row")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            total, removed, kept = [], [], []
            texts, lists = (batch.column(c).to_pylist() for c in ("text", "gone"))
            for value, gone in zip(texts, lists, strict=True):
                tokens = words(value)
                total.append(len(tokens))
                if gone:
                    keep = np.ones(len(tokens), dtype=bool)
                    for g in gone:
                        keep[g["start"] : g["start"] + g["length"]] = False
                    tokens = [tokens[i] for i in np.flatnonzero(keep)]
                removed.append(total[-1] - len(tokens))
                kept.append(b" ".join(tokens).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()), batch.column("carried"),
                ],
                names=["doc_id", "n_words", "n_removed", "kept", "carried"],
            )

    joined = rows.join(gone, same, "left").select("doc_id", "text", "gone", "carried")
    return joined.mapInArrow(
        run,
        f"doc_id {kinds['doc_id']}, n_words bigint, n_removed bigint, kept string, "
        f"carried {kinds['carried']}",
    )
