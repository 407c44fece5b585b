"""Phrases and near phrases of test items in a corpus, by a positional inverted index in shards.

The index is a table with one row per shard, some neighbouring documents of about ``CHUNK_BYTES`` of
text: its terms, how often each occurs, and their places in order. Shards never wait for each other:
a window of test words is looked up where the documents are, beginning with the list of its rarest
term in the corpus, moved by the term's offset, and cut down by the lists of the others in turn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.batches import Cache, chunks, one_row_per
from fareloom.session import written

#: Buckets of test words by CRC-32: which of them are used is all that the indexing tasks are told.
BUCKETS = 1 << 20
#: Windows that go to the tasks at once, about. More are looked up in further passes over the index.
WINDOWS_AT_ONCE = 1 << 17
#: Places of rarest terms that a task follows at once.
PLACES_AT_ONCE = 1 << 20
#: Every ASCII byte that is no letter or digit parts words; letters A-Z are lower-cased.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_TO_WORDS).split() if text else []


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = 10) -> DataFrame:
    """``(window, item_id, words)``: every ``size`` consecutive words of an item, numbered.

    An item of fewer words, but not none, is one window. Null texts have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = [w.decode("utf-8") for w in tokens(text)]
                starts = range(max(1, len(found) - size + 1)) if found else ()
                for part in range(0, len(starts), 10_000):
                    lists = [found[s : s + size] for s in starts[part : part + 10_000]]
                    owner = pa.array([i] * len(lists), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(owner), pa.array(lists, pa.list_(pa.string()))],
                        names=["item_id", "words"],
                    )

    rows = one_row_per(items, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    windows = rows.mapInArrow(run, f"item_id {kind}, words array<string>")
    return written(windows.withColumn("window", F.monotonically_increasing_id()), "windows")


def _wanted(windows: DataFrame) -> bytes:
    """A bit per bucket of words that some window has: a fixed size, whatever the windows."""
    used = windows.select(F.explode("words").alias("word"))
    used = used.select((F.crc32("word") % BUCKETS).cast("int").alias("bucket")).distinct()
    bits = np.zeros(BUCKETS, dtype=bool)
    bits[[row["bucket"] for row in used.collect()]] = True  # no more rows than buckets
    return np.packbits(bits).tobytes()


INDEX = "shard bigint, doc_ids array<{kind}>, n_words array<int>, terms array<string>, counts array<int>, places binary"


class _Numbers(dict):
    """Numbers for the wanted words of a shard in order of appearance, -1 for others."""

    def __init__(self, wanted: Cache):
        super().__init__()
        self.wanted, self.terms = wanted, []

    def __missing__(self, word: bytes) -> int:
        number = -1
        if self.wanted[word]:
            number = len(self.terms)
            self.terms.append(word)
        self[word] = number
        return number


def positional_index(
    docs: DataFrame, windows: DataFrame | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The index of whole texts, written: a row per shard, documents without words included.

    ``places`` are 32-bit numbers, term after term: word places in the shard, whose documents follow
    one another without a gap. Given ``windows``, only terms that may occur in one are listed (a few
    others share a bucket with one); else all are, for any windows. Nothing is shuffled: shards are
    cut where the documents lie, a very long one by itself, so copies and hot words change nothing.
    """
    rows = one_row_per(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    bits = None if windows is None else _wanted(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = None if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        wanted = Cache(lambda w: used is None or bool(used[zlib.crc32(w) % BUCKETS]))
        shard = TaskContext.get().partitionId() << 32
        for batch in chunks(batches):
            numbers, sizes, parts = _Numbers(wanted), [], []
            for value in batch.column("text").to_pylist():
                found = tokens(value)
                sizes.append(len(found))
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
            flat = np.concatenate(parts)
            places = np.flatnonzero(flat >= 0).astype(np.int32)
            places = places[np.argsort(flat[places], kind="stable")]
            counts = np.bincount(flat[flat >= 0], minlength=len(numbers.terms)).astype(np.int32)
            terms = [t.decode("utf-8") for t in numbers.terms]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id")),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([terms], pa.list_(pa.string())),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([places.tobytes()], pa.binary()),
                ],
                names=["shard", "doc_ids", "n_words", "terms", "counts", "places"],
            )
            shard += 1

    return written(rows.mapInArrow(run, INDEX.format(kind=kind)), "positional-index")


def _rarest_first(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``(window, item_id, terms)``: the words of each window with their offsets, the rarest first.

    Counts are over the whole corpus. A window with a word that the corpus lacks is nowhere and goes.
    """
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("pair"))
    counts = pairs.groupBy(F.col("pair.terms").alias("word")).agg(F.sum("pair.counts").alias("n"))
    parts = windows.select("window", "item_id", F.posexplode("words").alias("offset", "word"))
    parts = written(parts, "window-words").join(written(counts, "term-counts"), "word", "left")
    ordered = parts.groupBy("window", "item_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "offset", "word"))).alias("terms")
    )
    known = ordered.where(F.forall("terms", lambda t: t["n"].isNotNull()))
    return written(known.select("window", "item_id", "terms"), "rarest-first")


class _Lookup:
    """Some windows as arrays: words by number, the rarest first, and their offsets; -1 fills up."""

    def __init__(self, rows: list):
        self.items = [r["item_id"] for r in rows]
        self.windows = np.array([r["window"] for r in rows], dtype=np.int64)
        self.size = np.array([len(r["terms"]) for r in rows], dtype=np.int64)
        self.words: dict[str, int] = {}
        shape = (len(rows), int(self.size.max()))
        self.terms, self.offsets = np.full(shape, -1, np.int32), np.zeros(shape, np.int32)
        for i, row in enumerate(rows):
            for k, part in enumerate(row["terms"]):
                self.terms[i, k] = self.words.setdefault(part["word"], len(self.words))
                self.offsets[i, k] = part["offset"]


class _Shard:
    """The lists of one shard, ready for lookups of the windows that have all their words here."""

    def __init__(self, row: dict, lookup: _Lookup):
        self.row, self.lookup = row, lookup
        sizes = np.array(row["n_words"], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.places = np.frombuffer(row["places"], np.int32).astype(np.int64)
        counts = np.array(row["counts"], dtype=np.int64)
        self.last = np.cumsum(counts)
        self.first = self.last - counts
        self.stride = int(self.ends[-1]) + 1 if len(sizes) else 1
        self.keys = np.repeat(np.arange(len(counts)), counts) * self.stride + self.places
        here = np.full(len(lookup.words) + 1, -1, dtype=np.int64)
        for i, term in enumerate(row["terms"]):
            number = lookup.words.get(term)
            if number is not None:
                here[number] = i
        here[-1] = -2  # what fills a short window up
        self.terms = here[lookup.terms]
        self.alive = np.flatnonzero((self.terms != -1).all(axis=1))

    def rarest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows and the places of their rarest words, in slices of bounded size."""
        rare = self.terms[self.alive, 0]
        sizes = self.last[rare] - self.first[rare]
        total = np.cumsum(sizes)
        done = 0
        while done < len(rare):
            begun = total[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(total, begun + PLACES_AT_ONCE, "right")))
            own = sizes[done:stop]
            within = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            at = np.repeat(self.first[rare[done:stop]], own) + within
            yield np.repeat(self.alive[done:stop], own), self.places[at]
            done = stop

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, place, "right") - 1

    def phrases(self) -> Iterator[tuple[np.ndarray, ...]]:
        """``(document, window, start, end)`` of all exact occurrences."""
        look = self.lookup
        for window, place in self.rarest():
            start = place - look.offsets[window, 0]
            for k in range(1, look.terms.shape[1]):
                term = self.terms[window, k]
                wanted = term * self.stride + start + look.offsets[window, k]
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                # a start before the shard, or a place after it, must not meet another term's key
                inside = (start >= 0) & (start + look.offsets[window, k] < self.stride)
                kept = (term == -2) | ((self.keys[at] == wanted) & inside)
                window, start = window[kept], start[kept]
            end = start + look.size[window]
            whole = start >= 0
            window, start, end = window[whole], start[whole], end[whole]
            doc = self.document(start)
            own = end <= self.ends[doc]
            yield doc[own], window[own], start[own], end[own]

    def stretches(self, slack: int) -> Iterator[tuple[np.ndarray, ...]]:
        """``(document, window, start, end)`` of all shortest stretches that hold every word.

        They may be ``slack`` words longer than the window, in any order; none can lose an end.
        """
        look = self.lookup
        for window, place in self.rarest():
            reach = look.size[window] + slack
            doc = self.document(place)
            found = []
            width = int(reach.max()) if len(reach) else 0
            # where the last of the words is met, reading on from each start before the rarest one
            later = self._complete(window, place + 1, self.ends[doc])
            for back in range(width):
                start = place - back
                end = self._complete(window, start, self.ends[doc])
                # the next start must miss a word that this one has
                good = (start >= self.begins[doc]) & (end - start <= reach) & (end < later) & (end > place)
                found.append(np.stack([doc[good], window[good], start[good], end[good]]))
                later = end
            whole = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((4, 0), np.int64)
            yield tuple(whole)

    def _complete(self, window: np.ndarray, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The end of the shortest stretch from a start that has all words, or far beyond any."""
        far = np.int64(1) << 40
        end = np.zeros(len(start), dtype=np.int64)
        for k in range(self.lookup.terms.shape[1]):
            term = self.terms[window, k]
            at = np.searchsorted(self.keys, term * self.stride + np.clip(start, 0, self.stride - 1))
            key = self.keys[np.minimum(at, len(self.keys) - 1)]
            met = (at < len(self.keys)) & (key // self.stride == term) & (key % self.stride < limit)
            place = np.where(term == -2, -1, np.where(met, key % self.stride, far))
            end = np.maximum(end, place + 1)
        return end


def _passes(windows: DataFrame, index: DataFrame) -> Iterator[_Lookup]:
    """The windows in blocks of a bounded size, one at a time."""
    plan = _rarest_first(windows, index)
    blocks = -(-plan.count() // WINDOWS_AT_ONCE)
    for block in range(blocks):
        rows = plan.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block).collect()
        if rows:
            yield _Lookup(rows)


def _scan(index: DataFrame, lookup: _Lookup, schema: str, found) -> DataFrame:
    """``found(shard)`` gives columns for a shard's row; empty ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("shard", "n_words", "terms", "counts", "places")}
                if not row["terms"]:
                    continue
                for columns in found(_Shard(row, lookup)):
                    if len(columns["start"]):
                        size = len(columns["start"])
                        columns = {"shard": np.full(size, row["shard"]), **columns}
                        yield pa.RecordBatch.from_arrays(
                            [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
                            names=list(columns),
                        )

    return index.drop("doc_ids").mapInArrow(run, schema)


def find_windows(index: DataFrame, windows: DataFrame, slack: int | None = None) -> DataFrame:
    """``(shard, document, window, start, length)``: where windows occur, places counted per document.

    Without ``slack`` as phrases, word for word. With it as proximity matches: stretches of at most
    ``slack`` words more than the window has, which hold each of its words in any order, and which
    hold them no more if they lose a word at either end. ``index`` must list the windows' terms.
    """

    def found(shard: _Shard) -> Iterator[dict]:
        matches = shard.phrases() if slack is None else shard.stretches(slack)
        for doc, window, start, end in matches:
            yield {
                "document": doc.astype(np.int32), "window": shard.lookup.windows[window],
                "start": (start - shard.begins[doc]).astype(np.int32), "length": (end - start).astype(np.int32),
            }

    schema = "shard bigint, document int, window bigint, start int, length int"
    parts = [
        written(_scan(index, lookup, schema, found), "window-matches") for lookup in _passes(windows, index)
    ]
    return reduce(DataFrame.unionByName, parts, index.sparkSession.createDataFrame([], schema))


def _covered(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``(shard, document, item_id, start, end)``: stretches covered by phrases of an item, merged."""
    kind = windows.schema["item_id"].dataType.simpleString()
    schema = f"shard bigint, document int, item_id {kind}, start int, end int"
    ids = pa.field("item_id", _arrow_type(windows, "item_id"))

    def found(shard: _Shard) -> Iterator[dict]:
        look = shard.lookup
        for doc, window, start, end in shard.phrases():
            item = look.owner[window]
            order = np.lexsort((start, item, doc))
            doc, item, start, end = doc[order], item[order], start[order], end[order]
            # windows of an item are of one length, so ends are in order too
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] > end[:-1])
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(doc)) - 1 if len(heads) else heads
            base = shard.begins[doc[heads]]
            yield {
                "document": doc[heads].astype(np.int32),
                "item_id": pa.array([look.ids[i] for i in item[heads]], ids.type),
                "start": (start[heads] - base).astype(np.int32), "end": (end[tails] - base).astype(np.int32),
            }

    parts = []
    for lookup in _passes(windows, index):
        lookup.ids = list(dict.fromkeys(lookup.items))
        numbers = {item: i for i, item in enumerate(lookup.ids)}
        lookup.owner = np.array([numbers[item] for item in lookup.items], dtype=np.int64)
        parts.append(written(_scan(index, lookup, schema, found), "covered"))
    return reduce(DataFrame.unionByName, parts, index.sparkSession.createDataFrame([], schema))


def _arrow_type(table: DataFrame, column: str) -> pa.DataType:
    return table.select(column).limit(0).toArrow().schema.field(column).type


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = 10,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_hit, items)``: per document the words inside test windows, and whose.

    A window is ``size`` consecutive words of an item, or all of a shorter one; ``items`` are the ids
    of items with a window in the document, as strings, distinct and sorted. Null texts have no words.
    Items without an id hit words but are not listed. Repeated documents come back as often as they
    came, items that share an id are listed once. Other columns are left out. An empty table of
    documents gives no rows, one of items no hits.
    """
    windows = item_windows(items, item_key, item_text, size)
    index = positional_index(docs, windows, key, text)
    stretch = F.struct("start", "end")
    hits = _covered(index, windows).groupBy("shard", "document").agg(
        F.array_sort(F.collect_set(stretch)).alias("stretches"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    covered = F.aggregate("stretches", nothing, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["reach"], x["start"]))).alias("n"),
        F.greatest(s["reach"], x["end"]).alias("reach"),
    ))
    hits = written(hits.select("shard", "document", covered["n"].alias("n_hit"), "items"), "hits")
    rows = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("document", "doc"))
    return rows.join(hits, ["shard", "document"], "left").select(
        F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.n_words").cast("bigint").alias("n_words"),
        F.coalesce(F.col("n_hit").cast("bigint"), F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
