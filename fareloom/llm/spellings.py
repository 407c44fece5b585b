"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted, deleted or replaced letter moves a word's letter counts by one or two in L1, so what may
be near a word lies in a small ball, of radius 2 among words of its length and of radius 1 among those
one longer or shorter. Words of a length are dealt into the cells of a k-d tree fitted to a bounded
sample of them; a word visits each cell whose box its ball touches, descends that cell's own tree,
and what is left in reach is verified letter by letter. Every word is in a tree and searches; the
sample only decides where the cells' borders are.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.batches import chunks, one_row_per
from fareloom.session import written

#: Words whose letter counts the borders of cells are fitted to, about, and words a cell should hold.
SAMPLE_WORDS = 1 << 16
CELL_WORDS = 1 << 14
#: Words in a leaf of a cell's tree, searches that descend at once, and levels of a tree, at most.
LEAF_WORDS = 48
SEARCHES_AT_ONCE = 1 << 13
MOST_LEVELS = 200
#: Distinct words that a task counts before it passes their counts on.
WORDS_AT_ONCE = 200_000
#: Letters are U+0041 to U+005A, lower-cased, U+0061 to U+007A and U+00C0 to U+00FF: one byte each in
#: Latin-1, where every other byte, and what Latin-1 lacks, parts words.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)
_COLUMN = np.array([b - 97 if 97 <= b <= 122 else b - 0xC0 + 26 if b >= 0xC0 else 0 for b in range(256)])
LETTERS = 26 + 64
#: Counts modulo 8 as codes of four bits: counts that differ by up to four differ in as many bits, others
#: in fewer than they differ by, so no pair within reach is lost and verification sees the rest.
_CODE = np.array([0b0000, 0b0001, 0b0011, 0b0111, 0b1111, 0b1110, 0b1100, 0b1000], dtype=np.uint64)


def runs(text: str | None) -> Counter:
    """How often each maximal run of letters occurs, A-Z lower-cased, as Latin-1."""
    return Counter(text.encode("latin-1", "replace").translate(_TO_WORDS).split() if text else ())


def word_counts(
    docs: DataFrame, least_letters: int = 6, least_count: int = 5, slips: int | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(word, n)`` over all whole texts: runs of so many letters at least that occur so often.

    With ``slips``, all occurrences of a run in a document lose one letter where the CRC-32 h of
    ``<doc_id>:<run>`` is a multiple of it, the one at h modulo the run's length: slips of the pen, for
    trials (a null id is empty). Tasks pass on counts, not occurrences.
    """

    def counted(total: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in chunks(batches):
            for doc, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in runs(value).items():
                    if len(word) < least_letters:
                        continue
                    if slips:
                        shown = word if word.isascii() else word.decode("latin-1").encode()
                        h = zlib.crc32(shown, begun)
                        if h % slips == 0:
                            gone = h % len(word)
                            word = word[:gone] + word[gone + 1 :]
                            if len(word) < least_letters:
                                continue
                    total[word] += n
            if len(total) > WORDS_AT_ONCE:
                yield counted(total)
                total.clear()
        if total:
            yield counted(total)

    parts = one_row_per(docs, key, text).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _letters(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows by length, and their letters as a matrix."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    sizes = np.diff(ends)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, data[ends[rows][:, None] + np.arange(size)]


def letter_counts(letters: np.ndarray) -> np.ndarray:
    n = len(letters)
    at = _COLUMN[letters] + np.arange(n)[:, None] * LETTERS
    return np.bincount(at.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(np.int32)


def grow(counts: np.ndarray, most: float) -> tuple[object, list[np.ndarray]]:
    """A k-d tree and the rows of its leaves: inner nodes are (column, threshold, below, above).

    Each node is cut where rows part most evenly, until ``most`` rows are left or all are alike.
    """
    leaves: list[np.ndarray] = []

    def node(rows: np.ndarray, level: int):
        if len(rows) > most and level < MOST_LEVELS:
            own, best = counts[rows], (0, 0, 0)
            for threshold in range(4):
                below = (own <= threshold).sum(axis=0)
                even = np.minimum(below, len(rows) - below)
                column = int(even.argmax())
                best = max(best, (int(even[column]), column, threshold))
            if not best[0]:  # alike up to four of each letter: cut at a median instead
                spread = own.max(axis=0) - own.min(axis=0)
                column = int(spread.argmax())
                if spread[column]:
                    best = (1, column, int((own[:, column].min() + own[:, column].max() - 1) // 2))
            if best[0]:
                _, column, threshold = best
                low = own[:, column] <= threshold
                return column, threshold, node(rows[low], level + 1), node(rows[~low], level + 1)
        leaves.append(rows)
        return len(leaves) - 1

    return node(np.arange(len(counts)), 0), leaves


def visit(tree, counts: np.ndarray, radius: int, apart: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves with the rows of ``counts`` whose ball of ``radius`` in L1 touches their box.

    ``apart`` is how far each row is from the whole tree to begin with.
    """
    low, high = np.zeros(counts.shape[1], np.int64), np.full(counts.shape[1], np.iinfo(np.int32).max)

    def down(node, rows, apart):
        if not len(rows):
            return
        if isinstance(node, int):
            yield node, rows
            return
        column, threshold, below, above = node
        own = counts[rows, column]
        now = np.maximum(0, np.maximum(low[column] - own, own - high[column]))
        for child, bound, value in ((below, high, threshold), (above, low, threshold + 1)):
            kept, bound[column] = bound[column], value
            then = apart - now + np.maximum(0, np.maximum(low[column] - own, own - high[column]))
            near = then <= radius
            yield from down(child, rows[near], then[near])
            bound[column] = kept

    rows = np.flatnonzero(apart <= radius)
    yield from down(tree, rows, apart[rows])


def one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Row by row: one letter replaced, or one letter more in the longer."""
    if shorter.shape[1] == longer.shape[1]:
        return (shorter != longer).sum(axis=1) == 1
    size = shorter.shape[1]
    ahead = np.argmax(np.pad(shorter != longer[:, :-1], ((0, 0), (0, 1)), constant_values=True), axis=1)
    behind = np.argmax(np.pad((shorter != longer[:, 1:])[:, ::-1], ((0, 0), (0, 1)), constant_values=True), axis=1)
    return ahead + behind >= size


class Cell:
    """The words of a cell, all of one length, as a tree that counts the words near others."""

    def __init__(self, letters: np.ndarray, n: np.ndarray):
        best_first = np.lexsort((*letters.T[::-1], -n)) if letters.shape[1] < 200 else np.array(
            sorted(range(len(n)), key=lambda i: (-n[i], letters[i].tobytes()))
        )
        self.letters, self.n = letters[best_first], n[best_first]
        counts = letter_counts(self.letters)
        self.columns = np.flatnonzero(counts.any(axis=0))
        counts = counts[:, self.columns]
        self.tree, self.leaves = grow(counts, LEAF_WORDS)
        self.codes = self._codes(counts)

    @staticmethod
    def _codes(counts: np.ndarray) -> np.ndarray:
        """Words of 64 bits, one row each, with four bits a letter."""
        wide = _CODE[counts % 8]
        wide = np.pad(wide, ((0, 0), (0, -wide.shape[1] % 16)))
        shifted = wide << (4 * (np.arange(wide.shape[1]) % 16)).astype(np.uint64)
        return np.bitwise_or.reduce(shifted.reshape(len(counts), -1, 16), axis=2).T.copy()

    def near(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word: how many words here are one edit away, and the first of them by count."""
        whole = letter_counts(letters)
        counts = whole[:, self.columns]
        beyond = whole.sum(axis=1) - counts.sum(axis=1)  # letters that no word here has
        size, own = letters.shape[1], self.letters.shape[1]
        radius = 2 if size == own else 1
        codes = self._codes(counts)
        number, first = np.zeros(len(letters), np.int64), np.full(len(letters), len(self.n))
        held, held_size = [], 0

        def verify():
            word, here = (np.concatenate(x) for x in zip(*held, strict=True))
            for part in range(0, len(word), step := max(1, (4 << 20) // (size + 1))):
                a, b = word[part : part + step], here[part : part + step]
                pair = (letters[a], self.letters[b])
                good = one_edit(*(pair if size <= own else pair[::-1]))
                np.add.at(number, a[good], 1)
                np.minimum.at(first, a[good], b[good])

        for leaf, rows in visit(self.tree, counts, radius, beyond):
            members = self.leaves[leaf]
            for part in range(0, len(rows), step := max(1, (1 << 19) // len(members))):
                some = rows[part : part + step]
                apart = np.repeat(beyond[some][:, None], len(members), axis=1)
                for mine, theirs in zip(codes, self.codes, strict=True):
                    apart += np.bitwise_count(mine[some][:, None] ^ theirs[members][None, :])
                a, b = np.nonzero(apart == radius)
                held.append((some[a], members[b]))
                held_size += len(a)
                if held_size > 1 << 18:
                    verify()
                    held, held_size = [], 0
        if held_size:
            verify()
        return number, first


def _borders(words: DataFrame) -> dict[int, object]:
    """A tree of cells for each length in a sample of about ``SAMPLE_WORDS`` words."""
    n = words.count()
    share = min(1.0, SAMPLE_WORDS / max(1, n))
    chosen = F.pmod(F.xxhash64("letters"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    sample = words.where(chosen & (F.octet_length("letters") <= 255)).select("letters").toArrow()
    trees = {}
    for rows, letters in _letters(sample.column("letters").combine_chunks()) if sample.num_rows else ():
        trees[letters.shape[1]] = grow(letter_counts(letters), max(8, CELL_WORDS * share))[0]
    return trees


def _dealt(words: DataFrame, trees: dict[int, object]) -> DataFrame:
    """``(length, cell, searches, letters, n)``: each word once in its cell, and where it searches.

    Lengths without a tree are one cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for rows, letters in _letters(batch.column("letters")):
                size, counts = letters.shape[1], letter_counts(letters)
                start = np.zeros(len(rows), np.int64)
                for length, radius, searches in (
                    (size, 0, False), (size, 2, True), (size - 1, 1, True), (size + 1, 1, True),
                ):
                    for cell, some in visit(trees.get(length, 0), counts, radius, start):
                        taken = pa.array(rows[some])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(some), length, np.int32)),
                                pa.array(np.full(len(some), cell, np.int32)),
                                pa.array(np.full(len(some), searches)),
                                batch.column("letters").take(taken), batch.column("n").take(taken),
                            ],
                            names=["length", "cell", "searches", "letters", "n"],
                        )

    return words.mapInArrow(run, "length int, cell int, searches boolean, letters binary, n bigint")


def _searched(dealt: DataFrame) -> DataFrame:
    """``(letters, n_near, best)``: what each search found in its cell, if anything."""

    def answer(cell: Cell, words: pa.Array) -> Iterator[pa.RecordBatch]:
        for rows, letters in _letters(words):
            number, first = cell.near(letters)
            some = np.flatnonzero(number)
            if len(some):
                best = first[some]
                yield pa.RecordBatch.from_arrays(
                    [
                        words.take(pa.array(rows[some])), pa.array(number[some]), pa.array(cell.n[best]),
                        pa.array([row.tobytes() for row in cell.letters[best]], pa.binary()),
                    ],
                    names=["letters", "n_near", "near_n", "near"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cell, points, waiting = None, None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal cell, waiting
            if cell is None and points and waiting:
                letters, n = zip(*points, strict=True)
                (_, matrix), = _letters(pa.concat_arrays(letters))
                cell = Cell(matrix, np.concatenate(n))
            if cell is not None and waiting:
                yield from answer(cell, pa.concat_arrays(waiting))
            waiting = []

        for batch in batches:
            if not batch.num_rows:
                continue
            length, part = (batch.column(c).to_numpy() for c in ("length", "cell"))
            searches = batch.column("searches").to_numpy(zero_copy_only=False)
            new = (length[1:] != length[:-1]) | (part[1:] != part[:-1]) | (searches[1:] != searches[:-1])
            ends = [*np.flatnonzero(new) + 1, batch.num_rows]
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                if (length[a], part[a]) != here:
                    yield from flush()
                    here, cell, points = (length[a], part[a]), None, []
                some = batch.column("letters").slice(a, b - a)
                if searches[a]:
                    waiting.append(some)
                    if sum(map(len, waiting)) >= SEARCHES_AT_ONCE:
                        yield from flush()
                else:
                    points.append((some, batch.column("n").to_numpy()[a:b]))
        yield from flush()

    ordered = dealt.repartition("length", "cell").sortWithinPartitions("length", "cell", "searches", "letters")
    return ordered.mapInArrow(run, "letters binary, n_near bigint, near_n bigint, near binary")


def near_words(words: DataFrame) -> DataFrame:
    """``(letters, n_near, near_n, near)`` for ``words(letters, n)`` that have a word one edit away.

    ``near`` is the one with the largest count, on a tie the smallest in code-point order. A cell's
    words are in one task; what searches it passes by in slices. No pairs leave a task.
    """
    parts = _searched(_dealt(words, _borders(words)))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near")))
    found = parts.groupBy("letters").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("letters", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, root)`` pairs that lead one step: follows them to their ends.

    Every round doubles the steps; the joins have two written sides, so that adaptive execution
    splits a form that many words share.
    """
    steps = written(forms, "forms")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("last"))
        joined = written(steps.join(onward, "root", "left"), "steps")
        steps = joined.select("word", F.coalesce("last", "root").alias("root"))
        if joined.where(F.col("last").isNotNull()).isEmpty():
            return steps


def spelling_variants(counts: DataFrame, times: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for ``counts(word, n)`` of distinct words.

    Words are near if exactly one inserted, deleted or replaced letter tells them apart. The form of
    a word is its near word with the largest n (ties: smallest in code-point order) if that is at
    least ``times`` its own n, else null; the root follows forms to the last, the word itself if it
    has none. Words are of letters in the sense of this module; others, null and empty words are
    refused by their letters: they match nothing and come back without a form.
    """
    plain = F.col("word").rlike("^[a-zÀ-ÿ]+$")
    letters = F.encode(F.when(plain, F.col("word")), "ISO-8859-1")
    words = written(counts.select("word", "n", letters.alias("letters")), "words")
    near = near_words(words.where(F.col("letters").isNotNull()).select("letters", "n"))
    as_word = lambda c: F.decode(c, "ISO-8859-1")
    fits = F.col("near_n") >= times * F.col("n")
    told = written(words.join(near, "letters", "left").select(
        "word", "n",
        F.when(fits, as_word("near")).alias("form"),
        F.when(fits, F.col("near_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    ), "forms-of-words")
    roots = _roots(told.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return told.join(written(roots, "roots"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
