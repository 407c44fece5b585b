"""Arrow batches cut to a bounded amount of text, and words in their fixed definition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text handled at once by a Python worker, unless a single document is longer.
CHUNK_BYTES = 1 << 20
#: Entries after which a worker's cache starts anew. A cache changes the time only, never a result.
CACHE_ENTRIES = 300_000


def words(text: str | None) -> list[bytes]:
    """The runs of characters other than space and U+0009 to U+000D, as UTF-8."""
    return text.encode("utf-8", "replace").split() if text else []


class Cache(dict):
    """A dict that fills itself and keeps what was used last.

    It holds two generations of half the entries each; what is asked for again moves to the newer.
    """

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.half = make, max(1, entries // 2)
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``CHUNK_BYTES`` of text and at least one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + CHUNK_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def one_row_per(table: DataFrame, key: str, value: str) -> DataFrame:
    """Two columns of a table under fixed names: other columns, whatever their names, stay out."""
    return table.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{value}`").alias("text"))
