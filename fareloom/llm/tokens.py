"""Byte-pair ids of whole texts, and their pieces of bounded length."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fareloom.llm.batches import chunks, one_row_per

#: Parts a worker keeps; the number changes the time only.
PARTS = 1_500_000


@cache
def encoder(tokenizer: str) -> Callable[[list[str | None]], list[bytes]]:
    """Texts to their ids as little-endian unsigned 32-bit numbers, as the tokenizer file gives them.

    For byte-level pre-tokenizers that keep a space with the word after it, a text falls apart
    before each space that stands alone without changing any id, so each such part is encoded once.
    A text with other spaces goes to the tokenizer whole. A worker keeps its parts from task to task.
    The new parts of a text go to the tokenizer as one text, which spares an encoding for each; its
    ids are parted where a token begins with a space, and each part by itself if that gives others.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    inner = Tokenizer.from_file(tokenizer)
    vocabulary = inner.get_vocab()
    spaced = np.zeros(1 + max(vocabulary.values(), default=0), dtype=bool)
    spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
    parts: dict[str, bytes] = {}
    odd: set[str] = set()
    past: set[str] = set()

    def packed(encoding) -> bytes:
        return array("I", encoding.ids).tobytes()

    def apart(new: list[str]) -> dict[str, bytes]:
        found = inner.encode_batch_fast([" " + p for p in new], add_special_tokens=False)
        return dict(zip(new, map(packed, found), strict=True))

    def together(new: list[str]) -> dict[str, bytes]:
        (found,) = inner.encode_batch_fast([" " + " ".join(new)], add_special_tokens=False)
        ids = packed(found)
        at = (4 * np.flatnonzero(spaced[np.frombuffer(ids, dtype="u4")])).tolist()
        if len(at) != len(new) or at[0]:
            return apart(new)
        return {p: ids[i:j] for p, i, j in zip(new, at, [*at[1:], len(ids)], strict=True)}

    def encoded(new: list[str]) -> dict[str, bytes]:
        strange = [p for p in new if not p or p[0].isspace() or p[-1].isspace()]
        plain = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()] if strange else new
        fresh = (together(plain) if plain else {}) | (apart(strange) if strange else {})
        if len(parts) + len(new) > PARTS:
            parts.clear()
            past.clear()  # a text at hand may have parts that were known before
            past.update(odd)
            odd.clear()
        odd.update(strange)
        parts.update(fresh)
        return fresh

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        first, *split = text.split(" ")
        ids = list(map(parts.get, split))
        if None in ids:
            fresh = encoded(list({p for p, i in zip(split, ids, strict=True) if i is None}))
            ids = [fresh[p] if i is None else i for p, i in zip(split, ids, strict=True)]
        strange = any(kept and not kept.isdisjoint(split) for kept in (odd, past))
        if strange or not first or first[-1].isspace():
            return packed(inner.encode(text, add_special_tokens=False))
        return packed(inner.encode(first, add_special_tokens=False)) + b"".join(ids)

    return lambda texts: [encode(text) for text in texts]


def token_pieces(
    docs: DataFrame, tokenizer: str, most: int = 2048, end: int = 0, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: the ids of a text, then ``end``, in pieces.

    Texts of up to ``most`` ids are one piece. Longer ones are cut from their end into pieces of
    ``most`` ids, so that only the first piece may be shorter. Null and empty texts are the one id
    ``end``. Repeated and null ids are rows like others; other columns are left out.
    """
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in chunks(batches):
            row, piece, start, length, check = [], [], [], [], []
            for i, ids in enumerate(encode(batch.column("text").to_pylist())):
                ids = memoryview(ids + last)
                at, number = 0, len(ids) // 4
                size = number % most or most
                while at < number:
                    row.append(i)
                    piece.append(-(-at // most))
                    start.append(at)
                    length.append(size)
                    check.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                    at, size = at + size, most
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(check, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = one_row_per(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )
