"""SentencePiece byte-pair models: encoding with original byte spans, and decoding.

The model file gives pieces, scores and the compiled character map; the work on texts is done here,
once per distinct stretch between spaces.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fareloom.llm.batches import Cache, chunks, one_row_per

SPACE = "▁"
#: Kinds of pieces in a model file; fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What unknown pieces decode to; a fixed value.
UNKNOWN_TEXT = " ⁇ "
#: Numbers of single characters that are no pieces start here, and no number needs more bits.
FIRST_CHARACTER, SYMBOL_BITS = 1 << 24, 26
#: Any character that no piece holds, a symbol merged into its left neighbour, and no rank.
OTHER, GONE, NEVER = (1 << 26) - 1, -1, 1 << 30
#: Characters from which a stretch is merged by a heap.
LONG_STRETCH = 64
#: Stretches a worker keeps; the number changes the time only.
STRETCHES = 900_000


class CharacterMap:
    """A compiled character map: a double-array trie of UTF-8 prefixes, and what they become."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.texts = compiled[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """How many bytes from ``at`` on the longest mapped prefix has, and its replacement."""
        if not self.units:
            return None
        found = None
        node = self._offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & (0x80000000 | 0xFF) != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = (i + 1 - at, self.texts[start : self.texts.index(b"\0", start)])
        return found

    def normalized(self, text: str) -> list[tuple[str, int]]:
        """Normalised characters, each with the source bytes it stands for.

        A replacement's first character takes the whole matched prefix and its others none; a prefix
        that becomes nothing is added to the character before it, or to the one after at the start.
        """
        data = text.encode("utf-8", "replace")
        out: list[tuple[str, int]] = []
        at = owed = 0
        while at < len(data):
            match = self.longest(data, at)
            if match:
                taken, become = match
                new = become.decode("utf-8", "replace")
            else:
                taken = 1
                while at + taken < len(data) and data[at + taken] & 0xC0 == 0x80:
                    taken += 1
                new = data[at : at + taken].decode("utf-8", "replace")
            at += taken
            if not new:
                if out:
                    out[-1] = (out[-1][0], out[-1][1] + taken)
                else:
                    owed += taken
                continue
            out.append((new[0], taken + owed))
            out.extend((c, 0) for c in new[1:])
            owed = 0
        return out


class Model:
    """A byte-pair model read from its file."""

    def __init__(self, file: str):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(file, "rb") as opened:
            spec.ParseFromString(opened.read())
        if spec.trainer_spec.model_type != 2:
            raise ValueError("only byte-pair models are read")
        rules = spec.normalizer_spec
        if rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("models that drop spaces or leave them as they are are not read")
        if spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that put spaces behind words are not read")
        kinds = {p.type for p in spec.pieces}
        if kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("models with user-defined or unused pieces are not read")
        self.prefix = rules.add_dummy_prefix
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == UNKNOWN)
        # Pieces hold the sign for a space at their start or nothing else: no merge passes one.
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self._number_merges({p.piece: p.score for p in spec.pieces if p.type == NORMAL})
        unknown_text = spec.trainer_spec.unk_surface or UNKNOWN_TEXT
        self.text_of: list[bytes | int] = []
        for p in spec.pieces:
            text = {NORMAL: p.piece.replace(SPACE, " "), UNKNOWN: unknown_text}.get(p.type, "")
            self.text_of.append(int(p.piece[1:-1], 16) if p.type == BYTE else text.encode())
        flat = [bytes([t]) if isinstance(t, int) else t for t in self.text_of]
        self.size_of = [len(t) for t in flat]
        # each piece's bytes, and again without the space that goes at the start of a text
        self.flat = pa.array([*flat, *(t.removeprefix(b" ") for t in flat)], pa.binary())
        kinds = np.array([p.type for p in spec.pieces])
        self.is_byte, self.is_control, self.is_normal = (kinds == k for k in (BYTE, CONTROL, NORMAL))
        self.pieces = [p.piece for p in spec.pieces]
        self.stretches = Cache(self._stretch, STRETCHES)

    def _number_merges(self, scores: dict[str, float]) -> None:
        """Symbols as numbers, and for each pair that is a piece its rank by score and its number.

        Symbols are the pieces and the single characters inside pieces; the best score has rank 0 and
        equal scores share a rank.
        """
        self.symbols = dict(self.ids)
        for character in sorted({c for piece in scores for c in piece}):
            self.symbols.setdefault(character, len(self.symbols) + FIRST_CHARACTER)
        ranks = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank_of: dict[int, int] = {}
        self.symbol_of: dict[int, int] = {}
        for piece, score in scores.items():
            for i in range(1, len(piece)):
                left, right = self.symbols.get(piece[:i]), self.symbols.get(piece[i:])
                if left is not None and right is not None:
                    self.rank_of[left << SYMBOL_BITS | right] = ranks[score]
                    self.symbol_of[left << SYMBOL_BITS | right] = self.ids[piece]

    def _merged(self, symbols: list[int]) -> list[int]:
        """The symbols left: the best adjacent pair is merged first, the leftmost on a tie."""
        if len(symbols) > LONG_STRETCH:
            return self._merged_by_heap(symbols)
        get, merged = self.rank_of.get, self.symbol_of
        ranks = [get(a << SYMBOL_BITS | b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            symbols[i] = new = merged[symbols[i] << SYMBOL_BITS | symbols.pop(i + 1)]
            del ranks[i]
            if i:
                ranks[i - 1] = get(symbols[i - 1] << SYMBOL_BITS | new, NEVER)
            if i < len(ranks):
                ranks[i] = get(new << SYMBOL_BITS | symbols[i + 1], NEVER)
        return symbols

    def _merged_by_heap(self, symbols: list[int]) -> list[int]:
        """The same for stretches of many characters, in n log n steps."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                pair = symbols[i] << SYMBOL_BITS | symbols[after[i]]
                if pair in self.rank_of:
                    heappush(heap, (self.rank_of[pair], i, pair))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n or symbols[i] << SYMBOL_BITS | symbols[j] != pair:
                continue  # one of the two has changed since
            symbols[i], symbols[j] = self.symbol_of[pair], GONE
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s != GONE]

    def _stretch(self, stretch: str) -> tuple[bytes, bytes]:
        """The ids of a stretch and, for each, how many bytes of the source it stands for."""
        if not self.map.units and SPACE not in stretch and self.bytes:
            return self._plain_stretch(stretch)
        characters = self.map.normalized(stretch)
        signs = [SPACE if c == " " else c for c, _ in characters]
        known = [self.symbols.get(c, OTHER) for c in signs]
        ids: list[int] = []
        lengths: list[int] = []
        at = 0
        for symbol in self._merged(known):
            size = len(self.pieces[symbol]) if symbol < FIRST_CHARACTER else 1
            source = sum([s for _, s in characters[at : at + size]])
            if symbol < FIRST_CHARACTER:
                ids.append(symbol)
                lengths.append(source)
            elif self.bytes:
                raw = signs[at].encode()
                ids.extend([self.bytes[b] for b in raw])
                # a source of as many bytes gives each its own, any other goes to the last
                lengths.extend([1] * len(raw) if source == len(raw) else [0] * (len(raw) - 1) + [source])
            elif ids and ids[-1] == self.unknown:
                lengths[-1] += source
            else:
                ids.append(self.unknown)
                lengths.append(source)
            at += size
        return array("i", ids).tobytes(), array("i", lengths).tobytes()

    def _plain_stretch(self, stretch: str) -> tuple[bytes, bytes]:
        """The same where normalising changes nothing, so that pieces and source have equal sizes."""
        signs = stretch.encode("utf-8", "replace").decode("utf-8").replace(" ", SPACE)
        symbols = [self.symbols.get(c, OTHER) for c in signs]
        if max(symbols) >= FIRST_CHARACTER:  # characters that are no pieces become bytes
            others = iter([c for c, s in zip(signs, symbols, strict=True) if s >= FIRST_CHARACTER])
            ids = []
            for symbol in self._merged(symbols):
                if symbol < FIRST_CHARACTER:
                    ids.append(symbol)
                else:
                    ids.extend([self.bytes[b] for b in next(others).encode()])
        else:
            ids = self._merged(symbols)
        return array("i", ids).tobytes(), array("i", [self.size_of[i] for i in ids]).tobytes()

    def _parts(self, text: str) -> list[str]:
        """The stretches of a text that has the space before it already."""
        if not text or not self.apart or self.map.units:
            return [text] if text else []
        if "  " in text or SPACE in text:
            # a stretch begins with all the spaces, plain or as signs, that stand before it
            return re.findall(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+", text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + part for part in rest]

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids and source lengths of each text."""
        return [self.encode(text) for text in texts]

    def encode(self, text: str) -> tuple[bytes, bytes]:
        parts = self._parts(" " + text if self.prefix and text else text)
        whole = not self.apart or bool(self.map.units)
        look_up = self._stretch if whole else self.stretches.__getitem__
        return self._joined(list(map(look_up, parts)))

    def _joined(self, found: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
        """Ids and source lengths of a whole text, as 32-bit numbers."""
        if not found:
            return b"", b""
        ids, lengths = (b"".join(x) for x in zip(*found, strict=True))
        if self.prefix:  # the space that was put before the text is in the first piece
            first = struct.unpack_from("<i", lengths)[0]
            lengths = struct.pack("<i", first - 1) + lengths[4:]
        return ids, lengths

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: runs of byte pieces as UTF-8, each bad byte as U+FFFD."""
        if not len(ids):
            return ""
        if ((ids < 0) | (ids >= len(self.text_of))).any():
            raise IndexError("an id is not in the model")
        if self.is_byte[ids].any():
            out, run = [], bytearray()
            for part in map(self.text_of.__getitem__, ids.tolist()):
                if isinstance(part, int):
                    run.append(part)
                    continue
                out += [_repaired(bytes(run)), part]
                run.clear()
            text = b"".join([*out, _repaired(bytes(run))])
        else:
            text = b"".join(map(self.text_of.__getitem__, ids.tolist()))
        first = ids[np.argmin(self.is_control[ids])]  # the first that is no control piece
        if self.prefix and self.is_normal[first]:
            text = text.removeprefix(b" ")
        return text.decode("utf-8")


    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of many lists of ids, given end to end; as :meth:`decode` gives each.

        The bytes of all pieces are gathered at once. Lists that begin with a control piece, and all
        lists where the bytes are no valid text, are decoded one by one.
        """
        starts = np.concatenate(([0], ends[:-1]))
        first = ids[starts[starts < ends]]
        if ((ids < 0) | (ids >= len(self.text_of))).any():
            raise IndexError("an id is not in the model")
        plain = not (self.is_control[first].any() or self.is_byte[first].any())
        if plain:
            places = ids.astype(np.int64)
            places[starts[starts < ends]] += len(self.text_of) * (self.prefix & self.is_normal[first])
            gathered = pc.take(self.flat, pa.array(places))
            data = gathered.buffers()[2]
            offsets = np.frombuffer(gathered.buffers()[1], np.int32)[np.concatenate(([0], ends))]
            try:
                str(memoryview(data) if data else b"", "utf-8")
            except UnicodeDecodeError:
                plain = False
        if plain:
            return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), data or pa.py_buffer(b""))
        return pa.array([self.decode(x) for x in np.split(ids, ends[:-1])], pa.string())


def _repaired(data: bytes) -> bytes:
    """Valid UTF-8 as it is, and U+FFFD for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode("utf-8").encode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


@cache
def model(file: str) -> Model:
    return Model(file)


def encode_pieces(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids, starts, ends)``: ids of the whole text and their spans in its UTF-8 bytes.

    No begin or end ids. Spans follow each other and cover the text; a piece that stands for nothing
    in the source, such as the space put before a text, is empty. Null and empty texts have no ids.
    One row per row, repeated and null ids included; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(file)
        for batch in chunks(batches):
            found = own.encode_all([t or "" for t in batch.column("text").to_pylist()])
            offsets = np.cumsum([0, *(len(ids) // 4 for ids, _ in found)]).astype(np.int32)
            ids = np.frombuffer(b"".join([ids for ids, _ in found]), "<i4")
            sizes = np.frombuffer(b"".join([sizes for _, sizes in found]), "<i4")
            total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            base = np.repeat(total[offsets[:-1]], np.diff(offsets))
            lists = [ids, (total[:-1] - base).astype(np.int32), (total[1:] - base).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in lists),
                ],
                names=["doc_id", "ids", "starts", "ends"],
            )

    rows = one_row_per(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>"
    )


def decode_pieces(encoded: DataFrame, file: str) -> DataFrame:
    """``(doc_id, ids, text)`` from ``(doc_id, ids)``: null and empty lists are the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(file)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                lists = some.column("ids")
                values = lists.flatten().to_numpy()
                ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), lists, own.decode_all(values, ends)],
                    names=["doc_id", "ids", "text"],
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, ids array<int>, text string"
    )
