"""Token counts under a unigram model, by dynamic programming on a trie of pre-tokens."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Mapping, Sequence
from functools import cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame

from fareloom.llm.batches import Cache, chunks, one_row_per, words

SPACE = "▁"
#: How far below the worst piece a character scores that no piece covers.
UNKNOWN_PENALTY = 10.0
#: Trie nodes and counts that a worker keeps; the numbers change the time only.
NODES = 600_000
#: Characters from which on a word's scores are kept as plain numbers.
LONG_WORD = 1 << 12
COUNTS = 1_000_000


class Trie:
    """Pre-tokens by prefix: each node has its prefix's best score and the tokens it takes.

    The forward score of a prefix is the best, over the pieces it ends with, of the piece's score and
    the forward score of what is before it; it depends on the prefix alone, so pre-tokens with a
    common start share its nodes and nothing is computed twice. Of equal scores the longest last
    piece wins. A character that is no piece counts as its UTF-8 bytes.
    """

    def __init__(self, scores: dict[str, float], nodes: int = NODES):
        self.scores, self.nodes = scores, nodes
        lengths: dict[str, set[int]] = {}
        for piece in scores:
            lengths.setdefault(piece[-2:], set()).add(len(piece))
        #: By the last two characters, the lengths that pieces ending so have, the longest first.
        self.lengths = {end: sorted(own, reverse=True) for end, own in lengths.items()}
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.clear()

    def clear(self) -> None:
        self.root: dict = {}
        self.size = 0

    def count(self, token: str) -> int:
        """Insert a pre-token; the number of tokens at its end.

        A trie that is full starts anew with the next pre-token. One that gets full within a
        pre-token goes on with numbers alone, 16 bytes for each further character.
        """
        if self.size >= self.nodes:
            self.clear()
        best, taken = [0.0], [0]
        if len(token) > LONG_WORD:
            best, taken = array("d", best), array("q", taken)
        children = self.root
        for end in range(1, len(token) + 1):
            node = children.get(token[end - 1])
            if node is None:
                node = (*self._forward(token, end, best, taken), {})
                if self.size < self.nodes:
                    children[token[end - 1]] = node
                    self.size += 1
            best.append(node[0])
            taken.append(node[1])
            children = node[2]
        return taken[-1]

    def _forward(self, token: str, end: int, best: Sequence[float], taken: Sequence[int]) -> tuple[float, int]:
        score, count = None, 0
        for length in self.lengths.get(token[end - 2 : end], ()) if end > 1 else ():
            piece = self.scores.get(token[end - length : end]) if length <= end else None
            if piece is not None and (score is None or best[end - length] + piece > score):
                score, count = best[end - length] + piece, taken[end - length] + 1
        character = token[end - 1]
        single, tokens = self.scores.get(character), 1
        if single is None:
            single, tokens = self.unknown, len(character.encode("utf-8", "replace"))
        if score is None or best[end - 1] + single > score:
            score, count = best[end - 1] + single, taken[end - 1] + tokens
        return score, count


def ranked_scores(file: str) -> dict[str, float]:
    """Pieces of a SentencePiece model file with log probabilities in proportion to 1 / rank.

    The public files hold no unigram model. Their pieces are in the order in which merges were
    learnt, so the n-th ordinary piece is given Zipf's share; nothing is trained.
    """
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(file, "rb") as opened:
        spec.ParseFromString(opened.read())
    pieces = [p.piece for p in spec.pieces if p.type == 1]
    total = log(sum(1 / (n + 1) for n in range(len(pieces))))
    return {piece: -log(n + 1) - total for n, piece in enumerate(pieces)}


def _counter(scores: Mapping[str, float]) -> Cache:
    trie = Trie(scores)
    return Cache(lambda word: trie.count(SPACE + word.decode("utf-8")), COUNTS)


@cache
def _ranked_counter(file: str) -> Cache:
    return _counter(ranked_scores(file))


def token_counts(
    docs: DataFrame, scores: str | Mapping[str, float], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_pretokens, n_tokens)``: pre-tokens are words, each with a space sign before it.

    ``scores`` are the log probabilities of a unigram model's pieces, or a SentencePiece model file
    whose pieces :func:`ranked_scores` scores. Tasks keep the trie and its terminal counts between
    batches, with a file from task to task, so nothing is shuffled; both start anew at a fixed size,
    and a very long word adds no node beyond it. Null, empty and blank texts have no tokens. One row
    per row, repeated and null ids included; other columns are left out.
    """
    given = scores if isinstance(scores, str) else dict(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _ranked_counter(given) if isinstance(given, str) else _counter(given)
        for batch in chunks(batches):
            tokens = [words(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array([sum(map(counter.__getitem__, t)) for t in tokens], pa.int64()),
                ],
                names=["doc_id", "n_pretokens", "n_tokens"],
            )

    rows = one_row_per(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pretokens bigint, n_tokens bigint")
