"""Best-fit packing planned over the histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.tokens import token_pieces
from fareloom.session import written

#: Parts into which the pieces of one length are dealt for counting; the ranks do not depend on it.
PARTS = 512
#: Rows of a plan that are sent to every task, 40 bytes each; a longer plan meets its pieces by a shuffle.
SENT_SLOTS = 1 << 16


@dataclass(frozen=True)
class Slots:
    """Pieces of ``length`` with ranks from ``first`` on: one in each of ``number`` sequences."""

    length: int
    first: int
    number: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], most: int) -> list[Slots]:
    """Best fit, longest first, over counts: equal pieces and equally full sequences move together.

    ``open_at[room]`` lists runs of sequences with that room left. A length takes the fullest runs
    that still hold it, then new sequences. One step fills a whole run, so steps depend on the
    lengths that occur and not on how many pieces have them.
    """
    open_at: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    slots: list[Slots] = []
    sequences = 0

    def keep(room: int, first: int, number: int) -> None:
        if not room:
            return
        if room not in open_at:
            open_at[room] = []
            insort(rooms, room)
        open_at[room].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room], rooms[at]
            else:
                room, first = most, sequences
                number = -(-left // (most // length))
                sequences += number
            used = min(number, left)
            if used < number:
                keep(room, first + used, number - used)
            slots.append(Slots(length, rank, used, first, most - room))
            keep(room - length, first, used)
            rank, left = rank + used, left - used
    return slots


def ranked(pieces: DataFrame) -> DataFrame:
    """The pieces with their rank within their length, counted from 0 in many tasks.

    Pieces of a length are dealt into ``PARTS`` by their values; ranks within a part follow from
    sorting it, and a part's start is the sum of the counts before it. A length that most pieces
    share is thus numbered by as many tasks as there are parts.
    """
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PARTS)).cast("int")
    dealt = pieces.withColumn("part", part)
    counts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from")),
        "rank-starts",
    )
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (
        dealt.withColumn("row", F.row_number().over(inside) - 1)
        .join(starts, ["length", "part"])
        .withColumn("rank", F.col("from") + F.col("row"))
        .drop("part", "row", "from")
    )


def pack(pieces: DataFrame, most: int = 2048) -> DataFrame:
    """Give each piece of 1 to ``most`` tokens a place: the pieces with ``sequence_id, offset``.

    ``pieces`` are ``(doc_id, piece, start, length, ids_crc32)`` as :func:`token_pieces` gives them.
    Only the counts of the at most ``most`` lengths reach the driver. A plan has some slots a length,
    whatever the corpus, and never more than the square of ``most``. Pieces alike in all columns are
    interchangeable. No pieces, no rows.
    """
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    counts = pieces.groupBy("length").agg(F.count("*").alias("n"))
    slots = plan({row["length"]: row["n"] for row in counts.collect()}, most)
    table = spark.createDataFrame(
        [(s.length, s.first, s.number, s.sequence, s.offset) for s in slots],
        "slot_length bigint, first bigint, number bigint, sequence bigint, offset bigint",
    )
    inside = (
        (F.col("length") == F.col("slot_length"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("first") + F.col("number"))
    )
    table = F.broadcast(table) if len(slots) <= SENT_SLOTS else written(table, "slots")
    return ranked(pieces).join(table, inside).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
    )


def pack_documents(docs: DataFrame, tokenizer: str, most: int = 2048, **columns: str) -> DataFrame:
    """Tokenize whole texts, cut what is longer than a sequence, and pack all pieces.

    See :func:`token_pieces` for what null, empty and very long texts give.
    """
    return pack(token_pieces(docs, tokenizer, most, **columns), most)
