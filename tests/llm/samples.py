"""Small tables with the cases every operator must take."""

from __future__ import annotations

import random

#: (id, text): null, empty, blank, one word, copies, a repeated row, odd characters, and a long text.
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "The same words again, the same words again."),
    (6, "The same words again, the same words again."),
    (6, "The same words again, the same words again."),
    (7, "THE same\nwords  again, the same words again."),
    (8, "naïve café   世界 😀 \x00 <|endoftext|> ▁x"),
    (None, "a row without an id"),
    (None, None),
    (9, "a b " * 40_000),
]
CLASHING = "doc_id bigint, text string, row bigint, fp string, stats string, score int, start int"


def texts(spark, rows=TEXTS):
    """The texts with columns whose names operators use inside."""
    filled = [(key, text, 1, "x", None, 2, 3) for key, text in rows]
    return spark.createDataFrame(filled, CLASHING)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))
