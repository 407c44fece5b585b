"""A quality classifier: Gaussian kernel by random features, ridge scores, isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.batches import chunks, one_row_per
from fareloom.session import written

FEATURES = 300
FOLDS = 4
BINS = 4096

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_STOP = np.isin(_BYTES, np.frombuffer(b".,;:?'\"()-", np.uint8))
_OTHER = ~(_LETTER | _DIGIT | _BLANK | _STOP)
_LONE = re.compile(rb"(?<!\S)[^\sA-Za-z0-9\x80-\xff]+(?!\S)")


def statistics(text: str | None) -> list[float]:
    """Numbers about a whole text; all are finite, and those of an empty text are zeros."""
    data = (text or "").encode("utf-8", "replace")
    tokens = data.split()
    if not tokens:
        return [0.0] * 20
    n, words = len(data), len(tokens)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = int(counts[_LETTER].sum())
    shares = counts[counts > 0] / n
    lengths = np.fromiter(map(len, tokens), np.int64, words)
    distinct = set(tokens)
    lines = [line for line in data.split(b"\n") if line.strip()]
    ends = data.count(b". ") + data.count(b".\n") + data.endswith(b".")
    return [
        np.log1p(n),
        np.log1p(words),
        float(lengths.mean()),
        float(lengths.std()),
        float(lengths.max() ** 0.5),
        len(distinct) / words,
        len(distinct) / words**0.8,
        int(counts[_UPPER].sum()) / max(letters, 1),
        letters / n,
        int(counts[_DIGIT].sum()) / n,
        int(counts[_STOP].sum()) / words,
        min(int(counts[_OTHER].sum()) / words, 5.0),
        int(counts[128:].sum()) / n,
        float(-(shares * np.log(shares)).sum()),
        np.log1p(len(lines)),
        np.log1p(words / len(lines)),
        1 - len(set(lines)) / len(lines),
        min(len(_LONE.findall(data)) / words, 1.0),
        ends / words,
        float(np.abs(np.diff(lengths)).mean()) if words > 1 else 0.0,
    ]


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, stats)`` of every row, from whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(stats, pa.list_(pa.float64()))],
                names=["doc_id", "stats"],
            )

    rows = one_row_per(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, stats array<double>")


@dataclass(frozen=True)
class Classifier:
    """Means and widths of the statistics, the random directions, the weights and the calibration."""

    middle: np.ndarray
    width: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    scores: np.ndarray
    chances: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.middle) / self.width, -8, 8)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(stats), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.features(stats) @ self.weights, self.scores, self.chances)


def _stacked(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("stats").flatten().to_numpy()
    return values.reshape(batch.num_rows, -1)


def _isotonic(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the middle score and the label share of each block."""
    blocks: list[list[float]] = []
    for s, y, n in zip(scores, labels, counts, strict=True):
        blocks.append([s * n, y, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(
    labelled: DataFrame, ridge: float = 1e-5, bandwidth: float = 0.01, seed: int = 3
) -> Classifier | None:
    """Fit to ``(doc_id, stats, label)`` with labels from 0 to 1; None without any label.

    Every labelled row counts. Each partition sums the normal equations of its rows, one set per
    fold, and only those sums, whose size is fixed, meet. Each fold is scored by weights of the other
    folds, and these scores, counted in ``BINS`` bins, are calibrated.
    """
    rows = written(labelled.where("label IS NOT NULL").select(
        F.pmod(F.xxhash64("doc_id", "stats"), F.lit(FOLDS)).cast("int").alias("fold"), "stats", "label"
    ), "labelled")
    size = rows.select(F.size("stats")).first()
    if size is None:
        return None
    parts = [F.col("stats")[i] for i in range(size[0])]
    moments = rows.agg(*(f(p) for p in parts for f in (F.avg, F.stddev_pop))).first()
    middle, width = np.array(moments[::2]), np.array(moments[1::2])
    draw = np.random.default_rng(seed)
    blank = Classifier(
        middle, np.where(width > 1e-9, width, 1.0),
        draw.standard_normal((size[0], FEATURES)) * np.sqrt(2 * bandwidth),
        draw.uniform(0, 2 * np.pi, FEATURES), np.empty(0), np.empty(0), np.empty(0),
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z, y = blank.features(_stacked(batch)), batch.column("label").to_numpy()
            fold = batch.column("fold").to_numpy()
            for f in range(FOLDS):
                own = fold == f
                total[f, :, :-1] += z[own].T @ z[own]
                total[f, :, -1] += z[own].T @ y[own]
        flat = total.reshape(-1, FEATURES + 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat))), pa.array(list(flat), pa.list_(pa.float64()))],
            names=["line", "part"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column("part").flatten().to_numpy().reshape(batch.num_rows, -1)
            for line, value in zip(batch.column("line").to_pylist(), values, strict=True):
                lines[line] = lines.get(line, 0) + value
        if lines:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(lines), pa.int64()), pa.array(list(lines.values()), pa.list_(pa.float64()))],
                names=["line", "part"],
            )

    schema = "line bigint, part array<double>"
    summed = rows.mapInArrow(sums, schema).repartition("line").mapInArrow(added, schema)
    total = np.zeros((FOLDS * (FEATURES + 1), FEATURES + 2))
    for row in summed.toLocalIterator():
        total[row["line"]] = row["part"]
    total = total.reshape(FOLDS, FEATURES + 1, FEATURES + 2)

    def solve(equations: np.ndarray) -> np.ndarray:
        penalty = ridge * max(equations[-1, -2], 1.0) * np.eye(FEATURES + 1)
        penalty[-1, -1] = 1e-9
        return np.linalg.solve(equations[:, :-1] + penalty, equations[:, -1])

    whole = total.sum(axis=0)
    folds = [solve(whole - part) for part in total]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, fold = blank.features(_stacked(batch)), batch.column("fold").to_numpy()
            raw = np.einsum("ij,ij->i", z, np.stack(folds)[fold])
            place = np.clip((raw + 1) / 3, 0, 1) * (BINS - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.astype(np.int32)), pa.array(raw), batch.column("label")],
                names=["bin", "raw", "label"],
            )

    bins = rows.mapInArrow(binned, "bin int, raw double, label double").groupBy("bin").agg(
        F.avg("raw").alias("raw"), F.sum("label").alias("ones"), F.count("*").alias("n")
    ).orderBy("bin").toPandas()
    scores, chances = _isotonic(bins["raw"].to_numpy(), bins["ones"].to_numpy(), bins["n"].to_numpy())
    return Classifier(
        blank.middle, blank.width, blank.directions, blank.phases, solve(whole), scores, chances
    )


def _known(labels: DataFrame, learn_from, key: str, label: str) -> DataFrame:
    """One label per id to learn from, the mean of several."""
    value = F.col(f"`{label}`").cast("double").alias("label")
    known = labels.select(F.col(f"`{key}`").alias("doc_id"), value).where(learn_from)
    return known.groupBy("doc_id").agg(F.avg("label").alias("label"))


def score_quality(
    docs: DataFrame, labels: DataFrame, learn_from, key: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """``(doc_id, score)`` of every row: from 0 to 1, higher where label 1 is likelier.

    ``labels`` has ``key`` and ``label``; only ids that satisfy the condition ``learn_from`` on
    ``doc_id`` are learnt from. Several labels of an id count as their mean, null labels not at all.
    Nothing but the text is scored. Null and empty texts are scored like others, by their zeros. Null
    and repeated ids are scored row by row. Without any label all scores are 0.5.
    """
    stats = written(document_statistics(docs, key, text), "statistics")
    found = fit(stats.join(_known(labels, learn_from, key, label), "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = found.score(_stacked(batch)) if found else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(
    docs: DataFrame, labels: DataFrame, learn_from, least: float = 0.7, key: str = "doc_id",
    text: str = "text", label: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns as they are.

    Learns and scores as :func:`score_quality` does. Without any label every row stays.
    """
    stats = document_statistics(docs, key, text)
    found = fit(stats.join(_known(labels, learn_from, key, label), "doc_id"))
    if found is None:
        return docs

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(found.score(np.array([statistics(t) for t in texts]).reshape(len(texts), -1)))

    return docs.where(score(F.col(f"`{text}`")) >= least)
