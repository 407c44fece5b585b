"""The registered queries over whole tables: against SQL where there is some, else plain versions."""

import sys
import zlib
from pathlib import Path

import brute
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer, models

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle import TESTDATA, connect, differences  # noqa: E402

from fareloom.llm.counts import ranked_scores  # noqa: E402
from fareloom.llm.registry import BYTE_BPE, ENTRIES, PIECE_BPE  # noqa: E402

FOLDER = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rows(spark, name, *columns):
    return [tuple(r) for r in ENTRIES[name].build(spark, FOLDER).select(*columns).collect()]


@pytest.mark.parametrize("name", [name for name, entry in ENTRIES.items() if entry.sql])
def test_equals_sql(spark, name):
    assert differences(ENTRIES[name].build(spark, FOLDER), ENTRIES[name].sql, connect(FOLDER)) == []


def test_quality(spark, documents):
    found = rows(spark, "op1_quality_classifier", "doc_id", "held_out", "score", "predicted")
    assert sorted(f[0] for f in found) == sorted(documents)
    for key, held_out, score, predicted in found:
        assert held_out == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert 0 <= score <= 1 and predicted == int(score >= 0.7)


def test_token_counts(spark, documents):
    library = models.Unigram([("<unk>", -1e9), *ranked_scores(PIECE_BPE).items()], 0, False)
    expected = []
    for key, text in documents.items():
        words = [w.decode() for w in brute.words(text)]
        expected.append((key, len(words), sum(len(library.tokenize("▁" + w)) for w in words)))
    assert sorted(rows(spark, "op3_token_counts", "doc_id", "n_pretokens", "n_tokens")) == sorted(expected)


def test_packing(spark, documents):
    library, expected = Tokenizer.from_file(BYTE_BPE), []
    for key, text in documents.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        start, size = 0, len(ids) % 2048 or 2048
        while start < len(ids):
            expected.append((key, -(-start // 2048), start, size, zlib.crc32(ids[start : start + size].tobytes())))
            start, size = start + size, 2048
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(rows(spark, "op5_best_fit_packing", *columns)) == sorted(expected)


def test_neighbours(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in table])
    matrix = np.array([r["embedding"] for r in table], dtype=float)
    found = rows(spark, "op6_nearest_neighbours", "query_id", "rank", "vec_id", "score")
    hits = 0
    for query in ids[ids % 100 == 0]:
        apart = np.sqrt(((matrix - matrix[ids == query]) ** 2).sum(axis=1))
        apart[ids == query] = np.inf
        best = ids[np.lexsort((ids, apart))[:10]]
        own = sorted(f for f in found if f[0] == query)
        assert [f[1] for f in own] == list(range(1, 11))
        assert np.allclose([f[3] for f in own], [apart[ids == f[2]][0] for f in own], rtol=1e-12)
        hits += len(set(best) & {f[2] for f in own})
    assert hits >= 0.9 * len(found)


def test_near_duplicates(spark, documents):
    prints = {key: brute.fingerprint(text) for key, text in documents.items()}
    groups = brute.components(prints)
    expected = [(key, format(prints[key], "016x"), groups[key]) for key in documents]
    columns = ("doc_id", "fingerprint", "component_id")
    assert sorted(rows(spark, "op7_simhash_near_dedup", *columns)) == sorted(expected)


def test_pieces(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    expected = []
    for key, text in documents.items():
        ids = library.encode(text or "")
        expected.append((key, len(ids), brute.sha256(",".join(map(str, ids))), brute.sha256(library.decode(ids))))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(rows(spark, "op8_sentencepiece", *columns)) == sorted(expected)


def test_repeated_windows(spark, documents):
    expected = [
        (key, n, gone, brute.sha256(kept)) for key, (n, gone, kept) in brute.repeats(list(documents.items())).items()
    ]
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(rows(spark, "op9_substring_dedup", *columns)) == sorted(expected)
