"""Packing, pieces and counts against the tokenizer libraries."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from samples import TEXTS, prose, texts
from tokenizers import Tokenizer, models

from fareloom.llm import tokens
from fareloom.llm.counts import Trie, ranked_scores, token_counts
from fareloom.llm.packing import pack, pack_documents, plan
from fareloom.llm.pieces import CharacterMap, Model, decode_pieces, encode_pieces
from fareloom.llm.tokens import encoder, token_pieces

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SCRAPS = ["a", "b'", "'s", "the", "ing", "1", "\n", " ", "  ", "\t", "\xa0", "é", "!", "世", "😀", "▁", "\x00", "<s>", "<|endoftext|>", " ", " x"]


def scraps(seed, times):
    draw = random.Random(seed)
    return ["".join(draw.choices(SCRAPS, k=draw.randint(0, 9))) for _ in range(times)]


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(BYTE_BPE), encoder(BYTE_BPE)
    for text in [*scraps(1, 4000), *(t for _, t in TEXTS if t), prose(1, 300)]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own([text])[0], "<u4").tolist() == expected, repr(text)
    many = [None, "", *scraps(9, 50), "a b", None]
    assert own(many) == [own([text])[0] for text in many]


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_every_slot_once(seed):
    draw = random.Random(seed)
    most = draw.choice([1, 10, 64, 2048])
    lengths = draw.sample(range(1, most + 1), draw.randint(1, min(most, 300)))
    histogram = {n: draw.randint(1, 500) for n in lengths}
    places: dict[int, list] = {}
    ranks: dict[int, list] = {n: [] for n in histogram}
    for slot in plan(histogram, most):
        for i in range(slot.number):
            places.setdefault(slot.sequence + i, []).append((slot.offset, slot.length))
            ranks[slot.length].append(slot.first + i)
    assert all(sorted(r) == list(range(histogram[n])) for n, r in ranks.items())
    assert sorted(places) == list(range(len(places)))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= most
    # best fit, longest first, needs at most 11/9 of the least number and one more
    assert len(places) <= 11 / 9 * max(1, sum(n * c for n, c in histogram.items()) / most) * 1.2 + 1


def test_plan_does_not_grow_with_the_counts():
    sizes = [len(plan({n: times * (n % 7 + 1) for n in range(1, 500)}, 512)) for times in (10**4, 10**9)]
    assert sizes[1] <= 1.1 * sizes[0] <= 10 * 500
    assert plan({}, 8) == []


def test_packing_of_documents(spark):
    rows = [*TEXTS, *((100 + i, prose(i, 50 * i)) for i in range(30))]
    found = pack_documents(texts(spark, rows), BYTE_BPE, most=256).collect()
    library, expected = Tokenizer.from_file(BYTE_BPE), []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        start, size = 0, len(ids) % 256 or 256
        while start < len(ids):
            part = struct.pack(f"<{size}I", *ids[start : start + size])
            expected.append((key or 0, -(-start // 256), start, size, zlib.crc32(part)))
            start, size = start + size, 256
    got = [(r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found]
    assert sorted(got) == sorted(expected)
    sequences: dict[int, list] = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 256
    assert len(sequences) <= 1.02 * sum(e[3] for e in expected) / 256 + 1


def test_packing_of_nothing_and_of_one_length(spark):
    assert pack_documents(texts(spark, []), BYTE_BPE).collect() == []
    same = [(i, "one") for i in range(500)]
    found = pack(token_pieces(texts(spark, same), BYTE_BPE, 8), 8).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 500
    assert {r["offset"] for r in found} == {0, 2, 4, 6} and len({r["sequence_id"] for r in found}) == 125


def test_pieces_equal_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE), Model(PIECE_BPE)
    long = "".join(random.Random(3).choices("abcdefgh世é▁ ", k=4000))
    for text in [*scraps(2, 6000), *(t for _, t in TEXTS if t), long, long.replace(" ", ""), prose(1, 300)]:
        ids, lengths = (np.frombuffer(x, "<i4") for x in own.encode(text))
        assert ids.tolist() == library.encode(text), repr(text[:50])
        assert own.decode(ids) == library.decode(ids.tolist()), repr(text[:50])
        assert lengths.sum() == len(text.encode()) and (lengths >= 0).all()


def test_decoding_of_any_ids_equals_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE), Model(PIECE_BPE)
    draw = random.Random(4)
    for _ in range(3000):
        ids = [draw.choice([3 + draw.randrange(256), draw.randrange(32_000), draw.randrange(3), 28705])
               for _ in range(draw.randint(0, 6))]
        assert own.decode(np.array(ids, dtype=int)) == library.decode(ids), ids
    with pytest.raises(IndexError):
        own.decode(np.array([32_000]))


def test_spans_name_the_bytes_of_each_piece(spark):
    own = Model(PIECE_BPE)
    for row in encode_pieces(texts(spark), PIECE_BPE).collect():
        sources = [t for k, t in TEXTS if k == row["doc_id"] and (k is not None or bool(t) == bool(row["ids"]))]
        data = (sources[0] or "").encode()
        assert row["starts"] == [0, *row["ends"]][: len(row["ids"])]
        assert (row["ends"] or [0])[-1] == len(data)
        if len(data) < 1000:
            for piece, a, b in zip(row["ids"], row["starts"], row["ends"], strict=True):
                text = own.text_of[piece]
                source = data[a:b].replace("▁".encode(), b" ")
                assert source in ((bytes([text]),) if isinstance(text, int) else (text, text[1:]))


def _compiled(pairs):
    """A character map with one-byte keys, laid out as double-array units."""
    texts, at = b"", {}
    for key, value in pairs.items():
        at[key] = len(texts)
        texts += value + b"\0"
    units = [0] * 1024
    units[0] = 256 << 10
    for i, key in enumerate(pairs):
        node = 256 ^ key[0]
        leaf = 768 + i
        units[node] = ((node ^ leaf) << 10) | 1 << 8 | key[0]
        units[leaf] = 0x80000000 | at[key]
    packed = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(packed)) + packed + texts


def test_character_map_keeps_the_source():
    mapped = CharacterMap(_compiled({b"A": b"a", b"#": b"", b"&": b"and", b"\t": b" "}))
    assert mapped.normalized("A&é#B\t") == [
        ("a", 1), ("a", 1), ("n", 0), ("d", 0), ("é", 3), ("B", 1), (" ", 1),
    ]
    assert mapped.normalized("#A") == [("a", 2)]
    assert CharacterMap(b"").normalized("é") == [("é", 2)]
    assert mapped.longest(b"AA", 1) == (1, b"a") and mapped.longest(b"zz", 0) is None


def test_round_trip_in_spark(spark):
    rows = decode_pieces(encode_pieces(texts(spark), PIECE_BPE), PIECE_BPE).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    got = sorted(((r["doc_id"] or 0, r["ids"], r["text"]) for r in rows))
    expected = sorted((k or 0, library.encode(t or ""), library.decode(library.encode(t or ""))) for k, t in TEXTS)
    assert got == expected
    assert encode_pieces(texts(spark, []), PIECE_BPE).collect() == []
    lists = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [r["text"] for r in decode_pieces(lists, PIECE_BPE).collect()] == ["", ""]


def test_counts_equal_the_library(spark):
    scores = ranked_scores(PIECE_BPE)
    library = models.Unigram([("<unk>", -1e9), *scores.items()], 0, False)
    rows = [(i, prose(i, 60) + " the thing and another") for i in range(20)]
    for row in token_counts(texts(spark, rows), PIECE_BPE).collect():
        text = rows[row["doc_id"]][1]
        assert row["n_pretokens"] == len(text.split())
        assert row["n_tokens"] == sum(len(library.tokenize("▁" + w)) for w in text.split())


def test_counts_of_odd_texts(spark):
    found = {(r["doc_id"], r["n_pretokens"]): r["n_tokens"] for r in token_counts(texts(spark), PIECE_BPE).collect()}
    assert found[1, 0] == found[2, 0] == found[3, 0] == 0
    assert found[9, 80_000] == 40_000 * (found_of("a") + found_of("b"))
    assert token_counts(texts(spark, []), PIECE_BPE).collect() == []


def found_of(word):
    return Trie(ranked_scores(PIECE_BPE)).count("▁" + word)


def test_trie_scores_a_shared_prefix_once():
    scores = {"a": -1.0, "b": -1.0, "ab": -1.5, "c": -2.0, "abc": -9.0}
    trie = Trie(scores)
    assert trie.count("abc") == 2 and trie.size == 3
    assert trie.count("abca") == 3 and trie.size == 4
    assert trie.count("ab") == 1 and trie.size == 4
    assert trie.count("é") == 2 and trie.count("") == 0
    assert Trie(scores, nodes=2).count("abc") == 2


def test_scores_of_any_unigram_model(spark):
    scores = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -3.2, "abab": -5.0, "ba": -6.0}
    library = models.Unigram([("<unk>", -1e9), *scores.items()], 0, False)
    rows = [(i, w) for i, w in enumerate(["a", "abab", "ababab", "bab bbb", "a ba ab", "", "aabbaabb " * 3])]
    for row in token_counts(texts(spark, rows), scores).collect():
        found = [w for w in rows[row["doc_id"]][1].split()]
        assert row["n_tokens"] == sum(len(library.tokenize("▁" + w)) for w in found)


def test_a_very_long_word_adds_no_more_nodes_than_allowed():
    scores = ranked_scores(PIECE_BPE)
    word = "".join(random.Random(2).choices("etaoinshr", k=1_000_000))
    trie = Trie(scores, nodes=1000)
    found = trie.count("▁" + word)
    assert trie.size == 1000
    library = models.Unigram([("<unk>", -1e9), *scores.items()], 0, False)
    assert trie.count("▁other") == len(library.tokenize("▁other")) and trie.size <= 1000
    part = word[:3000]
    assert Trie(scores, nodes=10).count("▁" + part) == len(library.tokenize("▁" + part))
    assert 100_000 < found < 1_000_000


def test_parts_that_are_forgotten_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "PARTS", 40)
    tokens.encoder.cache_clear()
    library, own = Tokenizer.from_file(BYTE_BPE), tokens.encoder(BYTE_BPE)
    for text in scraps(3, 600) + [" ".join(scraps(i, 30)) for i in range(60)]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own([text])[0], "<u4").tolist() == expected, repr(text)
    tokens.encoder.cache_clear()


@pytest.mark.parametrize("known", [True, False])
def test_new_parts_of_a_text_are_one_encoding(monkeypatch, known):
    """Unless the vocabulary does not tell where they begin: then each is encoded by itself."""
    library, sent = Tokenizer.from_file(BYTE_BPE), []

    class Counted:
        from_file = staticmethod(lambda path: Counted())
        encode = staticmethod(library.encode)
        get_vocab = staticmethod(lambda: library.get_vocab() if known else {"</w>": 60_000})

        def encode_batch_fast(self, texts, **settings):
            sent.extend(texts)
            return library.encode_batch_fast(texts, **settings)

    monkeypatch.setattr("tokenizers.Tokenizer", Counted)
    own = tokens.encoder.__wrapped__(BYTE_BPE)
    text = " ".join(["one", *(f"x{i},Ġy{i}<|endoftext|>'s" for i in range(300)), "\n", "", "end"])
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own([text])[0], dtype="<u4").tolist() == expected
    assert len(sent) == (3 if known else 304)
