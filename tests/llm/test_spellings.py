"""Spelling variants against plain counts and edits."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from samples import TEXTS, texts

from fareloom.llm import spellings
from fareloom.llm.spellings import Cell, grow, letter_counts, spelling_variants, visit, word_counts


def plain_counts(docs, letters=6, least=5, slips=199):
    total = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= letters and n >= least}


def edited(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, times=5):
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and edited(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def variants(spark, counts):
    table = spark.createDataFrame([(*c, 7, "x") for c in counts.items()], "word string, n bigint, cell int, letters string")
    found = spelling_variants(table)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()))


def made_words(seed, families, alphabet="abcdeé"):
    """Families of words one to three edits from a first one, so chains of forms come up."""
    draw, counts = random.Random(seed), {}
    for _ in range(families):
        word = "".join(draw.choice(alphabet) for _ in range(draw.randrange(6, 12)))
        n = draw.choice([5, 30, 200, 4000])
        for _ in range(draw.randrange(1, 7)):
            counts[word] = max(counts.get(word, 0), n)
            at, letter = draw.randrange(len(word)), draw.choice(alphabet)
            word = draw.choice([word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :], word[:at] + word[at + 1 :]])
            n = max(1, n // draw.choice([1, 2, 5, 6, 40]))
    return {w: n for w, n in counts.items() if w}


def test_counts_equal_plain_counts(spark):
    docs = [(k, ((t or "") + " Größe größe naïveté ÷×÷×÷× ΑΒΓΔΕΖΗ abcdef_abcdef ABCDEFg ") * 3) for k, t in TEXTS]
    docs += [(i, " ".join(f"word{chr(97 + j % 26) * 3}" for j in range(i))) for i in range(60)] + [(None, None)]
    for slips, least in ((None, 1), (3, 1), (199, 5)):
        found = word_counts(texts(spark, docs), 6, least, slips)
        assert {r["word"]: r["n"] for r in found.collect()} == plain_counts(docs, 6, least, slips)


@pytest.mark.parametrize("cell", [1 << 14, 40, 8])
def test_variants_equal_plain_variants(spark, monkeypatch, cell):
    monkeypatch.setattr(spellings, "CELL_WORDS", cell)
    counts = made_words(cell, 150)
    expected = plain_variants(counts)
    assert sum(r[1] is not None for r in expected) > 50 and any(r[1] != r[2] for r in expected if r[1])
    assert variants(spark, counts) == expected


@pytest.mark.parametrize("leaf", [1, 5, 48])
def test_a_cell_counts_the_words_near_others(monkeypatch, leaf):
    monkeypatch.setattr(spellings, "LEAF_WORDS", leaf)
    counts = made_words(11, 200, "abcdé")
    of = {size: sorted(w for w in counts if len(w) == size) for size in (7, 8, 9)}
    as_matrix = lambda words: np.array([list(w.encode("latin-1")) for w in words], np.uint8)
    cell = Cell(as_matrix(of[8]), np.array([counts[w] for w in of[8]]))
    for size in (7, 8, 9):
        number, first = cell.near(as_matrix(of[size]))
        for word, n, best in zip(of[size], number, first, strict=True):
            near = [x for x in of[8] if edited(word, x)]
            assert n == len(near)
            if near:
                assert cell.letters[best].tobytes().decode("latin-1") == min(near, key=lambda x: (-counts[x], x))
    assert sum(cell.near(as_matrix(of[8]))[0]) > 20


def test_cells_from_a_small_sample_hold_every_word(spark, monkeypatch):
    monkeypatch.setattr(spellings, "SAMPLE_WORDS", 60)
    monkeypatch.setattr(spellings, "CELL_WORDS", 30)
    counts = made_words(3, 250)
    assert variants(spark, counts) == plain_variants(counts)


def test_odd_words(spark):
    assert variants(spark, {}) == []
    ties = {"abcdef": 5, "abcdeg": 500, "abcdeh": 500, "zbcdef": 500, "abcdefg": 500}
    assert variants(spark, ties) == plain_variants(ties)
    long = {"a" * 3000: 100, "a" * 3001: 5, "a" * 2999 + "b": 20, "a" * 3008: 5, "a" * 2992: 1000, "b" * 300: 9}
    assert variants(spark, long) == plain_variants(long)
    others = spark.createDataFrame([(None, 5), ("", 5), ("not one", 5), ("abcdef", 5), ("abcdeg", 50)], "word string, n bigint")
    rows = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in spelling_variants(others).collect()}
    assert rows == {
        None: (None, None, 0), "": (None, "", 0), "not one": (None, "not one", 0),
        "abcdef": ("abcdeg", "abcdeg", 1), "abcdeg": (None, "abcdeg", 1),
    }


def test_a_long_chain_of_forms_and_a_form_of_many(spark):
    chain = {"abcdefghijkl"[: 6 + i]: 5 ** (i + 1) for i in range(7)}
    many = {"qqqqqqqqq"[:i] + c + "qqqqqqqqq"[i + 1 :]: 1 for i in range(9) for c in "abcdefghij"} | {"q" * 9: 100}
    rows = variants(spark, chain | many)
    assert rows == plain_variants(chain | many)
    assert max(r[4] for r in rows) == 90


def test_tree_visits_every_leaf_in_reach():
    draw = np.random.default_rng(5)
    counts = letter_counts(draw.choice(np.frombuffer(b"abcdefgh", np.uint8), (500, 9)))
    tree, leaves = grow(counts, 7)
    home = {int(row): leaf for leaf, rows in enumerate(leaves) for row in rows}
    assert sorted(home) == list(range(500)) and len(leaves) > 50
    searched = 0
    for radius in (0, 1, 2):
        seen = set()
        for leaf, rows in visit(tree, counts, radius, np.zeros(500, np.int64)):
            seen.update((int(r), leaf) for r in rows)
        apart = np.abs(counts[:, None] - counts[None]).sum(axis=2)
        assert {(a, home[b]) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(apart <= radius)), strict=True)} <= seen
        searched = len(seen)
    assert searched < 500 * len(leaves) / 2  # boxes are pruned
