"""SimHash groups, near copies and repeated windows against plain versions."""

import itertools
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import TEXTS, prose, texts

from fareloom.llm import repeats, simhash
from fareloom.llm.automaton import seen_windows
from fareloom.llm.components import components
from fareloom.llm.repeats import mark_repeats
from fareloom.llm.simhash import BYTES, drop_near_duplicates, keys, links, near_duplicates, postings, tallied


def test_fingerprints_and_groups(spark):
    rows = [r for r in TEXTS if r[0] is not None]
    rows += [(100 + i, prose(i // 3, 400) + (" end" if i % 3 else "")) for i in range(12)]
    rows += [(200 + i, prose(1, 30)) for i in range(40)]
    found = near_duplicates(texts(spark, rows)).collect()
    prints = {key: brute.fingerprint(text) for key, text in rows}
    expected = brute.components(prints)
    assert sorted(r["doc_id"] for r in found) == sorted(key for key, _ in rows)
    for row in found:
        assert row["fp"] % 2**64 == prints[row["doc_id"]]
        assert row["component_id"] == expected[row["doc_id"]]


def test_null_ids_join_groups_and_never_name_them(spark):
    found = near_duplicates(texts(spark, [(None, "x"), (7, "x"), (None, "y z")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found if r["component_id"]) == [(0, 7), (7, 7)]
    assert [r["doc_id"] for r in found if r["component_id"] is None] == [None]


def test_empty_tables(spark):
    none = texts(spark, [])
    assert near_duplicates(none).collect() == []
    assert drop_near_duplicates(none).collect() == []
    assert mark_repeats(none).collect() == []


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_connect_what_all_pairs_connect(spark, bits):
    draw = random.Random(bits)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for start in list(prints)[:20]:
        for _ in range(8):
            start ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, bits + 1)))
            prints.add(start)
    hub = draw.getrandbits(64)  # one list of the index that is long enough to be looked up
    prints |= {hub ^ a for a in range(0, 600)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = components(links(spark.createDataFrame(signed, "fp bigint"), bits)).collect()
    roots = {r["node"]: r["root"] for r in found}
    expected = brute.components({s: s % 2**64 for (s,) in signed}, bits)
    assert {s: roots.get(s, s) for (s,) in signed} == expected


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 101 + i) for i in range(50)] + [(200, 200), (None, 3)]
    found = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(roots) == len(found) == 102
    assert all(roots[i] == 0 for i in range(51)) and all(roots[i] == 100 for i in range(100, 151))


def test_automaton_against_sets():
    draw = random.Random(5)
    for _ in range(500):
        window = draw.randint(1, 4)
        passages = [
            [draw.choice("ab") for _ in range(draw.randint(window, 9))] for _ in range(draw.randint(1, 6))
        ]
        seen, expected = set(), []
        for passage in passages:
            expected.append([])
            for i in range(len(passage) - window + 1):
                piece = tuple(passage[i : i + window])
                expected[-1].append(piece in seen)
                seen.add(piece)
        assert seen_windows(passages, window) == expected


def _repeating(seed):
    """Documents that share passages of many lengths, with a periodic one among them."""
    draw = random.Random(seed)
    passages = [prose(1000 + i, n, 10_000).split() for i, n in enumerate((19, 20, 21, 35, 60, 200))]
    rows = []
    for key in draw.sample(range(10_000), 60):
        words = []
        for _ in range(draw.randint(0, 6)):
            passage = draw.choice(passages)
            cut = draw.randint(0, len(passage) // 2)
            words += prose(draw.randrange(10**6), draw.randint(0, 30), 10_000).split()
            words += passage[cut : draw.randint(cut, len(passage))]
        rows.append((key, " ".join(words)))
    return rows + [(20_000, "x y " * 60), (20_001, "tail " + "x y " * 30), (20_002, "z " * 45)]


@pytest.mark.parametrize("most", [2, 200])
def test_repeats_against_sets(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_PASSAGES", most)
    rows = _repeating(most)
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in mark_repeats(texts(spark, rows)).collect()}
    assert found == brute.repeats(rows)
    assert sum(f[1] for f in found.values()) > 500


def test_repeats_of_odd_rows(spark):
    long = prose(3, 30, 10_000)
    rows = [*TEXTS, (50, long), (None, long), (51, "new " + long), (51, "new " + long), (51, "other")]
    marked = mark_repeats(texts(spark, rows), carry=("row", "start"))
    found = {(r["doc_id"], r["n_words"]): r for r in marked.collect()}
    assert marked.count() == len(rows)
    assert found[None, 30]["n_removed"] == 0  # null ids come first
    assert found[50, 30]["n_removed"] == 30 and found[50, 30]["kept"] == ""
    assert found[51, 31]["kept"] == "new" and found[51, 1]["kept"] == "other"
    assert found[9, 80_000]["n_removed"] == 80_000 - 2
    assert all(found[k, 0]["kept"] == "" for k in (1, 2, 3, None))
    assert found[4, 1]["carried"].asDict() == {"row": 1, "start": 3}


def test_one_row_of_each_group_stays(spark):
    base = prose(1, 300, 5000)
    rows = [
        *TEXTS, (10, base), (11, base + " end"), (12, base.upper()), (13, prose(2, 300, 5000)),
        (14, "short words here"), (15, "short words there"), (16, base), (16, "short words here"),
    ]
    kept = drop_near_duplicates(texts(spark, rows))
    assert kept.columns == texts(spark, []).columns
    groups = near_duplicates(texts(spark, rows)).collect()
    found = [r["doc_id"] for r in kept.collect()]
    expected = {g["component_id"] for g in groups}
    assert None not in expected or found.count(None) == sum(g["component_id"] is None for g in groups)
    assert sorted(f for f in found if f is not None) == sorted(e for e in expected if e is not None)
    assert {1, 4, 5, 8, 9, 10, 13, 14, 15} <= set(found) and not {2, 3, 6, 7, 12, 16} & set(found)


def test_repeated_rows_and_rows_without_ids_stay_once(spark):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "x y z"), (None, "x y z"), (4, None), (4, None)]
    found = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(texts(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted([(3, "a b c d"), (None, "x y z"), (4, None)], key=str)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_prints_in_reach_agree_in_a_key(bits):
    for gone in itertools.combinations(range(BYTES), bits):
        assert any(not set(gone) & set(key) for key in keys(bits))


def test_the_tally_keeps_pairs_with_the_least_count_only(monkeypatch):
    """Prints that agree in four bytes: most pairs are rejected before their bits are compared."""
    draw = random.Random(3)
    prints = [draw.getrandbits(32) << 32 | 0x01020304 for _ in range(60)]
    prints += [p ^ 1 << 40 for p in prints[:10]] + [p ^ 0xFF << 56 for p in prints[10:20]]
    left, right = tallied(np.array(prints, np.uint64), 2)
    kept = {tuple(sorted(p)) for p in zip(left.tolist(), right.tolist(), strict=True)}
    assert {(i, 60 + i) for i in range(20)} <= kept
    assert len(kept) < 40 and len(prints) * (len(prints) - 1) // 2 == 3160
    same = lambda a, b: sum(a >> 8 * i & 255 == b >> 8 * i & 255 for i in range(8))
    assert kept == {
        (i, j) for j in range(len(prints)) for i in range(j) if same(prints[i], prints[j]) >= 6
    }


@pytest.mark.parametrize("bits", [1, 2])
def test_long_lists_are_split_and_link_as_before(spark, monkeypatch, bits):
    monkeypatch.setattr(simhash, "LONG_LIST", 40)
    monkeypatch.setattr(simhash, "TALLIED", 8)
    draw = random.Random(bits)
    prints = {draw.getrandbits(32) << 32 for _ in range(100)} | {draw.getrandbits(16) << 16 for _ in range(100)}
    for start in list(prints):
        prints.add(start ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, bits))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    table = spark.createDataFrame(signed, "fp bigint")
    lists = postings(table, bits).groupBy("choice", "shared").count()
    assert lists.where("choice >= 6" if bits == 2 else "choice >= 4").count()
    roots = {r["node"]: r["root"] for r in components(links(table, bits)).collect()}
    expected = brute.components({s: s % 2**64 for (s,) in signed}, bits)
    assert {s: roots.get(s, s) for (s,) in signed} == expected


def test_words_lie_where_they_are_split(monkeypatch):
    rows = [t for _, t in TEXTS] + ["a", "", None, " b  c\x0bd\x1cx é y ", prose(1, 50)]
    found = repeats.Words(rows)
    expected = [(i, w) for i, t in enumerate(rows) for w in brute.words(t)]
    lie = [found.data[a:b] for a, b in zip(found.begin, found.end, strict=True)]
    assert list(zip(found.text_of.tolist(), lie, strict=True)) == expected
    by_word = {}
    for (_, word), h in zip(expected, found.hashes.tolist(), strict=True):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)
    monkeypatch.setattr(repeats, "_BLOCK", 7)
    repeats._powers.cache_clear()
    assert repeats.Words(rows).hashes.tolist() == found.hashes.tolist()
    repeats._powers.cache_clear()
    assert found.joined(0, 3) == b" ".join(w for _, w in expected[:3])


def test_many_identical_rows_are_one_document(spark):
    """Their work is that of one; each gets its result."""
    text = prose(8, 400, 10_000)
    rows = [(1, text)] * 3000 + [(2, "own " + text), (0, prose(9, 40, 10_000))]
    found = mark_repeats(texts(spark, rows)).groupBy("doc_id", "n_removed").count().collect()
    assert {tuple(r) for r in found} == {(1, 0, 3000), (2, 400, 1), (0, 0, 1)}
    anchors = repeats._all_anchors(repeats._once(texts(spark, rows).withColumn("row", F.xxhash64("doc_id", "text"))), 20)
    assert anchors.count() < 200


def test_first_occurrences_are_told_over_tasks(spark):
    """A shard that goes on over several tasks has one first occurrence."""
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(50)]), i, draw.randrange(9), s) for i, s in enumerate([0] * 600 + [1] * 5 + list(range(2, 80)) * 2)]
    table = spark.createDataFrame(
        [(d, r, s, shard.to_bytes(16, "big"), "x") for d, r, s, shard in rows],
        "doc_id bigint, row bigint, start int, shard binary, text string",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else its few rows meet in one task
    try:
        found = repeats._told_apart(table.repartition(5), "shard", "told").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    first = {}
    for d, r, s, shard in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])):
        first.setdefault(shard, r)
    assert len(found) == len(rows)
    assert {(r["row"], r["later"]) for r in found} == {(r, first[shard] != r) for _, r, _, shard in rows}


@pytest.mark.parametrize("most", [1, 3, 200])
def test_equal_passages_of_many_near_copies(spark, monkeypatch, most):
    """Copies with an edit each: their passages are equal but for those around the edit."""
    monkeypatch.setattr(repeats, "MOST_PASSAGES", most)
    base = prose(12, 240, 10_000).split()
    rows = [(None, " ".join(base[:100]))]
    for i in random.Random(1).sample(range(1000), 60):
        words = list(base)
        words[i * 7 % 240] = f"edit{i}"
        rows.append((i, " ".join(words)))
    expected = brute.repeats([(k if k is not None else -1, t) for k, t in rows])
    found = {
        (r["doc_id"] if r["doc_id"] is not None else -1): (r["n_words"], r["n_removed"], r["kept"])
        for r in mark_repeats(texts(spark, rows)).collect()
    }
    assert found == expected and sum(f[1] for f in found.values()) > 10_000
