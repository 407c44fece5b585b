"""The trie of conversation prefixes against a plain version."""

import hashlib
import random
import zlib

import pytest

from fareloom.llm.prefix_trie import SPAN, ordered_turns, prefix_trie, with_shared_heads
from fareloom.llm.registry import ENTRIES
from fareloom.session import written

COLUMNS = "conv_id bigint, turn bigint, role string, text string, conv int, name string, block int, own string"
FIELDS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2, None) for r in rows], COLUMNS)


def digest(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(b"%d:" % len(role) + role + text).hexdigest()[:32]


def plain_sequences(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    return {c: [t[3:] for t in sorted(own)] for c, own in turns.items()}


def rebuilt(turns):
    result = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        result[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return result


def plain_trie(sequences):
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    nodes = {k: [min(m), len(k), min(members[k[:-1]]) if k else None, len(m), 0, 0, 0] for k, m in members.items()}
    for k in sorted(nodes, key=len, reverse=True):
        own = nodes[k]
        own[5] += own[4] == 0
        own[6] += (own[3] - 1) * len(k[-1][1].encode()) if k else 0
        if k:
            above = nodes[k[:-1]]
            above[4] += 1
            above[5] += own[5]
            above[6] += own[6]
    ends = {k: ",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(k)) for k, m in members.items()}
    return sorted((*n, hashlib.sha256(ends[k].encode()).hexdigest()) for k, n in nodes.items())


def found(spark, rows, rebuild=True):
    turns = written(ordered_turns(frame(spark, rows)), "turns")
    sequences = with_shared_heads(turns) if rebuild else turns
    nodes = prefix_trie(sequences, turns.select("conv").distinct())
    assert tuple(nodes.columns) == FIELDS
    return sorted((tuple(r) for r in nodes.collect()), key=str)


def same(spark, rows, rebuild=True):
    sequences = plain_sequences(rows)
    expected = plain_trie(rebuilt(sequences) if rebuild else sequences)
    assert found(spark, rows, rebuild) == sorted(expected, key=str)


ODD = [
    (0, None, "user", "null comes first"), (0, 0, None, None), (0, 0, "", ""), (0, 0, "", ""),
    (0, 1, "a", "b"), (0, 1, "", "ab"), (0, 1, "ab", ""), (1, 5, "user", "naïve 世界"),
    (2, 5, "user", "naïve 世界"), (7, 1, "user", "no base"), (-3, 1, "user", "below zero"),
    (None, 1, "user", "no conversation"), (11, 1, "user", "x" * 100_000), (12, 1, "user", "x" * 100_000),
]


@pytest.mark.parametrize("rows", [[], ODD, ODD + ODD, [(None, 1, "a", "b")], [(6, 1, "a", "gone")]])
def test_odd_rows(spark, rows):
    same(spark, [r for r in rows if r[0] is None or r[0] >= 0])


def test_ids_below_zero_are_sequences_like_others(spark):
    same(spark, ODD, rebuild=False)


@pytest.mark.parametrize("length", [SPAN - 2, SPAN - 1, SPAN, SPAN + 1, 4 * SPAN, 9 * SPAN + 3])
def test_long_sequences_are_cut_and_grafted(spark, length):
    draw, rows = random.Random(length), []
    trunk = [("user", f"turn {i % 3}") for i in range(length)]
    for c in range(12):
        shared = draw.choice([0, 1, SPAN - 2, SPAN - 1, SPAN, length // 2, length - 1, length])
        own = trunk[:shared] + [("user", f"own {c} {i}" * draw.randrange(3)) for i in range(draw.randrange(4))]
        rows += [(c, i, *t) for i, t in enumerate(own)]
    rows += [(20, i, *t) for i, t in enumerate(trunk)]
    rows += [(21, i, *t) for i, t in enumerate(trunk)]
    same(spark, rows, rebuild=False)
    same(spark, rows)


def test_places_count_on_over_tasks(spark):
    """One conversation with nearly all rows, sorted in several tasks, among small ones."""
    rows = [(3, i, "user", f"t{i}") for i in range(3000)] + [(c, 1, "user", "x") for c in range(40)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else its few rows meet in one task
    try:
        turns = written(ordered_turns(frame(spark, rows).repartition(6)), "turns")
        places = sorted((r["conv"], r["pos"]) for r in turns.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    expected = [(3, i) for i in range(1, 3002)] + [(c, 1) for c in range(40) if c != 3]
    assert places == sorted(expected)


def test_many_equal_conversations(spark):
    same(spark, [(c, t, "user", f"same {t}") for c in range(400) for t in range(3)], rebuild=False)


def test_query_over_the_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    nodes = ENTRIES["op13_conversation_trie"].build(spark, folder)
    assert sorted(map(tuple, nodes.collect()), key=str) == sorted(plain_trie(rebuilt(plain_sequences(rows))), key=str)
