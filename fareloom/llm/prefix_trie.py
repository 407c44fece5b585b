"""The trie of conversation prefixes, by cutting sequences at half their depth again and again.

No conversation and no node is ever gathered: a task sees up to ``SPAN`` neighbouring turns of a
conversation, the base case of the recursion. Above it every round halves the number of blocks.
Going down, :func:`_cut_names` names the prefixes at the cuts, so that upper tries and lower forests
are built at once, each lower forest under the name of the prefix it was cut from. Going up,
:func:`_later_totals` grafts the totals of lower forests onto what lies above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.places import in_order
from fareloom.session import written

#: Turns of a conversation that a task names at once: the height at which sequences are cut no more.
SPAN = 64
#: Bytes of joined ids that travel to the hash of a node at once, about.
PIECE_BYTES = 1 << 18


def _digest(text: Column) -> Column:
    """128 bits of SHA-256, as hexadecimal digits."""
    return F.left(F.sha2(text, 256), F.lit(32))


def _named(above: Column, below: Column) -> Column:
    return _digest(F.concat(above, F.lit(":"), below))


def ordered_turns(
    conversations: DataFrame,
    conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``(conv, pos, digest, size)``: turns with their place from 1, in order of ``turn``, null first.

    ``digest`` stands for role and text (null becomes empty), ``size`` counts the text's UTF-8 bytes.
    Turns that share a number are in order of their digests; repeated rows are turns of their own.
    Rows without a conversation belong to none and are left out.
    A conversation with any share of the rows is ordered in many tasks: see :func:`in_order`.
    """
    filled = {n: F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in (role, text)}
    told = F.concat(
        F.octet_length(filled[role]).cast("string"), F.lit(":"), filled[role], filled[text]
    )
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        _digest(told).alias("digest"), F.octet_length(filled[text]).cast("bigint").alias("size"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = in_order(rows, ["conv"], order, "ordered-turns")
    return placed.select("conv", "pos", "digest", "size")


def with_shared_heads(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt so that the ``family`` ids from a multiple of it on share a beginning.

    Conversation c becomes the first h turns of conversation ``c - c % family`` (fewer if it has
    fewer, none if it does not exist), then its own turns after its first h, with h the CRC-32 of the
    decimal c modulo ``most``. ``turns`` are as :func:`ordered_turns` gives them, and so is the result;
    a conversation may be left without any turn. ``turns`` are read four times: pass a written table.
    """
    lengths = written(turns.groupBy("conv").agg(F.max("pos").alias("n")), "lengths")
    head = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most)).cast("bigint")
    plan = lengths.select(
        "conv", (F.col("conv") - F.col("conv") % family).alias("base"), head.alias("head")
    )
    of_base = lengths.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    shared = F.least("head", F.coalesce("base_n", F.lit(0))).alias("shared")
    plan = written(plan.join(of_base, "base", "left").select("conv", "base", "head", shared), "heads")
    heads = (
        turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
        .join(plan, "base").where("pos <= shared").select("conv", "pos", "digest", "size")
    )
    own = turns.join(plan, "conv").where("pos > head")
    own = own.select("conv", (F.col("pos") - F.col("head") + F.col("shared")).alias("pos"), "digest", "size")
    return heads.unionByName(own)


def _in_blocks(rows: DataFrame, *columns: str) -> DataFrame:
    """``(conv, block, turns)``: up to ``SPAN`` neighbours in order, and the turn before and after.

    A turn's ``off`` is its place in the block; the neighbours beyond it have -1 and ``SPAN``.
    """
    block, off = F.floor(F.col("pos") / SPAN), F.col("pos") % SPAN
    at = lambda b, o: F.struct(b.cast("bigint").alias("block"), o.cast("int").alias("off"))
    places = F.array_compact(F.array(
        at(block, off),
        F.when((off == 0) & (block > 0), at(block - 1, F.lit(SPAN))),
        F.when(off == SPAN - 1, at(block + 1, F.lit(-1))),
    ))
    spread = rows.select("conv", F.explode(places).alias("place"), *columns)
    turn = F.struct(F.col("place.off").alias("off"), *columns)
    grouped = spread.groupBy("conv", F.col("place.block").alias("block")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    inside = lambda t: (t["off"] >= 0) & (t["off"] < SPAN)
    return grouped.where(F.exists("turns", inside)).withColumn("own", F.filter("turns", inside))


def _last_block(blocks: DataFrame) -> int:
    return blocks.agg(F.max("block")).first()[0] or 0


def _halves(blocks: DataFrame, *columns: str) -> DataFrame:
    """Neighbouring blocks as the left and right half of a block of twice the height."""
    side = lambda c, odd: F.min(F.when(F.col("block") % 2 == odd, F.col(c)))
    halves = blocks.groupBy("conv", F.shiftright("block", 1).alias("block")).agg(
        *(side(c, odd).alias(f"{name}_{c}") for c in columns for odd, name in ((0, "left"), (1, "right")))
    )
    return written(halves, "halves")


def _cut_names(blocks: DataFrame) -> DataFrame:
    """``(conv, block, start)``: the name of all that comes before a block, from the blocks' digests.

    Both halves of a taller block are named by the recursion above it: the left one lies under the
    same cut, the right one under that cut's name and the left half's digest.
    """
    if not _last_block(blocks):
        return blocks.select("conv", "block", F.lit("").alias("start"))
    halves = _halves(blocks, "digest")
    taller = halves.select(
        "conv", "block", _named(F.col("left_digest"), F.coalesce("right_digest", F.lit(""))).alias("digest")
    )
    above = _cut_names(taller)
    both = halves.join(above, ["conv", "block"]).select("conv", F.explode(F.array_compact(F.array(
        F.struct((F.col("block") * 2).alias("block"), F.col("start")),
        F.when(F.col("right_digest").isNotNull(), F.struct(
            (F.col("block") * 2 + 1).alias("block"),
            _named(F.col("start"), F.col("left_digest")).alias("start"),
        )),
    ))).alias("half"))
    return written(both.select("conv", "half.block", "half.start"), "cut-names")


def _later_totals(blocks: DataFrame) -> DataFrame:
    """``(conv, block, saved, leaves)``: the totals of all blocks after a block."""
    if not _last_block(blocks):
        return blocks.select("conv", "block", *(F.lit(0).cast("bigint").alias(c) for c in ("saved", "leaves")))
    halves = _halves(blocks, "saved", "leaves")
    right = {c: F.coalesce(f"right_{c}", F.lit(0)) for c in ("saved", "leaves")}
    above = _later_totals(
        halves.select("conv", "block", *((F.col(f"left_{c}") + right[c]).alias(c) for c in right))
    )
    both = halves.join(above, ["conv", "block"]).select("conv", F.explode(F.array(
        F.struct((F.col("block") * 2).alias("block"), *((F.col(c) + right[c]).alias(c) for c in right)),
        F.struct((F.col("block") * 2 + 1).alias("block"), *(F.col(c).alias(c) for c in right)),
    )).alias("half"))
    return written(both.select("conv", "half.*"), "later-totals")


def _tall(blocks: DataFrame) -> DataFrame:
    """Blocks of sequences that reach over their first one: only these need any cut."""
    return blocks.where((F.col("block") > 0) | (F.size("own") == SPAN))


def _member_nodes(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """``(conv, pos, name, size, last)``: the node of every prefix of every sequence, the root's too."""
    roots = members.select(
        "conv", F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("digest"),
        F.lit(0).cast("bigint").alias("size"),
    )
    blocks = written(_in_blocks(roots.unionByName(sequences), "digest", "size"), "turn-blocks")
    first = lambda n: F.array_join(F.slice(F.col("own.digest"), F.lit(1), n), ",")
    whole = _digest(first(F.size("own"))).alias("digest")
    starts = _cut_names(written(_tall(blocks).select("conv", "block", whole), "cut-blocks"))
    blocks = blocks.join(starts, ["conv", "block"], "left")
    start = F.coalesce("start", F.lit(""))
    follows = F.exists("turns", lambda t: t["off"] == SPAN)
    turn = lambda t, i: F.struct(
        (F.col("block") * SPAN + i).alias("pos"),
        _named(start, _digest(first(i + 1))).alias("name"),
        t["size"].alias("size"),
        ((i == F.size("own") - 1) & ~follows).alias("last"),
    )
    rows = blocks.select("conv", F.explode(F.transform("own", turn)).alias("turn"))
    return written(rows.select("conv", "turn.*"), "member-nodes")


def _ends(rows: DataFrame) -> DataFrame:
    """``(name, ends_sha256)`` of the ids of sequences that end at a node, in order, comma-joined.

    Ids are sorted by range and joined to pieces in many tasks; the one that hashes a node reads its
    pieces one after another and holds none.
    """
    kind = rows.schema["conv"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, held, size = None, None, [], 0
        for batch in batches:
            done: list[tuple] = []
            columns = (batch.column(c) for c in ("name", "conv", "shown"))
            for node, conv, shown in zip(*(c.to_pylist() for c in columns), strict=True):
                if held and (node != name or size > PIECE_BYTES):
                    done.append((name, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    name, first = node, conv
                held.append(shown)
                size += len(shown)
            if done:
                yield as_batch(done, batch.schema.field("conv").type)
            ids = batch.schema.field("conv").type
        if held:
            yield as_batch([(name, first, ",".join(held))], ids)

    def as_batch(done: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
        kinds = (pa.string(), ids, pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["name", "first", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for node, piece in zip(batch.column("name").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                if node != name:
                    if state:
                        done.append((name, state.hexdigest()))
                    name, state = node, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done, strict=True))), names=["name", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([state.hexdigest()])], names=["name", "ends"])

    ids = rows.where("last").select("name", "conv", F.col("conv").cast("string").alias("shown"))
    ids = ids.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
    pieces = ids.mapInArrow(pack, f"name string, first {kind}, piece string")
    pieces = pieces.repartition("name").sortWithinPartitions("name", "first")
    return written(pieces.mapInArrow(digest, "name string, ends string"), "ends")


def prefix_trie(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of ``sequences(conv, pos, digest, size)``, one row each.

    ``members(conv)`` lists every sequence once, those without a turn too; places count from 1 without
    gaps. A node is a distinct prefix of ``depth`` digests, the root the empty one. Columns:
    ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes below it, itself included),
    ``saved_tokens`` (over its subtree, each node's members but one times the size of its last turn)
    and ``ends_sha256`` (of the ids of members that end here). No members give no rows.

    Subtrees are summed through members. Each node is represented by its smallest member, so what a
    subtree holds once (a leaf) is the sum over its members of what they represent from there on, and
    what it holds for all members but one is the sum of what they do not represent. So totals are
    sums along sequences, block by block, and then sums by node, combined in every task.
    """
    rows = _member_nodes(sequences, members)
    nodes = rows.groupBy("name").agg(
        F.min("conv").alias("chosen"), F.sum((~F.col("last")).cast("int")).alias("going_on")
    )
    rows_of = rows.join(written(nodes, "nodes"), "name")
    mine = F.col("conv") == F.col("chosen")
    marked = rows_of.select(
        "conv", "pos", "name", "chosen", mine.cast("int").alias("mine"),
        F.when(mine, 0).otherwise(F.col("size")).alias("saved"),
        (mine & (F.col("going_on") == 0)).cast("bigint").alias("leaf"),
    )
    blocks = written(_in_blocks(marked, "name", "chosen", "mine", "saved", "leaf"), "node-blocks")
    total = lambda of, c: F.aggregate(of, F.lit(0).cast("bigint"), lambda s, t: s + t[c])
    own = F.col("own")
    totals = _tall(blocks).select("conv", "block", total(own, "saved").alias("saved"), total(own, "leaf").alias("leaves"))
    later = _later_totals(written(totals, "block-totals"))
    before = F.filter("turns", lambda t: t["off"] < 0)
    after = F.filter("turns", lambda t: t["off"] >= SPAN)
    turn = lambda t, i: F.struct(
        t["name"].alias("name"),
        (F.col("block") * SPAN + i).alias("depth"),
        F.when(i > 0, F.get(own, i - 1)["chosen"]).otherwise(F.get(before, F.lit(0))["chosen"]).alias("parent"),
        F.coalesce(F.get(own, i + 1)["mine"], F.get(after, F.lit(0))["mine"], F.lit(0)).alias("child"),
        (total(F.slice(own, i + 1, SPAN), "saved") + F.coalesce("saved", F.lit(0))).alias("saved"),
        (total(F.slice(own, i + 1, SPAN), "leaf") + F.coalesce("leaves", F.lit(0))).alias("leaves"),
    )
    counted = blocks.join(later, ["conv", "block"], "left").select(
        "conv", F.explode(F.transform("own", turn)).alias("turn")
    )
    found = counted.groupBy("turn.name").agg(
        F.min("conv").alias("conv_id"),
        F.min("turn.depth").alias("depth"),
        F.min("turn.parent").alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.sum("turn.child").alias("n_children"),
        F.sum("turn.leaves").alias("n_leaves"),
        F.sum("turn.saved").alias("saved_tokens"),
    )
    none = F.lit(hashlib.sha256(b"").hexdigest())
    ended = found.join(_ends(rows), "name", "left")
    return ended.drop("name").withColumn("ends_sha256", F.coalesce("ends", none)).drop("ends")
