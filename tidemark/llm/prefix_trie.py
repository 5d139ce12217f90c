"""Prefix trie of conversations by van Emde Boas recursion: all sub-tries of one height at a time, none in one task.

A trie of height 2h is an upper trie of height h and, below each of its nodes at full depth, a lower trie of height h.
So sequences are cut at half their height, equal upper halves get one name, the smallest id that has them, and stand
once in the upper trie, with the weight of all; lower halves go on below the node of that name. Both
halves are cut again in the next round, all tries of a height together, until every trie is one turn high and each of its
sequences is a node. Halves are compared by digests of blocks of 1, 2, 4, ... turns, made of the digests of their halves.
A round has as many rows as there are blocks, so all rounds together have about twice the turns.

Totals go up the same way: those of a lower trie are grafted onto the node that it hangs from, once per height.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import balanced_left_join

from .tables import Scratch, small_batches

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
#: Turns of a neighbour that a rebuilt conversation may open with, and conversations that share a neighbour.
OPENING, SHARING = 8, 5
#: Rows of a prefix from which on it counts as heavy, and ids joined in a row before they are hashed.
_HEAVY, _IDS = 256, 8192


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ordered(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, part, at, s, bytes) and parts (conv_id, part, first, before, n).

    The place of a turn in its conversation, from 0, is ``at - first + before``. ``s`` is the digest of role and text.
    Turns are sorted in ranges, so a conversation of any length is spread over many tasks.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")).where("conv_id is not null")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    # equal rows are told apart by a number, so that many of them need not share a range
    ranged = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order, "salt").sortWithinPartitions(*order)
    content = _digest(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    told = (F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    kept = scratch.keep(ranged.select("conv_id", *told, content.alias("s"), F.octet_length("text").cast("long").alias("bytes")))
    parts = kept.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return kept, scratch.keep(parts.withColumn("before", F.coalesce(before, F.lit(0))))


def opening(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from its neighbour: crc32 of its decimal id, modulo nine."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (OPENING + 1)


def rebuilt(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Symbols (c, b, dg, bytes) and lengths (c, n) of conversations that open with their neighbour's first turns.

    Conversation c takes the first ``opening(c)`` turns of c - c % 5, all if there are fewer, none if there is no such
    conversation, then its own turns behind as many of its own. Turns are in order of ``turn``, nulls first, then role
    and text. Null roles and texts are empty. Rows without conv_id belong to none.
    """
    rows, parts = ordered(turns, scratch)
    held = parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % SHARING
    convs = held.withColumn("h", opening(F.col("conv_id"))).withColumn("base", base)
    neighbour = held.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = convs.join(neighbour, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = scratch.keep(convs.select("conv_id", "base", "n", "h", "taken"))
    placed = rows.join(parts.join(convs, "conv_id").select("conv_id", "part", "first", "before", "h", "taken"), ["conv_id", "part"])
    placed = placed.withColumn("k", F.col("at") - F.col("first") + F.col("before"))
    placed = scratch.keep(placed.select("conv_id", "k", "h", "taken", "s", "bytes"))
    own = placed.where("k >= h").select(F.col("conv_id").alias("c"), (F.col("taken") + F.col("k") - F.col("h")).alias("b"), F.col("s").alias("dg"), "bytes")
    heads = placed.where((F.col("k") < OPENING) & (F.col("conv_id") % SHARING == 0)).select(F.col("conv_id").alias("base"), "k", "s", "bytes")
    heads = heads.join(convs.select("conv_id", "base", "h"), "base").where("k < h")
    symbols = own.unionByName(heads.select(F.col("conv_id").alias("c"), F.col("k").alias("b"), F.col("s").alias("dg"), "bytes"))
    lengths = convs.select(F.col("conv_id").alias("c"), (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return scratch.keep(symbols), scratch.keep(lengths)


def _blocks(symbols: DataFrame, rounds: int, scratch: Scratch) -> list[DataFrame]:
    """(c, b, dg) of the blocks of 2^k turns for every k up to ``rounds``; the last block of a sequence may be shorter."""
    out = [symbols.select("c", "b", "dg")]
    even = F.col("b") % 2 == 0
    for _ in range(rounds):
        halves = out[-1].groupBy("c", F.shiftright("b", 1).alias("up"))
        halves = halves.agg(F.max(F.when(even, F.col("dg"))).alias("l"), F.max(F.when(~even, F.col("dg"))).alias("r"))
        out.append(scratch.keep(halves.select("c", F.col("up").alias("b"), _digest(F.col("l"), F.coalesce("r", F.lit(b""))).alias("dg"))))
    return out


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids with one key, as text, comma-joined, some thousands at a time."""
    key, ids = None, []
    out: list[tuple] = []

    def flush():
        if ids:
            out.append((*key, ids[0], ",".join(map(str, ids)).encode()))
            ids.clear()

    def drained():
        columns = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["n", "dg", "first", "ids"])
        out.clear()
        return made

    for batch in batches:
        for n, dg, c in zip(*(column.to_pylist() for column in batch.columns)):
            if (n, dg) != key or len(ids) == _IDS:
                flush()
                key = (n, dg)
            ids.append(c)
        yield drained()
    flush()
    yield drained()


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest id and the digest of all ids of every key, whose runs come in order; one run is held at a time."""
    key, least, digest = None, None, None
    out: list[tuple] = []

    def drained():
        columns = list(zip(*out)) or [()] * 2
        made = pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], names=["q", "sha"])
        out.clear()
        return made

    for batch in batches:
        for n, dg, first, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if (n, dg) != key:
                if digest is not None:
                    out.append((least, digest.hexdigest()))
                key, least, digest = (n, dg), first, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        yield drained()
    if digest is not None:
        out.append((least, digest.hexdigest()))
    yield drained()


def _ends(whole: DataFrame) -> DataFrame:
    """(q, sha): for every distinct sequence, its smallest id and the digest of all its ids in order."""
    small_batches(whole.sparkSession)
    key = ["n", "dg"]
    ids = whole.select(*key, "c").repartitionByRange(*key, "c").sortWithinPartitions(*key, "c")
    runs = ids.mapInArrow(_joined_ids, "n long, dg binary, first long, ids binary")
    return runs.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_hashed_ids, "q long, sha string")


def _cut(tries: DataFrame, blocks: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """Sequences (t, a, c, m, w, q) of tries of height 2^(k+1) cut in half: those of all upper and lower tries.

    A row is one distinct sequence of the trie below node t at depth a: its smallest id, its turns, the conversations
    that have it, and the one that ends with it, if any.
    """
    h = 1 << k
    there = blocks.select("c", F.shiftleft("b", k).alias("a"), "dg")
    halves = scratch.keep(tries.join(there, ["c", "a"]).withColumn("key", F.struct("t", "a", "dg", F.least("m", F.lit(h)).alias("m"))))
    goes_on = F.col("m") > h
    upper = halves.groupBy("key").agg(
        F.min("c").alias("u"), F.sum("w").alias("w"), F.max(F.when(~goes_on, F.col("q"))).alias("q"), F.count_if(goes_on).alias("_n")
    )
    upper = scratch.keep(upper)
    lower = balanced_left_join(halves.where(goes_on), upper, "key", "u", F.lit(True), ["c"], _HEAVY)
    lower = lower.select(F.col("u").alias("t"), (F.col("a") + h).alias("a"), "c", (F.col("m") - h).alias("m"), "w", "q")
    return scratch.keep(upper.select("key.t", "key.a", F.col("u").alias("c"), "key.m", "w", "q").unionByName(lower))


_TOTALS = ("leaves", "saved")


def _summed(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(*(F.sum(x).alias(x) for x in _TOTALS))


def _below(tries: list[DataFrame], nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(t, a, leaves, saved) of all that lies below the root, and below every other node that has children.

    Going up, the totals of the lower tries of a height are grafted onto the nodes at which they hang and so
    give those of the tries twice as high. Going down again, a trie takes in what hangs from its deepest nodes.
    """
    links = [r.where(F.col("m") == 1 << k).select("t", "a", "c") for k, r in enumerate(tries[:-1])]
    of_height = [scratch.keep(_summed(nodes.select(F.col("parent").alias("t"), (F.col("depth") - 1).alias("a"), *_TOTALS), "t", "a"))]
    for k, link in enumerate(links):
        h = 1 << k
        hanging = of_height[k].select(F.col("t").alias("c"), (F.col("a") - h).alias("a"), *_TOTALS)
        grafted = link.where(F.col("a") % (2 * h) == 0).join(hanging, ["c", "a"]).select("t", "a", *_TOTALS)
        of_height.append(scratch.keep(_summed(of_height[k].where(F.col("a") % (2 * h) == 0).unionByName(grafted), "t", "a")))
    below = of_height[-1].limit(0)
    for k in range(len(links) - 1, -1, -1):
        h = 1 << k
        inside = F.col("a") % (2 * h) == h
        hanging = below.select(F.col("t").alias("c"), (F.col("a") - h).alias("a"), *_TOTALS)
        grafted = links[k].where(inside).join(hanging, ["c", "a"]).select("t", "a", *_TOTALS)
        below = below.unionByName(scratch.keep(_summed(of_height[k].where(inside).unionByName(grafted), "t", "a")))
    return of_height[-1], below


def trie(symbols: DataFrame, lengths: DataFrame, scratch: Scratch) -> DataFrame:
    """The nodes of the trie of all sequences; see :func:`conversation_trie` for the columns.

    ``symbols`` (c, b, dg, bytes) has the digest and size of turn b, from 0, of sequence c, ``lengths`` (c, n) the number
    of turns of every sequence, which may be zero.
    """
    whole = lengths.agg(F.max("n").alias("longest"), F.min("c").alias("least"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return lengths.sparkSession.createDataFrame([], NODE)
    rounds = max(0, whole["longest"] - 1).bit_length()
    blocks = _blocks(symbols, rounds, scratch)
    content = scratch.keep(lengths.join(blocks[-1].select("c", "dg"), "c", "left").withColumn("dg", F.coalesce("dg", F.lit(b""))))
    ends = scratch.keep(_ends(content))
    distinct = content.where("n > 0").groupBy("n", "dg").agg(F.min("c").alias("c"), F.count("*").alias("w"))
    root = F.lit(whole["least"]).cast("long")
    tries = [scratch.keep(distinct.select(root.alias("t"), F.lit(0).cast("long").alias("a"), "c", F.col("n").alias("m"), "w", F.col("c").alias("q")))]
    for k in range(rounds - 1, -1, -1):
        tries.insert(0, _cut(tries[0], blocks[k], k, scratch))

    children = tries[0].groupBy("t", "a").agg(F.count("*").alias("n_children")).toDF("c", "depth", "n_children")
    sizes = symbols.select("c", F.col("b").alias("a"), "bytes")
    nodes = tries[0].join(sizes, ["c", "a"]).select(F.col("t").alias("parent"), "c", (F.col("a") + 1).alias("depth"), "w", "q", "bytes")
    nodes = nodes.join(children, ["c", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = ((F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("w") - 1) * F.col("bytes")).alias("saved"))
    nodes = scratch.keep(nodes.select("parent", "c", "depth", "w", "q", "n_children", *own))
    at_root, below = _below(tries, nodes, scratch)

    nothing = hashlib.sha256(b"").hexdigest()
    hanging = below.select(F.col("t").alias("c"), F.col("a").alias("depth"), *(F.col(x).alias(f"{x}_below") for x in _TOTALS))
    told = nodes.join(hanging, ["c", "depth"], "left").join(ends, "q", "left")
    totals = [(F.col(x) + F.coalesce(f"{x}_below", F.lit(0))).alias(x) for x in _TOTALS]
    told = told.select("c", "depth", "parent", "w", "n_children", *totals, F.coalesce("sha", F.lit(nothing)).alias("sha"))
    turnless = content.where("n = 0").groupBy("n").agg(F.min("c").alias("q")).join(ends, "q", "left").first()
    total, first_turns = at_root.first(), nodes.where("depth = 1").count()
    top = (
        whole["least"], 0, None, whole["n"], first_turns, total["leaves"] if total else 1, total["saved"] if total else 0,
        turnless["sha"] if turnless else nothing,
    )
    names = [part.split()[0] for part in NODE.split(", ")]
    return lengths.sparkSession.createDataFrame([top], NODE).unionByName(told.toDF(*names))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations that :func:`rebuilt` makes of ``turns`` (conv_id, turn, role, text).

    A row is a node, that is a distinct sequence of first turns (role, text), the empty one included: ``conv_id``, the
    smallest conversation that begins with it; ``depth``, its turns; ``parent_conv_id``, the conv_id of the node one turn
    shorter, null at the root; ``n_convs``, conversations that begin with it; ``n_children``, nodes one turn longer;
    ``n_leaves``, nodes without a child in its subtree, itself included; ``saved_tokens``, the bytes of the last texts
    that are not stored again, over its subtree; ``ends_sha256``, the digest of the conversations that end here. Repeated
    rows are turns of their own. No conversations give no node. Other columns are not looked at.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    return trie(*rebuilt(turns, scratch), scratch)
