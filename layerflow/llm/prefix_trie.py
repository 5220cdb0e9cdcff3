"""Prefix trie of rebuilt conversations.

Conversations are put in order by turn (null first; equal turns by a digest of role and text), null roles and texts are
empty. Conversation c then takes the first h turns of conversation c - c % 20 for its own first h (h = crc32 of c's
decimal text, modulo 4), so conversations share beginnings. Every distinct sequence of first turns is a node.

Plan. Role and text become a 16-byte digest in the JVM, so no text crosses a shuffle. Places in a conversation come from
one range shuffle by (conversation, turn, digest, row): tasks number their rows, and the conversation that a task
shares with the one before continues its count, so even one conversation of a third of all rows spreads over tasks.
Rebuilt conversations are cut into blocks of ``BLOCK`` turns and dealt by range of their first turns, so that equal
beginnings are neighbours and a common one spreads over several tasks. A task takes its blocks in shards of bounded
size. A shard has vertical bitmaps: for every (position, turn) the bitset of the conversations that have the turn there.
Depth first, a node's bitset (conversations as bits in ascending order of their ids) meets the postings of the turns
that follow: each meeting is a child, its popcount the child's members, its lowest bit the smallest; what is left of the
node's bitset ends there. Nodes that shards share are added up by their key, a digest of the path; their ends go by key and id,
in order, through one running SHA-256. A node that no other shard can know, by the order in which blocks were dealt, is
final with all below it. The others, the edges, are few: their sums over subtrees double the distance in each round (a
node's sum over the descendants within 2^k turns, plus that of its descendants at distance 2^k), blocks as wholes first,
so rounds grow with the logarithm of the depth.

Results for special input: rows with a null conversation id belong to no conversation; a conversation whose rebuilt
form has no turn ends at the root; null, empty and very long texts are turns like any other; repeated rows are turns
that repeat; an empty table has no node, not even a root; other columns are ignored. Negative ids take ``%`` as Spark
does (the sign of the id).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, map_batches, written

#: Turns of a block, and what a shard holds at most: blocks of conversations and their turns.
BLOCK = 1024
SHARD_BLOCKS = 4096
SHARD_TURNS = 1 << 16
#: Turns of a block's beginning by which blocks are dealt.
_DEALT_BY = 4
#: Copies of a node that several shards know, for its children to meet.
_SALTS = 32
EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- places

def turns_of(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(conv_id, turn, digest, words): digest of role and text, words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    return conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(f"[^{WHITE}]+")).cast("long").alias("words"))


def placed(turns: DataFrame) -> DataFrame:
    """(conv_id, place, digest, words): the place of every turn in its conversation, from 1. Equal rows are kept apart by a
    number of their own, so that a range shuffle can split any of them."""
    dealt = turns.withColumn("row", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last, at = None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            places = []
            for c in ids:
                at = at + 1 if c == last else 1
                last = c
                places.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([task] * len(ids), pa.int32()), pa.array(places, pa.int64()),
                 batch.column("digest"), batch.column("words")], names=["conv_id", "task", "place", "digest", "words"])

    in_order = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "words")
    own = written(map_batches(in_order, run, "conv_id long, task int, place long, digest binary, words long"), "trie-places")
    # Of each task only its first and last conversation can go on elsewhere: one row for each task reaches the driver.
    per_task = own.groupBy("task").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last"),
        F.max(F.struct("conv_id", "place")).getField("place").alias("n")).orderBy("task").collect()
    before, shifts = {}, []
    for r in per_task:
        if r["first"] in before:
            shifts.append((r["task"], r["first"], before[r["first"]]))
        before = {r["last"]: r["n"] + (before.get(r["last"], 0) if r["first"] == r["last"] else 0)}
    if not shifts:
        return own.drop("task")
    task, conv, shift = zip(*shifts)
    moved = own.sparkSession.createDataFrame(pa.table(
        [pa.array(task, pa.int32()), pa.array(conv, pa.int64()), pa.array(shift, pa.int64())], names=["task", "conv_id", "shift"]))
    return own.join(F.broadcast(moved), ["task", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"), "digest", "words")


def rebuilt(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, place, digest, words) of the rebuilt conversations, places from 1 without gaps; a conversation without a
    turn is one row with null place."""
    own = written(placed(turns), "trie-own")
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    base = F.col("conv_id") - F.col("conv_id") % family
    # Every conversation has a row of place 1. A family has as many conversations as ``family`` (twice, around zero).
    convs = own.filter("place = 1").select("conv_id", taken.alias("h"), base.alias("base"))
    first = own.filter((F.col("place") < heads) & (F.col("conv_id") % family == 0))
    lengths = first.groupBy(F.col("conv_id").alias("base")).agg(F.max("place").alias("n"))
    short = convs.filter("h > 0").join(lengths, "base", "left").select(
        "conv_id", (F.col("h") - F.least("h", F.coalesce("n", F.lit(0)))).alias("gap")).filter("gap > 0")
    rest = own.filter(F.col("place") > taken).join(short, "conv_id", "left").select(
        "conv_id", (F.col("place") - F.coalesce("gap", F.lit(0))).alias("place"), "digest", "words")
    taken_over = convs.filter("h > 0").join(first.withColumnRenamed("conv_id", "base"), "base").filter("place <= h").select(
        "conv_id", "place", "digest", "words")
    nothing = F.lit(None)
    return rest.unionByName(taken_over).unionByName(convs.select(
        "conv_id", nothing.cast("long").alias("place"), nothing.cast("binary").alias("digest"), nothing.cast("long").alias("words")))


def blocks_of(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, start, next, turns): blocks of at most ``block`` turns. ``start`` is the key of the node that the
    block begins under (empty: the root), ``next`` that of its last node if the block is full, and ``goes_on`` whether the
    conversation does."""
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "digest", "words"))
    cut = written(sequences.groupBy("conv_id", F.coalesce(F.floor((F.col("place") - 1) / block), F.lit(0)).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")), "trie-blocks")
    alone = (F.col("block") == 0) & (F.size("turns") < block)
    none = F.lit(None).cast("binary")
    short = cut.filter(alone).select("conv_id", "block", F.lit(b"").alias("start"), none.alias("next"), F.lit(False).alias("goes_on"), "turns")
    # The key of a block's start: order-free sums of hashes of (block, its turns), one row for ``block`` turns.
    path = F.concat_ws("", F.transform("turns", lambda t: F.hex(t["digest"])))
    in_order = Window.partitionBy("conv_id").orderBy("block")
    sums = [F.sum(F.xxhash64(F.lit(seed), F.col("block"), path).cast("decimal(20,0)")) for seed in (11, 12)]
    key = lambda rows, k: F.unhex(F.md5(F.concat_ws(":", k, *[s.over(in_order.rowsBetween(*rows)) for s in sums])))
    long = cut.filter(~alone).select(
        "conv_id", "block", F.when(F.col("block") == 0, F.lit(b"")).otherwise(key((Window.unboundedPreceding, -1), F.col("block"))).alias("start"),
        F.when(F.size("turns") == block, key((Window.unboundedPreceding, Window.currentRow), F.col("block") + 1)).alias("next"),
        F.lead("block").over(in_order).isNotNull().alias("goes_on"), "turns")
    return short.unionByName(long)


# ---------------------------------------------------------------- shards

Block = tuple[int, int, bytes, bytes | None, bool, list[tuple[bytes, int]]]


def _lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def shard_nodes(blocks: list[Block], size: int = BLOCK) -> Iterator[list]:
    """The nodes of a shard, fields as in ``NODES``; ``blocks`` stand in the order in which they were dealt.

    A node is ``edge`` if another shard may know it too: within the first ``_DEALT_BY`` turns, if it holds the shard's first or
    last block; below, if its ancestor there does. Edges are also the ends of full blocks, whose children are in other
    blocks, and all nodes above an edge. The other nodes are whole here: ``children``, ``leaves`` and ``saved`` are
    final. Those of an edge count the children that are no edges, with all below them. ``above`` holds the keys of an edge's
    ancestors at distances 1, 2, 4, … inside the block.
    """
    borders = {(b[0], b[1]) for b in (blocks[0], blocks[-1])}
    blocks = sorted(blocks, key=lambda b: b[0])
    postings: dict[tuple[int, bytes], int] = {}
    roots: dict[tuple[int, bytes], int] = {}
    border = 0
    for i, (conv, number, start, _, _, turns) in enumerate(blocks):
        bit = 1 << i
        border |= bit * ((conv, number) in borders)
        roots[number, start] = roots.get((number, start), 0) | bit
        for place, (turn, _) in enumerate(turns):
            postings[place, turn] = postings.get((place, turn), 0) | bit

    for (number, start), members in roots.items():
        # Depth first; a node is put down behind its parent: [depth, bits, key, words, parent's place, edge, ends, smallest].
        found: list[list] = []
        waiting = [(0, members, hashlib.blake2b(start, digest_size=16), start, 0, -1)]
        while waiting:
            depth, bits, path, key, words, parent = waiting.pop()
            here = len(found)
            edge = depth == size or (bits & border != 0 if depth <= _DEALT_BY else found[parent][5])
            smallest, rest, ends = blocks[_lowest(bits)][0], bits, []
            while rest:
                i = _lowest(rest)
                conv, _, _, last, goes_on, turns = blocks[i]
                if len(turns) == depth:
                    rest &= rest - 1
                    if not goes_on:
                        ends.append(conv)
                    continue
                turn, count = turns[depth]
                child = rest & postings[depth, turn]
                rest &= ~child
                below = path.copy()
                below.update(turn)
                waiting.append((depth + 1, child, below, last if depth + 1 == size else below.digest(), count, here))
            found.append([depth, bits, key, words, parent, edge, ends, smallest])

        for depth, _, _, _, parent, edge, _, _ in reversed(found):
            if edge and depth:
                found[parent][5] = True
        children, leaves, saved = ([0] * len(found) for _ in range(3))
        for i in range(len(found) - 1, -1, -1):
            depth, bits, _, words, parent, edge, _, _ = found[i]
            if not edge:
                leaves[i] = leaves[i] or 1
                saved[i] += (bits.bit_count() - 1) * words
                if depth:
                    children[parent] += 1
                    leaves[parent] += leaves[i]
                    saved[parent] += saved[i]
        way: list[bytes] = []
        for i, (depth, bits, key, words, parent, edge, ends, smallest) in enumerate(found):
            del way[depth:]
            way.append(key)
            if not depth and number:  # the end of the block before: known there but for its children
                yield [True, False, key, None, None, None, number * size, None, None, 0, None, children[i], leaves[i], saved[i], [], None]
                continue
            inside = 0 if number else 1  # whether the block's start is one of its nodes
            yield [
                edge, bool(depth) and (found[parent][5] or (depth == 1 and number > 0)), key, way[depth - 1] if depth else None,
                start if depth else None, [way[depth - (1 << k)] for k in range(depth.bit_length()) if (1 << k) < depth + inside] if edge else None,
                number * size + depth, smallest, found[parent][7] if depth else None, bits.bit_count(), words, children[i], leaves[i], saved[i],
                ends if edge else None, None if edge else hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()]


_ARROW = pa.schema([
    ("edge", pa.bool_()), ("under_edge", pa.bool_()), ("key", pa.binary()), ("parent", pa.binary()), ("start", pa.binary()),
    ("above", pa.list_(pa.binary())), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("words", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.list_(pa.int64())),
    ("ends_sha256", pa.string())])
NODES = (
    "edge boolean, under_edge boolean, key binary, parent binary, start binary, above array<binary>, depth long, conv_id long, "
    "parent_conv_id long, n_convs long, words long, children long, leaves long, saved long, ends array<long>, ends_sha256 string")


def sharded(blocks: DataFrame, size: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of every shard."""

    def out(shard: list[Block]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for row in shard_nodes(shard, size):
            rows.append(row)
            if len(rows) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[Block] = []
        turns = 0
        for batch in batches:
            for r in batch.to_pylist():
                own = [(t["digest"], t["words"]) for t in r["turns"]]
                if shard and (len(shard) == shard_blocks or turns + len(own) > shard_turns):
                    yield from out(shard)
                    shard, turns = [], 0
                shard.append((r["conv_id"], r["block"], r["start"], r["next"], r["goes_on"], own))
                turns += len(own)
        if shard:
            yield from out(shard)

    order = ["block", "start", *(F.get("turns", i)["digest"] for i in range(_DEALT_BY)), "conv_id"]
    return map_batches(blocks.repartitionByRange(*order).sortWithinPartitions(*order), run, NODES)


# ---------------------------------------------------------------- nodes of all shards

def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, id): SHA-256 of a key's ids in ascending order, read as a stream that Spark sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, done = None, None, []
        for batch in batches:
            for key, i in zip(batch.column("key").to_pylist(), batch.column("id").to_pylist()):
                if state is None or key != last:
                    if state is not None:
                        done.append((last, state.hexdigest()))
                    last, state = key, hashlib.sha256(str(i).encode())
                else:
                    state.update(b",%d" % i)
            if len(done) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "ends_sha256"])
                done = []
        if state is not None:
            done.append((last, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "ends_sha256"])

    return map_batches(ends.repartition("key").sortWithinPartitions("key", "id"), run, "key binary, ends_sha256 string")


def _with_below(nodes: DataFrame, up: Column, values: tuple[str, ...]) -> DataFrame:
    """``nodes`` with the values of the nodes whose ``up`` is their key added to their own."""
    below = nodes.filter(up.isNotNull()).groupBy(up.alias("key")).agg(*[F.sum(v).alias(f"{v}_below") for v in values])
    return nodes.join(below, "key", "left").select(
        *[c for c in nodes.columns if c not in values],
        *[(F.col(v) + F.coalesce(f"{v}_below", F.lit(0))).alias(v) for v in values])


def _whole_below(nodes: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """(key, values) of the nodes at the ends of full blocks: sums over all blocks below them. One row for a full
    block; the distance doubles in each round."""
    own = nodes.filter("start is not null").groupBy(F.col("start").alias("key")).agg(*[F.sum(v).alias(v) for v in values])
    now = written(own.filter(F.length("key") > 0).join(nodes.select("key", F.col("start").alias("up")), "key").select(
        "key", F.when(F.length("up") > 0, F.col("up")).alias("up"), *values), "trie-wholes")
    while not now.filter("up is not null").isEmpty():
        further = now.select(F.col("key").alias("up"), F.col("up").alias("next"))
        now = written(_with_below(now, F.col("up"), values).join(further, "up", "left").select(
            "key", F.col("next").alias("up"), *values), "trie-wholes")
    return now.drop("up")


def trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    size: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    turns = written(turns_of(conversations, id_col, turn_col, role_col, text_col), "trie-turns")
    parts = written(sharded(blocks_of(rebuilt(turns), size), size, shard_blocks, shard_turns), "trie-shards")
    edges = written(_edges(parts.filter("edge"), size), "trie-edges")
    # Under an edge, the parent's smallest member may be in another shard. Children of one edge are dealt over its copies.
    copies = edges.select(
        F.col("key").alias("parent"), F.col("conv_id").alias("least"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = parts.filter("not edge").select(
        "key", "parent", "under_edge", "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")
    under = whole.filter("under_edge").drop("under_edge", "parent_conv_id").unionByName(edges.select(
        "key", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")).withColumn(
        "salt", F.pmod(F.xxhash64("key"), F.lit(_SALTS)).cast("int")).join(copies, ["parent", "salt"], "left").withColumnRenamed(
        "least", "parent_conv_id")
    return whole.filter("not under_edge").select(*columns).unionByName(under.select(*columns))


def _edges(parts: DataFrame, size: int) -> DataFrame:
    """The nodes that shards share, added up, with sums over their whole subtrees."""
    merged = written(parts.groupBy("key").agg(
        *[F.any_value(c, True).alias(c) for c in ("parent", "start", "above", "depth", "words")],
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]), "trie-merged")
    of_edges = merged.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("more"))
    ended = ends_digest(parts.filter(F.size("ends") > 0).select("key", F.explode("ends").alias("id")))
    values = ("n_leaves", "saved_tokens")
    n_children = F.col("children") + F.coalesce("more", F.lit(0))
    now = written(merged.join(of_edges, "key", "left").join(ended, "key", "left").select(
        "key", "parent", "start", "above", "depth", "conv_id", "n_convs", n_children.alias("n_children"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        (F.when(n_children == 0, 1).otherwise(0) + F.col("leaves")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words") + F.col("saved")).alias("saved_tokens")), "trie-sums")
    deepest, rounds = now.agg(F.max("depth"), F.max(F.size("above"))).first()
    if (deepest or 0) > size:
        below = _whole_below(now, values).select("key", *[F.col(v).alias(f"{v}_below") for v in values])
        now = written(now.join(below, "key", "left").select(
            *[c for c in now.columns if c not in values],
            *[(F.col(v) + F.coalesce(f"{v}_below", F.lit(0))).alias(v) for v in values]), "trie-sums")
    for k in range(rounds or 0):
        now = written(_with_below(now, F.get("above", k), values), "trie-sums")
    return now
