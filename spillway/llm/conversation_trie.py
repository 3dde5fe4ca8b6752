"""Prefix trie of conversations: every distinct beginning, who shares it and what sharing saves.

Turns are reduced to 128-bit digests of (place, role, text) and a text length as
they are read; a prefix's digest is the exclusive-or of its turns' digests, so
prefixes of any length are chained by sums instead of by walks along a
conversation.  The trie is then built from fixed-length blocks:

1. Conversations are grouped by the digests of their successive blocks of
   `BLOCK` turns (the last one may be shorter): one row per distinct block.
2. Where a block has no sibling, its members agree on every turn of it: its
   turns are nodes as they stand.  Only where siblings diverge are turn
   boundaries refined, from one representative per distinct block.

A node belongs to its smallest member.  A conversation owns the nodes from some
depth (`start`) to its end, and shares `shared` text bytes with smaller ones; so
what a subtree saves is a sum over its members (of shared bytes), and what it
has of leaves is a count of members, both gathered block by block in the same way.
A hot conversation or a prefix that a third of all share is many rows of many
tasks: turns are numbered in ranges, and groups are pre-aggregated.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.llm.common import Workspace

BLOCK = 4        # turns in a block
STRIPE = 1024    # blocks of a conversation that one window chains
NOBODY = hashlib.sha256(b"").hexdigest()
# The rebuilding of conversations (values of the contract).
FAMILY = 5       # conversations c - c % FAMILY lend their first turns
LENT = 9         # fewer than so many turns are lent
_ID_SLICE_BITS = 16  # ids are listed in slices of so many bits


def number_turns(conversations: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, d1, d2, n_bytes) per turn, place from 0 by turn (null first), and (conv_id, n_turns) per conversation.

    Turns of one number are ordered by role and then by digest of role and text.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), F.xxhash64(role, text).alias("d1"),
        F.xxhash64(F.lit(7), role, text).alias("d2"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("tie"))
    order = [F.col("turn").asc_nulls_first(), "role", "d1", "d2", "tie"]
    # `part` depends on how this run cut the ranges: it is written down before it is used twice.
    placed = work.write(slim.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "placed")
    sizes = placed.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = sizes.select("part", "conv_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    local = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)) - 1
    turns = (placed.withColumn("local", local).join(bases, ["part", "conv_id"])
             .select("conv_id", (F.col("base") + F.col("local")).alias("place"), "d1", "d2", "n_bytes"))
    return turns, sizes.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))


def rebuild(turns: DataFrame, ids: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Conversation c as the first h turns of conversation c - c % 5 and then its own behind its first h; h = crc32(c) % 9."""
    lends = ids.select(F.col("conv_id").alias("lender"), F.col("n_turns").alias("n_lender"))
    # The remainder is never negative; below the least long there is no lender.
    plan = ids.select("conv_id", "n_turns", F.try_subtract("conv_id", F.pmod("conv_id", F.lit(FAMILY))).alias("lender"),
                      (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT).alias("h")).join(lends, "lender", "left")
    plan = work.write(plan.withColumn("lent", F.least("h", F.coalesce("n_lender", F.lit(0)))), "rebuilding")
    own = (turns.join(plan.select("conv_id", "h", "lent"), "conv_id").where("place >= h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("lent")).alias("place"), "d1", "d2", "n_bytes"))
    first = turns.where((F.col("place") < LENT) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "lender")
    lent = first.join(plan.select("conv_id", "lender", "h"), "lender").where("place < h").select("conv_id", "place", "d1", "d2", "n_bytes")
    lengths = plan.select("conv_id", (F.col("lent") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"))
    return own.unionByName(lent), lengths


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: u1, u2 (digest of the prefix before it), v1, v2 (with it), s0 (bytes before it), turns."""
    salted = turns.select("conv_id", "place", F.expr(f"place div {BLOCK}").alias("block"), F.expr(f"place div {BLOCK * STRIPE}").alias("stripe"),
                          F.xxhash64("place", "d1", "d2").alias("x1"), F.xxhash64(F.lit(11), "place", "d1", "d2").alias("x2"), "n_bytes")
    blocks = (salted.repartition("conv_id", "stripe").groupBy("conv_id", "stripe", "block")
              .agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("n_bytes").alias("n_bytes"),
                   F.sort_array(F.collect_list(F.struct("place", "x1", "x2", "n_bytes"))).alias("turns")))

    def chained(rows, keys, order):
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast("long")
        return (F.coalesce(F.bit_xor("x1").over(before), zero), F.coalesce(F.bit_xor("x2").over(before), zero),
                F.coalesce(F.sum("n_bytes").over(before), zero))

    totals = salted.groupBy("conv_id", "stripe").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("n_bytes").alias("n_bytes"))
    a1, a2, a3 = chained(totals, ["conv_id"], "stripe")  # one row per stripe
    stripes = totals.select("conv_id", "stripe", a1.alias("a1"), a2.alias("a2"), a3.alias("a3"))
    b1, b2, b3 = chained(blocks, ["conv_id", "stripe"], "block")
    inside = blocks.withColumns({"b1": b1, "b2": b2, "b3": b3}).join(stripes, ["conv_id", "stripe"])
    return (inside.withColumns({"u1": _xor("a1", "b1"), "u2": _xor("a2", "b2"), "s0": F.col("a3") + F.col("b3")})
            .select("conv_id", "block", "u1", "u2", _xor("u1", "x1").alias("v1"), _xor("u2", "x2").alias("v2"), "s0", "n_bytes", "turns"))


BLOCK_KEY = ["block", "u1", "u2", "v1", "v2"]
NODE_KEY = ["depth", "t1", "t2"]


def _turns_of(groups: DataFrame, *carried: str) -> DataFrame:
    """Every turn of every distinct block: its prefix (t1, t2), the prefix before it (p1, p2), bytes and bytes before it."""
    upto = F.slice("turns", 1, F.col("i") + 1)
    fold = lambda start, field: F.aggregate(upto, F.col(start), lambda acc, t: acc.bitwiseXOR(t[field]))
    seen = F.aggregate(upto, F.col("s0"), lambda acc, t: acc + t["n_bytes"])
    return (groups.select("*", F.posexplode("turns").alias("i", "turn"))
            .select((F.col("turn.place") + 1).alias("depth"), fold("u1", "x1").alias("t1"), fold("u2", "x2").alias("t2"),
                    F.col("turn.x1").alias("x1"), F.col("turn.x2").alias("x2"), F.col("turn.n_bytes").alias("n_bytes"), seen.alias("seen"), *carried)
            .select(*NODE_KEY, _xor("t1", "x1").alias("p1"), _xor("t2", "x2").alias("p2"), (F.col("seen") - F.col("n_bytes")).alias("s"), *carried))


def _nodes(blocks: DataFrame, ids: DataFrame, work: Workspace) -> DataFrame:
    """Every node: depth, digest, digest of its parent (p1, p2), bytes before its last text (s), conv_id (owner), n (members)."""
    groups = work.write(blocks.groupBy(*BLOCK_KEY).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first(F.struct("turns", "s0")).alias("head"))
        .select(*BLOCK_KEY, "n", "conv_id", "head.turns", "head.s0"), "groups")
    siblings = groups.groupBy("block", "u1", "u2").agg(F.count("*").alias("siblings"))
    marked = groups.join(siblings, ["block", "u1", "u2"])
    alone = _turns_of(marked.where("siblings = 1"), "conv_id", "n")
    refined = (_turns_of(marked.where("siblings > 1"), "conv_id", "n").groupBy(*NODE_KEY, "p1", "p2", "s")
               .agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n")))
    nobody, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).where("n > 0").select(
        zero.alias("depth"), zero.alias("t1"), zero.alias("t2"), nobody.alias("p1"), nobody.alias("p2"), zero.alias("s"), "conv_id", "n")
    return work.write(alone.unionByName(refined).unionByName(root), "nodes")


def _digest_ids(batches):
    """SHA-256 of each node's listed ids, from slices of the list in order; one digest is held at a time."""
    key, running = None, None

    def done():
        return pa.RecordBatch.from_pylist([{"depth": key[0], "t1": key[1], "t2": key[2], "ends_sha256": running.hexdigest()}])

    for batch in batches:
        out = []
        for depth, t1, t2, listed in zip(*(batch.column(c).to_pylist() for c in (*NODE_KEY, "listed")), strict=True):
            if key == (depth, t1, t2):
                running.update(b"," + listed.encode())
                continue
            if key is not None:
                out.append(done())
            key, running = (depth, t1, t2), hashlib.sha256(listed.encode())
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
    if key is not None:
        yield done()


def _ends(convs: DataFrame) -> DataFrame:
    """(depth, t1, t2, ends_sha256) of the shared nodes where conversations end."""
    ended = convs.where("deep >= n_turns").select(F.col("n_turns").alias("depth"), "t1", "t2", "conv_id",
                                                  F.shiftright("conv_id", _ID_SLICE_BITS).alias("slice"))
    listed = ended.groupBy(*NODE_KEY, "slice").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("listed"))
    return (listed.repartition(*NODE_KEY).sortWithinPartitions(*NODE_KEY, "slice").select(*NODE_KEY, "listed")
            .mapInArrow(_digest_ids, "depth long, t1 long, t2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, ids: DataFrame, work: Workspace) -> DataFrame:
    """One row per node of the trie of `turns` (see `number_turns`); `ids` has every conversation, turnless ones too.

    conv_id: smallest member; depth (0: the root); parent_conv_id (null at the
    root); n_convs; n_children; n_leaves (childless nodes of the subtree, itself
    included); saved_tokens: over the subtree, (n_convs - 1) times the bytes of
    a node's last text; ends_sha256: of the ids that end here, ascending and comma-joined.

    Repeated turns count as turns; equal conversations end at one node; without
    conversations there is no node, not even the root.
    """
    blocks = work.write(_blocks(turns), "blocks")
    ids = work.write(ids.select("conv_id", "n_turns"), "ids")
    nodes = _nodes(blocks, ids, work)

    first = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "p1", "p2", "s")).alias("first")).select(
        "conv_id", F.col("first.depth").alias("start"), "first.p1", "first.p2", F.col("first.s").alias("shared"))
    shared_nodes = nodes.where("n > 1")
    above = nodes.where("n > 1 or depth = 0").select((F.col("depth") + 1).alias("start"), F.col("t1").alias("p1"), F.col("t2").alias("p2"),
                                                     F.col("conv_id").alias("parent"))
    owners = work.write(first.join(above, ["start", "p1", "p2"], "left").select("conv_id", "start", "shared", "parent"), "owners")
    forks = owners.where("start > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("start") - 1).alias("depth")).agg(F.count("*").alias("forks"))

    whole = blocks.groupBy("conv_id").agg(F.sum("n_bytes").alias("all_bytes"), F.bit_xor(_xor("u1", "v1")).alias("t1"),
                                          F.bit_xor(_xor("u2", "v2")).alias("t2"))
    deepest = shared_nodes.groupBy("conv_id").agg(F.max("depth").alias("deepest"))
    zero = F.lit(0).cast("long")
    convs = work.write(
        ids.join(whole, "conv_id", "left").join(owners, "conv_id", "left").join(deepest, "conv_id", "left")
        .join(forks.withColumnRenamed("depth", "n_turns"), ["conv_id", "n_turns"], "left")
        .select("conv_id", "n_turns", "start", "parent", F.coalesce("shared", "all_bytes", zero).alias("shared"),
                F.coalesce("t1", zero).alias("t1"), F.coalesce("t2", zero).alias("t2"),
                (F.col("start").isNotNull() & F.col("forks").isNull()).cast("long").alias("leaf"),
                F.coalesce("deepest", F.col("start") - 1, "n_turns").alias("deep")), "convs")

    # Sums over members, for the blocks that hold shared nodes.
    members = blocks.join(convs.select("conv_id", "shared", "leaf", "deep"), "conv_id").where(F.col("block") * BLOCK < F.col("deep"))
    by_block = members.groupBy(*BLOCK_KEY).agg(F.sum("shared").alias("shared"), F.sum("leaf").alias("leaf"),
                                               F.first(F.struct("turns", "s0")).alias("head"))
    by_turn = (_turns_of(by_block.select(*BLOCK_KEY, "shared", "leaf", "head.turns", "head.s0"), "shared", "leaf")
               .groupBy(*NODE_KEY).agg(F.sum("shared").alias("sum_shared"), F.sum("leaf").alias("n_leaves")))
    at_root = convs.agg(F.sum("shared").alias("sum_shared"), F.sum("leaf").alias("n_leaves")).select(
        zero.alias("depth"), zero.alias("t1"), zero.alias("t2"), "sum_shared", "n_leaves")

    known = convs.select("conv_id", "n_turns", "start", "parent", "shared")
    parent = F.when(F.col("depth") > F.col("start"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id")
    deeper = (F.col("depth") < F.col("n_turns")).cast("long")
    alone = nodes.where("n = 1").join(known, "conv_id").select(
        "conv_id", "depth", parent, F.col("n").alias("n_convs"), deeper.alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"), F.when(F.col("depth") == F.col("n_turns"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
        .otherwise(F.lit(NOBODY)).alias("ends_sha256"))
    shared = (shared_nodes.join(by_turn.unionByName(at_root), NODE_KEY).join(_ends(convs), NODE_KEY, "left")
              .join(known, "conv_id").join(forks, ["conv_id", "depth"], "left")
              .select("conv_id", "depth", parent, F.col("n").alias("n_convs"), (F.coalesce("forks", zero) + deeper).alias("n_children"), "n_leaves",
                      (F.col("sum_shared") - F.col("shared") - (F.col("n") - 1) * F.col("s")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256")))
    return alone.unionByName(shared)


def trie_of(conversations: DataFrame, work: Workspace) -> DataFrame:
    """The prefix trie of a table (conv_id, turn, role, text), see `prefix_trie`.

    Rows without a conv_id belong to no conversation and are left out; a null
    turn comes first; null roles and texts are empty; texts are taken whole;
    other columns are not read; an empty table gives no rows.
    """
    turns, ids = number_turns(conversations, work)
    return prefix_trie(turns, ids, work)


def rebuilt_trie(conversations: DataFrame, work: Workspace) -> DataFrame:
    """As `trie_of`, of the conversations rebuilt by `rebuild`."""
    turns, ids = number_turns(conversations, work)
    return prefix_trie(*rebuild(turns, ids, work), work)
