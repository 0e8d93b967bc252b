"""Conversation prefix trie by fixed-length block hashing.

Turns travel as digests of (role, text), never as texts.  ``BLOCK`` consecutive
turns of a conversation form a block, a block's digest is that of its turns'
digests, and the chain digest of a block stands for all blocks up to it (made
by prefix doubling: in each round a chain of w blocks takes in the w blocks
before it, so a conversation of any length needs a logarithmic number of
rounds and no task holds one whole).  Conversations are grouped by successive
chain digests first.  Only where blocks with the same chain before them differ
are their turns compared one by one; a block without siblings is a plain run
of turns, which all its conversations share.

Sums over subtrees are taken in two parts: within a block every node adds to
its at most ``BLOCK`` ancestors there, and between blocks the sums are passed up
by pointer doubling.  The ids of the conversations that end at a node are
joined in sorted pieces of ``PIECE`` ids, and the pieces of a node pass its
running SHA-256 one after another, so no node's list is ever in memory.

Edge cases: turns are ordered by turn number, null first, ties by the digest of
role and text, so repeated rows count as turns of their own; null role or text
is empty; empty and very long texts are texts like any other; rows without a
conversation id belong to no conversation and are left out; conversations
without turns are members of the root; an empty table has no members and so no
nodes; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored
from salescope.llm.ordered import numbered

#: Turns of a block.
BLOCK = 4
#: Ids of a piece of a list that is hashed.
PIECE = 256
ROOT = "root"


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns as (``conv``, ``_rank`` from 0, ``_n`` turns of the conversation, ``digest``, ``chars``)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.char_length(text).cast("long").alias("chars"))
    return numbered(stored(turns, "turns"), ["conv"], ["turn", "digest"], "turns-by-rank").drop("turn")


def _chained(blocks: DataFrame, last: int) -> DataFrame:
    """``blocks`` with ``to``, the chain digest up to each block, and ``from``, that of the block before it."""
    chain, width = blocks.select("conv", "block", F.sha2(F.array_join("turns.digest", ""), 256).alias("to")), 1
    while width < last + 1:
        before = chain.select("conv", (F.col("block") + width).alias("block"), F.col("to").alias("before"))
        chain = stored(chain.join(before, ["conv", "block"], "left")
                       .select("conv", "block", F.when(F.col("before").isNull(), F.col("to"))
                               .otherwise(F.sha2(F.concat("before", "to"), 256)).alias("to")), "chains")
        width *= 2
    before = chain.select("conv", (F.col("block") + 1).alias("block"), F.col("to").alias("from"))
    return (blocks.join(chain, ["conv", "block"]).join(before, ["conv", "block"], "left")
            .withColumn("from", F.coalesce("from", F.lit(ROOT))))


def _keys() -> Column:
    """Keys of the nodes of a block's turns: a full block's last turn has the chain digest, others one of their own."""
    return F.transform(F.sequence(F.lit(1), F.size("turns")), lambda k: F.when(k == BLOCK, F.col("to")).otherwise(
        F.sha2(F.concat(F.col("from"), F.lit("/"), F.array_join(F.slice("turns.digest", F.lit(1), k), "")), 256)))


def _nodes(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: ``key``, ``parent``, ``from``, ``line`` (keys within the block), ``depth``, ``n_convs``, ``conv``, ``chars``."""
    distinct = stored(blocks.groupBy("block", "from", "to", "turns")
                      .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")), "distinct-blocks")
    siblings = distinct.groupBy("from").agg(F.count(F.lit(1)).alias("siblings"))
    # Stored between the join and the grouping, so that a chain with very many blocks behind it is split by the skew rule.
    turns = stored(distinct.join(siblings, "from").withColumn("keys", _keys())
                   .select("block", "from", "n_convs", "conv", "siblings", "keys", F.posexplode("turns.chars").alias("at", "chars"))
                   .withColumn("line", F.slice("keys", F.lit(1), F.col("at") + 1)).drop("keys"), "block-turns")
    node = ["block", "from", "at", "line", "chars"]
    alone = turns.where("siblings = 1").select(*node, "n_convs", "conv")
    refined = (turns.where("siblings > 1").groupBy(*node)
               .agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv")))
    found = alone.unionByName(refined).select(
        F.element_at("line", -1).alias("key"),
        F.when(F.col("at") == 0, F.col("from")).otherwise(F.get("line", F.col("at") - 1)).alias("parent"),
        "from", "line", (F.col("block") * BLOCK + F.col("at") + 1).alias("depth"), "n_convs", "conv", "chars")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("from"),
        F.array(F.lit(ROOT)).alias("line"), F.lit(0).cast("long").alias("depth"), "n_convs", "conv",
        F.lit(0).cast("long").alias("chars"))
    return stored(found.unionByName(root), "nodes")


def _below(nodes: DataFrame, last: int) -> DataFrame:
    """For each node that a block starts from (``key``): ``leaves`` and ``saved`` of all nodes below it."""
    sums = (nodes.where(F.col("from").isNotNull()).groupBy(F.col("from").alias("key"))
            .agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")))
    sums = stored(sums.join(nodes.select("key", F.col("from").alias("up")), "key"), "block-sums")
    width = 1
    while width <= last:  # sums reach over ``width`` blocks, ``up`` is so many blocks further up
        add = (sums.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("key"))
               .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        up = sums.where(F.col("up").isNotNull()).select(F.col("key").alias("up"), F.col("up").alias("further"))
        sums = stored(sums.join(add, "key", "left").join(up, "up", "left").select(
            "key", *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")),
            F.col("further").alias("up")), "block-sums")
        width *= 2
    return sums.drop("up")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(``key``, ``ends_sha256``): SHA-256 of the decimal ids ``conv`` of each key, ascending, joined by commas."""
    ranked = numbered(stored(ends, "ends"), ["key"], ["conv"], "ends-by-rank")
    pieces = (ranked.groupBy("key", F.expr(f"_rank div {PIECE}").alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)],
                                             names=["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    return (pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
            .mapInArrow(run, "key string, ends_sha256 string"))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row a node of the trie of ``turns`` (``conv``, ``_rank`` without gaps, ``digest``, ``chars``).

    ``conversations`` (``conv``, distinct) names all members, with or without turns.
    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    blocks = stored(turns.groupBy("conv", F.expr(f"_rank div {BLOCK}").alias("block"))
                    .agg(F.sort_array(F.collect_list(F.struct("_rank", "digest", "chars"))).alias("turns"))
                    .withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"),
                                                                                 t["chars"].alias("chars")))), "blocks")
    last = blocks.agg(F.max("block")).first()[0] or 0
    blocks = stored(_chained(blocks, last), "chained-blocks")
    nodes = _nodes(blocks, conversations)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, "key", "left")
                   .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                   .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
                   .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "nodes-with-children")
    below = _below(nodes, last)
    subtree = (nodes.join(below.withColumnsRenamed({"leaves": "b_leaves", "saved": "b_saved"}), "key", "left")
               .select(F.explode("line").alias("key"), (F.col("leaf") + F.coalesce("b_leaves", F.lit(0))).alias("leaves"),
                       (F.col("saved") + F.coalesce("b_saved", F.lit(0))).alias("saved"))
               .groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    lasts = blocks.groupBy("conv").agg(F.max("block").alias("block"))
    ends = (conversations.join(blocks.join(lasts, ["conv", "block"])
                               .select("conv", F.element_at(_keys(), -1).alias("key")), "conv", "left")
            .select(F.coalesce("key", F.lit(ROOT)).alias("key"), "conv"))
    whole = stored(nodes.join(subtree, "key").join(ends_digest(ends), "key", "left"), "whole-nodes")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (whole.join(above, "parent", "left")
            .select(F.col("conv").alias("conv_id"), F.col("depth"), "parent_conv_id", "n_convs", "n_children",
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
