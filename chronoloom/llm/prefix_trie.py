"""The prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with a list of those that
end there.  A sequence that is a proper prefix of another is no leaf: an
anti-join with the proper prefixes finds the leaves.  Each prefix of a distinct
sequence, weighted, is a row; grouped by prefix they are the nodes.

A prefix is named by its length and 128 bits: the exclusive or, over its turns,
of hashes of (place, digest of role and text).  It is a running total, so a long conversation is worked on in
blocks of turns.  Two different prefixes of one length share a name with
probability 2^-128.

Sums over subtrees need no ancestor lists.  A node belongs to the sequence that holds its smallest
member; the nodes of a sequence are then its own from some depth to its end, so
the sum below a node is the running sum from the end of its owner, plus the whole sums of
the other sequences that pass through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.llm.common import written

#: Turns of one conversation, and identifiers of one end list, that a task holds at a time.
BLOCK = 65_536
EMPTY = hashlib.sha256(b"").hexdigest()
NAME = ["depth", "a", "b"]


def numbered(rows: DataFrame, key: str, order: list[Column], name: str = "place") -> DataFrame:
    """Row numbers from 1 within a key: sorted over all tasks, so that a long group spreads over many."""
    every = [F.col(key), *order]
    ordered = written(rows.repartitionByRange(*every).sortWithinPartitions(*every), "ordered")
    # the rows of a file stay in their order
    rows = ordered.withColumn("_file", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")).withColumn(
        "_row", F.col("_metadata.row_index"))
    counts = rows.groupBy(key, "_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(key).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return rows.join(starts.select(key, "_file", "_first", "_start"), [key, "_file"]).withColumn(
        name, F.col("_start") + F.col("_row") - F.col("_first") + 1).drop("_file", "_row", "_first", "_start")


def running(rows: DataFrame, key: str, place: str, totals: dict[str, Column], agg: Callable[[Column], Column], merge: Callable[[Column, Column], Column],
            zero, backward: bool = False) -> DataFrame:
    """Running totals along a key, in blocks of places: within the block, and over the totals of the blocks before."""
    block = F.floor(F.col(place) / BLOCK)
    way = (lambda c: F.col(c).desc()) if backward else F.col
    inner = Window.partitionBy(key, "_block").orderBy(way(place)).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(key).orderBy(way("_block")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_block": block, **{f"_in_{n}": c for n, c in totals.items()}})
    blocks = rows.groupBy(key, "_block").agg(*[agg(F.col(f"_in_{n}")).alias(f"_all_{n}") for n in totals])
    blocks = blocks.select(key, "_block", *[F.coalesce(agg(F.col(f"_all_{n}")).over(outer), F.lit(zero)).alias(f"_before_{n}") for n in totals])
    rows = rows.withColumns({n: agg(F.col(f"_in_{n}")).over(inner) for n in totals}).join(blocks, [key, "_block"])
    return rows.withColumns({n: merge(F.col(n), F.col(f"_before_{n}")) for n in totals}).drop(
        "_block", *[f"_in_{n}" for n in totals], *[f"_before_{n}" for n in totals])


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_hash, bytes): the turns of each conversation in order."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = numbered(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    return written(ordered.select("conv_id", F.col("place").cast("long").alias("place"), digest.alias("turn_hash"), F.octet_length("text").alias("bytes")), "turns")


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, place, turn_hash, bytes): the first h turns of the group's first conversation, then the own turns after h."""
    conv = turns.where("place = 1").select("conv_id").withColumns({
        "first": F.col("conv_id") - F.col("conv_id") % group, "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads})
    opening = turns.where(F.col("place") < heads).withColumnRenamed("conv_id", "first")
    # at most heads - 1 turns of a conversation are given to at most 2 * group - 1 others
    taken = conv.join(opening, "first").where("place <= h").select("conv_id", "place", "turn_hash", "bytes")
    there = opening.groupBy("first").agg(F.max("place").alias("there"))
    shift = conv.join(there, "first", "left").select("conv_id", "h", (F.least("h", F.coalesce("there", F.lit(0))) - F.col("h")).alias("shift"))
    own = turns.join(shift, "conv_id").where("place > h").select("conv_id", (F.col("place") + F.col("shift")).alias("place"), "turn_hash", "bytes")
    return taken.unionByName(own)


def end_lists(members: DataFrame) -> DataFrame:
    """sha256 of the ascending, comma-joined conv_ids that end in each sequence.

    Ids meet in blocks of BLOCK successive numbers; one task then reads the
    blocks of a sequence in order and feeds them to the digest, which by its
    definition takes them one after the other.  It holds one Arrow batch of blocks.
    """
    block = F.floor(F.col("conv_id") / BLOCK)
    joined = members.groupBy(*NAME, block.alias("block")).agg(F.concat_ws(",", F.sort_array(F.collect_list("conv_id"))).alias("ids"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest, done = None, None, []

        def out():
            rows = done.copy()
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*[n for n, _ in rows]))] + [pa.array([d for _, d in rows])],
                                              [*NAME, "ends_sha256"])

        for part in parts:
            for own, ids in zip(zip(*[part.column(c).to_pylist() for c in NAME]), part.column("ids")):
                if own != name:
                    if digest:
                        done.append((name, digest.hexdigest()))
                        if len(done) >= 4_096:
                            yield out()
                    name, digest = own, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_buffer() or b"")
        if digest:
            done.append((name, digest.hexdigest()))
        if done:
            yield out()

    return joined.repartition(*NAME).sortWithinPartitions(*NAME, "block").select(*NAME, "ids").mapInArrow(
        batches, "depth long, a long, b long, ends_sha256 string")


def trie(conversations: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by turn (null first), then role and text; repeated rows are turns of
    their own.  Null roles and texts are empty.  Rows without conv_id belong to no
    conversation.  A text may be of any length: only its digest and size are kept
    after the first sort.  Further columns are left out.  An empty table has no
    conversation and gives no node, not even the root.
    """
    turns = turns_of(conversations)
    rows = written(running(
        rebuilt(turns, group, heads).withColumnRenamed("place", "depth"), "conv_id", "depth",
        {n: F.xxhash64(F.lit(seed), "depth", "turn_hash") for n, seed in (("a", 1), ("b", 2))},
        F.bit_xor, lambda x, y: x.bitwiseXOR(y), 0).select("conv_id", "depth", "a", "b", "bytes"), "prefixes")
    # whole sequences: the last prefix of every conversation; one without turns ends at the root
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("depth", "a", "b"), "depth").alias("end"))
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in NAME])
    members = written(turns.where("place = 1").select("conv_id").join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("end", none).alias("end")).select("conv_id", "end.*"), "members")
    sequences = members.groupBy(*NAME).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"))

    # the prefixes of each distinct sequence, the root first
    named = sequences.select("conv_id", "weight", F.col("depth").alias("length"))
    inner = rows.join(named, "conv_id").select("conv_id", "weight", "length", *NAME, "bytes")
    roots = named.select("conv_id", "weight", "length", *[F.lit(0).cast("long").alias(c) for c in NAME], F.lit(0).alias("bytes"))
    paths = written(inner.unionByName(roots), "paths")
    proper = paths.where("depth < length").select(*NAME)
    leaves = sequences.join(proper, NAME, "left_anti").select("conv_id", F.lit(1).alias("leaf"))

    # a node's parent is named by the row before it on any of its sequences: take the hashes back off
    step = rows.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"))
    nodes = written(paths.join(leaves, "conv_id", "left").groupBy(*NAME).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.max("bytes").cast("long").alias("bytes")).join(step, ["conv_id", "depth"], "left").withColumns({
            "up_a": F.coalesce("up_a", F.lit(0)), "up_b": F.coalesce("up_b", F.lit(0)), "worth": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")

    below = running(nodes.select("conv_id", "depth", "worth"), "conv_id", "depth", {"own": F.col("worth")}, F.sum, lambda x, y: x + y, 0, backward=True)
    whole = nodes.groupBy("conv_id").agg(F.sum("worth").alias("whole"))
    through = paths.join(whole, "conv_id").groupBy(*NAME).agg(F.sum("whole").alias("through"))
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(below.select("conv_id", "depth", "own"), ["conv_id", "depth"]).join(whole, "conv_id").join(through, NAME)
            .join(children, NAME, "left").join(parents, ["depth", "up_a", "up_b"], "left").join(end_lists(members), NAME, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                    (F.col("own") - F.col("whole") + F.col("through")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))
