"""Operator 12: the trie of conversation prefixes, from vertical bitmaps.

1. Turns get their position in their conversation by one range-partitioned
   sort; a conversation may span tasks of it. Conversations are numbered in
   order of their ids, ``SHARD`` of them form a shard, and positions are cut
   into bands of ``BAND``. A unit of work is one band of one shard, so it is
   bounded however long a conversation is or however many are alike.
2. In a unit an index maps each (position, turn) to the bitset of the shard's
   conversations that have that turn there. A depth-first walk intersects a
   node's bitset with the postings of the turns that follow: the result is a
   child's bitset, its popcount the shard's members, and the conversations
   whose length is the node's depth are its end list.
3. A node is the same in all shards and bands when the 128-bit key of its
   turns is: the exclusive or of two 64-bit hashes of each (position, turn).
   Counts, smallest members and children are summed over the shards by key.
4. Each node belongs to its smallest member; the nodes of a conversation are
   one chain along its path. A chain adds its leaf and its savings once to
   every node above its top, summed per shard entry and then by key; below the
   top, running sums along the chain. So subtree sums need no loop over depths.
5. End lists of a node are hashed as a stream in the order of shards.

Defined results: a null role or text is empty; turns are ordered by turn
(null first), then role, then text; repeated rows are turns of their own. Rows
with a null conv_id belong to no conversation. The remainder of a negative id
has its sign, as in SQL. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cctally.llm.common import stage
from cctally.operators.dedup import number_in_order

SHARD, BAND = 1024, 1024
KEY = ["k1", "k2", "depth"]


def ordered_turns(conversations: DataFrame, keep_text: bool = False) -> DataFrame:
    """``conv_id, pos, digest, words`` (and ``role, text``): turns with their positions from 0.

    Positions come from the place in a sorted, written table, so a conversation
    of any length is never held by one task.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    turns = turns.withColumn("words", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    placed = turns.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select(
        "conv_id", "digest", "words", *(["role", "text"] if keep_text else []),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = stage(placed, "trie_turns")
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return placed.join(runs, ["conv_id", "part"]).withColumn(
        "pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def rebuilt(conversations: DataFrame, family: int = 20, shared: int = 4, keep_text: bool = False) -> DataFrame:
    """The turns of conversations rebuilt on the opening of their family's first one.

    Conversation c takes the first ``crc32(c) % shared`` turns of conversation
    ``c - c % family`` in place of its own. One row per turn; a conversation
    without turns has one row with a null position.
    """
    turns = stage(ordered_turns(conversations, keep_text), "trie_ordered")
    length = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    taken = F.crc32(F.col("conv_id").cast("string")) % shared
    heads = length.select("conv_id", "own", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    heads = heads.join(length.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    heads = heads.withColumn("opening", F.least("h", F.coalesce("there", F.lit(0))))
    # at most shared - 1 turns of a base, for at most 2 * family - 1 conversations
    rest = ["digest", "words", *(["role", "text"] if keep_text else [])]
    opening = turns.filter(F.col("pos") < shared - 1).select(F.col("conv_id").alias("base"), "pos", *rest)
    opening = heads.join(opening, "base").filter("pos < opening").select("conv_id", "pos", *rest)
    # openings of own turns are cut off before the join, so that a long conversation is joined by bands
    bands = heads.select("conv_id", "h", "opening", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("own") - 1) / BAND))).alias("band"))
    own = turns.withColumn("band", F.floor(F.col("pos") / BAND)).join(bands, ["conv_id", "band"]).filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("opening")).alias("pos"), *rest)
    empty = heads.filter("opening = 0 AND own <= h").select(
        "conv_id", F.lit(None).cast("long").alias("pos"), *[F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in rest])
    return opening.unionByName(own).unionByName(empty)


def _walk(columns: dict[str, np.ndarray], band: int, size: int) -> Iterator[tuple]:
    """The nodes of one unit: key, parent's key, depth, words, members, ends (conversation ids, ascending)."""
    low = band * size
    bit, pos, length = columns["bit"], columns["pos"], columns["length"]
    ids = dict(zip(bit.tolist(), columns["conv_id"].tolist(), strict=True))
    ends: dict[int, int] = {}
    for b, turns in dict(zip(bit.tolist(), length.tolist(), strict=True)).items():
        ends[turns] = ends.get(turns, 0) | 1 << b
    postings: dict[tuple, int] = {}
    turn_at: dict[tuple, tuple] = {}
    starts: dict[tuple, int] = {}
    for b, p, z1, z2, words, s1, s2 in zip(*[columns[c].tolist() for c in (
            "bit", "pos", "z1", "z2", "words", "s1", "s2")], strict=True):
        if p >= 0:
            turn = (p, z1, z2)
            postings[turn] = postings.get(turn, 0) | 1 << b
            turn_at[b, p] = (turn, words)
        starts[s1, s2] = starts.get((s1, s2), 0) | 1 << b

    def listed(bits: int) -> list[int]:
        out = []
        while bits:
            least = bits & -bits
            out.append(ids[least.bit_length() - 1])
            bits ^= least
        return out

    stack = []
    for (s1, s2), bits in starts.items():
        if not band:
            yield s1, s2, None, None, 0, 0, listed(bits), listed(bits & ends.get(0, 0))
        stack.append((s1, s2, low, bits))
    while stack:
        k1, k2, depth, bits = stack.pop()
        rest = bits & ~ends.get(depth, 0)
        if depth == low + size:
            continue
        while rest:
            turn, words = turn_at[(rest & -rest).bit_length() - 1, depth]
            child = bits & postings[turn]
            rest &= ~child
            c1, c2 = k1 ^ turn[1], k2 ^ turn[2]
            yield c1, c2, k1, k2, depth + 1, words, listed(child), listed(child & ends.get(depth + 1, 0))
            stack.append((c1, c2, depth + 1, child))


_ENTRIES = pa.schema([
    ("shard", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
    ("depth", pa.int64()), ("words", pa.int64()), ("members", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _unit(size: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        shard, band = (k.as_py() for k in key)
        found = list(_walk({c: rows[c].to_numpy() for c in rows.column_names}, band, size))
        columns = list(zip(*found, strict=True)) if found else [[]] * 8
        return pa.Table.from_arrays([pa.array(np.full(len(found), shard), pa.int64()), *[
            pa.array(c, f.type) for c, f in zip(columns, list(_ENTRIES)[1:], strict=True)]], schema=_ENTRIES)
    return run


def entries(turns: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """Step 2: one row per node and shard, with members and ends as lists of at most ``shard`` ids."""
    sizes = turns.groupBy("conv_id").agg(F.count("pos").alias("length"))
    numbered = number_in_order(sizes, [F.col("conv_id")], "number").select(
        "conv_id", "length", F.floor((F.col("number") - 1) / shard).alias("shard"),
        ((F.col("number") - 1) % shard).cast("int").alias("bit"))
    numbered = stage(numbered, "trie_numbers")
    turns = turns.withColumn("band", F.floor(F.coalesce("pos", F.lit(0)) / band)).select(
        "conv_id", F.coalesce("pos", F.lit(-1)).alias("pos"), F.coalesce("words", F.lit(0)).alias("words"), "band",
        F.xxhash64("pos", "digest").alias("z1"), F.xxhash64("digest", "pos", F.lit(1)).alias("z2"))
    # keys at the start of later bands; conversations of one band need none
    long = numbered.filter(F.col("length") > band).select("conv_id")
    sums = turns.join(long, "conv_id", "left_semi").groupBy("conv_id", "band").agg(
        F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "band", F.bit_xor("z1").over(earlier).alias("s1"), F.bit_xor("z2").over(earlier).alias("s2"))
    # one row per conversation and band, so that a long conversation's turns meet it in pieces
    banded = numbered.withColumn("band", F.explode(F.sequence(
        F.lit(0), F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / band))))
    banded = banded.join(sums, ["conv_id", "band"], "left").withColumns(
        {"s1": F.coalesce("s1", F.lit(0)), "s2": F.coalesce("s2", F.lit(0))})
    units = turns.join(banded, ["conv_id", "band"])
    return units.groupBy("shard", "band").applyInArrow(
        _unit(band), "shard long, k1 long, k2 long, p1 long, p2 long, depth long, words long, members array<long>, "
        "ends array<long>")


def trie(turns: DataFrame, shard: int = SHARD, band: int = BAND) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of ``turns`` (``conv_id, pos, digest, words``).

    Nodes: ``k1, k2, depth`` (the key), ``conv_id`` (smallest member),
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``. Ends:
    ``k1, k2, depth, shard, ends``, lists that are ascending within and over
    shards.
    """
    found = stage(entries(turns, shard, band), "trie_entries")
    nodes = found.groupBy(*KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("words").alias("words"),
        F.min(F.col("members")[0]).alias("conv_id"), F.sum(F.size("members")).alias("n_convs"))
    nodes = stage(nodes, "trie_nodes")
    children = nodes.filter("depth > 0").groupBy(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    of_band = F.floor(F.col("depth") / band)
    nodes = nodes.join(children, KEY, "left").select(
        *KEY, "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), of_band.alias("band"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saving"))
    nodes = stage(nodes, "trie_counted")
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("saving").alias("savings"),
        F.max_by(F.when(F.col("n_children") == 0, 1).otherwise(0), "depth").alias("leaf"))
    chains = stage(chains, "trie_chains")
    # what hangs below a node: the chains whose top lies deeper on a path through it
    paths = found.join(nodes.select(*KEY, F.col("conv_id").alias("owner")), KEY).select(
        *KEY, "owner", of_band.alias("band"), F.explode("members").alias("conv_id"))
    above = chains.withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("top") / band))))
    paths = stage(paths.join(above, ["conv_id", "band"]).filter("depth < top").select(
        *KEY, "owner", "conv_id", "top", "savings", "leaf"), "trie_paths")
    below = paths.groupBy(*KEY).agg(F.sum("savings").alias("hung"), F.sum("leaf").alias("leaves"))
    parents = paths.filter("depth = top - 1").select("conv_id", F.col("owner").alias("parent"))
    # along a chain: sums from the bottom, by bands
    rest = nodes.groupBy("conv_id", "band").agg(F.sum("saving").alias("saving"))
    deeper = Window.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.select("conv_id", "band", F.coalesce(F.sum("saving").over(deeper), F.lit(0)).alias("later"))
    chain = rest.join(chains.join(parents, "conv_id", "left").select("conv_id", "top", "leaf", "parent"), "conv_id")
    down = Window.partitionBy("conv_id", "band").orderBy(F.col("depth").desc())
    out = nodes.withColumn("along", F.sum("saving").over(down)).join(chain, ["conv_id", "band"]).join(below, KEY, "left")
    return out.select(
        *KEY, "conv_id", F.when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(
            F.col("conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
        (F.col("along") + F.col("later") + F.coalesce("hung", F.lit(0))).alias("saved_tokens"),
    ), found.filter(F.size("ends") > 0).select(*KEY, "shard", "ends")


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of their last turn, from ``rebuilt(..., keep_text=True)``."""
    text = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "role", "text")
    return nodes.join(text, ["conv_id", "depth"], "left")


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's comma-joined ids; its rows follow each other, in order."""
    names = [*KEY, "ends_sha256"]
    node, state = None, None
    for batch in batches:
        done = []
        keys = zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)
        for key, ids in zip(keys, batch.column(3).to_pylist(), strict=True):
            part = ",".join(map(str, ids)).encode()
            if key == node:
                state.update(b"," + part)
                continue
            if node is not None:
                done.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(part)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=names)


def digests(turns: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The nodes with ``ends_sha256``; a node's end lists pass through one digest as a stream, never held together."""
    nodes, ends = trie(turns, shard, band)
    hashed = ends.repartition(*KEY).sortWithinPartitions(*KEY, "shard").select(*KEY, "ends").mapInArrow(
        _hash_lists, "k1 long, k2 long, depth long, ends_sha256 string")
    return nodes.join(hashed, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
