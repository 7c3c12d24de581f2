"""Prefix trie of conversations by van Emde Boas recursion.

1. Turns get their places in a conversation by a range sort and a running count, so that a
   conversation of any length is dealt over tasks; texts stay behind as hashes and byte counts.
2. Sequences are cut at half their depth, and the halves again: a segment of 2**j turns is named by
   its two halves, and the prefix that ends at a cut by the prefix at the segment's start and
   the upper half. All segments of a height are handled at once, in one join a height; a name is
   128 bits of hash that hold all turns and their places.
3. Prefixes of one name and depth are a node. The tries of a height are joined in pairs, an upper trie
   and the lower forests below its cut: totals of the lower trees' roots are added to all their
   ancestors in the upper trie. Prefixes of a single conversation form a chain without
   branches; their totals are known and only the top of a chain is grafted.
4. The conversations that end at a node are hashed in order, a piece at a time.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aspectra.llm.batches import column
from aspectra.plans.materialize import materialize

#: Ancestors are joined in pieces of at most this many turns, written as a power of two.
PIECE = 12
#: Bytes of ids in a row on their way to the hash of a node.
ENDS_BYTES = 1 << 20
#: A node with more than 1 of so many nodes as children is sent to all tasks: there are fewer than this many.
CROWD = 1000
_NAME = ["depth", "n1", "n2"]
_NONE = hashlib.sha256(b"").hexdigest()


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``local``: how many rows of the conversation stand before a row in its partition."""
    last, count = None, 0
    for batch in batches:
        ids = column(batch, "conv_id").to_numpy()
        if not len(ids):
            continue
        head = np.ones(len(ids), bool)
        head[1:] = ids[1:] != ids[:-1]
        at = np.arange(len(ids)) - np.maximum.accumulate(np.where(head, np.arange(len(ids)), 0))
        if ids[0] == last:
            at[: (np.append(np.flatnonzero(head)[1:], len(ids)))[0]] += count
        last, count = ids[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int64))], [*batch.schema.names, "local"])


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, p, h1, h2, bytes): the turns of each conversation counted from 0."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"), F.octet_length(text).cast("long").alias("bytes"),
    )
    # the row's place spreads equal rows over ranges; they are the same turn, so their order is free
    order = ["conv_id", F.col("turn").asc_nulls_first(), "h1", "h2"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order, F.xxhash64(F.monotonically_increasing_id())).sortWithinPartitions(*order)
    rows = rows.select("conv_id", "h1", "h2", "bytes", F.spark_partition_id().alias("range"))
    rows = materialize(rows.mapInArrow(_count_task, "conv_id long, h1 long, h2 long, bytes long, range int, local long"), "trie-turns")
    size = rows.groupBy("conv_id", "range").agg(F.max("local").alias("n"))
    before = F.sum(F.col("n") + 1).over(W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    # only a range's first conversation can have turns in the ranges before: at most a row per range
    later = size.withColumn("before", before).where("before IS NOT NULL").select("conv_id", "range", "before")
    rows = rows.join(F.broadcast(later), ["conv_id", "range"], "left")
    return rows.select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("p"), "h1", "h2", "bytes")


def rebuilt(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each took the first ``head`` turns of conversation ``base`` for its own.

    conversations: conv_id, size; turns: conv_id, p, h1, h2, bytes. ``base`` and ``head`` (at most 8)
    are expressions of conv_id.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = sizes.select("conv_id", "own", base.cast("long").alias("base"), head.cast("long").alias("h"))
    convs = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own")), "base", "left")
    convs = convs.withColumn("lead", F.least("h", F.coalesce("base_own", F.lit(0))))
    convs = materialize(convs.select("conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")), "trie-conversations")
    first = turns.where("p < 8").withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "lead"), "base").where("p < lead")
    rest = turns.join(convs.select("conv_id", "h", "lead"), "conv_id").where("p >= h").withColumn("p", F.col("p") - F.col("h") + F.col("lead"))
    fields = ["conv_id", "p", "h1", "h2", "bytes"]
    return convs.select("conv_id", "size"), first.select(*fields).unionByName(rest.select(*fields))


def prefix_names(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, n1, n2): the name of the first ``depth`` turns, for depths 0 to the size."""
    # the turn's place is hashed with it, so the names of parts can be put together by xor
    own = [F.xxhash64("h1", "h2", "p").alias("x1"), F.xxhash64("h2", "p", "h1").alias("x2")]
    level = turns.select("conv_id", F.col("p").alias("i"), *own, F.lit(1).cast("long").alias("n"))
    deepest = convs.agg(F.max("size")).first()[0] or 0
    segments = [materialize(level, "trie-segments")]
    while 1 << len(segments) <= deepest:
        pairs = segments[-1].groupBy("conv_id", F.shiftright("i", 1).alias("i")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("n").alias("n"))
        segments.append(materialize(pairs.where(F.col("n") == 1 << len(segments)), "trie-segments"))
    names = convs.select("conv_id", F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("n1"), F.lit(0).cast("long").alias("n2"))
    for upper in reversed(segments):
        # a segment that starts at m is cut in half: its upper half ends at 2m + 1 of the halves
        half = upper.where("i % 2 = 0").select("conv_id", F.expr("i div 2").alias("m"), "x1", "x2")
        cut = names.join(half, ["conv_id", "m"]).select("conv_id", (2 * F.col("m") + 1).alias("m"), F.col("n1").bitwiseXOR(F.col("x1")).alias("n1"), F.col("n2").bitwiseXOR(F.col("x2")).alias("n2"))
        names = materialize(names.withColumn("m", 2 * F.col("m")).unionByName(cut), "trie-names")
    return names.withColumnRenamed("m", "depth")


def _parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id; parents of very many children are sent to all tasks, others joined."""
    total = nodes.count()
    up = ["up_depth", "up1", "up2"]
    named = nodes.select(F.col("depth").alias("up_depth"), F.col("n1").alias("up1"), F.col("n2").alias("up2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    crowded = F.col("n_children") > F.lit(max(1, total // CROWD))
    far = nodes.join(F.broadcast(named.where(crowded).drop("n_children")), up, "left")
    far = materialize(far, "trie-parents")
    near = far.where("parent_conv_id IS NULL AND depth > 0").drop("parent_conv_id").join(named.where(~crowded).drop("n_children"), up)
    return far.where("parent_conv_id IS NOT NULL OR depth = 0").unionByName(near)


def subtree_totals(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(depth, n1, n2, n_leaves, saved_tokens) of the nodes that more than one conversation shares.

    ``nodes``: those nodes with their own weights n_leaves and saved_tokens and conv_id; ``paths``:
    (conv_id, depth, n1, n2) for the ancestors of each, under its conv_id.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = nodes.select("conv_id", *_NAME, "n_leaves", "saved_tokens")
    height = 1
    while height <= deepest:
        # tries of this height: the roots of the lower one at odd multiples, their ancestors in the upper one
        j = height.bit_length() - 1
        size = min(j, PIECE)
        roots = totals.where(F.shiftright("depth", j) % 2 == 1).where(F.col("depth") % height == 0)
        last = F.shiftright("depth", size)
        pieces = F.explode(F.sequence(last - (1 << (j - size)), last - 1))
        roots = roots.select("conv_id", pieces.alias("piece"), "n_leaves", "saved_tokens")
        above = paths.withColumn("piece", F.shiftright("depth", size))
        grafts = above.join(roots, ["conv_id", "piece"]).select(F.lit(None).cast("long").alias("conv_id"), *_NAME, "n_leaves", "saved_tokens")
        totals = totals.unionByName(grafts).groupBy(*_NAME).agg(F.max("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        totals = materialize(totals, "trie-totals")
        height *= 2
    return totals.drop("conv_id")


def _piece_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node in order, joined by commas, a row for about ``ENDS_BYTES``; starts and ends with a digit."""
    names = [*_NAME, "first"]
    node, first, held, size = None, 0, [], 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in (*node, first)], pa.array([b",".join(held)], pa.binary())], [*names, "ids"])

    for batch in batches:
        keys = zip(*[column(batch, c).to_pylist() for c in _NAME])
        ids = column(batch, "conv_id").to_pylist()
        for key, i in zip(keys, ids):
            if held and (key != node or size >= ENDS_BYTES):
                yield row()
                held, size = [], 0
            if not held:
                node, first = key, i
            held.append(b"%d" % i)
            size += len(held[-1]) + 1
    if held:
        yield row()


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of a node's pieces, which stand in order."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in node], pa.array([state.hexdigest()])], [*_NAME, "ends_sha256"])

    for batch in batches:
        pieces = column(batch, "ids")
        for k, key in enumerate(zip(*[column(batch, c).to_pylist() for c in _NAME])):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    yield row()
                node, state = key, hashlib.sha256()
            state.update(pieces[k].as_buffer())
    if node is not None:
        yield row()


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, n1, n2, ends_sha256) of the nodes at which conversations (conv_id) end.

    A node's ids are sorted and joined over as many ranges as they need; only the hash itself, which
    is one sequence by its definition, is taken in one task, a piece at a time.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_NAME, "conv_id"]
    name = ", ".join(f"{c} long" for c in _NAME)
    pieces = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_piece_task, f"{name}, first long, ids binary")
    return pieces.repartition(*_NAME).sortWithinPartitions(*_NAME, "first").mapInArrow(_hash_task, f"{name}, ends_sha256 string")


def prefix_trie(conversations: DataFrame, base: Column | None = None, head: Column | None = None) -> DataFrame:
    """One row per distinct prefix (node): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``conversations``: conv_id, turn, role, text. Turns of a conversation follow by turn (null
    first), those with one number by a hash of role and text; a null role or text is empty;
    repeated rows are turns of their own; rows without a conv_id take no part; other columns are
    ignored. Where ``base`` and ``head`` (expressions of conv_id; head at most 8) are given, a
    conversation takes the first ``head`` turns of conversation ``base`` (none if it is absent) in
    place of its own first ``head``.

    conv_id is the smallest member of a node, parent_conv_id its parent's (null for the root);
    n_leaves counts the childless nodes below and at it; saved_tokens sums over them (n_convs - 1)
    times the UTF-8 bytes of the node's last text; ends_sha256 hashes the decimal conv_ids, in
    ascending order and joined by commas, of the members that end there. An empty table has no
    nodes, not even a root.
    """
    convs, turns = rebuilt(numbered_turns(conversations), F.col("conv_id") if base is None else base, F.lit(0) if head is None else head)
    turns = materialize(turns, "trie-rebuilt")
    names = prefix_names(convs, turns)
    last = turns.select("conv_id", (F.col("p") + 1).alias("depth"), "bytes", F.xxhash64("h1", "h2", "p").alias("x1"), F.xxhash64("h2", "p", "h1").alias("x2"))
    paths = materialize(names.join(last, ["conv_id", "depth"], "left"), "trie-paths")
    nodes = paths.groupBy(*_NAME).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.max("x1").alias("x1"), F.max("x2").alias("x2"))
    up = [(F.col("depth") - 1).alias("up_depth"), F.col("n1").bitwiseXOR(F.col("x1")).alias("up1"), F.col("n2").bitwiseXOR(F.col("x2")).alias("up2")]
    nodes = materialize(nodes.select(*_NAME, "conv_id", "n_convs", F.coalesce("bytes", F.lit(0)).alias("bytes"), *up), "trie-nodes")
    alone = F.when(F.col("n_convs") == 1, 1).otherwise(0)
    child = nodes.where("depth > 0").select(F.col("up_depth").alias("depth"), F.col("up1").alias("n1"), F.col("up2").alias("n2"), F.lit(1).alias("child"), alone.alias("chain"))
    counted = nodes.unionByName(child, allowMissingColumns=True).groupBy(*_NAME).agg(
        *[F.max(c).alias(c) for c in ("conv_id", "n_convs", "bytes", "up_depth", "up1", "up2")], F.count("child").alias("n_children"), F.coalesce(F.sum("chain"), F.lit(0)).alias("chains"),
    )
    counted = materialize(counted, "trie-children")
    shared = counted.where("n_convs > 1")
    weights = shared.select("conv_id", *_NAME, F.when(F.col("n_children") == 0, 1).otherwise(F.col("chains")).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    ancestors = weights.groupBy("conv_id").agg(F.max("depth").alias("most"))
    ancestors = materialize(paths.join(ancestors, "conv_id").where("depth < most").select("conv_id", *_NAME), "trie-ancestors")
    totals = subtree_totals(weights, ancestors)
    ends = paths.join(convs, "conv_id").where("depth = size")
    # the three tables of facts about a node are united and grouped, so no key is joined twice
    facts = _parents(counted.drop("bytes", "chains")).drop("up_depth", "up1", "up2")
    facts = facts.unionByName(totals, allowMissingColumns=True).unionByName(end_hashes(ends), allowMissingColumns=True)
    whole = facts.groupBy(*_NAME).agg(*[F.max(c).alias(c) for c in facts.columns if c not in _NAME])
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"),
    )
