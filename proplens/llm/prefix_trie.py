"""Prefix trie of conversations by fixed-length block hashing.

A turn is a SHA-256 digest, a block is ``block`` consecutive turns of a conversation, the last may be shorter.  One pass
chains each conversation's block digests, so that a block knows the digest of all turns before it.  Conversations are
grouped by (digest before, block digest): equal pairs share every turn up to the block's end.  Where the conversations
that share the turns before a block agree on it, its nodes follow from the group as a whole.  Only where they diverge are
the distinct blocks, not the conversations, taken apart turn by turn.

A node is named by its smallest member and its depth.  Every conversation so owns one run of consecutive depths at its
end, possibly none, and a subtree is the end of its owner's run plus whole runs of other owners.  Subtree sums therefore
need no walk over levels: each run's sum is added once to every owner that its conversation's path passes, at the last
depth where that owner holds it, and sums from the deep end of each run give the answer.

Hot groups: copies of a conversation meet only in counts, minima and skew-joins; turns are numbered over a range sort
that cuts a long conversation into several tasks; runs are summed in stretches of 4,096 nodes; a conversation's blocks
are chained as a stream.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proplens.llm.common import forget, written

#: Nodes of an owner that one window sums.
STRETCH = 4096
#: Member identifiers in one piece of a node's list.
PIECE = 1 << 16


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def numbered_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """conv_id, pos (from 1, by turn, null first), digest of (role, text), n_bytes (of the text).

    Null role and text are empty.  Equal turns stand in the order of their digests, repeated rows count each.  Rows with
    a null identifier belong to no conversation and go.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = rows.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        _sha(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "n_bytes")

    def number(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for b in batches:
            ids = b["conv_id"].to_numpy()
            if not len(ids):
                continue
            at = np.arange(len(ids))
            starts = np.maximum.accumulate(np.where(np.r_[True, ids[1:] != ids[:-1]], at, 0))
            pos = at - starts + 1
            if ids[0] == last:
                pos[starts == 0] += count
            last, count = ids[-1], int(pos[-1])
            yield pa.RecordBatch.from_arrays([b["conv_id"], pa.array(pos), pa.array(np.full(len(ids), part)), b["digest"],
                                              b["n_bytes"]], ["conv_id", "pos", "part", "digest", "n_bytes"])

    placed = written(turns.mapInArrow(number, "conv_id long, pos long, part long, digest string, n_bytes long"), "turns")
    # Conversations that go on in another partition: at most two a partition, each with the rows that stand before.
    held = placed.groupBy("conv_id", "part").agg(F.max("pos").alias("rows"))
    broken = held.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("conv_id")
    before = held.join(broken, "conv_id", "left_semi").withColumn("before", F.sum("rows").over(
        Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    before = F.broadcast(before.filter("before > 0").select("conv_id", "part", "before"))
    return placed.join(before, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "n_bytes")


def grafted(turns: DataFrame, every: int = 5, most: int = 8, heads: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as another one does: (turns with depth and length, conversations with length).

    Conversation c takes the first ``heads`` (an expression on conv_id, ``most`` at most) turns of conversation
    c - c % ``every`` and then its own turns after its first ``heads``.  Turns: conv_id, length, depth (from 1), digest,
    n_bytes; conversations: conv_id, length, those without turns too.
    """
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9)) if heads is None else heads
    turns = turns.withColumn("heads", heads)
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"), F.first("heads").alias("heads"))
    lent = turns.filter((F.col("conv_id") % every == 0) & (F.col("pos") <= most)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "n_bytes"))).alias("lent"))  # ``most`` at most
    convs = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(lent, "base", "left")
    convs = convs.withColumn("lent", F.when(F.col("heads") > 0, F.slice("lent", F.lit(1), F.col("heads").cast("int"))))
    taken = F.when(F.col("lent").isNull(), 0).otherwise(F.size("lent")).cast("long")
    convs = convs.withColumn("taken", taken).withColumn(
        "length", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("heads")))
    convs = written(convs.select("conv_id", "length", "taken", "lent"), "conversations")
    first = convs.select("conv_id", "length", F.explode("lent").alias("t")).select(
        "conv_id", "length", F.col("t.pos").alias("depth"), "t.digest", "t.n_bytes")
    own = turns.filter("pos > heads").join(convs.drop("lent"), "conv_id").select(
        "conv_id", "length", (F.col("taken") + F.col("pos") - F.col("heads")).alias("depth"), "digest", "n_bytes")
    return first.unionByName(own), convs.select("conv_id", "length")


def _chained(blocks: DataFrame) -> DataFrame:
    """Blocks with ``before`` and ``after``: the digests of all turns before the block and up to its end."""
    cols = blocks.columns

    def chain(batches):
        last, state = None, ""
        for b in batches:
            before, after = [], []
            for conv, digest in zip(b["conv_id"].to_pylist(), b["digest"].to_pylist()):
                if conv != last:
                    last, state = conv, ""
                before.append(state)
                state = hashlib.sha256((state + digest).encode()).hexdigest()
                after.append(state)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before, pa.string()), pa.array(after, pa.string())],
                                             [*cols, "before", "after"])

    schema = blocks.schema.add("before", "string").add("after", "string")
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(chain, schema)


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = 4) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of ``turns`` (conv_id, length, depth from 1, digest, n_bytes) of ``convs`` (conv_id, length).

    Nodes: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, n_convs - 1 times n_bytes of the node's turn).  Ends: conv_id,
    depth of the node at which ``member`` ends, one row for each conversation.  No conversation: no root.
    """
    at = (F.col("depth") - 1) % block
    rows = turns.groupBy("conv_id", "length", ((F.col("depth") - 1 - at) / block).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "digest", "n_bytes"))).alias("turns"))  # ``block`` at most
    rows = rows.select("conv_id", "length", "block", F.transform("turns", lambda t: t["digest"]).alias("digests"),
                       F.transform("turns", lambda t: t["n_bytes"]).alias("sizes"))
    rows = written(_chained(rows.withColumn("digest", _sha(F.array_join("digests", "")))), "blocks")
    least = convs.agg(F.min("conv_id")).first()[0]

    # Distinct blocks after equal beginnings, and how many of them follow each beginning.
    alike = written(rows.groupBy("before", "digest").agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.any_value("after").alias("after"),
        F.any_value("block").alias("block"), F.any_value("digests").alias("digests"), F.any_value("sizes").alias("sizes")),
        "alike")
    begun = alike.groupBy("before").agg(F.count(F.lit(1)).alias("ways"))
    begun = begun.join(alike.select(F.col("after").alias("before"), F.col("owner").alias("above")), "before", "left")
    begun = begun.withColumn("above", F.when(F.col("before") == "", F.lit(least).cast("long")).otherwise(F.col("above")))
    alike = alike.join(begun, "before")
    depth = F.col("block") * block

    def each_turn(frame: DataFrame, *keep: str) -> DataFrame:
        return frame.select(*keep, "before", "block", "digests", F.posexplode("sizes").alias("i", "n_bytes")).select(
            *keep, "before", (depth + F.col("i") + 1).alias("depth"), "n_bytes",
            _sha(F.array_join(F.slice("digests", F.lit(1), F.col("i") + 1), "")).alias("prefix"),
            F.when(F.col("i") > 0, _sha(F.array_join(F.slice("digests", F.lit(1), F.col("i")), ""))).alias("shorter"))

    # Where all agree, the block's nodes have the group's owner and count.
    plain = alike.filter("ways = 1").select("owner", "n_convs", "above", depth.alias("d"),
                                            F.posexplode("sizes").alias("i", "n_bytes")).select(
        F.col("owner").alias("conv_id"), (F.col("d") + F.col("i") + 1).alias("depth"), "n_convs", "n_bytes",
        F.when(F.col("i") == 0, F.col("above")).otherwise(F.col("owner")).alias("parent_conv_id"))
    # Where they diverge, distinct blocks are taken apart.
    split = written(each_turn(alike.filter("ways > 1"), "owner", "n_convs", "above").groupBy("before", "depth", "prefix").agg(
        F.min("owner").alias("owner"), F.sum("n_convs").alias("n_convs"), F.any_value("n_bytes").alias("n_bytes"),
        F.any_value("above").alias("above"), F.any_value("shorter").alias("shorter")), "split")
    upper = split.select(F.col("before").alias("b"), F.col("prefix").alias("p"), (F.col("depth") + 1).alias("d"),
                         F.col("owner").alias("over"))
    apart = split.join(upper, (F.col("before") == F.col("b")) & (F.col("depth") == F.col("d")) & (
        F.col("shorter") == F.col("p")), "left").select(
        F.col("owner").alias("conv_id"), "depth", "n_convs", "n_bytes",
        F.when(F.col("shorter").isNull(), F.col("above")).otherwise(F.col("over")).alias("parent_conv_id"))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), "n_convs",
        F.lit(0).cast("long").alias("n_bytes"), F.lit(None).cast("long").alias("parent_conv_id"))
    bare = written(plain.unionByName(apart).unionByName(root), "nodes")

    # The owners that each conversation's path passes, each with the last depth that it holds there.
    own = rows.join(alike.select("before", "digest", "owner", "ways"), ["before", "digest"])
    passed = own.filter("ways = 1").select("conv_id", "length", "owner", (depth + F.size("digests")).alias("depth"))
    some = each_turn(own.filter("ways > 1"), "conv_id", "length").join(
        split.select("before", "depth", "prefix", "owner"), ["before", "depth", "prefix"])
    passed = written(passed.unionByName(some.select("conv_id", "length", "owner", "depth")), "passed")
    start = convs.select("conv_id", "length", F.lit(least).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"))
    ends = passed.unionByName(start).filter("depth = length").select(
        F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member"))

    # A node's own numbers, then every run's sums at the places that its owner's path passes.
    zero = F.lit(0).cast("long")
    kids = bare.filter("depth > 0").select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    nodes = written(bare.withColumn("kid", zero).unionByName(
        kids.withColumn("kid", F.lit(1).cast("long")), allowMissingColumns=True).groupBy("conv_id", "depth").agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"), F.sum("kid").alias("n_children")).withColumns(
        {"saved": (F.col("n_convs") - 1) * F.col("n_bytes"), "leaf": (F.col("n_children") == 0).cast("long")}), "counted")
    runs = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    joints = passed.unionByName(start).filter("owner <> conv_id").groupBy("conv_id", "owner").agg(F.max("depth").alias("depth"))
    lent = joints.join(runs, "conv_id").groupBy(F.col("owner").alias("conv_id"), "depth").agg(
        F.sum("saved").alias("saved_below"), F.sum("leaf").alias("leaves_below"))
    full = nodes.join(lent, ["conv_id", "depth"], "left").withColumns({
        "saved": F.col("saved") + F.coalesce("saved_below", zero), "leaf": F.col("leaf") + F.coalesce("leaves_below", zero),
        "stretch": F.floor(F.col("depth") / STRETCH)})
    full = written(full.drop("saved_below", "leaves_below"), "full")
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    for used in (rows, alike, split, bare, nodes):
        forget(used)
    rest = full.groupBy("conv_id", "stretch").agg(F.sum("saved").alias("s"), F.sum("leaf").alias("l")).withColumns(
        {"saved_rest": F.sum("s").over(deeper), "leaf_rest": F.sum("l").over(deeper)}).filter(
        F.col("leaf_rest").isNotNull()).drop("s", "l")
    here = Window.partitionBy("conv_id", "stretch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    out = full.withColumns({"saved": F.sum("saved").over(here), "leaf": F.sum("leaf").over(here)}).join(
        rest, ["conv_id", "stretch"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf") + F.coalesce("leaf_rest", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("saved_rest", zero)).alias("saved_tokens"))
    return out, ends


def joined_digests(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256: SHA-256 of the members' identifiers, ascending, comma-joined, for nodes with ends.

    Identifiers are joined in pieces of at most 65,536 of them, and a node's pieces pass through its hash as a stream.
    """
    pieces = ends.groupBy("conv_id", "depth", F.floor(F.col("member") / PIECE).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("text"))
    pieces = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "piece")

    def digest(batches):
        node, state = None, None
        for b in batches:
            done = []
            for conv, depth, text in zip(*(b[c].to_pylist() for c in ("conv_id", "depth", "text"))):
                if (conv, depth) == node:
                    state.update(b"," + text.encode())
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256(text.encode())
            if done:
                yield _digests(done)
        if node:
            yield _digests([(*node, state.hexdigest())])

    return pieces.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    conv, depth, text = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(text)],
                                      ["conv_id", "depth", "ends_sha256"])


def conversation_trie(rows: DataFrame, block: int = 4) -> DataFrame:
    """The nodes of the grafted conversations' trie with their ``ends_sha256``; see the functions above for each case."""
    turns, convs = grafted(numbered_turns(rows))
    nodes, ends = prefix_trie(turns, convs, block)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(joined_digests(ends), ["conv_id", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", nothing))
