"""The prefix trie of conversations, by van Emde Boas recursion.

A block is a stretch of 2^k turns. It is cut at half its length: the distinct first halves under one context make an
upper trie, and each of them is named after its smallest conversation; what follows a first half is a sequence of the
lower forest under that name. Upper and lower parts are blocks of half the size and are cut again, all blocks of one
size at once, until a block is a single turn and each distinct turn under a context is a node. Equal first halves go on
as one sequence with a weight, so a beginning that many conversations share is followed once.

Totals are grafted back over the same cuts: in each block the nodes of its lower half are summed by the name they hang
under, and the sums are added to those nodes of the upper half; then both halves go on by themselves. After the last
cut each node holds the sum over its subtree. Both ways take one round per halving, whatever the depth.

Turns stay rows throughout: a conversation is never gathered in one row or one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.session import settled

SHARED_TURNS = 6  # a conversation takes over fewer turns than this
FAMILY = 100  # conversation c begins like c - c % 100
CHUNK_BITS = 10  # 1,024 neighbouring ids are written as one text
DEAL_POINTS = 64  # leading code points that decide the range a turn is dealt to


def _key(*columns: str) -> Column:
    """A text key: differs from what either side was grouped on, so a join on it is a plain exchange that can be split."""
    return F.concat_ws(":", *columns)


def _numbered(turns: DataFrame, scratch: list[str]) -> DataFrame:
    """``conv_id, at, symbol, points``: each turn's place in its conversation, from 0.

    Turns are dealt by ranges of (conversation, turn, role, text), so a conversation of any length spreads over many
    tasks; places count within a range, after the conversation's turns in the ranges before it. Long roles and texts
    are dealt by their beginnings, in the same order, and sorted as a whole. A turn's text is replaced by its digest
    and its number of code points.
    """
    read = turns.select(
        "conv_id", "turn", F.length("text").cast("long").alias("points"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)).alias("symbol"),
        "role", "text")
    brief, order = F.length("role") <= DEAL_POINTS, ["conv_id", F.col("turn").asc_nulls_first()]
    ranged = read.repartitionByRange(*order, F.substring("role", 1, DEAL_POINTS), ~brief, F.when(brief, F.substring("text", 1, DEAL_POINTS)))
    ranged = ranged.sortWithinPartitions(*order, "role", "text")
    ranged = settled(ranged.select("conv_id", "points", "symbol", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("line")), scratch)
    counts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("line").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select(_key("conv_id", "part").alias("k"), "first", "offset")
    keyed = ranged.withColumn("k", _key("conv_id", "part"))
    return keyed.join(starts, "k").select("conv_id", (F.col("line") - F.col("first") + F.col("offset")).alias("at"), "symbol", "points")


def _rebuilt(turns: DataFrame, scratch: list[str]) -> tuple[DataFrame, DataFrame]:
    """``conv_id, at, symbol, points`` of the rebuilt turns, and ``conv_id, turns`` of all conversations, turnless ones too."""
    own = settled(_numbered(turns, scratch), scratch)
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS
    convs = own.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("h", taken).withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    heads = own.filter(F.col("at") < SHARED_TURNS - 1).join(convs.select(F.col("family").alias("conv_id")).distinct(), "conv_id", "left_semi")
    sizes = heads.groupBy(F.col("conv_id").alias("family")).agg(F.count("*").alias("there"))
    convs = convs.join(sizes, "family", "left").withColumn("got", F.least("h", F.coalesce("there", F.lit(0))))
    convs = settled(convs.select("conv_id", "family", "got", (F.col("got") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"),
                                 (F.col("h") - F.col("got")).alias("lost")), scratch)
    shared = (convs.filter("got > 0").select("conv_id", "family", "got")
              .join(heads.select(F.col("conv_id").alias("family"), "at", "symbol", "points"), "family").filter("at < got").select("conv_id", "at", "symbol", "points"))
    # Only conversations whose family has too few turns move up, and the key's text lets a long one be split.
    moved = convs.filter("lost > 0").select(F.col("conv_id").cast("string").alias("k"), "lost")
    rest = (own.filter(F.col("at") >= taken).withColumn("k", F.col("conv_id").cast("string")).join(moved, "k", "left")
            .select("conv_id", (F.col("at") - F.coalesce("lost", F.lit(0))).alias("at"), "symbol", "points"))
    return settled(shared.unionByName(rest), scratch), convs.select("conv_id", "turns")


def _slices(rows: DataFrame, levels: int, scratch: list[str]) -> list[DataFrame]:
    """By level k: ``conv_id, block, digest`` of every stretch of 2^k turns that starts at a multiple of 2^k and is whole."""
    slices = [rows.select("conv_id", F.col("at").alias("block"), F.col("symbol").alias("digest"))]
    for _ in range(1, levels):
        half = slices[-1].groupBy("conv_id", F.shiftright("block", 1).alias("pair")).agg(
            F.max(F.when(F.col("block") % 2 == 0, F.col("digest"))).alias("left"), F.max(F.when(F.col("block") % 2 == 1, F.col("digest"))).alias("right"))
        joined = half.filter(F.col("left").isNotNull() & F.col("right").isNotNull())
        slices.append(settled(joined.select("conv_id", F.col("pair").alias("block"), F.unhex(F.sha2(F.concat("left", "right"), 256)).alias("digest")), scratch))
    return slices


def _named(rows: DataFrame, convs: DataFrame, levels: int, scratch: list[str]) -> DataFrame:
    """Cut down to single turns: ``rep, start, names, length, weight``.

    A sequence is followed as its smallest conversation ``rep``. ``names`` are the nodes it hangs under, one per cut at
    which it went on below: the last is its context, the node at depth ``start``. After the last cut a sequence is one
    turn long and makes a node, or it is empty and a conversation ends at its context.
    """
    items = convs.select(F.col("conv_id").alias("rep"), F.lit(0).cast("long").alias("start"), F.array().cast("array<long>").alias("names"),
                         F.col("turns").alias("length"), F.lit(1).cast("long").alias("weight"))
    for k, digests in reversed(list(enumerate(_slices(rows, levels, scratch)))):
        half = 1 << k
        long = items.filter(F.col("length") >= half).withColumn("k", _key("rep", F.shiftright("start", k)))
        known = long.join(digests.select(_key("conv_id", "block").alias("k"), "digest"), "k").drop("k")
        known = settled(known, scratch)
        below = F.coalesce(F.try_element_at("names", F.lit(-1)), F.lit(-1))  # with the start, this names the context
        groups = known.groupBy("start", F.size("names").alias("cuts"), below.alias("context"), "digest").agg(
            F.min("rep").alias("name"), F.sum("weight").alias("weight"), F.first("names").alias("names"))
        upper = groups.select(F.col("name").alias("rep"), "start", "names", F.lit(half).cast("long").alias("length"), "weight")
        at = lambda: F.concat_ws(":", "start", F.size("names"), below, F.hex("digest")).alias("k")
        names = groups.select(F.concat_ws(":", "start", "cuts", "context", F.hex("digest")).alias("k"), "name")
        lower = known.withColumn("k", at()).join(names, "k").select(
            "rep", (F.col("start") + half).alias("start"), F.concat("names", F.array("name")).alias("names"), (F.col("length") - half).alias("length"), "weight")
        items = settled(items.filter(F.col("length") < half).unionByName(upper).unionByName(lower), scratch)
    return items


def _grafted(nodes: DataFrame, levels: int, totals: list[str], scratch: list[str]) -> DataFrame:
    """Add to every node the totals of all nodes below it."""
    for k in reversed(range(levels)):
        # The turn's place has bit k set: the node is in a lower half, under the name given at that cut.
        lower = nodes.filter(F.shiftright("place", k) % 2 == 1)
        cut = F.shiftleft(F.shiftright("place", k), k)
        which = F.bit_count(F.shiftright("place", k)).cast("int")  # the cuts above it, and this one
        sums = lower.groupBy(cut.alias("depth"), F.try_element_at("names", which).alias("name")).agg(*[F.sum(t).alias(f"{t}_below") for t in totals])
        sums = sums.select(_key("depth", "name").alias("k"), *[f"{t}_below" for t in totals])
        nodes = nodes.withColumn("k", _key("depth", "name")).join(sums, "k", "left").select(
            *[c for c in nodes.columns if c not in totals], *[(F.col(t) + F.coalesce(f"{t}_below", F.lit(0))).alias(t) for t in totals])
        nodes = settled(nodes, scratch)
    return nodes


def _listed(ends: DataFrame, scratch: list[str]) -> DataFrame:
    """``k, ends_sha256``: digest of each node's ids in ascending order, comma-joined.

    Ids are written in chunks of neighbouring numbers first, which bounds what is gathered. Where a node has several
    chunks they pass by in order and only the running digest is held.
    """
    chunks = ends.groupBy("k", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    chunks = settled(chunks, scratch)
    count = chunks.groupBy("k").agg(F.count("*").alias("n"), F.max("ids").alias("ids"))
    single = count.filter("n = 1").select("k", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    several = chunks.join(count.filter("n > 1").select(F.concat("k").alias("k")), "k", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            for k, ids in zip(batch.column("k").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pydict({"k": [key], "ends_sha256": [digest.hexdigest()]})
                    key, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if key is not None:
            yield pa.RecordBatch.from_pydict({"k": [key], "ends_sha256": [digest.hexdigest()]})

    streamed = several.repartition("k").sortWithinPartitions("k", "chunk").select("k", "ids").mapInArrow(run, "k string, ends_sha256 string")
    return single.unionByName(streamed)


def build(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
          text_column: str = "text", scratch: list[str] | None = None) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by turn number, null first, then by role, then by text; repeated rows are turns of their own. A null
    role or text is empty. Rows with a null id belong to no conversation. Conversation c is rebuilt: it begins with the
    first h turns of conversation ``c - c % 100`` (all if it has fewer, none if it is absent), h = crc32(c) % 6, and goes on
    with its own turns after its first h. Remainders have the sign of the id.

    A node is a distinct sequence of first turns and is named by its smallest conversation and its depth; the root has
    depth 0 and no parent. No conversations give no nodes, not even a root. Other columns are not read. ``scratch``
    collects the folders written, for ``discard``.
    """
    scratch = [] if scratch is None else scratch
    known = conversations.filter(F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").cast("long").alias("conv_id"), F.col(f"`{turn_column}`").alias("turn"),
        F.coalesce(F.col(f"`{role_column}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    rows, convs = _rebuilt(known, scratch)
    deepest = convs.agg(F.max("turns").alias("most"), F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    levels = max(1, (deepest["most"] or 0).bit_length())  # blocks of 2^levels turns, longer than any conversation
    items = _named(rows, convs, levels, scratch)

    # Without a cut below, the context is the root, whose name is the smallest conversation of all.
    above = F.coalesce(F.try_element_at("names", F.lit(-1)), F.lit(deepest["least"]).cast("long"))
    single = items.filter("length = 1").withColumn("k", _key("rep", "start"))
    said = rows.select(_key("conv_id", "at").alias("k"), "symbol", "points")
    nodes = single.join(said, "k").groupBy("start", above.alias("parent"), "symbol").agg(
        F.min("rep").alias("name"), F.sum("weight").alias("n_convs"), F.max("points").alias("points"), F.first("names").alias("names"))
    nodes = settled(nodes.select("name", F.col("start").alias("place"), (F.col("start") + 1).alias("depth"), "parent", "n_convs", "points", "names"), scratch)

    children = nodes.groupBy(_key("place", "parent").alias("k")).agg(F.count("*").alias("n_children"))
    counted = nodes.withColumn("k", _key("depth", "name")).join(children, "k", "left").select(
        "name", "place", "depth", "parent", "names", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("points")).alias("saved_tokens"))
    totals = _grafted(settled(counted, scratch), levels, ["n_leaves", "saved_tokens"], scratch)

    top = totals.filter("depth = 1").agg(F.count("*").alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
                                         F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"))
    root = top.filter(F.lit(deepest["n"]) > 0).select(
        F.lit(deepest["least"]).cast("long").alias("name"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
        F.lit(deepest["n"]).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")
    # A sequence with nothing left is a conversation that ends at its context.
    ends = items.filter("length = 0").select(F.col("rep").alias("conv_id"), F.concat_ws(":", "start", above).alias("k"))
    listed = _listed(ends, scratch).select(F.concat("k").alias("k"), "ends_sha256")
    tree = root.unionByName(totals.select(*root.columns)).withColumn("k", _key("depth", "name"))
    return tree.join(listed, "k", "left").select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
