"""Prefix trie of conversations (operator 13): shared beginnings, counted by a depth-band rollup.

A node is a distinct sequence of a conversation's first d turns (role, text), from the root (d = 0).
A conversation is a member of every node it begins with.

1. Turns are numbered by range partitions, so a conversation of any length is spread over tasks.
   Each turn has a digest; a prefix has as key the sum, limb by limb, of digests of (place, turn
   digest) up to its depth, formed in blocks of turns.  Only keys travel, no texts.
2. Paths (conversation, depth, key) grouped by key are the nodes, with smallest member and size.
3. Totals over subtrees (``rollup``): depths are cut into bands of ``band`` levels.  A node adds its own
   figures to its ancestors within its band only.  The band roots, now complete for their bands, are
   nodes of a tree that is ``band`` times less deep, which is rolled up the same way; their completed
   totals then go to the nodes of the band above.  So no row explodes to more than ``band`` rows, and
   there are log_band(depth) rounds.
4. Members that end at a node are joined into one text in ascending order: pieces of ranges of ids
   first, then piece after piece into a running SHA-256, so a node's ids never stand in memory at once.

Defined results: turns are ordered by turn, null first, ties by a digest of role and text; a null role
or text is empty; equal rows are turns of their own; rows without a conversation's id are left out;
columns other than conv_id, turn, role and text are ignored; an empty table has no nodes, not even a
root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.llm.common import written
from tickwatch.operators.blocks import number_in_order
from tickwatch.session import default_parallelism

#: Words of the token count.
WORD = r"[^\x20\x09-\x0D]+"
#: A key's limbs: 32 bits of a digest each, summed as longs.
LIMBS = 4
KEY = [f"k{i}" for i in range(LIMBS)]
PARENT = [f"p{i}" for i in range(LIMBS)]
NODE = ["depth", *KEY]


@dataclass(frozen=True)
class TrieParams:
    """Levels of a band, turns summed at once, and rows numbered in one task."""

    band: int = 32
    block_turns: int = 4096
    part_rows: int = 1_000_000


# ------------------------------------------------------------------------------ conversations

def turns(chats: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """conv_id, place (from 1), n_own, digest and words of every turn."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    role, text = filled("role"), filled("text")
    rows = chats.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = written(rows)  # read twice: to draw the bounds of the ranges and to deal the rows out
    total = rows.count()
    parts = max(1, -(-total // p.part_rows), min(default_parallelism(rows.sparkSession), -(-total // 4096)))
    return number_in_order(rows, ["conv_id"], ["turn", "digest"], parts, "place", "n_own") \
        .select("conv_id", "place", "n_own", "digest", "words")


def rebuilt(own: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """conv_id, place, n_turns, digest and words after the beginnings are shared.

    Conversation c gets the first h = crc32(decimal c) % ``heads`` turns of conversation c - c % ``group``
    (all it has, if fewer) in place of its own first h.  The remainder has the sign of c, as in SQL."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    convs = own.where("place = 1").select("conv_id", "n_own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("from_conv"))
    sources = own.where((F.col("place") < heads) & (F.col("conv_id") % group == 0)).select(
        F.col("conv_id").alias("from_conv"), "place", "digest", "words", F.col("n_own").alias("n_from"))
    # at most heads - 1 turns of a source, each for the fewer than 2 * group conversations that name it
    begun = convs.join(sources, (convs.from_conv == sources.from_conv) & (sources.place <= convs.h)).select(
        convs.conv_id, "place", "digest", "words", "n_from")
    taken = begun.groupBy("conv_id").agg(F.count(F.lit(1)).alias("taken"))
    shift = convs.join(taken, "conv_id", "left").select(
        "conv_id", "h", F.coalesce("taken", F.lit(0)).alias("taken"),
        (F.coalesce("taken", F.lit(0)) + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))).alias("n_turns"))
    shift = written(shift)
    rest = own.select("conv_id", "place", "digest", "words").join(shift, "conv_id").where(F.col("place") > F.col("h")).select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "n_turns", "digest", "words")
    first = begun.join(shift.select("conv_id", "n_turns"), "conv_id").select("conv_id", "place", "n_turns", "digest", "words")
    root = shift.select("conv_id", F.lit(0).cast("long").alias("place"), "n_turns", F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("words"))
    return root.unionByName(first).unionByName(rest)


def paths(convs: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """conv_id, depth, key, parent's key, words and n_turns of every prefix of every conversation (place 0: the root).

    A key is a running sum over the conversation: within blocks of turns, then over the blocks before."""
    mixed = F.sha2(F.concat(F.col("place").cast("string"), F.lit("-"), F.col("digest")), 256)
    rows = convs.withColumn("_m", mixed).withColumns({
        f"_g{i}": F.coalesce(F.conv(F.substring("_m", 1 + 8 * i, 8), 16, 10).cast("long"), F.lit(0)) for i in range(LIMBS)})
    rows = rows.withColumn("_block", F.expr(f"place div {p.block_turns}")).drop("_m", "digest")
    inside = Window.partitionBy("conv_id", "_block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("conv_id", "_block").agg(*[F.sum(f"_g{i}").alias(f"_s{i}") for i in range(LIMBS)])
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "_block", *[F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_b{i}") for i in range(LIMBS)])
    rows = rows.withColumns({f"_w{i}": F.sum(f"_g{i}").over(inside) for i in range(LIMBS)}).join(sums, ["conv_id", "_block"])
    keys = {f"k{i}": F.col(f"_w{i}") + F.col(f"_b{i}") for i in range(LIMBS)}
    parents = {f"p{i}": F.col(f"k{i}") - F.col(f"_g{i}") for i in range(LIMBS)}
    return rows.withColumns(keys).withColumns(parents).select(
        "conv_id", F.col("place").alias("depth"), *KEY, *PARENT, "words", "n_turns")


# ------------------------------------------------------------------------------ totals over subtrees

def rollup(nodes: DataFrame, path: DataFrame, figures: list[str], depth: int, band: int) -> DataFrame:
    """``figures`` of every node (depth, key, conv_id) summed over its subtree.

    ``path`` has (conv_id, depth, key) of all prefixes of the conversations that are nodes' smallest
    members; ``depth`` is the largest depth."""
    banded = path.withColumn("_band", F.expr(f"depth div {band}")).groupBy("conv_id", "_band").agg(
        F.collect_list(F.struct(*NODE)).alias("_above"))  # one element a level of the band
    banded = written(banded)
    sums = [F.sum(f).alias(f) for f in figures]

    def added(rows: DataFrame, at: Column) -> DataFrame:
        """The rows' figures added up at their ancestors (themselves included) in the band ``at``."""
        up = rows.withColumn("_band", at).join(banded, ["conv_id", "_band"])
        up = up.select("conv_id", *figures, F.explode(F.filter("_above", lambda a: a["depth"] <= F.col("depth"))).alias("_a"))
        return up.select("_a.*", "conv_id", *figures).groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *sums)

    partial = added(nodes.select(*NODE, "conv_id", *figures), F.expr(f"depth div {band}"))
    if depth < band:
        return partial
    partial = written(partial)
    # the bands' roots form a tree of their own, band times less deep
    up = F.expr(f"depth div {band}")
    roots = partial.where(F.col("depth") % band == 0).withColumn("depth", up)
    tops = path.where(F.col("depth") % band == 0).withColumn("depth", up)
    done = rollup(roots, tops, figures, depth // band, band).withColumn("depth", F.col("depth") * band)
    done = written(done)
    # a completed root belongs to its ancestors in the band above as well
    passed = added(done.where("depth > 0"), F.expr(f"depth div {band} - 1"))
    rest = partial.where(F.col("depth") % band != 0).select(*NODE, "conv_id", *figures)
    both = rest.unionByName(passed.where(F.col("depth") % band != 0)) \
        .groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *sums)
    return both.unionByName(done.select(*NODE, "conv_id", *figures))


# ------------------------------------------------------------------------------ ends

def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a node from its pieces in order: the SHA-256 of the pieces joined by commas."""
    now, running, out = None, None, []

    def rows(found: list) -> pa.RecordBatch:
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())],
                                          [*NODE, "ends_sha256"])

    for batch in batches:
        names = [batch.column(c).to_pylist() for c in NODE]
        for *node, piece in zip(*names, batch.column("piece").to_pylist()):
            if node != now:
                if now is not None:
                    out.append((*now, running.hexdigest()))
                now, running = node, hashlib.sha256()
            else:
                running.update(b",")
            running.update(piece.encode())
        if len(out) >= 4096:
            yield rows(out)
            out = []
    if now is not None:
        out.append((*now, running.hexdigest()))
    if out:
        yield rows(out)


def ends(path: DataFrame) -> DataFrame:
    """ends_sha256 of the nodes at which members end."""
    last = path.where(F.col("depth") == F.col("n_turns")).select("conv_id", *NODE)
    parts = last.repartitionByRange("conv_id").withColumn("_range", F.spark_partition_id())
    pieces = parts.groupBy(*NODE, "_range").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select(*NODE, "_range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("piece"))
    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "_range")
    return ordered.mapInArrow(digests, ", ".join(f"{c} long" for c in NODE) + ", ends_sha256 string")


# ------------------------------------------------------------------------------ the trie

def prefix_trie(convs: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """One row a node of the conversations (conv_id, place, n_turns, digest, words): key, conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    path = written(paths(convs, p))
    nodes = path.groupBy(*NODE, *PARENT).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                             F.max("words").alias("words"))
    nodes = written(nodes)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(a).alias(b) for a, b in zip(PARENT, KEY)]) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"),
                                       "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}))
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    members = nodes.select("conv_id").distinct()
    own_paths = path.select("conv_id", *NODE).join(members, "conv_id", "left_semi")
    figures = ["n_leaves", "saved_tokens"]
    totals = rollup(nodes, own_paths, figures, depth, p.band).select(*NODE, *figures)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(a).alias(b) for a, b in zip(KEY, PARENT)],
                           F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop(*figures, "words").join(parents, ["depth", *PARENT], "left")
    out = out.join(totals, NODE).join(ends(path), NODE, "left")
    return out.select(*KEY, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *figures,
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
