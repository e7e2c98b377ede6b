"""A prefix trie over conversations, rolled up by centroid decomposition.

Turns are cut to a digest and a word count before anything moves. They are placed by a range sort over
conversation and turn, so that one very long conversation is spread over tasks: numbers and running
digests are made within each range, and what a conversation brings from the ranges before is added
from a table of one row per range. A node is known by the exclusive or of 128-bit digests of
(position, role, text) over its turns; equal sequences have equal digests, and others differ but for
one chance in 2^128 or so.

Sums over subtrees come from :mod:`centroids`. The weight of a node is the number of turns its members
have from there on; the walk that leads to it is its smallest member.

The digests of the conversations that end at a node are made from pieces of up to ``PIECE`` ids: the
ids are sorted over nodes and tasks, joined to pieces where they lie, and the pieces streamed through
the hash in order.

Defined cases: rows without a ``conv_id`` take no part; a null turn comes before all others; turns with
one number follow by a digest of role and text, repeated rows being repeated turns; null roles and
texts are empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from coppice.llm.centroids import LIMIT, forest_sums
from coppice.llm.shipping import with_package
from coppice.llm.text import count_words, stored, whole_text

#: Conversations share the opening of the one whose id is the multiple of ``FAMILY`` at or below.
FAMILY = 20
OPENINGS = 4
PIECE = 512

ROOT = "0" * 32


def _slim(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, _d1, _d2, words)``; the digest has 120 bits."""
    role, text = whole_text("role"), whole_text("text")
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)

    def limb(at: int) -> Column:
        return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")

    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        limb(1).alias("_d1"),
        limb(16).alias("_d2"),
        count_words(text).alias("words"),
    )


def _before(totals: DataFrame, merged: dict[str, Column]) -> DataFrame:
    """What each conversation brings to a range from the ranges before; one row per range at most."""
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    rows = totals.select("_part", "conv_id", *[v.over(earlier).alias(k) for k, v in merged.items()])
    return stored(rows.filter(F.col(next(iter(merged))).isNotNull()), "before")


def _within() -> WindowSpec:
    """The turns of one conversation in one range, in order."""
    return Window.partitionBy("_part", "conv_id").orderBy("_at")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """The slim turns with ``pos``, from 1 in each conversation, and where they lie."""
    order = ["conv_id", F.asc_nulls_first("turn"), "_d1", "_d2", "_n"]
    placed = stored(
        _slim(conversations)
        .withColumn("_n", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_n")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "placed",
    )
    counts = placed.groupBy("_part", "conv_id").agg(F.count(F.lit(1)).alias("_n"))
    before = _before(counts, {"_past": F.sum("_n")})
    numbered = placed.withColumn("_here", F.row_number().over(_within())).join(
        before, ["_part", "conv_id"], "left"
    )
    pos = (F.col("_here") + F.coalesce("_past", F.lit(0))).cast("long").alias("pos")
    return stored(numbered.select("conv_id", pos, "_d1", "_d2", "words", "_part", "_at"), "turns")


def _step(pos: Column, d1: Column, d2: Column) -> tuple[Column, Column]:
    """Digest of a turn at a position, as two longs."""
    pos = pos.cast("long")
    return F.xxhash64(pos, d1, d2), F.xxhash64(d2, pos, d1, F.lit(2))


def _hex(first: Column, second: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in (first, second)]))


def _openings(turns: DataFrame) -> DataFrame:
    """``(_base, _open)``: the first turns of every conversation that others share, with digests."""
    first = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < OPENINGS))
    e1, e2 = _step(F.col("pos"), F.col("_d1"), F.col("_d2"))
    turn = F.struct("pos", e1.alias("e1"), e2.alias("e2"), "words")
    return first.groupBy(F.col("conv_id").alias("_base")).agg(
        F.sort_array(F.collect_list(turn)).alias("_open")
    )


def _xor(turns: Column, field: str) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(t[field]))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations, ``(conv_id, length)``, and their turns after the exchange of openings.

    With h = crc32(decimal id) % 4: the first h turns of conversation ``id - id % 20``, all if it has
    fewer, then the own turns after the first h. A turn has its ``depth`` in the rebuilt conversation,
    the digest ``node`` of the sequence that it ends, and that of its ``parent``.
    """
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(OPENINGS)).cast("int")
    open_ = F.coalesce("_open", F.array().cast(_openings(turns).schema["_open"].dataType))
    length = F.size("_open") + F.greatest(F.col("_own") - F.col("_skip"), F.lit(0))
    convs = stored(
        turns.groupBy("conv_id")
        .agg(F.max("pos").alias("_own"))
        .withColumns({"_base": F.col("conv_id") - F.col("conv_id") % FAMILY, "_skip": shared})
        .join(_openings(turns), "_base", "left")
        .withColumn("_open", F.slice(open_, 1, F.col("_skip")))
        .select("conv_id", "_skip", "_open", length.cast("long").alias("length")),
        "conversations",
    )

    def upto(i: Column) -> Column:
        return F.slice("_open", F.lit(1), i + 1)

    prefixes = F.transform(
        "_open",
        lambda t, i: F.struct(
            (i + 1).cast("long").alias("depth"),
            _xor(upto(i), "e1").alias("s1"),
            _xor(upto(i), "e2").alias("s2"),
            t["e1"].alias("e1"),
            t["e2"].alias("e2"),
            t["words"].alias("words"),
        ),
    )
    opening = convs.select("conv_id", "length", F.inline(prefixes))

    depth = F.col("pos") - F.col("_skip") + F.size("_open")
    e1, e2 = _step(F.col("depth"), F.col("_d1"), F.col("_d2"))
    own = stored(
        turns.join(convs, "conv_id")
        .filter(F.col("pos") > F.col("_skip"))
        .withColumn("depth", depth.cast("long"))
        .select(
            "conv_id", "length", "depth", "words", "_part", "_at", e1.alias("e1"), e2.alias("e2"),
            _xor(F.col("_open"), "e1").alias("o1"), _xor(F.col("_open"), "e2").alias("o2"),
        ),
        "own",
    )
    totals = own.groupBy("_part", "conv_id").agg(F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"))
    before = _before(totals, {"b1": F.bit_xor("x1"), "b2": F.bit_xor("x2")})
    running = _within().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = own.withColumns(
        {"r1": F.bit_xor("e1").over(running), "r2": F.bit_xor("e2").over(running)}
    ).join(before, ["_part", "conv_id"], "left")

    def whole(k: str) -> Column:
        run = F.col(f"o{k}").bitwiseXOR(F.col(f"r{k}"))
        return run.bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))).alias(f"s{k}")

    after = summed.select("conv_id", "length", "depth", whole("1"), whole("2"), "e1", "e2", "words")
    both = opening.unionByName(after)
    parent = _hex(F.col("s1").bitwiseXOR(F.col("e1")), F.col("s2").bitwiseXOR(F.col("e2")))
    members = both.select(
        "conv_id", "length", "depth", "words", _hex(F.col("s1"), F.col("s2")).alias("node"), parent.alias("parent")
    )
    return convs.select("conv_id", "length"), stored(members, "members")


def _ends(convs: DataFrame, members: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` for nodes at which conversations end."""
    ends = (
        members.filter("depth = length")
        .select("node", "conv_id")
        .unionByName(convs.filter("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    )

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            out: list[tuple[str, int, str]] = []
            for n, c in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if ids and (n != node or len(ids) == PIECE):
                    out.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = n
                ids.append(c)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["node", "first", "ids"])
        if ids:
            yield pa.RecordBatch.from_pydict(
                {"node": [node], "first": [ids[0]], "ids": [",".join(map(str, ids))]}
            )

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for node, parts in groupby(rows, lambda r: r["node"]):
            digest = hashlib.sha256(next(parts)["ids"].encode())
            for part in parts:
                digest.update(f",{part['ids']}".encode())
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [digest.hexdigest()]})

    sorted_ends = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = with_package(sorted_ends).mapInArrow(pieces, "node string, first long, ids string")
    streamed = joined.repartition("node").sortWithinPartitions("node", "first")
    return streamed.mapInArrow(digests, "node string, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node: its smallest member, depth, counts, and what its subtree adds up to.

    ``limit`` is the number of nodes of a component that a task holds.
    """
    convs, members = rebuilt(numbered_turns(conversations))
    whole = convs.agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") + 1).alias("weight"),
    ).filter("n_convs > 0")
    top = whole.select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), "conv_id",
        F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("words"), "weight",
    )
    nodes = members.groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    nodes = stored(nodes.unionByName(top), "nodes")
    children = (
        nodes.filter("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = stored(nodes.join(children, "node", "left").fillna(0, ["n_children"]), "family")

    weights = nodes.select("node", "weight")
    steps = members.select(F.col("conv_id").alias("walk"), "node", "depth").unionByName(
        convs.select(F.col("conv_id").alias("walk"), F.lit(ROOT).alias("node"), F.lit(0).cast("long").alias("depth"))
    )
    paths = stored(steps.join(weights, "node"), "paths")
    summed = forest_sums(
        nodes.select(
            "node",
            F.col("parent").alias("up"),
            F.col("conv_id").alias("walk"),
            "depth",
            "weight",
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        ),
        paths,
        ["n_leaves", "saved_tokens"],
        limit,
    )
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(summed, "node")
        .join(_ends(convs, members), "node", "left")
        .join(above, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
