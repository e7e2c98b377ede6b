"""Sums over the subtrees of a forest, by centroid decomposition.

A component is halved at its centroid: the total of the centroid's subtree is added to every node
from the centroid up to the component's top, and the parts that are left, the one above and one below
each child, are split in the same way. No path is walked more than log n times, however deep the
tree.

The forest is first cut into components of at most ``limit`` nodes. Every node has a weight that is
at least its own share plus the weights of its children, the share being one or more; nodes whose
weights divided by ``limit`` have the same whole part belong together where they hang together. Above
``limit`` at most one child of a node can have its parent's whole part, so such a component is a
path; below, it is a whole subtree; and neither has more than ``limit`` nodes. Whole subtrees pass
their totals to the node above. The paths, of which there are at most twice the total weight over
``limit``, are the nodes of a smaller forest, which is cut by ``limit²`` and summed in the same way
before their own nodes are. One component at a time is held by a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.shipping import with_package
from coppice.llm.text import stored

LIMIT = 256


def _split(nodes: list[int], parent: list[int], values: list[list[int]]) -> tuple:
    """The centroid, the sums of its subtree, and the parts that are left without it.

    ``nodes`` has parents before their children; the first is the top.
    """
    size = dict.fromkeys(nodes, 1)
    for node in reversed(nodes[1:]):
        size[parent[node]] += size[node]
    centroid = min((n for n in nodes if 2 * size[n] >= len(nodes)), key=size.__getitem__)
    part = {}
    parts: dict[int, list[int]] = {}
    for node in nodes:
        if node == centroid:
            part[node] = node
            continue
        if node == nodes[0]:
            part[node] = node
        else:
            above = part[parent[node]]
            part[node] = node if above == centroid else above
        parts.setdefault(part[node], []).append(node)
    below = [m for top, members in parts.items() if top != nodes[0] for m in members]
    totals = [sum(values[n][i] for n in (centroid, *below)) for i in range(len(values[centroid]))]
    return centroid, totals, list(parts.values())


def subtree_sums(parent: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums of ``values`` over every node's subtree; node 0 is the top, parents come first."""
    sums = [[0] * len(v) for v in values]
    left = [list(range(len(parent)))]
    while left:
        nodes = left.pop()
        if len(nodes) == 1:
            sums[nodes[0]] = [a + b for a, b in zip(sums[nodes[0]], values[nodes[0]], strict=True)]
            continue
        node, totals, parts = _split(nodes, parent, values)
        top = nodes[0]
        while True:
            sums[node] = [a + b for a, b in zip(sums[node], totals, strict=True)]
            if node == top:
                break
            node = parent[node]
        left += parts
    return sums


def _component_sums(members: DataFrame, values: list[str]) -> DataFrame:
    """``(node, …values)``: sums within the components of ``members(comp, node, up, depth, …)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, component in groupby(rows, lambda r: r["comp"]):
            nodes = list(component)
            place = {row["node"]: i for i, row in enumerate(nodes)}
            parent = [place.get(row["up"], 0) for row in nodes]
            sums = subtree_sums(parent, [[row[v] for v in values] for row in nodes])
            out = {"node": pa.array([row["node"] for row in nodes], pa.string())}
            for i, name in enumerate(values):
                out[name] = pa.array([s[i] for s in sums], pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    placed = (
        members.select("comp", "node", "up", "depth", *values)
        .repartition("comp")
        .sortWithinPartitions("comp", "depth", "node")
    )
    schema = ", ".join(["node string", *(f"{v} long" for v in values)])
    return with_package(placed).mapInArrow(run, schema)


def _with_more(nodes: DataFrame, more: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` with the sums of ``more(up, …values)`` added to the node they hang from."""
    gathered = more.groupBy(F.col("up").alias("node")).agg(
        *[F.sum(v).alias(f"_{v}") for v in values]
    )
    joined = nodes.join(gathered, "node", "left")
    added = {v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values}
    return joined.withColumns(added).drop(*[f"_{v}" for v in values])


def forest_sums(
    nodes: DataFrame, paths: DataFrame, values: list[str], limit: int = LIMIT
) -> DataFrame:
    """``(node, …values)``: for every node the sums over its subtree, itself included.

    ``nodes(node, up, walk, depth, weight, …values)`` has one row per node; ``up`` is the parent, or
    null. ``paths(walk, node, depth, weight)`` lists for every ``walk`` that a node names all nodes
    from the top of its tree down to it, and perhaps beyond.
    """
    most = nodes.agg(F.max("weight")).first()[0]
    return _scale(nodes, paths, values, limit, limit, most or 0)


def _scale(
    nodes: DataFrame, paths: DataFrame, values: list[str], limit: int, unit: int, most: int
) -> DataFrame:
    def class_of(weight: str):
        return F.floor(F.col(weight) / F.lit(unit)).alias("_class")

    tops = (
        paths.select("walk", class_of("weight"), F.struct("depth", "node").alias("_at"))
        .groupBy("walk", "_class")
        .agg(F.min("_at").alias("_top"))
        .select("walk", "_class", F.col("_top.node").alias("comp"))
    )
    placed = stored(
        nodes.withColumn("_class", class_of("weight")).join(tops, ["walk", "_class"]), "components"
    )
    light = placed.filter("_class = 0")
    below = stored(_component_sums(light, values), "subtrees")
    if most < unit:
        return below

    tops_below = light.filter("comp = node").select("node", "up").join(below, "node")
    heavy = stored(_with_more(placed.filter("_class > 0"), tops_below, values), "heavy")
    totals = heavy.groupBy("comp").agg(*[F.sum(v).alias(v) for v in values])
    heads = heavy.filter("comp = node").select("comp", "up", "walk", "depth", "weight")
    above = heavy.select(F.col("node").alias("up"), F.col("comp").alias("_comp_above"))
    contracted = stored(
        heads.join(totals, "comp")
        .join(above, "up", "left")
        .select(F.col("comp").alias("node"), F.col("_comp_above").alias("up"), "walk", "depth", "weight", *values),
        "contracted",
    )
    kept = paths.join(contracted.select("node"), "node", "left_semi")
    summed = stored(_scale(contracted, kept, values, limit, unit * limit, most), "contracted-sums")
    hanging = heads.select(F.col("comp").alias("node"), "up").join(summed, "node")
    along = _component_sums(_with_more(heavy, hanging, values), values)
    return stored(below.unionByName(along), "subtree-sums")
