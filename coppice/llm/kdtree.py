"""Exact search for the highest inner products, over KD-trees per shard.

Vectors are quantised to integers, ``floor(64 * x)``, and dealt over shards of about ``SHARD_ROWS``
rows by the hash of a row number. Each shard is a tree: a node is halved at the median of its widest
dimension, and keeps the tight box around its vectors. The box bounds the score of a query with
anything inside, dimension by dimension; a query visits nodes by falling bound and stops below its
kth best score so far.

That score is propagated from shard to shard: shards are searched in waves, each of as many shards
as all before it, and a query brings along the kth score of the waves before. A query so gets about
k rows from each wave, whatever the number of shards. Every wave joins blocks of queries with trees by
shard; a tree is sent once for each ``QUERIES_PER_TASK`` queries.

Defined cases: vectors that are null, or hold a null or a number that is not finite, take no part.
Shorter vectors count as if filled up with zeros. Components and scores saturate at 64 bits, and
so may be equal there; below, scores are exact. Every row but the query's own is a candidate, also one with the
same ``vec_id``; null ids come last among equal scores. Repeated query ids each have their result,
without telling them apart. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.shipping import with_package
from coppice.llm.text import stored, with_row_key

SHARD_ROWS = 8192
LEAF_ROWS = 256
QUERY_BLOCK = 64
QUERIES_PER_TASK = 512

#: Whole numbers up to here are exact in floating point.
EXACT = 1 << 53

_LONG = np.iinfo(np.int64)  # its limits are Python numbers


def _packed(**arrays: np.ndarray) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    return buffer.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as arrays:
        return dict(arrays)


def _matrix(vectors: list[list[int]]) -> np.ndarray:
    """Rows of equal length, filled up with zeros."""
    matrix = np.zeros((len(vectors), max(map(len, vectors), default=0)), dtype=np.int64)
    for row, vector in zip(matrix, vectors, strict=True):
        row[: len(vector)] = vector
    return matrix


def _rows(rows: list[int], ids: list[int | None], vectors: list[list[int]]) -> dict[str, np.ndarray]:
    return {
        "rows": np.array(rows, dtype=np.int64),
        "ids": np.array([i or 0 for i in ids], dtype=np.int64),
        "nameless": np.array([i is None for i in ids], dtype=bool),
        "points": _matrix(vectors),
    }


def build(part: dict[str, np.ndarray], leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """The arrays of a tree: rows in leaf order, and of each node its span, first child and box.

    The second child follows the first; a leaf has the child -1.
    """
    points = part["points"]
    order, spans, child, low, high = np.arange(len(points)), [(0, len(points))], [], [], []
    node = 0
    while node < len(spans):
        start, stop = spans[node]
        inside = points[order[start:stop]]
        low.append(inside.min(axis=0))
        high.append(inside.max(axis=0))
        # As floating-point numbers: a width can exceed 64 bits.
        width = high[-1].astype(float) - low[-1].astype(float)
        if stop - start <= leaf_rows or not width.any():
            child.append(-1)
        else:
            half = (stop - start) // 2
            split = np.argpartition(inside[:, int(width.argmax())], half)
            order[start:stop] = order[start:stop][split]
            child.append(len(spans))
            spans += [(start, start + half), (start + half, stop)]
        node += 1
    return {
        **{name: values[order] for name, values in part.items()},
        "spans": np.array(spans, dtype=np.int64),
        "child": np.array(child, dtype=np.int64),
        "low": np.array(low),
        "high": np.array(high),
    }


class Tree:
    """A tree ready to be searched with vectors of any length."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.rows, self.ids, self.nameless = arrays["rows"], arrays["ids"], arrays["nameless"]
        self.spans, self.child = arrays["spans"].tolist(), arrays["child"].tolist()
        self.whole = [arrays[name] for name in ("points", "low", "high")]
        self.floating = [values.astype(float) for values in self.whole]
        self.largest = float(np.abs(self.floating[0]).max(initial=0))

    def nearest(
        self, queries: dict[str, np.ndarray], least: list[int | None], k: int
    ) -> Iterator[tuple[int, list[tuple[int, int | None]]]]:
        """``(query, [(score, vec_id), …])`` with up to k rows of at least the query's given score."""
        width = self.whole[0].shape[1]
        asked = np.zeros((len(queries["rows"]), width), dtype=np.int64)
        asked[:, : queries["points"].shape[1]] = queries["points"][:, :width]
        exact = width * self.largest * float(np.abs(asked.astype(float)).max(initial=0)) < EXACT
        points, low, high = (
            self.floating if exact else [values.astype(object) for values in self.whole]
        )
        asked = asked.astype(float if exact else object)
        bounds = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
        for i, own in enumerate(queries["rows"].tolist()):
            best = self._search(points, asked[i], own, bounds[i].tolist(), least[i], k)
            yield i, [(int(-score), None if late else vec_id) for score, late, vec_id in best]

    def _search(
        self,
        points: np.ndarray,
        query: np.ndarray,
        own: int,
        bounds: list,
        least: int | None,
        k: int,
    ) -> list[tuple]:
        """Best first: the heap holds nodes by falling bound."""
        floor = -np.inf if least is None else least
        best: list[tuple] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < floor:
                break
            first = self.child[node]
            if first >= 0:
                for child in (first, first + 1):
                    if bounds[child] >= floor:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            start, stop = self.spans[node]
            scores = points[start:stop] @ query
            if scores.dtype == object:
                scores = np.clip(scores, _LONG.min, _LONG.max)
            near = np.flatnonzero((scores >= floor) & (self.rows[start:stop] != own))
            if not len(near):
                continue
            places = near + start
            found = zip(
                (-scores[near]).tolist(), self.nameless[places].tolist(), self.ids[places].tolist(), strict=True
            )
            best = heapq.nsmallest(k, [*best, *found])
            if len(best) == k:
                floor = max(floor, -best[-1][0])
        return best


def quantised(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _finite(vector: str) -> Column:
    infinity = F.lit(float("inf"))
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity)
    )


def _in_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _trees(points: DataFrame, leaf_rows: int) -> DataFrame:
    """``(_shard, _data)``: one row per shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in groupby(_in_partition(batches), lambda r: r["_shard"]):
            members = list(rows)
            part = _rows(*([m[c] for m in members] for c in ("_row", "vec_id", "_code")))
            tree = _packed(**build(part, leaf_rows))
            yield pa.RecordBatch.from_pydict({"_shard": [shard], "_data": [tree]})

    placed = points.repartition("_shard").sortWithinPartitions("_shard", "_row")
    return with_package(placed).mapInArrow(run, "_shard long, _data binary")


def _blocks(queries: DataFrame) -> DataFrame:
    """``(_first, _data)``: blocks of queries with the scores they have to reach."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(at, QUERY_BLOCK).to_pydict()
                least = part["_least"]
                block = _packed(
                    **_rows(part["_row"], part["vec_id"], part["_code"]),
                    least=np.array([x or 0 for x in least], dtype=np.int64),
                    bounded=np.array([x is not None for x in least], dtype=bool),
                )
                yield pa.RecordBatch.from_pydict({"_first": [part["_row"][0]], "_data": [block]})

    slim = queries.select("_row", "vec_id", "_code", "_least")
    return with_package(slim).mapInArrow(run, "_first long, _data binary")


def _searched(work: DataFrame, k: int) -> DataFrame:
    """Search each tree with the blocks that follow it; one tree and one block are held at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for row in _in_partition(batches):
            arrays = _unpacked(row["_data"])
            if row["_kind"] == 0:
                tree = Tree(arrays)
                continue
            least = [
                int(score) if bounded else None
                for score, bounded in zip(arrays["least"], arrays["bounded"], strict=True)
            ]
            out: dict[str, list] = {name: [] for name in ("_row", "query_id", "vec_id", "score")}
            for i, best in tree.nearest(arrays, least, k):
                for score, vec_id in best:
                    out["_row"].append(int(arrays["rows"][i]))
                    out["query_id"].append(None if arrays["nameless"][i] else int(arrays["ids"][i]))
                    out["vec_id"].append(vec_id)
                    out["score"].append(score)
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})

    placed = work.repartition("_shard", "_slice").sortWithinPartitions("_shard", "_slice", "_kind")
    return with_package(placed).mapInArrow(
        run, "_row long, query_id long, vec_id long, score long"
    )


def _each(first: int, end: int) -> Column:
    """One row for every number from ``first`` up to, not including, ``end``."""
    return F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long")))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def highest_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest scores of each row that ``is_query``.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    """
    keyed, _ = with_row_key(
        vectors.filter(_finite("embedding")).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            quantised("embedding", scale).alias("_code"),
        )
    )
    queries = keyed.filter(F.coalesce(is_query, F.lit(False)))
    total, n_queries = keyed.count(), queries.count()
    shards, slices = -(-total // shard_rows), max(1, -(-n_queries // QUERIES_PER_TASK))
    shard = F.pmod(F.xxhash64("_row"), F.lit(max(1, shards))).alias("_shard")
    trees = stored(_trees(keyed.select(shard, "*"), leaf_rows), "trees")

    best = None
    done = 0
    while done < shards:
        upto = min(shards, max(1, 2 * done))
        asked = queries.withColumn("_least", F.lit(None).cast("long"))
        if best is not None:
            reached = best.filter(F.col("rank") == k).select("_row", F.col("score").alias("_least"))
            asked = queries.join(reached, "_row", "left")
        blocks = _blocks(asked).select(
            _each(done, upto).alias("_shard"),
            F.pmod(F.xxhash64("_first"), F.lit(slices)).alias("_slice"),
            F.lit(1).alias("_kind"),
            "_data",
        )
        sent = trees.filter((F.col("_shard") >= done) & (F.col("_shard") < upto)).select(
            "_shard",
            _each(0, slices).alias("_slice"),
            F.lit(0).alias("_kind"),
            "_data",
        )
        found = _searched(sent.unionByName(blocks), k)
        if best is not None:
            found = best.drop("rank").unionByName(found)
        best = stored(_ranked(found, k), "best")
        done = upto
    if best is None:
        empty = "_row long, query_id long, vec_id long, score long, rank int"
        best = vectors.sparkSession.createDataFrame([], empty)
    return best.select("query_id", "rank", "vec_id", "score")
