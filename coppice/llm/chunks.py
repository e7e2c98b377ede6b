"""Passages that repeat across documents, by content-defined chunking with a gear rolling hash.

The gear hash of a byte adds a fixed number per byte value to the doubled hash before it; with 16 bits
it depends on the last 16 bytes alone. A chunk ends where the top bits are zero and no such place
lies within ``min_bytes`` before. Where ``max_bytes`` in a row have no such end, it is cut at the
smallest hash of every window of that size, the last one of equals. So all boundaries depend on nearby
content only: an insertion shifts none beyond it, and a passage has the same ones in every document
but for its outer bytes. In periodic text, where each period has a smallest hash, every few periods
are one chunk, equal wherever the counting began.

Chunks are deduplicated by a 64-bit digest: the document with the smallest id keeps a chunk, the
others repeat it. A passage is longer than a chunk, so one pair of chunks with equal digests by chance
makes none. Neighbouring chunks of a document that also occur in other documents make up a
passage, reported from ``min_passage`` bytes on.

Defined cases: a null or empty text has no chunks; very long texts are chunked whole; rows that repeat
a ``doc_id`` are one document to the rest but have their own passages; null ids take no part; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.shipping import with_package
from coppice.llm.text import each_salt, salt, salts_seen, stored

SALTS = 32


@dataclass(frozen=True)
class ChunkSettings:
    """``bits`` zero bits end a chunk: about one byte in ``2 ** bits`` does."""

    bits: int = 5
    min_bytes: int = 16
    max_bytes: int = 64
    min_passage: int = 110
    gear_seed: int = 42


def gear_table(seed: int) -> np.ndarray:
    """One 16-bit number per byte value, from a hash."""
    numbers = [xxhash.xxh64_intdigest(bytes([b]), seed) & 0xFFFF for b in range(256)]
    return np.array(numbers, dtype=np.uint16)


def boundaries(data: bytes, gear: np.ndarray, settings: ChunkSettings) -> list[int]:
    """Ends of the chunks of ``data``, the last one included."""
    values = gear[np.frombuffer(data, dtype=np.uint8)]
    # hash[i] = sum of gear[i - k] << k: doubling the span four times gives all 16 terms.
    for span in (1, 2, 4, 8):
        values[span:] += values[:-span] << np.uint16(span)
    marks = np.flatnonzero(values >> np.uint16(16 - settings.bits) == 0)
    if len(marks):
        marks = marks[np.diff(marks, prepend=-settings.min_bytes) >= settings.min_bytes]
    ends = np.union1d(marks, _smallest(values, marks, settings)) + 1
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    return ends.tolist()


def _smallest(values: np.ndarray, marks: np.ndarray, settings: ChunkSettings) -> np.ndarray:
    """Where the smallest hash lies in each window of ``max_bytes`` that has no mark."""
    size, count = settings.max_bytes, len(values)
    windows = count - size + 1
    if windows < 1:
        return np.empty(0, dtype=np.int64)
    marked = np.zeros(count + 1, dtype=np.int64)
    marked[marks + 1] = 1
    marked = np.cumsum(marked)
    free = marked[size:] == marked[:windows]
    # The place counts backwards in the low half: of equal hashes the last one is the smallest.
    keys = (values.astype(np.uint64) << np.uint64(32)) + np.arange(count, 0, -1, dtype=np.uint64)
    span = 1
    while span < size:  # the smallest key of twice as many, and in the end of exactly ``size``
        step = min(span, size - span)
        keys = np.minimum(keys[:-step], keys[step:])
        span += step
    places = count - np.unique(keys[free] & np.uint64(0xFFFFFFFF)).astype(np.int64)[::-1]
    if len(places) < 2:
        return places
    # Runs of equal hashes at equal distances under min_bytes: one place in every few stays.
    apart = np.diff(places)
    follows = (np.diff(values[places].astype(np.int64)) == 0) & (apart < settings.min_bytes)
    follows[1:] &= ~follows[:-1] | (apart[1:] == apart[:-1])
    starts = np.flatnonzero(~np.concatenate([[False], follows]))
    lengths = np.diff(starts, append=len(places))
    in_run = np.arange(len(places)) - np.repeat(starts, lengths)
    first_apart = np.append(apart, settings.min_bytes)[starts]
    every = np.where(lengths > 1, -(-settings.min_bytes // first_apart), 1)
    return places[in_run % np.repeat(every, lengths) == 0]


def chunked(docs: DataFrame, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """``(doc_id, row, start, n_bytes, digest)``: every chunk with its digest.

    Offsets count UTF-8 bytes.
    """
    gear = gear_table(settings.gear_seed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, starts, sizes, digests = [], [], [], [], []
            columns = [c.to_pylist() for c in batch.columns]
            for doc_id, row, text in zip(*columns, strict=True):
                data = (text or "").encode()
                if not data:
                    continue
                ends = boundaries(data, gear, settings)
                begins = [0, *ends[:-1]]
                digests += [
                    xxhash.xxh3_64_digest(data[a:b]) for a, b in zip(begins, ends, strict=True)
                ]
                ids += [doc_id] * len(ends)
                rows += [row] * len(ends)
                starts += begins
                sizes += [b - a for a, b in zip(begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(rows, pa.int64()),
                    pa.array(starts, pa.int32()),
                    pa.array(sizes, pa.int32()),
                    pa.array(np.frombuffer(b"".join(digests), dtype="<i8"), pa.int64()),
                ],
                ["doc_id", "row", "start", "n_bytes", "digest"],
            )

    slim = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id long, row long, start int, n_bytes int, digest long"
    return with_package(slim).mapInArrow(run, schema)


def shared_chunks(chunks: DataFrame, salts: int = SALTS) -> DataFrame:
    """The chunks that occur in several documents, with ``first_doc_id``, which keeps them.

    Counted per task before anything moves; a chunk that very many rows share is joined in as many
    parts as it has salts.
    """
    firsts = (
        chunks.withColumn("_salt", salt(salts))
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("first_doc_id"),
            F.max("doc_id").alias("_last"),
            salts_seen("_salt").alias("_salts"),
        )
        .filter(F.col("first_doc_id") < F.col("_last"))
        .select("digest", "first_doc_id", each_salt("_salts", salts).alias("_salt"))
    )
    # The salt goes into the digest: one column less in the rows that move.
    salted = F.col("digest").bitwiseXOR(F.col("_salt").cast("long")).alias("digest")
    placed = firsts.select(salted, "first_doc_id")
    kept = [F.col(c) for c in ("doc_id", "row", "start", "n_bytes")]
    spread = chunks.withColumn("_salt", salt(salts)).select(*kept, salted)
    return spread.join(placed, "digest").drop("digest")


def repeated_passages(docs: DataFrame, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """Passages of every document that occur in others too.

    ``(doc_id, start, end, first_doc_id, n_chunks, repeated_bytes, kept)``: the span in bytes, the
    smallest document that has a part of it, and the bytes that an earlier document keeps; ``kept``
    says that there are none.
    """
    shared = shared_chunks(stored(chunked(docs, settings), "chunks"))
    in_row = Window.partitionBy("doc_id", "row").orderBy("start")
    end = F.col("start") + F.col("n_bytes")
    broken = F.coalesce(F.lag(end).over(in_row) != F.col("start"), F.lit(True))
    elsewhere = F.when(F.col("first_doc_id") < F.col("doc_id"), F.col("n_bytes")).otherwise(0)
    return (
        shared.withColumn("_breaks", broken.cast("int"))
        .withColumn("_run", F.sum("_breaks").over(in_row))
        .groupBy("doc_id", "row", "_run")
        .agg(
            F.min("start").cast("long").alias("start"),
            F.max(end).cast("long").alias("end"),
            F.min("first_doc_id").alias("first_doc_id"),
            F.count(F.lit(1)).alias("n_chunks"),
            F.sum(elsewhere).alias("repeated_bytes"),
        )
        .filter(F.col("end") - F.col("start") >= settings.min_passage)
        .withColumn("kept", F.col("repeated_bytes") == 0)
        .drop("row", "_run")
    )
