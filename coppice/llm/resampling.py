"""Quality selection by importance resampling over hashed n-grams.

Two bag-of-n-grams models are counted over a fixed number of hash buckets: one of target text (rows
labelled good), one of all raw text. A document's log importance is the mean
log ratio of its n-grams, divided by ``temperature``: a sum over all n-grams spreads so widely with
length that noise would decide nothing. Adding Gumbel noise seeded by the hash of the id and keeping
the k largest keys samples k documents without replacement in proportion to their importance; a lower
temperature comes nearer to the k heaviest, a higher one nearer to chance.

Raw counts cover every document. The target model may come from at most ``max_target`` labelled rows,
chosen by the hash of their ids; only their ids are broadcast, which that bound keeps small.

Defined cases: a null or empty text has no n-grams and log importance 0; very long texts are counted
whole; repeated rows get equal keys, ties go by ``doc_id``; without target rows all weights are 0; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.ranks import with_rank
from coppice.llm.shipping import with_package
from coppice.llm.text import stored

_WORDS_KEPT = 300_000
_DOCS_AT_ONCE = 256


@dataclass(frozen=True)
class ResampleSettings:
    """``share`` of the documents is kept; ``buckets`` is a power of two.

    ``temperature`` is in nats per n-gram.
    """

    share: float = 0.9
    buckets: int = 1 << 16
    smoothing: float = 1.0
    temperature: float = 0.1
    max_target: int = 20_000
    seed: int = 42


class _Hashes(dict):
    """Hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def ngram_buckets(text: str, buckets: int) -> np.ndarray:
    """Buckets of all words and pairs of neighbouring words."""
    words = text.encode().lower().split()
    one = np.array([_hashes[w] for w in words], dtype=np.uint64)
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    two ^= two >> np.uint64(29)
    return (np.concatenate([one, two]) & np.uint64(buckets - 1)).astype(np.int64)


def _counts(docs: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, raw, target)`` summed over ``docs(text, is_target)``; each task sends its sums."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCS_AT_ONCE):
                part = batch.slice(at, _DOCS_AT_ONCE)
                found = [ngram_buckets(t.as_py() or "", buckets) for t in part.column(0)]
                good = [f for f, g in zip(found, part.column(1), strict=True) if g.as_py()]
                for k, arrays in enumerate((found, good)):
                    joined = np.concatenate([np.empty(0, dtype=np.int64), *arrays])
                    sums[k] += np.bincount(joined, minlength=buckets)
        seen = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(sums[0][seen]), pa.array(sums[1][seen])],
            ["bucket", "raw", "target"],
        )

    each = with_package(docs).mapInArrow(run, "bucket long, raw long, target long")
    return each.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(docs: DataFrame, good: DataFrame, settings: ResampleSettings) -> np.ndarray:
    """Log ratio of target to raw probability per bucket; ``good`` holds ids of target rows."""
    order = F.xxhash64(F.lit(settings.seed), F.col("doc_id"))
    ids = good.select("doc_id").distinct().orderBy(order, "doc_id").limit(settings.max_target)
    marked = ids.select(F.col("doc_id").alias("_good"), F.lit(True).alias("is_target"))
    chosen = stored(marked, "targets")
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    flagged = slim.join(F.broadcast(chosen), F.col("doc_id") == F.col("_good"), "left")
    table = _counts(flagged.select("text", "is_target"), settings.buckets).toPandas()  # one row per bucket at most
    raw, target = np.zeros(settings.buckets), np.zeros(settings.buckets)
    raw[table["bucket"]], target[table["bucket"]] = table["raw"], table["target"]
    if not target.sum():
        return np.zeros(settings.buckets)

    def logs(counts: np.ndarray) -> np.ndarray:
        smooth = counts + settings.smoothing
        return np.log(smooth / smooth.sum())

    return logs(target) - logs(raw)


def log_weight(text: str, ratios: np.ndarray, temperature: float) -> float:
    found = ratios[ngram_buckets(text, len(ratios))]
    return float(found.mean()) / temperature if len(found) else 0.0


def weighed(docs: DataFrame, ratios: np.ndarray, temperature: float) -> DataFrame:
    """``(doc_id, log_weight)``: the log importance of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [log_weight(t.as_py() or "", ratios, temperature) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.float64())], ["doc_id", "log_weight"]
            )

    slim = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return with_package(slim).mapInArrow(run, "doc_id long, log_weight double")


def resampled(
    docs: DataFrame, good: DataFrame, settings: ResampleSettings = ResampleSettings()
) -> DataFrame:
    """``(doc_id, log_weight, key, selected)`` for every document."""
    # Written first: the sampling of ranges would score every text a second time.
    ratios = log_ratios(docs, good, settings)
    weights = stored(weighed(docs, ratios, settings.temperature), "weights")
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    seeded = F.concat(F.lit(f"{settings.seed}|"), doc_id)
    number = F.conv(F.substring(F.md5(seeded), 1, 12), 16, 10).cast("double")
    uniform = (number + 0.5) / F.lit(float(1 << 48))
    keyed = weights.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))
    ranked = stored(with_rank(keyed, [F.desc("key"), F.col("doc_id")], "_rank"), "resampled")
    kept = round(settings.share * ranked.count())
    return ranked.withColumn("selected", F.col("_rank") < kept).drop("_rank")
