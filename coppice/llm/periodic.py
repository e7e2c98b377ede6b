"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q and at least ``max(24, 3q)`` words that cannot
grow. A text is cut into blocks of 8, 16, 32, … words. A run with a period from B to 2B - 1 holds a
whole block of B words that recurs q words later, as ``3q >= q + 2B - 1``; blocks of 8 words also
serve the periods below 8. :mod:`convolution` finds the distances at which each block recurs in the
window behind it, and each distance seeds an extension to both sides, word by word. A block one of
whose words does not come again within the window cannot recur and is not transformed.

Shorter periods come first, so a stretch whose smallest period is shorter is known by the run that
covers it. Work is n log² n for n words; a text is handled whole by one task, with memory in
proportion to its words.

Defined cases: a null or empty text has no words and no runs; repeated rows each have their result;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.llm.convolution import recurrences
from coppice.llm.shipping import with_package
from coppice.llm.text import SPACE_CLASS, let, whole_text

SMALLEST_BLOCK = 8
SHORTEST = 24
REPEATS = 3

#: Words handled together; longer texts are handled alone.
WORDS_AT_ONCE = 1 << 18

Run = tuple[int, int, int]


def _numbered(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(group, place in group)`` for ``counts`` members of each group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


def _next_distance(group: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """How many words later the same word comes again in its text; a very large number if never."""
    order = np.lexsort((codes, group))
    same = (codes[order[1:]] == codes[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    distance = np.full(len(codes), np.iinfo(np.int64).max)
    distance[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return distance


def _agreement(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at : min(n, at + step)] != b[at : min(n, at + step)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = min(n, at + step), 2 * step
    return n


class _Text:
    """The words of one text, as codes, and the runs found so far, as ``(start, end, period)``."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.found: list[Run] = []

    def extend(self, period: int, seeds: np.ndarray, block: int) -> None:
        """Grow the seeds of one period; ``seeds`` are rising starts of recurring blocks."""
        for start, end, shorter in self.found:
            if period % shorter == 0 and period > shorter:
                seeds = seeds[(seeds < start) | (seeds + period > end)]
        ahead, reached = self.codes[period:], 0
        for seed in seeds.tolist():
            if seed < reached:
                continue
            right = seed + _agreement(self.codes[seed:], ahead[seed:])
            if right < seed + block:
                continue
            left = seed - _agreement(self.codes[:seed][::-1], ahead[:seed][::-1])
            reached = right
            if right + period - left >= max(SHORTEST, REPEATS * period):
                self._add(left, right + period, period)

    def _add(self, start: int, end: int, period: int) -> None:
        if not any(s <= start and end <= e for s, e, _ in self.found):
            self.found.append((start, end, period))

    def runs(self) -> list[Run]:
        """``(start, length, period)`` by start, then period."""
        return sorted((start, end - start, period) for start, end, period in self.found)


def find_runs(sequences: Sequence[np.ndarray]) -> list[list[Run]]:
    """The runs ``(start, length, period)`` of each sequence of codes."""
    texts = [_Text(codes) for codes in sequences]
    lengths = np.array([len(codes) for codes in sequences], dtype=np.int64)
    if lengths.sum() == 0:
        return [[] for _ in texts]
    codes = np.concatenate(sequences)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    distance = _next_distance(np.repeat(np.arange(len(texts)), lengths), codes)

    block, least = SMALLEST_BLOCK, 1
    counts = lengths // block
    owner, place = _numbered(counts)
    starts = begins[owner] + place * block
    farthest = distance[starts[:, None] + np.arange(block)].max(axis=1)
    while lengths.max() >= max(SHORTEST, REPEATS * least):
        most = 2 * block - 1
        live = np.flatnonzero((farthest <= most) & (lengths[owner] >= REPEATS * least))
        which, period = recurrences(codes, starts[live], ends[owner[live]], block, least, most)
        of, at = owner[live[which]], starts[live[which]]
        order = np.lexsort((at, period, of))
        of, at, period = of[order], at[order], period[order]
        cuts = np.flatnonzero((np.diff(of) != 0) | (np.diff(period) != 0)) + 1
        for group in np.split(np.arange(len(of)), cuts) if len(of) else []:
            text = of[group[0]]
            texts[text].extend(int(period[group[0]]), at[group] - begins[text], block)

        first = np.cumsum(counts) - counts
        counts = counts // 2
        owner, place = _numbered(counts)
        left = first[owner] + 2 * place
        starts, farthest = starts[left], np.maximum(farthest[left], farthest[left + 1])
        block, least = 2 * block, 2 * block
    return [text.runs() for text in texts]


def without_repeats(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def _coded(texts: Sequence[str | None]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    words = [(text or "").encode().split() for text in texts]
    seen: dict[bytes, int] = {}
    codes = [np.array([seen.setdefault(w, len(seen)) for w in ws], dtype=np.int64) for ws in words]
    return words, codes


def _portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Consecutive texts of up to ``WORDS_AT_ONCE`` words by their lengths, at least one."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "") // 4
        if size > WORDS_AT_ONCE and i > first:
            yield first, i
            first, size = i, len(text or "") // 4
    if first < len(texts):
        yield first, len(texts)


RUNS = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


def period_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, runs, collapsed)``: the runs by start, then period, and the text without repeats.

    ``start`` counts words from 0. The collapsed text has one space between words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in _portions(texts):
                words, codes = _coded(texts[first:last])
                runs = find_runs(codes)
                kept = [
                    b" ".join(without_repeats(w, r)).decode()
                    for w, r in zip(words, runs, strict=True)
                ]
                rows = [
                    [{"start": s, "length": n, "period": q} for s, n, q in found] for found in runs
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(rows, RUNS), pa.array(kept, pa.string())],
                    ["doc_id", "runs", "collapsed"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return with_package(slim).mapInArrow(
        run,
        "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: about one text in ten repeats itself from some word on.

    With h the crc32 of the decimal id and g = floor(h / 10): where 10 divides h, word i >= a becomes
    word ``a + (i - a) % p``, for n words, a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A row
    without an id is left as it is.
    """
    crc = F.crc32(F.col("doc_id").cast("long").cast("string"))
    g = F.floor(crc / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        first = (g % n).cast("int")
        period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
        return F.array_join(
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: F.get(words, F.when(i < first, i).otherwise(first + (i - first) % period)),
            ),
            " ",
        )

    text = whole_text()
    planted = let(
        F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != ""),
        lambda words: F.when(F.size(words) > 0, repeated(words)).otherwise(F.lit("")),
    )
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(crc % 10 == 0, planted).otherwise(text).alias("text"),
    )


def digested(found: DataFrame) -> DataFrame:
    """Per text the number of runs, the one of highest exact exponent, and digests of the rest."""

    def before(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (a["start"] < b["start"]) | (
            (a["start"] == b["start"]) & (a["period"] < b["period"])
        )
        return F.when((left > right) | ((left == right) & earlier), -1).otherwise(1)

    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")])
    )
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("_best", F.get(F.array_sort("runs", before), F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{name}").alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
