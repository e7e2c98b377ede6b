"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are indexed in blocks: each term has its postings by block and the largest weight it has in
every block. A query bounds each block from above by those largest weights, scores blocks from the
highest bound on, several at once, and stops when no bound reaches the k-th best cosine, so the
neighbours are exact.
Their labels vote by similarity; the votes are calibrated on the examples, each one leaving itself
out. The neighbours are returned as evidence.

Terms are words and beginnings of words, lower-case. The vocabulary has the terms that depend on the
label by a chi-square test; TF-IDF and norms are over this vocabulary.

The index is fitted on at most ``max_examples`` labelled rows, chosen by the hash of their ids; every
document is scored against all of it. A score depends on the text alone.

Defined cases: a null, empty or unknown text has no terms and gets the calibrated score of no
evidence; very long texts are read whole; equal texts get equal scores; ties of cosine go to the
example first in the index; without examples of both labels all scores are the share of label 1, or
0; labels that are null, or not 0 or 1, are no examples; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.shipping import with_package
from coppice.llm.text import stored, whole_text

_WORD = re.compile(r"\w+")
_PREFIXES = (4, 5, 6)
_CALIBRATION_TASKS = 24
_WORDS_SEEN = 200_000
_FIRST_WAVE = 32
_WAVE_GROWTH = 8


@dataclass(frozen=True)
class ToxicitySettings:
    max_examples: int = 20_000
    max_terms: int = 4_096
    min_chi2: float = 30.0
    neighbours: int = 15
    block: int = 128
    prior_weight: float = 0.5
    seed: int = 42


def word_terms(word: str) -> list[str]:
    """A word and its longer beginnings, which families of words share."""
    return [word, *[f"{word[:n]}-" for n in _PREFIXES if len(word) > n]]


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


class Vocabulary:
    """Numbers and idf of the known terms."""

    def __init__(self, terms: list[str], idf: list[float]) -> None:
        self.numbers = {t: i for i, t in enumerate(terms)}
        #: Few words begin like a known term; the others are passed over.
        self.heads = {t.removesuffix("-")[: _PREFIXES[0]] for t in terms}
        self.idf = np.array(idf, dtype=np.float64)
        self.seen: dict[str, tuple[int, ...]] = {}

    def known(self, text: str) -> list[str]:
        """The words that have a known term, in order."""
        heads, n = self.heads, _PREFIXES[0]
        likely = [w for w in _WORD.findall(text.lower()) if w[:n] in heads]
        return [w for w in likely if self._numbers_of(w)]

    def _numbers_of(self, word: str) -> tuple[int, ...]:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) >= _WORDS_SEEN:
                self.seen.clear()
            found = tuple(self.numbers[t] for t in word_terms(word) if t in self.numbers)
            self.seen[word] = found
        return found

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}}

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of unit length; (1 + log tf) · idf before scaling."""
        found = Counter(i for w in self.known(text) for i in self._numbers_of(w))
        terms = np.array(sorted(found), dtype=np.int64)
        tf = np.array([found[i] for i in terms.tolist()], dtype=np.float64)
        weights = (1.0 + np.log(tf)) * self.idf[terms] if len(terms) else tf
        return terms, weights / np.sqrt((weights**2).sum()) if len(terms) else weights


class BlockMaxIndex:
    """Inverted lists over blocks of examples, with the largest weight of each term per block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int) -> None:
        self.block, self.terms = block, terms
        self.blocks = -(-len(vectors) // block)
        none = np.empty(0, dtype=np.int64)
        term = np.concatenate([none, *[t for t, _ in vectors]])
        weight = np.concatenate([np.empty(0), *[w for _, w in vectors]])
        example = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        # Postings by block, then term; a run is the postings of one term in one block.
        order = np.lexsort((example, term, example // block))
        term, in_block = term[order], example[order] // block
        self.weight, self.example = weight[order], example[order].astype(np.int32)
        self.examples = len(vectors)
        runs = np.flatnonzero(np.diff(in_block * max(1, terms) + term, prepend=-1))
        self.run_term, self.run_block = term[runs], in_block[runs]
        self.run_at, self.run_length = runs, np.diff(runs, append=len(term))
        self.run_max = np.maximum.reduceat(self.weight, runs) if len(runs) else self.weight

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1
    ) -> list[tuple[float, int]]:
        """Up to ``k`` pairs of positive cosine and example, best first, ties by example.

        Blocks are scored in waves, each one longer than the last, as numpy's cost per call would
        outweigh that of the few postings of one block.
        """
        if not len(terms) or not self.blocks:
            return []
        query = np.zeros(self.terms)
        query[terms] = weights
        runs = np.flatnonzero(query[self.run_term])
        factor, block = query[self.run_term[runs]], self.run_block[runs]
        bounds = np.bincount(block, factor * self.run_max[runs], self.blocks)
        order = np.argsort(-bounds, kind="stable")
        cosines, found = np.empty(0), np.empty(0, dtype=np.int64)
        at, size = 0, _FIRST_WAVE
        while at < self.blocks:
            least = cosines[k - 1] if len(cosines) >= k else 0.0
            # Sums in another order may differ in the last bits, so equal bounds are looked into.
            wave = order[at : at + size]
            wave = wave[(bounds[wave] > 0.0) & (bounds[wave] * (1 + 1e-9) >= least)]
            if not len(wave):
                break
            in_wave = np.zeros(self.blocks, dtype=bool)
            in_wave[wave] = True
            picked = in_wave[block]
            scores = self._scored(runs[picked], factor[picked])
            if skip >= 0:
                scores[skip] = 0.0
            hits = np.flatnonzero(scores >= least) if least else np.flatnonzero(scores)
            cosines = np.concatenate([cosines, scores[hits]])
            found = np.concatenate([found, hits])
            if len(cosines) > k:
                good = cosines >= np.partition(cosines, len(cosines) - k)[len(cosines) - k]
                cosines, found = cosines[good], found[good]
            best = np.lexsort((found, -cosines))[:k]
            cosines, found = cosines[best], found[best]
            at, size = at + size, size * _WAVE_GROWTH
        return list(zip(cosines.tolist(), found.tolist(), strict=True))

    def _scored(self, runs: np.ndarray, factor: np.ndarray) -> np.ndarray:
        """Sums of weight times factor over the postings of ``runs``, for every example."""
        length = self.run_length[runs]
        end = np.cumsum(length)
        at = np.arange(end[-1]) + np.repeat(self.run_at[runs] - (end - length), length)
        products = self.weight[at] * np.repeat(factor, length)
        return np.bincount(self.example[at], products, self.examples)


def pooled(votes: np.ndarray, labels: np.ndarray) -> tuple[list[float], list[float]]:
    """Non-decreasing share of label 1 by vote: neighbouring groups that fall are pooled."""
    values, at = np.unique(votes, return_inverse=True)
    ones = np.bincount(at, labels, len(values))
    counts = np.bincount(at, minlength=len(values)).astype(float)
    groups: list[list[float]] = []
    for v, one, n in zip(values, ones, counts, strict=True):
        groups.append([v, one, n])
        while len(groups) > 1 and groups[-2][1] * groups[-1][2] >= groups[-1][1] * groups[-2][2]:
            _, one_more, n_more = groups.pop()
            groups[-1][1] += one_more
            groups[-1][2] += n_more
    return [g[0] for g in groups], [g[1] / g[2] for g in groups]


class Model:
    """Vocabulary, index, labels and calibration; its size is bounded by the settings."""

    def __init__(self, examples: list[tuple], terms: list[tuple], settings: ToxicitySettings) -> None:
        self.settings = settings
        n = len(examples)
        self.vocabulary = Vocabulary(
            [t for t, _ in terms], [float(np.log((n + 1) / (df + 1)) + 1) for _, df in terms]
        )
        vectors = [self.vocabulary.vector(text) for _, text, _ in examples]
        # Examples with the same leading term stand together, which tightens the bounds of blocks.
        lead = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        order = sorted(range(n), key=lambda i: (lead[i], examples[i][0]))
        self.ids = [examples[i][0] for i in order]
        self.labels = np.array([examples[i][2] for i in order], dtype=np.float64)
        vectors = [vectors[i] for i in order]
        self.index = BlockMaxIndex(vectors, len(terms), settings.block)
        self.prior = float(self.labels.mean()) if n else 0.0
        self.place = {doc_id: i for i, doc_id in reversed(list(enumerate(self.ids)))}
        self.steps: tuple[list[float], list[float]] = ([0.0], [self.prior])

    def own_vote(self, doc_id: int, text: str) -> float:
        """The vote on an example when it is left out."""
        vector = self.vocabulary.vector(text)
        return self.vote(self.index.nearest(*vector, self.settings.neighbours, self.place[doc_id]))

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Share of label 1 by similarity; the prior has the weight of a distant neighbour."""
        extra = self.settings.prior_weight
        total = sum(s for s, _ in found) + extra
        return (sum(s * self.labels[i] for s, i in found) + extra * self.prior) / total

    def score(self, text: str) -> tuple[float, list[tuple[float, int]]]:
        found = self.index.nearest(*self.vocabulary.vector(text), self.settings.neighbours)
        at = np.searchsorted(self.steps[0], self.vote(found), side="right") - 1
        return self.steps[1][max(0, int(at))], found


def _examples(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most ``max_examples`` labelled rows outside the held-out part.

    Only their ids are broadcast, which the bound keeps small; no text moves but theirs. An id has one
    example, the least text and label of its rows, so that the bound holds where ids repeat, and an
    example that is left out leaves no copy of its row.
    """
    usable = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).select(
        F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")
    )
    order = F.xxhash64(F.lit(settings.seed), F.col("_id"))
    chosen = stored(usable.orderBy(order, "_id", "toxic").limit(settings.max_examples), "examples")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    joined = slim.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    least = joined.groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("_least"))
    return stored(least.select("doc_id", "_least.text", "_least.toxic"), "example-texts")


def _terms(examples: DataFrame, settings: ToxicitySettings) -> list[tuple[str, int]]:
    """Terms that depend on the label, with their document counts; at most ``max_terms``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                words = set(_WORD.findall(text.as_py().lower()))
                counts[toxic.as_py()].update({t for w in words for t in word_terms(w)})
        terms = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in counts]],
            ["term", "clean", "toxic"],
        )

    each = with_package(examples.select("text", "toxic")).mapInArrow(
        run, "term string, clean long, toxic long"
    )
    ones, n = examples.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    c, d = F.lit(float(ones)) - a, F.lit(float(n - ones)) - b
    chi2 = F.lit(float(n)) * F.pow(a * d - b * c, F.lit(2.0)) / ((a + b) * (c + d) * (a + c) * (b + d))
    kept = (
        each.groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("df", F.col("clean") + F.col("toxic"))
        .filter((F.col("df") < n) & F.lit(0 < ones < n))
        .withColumn("_chi2", chi2)
        .filter(F.col("_chi2") >= settings.min_chi2)
        .orderBy(F.desc("_chi2"), "term")
        .limit(settings.max_terms)
    )
    return [(r["term"], r["df"]) for r in kept.select("term", "df").collect()]


def fitted(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()
) -> Model:
    """The model; the bounded examples come to the driver with the words of the vocabulary only."""
    examples = _examples(docs, labels, settings)
    terms = _terms(examples, settings)
    known = Vocabulary([t for t, _ in terms], [1.0] * len(terms))
    schema = "doc_id long, text string, toxic int"

    def shorten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [" ".join(known.known(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), batch.column(2)],
                ["doc_id", "text", "toxic"],
            )

    slim = stored(with_package(examples).mapInArrow(shorten, schema), "example-words")
    model = Model([tuple(r) for r in slim.collect()], terms, settings)

    def leave_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0), batch.column(1), strict=True)
            votes = [model.own_vote(d.as_py(), t.as_py()) for d, t in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(votes, pa.float64()), batch.column(2)], ["vote", "toxic"]
            )

    if 0.0 < model.prior < 1.0:
        dealt = slim.repartition(_CALIBRATION_TASKS, "doc_id")
        votes = dealt.mapInArrow(leave_out, "vote double, toxic int").toPandas()
        model.steps = pooled(votes["vote"].to_numpy(), votes["toxic"].to_numpy())
    return model


def scored(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence)`` for every document.

    ``evidence`` lists the neighbours: their ``doc_id``, cosine and label.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = [], []
            for text in batch.column(1):
                score, found = model.score(text.as_py() or "")
                scores.append(score)
                evidence.append(
                    [
                        {"doc_id": model.ids[i], "cosine": s, "label": int(model.labels[i])}
                        for s, i in found
                    ]
                )
            kind = pa.list_(
                pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                ["doc_id", "score", "evidence"],
            )

    slim = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    schema = (
        "doc_id long, score double, evidence array<struct<doc_id: long, cosine: double, label: int>>"
    )
    rows = with_package(slim).mapInArrow(run, schema)
    return rows.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )
