"""Mixing sources to target weights by repeating and thinning whole documents.

The words of each source are counted, targets are derived from the weights, and a source's rate is
its target by its size. Every document is emitted ``floor(rate)`` times, and once more if a draw
seeded by the hash of its id and text falls below the fraction. Only built-in functions are used.

Defined cases: a null text has no words; a null source is a source of its own, ranked last; a source
without words has rate 0; rows that repeat a ``doc_id``, or have none, draw by their texts,
and those that repeat both get the same draw; an empty table gives an
empty mix. Other columns are carried along by :func:`mixed` and ignored by :func:`mix_plan`; columns
whose names clash with the ones added are replaced in the plan only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.llm.ranks import with_rank
from coppice.llm.text import count_words, stored, whole_text


@dataclass(frozen=True)
class MixSettings:
    """``weights`` repeat over the sources in code point order; ``max_repeat`` bounds every rate."""

    weights: Sequence[int] = (1, 2, 3)
    max_repeat: int = 3
    seed: int = 42


def source_sizes(docs: DataFrame) -> DataFrame:
    """``(source, source_size)``; counted in every task before one row per source moves."""
    return docs.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum(count_words(whole_text())).alias("source_size")
    )


def source_targets(sizes: DataFrame, settings: MixSettings) -> DataFrame:
    """``(source, source_size, target)``: shares by weight, none above ``max_repeat`` times its size.

    What a source can't take is shared again by weight among the others, until none is above. Each
    round is one aggregation to two numbers; sums are whole numbers and each target is one
    division, so that reruns and other engines agree to the last bit.
    """
    weights = F.array(*[F.lit(w) for w in settings.weights])
    ranked = stored(
        with_rank(sizes, [F.col("source").isNull(), F.col("source")], "_rank").select(
            "source",
            "source_size",
            weights[(F.col("_rank") % len(settings.weights)).cast("int")].cast("long").alias("_w"),
            (F.lit(settings.max_repeat) * F.col("source_size")).alias("_cap"),
        ),
        "mix-sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    full = F.lit(False)
    while True:
        left, weight, at_cap = ranked.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0)),
            F.coalesce(F.sum(full.cast("long")), F.lit(0)),
        ).first()
        # The level only rises from round to round, so sources that are full stay so.
        above = _product(F.col("_w"), F.lit(left)) > _product(F.col("_cap"), F.lit(weight))
        if not weight or ranked.filter(above).count() == at_cap:
            break
        full = above
    share = (F.col("_w") * F.lit(left)).cast("double") / F.lit(float(weight or 1))
    target = F.when(full, F.col("_cap").cast("double")).otherwise(share)
    return ranked.select("source", "source_size", target.alias("target"))


def _product(a: Column, b: Column) -> Column:
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def draw(seed: int) -> Column:
    """A number in [0, 1) from 32 bits of the hash of seed, id and text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.concat(F.lit(f"{seed}|"), doc_id, F.lit("|"), F.md5(whole_text()))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _copies(settings: MixSettings) -> Column:
    rate = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")
    ).otherwise(F.lit(0.0))
    return (F.floor(rate) + (draw(settings.seed) < rate - F.floor(rate)).cast("long")).cast("int")


def _with_targets(docs: DataFrame, settings: MixSettings) -> DataFrame:
    """Add the targets by source; one narrow row per source is joined, by Catalyst's size check."""
    targets = stored(source_targets(source_sizes(docs), settings), "mix-targets")
    key = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return docs.join(key, F.col("source").cast("string").eqNullSafe(F.col("_source")), "left")


def mix_plan(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """``(doc_id, size, source, source_size, target, copies, taken)`` for every document."""
    slim = docs.select("doc_id", "text", "source")
    return (
        _with_targets(slim, settings)
        .select(
            "doc_id",
            count_words(whole_text()).alias("size"),
            "source",
            "source_size",
            "target",
            _copies(settings).alias("copies"),
        )
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mixed(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mix itself: every document with all its columns, as often as its rate and draw say."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "source", "text")}
    plain = docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns])
    repeats = F.explode(F.array_repeat(F.lit(True), _copies(settings))).alias("_copy")
    return (
        _with_targets(plain, settings)
        .select(*plain.columns, repeats)
        .select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
    )
