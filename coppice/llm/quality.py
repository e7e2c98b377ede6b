"""Quality rules: a threshold table compiled into one projection.

Every rule bounds one measure by a multiple of another. The measures are counted in whole texts by
built-in functions, the rules become one Boolean expression, and nothing moves between tasks.

Defined cases: a null or empty text has no words and fails the base rule; very long texts are
measured whole; repeated rows and ties are judged alike; an empty table stays empty. Other columns
are kept by :func:`passing` and not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.llm.text import SPACE_CLASS, SPACES, count_chars, let, whole_text

SYMBOLS = "#*$%&|<>"

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "das der die den ein eine er es ist mit nicht sich sie und von zu "
    "au dans des du elle en est et il la le les par pas pour que qui sur un une "
    "al como con de del el las lo los más no para por se su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``at_least`` and ``at_most`` times ``per``."""

    name: str
    measure: str
    per: str
    at_least: float | None = None
    at_most: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("word_length", "word_chars", "n_words", at_least=2.0, at_most=15.0),
    Rule("symbols", "n_symbols", "n_words", at_most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", at_least=0.02),
    Rule("dup_lines", "n_dup_lines", "n_lines", at_most=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", at_most=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", at_most=0.3),
)

BULLETS = ("•", "- ", "* ")
ELLIPSES = ("...", "…")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice, the first occurrence included.

    Windows are compared by 64-bit hashes of their words' hashes. Without two equal hashes the
    answer is 0; otherwise sorting brings equal windows together.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - F.lit(3))
        return F.transform(starts, lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2]))

    def covered(windows: Column) -> Column:
        placed = F.sort_array(
            F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        )
        return let(placed, in_repeats)

    def in_repeats(placed: Column) -> Column:
        last = F.size(placed) - 1
        again = F.filter(
            placed,
            lambda p, k: ((k > 0) & (F.get(placed, k - 1)["x"] == p["x"]))
            | ((k < last) & (F.get(placed, k + 1)["x"] == p["x"])),
        )
        near = F.transform(again, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2))
        return F.size(F.array_distinct(F.flatten(near))).cast("long")

    def counted(g: Column) -> Column:
        no_repeats = F.size(F.array_distinct(g)) == F.size(g)
        return F.when(no_repeats, F.lit(0).cast("long")).otherwise(covered(g))

    found = let(hashes, lambda h: let(windows(h), counted))
    return F.when(F.size(words) >= 3, found).otherwise(F.lit(0).cast("long"))


def _word_measures(words: Column) -> Column:
    stop_words = F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS)))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        stop_words.cast("long").alias("n_stop_words"),
        _repeat_words(words).alias("n_repeat_words"),
    )


def _line_measures(lines: Column) -> Column:
    def having(marks: Sequence[str], test: str) -> Column:
        def marked(line: Column) -> Column:
            bare = F.trim(line)
            return reduce(lambda a, b: a | b, [getattr(bare, test)(m) for m in marks])

        return F.size(F.filter(lines, marked)).cast("long")

    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        having(BULLETS, "startswith").alias("n_bullet_lines"),
        having(ELLIPSES, "endswith").alias("n_ellipsis_lines"),
    )


def measures(text: Column) -> Column:
    """All measures of a text as one struct of longs, and the word and line parts in structs."""
    words = F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")
    with_word = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0
    )
    return F.struct(
        let(words, _word_measures).alias("by_word"),
        let(with_word, _line_measures).alias("by_line"),
        (F.length(text) - count_chars(text, SPACES)).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).alias("n_symbols"),
    )


def _field(measured: Column, name: str) -> Column:
    if name in ("word_chars", "n_symbols"):
        return measured[name]
    lines = ("n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines")
    return measured["by_line" if name in lines else "by_word"][name]


def base_failed(measured: Column) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    words, repeats = _field(measured, "n_words"), _field(measured, "n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def compiled(rules: Sequence[Rule], measured: Column) -> Column:
    """One Boolean expression for the whole table of rules; measures are compared by products."""
    tests = []
    for rule in rules:
        value, per = _field(measured, rule.measure), _field(measured, rule.per)
        if rule.at_least is not None:
            tests.append(value >= F.lit(rule.at_least) * per)
        if rule.at_most is not None:
            tests.append(value <= F.lit(rule.at_most) * per)
    return reduce(and_, tests, F.lit(True))


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` for every row."""
    measured = docs.select("doc_id", measures(whole_text()).alias("_m"))
    m = F.col("_m")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return measured.select(
        "doc_id",
        *[_field(m, n).alias(n) for n in names],
        base_failed(m).alias("base_failed"),
        (~base_failed(m) & compiled(rules, m)).alias("kept"),
    )


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    keep = let(measures(whole_text()), lambda m: ~base_failed(m) & compiled(rules, m))
    return docs.filter(keep)
