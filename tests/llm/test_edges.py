"""Null and repeated ids, and tables whose columns are named like those the operators add."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from coppice.llm import exact_dedup, mixing, resampling, simhash, toxicity


def test_rows_without_an_id_draw_by_their_texts(spark):
    rows = [(None, "w " * 19 + f"t{i}", "a") for i in range(2000)]
    rows += [(i, "w " * 20, "b") for i in range(2000)] + [(7, "w " * 19 + f"u{i}", "c") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(df).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")
    )
    for r in plan.collect():
        assert abs(r["taken"] / r["target"] - 1) < 0.15


@pytest.mark.parametrize("bits", [8, 256])
def test_copies_without_ids_under_colliding_digests(spark, bits):
    rows = [(None if i % 4 == 0 else i, f"text {i % 40}") for i in range(640)]
    rows += [(5, f"other text {i}") for i in range(10)] + [(None, "lone")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = exact_dedup.marked_copies(df, digest_bits=bits)
    least = {}
    for doc_id, text in rows:
        old = least.get(text)
        least[text] = doc_id if old is None else old if doc_id is None else min(old, doc_id)
    sizes = Counter(text for _, text in rows)
    expected = Counter((d, least[t], sizes[t], d == least[t]) for d, t in rows)
    assert Counter(tuple(r)[:4] for r in got.collect()) == expected


NAMES = ["toxic", "_id", "is_target", "_good", "_dropped", "_row", "_salt", "_digest", "_n", "_least", "keep_id", "fp"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"some words of text number {i % 7}", "a") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({name: F.lit(f"mine {name}") for name in NAMES})


def test_clashing_names(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(40)], "doc_id long, toxic int, quality int")
    model = toxicity.fitted(clashing, labels.withColumn("_id", F.lit("x")))
    assert toxicity.scored(clashing, model).count() == 40
    assert resampling.resampled(clashing, labels.filter("doc_id < 9")).count() == 40
    for stage in (exact_dedup.without_copies, simhash.without_near, mixing.mixed):
        out = stage(clashing)
        assert out.columns == clashing.columns
        assert {r["_dropped"] for r in out.select("_dropped").collect()} == {"mine _dropped"}
    assert exact_dedup.without_copies(clashing).count() == 7


def test_repeated_ids_are_one_example(spark):
    rows = [(2, f"text {i}") for i in range(300)] + [(5, "toxic words"), (6, "clean words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1), (2, 0), (5, 1), (6, 0)], "doc_id long, toxic int")
    settings = toxicity.ToxicitySettings(max_examples=10)
    found = toxicity._examples(docs, labels, settings).collect()
    assert len(found) == len({r["doc_id"] for r in found}) <= 4
    assert toxicity.scored(docs, toxicity.fitted(docs, labels, settings)).count() == len(rows)
