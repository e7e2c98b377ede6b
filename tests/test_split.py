"""Splits against a plain single-machine count, duplicates and hot keys included."""

import hashlib
from collections import Counter, defaultdict
from math import floor

import pytest
from pyspark.sql import functions as F

from coppice.operators import split
from coppice.operators.rows import first_shuffled, repeated, shuffled, stable_layout
from coppice.operators.split import hash_split, native_split, quotas, sides, stratified_split


def key_hash(seed, key):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def expected_quotas(labels, fraction):
    counts = Counter(labels)
    exact = {c: round(fraction * n, 9) for c, n in counts.items()}
    base = {c: floor(x) for c, x in exact.items()}
    seats = floor(round(fraction * len(labels), 9)) - sum(base.values())
    order = sorted(counts, key=lambda c: (-round(exact[c] - base[c], 9), c))
    return {c: base[c] + (c in order[:seats]) for c in counts}


def check_split(rows, flagged, fraction, seed=42):
    """rows: (label, key, x); flagged: the same with is_train."""
    assert Counter(r[:3] for r in flagged) == Counter(rows)
    wanted = expected_quotas([r[0] for r in rows], fraction)
    got = Counter(r[0] for r in flagged if r[3])
    assert {c: got.get(c, 0) for c in wanted} == wanted
    by_class = defaultdict(lambda: ([], []))
    for label, key, _, train in flagged:
        by_class[label][0 if train else 1].append(key_hash(seed, key))
    for inside, outside in by_class.values():
        if inside and outside:
            assert max(inside) <= min(outside)


def run_split(spark, rows, fraction=0.7, partitions=5):
    df = spark.createDataFrame(rows, "label string, key bigint, x double").repartition(partitions)
    flagged = stratified_split(df, "label", ["key"], fraction)
    assert flagged.columns == ["label", "key", "x", "is_train"]
    return [tuple(r) for r in flagged.collect()]


CASES = {
    "unique keys": [(f"c{i % 3}", i, float(i)) for i in range(300)],
    "uneven classes": [("a" if i % 10 else "b", i, 0.5) for i in range(203)],
    "tiny classes": [("a", 1, 0.0), ("b", 2, 0.0), ("c", 3, 0.0), ("c", 4, 0.0)],
    "one class": [("only", i, 1.0) for i in range(50)],
    "hot key, different rows": [("a", 7 if i < 150 else i, float(i)) for i in range(300)],
    "hot key, exact copies": [("a", 7 if i < 250 else i, 1.0) for i in range(300)],
    "hot key in two classes": [("ab"[i % 2], i % 3, float(i % 2)) for i in range(400)],
    "all rows equal": [("a", 1, 1.0)] * 101,
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_stratified_split(spark, case):
    rows = CASES[case]
    flagged = run_split(spark, rows)
    check_split(rows, flagged, 0.7)
    assert Counter(flagged) == Counter(run_split(spark, rows, partitions=2))


@pytest.mark.parametrize("fraction", [0.01, 0.5, 0.99])
def test_stratified_fractions(spark, fraction):
    rows = CASES["uneven classes"]
    check_split(rows, run_split(spark, rows, fraction), fraction)


def test_null_label_is_a_class_of_its_own(spark):
    rows = [(None if i % 2 else "a", i, 0.0) for i in range(100)]
    flagged = run_split(spark, rows)
    assert Counter((r[0], r[3]) for r in flagged) == {
        (None, True): 35,
        (None, False): 15,
        ("a", True): 35,
        ("a", False): 15,
    }


def test_null_values_tell_rows_apart(spark):
    df = spark.range(40).select(
        F.lit("a").alias("label"),
        F.lit(1).alias("key"),
        F.when(F.col("id") < 20, 1).alias("x"),
        F.when(F.col("id") >= 20, 1).alias("y"),
    )
    rows = stratified_split(df, "label", ["key"], 0.7).collect()
    assert sum(r["is_train"] for r in rows) == 28
    assert Counter((r["x"], r["y"]) for r in rows) == {(1, None): 20, (None, 1): 20}


def test_empty_table(spark):
    df = spark.createDataFrame([], "label string, key bigint, x double")
    assert stratified_split(df, "label", ["key"], 0.7).count() == 0
    assert hash_split(df, ["key"], 0.7).count() == 0


def test_quotas_follow_largest_remainder(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 4)], "label string, n bigint")
    got = {r["label"]: r["quota"] for r in quotas(counts, "label", 0.7).collect()}
    assert got == {"a": 3, "b": 3, "c": 3}


def test_stratified_split_moves_no_rows(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    flagged = stratified_split(orders, "o_orderstatus", ["o_orderkey"], 0.7)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    pruned = flagged.select("is_train")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in pruned


def test_hash_split_keeps_equal_keys_together(spark):
    df = spark.range(2000).select((F.col("id") % 100).alias("key"), "id")
    flagged = hash_split(df, ["key"], 0.7)
    assert flagged.groupBy("key").agg(F.countDistinct("is_train").alias("n")).filter("n > 1").isEmpty()
    train, rest = sides(flagged)
    assert train.count() + rest.count() == 2000
    assert train.columns == ["key", "id"]


def test_hash_split_ignores_layout(spark):
    df = spark.range(1000)
    first = set(sides(hash_split(df.repartition(3), ["id"], 0.7))[0].collect())
    again = set(sides(hash_split(df.repartition(7), ["id"], 0.7))[0].collect())
    assert first == again
    assert 0.65 < len(first) / 1000 < 0.75


def test_native_split_is_complete(spark):
    train, rest = native_split(spark.range(1000), 0.7, seed=3)
    assert train.union(rest).distinct().count() == 1000


def test_shuffled_is_a_repeatable_permutation(spark):
    df = spark.range(500)
    ids = [r["id"] for r in shuffled(df, ["id"], seed=1).collect()]
    assert ids == sorted(range(500), key=lambda i: key_hash(1, i))
    assert ids == [r["id"] for r in shuffled(df.repartition(3), ["id"], seed=1).collect()]
    assert ids[:20] == [r["id"] for r in first_shuffled(df, 20, ["id"], seed=1).collect()]
    assert ids != [r["id"] for r in shuffled(df, ["id"], seed=2).collect()]


def test_shuffled_orders_rows_with_one_key_by_content(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("key"), F.col("id").alias("x"))
    first = [tuple(r) for r in shuffled(df, ["key"], seed=1).collect()]
    assert first == [tuple(r) for r in shuffled(df.repartition(5), ["key"], seed=1).collect()]
    assert first[:10] == [tuple(r) for r in first_shuffled(df, 10, ["key"], seed=1).collect()]
    plan = shuffled(df, ["key"], seed=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and "rangepartitioning" in plan


def test_shuffled_cuts_through_a_hot_key(spark):
    df = spark.range(0, 40_000, 1, 4).select(F.lit(5).alias("key"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        sizes = [len(p) for p in shuffled(df, ["key"], seed=1).rdd.glom().collect()]
    finally:
        spark.conf.unset(merge)
    assert sum(sizes) == 40_000
    assert max(sizes) < 20_000


def test_repeated_spreads_copies(spark):
    df = spark.createDataFrame([("a", 1050), ("b", 1), ("c", 0)], "x string, n bigint")
    grown = repeated(df, "n", partitions=8, chunk=50)
    assert Counter(r["x"] for r in grown.collect()) == {"a": 1050, "b": 1}
    assert max(len(p) for p in grown.rdd.glom().collect()) < 800


def test_stable_layout_ignores_input_layout(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 500).alias("x"), F.lit(1.5).alias("y")
    )

    def layout(parts):
        return stable_layout(df.repartition(parts), 4, chunk=100).rdd.glom().collect()

    first = layout(3)
    assert first == layout(7)
    assert Counter(r for p in first for r in p) == Counter(df.collect())
    # A third of the rows are copies of one row; no partition holds them all.
    assert max(Counter(r["x"] for r in p)[0] for p in first) < 1000


@pytest.mark.parametrize("case", ["uneven classes", "hot key, exact copies"])
def test_many_classes_need_no_broadcast(spark, monkeypatch, case):
    """Beyond the size bound the class tables stay distributed; the result is the same."""
    monkeypatch.setattr(split, "localised", lambda df: df)
    rows = CASES[case]
    check_split(rows, run_split(spark, rows), 0.7)


def test_inner_nulls_maps_and_signed_zeros_stay_as_they_are(spark):
    """Rows that share a key at the cut differ in nested values only; none may replace another."""
    parts = [
        spark.range(20).selectExpr("1 as k", "'c' as label", value, sign)
        for value in ("array(1, null) as a", "array(null, 1) as a")
        for sign in ("map('x', 0.0D) as m", "map('x', -0.0D) as m")
    ]
    df = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    flagged = split.stratified_split(df, "label", ["k"], 0.6)
    assert flagged.filter("is_train").count() == 48

    def shapes(rows):
        return Counter((str(r["a"]), str(r["m"])) for r in rows.collect())

    assert shapes(flagged) == shapes(df)
