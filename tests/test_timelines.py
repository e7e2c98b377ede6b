"""Values over time, against brute force."""

import random
import time
from datetime import UTC, datetime

import pytest

from coppice.operators.timelines import as_of, highest_over_time, spans
from coppice.sources.registry import ModelRegistry, VersionNotFound
from coppice.sources.workspace import scratch_path


def test_rows_get_the_last_change_of_their_key(spark):
    rng = random.Random(5)

    def key():  # one key in three is the same; some have no changes or are null
        return rng.choice(["hot", "hot", "hot", None, "a", "b", "c", "d", "e"])

    def moment():
        return None if rng.random() < 0.05 else rng.randrange(60)

    changes = [(key(), moment(), i % 7, rng.choice([None, f"v{i}"])) for i in range(300)]
    changes = [c for c in changes if c[0] != "e"]
    rows = [(i, key(), moment()) for i in range(800)] + [(9999, "hot", 30)] * 400
    given = spark.createDataFrame(changes, "k string, since long, seq int, value string")
    asked = spark.createDataFrame(rows, "id long, k string, t long")

    def expected(k, t):
        before = [c for c in changes if c[0] == k and None not in (c[1], t) and c[1] <= t]
        best = max(((c[1], c[2]) for c in before), default=None)
        return {c[3] for c in before if (c[1], c[2]) == best} or {None}

    got = as_of(asked, given, ["k"], "t", "since", ["seq"])
    assert got.columns == ["id", "k", "t", "value"]
    found = got.collect()
    assert len(found) == len(rows)
    assert sum(r["id"] == 9999 for r in found) == 400
    assert all(r["value"] in expected(r["k"], r["t"]) for r in found)


def test_a_hot_moment_is_cut_and_nothing_else_is_lost(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        asked = spark.createDataFrame([("a", 5)] * 500 + [("b", 1)], "k string, t int")
        given = spark.createDataFrame([("a", 5, "x"), ("b", 2, "y")], "k string, since int, value string")
        got = as_of(asked, given, ["k"], "t", "since").groupBy("k", "value").count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert {tuple(r) for r in got} == {("a", "x", 500), ("b", None, 1)}


def test_empty_sides_and_clashing_names(spark):
    asked = spark.createDataFrame([("a", 5)], "k string, t int")
    given = spark.createDataFrame([("a", 5, "x")], "k string, since int, value string")
    assert [tuple(r) for r in as_of(asked, given.limit(0), ["k"], "t", "since").collect()] == [("a", 5, None)]
    assert as_of(asked.limit(0), given, ["k"], "t", "since").count() == 0
    with pytest.raises(ValueError, match=r"both sides: \['t'\]"):
        as_of(asked, given.withColumnRenamed("value", "t"), ["k"], "t", "since")


def test_highest_value_of_overlapping_spans(spark):
    rng = random.Random(6)
    held = []
    for i in range(400):
        since = rng.randrange(100)
        until = rng.choice([None, since + rng.randrange(1, 60)])
        held.append((rng.choice(["hot", "hot", "x", None]), i, since, until))
    table = spark.createDataFrame(held, "k string, value long, since int, until int")
    got = highest_over_time(table, ["k"], "value").collect()
    moments = {(h[0], t) for h in held for t in h[2:] if t is not None}
    assert {(r["k"], r["at"]) for r in got} == moments and len(got) == len(moments)
    for r in got:
        holding = [
            h[1] for h in held if h[0] == r["k"] and h[2] <= r["at"] and (h[3] is None or r["at"] < h[3])
        ]
        assert r["value"] == max(holding, default=None)
    assert highest_over_time(table.limit(0), ["k"], "value").count() == 0


def test_spans_end_at_the_next_change(spark):
    changes = [(1, "a", 1, 5), (1, "b", 2, 5), (1, "c", 3, 9), (2, "a", 1, None)]
    got = spans(spark.createDataFrame(changes, "m int, s string, seq int, at int"), ["m"], "at", ["seq"])
    assert {(r["m"], r["s"], r["since"], r["until"]) for r in got.collect()} == {
        (1, "b", 5, 9),
        (1, "c", 9, None),
    }


def test_versions_of_past_times_are_those_a_lookup_finds(spark):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"), merge_after=3)
    assert registry.stage_changes().count() == 0
    for run in ("r1", "r2"):
        registry.register_one("forest", run, run)
    moments = [datetime.now(UTC)]
    for version, stage in ((1, "Staging"), (2, "Staging"), (2, "Production"), (1, "Archived")):
        time.sleep(0.05)
        registry.set_stage("forest", version, stage)
        time.sleep(0.05)
        moments.append(datetime.now(UTC))

    def looked_up(stage, moment):
        try:
            return registry.lookup("forest", stage, at=moment).version
        except VersionNotFound:
            return None

    asked = [("forest", s, m) for s in ("Staging", "Production", "Archived") for m in moments]
    rows = spark.createDataFrame([(*a, i) for i, a in enumerate(asked)], "name string, stage string, t timestamp, i int")
    got = {r["i"]: r["version"] for r in registry.versions_as_of(rows, "t").collect()}
    assert got == {i: looked_up(s, m) for i, (_, s, m) in enumerate(asked)}
    assert got[1] == 1 and got[2] == 2 and got[4] is None
