"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

QUERIES = dict(entry.QUERIES)
ORACLES = dict(entry.ORACLES)


@pytest.fixture(scope="module")
def con(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, con):
    extra, missing = differences(con, QUERIES[name](spark, sf_dir), ORACLES[name])
    assert not extra and not missing, (list(extra)[:5], list(missing)[:5])


def test_entry_is_a_confusion_matrix(spark):
    df = entry.entry(spark)
    assert df.columns == ["model_version", "actual", "predicted", "n", "share"]
    rows = df.collect()
    assert len(rows) == 4
    assert sum(r["n"] for r in rows) == 27
    assert sum(r["share"] for r in rows) == pytest.approx(1.0)
