from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_twin_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


# A thousandth of the data leaves too few hours and zones for these; the model tests cover their parts.
@pytest.mark.parametrize("name", ["gbt_fare", "gbt_eta", "feature_importance", "model_health", "zone_clusters", "score_requests", "ingest_file_sizes"])
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["pu_borough", "trips", "avg_fare"]
