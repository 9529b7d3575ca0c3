"""Every query against its SQL over the same tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pagecat.plans.queries import all_queries
from tools.check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    verdict, _, rows = compare(spark, duck, SF_DIR, queries()[name], oracle_sql()[name])
    assert verdict == "ok"
    assert rows > 0 or name == "fallback_links_listing"  # page 13 needs more parts


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_query_here_has_an_oracle():
    assert set(all_queries()) <= set(oracle_sql())


def test_entry(spark):
    assert set(entry(spark).columns) >= {"dataset_url", "status", "files_found_count"}
