"""Every query against its oracle at the smallest scale."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from webloom.plans.oracles import ORACLES
from webloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
# The whole crawls have tests of their own; one of them stands for all here.
LONG = {
    "crawl_links", "redirect_pass", "stream_crawl", "stored_images", "stored_documents", "access_times",
    "archive_generations", "store_reset",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_query(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["domain", "n_new", "first_url"]
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
