"""Lookups by key in the store, chains, and joins that know their sizes."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from webloom.operators.joins import at_most, cut_lineage, hot_key_join, numbered, rows_of_keys
from webloom.operators.links import chain_ends
from webloom.operators.sitemap import reached_files
from webloom.plans.store import CrawlStore


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = CrawlStore.create(spark, str(tmp_path_factory.mktemp("s") / "store"), slots=8)
    store.add_frontier(spark.range(500).selectExpr("concat('https://a.example.com/', id, '/') AS url"))
    return store


def test_a_lookup_shuffles_no_page_and_reads_its_folders_only(spark, store, tmp_path):
    asked = spark.createDataFrame([("https://a.example.com/7/",), ("https://a.example.com/x/",), (None,)], "url string")
    asked.write.parquet(str(tmp_path / "asked"))
    asked = spark.read.parquet(str(tmp_path / "asked"))
    found = store.pages_of(asked)
    assert [(r.url, r.page_type_code, r.http_status_code) for r in found.collect()] == [
        ("https://a.example.com/7/", "FRONTIER", -1)
    ]
    rows = plan(rows_of_keys(store.log("page"), asked, "url", store.slots))
    # The keys are grouped (for the join and for the choice of folders); the pages are neither shuffled nor sorted.
    assert "BroadcastHashJoin [slot" in rows and "SortMergeJoin" not in rows
    assert rows.count("Exchange hashpartitioning") == 2 and "dynamicpruning" in rows
    assert CrawlStore(spark, store.root).slots == 8


def test_originals_by_digest(spark, store):
    run = store.begin()
    rows = [(1, "https://a.example.com/1/", "HTML", "d1"), (2, "https://a.example.com/2/", "HTML", "d2")]
    pages = spark.createDataFrame(rows, "id bigint, url string, page_type_code string, html_sha256 string")
    run.write_digests(pages)
    run.commit()
    asked = spark.createDataFrame([("d2",), ("d3",), (None,)], "html_sha256 string")
    assert [tuple(r) for r in store.originals(asked).collect()] == [(2, "d2")]


def test_chain_ends(spark):
    steps = [(f"a{i:03d}", f"a{i + 1:03d}") for i in range(100)]  # one long chain
    steps += [(f"s{i}", "a050") for i in range(40)]  # many meet in its middle
    steps += [("c1", "c2"), ("c2", "c3"), ("c3", "c1"), ("into", "c2"), ("self", "self"), ("two", "x"), ("two", "w")]
    steps += [(None, "a"), ("b", None)]
    table = spark.createDataFrame(steps, "key string, next string")
    got = {r.key: r.end for r in chain_ends(table).collect()}
    expected = {f"a{i:03d}": "a100" for i in range(100)} | {f"s{i}": "a100" for i in range(40)} | {"two": "w"}
    assert got == expected
    assert chain_ends(table.limit(0)).collect() == []


def test_sitemaps_in_circles_and_many_levels(spark):
    start = spark.createDataFrame([("s", "a", "0"), ("t", "b", "0")], "site string, authority string, path string")
    steps = [("a", str(i), "a", str(i + 1)) for i in range(120)] + [("a", "120", "a", "7"), ("b", "0", "b", "0")]
    nested = spark.createDataFrame(steps, "authority string, path string, to_authority string, to_path string")
    got = sorted(tuple(r) for r in reached_files(start, cut_lineage(nested)).collect())
    assert got == sorted([("s", "a", str(i)) for i in range(121)] + [("t", "b", "0")])


def test_known_sizes(spark):
    left = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    right = spark.range(2).selectExpr("id AS k", "id * 10 AS w")
    plain = hot_key_join(at_most(left, 100), right, "k", "v", rows_per_task=100)
    salted = hot_key_join(left, right, "k", "v", rows_per_task=10)
    assert "_salt" not in plan(plain) and "_salt" in plan(salted)
    assert sorted(map(str, plain.select("k", "v", "w").collect())) == sorted(map(str, salted.select("k", "v", "w").collect()))
    rows = numbered(spark.range(50).select((49 - F.col("id")).alias("x")), ["x"], "at")
    assert sorted(tuple(r) for r in rows.collect()) == [(i, i) for i in range(50)]
