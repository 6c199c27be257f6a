from pyspark.sql import functions as F

from webloom import schemas
from webloom.operators import joins, pages, quality, tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_keys_are_spread_and_nothing_is_lost(spark):
    # a third of the rows has one key
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, x int")
    assert [r["_salts"] for r in joins.hot_keys(left, "k", 100).collect()] == [10]
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        spread = joins.hot_key_join(left, right, "k", "v", how, rows_per_task=100)
        assert rows(spread.select(plain.columns)) == rows(plain)


def test_null_keys_stay(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([("a", 5)], "k string, x int")
    assert [tuple(r) for r in joins.hot_key_join(left, right, "k", "v").select("v", "x").orderBy("v").collect()] == [(1, None), (2, 5)]


def test_ids_are_unique_and_repeatable(spark):
    keys = spark.range(200_000).select(F.col("id").cast("string").alias("k"))
    first = joins.with_ids(keys, "k", after=10)
    again = joins.with_ids(keys.repartition(7), "k", after=10)
    stats = first.agg(F.count("*"), F.countDistinct("id"), F.min("id") > 10, F.max("id") < 2_000_000).first()
    assert tuple(stats) == (200_000, 200_000, True, True)
    assert first.join(again, ["k", "id"]).count() == 200_000


def test_insert_sites(spark):
    site = spark.createDataFrame([(7, "a", "r", None)], schemas.TABLES["site"])
    new = spark.createDataFrame([("a", None, None), ("b", "x", "y"), ("b", "x", "y")], "domain string, robots_content string, sitemap_content string")
    got = tables.insert_sites(site, new).collect()
    assert sorted((r.domain, r.robots_content) for r in got) == [("a", "r"), ("b", "x")]
    assert len({r.id for r in got}) == 2 and min(r.id for r in got) == 7


def test_insert_frontier_gives_id_or_minus_one(spark):
    empty = tables.empty_tables(spark)["page"]
    before = tables.insert_frontier(empty, spark.createDataFrame([("u1",), ("u1",)], "url string"))
    asked = spark.createDataFrame([("u1",), ("u2",)], "url string")
    after = tables.insert_frontier(before, asked)
    ids = {r.url: r.id for r in tables.frontier_ids(before, after, asked).collect()}
    assert ids["u1"] == -1 and ids["u2"] > 0
    row = after.where("url = 'u2'").first()
    assert (row.page_type_code, row.http_status_code, row.site_id, row.html_content) == ("FRONTIER", -1, None, None)


def test_update_links_and_codes(spark):
    link = spark.createDataFrame([(9, 2), (8, 2), (9, 1)], schemas.TABLES["link"])
    assert rows(tables.insert_links(link, spark.createDataFrame([(9, 1), (9, 3), (9, 3)], "from_page bigint, to_page bigint"))) == [(8, 2), (9, 1), (9, 2), (9, 3)]
    remap = spark.createDataFrame([(2, 1)], "to_page bigint, new_from bigint")
    assert rows(tables.repoint_links(link, remap)) == [(1, 2), (9, 1)]
    codes = tables.empty_tables(spark)["data_type"]
    new = spark.createDataFrame([("pdf",), ("PDF",), (None,)], "code string")
    assert rows(tables.insert_codes(codes, new)) == [(c,) for c in sorted(["PDF", "DOC", "DOCX", "PPT", "PPTX", "pdf"])]
    assert tables.table_names() == ["data_type", "page_type", "site", "page", "page_data", "image", "link"]


def test_classify_hot_content(spark):
    # every second page has the same content; each copy finds the first page
    df = spark.range(400).select(
        F.concat(F.lit("u"), F.lpad("id", 4, "0")).alias("url"),
        F.col("id").alias("page_id"),
        F.lit(None).cast("timestamp_ntz").alias("accessed_time"),
        F.when(F.col("id") % 2 == 0, "same").otherwise(F.col("id").cast("string")).alias("html_sha256"),
        F.lit(False).alias("canonical_copy"),
    )
    got = pages.classify(df, rows_per_task=10)
    assert rows(got.groupBy("page_type_code", "original_id").count().na.fill(-1)) == [("DUPLICATE", 0, 199), ("HTML", -1, 201)]
    stored = spark.createDataFrame([(77, "same"), (55, "same"), (1, "other")], "id bigint, html_sha256 string")
    got = pages.classify(df, stored, rows_per_task=10)
    assert rows(got.groupBy("page_type_code", "original_id").count().na.fill(-1)) == [("DUPLICATE", 55, 200), ("HTML", -1, 200)]


def test_orphans_count_child_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p bigint")
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert rows(quality.orphans(child, "p", parent, "id")) == [(2, 2)]


def test_images_and_documents_are_appended(spark):
    fresh = tables.empty_tables(spark)
    new = spark.sql("select 5L page_id, 0 pos, 'a.png' filename, 'PNG' content_type, timestamp_ntz'2020-01-01' accessed_time")
    once = tables.insert_images(fresh["image"], new)
    twice = tables.insert_images(once, new).collect()
    assert len({r.id for r in twice}) == 2 and {(r.page_id, r.filename, r.data) for r in twice} == {(5, "a.png", None)}
    docs = tables.insert_documents(fresh["page_data"], spark.sql("select 5L page_id, 1 pos, 'pdf' data_type_code"))
    assert [(r.page_id, r.data_type_code, r.data) for r in docs.collect()] == [(5, "pdf", None)]
