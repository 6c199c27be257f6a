from test_crawl import BATCH, CRAWL, check_batch, fetches, seed

from webloom import schemas
from webloom.plans.store import CrawlStore
from webloom.sources import readers
from webloom.streaming.crawl_stream import distinct_stream, start_crawl


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    arrivals, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    store = CrawlStore.create(spark, str(tmp_path / "store"))
    seed(store, *[r[0] for r in BATCH])
    rows = fetches(spark, *BATCH)
    for part in (rows.where("url < 'https://h.example.com/4'"), rows.where("url >= 'https://h.example.com/4'")):
        part.coalesce(1).write.mode("append").parquet(arrivals)
        # each start goes on from the progress of the one before
        stream = readers.fetched_page_stream(spark, arrivals, files_per_batch=1)
        start_crawl(stream, store, CRAWL, progress, once=True).awaitTermination()
    check_batch(CrawlStore(spark, store.root))


def test_two_streams_fill_one_store(spark, tmp_path):
    """Each has batch numbers of its own, also after the store was compacted."""
    store = CrawlStore.create(spark, str(tmp_path / "store"))
    seed(store, *[r[0] for r in BATCH])
    rows = fetches(spark, *BATCH)
    parts = rows.where("url < 'https://h.example.com/4'"), rows.where("url >= 'https://h.example.com/4'")
    for name, part in zip("ab", parts, strict=True):
        part.write.parquet(str(tmp_path / name))
        stream = readers.fetched_page_stream(spark, str(tmp_path / name), files_per_batch=100)
        start_crawl(stream, store, CRAWL, str(tmp_path / f"progress-{name}"), once=True).awaitTermination()
        store.compact()
    check_batch(CrawlStore(spark, store.root))
    batches = store.commits()[-1].batches
    assert len(batches) == 2 and set(batches.values()) == {0}


def test_distinct_stream(spark, tmp_path):
    arrivals, out = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        fetches(spark, *BATCH).write.mode("append").parquet(arrivals)
    stream = distinct_stream(readers.fetched_page_stream(spark, arrivals))
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert readers.fetched_pages(spark, out).count() == len(BATCH)


def test_readers(spark, tmp_path):
    files = spark.createDataFrame([("a", "robots.txt", 200, "x"), ("a", "sitemap.xml", 301, "y")], schemas.SITE_FILE)
    files.write.parquet(str(tmp_path / "files"))
    read = readers.site_files(spark, str(tmp_path / "files"))
    assert readers.fetched_robots(read, [200]).count() == 1
    assert readers.fetched_sitemaps(read, [200]).count() == 0
    assert readers.fetched_sitemaps(read, [200, 301]).count() == 1
    assert [r.url for r in readers.seed_urls(spark, ["u"]).collect()] == ["u"]
