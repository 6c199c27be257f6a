import datetime as dt

import pytest
from pyspark.sql import functions as F

from webloom import schemas
from webloom.operators import quality
from webloom.plans.crawl import MAIN_PASS, REDIRECT_PASS, Crawl, crawl_archive, process_batch, redirect_pass
from webloom.plans.store import CrawlStore

H = "https://h.example.com"
CRAWL = Crawl(".example.")


def at(second):
    return dt.datetime(2020, 1, 1) + dt.timedelta(seconds=second)


def fetches(spark, *rows):
    """(url, html, status[, redirect_url]) in order of access."""
    full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else None, at(i)) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, schemas.FETCH)


@pytest.fixture
def store(spark, tmp_path):
    return CrawlStore.create(spark, str(tmp_path / "store"))


def seed(store, *urls):
    store.add_frontier(store.spark.createDataFrame([(u,) for u in urls], "url string"))


def types(store):
    return {r.url: r.page_type_code for r in store.page().collect()}


def link_urls(store):
    page = store.page().select("id", "url")
    named = (
        store.link()
        .join(page.select(F.col("id").alias("from_page"), F.col("url").alias("a")), "from_page")
        .join(page.select(F.col("id").alias("to_page"), F.col("url").alias("b")), "to_page")
    )
    return sorted((r.a, r.b) for r in named.collect())


BATCH = [
    (f"{H}/1/", f"<a href='{H}/n1'>x</a><a href='{H}/n2/#top'><a href='/f.pdf'><img src='/i/p.png'>", 200),
    (f"{H}/2/", f"<a href='{H}/n1'>x</a><a href='{H}/n2/#top'><a href='/f.pdf'><img src='/i/p.png'>", 200),
    (f"{H}/3/", f"<link rel='canonical' href='{H}/1/'>y", 200),
    (f"{H}/4/", f"<link rel='canonical' href='{H}/4/'><a href='{H}/n1/'>z<a href='{H}/1/'><a href='/j.JPEG'><a href='/k.gif'>", 200),
    (f"{H}/5/", f"<link rel='canonical' href='{H}/5'>v", 200),
    (f"{H}/6/", "gone", 404),
    (f"{H}/7/", "bad", 400),
    (f"{H}/8/", "moved", 301),
]
EXPECTED = {
    f"{H}/1/": "HTML", f"{H}/2/": "DUPLICATE", f"{H}/3/": "DUPLICATE", f"{H}/4/": "HTML",
    f"{H}/5/": "DUPLICATE", f"{H}/6/": "NULL", f"{H}/7/": "NULL", f"{H}/8/": "NULL",
    f"{H}/n1/": "FRONTIER", f"{H}/n2/": "FRONTIER",
    f"{H}/j.JPEG/": "FRONTIER",
}


def check_batch(store):
    assert types(store) == EXPECTED
    assert link_urls(store) == [
        (f"{H}/1/", f"{H}/n1/"), (f"{H}/1/", f"{H}/n2/"), (f"{H}/4/", f"{H}/j.JPEG/")]
    page = {r.url: r for r in store.page(html=True).collect()}
    assert page[f"{H}/1/"].html_content == BATCH[0][1] and page[f"{H}/1/"].html_content_hash
    assert page[f"{H}/2/"].html_content == "NULL" and page[f"{H}/2/"].html_content_hash is None
    assert page[f"{H}/7/"].site_id is None and page[f"{H}/6/"].site_id is not None
    assert page[f"{H}/n1/"].html_content is None and page[f"{H}/n1/"].http_status_code == -1
    images = sorted((r.filename, r.content_type) for r in store.table("image").collect())
    assert images == [("k.gif", "GIF"), ("p.png", "PNG")]
    assert [r.data_type_code for r in store.table("page_data").collect()] == ["pdf"]
    assert sorted(r.code for r in store.table("data_type").collect()) == ["DOC", "DOCX", "PDF", "PPT", "PPTX", "pdf"]
    assert "NULL" in {r.code for r in store.table("page_type").collect()}
    assert [r.domain for r in store.table("site").collect()] == ["h.example.com"]
    report = quality.constraint_report(store.tables()).where("violations > 0").collect()
    assert report == []


def test_batch_rerun_and_compaction(spark, store):
    seed(store, *[r[0] for r in BATCH])
    rows = fetches(spark, *BATCH, (f"{H}/unknown/", "u", 200), (None, "x", 200), (f"{H}/1/", None, 200))
    process_batch(store, rows, CRAWL, batch=1)
    check_batch(store)
    rejects = sorted((r.url or "", r.reason) for r in store.table("reject").collect())
    assert rejects == [("", "no url"), (f"{H}/1/", "no html"), (f"{H}/unknown/", "unknown url")]
    # the same batch number is left alone, the same pages under another number change nothing
    assert process_batch(store, rows, CRAWL, batch=1) is None
    process_batch(store, rows, CRAWL, batch=2)
    check_batch(store)
    store.compact()
    check_batch(store)
    assert len(store.commits()) == 1
    store.reset()
    assert types(store) == {} and store.table("image").count() == 0
    assert sorted(r.code for r in store.table("page_type").collect()) == sorted(schemas.SEED_PAGE_TYPES)


def test_a_dead_attempt_counts_for_nothing(spark, store, monkeypatch):
    seed(store, *[r[0] for r in BATCH])
    rows = fetches(spark, *BATCH)
    with monkeypatch.context() as patch:
        def die(*_):
            raise RuntimeError("lost")

        patch.setattr("webloom.plans.crawl.accepted_tags", die)  # page rows are written by then
        with pytest.raises(RuntimeError):
            process_batch(store, rows, CRAWL, batch=0)
    seed(store, f"{H}/later/")  # takes the number of the dead run
    assert process_batch(store, rows, CRAWL, batch=0) is not None
    assert types(store).pop(f"{H}/later/") == "FRONTIER"
    images = sorted((r.filename, r.content_type) for r in store.table("image").collect())
    assert images == [("k.gif", "GIF"), ("p.png", "PNG")]
    assert store.link().count() > 0
    assert quality.constraint_report(store.tables()).where("violations > 0").collect() == []


def test_links_of_copies_are_repointed(spark, store):
    seed(store, f"{H}/9/")
    process_batch(store, fetches(spark, (f"{H}/9/", f"<a href='{H}/1'><a href='{H}/2'><a href='{H}/3'>", 200)), CRAWL)
    process_batch(store, fetches(spark, (f"{H}/1/", "X", 200), (f"{H}/2/", "X", 200), (f"{H}/3/", f"<link rel=canonical href='{H}/1/'>", 200)), CRAWL)
    assert link_urls(store) == [(f"{H}/1/", f"{H}/2/"), (f"{H}/1/", f"{H}/3/"), (f"{H}/9/", f"{H}/1/")]
    # a later page with stored content is a copy of the stored page
    seed(store, f"{H}/0/")
    process_batch(store, fetches(spark, (f"{H}/0/", "X", 200)), CRAWL)
    assert types(store)[f"{H}/0/"] == "DUPLICATE"


def test_strict_mode_and_all_links(spark, store):
    seed(store, f"{H}/5/", f"{H}/1/")
    process_batch(
        store,
        fetches(spark, (f"{H}/5/", f"<link rel='canonical' href='{H}/5/.'>v<a href='../1/'>", 200),
                (f"{H}/1/", "<a href='/5/'><a href='/1/#x'><a href='n'>", 200)),
        Crawl(".example.", mode="strict", all_links=True),
    )
    assert types(store) == {f"{H}/5/": "HTML", f"{H}/1/": "HTML", f"{H}/1/n": "FRONTIER"}
    assert link_urls(store) == [
        (f"{H}/1/", f"{H}/1/"), (f"{H}/1/", f"{H}/1/n"), (f"{H}/1/", f"{H}/5/"), (f"{H}/5/", f"{H}/1/"), (f"{H}/5/", f"{H}/5/")]


def test_sites_robots_and_sitemaps(spark, store):
    files = spark.createDataFrame(
        [("www.h.example.com", "robots.txt", 200, "User-agent: *\nDisallow: /no\n"),
         ("www.h.example.com", "sitemap.xml", 200, "<loc>https://www.h.example.com/b</loc><loc>https://www.h.example.com/a</loc>"),
         ("o.example.com", "robots.txt", 403, "")], schemas.SITE_FILE)
    w = "https://www.h.example.com"
    seed(store, f"{w}/1/")
    process_batch(store, fetches(spark, (f"{w}/1/", "<a href='/no/x'><a href='/yes'><a href='http://o.example.com/'><a href='mailto:a@b.example.com'><a href='http://else.org/'>", 200)), CRAWL, files)
    assert types(store) == {f"{w}/1/": "HTML", f"{w}/yes/": "FRONTIER"}
    site = store.table("site").collect()
    assert [tuple(s)[1:] for s in site] == [("h.example.com", "User-agent: *\nDisallow: /no\n", f"{w}/a\n{w}/b")]
    parts = store.table("sitemap_text").collect()
    assert [tuple(p) for p in parts] == [("h.example.com", 0, f"{w}/a\n{w}/b")]


def test_a_sitemap_of_many_parts(spark, store):
    w = "https://big.example.com"
    urls = [f"{w}/p{i:05d}" for i in range(20_500)]
    body = "".join(f"<loc>{url}</loc>" for url in reversed(urls))
    files = spark.createDataFrame([("big.example.com", "sitemap.xml", 200, body)], schemas.SITE_FILE)
    seed(store, f"{w}/1/", f"{H}/2/")
    process_batch(store, fetches(spark, (f"{w}/1/", "x", 200), (f"{H}/2/", "y", 200)), CRAWL, files)
    parts = sorted(tuple(p) for p in store.table("sitemap_text").collect())
    assert [(domain, part) for domain, part, _ in parts] == [("big.example.com", n) for n in range(3)]
    assert [url for *_, text in parts for url in text.split("\n")] == urls
    first = {r.domain: r.sitemap_content for r in store.table("site").collect()}
    assert first == {"big.example.com": parts[0][2], "h.example.com": None}


def test_redirect_pass(spark, store):
    urls = [f"{H}/{x}/" for x in "abcde"]
    seed(store, *urls, f"{H}/t/")
    process_batch(store, fetches(spark, *[(u, "m", 301) for u in urls], (f"{H}/t/", "T", 200)), CRAWL)
    redirect_pass(
        store,
        fetches(spark, (urls[0], "A", 301, f"{H}/new/"), (urls[1], "B", 302, f"{H}/t/"), (urls[2], "C", 307, f"{H}/new/"),
                (urls[3], "T", 301, f"{H}/new2/"), (urls[4], "no", 404, f"{H}/lost/"), (f"{H}/t/", "T", 200, f"{H}/t2/")),
        ".example.",
    )
    page = {r.url: (r.page_type_code, r.http_status_code) for r in store.page().collect()}
    assert page == {
        f"{H}/new/": ("HTML", 301),
        f"{H}/b/": ("DUPLICATE", 302),
        f"{H}/c/": ("DUPLICATE", 307),
        f"{H}/new2/": ("DUPLICATE", 301),
        f"{H}/lost/": ("NULL", 404),
        f"{H}/t/": ("HTML", 200),
    }
    assert quality.constraint_report(store.tables()).where("violations > 0").count() == 0


def test_archive_generations(spark, store):
    seed(store, f"{H}/1/")
    archive = fetches(
        spark, (f"{H}/1/", f"<a href='{H}/2'>", 200), (f"{H}/2/", f"2<a href='{H}/3'><a href='{H}/1'>", 200),
        (f"{H}/3/", f"3<a href='{H}/4'>", 200), (f"{H}/9/", "never linked", 200))
    assert crawl_archive(store, archive, CRAWL, generations=2) == 2
    assert types(store) == {f"{H}/1/": "HTML", f"{H}/2/": "HTML", f"{H}/3/": "FRONTIER"}
    assert crawl_archive(store, archive, CRAWL, batch_size=1) == 1
    assert types(store)[f"{H}/4/"] == "FRONTIER"
    assert {r.url: r.html_content for r in store.page(html=True).collect()}[f"{H}/3/"].startswith("3")


def test_passes_differ():
    assert MAIN_PASS.accepted == [200] and REDIRECT_PASS.accepted == [200, 301, 302, 307]
