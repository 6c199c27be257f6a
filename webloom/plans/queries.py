"""The library's operators as named queries over the test tables.

Every query reads whole tables and returns natural keys, never generated ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom import schemas
from webloom.functions import fetchlog, html, text, urls
from webloom.operators import (
    frontier, links, lookups, pages, quality, robots, sitemap, tables,
)
from webloom.operators.joins import cut_lineage, hot_key_join, shared_folder
from webloom.plans import crawl, summary
from webloom.plans.inputs import derived, fetched
from webloom.plans.store import VISITED, CrawlStore
from webloom.sources import readers
from webloom.streaming.crawl_stream import distinct_stream, start_crawl

SCOPE = ".example."
OK = [200]
OK_OR_MOVED = [200, *schemas.REDIRECTS]


# ---------------------------------------------------------------- tags and links


def _tags(spark, sf_dir, name="pages_x", mode="reference") -> DataFrame:
    return links.page_tags(derived(spark, sf_dir, name), ["page_id", "url"], mode=mode)


def _files(spark, sf_dir) -> DataFrame:
    """Site files as a table, since the steps that need them read them again and again."""
    return cut_lineage(derived(spark, sf_dir, "site_files"))


def _edges(spark, sf_dir, mode="reference") -> DataFrame:
    """Links to pages in scope: ``page_id, page_url, pos, target``."""
    targets = links.with_targets(_tags(spark, sf_dir, mode=mode))
    return links.in_scope_links(targets, SCOPE).withColumnRenamed("url", "page_url")


def extract_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.anchors(_tags(spark, sf_dir))
    return found.select("page_id", "pos", "href", F.col("href").isNotNull().alias("has_href"))


def resolve_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.with_targets(_tags(spark, sf_dir)).select("page_id", "pos", "kind", "target")


def resolve_links_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.with_targets(_tags(spark, sf_dir, mode="strict")).select("page_id", "pos", "target")


def _url_pool(spark, sf_dir) -> DataFrame:
    known = derived(spark, sf_dir, "pages_xc").select("url")
    linked = _edges(spark, sf_dir).select(F.col("target").alias("url"))
    return frontier.distinct_urls(known.unionByName(linked))


def normalize_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.normalization_steps(_url_pool(spark, sf_dir), "url")


def normalize_urls_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = derived(spark, sf_dir, "pages_xc").select("url")
    return pool.select("url", urls.normalize(F.col("url"), "strict").alias("normalized"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _url_pool(spark, sf_dir).select(
        "url", urls.domain_url(url).alias("domain_url"), urls.domain(url).alias("domain")
    )


def link_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.with_targets(_tags(spark, sf_dir))
    return found.groupBy(
        "kind",
        F.when(F.col("kind") != "page", urls.extension(F.col("href"))).alias("ext"),
    ).agg(F.count("*").alias("n_links"), F.countDistinct("page_id").alias("n_pages"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.documents(_tags(spark, sf_dir), ["page_id", "pos"])


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.images(_tags(spark, sf_dir), ["page_id", "pos"])


def image_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.image_sources(_tags(spark, sf_dir), ["page_id", "pos"])


def page_link_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = robots.robots_policy(_files(spark, sf_dir), OK)
    fetches = derived(spark, sf_dir, "pages_xc").select(
        "url", "html", F.col("status").alias("http_status_code")
    )
    found = summary.page_summary(fetches, policy)
    return found.select(
        "url",
        "http_status_code",
        "n_links",
        F.array_join(F.transform("first_links", lambda h: F.coalesce(h, F.lit("-"))), " ").alias(
            "first_links"
        ),
    )


# ---------------------------------------------------------------- frontier


def _new_urls(spark, sf_dir) -> DataFrame:
    edges = _edges(spark, sf_dir).select(
        urls.normalize(F.col("target")).alias("url"), "page_id", "pos", "page_url"
    )
    first = frontier.first_discovery(edges, ["page_id", "pos"])
    return frontier.unvisited(first, derived(spark, sf_dir, "pages_xc").select("url"))


def frontier_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _new_urls(spark, sf_dir)
    return found.groupBy(urls.domain(F.col("url")).alias("domain")).agg(
        F.count("*").alias("n_new"), F.min("url").alias("first_url")
    )


def discovery_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _new_urls(spark, sf_dir).select(F.col("page_url").alias("from_url"), F.col("url").alias("to_url"))


def next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = frontier.next_batch(_new_urls(spark, sf_dir), 100, "page_id", "pos")
    return queue.select("url", "page_id", "pos")


def next_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue, history and depth after the first generation, all by set operations."""
    start = derived(spark, sf_dir, "pages_xc").select("url")
    found = _edges(spark, sf_dir).select(
        urls.normalize(F.col("target")).alias("url"), F.lit(0).alias("depth")
    )
    queue = frontier.enqueue(start, found)
    visited = frontier.mark_visited(derived(spark, sf_dir, "pages_x"), start)
    return frontier.next_generation(queue, visited, found)


# ---------------------------------------------------------------- pages


def _with_canonical(df: DataFrame, mode: str = "reference") -> DataFrame:
    tag = html.canonical(html.tags(F.col("html"), ("link",)))
    return (
        df.withColumn("_c", tag)
        .withColumn("has_canonical", F.col("_c").isNotNull())
        .withColumn("canonical_href", F.col("_c.href"))
        .withColumn(
            "canonical_copy",
            pages.is_canonical_copy(
                F.col("has_canonical"), F.col("canonical_href"), F.col("url"), mode
            ),
        )
        .drop("_c")
    )


def canonical_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_canonical(derived(spark, sf_dir, "pages_xc")).select(
        "page_id", "has_canonical", "canonical_href", "canonical_copy"
    )


def _classified(spark, sf_dir) -> DataFrame:
    """Page types when the copies arrive at a store that holds the original pages."""
    facts = _with_canonical(fetched(derived(spark, sf_dir, "pages_xc"))).select(
        "url", "accessed_time", "canonical_copy", "canonical_href",
        text.content_digest(F.col("html")).alias("html_sha256"),
        F.col("url").alias("page_id"),
    )
    # Read several times below; hash and parse every page once.
    return pages.classify(cut_lineage(facts))


def content_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select(
        "url", "page_type_code", "copy_kind", F.col("original_id").alias("original_url")
    )


def document_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        text.content_hash(F.col("text")).alias("content_hash"),
        text.content_digest(F.col("text")).alias("digest"),
    )
    first = pages.content_representatives(docs, "digest", ["doc_id", "content_hash"])
    return first.select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.content_hash").alias("content_hash"), "copies"
    )


def same_hash_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every page the stored page (status 200) with its content, -1 for none."""
    hashes = [
        text.content_hash(F.col("html")).alias("html_content_hash"),
        text.content_digest(F.col("html")).alias("html_sha256"),
    ]
    stored = derived(spark, sf_dir, "pages_x").where("status = 200").select(
        F.col("page_id").alias("id"), *hashes
    )
    asked = derived(spark, sf_dir, "pages_xc").select("url", *hashes)
    asked = cut_lineage(asked)
    return lookups.with_page_of_hash(asked, stored, missing=lookups.NOT_FOUND).select("url", "same_page_id")


def route_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("status")
    return derived(spark, sf_dir, "pages_xc").select(
        "page_id",
        pages.route(status, pages.SUCCESS).alias("route_main"),
        pages.route(
            status, pages.SUCCESS_OR_REDIRECT, F.col("redirect_url") != F.col("url")
        ).alias("route_redirect"),
        pages.succeeded(status).alias("success"),
        pages.succeeded_or_moved(status).alias("success_or_moved"),
    )


def visited_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that led to a page of the store."""
    moved = fetched(derived(spark, sf_dir, "pages_xc")).select("url", "redirect_url")
    return frontier.visited_targets(moved, derived(spark, sf_dir, "pages_x"))


def status_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = derived(spark, sf_dir, "fetch_log")
    entries = fetchlog.response_entries(log)
    logged = readers.with_logged_status(entries.select("url", "message"), log)
    return logged.select(
        "url",
        F.col("http_status_code").alias("status"),
        fetchlog.header_status(F.col("message")).alias("header_status"),
    )


# ---------------------------------------------------------------- sites


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site rows that the fetched pages call for, in an empty store, with all parts of their sitemaps."""
    store = tables.empty_tables(spark)
    routed = fetched(derived(spark, sf_dir, "pages_xc")).select(
        "url", "accessed_time", F.col("url").alias("site_url"),
        urls.domain(F.col("url")).alias("domain"),
        pages.route(F.col("http_status_code"), pages.SUCCESS).alias("route"),
    )
    # As in a batch, what several steps read is a table.
    rows, listed = crawl.new_sites(
        routed, store["site"], _files(spark, sf_dir), crawl.Crawl(SCOPE), 0,
        stage=lambda name, df: cut_lineage(df),
    )
    added = tables.insert_sites(store["site"], rows.drop("id"))
    return added.select("domain", "robots_content").join(listed, "domain", "left")


def page_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by site, joined by domain; the hosts of copies have no site (-1)."""
    site = (
        derived(spark, sf_dir, "pages_x")
        .groupBy(urls.domain(F.col("url")).alias("domain"))
        .agg(F.min("page_id").alias("id"))
    )
    placed = lookups.with_site_id(
        derived(spark, sf_dir, "pages_xc").select("url", urls.domain(F.col("url")).alias("domain")),
        site, missing=lookups.NOT_FOUND,
    )
    return placed.groupBy("domain", "site_id").agg(F.count("*").alias("n_pages"))


def robots_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = robots.robots_policy(_files(spark, sf_dir), OK)
    asked = derived(spark, sf_dir, "pages_xc").select("url")
    return robots.with_robots(asked, policy).select("url", "allowed")


def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robots.robots_rules(derived(spark, sf_dir, "site_files"), OK_OR_MOVED)


def robots_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robots.robots_content(
        readers.fetched_robots(derived(spark, sf_dir, "site_files"), OK_OR_MOVED), OK_OR_MOVED
    )


def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap.expand_sitemaps(_files(spark, sf_dir), OK)


def sitemap_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitemap.expand_sitemaps(
        readers.fetched_sitemaps(_files(spark, sf_dir), OK), OK
    )
    return sitemap.sitemap_texts(cut_lineage(found), "authority")


# ---------------------------------------------------------------- tables


def _page_table(spark, sf_dir) -> DataFrame:
    """A page table: pages with status 200 visited, redirects failed, the rest waiting."""
    x = fetched(derived(spark, sf_dir, "pages_xc")).alias("x")
    status = F.col("http_status_code")
    kind = (
        F.when(status == 200, schemas.HTML)
        .when(status.isin(schemas.REDIRECTS), schemas.FAILED)
        .when(status == 404, schemas.FRONTIER)
    )
    return x.select(
        F.xxhash64("url").alias("id"),
        F.lit(None).cast("bigint").alias("site_id"),
        kind.alias("page_type_code"),
        "url",
        F.when(status == 200, F.col("html")).alias("html_content"),
        F.when(status == 200, text.content_hash(F.col("html"))).alias("html_content_hash"),
        F.when(status == 404, -1).when(status != 400, status).alias("http_status_code"),
        "accessed_time",
    )


def page_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four scans of the page table: which URL is in which."""
    page = _page_table(spark, sf_dir)
    scans = [
        ("frontier", frontier.frontier(page)),
        ("history", frontier.history(page)),
        ("redirected", frontier.redirected(page)),
        ("not_redirected", frontier.not_redirected(page)),
    ]
    parts = [df.select(F.lit(name).alias("scan"), "url") for name, df in scans]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def frontier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.counts(_page_table(spark, sf_dir))


def page_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is a linked URL a page of the store, and of which type; -1 for none."""
    page = _page_table(spark, sf_dir)
    # Each lookup reads its input twice, so extract the links once.
    asked = cut_lineage(
        _edges(spark, sf_dir).select(F.col("target").alias("url"), "page_id", "pos")
    )
    found = lookups.with_page_type(asked, page, spread="pos", missing="-1")
    found = lookups.with_page_id(
        found.withColumnRenamed("page_id", "source"), page, spread="pos", missing=lookups.NOT_FOUND
    )
    return found.select(
        F.col("source").alias("page_id"), "pos", "page_type_code",
        (F.col("page_id") != lookups.NOT_FOUND).alias("known"),
    )


def frontier_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page table after all linked URLs were put on the frontier."""
    page = _page_table(spark, sf_dir)
    found = _new_urls(spark, sf_dir).select("url")
    return tables.insert_frontier(page, found).select(
        "url", "page_type_code", "http_status_code", "html_content_hash"
    )


def page_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page table after its redirects were stored under the URL they led to."""
    page = _page_table(spark, sf_dir)
    moved = fetched(derived(spark, sf_dir, "pages_x")).where("url <> redirect_url").select(
        "url", F.col("redirect_url").alias("new_url"), F.lit(None).cast("bigint").alias("site_id"),
        F.lit(schemas.HTML).alias("page_type_code"), F.col("html").alias("html_content"),
        text.content_hash(F.col("html")).alias("html_content_hash"), "http_status_code",
        "accessed_time",
    )
    return tables.update_pages(page, moved).select(
        "url", "page_type_code", "http_status_code", "html_content_hash"
    )


def link_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between pages by page number: the first ones stored, then all inserted."""
    ids = derived(spark, sf_dir, "pages_xc").select(F.col("page_id").alias("id"), "url")
    edges = _edges(spark, sf_dir).select("page_id", F.col("target").alias("url"))
    found = cut_lineage(links.page_links(edges, ids))
    return tables.insert_links(found.where("from_page = to_page"), found)


def repoint_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery links after those into copies were moved to start at the originals."""
    edges = _edges(spark, sf_dir).select(
        F.col("target").alias("url"), "page_id", "pos", "page_url"
    )
    first = frontier.first_discovery(edges, ["page_id", "pos"]).select(
        F.col("page_url").alias("from_page"), F.col("url").alias("to_page")
    )
    link = cut_lineage(first)
    remap = _classified(spark, sf_dir).where("copy_kind = 'content'").select(
        F.col("url").alias("to_page"), F.col("original_id").alias("new_from")
    )
    return tables.repoint_links(link, remap).select(
        F.col("from_page").alias("from_url"), F.col("to_page").alias("to_url")
    )


def canonical_repoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links into pages with a canonical link start at the page that the chain of those ends at."""
    chained = derived(spark, sf_dir, "chained")
    ends = links.chain_ends(chained.select(F.col("url").alias("key"), F.col("canonical_href").alias("next")))
    remap = ends.select(F.col("key").alias("to_page"), F.col("end").alias("new_from"))
    # The pages as links: each page is found from its neighbour and from itself.
    x = derived(spark, sf_dir, "pages_x").select("page_id", "url")
    before = x.select((F.col("page_id") + 2).alias("page_id"), F.col("url").alias("from_page"))
    to_page = F.col("url").alias("to_page")
    link = x.join(before, "page_id").select("from_page", to_page).unionByName(
        x.select(F.col("url").alias("from_page"), to_page)
    )
    return tables.repoint_links(cut_lineage(link), remap).select(
        F.col("from_page").alias("from_url"), F.col("to_page").alias("to_url")
    )


def dimension_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both code tables of a fresh store after all pages and documents were stored."""
    fresh = tables.empty_tables(spark)
    new = {
        "data_type": links.documents(_tags(spark, sf_dir), ["page_id"]).select(
            F.col("data_type_code").alias("code")
        ),
        "page_type": _page_table(spark, sf_dir).select(F.col("page_type_code").alias("code")),
    }
    parts = [
        tables.insert_codes(fresh[name], codes).select(F.lit(name).alias("table_name"), "code")
        for name, codes in new.items()
        if name in tables.table_names()
    ]
    return parts[0].unionByName(parts[1])


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraint checks over tables with faults of every kind."""
    fresh = tables.empty_tables(spark)
    # The checks read every table several times, as they would the tables of a store.
    source = cut_lineage(derived(spark, sf_dir, "pages_xc").select("page_id", "url", "status"))
    authority = derived(spark, sf_dir, "authorities")
    page = source.select(
        F.col("page_id").alias("id"),
        F.when(F.col("page_id") % 3 == 0, F.col("page_id") % 7).alias("site_id"),
        F.when(F.col("status") == 200, "HTML").otherwise("a page type that is too long").alias("page_type_code"),
        F.when(F.col("page_id") % 20 != 0, F.replace("url", F.lit("://copy."), F.lit("://"))).alias("url"),
    )
    tags = cut_lineage(_tags(spark, sf_dir, "pages_xc").drop("base"))
    found = {
        **fresh,
        "site": authority.select((F.col("m") % 5).alias("id"), F.col("authority").alias("domain")),
        "page": page,
        "page_data": links.documents(tags, ["page_id", "pos"]).select(
            F.col("pos").cast("bigint").alias("id"), "page_id", "data_type_code"
        ),
        "image": links.images(tags, ["page_id", "pos"]).select(
            F.when(F.col("pos") > 8, F.col("page_id")).alias("id"),
            (F.col("page_id") + F.col("pos")).alias("page_id"),
            F.repeat("filename", 30).alias("filename"),
            "content_type",
        ),
        "link": source.select(
            F.col("page_id").alias("from_page"), (F.col("page_id") + 2).alias("to_page")
        ),
    }
    return quality.constraint_report(found)


# ---------------------------------------------------------------- whole crawls


def _crawled(spark, sf_dir) -> CrawlStore:
    """A store that was seeded with every page and then worked in all fetches at once."""
    store = CrawlStore.create(spark, _new_folder(spark, "crawl"))
    x = derived(spark, sf_dir, "pages_xc")
    store.add_frontier(x.select("url"))
    crawl.process_batch(
        store, fetched(x), crawl.Crawl(SCOPE), _files(spark, sf_dir)
    )
    return store


def _new_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _states(store: CrawlStore) -> DataFrame:
    site = store.table("site").select(F.col("id").alias("site_id"), "domain")
    page = hot_key_join(store.page(), site, "site_id", spread="url")  # a site may own half the pages
    return page.select("url", "page_type_code", "http_status_code", "html_content_hash", "domain")


def page_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(_crawled(spark, sf_dir))


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_links(_crawled(spark, sf_dir))


def _page_links(store: CrawlStore) -> DataFrame:
    page = store.page().select("id", "url")
    return (
        store.link()
        .join(page.select(F.col("id").alias("from_page"), F.col("url").alias("from_url")), "from_page")
        .join(page.select(F.col("id").alias("to_page"), F.col("url").alias("to_url")), "to_page")
        .select("from_url", "to_url")
    )


def redirect_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, frontier and links after a second visit to the pages that answered with a redirect."""
    store = _crawled(spark, sf_dir)
    crawl.redirect_pass(store, fetched(derived(spark, sf_dir, "pages_xc")), SCOPE, _files(spark, sf_dir))
    state = _states(store).select(
        F.lit("page").alias("record"), "url", "page_type_code", "http_status_code", "html_content_hash"
    )
    link = _page_links(store).select(F.lit("link").alias("record"), F.col("from_url").alias("url"), "to_url")
    return state.unionByName(link, allowMissingColumns=True)


def _seeds(spark, sf_dir) -> DataFrame:
    return derived(spark, sf_dir, "archive").where("page_id % 8 = 0").select("url")


def archive_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl from seeds through an archive, generation after generation, until nothing is due."""
    store = CrawlStore.create(spark, _new_folder(spark, "archive"))
    store.add_frontier(_seeds(spark, sf_dir))
    archive = fetched(derived(spark, sf_dir, "archive"))
    crawl.crawl_archive(store, archive, crawl.Crawl(SCOPE), _files(spark, sf_dir))
    return _states(store)


def store_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that was filled, emptied, seeded anew and crawled once: pages, sites, codes."""
    store = CrawlStore.create(spark, _new_folder(spark, "reset"))
    x = derived(spark, sf_dir, "pages_xc")
    store.add_frontier(x.select("url"))
    crawl.process_batch(store, fetched(x), crawl.Crawl(SCOPE))
    store.reset()
    store.add_frontier(_seeds(spark, sf_dir))
    archive = fetched(derived(spark, sf_dir, "archive"))
    crawl.process_batch(store, archive, crawl.Crawl(SCOPE), _files(spark, sf_dir))
    parts = [
        _states(store).select(F.lit("page").alias("record"), F.col("url").alias("name"), "page_type_code"),
        store.table("site").select(F.lit("site").alias("record"), F.col("domain").alias("name")),
        store.table("data_type").select(F.lit("data_type").alias("record"), F.col("code").alias("name")),
    ]
    return parts[0].unionByName(parts[1], True).unionByName(parts[2], True)


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs that arrive in three parts, many more than once, each kept at its first arrival.

    The state store knows what earlier parts brought, over two restarts of the stream.
    """
    folder = _new_folder(spark, "distinct")
    x = fetched(derived(spark, sf_dir, "pages_xc"))
    again = fetched(derived(spark, sf_dir, "pages_x"))
    for part in (again.where("http_status_code = 200"), x.unionByName(again), x):
        part.write.mode("append").parquet(f"{folder}/arrivals")
        first = distinct_stream(readers.fetched_page_stream(spark, f"{folder}/arrivals", files_per_batch=10_000))
        writer = first.select("url", "http_status_code").writeStream.format("parquet")
        query = writer.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True)
        query.start(f"{folder}/distinct").awaitTermination()
    return spark.read.schema("url string, http_status_code int").parquet(f"{folder}/distinct")


def batch_after_fault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``page_states``, after an attempt that died with its page rows written."""
    store = CrawlStore.create(spark, _new_folder(spark, "fault"))
    x = derived(spark, sf_dir, "pages_xc")
    store.add_frontier(x.select("url"))
    dead = store.begin(batch=0)
    pages_now = store.page_state().withColumn("page_type_code", F.lit(schemas.HTML))
    dead.write_pages(VISITED, pages_now)
    # Another run takes the dead one's number and commits.
    store.add_frontier(x.select("url"))
    crawl.process_batch(store, fetched(x), crawl.Crawl(SCOPE), _files(spark, sf_dir), batch=0)
    return _states(store)


def _stored(store: CrawlStore, table: str, *columns: str) -> DataFrame:
    page = store.page().select(F.col("id").alias("page_id"), "url")
    return store.table(table).join(page, "page_id").select("url", *columns)


def stored_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_crawled(spark, sf_dir), "image", "filename", "content_type")


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_crawled(spark, sf_dir), "page_data", "data_type_code")


def access_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each visited page was accessed, to the second."""
    page = _crawled(spark, sf_dir).page().where("accessed_time IS NOT NULL")
    return page.select("url", F.date_format("accessed_time", "yyyy-MM-dd HH:mm:ss").alias("accessed"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetches without a URL or a status, and those of pages that the store doesn't know."""
    store = CrawlStore.create(spark, _new_folder(spark, "rejects"))
    store.add_frontier(derived(spark, sf_dir, "pages_x").select("url"))
    x = derived(spark, sf_dir, "pages_xc")
    broken = x.withColumns(
        {
            "url": F.when(F.col("page_id") % 19 != 4, F.col("url")),
            "status": F.when(F.col("page_id") % 23 != 6, F.col("status")),
        }
    )
    crawl.process_batch(store, fetched(broken), crawl.Crawl(SCOPE))
    return store.table("reject")


def stream_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``page_states``, with the pages arriving as a stream of files."""
    folder = _new_folder(spark, "stream")
    store = CrawlStore.create(spark, f"{folder}/store")
    x = derived(spark, sf_dir, "pages_xc")
    store.add_frontier(x.select("url"))
    half = x.approxQuantile("page_id", [0.5], 0.01)[0]
    early = F.col("page_id") <= half
    for part in (x.where(early), x.where(~early)):
        # Each part arrives and is worked in; the second start resumes after the first.
        fetched(part).write.mode("append").parquet(f"{folder}/arrivals")
        query = start_crawl(
            readers.fetched_page_stream(spark, f"{folder}/arrivals", files_per_batch=10_000),
            store, crawl.Crawl(SCOPE), f"{folder}/progress", _files(spark, sf_dir), once=True,
        )
        query.awaitTermination()
    store.refresh()
    return _states(store)


QUERIES = {
    f.__name__: f
    for f in (
        extract_anchors, resolve_links, resolve_links_strict, normalize_urls,
        normalize_urls_strict, domains, link_classes, documents, images, image_sources,
        page_link_summary, frontier_new, discovery_links, next_batch, next_generation,
        canonical_duplicates, content_duplicates, document_duplicates, same_hash_lookup,
        route_pages, visited_redirects, status_from_log, sites, page_sites, robots_allowed, robots_rules,
        robots_texts, sitemap_urls, sitemap_texts, page_scans, frontier_counts, page_lookups,
        frontier_insert, page_update, link_insert, repoint_links, dimension_upsert,
        constraint_report, page_states, crawl_links, redirect_pass, stream_crawl,
        canonical_repoint, archive_generations, store_reset, stream_distinct,
        batch_after_fault, stored_images, stored_documents, access_times, rejects,
    )
}
