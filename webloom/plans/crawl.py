"""Batches of fetched pages worked into the store.

A batch goes through the same steps whether it comes from a table, a stream or an
archive: parse (one pass over the HTML, which never takes part in a shuffle),
decide (routes, sites, duplicates), then images, documents, links and the new
frontier. Results that several steps read are staged as tables, so each is
computed once and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom import schemas
from webloom.functions import html, text, urls
from webloom.operators import frontier, links, pages, robots, sitemap, tables
from webloom.operators.joins import at_most, hot_key_join, row_bound, rows_of_keys, with_ids
from webloom.plans.store import FRONTIER, MOVED, VISITED, CrawlStore, Run


@dataclass(frozen=True)
class Pass:
    """What tells the two kinds of crawl apart."""

    accepted: list[int]
    """statuses that make a page"""
    file_ok: list[int]
    """statuses with which robots and sitemap files count"""
    redirects: bool = False
    """revisit pages that answered with a redirect, under the URL they led to"""


MAIN_PASS = Pass(pages.SUCCESS, [200])
REDIRECT_PASS = Pass(pages.SUCCESS_OR_REDIRECT, [200, *schemas.REDIRECTS], redirects=True)


@dataclass(frozen=True)
class Crawl:
    """Settings of a crawl."""

    scope: str | list[str]
    """text(s) of which a URL must contain one to be followed"""
    mode: str = "reference"
    kind: Pass = field(default=MAIN_PASS)
    all_links: bool = False
    """keep every link between pages, not only the one that found the page"""


# ---------------------------------------------------------------- parse


def parse_fetches(fetches: DataFrame, crawl: Crawl) -> DataFrame:
    """Fetched pages without their HTML: status, hashes, canonical link and tags.

    A projection of the scan; pages that were not accepted keep no tags.
    """
    ok = F.coalesce(F.col("http_status_code").isin(crawl.kind.accepted), F.lit(False))
    body = F.when(ok, F.col("html"))
    moved = F.coalesce("redirect_url", "url") if crawl.kind.redirects else F.col("url")
    parsed = fetches.select(
        "url",
        moved.alias("final_url"),
        F.col("http_status_code").cast("int").alias("http_status_code"),
        # A live fetch that bears no time was accessed now.
        F.coalesce("accessed_time", F.localtimestamp()).alias("accessed_time"),
        text.content_hash(body).alias("html_content_hash"),
        text.content_digest(body).alias("html_sha256"),
        html.tags(body).alias("tags"),
    )
    canonical = html.canonical(F.col("tags"))
    return (
        parsed.withColumn("has_canonical", canonical.isNotNull())
        .withColumn("canonical_href", canonical["href"])
        .withColumn(
            "canonical_copy",
            pages.is_canonical_copy(
                F.coalesce("has_canonical", F.lit(False)),
                F.col("canonical_href"),
                F.col("final_url"),
                crawl.mode,
            ),
        )
        .withColumn(
            "reason",
            F.when(F.col("url").isNull(), "no url")
            .when(F.col("http_status_code").isNull(), "no status")
            .when(
                F.col("http_status_code").isin(crawl.kind.accepted) & F.col("html_sha256").isNull(),
                "no html",
            ),
        )
        # Tells apart several fetches of one URL within a batch.
        .withColumn(
            "version",
            F.concat_ws(
                "|", F.col("accessed_time").cast("string"), "http_status_code", "html_sha256", "final_url"
            ),
        )
    )


# ---------------------------------------------------------------- decide


def looked_up(parsed: DataFrame, crawl: Crawl) -> DataFrame:
    """The URLs (``url``) whose state decides about fetched pages: their own, and those they name."""
    read = parsed.where(F.col("reason").isNull())
    named = F.when(F.col("canonical_copy"), F.col("canonical_href"))
    columns = [F.col("url"), named] + ([F.col("final_url")] if crawl.kind.redirects else [])
    urls_of = read.select(F.explode(F.array_distinct(F.array(*columns))).alias("url"))
    return urls_of.where(F.col("url").isNotNull())


def due_pages(parsed: DataFrame, state: DataFrame, crawl: Crawl) -> DataFrame:
    """The first fetch of every URL, joined to its page row; ``page_id`` null if it has none.

    ``due`` is false for pages that were visited before.
    """
    facts = [
        "accessed_time", "version", "final_url", "http_status_code", "html_content_hash",
        "html_sha256", "canonical_href", "canonical_copy",
    ]
    first = (
        parsed.where(F.col("reason").isNull())
        .groupBy("url")
        .agg(F.min(F.struct(*facts)).alias("_f"))
        .select("url", "_f.*")
    )
    if crawl.kind.redirects:
        due = F.col("http_status_code").isin(schemas.REDIRECTS)
    else:
        due = F.col("page_type_code") == schemas.FRONTIER
    known = state.select("url", F.col("id").alias("page_id"), F.coalesce(due, F.lit(False)).alias("due"))
    return first.join(known, "url", "left")


def with_route(
    due: DataFrame, state: DataFrame, crawl: Crawl, rows: int | None = None
) -> DataFrame:
    """``route`` of every page that is due, and its ``domain``.

    In the redirect pass a page whose target was visited before, or to which an
    earlier page of the batch leads as well, is a copy.
    """
    visited = F.lit(False)
    if crawl.kind.redirects:
        known = state.where(F.col("http_status_code").isNotNull()).select(
            F.col("url").alias("final_url"), F.lit(True).alias("seen")
        )
        first = due.groupBy("final_url").agg(
            F.min(F.struct("accessed_time", "url")).alias("_first")
        )
        targets = first.join(known, "final_url", "left")
        due = at_most(due, rows)
        due = hot_key_join(due, targets, "final_url", "url")
        visited = F.col("seen").isNotNull() | (F.col("_first.url") != F.col("url"))
    kept_url = F.when(F.col("route") == "visited_redirect", F.col("url")).otherwise(
        F.col("final_url")
    )
    accepted = F.col("route") == "ok"
    return (
        due.withColumn("route", pages.route(F.col("http_status_code"), crawl.kind.accepted, visited))
        .withColumn("new_url", kept_url)
        .withColumn("site_url", F.when(accepted, F.col("final_url")).otherwise(F.col("url")))
        .withColumn("domain", urls.domain(F.col("site_url"), crawl.mode))
        .drop("seen", "_first")
    )


def _as_is(name: str, df: DataFrame) -> DataFrame:
    return df


def new_sites(
    routed: DataFrame,
    site: DataFrame,
    files: DataFrame | None,
    crawl: Crawl,
    after: int,
    stage=_as_is,
) -> tuple[DataFrame, DataFrame | None]:
    """Site rows for domains that the store lacks, and the texts of their sitemaps in parts.

    A site's files are those of the host of its first page. Its row holds the first part.
    """
    found = (
        routed.where(F.col("route") != "bad_request")
        .groupBy("domain")
        .agg(F.min(F.struct("accessed_time", "site_url")).alias("_s"))
        .select("domain", urls.authority(F.col("_s.site_url")).alias("authority"))
        .join(site.select("domain"), "domain", "left_anti")
    )
    if files is None:
        empty = F.lit(None).cast("string")
        rows = found.withColumn("robots_content", empty).withColumn("sitemap_content", empty)
        return with_ids(rows, "domain", after), None
    found = stage("domains", found)
    roots = found.select(F.col("domain").alias("site"), "authority")
    expanded = sitemap.expand_sitemaps(files, crawl.kind.file_ok, roots)
    named = expanded.withColumnRenamed("site", "domain")
    listed = stage("listed", sitemap.sitemap_texts(named, "domain"))
    rows = (
        found.join(robots.robots_content(files, crawl.kind.file_ok), "authority", "left")
        .join(sitemap.first_texts(listed), "domain", "left")
    )
    return with_ids(rows, "domain", after), listed


def decide(routed: DataFrame, site: DataFrame, stored: DataFrame, stage=_as_is) -> DataFrame:
    """Site and page type of every page that is due, and the original of a copy.

    ``stored``: ``id, html_sha256`` of the stored pages that have a content of these.
    """
    ids = site.select("domain", F.col("id").alias("site_id"))
    placed = at_most(stage("placed", hot_key_join(routed, ids, "domain", "url")), row_bound(routed))
    accepted = pages.classify(placed.where(F.col("route") == "ok"), stored, rows=row_bound(placed))
    rest = placed.where(F.col("route") != "ok").select(
        "*",
        F.lit(None).cast("string").alias("copy_kind"),
        F.lit(None).cast("bigint").alias("original_id"),
        F.when(F.col("route") == "visited_redirect", schemas.DUPLICATE)
        .otherwise(pages.failed_type())
        .alias("page_type_code"),
    )
    return accepted.unionByName(rest)


def page_updates(decided: DataFrame) -> DataFrame:
    """Page rows of the pages just visited."""
    whole = F.col("page_type_code") == schemas.HTML
    return decided.select(
        F.col("page_id").alias("id"),
        F.when(F.col("route") != "bad_request", F.col("site_id")).alias("site_id"),
        "page_type_code",
        F.col("new_url").alias("url"),
        F.when(whole, F.col("html_content_hash")).alias("html_content_hash"),
        F.when(whole, F.col("html_sha256")).alias("html_sha256"),
        "http_status_code",
        "accessed_time",
    )


def repointed(decided: DataFrame, state: DataFrame) -> DataFrame:
    """``to_page, new_from``: links into a copy start at its original from now on."""
    content = decided.where(F.col("copy_kind") == "content").select(
        F.col("page_id").alias("to_page"), F.col("original_id").alias("new_from")
    )
    named = decided.where((F.col("copy_kind") == "canonical") & F.col("canonical_href").isNotNull())
    target = state.select(F.col("url").alias("canonical_href"), F.col("id").alias("new_from"))
    named = named.select("canonical_href", F.col("page_id").alias("to_page"))
    canonical = hot_key_join(
        at_most(named, row_bound(decided)), target, "canonical_href", "to_page", "inner"
    ).select("to_page", "new_from")
    return content.unionByName(canonical)


# ---------------------------------------------------------------- extract


def accepted_tags(parsed: DataFrame, decided: DataFrame, crawl: Crawl) -> DataFrame:
    """Tags of the pages that are no copies, with their page id and link targets."""
    wanted = decided.where(F.col("page_type_code") == schemas.HTML).select(
        "url", "version", "page_id", F.col("final_url").alias("page_url")
    )
    chosen = (
        parsed.where(F.size("tags") > 0)
        .select("url", "version", "accessed_time", "tags")
        .join(wanted, ["url", "version"])
        .dropDuplicates(["url", "version"])
        .drop("url", "version")
    )
    tags = html.explode_tags(links.with_base(chosen, "page_url", crawl.mode))
    link = links.is_link()
    return tags.withColumn("kind", F.when(link, urls.link_class(F.col("href")))).withColumn(
        "target", F.when(F.col("kind") == "page", urls.resolve_against(F.col("href"), F.col("base")))
    ).drop("base")


ORDER = ["accessed_time", "page_url", "pos"]


def discover(
    edges: DataFrame, crawl: Crawl, policy: DataFrame | None, stage=_as_is
) -> DataFrame:
    """Distinct URLs that links lead to, each with the link that found it first.

    Links are thinned out to distinct targets before the robots test, the
    normalisation and anything else that shuffles.
    """
    targets = frontier.first_discovery(
        edges.select(F.col("target").alias("url"), *ORDER, "page_id"), ORDER
    )
    if policy is not None:
        targets = robots.with_robots(stage("targets", targets), policy).where("allowed")
    cleaned = targets.withColumn("url", urls.normalize(F.col("url"), crawl.mode))
    return frontier.first_discovery(cleaned.select("url", *ORDER, "page_id"), ORDER)


def every_link(
    edges: DataFrame, crawl: Crawl, policy: DataFrame | None, pages_of: Callable, stage
) -> DataFrame:
    """All links between pages of the store, as ``from_page, to_page``; ``pages_of`` looks up URLs."""
    pairs = edges.select("page_id", F.col("target").alias("url")).dropDuplicates()
    if policy is not None:
        pairs = robots.with_robots(stage("pairs", pairs), policy).where("allowed")
    cleaned = urls.normalize(F.col("url"), crawl.mode).alias("url")
    pairs = pairs.select("page_id", cleaned).dropDuplicates()
    pairs = stage("edges", pairs)
    ids = pages_of(pairs.select("url")).select("url", F.col("id").alias("to_page"))
    return (
        hot_key_join(pairs, ids, "url", "page_id", "inner")
        .select(F.col("page_id").alias("from_page"), "to_page")
        .dropDuplicates()
    )


# ---------------------------------------------------------------- whole batches


def process_batch(
    store: CrawlStore,
    fetches: DataFrame,
    crawl: Crawl,
    files: DataFrame | None = None,
    batch: int | None = None,
    stream: str = "",
) -> int | None:
    """Work fetched pages (``schemas.FETCH``) into the store; gives the run number.

    Pages that the store does not know or that cannot be read go to ``reject``,
    visited ones are passed over, and a ``batch`` of ``stream`` done before is left
    alone (None).
    """
    run = store.begin(batch, crawl.kind.redirects, stream)
    if run is None:
        return None
    ok = F.col("http_status_code").isin(crawl.kind.accepted) & F.col("html").isNotNull()
    run.write(
        "html",
        fetches.where(ok).select(text.content_digest(F.col("html")).alias("html_sha256"), "html"),
    )
    parsed = run.stage("parsed", parse_fetches(fetches, crawl))
    _apply(store, run, parsed, crawl, files)
    return run.number


def _apply(
    store: CrawlStore,
    run: Run,
    parsed: DataFrame,
    crawl: Crawl,
    files: DataFrame | None,
) -> DataFrame:
    """All steps after the parse; gives the new frontier rows.

    What the store knows of the URLs, contents and link targets of the batch is looked up once
    each, by key; nothing here reads or shuffles the whole store.
    """
    last = run.last
    known = run.stage("known", store.pages_of(looked_up(parsed, crawl)))
    found = run.stage_counted("found", due_pages(parsed, known, crawl))
    unread = parsed.where(F.col("reason").isNotNull()).select("url", "reason")
    unknown = found.where(F.col("page_id").isNull()).select("url", F.lit("unknown url").alias("reason"))
    run.write("reject", unread.unionByName(unknown))

    due = with_route(found.where("due"), known, crawl, row_bound(found))
    routed = at_most(run.stage("routed", due), row_bound(found))
    rows, listed = new_sites(routed, store.table("site"), files, crawl, last.site_id, run.stage)
    run.write("site", rows)
    if listed is not None:
        run.write("sitemap_text", listed)
    site = store.log("site", also=run)

    asked = routed.where((F.col("route") == "ok") & ~F.col("canonical_copy")).select("html_sha256")
    decided = decide(routed, site, store.originals(asked), run.stage)
    decided = at_most(run.stage("decided", decided), row_bound(found))
    updates = page_updates(decided)
    run.write_pages(VISITED, updates)
    originals = updates.where(F.col("page_type_code") == schemas.HTML)
    run.write_digests(originals.select("html_sha256", "id", "url"))
    if crawl.kind.redirects:
        left = decided.where(F.col("new_url") != F.col("url"))
        run.write_pages(MOVED, left.select(F.col("page_id").alias("id"), "url"))
    else:
        run.write("repoint", repointed(decided, known))

    tags = run.stage("tags", accepted_tags(parsed, decided, crawl))
    keys = ["page_id", "pos", "accessed_time"]
    run.write("image", tables.image_rows(links.images(tags, keys), last.image_id))
    run.write("page_data", tables.document_rows(links.documents(tags, keys), last.page_data_id))

    policy = None
    if files is not None:
        policy = robots.robots_policy(files, [200])
    edges = links.in_scope_links(tags, crawl.scope)
    linked = run.stage("linked", discover(edges, crawl, policy, run.stage_counted))
    old = store.pages_of(linked.select("url"), also=run)
    fresh = run.stage("fresh", tables.new_frontier_rows(linked, old, last.page_id))
    run.write_pages(FRONTIER, fresh)
    if crawl.all_links:
        pairs = every_link(
            edges, crawl, policy, lambda asked: store.pages_of(asked, also=run), run.stage_counted
        )
        run.write("link", pairs.join(store.log("link"), ["from_page", "to_page"], "left_anti"))
    else:
        run.write(
            "link", fresh.select(F.col("page_id").alias("from_page"), F.col("id").alias("to_page"))
        )

    # A few codes each; those stored before are told apart when read.
    run.write("data_type", run.read("page_data").select(F.col("data_type_code").alias("code")).distinct())
    run.write("page_type", decided.select(F.col("page_type_code").alias("code")).distinct())
    run.commit()
    return fresh


def redirect_pass(
    store: CrawlStore, fetches: DataFrame, scope, files: DataFrame | None = None, **settings
) -> int | None:
    """Second visit to the pages that answered with a redirect (``redirect_url`` is set)."""
    return process_batch(store, fetches, Crawl(scope, kind=REDIRECT_PASS, **settings), files)


def crawl_archive(
    store: CrawlStore,
    responses: DataFrame,
    crawl: Crawl,
    files: DataFrame | None = None,
    generations: int | None = None,
    batch_size: int | None = None,
) -> int:
    """Crawl an archive of responses from the store's frontier on; gives the generations done.

    The archive is parsed once and clustered by the hash of its URLs. The frontier is read
    once; from then on the queue follows from what a generation took and found. Every
    generation takes the whole queue, or its oldest ``batch_size`` URLs, as far as the
    archive has an answer, and reads of the archive the folders of these URLs alone:
    their narrow columns to decide, the tags of the pages that count.
    """
    archive, queue, done = None, None, 0
    new = store.frontier()
    while generations is None or done < generations:
        run = store.begin(rewrites=crawl.kind.redirects)
        if archive is None:
            ok = F.col("http_status_code").isin(crawl.kind.accepted) & F.col("html").isNotNull()
            digest = text.content_digest(F.col("html")).alias("html_sha256")
            archive = run.stage_slots(
                "archive", parse_fetches(responses, crawl).where("reason is null"), "url"
            )
            run.write("html", responses.where(ok).select(digest, "html"))
        answers = rows_of_keys(archive.select("slot", "url"), new, "url", store.slots)
        new = new.join(answers.select("url").distinct(), "url", "left_semi")
        queue = run.stage("queue", new if queue is None else queue.unionByName(new))
        due = queue if batch_size is None else frontier.next_batch(queue, batch_size, "run", "id")
        due = run.stage("due", due)
        if due.isEmpty():
            break
        fresh = _apply(store, run, rows_of_keys(archive, due, "url", store.slots).drop("slot"), crawl, files)
        new = fresh.select("id", "url", F.lit(run.number).alias("run"))
        queue = queue.join(due.select("id"), "id", "left_anti")
        done += 1
    return done
