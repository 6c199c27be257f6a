"""Images, documents and links of pages, from their tag rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import html, urls
from webloom.operators.joins import at_most, cut_lineage, hot_key_join


def is_link() -> Column:
    return F.col("tag").isin("a", "link") & F.col("href").isNotNull()


def page_tags(
    pages: DataFrame, keys: list[str], url: str = "url", mode: str = "reference"
) -> DataFrame:
    """Tag rows of pages (``html``) with the ``base`` that their links resolve against.

    Tags are taken in the scan's own task; neither the HTML nor a shuffle follows.
    """
    parsed = pages.select(*keys, html.tags(F.col("html")).alias("tags"))
    return html.explode_tags(with_base(parsed, url, mode))


def with_base(parsed: DataFrame, url: str = "url", mode: str = "reference") -> DataFrame:
    """``base`` of each page, in parts: the page's own URL where no tag gives one."""
    given = html.base_href(F.col("tags"), mode)
    if mode == "strict":
        given = urls.resolve(given, F.col(url))
    return parsed.withColumn("base", urls.base_parts(F.coalesce(given, F.col(url), F.lit(""))))


def with_targets(tags: DataFrame) -> DataFrame:
    """Links only, with their ``kind`` (document, image, page) and absolute ``target``."""
    return (
        tags.where(is_link())
        .withColumn("kind", urls.link_class(F.col("href")))
        .withColumn("target", urls.resolve_against(F.col("href"), F.col("base")))
    )


def images(tags: DataFrame, keys: list[str]) -> DataFrame:
    """``filename`` and ``content_type`` of embedded and of linked images."""
    shown, linked = F.col("tag") == "img", is_link() & (urls.link_class(F.col("href")) == "image")
    source = F.when(shown, F.col("src")).when(linked, F.col("href"))
    name = urls.file_name(source)
    kind = F.when(shown, urls.image_type(name)).otherwise(F.upper(urls.extension(source)))
    return tags.where(source != "").select(
        *keys, name.alias("filename"), kind.alias("content_type")
    )


def image_sources(tags: DataFrame, keys: list[str]) -> DataFrame:
    """Every ``img`` tag, those without a source too, with the text after the last dot."""
    return tags.where(F.col("tag") == "img").select(
        *keys, F.col("src").alias("filename"), urls.extension(F.col("src")).alias("content_type")
    )


def documents(tags: DataFrame, keys: list[str]) -> DataFrame:
    """``data_type_code`` of linked documents."""
    return tags.where(is_link() & (urls.link_class(F.col("href")) == "document")).select(
        *keys, urls.extension(F.col("href")).alias("data_type_code")
    )


def anchors(tags: DataFrame) -> DataFrame:
    """Every ``a`` tag; ``href`` is null where it has none."""
    return tags.where(F.col("tag") == "a")


def in_scope_links(targets: DataFrame, scope: str | list[str]) -> DataFrame:
    """Links to web pages whose URL contains the scope text."""
    target = F.col("target")
    return targets.where(
        (F.col("kind") == "page") & urls.in_scope(target, scope) & urls.is_web(target)
    )


def chain_ends(steps: DataFrame) -> DataFrame:
    """``key, end``: where the chain of ``key, next`` that begins at each key ends.

    Every round doubles the steps done, so a chain of any length takes a few rounds and each is
    a join of tables as large as ``steps``; many chains may end at one key. Chains that run into
    a circle have no end and are left out. Of several rows of a key the smallest ``next`` counts.
    """
    ways = cut_lineage(
        steps.where("key IS NOT NULL AND next IS NOT NULL").groupBy("key").agg(F.min("next").alias("end"))
    )
    total, done = ways.count(), 1
    while done <= total:
        on = ways.select(F.col("key").alias("end"), F.col("end").alias("_next"))
        joined = hot_key_join(at_most(ways, total), on, "end", "key")
        moved = cut_lineage(
            joined.select("key", F.coalesce("_next", "end").alias("end"), F.col("_next").isNotNull().alias("_moved"))
        )
        ways, done = moved.select("key", "end"), done * 2
        if moved.where("_moved").isEmpty():
            return ways
    # After as many steps as there are keys only those in circles still go on.
    return ways.join(ways.select(F.col("key").alias("end")), "end", "left_anti").select("key", "end")


def page_links(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Link rows (``from_page``, ``to_page``) for edges (``page_id``, ``url``) by the id of the URL."""
    return (
        hot_key_join(
            edges.select("page_id", "url").distinct(),
            ids.select("url", F.col("id").alias("to_page")), "url", "page_id", "inner",
        )
        .select(F.col("page_id").alias("from_page"), "to_page")
        .dropDuplicates()
    )
