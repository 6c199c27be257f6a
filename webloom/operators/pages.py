"""Routing of fetched pages by status, and detection of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import urls
from webloom.operators.joins import ROWS_PER_TASK, at_most, hot_key_join
from webloom.schemas import DUPLICATE, FAILED, HTML, REDIRECTS

# Statuses that count as a page, by kind of pass.
SUCCESS = [200]
SUCCESS_OR_REDIRECT = [200, *REDIRECTS]
BAD_REQUEST = 400


def succeeded(status: Column) -> Column:
    return status.cast("int").isin(SUCCESS)


def succeeded_or_moved(status: Column) -> Column:
    return status.cast("int").isin(SUCCESS_OR_REDIRECT)


def route(status: Column, accepted: list[int], target_visited: Column | None = None) -> Column:
    """What becomes of a response: visited_redirect, ok, bad_request or failed."""
    code = status.cast("int")
    visited = F.lit(False) if target_visited is None else target_visited
    return (
        F.when(visited, "visited_redirect")
        .when(code.isin(accepted), "ok")
        .when(code == BAD_REQUEST, "bad_request")
        .otherwise("failed")
    )


def is_canonical_copy(
    has_canonical: Column, href: Column, url: Column, mode: str = "reference"
) -> Column:
    """True where the page names another URL as its canonical one.

    The reference rule compares the texts and also takes a canonical tag without
    ``href`` for another URL; strict mode compares normalised, resolved URLs.
    """
    if mode == "strict":
        target = urls.normalize(urls.resolve(href, url), mode)
        return has_canonical & href.isNotNull() & ~target.eqNullSafe(urls.normalize(url, mode))
    return has_canonical & ~href.eqNullSafe(url)


def content_representatives(pages: DataFrame, digest: str, order: list[str]) -> DataFrame:
    """For every content its first page by ``order`` (as ``first``) and its number of copies."""
    return (
        pages.where(F.col(digest).isNotNull())
        .groupBy(digest)
        .agg(F.min(F.struct(*order)).alias("first"), F.count("*").alias("copies"))
    )


def classify(
    pages: DataFrame,
    stored: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> DataFrame:
    """Page type of accepted pages, and of which page a copy is one.

    ``pages``: ``url, page_id, accessed_time, html_sha256, canonical_copy``;
    ``stored``: ``id, html_sha256`` of the pages already in the store, as far as they have a
    content of ``pages``; ``rows``: how many pages there are at most, if known. Adds
    ``page_type_code``, ``copy_kind`` (canonical, content or null) and
    ``original_id`` of a content copy. The stored page comes first, then the
    earliest page of the batch; ties go by URL. Canonical copies never represent
    a content.
    """
    digest = F.col("html_sha256")
    batch = pages.where(~F.col("canonical_copy") & digest.isNotNull()).select(
        "html_sha256",
        F.struct(
            F.lit(1).alias("age"), "accessed_time", "url", F.col("page_id").alias("id")
        ).alias("page"),
    )
    known = batch
    if stored is not None:
        older = stored.where(digest.isNotNull()).select(
            "html_sha256",
            F.struct(
                F.lit(0).alias("age"),
                F.lit(None).cast("timestamp_ntz").alias("accessed_time"),
                F.lit(None).cast("string").alias("url"),
                "id",
            ).alias("page"),
        )
        known = batch.unionByName(older)
    first = (
        known.groupBy("html_sha256")
        .agg(
            F.min("page").alias("first"),
            F.count("*").alias("n"),
            F.max("page.age").alias("in_batch"),
        )
        # Only contents that occur twice decide anything.
        .where((F.col("n") > 1) & (F.col("in_batch") == 1))
        .select("html_sha256", "first")
    )
    pages = at_most(pages, rows)
    joined = hot_key_join(pages, first, "html_sha256", "url", rows_per_task=rows_per_task)
    content_copy = (
        ~F.col("canonical_copy")
        & F.col("first").isNotNull()
        & ~F.col("first.url").eqNullSafe(F.col("url"))
    )
    kind = F.when(F.col("canonical_copy"), "canonical").when(content_copy, "content")
    return (
        joined.withColumn("copy_kind", kind)
        .withColumn("original_id", F.when(F.col("copy_kind") == "content", F.col("first.id")))
        .withColumn(
            "page_type_code", F.when(F.col("copy_kind").isNull(), HTML).otherwise(DUPLICATE)
        )
        .drop("first")
    )


def failed_type() -> Column:
    """Page type of a response that is no page: the text, not a null."""
    return F.lit(FAILED)
