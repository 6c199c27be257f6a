"""The frontier of URLs to visit and the history of those visited."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.operators.joins import hot_key_join
from webloom.schemas import FRONTIER, REDIRECTS

# ---------------------------------------------------------------- scans of the page table


def frontier(page: DataFrame) -> DataFrame:
    """URLs still to visit."""
    return page.where(F.col("page_type_code") == FRONTIER).select("url")


def history(page: DataFrame) -> DataFrame:
    """URLs already visited. A null page type counts neither as visited nor as frontier."""
    return page.where(F.col("page_type_code") != FRONTIER).select("url")


def redirected(page: DataFrame) -> DataFrame:
    """URLs that answered with a redirect."""
    return page.where(F.col("http_status_code").isin(REDIRECTS)).select("url")


def not_redirected(page: DataFrame) -> DataFrame:
    """All other URLs with a status, those of the frontier included."""
    return page.where(~F.col("http_status_code").isin(REDIRECTS)).select("url")


def counts(page: DataFrame) -> DataFrame:
    """Sizes of frontier and history, in one pass."""
    return page.agg(
        F.count_if(F.col("page_type_code") == FRONTIER).alias("frontier"),
        F.count_if(F.col("page_type_code") != FRONTIER).alias("history"),
    )


# ---------------------------------------------------------------- set operations


def distinct_urls(df: DataFrame) -> DataFrame:
    """One row per URL."""
    return df.dropDuplicates(["url"])


def unvisited(urls: DataFrame, visited: DataFrame) -> DataFrame:
    """Rows whose URL is not among the visited ones."""
    return urls.join(visited.select("url"), "url", "left_anti")


def visited_targets(fetched: DataFrame, visited: DataFrame) -> DataFrame:
    """Rows whose redirect target is among the visited URLs; many may share one target."""
    seen = visited.select(F.col("url").alias("redirect_url")).distinct()
    return hot_key_join(fetched, seen, "redirect_url", "url", "left_semi")


def enqueue(queue: DataFrame, urls: DataFrame) -> DataFrame:
    """The queue and the URLs that were not in it yet."""
    return distinct_urls(queue.select("url").unionByName(urls.select("url")))


def mark_visited(visited: DataFrame, urls: DataFrame) -> DataFrame:
    """The history with the URLs added."""
    return visited.select("url").unionByName(urls.select("url")).distinct()


def next_batch(queue: DataFrame, size: int, *order: str | Column) -> DataFrame:
    """The first ``size`` entries of the queue; an empty frame if the queue is empty.

    A top-k: ``size`` rows meet in one task. To take very many, take the whole queue
    (``next_generation``).
    """
    return queue.orderBy(*(order or ("url",))).limit(size)


def next_generation(queue: DataFrame, visited: DataFrame, parents: DataFrame) -> DataFrame:
    """The whole queue but for visited URLs, one level deeper than the discovering page.

    ``parents`` brings ``url``, ``parent`` and the parent's ``depth``.
    """
    depth = parents.groupBy("url").agg((F.min("depth") + 1).alias("depth"))
    return unvisited(distinct_urls(queue.select("url")), visited).join(depth, "url", "left")


def first_discovery(edges: DataFrame, order: list[str]) -> DataFrame:
    """Of the rows that name a URL the first one, by ``order``.

    A minimum and not a window: rows are combined before the shuffle, so a URL
    that half of all pages link to costs no more than any other.
    """
    rest = [c for c in edges.columns if c not in order and c != "url"]
    first = edges.groupBy("url").agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select("url", "_first.*").select(*edges.columns)
