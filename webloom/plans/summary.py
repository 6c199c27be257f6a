"""Short reports on single pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions import html
from webloom.operators import robots


def link_summary(pages: DataFrame, keys: list[str], first: int = 10) -> DataFrame:
    """Number of anchors of each page and its first ``first`` links, nulls included.

    Counted inside the page's own row: no exchange at all.
    """
    hrefs = F.transform(html.tags(F.col("html"), ("a",)), lambda t: t["href"])
    return pages.select(*keys, hrefs.alias("_h")).select(
        *keys, F.size("_h").alias("n_links"), F.slice("_h", 1, first).alias("first_links")
    )


def page_summary(pages: DataFrame, policy: DataFrame, first: int = 10) -> DataFrame:
    """``link_summary`` and status of the pages that their site's robots file allows.

    ``pages``: ``url``, ``html``, ``http_status_code``.
    """
    summary = link_summary(pages, ["url", "http_status_code"], first)
    return robots.with_robots(summary, policy).where("allowed").drop("allowed")
