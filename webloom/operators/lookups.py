"""Point lookups of the store, as joins over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.operators.joins import hot_key_join

NOT_FOUND = -1


def _lookup(df, table, key: str, values: dict[str, str], spread: str, missing) -> DataFrame:
    found = table.groupBy(key).agg(
        F.min(F.struct(F.col("id"), *[F.col(c) for c in values if c != "id"])).alias("_row")
    )
    joined = hot_key_join(df, found, key, spread)
    for source, name in values.items():
        value = F.col(f"_row.{source}")
        joined = joined.withColumn(name, value if missing is None else F.coalesce(value, F.lit(missing)))
    return joined.drop("_row")


def with_site_id(df, site, domain: str = "domain", spread: str = "url", missing=None) -> DataFrame:
    """``site_id`` by domain; null (or ``missing``) for a domain not in ``site``."""
    table = site.select("id", F.col("domain").alias(domain))
    return _lookup(df, table, domain, {"id": "site_id"}, spread, missing)


def with_page_id(df, page, url: str = "url", spread: str = "url", missing=None) -> DataFrame:
    """``page_id`` by URL."""
    table = page.select("id", F.col("url").alias(url))
    return _lookup(df, table, url, {"id": "page_id"}, spread, missing)


def with_page_type(df, page, url: str = "url", spread: str = "url", missing=None) -> DataFrame:
    """``page_type_code`` by URL."""
    table = page.select("id", F.col("url").alias(url), "page_type_code")
    return _lookup(df, table, url, {"page_type_code": "page_type_code"}, spread, missing)


def with_page_of_hash(df, page, spread: str = "url", missing=None) -> DataFrame:
    """``same_page_id``: the stored page with the same content.

    ``df`` and ``page`` bring ``html_content_hash`` and the digest ``html_sha256``,
    which tells apart texts whose short hashes collide.
    """
    table = page.where(F.col("html_content_hash").isNotNull()).select("id", "html_sha256")
    return _lookup(df, table, "html_sha256", {"id": "same_page_id"}, spread, missing)
