"""Changes to single tables, as functions from the old table to the new one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom import schemas
from webloom.operators.joins import hot_key_join, with_ids

FRONTIER_DEFAULTS = {
    "site_id": (None, "bigint"),
    "page_type_code": (schemas.FRONTIER, "string"),
    "html_content": (None, "string"),
    "html_content_hash": (None, "bigint"),
    "http_status_code": (schemas.UNFETCHED, "int"),
    "accessed_time": (None, "timestamp_ntz"),
}


def _next_id(table: DataFrame) -> int:
    return table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def insert_sites(site: DataFrame, new: DataFrame) -> DataFrame:
    """The site table with the domains that it lacked (``domain``, contents)."""
    added = new.dropDuplicates(["domain"]).join(site.select("domain"), "domain", "left_anti")
    return site.unionByName(with_ids(added, "domain", _next_id(site)).select(site.columns))


def new_frontier_rows(urls: DataFrame, page: DataFrame, after: int) -> DataFrame:
    """Page rows for those of the (distinct) URLs that the page table lacks.

    Other columns of ``urls`` pass through.
    """
    fresh = urls.join(page.select("url"), "url", "left_anti")
    rows = with_ids(fresh, "url", after)
    for name, (value, kind) in FRONTIER_DEFAULTS.items():
        rows = rows.withColumn(name, F.lit(value).cast(kind))
    return rows


def insert_frontier(page: DataFrame, urls: DataFrame) -> DataFrame:
    """The page table with the URLs that it lacked, as pages still to visit."""
    rows = new_frontier_rows(urls.select("url").distinct(), page, _next_id(page))
    return page.unionByName(rows.select(page.columns))


def frontier_ids(page_before: DataFrame, page_after: DataFrame, urls: DataFrame) -> DataFrame:
    """``url, id`` of an insert: the new id, or -1 where the URL was there before."""
    added = page_after.select("url", "id").join(page_before.select("url"), "url", "left_anti")
    return urls.select("url").distinct().join(added, "url", "left").select(
        "url", F.coalesce("id", F.lit(-1)).alias("id")
    )


def update_pages(page: DataFrame, updates: DataFrame) -> DataFrame:
    """The page table with rows replaced by URL; ``updates`` may rename (``new_url``).

    URLs that are not in the table are not inserted.
    """
    changed = [c for c in page.columns if c not in ("id", "url")]
    new = updates.select("url", F.struct(F.col("new_url").alias("url"), *changed).alias("_new"))
    hit = F.col("_new").isNotNull()
    return page.join(new, "url", "left").select(
        *[
            F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c != "id" else F.col(c)
            for c in page.columns
        ]
    )


def insert_images(image: DataFrame, rows: DataFrame) -> DataFrame:
    """The image table with rows (``page_id, pos, filename, content_type, accessed_time``) appended."""
    return image.unionByName(image_rows(rows, _next_id(image)))


def _placed(rows: DataFrame, after: int) -> DataFrame:
    """``rows`` with an id by page and position of the tag: the same in every run."""
    return with_ids(rows.withColumn("_place", F.struct("page_id", "pos")), "_place", after)


def image_rows(rows: DataFrame, after: int) -> DataFrame:
    return _placed(rows, after).select(
        "id",
        "page_id",
        "filename",
        "content_type",
        F.lit(None).cast("binary").alias("data"),
        "accessed_time",
    )


def insert_documents(page_data: DataFrame, rows: DataFrame) -> DataFrame:
    """The document table with rows (``page_id, pos, data_type_code``) appended."""
    return page_data.unionByName(document_rows(rows, _next_id(page_data)))


def document_rows(rows: DataFrame, after: int) -> DataFrame:
    return _placed(rows, after).select(
        "id",
        "page_id",
        "data_type_code",
        F.lit(None).cast("binary").alias("data"),
    )


def insert_links(link: DataFrame, rows: DataFrame) -> DataFrame:
    """The link table with the pairs that it lacked."""
    keys = ["from_page", "to_page"]
    return link.unionByName(rows.select(keys).dropDuplicates().join(link, keys, "left_anti"))


def repoint_links(link: DataFrame, remap: DataFrame) -> DataFrame:
    """Links into ``to_page`` start at ``new_from`` from now on; equal pairs become one.

    ``remap`` has one row per ``to_page``. Salted: half of all links may lead to one page.
    """
    moved = hot_key_join(link, remap.select("to_page", "new_from"), "to_page", "from_page")
    return moved.select(
        F.coalesce("new_from", "from_page").alias("from_page"), "to_page"
    ).dropDuplicates()


def insert_codes(codes: DataFrame, new: DataFrame) -> DataFrame:
    """The code table with codes it lacked; upper and lower case differ."""
    return codes.select("code").unionByName(new.select("code")).where("code is not null").distinct()


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All tables of the store, empty but for the seed codes."""
    tables = {name: spark.createDataFrame([], schema) for name, schema in schemas.TABLES.items()}
    for name, codes in (
        ("data_type", schemas.SEED_DATA_TYPES),
        ("page_type", schemas.SEED_PAGE_TYPES),
    ):
        tables[name] = spark.createDataFrame([(c,) for c in codes], schemas.TABLES[name])
    return tables


def table_names() -> list[str]:
    """The tables of the store."""
    return list(schemas.TABLES)
