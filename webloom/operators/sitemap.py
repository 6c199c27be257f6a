"""Sitemap files: nested ones expanded, and their URLs as the text of a site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions import html, urls
from webloom.operators.joins import at_most, cut_lineage, hot_key_join, numbered

SITEMAP_PATH = "sitemap.xml"
PART_URLS = 10_000


def sitemap_locations(files: DataFrame, ok: list[int]) -> DataFrame:
    """``authority, path, locs``: the entries of every sitemap file that was fetched."""
    return files.where(
        (F.col("path") != "robots.txt") & F.col("status").isin(ok)
    ).select("authority", "path", html.locations(F.col("body")).alias("locs"))


REACHED = """
WITH RECURSIVE reached(site, authority, path, seen) MAX RECURSION LEVEL 1000 AS (
  SELECT site, authority, path, array(struct(authority, path)) FROM {start}
  UNION ALL
  SELECT r.site, n.to_authority, n.to_path,
    array_append(r.seen, struct(n.to_authority AS authority, n.to_path AS path))
  FROM reached r JOIN {nested} n ON r.authority = n.authority AND r.path = n.path
  WHERE NOT array_contains(r.seen, struct(n.to_authority AS authority, n.to_path AS path)))
SELECT DISTINCT site, authority, path FROM reached
"""


def reached_files(start: DataFrame, nested: DataFrame) -> DataFrame:
    """``site, authority, path``: the sitemap files of each site, over all levels, in one plan.

    ``start``: the first file of each site; ``nested``: files (``authority, path``) and those that
    they name (``to_authority, to_path``). A file is not followed from one that it led to, so
    cycles end. Rows are files by the ways that lead to them; Spark's limit of a million rows a
    recursion is lifted for the session, since a crawl of many sites has more.
    """
    spark = start.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark.sql(REACHED, start=start, nested=nested)


def expand_sitemaps(files: DataFrame, ok: list[int], roots: DataFrame | None = None) -> DataFrame:
    """``authority, url``: page URLs that the sitemap of each site names.

    An entry that names another sitemap is followed, over as many levels as there
    are. ``roots`` limits the sites (``site, authority``) and gives them other names; then the
    result is ``site, url``.
    """
    located = sitemap_locations(files, ok)
    loc = F.col("loc")
    nested = (
        located.select("authority", "path", F.explode("locs").alias("loc"))
        .where(urls.is_sitemap(loc))
        .select(
            "authority",
            "path",
            urls.authority(loc).alias("to_authority"),
            F.regexp_replace(loc, rf"^(?:{urls.SCHEME}:)?//[^/?#]*/?", "").alias("to_path"),
        )
        .distinct()
    )
    start = located.where(F.col("path") == SITEMAP_PATH).select("authority", "path").distinct()
    if roots is None:
        start = start.select(F.col("authority").alias("site"), "authority", "path")
    else:
        start = start.join(roots, "authority").select("site", "authority", "path")
    # Only the few files that name other files take part in the recursion; it reads them each time.
    reached = cut_lineage(reached_files(start, cut_lineage(nested)))
    file = F.struct("authority", "path").alias("_file")
    # Many sites may name one file: the one join here that may meet a hot key.
    sites = at_most(reached.select("site", file), reached.count())
    return (
        hot_key_join(sites, located.select(file, "locs"), "_file", spread="site", how="inner")
        .select(F.col("site").alias("authority" if roots is None else "site"), F.explode("locs").alias("url"))
        .where(~urls.is_sitemap(F.col("url")))
        .distinct()
    )


def sitemap_texts(site_urls: DataFrame, key: str, per_part: int = PART_URLS) -> DataFrame:
    """``part, sitemap_content``: the sorted URLs of each site, one per line, in numbered parts.

    Every site has the same form: part n holds its URLs from the n * ``per_part``-th on.
    The URLs (distinct per site) are numbered by a range sort, so a site of any size
    fills many tasks, and no value is larger than one part.
    """
    ordered = numbered(site_urls.select(key, "url"), [key, "url"], "_row")
    first = ordered.groupBy(key).agg(F.min("_row").alias("_first"))
    part = F.floor((F.col("_row") - F.col("_first")) / per_part).cast("int")
    return (
        hot_key_join(ordered, first, key, spread="url")
        .groupBy(key, part.alias("part"))
        .agg(F.array_join(F.array_sort(F.collect_list("url")), "\n").alias("sitemap_content"))
    )


def first_texts(texts: DataFrame) -> DataFrame:
    """The first part of every site, which for most is all."""
    return texts.where("part = 0").drop("part")
