"""Crawl inputs made from a table of raw pages (``page_id, url, html``).

Raw pages alone have no images, canonical links, redirects, robots files or logs.
The statements below add them by rule, page by page, so every input grows with the
pages. They are plain SQL that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a page gets in addition: condition, markup.
_ADDED = [
    ("page_id % 17 = 4", "'<link rel=\"canonical\">'"),
    (
        "page_id % 11 = 0",
        "'<link rel=\"canonical\" href=\"https://canon.example.org/c' || CAST(page_id % 3 AS STRING) || '/\">'",
    ),
    ("page_id % 11 = 5", "'<link rel=\"canonical\" href=\"' || url || '\">'"),
    (
        "page_id % 10 = 4",
        "'<base href=\"https://Base.example.org/dir' || CAST(page_id % 4 AS STRING) || '/index.html\">'",
    ),
    ("page_id % 5 = 0", "'<img src=\"/media/p' || CAST(page_id AS STRING) || '.png\">'"),
    ("page_id % 6 = 1", "'<IMG SRC=''pics/logo.svg?v=' || CAST(page_id AS STRING) || '''>'"),
    ("page_id % 9 = 2", "'<img src=\"\"><img alt=\"x > y\">'"),
    ("page_id % 7 = 0", "'<a href=\"/files/d' || CAST(page_id AS STRING) || '.pdf\">d</a>'"),
    ("page_id % 14 = 3", "'<a href=\"/files/t' || CAST(page_id AS STRING) || '.PDF\">t</a>'"),
    ("page_id % 8 = 3", "'<a href=\"/i/a' || CAST(page_id AS STRING) || '.jpeg\">i</a>'"),
    ("page_id % 6 = 0", "'<a name=\"mark\">m</a>'"),
    ("page_id % 3 = 0", "'<a href=\"sub/x' || CAST(page_id % 5 AS STRING) || '.html?q=1#f\">s</a>'"),
    (
        "page_id % 3 = 1",
        "'<a href=\"https://WWW.Shop' || CAST(page_id % 50 AS STRING) || '.Example.com:8080/a\">p</a>'",
    ),
    (
        "page_id % 4 = 2",
        "'<a href=\"http://Docs.example.org/x%2Dy/p' || CAST(page_id % 20 AS STRING) || '/index.html\">x</a>'",
    ),
    (
        "page_id % 4 = 3",
        "'<a href=\"http://docs.example.org/a/b/a/c d' || CAST(page_id % 9 AS STRING) || '\">y</a>'",
    ),
    ("page_id % 12 = 1", "'<a href=\"/q?a=1&amp;b=' || CAST(page_id % 3 AS STRING) || '\">q</a>'"),
    ("page_id % 15 = 2", "'<a href=\"mailto:info@www.example.com\">mail</a>'"),
    ("page_id % 13 = 0", "'<a href=\"' || replace(url, '://', '://copy.') || '\">copy</a>'"),
    ("page_id % 2 = 0", "'<a href=\"' || url || '\">self</a>'"),
    ("page_id % 2 = 1", "'<a href=\"https://spam-farm.example.org/start/\">start</a>'"),
]

_HTML = "html" + "".join(
    f"\n    || CASE WHEN {when} THEN {markup} ELSE '' END" for when, markup in _ADDED
)

# pages_x: richer pages with status and redirect target.
# pages_xc: the same and copies of some of them under a further host.
# archive: what a crawl of several generations meets. Pages (page_id % 8 = 0) lead to pages of a
# further host, those to others, over three levels (1 to 3), with copies, faults and links back.
# chained: pages whose canonical link leads to another page, over up to four steps, some in circles.
# authorities, site_files: robots and sitemap files of every host.
# fetch_log: browser log entries of every page.
CTES = rf"""
pages_x AS (
  SELECT page_id * 2 AS page_id, url,
    {_HTML} AS html,
    CASE page_id % 10 WHEN 3 THEN 301 WHEN 5 THEN 307 WHEN 6 THEN 404 WHEN 9 THEN 400 ELSE 200 END
      AS status,
    CASE WHEN page_id % 10 IN (3, 5) THEN
      CASE page_id % 4
        WHEN 1 THEN 'https://moved.example.org/t' || CAST(page_id % 40 AS STRING) || '/'
        WHEN 3 THEN 'https://moved.example.org/u' || CAST(page_id AS STRING) || '/'
        ELSE url END
      ELSE url END AS redirect_url
  FROM PAGES),
pages_xc AS (
  SELECT page_id, url, html, status, redirect_url FROM pages_x
  UNION ALL
  SELECT page_id + 1, replace(url, '://', '://copy.'), html, status, redirect_url
  FROM pages_x WHERE page_id % 26 = 0),
archive AS (
  SELECT page_id * 8 AS page_id, url, html || '<a href="https://next.example.org/g1/p'
    || CAST(page_id AS STRING) || '/">next</a>' AS html, status, redirect_url FROM pages_x
  UNION ALL
  SELECT page_id * 8 + 1, 'https://next.example.org/g1/p' || CAST(page_id AS STRING) || '/',
    '<p>first ' || CAST(page_id % 22 AS STRING) || '</p><a href="/g2/p' || CAST(page_id % 14 AS STRING)
      || '/">on</a><a href="/g1/p0/">back</a><img src="/i/' || CAST(page_id % 22 AS STRING) || '.png">',
    CASE page_id % 20 WHEN 6 THEN 301 WHEN 8 THEN 404 WHEN 12 THEN 400 ELSE 200 END,
    'https://next.example.org/g1/p' || CAST(page_id AS STRING) || '/'
  FROM pages_x WHERE page_id % 6 <> 4
  UNION ALL
  SELECT k * 8 + 2, 'https://next.example.org/g2/p' || CAST(k AS STRING) || '/',
    CASE WHEN k % 4 = 0 THEN '<p>second</p><a href="/g3/p' || CAST(k AS STRING) || '/">on</a>'
      ELSE '<p>second ' || CAST(k AS STRING) || '</p><a href="/g3/p' || CAST(k AS STRING)
        || '/">on</a><a href="https://next.example.org/g3/p' || CAST(k % 4 AS STRING) || '/">also</a>' END,
    200, 'https://next.example.org/g2/p' || CAST(k AS STRING) || '/'
  FROM (SELECT DISTINCT page_id % 14 AS k FROM pages_x) AS second
  UNION ALL
  SELECT k * 8 + 3, 'https://next.example.org/g3/p' || CAST(k AS STRING) || '/',
    '<link rel="canonical" href="https://next.example.org/g3/p' || CAST(k % 4 AS STRING)
      || '/"><p>third ' || CAST(k AS STRING) || '</p><a href="/g4/none/">out</a>',
    200, 'https://next.example.org/g3/p' || CAST(k AS STRING) || '/'
  FROM (SELECT DISTINCT page_id % 14 AS k FROM pages_x) AS third),
chained AS (
  SELECT a.page_id, a.url, b.url AS canonical_href FROM pages_x a JOIN pages_x b
    ON b.page_id = CASE WHEN a.page_id % 40 = 30 THEN a.page_id + 6 ELSE a.page_id - 2 END
  WHERE a.page_id % 10 <> 0 AND a.page_id % 4 <> 2 OR a.page_id % 40 >= 30),
authorities AS (
  SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS authority, min(page_id) AS m
  FROM pages_xc GROUP BY 1),
site_files AS (
  SELECT authority, 'robots.txt' AS path,
    CASE m % 18 WHEN 2 THEN 404 WHEN 4 THEN 403 WHEN 6 THEN 500 WHEN 8 THEN 301 ELSE 200 END AS status,
    CASE m % 5
      WHEN 0 THEN 'User-agent: *' || chr(10) || 'Disallow: /' || chr(10)
      WHEN 1 THEN 'User-agent: bot' || chr(10) || 'Disallow: /' || chr(10) || chr(10)
        || 'User-agent: *' || chr(10) || 'Allow: /en/' || chr(10) || 'Disallow: /e' || chr(10)
        || 'Disallow: /fr # note' || chr(10)
      WHEN 2 THEN '<pre>' || chr(10) || 'user-agent : *' || chr(10) || 'DISALLOW: /de' || chr(10)
        || 'Crawl-delay: 2' || chr(10) || 'Disallow: /fr/' || chr(10) || '</pre>'
      WHEN 3 THEN 'Disallow: /' || chr(10) || 'User-agent: *' || chr(10) || 'Disallow:' || chr(10)
      ELSE 'User-agent: *' || chr(10) || chr(10) || 'Disallow: /' || chr(10) END AS body
  FROM authorities
  UNION ALL
  SELECT authority, 'sitemap.xml', CASE m % 14 WHEN 8 THEN 404 ELSE 200 END,
    '<sitemapindex><loc>https://' || authority || '/sitemap-1.xml</loc><loc>https://' || authority
      || '/p1?a=1&amp;b=2</loc><loc>https://' || authority || '/feed.xml</loc></sitemapindex>'
  FROM authorities WHERE m % 3 <> 1
  UNION ALL
  SELECT authority, 'sitemap-1.xml', 200,
    '<urlset><loc>https://' || authority || '/p2</loc><loc>https://' || authority
      || '/p' || CAST(m AS STRING) || '</loc><loc>https://' || authority || '/sitemap.xml</loc></urlset>'
  FROM authorities WHERE m % 3 = 0),
fetch_log AS (
  SELECT url, CAST(log_idx AS INT) AS log_idx,
    CASE WHEN log_idx <> 3 THEN '{{"message":{{"params":{{"response":{{"status":999}}}}}}}}'
    ELSE CASE page_id % 14
      WHEN 0 THEN '{{"message":{{"params":{{"response":{{"headersText":"HTTP/1.1 '
        || CAST(status AS STRING) || ' Text\r\nX: y","status":599}}}}}}}}'
      WHEN 2 THEN '{{"message":{{"params":{{"response":{{"headers":{{"status":"' || CAST(status AS STRING)
        || '"}},"status":598}}}}}}}}'
      WHEN 4 THEN '{{"message":{{"params":{{"redirectResponse":{{"headersText":"HTTP/1.1 302 Found"}}}}}}}}'
      WHEN 6 THEN '{{"message":{{"params":{{"redirectResponse":{{"headers":{{"status":"307"}}}}}}}}}}'
      WHEN 8 THEN '{{"message":{{"params":{{"response":{{"status":' || CAST(status AS STRING) || '}}}}}}}}'
      WHEN 10 THEN '{{"message":{{"params":{{}}}}}}'
      ELSE '{{"message":{{"params":{{"response":{{"headersText":"HTTP/2 none"}}}}}}}}' END END AS message
  FROM pages_x CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS v(log_idx))
"""


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables above, from ``pages`` in ``sf_dir``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    escaped = CTES.replace("{", "{{").replace("}", "}}").replace("PAGES", "{pages}")
    if name == "fetch_log":  # a backslash in a Spark literal starts an escape
        escaped = escaped.replace("\\", "\\\\")
    return spark.sql(f"WITH {escaped} SELECT * FROM {name}", pages=pages)


def fetched(pages: DataFrame) -> DataFrame:
    """Derived pages in the form of a fetch, one second of access apart."""
    time = F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, page_id)")
    return pages.select(
        "url",
        "html",
        F.col("status").cast("int").alias("http_status_code"),
        "redirect_url",
        time.alias("accessed_time"),
    )
