from urllib.parse import urljoin

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webloom.functions import urls


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


NORMALIZED = [
    ("https://m.H.example.net/en/25#top", "https://m.h.example.net/en/25/"),
    ("http://h.example.com/fr/825?page=2&ref=x", "http://h.example.com/fr/825?page=2&ref=x/"),
    ("https://h.example.com/a/b/a/c", "https://h.example.com/a/c/"),
    ("https://h.example.com/x/index.html", "https://h.example.com/x/"),
    ("https://h.example.com:8080/x", "https://h.example.com/"),
    ("https://h.example.com/a%20b", "https://h.example.com/a%b/"),
    ("https://h.example.com/a%2Db%2Ec", "https://h.example.com/"),
    ("https://h.example.com/a%5Cb", "https://h.example.com/a\\\\b/"),
    ("HTTPS://H.Example.com/A", "HTTPS://h.example.com/A/"),
    ("https://index.example.com", "https://"),
    ("https://h.example.com/a%41b", "https://h.example.com/a%41b/"),
    ("https://h.example.com/a b/c", "https://h.example.com/a%b/c/"),
    ("https://H.example.com", "https://h.example.com/"),
    ("https://h.example.com/a/b/a/b/a", "https://h.example.com/a/"),
    ("no-colon", None),
    ("mailto:me@example.com", None),
]


def test_normalize_reference(spark):
    df = spark.createDataFrame(NORMALIZED, "url string, expected string")
    got = df.select("url", "expected", urls.normalize(F.col("url")).alias("got")).collect()
    assert [(r.url, r.got) for r in got] == NORMALIZED
    staged = urls.normalization_steps(df, "url").collect()
    assert [(r.url, r.host) for r in staged] == NORMALIZED


def test_normalize_strict(spark):
    cases = [
        ("HTTP://H.example.com:80/a/./b/../c#f", "http://h.example.com/a/c"),
        ("https://h.example.com:443", "https://h.example.com/"),
        ("https://h.example.com:8443/a", "https://h.example.com:8443/a"),
        ("https://h.example.com?q=1", "https://h.example.com/?q=1"),
        ("https://h.example.com/a/b/a/c", "https://h.example.com/a/b/a/c"),
        ("https://h.example.com/index/index.html?x=1", "https://h.example.com/index/?x=1"),
        ("https://h.example.com/a%2db%7Ec%2fd e", "https://h.example.com/a-b~c%2Fd%20e"),
    ]
    got = values(spark, cases, "url string, e string", "url", urls.normalize(F.col("url"), "strict"))
    assert got == cases


def test_domains(spark):
    cases = [
        ("https://www.h.example.com:81/x", "https://www.h.example.com:81/", "h.example.com:81"),
        ("http://a.www.example.com/", "http://a.www.example.com/", "a.example.com"),
        ("example.com", ":///", ""),
    ]
    got = values(
        spark, cases, "url string, a string, b string",
        "url", urls.domain_url(F.col("url")), urls.domain(F.col("url")),
    )
    assert got == cases
    strict = values(
        spark, [("https://me@WWW.H.example.com:81/x",)], "url string",
        urls.domain(F.col("url"), "strict"),
    )
    assert strict == [("h.example.com",)]


def test_images_and_link_classes(spark):
    names = [
        ("/media/p1.png", "p1.png", "PNG"),
        ("a/logo.svg?v=123", "logo.svg?v=123", None),
        ("/x/logo", "logo", "LOGO"),
        ("/x/pictures", "pictures", None),
    ]
    name = urls.file_name(F.col("src"))
    assert values(spark, names, "src string, a string, b string", "src", name, urls.image_type(name)) == names
    classes = [
        ("/files/d7.pdf", "document"),
        ("/files/d7.PDF", "page"),
        ("/t.xlsx", "page"),
        ("/i/a.jpeg", "image"),
        ("/The", "page"),
    ]
    assert values(spark, classes, "h string, c string", "h", urls.link_class(F.col("h"))) == classes


def test_scope_and_sitemap_predicates(spark):
    rows = [
        ("https://a.example.com/sitemap-1.xml", True, True),
        ("https://a.example.com/feed.xml", True, False),
        ("https://other.org/?u=.example.com", True, False),
        ("https://other.org/sitemap.xml", False, True),
    ]
    got = values(
        spark, rows, "u string, a boolean, b boolean",
        "u", urls.in_scope(F.col("u"), ".example."), urls.is_sitemap(F.col("u")),
    )
    assert got == rows


BASES = [
    "http://h.example.com",
    "https://h.example.com/",
    "https://h.example.com/a/b/c",
    "https://h.example.com/a/b/c/?q=1#f",
    "https://h.example.com:81/a/../b/./c?x=/y/../z",
    "/style/main.css",
    "main.css",
]
segment = st.sampled_from(["a", "b.html", ".", "..", "", "ü", "x;y", "p=1", "a:b"])
path = st.lists(segment, min_size=0, max_size=5).map("/".join)
prefix = st.sampled_from(["", "/", "./", "../", "//o.example.org/", "http://o.example.org/", "https://o.example.org", "HTTPS://O.example.org/", "mailto:", "javascript:", " /"])
suffix = st.sampled_from(["", "?q=1", "?q=/../b", "#top", "?q=1#top", "?", "#"])
refs = st.builds(lambda p, q, s: p + q + s, prefix, path, suffix)


def _odd(ref):
    # Empty authorities ("///x", "/.//x") are read differently by Python versions.
    return ref.lstrip().startswith("///") or "//" in ref.split("://")[-1].lstrip("/")


@settings(
    max_examples=3,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=list(HealthCheck),
)
@given(st.lists(refs.filter(lambda r: not _odd(r)), min_size=60, max_size=60))
def test_resolve_like_standard_library(spark, batch):
    rows = [(b, r) for b in BASES for r in batch]
    got = values(spark, rows, "base string, href string", "base", "href", urls.resolve(F.col("href"), F.col("base")))
    wrong = [(b, r, g, urljoin(b, r)) for b, r, g in got if g != urljoin(b, r)]
    assert not wrong, wrong[:10]
