import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from webloom.functions import html, text

PAGES = "/root/testdata/sf0.001/pages.parquet"


class Tags(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag in ("a", "link", "img", "base"):
            named = {k: v or "" for k, v in attrs}
            self.found.append((tag, named.get("href"), named.get("src"), named.get("rel")))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)


def by_parser(page):
    parser = Tags()
    parser.feed(page)
    parser.close()
    return parser.found


SNIPPETS = [
    '<p id="top"> <img src="pics/first_one.png" title="One" </p><a href=/after>',
    "<a href='/whole'>x</a><a href='/open",
    "<script src='/s'",
    "<A HREF='/x?a=1&amp;b=2' title=\"a > b\">x</A><abbr href=/no>",
    "<a href=/plain/path>x</a><a href=>y</a><a href>z</a><a name=q>w</a>",
    "<a data-href='/no' href = \"/yes\">x</a><a href='/one' href='/two'>",
    "<!-- <a href='/hidden'> --><script>var t=\"<a href='/js'>\"</script><a href='/seen'>",
    "<style>a{}</style><base href=\"https://h.example.com/\"/><link rel='stylesheet' href=s.css />",
    "<link rel=canonical><img src=''><img\nsrc=\n'a.png'\n>",
    "<a title=it's href='/apostrophe'>x</a>",
    "<a href='&#47;num&#x2f;hex&eacute;&copy;&nosuch;&amp'>x</a>",
    "",
    "no tags < a href",
]


def test_tags_like_standard_parser(spark):
    pages = spark.read.parquet(PAGES).select("html")
    literal = spark.createDataFrame([(s,) for s in SNIPPETS], "html string")
    rows = pages.union(literal).select("html", html.tags(F.col("html")).alias("t")).collect()
    for r in rows:
        assert [tuple(t) for t in r.t] == by_parser(r.html), r.html[:200]


def test_long_tag_does_not_overflow(spark):
    long = "<a " + "x " * 50_000 + "title='" + "y" * 200_000 + "' href='/end'>" + "<!--" + "z" * 300_000
    df = spark.createDataFrame([(long,)], "html string")
    assert [t.href for t in df.select(html.tags(F.col("html"))).first()[0]] == ["/end"]


@pytest.mark.parametrize("piece", ["<a ", "<a href='", "<script ", "<!--", "<a b=\"", "<style"])
def test_time_grows_with_the_text_alone(spark, piece):
    broken = "<a href='/first'>" + piece * (1_000_000 // len(piece))
    df = spark.createDataFrame([(broken,)], "html string").cache()
    df.count()
    start = time.time()
    found = [t.href for t in df.select(html.tags(F.col("html"))).first()[0]]
    assert found[0] == "/first" and time.time() - start < 4


def test_canonical_and_base(spark):
    cases = [
        ("<link rel='canonical' href='/a'><link rel='canonical' href='/b'>", (True, "/a"), "/a", None),
        ("<link rel=' canonical '>", (True, None), None, None),
        ("<link rel='canonical alternate' href='/x'>", None, "/x", None),
        ("<link rel='Canonical' href='/x'><base href='/y'>", None, "/x", "/y"),
        ("<base target='_top'><base href='/b'>", None, "/b", "/b"),
        ("<p>", None, None, None),
    ]
    tag = html.tags(F.col("h"))
    got = (
        spark.createDataFrame([(c[0],) for c in cases], "h string")
        .select("h", html.canonical(tag).alias("c"), html.base_href(tag).alias("b"),
                html.base_href(tag, "strict").alias("s"))
        .collect()
    )
    assert [(r.h, (True, r.c.href) if r.c else None, r.b, r.s) for r in got] == cases


def test_locations_and_visible_text(spark):
    xml = "<urlset><url><loc>https://h.example.com/a?x=1&amp;y=2</loc></url>\n<url><LOC>\nb</LOC></url><location>no</location></urlset>"
    df = spark.createDataFrame([(xml,)], "x string")
    assert df.select(html.locations(F.col("x"))).first()[0] == ["https://h.example.com/a?x=1&y=2", "\nb"]
    robots = spark.createDataFrame([("<pre>User-agent: *\nAllow: /a&amp;b</pre><!-- c -->\n",)], "x string")
    assert robots.select(html.visible_text(F.col("x"))).first()[0] == "User-agent: *\nAllow: /a&b\n"


def test_entities(spark):
    from html import unescape

    cases = ["a&amp;b", "&lt;&gt;&quot;&#39;&#x27;", "&eacute;&hellip;&notin;", "no refs", "&#128512;", "& &;", "&#0;",
             "&#x0000000041;&#00000000000000065;", "&#xFFFFFFFFFFFFFFFFFFFFFFFF;&#99999999999999999999999;"]
    got = spark.createDataFrame([(c,) for c in cases], "s string").select(
        text.decode_entities(F.col("s"))
    ).collect()
    assert [r[0] for r in got] == [unescape(c) for c in cases]


def test_percent_decode(spark):
    from urllib.parse import unquote

    cases = ["/a%20b+c", "/100%", "/%zz%41", "/%C3%A9", "plain"]
    got = spark.createDataFrame([(c,) for c in cases], "s string").select(
        text.percent_decode(F.col("s"))
    ).collect()
    assert [r[0] for r in got] == [unquote(c) for c in cases]


def test_content_hash_is_stable(spark):
    row = spark.sql("select 'abc' as h").select(text.content_hash(F.col("h")), text.content_digest(F.col("h"))).first()
    assert row[0] == int("900150983cd24fb"[:15], 16)
    assert row[1].startswith("ba7816bf")
