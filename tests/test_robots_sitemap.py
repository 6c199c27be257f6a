from urllib.robotparser import RobotFileParser

from webloom.operators import robots, sitemap
from webloom.schemas import SITE_FILE

ROBOTS = {
    "plain": "User-agent: *\nAllow: /a/open\nDisallow: /a\nDisallow: /b\n",
    "other": "User-agent: bot\nDisallow: /\n\nUser-agent: *\nDisallow: /a # note\n",
    "empty-rule": "User-agent: *\nDisallow:\nDisallow: /a\n",
    "two-defaults": "User-agent: *\nDisallow: /a\n\nUser-agent: *\nDisallow: /b\n",
    "shared": "User-agent: bot\nUser-agent: *\nDisallow: /b\nCrawl-delay: 3\nDisallow: /c\n",
    "split": "User-agent: *\n\nDisallow: /a\n\nUser-agent: *\nDisallow: /b\r\nUser-agent: z\nDisallow: /c",
    "no-agent": "Disallow: /a\n",
    "quoted": "user-AGENT : *\nDISALLOW : /q%3Fx\nDisallow: /%C3%A9\nnonsense\nSitemap: http://x/y\n",
    "nothing": "",
    "nameless": "User-agent: *\nDisallow: /a\n\nUser-agent:\nDisallow: /b\n",
    "root": "User-agent: *\nAllow: /b\nDisallow: /\n",
}
PATHS = ["", "/", "/a", "/a/open/x", "/a/y", "/b", "/b?x=1", "/c", "/q?x=1", "/q%3fx", "/é", "/%c3%a9/z", "/a b"]
OK = [200]


def test_rules_like_standard_library(spark):
    files = spark.createDataFrame([(a, "robots.txt", 200, t) for a, t in ROBOTS.items()], SITE_FILE)
    links = [(f"https://{a}{p}",) for a in ROBOTS for p in PATHS]
    policy = robots.robots_policy(files, OK)
    for rows_per_task in (None, 3):  # 3: every site is a hot key and gets spread
        got = robots.with_robots(spark.createDataFrame(links, "url string"), policy, rows_per_task=rows_per_task)
        got = {r.url: r.allowed for r in got.collect()}
        assert len(got) == len(links)
        for authority, text in ROBOTS.items():
            parser = RobotFileParser()
            parser.parse(text.splitlines())
            parser.modified()
            for path in PATHS:
                url = f"https://{authority}{path}"
                assert got[url] == parser.can_fetch("*", url), (authority, path)


def test_status_of_the_file(spark):
    deny = "User-agent: *\nDisallow: /\n"
    files = spark.createDataFrame(
        [("closed", "robots.txt", 403, deny), ("gone", "robots.txt", 404, deny),
         ("broken", "robots.txt", 500, deny), ("moved", "robots.txt", 301, deny)], SITE_FILE)
    links = spark.createDataFrame([(f"http://{a}/x",) for a in ("closed", "gone", "broken", "moved", "none")], "url string")
    got = robots.with_robots(links, robots.robots_policy(files, [200, 301, 302, 307]))
    assert {r.url: r.allowed for r in got.collect()} == {
        "http://closed/x": False, "http://gone/x": True, "http://broken/x": False,
        "http://moved/x": False, "http://none/x": True}
    text = robots.robots_content(files, [200, 301, 302, 307]).collect()
    assert [(r.authority, r.robots_content) for r in text] == [("moved", deny)]


def _sitemap(*locs):
    return "<urlset>" + "".join(f"<url><loc>{u}</loc></url>" for u in locs) + "</urlset>"


def test_nested_sitemaps_and_cycle(spark):
    h = "https://h.example.com/"
    files = spark.createDataFrame(
        [("h.example.com", "sitemap.xml", 200, _sitemap(h + "sitemap-1.xml", h + "p1", h + "feed.xml", h + "sitemap-none.xml")),
         ("h.example.com", "sitemap-1.xml", 200, _sitemap(h + "p2", h + "sitemap.xml", "https://o.example.com/deep/sitemap-2.xml")),
         ("o.example.com", "deep/sitemap-2.xml", 200, _sitemap(h + "p3", h + "p1")),
         ("x.example.com", "sitemap.xml", 404, _sitemap(h + "no")),
         ("o.example.com", "robots.txt", 200, "")], SITE_FILE)
    got = sitemap.expand_sitemaps(files, OK)
    assert sorted(map(tuple, got.collect())) == [("h.example.com", h + u) for u in ("feed.xml", "p1", "p2", "p3")]
    texts = sitemap.sitemap_texts(got, "authority").collect()
    assert [tuple(r) for r in texts] == [("h.example.com", 0, "\n".join(h + u for u in ("feed.xml", "p1", "p2", "p3")))]


def test_sitemap_of_a_huge_site_comes_in_parts(spark):
    many = spark.range(2_503).selectExpr("'big' AS authority", "format_string('https://big/%05d', id) AS url")
    few = spark.createDataFrame([("a", "https://a/1"), ("z", "https://z/1"), ("z", "https://z/2")], many.schema)
    parts = sitemap.sitemap_texts(many.union(few), "authority", per_part=100).collect()
    found = {(r.authority, r.part): r.sitemap_content.split("\n") for r in parts}
    assert found["a", 0] == ["https://a/1"] and found["z", 0] == ["https://z/1", "https://z/2"]
    assert len(found) == 26 + 2
    for n in range(26):
        assert found["big", n] == [f"https://big/{i:05d}" for i in range(100 * n, min(2503, 100 * n + 100))]


def test_redirected_robots_file_leaves_its_rules(spark):
    files = spark.createDataFrame(
        [("a", "robots.txt", 301, "User-agent: *\nDisallow: /x"), ("b", "robots.txt", 302, None),
         ("c", "robots.txt", 403, "")], SITE_FILE)
    asked = spark.createDataFrame([(f"https://{h}/{p}",) for h in "abc" for p in "xy"], "url string")
    got = {r.url: r.allowed for r in robots.with_robots(asked, robots.robots_policy(files, OK)).collect()}
    assert got == {"https://a/x": False, "https://a/y": True, "https://b/x": True, "https://b/y": True,
                   "https://c/x": False, "https://c/y": False}
