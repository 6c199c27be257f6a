"""URL parts, resolution and normalisation as column expressions.

``mode="reference"`` keeps the historical rules, oddities included, so that
existing stores keep their keys; ``mode="strict"`` follows RFC 3986.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions.text import bind, replace_matches

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"

# Triplets that rule 6 decodes, and what they become.
DECODED_TRIPLETS = {
    "%20": " ",
    "%25": "%",
    "%2d": "-",
    "%2e": ".",
    "%3c": "<",
    "%3e": ">",
    "%5c": "\\\\",
    "%5e": "^",
    "%5f": "_",
    "%60": "`",
    "%7b": "{",
    "%7c": "|",
    "%7d": "}",
    "%7e": "~",
}

# Extensions of linked documents and images, case-sensitive.
DOCUMENT_EXTENSIONS = ["pdf", "doc", "docx", "ppt", "pptx"]
IMAGE_EXTENSIONS = ["jpg", "png", "ico", "jpeg", "gif"]


def _check(mode: str) -> bool:
    if mode not in ("reference", "strict"):
        raise ValueError(f"mode must be 'reference' or 'strict', not {mode!r}")
    return mode == "strict"


# ---------------------------------------------------------------- parts


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, f"^({SCHEME}):", 1))


def authority(url: Column) -> Column:
    """Host with port and user information, '' where the URL has none."""
    return F.regexp_extract(url, f"^(?:{SCHEME}:)?//([^/?#]*)", 1)


def domain_url(url: Column) -> Column:
    """``scheme://authority/``"""
    return F.concat(scheme(url), F.lit("://"), authority(url), F.lit("/"))


def domain(url: Column, mode: str = "reference") -> Column:
    """Host of the URL without "www."."""
    if _check(mode):
        host = F.regexp_replace(F.lower(authority(url)), r"^[^@]*@|:[0-9]*$", "")
        return F.regexp_replace(host, r"^www\.", "")
    return F.replace(authority(url), F.lit("www."), F.lit(""))


def extension(href: Column) -> Column:
    """Text after the last dot; all of it where there is no dot."""
    return F.substring_index(href, ".", -1)


def file_name(href: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(href, "/", -1)


def image_type(name: Column) -> Column:
    """Upper-case extension of an image file name; null if it is over 5 characters."""
    ext = extension(name)
    return F.when(F.length(ext) <= 5, F.upper(ext))


def link_class(href: Column) -> Column:
    """'document', 'image' or 'page', by the extension of the link as written."""
    ext = extension(href)
    return (
        F.when(ext.isin(DOCUMENT_EXTENSIONS), "document")
        .when(ext.isin(IMAGE_EXTENSIONS), "image")
        .otherwise("page")
    )


def in_scope(url: Column, scope: str | list[str]) -> Column:
    """True where the URL contains (one of) the scope text(s)."""
    scopes = [scope] if isinstance(scope, str) else list(scope)
    hit = F.lit(False)
    for text in scopes:
        hit = hit | F.contains(url, F.lit(text))
    return hit


def is_web(url: Column) -> Column:
    return url.rlike("^(?i:https?)://")


def is_sitemap(url: Column) -> Column:
    """True where a sitemap entry names another sitemap."""
    return url.endswith(".xml") & F.contains(url, F.lit("sitemap"))


# ---------------------------------------------------------------- normalisation


def drop_port(url: Column, mode: str = "reference") -> Column:
    if _check(mode):
        out = F.regexp_replace(url, r"^((?i:http)://[^/?#]*):80(?=[/?#]|$)", "$1")
        return F.regexp_replace(out, r"^((?i:https)://[^/?#]*):443(?=[/?#]|$)", "$1")
    return F.when(F.contains(url, F.lit(":")), F.substring_index(url, ":", 2))


def drop_fragment(url: Column, mode: str = "reference") -> Column:
    _check(mode)
    return F.substring_index(url, "#", 1)


def add_slash(url: Column, mode: str = "reference") -> Column:
    if _check(mode):
        return F.regexp_replace(url, r"^([^:/?#]+://[^/?#]+)(?=[?#]|$)", "$1/")
    return F.when(url.endswith("/"), url).when(url != "", F.concat(url, F.lit("/")))


def collapse_directories(url: Column, mode: str = "reference") -> Column:
    """Where a directory comes twice, what stood before its repeat goes away."""
    if _check(mode):
        path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
        head = F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)
        tail = F.regexp_extract(url, r"([?#](?s:.*))$", 1)
        dotted = path.rlike(_DOTTED) & (head != "")
        clean = bind(_without_dots(path), _rooted)
        return F.when(dotted, F.concat(head, clean, tail)).otherwise(url)

    def step(kept: Column, name: Column) -> Column:
        return F.when(F.array_contains(kept, name), F.array(name)).otherwise(
            F.concat(kept, F.array(name))
        )

    def rebuilt(parts: Column, folders: Column) -> Column:
        kept = F.aggregate(folders, F.array().cast("array<string>"), step)
        # An empty last name gives the final slash.
        names = F.concat(F.slice(parts, 1, 3), kept, F.array(F.lit("")))
        return F.array_join(names, "/")

    def collapsed(parts: Column) -> Column:
        folders = F.slice(parts, 4, F.greatest(F.size(parts) - 4, F.lit(0)))
        return (
            F.when(F.size(parts) < 3, None)
            .when(F.size(parts) == 3, F.concat(url, F.lit("/")))
            .when(F.size(F.array_distinct(folders)) == F.size(folders), url)
            .otherwise(bind(folders, lambda f: rebuilt(parts, f)))
        )

    return bind(F.split(url, "/", -1), collapsed)


def drop_default_file(url: Column, mode: str = "reference") -> Column:
    if _check(mode):
        return F.regexp_replace(url, r"/index\.[A-Za-z0-9]+(?=[?#]|$)", "/")
    last = F.try_element_at(F.split(url, "/", -1), F.lit(-2))
    return F.when(
        F.substring_index(last, ".", 1) == "index", F.substring_index(url, "index", 1)
    ).otherwise(url)


def decode_triplets(url: Column, mode: str = "reference") -> Column:
    """Decode percent triplets that need no encoding (reference: the first one only)."""
    if _check(mode):
        char = lambda t: F.char(F.conv(F.substring(t, 2, 2), 16, 10).cast("int"))
        return F.when(
            F.contains(url, F.lit("%")),
            replace_matches(
                url,
                "%[0-9A-Fa-f]{2}",
                lambda t: F.when(char(t).rlike(r"^[A-Za-z0-9._~\-]$"), char(t)).otherwise(
                    F.upper(t)
                ),
            ),
        ).otherwise(url)
    before, first = F.split_part(url, F.lit("%"), F.lit(1)), F.split_part(url, F.lit("%"), F.lit(2))
    triplet = F.lower(F.concat(F.lit("%"), F.substring(first, 1, 2)))
    table = F.create_map(*[F.lit(x) for pair in DECODED_TRIPLETS.items() for x in pair])
    decoded = F.concat(before, F.try_element_at(table, triplet), F.substring(first, 3, 1 << 30))
    return F.when(F.contains(url, F.lit("%")), F.coalesce(decoded, url)).otherwise(url)


def encode_spaces(url: Column, mode: str = "reference") -> Column:
    return F.replace(url, F.lit(" "), F.lit("%20" if _check(mode) else "%"))


def lower_host(url: Column, mode: str = "reference") -> Column:
    """Host in lower case; reference mode also drops the text after the last slash."""
    if _check(mode):
        head = F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)
        return F.concat(F.lower(head), _after(url, head))
    kept = F.regexp_extract(url, r"^((?s:.*)/)", 1)
    head = F.concat(F.substring_index(kept, "/", 2), F.lit("/"))
    rest = _after(kept, head)
    host = F.substring_index(rest, "/", 1)
    return F.when(
        F.size(F.split(kept, "/", -1)) > 3, F.concat(head, F.lower(host), _after(rest, host))
    ).otherwise(kept)


def _after(text: Column, prefix: Column) -> Column:
    return F.substr(text, F.length(prefix) + F.lit(1))


# The eight rules in the order in which they apply.
RULES = [
    ("port", drop_port),
    ("fragment", drop_fragment),
    ("slash", add_slash),
    ("directories", collapse_directories),
    ("default_file", drop_default_file),
    ("triplets", decode_triplets),
    ("spaces", encode_spaces),
    ("host", lower_host),
]


def normalize(url: Column, mode: str = "reference") -> Column:
    """All eight rules. Null where the URL lacks the parts that a rule needs."""
    for _, rule in RULES:
        url = bind(url, lambda u, rule=rule: rule(u, mode))
    return url


def normalization_steps(df, url: str, mode: str = "reference"):
    """``df`` with the result of each rule as a column of its own, named by the rule.

    One projection per rule. Do not filter on the results: Catalyst would move the
    filter below and repeat the rules in it. ``normalize`` has no such trap.
    """
    current = F.col(url)
    for name, rule in RULES:
        df = df.withColumn(name, rule(current, mode))
        current = F.col(name)
    return df


# ---------------------------------------------------------------- resolution

_DOTTED = r"(?:^|/)\.\.?(?:/|$)"


def _without_dots(path: Column) -> Column:
    """Path with its '.' and '..' segments worked in (RFC 3986, 5.2.4)."""

    def step(kept: Column, seg: Column) -> Column:
        return (
            F.when(seg == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(seg == ".", kept)
            .otherwise(F.concat(kept, F.array(seg)))
        )

    kept = F.aggregate(
        F.split(path, "/", -1),
        F.array().cast("array<string>"),
        step,
        # A path that ends in a dotted segment names a folder.
        lambda names: F.concat(
            F.array_join(names, "/"),
            F.when(path.rlike(r"(?:^|/)\.\.?$") & (F.size(names) > 0), "/").otherwise(""),
        ),
    )
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("/"))


def _rooted(path: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def _part(url: Column, group: int) -> Column:
    """Scheme, authority, path, query, fragment by RFC 3986, appendix B."""
    shape = rf"^(?:({SCHEME}):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#((?s:.*)))?$"
    return F.regexp_extract(url, shape, group)


def base_parts(base: Column) -> Column:
    """What ``resolve`` needs of a base URL, taken apart once per page."""
    return bind(base, _base_parts)


def _base_parts(base: Column) -> Column:
    path = _part(base, 3)
    folder = F.regexp_extract(path, r"^((?s:.*)/)", 1)
    host, query = authority(base), _part(base, 4)
    prefix = F.when(scheme(base) != "", F.concat(scheme(base), F.lit(":"))).otherwise("")
    origin = F.when(host != "", F.concat(prefix, F.lit("//"), host)).otherwise(prefix)
    return F.struct(
        base.alias("url"),
        scheme(base).alias("scheme"),
        prefix.alias("prefix"),
        (host != "").alias("rooted"),
        origin.alias("origin"),
        path.alias("path"),
        F.when((folder == "") & (host != ""), "/").otherwise(folder).alias("folder"),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise("").alias("query"),
    )


def _without_empty_tail(url: Column) -> Column:
    """URL without a '?' or '#' that nothing follows."""
    short = lambda u: F.regexp_replace(
        F.regexp_replace(u, r"^([^?#]*)\?(?=#|$)", "$1"), r"^([^#]*)#$", "$1"
    )
    return bind(url, lambda u: F.when(u.rlike(r"[?#]$|\?#"), short(u)).otherwise(u))


def _join(ref: Column, at: Column) -> Column:
    """``ref``, which has no scheme and no host of its own, below the base ``at``."""
    path = F.regexp_extract(ref, "^([^?#]*)", 1)

    def with_path(p: Column) -> Column:
        # Empty segments inside a merged path vanish, those of a rooted link stay.
        merged = F.when(p.startswith("/"), p).otherwise(
            F.regexp_replace(F.concat(at["folder"], p), "(?<=.)/{2,}", "/")
        )
        dotless = bind(merged, lambda m: F.when(m.rlike(_DOTTED), _without_dots(m)).otherwise(m))
        rooted = bind(
            dotless,
            lambda m: F.when(at["rooted"] & ~m.startswith("/"), F.concat(F.lit("/"), m)).otherwise(m),
        )
        return F.concat(at["origin"], rooted, _after(ref, p))

    own_query = ref.rlike(r"^\?[^#]")
    return (
        F.when(own_query, F.concat(at["origin"], at["path"], ref))
        .when(ref.rlike("^[?#]"), F.concat(
            at["origin"], at["path"], at["query"], F.regexp_replace(ref, r"^\?", "")))
        .otherwise(bind(path, with_path))
    )


def resolve_against(href: Column, at: Column) -> Column:
    """The link ``href`` as seen from a base given by its ``base_parts`` (RFC 3986, section 5).

    Links of another scheme (``mailto:``, ``javascript:``) come back unchanged. The
    usual links, rooted or absolute, leave at the first tests.
    """

    def split(ref: Column) -> Column:
        return F.struct(
            scheme(ref).alias("scheme"), F.regexp_replace(ref, f"^{SCHEME}:", "").alias("rest")
        )

    def cases(p: Column) -> Column:
        # "http:page" on an http base is a relative link with a needless scheme.
        joined = F.when(
            p["rest"].rlike("^//[^/?#]"), F.concat(at["prefix"], p["rest"])
        ).otherwise(_join(p["rest"], at))
        return F.when((p["scheme"] != "") & (p["scheme"] != at["scheme"]), href).otherwise(
            _without_empty_tail(joined)
        )

    odd = r"^[\x00-\x20]|[\t\r\n]"
    cleaned = F.when(
        href.rlike(odd),
        F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", ""),
    ).otherwise(href)
    plain = href.rlike(r"^/(?!/)(?:[^./?#\t\r\n]|\.(?!/|\.?/|\.?$)|/(?!\.))*+$") & at["rooted"]
    return (
        F.when(at["url"] == "", href)
        .when(plain, F.concat(at["origin"], href))
        .when(href == "", at["url"])
        .otherwise(bind(bind(cleaned, split), cases))
    )


def resolve(href: Column, base: Column) -> Column:
    """The link ``href`` as seen from the URL ``base``."""
    return bind(base_parts(F.coalesce(base, F.lit(""))), lambda at: resolve_against(href, at))
