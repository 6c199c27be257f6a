"""Tags and their attributes, taken from HTML text by native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import bind, decode_entities

# One attribute: a name, then perhaps '=' and a value in one of three quotings.
# Possessive quantifiers keep the matcher iterative, so a tag of any length fits.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_ATTRIBUTE = rf"[^\s/>][^\s/=>]*+(?:\s*+=\s*+{_VALUE}?+)?+"
_ATTRIBUTES = rf"(?:[\s/]++|{_ATTRIBUTE})*+"
_NAME_AND_VALUE = rf"([^\s/>][^\s/=>]*+)(?:\s*+=\s*+({_VALUE})?+)?+"


def _token_pattern(names: list[str]) -> str:
    """Start tags of the given names; comments and scripts match as a whole,
    so that tags inside them are passed over. What the text's end leaves open matches
    up to there, or every further '<' would search the rest again."""
    return (
        # One leading '<' for all cases: other characters fail at the first test.
        r"(?is)<(?:!--.*?(?:-->|\z)"
        rf"|(script|style)(?=[\s/>]){_ATTRIBUTES}(?:\z|>.*?(?:</\1\s*>|\z))"
        rf"|(?:{'|'.join(names)})(?=[\s/>]){_ATTRIBUTES}(?:\z|>))"
    )


def _parse(token: Column) -> Column:
    attributes = F.regexp_replace(token, r"^<[A-Za-z]+", "")
    parts = F.struct(
        F.lower(F.regexp_extract(token, r"^<([A-Za-z]+)", 1)).alias("tag"),
        F.transform(
            F.regexp_extract_all(attributes, F.lit(_NAME_AND_VALUE), F.lit(1)), F.lower
        ).alias("names"),
        F.regexp_extract_all(attributes, F.lit(_NAME_AND_VALUE), F.lit(2)).alias("values"),
    )

    def attribute(p: Column, name: str) -> Column:
        # Of an attribute given twice the last one counts; one without a value is ''.
        raw = F.try_element_at(
            F.filter(p["values"], lambda v, i: F.get(p["names"], i) == name), F.lit(-1)
        )
        return decode_entities(F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")).alias(name)

    return bind(
        parts,
        lambda p: F.struct(
            p["tag"].alias("tag"), attribute(p, "href"), attribute(p, "src"), attribute(p, "rel")
        ),
    )


def tags(html: Column, names: tuple[str, ...] = ("a", "link", "img", "base")) -> Column:
    """The start tags of a page in document order.

    ``array<struct<tag, href, src, rel>>``; an attribute that is missing is null.
    """
    wanted = [n.lower() for n in names]
    tokens = F.regexp_extract_all(html, F.lit(_token_pattern(wanted)), F.lit(0))
    whole = lambda t: F.endswith(t, F.lit(">"))
    kept = F.filter(tokens, lambda t: whole(t) & t.rlike(rf"^<(?i:{'|'.join(wanted)})[\s/>]"))
    return F.transform(kept, _parse)


def canonical(tag_array: Column) -> Column:
    """The first ``<link rel="canonical">``, null if the page has none.

    A struct, since the tag may be there without its ``href``.
    """
    trimmed = lambda t: F.regexp_replace(t["rel"], r"^\s+|\s+$", "")
    return F.try_element_at(
        F.filter(tag_array, lambda t: (t["tag"] == "link") & (trimmed(t) == "canonical")), F.lit(1)
    )


def base_href(tag_array: Column, mode: str = "reference") -> Column:
    """The ``href`` against which the page's links resolve, null if it has none.

    Reference mode takes the first ``base`` or ``link`` tag, strict mode ``base`` only.
    """
    kinds = ["base"] if mode == "strict" else ["base", "link"]
    return F.try_element_at(
        F.filter(tag_array, lambda t: t["tag"].isin(kinds) & t["href"].isNotNull()), F.lit(1)
    )["href"]


def explode_tags(pages: DataFrame, tag_array: str = "tags") -> DataFrame:
    """One row per tag: the other columns of the page, ``pos`` from 0, and the tag."""
    rest = [c for c in pages.columns if c != tag_array]
    # Outer, with the filter behind it: for a plain explode Catalyst adds a filter on
    # the array's size, moves it down to the scan and so parses every page twice.
    exploded = pages.select(*rest, F.posexplode_outer(tag_array).alias("pos", "_tag"))
    return exploded.where("pos is not null").select(*rest, "pos", "_tag.*")


def locations(xml: Column) -> Column:
    """Texts of the ``<loc>`` elements of a sitemap, in order."""
    found = F.regexp_extract_all(xml, F.lit(r"(?is)<loc(?=[\s/>])[^>]*>(.*?)</loc\s*>"), F.lit(1))
    return F.transform(found, visible_text)


def visible_text(markup: Column) -> Column:
    """Text with its tags and comments removed and its references decoded."""
    return decode_entities(F.regexp_replace(markup, r"(?s)<!--.*?(?:-->|\z)|</?[A-Za-z][^>]*>", ""))
