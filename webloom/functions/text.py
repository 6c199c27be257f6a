"""Character references, percent triplets and content hashes."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def replace_matches(text: Column, pattern: str, replace) -> Column:
    """``text`` with every match of ``pattern`` replaced by ``replace(match)``.

    The native ``regexp_replace`` can only insert fixed text; here the
    replacement is a column expression of the match.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    decoded = F.transform(
        matches, lambda m, i: F.concat(replace(m), F.element_at(between, i + F.lit(2)))
    )
    return F.concat(F.element_at(between, 1), F.array_join(decoded, ""))


# Names that HTML lets stand without the final semicolon, and those that need it.
_NAMED = json.dumps(dict(html5))
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"


def _code_point(number: Column) -> Column:
    # char() covers one byte only, so go through UTF-32. Code points without a
    # character give the replacement character.
    usable = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    four_bytes = F.unhex(F.lpad(F.hex(F.when(usable, number).otherwise(0xFFFD)), 8, "0"))
    return F.decode(four_bytes, "UTF-32")


def decode_entities(text: Column) -> Column:
    """Character references (named, decimal, hexadecimal) turned into characters."""
    named = F.from_json(F.lit(_NAMED), "map<string,string>")

    def one(ref: Column) -> Column:
        body = F.regexp_replace(ref, "^&#[xX]?0*(?=[^;])|;$", "")
        number = (
            # More digits than a code point can have would overflow conv().
            F.when(ref.rlike("^&#[xX]"), F.when(F.length(body) <= 8, F.conv(body, 16, 10)))
            .when(ref.startswith("&#"), body)
            .try_cast("bigint")
        )
        return F.when(
            ref.startswith("&#"), _code_point(F.coalesce(number, F.lit(0)))
        ).otherwise(F.coalesce(F.try_element_at(named, F.substring(ref, 2, 64)), ref))

    return F.when(F.contains(text, F.lit("&")), replace_matches(text, _REFERENCE, one)).otherwise(
        text
    )


def percent_decode(text: Column) -> Column:
    """Percent triplets decoded as UTF-8; '+' and stray '%' stay as they are."""
    plain = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9a-fA-F]{2})", "%25")
    return F.when(F.contains(text, F.lit("%")), F.coalesce(F.try_url_decode(plain), text)).otherwise(
        text
    )


def content_hash(html: Column) -> Column:
    """A stable 60-bit content hash: the same text hashes alike in every session."""
    return F.conv(F.substring(F.md5(html), 1, 15), 16, 10).cast("bigint")


def content_digest(html: Column) -> Column:
    """The key that decides whether two texts are equal (SHA-256, hexadecimal)."""
    return F.sha2(html, 256)
