"""Schemas of the crawl store, of its inputs, and its seed rows."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType | tuple[T.DataType, bool]) -> T.StructType:
    out = T.StructType()
    for name, spec in fields.items():
        kind, nullable = spec if isinstance(spec, tuple) else (spec, True)
        out.add(name, kind, nullable)
    return out


STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
BYTES, TIME = T.BinaryType(), T.TimestampNTZType()

# The public tables of the store.
TABLES: dict[str, T.StructType] = {
    "data_type": _struct(code=(STRING, False)),
    "page_type": _struct(code=(STRING, False)),
    "site": _struct(id=LONG, domain=STRING, robots_content=STRING, sitemap_content=STRING),
    "page": _struct(
        id=LONG,
        site_id=LONG,
        page_type_code=STRING,
        url=STRING,
        html_content=STRING,
        html_content_hash=LONG,
        http_status_code=INT,
        accessed_time=TIME,
    ),
    "page_data": _struct(id=LONG, page_id=LONG, data_type_code=STRING, data=BYTES),
    "image": _struct(
        id=LONG, page_id=LONG, filename=STRING, content_type=STRING, data=BYTES, accessed_time=TIME
    ),
    "link": _struct(from_page=(LONG, False), to_page=(LONG, False)),
}

# Inputs.
FETCH = _struct(
    url=STRING, html=STRING, http_status_code=INT, redirect_url=STRING, accessed_time=TIME
)
SITE_FILE = _struct(authority=STRING, path=STRING, status=INT, body=STRING)
FETCH_LOG = _struct(url=STRING, log_idx=INT, message=STRING)

# Seed rows of the two code tables.
SEED_DATA_TYPES = ["PDF", "DOC", "DOCX", "PPT", "PPTX"]
SEED_PAGE_TYPES = ["HTML", "BINARY", "DUPLICATE", "FRONTIER"]

# Page states. FAILED is the four-letter text, not a null.
HTML, DUPLICATE, FRONTIER, FAILED = "HTML", "DUPLICATE", "FRONTIER", "NULL"
NO_HTML = "NULL"

# Status codes that mean "moved", and the status of a page not yet fetched.
REDIRECTS = [301, 302, 307]
UNFETCHED = -1

# Column lengths of the relational schema.
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "data_type": {"code": 20},
    "page_type": {"code": 20},
    "site": {"domain": 500},
    "page": {"page_type_code": 20, "url": 3000},
    "page_data": {"data_type_code": 20},
    "image": {"filename": 255, "content_type": 50},
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "data_type": ["code"],
    "page_type": ["code"],
    "site": ["id"],
    "page": ["id"],
    "page_data": ["id"],
    "image": ["id"],
    "link": ["from_page", "to_page"],
}

# child table, child column, parent table, parent column
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("image", "page_id", "page", "id"),
    ("link", "from_page", "page", "id"),
    ("link", "to_page", "page", "id"),
    ("page", "site_id", "site", "id"),
    ("page", "page_type_code", "page_type", "code"),
    ("page_data", "page_id", "page", "id"),
    ("page_data", "data_type_code", "data_type", "code"),
]
