"""Token counts of a byte-level BPE vocabulary, without producing identifiers.

A text is cut by the vocabulary's split pattern. Within a piece, a heap yields the
adjacent pair of lowest rank (leftmost first) again and again and a linked list joins
it; the count is the number of initial symbols minus the merges made. Special strings
are cut out first and count one each.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from webloom.llm.common import map_arrow, utf8

REMEMBER = 300_000  # pieces whose count a task keeps at most, twice
REMEMBER_LENGTH = 32
# Fixed value: the split pattern of byte-level vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def unassigned() -> tuple[str, str]:
    """Character classes: the code points without a category in Python's tables, and all from the first.

    The pattern's tables are newer than the library's and may call some of them letters,
    so a text that holds one is cut by the library's own splitter.
    """
    ranges: list[list[int]] = []
    for c in range(0x400, 0x110000):  # the older blocks are settled
        if unicodedata.category(chr(c)) == "Cn":
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    inside = "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)
    return f"[{inside}]", f"[{chr(ranges[0][0])}-\U0010ffff]"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in such vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    others = [b for b in range(256) if b not in table]
    table |= {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class MergeRules:
    """The merges of a vocabulary: (left, right) to (rank, joined), symbols as small integers."""

    def __init__(self, definition: dict):
        model = definition["model"]
        splitter = definition["pre_tokenizer"] or {}
        plain = not model.get("byte_fallback") and not model.get("ignore_merges")
        if model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or not plain:
            raise ValueError("only byte-level BPE vocabularies are supported")
        if definition["normalizer"] or splitter["add_prefix_space"] or not splitter["use_regex"]:
            raise ValueError("vocabularies with a normalizer or prefix space are not supported")
        number = {s: i for i, s in enumerate(byte_symbols())}
        self.ranks: dict[int, int] = {}  # by left << 32 | right
        self.joined: list[int] = []  # by rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.joined.append(number.setdefault(left + right, len(number)))
            self.ranks.setdefault(number[left] << 32 | number[right], rank)
        added = definition["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens with stripping or word rules are not supported")
        # Where several could start at one place, the longest counts.
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = "|".join(map(re.escape, contents))

    def count(self, piece: bytes) -> int:
        """How many symbols are left of ``piece`` once no pair can be merged."""
        get, joined, n = self.ranks.get, self.joined, len(piece)
        symbols = list(piece)
        # The rank of each symbol and its right neighbour now, or None.
        ranks = [get(a << 32 | b) for a, b in zip(symbols, symbols[1:], strict=False)]
        heap = [r << 32 | i for i, r in enumerate(ranks) if r is not None]
        if not heap:
            return n
        ranks.append(None)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        merges = 0
        while heap:
            lowest = heapq.heappop(heap)
            i = lowest & 0xFFFFFFFF
            if ranks[i] != lowest >> 32:
                continue  # a neighbour has been merged since
            merges += 1
            whole = symbols[i] = joined[lowest >> 32]
            j = after[i]
            ranks[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = ranks[i] = get(whole << 32 | symbols[k])
                if r is not None:
                    heapq.heappush(heap, r << 32 | i)
            else:
                ranks[i] = None
            h = before[i]
            if h >= 0:
                r = ranks[h] = get(symbols[h] << 32 | whole)
                if r is not None:
                    heapq.heappush(heap, r << 32 | h)
        return n - merges


class Counter:
    """Counts whole texts; remembers the counts of short pieces up to a fixed number."""

    def __init__(self, rules: MergeRules):
        self.rules, self.split = rules, regex.compile(SPLIT)
        self.special = re.compile(rules.special) if rules.special else None
        unknown, high = unassigned()
        self.unknown, self.high = re.compile(unknown), re.compile(high)
        self.slow_split = ByteLevel(add_prefix_space=False, use_regex=True)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and self.high.search(text) and self.unknown.search(text):
            spans = (span for _, span in self.slow_split.pre_tokenize_str(text))
            return [text[start:end] for start, end in spans]
        return self.split.findall(text)

    def _piece(self, piece: str) -> int:
        n = self.older.get(piece)
        if n is None:
            n = self.rules.count(piece.encode())
        if len(piece) <= REMEMBER_LENGTH:
            if len(self.known) >= REMEMBER:
                self.known, self.older = {}, self.known  # what is in use comes back from there
            self.known[piece] = n
        return n

    def count(self, text: str) -> int:
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self._plain(part) for part in parts)
        return self._plain(text)

    def _plain(self, text: str) -> int:
        get, look = self.known.get, self._piece
        return sum([get(piece) or look(piece) for piece in self.pieces(text)])


_counters: dict[str, Counter] = {}


def _counter(definition: str) -> Counter:
    """This worker's counter, kept from task to task."""
    if definition not in _counters:
        _counters[definition] = Counter(MergeRules(json.loads(definition)))
    return _counters[definition]


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row, by the vocabulary file at ``vocabulary``.

    No begin or end tokens, no truncation or padding; special strings inside a text
    count as the special token they name. Null and empty texts have 0 bytes and
    tokens. Repeated rows are counted each; an empty table gives no rows; other
    columns are not read. The vocabulary is read by the driver and broadcast: a
    file of fixed size.
    """
    with open(vocabulary, encoding="utf-8") as file:
        definition = json.load(file)
    MergeRules(definition)  # fails here, not in a task, if it is of another kind
    shared = docs.sparkSession.sparkContext.broadcast(json.dumps(definition))

    def body(part: pa.RecordBatch) -> dict:
        counter = _counter(shared.value)
        texts = utf8(part.column(1))
        tokens = [counter.count(t.decode("utf-8", "replace")) for t in texts]
        return {
            "id": part.column(0).cast(pa.int64()),
            "n_bytes": pa.array(map(len, texts), pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
        }

    schema = "id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_arrow(docs, [id_col, text_col], body, schema).withColumnRenamed("id", id_col)
