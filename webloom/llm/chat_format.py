"""Chat formatting: typed content parts of every turn flattened into marked text.

A turn is a text or a list of parts: text, image, audio and document. A visitor walks the
parts in order; text is escaped, every attachment leaves a placeholder and is recorded
with its reference, its place and the number of tokens that its placeholder expands to.
A formatted turn reads ``### role: body</turn>`` and a line feed; a conversation is its
turns one after the other.

Escapes: a backslash goes before each backslash, each ``#`` that two more follow, and each
``<`` that begins ``</turn>`` or ``<|``; in a role also before ``#``, ``<`` and ``:``. So no
text can end its turn, begin one or pose as a placeholder, and taking away the
backslashes gives back every text.

Turns are formatted row by row, where they lie. Their places in a conversation (number,
offset, number of the first attachment) come from one range sort over conversation and
turn: a conversation of any length fills as many tasks as it needs, and what
earlier partitions hold of it is added from one small row per partition.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import in_pieces, stage

PART = "kind string, text string, ref string, width int, height int, seconds double, pages int"
ATTACHMENT = "array<struct<kind:string,ref:string,at:bigint,tokens:bigint>>"
SPANS = "array<struct<first:bigint,last:bigint>>"
TURN = f"role string, formatted string, loss {SPANS}, attachments {ATTACHMENT}, chars bigint"

_ARROW = {
    "role": pa.string(),
    "formatted": pa.string(),
    "loss": pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])),
    "attachments": pa.list_(
        pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
    ),
    "chars": pa.int64(),
}

LOSS_ROLE = "assistant"
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"

_IN_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>|\|)")
_IN_ROLE = re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(
    r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S
)
_PLACEHOLDER = re.compile(r"\\.|<\|(\w+)\|>", re.S)


def escape(text: str) -> str:
    return _IN_TEXT.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Expansion:
    """How many tokens stand for an attachment once its placeholder is expanded."""

    patch: int = 28
    """side of the square of pixels that one token of an image covers"""
    per_second: float = 25.0
    """tokens for a second of audio"""
    per_page: int = 576
    """tokens for a page of a document"""

    def image(self, part: dict) -> int:
        return max(1, ceil((part["width"] or 0) / self.patch) * ceil((part["height"] or 0) / self.patch))

    def audio(self, part: dict) -> int:
        return max(1, ceil((part["seconds"] or 0.0) * self.per_second))

    def document(self, part: dict) -> int:
        return max(1, (part["pages"] or 0) * self.per_page)


@dataclass
class Flattener:
    """Visits the parts of one turn and puts together its formatted text.

    Texts without an attachment between them are one text, so that control strings
    that only arise where two meet are escaped as well. An unknown kind of part leaves a
    placeholder of the kind ``file`` that counts as one token.
    """

    expansion: Expansion
    role: str
    pieces: list[str] = field(default_factory=list)
    waiting: list[str] = field(default_factory=list)
    at: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def turn(self, parts: list[dict]) -> str:
        self._put(OPEN + _IN_ROLE.sub(r"\\\g<0>", self.role) + BETWEEN)
        for part in parts:
            getattr(self, f"visit_{part['kind']}", self.visit_file)(part)
        self._flush()
        self._put(CLOSE)
        return "".join(self.pieces)

    def visit_text(self, part: dict) -> None:
        self.waiting.append(part["text"] or "")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, self.expansion.image(part))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, self.expansion.audio(part))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, self.expansion.document(part))

    def visit_file(self, part: dict) -> None:
        self._attach("file", part, 1)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._flush()
        self.attachments.append({"kind": kind, "ref": part["ref"], "at": self.at, "tokens": tokens})
        self._put(f"<|{kind}|>")

    def _flush(self) -> None:
        text = escape("".join(self.waiting))
        self.waiting.clear()
        if text and self.role == LOSS_ROLE:
            self.loss.append({"first": self.at, "last": self.at + len(text)})
        self._put(text)

    def _put(self, text: str) -> None:
        self.pieces.append(text)
        self.at += len(text)


def parse(formatted: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """The turns of a formatted text: role and parts, each (text, its text) or (kind, '')."""
    end = 0
    while end < len(formatted):
        found = _TURN.match(formatted, end)
        if found is None:
            raise ValueError(f"no turn at {end}")
        end = found.end()
        body, begin, parts = found[2], 0, []
        for mark in _PLACEHOLDER.finditer(body):
            if mark[1]:
                parts += [("text", unescape(body[begin : mark.start()])), (mark[1], "")]
                begin = mark.end()
        parts.append(("text", unescape(body[begin:])))
        yield unescape(found[1]), [(kind, text) for kind, text in parts if text or kind != "text"]


def format_turns(
    chats: DataFrame, parts: str | None = None, expansion: Expansion = Expansion()
) -> DataFrame:
    """Every row of ``chats`` (conv_id, turn, role, text) formatted, without its place.

    Gives conv_id, turn, role, formatted, loss (spans of code points within ``formatted``
    that the loss covers: the texts of assistant turns), attachments (kind, ref, at, tokens)
    and chars. ``parts`` names a column ``array<struct<PART>>``; where it isn't null
    it replaces the text. Null texts, roles and parts count as empty. Other columns of
    ``chats`` are left out.
    """
    columns = ["conv_id", "turn", "role", F.col("text").alias("text")]
    if parts is not None:
        columns.append(F.col(parts).cast(f"array<struct<{PART}>>").alias("parts"))
    kinds = {c: chats.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, {TURN}"

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches):
            roles = [role or "" for role in piece["role"].to_pylist()]
            texts = piece["text"].to_pylist()
            lists = piece["parts"].to_pylist() if parts is not None else [None] * len(texts)
            out = {name: [] for name in _ARROW}
            for role, text, many in zip(roles, texts, lists, strict=True):
                if many is None:
                    many = [{"kind": "text", "text": text}]
                visitor = Flattener(expansion, role)
                whole = visitor.turn([part for part in many if part is not None])
                for name, value in zip(
                    out, (role, whole, visitor.loss, visitor.attachments, len(whole)), strict=True
                ):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(
                {"conv_id": piece["conv_id"], "turn": piece["turn"]}
                | {name: pa.array(values, _ARROW[name]) for name, values in out.items()}
            )

    return chats.select(*columns).mapInArrow(formatted, schema)


def format_chats(
    chats: DataFrame, parts: str | None = None, expansion: Expansion = Expansion()
) -> DataFrame:
    """The turns of all conversations, formatted and put in their places.

    Gives conv_id, turn_no (from 0 within the conversation), role, formatted, start (the
    turn's offset in the conversation, in code points), loss and attachments with offsets in
    the conversation, first_attachment (number of the turn's first one) and tokens (of
    all its attachments). A conversation's text is its ``formatted`` in the order of turn_no.

    Turns go by ``turn``, nulls first; rows that share one, repeated rows included, all stay
    and go by role and a hash of the formatted text. Rows without a conv_id form one
    conversation. Empty and very long texts are formatted like any other; an empty table
    gives no rows.
    """
    turns = format_turns(chats, parts, expansion)
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.xxhash64("formatted")]
    schema = (
        f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {TURN}, "
        "part int, head boolean, no bigint, start bigint, files bigint"
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: list = []  # the conversation before, once there is one
        head, no, start, files = True, 0, 0, 0
        for piece in in_pieces(batches):
            rows = []
            for conv, chars, held in zip(
                piece["conv_id"].to_pylist(), piece["chars"].to_pylist(),
                piece["attachments"].to_pylist(), strict=True,
            ):
                if last != [conv]:
                    head, no, start, files = not last, 0, 0, 0
                    last = [conv]
                rows.append((part, head, no, start, files))
                no, start, files = no + 1, start + chars, files + len(held)
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            added = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = piece.schema.names
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, *added], names=[*names, "part", "head", "no", "start", "files"]
            )

    ordered = (
        turns.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")
        .mapInArrow(placed, schema)
    )
    local = stage(ordered, "turns")
    # One row per partition of the sort, whatever the table.
    joined = local.join(F.broadcast(_carried(local)), "part", "left")
    for name, before in (("no", "no_before"), ("start", "chars_before"), ("files", "files_before")):
        carried = F.when(F.col("head"), F.coalesce(before, F.lit(0))).otherwise(0)
        joined = joined.withColumn(name, F.col(name) + carried)
    start = F.col("start")
    return joined.select(
        "conv_id", F.col("no").alias("turn_no"), "role", "formatted", "start",
        F.transform(
            "loss", lambda s: F.struct((s["first"] + start).alias("first"), (s["last"] + start).alias("last"))
        ).alias("loss"),
        F.transform("attachments", lambda a: a.withField("at", a["at"] + start)).alias("attachments"),
        F.col("files").alias("first_attachment"),
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("tokens"),
    )


def _carried(local: DataFrame) -> DataFrame:
    """What earlier partitions hold of the conversation that a partition begins with.

    One row per partition of the range sort meets on the driver: bounded by the number of
    partitions, whatever the table.
    """
    end = F.struct(
        F.struct("conv_id").alias("conv"), F.col("no"), (F.col("start") + F.col("chars")).alias("chars"),
        (F.col("files") + F.size("attachments")).alias("files"),
    )
    ends = local.groupBy("part").agg(
        F.max(F.when(F.col("head"), end)).alias("first"), F.max(end).alias("last")
    )
    rows = []
    previous, held = None, (0, 0, 0)
    for row in sorted(ends.collect(), key=lambda r: r.part):
        carry = held if previous is not None and row.first.conv == previous else (0, 0, 0)
        rows.append((row.part, *carry))
        own = (row.last.no + 1, row.last.chars, row.last.files)
        one = row.first.conv == row.last.conv
        held = tuple(a + b for a, b in zip(carry, own, strict=True)) if one else own
        previous = row.last.conv
    schema = "part int, no_before bigint, chars_before bigint, files_before bigint"
    return local.sparkSession.createDataFrame(rows, schema)


DIGEST = {
    "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
    "formatted_chars": "bigint", "n_attachments": "bigint", "attachment_tokens": "bigint",
}


def digest(placed: DataFrame) -> DataFrame:
    """What can be read back from the output of ``format_chats``, one row per conversation.

    conv_id, n_turns, turns_sha256 (of role, line feed, text, line feed of every turn),
    loss_chars and loss_sha256 (all text under the loss spans, unescaped), formatted_chars,
    n_attachments and attachment_tokens. A digest runs through a conversation from its first turn
    to its last, so one task reads all of it, turn by turn; it holds one turn at a time.
    """
    kind = placed.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "string": pa.string()}

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = []  # the conversation being read, once there is one
        turns = loss = None
        sums: dict[str, int] = {}
        fields: list = []

        def ended() -> pa.RecordBatch:
            row = {"conv_id": last[0], "turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}
            return pa.RecordBatch.from_pylist([row | sums], pa.schema(fields))

        for piece in in_pieces(batches):
            fields = [
                ("conv_id", piece.schema.field("conv_id").type),
                *((name, arrow[type_]) for name, type_ in DIGEST.items()),
            ]
            for row in piece.to_pylist():
                if last != [row["conv_id"]]:
                    if last:
                        yield ended()
                    last = [row["conv_id"]]
                    sums = {name: 0 for name, type_ in DIGEST.items() if type_ == "bigint"}
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                formatted, start = row["formatted"], row["start"]
                for role, parts in parse(formatted):
                    sums["n_turns"] += 1
                    sums["n_attachments"] += sum(kind != "text" for kind, _ in parts)
                    text = "".join(text for _, text in parts)
                    turns.update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(formatted[span["first"] - start : span["last"] - start])
                    sums["loss_chars"] += len(text)
                    loss.update(text.encode())
                sums["formatted_chars"] += len(formatted)
                sums["attachment_tokens"] += row["tokens"]
        if last:
            yield ended()

    dealt = placed.select("conv_id", "turn_no", "formatted", "start", "loss", "tokens")
    schema = ", ".join([f"conv_id {kind}", *(f"{name} {type_}" for name, type_ in DIGEST.items())])
    return (
        dealt.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn_no")
        .mapInArrow(digests, schema)
    )
