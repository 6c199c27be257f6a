"""Exact duplicates against a history, through a minimal perfect hash over its digests.

The history's distinct digests are dealt to shards by their leading bits. Each shard
holds a minimal perfect hash (levels of bit sets; a digest's slot is the rank of its
bit) whose slots keep the full digest and the locator of the winning row. A new
delivery, combined per digest first, asks its shard for the slot and compares all 32
bytes: equal means a repeat, anything else is grouped separately.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import WHITE, map_arrow, stage, utf8

KEYS_PER_SHARD = 2_000
LEVELS = 24
GAMMA = 2.0  # bits of a level per digest that is still without a slot
INDEX = "shard int, sizes array<int>, bits binary, digests binary, ids array<bigint>, lengths array<bigint>, counts array<bigint>"
WINNERS = "digest binary, id bigint, length bigint, n bigint"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, length): SHA-256 of each text without white space, and its code points."""

    def body(part: pa.RecordBatch) -> dict:
        texts = utf8(part.column(1))
        return {
            "id": part.column(0).cast(pa.int64()),
            "digest": pa.array(
                [hashlib.sha256(t.translate(None, WHITE)).digest() for t in texts], pa.binary()
            ),
            "length": pc.fill_null(pc.utf8_length(part.column(1)).cast(pa.int64()), 0),
        }

    return map_arrow(docs, [id_col, text_col], body, "id bigint, digest binary, length bigint")


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: the longest original text, then the smallest id; and the row count."""
    # Null ids come last. Lengths are far from the ends of their type, ids need not be.
    best = F.min(F.struct((-F.col("length")).alias("less"), F.col("id").isNull().alias("none"), "id"))
    return rows.groupBy("digest").agg(best.alias("b"), F.count("*").alias("n")).select(
        "digest", "b.id", (-F.col("b.less")).alias("length"), "n"
    )


def _halves(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(packed, dtype="<u8").reshape(-1, 4)
    return words[:, 1], words[:, 2]


def _bit(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a + b * np.uint64(2 * level + 1)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * level)
        return ((x >> np.uint64(17)) % np.uint64(size)).astype(np.int64)


def perfect_hash(packed: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, the bits of all levels, and the slot of each digest of ``packed``.

    A digest takes the first level at which no other digest wants its bit. What is
    left after the last level (two digests alike in 128 bits) gets no bit; such
    digests take the slots at the end, where a lookup compares them in turn.
    """
    a, b = _halves(packed)
    left, slots = np.arange(len(a)), np.full(len(a), -1, dtype=np.int64)
    sizes, bits, before = [], [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, int(GAMMA * len(left)))
        at = _bit(a[left], b[left], level, size)
        taken = np.bincount(at, minlength=size) == 1
        alone = taken[at]
        slots[left[alone]] = before + (np.cumsum(taken) - 1)[at[alone]]
        before += int(alone.sum())
        left = left[~alone]
        sizes.append(size)
        bits.append(taken)
    slots[left] = before + np.arange(len(left))
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slots


def find_slots(queries: bytes, sizes: list[int], bits: np.ndarray, digests_: bytes) -> np.ndarray:
    """The slot of each query digest, or -1; every hit is compared byte by byte."""
    a, b = _halves(queries)
    full = np.frombuffer(queries, np.uint8).reshape(-1, 32)
    held = np.frombuffer(digests_, np.uint8).reshape(-1, 32)
    rank = np.cumsum(bits) - 1
    found, open_ = np.full(len(a), -1, dtype=np.int64), np.arange(len(a))
    start = 0
    for level, size in enumerate(sizes):
        at = start + _bit(a[open_], b[open_], level, size)
        hit = bits[at]
        slot = rank[at[hit]]
        equal = (held[slot] == full[open_[hit]]).all(axis=1)
        found[open_[hit][equal]] = slot[equal]
        open_ = open_[~hit]
        start += size
    extra = range(int(bits.sum()), len(held))
    for q in open_ if len(extra) else []:
        for slot in extra:
            if (held[slot] == full[q]).all():
                found[q] = slot
    return found


def _packed(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def _shard(shards: int):
    head = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(shards)).cast("int")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The index over ``history`` (distinct digests, ``WINNERS``): one row per shard."""

    def build(table: pa.Table) -> pa.Table:
        packed = _packed(table["digest"])
        sizes, bits, slots = perfect_hash(packed)
        order = np.argsort(slots)
        held = np.frombuffer(packed, np.uint8).reshape(-1, 32)[order].tobytes()
        place = pa.array(order)
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
                "sizes": pa.array([sizes], pa.list_(pa.int32())),
                "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
                "digests": pa.array([held], pa.binary()),
                **{
                    new: pa.array([table[old].take(place).to_pylist()], pa.list_(pa.int64()))
                    for new, old in (("ids", "id"), ("lengths", "length"), ("counts", "n"))
                },
            }
        )

    return history.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(build, INDEX)


def look_up(index: DataFrame, delivery: DataFrame, shards: int) -> DataFrame:
    """``WINNERS`` of index and delivery (``WINNERS`` too) together, and ``known``: in the index before.

    Members of the index compete with its winner; nonmembers stay groups of their own.
    """

    def meet(new: pa.Table, held: pa.Table) -> pa.Table:
        ids, lengths, counts, keys = [], [], [], []
        if held.num_rows:
            row = held.to_pylist()[0]
            total = sum(row["sizes"])
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=total).astype(bool)
            keys = [row["digests"][i : i + 32] for i in range(0, len(row["digests"]), 32)]
            ids, lengths, counts = row["ids"], row["lengths"], row["counts"]
        known = [True] * len(keys)
        if new.num_rows:
            packed = _packed(new["digest"])
            slots = (
                find_slots(packed, row["sizes"], bits, row["digests"])
                if keys
                else np.full(new.num_rows, -1)
            )
            rows = zip(
                slots.tolist(), *(new[c].to_pylist() for c in ("digest", "id", "length", "n")),
                strict=True,
            )
            for slot, digest, id_, length, n in rows:
                if slot < 0:
                    keys.append(digest)
                    ids.append(id_)
                    lengths.append(length)
                    counts.append(n)
                    known.append(False)
                    continue
                counts[slot] += n
                better = length > lengths[slot] or (
                    length == lengths[slot]
                    and id_ is not None
                    and (ids[slot] is None or id_ < ids[slot])
                )
                if better:
                    ids[slot], lengths[slot] = id_, length
        return pa.table(
            {
                "digest": pa.array(keys, pa.binary()),
                "id": pa.array(ids, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "n": pa.array(counts, pa.int64()),
                "known": pa.array(known, pa.bool_()),
            }
        )

    grouped = delivery.withColumn("shard", _shard(shards)).groupBy("shard")
    return grouped.cogroup(index.groupBy("shard")).applyInArrow(meet, WINNERS + ", known boolean")


def exact_dedup(
    docs: DataFrame, deliveries: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with the row that stays for its text.

    Returns (id, keep_id, group_size, kept, text_sha256). Rows are dealt to
    ``deliveries`` by the hash of their id; each delivery meets the index of all
    before it. Null texts count as empty; texts are equal if they are so without white
    space. The longest original stays, then the smallest id (a null id loses to
    any other). Rows that share an id and a text are one document and kept alike;
    a group whose rows all have null ids keeps them (keep_id null). Empty tables
    give no rows; other columns are not read.
    """
    rows = stage(digests(docs, id_col, text_col), "digests")
    turn = F.pmod(F.xxhash64("id"), F.lit(deliveries))
    history = stage(winners(rows.where(turn == 0)), "winners")
    for number in range(1, deliveries):
        delivery = winners(rows.where(turn == number))
        shards = history.count() // KEYS_PER_SHARD + 1
        index = stage(build_index(history, shards), "index")
        history = stage(look_up(index, delivery, shards).drop("known"), "winners")
    return rows.join(history.withColumnRenamed("id", "keep_id").drop("length"), "digest").select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
