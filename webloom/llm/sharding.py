"""Shards by a Feistel permutation of global row numbers; native functions only.

A row's number among all rows (ordered by id, checksum and size) goes through a
keyed permutation of 0..n-1. Position ``p`` lies in shard ``p mod shards`` at slot
``p div shards``, so shard sizes differ by one row at most, slots have no gaps, and
both can be computed from the row number alone, in either direction.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.llm.common import stage

ROUNDS = 6
PRIME = 2**31 - 1
CHUNK = 10_000  # equal rows that travel as one
WALK = 2  # cycle-walking steps between counts


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three numbers below ``PRIME`` for each round, from a linear congruence."""
    state, keys = seed % 2**64, []
    for _ in range(ROUNDS):
        numbers = []
        for _ in range(3):
            state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
            numbers.append(1 + (state >> 32) % (PRIME - 1))
        keys.append(tuple(numbers))
    return keys


def sides(n: int) -> tuple[int, int]:
    """The radices (a, b) of the two halves: a * b >= n, and exceeds it by less than a."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def feistel(df: DataFrame, column: str, n: int, seed: int, inverse: bool = False) -> DataFrame:
    """``column`` moved once within 0..a*b-1 (``sides``), if it lies outside 0..n-1 or is ``_new``.

    Each round is one
    projection, so every number is computed once and stays in generated code.
    """
    a, b = (F.lit(side).cast("bigint") for side in sides(n))
    moving = (F.col(column) >= n) | F.col("_new")
    out = df.withColumns({"_r": F.col(column) % b, "_moves": moving})
    out = out.withColumn("_l", F.expr(f"({column} - _r) div {sides(n)[1]}L"))
    numbered = list(enumerate(round_keys(seed)))
    for number, key in reversed(numbered) if inverse else numbered:
        times, plus, last = (F.lit(k).cast("bigint") for k in key)
        target, other, radix = ("_r", "_l", b) if number % 2 else ("_l", "_r", a)
        # Both products stay below 2**62.
        out = out.withColumn("_t", (F.col(other) % PRIME * times + plus) % PRIME)
        change = (F.col("_t") * F.col("_t") + last) % PRIME
        out = out.withColumn(
            target, F.pmod(F.col(target) + (-change if inverse else change), radix)
        )
    moved = F.when(F.col("_moves"), F.col("_l") * b + F.col("_r")).otherwise(F.col(column))
    return out.withColumn(column, moved).drop("_l", "_r", "_t", "_moves").withColumn(
        "_new", F.lit(False)
    )


def permute(df: DataFrame, number: str, position: str, n: int, seed: int, inverse=False) -> DataFrame:
    """``df`` with ``position``: where the permutation of 0..n-1 sends ``number``.

    Values outside 0..n-1 walk on along their cycle. All but the tiniest tables
    need one or two steps; the loop goes on until a count finds none outside.
    """
    out = df.withColumns({position: F.col(number).cast("bigint"), "_new": F.lit(True)})
    for _ in range(1 + WALK):
        out = feistel(out, position, n, seed, inverse)
    out = stage(out, "permuted")
    while out.where(F.col(position) >= n).limit(1).count():
        for _ in range(WALK):
            out = feistel(out, position, n, seed, inverse)
        out = stage(out, "permuted")
    return out.drop("_new")


def number_rows(keys: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``keys`` (narrow rows) numbered from 0 in ``order``, without gaps, and their count.

    Equal rows travel as counted chunks, so one frequent row fills no task; a
    range sort orders the chunks, and offsets per partition make numbers global.
    """
    columns = keys.columns
    grouped = keys.groupBy(*columns).agg(F.count("*").alias("_n"))
    chunks = grouped.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / CHUNK)))
    ).withColumn("_n", F.least(F.lit(CHUNK).cast("bigint"), F.col("_n") - F.col("_chunk") * CHUNK))
    by = [*order, "_chunk"]
    ordered = chunks.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = ordered.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    placed = stage(
        rows.drop("_copy").withColumn("_at", F.monotonically_increasing_id()), "ordered"
    ).withColumn("_part", F.shiftright("_at", 33))
    # One row per partition of the sort: small however many rows there are.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    n = placed.count()
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn(
        "row_number", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    )
    return numbered.select(*columns, "row_number"), n


def assign_shards(
    docs: DataFrame, shards: int = 8, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows of ``docs`` as (id, size, text_crc32, law, shard, slot, grown_shard, row_number).

    ``size`` is the text's UTF-8 bytes plus 1; a null text has size 1 and a null
    checksum. Rows are numbered by id (null first), checksum, size; rows equal in
    all three are interchangeable and each gets a place of its own. An empty table
    gives no rows. Other columns of ``docs`` are not read. ``law`` is ``rows``: shard
    sizes differ by one at most; ``grown_shard`` is therefore null.
    """
    text = F.col(text_col)
    keys = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    numbered, n = number_rows(keys, ["doc_id", "text_crc32", "size"])
    placed = permute(numbered, "row_number", "_position", max(n, 1), seed)
    return placed.select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_position") % shards).cast("int").alias("shard"),
        F.floor(F.col("_position") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def rows_at(places: DataFrame, n: int, shards: int = 8, seed: int = 2024) -> DataFrame:
    """``places`` (shard, slot) with the ``row_number`` of the row that lies there."""
    positions = places.withColumn("_position", F.col("slot") * shards + F.col("shard"))
    return permute(positions, "_position", "row_number", n, seed, inverse=True).drop("_position")
