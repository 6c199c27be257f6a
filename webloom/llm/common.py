"""What the operators share: staged tables, Arrow maps over columns, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from webloom.operators.joins import ROWS_PER_TASK, hot_key_join, shared_folder

PIECE_ROWS = 500
# The bytes that count as white space in every contract: [\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"


def staged_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed once, no lineage."""
    path = staged_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``stage``, and ``measures`` (aggregates) of its rows, taken while they are written.

    A sum may count rows twice if an executor is lost on the way; a maximum stays right.
    """
    seen = Observation()
    out = stage(df.observe(seen, *(column.alias(key) for key, column in measures.items())), name)
    return out, seen.get


def join_sized(rows: DataFrame, sized: DataFrame, key: str, spread: str, most: int | None, how: str) -> DataFrame:
    """``rows`` joined with ``sized``, one row a key, where no key has over ``most`` rows.

    Keys that fit into a task join as usual; only if one may not are hot keys counted and
    their rows spread by the hash of ``spread``.
    """
    if (most or 0) <= ROWS_PER_TASK:
        return rows.join(sized, key, how)
    return hot_key_join(rows, sized, key, spread, how)


def in_pieces(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ``PIECE_ROWS`` rows at most, whatever size the session gives batches.

    What a task makes of a piece's long texts has to fit into its memory.
    """
    for part in parts:
        for start in range(0, part.num_rows, PIECE_ROWS):
            yield part.slice(start, PIECE_ROWS)


def map_arrow(
    df: DataFrame,
    columns: Iterable[str],
    body: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    schema: str,
) -> DataFrame:
    """``body`` over the Arrow batches of ``columns``; it returns the columns of ``schema``.

    Batches are worked in pieces, see ``in_pieces``.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(parts):
            yield pa.RecordBatch.from_pydict(body(piece))

    return df.select(*columns).mapInArrow(batches, schema)


def keep_numbered(rows: DataFrame, at: str, kept: DataFrame) -> DataFrame:
    """Of ``rows``, each with a number ``at`` of its own, those whose number is in ``kept`` (at).

    Numbers are long and not negative. ``kept`` becomes a bit a number, 64 neighbouring numbers a
    row: for numbers as ``monotonically_increasing_id`` deals them about two bits for each
    of ``rows``. So Spark broadcasts it up to tens of millions of rows and moves none of
    ``rows``; beyond its limit both are shuffled. Numbers far apart give a row each.
    """
    place = lambda number: number.bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place(F.col("at")))
    words = stage(
        kept.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")), "kept"
    )
    met = F.shiftright(rows[at], 6) == words["word"]
    return rows.join(words, met & (F.getbit(words["bits"], place(rows[at])) == 1), "left_semi")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """The bytes of a text column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


GROUP = ["key", "low", "high"]


def deal_buckets(keyed: DataFrame, spread: str, block: int, useful: Column | None = None) -> DataFrame:
    """Rows that share a ``key`` with others, sorted so that those of a group lie together.

    A bucket of more than ``block`` rows is dealt to blocks by the hash of ``spread``, and
    every two of its blocks form a group: all its rows meet, but no task holds a whole
    large bucket. ``useful`` is a condition on the bucket's aggregates. Groups are
    told apart by ``GROUP``.
    """
    wanted = F.count("*") > 1 if useful is None else (F.count("*") > 1) & useful
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), wanted.alias("_wanted"))
    sizes, seen = stage_counted(sizes.where("_wanted").select("key", "n"), "buckets", most=F.max("n"))
    many = F.ceil(F.col("n") / block).cast("int")
    dealt = (
        join_sized(keyed, sizes, "key", spread, seen["most"], "inner")
        .withColumn("_own", F.pmod(F.xxhash64(spread), many).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), many - 1)))
        .withColumns({"low": F.least("_own", "_other"), "high": F.greatest("_own", "_other")})
        .drop("n", "_own", "_other")
    )
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)


def deal_hot_buckets(keyed: DataFrame, spread: str, block: int) -> DataFrame:
    """As ``deal_buckets``, rows whose key no other has included: all are shuffled once.

    Only the keys of more than ``block`` rows are looked up.
    """
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    sizes, seen = stage_counted(sizes, "buckets", most=F.max("n"))
    many = F.ceil(F.coalesce("n", F.lit(1)) / block).cast("int")
    dealt = (
        join_sized(keyed, sizes, "key", spread, seen["most"], "left")
        .withColumn("_own", F.pmod(F.xxhash64(spread), many).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), many - 1)))
        .withColumns({"low": F.least("_own", "_other"), "high": F.greatest("_own", "_other")})
        .drop("n", "_own", "_other")
    )
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)


def whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of ``deal_buckets`` as tables of whole groups, and where the groups begin and end."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        bounds = _bounds(table)
        last = int(bounds[-2])
        if last:
            yield table.slice(0, last).combine_chunks(), bounds[:-1]
        held = table.slice(last).combine_chunks()
    if held is not None:
        yield held, _bounds(held)


def _bounds(table: pa.Table) -> np.ndarray:
    marks = np.stack([table[c].to_numpy() for c in GROUP], axis=1)
    edges = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
    return np.concatenate([[0], edges, [table.num_rows]])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node.

    Large-star and small-star steps in turn, until nothing changes: the number of
    rounds grows with the logarithm of a component's size, rows never exceed
    the edges, and minima are combined before each shuffle. Nodes may be of any
    type that has an order. Each round is written to the shared folder, and counted on the way.
    The edges of a hub that has more than a task should hold are spread over several.
    """

    def star(pairs: DataFrame, name: str) -> DataFrame:
        # pairs: (u, v), each v gets the smallest of u and all v of that u.
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        least, seen = stage_counted(least, name, most=F.max("n"))
        return join_sized(pairs, least, "u", "v", seen["most"], "inner").select("u", "v", "m")

    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        return star(both, "large").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        joined = star(down, "small")
        to_least = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        own = joined.select(F.col("u").alias("a"), F.col("m").alias("b"))
        return to_least.union(own)

    def kept(e: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        both = F.xxhash64("a", "b").cast("decimal(38,0)")
        distinct, seen = stage_counted(
            e.where("a <> b").distinct(), name, rows=F.count("*"), total=F.sum(both)
        )
        return distinct, (seen["rows"], seen["total"])

    current, mark = kept(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges"
    )
    while True:
        middle = stage(large(current).where("a <> b").distinct(), "middle")
        current, after = kept(small(middle), "edges")
        if after == mark:
            break
        mark = after
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
