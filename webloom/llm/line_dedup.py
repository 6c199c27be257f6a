"""Lines that several documents share, through levelled sorted runs of line hashes.

Documents arrive in batches of rising id. The hashes seen so far lie in runs: tables
bucketed by hash, one file a bucket, sorted by hash, each hash with the smallest document id.
A new batch becomes such a table as well and meets the runs one by one in merge joins,
bucket by bucket: neither a run nor the batch is shuffled or sorted for them. It loses the lines
that the runs know, and the hashes that they don't become a run of level 0, written as the merge
anti join yields them. Before a batch, two runs of one level are merged into one of the next, by
bucket again, so it meets few runs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import WHITE, fresh, in_pieces, map_arrow, stage, staged_path, utf8

MIN_CHARS = 10
FANOUT = 2
BATCHES = 4


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 128-bit hash of a line's key, or None if the key has too few code points."""
    key = line.strip(WHITE).lower()  # bytes.lower() changes A-Z only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def row_key(id_col: str, text_col: str) -> Column:
    """What rows that lose the same lines have in common: the id or, without one, the text.

    All rows without an id are one document, but no row of theirs has to carry the lines of all.
    """
    text = F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.coalesce(F.col(id_col).cast("string"), text)


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, h): the hashes of each row's long enough line keys; ``key`` as ``row_key``."""

    def body(part: pa.RecordBatch) -> dict:
        keys, ids, hashes = [], [], []
        for id_, text in zip(part.column(0).to_pylist(), utf8(part.column(1)), strict=True):
            found = {line_key(line) for line in text.split(b"\n")} - {None}
            key = str(id_) if id_ is not None else f"text {hashlib.md5(text).hexdigest()}"
            keys += [key] * len(found)
            ids += [id_] * len(found)
            hashes += found
        return {
            "key": pa.array(keys, pa.string()),
            "id": pa.array(ids, pa.int64()),
            "h": pa.array(hashes, pa.binary()),
        }

    return map_arrow(docs, [id_col, text_col], body, "key string, id bigint, h binary")


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Lets plans rely on the order within the files of bucketed tables: ours have one a bucket."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class LineRuns:
    """The runs of all batches so far: table names by level."""

    spark: SparkSession
    buckets: int
    levels: dict[int, list[str]] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [name for level in self.levels.values() for name in level]

    def write(self, hashes: DataFrame) -> str:
        """``hashes``, which lie in the buckets already, as a bucketed and sorted table; its name."""
        name = f"line_run_{uuid.uuid4().hex}"
        (
            hashes.write.bucketBy(self.buckets, "h")
            .sortBy("h")
            .option("path", staged_path(self.spark, name))
            .saveAsTable(name)
        )
        return name

    def dealt(self, hashes: DataFrame) -> DataFrame:
        """``hashes`` in the buckets of the runs: the one shuffle of a batch."""
        return hashes.repartition(self.buckets, "h")

    def meet(self, batch: DataFrame, how: str = "left") -> DataFrame:
        """``batch`` (a table of ``write``) joined to every run in turn; ``first`` of the run that knows h.

        A hash lies in one run only. A left anti join leaves the hashes that no run knows.
        """
        firsts = []
        for number, name in enumerate(self.names()):
            run = self.spark.table(name)
            if how == "left":
                firsts.append(f"_first{number}")
                run = run.withColumnRenamed("first", firsts[-1])
            batch = batch.join(run.hint("merge"), "h", how)
        if how != "left":
            return batch
        known = F.coalesce(*firsts) if firsts else F.lit(None).cast("bigint")
        return batch.withColumn("first", known).drop(*firsts)

    def add(self, name: str) -> None:
        """A new run of level 0."""
        self.levels.setdefault(0, []).append(name)

    def compact(self) -> None:
        """Two runs of one level become one of the next, until no level has two."""
        level = 0
        while level in self.levels:
            while len(self.levels[level]) >= FANOUT:
                merged = self.write(self.merged(*self.levels[level][:FANOUT]))
                self.levels[level] = self.levels[level][FANOUT:]
                self.levels.setdefault(level + 1, []).append(merged)
            level += 1

    def merged(self, name: str, other: str) -> DataFrame:
        """The rows of two runs: a full merge join of their buckets, without a shuffle.

        Not a union: unions of bucketed scans lose their buckets when they are written.
        """
        right = self.spark.table(other).withColumnRenamed("first", "_other")
        both = self.spark.table(name).hint("merge").join(right, "h", "full")
        return both.select("h", F.coalesce("first", "_other").alias("first"))

    def forget(self, names: list[str]) -> None:
        """Take tables that nothing reads any more out of the catalog."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def absorb(runs: LineRuns, lines: DataFrame) -> DataFrame:
    """(key, h) of the lines that a batch (``line_hashes``) loses; the runs gain its new hashes.

    Every id of the batch must be above those of earlier batches. Rows without an id are
    one document, the last of all: they belong to the last batch.
    """
    once = lines.groupBy("h").agg(
        F.min("id").alias("own"), F.max("id").alias("last"), F.bool_or(F.col("id").isNull()).alias("none")
    )
    batch = runs.write(runs.dealt(once))
    with sorted_buckets(runs.spark):
        runs.compact()
        met = runs.meet(runs.spark.table(batch))
        # Hashes of one holder only lose nothing and don't meet the lines again.
        several = (F.col("own") != F.col("last")) | (F.col("none") & F.col("own").isNotNull())
        shared = stage(
            met.where(F.col("first").isNotNull() | several).select("h", F.coalesce("first", "own").alias("owner")),
            "shared",
        )
        new = runs.meet(runs.spark.table(batch), "left_anti").select("h", F.col("own").alias("first"))
        runs.add(runs.write(new))
    runs.forget([batch])
    gone = lines.join(shared, "h").where(~F.col("id").eqNullSafe(F.col("owner")))
    return stage(gone.select("key", "h"), "lost")


def bounds(docs: DataFrame, id_col: str, batches: int) -> list[int]:
    """Ids that end the batches: approximate quantiles, so batches are of like size."""
    probabilities = [i / batches for i in range(1, batches)]
    if not probabilities:
        return []
    ends = {int(b) for b in docs.approxQuantile(id_col, probabilities, 0.01)}
    return sorted(end for end in ends if end < 2**63 - 1)  # no id lies above the largest


def lost_lines(
    docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(key, lost): for each ``row_key`` that loses lines, the hashes of their keys."""
    spark = docs.sparkSession
    hashes = line_hashes(docs, id_col, text_col)
    # A repeated row holds the same lines as its twin; both count as one document.
    ends = bounds(docs, id_col, batches)
    after = [F.coalesce(F.col("id") > end, F.lit(True)).cast("int") for end in ends]
    number = sum(after) if ends else F.lit(0)
    path = staged_path(spark, "lines")
    hashes.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("key string, id bigint, h binary, batch int").parquet(path)
    runs = LineRuns(spark, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    lost = [
        absorb(runs, lines.where(F.col("batch") == b).select("key", "id", "h"))
        for b in range(len(ends) + 1)
    ]
    runs.forget(runs.names())
    return reduce(DataFrame.union, lost).groupBy("key").agg(F.collect_set("h").alias("lost"))


def drop_lines(
    docs: DataFrame, lost: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, str, str]:
    """``docs``, all columns, without the lines of ``lost`` (key, lost); the names of two counts.

    The counts are the lines before, and the lines that went. A null text stays null.
    """
    key, gone = fresh(docs, "key"), fresh(docs, "lost")
    before, went = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    named = lost.select(F.col("key").alias(key), F.col("lost").alias(gone))
    both = docs.withColumn(key, row_key(id_col, text_col)).join(named, key, "left")
    names, at = docs.columns, docs.columns.index(text_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(parts):
            n_lines, n_dropped, kept = [], [], []
            texts, away = utf8(part.column(at)), part.column(len(names)).to_pylist()
            for text, hashes in zip(texts, away, strict=True):
                lines = text.split(b"\n")
                stay = lines
                if hashes:
                    found = set(hashes)
                    stay = [line for line in lines if line_key(line) not in found]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            text = pa.array(kept, pa.binary(), mask=part.column(at).is_null().to_numpy(zero_copy_only=False))
            columns = [*part.columns[:-1], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            columns[at] = text.cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*names, before, went])

    schema = T.StructType(
        [*docs.schema, T.StructField(before, T.LongType()), T.StructField(went, T.LongType())]
    )
    return both.select(*names, gone).mapInArrow(batches, schema), before, went


def dedup_lines(
    docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_lines, n_dropped, kept): every document with the lines that stay, joined by newlines.

    A key is a line stripped of white space with A-Z lower-cased. Keys of ten code
    points or more that several documents hold stay in the one with the smallest
    id, with all their lines there, and go from the others. Null and empty texts have
    one empty line; rows without an id are one document that comes after all others; rows
    that share an id are one document too (each keeps a row). An empty table gives no rows. Other columns are
    not read.
    """
    lost = lost_lines(docs, batches, id_col, text_col)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("kept"))
    out, before, went = drop_lines(narrow, lost, "id", "kept")
    return out.select(
        F.col("id").alias(id_col),
        F.col(before).alias("n_lines"),
        F.col(went).alias("n_dropped"),
        F.coalesce("kept", F.lit("")).alias("kept"),
    )


def digest(kept: DataFrame) -> DataFrame:
    """``kept`` with the SHA-256 of the lines that stay in place of their text."""
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
