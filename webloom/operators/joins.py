"""Joins and numbering that hold up when one key owns a large share of the rows."""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_TASK = 1_000_000
MAX_HOT = 10_000
ID_BUCKETS = 65_536


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Hashes of the keys with most rows, and over how many tasks to spread each.

    Keys of more than ``rows_per_task`` rows, the ``MAX_HOT`` largest of them: any other
    key has less than one row in ``MAX_HOT`` of all. So the result may be broadcast,
    whatever the data: it has at most ``MAX_HOT`` rows of two numbers. Counts are
    combined before the shuffle. Keys that share a hash are spread alike.
    """
    largest = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > rows_per_task)
        .orderBy(F.desc("_n"))
        .limit(MAX_HOT)
    )
    return largest.groupBy(F.xxhash64(key).alias("_hot")).agg(
        F.max(F.ceil(F.col("_n") / rows_per_task)).cast("int").alias("_salts")
    )


def at_most(df: DataFrame, rows: int | None) -> DataFrame:
    """``df``, known to have at most so many rows (None: not known)."""
    df._at_most = rows
    return df


def row_bound(df: DataFrame) -> int | None:
    return getattr(df, "_at_most", None)


def slot_of(key: str | Column, slots: int) -> Column:
    """The folder, one of ``slots``, in which rows of a key lie."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def rows_of_keys(table: DataFrame, keys: DataFrame, key: str, slots: int) -> DataFrame:
    """The rows of ``table`` (partitioned by ``slot``) whose ``key`` is among ``keys``.

    Keys that Spark finds small enough are broadcast: then no row of the table is shuffled,
    and only folders that hold one of the keys are read (dynamic partition pruning,
    for which the keys have to be recognisable as a selection; hence the filter). More
    keys than that meet the table's rows in a shuffle of both.
    """
    slot = slot_of(key, slots)
    wanted = keys.select(key).distinct().withColumn("slot", slot).where(F.col("slot") >= 0)
    return table.join(wanted, ["slot", key], "left_semi")


def hot_key_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str,
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join on ``key`` where ``left`` may hold very many rows of one key.

    The left rows of a hot key go to several tasks, by the hash of ``spread``;
    the matching right rows, and only those, are copied to each of them. All
    other keys join as usual. ``left`` is read twice, so hand in something that
    is cheap to read again. A left side known to be no larger than one task's share
    (``at_most``) has no hot key and joins as usual.
    """
    bound = row_bound(left)
    if bound is not None and bound <= rows_per_task:
        return left.join(right, key, how)
    hot = F.broadcast(hot_keys(left.select(key), key, rows_per_task))
    salted_left = left.join(hot, F.xxhash64(left[key]) == hot["_hot"], "left").withColumn(
        "_salt",
        F.when(
            F.col("_salts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_salts")).cast("int")
        ).otherwise(0),
    ).drop("_hot", "_salts")
    salted_right = right.join(hot, F.xxhash64(right[key]) == hot["_hot"], "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    ).drop("_hot", "_salts")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: the position of each row in the order ``by``, from 0 over all rows.

    A range sort and one offset per partition: no task sees all rows.
    """
    placed = cut_lineage(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    # One row per partition of the sort, however many rows there are.
    sizes = sorted(tuple(r) for r in placed.groupBy("_part").agg(F.count("*")).collect())
    before = [0, *accumulate(size for _, size in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(part, rows) for (part, _), rows in zip(sizes, before, strict=False)], "_part bigint, _before bigint"
    )
    out = (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_at", "_before")
    )
    return at_most(out, before[-1])


def with_ids(df: DataFrame, key: str, after: int = 0) -> DataFrame:
    """``df`` with an ``id`` of its own for every (distinct) ``key``, above ``after``.

    Numbers within hash buckets instead of over the whole table: ids are unique,
    the same in every run, nearly dense, and no task sees more than its buckets.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(ID_BUCKETS))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        df.withColumn("_bucket", bucket)
        .withColumn(
            "id", F.lit(after) + (rank.cast("bigint") - 1) * ID_BUCKETS + F.col("_bucket") + 1
        )
        .drop("_bucket")
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back.

    Computed once, safe if executors go, and its size is known to the optimizer.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` where it is set.

    Else one in the warehouse, which all executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stage"
