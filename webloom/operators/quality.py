"""Checks of keys, references, missing values and lengths over the store's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.schemas import FOREIGN_KEYS, MAX_LENGTHS, PRIMARY_KEYS, TABLES


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that more than one row has."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of ``column`` without a parent row, with the number of child rows.

    Child rows are counted per value first: millions of rows that name the same
    parent reach the join as one.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return used.join(parent.select(F.col(key).alias(column)), column, "left_anti")


def _report(rows: DataFrame, rule: str, table: str, violations) -> DataFrame:
    return rows.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table"), "violations"
    )


def column_checks(df: DataFrame, table: str) -> DataFrame | None:
    """Missing values and lengths of one table, all counted in one scan."""
    columns = {f.name: f for f in TABLES[table].fields}
    required = sorted({*PRIMARY_KEYS[table], *(n for n, f in columns.items() if not f.nullable)})
    checks = [(f"not_null:{c}", F.col(c).isNull()) for c in required]
    checks += [
        (f"length:{c}", F.length(c) > limit) for c, limit in MAX_LENGTHS.get(table, {}).items()
    ]
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, bad) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(table).alias("table"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, (rule, _) in enumerate(checks)
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per rule: ``rule, table, violations``."""
    parts = []
    for name, key in PRIMARY_KEYS.items():
        parts.append(
            _report(
                repeated_keys(tables[name], key), f"primary_key:{','.join(key)}", name, F.count("*")
            )
        )
        parts.append(column_checks(tables[name], name))
    urls = repeated_keys(tables["page"].where("url is not null"), ["url"])
    parts.append(_report(urls, "unique:url", "page", F.count("*")))
    for child, column, parent, key in FOREIGN_KEYS:
        missing = orphans(tables[child], column, tables[parent], key)
        parts.append(_report(missing, f"foreign_key:{column}", child, F.sum("rows")))
    return reduce(DataFrame.unionByName, parts)
