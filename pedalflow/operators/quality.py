"""Key and reference rules, checked as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.schemas import FOREIGN_KEYS, PRIMARY_KEYS, Mobility


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(key).count().filter("count > 1")


def missing_targets(df: DataFrame, column: str, target: DataFrame, key: str) -> DataFrame:
    """The different values of a reference that are no key of ``target``; null passes."""
    used = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("k")).distinct()
    return used.join(target.select(F.col(key).alias("k")), "k", "left_anti")


def key_report(data: Mobility) -> DataFrame:
    """Per table: rows, different keys, keys held twice or more, and null keys."""
    parts = []
    for name, key in PRIMARY_KEYS.items():
        per_key = getattr(data, name).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count("k").alias("keys"),
                F.count_if((F.col("n") > 1) & F.col("k").isNotNull()).alias("duplicated_keys"),
                F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
            ).select(F.lit(name).alias("table_name"), "row_count", "keys", "duplicated_keys", "null_keys")
        )
    return reduce(DataFrame.unionByName, parts)


def orphans(data: Mobility) -> DataFrame:
    """Per reference: rows that point at nothing; nulls pass. Rows are counted per key before the join."""
    parts = []
    for (table, column), target in FOREIGN_KEYS.items():
        used = getattr(data, table).filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("k"))
        known = getattr(data, target).select(F.col(PRIMARY_KEYS[target]).alias("k"))
        dangling = used.agg(F.count("*").alias("n")).join(known, "k", "left_anti")
        parts.append(
            dangling.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
                F.lit(f"{table}.{column}").alias("reference"), "orphans"
            )
        )
    return reduce(DataFrame.unionByName, parts)
