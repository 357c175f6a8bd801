"""Compare queries with their SQL: python tests/check_oracle.py [sf dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from pedalflow.session import get_spark  # noqa: E402

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        source = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source + '/*.parquet' if os.path.isdir(source) else source}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark, con, folder: str, name: str) -> str:
    """Empty when rows, column names, types and values agree, else what differs."""
    df = queries()[name](spark, folder)
    ours = rows_of(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return "" if ours else "no rows"
    relation = con.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {df.columns} / {relation.columns}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    off = {c: (t, types[c]) for c, t in df.dtypes if _TYPES.get(t, t) != types[c]}
    if off:
        return f"types {off}"
    if len(ours) != len(theirs):
        return f"{len(ours)} / {len(theirs)} rows"
    wrong = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    return f"{len(wrong)} of {len(ours)} rows differ: {wrong[0]}" if wrong else ""


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = get_spark(master="local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), []
    for name in names:
        begun = time.perf_counter()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.perf_counter() - begun:6.2f}s  {problem or 'ok'}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
