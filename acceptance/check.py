"""Runs the acceptance queries beside their SQL: ``python -m acceptance.check [folder] [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from autoledger.session import session

from .oracles import oracle_sql
from .queries import queries


def rows_of_sql(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = connection.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda position: result.columns[position])
    rows = Counter(frozen([row[position] for position in order]) for row in result.fetchall())
    return sorted(result.columns), rows


def frozen(value):
    """A value that can be counted: lists as tuples, maps as sorted pairs, rows as tuples of frozen values."""
    if isinstance(value, (list, tuple)):
        return tuple(map(frozen, value))
    if isinstance(value, dict):
        return tuple(sorted((frozen(key), frozen(held)) for key, held in value.items()))
    return bytes(value) if isinstance(value, bytearray) else value


def rows_of_spark(result: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(result.columns)
    return names, Counter(frozen(row) for row in result.select(*names).collect())


def main(sf_dir: str = "/root/testdata/sf0.01", *only: str) -> int:
    spark = session("acceptance", "local[8]", **{"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    failures = 0
    expected = oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        columns, rows = rows_of_spark(query(spark, sf_dir))
        seconds = time.perf_counter() - start
        verdict = "rows only"
        if name in expected:
            verdict = "equal" if (columns, rows) == rows_of_sql(sf_dir, expected[name]) else "DIFFERS"
        failures += verdict == "DIFFERS"
        print(f"{name:34} {sum(rows.values()):8} rows {seconds:7.2f} s  {verdict}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
