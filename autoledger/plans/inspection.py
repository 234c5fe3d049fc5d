"""Looking at a table, and dropping it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def preview(table: DataFrame, rows: int = 10) -> DataFrame:
    """Any ``rows`` rows; no order is promised."""
    return table.limit(rows)


def total_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("total_rows"))


def drop_table(spark: SparkSession, name: str) -> None:
    """Drops a table, or the view that shows a snapshot or a change target, with the tables of its snapshots; nothing, if
    there is none. Files stay where they are."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW":
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        database, _, table = name.rpartition(".")
        for part in spark.catalog.listTables(database or None, f"{table}_upto_*"):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{part.name}" if database else f"DROP TABLE IF EXISTS {part.name}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
