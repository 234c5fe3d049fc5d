"""The datasets by layer, and where a deployment keeps them.

The session catalog takes names of two parts, ``layer.table``. A lake is a root folder shared by all
executors; each layer is a database below it and each stream keeps its progress below ``_checkpoints``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .sources import NO_AGE_LIMIT


@dataclass(frozen=True)
class BatchLimit:
    """What bounds a micro-batch: a number of files, or a size such as ``500g``; Spark takes either, not both."""

    files: int | None = None
    bytes: str | None = None

    @property
    def options(self) -> dict[str, str]:
        if self.files is not None:
            return {"maxFilesPerTrigger": str(self.files)}
        return {"maxBytesPerTrigger": self.bytes} if self.bytes is not None else {}


NO_LIMIT = BatchLimit()


@dataclass(frozen=True)
class Dataset:
    layer: str
    name: str
    comment: str
    partitioned_by: tuple[str, ...] = ()

    @property
    def properties(self) -> dict[str, str]:
        return {"quality": self.layer, "layer": self.layer}


# The names by which the tables are known.
_ALL = (
    Dataset("bronze", "product_bronze", "Product feed as delivered"),
    Dataset("bronze", "customer_bronze", "Customer feed as delivered"),
    Dataset("bronze", "payment_bronze", "Payment feed as delivered"),
    Dataset("silver", "product_enriched", "Products that passed the quality rules"),
    Dataset("silver", "product_rejected", "Products that failed a quality rule, with the reason"),
    Dataset("silver", "customer_enriched", "Customers, cleaned"),
    Dataset("silver", "payment_enriched", "Payments, cleaned and typed, that passed the quality rules"),
    Dataset("silver", "payment_rejected", "Payments that failed a quality rule, with the reason"),
    Dataset("silver", "payment_streaming", "Payments, the current version of each transaction"),
    Dataset("gold", "vehicle_owner", "Customers with the product of the same VIN"),
    # A file for each dealer and day; see the README for what that costs where they hold few rows.
    Dataset("gold", "curated_360_gold", "Payments with product and customer", ("dealer_id", "payment_date")),
)
DATASETS = {dataset.name: dataset for dataset in _ALL}
LAYERS = ("bronze", "silver", "gold")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _property_list(dataset: Dataset) -> str:
    pairs = dataset.properties.items()
    return ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in pairs)


@dataclass(frozen=True)
class Lake:
    """Tables of one deployment. ``prefix`` keeps several deployments apart within one catalog."""

    spark: SparkSession
    root: str
    prefix: str = ""
    table_format: str = "parquet"

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table(self, name: str) -> str:
        return f"{self.database(DATASETS[name].layer)}.{name}"

    def folder(self, name: str) -> str:
        return f"{self.root}/{DATASETS[name].layer}/{name}"

    def checkpoint(self, flow: str) -> str:
        return f"{self.root}/_checkpoints/{flow}"

    def create_databases(self) -> Lake:
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                f"LOCATION {_quoted(f'{self.root}/{layer}')}"
            )
        return self

    def declare(
        self,
        name: str,
        schema: T.StructType,
        partitioned_by: tuple[str, ...] | None = None,
    ) -> str:
        """An empty table with its comment and properties, unless it exists."""
        dataset = DATASETS[name]
        columns = ", ".join(
            f"`{column.name}` {column.dataType.simpleString()}" for column in schema.fields
        )
        partitions = dataset.partitioned_by if partitioned_by is None else partitioned_by
        partition_clause = f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table(name)} ({columns}) "
            f"USING {self.table_format} {partition_clause}"
            f"LOCATION {_quoted(self.folder(name))} "
            f"COMMENT {_quoted(dataset.comment)} TBLPROPERTIES ({_property_list(dataset)})"
        )
        return self.table(name)

    def partition_columns(self, name: str) -> tuple[str, ...]:
        """The columns by which the table is partitioned, as the catalog has them."""
        columns = self.spark.catalog.listColumns(self.table(name))
        return tuple(column.name for column in columns if column.isPartition)

    def show(self, name: str, query: str) -> None:
        """A view in place of a table; an existing view gets the new query in one catalog operation."""
        dataset = DATASETS[name]
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.table(name)} COMMENT {_quoted(dataset.comment)} "
            f"TBLPROPERTIES ({_property_list(dataset)}) AS {query}"
        )

    def save(self, name: str, rows: DataFrame, keep: int = 2) -> None:
        """Replaces the snapshot shown under ``name`` by one of ``rows``.

        A snapshot is a folder of its own. Only when it is complete does the view under ``name`` go over to it, in
        one catalog operation, so a failed rebuild leaves the old rows and readers see either. The newest ``keep``
        complete snapshots stay, for readers who are still on one; older and unfinished ones are deleted.
        """
        dataset = DATASETS[name]
        version = time.time_ns()
        folder = f"{self.folder(name)}/version={version}"
        writer = rows.write.format(self.table_format)
        if dataset.partitioned_by:
            writer = writer.partitionBy(*dataset.partitioned_by)
        writer.save(folder)
        self.show(name, f"SELECT * FROM {self.table_format}.`{folder}`")
        complete = sorted(self._versions(name, "/_SUCCESS"))[-keep:]
        for old in self._versions(name):
            if old < version and old not in complete:
                path = self._path(f"{self.folder(name)}/version={old}")
                self._file_system(path).delete(path, True)

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _file_system(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self, name: str, mark: str = "") -> list[int]:
        pattern = self._path(f"{self.folder(name)}/version=*{mark}")
        found = [status.getPath() for status in self._file_system(pattern).globStatus(pattern) or []]
        folders = [path.getParent() if mark else path for path in found]
        return [int(folder.getName().split("=")[1]) for folder in folders]

    def read(self, name: str) -> DataFrame:
        """The table as it is now; files found by an earlier read are listed anew."""
        self.spark.catalog.refreshTable(self.table(name))
        return self.spark.read.table(self.table(name))

    def stream(self, name: str, limit: BatchLimit = NO_LIMIT) -> DataFrame:
        """New rows of a table, each file once whatever its time stamp."""
        return self.spark.readStream.options(**limit.options, **NO_AGE_LIMIT).table(self.table(name))
