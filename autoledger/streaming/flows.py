"""Append flows: a streaming DataFrame into a table or an external sink.

A flow processes what has arrived since its last run and ends. Started again with the same checkpoint it
goes on where it stopped, so it can run on a schedule and survives the loss of executors or the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..catalog import DATASETS, Lake


def _writer(rows: DataFrame, checkpoint: str) -> DataStreamWriter:
    return (
        rows.writeStream.outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
    )


def into_table(
    lake: Lake, name: str, rows: DataFrame, partitioned_by: tuple[str, ...] | None = None
) -> StreamingQuery:
    """Starts the flow that fills table ``name``; the table is declared first.

    A table that is there with other partition columns is refused: Spark would write folders of both kinds into it,
    and then read neither.
    """
    partitions = DATASETS[name].partitioned_by if partitioned_by is None else partitioned_by
    table = lake.declare(name, rows.schema, partitioned_by=partitions)
    stored = lake.partition_columns(name)
    if [column.lower() for column in stored] != [column.lower() for column in partitions]:
        raise ValueError(f"{table} is partitioned by {stored}, not by {tuple(partitions)}")
    writer = _writer(rows, lake.checkpoint(name)).queryName(table).format(lake.table_format)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.toTable(table)


@dataclass(frozen=True)
class Sink:
    """An external target by format and options; the path is one of the options."""

    name: str
    format: str
    options: Mapping[str, str] = field(default_factory=dict)


def into_sink(rows: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    """Starts the flow that appends a stream to an external sink.

    Feed it from append-only tables. A table that is rewritten as a snapshot would be sent again in full
    after each rewrite; for that use ``snapshot_to_sink``.
    """
    return _writer(rows, checkpoint).format(sink.format).options(**sink.options).start()


def snapshot_to_sink(rows: DataFrame, sink: Sink) -> None:
    """Replaces the sink's content by the rows of a batch."""
    rows.write.format(sink.format).mode("overwrite").options(**sink.options).save()


def finish(flows: Iterable[StreamingQuery]) -> None:
    """Waits for flows started together; the first failure is raised after all have ended."""
    failure: Exception | None = None
    for flow in flows:
        try:
            flow.awaitTermination()
        except Exception as error:  # the other flows are independent and may finish
            failure = failure or error
    if failure is not None:
        raise failure
