"""Tab-separated files as a batch or as an incremental stream, malformed lines kept beside the parsed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import Feed


def _options(feed: Feed) -> dict[str, str]:
    return {
        "sep": "\t",
        "header": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": feed.capture,
    }


# The file source forgets files older than the newest by more than this, read or not. A file may be as old as
# its owner's clock says, so age must not decide; ``archive`` keeps the list of files that are read short.
NO_AGE_LIMIT = {"maxFileAge": "36500d"}


def read_feed(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """All files under ``path``, once."""
    rows = spark.read.format("csv").schema(feed.schema).options(**_options(feed)).load(path)
    return rows.withColumns(feed.lineage_columns()) if feed.lineage else rows


def stream_feed(
    spark: SparkSession,
    feed: Feed,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Files under ``path`` as they arrive, each read once for a given checkpoint, whatever their time stamps.

    One of the two limits bounds a micro-batch; Spark's file source takes either, not both. With ``archive``, a
    folder outside ``path``, files move there after the micro-batch that follows theirs, so that the landing
    folder holds only what is new. Do not use it where two flows read one folder.
    """
    reader = spark.readStream.format("csv").schema(feed.schema).options(**_options(feed), **NO_AGE_LIMIT)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    rows = reader.load(path)
    return rows.withColumns(feed.lineage_columns()) if feed.lineage else rows


def malformed(ingested: DataFrame, feed: Feed) -> DataFrame:
    """Rows whose line had too few or too many fields.

    Ask this of the ingested table, not of the text files: the CSV reader fills the capture column only
    when it has to parse every field, and a pruned read leaves it null.
    """
    return ingested.filter(F.col(feed.capture).isNotNull())


def well_formed(ingested: DataFrame, feed: Feed) -> DataFrame:
    return ingested.filter(F.col(feed.capture).isNull())
