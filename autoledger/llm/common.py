"""What the operators share: the two columns they read, and working tables in the shared folder."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import working_folder


# What a file of a working table holds where Spark does not merge small partitions.
ROWS_A_FILE = 8_192
CHARS_A_FILE = 32_000_000
# The driver's own; executors fetch the archive from the driver. Removed when the driver ends.
PACKAGE_FOLDER = tempfile.TemporaryDirectory(prefix="autoledger-package-")


def column(name: str) -> Column:
    """A column by its literal name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts_of(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text reads as empty, other columns are not read at all."""
    return docs.select(
        column(id).alias("doc_id"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
    )


def schema_of(docs: DataFrame, fields: str) -> T.StructType:
    """``doc_id`` with the type it has in ``docs``, followed by the fields of a DDL text."""
    id_type = docs.schema["doc_id"].dataType
    return T.StructType([T.StructField("doc_id", id_type), *T.StructType.fromDDL(fields).fields])


def files_for(docs: DataFrame, text: str = "text") -> int | None:
    """Into how many files a working table of these documents goes, in a session that does not merge small partitions
    and has far more of them than the documents need: one for ``ROWS_A_FILE`` rows or ``CHARS_A_FILE`` characters of
    text, whichever are more, and no fewer than the cores can write at once. Else none: a file per partition will do."""
    conf = docs.sparkSession.conf
    if all(conf.get(f"spark.sql.adaptive.{name}") == "true" for name in ("enabled", "coalescePartitions.enabled")):
        return None
    chars = F.sum(F.char_length(column(text).cast("string")))
    facts = docs.agg(F.count("*").alias("rows"), F.coalesce(chars, F.lit(0)).alias("chars")).first()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    files = max(cores, math.ceil(facts.rows / ROWS_A_FILE), math.ceil(facts.chars / CHARS_A_FILE))
    return files if 2 * files < int(conf.get("spark.sql.shuffle.partitions")) else None


def in_files(rows: DataFrame, files: int | None) -> DataFrame:
    """``rows`` dealt to as many tasks as there are to be files, if that is given.

    They are dealt by a shuffle: a task that took over whole partitions would hold the memory of all their sorts.
    """
    return rows if files is None else rows.repartition(files)


def stored(rows: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``rows`` written to the shared folder and read back: done once, and safe from lost executors.

    The files are removed when the driver's JVM ends; until then results may depend on them. ``files`` is for tables
    of few rows in many partitions: a file costs its executor more than its rows, as the local file
    system starts a process for every permission it sets, unless Hadoop's native library is there.
    """
    spark = rows.sparkSession
    rows = in_files(rows, files)
    folder = f"{working_folder(spark)}/{name}"
    rows.write.option("compression", "zstd").parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(rows.schema).parquet(folder)


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package, as ``--py-files`` would; once per application."""
    archive = "autoledger_package.zip"
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if root.suffix == ".zip" or any(file.endswith(archive) for file in context.listFiles):
        return
    path = Path(PACKAGE_FOLDER.name) / archive
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted((root / "autoledger").rglob("*.py")):
            packed.write(file, file.relative_to(root))
    context.addPyFile(str(path))


def spelled(kind: T.DataType) -> T.DataType:
    """The type in which ids go through Python. A column of whole numbers with a null in it becomes one of floats there,
    which are exact up to 2^53 only, so whole numbers go as text, and so do lists of them."""
    if isinstance(kind, T.IntegralType):
        return T.StringType()
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.IntegralType):
        return T.ArrayType(T.StringType())
    return kind


ID_COLUMNS = ("doc_id", "doc_ids")


def spelled_ids(rows: DataFrame) -> DataFrame:
    """``rows`` with their ids in the form in which Python may see them."""
    return rows.select(
        *[
            column(field.name).cast(spelled(field.dataType)).alias(field.name)
            if field.name in ID_COLUMNS
            else column(field.name)
            for field in rows.schema.fields
        ]
    )


def spelled_schema(schema: T.StructType) -> T.StructType:
    """What Python returns where ``schema`` is wanted in the end."""
    return T.StructType(
        [
            T.StructField(field.name, spelled(field.dataType)) if field.name in ID_COLUMNS else field
            for field in schema.fields
        ]
    )


def as_wanted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Ids back in the types of ``schema``."""
    return rows.select(
        *[
            column(field.name).cast(field.dataType).alias(field.name)
            if field.name in ID_COLUMNS
            else column(field.name)
            for field in schema.fields
        ]
    )


def mapped(
    rows: DataFrame, transform: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: T.StructType
) -> DataFrame:
    """``mapInPandas`` that keeps ids exact: whole numbers in ``doc_id`` and ``doc_ids`` are text for ``transform``."""
    ship(rows.sparkSession)
    return as_wanted(spelled_ids(rows).mapInPandas(transform, spelled_schema(schema)), schema)


def slices(frames: Iterator[pd.DataFrame], text: str, most_chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """The rows of ``frames`` in their order, in slices of about ``most_chars`` characters of text.

    A single longer text is a slice of its own, so memory follows the longest text and not the batch.
    """
    for frame in frames:
        if frame.empty:
            continue
        ends = frame[text].str.len().cumsum()
        for _, part in frame.groupby((ends - 1) // most_chars, sort=False):
            yield part


def by_slice(
    transform: Callable[[pd.DataFrame], pd.DataFrame], text: str = "text", most_chars: int = 4_000_000
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``transform`` applied to slices of bounded size, for ``mapInPandas``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(frames, text, most_chars):
            yield transform(part)

    return run
