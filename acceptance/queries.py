"""The acceptance queries: each takes a session and a folder of test tables and returns a DataFrame.

Batch queries run the builders on the derived feeds. Stream queries write the feed as text files into a
fresh lake, run the flows to their end and read the resulting table. Ingest and rejection times differ from
run to run and are left out; days, amounts and nullable numbers are shown as text, the form that is compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoledger.catalog import DATASETS, Lake
from autoledger.operators import (
    clean_customers,
    latest_per_key,
    rejected_payments,
    rejected_products,
    valid_payments,
    valid_products,
)
from autoledger.plans import curated_360, drop_table, preview, total_rows, vehicle_owner
from autoledger.plans import refresh as flows
from autoledger.session import working_folder
from autoledger.sources import FEEDS, malformed
from autoledger.streaming import ChangeTarget, Sink, finish

from .feeds import feed_rows, source_table, write_feed_files, write_lines

Query = Callable[[SparkSession, str], DataFrame]

BATCHES = 3
LINEAGE = ("file_name", "file_modification_time")


def shown(rows: DataFrame, *left_out: str) -> DataFrame:
    """Columns in comparable form: no ingest times; days, amounts and nullable numbers as text."""
    columns = []
    for field in rows.schema.fields:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)) or field.name in left_out:
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.DecimalType, T.IntegerType)):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return rows.select(*columns)


# Batch ------------------------------------------------------------------------------------------------


def silver(builder: Callable[[DataFrame], DataFrame], feed: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(builder(feed_rows(spark, sf_dir, feed)), FEEDS[feed].capture)

    return query


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    products = valid_products(feed_rows(spark, sf_dir, "product"))
    customers = clean_customers(feed_rows(spark, sf_dir, "customer"))
    return products, customers


def vehicle_owner_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, customers = _dimensions(spark, sf_dir)
    return vehicle_owner(customers, products)


def vehicle_owner_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join as it runs when the dimension is too large to broadcast and hot keys are looked for."""
    products, customers = _dimensions(spark, sf_dir)
    return vehicle_owner(customers, products.hint("merge"), hot_in=customers)


def curated_360_query(spark: SparkSession, sf_dir: str, normalize_keys: bool = True) -> DataFrame:
    products, customers = _dimensions(spark, sf_dir)
    payments = valid_payments(feed_rows(spark, sf_dir, "payment"))
    return shown(curated_360(payments, products, customers, normalize_keys))


def curated_360_ids_as_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated_360_query(spark, sf_dir, normalize_keys=False)


def curated_360_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both joins as they run when the dimensions are too large to broadcast and hot keys are looked for."""
    products, customers = _dimensions(spark, sf_dir)
    payments = valid_payments(feed_rows(spark, sf_dir, "payment"))
    products, customers = products.hint("merge"), customers.hint("merge")
    return shown(curated_360(payments, products, customers, hot_in=payments))


EVENT_KEY = ("user_id",)
EVENT_SEQUENCE = ("ts", "event_id")


def events_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(latest_per_key(source_table(spark, sf_dir, "events"), EVENT_KEY, EVENT_SEQUENCE))


def payment_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = valid_payments(feed_rows(spark, sf_dir, "payment"))
    current = latest_per_key(payments, flows.PAYMENT_KEY, ("silver_ingest_ts",))
    return shown(current, FEEDS["payment"].capture)


# Streams ----------------------------------------------------------------------------------------------


def fresh_lake(spark: SparkSession) -> Lake:
    lake = Lake(spark, working_folder(spark), prefix=f"autoledger_{uuid.uuid4().hex[:12]}_")
    return lake.create_databases()


def landing(lake: Lake, feed: str, delivery: int | str) -> str:
    return f"{lake.root}/landing/{feed}/delivery={delivery}"


def ingested(spark: SparkSession, sf_dir: str, *feeds: str, with_malformed: bool = False) -> Lake:
    """A lake with the bronze tables of the feeds, each read from files in a few micro-batches."""
    lake = fresh_lake(spark)
    files = max(
        write_feed_files(spark, sf_dir, feed, landing(lake, feed, 1), BATCHES, with_malformed)
        for feed in feeds
    )
    paths = {feed: landing(lake, feed, "*") for feed in feeds}
    flows.ingest(lake, paths, files_per_batch=-(-files // BATCHES))
    return lake


def ingest_stream(feed: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = ingested(spark, sf_dir, feed, with_malformed=True)
        return shown(lake.read(f"{feed}_bronze"), *LINEAGE)

    return query


def malformed_lines(feed: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = ingested(spark, sf_dir, feed, with_malformed=True)
        return shown(malformed(lake.read(f"{feed}_bronze"), FEEDS[feed]), *LINEAGE)

    return query


def bronze_total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = ingested(spark, sf_dir, "product")
    return total_rows(lake.read("product_bronze"))


def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a preview shows is open; how many, and that the table has them, is not."""
    lake = ingested(spark, sf_dir, "product")
    table = lake.read("product_bronze")
    shown_rows = preview(table).select("system_id")
    held = shown_rows.join(table.select("system_id").distinct(), "system_id", "left_semi")
    counts = held.agg(F.count("*").alias("in_table"))
    return shown_rows.agg(F.count("*").alias("shown")).join(counts)


def ingest_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first delivery, then the whole feed again by files dated weeks before it: none may be lost."""
    lake = fresh_lake(spark)
    write_feed_files(spark, sf_dir, "product", landing(lake, "product", 1), BATCHES, False)
    paths = {"product": landing(lake, "product", "*")}
    flows.ingest(lake, paths)
    write_feed_files(spark, sf_dir, "product", landing(lake, "product", 2), BATCHES, False)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{landing(lake, 'product', 2)}/*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(pattern):
        files.setTimes(status.getPath(), status.getModificationTime() - 40 * 86_400_000, -1)
    flows.ingest(lake, paths)
    return shown(lake.read("product_bronze"), *LINEAGE)


def silver_stream(feed: str, table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = ingested(spark, sf_dir, feed)
        flows.clean(lake, table)
        return shown(lake.read(table), FEEDS[feed].capture, *LINEAGE)

    return query


def events_scd1_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fresh_lake(spark)
    events = source_table(spark, sf_dir, "events")
    events.repartition(BATCHES).write.parquet(landing(lake, "events", 1))
    # Any dataset name of the lake serves; only the rows come from elsewhere.
    target = ChangeTarget(lake, "payment_streaming", events.schema, EVENT_KEY, EVENT_SEQUENCE)
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(landing(lake, "events", 1))
    )
    finish([target.create().start(stream)])
    target.compact_if_due()
    return shown(lake.read("payment_streaming"))


def payment_scd1_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = ingested(spark, sf_dir, "payment")
    flows.clean(lake, "payment_enriched")
    flows.apply_payment_changes(lake)
    return shown(lake.read("payment_streaming"), FEEDS["payment"].capture, *LINEAGE)


def corrected(spark: SparkSession, sf_dir: str, *dimensions: str) -> Lake:
    """A lake after a first delivery of all payments and a second one that corrects those of open orders."""
    lake = ingested(spark, sf_dir, "payment", *dimensions)
    flows.clean(lake, "payment_enriched", *[f"{feed}_enriched" for feed in dimensions])
    flows.apply_payment_changes(lake)

    orders = feed_rows(spark, sf_dir, "payment", keep=("o_orderstatus",), deal=True).filter("o_orderstatus = 'O'")
    again = orders.withColumn("amount_paid", F.concat(F.lit("1"), "amount_paid"))
    fields = [F.coalesce(name, F.lit("")) for name in FEEDS["payment"].fields]
    line = F.concat_ws("\t", *fields).alias("value")
    write_lines(again.select(line), landing(lake, "payment", 2))

    flows.ingest(lake, {"payment": landing(lake, "payment", "*")})
    flows.clean(lake, "payment_enriched")
    flows.apply_payment_changes(lake)
    return lake


def payment_scd1_corrected_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = corrected(spark, sf_dir)
    return shown(lake.read("payment_streaming"), FEEDS["payment"].capture, *LINEAGE)


def curated_360_of_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per transaction, although corrected ones are there in two versions."""
    lake = corrected(spark, sf_dir, "product", "customer")
    return shown(flows.curated_360_of_current(lake))


def curated_360_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = ingested(spark, sf_dir, "product", "customer", "payment")
    flows.clean(lake, "product_enriched", "customer_enriched", "payment_enriched")
    flows.extend_curated_360(lake)
    return shown(lake.read("curated_360_gold"))


def vehicle_owner_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = ingested(spark, sf_dir, "product", "customer")
    flows.clean(lake, "product_enriched", "customer_enriched")
    sink = Sink("vehicle_owner_export", "parquet", {"path": f"{lake.root}/export/vehicle_owner"})
    flows.export_vehicle_owner(lake, sink)
    return spark.read.parquet(sink.options["path"])


def vehicle_owner_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = ingested(spark, sf_dir, "product", "customer")
    flows.clean(lake, "product_enriched", "customer_enriched")
    flows.build_vehicle_owner(lake)
    return lake.read("vehicle_owner")


FEED_NAMES = ("customer", "payment", "product")
# Every time stamp that a flow gives, by table; fixed values: the columns' names.
GIVEN_TIMES = {
    "product_bronze": ("bronze_ingest_timestamp",),
    "customer_bronze": ("bronze_ingest_timestamp",),
    "product_enriched": ("silver_ingest_ts",),
    "product_rejected": ("rejected_at", "silver_ingest_ts"),
    "customer_enriched": ("silver_ingest_timestamp",),
    "payment_enriched": ("silver_ingest_ts",),
    "payment_rejected": ("rejected_at", "silver_ingest_ts"),
}


def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by feed, and those whose line stands in the file they name, as often as they do, in a file of that time."""
    lake = ingested(spark, sf_dir, *FEED_NAMES)
    results = []

    def digest(line: Column) -> Column:
        """A line as its SHA-256, a tenth of its size where lines are shuffled and compared."""
        return F.unhex(F.sha2(line, 256))

    for name in FEED_NAMES:
        feed = FEEDS[name]
        landed = spark.read.text(landing(lake, name, "*")).select(
            digest(F.col("value")).alias("line"), "_metadata.file_name", "_metadata.file_modification_time"
        )
        landed = landed.groupBy("line", "file_name", "file_modification_time").agg(F.count("*").alias("in_file"))
        line = digest(F.concat_ws("\t", *[F.coalesce(field, F.lit("")) for field in feed.fields]))
        same = ["line", *feed.lineage.keys() & {"file_name", "file_modification_time"}]
        rows = lake.read(f"{name}_bronze").withColumn("line", line).groupBy(*same).agg(F.count("*").alias("in_table"))
        found = rows.join(landed, same, "left")
        results.append(
            found.select(
                F.lit(name).alias("feed"),
                "in_table",
                F.when(F.col("in_table") == F.col("in_file"), F.col("in_table")).otherwise(0).alias("in_their_file"),
            )
        )
    every = reduce(DataFrame.unionAll, results)
    return every.groupBy("feed").agg(
        F.sum("in_table").alias("total_rows"), F.sum("in_their_file").alias("in_their_file")
    )


def given_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each time stamp that a flow gives: rows, and those whose time lies within the run and is the same throughout
    their micro-batch, of which there are at most ``BATCHES`` a table."""
    started = spark.range(1).select(F.current_timestamp()).first()[0]
    lake = ingested(spark, sf_dir, *FEED_NAMES)
    flows.clean(lake)
    results = []
    for table, columns in GIVEN_TIMES.items():
        rows = lake.read(table)
        for name in columns:
            time = F.col(name)
            within = F.count(F.when((time >= F.lit(started)) & (time <= F.current_timestamp()), 1))
            moments = F.when(F.count_distinct(time) <= BATCHES, "one a batch").otherwise("more")
            counted = rows.agg(F.count("*").alias("total_rows"), within.alias("within_run"), moments.alias("moments"))
            results.append(counted.select(F.lit(f"{table}.{name}").alias("given"), "*"))
    return reduce(DataFrame.unionAll, results)


def described_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment and properties of every dataset after a run, as the catalog has them, with the rows behind them."""
    lake = ingested(spark, sf_dir, *FEED_NAMES)
    flows.clean(lake)
    flows.apply_payment_changes(lake)
    flows.build_vehicle_owner(lake)
    flows.extend_curated_360(lake)
    results = []
    for name in DATASETS:
        table = lake.table(name)
        properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        described = {
            "dataset": name,
            "comment": spark.catalog.getTable(table).description,
            "quality": properties.get("quality"),
            "layer": properties.get("layer"),
        }
        counted = lake.read(name).agg(F.count("*").alias("total_rows"))
        results.append(counted.select(*[F.lit(value).alias(key) for key, value in described.items()], "total_rows"))
    return reduce(DataFrame.unionAll, results)


def dropped_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left in the catalog, with its rows, after a table, a view on a snapshot and one on changes are dropped,
    one of them twice."""
    lake = ingested(spark, sf_dir, *FEED_NAMES)
    flows.clean(lake)
    flows.apply_payment_changes(lake)
    flows.build_vehicle_owner(lake)
    for name in ("product_rejected", "vehicle_owner", "payment_streaming", "vehicle_owner"):
        drop_table(spark, lake.table(name))
    left = [name for name in DATASETS if spark.catalog.tableExists(lake.table(name))]
    counts = [lake.read(name).agg(F.lit(name).alias("dataset"), F.count("*").alias("total_rows")) for name in left]
    return reduce(DataFrame.unionAll, counts)


def queries() -> dict[str, Query]:
    return {
        "ingest_product_stream": ingest_stream("product"),
        "ingest_customer_stream": ingest_stream("customer"),
        "ingest_payment_stream": ingest_stream("payment"),
        "malformed_product_lines": malformed_lines("product"),
        "malformed_customer_lines": malformed_lines("customer"),
        "malformed_payment_lines": malformed_lines("payment"),
        "ingest_late_files": ingest_late_files,
        "bronze_total_rows": bronze_total_rows,
        "bronze_preview": bronze_preview,
        "file_lineage": file_lineage,
        "given_times": given_times,
        "described_tables": described_tables,
        "dropped_tables": dropped_tables,
        "product_enriched": silver(valid_products, "product"),
        "product_rejected": silver(rejected_products, "product"),
        "customer_enriched": silver(clean_customers, "customer"),
        "payment_enriched": silver(valid_payments, "payment"),
        "payment_rejected": silver(rejected_payments, "payment"),
        "silver_stream_product": silver_stream("product", "product_enriched"),
        "silver_stream_product_rejected": silver_stream("product", "product_rejected"),
        "silver_stream_customer": silver_stream("customer", "customer_enriched"),
        "silver_stream_payment": silver_stream("payment", "payment_enriched"),
        "silver_stream_payment_rejected": silver_stream("payment", "payment_rejected"),
        "events_scd1": events_scd1,
        "events_scd1_stream": events_scd1_stream,
        "payment_scd1": payment_scd1,
        "payment_scd1_stream": payment_scd1_stream,
        "payment_scd1_corrected_stream": payment_scd1_corrected_stream,
        "vehicle_owner": vehicle_owner_query,
        "vehicle_owner_shuffled": vehicle_owner_shuffled,
        "vehicle_owner_table": vehicle_owner_table,
        "vehicle_owner_export": vehicle_owner_export,
        "curated_360": curated_360_query,
        "curated_360_shuffled": curated_360_shuffled,
        "curated_360_ids_as_delivered": curated_360_ids_as_delivered,
        "curated_360_of_current": curated_360_of_current,
        "curated_360_stream": curated_360_stream,
    }
