"""The refresh through all layers, restarts, table attributes, the external sink."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from acceptance.feeds import feed_rows, write_feed_files
from acceptance.queries import LINEAGE, shown
from autoledger.operators import (
    clean_customers,
    rejected_payments,
    rejected_products,
    valid_payments,
    valid_products,
)
from autoledger.plans import curated_360, drop_table, preview, total_rows, vehicle_owner
from autoledger.plans import refresh as flows
from autoledger.sources import FEEDS, PRODUCT
from autoledger.streaming import Sink, finish, into_sink, snapshot_to_sink

from .conftest import SMALL, as_set, plan_of

BUILDERS = {
    "product_enriched": ("product", valid_products),
    "product_rejected": ("product", rejected_products),
    "customer_enriched": ("customer", clean_customers),
    "payment_enriched": ("payment", valid_payments),
    "payment_rejected": ("payment", rejected_payments),
}


def batch_of(spark, table):
    feed, builder = BUILDERS[table]
    return builder(feed_rows(spark, SMALL, feed))


def comparable(rows, feed):
    result = shown(rows, FEEDS[feed].capture, *LINEAGE)
    return as_set(result, *sorted(result.columns))


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    """A lake after one refresh of all feeds, and the folders the feeds came from."""
    from autoledger.catalog import Lake

    root = str(tmp_path_factory.mktemp("refreshed"))
    paths = {}
    for feed in FEEDS:
        paths[feed] = f"{root}/landing/{feed}"
        write_feed_files(spark, SMALL, feed, paths[feed])
    lake = Lake(spark, f"{root}/lake", prefix="refreshed_")
    sink = Sink("owners_out", "parquet", {"path": f"{root}/owners_out"})
    flows.refresh(lake, paths, owner_sink=sink, files_per_batch=2)
    return lake, paths, sink


@pytest.mark.parametrize("table", BUILDERS)
def test_silver_stream_equals_batch(refreshed, table):
    lake, _, _ = refreshed
    feed, _ = BUILDERS[table]
    assert comparable(lake.read(table), feed) == comparable(batch_of(lake.spark, table), feed)


def test_gold_tables_equal_their_builders_on_batches(refreshed):
    lake, _, sink = refreshed
    products, customers, payments = (
        batch_of(lake.spark, table)
        for table in ("product_enriched", "customer_enriched", "payment_enriched")
    )
    owners = as_set(vehicle_owner(customers, products))
    assert as_set(lake.read("vehicle_owner")) == owners
    assert as_set(lake.spark.read.parquet(sink.options["path"])) == owners
    view = shown(curated_360(payments, products, customers))
    columns = view.columns
    assert as_set(shown(lake.read("curated_360_gold")), *columns) == as_set(view)
    assert as_set(shown(flows.curated_360_of_current(lake)), *columns) == as_set(view)


def test_owner_table_without_broadcast(refreshed, settings):
    lake, _, _ = refreshed
    before = as_set(lake.read("vehicle_owner"))
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    flows.build_vehicle_owner(lake)
    assert as_set(lake.read("vehicle_owner")) == before


def test_payment_streaming_holds_each_transaction_once(refreshed):
    lake, _, _ = refreshed
    current = lake.read("payment_streaming")
    valid = lake.read("payment_enriched")
    assert current.count() == valid.count() == current.select("transaction_id").distinct().count()


def test_second_refresh_adds_only_what_is_new(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    paths = {feed: f"{landing}/{feed}/*" for feed in FEEDS}
    for feed in FEEDS:
        write_feed_files(spark, SMALL, feed, f"{landing}/{feed}/day=1")
    sink = Sink("owners_out", "parquet", {"path": str(tmp_path / "out")})
    tables = [*BUILDERS, "vehicle_owner", "curated_360_gold", "payment_streaming"]

    def counts():
        flows.refresh(lake, paths, owner_sink=sink)
        return {table: lake.read(table).count() for table in tables}

    first = counts()
    assert counts() == first
    # The payments come once more: every version is kept, the current transactions stay the same.
    write_feed_files(spark, SMALL, "payment", f"{landing}/payment/day=2")
    second = counts()
    again = ("payment_enriched", "payment_rejected", "curated_360_gold")
    assert second == {**first, **{table: 2 * first[table] for table in again}}
    newest = lake.read("payment_enriched").agg(F.max("silver_ingest_ts")).first()[0]
    stale = lake.read("payment_streaming").filter(F.col("silver_ingest_ts") < F.lit(newest))
    assert stale.count() == 0
    assert spark.read.parquet(sink.options["path"]).count() == first["vehicle_owner"]


def test_versions_in_one_batch_are_ordered_by_their_files(spark, lake, tmp_path):
    """Rows of one micro-batch share the ingest time; the later file's version wins."""
    import os

    fields = FEEDS["payment"].fields
    landing = tmp_path / "payment"
    landing.mkdir()
    for name, age, paid in (("a.tsv", 0, "2.00"), ("b.tsv", 100, "1.00")):
        values = {
            "transaction_id": "T1", "vin": "V" * 17, "payment_date": "2024-01-05", "amount_paid": paid
        }
        (landing / name).write_text("\t".join(values.get(field, "") for field in fields) + "\n")
        os.utime(landing / name, (1_700_000_000 - age, 1_700_000_000 - age))
    flows.ingest(lake, {"payment": str(landing)})
    flows.clean(lake, "payment_enriched")
    flows.apply_payment_changes(lake)
    rows = lake.read("payment_streaming").select("amount_paid", "file_name").collect()
    assert [(str(row.amount_paid), row.file_name) for row in rows] == [("2.00", "a.tsv")]


def test_late_dimension_rows_reach_only_later_payments(spark, lake, tmp_path):
    """A payment is looked up once; the batch builder over the whole tables is the backfill."""
    landing = tmp_path / "landing"
    paths = {feed: f"{landing}/{feed}/*" for feed in FEEDS}
    for feed in FEEDS:
        write_feed_files(spark, SMALL, feed, f"{landing}/{feed}/day=1")
    flows.ingest(lake, paths)
    flows.clean(lake, "payment_enriched")
    (tmp_path / "empty").mkdir()
    late = {"product": "product_enriched", "customer": "customer_enriched"}
    for feed, table in late.items():
        lake.declare(table, batch_of(spark, table).schema)
    flows.extend_curated_360(lake)
    found = F.count("product_system_id")
    assert lake.read("curated_360_gold").agg(found).first()[0] == 0

    flows.clean(lake, *late.values())
    write_feed_files(spark, SMALL, "payment", f"{landing}/payment/day=2")
    flows.ingest(lake, {"payment": paths["payment"]})
    flows.clean(lake, "payment_enriched")
    flows.extend_curated_360(lake)
    streamed = lake.read("curated_360_gold").agg(found).first()[0]
    backfill = curated_360(
        lake.read("payment_enriched"), lake.read("product_enriched"), lake.read("customer_enriched")
    )
    assert streamed > 0 and backfill.agg(found).first()[0] == 2 * streamed


def test_comments_and_properties(refreshed):
    lake, _, _ = refreshed
    for name, layer in (
        ("product_bronze", "bronze"),
        ("payment_enriched", "silver"),
        ("payment_streaming", "silver"),
        ("vehicle_owner", "gold"),
        ("curated_360_gold", "gold"),
    ):
        table = lake.table(name)
        properties = {row.key: row.value for row in lake.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        assert (properties["quality"], properties["layer"]) == (layer, layer)
        described = lake.spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Comment'").first()
        assert described.data_type


def test_360_table_is_partitioned_by_dealer(refreshed):
    lake, _, _ = refreshed
    rows = lake.spark.sql(f"DESCRIBE EXTENDED {lake.table('curated_360_gold')}").collect()
    names = [row.col_name for row in rows]
    assert names[names.index("# Partition Information") + 2] == "dealer_id"
    one_dealer = lake.read("curated_360_gold").filter("dealer_id = 'US-000-000'")
    assert "PartitionFilters: [isnotnull(dealer_id" in one_dealer._jdf.queryExecution().toString()


def test_both_partition_columns_can_be_asked_for(spark, lake, tmp_path):
    paths = {}
    for feed in FEEDS:
        paths[feed] = str(tmp_path / feed)
        write_feed_files(spark, SMALL, feed, paths[feed])
    flows.ingest(lake, paths)
    flows.clean(lake, "product_enriched", "customer_enriched", "payment_enriched")
    flows.extend_curated_360(lake, partitioned_by=("dealer_id", "payment_date"))
    rows = lake.read("curated_360_gold")
    assert rows.count() == lake.read("payment_enriched").count()
    assert dict(rows.dtypes)["payment_date"] == "date" and dict(rows.dtypes)["dealer_id"] == "string"


def paid(spark, lake, folder, *payments):
    """Payments of a dealer on a day in the silver table, each of its own customer; no product or customer is known."""
    lines = []
    for number, (dealer, day) in enumerate(payments):
        values = {
            "transaction_id": f"T{number}", "customer_id": f"C{number}", "vin": "V" * 17,
            "dealer_id": dealer, "payment_date": day, "amount_paid": "1.00",
        }
        lines.append("\t".join(values.get(field, "") for field in FEEDS["payment"].fields) + "\n")
    folder.mkdir()
    (folder / "payments.tsv").write_text("".join(lines))
    flows.ingest(lake, {"payment": str(folder)})
    flows.clean(lake, "payment_enriched")
    for table in ("product_enriched", "customer_enriched"):
        lake.declare(table, batch_of(spark, table).schema)


def test_360_table_is_partitioned_by_dealer_and_day(spark, lake, tmp_path):
    dealers_and_days = [
        ("D1", "2024-01-05"), ("D1", "2024-01-06"), ("D1", "2024-01-05"), ("007", "0001-01-01"),
        ("a/1=2 %", "9999-12-31"), ("", "2024-01-06"),
    ]
    paid(spark, lake, tmp_path / "payment", *dealers_and_days)
    flows.extend_curated_360(lake)
    files = list(Path(lake.folder("curated_360_gold")).glob("dealer_id=*/payment_date=*/*.parquet"))
    assert len(files) == len(set(dealers_and_days)) == 5
    assert lake.partition_columns("curated_360_gold") == ("dealer_id", "payment_date")
    rows = lake.read("curated_360_gold").withColumn("payment_date", F.col("payment_date").cast("string"))
    expected = [(f"C{number}", dealer or None, day) for number, (dealer, day) in enumerate(dealers_and_days)]
    assert as_set(rows, "customer_id", "dealer_id", "payment_date") == sorted(expected, key=repr)
    one_day = lake.read("curated_360_gold").filter("payment_date = DATE '2024-01-06'")
    assert "PartitionFilters: [isnotnull(payment_date" in plan_of(one_day) and one_day.count() == 2


def test_360_table_of_other_partitions_is_refused(spark, lake, tmp_path):
    """Else the table would hold folders by dealer beside such by dealer and day, and could not be read."""
    paid(spark, lake, tmp_path / "payment", ("D1", "2024-01-05"), ("D2", "2024-01-06"))
    flows.extend_curated_360(lake, partitioned_by=("dealer_id",))
    with pytest.raises(ValueError, match="is partitioned by"):
        flows.extend_curated_360(lake)
    flows.extend_curated_360(lake, partitioned_by=("dealer_id",))
    assert lake.read("curated_360_gold").count() == 2


def test_inspection(refreshed):
    lake, _, _ = refreshed
    bronze = lake.read("product_bronze")
    assert preview(bronze).count() == 10
    assert total_rows(bronze).columns == ["total_rows"]
    assert total_rows(bronze).first().total_rows == 200


def test_failed_rebuild_keeps_the_old_snapshot(spark, lake):
    lake.save("vehicle_owner", spark.range(5).selectExpr("id AS vin"))
    old = lake.read("vehicle_owner")
    broken = spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("broken"))).alias("vin"))
    with pytest.raises(Exception, match="broken"):
        lake.save("vehicle_owner", broken)
    assert lake.read("vehicle_owner").count() == 5
    lake.save("vehicle_owner", spark.range(7).selectExpr("id AS vin"))
    # A reader who began before the rebuild still has the files of its snapshot.
    assert old.count() == 5 and lake.read("vehicle_owner").count() == 7
    for rows in (8, 9):
        lake.save("vehicle_owner", spark.range(rows).selectExpr("id AS vin"))
    assert lake.read("vehicle_owner").count() == 9 and len(lake._versions("vehicle_owner")) == 2


def test_no_file_is_too_old(spark, lake, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    line = "\t".join(["x"] * len(PRODUCT.fields)) + "\n"
    (folder / "new.tsv").write_text(line)
    flows.ingest(lake, {"product": str(folder)})
    (folder / "old.tsv").write_text(line * 2)
    os.utime(folder / "old.tsv", (1_000_000_000, 1_000_000_000))
    flows.ingest(lake, {"product": str(folder)})
    assert lake.read("product_bronze").count() == 3
    for file in (tmp_path / "lake" / "bronze" / "product_bronze").glob("*.parquet"):
        os.utime(file, (1_000_000_000, 1_000_000_000))
        break
    flows.clean(lake, "product_rejected", "product_enriched")
    both = lake.read("product_rejected").count() + lake.read("product_enriched").count()
    assert both == 3


def test_every_flow_is_bounded(spark, lake, tmp_path):
    """Four files a feed and one file a micro-batch: no flow takes its backlog as one."""
    paths = {}
    for feed in FEEDS.values():
        folder = tmp_path / "landing" / feed.name
        folder.mkdir(parents=True)
        for number in range(4):
            (folder / f"{number}.tsv").write_text("\t".join([f"v{number}"] * len(feed.fields)) + "\n")
        paths[feed.name] = str(folder)
    flows.refresh(lake, paths, files_per_batch=1)

    def batches(checkpoint: str) -> int:
        return len([file for file in Path(checkpoint, "commits").iterdir() if file.name.isdigit()])

    for name in ("product_bronze", "customer_bronze", "payment_bronze", *flows.SILVER_FLOWS):
        assert batches(lake.checkpoint(name)) >= 4, name


def test_drop_table_is_idempotent(spark, lake):
    lake.save("vehicle_owner", spark.range(3).selectExpr("id AS vin"))
    drop_table(spark, lake.table("vehicle_owner"))
    drop_table(spark, lake.table("vehicle_owner"))
    assert not spark.catalog.tableExists(lake.table("vehicle_owner"))


def test_snapshot_sink_replaces_and_stream_sink_appends(spark, tmp_path):
    sink = Sink("out", "parquet", {"path": str(tmp_path / "out")})
    for rows in (5, 3):
        snapshot_to_sink(spark.range(rows), sink)
    assert spark.read.parquet(sink.options["path"]).count() == 3

    stream_sink = Sink("out2", "json", {"path": str(tmp_path / "out2")})
    for rows in (5, 3):
        spark.range(rows).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
        finish([into_sink(stream, stream_sink, str(tmp_path / "checkpoint"))])
    assert spark.read.json(stream_sink.options["path"]).count() == 8


def test_failure_of_one_flow_is_raised(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    failing = stream.select(F.raise_error(F.lit("broken")).alias("x"))
    sink = Sink("out", "parquet", {"path": str(tmp_path / "out")})
    with pytest.raises(Exception, match="broken"):
        finish([into_sink(failing, sink, str(tmp_path / "checkpoint"))])
