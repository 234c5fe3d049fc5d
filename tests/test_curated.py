"""The lookup and the two curated tables: results, plans and behaviour under skew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from autoledger.operators import KeyPair, left_lookup
from autoledger.operators.lookup import hot_key_lanes
from autoledger.plans import curated_360, rebalanced, vehicle_owner
from autoledger.plans.curated import OWNER_FROM_CUSTOMER, VIEW_360_COLUMNS
from autoledger.streaming import Sink, finish, into_sink

from .conftest import as_set, plan_of


def lookup(facts, dimension, **options):
    keys = [KeyPair(F.col("k"), F.col("k"))]
    return left_lookup(facts, dimension, keys, {"v": F.col("v")}, **options)


def brute_force(facts, dimension):
    rows = []
    for position, key in facts:
        found = [value for other, value in dimension if key is not None and other == key]
        rows += [(position, key, value) for value in found or [None]]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("look_for_hot_keys", [False, True])
@pytest.mark.parametrize("strategy", [None, "merge", "shuffle_hash", "broadcast"])
def test_lookup_equals_brute_force(spark, strategy, look_for_hot_keys):
    rng = random.Random(3)
    keys = [None, *[f"k{number}" for number in range(30)]]
    facts = [(position, rng.choice(keys)) for position in range(500)]
    dimension = [(rng.choice(keys[:20]), position) for position in range(25)]
    right = spark.createDataFrame(dimension, "k string, v int")
    right = right.hint(strategy) if strategy else right
    left = spark.createDataFrame(facts, "p int, k string")
    result = lookup(left, right, hot_in=left if look_for_hot_keys else None)
    assert result.columns == ["p", "k", "v"]
    assert as_set(result) == brute_force(facts, dimension)


def test_duplicates_multiply_unless_the_newest_is_asked_for(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "p int, k string")
    dimension = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), (None, 9, 9)], "k string, v int, t int")
    assert as_set(lookup(facts, dimension), "p", "v") == [(1, 1), (1, 2), (2, None), (3, None)]
    assert as_set(lookup(facts, dimension, newest_by=["t"]), "p", "v") == [(1, 2), (2, None), (3, None)]


def test_null_keys_are_spread_over_tasks(spark, settings):
    """A third of the facts has no key; no task gets more than its share of them."""
    settings(spark__sql__shuffle__partitions="16", spark__sql__adaptive__enabled="false")
    facts = spark.range(30_000).selectExpr("id AS p", "IF(id % 3 = 0, NULL, concat('k', id)) AS k")
    dimension = spark.range(30_000).selectExpr("concat('k', id) AS k", "id AS v").hint("merge")
    result = lookup(facts, dimension)
    assert "_lane" in plan_of(result).split("Exchange hashpartitioning")[1][:80]
    sizes = [row["count"] for row in result.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 30_000 / 16
    assert result.filter("v IS NULL").count() == 10_000


def test_hot_key_is_spread_over_tasks(spark, settings):
    """A third of the facts has one key: beside a shuffle on the key alone, where one task gets them all."""
    settings(spark__sql__shuffle__partitions="16", spark__sql__adaptive__enabled="false")
    facts = spark.range(60_000).selectExpr("id AS p", "IF(id % 3 = 0, 'hot', concat('k', id)) AS k")
    dimension = spark.range(60_000).selectExpr("IF(id = 0, 'hot', concat('k', id)) AS k", "id AS v")

    def largest(rows):
        return max(row["count"] for row in rows.groupBy(F.spark_partition_id()).count().collect())

    assert largest(lookup(facts, dimension.hint("merge"))) > 20_000
    spread = lookup(facts, dimension.hint("merge"), hot_in=facts)
    assert largest(spread) < 2 * 60_000 / 16
    assert tuple(spread.agg(F.count("*"), F.count("v")).first()) == (60_000, 60_000)


def test_hot_keys_are_those_above_a_share(spark):
    rows = spark.range(100_000).selectExpr("IF(id % 3 = 0, 'hot', IF(id % 3 = 1, NULL, concat('k', id))) AS k")
    hot = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    # The only hot key gets all 4 times 16 lanes, up to the next size.
    assert hot_key_lanes(rows, [F.col("k")], 16) == {69: [hot]}
    assert hot_key_lanes(rows.filter("k IS NULL"), [F.col("k")], 16) == {}
    assert hot_key_lanes(rows.filter("k <> 'hot'"), [F.col("k")], 1000) == {}


def test_few_even_keys_are_not_hot(spark):
    rows = spark.range(64_000).selectExpr("concat('k', id % 64) AS k")
    assert hot_key_lanes(rows, [F.col("k")], 64) == {}
    assert hot_key_lanes(rows, [F.col("k")], 256) != {}


def test_lanes_follow_the_share_of_a_key(spark, settings):
    """Keys with a half, a quarter, an eighth of the rows and so on: repeated rows stay below five times the lanes."""
    settings(spark__sql__shuffle__partitions="32", spark__sql__adaptive__enabled="false")
    lanes, n = 32, 1 << 16
    facts = spark.range(1, n).selectExpr("id AS p", "concat('k', bit_count(id ^ (id - 1))) AS k")
    hot = hot_key_lanes(facts, [F.col("k")], lanes)
    assert {own: len(found) for own, found in hot.items()} == {69: 1, 35: 1, 18: 1, 9: 1}
    for many in (32, 64, 500, 4000):
        found = hot_key_lanes(facts, [F.col("k")], many)
        assert sum(own * len(keys) for own, keys in found.items()) <= 5 * many
    dimension = spark.range(1, 18).selectExpr("concat('k', id) AS k", "id AS v")
    spread = lookup(facts, dimension.hint("merge"), hot_in=facts)
    assert as_set(spread.groupBy("k").agg(F.count("v"))) == as_set(facts.groupBy("k").count())
    largest = max(row["count"] for row in spread.groupBy(F.spark_partition_id()).count().collect())
    assert largest < 4 * n / lanes


def test_table_without_hot_keys_repeats_no_dimension_row(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    facts = spark.range(5_000).selectExpr("id AS p", "concat('k', id) AS k")
    dimension = spark.range(5_000).selectExpr("concat('k', id) AS k", "id AS v")
    assert "Generate" not in plan_of(lookup(facts, dimension, hot_in=facts))


def test_keys_of_different_types_are_refused(spark):
    with pytest.raises(TypeError):
        lookup(spark.range(1).selectExpr("id AS k"), spark.range(1).selectExpr("'1' AS k", "id AS v"))


def test_stream_takes_hot_keys_from_earlier_facts(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    hot_facts(spark, str(tmp_path / "facts"))
    dimension = spark.range(60_000).selectExpr("IF(id = 0, 'hot', concat('k', id)) AS k", "id AS v")
    stream = spark.readStream.schema("p bigint, k string").parquet(str(tmp_path / "facts"))
    rows = lookup(stream, dimension, hot_in=spark.read.parquet(str(tmp_path / "facts")))
    sink = Sink("out", "parquet", {"path": str(tmp_path / "out")})
    finish([into_sink(rows, sink, str(tmp_path / "checkpoint"))])
    out = spark.read.parquet(str(tmp_path / "out"))
    assert tuple(out.agg(F.count("*"), F.count("v"), F.countDistinct("p")).first()) == (60_000,) * 3


SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "8",
}


def hot_facts(spark, folder):
    """A third of the rows on one key, in several files."""
    rows = spark.range(60_000).selectExpr("id AS p", "IF(id % 3 = 0, 'hot', concat('k', id)) AS k")
    rows.repartition(8).write.parquet(folder)


def test_hot_key_is_split_in_batch(spark, settings, tmp_path):
    settings(**SKEW)
    hot_facts(spark, str(tmp_path / "facts"))
    dimension = spark.range(60_000).selectExpr("IF(id = 0, 'hot', concat('k', id)) AS k", "id AS v")
    result = lookup(spark.read.parquet(str(tmp_path / "facts")), dimension)
    counted = result.groupBy().agg(F.count("*").alias("n"), F.count("v").alias("found"))
    assert tuple(counted.first()) == (60_000, 60_000)
    result.write.format("noop").mode("overwrite").save()
    result.collect()
    assert "skew=true" in plan_of(result)


def test_hot_key_is_split_in_a_stream(spark, settings, tmp_path):
    settings(**SKEW)
    folder = str(tmp_path / "facts")
    hot_facts(spark, folder)
    dimension = spark.range(60_000).selectExpr("IF(id = 0, 'hot', concat('k', id)) AS k", "id AS v")
    stream = spark.readStream.schema("p bigint, k string").parquet(folder)
    flow = (
        lookup(stream, dimension)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .format("parquet")
        .start(str(tmp_path / "out"))
    )
    flow.awaitTermination()
    plan = flow._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert spark.read.parquet(str(tmp_path / "out")).filter("v IS NOT NULL").count() == 60_000


def test_hot_partition_value_is_written_by_several_tasks(spark, settings, tmp_path):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__shuffle__partitions="8",
    )
    hot_facts(spark, str(tmp_path / "facts"))
    rows = spark.read.parquet(str(tmp_path / "facts")).selectExpr(
        "p", "sha2(cast(p AS string), 256) AS payload", "IF(k = 'hot', 'D1', concat('D', p % 5)) AS d"
    )
    rebalanced(rows, "d").write.partitionBy("d").parquet(str(tmp_path / "out"))
    assert len(list((tmp_path / "out" / "d=D1").glob("*.parquet"))) > 2
    assert len(list((tmp_path / "out" / "d=D2").glob("*.parquet"))) <= 8
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60_000


# The two tables ---------------------------------------------------------------------------------------

PRODUCT = (
    "vin string, dealer_id string, sgrp_id string, manufacturer string, legal_name string, email string,"
    " system_id string, serial_number string, country_code string, silver_ingest_ts timestamp"
)
CUSTOMER = (
    "customer_id string, vin string, dealer_id string, first_name string, national_id string,"
    " email string, phone_mobile string, city string, country string, customer_type string,"
    " account_status string, credit_score string, purchase_date string, payment_method string,"
    " currency string, country_code string, serial_number string, silver_ingest_timestamp timestamp"
)
PAYMENT = (
    "transaction_id string, customer_id string, vin string, dealer_id string, payment_date string"
)


def frame(spark, schema, *rows):
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], schema)


def test_owner_keeps_customers_without_product_and_without_vin(spark):
    customers = frame(
        spark, CUSTOMER, {"vin": "A", "first_name": "x"}, {"vin": "Z"}, {"first_name": "no vin"}
    )
    products = frame(spark, PRODUCT, {"vin": "A", "system_id": "S1"}, {"vin": "A", "system_id": "S2"}, {})
    owners = vehicle_owner(customers, products)
    assert owners.columns == [
        *OWNER_FROM_CUSTOMER, "manufacturer", "legal_name", "email", "system_id", "sgrp_id"
    ]
    assert as_set(owners, "vin", "first_name", "system_id") == [
        ("A", "x", "S1"), ("A", "x", "S2"), ("Z", None, None), (None, "no vin", None)
    ]


def test_360_matches_ids_with_and_without_hyphens(spark):
    payments = frame(spark, PAYMENT, {"customer_id": "C-1", "vin": "VIN1", "dealer_id": "US-01"})
    products = frame(spark, PRODUCT, {"vin": " vin1", "dealer_id": "US01", "system_id": "S"})
    customers = frame(
        spark,
        CUSTOMER,
        {"customer_id": "C1", "vin": "Vin1 ", "dealer_id": "US01", "currency": "EUR", "payment_method": "m"},
    )
    view = curated_360(payments, products, customers)
    assert view.columns == list(VIEW_360_COLUMNS) and len(VIEW_360_COLUMNS) == 21
    shown = ("customer_id", "vin", "dealer_id", "product_system_id", "customer_currency")
    assert as_set(view, *shown) == [("C-1", "VIN1", "US-01", "S", "EUR")]
    as_delivered = curated_360(payments, products, customers, normalize_keys=False)
    assert as_set(as_delivered, *shown) == [("C-1", "VIN1", "US-01", None, None)]


def test_360_keeps_payments_without_customer_or_dealer(spark):
    payments = frame(
        spark, PAYMENT, {"vin": "V", "dealer_id": "D"}, {"vin": "V", "customer_id": "C"}, {"vin": "W"}
    )
    products = frame(spark, PRODUCT, {"vin": "V", "dealer_id": "D", "system_id": "S"})
    customers = frame(spark, CUSTOMER, {"vin": "V", "first_name": "n"})
    assert as_set(curated_360(payments, products, customers), "vin", "product_system_id", "first_name") == [
        ("V", "S", None), ("V", None, None), ("W", None, None)
    ]


def test_360_reads_only_needed_columns_and_broadcasts_small_dimensions(spark, tmp_path):
    stored = {}
    for name, schema in (("payment", PAYMENT), ("product", PRODUCT), ("customer", CUSTOMER)):
        names = [part.split()[0] for part in schema.split(",")]
        row = {column: "x" for column in names if not column.startswith("silver")}
        frame(spark, schema, row).withColumn("unused", F.lit("u")).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    view = curated_360(stored["payment"], stored["product"], stored["customer"])
    view.collect()
    plan = plan_of(view).split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    schemas = [part.split("\n")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert len(schemas) == 3 and not any("unused" in schema for schema in schemas)
    assert not any("email" in schema for schema in schemas if "sgrp_id" in schema)
    # The lookups themselves shuffle nothing when the dimensions are small.
    assert "Exchange hashpartitioning" not in plan
