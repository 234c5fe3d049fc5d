"""Latest version per key, in batch."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from autoledger.operators import latest_per_key

from .conftest import SMALL, as_set, plan_of


def test_equals_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(40), rng.randrange(10_000), position) for position in range(3000)]
    best = {}
    for key, sequence, position in rows:
        best[key] = max(best.get(key, (-1, -1)), (sequence, position))
    frame = spark.createDataFrame(rows, "k int, s int, p int").repartition(5)
    expected = sorted(((k, s, p) for k, (s, p) in best.items()), key=repr)
    assert as_set(latest_per_key(frame, ["k"], ["s", "p"])) == expected


def test_ties_are_decided_alike_in_every_run(spark):
    frame = spark.createDataFrame([(1, 5, text) for text in "abcdefgh"], "k int, s int, v string")
    winners = {
        tuple(as_set(latest_per_key(frame.repartition(parts).orderBy(F.rand()), ["k"], ["s"])))
        for parts in (1, 2, 3, 7)
    }
    assert len(winners) == 1


def test_null_keys_are_one_key_and_a_null_sequence_is_oldest(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), (7, None), (7, 0)], "k int, s int")
    assert as_set(latest_per_key(frame, ["k"], ["s"])) == [(7, 0), (None, 2)]


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    """A third of all rows on one key: each split sends a single row of it."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("s"),
    )
    rows.repartition(6).write.parquet(str(tmp_path / "hot"))
    latest = latest_per_key(spark.read.parquet(str(tmp_path / "hot")), ["k"], ["s"])
    latest.collect()
    plan = plan_of(latest).split("== Initial Plan ==")[0]
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:] and "Partial" in plan[shuffle:]
    assert latest.filter("k = -1").first().s == 29_997
    assert latest.count() == 20_001


def test_events(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    latest = latest_per_key(events, ["user_id"], ["ts", "event_id"])
    assert latest.count() == events.select("user_id").distinct().count()
