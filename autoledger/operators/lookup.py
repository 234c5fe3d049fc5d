"""Left lookup of a fact table, batch or stream, in a dimension.

No broadcast hint is given: Spark broadcasts a dimension whose size, known from statistics or from a
finished shuffle stage, is below ``spark.sql.autoBroadcastJoinThreshold``, and joins by shuffle beyond it.

A shuffle on the key alone would gather all facts of one key in one task. So the join key is the key and a
lane:

- facts with a null key match nothing; they get a lane from their spread value and so scatter;
- facts with a hot key get one of that key's lanes likewise, and the dimension rows of the key stand in each of these;
- all others are in lane 0, as are the other dimension rows.

Hot keys are looked for where ``hot_in`` is given: one pass over its key columns, in sketches of fixed size. A key
is hot if it holds at least twice the rows that one of ``lanes`` partitions would hold of evenly dealt rows, so
there are at most ``lanes / 2`` hot keys, and none where keys are even, however few they are. Each gets lanes by its own
share: its part of ``LANES_PER_PARTITION`` times ``lanes``, but no more than ``MOST_PER_SHARE`` for each partition that it
fills, up to the next of a few sizes. So all hot keys together have at most ``5 lanes`` lanes, and that many times their
dimension rows are repeated at most. The hashes found are
collected once, one group for each size, and both sides get the same literals, so which keys are named affects speed
and never the result. What remains is left to the adaptive skew join, which splits the left side of a left join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import latest_per_key

# Groups of input splits whose sketches are merged, and counters of a sketch for each key it may have to name.
SKETCH_GROUPS = 256
COUNTERS_PER_KEY = 10
MOST_COUNTERS = 1_000_000
# A key is hot from so many shares of a partition on.
HOT_SHARES = 2
# Lanes of all hot keys for each partition, so that chance puts about as many into each, and of one for each that it fills.
LANES_PER_PARTITION = 4
MOST_PER_SHARE = 16
# Numbers of lanes are powers of this, so that there are few of them.
SIZE_STEP = 1.25


class KeyPair(NamedTuple):
    """What is compared on either side; both of one type."""

    fact: Column
    dimension: Column


def hot_key_lanes(rows: DataFrame, keys: Sequence[Column], lanes: int) -> dict[int, list[int]]:
    """Hashes of the keys that hold at least ``HOT_SHARES`` in ``lanes`` of the rows with a key, by their number of lanes.

    The splits' sketches are merged in groups and only the groups' top keys go on, so no task sees more
    than a fixed amount, however many splits there are.
    """
    any_null = reduce(or_, [key.isNull() for key in keys])
    hashed = rows.filter(~any_null).select(F.xxhash64(*keys).alias("key_hash"))
    counters = min(MOST_COUNTERS, COUNTERS_PER_KEY * lanes)
    groups = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))).agg(
        F.expr(f"approx_top_k(key_hash, {lanes}, {counters})").alias("top"), F.count("*").alias("rows")
    )
    total = groups.agg(F.sum("rows")).scalar()
    counted = groups.select(F.inline("top")).groupBy("item").agg(F.sum("count").alias("rows"))
    shares = F.col("rows") * lanes / total
    hot = counted.select("item", "rows", shares.alias("shares")).filter(F.col("shares") >= HOT_SHARES).filter("rows > 1")
    shares_of = {row.item: row.shares for row in hot.orderBy("item").collect()}  # at most ``lanes / HOT_SHARES``
    each = min(MOST_PER_SHARE, LANES_PER_PARTITION * lanes / max(1, sum(shares_of.values())))
    found: dict[int, list[int]] = {}
    for key_hash, share in shares_of.items():
        found.setdefault(size_for(share * each), []).append(key_hash)
    return found


def size_for(lanes: float) -> int:
    power = math.floor(math.log(lanes, SIZE_STEP))
    while int(SIZE_STEP**power) < lanes:
        power += 1
    return int(SIZE_STEP**power)


def lanes_of_key(key_hash: Column, hot: Mapping[int, Sequence[int]]) -> Column:
    """The number of lanes of a hot key, and 1 for others; one set of literals for each size."""
    groups = sorted(hot.items())
    first = F.when(key_hash.isin(groups[0][1]), groups[0][0])
    return reduce(lambda found, group: found.when(key_hash.isin(group[1]), group[0]), groups[1:], first).otherwise(1)


def left_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[KeyPair],
    take: Mapping[str, Column],
    newest_by: Sequence[str] | None = None,
    spread_by: Column | None = None,
    hot_in: DataFrame | None = None,
    lanes: int | None = None,
) -> DataFrame:
    """Every fact row with the ``take`` columns of each dimension row that has equal keys, else nulls.

    Two dimension rows with the same keys give two result rows, unless ``newest_by`` names the columns
    that decide which one is kept. ``spread_by`` tells facts of one key apart, by default a hash of the
    row. ``hot_in`` is a batch with the facts' key columns: the facts themselves, or for a stream a table
    of earlier ones. ``lanes``, by default the number of shuffle partitions, is among how many partitions a hot key is dealt.
    """
    lanes = lanes or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_key{position}" for position in range(len(keys))]
    no_match = reduce(or_, [pair.fact.isNull() for pair in keys])
    if spread_by is None:
        spread_by = F.xxhash64(*[F.col(f"`{name}`") for name in facts.columns])
    lane_0 = F.lit(0)

    keyed_dimension = dimension.select(
        *[pair.dimension.alias(name) for name, pair in zip(names, keys)],
        *[column.alias(name) for name, column in take.items()],
        *[F.col(name).alias(f"_by_{name}") for name in newest_by or ()],
    )
    if newest_by:
        order = [f"_by_{name}" for name in newest_by]
        keyed_dimension = latest_per_key(keyed_dimension, names, order).drop(*order)

    hot = hot_key_lanes(hot_in, [pair.fact for pair in keys], lanes) if hot_in is not None else {}
    null_lane = F.pmod(spread_by, F.lit(LANES_PER_PARTITION * lanes)).cast("int")
    if not hot:
        fact_lane = F.when(no_match, null_lane).otherwise(lane_0)
        # Always 0, yet no literal: Catalyst would fold a literal into a filter and out of the join key.
        dimension_lane = F.pmod(F.hash(*names), F.lit(1))
    else:
        fact_lanes = lanes_of_key(F.xxhash64(*[pair.fact for pair in keys]), hot)
        own_lane = F.pmod(spread_by, fact_lanes).cast("int")
        fact_lane = F.when(no_match, null_lane).otherwise(own_lane)
        dimension_lane = F.explode(F.sequence(lane_0, lanes_of_key(F.xxhash64(*names), hot) - 1))

    keyed_facts = facts.withColumns(
        {**{name: pair.fact for name, pair in zip(names, keys)}, "_lane": fact_lane}
    )
    keyed_dimension = keyed_dimension.withColumn("_lane", dimension_lane)
    for name in names:
        if keyed_facts.schema[name].dataType != keyed_dimension.schema[name].dataType:
            raise TypeError("keys of facts and dimension must have the same type")

    joined = keyed_facts.join(keyed_dimension, [*names, "_lane"], "left")
    return joined.drop(*names, "_lane")
