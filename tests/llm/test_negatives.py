"""Hard negatives against brute force, and the curve and the bounds by themselves."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from autoledger.llm import hard_negatives as hn
from autoledger.llm import queries

from .conftest import SMALL

SCHEMA = "vec_id long, embedding array<long>, label long, number string, zone string"


def brute(rows: list[tuple], positives=5, negatives=10) -> list[tuple]:
    rows = [row for row in rows if row[1] is not None and row[2] is not None and None not in row[1]]
    width = max((len(row[1]) for row in rows), default=0)
    vectors = [[*row[1], *[0] * (width - len(row[1]))] for row in rows]
    found = []
    for at, anchor in enumerate(rows):
        if anchor[0] is None or anchor[0] % 100:
            continue
        scored = []
        for other, row in enumerate(rows):
            if other != at:
                score = sum(a * b for a, b in zip(vectors[at], vectors[other]))
                score = min(max(score, -(1 << 63)), (1 << 63) - 1)
                scored.append((-score, row[0] is None, row[0] or 0, other))
        scored.sort()
        same = [one for one in scored if rows[one[3]][2] == anchor[2]][:positives]
        for one in same:
            low, high = -30 * one[0], -90 * one[0]
            window = [n for n in scored if rows[n[3]][2] != anchor[2] and low <= -100 * n[0] <= high][:negatives]
            for rank, negative in enumerate(window, 1):
                found.append((anchor[0], rows[one[3]][0], rank, rows[negative[3]][0], -one[0], -negative[0]))
    return sorted(found, key=repr)


def mined(spark, rows: list[tuple], **settings) -> list[tuple]:
    table = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(3)
    found = hn.hard_negatives(table, F.col("vec_id") % 100 == 0, **settings)
    assert found.columns == [field.split()[0] for field in hn.RESULT.split(", ")]
    return sorted(map(tuple, found.collect()), key=repr)


def test_op11_equals_its_sql(spark, sql_rows):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = queries.op11_hard_negatives(spark, SMALL).select(columns).collect()
    assert sorted(map(repr, map(tuple, rows))) == sql_rows(hn.SQL, columns)


def test_small_blocks_equal_brute_force(spark):
    draw = random.Random(3)
    rows = []
    for number in range(400):
        centre = number % 4
        rows.append((number * 20, [draw.randint(-9, 9) + 12 * (place == centre) for place in range(6)], draw.randint(0, 3)))
    # A hot vector in two labels, repeated ids, ids and labels missing, short and empty vectors, gaps in vectors.
    rows += [(7 + number, [5, 5, 5, 5, 5, 5], number % 2) for number in range(150)]
    rows += [(100, [9, 9, 9, 9, 9, 9], 1), (100, [9, 9, 9, 9, 9, 9], 1), (None, [9, 9, 9, 9, 9, 9], 1), (None, [9, 9], 2)]
    rows += [(1 << 60, [8, 8, 8, 8, 8, 8], 2), ((1 << 60) + 1, [8, 8, 8, 8, 8, 8], 2), (200, [], 2), (300, None, 2)]
    rows += [(400, [1, None, 3], 1), (500, [3, 2, 1], None), (-100, [4, 4, 4, 4, 4, 4], 0)]
    expected = brute(rows)
    assert len(expected) > 1000
    assert mined(spark, rows, block_rows=16, group_rows=8, zone_blocks=5) == expected


def test_scores_beyond_a_long(spark):
    large = (1 << 62) + 12345
    rows = [(0, [large, 3, 1], 1), (1, [large, 1, 0], 1), (2, [1, 2, 3], 2), (3, [large // 4, 7, 0], 2), (4, [0, 1, 1], 1)]
    rows += [(100, [1, -1, 0], 1), (5, [-large, 0, 0], 2), (6, [2, 0, 0], 2), (7, [5, 1, 1], 1)]
    assert mined(spark, rows, block_rows=2, group_rows=1) == brute(rows)


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1, 2], 0), (None, [3, 4], 1)]) == []
    assert mined(spark, [(100, [], 0), (200, [], 1), (300, [], 0)]) == brute([(100, [], 0), (200, [], 1), (300, [], 0)])


def test_quantised(spark):
    rows = [(1, [0.5, -0.001, 1.0], 0), (2, [float("nan")], 0), (3, [float("inf"), 1.0], 0), (4, None, 0), (5, [None, 1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {row.vec_id: row.embedding for row in hn.quantised(table).collect()}
    assert found == {1: [128, -1, 256], 2: None, 3: None, 4: None, 5: None}


def test_the_curve_visits_neighbours():
    for sides, bits in ((2, 3), (3, 2), (2, 4)):
        cells = np.array(list(np.ndindex(*[1 << bits] * sides)))
        keys = hn.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=lambda place: keys[place])]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_reached():
    draw = np.random.default_rng(4)
    vectors, points = draw.integers(-50, 50, (20, 5)), draw.integers(-50, 50, (30, 5))
    low, high = hn.bounds(vectors, points.min(axis=0)[None], points.max(axis=0)[None])
    scores = vectors @ points.T
    assert (low[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= high[:, 0]).all()
    corners = np.array(list(np.ndindex(*[2] * 5)))
    corners = np.where(corners, points.max(axis=0), points.min(axis=0))
    assert ((vectors @ corners.T).max(axis=1) == high[:, 0]).all()


def test_far_blocks_are_ruled_out(spark):
    """Two clusters far apart: anchors of one need no block of the other."""
    draw = random.Random(5)
    rows = [
        (number, [draw.randint(90, 110) * (1 if number % 2 else -1) for _ in range(4)], number % 4 // 2)
        for number in range(1, 1000)
    ] + [(0, [100, 100, 100, 100], 0)]
    table = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    ready = hn.stored(hn.prepared(table, F.col("vec_id") == 0, "vec_id", "embedding", "label"), "vectors")
    mean, deviation = hn.spread(ready)
    blocks = hn.blocks_of(ready, mean, deviation, 50)
    groups = hn.groups_of(blocks, len(mean), 8)
    zones, n_zones = hn.zones_of(blocks, 4)
    terms = groups.select(
        "group",
        F.lit(0).alias("place"),
        F.lit(0).alias("window"),
        F.lit(1).alias("low"),
        F.lit(hn.LONG.max).alias("high"),
        F.lit(hn.LONG.min).alias("beat"),
        F.lit(hn.LONG.max).alias("beat_id"),
    )
    pairs = hn.far_pairs(groups, hn.packed_terms(terms), zones, n_zones, len(mean), same=False)
    assert 0 < pairs.count() <= blocks.count() // 2 + 2
