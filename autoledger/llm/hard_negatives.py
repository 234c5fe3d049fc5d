"""Hard negatives of anchors, by exact search in Hilbert-ordered blocks with zone maps.

1. **Blocks.** All rows are ordered along a Hilbert curve through their vectors and cut into blocks of about
   ``BLOCK_ROWS`` rows, one Parquet row each. Neighbours on the curve are close in space, so a block's zone map, the least
   and the largest value of every dimension, is a small box. Boxes are stored beside the blocks and read without them.
2. **Anchors** are taken from the blocks in the order of the curve, in groups of up to ``GROUP_ROWS``.
3. **Search.** A request is an anchor with windows, intervals of scores, and asks for the best rows in each. First each anchor
   searches the block it lies in, which gives every window with enough rows a score to beat. Then interval arithmetic over
   the boxes bounds the scores that an anchor can have in a block from above and below, and only blocks whose bounds
   reach one of its windows, and there the score to beat, are read for it. Bounds only rule out, so the result is exact.
4. **Two searches.** The first finds the positives, rows of the anchor's label, with one window that is open on both
   sides. Their scores make the windows of the second, among rows of other labels.

Groups of anchors meet blocks in a join by block number, and groups meet boxes, packed ``ZONES`` blocks to a row, likewise.
What a task returns of a group and a block is at most as many rows as asked for, per anchor and window.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part; a shorter vector goes on with
zeros, so an empty one is all zeros; ids may repeat, as rows are told apart by a number of their own, and equal rows are
other rows; rows without an id come last of those of one score and are no anchors; components and scores beyond a long stay at its limits;
ties beyond the id go to the row read first; an empty table, or one without anchors, has no result; other columns are not read.
A hot vector, label or id is dealt over blocks by the row's number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, mapped, ship, stored

BLOCK_ROWS = 4096
GROUP_ROWS = 1024
ZONES = 4096
# Cells of a dimension for the curve, as a power of two; about as many vectors in each.
CURVE_BITS = 3
POSITIVES = 5
NEGATIVES = 10
# Percent of the positive's score that a negative's may have.
LEAST_PERCENT = 30
MOST_PERCENT = 90

LONG = np.iinfo(np.int64)
# Whole numbers up to here are exact as floats.
EXACT = float(1 << 53)
# Bounds of the seven eighths of a normal distribution, in deviations.
EIGHTHS = np.array([-1.1503, -0.6745, -0.3186, 0.0, 0.3186, 0.6745, 1.1503])

BLOCK = (
    "block long, n int, block_labels array<long>, least binary, largest binary, ids binary, numbers binary, labels binary, "
    "anchors binary, width int, vectors binary"
)
GROUP = "group long, ids binary, numbers binary, labels binary, homes binary, width int, vectors binary"
TERMS = "group long, place binary, window binary, low binary, high binary, beat binary, beat_id binary"


def hilbert_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> list[bytes]:
    """The places of points on the Hilbert curve through a grid of ``2 ** bits`` cells a side, as bytes in order.

    By the transposed form of the curve: exchanges and inversions of the axes from the coarsest bit to the finest, then
    the Gray code over all axes, then the bits of equal weight side by side.
    """
    axes = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in axes:
            inverted = ((axis >> bit) & 1).astype(bool)
            exchanged = np.where(inverted, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(inverted, below, exchanged)
            axis ^= exchanged
    for one, other in zip(axes, axes[1:]):
        other ^= one
    turn = np.zeros(axes.shape[1], dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> bit) & 1, (1 << bit) - 1, 0)
    axes ^= turn
    planes = np.concatenate([(axes >> bit) & 1 for bit in range(bits - 1, -1, -1)]).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(planes.T, axis=1)]


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """One row per vector, filled up with zeros."""
    rows = np.zeros((len(vectors), width), dtype=np.int64)
    for place, vector in enumerate(vectors):
        rows[place, : len(vector)] = vector
    return rows


def narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest type of whole numbers that holds them all."""
    for kind in (np.int16, np.int32):
        limits = np.iinfo(kind)
        if values.size and limits.min <= values.min() and values.max() <= limits.max:
            return values.astype(kind)
    return values


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<i{width}")


def longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<i8")


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, exact up to the limits of a long."""
    largest = [max(abs(float(each.min(initial=0))), abs(float(each.max(initial=0)))) for each in (one, other)]
    if largest[0] * largest[1] * max(1, one.shape[1]) < EXACT:
        return (one.astype(np.float64) @ other.astype(np.float64).T).astype(np.int64)
    whole = one.astype(object) @ other.astype(object).T
    return np.clip(whole, LONG.min, LONG.max).astype(np.int64)


def bounds(vectors: np.ndarray, least: np.ndarray, largest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score that each vector can have in each box, or a little beyond."""
    above, below = (np.where(keep, vectors, 0).astype(np.float64) for keep in (vectors > 0, vectors < 0))
    least, largest = least.astype(np.float64), largest.astype(np.float64)
    low, high = above @ least.T + below @ largest.T, above @ largest.T + below @ least.T
    size = np.abs(vectors.astype(np.float64)) @ np.maximum(np.abs(least), np.abs(largest)).T
    slack = np.where(size < EXACT, 0.0, 1e-9 * size)
    # Scores stay at the limits of a long, so their bounds do.
    limits = float(LONG.min), float(LONG.max)
    return np.clip(low - slack, *limits), np.clip(high + slack, *limits)


def prepared(vectors: DataFrame, is_anchor: Column, id: str, vector: str, label: str) -> DataFrame:
    """Rows that take part: ``number``, ``id``, ``label``, ``vector`` of longs and ``is_anchor``."""
    values = column(vector)
    whole = F.forall(values, lambda one: one.isNotNull())
    return vectors.filter(column(label).isNotNull() & values.isNotNull() & whole).select(
        F.monotonically_increasing_id().alias("number"),
        column(id).cast("long").alias("id"),
        column(label).cast("long").alias("label"),
        F.transform(values, lambda one: one.cast("long")).alias("vector"),
        (F.coalesce(is_anchor, F.lit(False)) & column(id).isNotNull()).alias("is_anchor"),
    )


def spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each dimension. One number each per dimension reaches the driver."""

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            width = int(frame["vector"].str.len().max()) if len(frame) else 0
            values = matrix(frame["vector"], width).astype(np.float64)
            sums = {"n": len(frame), "total": values.sum(axis=0), "squares": (values * values).sum(axis=0)}
            yield pd.DataFrame({"dimension": np.arange(width), **sums})

    parts = mapped(rows.select("vector"), summed, T.StructType.fromDDL("dimension int, n long, total double, squares double"))
    sums = parts.groupBy("dimension").agg(F.sum("n"), F.sum("total"), F.sum("squares")).orderBy("dimension").collect()
    n, total, squares = (np.array([row[place] for row in sums], dtype=np.float64) for place in (1, 2, 3))
    if not len(n):  # no rows, or empty vectors alone
        return np.zeros(1), np.zeros(1)
    mean = total / n
    return mean, np.sqrt(np.maximum(squares / n - mean * mean, 0))


def blocks_of(rows: DataFrame, mean: np.ndarray, deviation: np.ndarray, block_rows: int) -> DataFrame:
    """The rows in blocks along the curve. Rows of one place on it are dealt by their number."""
    width = len(mean)
    edges = mean + np.outer(EIGHTHS, deviation)

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = matrix(frame["vector"], width)
            cells = (values[None, :, :] > edges[:, None, :]).sum(axis=0)
            yield frame.assign(key=hilbert_keys(cells))

    # Ids go through Python as text, as a missing one makes floats of the others.
    rows = rows.withColumn("id", F.col("id").cast("string"))
    keys = stored(mapped(rows, keyed, T.StructType([*rows.schema.fields, T.StructField("key", T.BinaryType())])), "curve")
    ordered = keys.repartitionByRange("key", "number").sortWithinPartitions("key", "number")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 32
        held, n_held, made = [], 0, 0

        def closed(frame: pd.DataFrame) -> pd.DataFrame:
            ids = np.array([LONG.max if one is None else int(one) for one in frame["id"]], dtype=np.int64)
            nameless = np.array([one is None for one in frame["id"]])
            order = np.lexsort((frame["number"], nameless, ids))
            frame, ids = frame.iloc[order], ids[order]
            values = matrix(frame["vector"], width)
            small = narrow(values)
            labels = frame["label"].to_numpy()
            row = {
                "block": first + made,
                "n": len(frame),
                "block_labels": [np.unique(labels).tolist()],
                "least": packed(values.min(axis=0)),
                "largest": packed(values.max(axis=0)),
                "ids": packed(ids),
                "numbers": packed(frame["number"].to_numpy()),
                "labels": packed(labels),
                "anchors": packed(np.flatnonzero(frame["is_anchor"])),
                "width": small.dtype.itemsize,
                "vectors": packed(small),
            }
            return pd.DataFrame(row | {"named": int((~nameless).sum())})

        for frame in frames:
            while len(frame):
                part, frame = frame.iloc[: block_rows - n_held], frame.iloc[block_rows - n_held :]
                held.append(part)
                n_held += len(part)
                if n_held == block_rows:
                    yield closed(pd.concat(held))
                    held, n_held, made = [], 0, made + 1
        if held:
            yield closed(pd.concat(held))

    return stored(mapped(ordered, cut, T.StructType.fromDDL(f"{BLOCK}, named int")), "blocks")


def groups_of(blocks: DataFrame, width: int, group_rows: int) -> DataFrame:
    """The anchors in groups, in the order in which their blocks are read."""

    def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 32
        held: list[dict[str, np.ndarray]] = []
        made = 0

        def closed(parts: list[dict[str, np.ndarray]]) -> pd.DataFrame:
            whole = {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}
            small = narrow(whole.pop("vectors"))
            row = {name: packed(values) for name, values in whole.items()}
            return pd.DataFrame([row | {"group": first + made, "width": small.dtype.itemsize, "vectors": packed(small)}])

        for frame in frames:
            for row in frame.itertuples():
                places = longs(row.anchors)
                if not len(places):
                    continue
                part = {name: longs(getattr(row, name))[places] for name in ("ids", "numbers", "labels")}
                part["vectors"] = unpacked(row.vectors, row.width).reshape(-1, width)[places].astype(np.int64)
                part["homes"] = np.full(len(places), row.block)
                for begin in range(0, len(places), group_rows):
                    one = {name: values[begin : begin + group_rows] for name, values in part.items()}
                    if sum(len(other["ids"]) for other in held) + len(one["ids"]) > group_rows:
                        yield closed(held)
                        held, made = [], made + 1
                    held.append(one)
        if held:
            yield closed(held)

    names = ["block", "ids", "numbers", "labels", "anchors", "width", "vectors"]
    with_anchors = blocks.filter(F.length("anchors") > 0).select(*names)
    return stored(mapped(with_anchors, gathered, T.StructType.fromDDL(GROUP)), "groups")


def packed_terms(terms: DataFrame) -> DataFrame:
    """A row per group of its windows; ``terms`` has ``group``, ``place``, ``window``, ``low``, ``high``, ``beat``, ``beat_id``."""

    def gathered(frame: pd.DataFrame) -> pd.DataFrame:
        names = ["place", "window", "low", "high", "beat", "beat_id"]
        frame = frame.sort_values(["window", "place"])
        row = {name: packed(frame[name].to_numpy().astype(np.int64)) for name in names}
        return pd.DataFrame([{"group": int(frame["group"].iloc[0]), **row}])

    ship(terms.sparkSession)
    return terms.groupBy("group").applyInPandas(gathered, TERMS)


def home_pairs(groups: DataFrame) -> DataFrame:
    """Each group with the blocks its anchors lie in: ``group``, ``block`` and ``wanted``, places in the group."""

    def paired(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                homes = longs(row.homes)
                rows = [(row.group, int(home), packed(np.flatnonzero(homes == home))) for home in np.unique(homes)]
                yield pd.DataFrame(rows, columns=["group", "block", "wanted"])

    return mapped(groups.select("group", "homes"), paired, T.StructType.fromDDL("group long, block long, wanted binary"))


def far_pairs(groups: DataFrame, terms: DataFrame, zones: DataFrame, n_zones: int, width: int, same: bool) -> DataFrame:
    """Each group with the other blocks whose bounds reach a window of one of its anchors.

    The queries meet the boxes of all blocks in packs, by the number of the pack.
    """

    def chosen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                vectors = unpacked(row.vectors, row.width).reshape(-1, width).astype(np.int64)
                labels, homes = longs(row.labels), longs(row.homes)
                least, largest = (
                    longs(b"".join(boxes)).reshape(-1, width) for boxes in (row.least, row.largest)
                )
                numbers = np.asarray(row.blocks, dtype=np.int64)
                low, high = bounds(vectors, least, largest)
                reached = np.zeros(low.shape, dtype=bool)
                place, terms_low, terms_high, beat = map(longs, (row.place, row.low, row.high, row.beat))
                window = longs(row.window)
                for one in np.unique(window):
                    of = window == one
                    at = place[of]
                    from_score = np.maximum(terms_low[of], beat[of])[:, None]
                    reached[at] |= (high[at] >= from_score) & (low[at] <= terms_high[of][:, None])
                for at, held in enumerate(row.block_labels):
                    if same:
                        reached[:, at] &= np.isin(labels, np.asarray(held, dtype=np.int64))
                    elif len(held) == 1:
                        reached[:, at] &= labels != held[0]
                reached &= homes[:, None] != numbers[None, :]
                pairs = np.flatnonzero(reached.any(axis=0))
                rows = [(row.group, int(numbers[at]), packed(np.flatnonzero(reached[:, at]))) for at in pairs]
                yield pd.DataFrame(rows, columns=["group", "block", "wanted"])

    every = F.explode(F.sequence(F.lit(0), F.lit(n_zones - 1))).alias("zone")
    names = ["group", "labels", "homes", "width", "vectors", "place", "window", "low", "high", "beat"]
    asked = groups.join(terms, "group").select(*names, every)
    met = asked.join(zones, "zone").drop("zone")
    return mapped(met, chosen, T.StructType.fromDDL("group long, block long, wanted binary"))


def answers(
    pairs: DataFrame, groups: DataFrame, terms: DataFrame, blocks: DataFrame, width: int, same: bool, most: int
) -> DataFrame:
    """Of each pair of a group and a block, the best rows for each window of the wanted anchors."""

    def best(row, group_vectors: np.ndarray) -> Iterator[tuple]:
        wanted = longs(row.wanted)
        ids, numbers, labels = map(longs, (row.ids, row.numbers, row.labels))
        values = unpacked(row.vectors, row.width).reshape(-1, width).astype(np.int64)
        scores = products(group_vectors[wanted], values)
        own_labels, own_numbers = longs(row.group_labels)[wanted], longs(row.group_numbers)[wanted]
        allowed = (own_labels[:, None] == labels[None, :]) == same
        allowed &= own_numbers[:, None] != numbers[None, :]
        terms_of = [longs(getattr(row, name)) for name in ("place", "window", "low", "high", "beat", "beat_id")]
        place, window, low, high, beat, beat_id = terms_of
        for one in np.unique(window):
            of = np.flatnonzero(window == one)
            of = of[np.isin(place[of], wanted)]
            at = np.searchsorted(wanted, place[of])
            score = scores[at]
            fits = allowed[at] & (score >= low[of][:, None]) & (score <= high[of][:, None])
            fits &= score >= beat[of][:, None]
            fits &= (score > beat[of][:, None]) | (ids[None, :] <= beat_id[of][:, None])
            anchor, col = np.nonzero(fits)
            value = score[anchor, col]
            # Columns are in the order of ids, so a stable sort leaves ties in it. ``~`` turns the order round.
            order = np.lexsort((~value, anchor))
            anchor, col, value = anchor[order], col[order], value[order]
            rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
            kept = rank < most
            anchor, col, value = anchor[kept], col[kept], value[kept]
            named = col < row.named
            if len(anchor):
                yield row.group, place[of][anchor], int(one), value, ids[col], named, numbers[col]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                group_vectors = unpacked(row.group_vectors, row.group_width).reshape(-1, width).astype(np.int64)
                for group, place, window, score, ids, named, numbers in best(row, group_vectors):
                    found = {"place": place.astype(np.int32), "score": score, "id": ids, "named": named, "number": numbers}
                    yield pd.DataFrame(found).assign(group=group, window=window)

    of_group = groups.select(
        "group",
        F.col("numbers").alias("group_numbers"),
        F.col("labels").alias("group_labels"),
        F.col("width").alias("group_width"),
        F.col("vectors").alias("group_vectors"),
    )
    of_block = blocks.select("block", "ids", "numbers", "labels", "width", "vectors", "named")
    met = pairs.join(of_group, "group").join(terms, "group").join(of_block, "block")
    schema = T.StructType.fromDDL("group long, place int, window int, score long, id long, named boolean, number long")
    found = mapped(met, read, schema)
    return found.withColumn("id", F.when(F.col("named"), F.col("id"))).drop("named")


def top(found: DataFrame, most: int) -> DataFrame:
    """The best rows of each window, with their ``rank`` from 1. Spark limits the ranks before the shuffle as well."""
    order = Window.partitionBy("group", "place", "window").orderBy(
        F.desc("score"), F.asc_nulls_last("id"), "number"
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def searched(
    terms: DataFrame, groups: DataFrame, blocks: DataFrame, zones: DataFrame, n_zones: int, width: int, same: bool, most: int
) -> DataFrame:
    """The best rows for every window of ``terms``: ``group``, ``place``, ``window``, ``low`` and ``high``."""
    nothing = [F.lit(LONG.min).cast("long").alias("beat"), F.lit(LONG.max).cast("long").alias("beat_id")]
    at_home = stored(packed_terms(terms.select("*", *nothing)), "home_terms")
    near = stored(top(answers(home_pairs(groups), groups, at_home, blocks, width, same, most), most), "near")
    last = near.filter(F.col("rank") == most).select(
        "group", "place", "window", F.col("score").alias("beat"), F.coalesce("id", F.lit(LONG.max)).alias("beat_id")
    )
    to_beat = terms.join(last, ["group", "place", "window"], "left").select(
        "group",
        "place",
        "window",
        "low",
        "high",
        F.coalesce("beat", F.lit(LONG.min)).alias("beat"),
        F.coalesce("beat_id", F.lit(LONG.max)).alias("beat_id"),
    )
    asked = stored(packed_terms(to_beat), "terms")
    pairs = stored(far_pairs(groups, asked, zones, n_zones, width, same), "block_choice")
    far = answers(pairs, groups, asked, blocks, width, same, most)
    return top(near.drop("rank").unionByName(far), most)


def zones_of(blocks: DataFrame, zone_blocks: int) -> tuple[DataFrame, int]:
    """The boxes of the blocks in packs, and the number of packs."""
    n_zones = max(1, -(-blocks.count() // zone_blocks))
    box = F.struct("block", "block_labels", "least", "largest")
    packs = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(n_zones)).cast("int").alias("zone"))
    boxes = packs.agg(F.collect_list(box).alias("boxes")).select(
        "zone",
        F.col("boxes.block").alias("blocks"),
        F.col("boxes.block_labels").alias("block_labels"),
        F.col("boxes.least").alias("least"),
        F.col("boxes.largest").alias("largest"),
    )
    return stored(boxes, "zones"), n_zones


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT,
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
    zone_blocks: int = ZONES,
) -> DataFrame:
    """For each anchor and each of its best ``positives`` of its own label, the best ``negatives`` of other labels whose
    score is between two shares of the positive's. Vectors are of whole numbers, see ``quantised``."""
    if not 0 <= least_percent <= most_percent <= 100:
        raise ValueError("0 <= least_percent <= most_percent <= 100")
    spark = vectors.sparkSession
    rows = stored(prepared(vectors, is_anchor, id, vector, label), "vectors")
    mean, deviation = spread(rows)
    width = len(mean)
    blocks = blocks_of(rows, mean, deviation, block_rows)
    groups = groups_of(blocks, width, group_rows)
    if groups.isEmpty():
        return spark.createDataFrame([], RESULT)
    zones, n_zones = zones_of(blocks, zone_blocks)
    setting = (groups, blocks, zones, n_zones, width)

    last_place = (F.length("numbers") / 8 - 1).cast("int")
    anchors = groups.select("group", F.explode(F.sequence(F.lit(0), last_place)).alias("place"))
    everything = anchors.select(
        "*", F.lit(0).alias("window"), F.lit(LONG.min).alias("low"), F.lit(LONG.max).alias("high")
    )
    found = stored(searched(everything, *setting, same=True, most=positives), "positives")

    score = F.col("score")
    hundreds, rest = F.expr("score div 100"), score % 100
    terms = found.filter(score >= 0).select(
        "group",
        "place",
        F.col("rank").alias("window"),
        (hundreds * least_percent + F.ceil(rest * least_percent / 100)).alias("low"),
        (hundreds * most_percent + F.floor(rest * most_percent / 100)).alias("high"),
    )
    terms = stored(terms, "windows")
    negative = searched(terms, *setting, same=False, most=negatives).select(
        "group",
        "place",
        "window",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    positive = found.select(
        "group",
        "place",
        F.col("rank").alias("window"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    names = stored(named_anchors(groups), "anchors")
    joined = negative.join(positive, ["group", "place", "window"]).join(names, ["group", "place"])
    return joined.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def named_anchors(groups: DataFrame) -> DataFrame:
    """``group``, ``place`` and ``anchor_id`` of every anchor."""

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                ids = longs(row.ids)
                yield pd.DataFrame({"group": row.group, "place": np.arange(len(ids), dtype=np.int32), "anchor_id": ids})

    return mapped(groups.select("group", "ids"), listed, T.StructType.fromDDL("group long, place int, anchor_id long"))


def quantised(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id``, ``vector`` and ``label`` with each component ``x`` as ``floor(256 x)``; a vector with a component that is
    null or not finite becomes null."""
    values = F.transform(column(vector), lambda one: one.cast("double"))
    finite = F.forall(values, lambda one: one.isNotNull() & ~F.isnan(one) & (F.abs(one) < float("inf")))
    whole = F.transform(values, lambda one: F.floor(one * 256))
    return vectors.select(column(id).alias(id), column(label).alias(label), F.when(finite, whole).alias(vector))


# The same in DuckDB, for the query's anchors and labels.
SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, a.l AS al, b.r AS br, b.vec_id AS vec_id, b.l AS bl,
    CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE al = bl
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, br) <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.vec_id NULLS LAST, s.br) AS rank
  FROM p JOIN s ON s.ar = p.ar AND s.bl <> p.al
    AND {LEAST_PERCENT} * p.score <= 100 * s.score AND 100 * s.score <= {MOST_PERCENT} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {NEGATIVES}
"""
