"""Near-duplicate classes by BagMinHash signatures.

A text is a bag of its five-word shingles. Two texts are linked if their weighted Jaccard similarity, the sum of
least over the sum of largest counts, is at least ``THRESHOLD``; a class is what links connect.

**Signature.** Each shingle has Poisson processes over its count, cut at powers of two: one of rate 1 on the first
copy, one of rate 1 on the second, of rate 2 on the next two, and so on. A point falls on one of the interval's
copies by halving it again and again, counts only if the text has that copy, and goes to one register, which
keeps its earliest point. So a register of two texts agrees with just the probability of their weighted
Jaccard similarity, and the work for a count grows with its logarithm. Points beyond the time at which all
registers are surely filled are never drawn; a text that is not filled by then is drawn further.

**Candidates.** Texts that agree in all registers of a band share a bucket. Equal texts are one node from the
start. In a bucket all members are compared with one pivot, not with each other. Where links join them all the
bucket is done, and a group of copies of any size costs about one comparison a member. Else members are compared with another
pivot ``P``: of the class that is closest to the bucket's members, the text with the least share of shingles of its own. The
text that a group was copied from is close to all of them, and one copy to another is not.

**What is left.** Pairs of different classes under one pivot ``P`` are found by a prefix-filtered join. The shingles of a text
are ordered: first those no other open text holds, then those that ``P`` does not hold, then those of ``P``, each by hash.
Two similar texts of ``n`` and ``k`` shingles share at least ``o = ceil(0.8 / 1.8 (n + k))``, and so one among the first
``n - o + 1`` places of the one and ``k - o + 1`` of the other, and by the first that they share there, enough must lie
behind it in both. For ``k`` a text takes the fewest shingles of those under ``P`` that are within its bounds and not of
its class for sure; if there are none, it takes no part. So no link between members of a bucket is lost, and unlike
copies of one text, whose own edits fill their first places, do not meet.

**Bounds.** Shingles of a text that no other open text holds are in no overlap. With ``n`` shingles and ``m`` of
them held by others, the similarity to a text of ``k`` shingles is at most ``m / (n + k - m)``. After the first
round this rules out, exactly, most of what is left in a large group whose copies differ by their own edits:
members that no text of their bucket can match leave it, and pairs beyond the bound are not compared.

**Verification.** Candidate pairs are checked on their texts.

Cases: a null text is like an empty one, and texts without words, like all equal texts, are one class; of fewer than
five words the whole text is the one shingle; a class is named by its least id that is not null; ids may repeat,
as rows are told apart by their texts; an empty table has no class; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_slice, column, files_for, mapped, schema_of, ship, stored, texts_of
from .graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
BAND_REGISTERS = 5
# Characters of the texts that are signed together.
SIGNED_CHARS = 1_000_000
# Numbers of shingles within this factor count as one size, of which the bounds of the best text are kept.
SIZE_STEP = 1.02
WORD = regex.compile(r"[0-9a-z\u0080-\U0010FFFF]+")
MOST_WORDS = 100_000


@lru_cache(maxsize=MOST_WORDS)
def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-spread function of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def advance(draws: int) -> np.uint64:
    return np.uint64(draws * 0x9E3779B97F4A7C15 % 2**64)


def shingles_of(text: str) -> np.ndarray:
    """64-bit hashes of the shingles of a text, one per place."""
    words = WORD.findall(text.lower())
    hashes = np.fromiter(map(word_hash, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(hashes))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    rolled = np.zeros(count, dtype=np.uint64)
    for step in range(size):
        rolled = mixed(rolled + hashes[step : step + count])
    return rolled


def weighted_jaccard(one: str, other: str) -> float:
    a, b = Counter(shingles_of(one).tolist()), Counter(shingles_of(other).tolist())
    common = sum((a & b).values())
    union = sum(a.values()) + sum(b.values()) - common
    return common / union if union else 1.0


def intervals(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each process of each text: the text's place, a seed, the interval's size, and copies held in it."""
    places, seeds, sizes, held = [], [], [], []
    for place, text in enumerate(texts):
        distinct, counts = np.unique(shingles_of(text), return_counts=True)
        begin, size, level = 0, 1, 0
        while len(distinct):
            places.append(np.full(len(distinct), place))
            seeds.append(mixed(distinct + np.uint64(level)))
            sizes.append(np.full(len(distinct), size))
            held.append(np.minimum(counts - begin, size))
            begin, level = begin + size, level + 1
            size = begin
            more = counts > begin
            distinct, counts = distinct[more], counts[more]
    if not places:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty.astype(np.uint64), empty, empty
    return tuple(map(np.concatenate, (places, seeds, sizes, held)))


def uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(texts: list[str], registers: int = BANDS * BAND_REGISTERS) -> np.ndarray:
    """A row of registers per text: the 64-bit pattern of each register's earliest time; 0 for no shingles."""
    place, seed, size, held = intervals(texts)
    earliest = np.full(len(texts) * registers, np.inf)
    weights = np.bincount(place, weights=held, minlength=len(texts))
    # By then each register has its point, but for about one text in fifty.
    limit = registers * (np.log(registers) + 4) / np.maximum(weights, 1)
    active = np.arange(len(place))
    time, draw = np.zeros(len(place)), 0
    waiting: list[tuple[np.ndarray, np.ndarray, int]] = []
    state = mixed(seed)
    while True:
        while len(active):
            draw += 1
            bits = mixed(state[active] + advance(draw))
            more = mixed(bits + np.uint64(0x632BE59BD9B4E019))
            time[active] -= np.log(uniform(bits)) / size[active]
            within = time[active] <= limit[place[active]]
            waiting.append((active[~within], more[~within], draw))
            active, more = active[within], more[within]
            record(earliest, registers, place[active], more, time[active], size[active], held[active])
        filled = np.isfinite(earliest.reshape(-1, registers)).all(axis=1) | (weights == 0)
        if filled.all():
            break
        # Draw on for the others: what lies beyond the old limit was drawn but not recorded.
        limit = np.where(filled, limit, 2 * limit)
        resumed, left = [], []
        for beyond, more, drawn in waiting:
            again = ~filled[place[beyond]]
            inside = again & (time[beyond] <= limit[place[beyond]])
            now = beyond[inside]
            record(earliest, registers, place[now], more[inside], time[now], size[now], held[now])
            resumed.append((now, drawn))
            left.append((beyond[again & ~inside], more[again & ~inside], drawn))
        waiting = left
        # Each process goes on from its own number of draws; the seed takes up the difference.
        latest = draw
        for now, drawn in resumed:
            state[now] = state[now] - advance(latest - drawn)
        active = np.concatenate([now for now, _ in resumed])
    result = earliest.view(np.uint64).reshape(-1, registers).copy()
    result[weights == 0] = 0
    return result


def record(
    earliest: np.ndarray,
    registers: int,
    place: np.ndarray,
    bits: np.ndarray,
    time: np.ndarray,
    size: np.ndarray,
    held: np.ndarray,
) -> None:
    """Points go to their register, if the copy they fall on is held."""
    register = ((bits >> np.uint64(40)) % np.uint64(registers)).astype(np.int64)
    copy = (bits & np.uint64(0xFFFFFFFF)).astype(np.int64) % size
    counts = copy < held
    np.minimum.at(earliest, (place * registers + register)[counts], time[counts])


def banded(docs: DataFrame) -> DataFrame:
    """``node``, the digest of a text, and ``buckets``, one hash per band; no buckets without words."""

    def signed(frame: pd.DataFrame) -> pd.DataFrame:
        rows = signatures(frame["text"].tolist()).reshape(len(frame), BANDS, BAND_REGISTERS)
        keys = np.zeros(rows.shape[:2], dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for register in range(BAND_REGISTERS):
            keys = mixed(keys + rows[:, :, register])
        buckets = [[] if not row.any() else key.view(np.int64).tolist() for row, key in zip(rows, keys)]
        return pd.DataFrame({"doc_id": frame["doc_id"], "node": frame["node"], "buckets": buckets})

    fields = schema_of(docs, "node binary, buckets array<long>")
    return mapped(docs.withColumn("node", F.unhex(F.md5("text"))), by_slice(signed, most_chars=SIGNED_CHARS), fields)


def linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs ``a``, ``b`` of nodes whose texts are similar enough."""
    ship(pairs.sparkSession)

    @F.pandas_udf(T.BooleanType())
    def similar(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([weighted_jaccard(a, b) >= threshold for a, b in zip(one, other)], dtype=bool)

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").filter(similar("text_a", "text_b")).select("a", "b")


def shingle_bags(texts: DataFrame, files: int | None = None) -> DataFrame:
    """``node`` and ``bag``, its shingles; the second copy of a shingle in a text is another shingle, and so on."""

    def bag(text: str) -> list[int]:
        distinct, counts = np.unique(shingles_of(text), return_counts=True)
        copies = np.arange(counts.sum()) - (np.cumsum(counts) - counts).repeat(counts)
        named = distinct.repeat(counts)
        return np.where(copies > 0, mixed(named + copies.astype(np.uint64)), named).view(np.int64)

    def listed(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"node": frame["node"], "bag": [bag(text) for text in frame["text"]]})

    schema = T.StructType.fromDDL("node binary, bag array<long>")
    return stored(mapped(texts, by_slice(listed, most_chars=SIGNED_CHARS), schema), "bags", files)


def shared_shingles(bags: DataFrame, files: int | None = None) -> DataFrame:
    """``n``, the number of shingles of each ``node``, ``m``, of those that another of the texts holds, and these as ``shared``."""
    holder = F.xxhash64("node")
    rows = bags.select(holder.alias("holder"), F.explode("bag").alias("shingle"))
    alone = rows.groupBy("shingle").agg(F.count("*").alias("texts"), F.bit_xor("holder").alias("holder")).filter("texts = 1")
    own = alone.groupBy("holder").agg(F.collect_list("shingle").alias("own"))
    found = bags.withColumn("holder", holder).join(own, "holder", "left")
    shared = F.when(F.col("own").isNull(), F.col("bag")).otherwise(F.array_except("bag", "own"))
    found = found.select("node", F.size("bag").cast("long").alias("n"), shared.alias("shared"))
    return stored(found.withColumn("m", F.size("shared").cast("long")), "shared", files)


def reach(m: Column, n: Column, threshold: float) -> Column:
    """With ``m`` of ``n`` shingles in common, ``threshold`` times the most shingles that a similar enough text has."""
    return (1 + threshold) * m - threshold * n


def reaches(reach: Column, other_n: Column, threshold: float) -> Column:
    """Whether a text of this ``reach`` could be similar enough to one of ``other_n`` shingles."""
    return reach >= threshold * other_n - 1e-6


def reachable(m: Column, n: Column, other_n: Column, threshold: float) -> Column:
    """Whether ``m`` shingles in common could be similar enough; a little more is let through than that."""
    return m >= threshold * (n + other_n - m) - 1e-6


def candidate_pairs(opened: DataFrame) -> DataFrame:
    """Pairs of a bucket's first pivot and its other members."""
    pivots = opened.filter("is_pivot").select("bucket", F.col("node").alias("pivot"))
    met = opened.join(pivots, "bucket").filter(F.col("node") != F.col("pivot"))
    return met.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()


def closest(opened: DataFrame) -> DataFrame:
    """For each ``bucket`` its ``pivot``: the class of the member with the least share of shingles of its own, and of all
    that class the text with the least."""
    own = F.struct(((F.col("n") - F.col("m")) / F.col("n")).alias("own"), "node")
    of_class = opened.groupBy("root").agg(F.min(own)["node"].alias("pivot"))
    return opened.groupBy("bucket").agg(F.min_by("root", own).alias("root")).join(of_class, "root").select("bucket", "pivot")


def pivot_pairs(opened: DataFrame, pivots: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a bucket's pivot and its members of other classes, within bounds."""
    facts = opened.select("node", "root", "n", "m").distinct()
    facts = facts.toDF(*[f"pivot_{name}" for name in facts.columns])
    met = opened.join(pivots, "bucket").join(facts, F.col("pivot") == F.col("pivot_node"))
    met = met.filter(F.col("root") != F.col("pivot_root"))
    met = met.filter(reachable(F.least("m", "pivot_m"), F.col("n"), F.col("pivot_n"), threshold))
    return met.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()


def sizes_met(met: DataFrame, threshold: float) -> DataFrame:
    """For each ``pivot`` the ``sizes`` of its texts, those apart from its class by themselves: the least ``n`` and the
    greatest ``reach`` of each size. The list grows with the logarithm of the longest text."""
    size = F.floor(F.log("n") / F.log(F.lit(SIZE_STEP)))
    bounds = F.min("n").alias("n"), F.max(reach(F.col("m"), F.col("n"), threshold)).alias("reach")
    of_size = met.groupBy("pivot", "apart", size.alias("size")).agg(*bounds)
    return of_size.groupBy("pivot").agg(F.collect_list(F.struct("apart", "n", "reach")).alias("sizes"))


def prefixes(
    opened: DataFrame,
    pivots: DataFrame,
    roots: DataFrame,
    shared: DataFrame,
    threshold: float,
    files: int | None = None,
) -> DataFrame:
    """For each ``pivot`` and ``node`` of one of its buckets: ``prefix``, the shingles that a similar text under this pivot
    must have one of, and ``apart``, whether the node is of another class than the pivot."""
    of_pivot = pivots.join(roots.withColumnRenamed("node", "pivot"), "pivot", "left").select(
        "bucket", "pivot", F.coalesce("root", "pivot").alias("pivot_root")
    )
    met = opened.join(of_pivot, "bucket").select(
        "pivot", "node", "n", "m", (F.col("root") != F.col("pivot_root")).alias("apart")
    )
    # Once for a text and a pivot, in however many buckets they meet.
    met = stored(met.distinct(), "met", files)
    n, m, apart = F.col("n"), F.col("m"), F.col("apart")
    partners = F.filter(
        "sizes",
        lambda size: (apart | size["apart"])
        & reaches(size["reach"], n, threshold)
        & reaches(reach(m, n, threshold), size["n"], threshold),
    )
    fewest = F.array_min(F.transform(partners, lambda size: size["n"]))
    overlap = F.greatest(threshold * n, threshold / (1 + threshold) * (n + fewest))
    # Shingles of its own take the first places, but meet nothing.
    places = F.when(fewest.isNotNull(), m - F.ceil(overlap - 1e-6) + 1)
    near = met.join(sizes_met(met, threshold), "pivot").withColumn("places", places.cast("int")).filter("places > 0")
    lists = shared.select(F.col("node").alias("pivot"), F.col("shared").alias("in_pivot"))
    both = near.drop("sizes").join(shared.select("node", "shared"), "node").join(lists, "pivot")
    beside = F.array_sort(F.array_except("shared", "in_pivot"))
    ordered = F.concat(beside, F.array_sort(F.array_intersect("shared", "in_pivot")))
    return both.select("pivot", "node", "n", "m", "apart", F.slice(ordered, F.lit(1), F.col("places")).alias("prefix"))


def placed(prefixed: DataFrame, roots: DataFrame) -> DataFrame:
    """A row per shingle of each prefix, with ``most``, the shingles from there on that others hold, and the node's ``root``."""
    known = prefixed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = known.select("pivot", "node", "root", "n", "m", "apart", F.posexplode("prefix").alias("place", "shingle"))
    return rows.withColumn("most", F.col("m") - F.col("place")).drop("m", "place")


def meets(one: str, other: str, threshold: float) -> Column:
    """Whether two texts that share a shingle are of different classes, one of them of another than the pivot, and have
    enough shingles from there on."""
    a, b = (lambda name: F.col(f"{one}.{name}")), (lambda name: F.col(f"{other}.{name}"))
    enough = reachable(F.least(a("most"), b("most")), a("n"), b("n"), threshold)
    return (a("root") != b("root")) & (a("apart") | b("apart")) & enough


def pairs_left(tokens: DataFrame, threshold: float) -> DataFrame:
    """All pairs of different classes that share a shingle of their prefixes, within bounds."""
    mixed_groups = tokens.groupBy("pivot", "shingle").agg(
        F.min("root").alias("first_root"), F.max("root").alias("last_root")
    )
    mixed_groups = mixed_groups.filter("first_root <> last_root").select("pivot", "shingle")
    fact = F.struct("node", "root", "n", "most", "apart")
    others = tokens.select("pivot", "shingle", fact.alias("other"))
    ones = tokens.filter("apart").join(mixed_groups, ["pivot", "shingle"], "left_semi")
    met = ones.select("pivot", "shingle", fact.alias("one")).join(others, ["pivot", "shingle"])
    once = ~F.col("other.apart") | (F.col("one.node") < F.col("other.node"))
    met = met.filter(meets("one", "other", threshold) & once)
    return met.select(F.greatest("one.node", "other.node").alias("a"), F.least("one.node", "other.node").alias("b")).distinct()


def classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    id: str = "doc_id",
    text: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Per row: ``doc_id``, ``node`` (a digest of its text), ``root`` (the least node of its class) and ``class_id``,
    the least id of its class. If an id stands on several texts, classes may share a ``class_id`` but no ``root``.
    Working tables go into ``files``, by default what ``files_for`` says."""
    docs = texts_of(docs, id, text)
    files = files_for(docs) if files is None else files
    signed = stored(banded(docs), "signatures")
    nodes = stored(
        signed.groupBy("node").agg(F.min("doc_id").alias("id"), F.first("buckets").alias("buckets")), "nodes", files
    )
    members = nodes.select("node", F.explode("buckets").alias("bucket"))
    several = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = stored(members.join(several, "bucket").select("bucket", "node"), "members", files)

    # Texts that take part, one row each; a text is read at one of its ids.
    wanted = members.select("node").distinct().join(nodes.select("node", "id"), "node")
    read = docs.join(
        wanted.withColumnRenamed("id", "_id"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.unhex(F.md5("text")) == F.col("node")),
    )
    texts = stored(read.groupBy("node").agg(F.min("text").alias("text")), "texts", files)

    roots = nodes.select("node", F.col("node").alias("root")).limit(0)

    def undone(members: DataFrame, bounds: DataFrame | None) -> DataFrame:
        """Members of buckets that hold several classes, with ``root``, and with ``n`` and ``m`` where bounds are known."""
        labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        facts = [F.min("node").alias("least"), F.min("root").alias("first_root"), F.max("root").alias("last_root")]
        near = F.lit(True)
        if bounds is not None:
            labelled = labelled.join(bounds, "node")
            facts.append(F.min("n").alias("fewest"))
            # Members out of reach of the text of fewest shingles in their bucket are out of reach of all.
            near = reachable(F.col("m"), F.col("n"), F.greatest("fewest", "m"), threshold)
        open_buckets = labelled.groupBy("bucket").agg(*facts).filter("first_root <> last_root")
        return labelled.join(open_buckets.drop("first_root", "last_root"), "bucket").filter(near)

    def joined(pairs: DataFrame) -> DataFrame:
        """The roots with the links among the pairs."""
        found = stored(linked(pairs, texts, threshold), "links", files)
        if found.isEmpty():
            return roots
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        return components(found.unionAll(known), files)

    opened = undone(members, None).withColumn("is_pivot", F.col("node") == F.col("least"))
    opened = stored(opened, "open_members", files)
    if not opened.isEmpty():
        roots = joined(stored(candidate_pairs(opened), "pairs", files))
        members = opened.filter(~F.col("is_pivot")).select("bucket", "node")
        open_texts = texts.join(undone(members, None).select("node").distinct(), "node")
        shared = shared_shingles(shingle_bags(open_texts, files), files)
        bounds = shared.select("node", "n", "m")
        opened = stored(undone(members, bounds), "near_members", files)
        pivots = stored(closest(opened), "pivots", files)
        roots = joined(stored(pivot_pairs(opened, pivots, threshold), "pairs", files))
        opened = stored(undone(members, bounds), "left_members", files)
        if not opened.isEmpty():
            # Anew, as classes that are joined by now have one text in common that is closest to them all.
            prefixed = prefixes(opened, closest(opened), roots, shared, threshold, files)
            tokens = stored(placed(prefixed, roots), "places", files)
            roots = joined(stored(pairs_left(tokens, threshold), "pairs", files))

    labelled = nodes.select("node", "id").join(roots, "node", "left")
    labelled = labelled.select("node", "id", F.coalesce("root", "node").alias("root"))
    named = labelled.groupBy("root").agg(F.min("id").alias("class_id"))
    named = labelled.join(named, "root").select("node", "root", "class_id")
    return signed.select("doc_id", "node").join(named, "node")


def first_of_each(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    id: str = "doc_id",
    text: str = "text",
    files: int | None = None,
) -> DataFrame:
    """One document of each class, that of the least id and then of the least text digest, with all its columns."""
    found = classes(docs, threshold, id, text, files)
    # By the root, as one id may stand in several classes.
    chosen = (
        found.filter(F.col("class_id").isNull() | (F.col("doc_id") == F.col("class_id")))
        .groupBy("root", F.col("class_id").alias("_id"))
        .agg(F.min("node").alias("_node"))
        .select("_id", "_node")
    )
    row = F.struct(*[column(name) for name in docs.columns]).alias("row")
    whole = F.coalesce(column(text).cast("string"), F.lit(""))
    rows = docs.select(row, column(id).alias("_doc"), F.unhex(F.md5(whole)).alias("_text_node"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_node") == F.col("_node"))
    kept = rows.join(chosen, same, "left_semi")
    # Rows that are equal in id and text, if any, are one document.
    return kept.dropDuplicates(["_doc", "_text_node"]).select("row.*")
