"""Benchmark decontamination as a prefix-filtered join of shingles, in DataFrame functions only.

A window is ten consecutive words of an item, or the whole of a shorter one; a document word inside any
occurrence of a window is hit. A window holds shingles of five words. If it occurs in a document, so does its
rarest shingle, at the place the window's start and the shingle's offset give. So:

1. the documents' shingles that are in some item are kept, in one pass over the texts, and counted (map-side
   sums), which orders them by rarity;
2. of each window only the rarest shingle, its prefix, is joined with them;
3. a match must leave room for the whole window in the document (length and position bounds);
4. what is left is compared word by word.

No document is joined to an item without a shared rare shingle, and no hint forces a broadcast: the item side
is broadcast if Spark finds it small, and joined by shuffle, with skewed keys split, if not. Shingles are
compared by a 64-bit hash of their words in lower case, which step 4 makes exact.

Cases: null or empty texts have no words and are never hit; items without words have no windows; repeated
items count by their distinct ids; repeated documents are answered once per row; ids may be null; other
columns are not read. Words are compared in lower case of A-Z only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, stored, texts_of

WINDOW = 10
SHINGLE = 5
# Fixed value: what separates words, before A-Z are put into lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def words_of(text: Column) -> Column:
    """Words as they are compared; ``translate`` goes character by character, so only where it must."""
    return plain_words(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def folded(words: Column) -> Column:
    """Words as they are hashed: equal words stay equal, and a few that differ become equal."""
    return F.transform(words, lambda word: F.lower(word))


def starts(n_words: Column, size: int) -> Column:
    """Places, from 0, at which ``size`` consecutive words begin."""
    last = n_words - size
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def hashes(words: Column, at: Column, size: int) -> Column:
    return F.transform(
        at, lambda i: F.xxhash64(F.lit(size), *[F.get(words, i + step) for step in range(size)])
    )


def windows_of(items: DataFrame) -> DataFrame:
    """Distinct windows: ``words``, their number ``n``, and a row per shingle with its ``hash`` and ``offset``.

    A window of fewer than five words is its own only shingle.
    """
    windows = item_windows(items).select("words").distinct().withColumn("n", F.size("words"))
    by_size = []
    for size in range(1, SHINGLE + 1):
        some = windows.filter(F.col("n") == size if size < SHINGLE else F.col("n") >= size)
        some = some.withColumn("folded", folded(F.col("words")))
        shingles = F.posexplode(hashes(F.col("folded"), starts(F.col("n"), size), size))
        by_size.append(some.select("words", "n", shingles.alias("offset", "hash")))
    whole = by_size[0]
    for rows in by_size[1:]:
        whole = whole.unionAll(rows)
    return whole


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id`` and ``words`` of each window."""
    split = items.withColumn("all", words_of(F.col("text"))).withColumn("n", F.size("all"))
    long_ones = F.transform(starts(F.col("n"), WINDOW), lambda i: F.slice("all", i + 1, F.lit(WINDOW)))
    windows = F.when(F.col("n") >= WINDOW, long_ones).otherwise(F.array("all"))
    return split.filter("n > 0").select("item_id", F.explode(windows).alias("words"))


def document_shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), place ``at`` and ``hash`` of each shingle."""
    split = docs.select("doc_id", "mark", folded(plain_words(F.col("text"))).alias("words")).withColumn(
        "n_words", F.size("words")
    )
    parts = [hashes(F.col("words"), starts(F.col("n_words"), size), size) for size in sizes]
    whole = None
    for part in parts:
        rows = split.select("doc_id", "mark", "n_words", F.posexplode(part).alias("at", "hash"))
        whole = rows if whole is None else whole.unionAll(rows)
    return whole


def contaminated_words(docs: DataFrame, items: DataFrame, files: int | None = None) -> DataFrame:
    """Per row of ``doc_id`` and ``text``: ``n_words`` and ``hits``, structs of place, length and window.

    Rows carry ``mark``, a hash of the text, so that with ``doc_id`` equal rows and only these fall together.
    """
    marked = docs.withColumn("mark", F.xxhash64("text"))
    windows = stored(windows_of(items), "windows", files)
    # At most five different sizes, whatever the number of items.
    sizes = sorted(
        row.size for row in windows.select(F.least("n", F.lit(SHINGLE)).alias("size")).distinct().collect()
    )
    if not sizes:
        none = F.array().cast("array<struct<at:int,n:int,words:array<string>>>")
        return marked.select(
            "doc_id", "mark", F.size(plain_words(F.col("text"))).alias("n_words"), none.alias("hits")
        )
    known = windows.select("hash").distinct()
    shingles = document_shingles(marked, sizes).join(known, "hash", "left_semi")
    shingles = stored(shingles, "shingles", files)
    counted = shingles.groupBy("hash").agg(F.count("*").alias("n_found"))
    # A shingle that no document holds rules its window out; else the rarest is the prefix.
    ranked = windows.join(counted, "hash", "left")
    rarity = F.struct(F.coalesce("n_found", F.lit(0)).alias("n_found"), "hash", "offset")
    prefixes = (
        ranked.groupBy("words", "n").agg(F.min(rarity).alias("prefix")).filter("prefix.n_found > 0")
    ).select("words", "n", "prefix.hash", "prefix.offset")
    prefixes = stored(prefixes, "prefixes", files)
    start = F.col("at") - F.col("offset")
    candidates = (
        shingles.join(prefixes, "hash")
        .withColumn("start", start)
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "start", "n", "words")
    )
    # No more than the places of a document times the windows that share one prefix.
    by_document = candidates.groupBy("_id", "_mark").agg(
        F.collect_set(F.struct(F.col("start").alias("at"), "n", "words")).alias("candidates")
    )
    checked = marked.join(
        by_document,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")),
        "left",
    ).withColumn("all", F.when(F.col("candidates").isNotNull(), words_of(F.col("text"))))
    occurs = F.filter("candidates", lambda c: F.slice(F.col("all"), c["at"] + 1, c["n"]) == c["words"])
    n_words = F.size(plain_words(F.col("text")))
    hits = F.coalesce(occurs, F.array().cast("array<struct<at:int,n:int,words:array<string>>>"))
    return checked.select("doc_id", "mark", n_words.alias("n_words"), hits.alias("hits"))


def decontamination(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """Per document row: ``n_words``, ``n_hit``, ``items`` (sorted ids as text), ``contaminated``."""
    items = items.select(
        column(item_id).cast("string").alias("item_id"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
    )
    found = stored(contaminated_words(texts_of(docs, id, text), items), "contaminated_words")
    spans = F.transform("hits", lambda hit: F.sequence(hit["at"], hit["at"] + hit["n"] - 1))
    n_hit = F.size(F.array_distinct(F.flatten(spans)))
    windows = F.array_distinct(F.transform("hits", lambda hit: hit["words"]))
    # Rows without hits need no join; equal rows are asked about once.
    asked = (
        found.filter(F.size("hits") > 0)
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), windows.alias("windows"))
        .dropDuplicates(["_id", "_mark"])
        .select("_id", "_mark", F.explode("windows").alias("words"))
    )
    holders = item_windows(items).filter("item_id is not null").distinct()
    by_document = (
        asked.join(holders, "words")
        .groupBy("_id", "_mark")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return found.join(
        by_document,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")),
        "left",
    ).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", files: int | None = None
) -> DataFrame:
    """The documents no word of which is hit, with all their columns; working tables go into ``files``."""
    row = F.struct(*[column(name) for name in docs.columns]).alias("row")
    rows = docs.select(
        row, column(id).alias("doc_id"), F.coalesce(column(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    dirty = (
        contaminated_words(rows.select("doc_id", "text"), items, files)
        .filter(F.size("hits") > 0)
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return rows.join(dirty, same, "left_anti").select("row.*")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[s:s + least(10, len(w)) - 1] AS win, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
place AS (
  SELECT r, s, n, w[s:s + n - 1] AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win)
        WHERE len(w) >= n)),
hit AS (SELECT r, s, place.n AS n, item_id FROM place JOIN win USING (win)),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
held AS (
  SELECT r, count(DISTINCT item_id) AS n,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(held.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN held USING (r)
"""
