"""Line-first quality rules, in DataFrame functions only.

Each line is judged on its own; failing lines are removed; then a document that has lost too much of its text
is rejected, as is one that fails the base rules on its whole text. No row needs another one, so there is no
shuffle, and the work of a row is in proportion to its text (times a logarithm where windows are sorted).

Cases: a null text reads as empty; an empty text has no words and fails the base rules; rows repeated in the
input are repeated in the result; other columns of the input are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, texts_of

# White space between words, and the characters counted as symbols.
SPACES_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# A line holding one of these, in any case, is boilerplate of the page and not text.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "share this page",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)
NAVIGATION_MARKS = "|»›•→"  # the first is counted by pattern, the rest by replacing: see ``measured``
# Ends of sentences in many scripts, and what may close behind them; Java and DuckDB read the patterns alike.
SENTENCE_END = r"""[.!?:;…।॥؟؛۔。．｡！？：；։።፧။។༎\x{061D}\x{037E}]["'”’»)\]」』）】》]*$"""
GOES_ON = r"""^[\x20\x09-\x0D]*["'“‘«(\[]*\p{Ll}"""

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
UNENDED_WORDS = 10
WORDS_A_PHRASE = 20
MAX_LOST_PERCENT = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES_PATTERN), "")


def only(text: Column, characters: str) -> Column:
    """The occurrences of some characters, without what is between them."""
    return F.regexp_replace(text, f"[^{characters}]+", "")


def measured(lines: Column) -> Column:
    """Each line with what the rules ask of it; computed once, as a lambda repeats what it mentions twice."""
    marks = SYMBOLS + "!"  # a pattern class of other than ASCII characters would be fifty times as slow

    def navigation_marks(part: Column) -> Column:
        others = [
            F.char_length(part["line"]) - F.char_length(F.replace(part["line"], F.lit(mark), F.lit("")))
            for mark in NAVIGATION_MARKS[1:]
        ]
        return reduce(add, others, F.char_length(only(part["marks"], NAVIGATION_MARKS[0])))

    split = F.transform(
        lines,
        lambda line: F.struct(
            line.alias("line"), words_of(line).alias("words"), only(line, marks).alias("marks")
        ),
    )
    return F.transform(
        split,
        lambda part: F.struct(
            part["line"].alias("line"),
            F.size(part["words"]).alias("n"),
            F.char_length(F.array_join(part["words"], "")).alias("solid"),
            navigation_marks(part).alias("navigation"),
            F.char_length(only(part["marks"], SYMBOLS)).alias("symbols"),
            F.char_length(only(part["marks"], "!")).alias("shouts"),
            F.try_element_at(part["words"], F.lit(-1)).rlike(SENTENCE_END).alias("ended"),
            F.char_length(F.rtrim(part["line"])).alias("width"),
            F.char_length(F.try_element_at(part["words"], F.lit(1))).alias("first"),
            part["line"].rlike(GOES_ON).alias("goes_on"),
        ),
    )


def wrapped(part: Column, following: Column, widest: Column) -> Column:
    """Whether a line's sentence goes on in the line that follows: that begins in lower case, or its first word
    had no room left in a text whose lines are no wider than ``widest``."""
    no_room = part["width"] + 1 + following["first"] > widest
    return F.coalesce((following["n"] > 0) & (following["goes_on"] | no_room), F.lit(False))


def line_fails(part: Column, is_last: Column, some_boilerplate: Column, is_wrapped: Column) -> Column:
    """Whether a measured line that holds a word is navigation, boilerplate or badly punctuated.

    - navigation: three marks between items or more, and one to every four words or more;
    - boilerplate: one of the phrases of ``BOILERPLATE`` to every twenty words or more, looked for where the
      whole text has one;
    - punctuation: more than a tenth of the line is symbols, there is an exclamation mark to every second
      word, or ten words or more stand there without the end of a sentence. The end of a text may be cut off,
      so its last line needs none, nor does a line that is wrapped.
    """
    n = part["n"]
    navigation = (part["navigation"] >= 3) & (part["navigation"] * 4 >= n)
    n_phrases = F.regexp_count(F.lower(part["line"]), F.lit("|".join(BOILERPLATE)))
    boilerplate = some_boilerplate & (n_phrases * WORDS_A_PHRASE >= n)
    symbols = part["symbols"] * 10 > part["solid"]
    shouting = (n >= 3) & (part["shouts"] * 2 >= n)
    unended = (n >= UNENDED_WORDS) & ~part["ended"] & ~is_last & ~is_wrapped
    return navigation | symbols | shouting | unended | boilerplate


def repeated_words(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside any window of three that occurs twice or more in the text.

    Windows are compared by a 64-bit hash of their words. Sorting them beside their places puts equal ones
    next to each other; most texts have no two equal windows and skip that.
    """
    n_windows = F.col("n_words").cast("int") - (WINDOW - 1)
    places = F.when(n_windows > 0, F.sequence(F.lit(0), n_windows - 1)).otherwise(
        F.array().cast("array<int>")
    )
    hashed = rows.withColumn(
        "_hashes",
        F.transform(
            places, lambda i: F.xxhash64(*[F.get(F.col("_words"), i + step) for step in range(WINDOW)])
        ),
    )
    some_repeat = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.transform("_hashes", lambda value, place: F.struct(value.alias("h"), place.alias("at")))
    ordered = hashed.withColumn("_ordered", F.when(some_repeat, F.sort_array(placed)))
    # Pairs of neighbours in hash order; both places of an equal pair are places of repeated windows.
    size = F.size("_ordered")
    pairs = F.arrays_zip(
        F.slice("_ordered", F.lit(1), size - 1).alias("a"), F.slice("_ordered", F.lit(2), size - 1).alias("b")
    )
    equal = F.filter(pairs, lambda pair: pair["a"]["h"] == pair["b"]["h"])
    found = F.array_distinct(
        F.flatten(F.transform(equal, lambda pair: F.array(pair["a"]["at"], pair["b"]["at"])))
    )
    repeats = ordered.withColumn("_at", F.when(F.col("_ordered").isNotNull(), F.sort_array(found)))
    n_found = F.size("_at")
    steps = F.zip_with(
        F.slice("_at", F.lit(2), n_found - 1),
        F.slice("_at", F.lit(1), n_found - 1),
        lambda later, earlier: F.least(later - earlier, F.lit(WINDOW)).cast("long"),
    )
    covered = F.aggregate(steps, F.lit(WINDOW).cast("long"), lambda total, step: total + step)
    return repeats.withColumn(
        "n_repeat_words", F.when(F.col("_at").isNotNull(), covered).otherwise(F.lit(0).cast("long"))
    ).drop("_hashes", "_ordered", "_at")


def judged(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the counts, the verdicts and ``cleaned``, the text without its failing lines.

    The columns added are named as in ``quality_rules``; ``text`` names a column without nulls.
    """
    whole = F.col(text)
    with_words = rows.withColumn("_words", words_of(whole)).withColumn(
        "n_words", F.size("_words").cast("long")
    )
    lowered = F.lower(whole)
    some_boilerplate = reduce(or_, [F.contains(lowered, F.lit(phrase)) for phrase in BOILERPLATE])
    counted = (
        repeated_words(with_words)
        .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.char_length(only(whole, SYMBOLS)).cast("long"))
        .withColumn("_boilerplate", some_boilerplate)
        .drop("_words")
    )
    widths = F.transform(F.split(whole, "\n"), lambda line: F.char_length(F.rtrim(line)))
    lines = counted.withColumn("_widest", F.array_max(widths)).withColumn("_lines", measured(F.split(whole, "\n")))
    worded = F.transform(F.filter("_lines", lambda part: part["n"] > 0), lambda part: part["line"])
    lines = lines.withColumn("_worded", worded).withColumn(
        "n_dup_lines", (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long")
    )

    def stays(part: Column, place: Column) -> Column:
        is_last = place == F.size("_lines") - 1
        is_wrapped = wrapped(part, F.get("_lines", place + 1), F.col("_widest"))
        return (part["n"] == 0) | ~line_fails(part, is_last, F.col("_boilerplate"), is_wrapped)

    cleaned = lines.withColumn("_kept", F.filter("_lines", stays)).withColumn(
        "cleaned", F.array_join(F.transform("_kept", lambda part: part["line"]), "\n")
    )
    kept_chars = F.aggregate("_kept", F.lit(0).cast("long"), lambda total, part: total + part["solid"])
    lost = F.col("word_chars") - kept_chars
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    verdict = cleaned.withColumn("lost_chars", lost.cast("long")).withColumn("base_failed", base_failed)
    lost_too_much = 100 * F.col("lost_chars") > MAX_LOST_PERCENT * F.col("word_chars")
    verdict = verdict.withColumn("kept", ~F.col("base_failed") & ~lost_too_much)
    # Behind a generator, as Catalyst would copy the expressions above into a filter on the verdict, and into
    # their own lambdas, to be computed once per word.
    added = [name for name in verdict.columns if name not in rows.columns and not name.startswith("_")]
    return verdict.select(*rows.columns, F.inline(F.array(F.struct(*added))))


def quality_rules(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts, ``base_failed``, ``kept`` and ``cleaned``, the text without its failing lines."""
    return judged(texts_of(docs, id, text), "text").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "lost_chars",
        "base_failed",
        "kept",
        "cleaned",
    )


def kept_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that pass, with all their columns and their text cleaned; ``n_chars`` follows the text."""
    whole_row = F.struct(*[column(name) for name in docs.columns]).alias("row")
    rows = docs.select(whole_row, F.coalesce(column(text).cast("string"), F.lit("")).alias("text"))
    passed = judged(rows, "text").filter("kept")
    changed = {text: F.col("cleaned"), n_chars: F.char_length("cleaned")}
    return passed.select(
        *[
            (changed[name].cast(kind) if name in changed else F.col("row")[name]).alias(name)
            for name, kind in docs.dtypes
        ]
    )


# The same in DuckDB. Its regular expressions match bytes of UTF-8 as code points, as Java's do.
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    string_split(t, chr(10)) AS lines,
    regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g') AS solid
  FROM d),
windows AS (
  SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + step) AS n FROM again, (VALUES (0), (1), (2)) AS s(step) GROUP BY r),
line AS (
  SELECT r, lines[i] AS l, coalesce(lines[i + 1], '') AS following, i = len(lines) AS is_last, widest
  FROM (SELECT r, lines, list_max(list_transform(lines, lambda x: length(rtrim(x, ' ')))) AS widest,
      unnest(range(1, len(lines) + 1)) AS i
    FROM w)),
worded AS (
  SELECT r, l, following, is_last, widest, regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g') AS solid,
    list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(regexp_split_to_array(following, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS next_words,
    length(l) - length(translate(l, '{NAVIGATION_MARKS}', '')) AS marks,
    length(l) - length(translate(l, '{SYMBOLS}', '')) AS symbols,
    length(l) - length(replace(l, '!', '')) AS shouts
  FROM line WHERE regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g') <> ''),
verdicts AS (
  SELECT r, l, solid,
    (marks >= 3 AND marks * 4 >= len(words))
    OR len(regexp_extract_all(lower(l), '{"|".join(BOILERPLATE)}')) * {WORDS_A_PHRASE} >= len(words)
    OR symbols * 10 > length(solid)
    OR (len(words) >= 3 AND shouts * 2 >= len(words))
    OR (len(words) >= {UNENDED_WORDS} AND NOT is_last
        AND NOT regexp_matches(words[len(words)], '{SENTENCE_END.replace("'", "''")}')
        AND NOT (len(next_words) > 0 AND (regexp_matches(following, '{GOES_ON.replace("'", "''")}')
          OR length(rtrim(l, ' ')) + 1 + length(next_words[1]) > widest))) AS fails
  FROM worded),
by_line AS (
  SELECT r, count(*) - count(DISTINCT l) AS dups, sum(CASE WHEN fails THEN length(solid) ELSE 0 END) AS lost
  FROM verdicts GROUP BY r),
counts AS (
  SELECT w.r, doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(solid) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(lost, 0) AS BIGINT) AS lost
  FROM w LEFT JOIN covered c USING (r) LEFT JOIN by_line USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
    AND NOT 100 * lost > {MAX_LOST_PERCENT} * word_chars AS kept
FROM counts
"""
