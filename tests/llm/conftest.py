from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sql_rows():
    """Rows of a query in DuckDB over the small tables, as texts in sorted order."""
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")

    def rows(sql: str, columns: list[str]) -> list[str]:
        return sorted(map(repr, connection.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()))

    return rows


#: Nulls in both columns, empty and white texts, repeats, ties, one very long text, a clashing extra column.
def awkward_rows() -> list[tuple]:
    long_text = "word other third. " * 4000
    return [
        (1, None, "en", "s", 0),
        (2, "", "en", "s", 0),
        (3, "  \n\t ", "en", None, None),
        (4, "one", None, "s", 3),
        (4, "one", None, "s", 3),
        (5, "one", "en", "s", 3),
        (None, "some text with no id at all", "en", "s", 1),
        (None, None, "en", "s", 1),
        (6, long_text, "en", "s", len(long_text)),
        (7, "naïve Ünïcode 日本語 🙂 text", "en", "s", 1),
    ]


AWKWARD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), AWKWARD_SCHEMA)


@pytest.fixture
def awkward_wide(awkward):
    """The same with columns named as operators name their own."""
    from pyspark.sql import functions as F

    own = ("node", "mark", "kept", "words", "_id", "row", "n_words", "part", "digest", "block")
    return awkward.withColumns({name: F.lit("x") for name in own})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], AWKWARD_SCHEMA)
