"""Feed files are written evenly, by functions short enough to be compiled."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

from acceptance import feeds, queries
from autoledger.session import METHOD_LIMIT, SETTINGS, small_methods


def orders(path, n):
    sql = f"""COPY (SELECT range AS o_orderkey, range % 7 AS o_custkey, 'O' AS o_orderstatus, 1.5::DOUBLE AS o_totalprice,
      TIMESTAMP '2020-01-01' AS o_orderdate FROM range({n})) TO '{path}/orders.parquet' (FORMAT parquet, ROW_GROUP_SIZE 1000000)"""
    duckdb.sql(sql)


def test_one_row_group_is_written_by_every_task(spark, tmp_path):
    orders(tmp_path, 8000)
    tasks = feeds.write_feed_files(spark, str(tmp_path), "payment", str(tmp_path / "out"), 3)
    assert tasks == spark.sparkContext.defaultParallelism == 4
    lines = [file.read_text().splitlines() for file in Path(tmp_path / "out").glob("part-*")]
    assert [len(part) for part in lines] == [2000] * 4
    expected = duckdb.sql(f"SELECT {feeds.line_sql('payment', False)} FROM '{tmp_path}/orders.parquet'").fetchall()
    assert Counter(line for part in lines for line in part) == Counter(line for (line,) in expected)


def test_the_limit_on_methods_holds_inside_only(spark, settings, tmp_path):
    settings(spark__sql__codegen__hugeMethodLimit="65535")
    seen = []
    try:
        with small_methods(spark):
            seen.append(spark.conf.get(METHOD_LIMIT))
            raise ValueError
    except ValueError:
        seen.append(spark.conf.get(METHOD_LIMIT))
    assert seen == [SETTINGS[METHOD_LIMIT], "65535"]


def test_lineage_compares_digests_of_lines(spark, tmp_path):
    """Equal lines count as often as they stand in their file, and lines are not shuffled whole."""
    orders(tmp_path, 100)
    for table, key in (("customer", "c"), ("part", "p")):
        duckdb.sql(f"COPY (SELECT * FROM '/root/testdata/sf0.001/{table}.parquet' LIMIT 20) TO '{tmp_path}/{table}.parquet'")
    duckdb.sql(f"COPY (SELECT o.* FROM '{tmp_path}/orders.parquet' o, range(3)) TO '{tmp_path}/thrice.parquet'")
    (tmp_path / "thrice.parquet").replace(tmp_path / "orders.parquet")
    rows = queries.file_lineage(spark, str(tmp_path))
    assert "sha2(" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {row.feed: (row.total_rows, row.in_their_file) for row in rows.collect()} == {
        "payment": (300, 300),
        "customer": (20, 20),
        "product": (20, 20),
    }
