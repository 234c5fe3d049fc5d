"""The tab-separated reader on well-formed, short, long and blank lines."""

from __future__ import annotations

import pytest

from autoledger.plans.refresh import ingest
from autoledger.sources import CUSTOMER, PAYMENT, PRODUCT, malformed, read_feed, well_formed

GOOD = "D-1\tG\tACME\tAcme-Ltd\ta@b\tS1\tVIN"
LINES = [
    GOOD,
    "D-1\tG\tACME",
    GOOD + "\textra",
    "",
    "D-2\t\tACME\t\t\t\t",
    'D-3\t"q""x"\tACME\tL\tE\tS\tV',
    "  D-4 \tG\tM\tL\tE\tS\tV",
]


@pytest.fixture
def products(tmp_path):
    folder = tmp_path / "product"
    folder.mkdir()
    (folder / "a.tsv").write_text("\n".join(LINES) + "\n")
    return str(folder)


def parsed(rows):
    names = [*PRODUCT.fields, PRODUCT.capture]
    return {tuple(row) for row in rows.select(*names).collect()}


EXPECTED = {
    ("D-1", "G", "ACME", "Acme-Ltd", "a@b", "S1", "VIN", None),
    ("D-1", "G", "ACME", None, None, None, None, LINES[1]),
    ("D-1", "G", "ACME", "Acme-Ltd", "a@b", "S1", "VIN", LINES[2]),
    ("D-2", None, "ACME", None, None, None, None, None),
    ("D-3", '"q""x"', "ACME", "L", "E", "S", "V", None),
    ("  D-4 ", "G", "M", "L", "E", "S", "V", None),
}


def test_batch_read(spark, products):
    rows = read_feed(spark, PRODUCT, products)
    assert rows.columns == [*PRODUCT.schema.names, "file_name", "bronze_ingest_timestamp"]
    assert parsed(rows) == EXPECTED


def test_stream_reads_the_same_and_keeps_the_file_name(lake, products):
    ingest(lake, {"product": products})
    bronze = lake.read("product_bronze")
    assert len(bronze.columns) == 10
    assert parsed(bronze) == EXPECTED
    assert {row.file_name for row in bronze.select("file_name").collect()} == {"a.tsv"}
    assert bronze.filter("bronze_ingest_timestamp IS NULL").count() == 0
    assert malformed(bronze, PRODUCT).count() == 2
    assert well_formed(bronze, PRODUCT).count() == 4


def test_field_counts():
    assert [len(feed.fields) for feed in (PRODUCT, CUSTOMER, PAYMENT)] == [7, 27, 28]
    assert {type(field.dataType).__name__ for field in PAYMENT.schema} == {"StringType"}


def test_malformed_payment_is_marked_and_not_taken_as_data(lake, tmp_path):
    folder = tmp_path / "payment"
    folder.mkdir()
    fields = [f"f{position}" for position in range(len(PAYMENT.fields))]
    lines = ["\t".join(fields), "\t".join([*fields, "extra"]), "\t".join(fields[:5])]
    (folder / "p.tsv").write_text("\n".join(lines) + "\n")
    ingest(lake, {"payment": str(folder)})
    marks = [row[0] for row in lake.read("payment_bronze").select(PAYMENT.capture).collect()]
    assert sorted(mark or "" for mark in marks) == sorted(["", lines[1], lines[2]])
