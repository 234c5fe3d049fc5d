"""A refresh killed on its way and started again ends with the rows of an undisturbed one."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import time
from pathlib import Path

import pytest

from acceptance.feeds import feed_rows, write_feed_files
from acceptance.queries import LINEAGE, shown
from autoledger.operators import clean_customers, valid_payments, valid_products
from autoledger.plans import curated_360, vehicle_owner
from autoledger.sources import FEEDS
from autoledger.streaming.changes import BUCKET, ROW_HASH

from .conftest import SMALL, as_set

REPO = Path(__file__).resolve().parent.parent


def start(root: Path, *arguments: str) -> subprocess.Popen:
    feeds = [part for feed in FEEDS for part in (f"--{feed}", f"{root}/landing/{feed}")]
    command = [sys.executable, "-m", "autoledger", "--root", f"{root}/lake", *feeds]
    command += ["--files-per-batch", "1", "--export-path", f"{root}/export", *arguments]
    settings = ("spark.ui.enabled=false", "spark.sql.shuffle.partitions=4", "spark.master=local[4]")
    submit = " ".join([*[f"--conf {setting}" for setting in settings], "pyspark-shell"])
    environment = {**os.environ, "PYSPARK_SUBMIT_ARGS": submit}
    # A group of its own, so that the Java process can be killed with it.
    with open(root / "log.txt", "a") as log:
        return subprocess.Popen(command, cwd=REPO, env=environment, start_new_session=True, stderr=log)


@pytest.mark.parametrize(
    "sign", ["lake/silver/payment_enriched/part-*", "lake/silver/payment_streaming/changes/batch=*/*"]
)
def test_killed_refresh_is_completed_by_the_next(spark, tmp_path, sign):
    for feed in FEEDS:
        write_feed_files(spark, SMALL, feed, f"{tmp_path}/landing/{feed}")
    victim = start(tmp_path)
    deadline = time.monotonic() + 120
    while not list(tmp_path.glob(sign)) and victim.poll() is None and time.monotonic() < deadline:
        time.sleep(0.02)
    assert victim.poll() is None, "the run ended before it could be killed"
    os.killpg(victim.pid, signal.SIGKILL)
    victim.wait()
    assert start(tmp_path).wait(timeout=240) == 0, (tmp_path / "log.txt").read_text()[-2000:]

    payments = valid_payments(feed_rows(spark, SMALL, "payment"))
    products = valid_products(feed_rows(spark, SMALL, "product"))
    customers = clean_customers(feed_rows(spark, SMALL, "customer"))
    folder = tmp_path / "lake"

    def stored(path):
        return shown(spark.read.parquet(str(path)), FEEDS["payment"].capture, *LINEAGE)

    expected = shown(payments, FEEDS["payment"].capture)
    assert as_set(stored(folder / "silver/payment_enriched")) == as_set(expected)
    snapshots = sorted((folder / "silver/payment_streaming/snapshots").iterdir())
    finished = [path for path in snapshots if (path / "_SUCCESS").exists()]
    newest = max(finished, key=lambda path: int(path.name.split("=")[1]))
    assert as_set(stored(newest).drop(ROW_HASH, BUCKET)) == as_set(expected)
    view = shown(curated_360(payments, products, customers))
    gold = spark.read.schema("dealer_id string").parquet(str(folder / "gold/curated_360_gold"))
    assert gold.count() == view.count()
    owners = vehicle_owner(customers, products)
    for path in (folder / "gold/vehicle_owner", tmp_path / "export"):
        assert as_set(spark.read.parquet(str(path)), *owners.columns) == as_set(owners)
