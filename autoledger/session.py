"""Session settings the flows rely on, and the shared folder for working tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot leaves methods beyond 8000 bytes of code uncompiled; a stage of so many expressions runs
    # faster as smaller generated functions.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """The limit of ``SETTINGS`` on generated functions, for jobs inside, whatever the session was started with."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """The name of a fresh folder that every executor can reach.

    It lies in the folder named by ``spark.checkpoint.dir``, or else in the warehouse, which executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/autoledger-{uuid.uuid4().hex}"
