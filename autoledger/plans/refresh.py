"""The whole refresh, layer by layer, in the order in which tables feed each other."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..catalog import DATASETS, NO_LIMIT, BatchLimit, Lake
from ..operators import (
    clean_customers,
    rejected_payments,
    rejected_products,
    valid_payments,
    valid_products,
)
from ..sources import FEEDS, stream_feed
from ..streaming import ChangeTarget, Sink, finish, into_sink, into_table
from .curated import curated_360, rebalanced, vehicle_owner

# target table -> (source table, builder)
SILVER_FLOWS = {
    "product_enriched": ("product_bronze", valid_products),
    "product_rejected": ("product_bronze", rejected_products),
    "customer_enriched": ("customer_bronze", clean_customers),
    "payment_enriched": ("payment_bronze", valid_payments),
    "payment_rejected": ("payment_bronze", rejected_payments),
}

PAYMENT_KEY = ("transaction_id",)
# All rows of a micro-batch share the ingest time; the file's time and name order versions within it.
PAYMENT_SEQUENCE = ("silver_ingest_ts", "file_modification_time", "file_name")
VIEW_360_PARTITIONS = DATASETS["curated_360_gold"].partitioned_by


def ingest(
    lake: Lake,
    paths: Mapping[str, str],
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    archive: str | None = None,
) -> None:
    """New files of the named feeds into their bronze tables; with ``archive`` read files move below it."""
    finish(
        [
            into_table(
                lake,
                f"{name}_bronze",
                stream_feed(
                    lake.spark,
                    FEEDS[name],
                    path,
                    files_per_batch,
                    bytes_per_batch,
                    archive and f"{archive}/{name}",
                ),
            )
            for name, path in paths.items()
        ]
    )


def clean(lake: Lake, *names: str, limit: BatchLimit = NO_LIMIT, reject_malformed: bool = False) -> None:
    """New bronze rows into the named silver tables, by default all of them."""
    flows = []
    for name in names or SILVER_FLOWS:
        source, build = SILVER_FLOWS[name]
        # Customers have no rejected side to which a malformed line could go.
        options = {"reject_malformed": True} if reject_malformed and build is not clean_customers else {}
        flows.append(into_table(lake, name, build(lake.stream(source, limit), **options)))
    finish(flows)


def payment_target(lake: Lake) -> ChangeTarget:
    schema = lake.spark.table(lake.table("payment_enriched")).schema
    return ChangeTarget(lake, "payment_streaming", schema, PAYMENT_KEY, PAYMENT_SEQUENCE)


def apply_payment_changes(lake: Lake, limit: BatchLimit = NO_LIMIT) -> None:
    """New valid payments into the view of current transactions."""
    target = payment_target(lake).create()
    finish([target.start(lake.stream("payment_enriched", limit))])
    target.compact_if_due()


def build_vehicle_owner(lake: Lake, newest_product_only: bool = False, spread: bool = True) -> None:
    """The owner table anew. ``spread`` looks for VINs that many customers share and deals them out."""
    customers, products = lake.read("customer_enriched"), lake.read("product_enriched")
    hot_in = customers if spread else None
    lake.save("vehicle_owner", vehicle_owner(customers, products, newest_product_only, hot_in=hot_in))


def extend_curated_360(
    lake: Lake,
    limit: BatchLimit = NO_LIMIT,
    partitioned_by: tuple[str, ...] = VIEW_360_PARTITIONS,
    newest_dimension_only: bool = False,
    spread: bool = True,
) -> None:
    """New valid payments, with the products and customers known now, into the 360 table.

    A payment is looked up once, when it arrives. ``curated_360`` over the whole tables is the backfill.
    ``spread`` looks for hot keys in the payments there are, which hold those that the stream will bring.
    """
    rows = curated_360(
        lake.stream("payment_enriched", limit),
        lake.read("product_enriched"),
        lake.read("customer_enriched"),
        newest_dimension_only=newest_dimension_only,
        hot_in=lake.read("payment_enriched") if spread else None,
    )
    table = "curated_360_gold"
    finish([into_table(lake, table, rebalanced(rows, *partitioned_by), partitioned_by)])


def curated_360_of_current(
    lake: Lake, newest_dimension_only: bool = False, spread: bool = True
) -> DataFrame:
    """The 360 view over the current version of each transaction instead of every version."""
    return curated_360(
        lake.read("payment_streaming"),
        lake.read("product_enriched"),
        lake.read("customer_enriched"),
        newest_dimension_only=newest_dimension_only,
        # Keys are looked for in all versions, a plain scan, and not in the view, which merges them.
        hot_in=lake.read("payment_enriched") if spread else None,
    )


def export_vehicle_owner(
    lake: Lake,
    sink: Sink,
    limit: BatchLimit = NO_LIMIT,
    newest_product_only: bool = False,
    spread: bool = True,
) -> None:
    """New customers, with their products, appended to an external sink.

    The flow reads the customers, which only grow, and not the owner table, which is rewritten: a stream
    over a rewritten table would send all its rows again.
    """
    rows = vehicle_owner(
        lake.stream("customer_enriched", limit),
        lake.read("product_enriched"),
        newest_product_only,
        hot_in=lake.read("customer_enriched") if spread else None,
    )
    finish([into_sink(rows, sink, lake.checkpoint(sink.name))])


def refresh(
    lake: Lake,
    paths: Mapping[str, str],
    owner_sink: Sink | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    archive: str | None = None,
    reject_malformed: bool = False,
    newest_dimension_only: bool = False,
    partitioned_by: tuple[str, ...] = VIEW_360_PARTITIONS,
) -> None:
    """Everything that has arrived, through all layers; the limit bounds each micro-batch of each flow."""
    limit = BatchLimit(files_per_batch, bytes_per_batch)
    lake.create_databases()
    ingest(lake, paths, files_per_batch, bytes_per_batch, archive)
    clean(lake, limit=limit, reject_malformed=reject_malformed)
    apply_payment_changes(lake, limit)
    build_vehicle_owner(lake, newest_dimension_only)
    extend_curated_360(lake, limit, partitioned_by, newest_dimension_only)
    if owner_sink is not None:
        export_vehicle_owner(lake, owner_sink, limit, newest_dimension_only)
