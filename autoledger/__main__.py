"""``spark-submit`` entry: one refresh of a lake.

    python -m autoledger --root /lake --product /in/product --customer /in/customer --payment /in/payment
"""

from __future__ import annotations

import argparse

from .catalog import Lake
from .plans.refresh import VIEW_360_PARTITIONS, refresh
from .session import session
from .sources import FEEDS
from .streaming import Sink


def main() -> None:
    parser = argparse.ArgumentParser(prog="autoledger")
    parser.add_argument("--root", required=True, help="folder of the lake, shared by all executors")
    for feed in FEEDS:
        parser.add_argument(f"--{feed}", help=f"folder of the {feed} files")
    parser.add_argument("--format", default="parquet", help="table format")
    parser.add_argument("--export-path", help="folder to which new vehicle owners are appended")
    parser.add_argument("--export-format", default="parquet")
    limit = parser.add_mutually_exclusive_group()
    limit.add_argument("--bytes-per-batch", help="size of a micro-batch of any flow, such as 500g")
    limit.add_argument("--files-per-batch", type=int, help="number of files in a micro-batch of any flow")
    parser.add_argument("--archive", help="folder to which feed files move once they are read")
    parser.add_argument("--reject-malformed", action="store_true", help="malformed lines fail the quality rules")
    parser.add_argument(
        "--newest-dimension-only", action="store_true", help="look up only the newest row of a key"
    )
    parser.add_argument(
        "--partitioned-by", nargs="+", default=VIEW_360_PARTITIONS, help="columns that partition the 360 table"
    )
    arguments = parser.parse_args()

    paths = {feed: getattr(arguments, feed) for feed in FEEDS if getattr(arguments, feed)}
    sink = None
    if arguments.export_path:
        options = {"path": arguments.export_path}
        sink = Sink("vehicle_owner_export", arguments.export_format, options)
    lake = Lake(session("autoledger"), arguments.root, table_format=arguments.format)
    refresh(
        lake,
        paths,
        owner_sink=sink,
        files_per_batch=arguments.files_per_batch,
        bytes_per_batch=arguments.bytes_per_batch,
        archive=arguments.archive,
        reject_malformed=arguments.reject_malformed,
        newest_dimension_only=arguments.newest_dimension_only,
        partitioned_by=tuple(arguments.partitioned_by),
    )


if __name__ == "__main__":
    main()
