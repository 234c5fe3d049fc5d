"""Times every acceptance query: one warm-up, then the median of the timed runs.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local threads. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from acceptance.queries import queries
from autoledger.session import session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
BATCH_RUNS = 3
STREAM_RUNS = 1


def is_stream(name: str) -> bool:
    """These write feed files and run flows; they take seconds, and one timed run is steady enough."""
    parts = ("stream", "malformed", "bronze", "_export", "_table", "_of_current")
    return any(part in name for part in parts)


def scale_factor() -> float | str:
    name = Path(SF_DIR).name.removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    spark = session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": str(2 * int(CPUS)),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name, query in queries().items():
        seconds = []
        for run in range(1 + (STREAM_RUNS if is_stream(name) else BATCH_RUNS)):
            start = time.perf_counter()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            if run:
                seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": scale_factor(),
            }
        )
    )


if __name__ == "__main__":
    main()
