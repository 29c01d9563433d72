"""Time the registered queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` (optional) a
comma-separated choice. Every query writes all of its rows to Spark's no-op sink, once over the
smallest tables beside those of the folder to warm up, and once for the clock.
"""

from __future__ import annotations

import json
import os
import time

from tidemark import build_session
from tidemark.session import clean_scratch
from workload import QUERIES

# The flagship path: records in, typed rows, merged table out.
FLOW = ("flatten_props", "upsert_then_tombstone")


def seconds(run) -> float:
    started = time.monotonic()
    run().write.format("noop").mode("overwrite").save()
    return time.monotonic() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = [n for n in chosen.split(",") if n] or list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed: dict[str, float] = {}
    beside = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    small = beside if os.path.isdir(beside) else folder
    seconds(lambda: QUERIES["latest_per_user"](spark, folder))
    for name in names:
        seconds(lambda: QUERIES[name](spark, small))
        timed[name] = round(seconds(lambda: QUERIES[name](spark, folder)), 3)
        clean_scratch(spark)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    orders = spark.read.parquet(f"{folder}/orders.parquet").count()
    rates = {
        name: round(rows / timed[name])
        for name, rows in zip(FLOW, (events, orders))
        if name in timed
    }
    print(
        json.dumps(
            {
                "metric": "all registered queries, whole results",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "records_per_sec": rates,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
