"""Time every registered query and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads, ``BENCH_RUNS`` the timed
runs per query (the median counts) and ``BENCH_QUERIES`` a comma list to limit the run.
All rows are produced and dropped by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session, clear_scratch  # noqa: E402


def session(cpus: int) -> SparkSession:
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(QUERIES)
    spark = session(cpus)
    timed(spark, "flow_borough", sf_dir)  # start-up cost is not a query's
    seconds = {
        name: round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3) for name in names
    }
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
