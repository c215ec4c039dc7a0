"""Time the named queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the folder with the tables, ``BENCH_CPUS`` the cores.
Names given as arguments limit the run to those queries. The stored relation is
built first and timed on its own; every query is run once and fully consumed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from trolley.registry import QUERIES  # noqa: E402
from trolley.sources.prepared import stored_keyed_lines, stored_lines  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()  # start-up is not part of any query

    seconds: dict[str, float] = {}

    def timed(name, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    timed("build_relation", lambda: stored_lines(spark, folder))
    timed("build_keyed_relation", lambda: stored_keyed_lines(spark, folder))
    # Workflows repeat what the other queries time one by one.
    for name in sys.argv[1:] or [q for q in QUERIES if not q.endswith("_workflow")]:
        timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())

    result = {
        "metric": "total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
