"""Run named queries against their SQL: ``python tests/check_oracles.py [folder] [name ...]``."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from comparing import connect, difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from trolley.registry import ORACLES, QUERIES  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = difference(result, connection, ORACLES[name])
                state = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                state = f"rows {result.count()}"
        except Exception as error:
            traceback.print_exc(limit=3)
            state = f"ERROR {type(error).__name__} {str(error)[:300]}"
        bad += state.startswith(("DIFFERS", "ERROR"))
        print(f"{name:32s} {time.time() - start:6.1f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad; no SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
