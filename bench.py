"""Wall time of the library's queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma separated) a selection. Each query runs once to warm up and then BENCH_RUNS times; the median
counts.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from equifacts.bindings import QUERIES  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("equifacts-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="equifacts-bench-"))
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark, name) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = chosen.split(",") if chosen else sorted(QUERIES)
    seconds = {}
    for name in names:
        timed(spark, name)
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(FOLDER).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
