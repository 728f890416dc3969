"""Times the headline queries and the load paths; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from sluiceway.plans import fixtures as X  # noqa: E402
from sluiceway.plans import queries as Q  # noqa: E402
from sluiceway.sources.lines import text_stream  # noqa: E402
from sluiceway.streaming.loader import configure, load_lines, run_stream  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "parse_good_bad", "entity_counts", "strict_cast_int", "cast_all_types", "transform_rows", "transform_nested",
    "failed_records", "row_conformance", "summary_of_batch",
)
OPTIONS = {**X.LAYOUT, "exit_on_missing_schema": False, "skip_schemas": X.SKIP, "legacy_schemas": X.LEGACY}


def timed(action) -> float:
    """Median of the runs after one warm-up."""
    seconds = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(sorted(seconds[1:])[RUNS // 2], 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("sluiceway-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(CPUS)).config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    work = tempfile.mkdtemp(prefix="sluiceway-bench-")
    # The tables have one row group each, which one core would read alone; the queries read copies in one file a core or more. Not timed.
    tables = f"{work}/tables"
    for name in ("events", "lineitem"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(max(8, CPUS)).write.parquet(f"{tables}/{name}.parquet")
    n_rows = X.table(spark, tables, "events").count()
    catalogue = Q.all_queries()
    registry = Q._registry(spark)
    times = {
        name: timed(lambda f=catalogue[name]: f(spark, tables).write.format("noop").mode("overwrite").save())
        for name in HEADLINE
    }
    # The load paths read lines from files, as a loader does.
    X.enriched_lines(spark, tables).repartition(CPUS).write.text(f"{work}/lines")
    counter = iter(range(1000))

    def append() -> None:
        lines = spark.read.option("lineSep", "\n").text(f"{work}/lines")
        load_lines(lines, f"bench-{next(counter)}", f"{work}/append", registry, X.ATOMIC, Q.LOAD_TSTAMP, **OPTIONS)

    def stream() -> None:
        run = f"{work}/stream-{next(counter)}"
        query = run_stream(text_stream(spark, f"{work}/lines", 100_000_000), f"{run}/table", registry, X.ATOMIC,
                           f"{run}/checkpoint", trigger={"availableNow": True}, **OPTIONS)
        query.awaitTermination()

    times["load_batch"] = timed(append)
    times["load_stream"] = timed(stream)
    rate = {k: round(n_rows / times[k]) for k in ("parse_good_bad", "transform_rows", "load_batch", "load_stream")}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": CPUS, "input_files": max(8, CPUS), "events": n_rows, "events_per_sec": rate,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
