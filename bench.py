"""Time every checked query at one scale and print one JSON line.

Each query runs twice into a sink that drops its rows.  ``queries`` has the better time,
which tells about the query and not about the first use of the JVM; ``cold`` has the
first.  Two more entries follow the published figures: a warm filtered look-up and a
conversion of CSV to clean Parquet, with their rows per second.
"""

from __future__ import annotations

import dataclasses
import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

RUNS = 2


def headline(spark, folder: str, timed, times: dict[str, float]) -> dict[str, int]:
    """Filtered look-up and conversion over the largest table; rows per second of each."""
    from pyspark.sql import functions as F

    from musterroll import Catalog, Engine
    from musterroll.specs.tables import LINEITEM

    path = f"{folder.rstrip('/')}/lineitem.parquet"
    lines = spark.read.parquet(path)
    rows = lines.count()
    scratch = tempfile.mkdtemp(prefix="musterroll-bench-")
    engine = Engine(spark, Catalog([LINEITEM])).bind("LINEITEM", path)
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in lines.columns])
    text.write.option("header", True).mode("overwrite").csv(f"{scratch}/csv")
    timed("lookup_latest_5", lambda: engine.latest("LINEITEM", {"ship_date": "1996-0"}, limit=5).collect())
    converter = Engine(spark, Catalog([dataclasses.replace(LINEITEM, multiline=False)]))
    timed("convert_csv", lambda: converter.ingest("LINEITEM", f"{scratch}/csv", f"{scratch}/clean"))
    return {k: round(rows / times[k]) for k in ("lookup_latest_5", "convert_csv")}


def main() -> None:
    from pyspark.sql import SparkSession

    from musterroll.session import configure
    from musterroll.workload import CHECKS

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"))
        .appName("musterroll-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="musterroll-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(CHECKS)
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    CHECKS["filter_and"].run(spark, folder).write.format("noop").mode("overwrite").save()

    def timed(name: str, run: Callable[[], object]) -> None:
        for turn in range(RUNS):
            start = time.perf_counter()
            run()
            took = round(time.perf_counter() - start, 3)
            if turn == 0:
                cold[name] = took
            times[name] = min(took, times.get(name, took))

    for name in wanted:
        timed(name, lambda name=name: CHECKS[name].run(spark, folder).write.format("noop").mode("overwrite").save())
    rates: dict[str, int] = {}
    if not sys.argv[1:]:
        rates = headline(spark, folder, timed, times)
    spark.stop()
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({
        "metric": "total time of all checked queries, best of two runs each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "rows_per_second": rates,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
