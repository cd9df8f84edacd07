"""Times the registered queries on one data folder and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from replyloom.plans.queries import QUERIES
from replyloom.session import drop_stages, local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = local_session(CPUS, "replyloom-bench", os.environ.get("BENCH_MEMORY", "8g"))
    # The first query pays for starting Spark and compiling; it runs once before the clock starts.
    QUERIES["response_type"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(QUERIES)
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        # The noop sink runs the whole query without pulling rows to the driver.
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        drop_stages(spark)
    total = round(sum(seconds.values()), 3)
    report = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cores": CPUS,
        "spark": spark.version,
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
