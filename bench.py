"""Time every registered query on one machine; prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the cores. Results go to Spark's no-op sink, so every column of
every row is computed and none is collected. Each query runs once to warm up and is then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tradewatch.queries import queries
from tradewatch.session import local_session


def run(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = set(sys.argv[1:])
    spark = local_session(cores)
    timings = {}
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        run(query, spark, sf_dir)
        timings[name] = round(run(query, spark, sf_dir), 3)
    spark.stop()
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of all registered queries",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
