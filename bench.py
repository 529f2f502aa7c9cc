"""Time every registered query on local Spark; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Results go to the ``noop`` sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from daybook.queries import QUERIES
from daybook.session import local_session

RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="daybook-bench")
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(QUERIES)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in wanted:
        run(name)
        taken = [run(name) for _ in range(RUNS)]
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
