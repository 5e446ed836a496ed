"""Time the registered queries: one JSON line on stdout.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores; names as arguments choose queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from registry.compare import session
from registry.queries import QUERIES


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # Start the JVM's and the Python workers' engines before the first measurement.
    for name in ("loss_profile", "encode_batches"):
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or list(QUERIES):
        begin = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
