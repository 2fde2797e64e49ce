"""Time every registered query at one scale and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import REGISTRY  # noqa: E402
from palaver.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if "BENCH_QUERIES" in os.environ else None
    spark = local_session(cores, shuffle_partitions=cores, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["total_messages"](spark, sf_dir).collect()  # start the workers once
    seconds = {}
    for name in names or REGISTRY:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
