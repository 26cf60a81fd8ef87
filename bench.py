"""Times all queries of the reference's operators and prints one JSON line.

Every query runs to the end over whole tables: its rows go to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import time

from costledger.plans.queries import QUERIES
from costledger.session import build_session

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark_ui_showConsoleProgress="false", spark_driver_memory="16g")
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("tx_clean", "redacted_reference"):  # starts the Python workers and compiles the common paths
        run(name)
    seconds = {name: round(run(name), 3) for name in QUERIES}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total time of the queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
