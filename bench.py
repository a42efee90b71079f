"""Seconds per query, written to the no-op sink so that every row is computed.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names; default all but LONG). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from depthgrid.queries import QUERIES
from depthgrid.session import build_session


#: Fits with the whole configuration, minutes each, and the search of 56 fits; ``boost_tweedie`` stands for them.
LONG = ("boost_squared", "boost_history", "score_testset", "hyper_search")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [
        n for n in QUERIES if n not in LONG
    ]
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="depthgrid-bench-")
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["metrics_by_group"](spark, folder).collect()  # JVM warm-up
    seconds: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
