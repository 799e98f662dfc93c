"""Time the catalogue queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is computed in full (all rows and columns, to Spark's no-op sink), after one warm-up. The
full load is timed by its steps, without the time it takes to derive its raw files.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom.catalog import QUERIES, warehouse  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def run(spark, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def load_steps(spark) -> dict[str, float]:
    _, seconds = warehouse.loaded(spark, FOLDER)
    return {f"load {step}": round(s, 3) for step, s in seconds.items()}


def main() -> None:
    names = sys.argv[1:] or [n for n in QUERIES if n not in warehouse.TARGET_QUERIES]
    spark = local_session("ledgerloom-bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("scd2_build", "star_lookup", "upsert_additive"):
        run(spark, name)
    seconds = {name: round(run(spark, name), 3) for name in names}
    if not sys.argv[1:]:
        seconds |= load_steps(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "catalogue_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
