"""Times the batch steps at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The steps are those of the published baseline run: inventory, profiling, fact build,
publication, marts, classification, contracts, quality, monitoring, catalog, SQL reports
and BI export, each from files to files.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
from datetime import datetime, timezone
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tradeledger.plans.batch import Run, run_all  # noqa: E402
from tradeledger.session import build_session  # noqa: E402
from tradeledger.sources.commerce import commerce  # noqa: E402


def main() -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    layers = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")  # a local session only
    seconds = run_all(
        Run(
            spark=spark,
            source=commerce(spark, source),
            root=layers,
            as_of=datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
            min_rows=1,
            tier_bounds=(490, 560, 610),
            staged=False,
        )
    )
    line = {
        "metric": "batch_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(source).name.removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
