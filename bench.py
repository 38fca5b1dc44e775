"""Seconds per headline query, as one line of JSON.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.  Every query runs in
full into a sink that drops the rows; the first run of each pays for its plan and
generated code, so the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from narrowlake.functions.cells import encode_cell  # noqa: E402
from narrowlake.model import COLLECTIONS  # noqa: E402
from narrowlake.operators import pivots  # noqa: E402
from narrowlake.registry import QUERIES  # noqa: E402
from narrowlake.session import build_session  # noqa: E402
from narrowlake.sources import trade  # noqa: E402

HEADLINE = [
    "wide_encoded",
    "wide_encoded_multi",
    "wide_encoded_80",
    "wide_encoded_550",
    "wide_encoded_1900",
    "wide_kv",
    "wide_api",
    "wide_composite",
    "unpivot_roundtrip",
    "items_by_series",
    "cross_series_join",
    "items_schedule_join",
    "report_items",
    "item_desc_lookup",
    "latest_submission",
    "filing_summary",
    "daily_summary",
    "rows_by_partition",
    "compare_outputs",
    "duplicate_items",
    "csv_strict",
    "csv_text_roundtrip",
]
RUNS = 2


def filings_of(width: int):
    """Full filings, each with few of very many columns."""

    def run(spark, folder):
        rows = trade.coded_collections(spark, folder, width).where(F.col("seriesid") == "FRY9C")
        codes = pivots.discover_codes(rows, COLLECTIONS.item)
        return pivots.pivot(
            rows, encode_cell(), codes, keys=["seriesid", "aod", "rssdid"], item=COLLECTIONS.item
        )

    return run


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "narrowlake-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = set(sys.argv[1:])
    jobs = {name: QUERIES[name] for name in HEADLINE}
    jobs["sparse_filings_550"] = filings_of(550)
    timings: dict[str, float] = {}
    for name, job in jobs.items():
        if wanted and name not in wanted:
            continue
        for _ in range(RUNS):
            start = time.perf_counter()
            job(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            timings[name] = round(min(took, timings.get(name, took)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
