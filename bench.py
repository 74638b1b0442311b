"""Times the registered queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tidemark.plans.queries import QUERIES
from tidemark.workspace import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "cdc_scd1", "latest_per_key_aggregate", "cdc_scd2", "cdc_scd2_hot_keys", "cdc_deletes", "cdc_scd1_stream",
    "snapshot_diff", "snapshot_scd2", "append_dedupe", "append_stream", "read_between", "high_water_mark",
    "next_cursor", "bounded_batch", "assign_pages", "assign_pages_hot", "conform_events", "conform_lenient",
    "conform_nested", "stripe_invoice_items", "github_issues", "expand_children", "nest_children",
    "explode_children", "expand_detail", "unnest_envelope", "page_chain", "falsy_to_null", "rows_present",
    "contract_report", "key_uniqueness", "range_source", "ingest",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    wanted = sys.argv[1:] or HEADLINE
    conf = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    if "BENCH_WORK_DIR" in os.environ:
        conf["spark.checkpoint.dir"] = os.environ["BENCH_WORK_DIR"]
    else:
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = build_session(f"local[{CPUS}]", "tidemark-bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF_DIR}/region.parquet").count()  # start-up is not timed
    times = {}
    for name in wanted:
        run(spark, name)  # warm-up: compile once
        times[name] = round(run(spark, name), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries, warm",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
