"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads, ``BENCH_QUERIES`` (comma separated, or
``all``) other queries than the headline ones. Every query runs once unmeasured and twice measured,
the better time counts; its whole result is written to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oreflow.registry import all_queries  # noqa: E402
from oreflow.session import build_session  # noqa: E402

HEADLINE = """sales_by_category popular_products monthly_sales top_sales gold_lines order_lines orders_per_customer
dedup_row_number find_duplicates window_means asof_features asof_range_join training_set time_split
update_where merge_upsert score_udf classification_report
stream_tumbling_complete stream_watermark_append ingest_incremental scan_json_nested
asof_one_key schema_evolve_nested stream_progress train_linear ridge_coefficients""".split()


def seconds(spark, run, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session(
        "oreflow-bench",
        f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, queries[name].run, sf_dir)
        times[name] = min(seconds(spark, queries[name].run, sf_dir) for _ in range(2))
    match = re.search(r"sf([0-9.]+)/?$", sf_dir)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(match.group(1)) if match else sf_dir,
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
