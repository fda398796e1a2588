"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; its whole result is produced (written
to the no-op sink) and the median counts. The value is the sum of the medians. Test workbooks are
made in the warm-up and used again, so that the clock measures the jobs that read them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcount.session import build_session  # noqa: E402
from shelfcount_checks import files  # noqa: E402
from shelfcount_checks.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "variance_analysis",
    "variance_kpi",
    "variance_to_sales",
    "store_report",
    "dept_report",
    "sku_ranking",
    "snapshot_blocked_vendors",
    "year_start",
    "missrate_simple",
    "missrate_reconciled",
    "planned_only",
    "not_loaded",
    "matches_filename",
    "rejoin_latest",
    "visit_rank",
    "sequence_in_group",
    "lookup_two_step",
    "overlay_totals",
    "replace_keys",
    "insert_new_or_reload",
    "archive_new",
    "unpivot_barcodes",
    "checklist_score",
    "posting_age",
    "upload_inbox",
    "snapshot_from_file",
    "store_summary",
    "approved_rows",
    "import_approved",
    "report_reload",
    "load_master",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    wanted = [q for q in HEADLINE if not sys.argv[1:] or q in sys.argv[1:]]
    files.kept_books = {}
    times = {}
    for name in wanted:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(3)), 3)
    size = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(size) if size.replace(".", "", 1).isdigit() else size,
            }
        )
    )


if __name__ == "__main__":
    main()
