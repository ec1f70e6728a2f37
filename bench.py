"""Time the headline queries and the feed-to-final job; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plotwise.plans import job  # noqa: E402
from plotwise.session import get_session  # noqa: E402
from plotwise.sources import feeds  # noqa: E402
from plotwise.suite import job as feed_queries  # noqa: E402
from plotwise.suite.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "listing_job", "dedup_first", "dedup_two_pass", "impute_median", "trim_p99", "histogram20", "kpis", "by_type",
    "monthly_avg", "avg_by_group", "type_share", "listing_page", "search", "top20", "sample_hash", "parse_price",
    "parse_dates", "numeric_repair", "spam_filter", "dup_count", "profile", "quality_checks", "eval_metrics",
    "html_fields", "text_cleanup", "iqr_filter", "step_audit", "run_report", "fuzzy_dedup", "csv_round_trip",
]
#: Modelling; once each, as they take long.
MODELS = ["train_lr", "train_rf", "train_gbt"]


def feeds_to_final(spark, paths: dict[str, str]) -> float:
    """Seconds from CSV feeds to the final table: cleaning and transformation."""
    start = time.perf_counter()
    tables = job.listing_tables(feeds.load_feeds(spark, paths), feed_queries.AS_OF)
    tables.final.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="plotwise-bench-")
    spark = get_session("plotwise-bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.checkpoint.dir": scratch})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    try:
        paths = feed_queries.write_feeds(spark, folder, f"{scratch}/feeds")  # not timed
        rows = feeds.load_feeds(spark, paths).count()
        seconds["feeds_to_final"] = min(feeds_to_final(spark, paths) for _ in range(3))
        for name in HEADLINE:
            best = None
            for _ in range(2):
                start = time.perf_counter()
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                took = time.perf_counter() - start
                best = took if best is None else min(best, took)
            seconds[name] = best
        for name in MODELS:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = time.perf_counter() - start
    finally:
        spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": {n: round(s, 3) for n, s in seconds.items()},
                      "sf": os.path.basename(folder.rstrip("/")), "feed_rows": rows,
                      "feed_rows_per_sec": round(rows / seconds["feeds_to_final"])}))


if __name__ == "__main__":
    main()
