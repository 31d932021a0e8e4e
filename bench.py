"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of cores. Each query runs to
the end with all its columns, into a sink that stores nothing, after one small warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfspark.bindings import all_queries  # noqa: E402
from shelfspark.session import build_session  # noqa: E402

HEADLINE = (
    "explode_items", "drop_fields", "clean_kept", "clean_report", "file_metrics", "merge_records", "merge_metrics",
    "dedup_first_wins", "label_duplicates", "dedup_richest", "label_events", "cross_file_membership",
    "resume_new_urls", "normalize_text", "strip_tags_decode", "scan_url_list", "expand_page_range",
    "parse_detail_page", "extract_details", "extract_page_fields", "classify_page", "listing_blocks",
    "collect_links", "running_totals", "take_pages", "stream_dedup",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            run(name, small)
    seconds = {name: round(run(name, sf_dir), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
