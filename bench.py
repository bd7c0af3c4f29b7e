"""Times headline queries: ``BENCH_SF_DIR`` tables on ``local[BENCH_CPUS]``.

Prints one JSON line.  Each query runs to the end with all its columns (a
``noop`` write), after one small query that starts the session.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from pyspark.sql import SparkSession

from wagegrid.plans import QUERIES

HEADLINES = [
    # the salary study, step by step and as a whole
    "parse_salary", "annual_only", "split_location", "above_median", "salary_study",
    "value_counts", "median_value", "quality_summary", "one_hot", "title_flags",
    # joins, duplicates, positions
    "join_details", "new_job_ids", "dedupe_rows", "row_numbers", "stratified_folds",
    # pages
    "explode_cards", "card_fields", "detail_fields", "strip_tags", "list_items",
    # words
    "tokenize_words", "bigrams", "top_terms", "term_counts", "tfidf", "assemble",
    # sources and sinks
    "read_listings_csv", "append_details", "append_search_day", "search_grid",
    "incremental_load",
    # models
    "logistic", "random_forest", "score_postings",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wagegrid-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    with contextlib.redirect_stdout(sys.stderr):
        QUERIES["count_rows"](spark, folder).collect()
        for name in names:
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
            print(f"{name:24s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
