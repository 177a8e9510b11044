"""Headline queries, timed; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all), BENCH_RUNS (default 3, after one warm-up each).
Every query is evaluated in full (all columns of all rows, written to the no-op sink); the value is the sum of the
medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from newslens.plans.queries import QUERIES
from newslens.session import apply_session_conf, build_session

HEADLINE = (
    "match_substring",
    "match_substring_many",
    "match_best_alias",
    "match_alias_list",
    "lexicon_sentiment",
    "rule_sentiment",
    "normalize_gdelt",
    "minute_mart",
    "article_enriched",
    "daily_mart",
    "upsert_articles",
    "latest_event_company",
    "latest_url_company",
    "article_volume",
    "sentiment_summary",
    "daily_trend",
    "tile_examples",
    "top_sources",
    "matching_quality",
    "backfill_coverage",
    "stream_pipeline",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "newslens-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_conf(spark)
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    scale = re.search(r"sf([\d.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
