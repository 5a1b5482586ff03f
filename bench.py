"""Headline queries at one scale, timed. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "normalize_posting", "collect_request", "extract_salary", "detect_country", "parse_tweets",
    "parse_linkedin_posts", "html_to_text", "html_nodes", "html_to_markdown",
    "dedup_by_normalized_url", "dedup_within_site", "enrich_with_details", "parse_indeed",
    "parse_linkedin_cards", "parse_jsonld_postings", "parse_next_data", "extract_job_links",
    "sitemap_postings", "offset_slice", "seen_anti_join",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    from checks import load
    from checks.registry import QUERIES
    from vacancia.session import build_session

    load()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and the Python workers' machinery on a small input first.
    small = sf_dir.replace("sf0.1", "sf0.001")
    for name in ("normalize_posting", "html_nodes"):
        QUERIES[name](spark, small if os.path.isdir(small) else sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
