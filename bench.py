"""Headline queries on one folder of tables; prints one JSON line.

BENCH_SF_DIR names the folder, BENCH_CPUS the local threads. Every query runs to completion
over its whole tables; rows go to the no-op sink so that only the engine is timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from broadsheet.plans.catalog import QUERIES  # noqa: E402
from broadsheet.session import build_session  # noqa: E402

HEADLINE = (
    "h9_top_articles_per_source", "j1_html_to_text", "j8_url_normalise", "c1_api_record_to_article", "a3_feed_entry_scan",
    "a7_article_message_scan", "d6_relevance_scores", "d18_unique_keys", "d19_foreign_keys", "e1_articles_for_state",
    "e2_ranked_articles", "e3_favorite_states", "e4_duplicate_by_url", "e5_duplicate_by_hash", "f3_consumer_summary",
    "h1_recent_articles", "h7_favorite_countries", "i1_ordered_dedup", "i2_persist_articles", "i4_state_link_upsert",
    "i8_replace_top_ten", "i10_add_favorite_state",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g", "spark.log.level": "ERROR",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
