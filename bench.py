"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from casebook import session
from casebook.plans import catalog

HEADLINE = (
    "dedupe_latest", "merge_upsert", "validation_reasons", "quarantine_groups_topn",
    "city_stats", "city_directory", "city_recent5", "state_stats", "state_recent5",
    "company_stats", "company_recent5", "nation_totals", "nation_recent5", "city_documents",
    "state_documents", "company_documents", "site_documents", "site_siblings",
    "ingest_events", "resolve_company", "company_fold", "clean_city", "event_id_hash",
    "top_companies_by_state", "recent20_by_state", "trend_12m", "safety_score",
    "sitemap_chunks", "prompt_requests", "stream_equals_batch",
    "landing_csv_ingest", "upsert_out_of_order", "gold_round_trip", "entity_refresh",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Build and run one query to its last row; the wall time in seconds."""
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build_session(
        "casebook-bench", f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="casebook-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # An untimed pass over the smallest tables, so that class loading and code
    # generation are not what is measured.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        run(spark, name, small if os.path.isdir(small) else sf_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
                "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
