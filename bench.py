"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores. Every query
runs to completion (all rows and columns are produced, none is collected) once to warm
up and then ``BENCH_RUNS`` times; the best time counts.
"""

from __future__ import annotations

import json
import os
import time

from scrutiny.harness.catalog import QUERIES
from scrutiny.session import build

HEADLINE = (
    "party_totals_share",
    "curated_votes_last_run",
    "curate_votes_by_header_run",
    "enrich_header",
    "tidy_votes",
    "flatten_document",
    "dq_report",
    "anomalies_all",
    "winners_by_place",
    "turnout_by_place",
    "geo_rollup_3_levels",
    "state_matrix",
    "age_band_roll",
    "validity_merge",
    "export_district_summary",
    "deputies_winner_by_district",
    "catalogue_articles",
    "shard_of_key",
    "progress_15min",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build(
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
