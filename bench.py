"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is planned anew and its rows are written to a sink that discards them, so that all
columns of all rows are computed. Building JSON documents from the star tables is part of the time.
"""

from __future__ import annotations

import json
import os
import time

from eventweft.checks import QUERIES
from eventweft.session import local_session

HEADLINE = (
    "extract_array",
    "extract_single",
    "path_nested",
    "latest_per_id",
    "nullability_split",
    "fk_resolve",
    "fk_join_frames",
    "link_event_scope",
    "link_path_scope",
    "new_only_anti_join",
    "record_hash",
    "uuid_v5",
    "coerce_int",
    "coerce_decimal",
    "coerce_date",
    "coerce_timestamp",
    "running_total",
    "scan_csv",
    "stream_ingest",
    "reconcile_counts",
    "model_entities",
    "model_links",
    "stays_reservations",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="12g")
    QUERIES["scan_parquet"](spark, sf_dir).collect()  # start the session's machinery
    spent = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
