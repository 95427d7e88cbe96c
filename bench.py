"""Headline queries, timed.  Prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``BENCH_CPUS`` (default 8) the local
cores.  Every query is run to completion into Spark's ``noop`` sink, so all rows and columns are
computed; the streaming job is reported with its end-to-end records per second.
"""

from __future__ import annotations

import json
import os
import pathlib
import tempfile
import time

from tidemark.checks import queries as q
from tidemark.checks import views
from tidemark.session import local_session

HEADLINE = [
    "canonicalize",
    "validate_records",
    "prefilter_accepts",
    "prefilter_rejects",
    "guardrail",
    "two_tier_rules",
    "line_rules",
    "upsert_status",
    "maturity_regression",
    "reject_envelopes",
    "message_keys",
    "upsert_store",
    "insert_if_absent",
    "delete_trades",
    "merge_last_wins",
    "expire_matured",
    "latest_per_trade",
    "rebuild_store",
    "active_counts",
    "ingest_metrics",
    "converge_sources",
    "reconcile",
    "dedup_ttl",
    "array_chunks",
    "sized_parts",
    "generated_trades",
    "bulk_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = local_session(scratch, int(os.environ.get("BENCH_CPUS", "8")), app="tidemark-bench")
    # start the session's threads and code paths before timing
    views.incoming(spark, sf_dir).limit(1).collect()

    took: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        q.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)

    records = views.table(spark, sf_dir, "events").count()
    began = time.perf_counter()
    q.run_stream(spark, sf_dir, batches=3)
    took["stream_ingest"] = round(time.perf_counter() - began, 3)

    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": pathlib.Path(sf_dir).name.removeprefix("sf"),
                "stream_records_per_sec": round(records / took["stream_ingest"], 1),
                "rules_records_per_sec": round(views.incoming(spark, sf_dir).count() / took["two_tier_rules"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
