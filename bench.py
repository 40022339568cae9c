"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "q_audit_wide", "q_event_scan", "q_attr_flatten", "q_attr_extract", "q_attr_raw", "q_ci_join",
    "q_case_resolve", "q_composite_join", "q_provenance", "q_upsert_last_wins", "q_upsert_attributes",
    "q_history_normalize", "q_record_id", "q_classify", "q_unmatched_upsert", "q_catalog", "q_event_name",
    "q_list_flat", "q_list_sync", "q_purge_ms", "q_counter", "q_publish", "q_backfill",
    "q_snapshot_rotate", "q_stream_replay",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        {
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        raise SystemExit("set spark.checkpoint.dir to a shared folder")

    from tidemark.plans.table_checks import QUERIES

    # The first query pays for starting the JVM and its compiler; run one unmeasured.
    QUERIES["q_event_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
