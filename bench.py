"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times (3); the fastest run counts. Results
are written to Spark's ``noop`` sink, so all rows and columns are computed.
"""

import json
import os
import tempfile
import time

from checks import workload
from checks.queries import QUERIES
from spoolway.session import session

HEADLINE = [
    "recover_all",
    "events_by_tag",
    "journal_index",
    "snapshot_load",
    "snapshot_live_set",
    "all_events",
    "events_by_id",
    "replay",
    "bulk_replay",
    "fold_state",
    "compact_latest",
    "logical_delete",
    "topic_scan",
    "assigned_scan",
    "resume_from_commit",
    "per_partition_running",
    "commit_ledger",
    "journal_append",
    "produce_multi",
    "exactly_once",
    "decode_headers",
    "json_decode",
    "fold_udf",
]


def timed(function) -> float:
    begin = time.perf_counter()
    function()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    shared = tempfile.mkdtemp(prefix="spoolway-bench-")
    conf = {"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.checkpoint.dir": shared}
    spark = session(f"local[{cpus}]", int(cpus), **conf)
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # writes the topic tables that the queries read; includes the start-up of the session
    stored = timed(lambda: workload.topics_root(spark, sf_dir))
    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(min(timed(lambda: run(name)) for _ in range(runs)), 3)
    events = workload.table(spark, sf_dir, "events").count()
    headline = ("recover_all", "events_by_tag", "journal_index", "snapshot_load")
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "store_topics_sec": round(stored, 3),
                "events_per_sec": {name: round(events / seconds[name]) for name in headline},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
