"""Time the report workload; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_STANDALONE (comma list of reports timed from base tables),
     BENCH_EVENT_LOG (folder for Spark's event log; default a fresh scratch folder)

Workload = the reference's "report" step: all 36 reports built in dependency
order for all courses at once, each written (partitioned by course) and read
back by the reports that use it.  ``value`` is its wall time; ``queries`` the
per-report build seconds.  ``standalone`` times a few reports computed from
the base tables in one plan (what ``__spark_entry__.queries()`` returns).
The driver tables are bridged into stored course-data tables first
(``bridge_sec``, not part of ``value``; production reads ingest output).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mooclens.plans import reports  # noqa: E402
from mooclens.plans.build import build_reports  # noqa: E402
from mooclens.session import checkpoint_dir, get_spark  # noqa: E402
from mooclens.sources.bridge import TABLES, Tables, stored  # noqa: E402

STANDALONE = ["time_on_task", "course_modal_ip", "forum_events", "course_item"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    standalone = [q for q in os.environ.get("BENCH_STANDALONE", ",".join(STANDALONE)).split(",") if q]
    # Spark's event log, written to a fresh scratch folder, gives shuffle bytes per report
    import tempfile
    event_dir = os.environ.get("BENCH_EVENT_LOG") or tempfile.mkdtemp(prefix="mooclens-evlog-")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
             "spark.eventLog.compress": "false"}
    spark = get_spark(f"local[{cpus}]", app="mooclens-bench", shuffle_partitions=cpus * 2, **extra)

    t0 = time.perf_counter()
    for name in TABLES:
        stored(spark, sf_dir, name)
    bridge_sec = time.perf_counter() - t0

    def run(name):
        t = time.perf_counter()
        reports.resolve(name, Tables(spark, sf_dir)).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t, 3)

    run("pc_day_ip_counts")  # warm-up: JIT, file listing, codegen caches

    t0 = time.perf_counter()
    status = build_reports(spark, Tables(spark, sf_dir),
                           f"{checkpoint_dir(spark)}/mooclens-bench/{uuid.uuid4().hex[:8]}")
    pipeline_sec = time.perf_counter() - t0
    out = {"metric": "all_reports_build_wall", "value": round(pipeline_sec, 3), "unit": "sec",
           "queries": {s["report"]: s["seconds"] for s in status},
           "failed": [s["report"] for s in status if s["status"] != "ok"],
           "standalone": {n: run(n) for n in standalone},
           "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": cpus,
           "bridge_sec": round(bridge_sec, 3)}
    app_id = spark.sparkContext.applicationId
    spark.stop()
    shuffle = shuffle_bytes_by_report(event_dir, app_id)
    out["shuffle_bytes"] = {k: shuffle.get(k, 0) for k in out["queries"]}
    out["shuffle_bytes_total"] = sum(out["shuffle_bytes"].values())
    print(json.dumps(out))


def _event_files(event_dir: str, app_id: str) -> list[str]:
    entry = next((os.path.join(event_dir, f) for f in os.listdir(event_dir) if app_id in f), None)
    if entry is None:
        return []
    if not os.path.isdir(entry):
        return [entry]
    # rolling event log: events_<n>_<app id> files, read in order
    files = sorted((f for f in os.listdir(entry) if f.startswith("events_")), key=lambda f: int(f.split("_")[1]))
    return [os.path.join(entry, f) for f in files]


def shuffle_bytes_by_report(event_dir: str, app_id: str) -> dict[str, int]:
    """Sum shuffle bytes written per ``report:<name>`` job description from the event log."""
    stage_owner: dict[int, str] = {}
    totals: dict[str, int] = {}
    for path in _event_files(event_dir, app_id):
        with open(path, encoding="utf8") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    if desc.startswith("report:"):
                        for sid in ev.get("Stage IDs", []):
                            stage_owner[sid] = desc[len("report:"):]
                elif kind == "SparkListenerTaskEnd":
                    owner = stage_owner.get(ev.get("Stage ID"))
                    metrics = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if owner:
                        totals[owner] = totals.get(owner, 0) + int(metrics.get("Shuffle Bytes Written", 0))
    return totals


if __name__ == "__main__":
    main()
