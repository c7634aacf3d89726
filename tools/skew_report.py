"""Task balance of the fact-base join on a skewed input, with and without salting.

Usage: python tools/skew_report.py [sf_dir] [scratch_dir]

The input is derived from the test tables: a third of the silver submissions
(chosen by a hash) are moved to one enrolment, so one join key holds a third
of the rows. The fact base (submissions ⟕ enrolments ⟕ clicks) is computed
twice on shuffle joins (broadcasts off, AQE skew splitting off, so only the
salting differs): once with hot-key salting disabled, once enabled. Spark's
event log, written to the scratch folder, gives per-task shuffle records and
run times of each job's join stage. Prints a Markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time
from collections import defaultdict

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


def event_lines(log_path: str):
    """Lines of an event log: a plain file or a rolling folder of (zstd) parts."""
    files = sorted(glob.glob(os.path.join(log_path, "events_*")),
                   key=lambda p: int(os.path.basename(p).split("_")[1])) if os.path.isdir(log_path) else [log_path]
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def stage_report(log_path: str) -> dict[str, dict]:
    """Per job description: the stage that read the most shuffle records."""
    jobs, stage_job, tasks = {}, {}, defaultdict(list)
    for line in event_lines(log_path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            if desc:
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = desc
        elif ev == "SparkListenerTaskEnd" and e.get("Task End Reason", {}).get("Reason") == "Success":
            m = e.get("Task Metrics") or {}
            rd = m.get("Shuffle Read Metrics") or {}
            info = e["Task Info"]
            tasks[e["Stage ID"]].append((rd.get("Total Records Read", 0),
                                         info["Finish Time"] - info["Launch Time"]))
    for sid, desc in stage_job.items():
        t = tasks.get(sid, [])
        total = sum(r for r, _ in t)
        if total and total > jobs.get(desc, {}).get("records", 0):
            recs = [r for r, _ in t]
            durs = [d for _, d in t]
            jobs[desc] = {"stage": sid, "tasks": len(t), "records": total, "max_task_records": max(recs),
                          "max_share": max(recs) / total, "max_over_mean": max(recs) / (total / len(t)),
                          "max_task_ms": max(durs), "median_task_ms": sorted(durs)[len(durs) // 2]}
    return jobs


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else None
    if not scratch:
        import tempfile
        scratch = tempfile.mkdtemp(prefix="skew-report-", dir="/tmp")
    events = os.path.join(scratch, "events")
    os.makedirs(events, exist_ok=True)

    from pyspark.sql import functions as F

    from edustar.operators import joins, star
    from edustar.plans.warehouse import Warehouse
    from edustar.session import local_session

    parts = 16
    spark = local_session(8, shuffle_partitions=parts, app="edustar-skew-report", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    w = Warehouse.of(spark, sf_dir)
    silver = dict(w.silver())
    sa = silver["student_assessment"]
    # One existing enrolment: the first submission's student and assessment.
    first = sa.select("id_student", "id_assessment").orderBy("id_student", "id_assessment").first()
    moved = F.pmod(F.xxhash64("id_student", "id_assessment"), F.lit(3)) == 0
    silver["student_assessment"] = sa.select(
        F.when(moved, F.lit(first.id_assessment)).otherwise(F.col("id_assessment")).alias("id_assessment"),
        F.when(moved, F.lit(first.id_student)).otherwise(F.col("id_student")).alias("id_student"),
        "date_submitted", "is_banked", "score")
    n = silver["student_assessment"].count()
    joins.BROADCAST_MAX_BYTES = 0  # every lookup a shuffle join, as above the bound at scale

    real_detect = star.detect_hot_keys
    runs = {}
    for label, salted in (("plain shuffle join", False), ("salted hot keys", True)):
        star.detect_hot_keys = real_detect if salted else (lambda df, keys, *a, **k: joins.HotKeys(keys, None))
        spark.sparkContext.setJobDescription(label)
        t = time.time()
        star.fact_base(silver, None, n).write.mode("overwrite").format("noop").save()
        runs[label] = time.time() - t
        spark.sparkContext.setJobDescription(None)
    star.detect_hot_keys = real_detect
    app_id = spark.sparkContext.applicationId
    spark.stop()

    log = [p for p in glob.glob(os.path.join(events, "*")) if app_id in p][0]
    rep = stage_report(log)
    print(f"Skewed input: {n:,} submissions, one enrolment holds a third; {parts} shuffle partitions, "
          "local[8], broadcasts and AQE skew splitting off.\n")
    print("| run | join-stage tasks | shuffle records | largest task | largest share | largest / mean "
          "| longest task ms | median task ms | wall s |")
    print("|---|---:|---:|---:|---:|---:|---:|---:|---:|")
    for label, sec in runs.items():
        r = rep.get(label, {})
        print(f"| {label} | {r.get('tasks')} | {r.get('records'):,} | {r.get('max_task_records'):,} | "
              f"{r.get('max_share', 0):.1%} | {r.get('max_over_mean', 0):.1f} | {r.get('max_task_ms')} | "
              f"{r.get('median_task_ms')} | {sec:.1f} |")


if __name__ == "__main__":
    main()
