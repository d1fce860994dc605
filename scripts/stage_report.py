"""Jobs, stages, tasks and bytes moved by one bound query, from Spark's event log.

    python scripts/stage_report.py <query> <sf_dir> [<scratch_dir>]

The event log is written to a scratch folder (no UI, no server) and read back:
totals of input bytes, shuffle bytes written and read, and output bytes over
every stage the query ran, eager steps (checkpoint-folder writes, size checks)
included.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollcall import build_session  # noqa: E402
from rollcall.plans.bindings import QUERIES  # noqa: E402


def _totals(log_dir: str, after_job: int) -> dict:
    jobs, stages, tasks = set(), set(), 0
    sums = {"input": 0, "shuffle_write": 0, "shuffle_read": 0, "output": 0}
    stage_job = {}
    paths = glob.glob(f"{log_dir}/**/events_*", recursive=True) + \
        [p for p in glob.glob(f"{log_dir}/*") if os.path.isfile(p)]
    for path in paths:
        for line in open(path):
            e = json.loads(line)
            kind = e["Event"]
            if kind == "SparkListenerJobStart" and e["Job ID"] > after_job:
                jobs.add(e["Job ID"])
                for s in e["Stage IDs"]:
                    stage_job[s] = e["Job ID"]
            elif kind == "SparkListenerTaskEnd" and stage_job.get(e["Stage ID"], -1) > after_job:
                stages.add(e["Stage ID"])
                tasks += 1
                m = e.get("Task Metrics") or {}
                sums["input"] += m.get("Input Metrics", {}).get("Bytes Read", 0)
                sums["output"] += m.get("Output Metrics", {}).get("Bytes Written", 0)
                sums["shuffle_write"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                r = m.get("Shuffle Read Metrics", {})
                sums["shuffle_read"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
    return {"jobs": len(jobs), "stages": len(stages), "tasks": tasks, **sums}


def main(name: str, sf_dir: str, scratch: str | None = None) -> None:
    scratch = scratch or tempfile.mkdtemp(prefix="stage-report-")
    spark = build_session("local[8]", shuffle_partitions=16, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch, "spark.eventLog.compress": "false"})
    QUERIES["edition_catalogue"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    warm_jobs = spark.sparkContext.statusTracker().getJobIdsForGroup() or [0]
    t0 = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()
    totals = _totals(scratch, max(warm_jobs))
    mb = {k: round(v / 2**20, 1) for k, v in totals.items() if k in ("input", "shuffle_write", "shuffle_read", "output")}
    print(json.dumps({"query": name, "sf_dir": sf_dir, "wall_s": round(wall, 2),
                      **{k: totals[k] for k in ("jobs", "stages", "tasks")}, "MiB": mb}))


if __name__ == "__main__":
    main(*sys.argv[1:])
