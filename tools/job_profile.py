"""Per-job timings of one registered query, from Spark's event log (no UI, no REST endpoint).

    python tools/job_profile.py <key> [sf_dir] [runs]

Runs the key ``runs`` times (default 3, cache cleared before each) into the ``noop`` sink with the
event log written to a fresh scratch folder, then prints, for the last run, every job with its
start offset, duration and stages (name, task count, duration). Plan-building time and execution
time are printed per run: jobs launched while the DataFrame is built (size checks, histogram
passes) show up before the execution starts.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str):
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isfile(path) and not os.path.basename(path).startswith("appstatus"):
            with open(path, encoding="utf-8") as fh:
                for line in fh:
                    yield json.loads(line)


def report(log_dir: str, group: str) -> None:
    jobs: dict[int, dict] = {}
    stages: dict[int, tuple] = {}
    for e in _events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            props = e.get("Properties", {})
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"],
                                 "group": props.get("spark.jobGroup.id")}
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            s = e["Stage Info"]
            stages[s["Stage ID"]] = (s["Stage Name"][:48], s["Number of Tasks"],
                                     s.get("Completion Time", 0) - s.get("Submission Time", 0))
    t0 = None
    for job_id, j in sorted(jobs.items()):
        if j["group"] != group:
            continue
        t0 = t0 if t0 is not None else j["start"]
        done = [stages[s] for s in j["stages"] if s in stages]
        print(f"job {job_id:5d}  at {j['start'] - t0:6d} ms  {j.get('end', j['start']) - j['start']:6d} ms  {done}")


def main() -> None:
    key = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    runs = int(sys.argv[3]) if len(sys.argv) > 3 else 3
    scratch = tempfile.mkdtemp(prefix="cardwatch-profile-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)

    from pyspark.sql import SparkSession

    from cardwatch.plans.keys import registry
    from cardwatch.session import _BASE_CONF, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[8]").appName("cardwatch-profile")
               .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
               .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
               .config("spark.eventLog.compress", "false"))
    for k, v in _BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    query = registry()[key]
    for i in range(runs):
        spark.catalog.clearCache()
        spark.sparkContext.setJobGroup(f"run{i}", f"{key} run {i}")
        t0 = time.perf_counter()
        df = query(spark, sf_dir)
        t1 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"run {i}: build {t1 - t0:.2f} s, execute {time.perf_counter() - t1:.2f} s")
    spark.stop()
    print(f"jobs of run {runs - 1} (event log in {log_dir}):")
    report(log_dir, f"run{runs - 1}")


if __name__ == "__main__":
    main()
