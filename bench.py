"""Benchmark: warm median seconds per catalog query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3). Prints one JSON line.

Each run builds the query and executes it completely through the ``noop``
sink (every row computed, nothing collected). The marts run once before
anything is timed, so the first queries don't pay for a cold JVM. The headline metric is the sum
of the warm medians of the five marts the reference benchmarks. Shuffle
bytes per query come from one more run in a second session that writes
Spark's event log to a fresh scratch folder (the timed session writes none);
fact rows per second use the forecast table's row count.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from augur.plans.catalog import QUERIES  # noqa: E402
from augur.session import build_session  # noqa: E402
from augur.sources.tables import read_table  # noqa: E402

HEADLINE = ["question_summary", "type_comparison", "belief_revision", "calibration_spread", "engagement"]


def run_once(spark, name, sf_dir, label=None):
    spark.sparkContext.setJobDescription(label or f"timed:{name}")
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def shuffle_bytes(log_dir):
    """Shuffle write bytes per job description, from the event log."""
    stage_job, job_desc, out = {}, {}, defaultdict(int)
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "")
                    job_desc[ev["Job ID"]] = desc
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    job = stage_job.get(ev.get("Stage ID"))
                    desc = job_desc.get(job, "")
                    if desc.startswith("measure:"):
                        out[desc[len("measure:"):]] += int(m.get("Shuffle Bytes Written", 0))
    return dict(out)


def _session(cpus, extra=None):
    conf = {"spark.driver.memory": "16g"}
    conf.update(extra or {})
    return build_session("augur-bench", f"local[{cpus}]", cpus, conf)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [a for a in sys.argv[1:] if a in QUERIES]
    names = only or HEADLINE + sorted(n for n in QUERIES if n not in HEADLINE)

    # timed runs: no event log, so logging never adds to the measured time
    spark = _session(cpus)
    results, errors = {}, {}
    for name in HEADLINE:  # a fresh JVM compiles what all marts share; none is timed for that
        run_once(spark, name, sf_dir)
    for name in names:
        try:
            run_once(spark, name, sf_dir)  # warm-up: codegen, file listing, JIT
            results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 4)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the rest
            errors[name] = str(e).splitlines()[0][:300]
    fact_rows = read_table(spark, sf_dir, "events").count()
    spark.stop()

    # shuffle bytes: one more run per query in a session that writes its event log
    log_dir = tempfile.mkdtemp(prefix="augur-eventlog-")
    spark = _session(cpus, {
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false",
    })
    for name in results:
        run_once(spark, name, sf_dir, f"measure:{name}")
    spark.stop()  # flushes the event log

    headline = [results[n] for n in HEADLINE if n in results]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_marts_warm_median_sum",
        "value": round(sum(headline), 4),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "all_queries_sum": round(sum(results.values()), 4),
        "fact_rows": fact_rows,
        "fact_rows_per_sec": {n: round(fact_rows / results[n]) for n in HEADLINE if n in results},
        "shuffle_bytes": shuffle_bytes(log_dir),
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
