"""Shuffle volume per operator, read from Spark's event log.

    python tools/shuffle_report.py --events DIR_OF_events.parquet [--out FILE]

Runs the keyed operators and the clean over the given ``events`` table with
the event log written to a fresh scratch folder, then sums, per operator, the
stages, tasks, input bytes and shuffle bytes written as recorded in the log.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def _stages(log_dir: str) -> dict[int, dict]:
    """job group (our operator label) -> totals, from the event log."""
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    stage_group: dict[int, str] = {}
    job_group: dict[int, str] = {}
    totals: dict[str, dict] = {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"], "")
                    if not group:
                        continue
                    acc = {a["Name"]: a.get("Value", 0) for a in info.get("Accumulables", [])}
                    t = totals.setdefault(group, {"stages": 0, "tasks": 0, "input_bytes": 0, "shuffle_write_bytes": 0})
                    t["stages"] += 1
                    t["tasks"] += info.get("Number of Tasks", 0)
                    t["input_bytes"] += int(acc.get("internal.metrics.input.bytesRead", 0) or 0)
                    t["shuffle_write_bytes"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
    return totals


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--events", required=True, help="folder holding events.parquet")
    ap.add_argument("--out", default=None)
    args = ap.parse_args()

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from telemetra.operators.keyed import delete_keys, latest_per_key, upsert_rows
    from telemetra.operators.staging import stage
    from telemetra.plans.clean import clean_telemetry
    from telemetra.sources.fixtures import telemetry_from_events

    log_dir = tempfile.mkdtemp(prefix="eventlog-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "64")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet(f"{args.events.rstrip('/')}/events.parquet")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    tele = telemetry_from_events(ev)
    runs = {
        "scan": ev,
        "latest_per_key": latest_per_key(ev, keys, order),
        "delete_keys": delete_keys(ev, ev.where(F.col("value") > 400), keys),
        "delete_keys, staged key set": None,
        "upsert_rows": upsert_rows(
            latest_per_key(ev.where(F.col("event_id") % 2 == 0), keys, order), ev.where(F.col("event_id") % 2 == 1), keys, order
        ),
        "clean (keyed source)": clean_telemetry(tele),
        "clean (with dedup)": clean_telemetry(tele, order_by=["event_id"]),
    }
    seconds = {}
    for name, df in runs.items():
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        if df is None:  # the lake delete's form: key set written first, then the join
            key_set = stage(ev.where(F.col("value") > 400).select(*keys).dropDuplicates(), "report-keys")
            df = delete_keys(ev, key_set, keys)
        df.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - t0, 2)
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    totals = _stages(log_dir)
    lines = ["| operator | sec | stages | tasks | input MB | shuffle written MB |", "| --- | --- | --- | --- | --- | --- |"]
    for name in runs:
        t = totals.get(name, {})
        lines.append(
            f"| {name} | {seconds[name]} | {t.get('stages', 0)} | {t.get('tasks', 0)} | "
            f"{t.get('input_bytes', 0) / 1e6:.1f} | {t.get('shuffle_write_bytes', 0) / 1e6:.1f} |"
        )
    text = "\n".join(lines)
    print(text)
    if args.out:
        with open(args.out, "w") as fh:
            fh.write(text + "\n")


if __name__ == "__main__":
    main()
