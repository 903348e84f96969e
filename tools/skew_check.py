"""Measure how a hot key spreads over tasks, from Spark's event log.

Usage: python tools/skew_check.py [sf_dir]

``lineitem`` is given one hot key: every row whose part key is divisible by 3
(a third of the table) gets the key (0, 0). ``duplicate_rows`` then runs as a
plain window (every row of a key in one task), on the aggregation-only path,
and in its default hybrid form. For each run the event log gives the wall
time, the largest number of shuffle records one task read, and that task's
share of all shuffle records read in its stage. A second experiment joins
the same hot key to a code table by shuffle (no broadcast), with adaptive
skew-join splitting off and on; the skew thresholds are scaled down to the
test data size.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starmart.operators import duplicates as DU  # noqa: E402
from starmart.operators import joins as J  # noqa: E402
from starmart.session import RECOMMENDED_CONF  # noqa: E402


def stage_task_records(log_dir: str, job_group: str) -> dict[int, list[int]]:
    """Shuffle records read per task, by stage, for the jobs in ``job_group``."""
    stages, out = set(), {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        stages.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    out.setdefault(ev["Stage ID"], []).append(m.get("Total Records Read", 0))
    return out


def main(argv: list[str]) -> None:
    sf_dir = (argv[0] if argv else "/root/testdata/sf0.1").rstrip("/")
    log_dir = tempfile.mkdtemp(prefix="starmart-eventlog-")
    builder = (SparkSession.builder.master("local[8]").appName("skew-check")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
               .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
               # keep partitions as they are, so the per-task numbers show the placement
               .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
               # no broadcast by size estimate, and skew thresholds scaled down to this data size
               .config("spark.sql.autoBroadcastJoinThreshold", "-1")
               .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
               .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256KB")
               .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
               .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB"))
    for k, v in RECOMMENDED_CONF.items():
        if k not in ("spark.sql.adaptive.coalescePartitions.enabled",):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("l_shipdate", F.to_date("l_shipdate"))
    hot = F.col("l_partkey") % 3 == 0
    skewed = li.withColumns({"l_orderkey": F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey")),
                             "l_linenumber": F.when(hot, F.lit(0)).otherwise(F.col("l_linenumber"))})
    keys = ["l_orderkey", "l_linenumber"]
    runs = {
        "duplicate rows": lambda: DU.duplicate_rows(skewed, keys, order=["l_partkey", "l_suppkey"]),
    }
    # the shuffle fallback of a lookup: part keys as codes, the hot third on code 0
    codes = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("code"), "p_brand")
    # the test file is one row group, read by one map task; a split of a skewed
    # partition needs several map outputs, as any large input has, so the fact
    # is spread over 16 partitions first
    fact = li.withColumn("code", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("l_partkey"))).repartition(16)

    def lookup(salts: int):
        return lambda: J.lookup_join(fact, codes, "code", {"p_brand": "brand"}, broadcast=False, salt_buckets=salts)

    runs["lookup by shuffle, one salt"] = lookup(1)
    runs["lookup by shuffle, 32 salts"] = lookup(32)
    results = {}
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(f"{name}-count", f"{name}-count")
        n = build().count()
        for attempt in range(2):  # the second run is measured: the whole result, written to the noop sink
            group = f"{name}-{attempt}"
            spark.sparkContext.setJobGroup(group, group)
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            wall = time.perf_counter() - t0
        results[name] = (group, wall, n)
    spark.stop()
    print("| Plan | Rows out | Wall time (s) | Largest task: shuffle records read | "
          "Its share of its stage's records (8 tasks: 12.5 % is even) |")
    print("|---|---|---|---|---|")
    for name, (group, wall, n) in results.items():
        # stages with one task (the final count) say nothing about placement
        by_stage = {st: recs for st, recs in stage_task_records(log_dir, group).items()
                    if sum(recs) > 0 and len(recs) > 1}
        worst = max(by_stage.values(), key=lambda recs: max(recs) / sum(recs))
        top_stage = max(by_stage.values(), key=max)
        print(f"| {name} | {n:,} | {wall:.2f} | {max(top_stage):,} | "
              f"{100.0 * max(worst) / sum(worst):.1f} % |")


if __name__ == "__main__":
    main(sys.argv[1:])
