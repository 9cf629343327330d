"""Per-stage task balance from Spark's event log (no UI).

Usage: python tools/stage_report.py [sf_dir]
Runs the fact builder on a skewed copy of the events (a third of all events
moved onto one media and one visitor) and, for contrast, a plain
``repartition(media_id)`` of the same rows; reads the event log written to a
fresh scratch folder and prints, per stage, the shuffle records read in total
and by the largest task.  A balanced plan keeps the largest task near
total / tasks; the contrast shows what a hot key does to an unbalanced one.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from engagelake.plans import gold, reports  # noqa: E402
from engagelake.session import get_session  # noqa: E402
from engagelake.sources import testdata as T  # noqa: E402


def skewed(spark, sf):
    ev = T.play_events(spark, sf)
    hot = (F.abs(F.hash("event_key")) % 3) == 0
    return (ev.withColumn("media_id", F.when(hot, F.lit("m0")).otherwise(F.col("media_id")))
              .withColumn("visitor_key", F.when(hot, F.lit("0")).otherwise(F.col("visitor_key"))))


def stage_summary(log_dir: str) -> dict[int, dict]:
    stages: dict[int, dict] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    for sid in ev.get("Stage IDs", []):
                        stages.setdefault(sid, {"tasks": []})["job"] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sr = m.get("Shuffle Read Metrics") or {}
                    info = ev.get("Task Info") or {}
                    stages.setdefault(ev["Stage ID"], {"tasks": []})["tasks"].append(
                        (sr.get("Total Records Read", 0), info.get("Finish Time", 0) - info.get("Launch Time", 0)))
    return stages


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = get_session("local[8]", app_name="stage-report", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file:{log_dir}",
                               "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    # keep every shuffle partition visible as a task (coalescing would merge small ones)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ev = skewed(spark, sf)
    spark.sparkContext.setJobDescription("fact on skewed events")
    fact = gold.build_fact(ev, gold.media_durations(T.media_metadata(spark, sf)), T.media_stats_by_date(spark, sf))
    fact.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription("channel_summary (2 groups) on the skewed fact")
    fact_tbl = fact.checkpoint(eager=True)
    dim_media = gold.build_dim_media(T.media_metadata(spark, sf), T.media_stats(spark, sf, with_visitors=False))
    reports.channel_summary(fact_tbl, dim_media, T.media_metadata(spark, sf)).write.format("noop").mode(
        "overwrite").save()
    spark.sparkContext.setJobDescription("dim_visitor on skewed events")
    places = T.places_lookup(spark, sf)
    gold.build_dim_visitor(ev.join(places, "visitor_key", "left").select(
        "*", F.col("event_key").alias("browser"), F.lit("v").alias("browser_version"),
        F.lit("p").alias("platform"), F.lit(False).alias("mobile"))).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription("contrast: repartition(media_id)")
    ev.repartition("media_id").write.format("noop").mode("overwrite").save()
    spark.stop()
    print("| job | stage | tasks | shuffle records read | largest task | median task | max task ms |")
    print("|---|---|---|---|---|---|---|")
    for sid, st in sorted(stage_summary(log_dir).items()):
        reads = [r for r, _ in st["tasks"]]
        if not reads or sum(reads) == 0:
            continue
        times = [t for _, t in st["tasks"]]
        print(f"| {st.get('job', '')} | {sid} | {len(reads)} | {sum(reads)} | {max(reads)} | "
              f"{int(statistics.median(reads))} | {max(times)} |")


if __name__ == "__main__":
    main()
