"""Daily runs end to end: land -> silver -> gold -> quality -> reports.

Each layer is written and the next one reads the written tables (the
hand-off is files, as on a cluster where each step may run as its own job;
it also cuts lineage).  Row counts are observed during the writes.
Independent datasets (the six landings, the six silver tables, the reports)
are submitted as concurrent Spark jobs from a small thread pool, so small
datasets do not leave the executors idle while a large one runs.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagelake.constants import DATASETS
from engagelake.operators.quality import QualityGateError, report_lines
from engagelake.plans import checks, gold, incremental, publish, reports, silver
from engagelake.schemas import SILVER_CLUSTER, SILVER_PARTITIONS
from engagelake.sources import bronze
from engagelake.sources import testdata as TD
from engagelake.sources.files import observed, path_exists, read_required, write_table, written_rows

# The fact is partitioned by day and clustered by media inside each day (a
# folder per (day, media) would multiply partitions by the catalogue size).
FACT_PARTITIONS = ["date"]
FACT_CLUSTER = ["media_id", "visitor_id"]

PARALLEL_JOBS = 6


def in_parallel(fns):
    """Run independent job-submitting callables concurrently; results in order."""
    with ThreadPoolExecutor(max_workers=PARALLEL_JOBS) as pool:
        return [f.result() for f in [pool.submit(fn) for fn in fns]]


@dataclass
class RunReport:
    root: str
    rows: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    failed_checks: int = 0
    check_lines: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    quarantined: dict[str, int] = field(default_factory=dict)
    window: incremental.RunWindow | None = None
    watermark_committed: bool = False


def _timed(report: RunReport, step: str, fn):
    t0 = time.perf_counter()
    out = fn()
    report.seconds[step] = round(time.perf_counter() - t0, 3)
    return out


def land_all(spark: SparkSession, sf_dir: str, bronze_root: str) -> None:
    in_parallel([lambda ds=ds: TD.land(spark, sf_dir, bronze_root, ds)
                  for ds in DATASETS])


QUARANTINE = "quarantine"


def _silver_rows(spark: SparkSession, bronze_root: str, ds: str, path: str | None = None):
    """(silver frame, its decoded bronze frame, the observation that counts rejects while the frame is written)."""
    frame = bronze.decoded(spark, bronze_root, ds, path)
    seen = Observation(f"decoded_{ds}")
    watched = frame.observe(seen, F.sum(F.size("rejects")).alias("rejects"))
    return silver.TRANSFORMS[ds](bronze.envelopes_of(watched, ds)), frame, seen


def _land_rejects(spark: SparkSession, root: str, ds: str, run_id: str, frame: DataFrame, seen: Observation,
                  report: RunReport) -> None:
    """Land what could not be decoded, if anything, under the run's id; a file that gave no envelope at all is an error.

    Bronze is read again only where there were rejects."""
    count = int(observed(seen, "rejects") or 0)
    report.quarantined[ds] = count
    if not count:
        return
    rejects = bronze.rejects_of(frame, ds).withColumn("processed_by", F.lit(run_id))
    write_table(rejects, f"{root}/{QUARANTINE}", ds, ["processed_by"], dynamic=True)
    barren = [r[0] for r in bronze.barren_files(frame).take(20)]
    if barren:
        raise bronze.BronzeError(f"no envelope could be read from {len(barren)} file(s) of {ds}, the first: {barren[0]}; "
                                 f"their text is in {root}/{QUARANTINE}/{ds}")


def build_silver(spark: SparkSession, bronze_root: str, root: str, report: RunReport, run_id: str) -> None:
    def one(ds: str) -> None:
        if not path_exists(spark, f"{bronze_root.rstrip('/')}/{ds}"):
            report.skipped.append(ds)                 # nothing landed: gold fails fast if it needs it
            return
        df, frame, seen = _silver_rows(spark, bronze_root, ds)
        _, obs = write_table(df, f"{root}/silver", ds, SILVER_PARTITIONS[ds], cluster_by=SILVER_CLUSTER[ds])
        report.rows[f"silver.{ds}"] = written_rows(obs)
        _land_rejects(spark, root, ds, run_id, frame, seen, report)
    in_parallel([lambda ds=ds: one(ds) for ds in DATASETS])


def _silver(spark: SparkSession, root: str, ds: str) -> DataFrame:
    return read_required(spark, root, ds, silver.schema(spark, ds))


DIM_MEDIA, DIM_VISITOR, FACT = "gold/dim_media", "gold/dim_visitor", "gold/fact_media_engagement"
VISITOR_PARTIALS = "gold/visitor_partials"                  # (visitor, media, day) partials of dim_visitor
FACT_CHECK_PARTIALS = "gold/fact_check_partials"            # per-day counts of the fact's check rules


def build_gold(spark: SparkSession, silver_root: str, root: str, version: str, report: RunReport) -> publish.Manifest:
    """Stage the three gold tables as a version under ``root``."""
    events = _silver(spark, silver_root, "events")
    metadata = _silver(spark, silver_root, "media_metadata")
    stats = _silver(spark, silver_root, "media_stats")
    by_date = _silver(spark, silver_root, "media_stats_by_date")
    staged: publish.Manifest = {}

    def media_and_fact() -> None:
        staged[DIM_MEDIA], o1 = publish.stage(gold.build_dim_media(metadata, stats, stamp=True), root, DIM_MEDIA, version)
        # The fact reads the written dimension: exact size known, broadcast.
        fact = gold.build_fact(events, publish.open_table(spark, root, staged, DIM_MEDIA), by_date, stamp=True)
        staged[FACT], o3 = publish.stage(fact, root, FACT, version, *FACT_PARTITIONS, cluster_by=FACT_CLUSTER)
        report.rows.update({"gold.dim_media": written_rows(o1), "gold.fact_media_engagement": written_rows(o3)})

    def visitors() -> None:
        staged[DIM_VISITOR], o2 = publish.stage(gold.build_dim_visitor(events, stamp=True), root, DIM_VISITOR, version)
        report.rows["gold.dim_visitor"] = written_rows(o2)

    in_parallel([media_and_fact, visitors])
    return staged


def fact_schema() -> T.StructType:
    return T.StructType([
        T.StructField("media_id", T.StringType()),
        T.StructField("visitor_id", T.StringType()), T.StructField("play_count", T.LongType()),
        T.StructField("play_rate", T.DoubleType()), T.StructField("total_watch_time_seconds", T.DoubleType()),
        T.StructField("total_watch_time_hours", T.DoubleType()), T.StructField("watched_percent", T.DoubleType()),
        T.StructField("media_load_count", T.LongType()), T.StructField("media_play_count", T.LongType()),
        T.StructField("media_hours_watched", T.DoubleType()), T.StructField("gold_loaded_at", T.TimestampType()),
        T.StructField("date", T.DateType()),
    ])


STATE = "state/commits"
TOUCHED = "state/touched"


def current(spark: SparkSession, root: str) -> publish.Manifest:
    """The manifest of the newest commit under ``root``."""
    return publish.from_text(incremental.head(incremental.read_state(spark, f"{root}/{STATE}"))[2])


def read_published(spark: SparkSession, root: str, table: str, manifest: publish.Manifest | None = None) -> DataFrame:
    """A published table (``gold/...`` or ``reports/...``) as readers see it."""
    return publish.open_table(spark, root, current(spark, root) if manifest is None else manifest, table)


def read_gold(spark: SparkSession, root: str, manifest: publish.Manifest | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact, media and visitor dimension, all of one commit."""
    manifest = current(spark, root) if manifest is None else manifest
    return tuple(publish.open_table(spark, root, manifest, t) for t in (FACT, DIM_MEDIA, DIM_VISITOR))


def _gate(report: RunReport, waived: Collection[str]) -> None:
    """Stop the run if a check failed that is not waived; nothing has been made current by then."""
    failed = [line for line in report.check_lines if line.startswith("[FAIL]")]
    report.failed_checks = len(failed)
    refused = [line for line in failed if line.split()[1] not in waived]
    if refused:
        error = QualityGateError(f"Gold quality checks failed: {len(refused)} failure(s): " + "; ".join(refused))
        error.report = report
        raise error


def stage_reports(spark: SparkSession, root: str, version: str, manifest: publish.Manifest, report: RunReport) -> publish.Manifest:
    """Stage the reports over a manifest's gold tables."""
    f, m, v = read_gold(spark, root, manifest)
    outs = {"plays_by_date_channel": reports.plays_by_date_channel(f, m),
            "watch_time_by_date_channel": reports.watch_time_by_date_channel(f, m),
            "avg_watched_by_media": reports.avg_watched_by_media(f, m),
            "unique_visitors": reports.unique_visitors(f, m),
            "channel_summary": reports.channel_summary(f, m),
            "daily_channel_trend": reports.daily_channel_trend(f, m),
            "top_locations": reports.top_locations(v), "device_breakdown": reports.device_breakdown(v),
            "kpi": reports.kpi(f, m)}
    staged = in_parallel([lambda n=n, d=d: publish.stage(d, root, f"reports/{n}", version) for n, d in outs.items()])
    report.rows["reports"] = sum(written_rows(seen) for _, seen in staged)
    return {f"reports/{n}": entry for n, (entry, _) in zip(outs, staged)}


def run_daily(spark: SparkSession, sf_dir: str, root: str, with_reports: bool = True,
              as_of: dt.datetime | None = None, run_id: str | None = None) -> RunReport:
    """One daily run over the generated tables: land them as bronze, then
    ``process_bronze`` (the checks that generated percents break by design are waived)."""
    report = RunReport(root=root)
    _timed(report, "land", lambda: land_all(spark, sf_dir, f"{root}/bronze"))
    return process_bronze(spark, f"{root}/bronze", root, TD.media_config(spark, sf_dir), with_reports=with_reports,
                          as_of=as_of, run_id=run_id, report=report, waived=TD.WAIVED_CHECKS)


def process_bronze(spark: SparkSession, bronze_root: str, root: str, media_config: DataFrame,
                   with_reports: bool = True, as_of: dt.datetime | None = None, run_id: str | None = None,
                   report: RunReport | None = None, waived: Collection[str] = ()) -> RunReport:
    """Silver -> gold -> checks -> reports from an existing bronze folder
    (lines or one document a file), writing under ``root``; what could not be
    decoded is landed in ``root/quarantine`` and counted in the report.

    Gold and reports are staged as a version.  If every check passes (but for
    those ``waived`` by name), one commit makes the version current and
    advances the watermark; else ``QualityGateError`` (with the ``report``) is
    raised, and readers, reports and watermark stay as they were (the next run
    covers the window again: at-least-once, made idempotent by the latest-wins
    silver transforms).  A commit by another run meanwhile refuses this one.
    ``media_config`` is the configured ``(media_id, channel)`` list the
    row-count check expects."""
    report = report or RunReport(root=root)
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    run_id = run_id or bronze.new_run_id(as_of)
    seq, previous, _ = incremental.head(incremental.read_state(spark, f"{root}/{STATE}"))
    report.window = incremental.resolve_window(as_of=as_of, previous_watermark=previous)
    version = bronze.file_part(run_id)
    _timed(report, "silver", lambda: build_silver(spark, bronze_root, root, report, run_id))
    manifest = _timed(report, "gold", lambda: build_gold(spark, f"{root}/silver", root, version, report))
    results = checks.check_gold(*read_gold(spark, root, manifest), media_config)

    def run_checks() -> None:
        report.check_lines = _timed(report, "quality", lambda: report_lines(results))

    def run_reports() -> None:
        manifest.update(_timed(report, "reports", lambda: stage_reports(spark, root, version, manifest, report)))

    in_parallel([run_checks, run_reports] if with_reports else [run_checks])
    _gate(report, waived)
    _commit(spark, root, report, run_id, manifest, seq)
    return report


def _commit(spark: SparkSession, root: str, report: RunReport, run_id: str, manifest: publish.Manifest, seq: int) -> None:
    candidate = incremental.state_row(spark, report.window, run_id, dt.datetime.now(dt.timezone.utc), "shared",
                                      report.rows.get("gold.dim_visitor", 0), report.rows.get("gold.dim_media", 0),
                                      publish.to_text(manifest))
    report.watermark_committed = incremental.commit(spark, f"{root}/{STATE}", candidate, expected_seq=seq)


INCREMENTAL_UPSERTS = {   # dataset -> (keys, partition columns): latest version per key wins
    "events": (["event_key"], ["event_date"]),
    "media_stats_by_date": (["media_id", "metric_date"], ["metric_date"]),
}
INCREMENTAL_APPENDS = ("media_stats", "media_metadata")   # one snapshot per run: new partitions


def _days(spark: SparkSession, window: incremental.RunWindow) -> DataFrame:
    """Every day of a run's window and the null day, as ``date``."""
    span = (window.end_date - window.start_date).days
    return spark.createDataFrame([(window.start_date + dt.timedelta(i),) for i in range(span + 1)] + [(None,)], "date date")


def _pending_days(spark: SparkSession, root: str, state: DataFrame) -> DataFrame:
    """Days that merges of runs without a commit touched (a refused or lost run), as ``date``."""
    path = f"{root}/{TOUCHED}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "date date")
    committed = state.select(F.col("last_successful_run.pipeline_run_id").alias("run_id"))
    touched = spark.read.schema("date date, dataset string, run_id string").parquet(path)
    return touched.join(committed, "run_id", "left_anti").select("date")


def run_incremental(spark: SparkSession, sf_dir: str, root: str, as_of: dt.datetime, lookback_days: int = 1,
                    initial_start_date: str | None = None, waived: Collection[str] = TD.WAIVED_CHECKS) -> RunReport:
    """One incremental run: only the window is landed, merged and recomputed.

    window = watermark - lookback .. as_of (bootstrap: ``initial_start_date``)
    -> land this run's envelopes under its own folder -> silver: latest-wins
    upsert of the touched ``event_date`` / ``metric_date`` partitions (found by
    the key index), new snapshot partitions for per-run datasets, several of one
    day side by side -> gold, staged: ``dim_media`` from silver
    (catalogue-sized); the visitor partials (one row per visitor, media and
    day) and the fact only for the window's days, the undated rows, the days
    that merged rows left or joined, and those of runs that were not
    committed; ``dim_visitor`` re-aggregated from the partials (visitor-day-sized,
    not event-sized) -> checks (the fact's metric rules summed from per-day
    partials kept for the rewritten days) -> one commit makes the staged
    partitions current and advances the watermark.  Re-running a run, or
    overlapping windows, converge to the same tables (latest-wins merge,
    deterministic recompute); a refused run changes nothing that readers see.
    """
    report = RunReport(root=root)
    state = incremental.read_state(spark, f"{root}/{STATE}")
    seq, previous, published = incremental.head(state)
    before = publish.from_text(published)
    window = incremental.resolve_window(as_of=as_of, previous_watermark=previous, lookback_days=lookback_days,
                                        initial_start_date=initial_start_date)
    report.window = window
    run_id = bronze.new_run_id(as_of)
    version = bronze.file_part(run_id)
    landed_at = as_of.astimezone(dt.timezone.utc).isoformat()
    ingest_day = as_of.astimezone(dt.timezone.utc).date().isoformat()
    b, s = f"{root}/bronze", f"{root}/silver"
    envs = TD.window_envelopes(spark, sf_dir, window.start_date, window.end_date, run_id, landed_at)
    _timed(report, "land", lambda: in_parallel([lambda d=d, e=e: bronze.land(
        e, b, d, TD.FINISH.get(d), bronze.LINES_PER_FILE_OF_ONE_RUN) for d, e in envs.items()]))

    def merge(ds: str) -> None:
        rows, frame, seen = _silver_rows(spark, b, ds, bronze.run_folder(b, ds, ingest_day, run_id))
        if ds in INCREMENTAL_UPSERTS:
            keys, parts = INCREMENTAL_UPSERTS[ds]
            incremental.upsert_latest(
                spark, rows, f"{s}/{ds}", keys, "ingested_at", parts, cluster_by=SILVER_CLUSTER[ds],
                before_replacing=lambda touched: touched.toDF("date").write.mode("overwrite").parquet(
                    f"{root}/{TOUCHED}/run_id={run_id}/dataset={ds}"))
        else:
            write_table(rows, s, ds, SILVER_PARTITIONS[ds], mode="overwrite", dynamic=True, cluster_by=SILVER_CLUSTER[ds])
        _land_rejects(spark, root, ds, run_id, frame, seen, report)
    _timed(report, "silver", lambda: in_parallel([lambda d=d: merge(d) for d in envs]))
    # the window's days, no day, and the days that merged rows left or joined, in this run or one without a commit
    days = _days(spark, window).unionByName(_pending_days(spark, root, state)).distinct().checkpoint(eager=True)
    values = [r[0] for r in days.collect()]                                  # at most a row per day of the data

    def stage_days(df: DataFrame, table: str, by: str, cluster_by=()) -> tuple[publish.Entry, publish.Entry, Observation]:
        """(entry of the staged days, entry with them in place, what was seen)."""
        staged, seen = publish.stage(df, root, table, version, by, cluster_by)
        return staged, publish.replacing(before.get(table), staged, values), seen

    def rebuild_gold() -> publish.Manifest:
        events = _silver(spark, s, "events")
        metadata, stats = _silver(spark, s, "media_metadata"), _silver(spark, s, "media_stats")
        by_date = _silver(spark, s, "media_stats_by_date")
        window_events = incremental.in_partitions(events, days.toDF("event_date"), ["event_date"])
        made: publish.Manifest = {}

        def media_and_fact() -> None:
            made[DIM_MEDIA], o1 = publish.stage(gold.build_dim_media(metadata, stats, stamp=True), root, DIM_MEDIA, version)
            fact = gold.build_fact(window_events, publish.open_table(spark, root, made, DIM_MEDIA),
                                   incremental.in_partitions(by_date, days.toDF("metric_date"), ["metric_date"]), stamp=True)
            staged, made[FACT], o3 = stage_days(fact, FACT, "date", FACT_CLUSTER)
            # check counts of the rewritten days only (the other days' partials stand)
            partials = checks.fact_check_partials(publish.open_table(spark, root, {FACT: staged}, FACT))
            _, made[FACT_CHECK_PARTIALS], _ = stage_days(partials, FACT_CHECK_PARTIALS, "date")
            report.rows.update({"gold.dim_media": written_rows(o1), "gold.fact_media_engagement.window": written_rows(o3)})

        def visitors() -> None:
            # visitor partials per (visitor, media, day): only the window's days are recomputed
            _, made[VISITOR_PARTIALS], _ = stage_days(
                gold.visitor_partials(window_events, ("visitor_key", "media_id", "event_date")), VISITOR_PARTIALS,
                "event_date", ["visitor_key"])
            partials = publish.open_table(spark, root, made, VISITOR_PARTIALS)
            dim_visitor = gold.dim_visitor_from_partials(gold.merge_visitor_partials(partials), stamp=True)
            made[DIM_VISITOR], o2 = publish.stage(dim_visitor, root, DIM_VISITOR, version)
            report.rows["gold.dim_visitor"] = written_rows(o2)

        in_parallel([media_and_fact, visitors])
        return made
    manifest = before | _timed(report, "gold", rebuild_gold)
    results = checks.check_gold(*read_gold(spark, root, manifest), TD.media_config(spark, sf_dir),
                                fact_partials=publish.open_table(spark, root, manifest, FACT_CHECK_PARTIALS))
    report.check_lines = _timed(report, "quality", lambda: report_lines(results))
    _gate(report, waived)
    _commit(spark, root, report, run_id, manifest, seq)
    return report
