"""Incremental runs: window resolution, watermark state, latest-wins upsert.

The window is a small driver-side decision over at most one state row; the
data work is a date predicate (a partition filter on date-partitioned
tables).  The watermark is the *run clock*, advanced only after a
successful run and only forward.  The state is a sequence of numbered commit
files, one per committed run: a commit creates the file of the next number,
which only one of several runs at once can do; the current state is the file of
the highest number.  A commit also carries the manifest of what the run
published (``plans.publish``).

Re-reading the lookback window lands overlapping events again; the overlap
is removed by ``upsert_latest``: the touched partitions of the silver table
are merged with the new rows, the newest version per key is kept, and only
those partitions are replaced (dynamic partition overwrite).  The overwrite is
staged aside and its folders are moved in place once all of it is written, so
the merge reads the folders that it replaces and is written in one pass; lost
tasks are recomputed from files that are still there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagelake.constants import DEFAULT_LOOKBACK_DAYS, SOURCE_NAME, WATERMARK_FIELD
from engagelake.operators.broadcast import counted_broadcast
from engagelake.operators.latest import latest_by
from engagelake.sources.files import child_folders, create_if_absent, observed, path_exists, remove_folder, remove_partition


@dataclass(frozen=True)
class RunWindow:
    """Days that a run covers, and why: ``origin`` names the rule that set the first day."""

    start_date: dt.date
    end_date: dt.date
    origin: str                          # explicit, disabled, watermark, initial or default
    clock: dt.datetime
    based_on: str | None = None          # the watermark text behind the window, if any
    commit_explicit: bool = False

    @property
    def next_watermark(self) -> str:
        return self.clock.isoformat()

    @property
    def should_update_watermark(self) -> bool:
        return self.commit_explicit if self.origin == "explicit" else self.origin != "disabled"


def parse_watermark(value: str) -> dt.datetime:
    """ISO text -> aware UTC datetime; ``Z`` accepted, naive means UTC."""
    parsed = dt.datetime.fromisoformat(value)          # handles a trailing Z (Python 3.11+)
    return (parsed if parsed.tzinfo else parsed.replace(tzinfo=dt.timezone.utc)).astimezone(dt.timezone.utc)


def resolve_window(*, as_of: dt.datetime, previous_watermark: str | None = None,
                   lookback_days: int = DEFAULT_LOOKBACK_DAYS, initial_start_date: str | None = None,
                   explicit_start: str | None = None, explicit_end: str | None = None,
                   disable_watermark: bool = False, update_on_explicit: bool = False) -> RunWindow:
    """The window of the first rule that applies, in this order: explicit days; no watermark wanted
    (from yesterday); the watermark less the lookback; a configured first day; yesterday."""
    clock = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    today = clock.astimezone(dt.timezone.utc).date()
    yesterday = today - dt.timedelta(days=1)
    days = [dt.date.fromisoformat(d) for d in (explicit_start, explicit_end) if d]
    if len(days) == 1:
        raise ValueError("an explicit window needs a first and a last day")
    first_days = {
        "explicit": lambda: days[0] if days else None,
        "disabled": lambda: yesterday if disable_watermark else None,
        "watermark": lambda: (parse_watermark(previous_watermark) - dt.timedelta(days=lookback_days)).date()
        if previous_watermark else None,
        "initial": lambda: dt.date.fromisoformat(initial_start_date) if initial_start_date else None,
        "default": lambda: yesterday,
    }
    origin, start = next((name, day) for name, rule in first_days.items() if (day := rule()) is not None)
    return RunWindow(start, days[1] if days else today, origin, clock,
                     based_on=previous_watermark if origin == "watermark" else None,
                     commit_explicit=update_on_explicit and not disable_watermark)


def in_window(df: DataFrame, window: RunWindow, date_col: str = "event_date") -> DataFrame:
    """Both ends included; literal bounds so a date-partitioned scan prunes."""
    return df.filter(F.col(date_col).between(F.lit(window.start_date), F.lit(window.end_date)))


# -- watermark state table -------------------------------------------------------

STATE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("watermark_field", T.StringType()),
    T.StructField("watermark_value", T.StringType()),
    T.StructField("watermark_ts", T.TimestampType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("last_successful_run", T.StructType([
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("completed_at", T.StringType()),
        T.StructField("storage_mode", T.StringType()),
        T.StructField("visitor_count", T.LongType()),
        T.StructField("media_count", T.LongType()),
    ])),
    T.StructField("seq", T.LongType()),
    T.StructField("published", T.StringType()),
])


class CommitConflict(RuntimeError):
    pass


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """State history; empty frame of the state schema when missing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).option("pathGlobFilter", "*.json").json(path)


def head(state: DataFrame) -> tuple[int, str | None, str | None]:
    """(number, watermark text, published manifest) of the newest commit; number 0 where there is none."""
    row = state.agg(F.max_by(F.struct("seq", "watermark_value", "published"), "seq").alias("h")).first()["h"]
    return tuple(row) if row else (0, None, None)


def current_watermark(state: DataFrame, as_of: dt.datetime | None = None) -> str | None:
    """Newest committed watermark (at or before ``as_of``): one-row aggregate."""
    s = state
    if as_of is not None:
        s = s.filter(F.col("watermark_ts") <= F.lit(as_of))
    row = s.agg(F.max_by("watermark_value", "watermark_ts").alias("wm")).first()
    return row["wm"] if row else None


def accepted_commits(candidates: DataFrame, order_col: str = "seq") -> DataFrame:
    """Monotone commit over a sequence of candidate states: a candidate is
    kept only when its watermark is strictly newer than every one before it
    (equal or older -> skipped).  Partitioned per source, ordered by the
    processing sequence (one row per run, not per data row)."""
    w = (Window.partitionBy("source").orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, -1))
    prior = F.max("watermark_ts").over(w)
    return (candidates.withColumn("_prior", prior)
            .filter(F.col("_prior").isNull() | (F.col("watermark_ts") > F.col("_prior")))
            .drop("_prior"))


def state_row(spark: SparkSession, window: RunWindow, run_id: str, completed_at: dt.datetime,
              storage_mode: str, visitor_count: int, media_count: int, published: str | None = None) -> DataFrame:
    completed = completed_at.isoformat()
    return spark.createDataFrame([(
        SOURCE_NAME, WATERMARK_FIELD, window.next_watermark, parse_watermark(window.next_watermark), completed,
        (run_id, window.start_date.isoformat(), window.end_date.isoformat(), completed, storage_mode,
         visitor_count, media_count), None, published)], STATE_SCHEMA)


def commit(spark: SparkSession, path: str, candidate: DataFrame, expected_seq: int | None = None) -> bool:
    """Make the candidate the newest state if its watermark is strictly newer than the stored one.

    The state is compared and set: the next number is created only if no other run has created it.  A run that
    built on commit ``expected_seq`` is refused (``CommitConflict``) once there is another; without it, the
    comparison is made again on the newer state."""
    newest = candidate.agg(F.max_by("watermark_value", "watermark_ts")).first()[0]
    while True:
        seq, stored, _ = head(read_state(spark, path))
        if expected_seq is not None and seq != expected_seq:
            raise CommitConflict(f"the run built on commit {expected_seq}, the newest is {seq}")
        if stored is not None and (newest is None or parse_watermark(newest) <= parse_watermark(stored)):
            return False
        text = candidate.withColumn("seq", F.lit(seq + 1).cast("long")).select(F.to_json(F.struct("*"))).first()[0]
        if create_if_absent(spark, f"{path}/{seq + 1:012d}.json", text + "\n"):
            return True


# -- latest-wins upsert into a partitioned table ------------------------------------

#: Up to so many touched partitions are named as literals, which prunes the scan when it is planned.
MAX_LITERAL_PARTITIONS = 10_000


def same_values(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Null-safe equality of both frames in ``columns``."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def in_partitions(table: DataFrame, touched: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``table`` in the partitions listed in ``touched``, null partitions included.

    Partition values up to ``MAX_LITERAL_PARTITIONS`` become literal partition
    filters; a longer list is left to the join alone."""
    listed = touched.select(*partition_cols).take(MAX_LITERAL_PARTITIONS + 1)
    if len(listed) <= MAX_LITERAL_PARTITIONS:
        for c in partition_cols:
            values = {row[c] for row in listed}
            test = F.col(c).isin(sorted(v for v in values if v is not None))
            table = table.filter(test | F.col(c).isNull() if None in values else test)
        if len(partition_cols) == 1:
            return table
    return table.join(touched, same_values(table, touched, partition_cols), "left_semi")


def replace_partitions(spark: SparkSession, rows: DataFrame, path: str, touched: DataFrame,
                       partition_cols: Sequence[str], cluster_by: Sequence[str] = (),
                       finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Make ``rows`` the whole content of the ``touched`` partitions of the table at ``path``.

    Dynamic overwrite replaces the partitions that ``rows`` has; touched ones
    without a row left are removed.  Which have one is observed during the
    write, so ``rows`` is evaluated once; it may read ``path``, whose folders
    are only replaced when all is written.  ``finish`` completes the rows after
    they were dealt to the files, so that what it derives is not shuffled."""
    values = [F.col(c).cast("string").alias(c) for c in partition_cols]
    seen = Observation("filled")
    dealt = (rows.observe(seen, F.collect_set(F.struct(*values)).alias("filled"))
             .hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, *cluster_by))
    ((finish(dealt) if finish else dealt)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path))
    filled = {tuple(row) for row in observed(seen, "filled") or ()}
    for row in touched.select(*values).distinct().collect():
        if tuple(row) not in filled:
            remove_partition(spark, path, row.asDict())


# -- key index: which partitions hold a key ------------------------------------------

#: A new key index gets a bucket for so many keys of its first rows, within the limits; an existing one keeps its number.
KEYS_PER_BUCKET = 1_000_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 4096
_BUCKET = "_bucket"
#: Up to so many incoming keys are hashed in memory, spread over the tasks of a shuffle, to look them up in the index; more are sorted.
PLACES_TO_HASH = 4_000_000


def _index_root(path: str) -> str:
    return f"{path.rstrip('/')}.keys"


def _buckets_of(spark: SparkSession, path: str) -> int | None:
    """Number of buckets of the index of the table at ``path``, if there is one."""
    return next((int(name[3:]) for name in child_folders(spark, _index_root(path)) if name.startswith("of=")), None)


def _buckets_for(keys: int) -> int:
    return min(max(-(-keys // KEYS_PER_BUCKET), LEAST_BUCKETS), MOST_BUCKETS)


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _add_to_index(spark: SparkSession, folder: str, rows: DataFrame, mode: str = "append") -> None:
    rows.hint("rebalance", _BUCKET).write.mode(mode).partitionBy(_BUCKET).parquet(folder)


def rebuild_key_index(spark: SparkSession, path: str, keys: Sequence[str], partition_cols: Sequence[str],
                      schema: T.StructType, buckets: int | None = None) -> None:
    """Write the index of a table anew from its key and partition columns (maintenance: stale and small files go)."""
    remove_folder(spark, _index_root(path))
    held = spark.read.schema(schema).parquet(path).select(*dict.fromkeys([*keys, *partition_cols])).distinct()
    buckets = buckets or _buckets_for(held.count())
    _add_to_index(spark, f"{_index_root(path)}/of={buckets}", _bucketed(held, keys, buckets), "overwrite")


def _indexed_partitions(spark: SparkSession, path: str, new_rows: DataFrame, keys: Sequence[str],
                        partition_cols: Sequence[str], buckets: int | None) -> DataFrame:
    """Partitions that hold or held a key of ``new_rows``, by the index, which learns the new rows' places first.

    Only the buckets of the incoming keys are read, once, and matched by a hash table of these keys; what follows works
    on the matches alone.  An entry is added before the table changes and never removed here: after a
    lost run the index may name a partition too many, never one too few."""
    if path_exists(spark, path) and not child_folders(spark, _index_root(path)):
        rebuild_key_index(spark, path, keys, partition_cols, new_rows.schema, buckets)
    columns = list(dict.fromkeys([*keys, *partition_cols]))
    distinct = new_rows.select(*columns).distinct().checkpoint(eager=True)       # not cached: that would keep every shuffle partition
    known, count = _buckets_of(spark, path), distinct.count()
    buckets = known or buckets or _buckets_for(count)
    folder, places = f"{_index_root(path)}/of={buckets}", _bucketed(distinct, keys, buckets)
    if known is None:
        _add_to_index(spark, folder, places)
        return places.select(*partition_cols).distinct().checkpoint(eager=True)
    asked = sorted(r[0] for r in places.select(_BUCKET).distinct().collect())         # at most ``buckets`` rows
    index = spark.read.schema(places.schema).parquet(folder).filter(F.col(_BUCKET).isin(asked)).select(*columns)
    sought = counted_broadcast(distinct.select(*keys), count)
    if count <= PLACES_TO_HASH:
        sought = sought.hint("shuffle_hash")                                          # where it is not broadcast
    held = index.join(sought, same_values(index, sought, keys), "left_semi").checkpoint(eager=True)
    found = distinct.select(*partition_cols).unionByName(held.select(*partition_cols)).distinct().checkpoint(eager=True)
    _add_to_index(spark, folder, places.join(held, same_values(places, held, columns), "left_anti"))
    return found


def upsert_latest(spark: SparkSession, new_rows: DataFrame, path: str, keys: Sequence[str],
                  order_col: str, partition_cols: Sequence[str], tiebreak: Sequence[str] | None = None,
                  cluster_by: Sequence[str] = (), buckets: int | None = None,
                  before_replacing: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Merge ``new_rows`` into the table at ``path`` keeping the newest row per
    key; returns the touched partition values (null is one of them).

    Touched are the partitions of ``new_rows`` and those that hold an incoming
    key so far (a key can move, e.g. when an event's time is corrected).  The
    latter come from the table's key index, kept beside it; no index is needed
    where the keys hold the partition columns.  Only touched partitions of the
    table are read, and replaced.  ``before_replacing`` is told the touched
    partitions before the table changes."""
    new_rows = new_rows.persist(StorageLevel.MEMORY_AND_DISK)   # read for touched partitions, keys and the merge
    try:
        if set(partition_cols) <= set(keys):
            touched = new_rows.select(*partition_cols).distinct().checkpoint(eager=True)
        else:
            touched = _indexed_partitions(spark, path, new_rows, keys, partition_cols, buckets)
        if before_replacing:
            before_replacing(touched)
        merged = new_rows
        if path_exists(spark, path):
            existing = spark.read.schema(new_rows.schema).parquet(path)
            merged = new_rows.unionByName(in_partitions(existing, touched, partition_cols).select(*new_rows.columns))
        replace_partitions(spark, latest_by(merged, keys, order_col, tiebreak=tiebreak), path, touched, partition_cols, cluster_by)
    finally:
        new_rows.unpersist()
    return touched


def compact_latest(spark: SparkSession, path: str, keys: Sequence[str], order_col: str,
                   partition_cols: Sequence[str] = (), tiebreak: Sequence[str] | None = None) -> int:
    """Maintenance: rewrite a per-run snapshot table keeping only the newest
    row per key (e.g. silver ``media_stats`` before ``dim_media`` scans it).
    The result goes through a reliable ``checkpoint()`` before the table is
    replaced, so the rewrite never reads the folders it overwrites."""
    table = spark.read.parquet(path)
    latest = latest_by(table, keys, order_col, tiebreak=tiebreak).checkpoint(eager=True)
    writer = latest.write.mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return spark.read.parquet(path).count()
