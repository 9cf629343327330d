"""Silver -> gold: the media and visitor dimensions and the daily fact.

Builders are pure ``DataFrame -> DataFrame`` functions over silver-shaped
inputs.  Input contract: silver events are unique per ``event_key`` (the
silver transform keeps the latest version per key), so the number of
distinct events in a group equals the number of event keys in it; the
``events_unique=False`` switch restores explicit distinct counting for
inputs without that guarantee.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagelake.constants import HOURS_SCALE, PERCENT_SCALE, RATE_SCALE, SECONDS_SCALE
from engagelake.functions.scalar import plain_decimal, pseudonym, safe_ratio
from engagelake.operators.broadcast import sized_broadcast
from engagelake.operators.latest import latest_by

DIM_MEDIA_COLUMNS = ["media_id", "numeric_id", "title", "description", "channel", "duration_seconds",
                     "media_type", "status", "archived", "created_at", "updated_at"]
VISITOR_ATTRS = ["country", "region", "city", "browser", "browser_version", "platform", "mobile"]
DIM_VISITOR_COLUMNS = ["visitor_id", *VISITOR_ATTRS, "first_seen_at", "last_seen_at", "event_count",
                       "distinct_media_count", "avg_percent_viewed", "max_percent_viewed"]
FACT_COLUMNS = ["media_id", "visitor_id", "date", "play_count", "play_rate", "total_watch_time_seconds",
                "total_watch_time_hours", "watched_percent", "media_load_count", "media_play_count",
                "media_hours_watched"]


def _stamp(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("gold_loaded_at", F.current_timestamp()) if stamp else df


# -- dim_media ---------------------------------------------------------------

def build_dim_media(media_metadata: DataFrame, media_stats: DataFrame, stamp: bool = False) -> DataFrame:
    """Latest metadata per media, left-joined with the latest stats' channel.

    A media without stats keeps a null channel.  Both sides are one row per
    ``media_id`` after ``latest_by``, so the join cannot fan out and no final
    de-duplication is needed (checked by ``qc_dim_media``).
    """
    meta = latest_by(media_metadata, ["media_id"], "ingested_at", tiebreak=["pipeline_run_id"])
    chan = latest_by(media_stats.select("media_id", "channel", "pipeline_run_id", "ingested_at"),
                     ["media_id"], "ingested_at", tiebreak=["pipeline_run_id", "channel"])
    out = meta.join(chan.select("media_id", "channel"), "media_id", "left").select(*DIM_MEDIA_COLUMNS)
    return _stamp(out, stamp)


def media_durations(media_metadata: DataFrame) -> DataFrame:
    """``(media_id, duration_seconds)`` of the latest metadata version.

    Row-for-row equal to ``dim_media``'s two columns (the channel join there
    cannot add or drop rows), but without the stats branch, so the fact's
    duration lookup stays a size-checked broadcast of the catalogue.
    """
    meta = latest_by(media_metadata.select("media_id", "duration_seconds", "pipeline_run_id", "ingested_at"),
                     ["media_id"], "ingested_at", tiebreak=["pipeline_run_id"])
    return meta.select("media_id", "duration_seconds")


# -- dim_visitor -------------------------------------------------------------

def visitor_partials(events: DataFrame, keys=("visitor_key", "media_id")) -> DataFrame:
    """Mergeable per-visitor partials at the grain ``keys``: first/last seen,
    event count, unrounded percent sum / count / max, and the attributes of
    the newest event with its order key.  Keyed by the raw visitor key."""
    ev = events.filter(F.col("visitor_key").isNotNull())
    order = F.struct(F.col("received_at"), F.col("event_key"))
    attrs = F.struct(*[F.col(c) for c in VISITOR_ATTRS])
    return ev.groupBy(*keys).agg(
        F.min("received_at").alias("first_seen_at"),
        F.max("received_at").alias("last_seen_at"),
        F.count("event_key").alias("n_events"),
        F.sum("percent_viewed").alias("pct_sum"),
        F.count("percent_viewed").alias("pct_n"),
        F.max("percent_viewed").alias("pct_max"),
        F.max_by(attrs, order).alias("attrs"),
        F.max(order).alias("attrs_order"),
    )


def merge_visitor_partials(partials: DataFrame, keys=("visitor_key", "media_id")) -> DataFrame:
    """Re-aggregate partials to the coarser grain ``keys`` (same columns)."""
    return partials.groupBy(*keys).agg(
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("n_events").alias("n_events"),
        F.sum("pct_sum").alias("pct_sum"),
        F.sum("pct_n").alias("pct_n"),
        F.max("pct_max").alias("pct_max"),
        F.max_by("attrs", "attrs_order").alias("attrs"),
        F.max("attrs_order").alias("attrs_order"),
    )


def dim_visitor_from_partials(per_media: DataFrame, stamp: bool = False) -> DataFrame:
    """Final level: per-(visitor, media) partials -> one row per visitor; the
    distinct media count is the number of (non-null) media rows."""
    per_visitor = per_media.groupBy("visitor_key").agg(
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("n_events").alias("event_count"),
        F.count("media_id").alias("distinct_media_count"),
        (F.sum("pct_sum") / F.sum("pct_n")).alias("avg_percent_viewed"),
        F.max("pct_max").alias("max_percent_viewed"),
        F.max_by("attrs", "attrs_order").alias("attrs"),
    )
    out = per_visitor.select(
        pseudonym("visitor_key").alias("visitor_id"),
        *[F.col(f"attrs.{c}").alias(c) for c in VISITOR_ATTRS],
        "first_seen_at", "last_seen_at", "event_count", "distinct_media_count",
        F.round("avg_percent_viewed", PERCENT_SCALE).alias("avg_percent_viewed"),
        F.round("max_percent_viewed", PERCENT_SCALE).alias("max_percent_viewed"),
    )
    return _stamp(out, stamp)


def build_dim_visitor(events: DataFrame, stamp: bool = False, events_unique: bool = True) -> DataFrame:
    """One row per visitor (pseudonymised) with first/last seen, counts and
    the place/device attributes of the newest event (ties: larger event key).

    Two-level aggregation: first per ``(visitor, media)`` -- which splits a
    hot visitor over many reducers and yields the distinct media count as a
    plain count -- then per visitor over the small partials.  The latest
    attributes ride along as ``max_by(attrs, (received_at, event_key))`` in
    the same aggregates, replacing a window plus self join.  (A struct
    buffer is variable-width, so Spark plans these as sort-based aggregates;
    they still combine map-side before each shuffle and spill gracefully.)
    The same partials at ``(visitor, media, day)`` grain are what the
    incremental run keeps, so the dimension is re-aggregated from them
    instead of from raw events.
    """
    ev = events
    if not events_unique:
        ev = latest_by(ev.filter(F.col("visitor_key").isNotNull()), ["event_key"], "received_at")
    return dim_visitor_from_partials(visitor_partials(ev), stamp)


def latest_visitor_attrs(events: DataFrame) -> DataFrame:
    """Attributes of each visitor's newest event (window form, ties by event key)."""
    ev = events.filter(F.col("visitor_key").isNotNull())
    latest = latest_by(ev.select("visitor_key", "received_at", "event_key", *VISITOR_ATTRS),
                       ["visitor_key"], "received_at", tiebreak=["event_key"])
    return latest.select(pseudonym("visitor_key").alias("visitor_id"), *VISITOR_ATTRS)


# -- fact_media_engagement ---------------------------------------------------

def watch_time(events: DataFrame, media: DataFrame) -> DataFrame:
    """Events with a visitor, left-joined with media duration:
    ``estimated_watch_seconds = percent_viewed * duration_seconds``."""
    ev = events.filter(F.col("visitor_key").isNotNull())
    durations = sized_broadcast(media.select("media_id", "duration_seconds"))
    return (ev.join(durations, "media_id", "left")
              .withColumn("estimated_watch_seconds", F.col("percent_viewed") * F.col("duration_seconds")))


def visitor_daily(events: DataFrame, media: DataFrame, events_unique: bool = True,
                  hash_ids: bool = True) -> DataFrame:
    """Visitor-day-media rollup: plays, average percent, summed watch time.

    Aggregates first, joins second: the duration is constant per media, so
    the summed ``percent_viewed * duration_seconds`` of a group is
    ``duration_seconds * sum(percent_viewed)`` (same nulls: a missing
    duration or all-null percents give null).  Percents and durations are
    taken as the decimals they are written as (9 and 6 decimals), summed and
    multiplied exactly and cast to double once, so that the two are equal to
    the last digit and no order of the rows shows.  The events are combined
    map-side and shuffled once by the group key; only the (much smaller)
    rollup meets the catalogue, so even a catalogue too large to broadcast
    never shuffles raw events by media (where one hot media would be one
    task).  Grouped on the raw visitor key and hashed afterwards: computed
    once per group, short shuffle key.
    """
    ev = events.filter(F.col("visitor_key").isNotNull())
    play = F.count("event_key") if events_unique else F.count_distinct("event_key")
    daily = ev.groupBy("media_id", "visitor_key", F.col("event_date").alias("date")).agg(
        play.alias("play_count"),
        F.sum(plain_decimal("percent_viewed", 9)).alias("_pct_sum"), F.count("percent_viewed").alias("_pct_n"),
    )
    durations = sized_broadcast(media.select("media_id", "duration_seconds"), bound=media)
    daily = (daily.join(durations, "media_id", "left")
                  .withColumn("watched_percent", F.try_divide(F.col("_pct_sum").cast("double"), F.col("_pct_n")))
                  .withColumn("total_watch_time_seconds", (plain_decimal("_pct_sum") * plain_decimal("duration_seconds", 9, 6))
                              .cast("double")))
    key = pseudonym("visitor_key").alias("visitor_id") if hash_ids else F.col("visitor_key")
    return daily.select("media_id", key, "date", "play_count", "watched_percent", "total_watch_time_seconds")


def with_visitor_ids(daily: DataFrame) -> DataFrame:
    """``visitor_daily`` with raw keys (``hash_ids=False``) -> with pseudonymous ids in their place."""
    return daily.select(*[pseudonym(c).alias("visitor_id") if c == "visitor_key" else c for c in daily.columns])


def media_daily_rate(media_stats_by_date: DataFrame) -> DataFrame:
    """Daily media stats on the fact's keys; ``play_rate`` only when loads > 0."""
    return media_stats_by_date.select(
        "media_id",
        F.col("metric_date").alias("date"),
        safe_ratio("play_count", "load_count").alias("play_rate"),
        F.col("load_count").alias("media_load_count"),
        F.col("play_count").alias("media_play_count"),
        F.col("hours_watched").alias("media_hours_watched"),
    )


def build_fact(events: DataFrame, media: DataFrame, media_stats_by_date: DataFrame,
               stamp: bool = False, events_unique: bool = True) -> DataFrame:
    """Grain ``(media_id, visitor_id, date)``; daily media stats repeat per row.

    Rounding: rate 6, seconds 2, hours 6 (from the *unrounded* seconds),
    percent 4.
    """
    daily = visitor_daily(events, media, events_unique)
    stats = sized_broadcast(media_daily_rate(media_stats_by_date))
    joined = daily.join(stats, ["media_id", "date"], "left")
    out = joined.select(
        "media_id", "visitor_id", "date", "play_count",
        F.round("play_rate", RATE_SCALE).alias("play_rate"),
        F.round("total_watch_time_seconds", SECONDS_SCALE).alias("total_watch_time_seconds"),
        F.round(F.col("total_watch_time_seconds") / F.lit(3600), HOURS_SCALE).alias("total_watch_time_hours"),
        F.round("watched_percent", PERCENT_SCALE).alias("watched_percent"),
        "media_load_count", "media_play_count", "media_hours_watched",
    )
    return _stamp(out, stamp)
