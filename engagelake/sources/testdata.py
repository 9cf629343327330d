"""Domain views over the generated test tables.

The generated tables (``events``, ``part``, ``customer``, ``nation``,
``region`` ...) stand in for the landed API data.  Each function here is a
plain projection / join / aggregate over those tables, so every query built
on them grows with the input.

Mapping rules (the same rules are written in SQL for the oracle):

* event: ``events`` row; ``event_key = string(event_id)``,
  ``visitor_key = string(user_id)``, ``media_id = 'm' || props.k``,
  ``received_at = ts``, ``event_date = date(ts)``,
  ``percent_viewed = floor(value) / 256`` (dyadic, so sums are exact in any
  order; values above 1 occur and are kept, as the source does not clamp).
* visitor place: ``customer`` -> ``nation`` -> ``region`` by ``user_id``.
* device: ``browser = event_type``, ``mobile = event_id even``.
* media catalogue: every ``part`` row, ``media_id = 'm' || p_partkey``;
  channel by key parity (configuration rule).
* daily media stats: events grouped by media and day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engagelake.constants import CHANNELS, DEFAULT_PAGE_SIZE
from engagelake.operators.aggregate import distinct_count
from engagelake.operators.broadcast import sized_broadcast
from engagelake.sources import bronze as BZ

PLAY_TYPES = ("view", "click")

#: Checks that the generated tables fail: watched percents reach above 1, catalogue items without an event have no channel.
WAIVED_CHECKS = ("dim_media.channel.not_null", "dim_visitor.avg_percent_viewed.between_0_and_1",
                 "dim_visitor.max_percent_viewed.between_0_and_1", "fact_media_engagement.watched_percent.between_0_and_1")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def channel_of(key: Column) -> Column:
    return F.when(key % 2 == 0, F.lit(CHANNELS[0])).otherwise(F.lit(CHANNELS[1]))


def _media_key(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


def run_id_of(day: Column) -> Column:
    """Daily run that landed the data of ``day`` (runs after the day closes)."""
    return F.concat(F.lit("run-"), F.date_format(day, "yyyyMMdd"))


def run_time_of(day: Column) -> Column:
    """02:00 UTC on the day after ``day``."""
    return day.cast("timestamp_ntz") + F.expr("INTERVAL 26 HOURS")


def play_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-events core columns (no place / device attributes)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("event_key"),
        F.col("user_id").cast("string").alias("visitor_key"),
        F.concat(F.lit("m"), _media_key(F.col("props"))).alias("media_id"),
        F.col("ts").alias("received_at"),
        F.col("ts").cast("date").alias("event_date"),
        (F.floor("value") / F.lit(256.0)).alias("percent_viewed"),
    )


def visitor_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: place attributes keyed by the visitor key text.

    Keyed by the string form so a join with events on ``visitor_key`` leaves
    the events hash-partitioned by the key later grouped on.  ``nation`` and
    ``region`` are fixed-size TPC-H tables; they still pass the size check.
    """
    cust = table(spark, sf_dir, "customer")
    nation = sized_broadcast(table(spark, sf_dir, "nation"))
    region = sized_broadcast(table(spark, sf_dir, "region"))
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
                .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
                .select(F.col("c_custkey").cast("string").alias("visitor_key"),
                        F.col("n_name").alias("country"),
                        F.col("r_name").alias("region"),
                        F.col("c_mktsegment").alias("city"),
                        F.col("c_nationkey").cast("double").alias("latitude"),
                        F.col("c_acctbal").alias("longitude"),
                        F.col("c_name").alias("organization")))


def places_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place table for joining to events: broadcast when small.  Its rows are
    bounded by ``customer`` (left joins on unique keys), which is the size
    check's bound -- the plain estimate of a join chain is a product."""
    return sized_broadcast(visitor_places(spark, sf_dir), bound=table(spark, sf_dir, "customer"))


def silver_events(spark: SparkSession, sf_dir: str, with_audit: bool = True) -> DataFrame:
    """Events in the silver schema (one row per event_key)."""
    ev = table(spark, sf_dir, "events")
    core = ev.select(
        F.col("event_id").cast("string").alias("event_key"),
        F.col("user_id").cast("string").alias("visitor_key"),
        F.concat(F.lit("m"), _media_key(F.col("props"))).alias("media_id"),
        F.concat(F.lit("media "), _media_key(F.col("props"))).alias("media_name"),
        F.col("ts").alias("received_at"),
        F.col("ts").cast("date").alias("event_date"),
        (F.floor("value") / F.lit(256.0)).alias("percent_viewed"),
        F.concat(F.lit("/embed/"), F.col("event_id").cast("string")).alias("embed_url"),
        F.concat(F.lit("/media/m"), _media_key(F.col("props"))).alias("media_url"),
        F.col("event_type").alias("browser"),
        (F.col("event_id") % 10).cast("string").alias("browser_version"),
        F.when(F.col("event_id") % 2 == 0, F.lit("mobile")).otherwise(F.lit("desktop")).alias("platform"),
        (F.col("event_id") % 2 == 0).alias("mobile"),
    )
    joined = core.join(places_lookup(spark, sf_dir), "visitor_key", "left")
    cols = ["event_key", "visitor_key", "media_id", "media_name", "received_at", "event_date",
            "percent_viewed", "country", "region", "city", "latitude", "longitude", "organization",
            "embed_url", "media_url", "browser", "browser_version", "platform", "mobile"]
    out = joined.select(*cols)
    if with_audit:
        out = out.select(*cols,
                         run_id_of(F.col("event_date")).alias("pipeline_run_id"),
                         run_time_of(F.col("event_date")).alias("ingested_at"),
                         F.col("event_date").alias("ingest_date"))
    return out


def media_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured media list ``(media_id, channel)``: one entry per catalogue item."""
    part = table(spark, sf_dir, "part")
    return part.select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("media_id"),
                       channel_of(F.col("p_partkey")).alias("channel"))


def media_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ``media_metadata``: one version per catalogue item."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("media_id"),
        F.col("p_partkey").alias("numeric_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("description"),
        (F.col("p_size") * F.lit(60.0)).alias("duration_seconds"),
        F.col("p_type").alias("media_type"),
        F.lit("ready").alias("status"),
        (F.col("p_size") % 2 == 0).alias("archived"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.lit("run-catalogue").alias("pipeline_run_id"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
    )


def media_day_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per media and day: loads, plays, hours (one partially-combined aggregate).

    Also the per-run ``media_stats`` snapshot: each daily run lands the
    stats of the day it closes.
    """
    ev = table(spark, sf_dir, "events")
    k = _media_key(F.col("props"))
    grouped = ev.groupBy(k.alias("k"), F.col("ts").cast("date").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("load_count"),
        F.count_if(F.col("event_type").isin(*PLAY_TYPES)).alias("play_count"),
        (F.sum(F.floor("value")) / F.lit(3600.0)).alias("hours_watched"),
        F.sum(F.floor("value")).alias("_pct_sum"),
    )
    return grouped.select(
        F.concat(F.lit("m"), F.col("k")).alias("media_id"),
        channel_of(F.col("k").cast("long")).alias("channel"),
        "metric_date", "load_count", "play_count", "hours_watched",
        (F.col("_pct_sum") / F.lit(256.0) / F.col("load_count")).alias("engagement"),
        run_id_of(F.col("metric_date")).alias("pipeline_run_id"),
        run_time_of(F.col("metric_date")).alias("ingested_at"),
    )


def media_day_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct visitors per media and day (skew-safe two-phase count)."""
    ev = table(spark, sf_dir, "events").select(
        F.concat(F.lit("m"), _media_key(F.col("props"))).alias("media_id"),
        F.col("ts").cast("date").alias("metric_date"), "user_id")
    return distinct_count(ev, ["media_id", "metric_date"], "user_id", "visitor_count")


def media_stats_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_day_stats(spark, sf_dir).select(
        "media_id", "channel", "metric_date", "load_count", "play_count", "hours_watched",
        "pipeline_run_id", "ingested_at")


def media_stats(spark: SparkSession, sf_dir: str, with_visitors: bool = True) -> DataFrame:
    """Silver ``media_stats``: one snapshot per media and daily run
    (``with_visitors=False`` leaves the visitor count null and skips it)."""
    s = media_day_stats(spark, sf_dir)
    if with_visitors:
        s = (s.join(media_day_visitors(spark, sf_dir), ["media_id", "metric_date"], "left")
              .withColumn("visitor_count", F.coalesce("visitor_count", F.lit(0).cast("long"))))
    else:
        s = s.withColumn("visitor_count", F.lit(None).cast("long"))
    return s.select("media_id", "channel", "load_count", "play_count",
                    F.when(F.col("load_count") > 0,
                           F.col("play_count") / F.col("load_count")).alias("play_rate"),
                    "hours_watched", "engagement", "visitor_count",
                    "pipeline_run_id", "ingested_at")


# -- API-shaped records and envelopes (bronze) -----------------------------------


MS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
LOOKBACK_LANDINGS = 2  # each day is landed by its own run and re-read by the next


def _landings(df: DataFrame, day_col: str) -> DataFrame:
    """Each row once per run that lands its day: the run of the day and the next run."""
    return (df.withColumn("_lag", F.explode(F.sequence(F.lit(0), F.lit(LOOKBACK_LANDINGS - 1))))
              .withColumn("_run_day", F.date_add(F.col(day_col), F.col("_lag"))))


def thin_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an event record is made of (``full_record``), with its day."""
    ev = table(spark, sf_dir, "events")
    base = ev.select(
        F.col("event_id").cast("string").alias("event_key"),
        F.col("user_id").cast("string").alias("visitor_key"),
        _media_key(F.col("props")).alias("k"),
        "ts", "value", "event_type",
        F.col("ts").cast("date").alias("event_date"),
    )
    return (base.join(places_lookup(spark, sf_dir), "visitor_key", "left")
                .withColumnRenamed("latitude", "lat").withColumnRenamed("longitude", "lon")
                .withColumnRenamed("organization", "org"))


THIN_RECORD_COLS = ["event_key", "visitor_key", "k", "ts", "value", "event_type",
                    "country", "region", "city", "lat", "lon", "org"]


def full_record(thin: Callable[[str], Column]) -> list[Column]:
    """The columns of a raw event record (API shape, personal fields included) from those of ``thin_events``."""
    event, user, k = thin("event_key").cast("long"), thin("visitor_key").cast("long"), thin("k")
    return [
        thin("event_key").alias("event_key"), thin("visitor_key").alias("visitor_key"),
        F.concat(F.lit("m"), k).alias("media_id"),
        F.concat(F.lit("media "), k).alias("media_name"),
        F.date_format(thin("ts"), MS_TEXT).alias("received_at"),
        (F.floor(thin("value")) / F.lit(256.0)).alias("percent_viewed"),
        *[thin(c).alias(c) for c in ("country", "region", "city", "lat", "lon", "org")],
        F.concat(F.lit("/embed/"), thin("event_key")).alias("embed_url"),
        F.concat(F.lit("/media/m"), k).alias("media_url"),
        F.concat(F.lit("10.0."), (user % 256).cast("string"), F.lit("."), (event % 256).cast("string")).alias("ip"),
        F.concat(F.lit("user"), thin("visitor_key"), F.lit("@example.invalid")).alias("email"),
        F.struct(thin("event_type").alias("browser"),
                 (event % 10).cast("string").alias("browser_version"),
                 F.when(event % 2 == 0, F.lit("mobile")).otherwise(F.lit("desktop")).alias("platform"),
                 (event % 2 == 0).alias("mobile")).alias("user_agent_details"),
    ]


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event records with their day."""
    return thin_events(spark, sf_dir).select(*full_record(F.col), "event_date", F.col("k").cast("long").alias("k"))


def full_events(env: DataFrame) -> DataFrame:
    """Envelopes of ``thin_events`` with whole records for a payload."""
    return env.withColumn("payload", F.transform("payload", lambda r: F.struct(*full_record(lambda c: r[c]))))


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs that land events (``events_envelopes``), one row each."""
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("event_date")).distinct()
    return _landings(days, "event_date").select(run_id_of(F.col("_run_day")).alias("pipeline_run_id")).distinct()


EVENT_RECORD_COLS = ["event_key", "visitor_key", "media_id", "media_name", "received_at", "percent_viewed",
                     "country", "region", "city", "lat", "lon", "org", "embed_url", "media_url", "ip", "email",
                     "user_agent_details"]


def thin_events_envelopes(spark: SparkSession, sf_dir: str, per_page: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Paged event responses per (media, run); every day re-landed by the next run; payloads as ``full_events`` takes them."""
    rec = _landings(thin_events(spark, sf_dir), "event_date")
    paged = BZ.page_records(rec, ["k", "_run_day"], "event_key", per_page)
    media_id = F.concat(F.lit("m"), F.col("k"))
    params = F.create_map(F.lit("media_id"), media_id,
                          F.lit("start_date"), F.date_sub("_run_day", 1).cast("string"),
                          F.lit("end_date"), F.col("_run_day").cast("string"),
                          F.lit("page"), F.col("page").cast("string"),
                          F.lit("per_page"), F.lit(str(per_page)))
    return BZ.envelopes(paged, dataset="events", endpoint="/stats/events",
                        run_id=run_id_of(F.col("_run_day")),
                        ingested_at=BZ.run_stamp(run_time_of(F.col("_run_day"))),
                        media_id=media_id, channel=channel_of(F.col("k").cast("long")),
                        record_cols=THIN_RECORD_COLS, request_params=params,
                        group_cols=["page"])


def events_envelopes(spark: SparkSession, sf_dir: str, per_page: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Paged event responses with whole records."""
    return full_events(thin_events_envelopes(spark, sf_dir, per_page))


def media_stats_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = (media_day_stats(spark, sf_dir).join(media_day_visitors(spark, sf_dir), ["media_id", "metric_date"], "left")
         .withColumn("visitors", F.coalesce("visitor_count", F.lit(0).cast("long")))).withColumn(
        "play_rate", F.when(F.col("load_count") > 0, F.col("play_count") / F.col("load_count")))
    return BZ.envelopes(s, dataset="media_stats", endpoint="/stats/medias/{media_id}",
                        run_id=F.col("pipeline_run_id"), ingested_at=BZ.run_stamp(F.col("ingested_at")),
                        media_id=F.col("media_id"), channel=F.col("channel"),
                        record_cols=["load_count", "play_count", "play_rate", "hours_watched", "engagement",
                                     "visitors"], array_payload=False)


def media_stats_by_date_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (media, run): the run's day and the day before (lookback overlap)."""
    s = _landings(media_day_stats(spark, sf_dir), "metric_date").withColumn(
        "date", F.col("metric_date").cast("string"))
    return BZ.envelopes(s, dataset="media_stats_by_date", endpoint="/stats/medias/{media_id}/by_date",
                        run_id=run_id_of(F.col("_run_day")),
                        ingested_at=BZ.run_stamp(run_time_of(F.col("_run_day"))),
                        media_id=F.col("media_id"), channel=F.col("channel"),
                        record_cols=["date", "load_count", "play_count", "hours_watched"])


def media_engagement_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement timelines from ``embeddings``: points = floor(1000 x), rewatch
    = the first ``label + 1`` points reversed (uneven lengths)."""
    emb = table(spark, sf_dir, "embeddings")
    pts = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(1000.0)))
    rec = emb.select(
        F.concat(F.lit("m"), F.col("vec_id").cast("string")).alias("media_id"),
        channel_of(F.col("vec_id")).alias("channel"),
        pts.alias("engagement_data"),
        F.reverse(F.slice(pts, 1, F.col("label") + 1)).alias("rewatch_data"),
        (F.col("label") / F.lit(4.0)).alias("engagement"))
    return BZ.envelopes(rec, dataset="media_engagement", endpoint="/stats/medias/{media_id}/engagement",
                        run_id=F.lit("run-engagement"), ingested_at=F.lit("2024-01-31T02:00:00+00:00"),
                        media_id=F.col("media_id"), channel=F.col("channel"),
                        record_cols=["engagement", "engagement_data", "rewatch_data"], array_payload=False)


def media_metadata_envelopes(spark: SparkSession, sf_dir: str, per_page: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    part = table(spark, sf_dir, "part")
    rec = part.select(
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("hashed_id"),
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("description"),
        (F.col("p_size") * F.lit(60.0)).alias("duration"), F.col("p_type").alias("type"),
        F.lit("ready").alias("status"), (F.col("p_size") % 2 == 0).alias("archived"),
        F.lit(None).cast("string").alias("created"), F.lit(None).cast("string").alias("updated"))
    paged = BZ.page_records(rec, [], "hashed_id", per_page)
    return BZ.envelopes(paged, dataset="media_metadata", endpoint="/medias",
                        run_id=F.lit("run-catalogue"), ingested_at=F.lit("2024-01-01T02:00:00+00:00"),
                        media_id=None, channel=None,
                        record_cols=["hashed_id", "id", "name", "description", "duration", "type", "status",
                                     "archived", "created", "updated"], group_cols=["page"])


def visitor_stats_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per visitor and run day (the day's activity)."""
    ev = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    agent = F.struct(F.col("event_type").alias("browser"),
                     (F.col("event_id") % 10).cast("string").alias("browser_version"),
                     F.when(F.col("event_id") % 2 == 0, F.lit("mobile")).otherwise(F.lit("desktop")).alias("platform"),
                     (F.col("event_id") % 2 == 0).alias("mobile"))
    order = F.struct("ts", "event_id")
    g = ev.groupBy("user_id", day.alias("day")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.max_by("event_id", order).alias("last_event"),
        F.count(F.lit(1)).alias("load_count"),
        F.count_if(F.col("event_type").isin(*PLAY_TYPES)).alias("play_count"),
        F.max_by(agent, order).alias("user_agent_details"))
    rec = g.select(
        "day", F.col("user_id").cast("string").alias("visitor_key"),
        F.date_format("first_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("created_at"),
        F.date_format("last_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("last_active_at"),
        F.col("last_event").cast("string").alias("last_event_key"),
        "load_count", "play_count", "user_agent_details",
        F.struct(F.concat(F.lit("visitor "), F.col("user_id").cast("string")).alias("name"),
                 F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.invalid")).alias("email"))
         .alias("visitor_identity"))
    return BZ.envelopes(rec, dataset="visitor_stats", endpoint="/stats/visitors/{visitor_key}",
                        run_id=run_id_of(F.col("day")), ingested_at=BZ.run_stamp(run_time_of(F.col("day"))),
                        media_id=None, channel=None,
                        record_cols=["visitor_key", "created_at", "last_active_at", "last_event_key", "load_count",
                                     "play_count", "user_agent_details", "visitor_identity"],
                        request_params=F.create_map(F.lit("visitor_key"), F.col("visitor_key")),
                        array_payload=False)


ENVELOPE_BUILDERS = {
    "media_metadata": media_metadata_envelopes,
    "media_stats": media_stats_envelopes,
    "media_stats_by_date": media_stats_by_date_envelopes,
    "media_engagement": media_engagement_envelopes,
    "events": events_envelopes,
    "visitor_stats": visitor_stats_envelopes,
}


#: How ``land`` completes a dataset's envelopes.
FINISH = {"events": full_events}


def land(spark: SparkSession, sf_dir: str, root: str, dataset: str) -> str:
    """Land a dataset's envelopes as bronze; event records are completed behind the shuffles."""
    build = thin_events_envelopes if dataset == "events" else ENVELOPE_BUILDERS[dataset]
    return BZ.land(build(spark, sf_dir), root, dataset, FINISH.get(dataset))


def window_envelopes(spark: SparkSession, sf_dir: str, start, end, run_id: str, ingested_at: str,
                     per_page: int = DEFAULT_PAGE_SIZE) -> dict[str, DataFrame]:
    """What one incremental run fetches: events and daily stats of the
    window ``[start, end]``, each media's stats snapshot, and the catalogue,
    all under one run id and landing time; to be landed with ``FINISH``."""
    in_window = lambda c: F.col(c).between(F.lit(start), F.lit(end))
    rid, at = F.lit(run_id), F.lit(ingested_at)
    rec = thin_events(spark, sf_dir).filter(in_window("event_date"))
    paged = BZ.page_records(rec, ["k"], "event_key", per_page)
    events = BZ.envelopes(paged, dataset="events", endpoint="/stats/events", run_id=rid, ingested_at=at,
                          media_id=F.concat(F.lit("m"), F.col("k")), channel=channel_of(F.col("k").cast("long")),
                          record_cols=THIN_RECORD_COLS, group_cols=["page"])
    days = media_day_stats(spark, sf_dir).filter(in_window("metric_date")).withColumn(
        "date", F.col("metric_date").cast("string"))
    by_date = BZ.envelopes(days, dataset="media_stats_by_date", endpoint="/stats/medias/{media_id}/by_date",
                           run_id=rid, ingested_at=at, media_id=F.col("media_id"), channel=F.col("channel"),
                           record_cols=["date", "load_count", "play_count", "hours_watched"])
    snap = (days.groupBy("media_id", "channel")
                .agg(F.sum("load_count").alias("load_count"), F.sum("play_count").alias("play_count"),
                     F.sum("hours_watched").alias("hours_watched"))
                .withColumn("play_rate", F.when(F.col("load_count") > 0, F.col("play_count") / F.col("load_count")))
                .withColumn("engagement", F.lit(None).cast("double"))
                .withColumn("visitors", F.lit(None).cast("long")))
    stats = BZ.envelopes(snap, dataset="media_stats", endpoint="/stats/medias/{media_id}", run_id=rid,
                         ingested_at=at, media_id=F.col("media_id"), channel=F.col("channel"),
                         record_cols=["load_count", "play_count", "play_rate", "hours_watched", "engagement",
                                      "visitors"], array_payload=False)
    catalogue = media_metadata_envelopes(spark, sf_dir, per_page).withColumn(
        "pipeline_run_id", rid).withColumn("ingested_at", at)
    return {"events": events, "media_stats_by_date": by_date, "media_stats": stats, "media_metadata": catalogue}
