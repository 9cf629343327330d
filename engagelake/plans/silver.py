"""Bronze envelopes -> typed silver tables (one projection pipeline each).

Every cast is a ``try_`` cast (null on malformed input whatever the ANSI
setting).  Tables whose grain is "latest version" use ``latest_by`` on
``ingested_at`` with a deterministic tie-break; the "any one per run" tables
use ``dedup_keep_one``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagelake.functions.scalar import (as_bool, as_double, as_int, as_long, event_time, iso_date,
                                         iso_timestamp)
from engagelake.operators.latest import dedup_keep_one, latest_by
from engagelake.schemas import SILVER_PARTITIONS, envelope


def _audit(run_col: str = "pipeline_run_id") -> list:
    return [F.col(run_col).alias("pipeline_run_id"),
            iso_timestamp("ingested_at").alias("ingested_at"),
            F.col("source_file"),
            iso_date("ingested_at").alias("ingest_date")]


def _with_source(df: DataFrame) -> DataFrame:
    return df if "source_file" in df.columns else df.withColumn("source_file", F.lit(None).cast("string"))


def media_metadata(bronze: DataFrame) -> DataFrame:
    """One row per (media, run); an empty payload leaves one all-null media row."""
    m = _with_source(bronze).select("pipeline_run_id", "ingested_at", "source_file",
                                    F.explode_outer("payload").alias("m"))
    rows = m.select(
        F.col("m.hashed_id").alias("media_id"),
        as_long("m.id").alias("numeric_id"),
        F.col("m.name").alias("title"),
        F.col("m.description").alias("description"),
        as_double("m.duration").alias("duration_seconds"),
        F.col("m.type").alias("media_type"),
        F.col("m.status").alias("status"),
        as_bool("m.archived").alias("archived"),
        iso_timestamp("m.created").alias("created_at"),
        iso_timestamp("m.updated").alias("updated_at"),
        *_audit(),
    )
    return dedup_keep_one(rows, ["media_id", "pipeline_run_id"])


def media_stats(bronze: DataFrame) -> DataFrame:
    rows = _with_source(bronze).select(
        "media_id", "channel",
        as_long("payload.load_count").alias("load_count"),
        as_long("payload.play_count").alias("play_count"),
        as_double("payload.play_rate").alias("play_rate"),
        as_double("payload.hours_watched").alias("hours_watched"),
        as_double("payload.engagement").alias("engagement"),
        as_long("payload.visitors").alias("visitor_count"),
        *_audit(),
    )
    return dedup_keep_one(rows, ["media_id", "pipeline_run_id"])


def media_stats_by_date(bronze: DataFrame) -> DataFrame:
    """Latest version per (media, metric_date); an empty payload leaves a null-date row."""
    d = _with_source(bronze).select("media_id", "channel", "pipeline_run_id", "ingested_at", "source_file",
                                    F.explode_outer("payload").alias("d"))
    rows = d.select(
        "media_id", "channel",
        iso_date("d.date").alias("metric_date"),
        as_long("d.load_count").alias("load_count"),
        as_long("d.play_count").alias("play_count"),
        as_double("d.hours_watched").alias("hours_watched"),
        *_audit(),
    )
    return latest_by(rows, ["media_id", "metric_date"], "ingested_at")


def media_engagement(bronze: DataFrame) -> DataFrame:
    """Timeline points: the two arrays zipped (shorter padded with null) and
    exploded with a 0-based position; one row per (media, position, run)."""
    z = _with_source(bronze).select(
        "media_id", "channel", "pipeline_run_id", "ingested_at", "source_file",
        as_double("payload.engagement").alias("overall_engagement"),
        F.posexplode_outer(F.arrays_zip(F.col("payload.engagement_data").alias("engagement_data"),
                                        F.col("payload.rewatch_data").alias("rewatch_data")))
         .alias("timeline_index", "point"),
    )
    rows = z.select(
        "media_id", "channel",
        as_int("timeline_index").alias("timeline_index"),
        as_long("point.engagement_data").alias("engagement_value"),
        as_long("point.rewatch_data").alias("rewatch_value"),
        "overall_engagement",
        *_audit(),
    )
    return dedup_keep_one(rows, ["media_id", "timeline_index", "pipeline_run_id"])


def events(bronze: DataFrame) -> DataFrame:
    """One row per event key, latest landing wins.  ``ip`` and ``email``
    never leave bronze.  ``received_at`` must match the millisecond pattern."""
    return latest_by(events_rows(bronze), ["event_key"], "ingested_at")


def events_rows(bronze: DataFrame) -> DataFrame:
    """Every landed event version (keyed ones only), typed; no de-duplication."""
    e = _with_source(bronze).select("pipeline_run_id", "ingested_at", "source_file",
                                    F.explode_outer("payload").alias("e"))
    received = event_time("e.received_at")
    rows = e.select(
        F.col("e.event_key").alias("event_key"),
        F.col("e.visitor_key").alias("visitor_key"),
        F.col("e.media_id").alias("media_id"),
        F.col("e.media_name").alias("media_name"),
        received.alias("received_at"),
        F.to_date(received).alias("event_date"),
        as_double("e.percent_viewed").alias("percent_viewed"),
        F.col("e.country").alias("country"),
        F.col("e.region").alias("region"),
        F.col("e.city").alias("city"),
        as_double("e.lat").alias("latitude"),
        as_double("e.lon").alias("longitude"),
        F.col("e.org").alias("organization"),
        F.col("e.embed_url").alias("embed_url"),
        F.col("e.media_url").alias("media_url"),
        F.col("e.user_agent_details.browser").alias("browser"),
        F.col("e.user_agent_details.browser_version").alias("browser_version"),
        F.col("e.user_agent_details.platform").alias("platform"),
        as_bool("e.user_agent_details.mobile").alias("mobile"),
        *_audit(),
    ).filter(F.col("event_key").isNotNull())
    return rows


def visitor_stats(bronze: DataFrame) -> DataFrame:
    """Latest snapshot per visitor key; ``visitor_identity`` is not carried."""
    rows = _with_source(bronze).select(
        F.col("payload.visitor_key").alias("visitor_key"),
        iso_timestamp("payload.created_at").alias("created_at"),
        iso_timestamp("payload.last_active_at").alias("last_active_at"),
        F.col("payload.last_event_key").alias("last_event_key"),
        as_long("payload.load_count").alias("load_count"),
        as_long("payload.play_count").alias("play_count"),
        F.col("payload.user_agent_details.browser").alias("browser"),
        F.col("payload.user_agent_details.browser_version").alias("browser_version"),
        F.col("payload.user_agent_details.platform").alias("platform"),
        as_bool("payload.user_agent_details.mobile").alias("mobile"),
        *_audit(),
    ).filter(F.col("visitor_key").isNotNull())
    return latest_by(rows, ["visitor_key"], "ingested_at")


TRANSFORMS = {
    "media_metadata": media_metadata,
    "media_stats": media_stats,
    "media_stats_by_date": media_stats_by_date,
    "media_engagement": media_engagement,
    "events": events,
    "visitor_stats": visitor_stats,
}


def transform(dataset: str, bronze: DataFrame) -> tuple[DataFrame, list[str]]:
    """Dataset name -> (silver frame, partition columns)."""
    return bronze.transform(TRANSFORMS[dataset]), SILVER_PARTITIONS[dataset]


def schema(spark: SparkSession, dataset: str) -> T.StructType:
    """The declared columns of a silver table (analysis only): a table without a row is read by them, too."""
    return TRANSFORMS[dataset](spark.createDataFrame([], envelope(dataset))).schema
