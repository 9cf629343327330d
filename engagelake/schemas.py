"""Declared schemas: bronze envelopes (per dataset payload), silver, gold.

Bronze is read with these schemas instead of inference, so empty payloads,
fields absent from every file and empty folders give nulls / empty frames
instead of analysis errors; documents that are not JSON and records whose
structure does not match are rejects (``sources.bronze``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
# Payload scalars are declared as text: the JSON reader keeps the literal
# text of numbers and booleans, and silver casts with ``try_cast``.  A
# malformed value then nulls that one field (as in the source), instead of
# turning the whole envelope into a corrupt record.
L = D = B = S


def struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USER_AGENT = struct(("browser", S), ("browser_version", S), ("platform", S), ("mobile", B))

PAYLOADS = {
    "media_metadata": T.ArrayType(struct(
        ("hashed_id", S), ("id", L), ("name", S), ("description", S), ("duration", D), ("type", S),
        ("status", S), ("archived", B), ("created", S), ("updated", S))),
    "media_stats": struct(
        ("load_count", L), ("play_count", L), ("play_rate", D), ("hours_watched", D), ("engagement", D),
        ("visitors", L)),
    "media_stats_by_date": T.ArrayType(struct(
        ("date", S), ("load_count", L), ("play_count", L), ("hours_watched", D))),
    "media_engagement": struct(
        ("engagement", D), ("engagement_data", T.ArrayType(L)), ("rewatch_data", T.ArrayType(L))),
    "events": T.ArrayType(struct(
        ("event_key", S), ("visitor_key", S), ("media_id", S), ("media_name", S), ("received_at", S),
        ("percent_viewed", D), ("country", S), ("region", S), ("city", S), ("lat", D), ("lon", D),
        ("org", S), ("embed_url", S), ("media_url", S), ("ip", S), ("email", S),
        ("user_agent_details", USER_AGENT))),
    "visitor_stats": struct(
        ("visitor_key", S), ("created_at", S), ("last_active_at", S), ("last_event_key", S),
        ("load_count", L), ("play_count", L), ("user_agent_details", USER_AGENT),
        ("visitor_identity", struct(("name", S), ("email", S)))),
}

ENVELOPE_FIELDS = [                      # the run id first
    ("pipeline_run_id", S), ("ingested_at", S), ("source", S), ("dataset", S), ("media_id", S),
    ("channel", S), ("endpoint", S), ("request_params", T.MapType(S, S)),
]

CORRUPT = "_corrupt_record"


def envelope(dataset: str) -> T.StructType:
    return struct(*ENVELOPE_FIELDS, ("payload", PAYLOADS[dataset]))


# Silver partitioning (dataset -> partition columns).  Dates partition, and the
# run where a table holds one snapshot per run (several runs may share a day);
# media ids cluster inside the files (sorted), so scans still skip by media
# through Parquet statistics without a folder per (day, media).  Events are
# partitioned by their own date (and daily stats by their metric date), which
# never changes between re-landings, so latest-wins upserts touch exactly the
# partitions of the new rows.
SILVER_PARTITIONS = {
    "media_metadata": ["ingest_date", "pipeline_run_id"],
    "media_stats": ["ingest_date", "pipeline_run_id"],
    "media_stats_by_date": ["metric_date"],
    "media_engagement": ["ingest_date"],
    "events": ["event_date"],
    "visitor_stats": ["ingest_date"],
}
SILVER_CLUSTER = {
    "media_metadata": ["media_id"],
    "media_stats": ["media_id"],
    "media_stats_by_date": ["media_id"],
    "media_engagement": ["media_id", "timeline_index"],
    "events": ["media_id", "visitor_key"],
    "visitor_stats": ["visitor_key"],
}
