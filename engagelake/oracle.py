"""Independent SQL (DuckDB dialect) for the correctness gate.

The views below restate the domain mapping of ``sources/testdata.py`` and
the gold rules in plain SQL.  Rounding goes through the double's shortest
decimal text and DECIMAL, so ties are resolved half-up on that text (as
Spark's ``round`` does), and sums
of rounded gold columns are added as DECIMAL, the same order-independent
form the Spark reports use.
"""

from __future__ import annotations

from engagelake.constants import CHANNELS

FB, YT = CHANNELS


def rnd(expr: str, n: int) -> str:
    """Half-up rounding of the double's shortest decimal text (Spark's rule)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)"


def dsum(expr: str, scale: int = 6) -> str:
    return f"sum(CAST({expr} AS DECIMAL(18,{scale})))"


def dsum_round(expr: str, n: int) -> str:
    return f"CAST(round({dsum(expr)}, {n}) AS DOUBLE)"


def davg(expr: str) -> str:
    return f"(CAST({dsum(expr)} AS DOUBLE) / count({expr}))"


CHANNEL_OF = "CASE WHEN {k} % 2 = 0 THEN '" + FB + "' ELSE '" + YT + "' END"

EV = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_key,
         CAST(user_id AS VARCHAR) AS visitor_key,
         'm' || json_extract_string(props, '$.k') AS media_id,
         'media ' || json_extract_string(props, '$.k') AS media_name,
         ts AS received_at,
         CAST(ts AS DATE) AS event_date,
         floor(value) / 256.0 AS percent_viewed,
         '/embed/' || CAST(event_id AS VARCHAR) AS embed_url,
         '/media/m' || json_extract_string(props, '$.k') AS media_url,
         event_type AS browser,
         CAST(event_id % 10 AS VARCHAR) AS browser_version,
         CASE WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS platform,
         event_id % 2 = 0 AS mobile
  FROM events
)"""

PLACES = """
places AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS visitor_key, n.n_name AS country, r.r_name AS region,
         c.c_mktsegment AS city, CAST(c.c_nationkey AS DOUBLE) AS latitude, c.c_acctbal AS longitude,
         c.c_name AS organization
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

SEV = """
sev AS (
  SELECT e.event_key, e.visitor_key, e.media_id, e.media_name, e.received_at, e.event_date,
         e.percent_viewed, p.country, p.region, p.city, p.latitude, p.longitude, p.organization,
         e.embed_url, e.media_url, e.browser, e.browser_version, e.platform, e.mobile,
         'run-' || strftime(e.event_date, '%Y%m%d') AS pipeline_run_id,
         CAST(e.event_date AS TIMESTAMP) + INTERVAL 26 HOUR AS ingested_at,
         e.event_date AS ingest_date
  FROM ev e LEFT JOIN places p USING (visitor_key)
)"""

SD = """
sd AS (
  SELECT 'm' || k AS media_id,
         """ + CHANNEL_OF.format(k="CAST(k AS BIGINT)") + """ AS channel,
         metric_date, load_count, play_count, hours_watched,
         pct_sum / 256.0 / load_count AS engagement, visitor_count,
         'run-' || strftime(metric_date, '%Y%m%d') AS pipeline_run_id,
         CAST(metric_date AS TIMESTAMP) + INTERVAL 26 HOUR AS ingested_at
  FROM (
    SELECT json_extract_string(props, '$.k') AS k, CAST(ts AS DATE) AS metric_date,
           count(*) AS load_count,
           count(*) FILTER (WHERE event_type IN ('view', 'click')) AS play_count,
           sum(floor(value)) / 3600.0 AS hours_watched,
           sum(floor(value)) AS pct_sum,
           count(DISTINCT user_id) AS visitor_count
    FROM events GROUP BY 1, 2
  )
)"""

META = """
meta AS (
  SELECT 'm' || CAST(p_partkey AS VARCHAR) AS media_id, p_partkey AS numeric_id, p_name AS title,
         p_brand AS description, CAST(p_size AS DOUBLE) * 60.0 AS duration_seconds,
         p_type AS media_type, 'ready' AS status, p_size % 2 = 0 AS archived,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at,
         'run-catalogue' AS pipeline_run_id, CAST(NULL AS TIMESTAMP) AS ingested_at
  FROM part
)"""

DIM_MEDIA = """
chan AS (
  SELECT media_id, channel FROM (
    SELECT media_id, channel, row_number() OVER (PARTITION BY media_id
             ORDER BY ingested_at DESC NULLS LAST, pipeline_run_id DESC NULLS LAST, channel DESC NULLS LAST) AS rn
    FROM sd) WHERE rn = 1
),
dim_media AS (
  SELECT m.media_id, m.numeric_id, m.title, m.description, c.channel, m.duration_seconds,
         m.media_type, m.status, m.archived, m.created_at, m.updated_at
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY media_id
             ORDER BY ingested_at DESC NULLS LAST, pipeline_run_id DESC NULLS LAST) AS rn FROM meta) WHERE rn = 1) m
  LEFT JOIN chan c USING (media_id)
)"""

FACT = """
vd AS (
  SELECT e.media_id, e.visitor_key, e.event_date AS date,
         count(DISTINCT e.event_key) AS play_count,
         avg(e.percent_viewed) AS watched_percent,
         sum(e.percent_viewed * d.duration_seconds) AS total_watch_time_seconds
  FROM ev e LEFT JOIN dim_media d USING (media_id)
  WHERE e.visitor_key IS NOT NULL
  GROUP BY 1, 2, 3
),
rate AS (
  SELECT media_id, metric_date AS date,
         CASE WHEN load_count > 0 THEN CAST(play_count AS DOUBLE) / load_count END AS play_rate,
         load_count AS media_load_count, play_count AS media_play_count, hours_watched AS media_hours_watched
  FROM sd
),
fact AS (
  SELECT v.media_id, sha256(v.visitor_key) AS visitor_id, v.date, v.play_count,
         """ + rnd("r.play_rate", 6) + """ AS play_rate,
         """ + rnd("v.total_watch_time_seconds", 2) + """ AS total_watch_time_seconds,
         """ + rnd("v.total_watch_time_seconds / 3600", 6) + """ AS total_watch_time_hours,
         """ + rnd("v.watched_percent", 4) + """ AS watched_percent,
         r.media_load_count, r.media_play_count, r.media_hours_watched
  FROM vd v LEFT JOIN rate r ON v.media_id = r.media_id AND v.date = r.date
)"""

DIM_VISITOR = """
vroll AS (
  SELECT visitor_key, min(received_at) AS first_seen_at, max(received_at) AS last_seen_at,
         count(DISTINCT event_key) AS event_count, count(DISTINCT media_id) AS distinct_media_count,
         avg(percent_viewed) AS avg_pv, max(percent_viewed) AS max_pv
  FROM sev WHERE visitor_key IS NOT NULL GROUP BY visitor_key
),
vlatest AS (
  SELECT * FROM (
    SELECT visitor_key, country, region, city, browser, browser_version, platform, mobile,
           row_number() OVER (PARTITION BY visitor_key
                              ORDER BY received_at DESC NULLS LAST, event_key DESC NULLS LAST) AS rn
    FROM sev WHERE visitor_key IS NOT NULL) WHERE rn = 1
),
dim_visitor AS (
  SELECT sha256(r.visitor_key) AS visitor_id, l.country, l.region, l.city, l.browser,
         l.browser_version, l.platform, l.mobile, r.first_seen_at, r.last_seen_at,
         r.event_count, r.distinct_media_count,
         """ + rnd("r.avg_pv", 4) + """ AS avg_percent_viewed,
         """ + rnd("r.max_pv", 4) + """ AS max_percent_viewed
  FROM vroll r LEFT JOIN vlatest l USING (visitor_key)
)"""

# Dependency order of the shared views.
_VIEWS = {
    "ev": (EV, ()),
    "places": (PLACES, ()),
    "sev": (SEV, ("ev", "places")),
    "sd": (SD, ()),
    "meta": (META, ()),
    "dim_media": (DIM_MEDIA, ("sd", "meta")),
    "fact": (FACT, ("ev", "dim_media", "sd")),
    "dim_visitor": (DIM_VISITOR, ("sev",)),
}


def with_views(*names: str) -> str:
    """``WITH`` clause holding the named views and what they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _VIEWS[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",".join(_VIEWS[n][0] for n in order) + "\n"


# -- quality results in SQL ----------------------------------------------------

def q_null(name: str, c: str):
    return (name, f"count(*) FILTER (WHERE {c} IS NULL)", "{v} = 0", "'null_count=' || CAST({v} AS VARCHAR)")


def q_range(name: str, c: str, lo, hi, allow_null: bool = True):
    cond = f"{c} < {lo} OR {c} > {hi}" + ("" if allow_null else f" OR {c} IS NULL")
    return (name, f"count(*) FILTER (WHERE {cond})", "{v} = 0", "'invalid_count=' || CAST({v} AS VARCHAR)")


def q_negative(name: str, c: str, allow_null: bool = True):
    cond = f"{c} < 0" + ("" if allow_null else f" OR {c} IS NULL")
    return (name, f"count(*) FILTER (WHERE {cond})", "{v} = 0", "'invalid_count=' || CAST({v} AS VARCHAR)")


def q_positive(name: str, c: str):
    return (name, f"count(*) FILTER (WHERE {c} <= 0)", "{v} = 0", "'invalid_count=' || CAST({v} AS VARCHAR)")


def q_allowed(name: str, c: str, allowed):
    vals = ", ".join(f"'{a}'" for a in sorted(allowed))
    listed = "[" + ", ".join(f"''{a}''" for a in sorted(allowed)) + "]"
    return (name, f"count(*) FILTER (WHERE NOT ({c} IN ({vals})))", "{v} = 0",
            f"'expected={listed}, invalid_count=' || CAST({{v}} AS VARCHAR)")


def q_row_count(name: str, expected_sql: str | None = None):
    if expected_sql is None:
        return (name, "count(*)", "{v} > 0", "'actual=' || CAST({v} AS VARCHAR)")
    return (name, "count(*)", "{v} = " + expected_sql,
            f"'expected=' || CAST({expected_sql} AS VARCHAR) || ', actual=' || CAST({{v}} AS VARCHAR)")


def q_eval(table: str, rules, seq0: int) -> str:
    parts = []
    for i, (name, metric, passed, details) in enumerate(rules):
        v = f"(SELECT {metric} FROM {table})"
        parts.append(f"SELECT {seq0 + i} AS seq, '{name}' AS \"check\", {passed.format(v=v)} AS passed, "
                     f"{v} AS observed, {details.format(v=v)} AS details")
    return "\nUNION ALL ".join(parts)


def q_unique(name: str, table: str, keys, seq: int) -> str:
    v = f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {', '.join(keys)} HAVING count(*) > 1))"
    return (f"SELECT {seq} AS seq, '{name}' AS \"check\", {v} = 0 AS passed, {v} AS observed, "
            f"'duplicate_key_count=' || CAST({v} AS VARCHAR) AS details")


def q_exists(name: str, left: str, right: str, key: str, seq: int, label: str) -> str:
    v = (f"(SELECT count(*) FROM (SELECT DISTINCT l.{key} FROM {left} l WHERE NOT EXISTS "
         f"(SELECT 1 FROM {right} r WHERE r.{key} = l.{key})))")
    return (f"SELECT {seq} AS seq, '{name}' AS \"check\", {v} = 0 AS passed, {v} AS observed, "
            f"'{label}=' || CAST({v} AS VARCHAR) AS details")


def union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


FACT_NON_NEGATIVE = ("play_count", "total_watch_time_seconds", "total_watch_time_hours",
                     "media_load_count", "media_play_count", "media_hours_watched")


def qc_dim_media_sql() -> str:
    return union(
        q_eval("dim_media", [q_row_count("dim_media.row_count", "(SELECT count(*) FROM part)"),
                             q_null("dim_media.media_id.not_null", "media_id"),
                             q_null("dim_media.title.not_null", "title"),
                             q_null("dim_media.channel.not_null", "channel")], 0),
        q_unique("dim_media.media_id.unique", "dim_media", ["media_id"], 4),
        q_eval("dim_media", [q_allowed("dim_media.channel.expected_values", "channel", CHANNELS)], 5))


def qc_dim_visitor_sql() -> str:
    return union(
        q_eval("dim_visitor", [q_row_count("dim_visitor.row_count_positive"),
                               q_null("dim_visitor.visitor_id.not_null", "visitor_id")], 100),
        q_unique("dim_visitor.visitor_id.unique", "dim_visitor", ["visitor_id"], 102),
        q_eval("dim_visitor", [q_positive("dim_visitor.event_count.positive", "event_count"),
                               q_range("dim_visitor.avg_percent_viewed.between_0_and_1", "avg_percent_viewed", 0, 1),
                               q_range("dim_visitor.max_percent_viewed.between_0_and_1", "max_percent_viewed", 0, 1)],
               103))


def qc_fact_sql() -> str:
    t = "fact_media_engagement"
    return union(
        q_eval("fact", [q_row_count(f"{t}.row_count_positive"),
                        q_null(f"{t}.media_id.not_null", "media_id"),
                        q_null(f"{t}.visitor_id.not_null", "visitor_id"),
                        q_null(f"{t}.date.not_null", "date")], 200),
        q_unique(f"{t}.grain.unique", "fact", ["media_id", "visitor_id", "date"], 204),
        q_eval("fact", [*[q_negative(f"{t}.{c}.non_negative", c) for c in FACT_NON_NEGATIVE],
                        q_range(f"{t}.play_rate.between_0_and_1", "play_rate", 0, 1),
                        q_range(f"{t}.watched_percent.between_0_and_1", "watched_percent", 0, 1)], 205),
        q_exists(f"{t}.media_id.exists_in_dim_media", "fact", "dim_media", "media_id", 213, "missing_media_count"),
        q_exists(f"{t}.visitor_id.exists_in_dim_visitor", "fact", "dim_visitor", "visitor_id", 214,
                 "missing_visitor_count"))


# -- silver from envelopes ---------------------------------------------------------

SILVER_MEDIA_METADATA = """
SELECT 'm' || CAST(p_partkey AS VARCHAR) AS media_id, p_partkey AS numeric_id, p_name AS title,
       p_brand AS description, CAST(p_size AS DOUBLE) * 60.0 AS duration_seconds, p_type AS media_type,
       'ready' AS status, p_size % 2 = 0 AS archived, CAST(NULL AS TIMESTAMP) AS created_at,
       CAST(NULL AS TIMESTAMP) AS updated_at, 'run-catalogue' AS pipeline_run_id,
       TIMESTAMP '2024-01-01 02:00:00' AS ingested_at, CAST(NULL AS VARCHAR) AS source_file,
       DATE '2024-01-01' AS ingest_date
FROM part"""

SILVER_MEDIA_STATS = "WITH " + SD + """
SELECT media_id, channel, load_count, play_count,
       CASE WHEN load_count > 0 THEN CAST(play_count AS DOUBLE) / load_count END AS play_rate,
       hours_watched, engagement, visitor_count, pipeline_run_id, ingested_at,
       CAST(NULL AS VARCHAR) AS source_file, CAST(metric_date + INTERVAL 1 DAY AS DATE) AS ingest_date
FROM sd"""

SILVER_MEDIA_STATS_BY_DATE = "WITH " + SD + """
SELECT media_id, channel, metric_date, load_count, play_count, hours_watched,
       'run-' || strftime(CAST(metric_date + INTERVAL 1 DAY AS DATE), '%Y%m%d') AS pipeline_run_id,
       CAST(metric_date AS TIMESTAMP) + INTERVAL 50 HOUR AS ingested_at,
       CAST(NULL AS VARCHAR) AS source_file, CAST(metric_date + INTERVAL 2 DAY AS DATE) AS ingest_date
FROM sd"""

SILVER_MEDIA_ENGAGEMENT = """
SELECT 'm' || CAST(vec_id AS VARCHAR) AS media_id,
       """ + CHANNEL_OF.format(k="vec_id") + """ AS channel,
       CAST(i - 1 AS INTEGER) AS timeline_index,
       CAST(floor(CAST(embedding[i] AS DOUBLE) * 1000.0) AS BIGINT) AS engagement_value,
       CASE WHEN i <= label + 1 THEN CAST(floor(CAST(embedding[label + 2 - i] AS DOUBLE) * 1000.0) AS BIGINT)
       END AS rewatch_value,
       CAST(label AS DOUBLE) / 4.0 AS overall_engagement, 'run-engagement' AS pipeline_run_id,
       TIMESTAMP '2024-01-31 02:00:00' AS ingested_at, CAST(NULL AS VARCHAR) AS source_file,
       DATE '2024-01-31' AS ingest_date
FROM embeddings, range(1, len(embedding) + 1) r(i)"""

SILVER_EVENTS_COLS = """
       s.event_key, s.visitor_key, s.media_id, s.media_name, date_trunc('millisecond', s.received_at) AS received_at,
       s.event_date, s.percent_viewed, s.country, s.region, s.city, s.latitude, s.longitude, s.organization,
       s.embed_url, s.media_url, s.browser, s.browser_version, s.platform, s.mobile,
       'run-' || strftime(CAST(s.event_date + INTERVAL 1 DAY AS DATE), '%Y%m%d') AS pipeline_run_id,
       CAST(s.event_date AS TIMESTAMP) + INTERVAL 50 HOUR AS ingested_at"""


def silver_events_sql(source_file: str | None = "CAST(NULL AS VARCHAR) AS source_file") -> str:
    extra = f", {source_file}" if source_file else ""
    return with_views("sev") + "SELECT " + SILVER_EVENTS_COLS + f"""{extra},
       CAST(s.event_date + INTERVAL 2 DAY AS DATE) AS ingest_date
FROM sev s"""


SILVER_VISITOR_STATS = """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
d AS (SELECT user_id, day, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS load_count,
             count(*) FILTER (WHERE event_type IN ('view', 'click')) AS play_count
      FROM e GROUP BY 1, 2),
l AS (SELECT * FROM (SELECT user_id, day, event_id, event_type,
                            row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS rn
                     FROM e) WHERE rn = 1),
last_day AS (SELECT user_id, max(day) AS day FROM e GROUP BY 1)
SELECT CAST(d.user_id AS VARCHAR) AS visitor_key, d.first_ts AS created_at, d.last_ts AS last_active_at,
       CAST(l.event_id AS VARCHAR) AS last_event_key, d.load_count, d.play_count,
       l.event_type AS browser, CAST(l.event_id % 10 AS VARCHAR) AS browser_version,
       CASE WHEN l.event_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS platform, l.event_id % 2 = 0 AS mobile,
       'run-' || strftime(d.day, '%Y%m%d') AS pipeline_run_id,
       CAST(d.day AS TIMESTAMP) + INTERVAL 26 HOUR AS ingested_at,
       CAST(NULL AS VARCHAR) AS source_file, CAST(d.day + INTERVAL 1 DAY AS DATE) AS ingest_date
FROM d JOIN last_day USING (user_id, day) JOIN l USING (user_id, day)"""

# Event records as landed: every event by the run of its day and by the next run.
LANDED_EVENTS = """
SELECT 'run-' || strftime(CAST(CAST(ts AS DATE) + INTERVAL (lag) DAY AS DATE), '%Y%m%d') AS pipeline_run_id,
       strftime(CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL (26 + 24 * lag) HOUR, '%Y-%m-%dT%H:%M:%S.%f')
         || '+00:00' AS ingested_at,
       'm' || json_extract_string(props, '$.k') AS media_id,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'Facebook' ELSE 'YouTube' END
         AS channel,
       CAST(event_id AS VARCHAR) AS event_key
FROM events, range(0, 2) g(lag)"""


def dim_visitor_ms_sql() -> str:
    """``dim_visitor`` over events whose times went through the millisecond
    text of the bronze landing (as the silver transform parses them)."""
    ms = "date_trunc('millisecond', received_at)"
    view = (DIM_VISITOR.replace("min(received_at)", f"min({ms})").replace("max(received_at)", f"max({ms})")
            .replace("ORDER BY received_at DESC", f"ORDER BY {ms} DESC"))
    return "WITH " + ",".join([EV, PLACES, SEV, view]) + "\nSELECT * FROM dim_visitor"
