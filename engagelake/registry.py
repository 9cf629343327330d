"""Registered queries (one per operator of the inventory) and their oracles.

Each query reads the generated tables through ``sources.testdata`` and runs
the library operator on whole tables.  ``ORACLES`` holds the equivalent
DuckDB SQL for every key that SQL can state.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engagelake import oracle as O
from engagelake.constants import EVENT_KEY_NAMES, SOURCE_NAME, VISITOR_KEY_NAMES
from engagelake.functions import scalar as S
from engagelake.operators import json_ops as J
from engagelake.operators import quality as QC
from engagelake.operators.aggregate import distinct_count, null_safe_join
from engagelake.operators.latest import dedup_keep_one as _dedup
from engagelake.operators.latest import latest_by as _latest
from engagelake.operators.privacy import drop_sensitive as _drop_sensitive
from engagelake.plans import catalog as CAT
from engagelake.plans import checks as CK
from engagelake.plans import gold
from engagelake.plans import incremental as INC
from engagelake.plans import publish
from engagelake.plans import reports as R
from engagelake.plans import silver as SV
from engagelake.plans.workflow import (DIM_MEDIA, DIM_VISITOR, FACT, FACT_CHECK_PARTIALS, FACT_CLUSTER, FACT_PARTITIONS,
                                       fact_schema, in_parallel, read_gold, read_published, run_daily, run_incremental)
from engagelake.schemas import SILVER_CLUSTER, SILVER_PARTITIONS
from engagelake.session import new_run_dir
from engagelake.sources import bronze as BZ
from engagelake.sources import testdata as T
from engagelake.sources.files import read_required, write_table
from engagelake.streaming import events as ST

REGISTRY: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# -- gold frames from the generated tables -------------------------------------

def dim_media_frame(spark: SparkSession, sf: str) -> DataFrame:
    # dim_media reads only the channel of the stats snapshot
    return gold.build_dim_media(T.media_metadata(spark, sf), T.media_stats(spark, sf, with_visitors=False))


def dim_visitor_frame(spark: SparkSession, sf: str) -> DataFrame:
    return gold.build_dim_visitor(T.silver_events(spark, sf, with_audit=False))


def fact_frame(spark: SparkSession, sf: str) -> DataFrame:
    return gold.build_fact(T.play_events(spark, sf), gold.media_durations(T.media_metadata(spark, sf)),
                           T.media_stats_by_date(spark, sf))


# -- GLD ---------------------------------------------------------------------

@register("fact_media_engagement", O.with_views("fact") + "SELECT * FROM fact")
def fact_media_engagement(spark, sf):
    return fact_frame(spark, sf)


@register("watch_time", O.with_views("ev", "dim_media") + """
SELECT e.media_id, e.event_key, e.visitor_key, e.event_date, e.percent_viewed, d.duration_seconds,
       e.percent_viewed * d.duration_seconds AS estimated_watch_seconds
FROM ev e LEFT JOIN dim_media d USING (media_id) WHERE e.visitor_key IS NOT NULL""")
def watch_time(spark, sf):
    return gold.watch_time(T.play_events(spark, sf), gold.media_durations(T.media_metadata(spark, sf))).select(
        "media_id", "event_key", "visitor_key", "event_date", "percent_viewed", "duration_seconds",
        "estimated_watch_seconds")


@register("visitor_daily", O.with_views("fact") + """
SELECT media_id, sha256(visitor_key) AS visitor_id, date, play_count, watched_percent,
       total_watch_time_seconds FROM vd""")
def visitor_daily(spark, sf):
    return gold.visitor_daily(T.play_events(spark, sf), gold.media_durations(T.media_metadata(spark, sf)))


def _decimal_events(spark, sf):
    """Play events whose percents have three decimals, and durations with two: no dyadic numbers."""
    ev = T.play_events(spark, sf).withColumn("percent_viewed", F.floor(F.col("percent_viewed") * 256 * 3) / F.lit(1000.0))
    media = gold.media_durations(T.media_metadata(spark, sf)).withColumn(
        "duration_seconds", F.col("duration_seconds") + F.substring("media_id", 2, 9).cast("long") % 100 / F.lit(100.0))
    return ev, media


_DECIMAL_SQL = O.with_views("ev", "dim_media") + """, x AS (
  SELECT e.media_id, e.visitor_key, e.event_date AS date, count(DISTINCT e.event_key) AS play_count,
         sum(CAST(floor(e.percent_viewed * 256 * 3) / 1000.0 AS DECIMAL(18,3))) AS p, count(e.percent_viewed) AS n,
         sum(CAST(floor(e.percent_viewed * 256 * 3) / 1000.0 AS DECIMAL(18,3)) * CAST(d.duration_seconds
             + CAST(substr(d.media_id, 2) AS BIGINT) % 100 / 100.0 AS DECIMAL(12,2))) AS s
  FROM ev e LEFT JOIN dim_media d USING (media_id) WHERE e.visitor_key IS NOT NULL GROUP BY 1, 2, 3)
SELECT media_id, sha256(visitor_key) AS visitor_id, date, play_count, CAST(p AS DOUBLE) / n AS watched_percent,
       CAST(s AS DOUBLE) AS total_watch_time_seconds FROM x"""


@register("visitor_daily_decimal", _DECIMAL_SQL)
def visitor_daily_decimal(spark, sf):
    """Watch seconds over three-decimal percents: the sum of the products, exactly."""
    return gold.visitor_daily(*_decimal_events(spark, sf))


@register("fact_decimal", f"""
SELECT media_id, visitor_id, date, {O.rnd('total_watch_time_seconds', 2)} AS total_watch_time_seconds,
       CAST(round(CAST(CAST(total_watch_time_seconds / 3600 AS VARCHAR) AS DECIMAL(38,24)), 6) AS DOUBLE) AS total_watch_time_hours, {O.rnd('watched_percent', 4)} AS watched_percent
FROM ({_DECIMAL_SQL})""")
def fact_decimal(spark, sf):
    ev, media = _decimal_events(spark, sf)
    return gold.build_fact(ev, media, T.media_stats_by_date(spark, sf)).select(
        "media_id", "visitor_id", "date", "total_watch_time_seconds", "total_watch_time_hours", "watched_percent")


@register("media_daily_rate", O.with_views("fact") + "SELECT * FROM rate")
def media_daily_rate(spark, sf):
    return gold.media_daily_rate(T.media_stats_by_date(spark, sf))


@register("dim_media", O.with_views("dim_media") + "SELECT * FROM dim_media")
def dim_media(spark, sf):
    return dim_media_frame(spark, sf)


@register("dim_visitor", O.with_views("dim_visitor") + "SELECT * FROM dim_visitor")
def dim_visitor(spark, sf):
    return dim_visitor_frame(spark, sf)


@register("latest_attrs", O.with_views("dim_visitor") + """
SELECT sha256(visitor_key) AS visitor_id, country, region, city, browser, browser_version, platform, mobile
FROM vlatest""")
def latest_attrs(spark, sf):
    return gold.latest_visitor_attrs(T.silver_events(spark, sf, with_audit=False))


# -- RPT -----------------------------------------------------------------------


REPORT_WINDOW = (dt.date(2024, 1, 8), dt.date(2024, 1, 14))
_FM = "FROM fact f JOIN dim_media m ON f.media_id = m.media_id"


def _gold(spark, sf):
    """Fact, media dimension and the dimension's row bound (its metadata:
    latest-by plus a left join on a unique key cannot add rows)."""
    return fact_frame(spark, sf), dim_media_frame(spark, sf), T.media_metadata(spark, sf)


@register("rpt_smoke_dim_media", O.with_views("dim_media")
          + "SELECT * FROM dim_media ORDER BY media_id NULLS FIRST LIMIT 10")
def rpt_smoke_dim_media(spark, sf):
    return R.smoke(dim_media_frame(spark, sf), ["media_id"])


@register("rpt_smoke_dim_visitor", O.with_views("dim_visitor")
          + "SELECT * FROM dim_visitor ORDER BY visitor_id NULLS FIRST LIMIT 10")
def rpt_smoke_dim_visitor(spark, sf):
    return R.smoke(dim_visitor_frame(spark, sf), ["visitor_id"])


@register("rpt_smoke_fact", O.with_views("fact")
          + "SELECT * FROM fact ORDER BY media_id NULLS FIRST, visitor_id NULLS FIRST, date NULLS FIRST LIMIT 10")
def rpt_smoke_fact(spark, sf):
    return R.smoke(fact_frame(spark, sf), ["media_id", "visitor_id", "date"])


@register("rpt_plays_by_date_channel", O.with_views("fact", "dim_media") + f"""
SELECT f.date, m.channel, CAST(SUM(f.play_count) AS BIGINT) AS total_plays {_FM}
GROUP BY f.date, m.channel ORDER BY f.date, m.channel""")
def rpt_plays_by_date_channel(spark, sf):
    return R.plays_by_date_channel(*_gold(spark, sf))


@register("rpt_watch_time_by_date_channel", O.with_views("fact", "dim_media") + f"""
SELECT f.date, m.channel, {O.dsum_round('f.total_watch_time_hours', 4)} AS total_watch_time_hours,
       {O.dsum_round('f.total_watch_time_seconds', 2)} AS total_watch_time_seconds {_FM}
GROUP BY f.date, m.channel ORDER BY f.date, m.channel""")
def rpt_watch_time_by_date_channel(spark, sf):
    return R.watch_time_by_date_channel(*_gold(spark, sf))


@register("rpt_avg_watched_by_media", O.with_views("fact", "dim_media") + f"""
SELECT m.channel, f.media_id, m.title, {O.rnd(O.davg('f.watched_percent'), 4)} AS avg_watched_percent,
       {O.rnd('MAX(f.watched_percent)', 4)} AS max_watched_percent,
       COUNT(DISTINCT f.visitor_id) AS unique_visitors, CAST(SUM(f.play_count) AS BIGINT) AS total_plays {_FM}
GROUP BY m.channel, f.media_id, m.title ORDER BY avg_watched_percent DESC""")
def rpt_avg_watched_by_media(spark, sf):
    return R.avg_watched_by_media(*_gold(spark, sf))


@register("rpt_unique_visitors", O.with_views("fact", "dim_media") + f"""
SELECT m.channel, f.media_id, m.title, COUNT(DISTINCT f.visitor_id) AS unique_visitors,
       CAST(SUM(f.play_count) AS BIGINT) AS total_plays {_FM}
GROUP BY m.channel, f.media_id, m.title ORDER BY unique_visitors DESC""")
def rpt_unique_visitors(spark, sf):
    return R.unique_visitors(*_gold(spark, sf))


@register("rpt_channel_summary", O.with_views("fact", "dim_media") + f"""
SELECT m.channel, COUNT(DISTINCT f.media_id) AS media_count, COUNT(DISTINCT f.visitor_id) AS unique_visitors,
       CAST(SUM(f.play_count) AS BIGINT) AS total_plays,
       {O.rnd(O.davg('f.play_rate'), 4)} AS avg_play_rate,
       {O.rnd(O.davg('f.watched_percent'), 4)} AS avg_watched_percent,
       {O.dsum_round('f.total_watch_time_hours', 4)} AS total_watch_time_hours {_FM}
GROUP BY m.channel ORDER BY total_plays DESC""")
def rpt_channel_summary(spark, sf):
    return R.channel_summary(*_gold(spark, sf))


@register("rpt_daily_channel_trend", O.with_views("fact", "dim_media") + f"""
SELECT f.date,
       CAST(SUM(CASE WHEN m.channel = '{O.FB}' THEN f.play_count ELSE 0 END) AS BIGINT) AS {O.FB.lower()}_plays,
       CAST(SUM(CASE WHEN m.channel = '{O.YT}' THEN f.play_count ELSE 0 END) AS BIGINT) AS {O.YT.lower()}_plays,
       {O.dsum_round(f"CASE WHEN m.channel = '{O.FB}' THEN f.total_watch_time_hours ELSE 0 END", 4)} AS {O.FB.lower()}_watch_hours,
       {O.dsum_round(f"CASE WHEN m.channel = '{O.YT}' THEN f.total_watch_time_hours ELSE 0 END", 4)} AS {O.YT.lower()}_watch_hours
{_FM} GROUP BY f.date ORDER BY f.date""")
def rpt_daily_channel_trend(spark, sf):
    return R.daily_channel_trend(*_gold(spark, sf))


@register("rpt_top_locations", O.with_views("dim_visitor") + f"""
SELECT country, region, city, COUNT(DISTINCT visitor_id) AS unique_visitors,
       CAST(SUM(event_count) AS BIGINT) AS total_events,
       {O.rnd(O.davg('avg_percent_viewed'), 4)} AS avg_watched_percent
FROM dim_visitor WHERE country IS NOT NULL GROUP BY country, region, city
ORDER BY unique_visitors DESC, country NULLS FIRST, region NULLS FIRST, city NULLS FIRST LIMIT 25""")
def rpt_top_locations(spark, sf):
    return R.top_locations(dim_visitor_frame(spark, sf))


@register("rpt_device_breakdown", O.with_views("dim_visitor") + f"""
SELECT platform, browser, mobile, COUNT(DISTINCT visitor_id) AS unique_visitors,
       CAST(SUM(event_count) AS BIGINT) AS total_events,
       {O.rnd(O.davg('avg_percent_viewed'), 4)} AS avg_watched_percent
FROM dim_visitor GROUP BY platform, browser, mobile ORDER BY unique_visitors DESC""")
def rpt_device_breakdown(spark, sf):
    return R.device_breakdown(dim_visitor_frame(spark, sf))


@register("rpt_date_filtered", O.with_views("fact", "dim_media") + f"""
SELECT f.date, m.channel, f.media_id, CAST(SUM(f.play_count) AS BIGINT) AS total_plays,
       {O.dsum_round('f.total_watch_time_hours', 4)} AS total_watch_time_hours {_FM}
WHERE f.date BETWEEN DATE '{REPORT_WINDOW[0]}' AND DATE '{REPORT_WINDOW[1]}'
GROUP BY f.date, m.channel, f.media_id ORDER BY f.date, m.channel, f.media_id""")
def rpt_date_filtered(spark, sf):
    f, m, b = _gold(spark, sf)
    return R.date_filtered(f, m, *REPORT_WINDOW, dim_bound=b)


@register("rpt_kpi", O.with_views("fact", "dim_media") + f"""
SELECT f.date, m.channel, f.media_id, CAST(SUM(f.play_count) AS BIGINT) AS plays,
       {O.davg('f.watched_percent')} AS avg_watched_percent,
       CAST({O.dsum('f.total_watch_time_hours')} AS DOUBLE) AS total_watch_time_hours {_FM}
GROUP BY f.date, m.channel, f.media_id ORDER BY f.date DESC, m.channel, f.media_id""")
def rpt_kpi(spark, sf):
    return R.kpi(*_gold(spark, sf))


# -- QC ------------------------------------------------------------------------


def _t(spark, sf, name):
    return T.table(spark, sf, name)


@register("qc_nulls", O.q_eval("lineitem", [O.q_null(f"lineitem.{c}.not_null", c) for c in (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")], 0))
def qc_nulls(spark, sf):
    li = _t(spark, sf, "lineitem")
    return QC.evaluate(li, [QC.null_rule(f"lineitem.{c}.not_null", c) for c in li.columns])


@register("qc_duplicate_keys", O.union(
    O.q_unique("lineitem.key.unique", "lineitem", ["l_orderkey", "l_linenumber"], 0),
    O.q_unique("orders.customer_day.unique", "orders", ["o_custkey", "o_orderdate"], 1)))
def qc_duplicate_keys(spark, sf):
    return QC.union_all([
        QC.unique_check("lineitem.key.unique", _t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 0),
        QC.unique_check("orders.customer_day.unique", _t(spark, sf, "orders"), ["o_custkey", "o_orderdate"], 1)])


@register("qc_range", O.q_eval("lineitem", [
    O.q_range("lineitem.l_discount.between_0_and_0.05", "l_discount", 0, 0.05),
    O.q_range("lineitem.l_tax.between_0_and_0.05", "l_tax", 0, 0.05, allow_null=False),
    O.q_range("lineitem.l_quantity.between_1_and_50", "l_quantity", 1, 50)], 0))
def qc_range(spark, sf):
    return QC.evaluate(_t(spark, sf, "lineitem"), [
        QC.range_rule("lineitem.l_discount.between_0_and_0.05", "l_discount", 0, 0.05),
        QC.range_rule("lineitem.l_tax.between_0_and_0.05", "l_tax", 0, 0.05, allow_null=False),
        QC.range_rule("lineitem.l_quantity.between_1_and_50", "l_quantity", 1, 50)])


@register("qc_negative", O.union(
    O.q_eval("customer", [O.q_negative("customer.c_acctbal.non_negative", "c_acctbal")], 0),
    O.q_eval("orders", [O.q_negative("orders.o_totalprice.non_negative", "o_totalprice", allow_null=False)], 1)))
def qc_negative(spark, sf):
    return QC.union_all([
        QC.evaluate(_t(spark, sf, "customer"), [QC.negative_rule("customer.c_acctbal.non_negative", "c_acctbal")], 0),
        QC.evaluate(_t(spark, sf, "orders"), [
            QC.negative_rule("orders.o_totalprice.non_negative", "o_totalprice", allow_null=False)], 1)])


@register("qc_positive", O.union(
    O.q_eval("part", [O.q_positive("part.p_size.positive", "p_size")], 0),
    O.q_eval("lineitem", [O.q_positive("lineitem.l_quantity.positive", "l_quantity")], 1)))
def qc_positive(spark, sf):
    return QC.union_all([
        QC.evaluate(_t(spark, sf, "part"), [QC.positive_rule("part.p_size.positive", "p_size")], 0),
        QC.evaluate(_t(spark, sf, "lineitem"), [QC.positive_rule("lineitem.l_quantity.positive", "l_quantity")], 1)])


@register("qc_allowed_values", O.union(
    O.q_eval("orders", [O.q_allowed("orders.o_orderstatus.expected_values", "o_orderstatus", ["F", "O"])], 0),
    O.q_eval("lineitem", [O.q_allowed("lineitem.l_returnflag.expected_values", "l_returnflag", ["A", "R"])], 1)))
def qc_allowed_values(spark, sf):
    return QC.union_all([
        QC.evaluate(_t(spark, sf, "orders"), [
            QC.allowed_values_rule("orders.o_orderstatus.expected_values", "o_orderstatus", ["F", "O"])], 0),
        QC.evaluate(_t(spark, sf, "lineitem"), [
            QC.allowed_values_rule("lineitem.l_returnflag.expected_values", "l_returnflag", ["A", "R"])], 1)])


@register("qc_orphans", """
WITH c AS (SELECT c_custkey AS custkey FROM customer), o AS (SELECT o_custkey AS custkey FROM orders)
""" + O.union(
    O.q_exists("customer.custkey.exists_in_orders", "c", "o", "custkey", 0, "missing_count"),
    O.q_exists("orders.custkey.exists_in_customer", "o", "c", "custkey", 1, "missing_count")))
def qc_orphans(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    return QC.union_all([
        QC.exists_check("customer.custkey.exists_in_orders", c, o, ["custkey"], 0, "missing_count"),
        QC.exists_check("orders.custkey.exists_in_customer", o, c, ["custkey"], 1, "missing_count")])


def _materialised(df: DataFrame) -> DataFrame:
    """Computed once and written to the shared checkpoint folder: the checks
    read a table several times (metrics, keys, references), as they would
    read the written gold layer."""
    return df.checkpoint(eager=True)


@register("qc_dim_media", O.with_views("dim_media") + O.qc_dim_media_sql())
def qc_dim_media(spark, sf):
    return CK.check_dim_media(_materialised(dim_media_frame(spark, sf)), T.media_config(spark, sf))


@register("qc_dim_visitor", O.with_views("dim_visitor") + O.qc_dim_visitor_sql())
def qc_dim_visitor(spark, sf):
    return CK.check_dim_visitor(_materialised(dim_visitor_frame(spark, sf)))


def _gold_materialised(spark, sf):
    """The three gold frames, materialised by concurrent jobs."""
    builders = [fact_frame, dim_media_frame, dim_visitor_frame]
    return tuple(in_parallel([lambda b=b: _materialised(b(spark, sf)) for b in builders]))


@register("qc_fact", O.with_views("fact", "dim_media", "dim_visitor") + O.qc_fact_sql())
def qc_fact(spark, sf):
    return CK.check_fact(*_gold_materialised(spark, sf))


@register("qc_gate", O.with_views("fact", "dim_media", "dim_visitor") + O.union(
    O.qc_dim_media_sql(), O.qc_dim_visitor_sql(), O.qc_fact_sql()))
def qc_gate(spark, sf):
    return CK.check_gold(*_gold_materialised(spark, sf), T.media_config(spark, sf))


# -- WIN / AGG-10 / PRJ / FLT / FN ---------------------------------------------


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]


@register("latest_by", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, """
          + ", ".join(f"{c} DESC NULLS LAST" for c in _LI_REST) + """) AS rn FROM lineitem) WHERE rn = 1""")
def latest_by(spark, sf):
    """Newest version per (order, line) by ship date; total tie-break on the rest."""
    return _latest(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@register("dedup_keep_one", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey NULLS FIRST,
      o_orderstatus NULLS FIRST, o_totalprice NULLS FIRST, o_orderpriority NULLS FIRST) AS rn FROM orders)
WHERE rn = 1""")
def dedup_keep_one(spark, sf):
    return _dedup(_t(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@register("not_null_filter", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, lang, quality, toxic FROM j WHERE quality IS NOT NULL AND doc_id IS NOT NULL""")
def not_null_filter(spark, sf):
    """Rows whose keys are present (labelled documents: the label side of a
    left join is null for unlabelled ones)."""
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    joined = docs.join(_t(spark, sf, "labels"), "doc_id", "left")
    return joined.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", "lang", "quality", "toxic")


def _raw_event_records(spark, sf):
    """Raw event records as an API would send them, personal fields included."""
    ev = _t(spark, sf, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("event_key"),
        F.col("user_id").cast("string").alias("visitor_key"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (F.col("event_id") % 256).cast("string")).alias("ip"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.invalid")).alias("email"),
        F.col("event_type").alias("description"),
        F.col("value").alias("percent_viewed"),
        F.struct(F.col("event_type").alias("browser"),
                 F.concat(F.lit("tok-"), F.col("event_id").cast("string")).alias("api_key")).alias("agent"),
    )


@register("drop_sensitive", """
SELECT CAST(event_id AS VARCHAR) AS event_key, value AS percent_viewed, event_type AS agent_browser
FROM events""")
def drop_sensitive(spark, sf):
    """Sensitive names (ip, email, visitor key, and the 'ip' in 'description')
    leave the frame; nested sensitive fields too."""
    out = _drop_sensitive(_raw_event_records(spark, sf))
    return out.select("event_key", "percent_viewed", F.col("agent.browser").alias("agent_browser"))


@register("sanitize_key", """
SELECT page_id, regexp_replace(replace(url, '/', '_'), '[^A-Za-z0-9_.=-]+', '_', 'g') AS file_part,
       regexp_replace(url, '[^A-Za-z0-9_.=-]+', '_', 'g') AS url_part
FROM pages""")
def sanitize_key(spark, sf):
    pages = _t(spark, sf, "pages")
    return pages.select("page_id", BZ.record_file_part(F.col("url")).alias("file_part"),
                        S.sanitize_file_part("url").alias("url_part"))


@register("scalar_pack", f"""
WITH x AS (
  SELECT event_id, user_id, ts, value, event_type, props,
         CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS received_text
  FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_key, received_text,
       CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts) END AS received_at,
       CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END AS event_date,
       CAST(ts AS DATE) AS ingest_date,
       CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS lookback_start,
       TRY_CAST(CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE 'n/a' || CAST(user_id AS VARCHAR) END
                AS BIGINT) AS load_count,
       TRY_CAST(CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'maybe' END AS BOOLEAN) AS archived,
       sha256(CAST(user_id AS VARCHAR)) AS visitor_id,
       CASE WHEN user_id % 3 > 0 THEN CAST(event_id % 5 AS DOUBLE) / CAST(user_id % 3 AS DOUBLE) END AS rate,
       {O.rnd('value * 1.2345', 2)} AS rounded,
       CASE WHEN event_type = 'view' THEN 'seen' END AS seen,
       event_type IN ('view', 'click') AS is_play,
       regexp_replace(event_type || '/' || props, '[^A-Za-z0-9_.=-]+', '_', 'g') AS file_part
FROM x""")
def scalar_pack(spark, sf):
    ev = _t(spark, sf, "events")
    even = F.col("event_id") % 2 == 0
    x = ev.select("*", F.when(even, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
                         .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("received_text"))
    received = S.event_time("received_text")
    return x.select(
        F.col("event_id").cast("string").alias("event_key"), "received_text",
        received.cast("timestamp_ntz").alias("received_at"),
        F.to_date(received).alias("event_date"),
        S.iso_date(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T01:02:03.1+00:00"))).alias("ingest_date"),
        F.date_sub(F.col("ts").cast("date"), 1).alias("lookback_start"),
        S.as_long(F.when(even, F.col("user_id").cast("string"))
                  .otherwise(F.concat(F.lit("n/a"), F.col("user_id").cast("string")))).alias("load_count"),
        S.as_bool(F.when(F.col("event_id") % 3 == 0, "true").when(F.col("event_id") % 3 == 1, "false")
                  .otherwise("maybe")).alias("archived"),
        S.pseudonym("user_id").alias("visitor_id"),
        S.safe_ratio(F.col("event_id") % 5, F.col("user_id") % 3).alias("rate"),
        F.round(F.col("value") * F.lit(1.2345), 2).alias("rounded"),
        F.when(F.col("event_type") == "view", F.lit("seen")).alias("seen"),
        F.col("event_type").isin("view", "click").alias("is_play"),
        S.sanitize_file_part(F.concat(F.col("event_type"), F.lit("/"), F.col("props"))).alias("file_part"),
    )


# -- TRF / SRC / SNK / JSN-5 -------------------------------------------------------


def _silver(dataset):
    def run(spark, sf):
        return SV.TRANSFORMS[dataset](T.ENVELOPE_BUILDERS[dataset](spark, sf))
    run.__name__ = f"silver_{dataset}"
    return run


register("silver_media_metadata", O.SILVER_MEDIA_METADATA)(_silver("media_metadata"))
register("silver_media_stats", O.SILVER_MEDIA_STATS)(_silver("media_stats"))
register("silver_media_stats_by_date", O.SILVER_MEDIA_STATS_BY_DATE)(_silver("media_stats_by_date"))
register("silver_media_engagement", O.SILVER_MEDIA_ENGAGEMENT)(_silver("media_engagement"))
register("silver_events", O.silver_events_sql())(_silver("events"))
register("silver_visitor_stats", O.SILVER_VISITOR_STATS)(_silver("visitor_stats"))


@register("land_bronze", O.LANDED_EVENTS)
def land_bronze(spark, sf):
    """Land paged event envelopes as JSON Lines, read them back (explicit
    schema, recursive), one row per landed record."""
    root = new_run_dir(spark, "bronze")
    T.land(spark, sf, root, "events")
    env = BZ.read(spark, root, "events")
    return env.select("pipeline_run_id", "ingested_at", "media_id", "channel",
                      F.explode("payload.event_key").alias("event_key"))


@register("bronze_scan", O.silver_events_sql("TRUE AS has_source_file"))
def bronze_scan(spark, sf):
    """Landed events -> scan with provenance -> silver events."""
    root = new_run_dir(spark, "bronze")
    T.land(spark, sf, root, "events")
    out = SV.events(BZ.read(spark, root, "events"))
    return out.withColumn("has_source_file", F.col("source_file").isNotNull()).drop("source_file")


_ODD_EVERY = 101        # every so many events is landed with a device that is text instead of an object


@register("bronze_quarantine", f"""
SELECT pipeline_run_id, event_key,
       CASE WHEN CAST(event_key AS BIGINT) % {_ODD_EVERY} = 0 THEN '{BZ.OTHER_STRUCTURE}' END AS reject_reason
FROM (""" + O.LANDED_EVENTS + f""") UNION ALL
SELECT DISTINCT pipeline_run_id, NULL, '{BZ.NOT_JSON}' FROM (""" + O.LANDED_EVENTS + ")")
def bronze_quarantine(spark, sf):
    """Event pages with odd records, and one broken line per run: every landed
    record is either kept or a reject with its reason, none is lost."""
    root = new_run_dir(spark, "bronze")
    env = T.events_envelopes(spark, sf)
    odd = lambda r: F.when(r["event_key"].cast("long") % _ODD_EVERY == 0, F.to_json(F.struct(
        r["event_key"].alias("event_key"), F.lit("device as text").alias("user_agent_details")))).otherwise(F.to_json(r))
    head = F.to_json(F.struct(*[c for c in env.columns if c != "payload"]))
    page = F.concat(F.lit("["), F.array_join(F.transform("payload", odd), ","), F.lit("]"))
    whole = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"payload":'), page, F.lit("}"))
    broken = T.event_runs(spark, sf).select("pipeline_run_id", F.concat(
        F.lit('{"pipeline_run_id":"'), "pipeline_run_id", F.lit('","payload":[{"event_key":')).alias("value"))
    lines = env.select("pipeline_run_id", whole.alias("value")).unionByName(broken)
    lines.hint("rebalance", "pipeline_run_id").select("value").write.text(f"{root}/events")    # a run's lines together, large runs split
    got = BZ.decoded(spark, root, "events", pattern="*.txt")
    kept = F.transform(F.coalesce("payload.event_key", F.array().cast("array<string>")), lambda k: F.struct(
        k.alias("event_key"), F.lit(None).cast("string").alias("reject_reason")))
    rejects = F.transform("rejects", lambda r: F.struct(F.when(r["position"].isNotNull(), F.get_json_object(
        r["raw"], "$.event_key")).alias("event_key"), r["reason"].alias("reject_reason")))
    return got.select("pipeline_run_id", F.explode(F.concat(kept, rejects)).alias("r")).select(     # decoded once
        "pipeline_run_id", "r.event_key", "r.reject_reason")


@register("bronze_multiline", O.SILVER_MEDIA_METADATA)
def bronze_multiline(spark, sf):
    """The catalogue landed as one pretty-printed document a file, read back
    by the same scan as lines."""
    root = new_run_dir(spark, "bronze")
    docs = T.media_metadata_envelopes(spark, sf).select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    docs.write.option("maxRecordsPerFile", 1).text(f"{root}/media_metadata")
    return SV.media_metadata(BZ.read(spark, root, "media_metadata", pattern="*.txt")).withColumn(
        "source_file", F.lit(None).cast("string"))


@register("paged_envelopes", """
WITH n AS (SELECT pipeline_run_id, media_id, count(*) AS n FROM (""" + O.LANDED_EVENTS + """) GROUP BY 1, 2)
SELECT pipeline_run_id, media_id, CAST(page AS VARCHAR) AS page, least(20, n - 20 * (page - 1)) AS n_records
FROM (SELECT *, unnest(range(1, (n + 19) // 20 + 1)) AS page FROM n)""")
def paged_envelopes(spark, sf):
    """Event pages per (media, run): numbered without gaps, all full but the last."""
    env = T.events_envelopes(spark, sf, per_page=20)
    return env.select("pipeline_run_id", "media_id", F.col("request_params")["page"].alias("page"),
                      F.size("payload").cast("long").alias("n_records"))


# -- INC -----------------------------------------------------------------------------


_EXPLICIT = ("2024-01-05", "2024-01-09")
_AS_OF_DISABLED = dt.datetime(2024, 1, 25, 8, 0, tzinfo=dt.timezone.utc)
_AS_OF_LOOKBACK = dt.datetime(2024, 1, 20, 12, 0, tzinfo=dt.timezone.utc)
_AS_OF_BOOTSTRAP = dt.datetime(2024, 1, 1, 1, 0, tzinfo=dt.timezone.utc)
_INITIAL_START = "2023-12-31"


def _window_sql(lo: str, hi: str) -> str:
    return (O.with_views("ev") + "SELECT event_key, visitor_key, media_id, event_date, percent_viewed FROM ev "
            f"WHERE event_date BETWEEN DATE '{lo}' AND DATE '{hi}'")


def _window_events(spark, sf, window):
    return INC.in_window(T.play_events(spark, sf), window).select(
        "event_key", "visitor_key", "media_id", "event_date", "percent_viewed")


def run_commit_candidates(spark, sf) -> DataFrame:
    """Candidate watermark states in processing order: each daily run commits
    its run clock; a replay of the previous run's commit follows it."""
    ev = T.play_events(spark, sf)
    days = null_safe_join(distinct_count(ev, ["event_date"], "visitor_key", "visitor_count"),
                          distinct_count(ev, ["event_date"], "media_id", "media_count"), ["event_date"], "full")
    cand = days.withColumn("replay", F.explode(F.array(F.lit(0), F.lit(1))))
    run_day = F.when(F.col("replay") == 0, F.col("event_date")).otherwise(F.date_sub("event_date", 1))
    wm_ts = T.run_time_of(run_day)
    return cand.select(
        (F.datediff("event_date", F.lit(dt.date(1970, 1, 1))) * 2 + F.col("replay")).cast("long").alias("seq"),
        F.lit(SOURCE_NAME).alias("source"),
        BZ.run_stamp(wm_ts).alias("watermark_value"),
        wm_ts.cast("timestamp").alias("watermark_ts"),
        T.run_id_of(run_day).alias("pipeline_run_id"),
        "visitor_count", "media_count")


@register("inc_explicit", _window_sql(*_EXPLICIT))
def inc_explicit(spark, sf):
    w = INC.resolve_window(as_of=_AS_OF_LOOKBACK, explicit_start=_EXPLICIT[0], explicit_end=_EXPLICIT[1])
    return _window_events(spark, sf, w)


@register("inc_disabled", _window_sql("2024-01-24", "2024-01-25"))
def inc_disabled(spark, sf):
    return _window_events(spark, sf, INC.resolve_window(as_of=_AS_OF_DISABLED, disable_watermark=True))


@register("inc_lookback", _window_sql("2024-01-19", "2024-01-20"))
def inc_lookback(spark, sf):
    """Previous watermark = newest accepted commit before ``as_of``; start =
    its date minus the one-day lookback."""
    prev = INC.current_watermark(INC.accepted_commits(run_commit_candidates(spark, sf)), _AS_OF_LOOKBACK)
    return _window_events(spark, sf, INC.resolve_window(as_of=_AS_OF_LOOKBACK, previous_watermark=prev))


@register("inc_bootstrap", _window_sql(_INITIAL_START, "2024-01-01"))
def inc_bootstrap(spark, sf):
    prev = INC.current_watermark(INC.accepted_commits(run_commit_candidates(spark, sf)), _AS_OF_BOOTSTRAP)
    return _window_events(spark, sf, INC.resolve_window(as_of=_AS_OF_BOOTSTRAP, previous_watermark=prev,
                                                        initial_start_date=_INITIAL_START))


@register("watermark_advance", """
WITH days AS (
  SELECT CAST(ts AS DATE) AS d, count(DISTINCT user_id) AS visitor_count,
         count(DISTINCT json_extract_string(props, '$.k')) AS media_count
  FROM events GROUP BY 1),
cand AS (
  SELECT (date_diff('day', DATE '1970-01-01', d) * 2 + replay) AS seq,
         CAST(CASE WHEN replay = 0 THEN d ELSE d - INTERVAL 1 DAY END AS DATE) AS run_day,
         visitor_count, media_count
  FROM days, range(0, 2) g(replay)),
c2 AS (
  SELECT seq, strftime(CAST(run_day AS TIMESTAMP) + INTERVAL 26 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
           AS watermark_value,
         CAST(run_day AS TIMESTAMP) + INTERVAL 26 HOUR AS watermark_ts,
         'run-' || strftime(run_day, '%Y%m%d') AS pipeline_run_id, visitor_count, media_count
  FROM cand),
c3 AS (SELECT *, max(watermark_ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
       FROM c2)
SELECT seq, 'video_api' AS source, watermark_value, watermark_ts, pipeline_run_id, visitor_count, media_count
FROM c3 WHERE prior IS NULL OR watermark_ts > prior""")
def watermark_advance(spark, sf):
    return INC.accepted_commits(run_commit_candidates(spark, sf))


_SPLIT = dt.date(2024, 1, 14)   # run B re-reads from here (lookback overlap with run A)
_A_END = dt.date(2024, 1, 15)


@register("inc_upsert", O.with_views("ev") + f"""
SELECT event_key, event_date, CASE WHEN event_date >= DATE '{_SPLIT}' THEN 'run-B' ELSE 'run-A' END
       AS pipeline_run_id
FROM ev""")
def inc_upsert(spark, sf):
    """Two runs with overlapping windows merged into a date-partitioned silver
    table: every event once, the overlap from the later run."""
    ev = T.play_events(spark, sf)
    run_a = ev.filter(F.col("event_date") <= F.lit(_A_END)).select(
        "*", F.lit("run-A").alias("pipeline_run_id"),
        F.lit(dt.datetime(2024, 1, 16, 2)).cast("timestamp_ntz").alias("ingested_at"))
    run_b = ev.filter(F.col("event_date") >= F.lit(_SPLIT)).select(
        "*", F.lit("run-B").alias("pipeline_run_id"),
        F.lit(dt.datetime(2024, 1, 31, 2)).cast("timestamp_ntz").alias("ingested_at"))
    path = new_run_dir(spark, "silver") + "/events"
    INC.upsert_latest(spark, run_a, path, ["event_key"], "ingested_at", ["event_date"])
    INC.upsert_latest(spark, run_b, path, ["event_key"], "ingested_at", ["event_date"])
    return spark.read.schema(run_a.schema).parquet(path).select("event_key", "event_date", "pipeline_run_id")


@register("inc_upsert_moved", O.with_views("ev") + """
SELECT event_key, CASE WHEN CAST(event_key AS BIGINT) % 7 = 0 THEN CAST(event_date + INTERVAL 1 DAY AS DATE) ELSE event_date END
       AS event_date, CASE WHEN CAST(event_key AS BIGINT) % 7 = 0 THEN 'run-B' ELSE 'run-A' END AS pipeline_run_id FROM ev""")
def inc_upsert_moved(spark, sf):
    """Every seventh event is landed again under the next day: it moves there,
    found by the key index, and its old day keeps the others."""
    return _upserted(spark, T.play_events(spark, sf), lambda e: F.date_add(e, 1), 7)


@register("inc_upsert_undated", O.with_views("ev") + """
SELECT event_key, CASE WHEN CAST(event_key AS BIGINT) % 5 = 0 THEN NULL ELSE event_date END AS event_date,
       CASE WHEN CAST(event_key AS BIGINT) % 5 = 0 THEN 'run-B' ELSE 'run-A' END AS pipeline_run_id FROM ev""")
def inc_upsert_undated(spark, sf):
    """Every fifth event loses its day: it moves to the null partition."""
    return _upserted(spark, T.play_events(spark, sf), lambda e: F.lit(None).cast("date"), 5)


def _upserted(spark, events, new_day, every):
    """All events merged, then every so many of them again with another day."""
    def landed(frame, run, day):
        return frame.select("*", F.lit(run).alias("pipeline_run_id"),
                            F.lit(dt.datetime(2024, 2, day, 2)).cast("timestamp_ntz").alias("ingested_at"))
    path = new_run_dir(spark, "silver") + "/events"
    again = events.filter(F.col("event_key").cast("long") % every == 0).withColumn("event_date", new_day("event_date"))
    for frame in (landed(events, "run-A", 1), landed(again, "run-B", 2)):
        INC.upsert_latest(spark, frame, path, ["event_key"], "ingested_at", ["event_date"])
    return spark.read.schema(frame.schema).parquet(path).select("event_key", "event_date", "pipeline_run_id")


# -- SNK-4/5, SRC-7..9 ---------------------------------------------------------------


_PROJ_FIRST, _PROJ_TODAY = dt.date(2024, 1, 3), dt.date(2024, 1, 28)


@register("silver_roundtrip", O.silver_events_sql())
def silver_roundtrip(spark, sf):
    """Silver events written (partitioned by event date, clustered by media)
    and read back with the declared schema."""
    df = SV.events(T.events_envelopes(spark, sf))
    root = new_run_dir(spark, "silver")
    write_table(df, root, "events", SILVER_PARTITIONS["events"], cluster_by=SILVER_CLUSTER["events"])
    return read_required(spark, root, "events", df.schema)


def _written_fact(spark, sf) -> str:
    root = new_run_dir(spark, "gold")
    write_table(fact_frame(spark, sf), root, "fact_media_engagement", FACT_PARTITIONS, cluster_by=FACT_CLUSTER)
    return root


@register("gold_roundtrip", O.with_views("fact") + "SELECT * FROM fact")
def gold_roundtrip(spark, sf):
    root = _written_fact(spark, sf)
    schema = fact_schema()
    schema.fields = [f for f in schema.fields if f.name != "gold_loaded_at"]
    return read_required(spark, root, "fact_media_engagement", schema).select(*gold.FACT_COLUMNS)


def _registered_gold(spark, sf) -> str:
    """The gold tables staged as a version and registered, in a database of the folder's own; its name."""
    root = new_run_dir(spark, "gold")
    frames = {DIM_MEDIA: dim_media_frame, DIM_VISITOR: dim_visitor_frame, FACT: fact_frame}
    manifest = {t: publish.stage(gold._stamp(f(spark, sf), True), root, t, "v1", "date" if t == FACT else None)[0]
                for t, f in frames.items()}
    database = "gold_" + root.rsplit("-", 1)[-1]
    CAT.register_gold_tables(spark, root, manifest, database)
    CAT.register_media(spark, T.media_config(spark, sf), f"{root}/media_config", database)
    return database


@register("catalog_fact", O.with_views("fact") + "SELECT * FROM fact")
def catalog_fact(spark, sf):
    """External table with declared types over the written fact; partitions
    discovered by MSCK REPAIR, the current version by the view on top."""
    return spark.table(f"{_registered_gold(spark, sf)}.fact_media_engagement").select(*gold.FACT_COLUMNS)


@register("catalog_dim_media", O.with_views("dim_media") + "SELECT * FROM dim_media")
def catalog_dim_media(spark, sf):
    return spark.table(f"{_registered_gold(spark, sf)}.dim_media").drop("gold_loaded_at").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})


@register("catalog_dim_visitor", O.with_views("dim_visitor") + "SELECT * FROM dim_visitor")
def catalog_dim_visitor(spark, sf):
    return spark.table(f"{_registered_gold(spark, sf)}.dim_visitor").drop("gold_loaded_at").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("first_seen_at", "last_seen_at")})


@register("projected_fact", O.with_views("fact") + f"""
SELECT * FROM fact WHERE date BETWEEN DATE '{_PROJ_FIRST}' AND DATE '{_PROJ_TODAY}'
  AND media_id IN (SELECT 'm' || CAST(p_partkey AS VARCHAR) FROM part)""")
def projected_fact(spark, sf):
    fact = spark.table(f"{_registered_gold(spark, sf)}.fact_media_engagement")
    return CAT.projected_fact(fact, _PROJ_FIRST, T.media_config(spark, sf), _PROJ_TODAY).select(
        *gold.FACT_COLUMNS)


@register("projected_view", O.with_views("fact") + f"""
SELECT * FROM fact WHERE date BETWEEN DATE '{_PROJ_FIRST}' AND current_date
  AND media_id IN (SELECT 'm' || CAST(p_partkey AS VARCHAR) FROM part)""")
def projected_view(spark, sf):
    """The projection as a named SQL view; its last day is the day it is read."""
    view = CAT.projection_view(spark, _PROJ_FIRST, _registered_gold(spark, sf))
    return spark.sql(f"SELECT {', '.join(gold.FACT_COLUMNS)} FROM {view}")


# -- JSN-1..4 --------------------------------------------------------------------------


@register("harvest_keys", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS visitor_key FROM events "
                          "ORDER BY visitor_key")
def harvest_keys(spark, sf):
    """Visitor keys found anywhere in the landed event pages, sorted."""
    env = T.events_envelopes(spark, sf)
    docs = env.select(F.monotonically_increasing_id().alias("doc"), F.to_json(F.struct("*")).alias("json"))
    return J.harvest(docs, ["doc"], "json", VISITOR_KEY_NAMES, "visitor_key").orderBy("visitor_key")


@register("harvest_event_keys", "SELECT DISTINCT CAST(event_id AS VARCHAR) AS event_key FROM events "
                                "ORDER BY event_key")
def harvest_event_keys(spark, sf):
    """Event keys found anywhere in the landed event pages, sorted."""
    env = T.events_envelopes(spark, sf)
    docs = env.select(F.monotonically_increasing_id().alias("doc"), F.to_json(F.struct("*")).alias("json"))
    return J.harvest(docs, ["doc"], "json", EVENT_KEY_NAMES, "event_key").orderBy("event_key")


def _response_docs(spark, sf) -> DataFrame:
    """Responses of four shapes built from conversation turns: a bare list,
    a list under ``events``, a non-list ``data`` before a list ``items``,
    and a container holding no list."""
    c = _t(spark, sf, "conversations")
    rec = F.struct(F.col("role"), F.length("text").alias("chars"), F.col("turn"))
    shape_no = F.col("turn") % 4
    payload = (F.when(shape_no == 0, F.to_json(F.array(rec, rec)))
                .when(shape_no == 1, F.to_json(F.struct(F.array(rec).alias("events"))))
                .when(shape_no == 2, F.to_json(F.struct(F.lit("not a list").alias("data"),
                                                        F.array(rec, rec, rec).alias("items"))))
                .otherwise(F.to_json(F.struct(F.lit(5).alias("results")))))
    return c.select("conv_id", "turn", "role", payload.alias("payload"))


@register("extract_records", """
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 0 END AS n_records,
       CASE WHEN turn % 4 < 3 THEN role END AS first_role
FROM conversations""")
def extract_records(spark, sf):
    out = J.extract_records(_response_docs(spark, sf), "payload")
    return out.select("conv_id", "turn", F.size("records").cast("int").alias("n_records"),
                      F.try_variant_get(F.get("records", 0), "$.role", "string").alias("first_role"))


_SHAPE_FIELDS = [
    ("$", "object", False), ("$.event_key", "string", False), ("$.visitor_key", "string", True),
    ("$.media_id", "string", False), ("$.media_name", "string", False), ("$.received_at", "string", False),
    ("$.percent_viewed", "float", False), ("$.country", "string", False), ("$.region", "string", False),
    ("$.city", "string", False), ("$.lat", "float", False), ("$.lon", "float", False), ("$.org", "string", False),
    ("$.embed_url", "string", False), ("$.media_url", "string", False), ("$.ip", "string", True),
    ("$.email", "string", True), ("$.user_agent_details", "object", False),
    ("$.user_agent_details.browser", "string", False), ("$.user_agent_details.browser_version", "string", False),
    ("$.user_agent_details.platform", "string", False), ("$.user_agent_details.mobile", "bool", False),
]


@register("json_shape", O.union(*[
    f"SELECT '{p}' AS path, '{t}' AS json_type, {str(r).upper()} AS redacted, count(*) AS n_nodes, "
    "CAST(NULL AS INTEGER) AS min_length, CAST(NULL AS INTEGER) AS max_length FROM events"
    for p, t, r in _SHAPE_FIELDS]))
def json_shape(spark, sf):
    """Shape of the raw event records (one JSON document per event)."""
    rec = T.event_records(spark, sf)
    docs = rec.select(F.to_json(F.struct(*T.EVENT_RECORD_COLS)).alias("json"))
    return J.shape(docs, "json")


# -- STR-1..5 ---------------------------------------------------------------------------


def _landed_events(spark, sf) -> str:
    root = new_run_dir(spark, "stream")
    T.land(spark, sf, f"{root}/bronze", "events")
    return root


@register("stream_events", O.with_views("ev") + """
SELECT event_key, visitor_key, media_id, date_trunc('millisecond', received_at) AS received_at, event_date,
       percent_viewed FROM ev""")
def stream_events(spark, sf):
    """File-source stream, watermark = lookback, duplicates removed per key."""
    root = _landed_events(spark, sf)
    dedup = ST.deduplicated(ST.event_stream(spark, f"{root}/bronze"))
    ST.run_available_now(dedup.select("event_key", "visitor_key", "media_id", "received_at", "event_date",
                                      "percent_viewed"), f"{root}/events_dedup", f"{root}/_chk_dedup")
    return spark.read.parquet(f"{root}/events_dedup")


@register("stream_upsert", O.silver_events_sql(None))
def stream_upsert(spark, sf):
    """Micro-batches merged latest-wins into the date-partitioned silver table."""
    root = _landed_events(spark, sf)
    ST.run_upsert_stream(spark, f"{root}/bronze", f"{root}/silver_events", f"{root}/_chk_upsert",
                         max_files_per_trigger=8)
    return spark.read.parquet(f"{root}/silver_events").drop("source_file")


@register("stream_visitor_daily", O.with_views("fact") + """
SELECT media_id, sha256(visitor_key) AS visitor_id, date, play_count, watched_percent,
       total_watch_time_seconds FROM vd""")
def stream_visitor_daily(spark, sf):
    """Visitor-day rollup kept exact under streaming: touched days recomputed
    from the upserted silver table after every micro-batch."""
    root = _landed_events(spark, sf)
    media = gold.media_durations(T.media_metadata(spark, sf))
    ST.run_upsert_stream(spark, f"{root}/bronze", f"{root}/silver_events", f"{root}/_chk_daily",
                         fact_path=f"{root}/visitor_daily", media=media, max_files_per_trigger=8)
    return spark.read.parquet(f"{root}/visitor_daily").select(
        "media_id", "visitor_id", "date", "play_count", "watched_percent", "total_watch_time_seconds")


@register("stream_visitor_days", O.with_views("fact") + """
SELECT media_id, sha256(visitor_key) AS visitor_id, date, play_count, watched_percent, total_watch_time_seconds FROM vd
WHERE date + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(received_at)) FROM ev) - INTERVAL 1 DAY""")
def stream_visitor_days(spark, sf):
    """The rollup as a stateful stream over four landings, one or more batches
    each: the days that the watermark has closed, each emitted once."""
    root = new_run_dir(spark, "stream")
    env = T.thin_events_envelopes(spark, sf).checkpoint(eager=True)
    media = gold.media_durations(T.media_metadata(spark, sf))
    for first, last in (("00", "08"), ("09", "16"), ("17", "24"), ("25", "99")):
        day = F.substring("pipeline_run_id", -2, 2)
        chunk = env.filter(F.when(F.col("pipeline_run_id") >= "run-20240201", "99").otherwise(day).between(first, last))
        BZ.land(chunk, f"{root}/bronze", "events", T.full_events)
        ST.run_visitor_days(spark, f"{root}/bronze", media, f"{root}/days", f"{root}/_chk", f"{root}/late")
    return spark.read.parquet(f"{root}/days")


# -- incremental daily runs end to end ---------------------------------------------------


_RUN_TIMES = [dt.datetime(2024, 1, 11, 2, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 21, 2, tzinfo=dt.timezone.utc),
              dt.datetime(2024, 2, 1, 2, tzinfo=dt.timezone.utc), dt.datetime(2024, 2, 1, 14, tzinfo=dt.timezone.utc)]


_INCREMENTAL_ROOTS: dict[str, str] = {}


def _incremental_runs(spark, sf) -> str:
    """Four incremental runs, two of them on one day, once per scale in this session; the incremental
    keys read the tables they leave."""
    if sf not in _INCREMENTAL_ROOTS:
        root = new_run_dir(spark, "incremental")
        for as_of in _RUN_TIMES:
            run_incremental(spark, sf, root, as_of, initial_start_date="2024-01-01")
        _INCREMENTAL_ROOTS[sf] = root
    return _INCREMENTAL_ROOTS[sf]


@register("inc_daily_checks", O.with_views("fact", "dim_media", "dim_visitor") + O.union(
    O.qc_dim_media_sql(), O.qc_dim_visitor_sql(), O.qc_fact_sql()))
def inc_daily_checks(spark, sf):
    """The 27 checks after three incremental runs, the fact's metric rules
    summed from the per-day partials each run kept for its window."""
    root = _incremental_runs(spark, sf)
    fact, dim_media, dim_visitor = read_gold(spark, root)
    partials = read_published(spark, root, FACT_CHECK_PARTIALS)
    return CK.check_gold(fact, dim_media, dim_visitor, T.media_config(spark, sf), fact_partials=partials)


@register("inc_dim_visitor", O.dim_visitor_ms_sql())
def inc_dim_visitor(spark, sf):
    """The visitor dimension kept by three incremental runs (re-aggregated
    from per-day partials) equals a full build."""
    root = _incremental_runs(spark, sf)
    return read_published(spark, root, DIM_VISITOR).drop("gold_loaded_at")


@register("inc_dim_media", O.with_views("dim_media") + "SELECT * FROM dim_media")
def inc_dim_media(spark, sf):
    """The media dimension after incremental runs, two of them on one day:
    each run's snapshot stands beside the other's."""
    return read_published(spark, _incremental_runs(spark, sf), DIM_MEDIA).drop("gold_loaded_at")


@register("inc_daily_runs", O.with_views("fact") + "SELECT * FROM fact")
def inc_daily_runs(spark, sf):
    """Incremental runs with overlapping (lookback) windows covering the data:
    each lands, merges and recomputes only its window; the published fact
    equals a full rebuild."""
    return read_published(spark, _incremental_runs(spark, sf), FACT).select(*gold.FACT_COLUMNS)


# -- the daily workflow end to end -------------------------------------------------------

_DAILY_ROOTS: dict[str, str] = {}


def _daily_run_root(spark, sf) -> str:
    """Land -> silver -> gold -> checks -> reports once per scale in this
    session; both keys below read its written gold tables."""
    if sf not in _DAILY_ROOTS:
        root = new_run_dir(spark, "daily")
        run_daily(spark, sf, root, with_reports=False,
                  as_of=dt.datetime(2024, 2, 1, 2, tzinfo=dt.timezone.utc))
        _DAILY_ROOTS[sf] = root
    return _DAILY_ROOTS[sf]


@register("daily_run_fact", O.with_views("fact") + "SELECT * FROM fact")
def daily_run_fact(spark, sf):
    """The fact written by the whole daily workflow (from landed bronze)."""
    root = _daily_run_root(spark, sf)
    fact, _, _ = read_gold(spark, root)
    return fact.select(*gold.FACT_COLUMNS)


@register("daily_run_checks", O.with_views("fact", "dim_media", "dim_visitor") + O.union(
    O.qc_dim_media_sql(), O.qc_dim_visitor_sql(), O.qc_fact_sql()))
def daily_run_checks(spark, sf):
    """The 27 checks over the gold layer the daily workflow wrote."""
    fact, dim_media, dim_visitor = read_gold(spark, _daily_run_root(spark, sf))
    return CK.check_gold(fact, dim_media, dim_visitor, T.media_config(spark, sf))
