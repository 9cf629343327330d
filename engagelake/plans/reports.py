"""Reports over the gold star schema.

Each report is a DataFrame plan over ``fact`` / ``dim_media`` /
``dim_visitor``.  The fact joins the media dimension with an inner join (a
fact row whose media is not in the dimension drops out of reports), the
dimension side being a size-checked broadcast.

Sums and averages of rounded gold doubles are computed as DECIMAL sums
(``exact_sum``): the result no longer depends on partitioning or task
order and is within one unit in the last place of a plain double sum.

Distinct counts run in two phases: first per (group, distinct value) --
the shuffle is spread by the value, so a group with billions of visitors
is not one reducer's work -- then per group over those partials, with
map-side combining.  All other measures ride along as partial sums / maxima.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagelake.constants import CHANNELS
from engagelake.functions.scalar import exact_avg, exact_sum, exact_sum_double, round_exact_sum
from engagelake.operators.broadcast import sized_broadcast


def _dec_avg(sum_col: str, n_col: str):
    """Average from summed DECIMAL partials and summed counts."""
    return F.sum(sum_col).cast("double") / F.sum(n_col)


def _fact_media(fact: DataFrame, dim_media: DataFrame, media_cols=("channel",),
                dim_bound: DataFrame | None = None) -> DataFrame:
    m = sized_broadcast(dim_media.select("media_id", *media_cols), bound=dim_bound)
    return fact.join(m, "media_id", "inner")


def smoke(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows by key (the smoke reports' LIMIT, made deterministic)."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def plays_by_date_channel(fact: DataFrame, dim_media: DataFrame, dim_bound: DataFrame | None = None) -> DataFrame:
    return (_fact_media(fact, dim_media, dim_bound=dim_bound)
            .groupBy("date", "channel")
            .agg(F.sum("play_count").alias("total_plays"))
            .orderBy("date", "channel"))


def watch_time_by_date_channel(fact: DataFrame, dim_media: DataFrame, dim_bound: DataFrame | None = None) -> DataFrame:
    return (_fact_media(fact, dim_media, dim_bound=dim_bound)
            .groupBy("date", "channel")
            .agg(round_exact_sum("total_watch_time_hours", 4).alias("total_watch_time_hours"),
                 round_exact_sum("total_watch_time_seconds", 2).alias("total_watch_time_seconds"))
            .orderBy("date", "channel"))


def avg_watched_by_media(fact: DataFrame, dim_media: DataFrame, dim_bound: DataFrame | None = None) -> DataFrame:
    keys = ["channel", "media_id", "title"]
    per_visitor = (_fact_media(fact, dim_media, ("channel", "title"), dim_bound)
                   .groupBy(*keys, "visitor_id")
                   .agg(exact_sum("watched_percent").alias("_wp_sum"), F.count("watched_percent").alias("_wp_n"),
                        F.max("watched_percent").alias("_wp_max"), F.sum("play_count").alias("_plays")))
    return (per_visitor.groupBy(*keys)
            .agg(F.round(_dec_avg("_wp_sum", "_wp_n"), 4).alias("avg_watched_percent"),
                 F.round(F.max("_wp_max"), 4).alias("max_watched_percent"),
                 F.count("visitor_id").alias("unique_visitors"),
                 F.sum("_plays").alias("total_plays"))
            .orderBy(F.col("avg_watched_percent").desc()))


def unique_visitors(fact: DataFrame, dim_media: DataFrame, dim_bound: DataFrame | None = None,
                    approx_rsd: float | None = None) -> DataFrame:
    """``approx_rsd`` opts into HyperLogLog counts (one pass; sketches merge
    map-side, so it is skew-safe too) with that relative standard deviation."""
    keys = ["channel", "media_id", "title"]
    if approx_rsd is not None:
        return (_fact_media(fact, dim_media, ("channel", "title"), dim_bound).groupBy(*keys)
                .agg(F.approx_count_distinct("visitor_id", approx_rsd).alias("unique_visitors"),
                     F.sum("play_count").alias("total_plays"))
                .orderBy(F.col("unique_visitors").desc()))
    per_visitor = (_fact_media(fact, dim_media, ("channel", "title"), dim_bound)
                   .groupBy(*keys, "visitor_id").agg(F.sum("play_count").alias("_plays")))
    return (per_visitor.groupBy(*keys)
            .agg(F.count("visitor_id").alias("unique_visitors"), F.sum("_plays").alias("total_plays"))
            .orderBy(F.col("unique_visitors").desc()))


def channel_summary(fact: DataFrame, dim_media: DataFrame, dim_bound: DataFrame | None = None,
                    approx_rsd: float | None = None) -> DataFrame:
    """Two distinct counts per channel from one scan: grouping sets over
    (channel, visitor) and (channel, media) in one aggregate, whose rows are
    counted per channel (``approx_rsd``: HyperLogLog counts instead)."""
    fm = _fact_media(fact, dim_media, dim_bound=dim_bound)
    if approx_rsd is not None:
        return (fm.groupBy("channel").agg(
            F.approx_count_distinct("media_id", approx_rsd).alias("media_count"),
            F.approx_count_distinct("visitor_id", approx_rsd).alias("unique_visitors"),
            F.sum("play_count").alias("total_plays"),
            F.round(exact_avg("play_rate"), 4).alias("avg_play_rate"),
            F.round(exact_avg("watched_percent"), 4).alias("avg_watched_percent"),
            round_exact_sum("total_watch_time_hours", 4).alias("total_watch_time_hours"))
            .orderBy(F.col("total_plays").desc()))
    sets = fm.groupingSets([["channel", "visitor_id"], ["channel", "media_id"]], "channel", "visitor_id", "media_id").agg(
        (F.grouping("media_id") == 1).alias("_by_visitor"),
        F.sum("play_count").alias("_plays"),
        exact_sum("play_rate").alias("_pr_sum"), F.count("play_rate").alias("_pr_n"),
        exact_sum("watched_percent").alias("_wp_sum"), F.count("watched_percent").alias("_wp_n"),
        exact_sum("total_watch_time_hours").alias("_h_sum"))
    of_visitors = lambda c: F.when(F.col("_by_visitor"), F.col(c))
    rows = sets.select("channel", "_by_visitor", "visitor_id", F.when(~F.col("_by_visitor"), F.col("media_id")).alias("media_id"),
                       *[of_visitors(c).alias(c) for c in ("_plays", "_pr_sum", "_pr_n", "_wp_sum", "_wp_n", "_h_sum")])
    return rows.groupBy("channel").agg(
        F.count("media_id").alias("media_count"),
        F.count(of_visitors("visitor_id")).alias("unique_visitors"),
        F.sum("_plays").alias("total_plays"),
        F.round(_dec_avg("_pr_sum", "_pr_n"), 4).alias("avg_play_rate"),
        F.round(_dec_avg("_wp_sum", "_wp_n"), 4).alias("avg_watched_percent"),
        F.round(F.sum("_h_sum"), 4).cast("double").alias("total_watch_time_hours")).orderBy(F.col("total_plays").desc())


def daily_channel_trend(fact: DataFrame, dim_media: DataFrame, dim_bound: DataFrame | None = None,
                        channels=CHANNELS) -> DataFrame:
    """Side-by-side per-channel columns via conditional sums (0 when absent)."""
    aggs = []
    for ch in channels:
        is_ch = F.col("channel") == F.lit(ch)
        aggs.append(F.sum(F.when(is_ch, F.col("play_count")).otherwise(F.lit(0)))
                    .alias(f"{ch.lower()}_plays"))
    for ch in channels:
        is_ch = F.col("channel") == F.lit(ch)
        aggs.append(round_exact_sum(F.when(is_ch, F.col("total_watch_time_hours")).otherwise(F.lit(0.0)), 4)
                    .alias(f"{ch.lower()}_watch_hours"))
    return _fact_media(fact, dim_media, dim_bound=dim_bound).groupBy("date").agg(*aggs).orderBy("date")


def _visitor_rollup(dim_visitor: DataFrame, keys: list[str]) -> DataFrame:
    per_visitor = dim_visitor.groupBy(*keys, "visitor_id").agg(
        F.sum("event_count").alias("_events"),
        exact_sum("avg_percent_viewed").alias("_pv_sum"), F.count("avg_percent_viewed").alias("_pv_n"))
    return per_visitor.groupBy(*keys).agg(
        F.count("visitor_id").alias("unique_visitors"),
        F.sum("_events").alias("total_events"),
        F.round(_dec_avg("_pv_sum", "_pv_n"), 4).alias("avg_watched_percent"))


def top_locations(dim_visitor: DataFrame, k: int = 25) -> DataFrame:
    """Top-k places by unique visitors; ties broken by the place columns."""
    return (_visitor_rollup(dim_visitor.filter(F.col("country").isNotNull()), ["country", "region", "city"])
            .orderBy(F.col("unique_visitors").desc(), F.col("country").asc_nulls_first(),
                     F.col("region").asc_nulls_first(), F.col("city").asc_nulls_first())
            .limit(k))


def device_breakdown(dim_visitor: DataFrame) -> DataFrame:
    return (_visitor_rollup(dim_visitor, ["platform", "browser", "mobile"])
            .orderBy(F.col("unique_visitors").desc()))


def date_filtered(fact: DataFrame, dim_media: DataFrame, start: dt.date, end: dt.date,
                  dim_bound: DataFrame | None = None) -> DataFrame:
    """Both ends included; on a table partitioned by ``date`` the predicate
    becomes a partition filter."""
    f = fact.filter(F.col("date").between(F.lit(start), F.lit(end)))
    return (_fact_media(f, dim_media, dim_bound=dim_bound)
            .groupBy("date", "channel", "media_id")
            .agg(F.sum("play_count").alias("total_plays"),
                 round_exact_sum("total_watch_time_hours", 4).alias("total_watch_time_hours"))
            .orderBy("date", "channel", "media_id"))


def kpi(fact: DataFrame, dim_media: DataFrame, dim_bound: DataFrame | None = None) -> DataFrame:
    return (_fact_media(fact, dim_media, dim_bound=dim_bound)
            .groupBy("date", "channel", "media_id")
            .agg(F.sum("play_count").alias("plays"),
                 exact_avg("watched_percent").alias("avg_watched_percent"),
                 exact_sum_double("total_watch_time_hours").alias("total_watch_time_hours"))
            .orderBy(F.col("date").desc(), "channel", "media_id"))
