"""Skewed input (one media and one visitor holding a third of all events):
the two-phase / map-side-combined plans must give exactly the brute-force
answer."""

from __future__ import annotations

import hashlib
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from engagelake.plans import gold, reports
from engagelake.sources import testdata as T


def half_up(x: float, n: int) -> float:
    """Spark's rule: half-up on the double's shortest decimal text."""
    return float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))


def skewed_events(spark, sf):
    ev = T.silver_events(spark, sf, with_audit=False)
    hot = (F.abs(F.hash("event_key")) % 3) == 0
    return (ev.withColumn("media_id", F.when(hot, F.lit("m0")).otherwise(F.col("media_id")))
              .withColumn("visitor_key", F.when(hot, F.lit("0")).otherwise(F.col("visitor_key"))))


def test_fact_dims_and_distinct_reports_under_skew(spark, sf_small):
    ev = skewed_events(spark, sf_small)
    media = gold.media_durations(T.media_metadata(spark, sf_small))
    fact = gold.build_fact(ev, media, T.media_stats_by_date(spark, sf_small))
    pdf = ev.toPandas()
    dur = dict(media.toPandas().values.tolist())
    pdf["sec"] = pdf["percent_viewed"] * pdf["media_id"].map(dur)
    g = pdf.groupby(["media_id", "visitor_key", "event_date"])
    expected = {(m, hashlib.sha256(v.encode()).hexdigest(), d): (len(x), half_up(x["sec"].sum(), 2))
                for (m, v, d), x in g}
    got = {(r["media_id"], r["visitor_id"], r["date"]): (r["play_count"], r["total_watch_time_seconds"])
           for r in fact.collect()}
    assert got == expected

    dv = {r["visitor_id"]: r for r in gold.build_dim_visitor(ev).collect()}
    for v, x in pdf.groupby("visitor_key"):
        row = dv[hashlib.sha256(v.encode()).hexdigest()]
        assert row["event_count"] == len(x) and row["distinct_media_count"] == x["media_id"].nunique()

    dim_media = gold.build_dim_media(T.media_metadata(spark, sf_small), T.media_stats(spark, sf_small))
    chan = {r["channel"]: r for r in reports.channel_summary(fact, dim_media).collect()}
    fpdf = fact.join(dim_media.select("media_id", "channel"), "media_id").toPandas()
    for c, x in fpdf.groupby("channel"):
        assert chan[c]["unique_visitors"] == x["visitor_id"].nunique()
        assert chan[c]["media_count"] == x["media_id"].nunique()
        assert chan[c]["total_plays"] == x["play_count"].sum()


def test_approximate_distinct_opt_in_is_close(spark, sf_small):
    from engagelake.registry import dim_media_frame, fact_frame
    fact, dm = fact_frame(spark, sf_small), dim_media_frame(spark, sf_small)
    exact = {r["media_id"]: r["unique_visitors"] for r in reports.unique_visitors(fact, dm).collect()}
    approx = {r["media_id"]: r["unique_visitors"] for r in reports.unique_visitors(fact, dm, approx_rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.1 * exact[k]) for k in exact)
    ch = {r["channel"]: r for r in reports.channel_summary(fact, dm, approx_rsd=0.02).collect()}
    ex = {r["channel"]: r for r in reports.channel_summary(fact, dm).collect()}
    assert all(ch[c]["total_plays"] == ex[c]["total_plays"] for c in ex)
