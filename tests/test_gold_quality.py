"""Gold builders and quality checks on small hand-made silver frames."""

from __future__ import annotations

import datetime as dt

import pytest

from engagelake.operators import quality as q
from engagelake.plans import checks, gold, reports

D1 = dt.date(2026, 5, 9)
T1 = dt.datetime(2026, 5, 9, 10, 0, 0)
T2 = dt.datetime(2026, 5, 9, 11, 0, 0)

EV_SCHEMA = ("event_key string, visitor_key string, media_id string, received_at timestamp, event_date date, "
             "percent_viewed double, country string, region string, city string, browser string, "
             "browser_version string, platform string, mobile boolean")


def events(spark):
    return spark.createDataFrame([
        ("e1", "v1", "m1", T1, D1, 0.5, "C1", "R1", "X1", "b1", "1", "p", False),
        ("e2", "v1", "m1", T2, D1, 1.2, "C2", "R2", "X2", "b2", "2", "p", True),   # newest for v1; pct > 1
        ("e3", "v1", "m9", T1, D1, 0.25, "C1", "R1", "X1", "b1", "1", "p", False),  # unknown media
        ("e4", None, "m1", T1, D1, 0.5, "C1", "R1", "X1", "b1", "1", "p", False),   # no visitor
        ("e5", "v2", "m2", T1, D1, 0.5, "C3", None, None, "b3", "3", "q", False),
    ], EV_SCHEMA)


def metadata(spark):
    return spark.createDataFrame([
        ("m1", 1, "t1", "d", 100.0, "video", "ready", False, None, None, "r1", T1),
        ("m2", 2, "t2", "d", 10.0, "video", "ready", False, None, None, "r1", T1),
        ("m3", 3, "t3", "d", 10.0, "video", "ready", False, None, None, "r1", T1),     # no stats
    ], "media_id string, numeric_id long, title string, description string, duration_seconds double, "
       "media_type string, status string, archived boolean, created_at timestamp, updated_at timestamp, "
       "pipeline_run_id string, ingested_at timestamp")


def stats(spark):
    return spark.createDataFrame([
        ("m1", "Facebook", "r1", T1), ("m1", "YouTube", "r2", T2), ("m2", "YouTube", "r1", T1),
    ], "media_id string, channel string, pipeline_run_id string, ingested_at timestamp")


def by_date(spark):
    return spark.createDataFrame([
        ("m1", D1, 0, 3, 1.0), ("m2", D1, None, 3, 1.0),
    ], "media_id string, metric_date date, load_count long, play_count long, hours_watched double")


def test_dim_media_latest_channel_and_missing_stats(spark):
    rows = {r["media_id"]: r for r in gold.build_dim_media(metadata(spark), stats(spark)).collect()}
    assert rows["m1"]["channel"] == "YouTube"        # latest stats row wins
    assert rows["m3"]["channel"] is None             # media without stats


def test_fact_rules(spark):
    dm = gold.build_dim_media(metadata(spark), stats(spark))
    fact = gold.build_fact(events(spark), dm, by_date(spark)).collect()
    assert len(fact) == 3                             # (m1,v1), (m9,v1), (m2,v2); null visitor dropped
    by_media = {r["media_id"]: r for r in fact}
    assert by_media["m1"]["play_rate"] is None        # load_count 0
    assert by_media["m2"]["play_rate"] is None        # load_count null
    assert by_media["m9"]["total_watch_time_seconds"] is None   # unknown media: no duration
    m1 = by_media["m1"]
    assert m1["play_count"] == 2 and m1["watched_percent"] == 0.85
    assert m1["total_watch_time_seconds"] == 170.0 and m1["total_watch_time_hours"] == round(170 / 3600, 6)


def test_distinct_switch_agrees_on_unique_events(spark):
    dm = gold.build_dim_media(metadata(spark), stats(spark))
    a = sorted(gold.build_fact(events(spark), dm, by_date(spark)).collect())
    b = sorted(gold.build_fact(events(spark), dm, by_date(spark), events_unique=False).collect())
    assert a == b


def test_dim_visitor_latest_attributes_and_counts(spark):
    rows = {r["country"]: r for r in gold.build_dim_visitor(events(spark)).collect()}
    v1 = rows["C2"]                                   # attributes of the newest event
    assert v1["browser"] == "b2" and v1["mobile"] is True
    assert v1["event_count"] == 3 and v1["distinct_media_count"] == 2
    assert v1["first_seen_at"] == T1 and v1["last_seen_at"] == T2
    assert v1["max_percent_viewed"] == 1.2 and len(rows) == 2


def results(df):
    return {r["check"]: r for r in df.collect()}


def test_quality_null_semantics(spark):
    dm = gold.build_dim_media(metadata(spark), stats(spark))
    cfg = spark.createDataFrame([("m1", "Facebook"), ("m2", "YouTube"), ("m3", "YouTube")],
                                "media_id string, channel string")
    res = results(checks.check_dim_media(dm, cfg))
    assert res["dim_media.row_count"]["passed"] is True
    assert res["dim_media.channel.not_null"]["passed"] is False          # m3 has no channel
    assert res["dim_media.channel.expected_values"]["passed"] is True    # null is not a violation
    assert res["dim_media.channel.expected_values"]["details"] == "expected=['Facebook', 'YouTube'], invalid_count=0"
    only_fb = spark.createDataFrame([("m1", "Facebook")], "media_id string, channel string")
    assert results(checks.check_dim_media(dm, only_fb))["dim_media.channel.expected_values"]["observed"] == 2


def test_fact_checks_catch_range_and_orphans(spark):
    dm = gold.build_dim_media(metadata(spark), stats(spark))
    dv = gold.build_dim_visitor(events(spark))
    fact = gold.build_fact(events(spark), dm, by_date(spark))
    res = results(checks.check_fact(fact, dm, dv))
    assert res["fact_media_engagement.media_id.exists_in_dim_media"]["observed"] == 1   # m9
    assert res["fact_media_engagement.visitor_id.exists_in_dim_visitor"]["passed"] is True
    assert res["fact_media_engagement.grain.unique"]["passed"] is True
    vres = results(checks.check_dim_visitor(dv))
    assert vres["dim_visitor.max_percent_viewed.between_0_and_1"]["passed"] is False   # 1.2 kept
    plays = [tuple(r) for r in reports.plays_by_date_channel(fact, dm).collect()]
    assert plays == [(D1, "YouTube", 3)]                                               # m9's play drops out
    with pytest.raises(q.QualityGateError):
        q.enforce(checks.check_gold(fact, dm, dv, spark.createDataFrame([("m1", "YouTube")],
                                                                        "media_id string, channel string")))


def test_duplicate_null_keys_count_once(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "k string, v int")
    assert q.duplicate_key_count(df, ["k"]).first()["observed"] == 2


def test_report_lines_and_run_id(spark):
    from engagelake.sources.bronze import new_run_id
    dm = gold.build_dim_media(metadata(spark), stats(spark))
    cfg = spark.createDataFrame([("m1", "Facebook"), ("m2", "YouTube"), ("m3", "YouTube")],
                                "media_id string, channel string")
    lines = q.report_lines(checks.check_dim_media(dm, cfg))
    assert lines[0] == "[PASS] dim_media.row_count - expected=3, actual=3"
    assert "[FAIL] dim_media.channel.not_null - null_count=1" in lines
    rid = new_run_id(dt.datetime(2026, 5, 10, 2, 0, 5, tzinfo=dt.timezone.utc))
    assert rid.startswith("20260510T020005Z-") and len(rid) == len("20260510T020005Z-") + 8


def test_fact_checks_from_partials_equal_whole_table_checks(spark):
    dm = gold.build_dim_media(metadata(spark), stats(spark))
    dv = gold.build_dim_visitor(events(spark))
    fact = gold.build_fact(events(spark), dm, by_date(spark))
    dup = fact.unionByName(fact.limit(1))                          # one duplicated grain key
    for f in (fact, dup):
        whole = sorted(map(tuple, checks.check_fact(f, dm, dv).collect()))
        parts = sorted(map(tuple, checks.check_fact_from_partials(checks.fact_check_partials(f), f, dm, dv).collect()))
        assert whole == parts
