"""Bronze scan and silver transforms on hand-written envelopes (edge rows)."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from engagelake.plans import silver
from engagelake.plans.workflow import process_bronze, read_published
from engagelake.sources import bronze
from engagelake.streaming import events as stream

RUN1 = {"pipeline_run_id": "r1", "ingested_at": "2026-05-10T02:00:00.000000+00:00", "source": "s",
        "endpoint": "/x", "request_params": {}}
RUN2 = {**RUN1, "pipeline_run_id": "r2", "ingested_at": "2026-05-11T02:00:00.000000+00:00"}


def land_lines(tmp_path, dataset, docs, raw_lines=()):
    d = tmp_path / dataset / "ingest_date=2026-05-10" / "run_id=r1"
    d.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps({**doc, "dataset": dataset}) for doc in docs] + list(raw_lines)
    (d / "part-0.json").write_text("\n".join(lines) + "\n")
    (d / "ignored.txt").write_text("not json at all\n")
    return str(tmp_path)


def event(key, **kw):
    base = {"event_key": key, "visitor_key": "v1", "media_id": "m1", "received_at": "2026-05-09T10:00:00.123Z",
            "percent_viewed": 0.5, "ip": "1.2.3.4", "email": "a@b.c",
            "user_agent_details": {"browser": "b", "browser_version": "1", "platform": "p", "mobile": True}}
    base.update(kw)
    return base


def test_events_edge_rows(spark, tmp_path):
    docs = [
        {**RUN1, "media_id": "m1", "channel": "c", "payload": []},                       # empty page
        {**RUN1, "media_id": "m1", "channel": "c", "payload": [
            event("e1", percent_viewed=0.25), event("e2"), event("e3", received_at="2026-05-09T10:00:59Z"),
            event(None)]},
        {**RUN2, "media_id": "m1", "channel": "c", "payload": [event("e1", percent_viewed=0.75)]},
        {**RUN2, "media_id": "m1", "channel": "c", "payload": [event("e2"), event("e2")]},  # tie
        {**RUN1, "ingested_at": None, "media_id": "m1", "channel": "c", "payload": [event("e4", percent_viewed=0.1)]},
        {**RUN1, "media_id": "m1", "channel": "c", "payload": [event("e4", percent_viewed=0.9)]},
    ]
    root = land_lines(tmp_path, "events", docs, raw_lines=["{broken json"])
    env = bronze.read(spark, root, "events")
    out = {r["event_key"]: r for r in silver.events(env).collect()}
    assert set(out) == {"e1", "e2", "e3", "e4"}               # null key and empty page dropped
    assert out["e1"]["percent_viewed"] == 0.75                # later landing wins
    assert out["e1"]["pipeline_run_id"] == "r2"
    assert out["e3"]["received_at"] is None and out["e3"]["event_date"] is None  # no fraction -> null
    assert out["e4"]["percent_viewed"] == 0.9                 # a value beats a null ingested_at
    assert "ip" not in silver.events(env).columns and "email" not in silver.events(env).columns
    assert all(r["source_file"].startswith("file:") for r in out.values())
    bad = bronze.quarantine(spark, root, "events").collect()
    assert len(bad) == 1 and bad[0]["raw"] == "{broken json" and bad[0]["reason"] == bronze.NOT_JSON


def test_metadata_empty_payload_gives_null_media_row(spark, tmp_path):
    root = land_lines(tmp_path, "media_metadata", [{**RUN1, "media_id": None, "channel": None, "payload": []}])
    rows = silver.media_metadata(bronze.read(spark, root, "media_metadata")).collect()
    assert len(rows) == 1 and rows[0]["media_id"] is None


def test_non_numeric_count_is_null_field_not_corrupt_row(spark, tmp_path):
    doc = {**RUN1, "media_id": "m1", "channel": "c",
           "payload": {"load_count": "n/a", "play_count": 7, "play_rate": 0.5, "hours_watched": 1.5,
                       "engagement": 0.1, "visitors": 3}}
    root = land_lines(tmp_path, "media_stats", [doc])
    rows = silver.media_stats(bronze.read(spark, root, "media_stats")).collect()
    assert len(rows) == 1
    assert rows[0]["load_count"] is None and rows[0]["play_count"] == 7 and rows[0]["visitor_count"] == 3


def test_engagement_zip_pads_shorter_array(spark, tmp_path):
    doc = {**RUN1, "media_id": "m1", "channel": "c",
           "payload": {"engagement": 0.4, "engagement_data": [5, 6, 7], "rewatch_data": [1]}}
    root = land_lines(tmp_path, "media_engagement", [doc])
    rows = sorted(silver.media_engagement(bronze.read(spark, root, "media_engagement")).collect(),
                  key=lambda r: r["timeline_index"])
    assert [r["timeline_index"] for r in rows] == [0, 1, 2]
    assert [r["engagement_value"] for r in rows] == [5, 6, 7]
    assert [r["rewatch_value"] for r in rows] == [1, None, None]


def test_missing_dataset_and_all_empty_payloads(spark, tmp_path):
    assert bronze.read(spark, str(tmp_path), "visitor_stats").count() == 0
    root = land_lines(tmp_path, "media_stats_by_date",
                      [{**RUN1, "media_id": "m1", "channel": "c", "payload": []}])
    rows = silver.media_stats_by_date(bronze.read(spark, root, "media_stats_by_date")).collect()
    assert len(rows) == 1 and rows[0]["metric_date"] is None   # harmless: never joins


def test_landing_round_trip_keeps_envelope(spark, sf_small, tmp_path):
    from engagelake.sources import testdata as T
    env = T.media_stats_envelopes(spark, sf_small)
    bronze.land(env, str(tmp_path), "media_stats")
    back = bronze.read(spark, str(tmp_path), "media_stats")
    assert back.count() == env.count()
    a = {(r["pipeline_run_id"], r["media_id"], r["channel"]) for r in env.collect()}
    b = {(r["pipeline_run_id"], r["media_id"], r["channel"]) for r in back.collect()}
    assert a == b


def test_multiline_documents_and_folder_without_json(spark, tmp_path):
    d = tmp_path / "media_stats" / "ingest_date=2026-05-10" / "run_id=r1" / "media_id=m1"
    d.mkdir(parents=True)
    doc = {**RUN1, "dataset": "media_stats", "media_id": "m1", "channel": "c",
           "payload": {"load_count": 4, "play_count": 2, "play_rate": 0.5, "hours_watched": 0.1,
                       "engagement": 0.2, "visitors": 1}}
    (d / "media_stats_m1.json").write_text(json.dumps(doc, indent=2))          # one pretty-printed document
    rows = silver.media_stats(bronze.read(spark, str(tmp_path), "media_stats")).collect()
    assert len(rows) == 1 and rows[0]["media_id"] == "m1" and rows[0]["load_count"] == 4
    e = tmp_path / "events" / "ingest_date=2026-05-10"
    e.mkdir(parents=True)
    (e / "notes.txt").write_text("no json here\n")
    assert bronze.read(spark, str(tmp_path), "events").count() == 0


def test_process_existing_multiline_bronze_end_to_end(spark, tmp_path):
    from engagelake.plans.workflow import process_bronze
    b = tmp_path / "bronze"
    run = {**RUN1}
    docs = {
        "media_metadata": {**run, "media_id": None, "channel": None, "payload": [
            {"hashed_id": "m1", "id": 1, "name": "t1", "duration": 100.0, "type": "Video", "status": "ready",
             "archived": False, "created": "2026-05-01T00:00:00Z", "updated": "2026-05-02T00:00:00Z"}]},
        "media_stats": {**run, "media_id": "m1", "channel": "Facebook", "payload": {"load_count": 4, "play_count": 2}},
        "media_stats_by_date": {**run, "media_id": "m1", "channel": "Facebook",
                                "payload": [{"date": "2026-05-09", "load_count": 4, "play_count": 2,
                                             "hours_watched": 0.5}]},
        "events": {**run, "media_id": "m1", "channel": "Facebook", "payload": [event("e1"), event("e2")]},
    }
    for ds, doc in docs.items():
        d = b / ds / "ingest_date=2026-05-10" / "run_id=r1"
        d.mkdir(parents=True)
        (d / f"{ds}.json").write_text(json.dumps({**doc, "dataset": ds}, indent=2))
    cfg = spark.createDataFrame([("m1", "Facebook")], "media_id string, channel string")
    rep = process_bronze(spark, str(b), str(tmp_path / "out"), cfg, with_reports=True)
    assert rep.rows["gold.fact_media_engagement"] == 1 and rep.rows["gold.dim_visitor"] == 1
    fact = read_published(spark, str(tmp_path / "out"), "gold/fact_media_engagement").first()
    assert fact["play_count"] == 2 and fact["play_rate"] == 0.5 and fact["total_watch_time_seconds"] == 100.0
    assert rep.failed_checks == 0 and rep.watermark_committed


def test_missing_bronze_dataset_skips_silver_and_gold_fails_fast(spark, tmp_path):
    import pytest

    from engagelake.plans.workflow import process_bronze
    from engagelake.sources.files import MissingTableError
    b = tmp_path / "bronze" / "media_metadata" / "ingest_date=2026-05-10" / "run_id=r1"
    b.mkdir(parents=True)
    (b / "m.json").write_text(json.dumps({**RUN1, "dataset": "media_metadata", "media_id": None,
                                          "channel": None, "payload": [{"hashed_id": "m1"}]}))
    cfg = spark.createDataFrame([("m1", "Facebook")], "media_id string, channel string")
    with pytest.raises(MissingTableError, match="events"):
        process_bronze(spark, str(tmp_path / "bronze"), str(tmp_path / "out"), cfg)


def write(tmp_path, dataset, name, text):
    d = tmp_path / dataset / "ingest_date=2026-05-10" / "run_id=r1"
    d.mkdir(parents=True, exist_ok=True)
    (d / name).write_text(text)


@pytest.mark.parametrize("limit", [bronze.WHOLE_FILE_BYTES, 0])
def test_one_odd_record_costs_only_itself(spark, tmp_path, limit):
    page = [event(f"e{i}") for i in range(101)]
    page[40] = event("e40", user_agent_details="not an object")
    write(tmp_path, "events", "a.json", json.dumps({**RUN1, "dataset": "events", "media_id": "m1", "payload": page}) + "\n")
    got = bronze.decoded(spark, str(tmp_path), "events", whole_file_bytes=limit)
    assert silver.events(bronze.envelopes_of(got, "events")).count() == 100
    bad = bronze.rejects_of(got, "events").collect()
    assert [(r.position, r.reason, r.pipeline_run_id, r.dataset) for r in bad] == [(40, bronze.OTHER_STRUCTURE, "r1", "events")]
    assert json.loads(bad[0].raw) == page[40] and bad[0].source_file.endswith("/a.json")


def test_every_kind_of_reject_and_both_layouts_in_one_folder(spark, tmp_path):
    line = lambda payload, **kw: json.dumps({**RUN1, "dataset": "events", "media_id": "m1", "payload": payload, **kw})
    write(tmp_path, "events", "lines.json", "\n".join([
        "{broken first", line([event("a"), 5, None, "text", [event("b")], event("c")]), "", "  ", "[1, 2]", '"text"', '{"other": 1}',
        line({"event_key": "d"}), line(None), line([]), line([event("e")])[:-9], line([event("f", country={"code": "x"})])]))
    write(tmp_path, "events", "document.json", json.dumps(json.loads(line([event("g"), event("h")])), indent=2))
    write(tmp_path, "events", "cut.json", json.dumps(json.loads(line([event("i")])), indent=2)[:-20])
    write(tmp_path, "events", "blank.json", " \n\n")
    got = bronze.decoded(spark, str(tmp_path), "events")
    kept = {r.event_key: r for r in silver.events(bronze.envelopes_of(got, "events")).collect()}
    assert set(kept) == set("acfgh")
    assert json.loads(kept["f"].country) == {"code": "x"}
    bad = sorted((r.source_file.rsplit("/", 1)[1], -1 if r.position is None else r.position, r.reason, r.pipeline_run_id or "")
                 for r in bronze.rejects_of(got, "events").collect())
    assert bad == sorted([
        ("cut.json", -1, bronze.NOT_JSON, "r1"), ("lines.json", -1, bronze.NOT_JSON, ""), ("lines.json", -1, bronze.NOT_JSON, "r1"),
        ("lines.json", -1, bronze.NOT_JSON, ""), ("lines.json", -1, bronze.NOT_JSON, ""), ("lines.json", -1, bronze.NOT_AN_ENVELOPE, ""),
        ("lines.json", -1, bronze.NOT_A_LIST, "r1"), *[("lines.json", k, bronze.NOT_AN_OBJECT, "r1") for k in (1, 2, 3, 4)]])
    assert [r.source_file.rsplit("/", 1)[1] for r in bronze.barren_files(got).collect()] == ["cut.json"]


def test_single_record_payloads_and_nested_arrays(spark, tmp_path):
    write(tmp_path, "media_engagement", "a.json", "\n".join(json.dumps({**RUN1, "media_id": m, "payload": p}) for m, p in [
        ("m1", {"engagement": 0.5, "engagement_data": [1, 2], "rewatch_data": [3]}), ("m2", {"engagement_data": {"x": 1}}),
        ("m3", [1]), ("m4", None)]))
    got = bronze.decoded(spark, str(tmp_path), "media_engagement")
    assert {r.media_id for r in silver.media_engagement(bronze.envelopes_of(got, "media_engagement")).collect()
            if r.engagement_value is not None} == {"m1"}
    assert sorted((r.position, r.reason) for r in bronze.rejects_of(got, "media_engagement").collect()) == [
        (0, bronze.OTHER_STRUCTURE), (0, bronze.NOT_AN_OBJECT)]


def lake(tmp_path, events, **more):
    """A bronze folder with a catalogue, statistics and the given event documents."""
    b = tmp_path / "bronze"
    docs = {"media_metadata": {**RUN1, "payload": [{"hashed_id": "m1", "name": "t1", "duration": 100.0}]},
            "media_stats": {**RUN1, "media_id": "m1", "channel": "Facebook", "payload": {"load_count": 4, "play_count": 2}},
            "media_stats_by_date": {**RUN1, "media_id": "m1", "channel": "Facebook",
                                    "payload": [{"date": "2026-05-09", "load_count": 4, "play_count": 2, "hours_watched": 0.5}]}}
    for ds, doc in docs.items():
        write(b, ds, "a.json", json.dumps({**doc, "dataset": ds}, indent=1))
    for name, text in events.items():
        write(b, "events", name, text)
    return str(b), str(tmp_path / "out"), [("m1", "Facebook")]


def test_run_lands_the_quarantine_and_counts_it(spark, tmp_path):
    good = json.dumps({**RUN1, "media_id": "m1", "channel": "Facebook", "payload": [event("e1"), "odd", event("e2")]})
    b, out, cfg = lake(tmp_path, {"a.json": good + "\n{broken\n"})
    rep = process_bronze(spark, b, out, spark.createDataFrame(cfg, "media_id string, channel string"), with_reports=False, run_id="run1")
    assert rep.quarantined == {"media_metadata": 0, "media_stats": 0, "media_stats_by_date": 0, "events": 2}
    rows = spark.read.parquet(f"{out}/quarantine/events").collect()
    assert {(r.position, r.reason, r.raw, r.processed_by) for r in rows} == {
        (1, bronze.NOT_AN_OBJECT, "odd", "run1"), (None, bronze.NOT_JSON, "{broken", "run1")}
    assert rep.rows["silver.events"] == 2 and rep.watermark_committed


def test_a_file_that_gives_nothing_stops_the_run(spark, tmp_path):
    good = json.dumps({**RUN1, "media_id": "m1", "channel": "Facebook", "payload": [event("e1")]})
    b, out, cfg = lake(tmp_path, {"a.json": good, "b.json": good[:-30]})
    with pytest.raises(bronze.BronzeError, match="b.json"):
        process_bronze(spark, b, out, spark.createDataFrame(cfg, "media_id string, channel string"), with_reports=False)
    assert spark.read.parquet(f"{out}/quarantine/events").count() == 1
    assert not os.path.exists(f"{out}/gold") and not os.path.exists(f"{out}/state")


def test_a_present_dataset_without_events_runs_clean(spark, tmp_path):
    b, out, cfg = lake(tmp_path, {"a.json": json.dumps({**RUN1, "media_id": "m1", "channel": "Facebook", "payload": []})})
    rep = process_bronze(spark, b, out, spark.createDataFrame(cfg, "media_id string, channel string"),
                         waived=["dim_visitor.row_count_positive", "fact_media_engagement.row_count_positive"])
    assert rep.rows["gold.fact_media_engagement"] == 0 and rep.rows["gold.dim_media"] == 1
    assert read_published(spark, out, "gold/fact_media_engagement").count() == 0


def test_streams_read_both_layouts_and_land_rejects(spark, tmp_path):
    doc = {**RUN1, "media_id": "m1", "channel": "c"}
    write(tmp_path, "events", "a.json", json.dumps({**doc, "payload": [event("e1"), event("e2", user_agent_details=7)]}) + "\n{broken\n")
    write(tmp_path, "events", "b.json", json.dumps({**doc, "payload": [event("e3")]}, indent=2))
    root = str(tmp_path)
    stream.run_upsert_stream(spark, root, f"{root}/silver", f"{root}/_chk", quarantine_path=f"{root}/q", max_files_per_trigger=1)
    assert {r.event_key for r in spark.read.parquet(f"{root}/silver").collect()} == {"e1", "e3"}
    assert sorted(r.reason for r in spark.read.parquet(f"{root}/q").collect()) == [bronze.OTHER_STRUCTURE, bronze.NOT_JSON]
    stream.run_available_now(stream.deduplicated(stream.event_stream(spark, root)).select("event_key"), f"{root}/d", f"{root}/_chk2")
    assert {r.event_key for r in spark.read.parquet(f"{root}/d").collect()} == {"e1", "e3"}


def test_events_are_landed_compressed_and_completed_behind_the_shuffles(spark, sf_small, tmp_path):
    from engagelake.sources import testdata as T
    out = T.land(spark, sf_small, str(tmp_path / "thin"), "events")
    bronze.land(T.events_envelopes(spark, sf_small), str(tmp_path / "full"), "events")
    assert {f.name.split(".", 1)[1].split(".", 1)[1] for f in (tmp_path / "thin").rglob("part-*")} == {"json.gz"}
    thin, full = (bronze.read(spark, str(tmp_path / name), "events").select(
        "pipeline_run_id", "ingested_at", "media_id", "channel", F.to_json("request_params"), F.explode("payload")) for name in ("thin", "full"))
    assert out.endswith("/events") and thin.count() == full.count() > 0
    pages = [c for c in thin.columns if c != "col"]
    assert {(r["pipeline_run_id"], r["media_id"], r["col"]) for r in thin.collect()} == {
        (r["pipeline_run_id"], r["media_id"], r["col"]) for r in full.collect()}
    assert thin.select(pages).distinct().exceptAll(full.select(pages).distinct()).isEmpty()
    env = T.thin_events_envelopes(spark, sf_small)
    assert "embed_url" not in env.select("payload").schema.simpleString() and T.full_events(env).schema["payload"].dataType.elementType.fieldNames() == T.EVENT_RECORD_COLS


def test_envelopes_that_fit_are_decoded_as_by_their_parts(spark, tmp_path):
    head = {"pipeline_run_id": "r", "ingested_at": "2026-05-10T02:00:00+00:00", "request_params": {"page": 1}, "media_id": 5}
    records = [{"event_key": "a", "percent_viewed": 0.10, "user_agent_details": {"mobile": True}}, {"event_key": 7, "extra": [1]}]
    (tmp_path / "events").mkdir()
    lines = [json.dumps({**head, "payload": records}), json.dumps({**head, "payload": [*records, None]}), json.dumps({**head, "payload": []}),
             json.dumps(head)]
    (tmp_path / "events" / "a.json").write_text("\n".join(lines))
    rows = bronze.decoded(spark, str(tmp_path), "events").collect()
    whole, parts, empty, none = sorted(rows, key=lambda r: (r.payload is None, -len(r.payload or ()), len(r.rejects)))
    assert whole.payload == parts.payload and [e.event_key for e in whole.payload] == ["a", "7"] and whole.request_params == parts.request_params
    assert [(r.position, r.reason) for r in parts.rejects] == [(2, bronze.NOT_AN_OBJECT)] and not whole.rejects
    assert empty.payload == [] and none.payload is None and all(r.is_envelope and r.media_id == "5" for r in rows)


def test_scans_get_small_splits_unless_the_session_says_otherwise(spark):
    from engagelake.session import SPLIT, configure
    assert spark.conf.get(SPLIT) == "32m"                  # landed text is ten times its compressed size
    spark.conf.set(SPLIT, "64m")
    try:
        assert configure(spark).conf.get(SPLIT) == "64m"
    finally:
        spark.conf.set(SPLIT, "32m")
