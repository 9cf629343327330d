"""Audited publishing, atomic commits and the key index."""

from __future__ import annotations

import datetime as dt
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from engagelake.operators.quality import QualityGateError
from engagelake.plans import incremental as INC
from engagelake.plans import publish
from engagelake.plans.workflow import current, process_bronze, read_published, run_incremental
from engagelake.session import new_run_dir
from engagelake.sources.files import create_if_absent

UTC = dt.timezone.utc
RUN = {"pipeline_run_id": "r1", "ingested_at": "2026-05-10T02:00:00+00:00", "source": "s", "endpoint": "/x", "request_params": {}}


def land(folder, percent):
    event = {"event_key": "e1", "visitor_key": "v1", "media_id": "m1", "received_at": "2026-05-09T10:00:00.123Z",
             "percent_viewed": percent}
    docs = {"media_metadata": {**RUN, "payload": [{"hashed_id": "m1", "name": "t", "duration": 100.0}]},
            "media_stats": {**RUN, "media_id": "m1", "channel": "Facebook", "payload": {"load_count": 4, "play_count": 2}},
            "media_stats_by_date": {**RUN, "media_id": "m1", "channel": "Facebook",
                                    "payload": [{"date": "2026-05-09", "load_count": 4, "play_count": 2, "hours_watched": 0.5}]},
            "events": {**RUN, "media_id": "m1", "channel": "Facebook", "payload": [event]}}
    for name, doc in docs.items():
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/a.json", "w") as out:
            json.dump({**doc, "dataset": name}, out, indent=2)
    return str(folder)


def test_a_refused_run_changes_nothing_that_readers_see(spark, tmp_path):
    media = spark.createDataFrame([("m1", "Facebook")], "media_id string, channel string")
    out = str(tmp_path / "out")
    good, bad = land(tmp_path / "good", 0.5), land(tmp_path / "bad", 1.5)
    first = process_bronze(spark, good, out, media, as_of=dt.datetime(2026, 5, 10, 2, tzinfo=UTC))
    assert first.watermark_committed and first.rows["reports"] > 0
    tables = sorted(current(spark, out))
    assert len(tables) == 12
    before = {t: read_published(spark, out, t).collect() for t in tables}
    state = INC.read_state(spark, f"{out}/state/commits").collect()
    with pytest.raises(QualityGateError, match="max_percent_viewed") as refused:
        process_bronze(spark, bad, out, media, as_of=dt.datetime(2026, 5, 11, 2, tzinfo=UTC))
    assert refused.value.report.failed_checks == 3 and len(refused.value.report.check_lines) == 27
    assert {t: read_published(spark, out, t).collect() for t in tables} == before
    assert INC.read_state(spark, f"{out}/state/commits").collect() == state
    waived = [line.split()[1] for line in refused.value.report.check_lines if line.startswith("[FAIL]")]
    process_bronze(spark, bad, out, media, as_of=dt.datetime(2026, 5, 11, 3, tzinfo=UTC), waived=waived)
    assert read_published(spark, out, "gold/fact_media_engagement").first()["watched_percent"] == 1.5
    kept = len(os.listdir(f"{out}/gold/dim_media"))
    gone = publish.prune(spark, out, INC.read_state(spark, f"{out}/state/commits"), dt.datetime(2100, 1, 1, tzinfo=UTC))
    assert kept == 3 and len([g for g in gone if g.startswith("gold/dim_media/")]) == 2
    assert read_published(spark, out, "gold/dim_media").count() == 1


def test_a_refused_incremental_run_is_made_good_by_the_next(spark, sf_small):
    """Days that the refused run's merge touched are recomputed by the next run, though its window has passed them."""
    root = new_run_dir(spark, "test-gate")
    fact = lambda: sorted(map(tuple, read_published(spark, root, "gold/fact_media_engagement").drop("gold_loaded_at").collect()),
                          key=str)
    run_incremental(spark, sf_small, root, dt.datetime(2024, 1, 12, 2, tzinfo=UTC), initial_start_date="2024-01-10")
    before, commits = fact(), INC.read_state(spark, f"{root}/state/commits").count()
    with pytest.raises(QualityGateError):
        run_incremental(spark, sf_small, root, dt.datetime(2024, 1, 16, 2, tzinfo=UTC), waived=())
    assert fact() == before and INC.read_state(spark, f"{root}/state/commits").count() == commits
    # an event leaves a published day in a merge whose run is never committed
    silver = f"{root}/silver/events"
    table = spark.read.parquet(silver)
    moved = (table.filter("visitor_key IS NOT NULL AND event_date = DATE'2024-01-10'").limit(1)
             .withColumn("event_date", F.lit(dt.date(2024, 1, 11))).withColumn("ingested_at", F.lit(dt.datetime(2030, 1, 1)))
             .select(*table.columns).checkpoint(eager=True))
    INC.upsert_latest(spark, moved, silver, ["event_key"], "ingested_at", ["event_date"], before_replacing=lambda t: t.toDF(
        "date").write.parquet(f"{root}/state/touched/run_id=lost/dataset=events"))
    run_incremental(spark, sf_small, root, dt.datetime(2024, 1, 17, 2, tzinfo=UTC))
    plays = {r["date"]: r["n"] for r in read_published(spark, root, "gold/fact_media_engagement").groupBy("date")
             .agg(F.sum("play_count").alias("n")).collect()}
    held = {r["event_date"]: r["n"] for r in spark.read.parquet(silver).filter("visitor_key IS NOT NULL").groupBy("event_date")
            .agg(F.count("*").alias("n")).collect()}
    assert plays == held and {dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 14)} <= set(plays)


def test_parts_replace_days_and_emptied_days_vanish(spark, tmp_path):
    root, s = str(tmp_path), "date date, v int"
    d = [dt.date(2024, 1, i) for i in range(1, 5)]
    whole, _ = publish.stage(spark.createDataFrame([(d[0], 1), (d[1], 2), (None, 3)], s), root, "t", "a", "date")
    part, _ = publish.stage(spark.createDataFrame([(d[1], 20), (d[2], 30)], s), root, "t", "b", "date")
    read = lambda e: sorted(((str(r.date), r.v) for r in publish.open_table(spark, root, {"t": e}, "t").collect()))
    second = publish.replacing(whole, part, [d[0], d[1], d[2]])
    assert read(second) == [("2024-01-02", 20), ("2024-01-03", 30), ("None", 3)]
    third = publish.replacing(second, publish.stage(spark.createDataFrame([(None, 9)], s), root, "t", "c", "date")[0], [None, d[2]])
    assert read(third) == [("2024-01-02", 20), ("None", 9)]
    assert read(whole) == [("2024-01-01", 1), ("2024-01-02", 2), ("None", 3)]
    assert publish.from_text(publish.to_text({"t": third})) == {"t": third}
    assert publish.replacing(None, part, d) == part
    plan = publish.open_table(spark, root, {"t": third}, "t").filter(F.col("date") == d[1])._jdf.queryExecution().executedPlan().toString()
    assert "version" in plan[plan.index("PartitionFilters"):]


def window(day):
    return INC.resolve_window(as_of=dt.datetime(2026, 5, day, 2, tzinfo=UTC))


def test_one_of_two_concurrent_commits_wins(spark, tmp_path):
    now = dt.datetime(2026, 5, 10, 3, tzinfo=UTC)
    for round_ in range(3):
        path = str(tmp_path / f"s{round_}")
        rows = [INC.state_row(spark, window(10), f"r{i}", now, "shared", 1, 1, published=f"p{i}") for i in range(4)]
        with ThreadPoolExecutor(4) as pool:
            won = list(pool.map(lambda r: INC.commit(spark, path, r), rows))
        assert won.count(True) == 1
        seq, _, published = INC.head(INC.read_state(spark, path))
        assert (seq, published) == (1, f"p{won.index(True)}")
        assert [n for n in os.listdir(path) if n.startswith("_")] == []


def test_a_run_that_built_on_an_older_commit_is_refused(spark, tmp_path):
    path, now = str(tmp_path / "s"), dt.datetime(2026, 5, 10, 3, tzinfo=UTC)
    assert INC.commit(spark, path, INC.state_row(spark, window(10), "a", now, "shared", 1, 1), expected_seq=0)
    with pytest.raises(INC.CommitConflict):
        INC.commit(spark, path, INC.state_row(spark, window(11), "b", now, "shared", 1, 1), expected_seq=0)
    assert INC.commit(spark, path, INC.state_row(spark, window(11), "b", now, "shared", 1, 1), expected_seq=1)
    state = INC.read_state(spark, path)
    assert INC.current_watermark(state) == window(11).next_watermark and state.count() == 2
    assert INC.current_watermark(state, dt.datetime(2026, 5, 10, 12)) == window(10).next_watermark


def test_create_if_absent_has_one_winner(spark, tmp_path):
    path = str(tmp_path / "x" / "f.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: create_if_absent(spark, path, f"text {i}"), range(8)))
    assert won.count(True) == 1
    assert open(path).read() == f"text {won.index(True)}"


KEYED = "k string, d date, v int, ts int"


def days(n):
    return [dt.date(2026, 1, 1) + dt.timedelta(i) for i in range(n)]


def test_upsert_reads_only_touched_partitions_and_its_keys_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    d = days(6)
    INC.upsert_latest(spark, spark.createDataFrame([(f"k{i}", d[i % 6], i, 1) for i in range(60)], KEYED), path, ["k"], "ts", ["d"], buckets=8)
    assert {n.split("=")[0] for n in os.listdir(f"{path}.keys/of=8")} >= {"_bucket"}
    for day in (d[3], d[4]):                                  # unreadable: any scan of these partitions fails
        for name in os.listdir(f"{path}/d={day}"):
            if name.endswith(".parquet"):
                with open(f"{path}/d={day}/{name}", "wb") as out:
                    out.write(b"not parquet")
                if os.path.exists(f"{path}/d={day}/.{name}.crc"):
                    os.remove(f"{path}/d={day}/.{name}.crc")
    new = spark.createDataFrame([("k0", d[1], 100, 2), ("k2", d[2], 102, 2), ("new", None, 1, 2)], KEYED)
    touched = INC.upsert_latest(spark, new, path, ["k"], "ts", ["d"])
    assert {r.d for r in touched.collect()} == {d[0], d[1], d[2], None}
    rows = {r.k: (r.d, r.v) for r in INC.in_partitions(spark.read.schema(KEYED).parquet(path), touched, ["d"]).collect()}
    assert rows["k0"] == (d[1], 100) and rows["k2"] == (d[2], 102) and rows["new"] == (None, 1) and len(rows) == 31


@pytest.mark.parametrize("broadcast,hashed", [("10m", 4_000_000), ("-1", 4_000_000), ("-1", 0)])
def test_merge_keeps_no_copy_of_its_rows_and_reads_its_index_once(spark, tmp_path, monkeypatch, broadcast, hashed):
    """The same by each way to look keys up: broadcast, hashed in the tasks of a shuffle, sorted."""
    path = str(tmp_path / "t")
    d = days(4)
    cap = "spark.sql.autoBroadcastJoinThreshold"
    monkeypatch.setattr(INC, "PLACES_TO_HASH", hashed, raising=False)
    first = spark.createDataFrame([*[(f"k{i}", d[i % 3], i, 1) for i in range(12)], (None, d[0], 50, 1)], KEYED)
    kept, real = [], type(first).checkpoint
    monkeypatch.setattr(type(first), "checkpoint", lambda self, eager=True: kept.append(self) or real(self, eager))
    before = spark.conf.get(cap)
    spark.conf.set(cap, broadcast)
    try:
        INC.upsert_latest(spark, first, path, ["k"], "ts", ["d"])
        new = [("k0", d[3], 100, 2), ("k1", d[1], 101, 2), ("k2", d[2], 102, 0), ("n", None, 7, 1), (None, d[3], 51, 2)]
        touched = INC.upsert_latest(spark, spark.createDataFrame(new, KEYED), path, ["k"], "ts", ["d"])
    finally:
        spark.conf.set(cap, before)
    assert not [frame.columns for frame in kept if "v" in frame.columns]
    scans = [frame._jdf.queryExecution().optimizedPlan().toString().count("parquet") for frame in kept]
    assert max(scans) == 1 and sum(scans) == 1
    assert {r.d for r in touched.collect()} == {*d, None}
    rows = {r.k: (r.d, r.v) for r in spark.read.schema(KEYED).parquet(path).collect()}
    assert rows == {**{f"k{i}": (d[i % 3], i) for i in range(2, 12)}, "k0": (d[3], 100), "k1": (d[1], 101), "n": (None, 7), None: (d[3], 51)}
    places = sorted(map(tuple, spark.read.parquet(f"{path}.keys").select("k", "d").collect()), key=str)
    assert places == sorted([*[(f"k{i}", d[i % 3]) for i in range(12)], (None, d[0]), ("k0", d[3]), ("n", None), (None, d[3])], key=str)


def test_key_index_is_built_for_an_older_table_and_rebuilt(spark, tmp_path):
    path = str(tmp_path / "t")
    d = days(3)
    spark.createDataFrame([("a", d[0], 1, 1), ("b", d[1], 1, 1), ("n", None, 1, 1)], KEYED).write.partitionBy("d").parquet(path)
    one = spark.createDataFrame([("a", d[2], 2, 2), ("n", d[2], 2, 2)], KEYED)
    assert {r.d for r in INC.upsert_latest(spark, one, path, ["k"], "ts", ["d"], buckets=4).collect()} == {d[0], d[2], None}
    again = INC.upsert_latest(spark, spark.createDataFrame([("a", d[2], 3, 3)], KEYED), path, ["k"], "ts", ["d"])
    assert {r.d for r in again.collect()} == {d[0], d[2]}                 # the index still names the place a left
    INC.rebuild_key_index(spark, path, ["k"], ["d"], spark.createDataFrame([], KEYED).schema, buckets=2)
    again = INC.upsert_latest(spark, spark.createDataFrame([("a", d[2], 4, 4)], KEYED), path, ["k"], "ts", ["d"])
    assert {r.d for r in again.collect()} == {d[2]}
    assert {(r.k, r.d, r.v) for r in spark.read.schema(KEYED).parquet(path).collect()} == {("a", d[2], 4), ("b", d[1], 1), ("n", d[2], 2)}
