"""latest_by / dedup, incremental window and watermark, JSON operators, privacy."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from engagelake.operators import json_ops as J
from engagelake.operators.latest import dedup_keep_one, latest_by
from engagelake.operators.privacy import drop_sensitive, is_sensitive_name
from engagelake.plans import incremental as INC

ROWS = [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "w"), (None, 2, "n1"), (None, 5, "n2"),
        ("c", 7, "p"), ("c", 7, "q")]


def test_latest_by_rules(spark):
    df = spark.createDataFrame(ROWS, "k string, t int, v string")
    out = {r["k"]: r["v"] for r in latest_by(df, ["k"], "t").collect()}
    assert out == {"a": "y", "b": "w", None: "n2", "c": "q"}   # nulls lose, null keys one group, tie -> larger v


def test_latest_by_idempotent_and_order_independent(spark):
    df = spark.createDataFrame(ROWS, "k string, t int, v string")
    once = sorted(latest_by(df, ["k"], "t").collect(), key=str)
    twice = sorted(latest_by(latest_by(df, ["k"], "t"), ["k"], "t").collect(), key=str)
    shuffled = sorted(latest_by(df.repartition(3).orderBy(F.rand(7)), ["k"], "t").collect(), key=str)
    assert once == twice == shuffled


def test_latest_by_plans_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    plan = latest_by(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dedup_keep_one_is_deterministic(spark):
    df = spark.createDataFrame(ROWS, "k string, t int, v string")
    a = sorted(dedup_keep_one(df, ["k"]).collect(), key=str)
    b = sorted(dedup_keep_one(df.repartition(4), ["k"]).collect(), key=str)
    assert a == b and len(a) == 4


def test_window_resolution():
    as_of = dt.datetime(2026, 5, 11, 3, 0, tzinfo=dt.timezone.utc)
    with pytest.raises(ValueError):
        INC.resolve_window(as_of=as_of, explicit_start="2026-05-01")
    w = INC.resolve_window(as_of=as_of, previous_watermark="2026-05-10T02:00:00Z", lookback_days=1)
    assert w.start_date == dt.date(2026, 5, 9) and w.end_date == dt.date(2026, 5, 11)
    d = INC.resolve_window(as_of=as_of, disable_watermark=True)
    assert (d.start_date, d.end_date, d.should_update_watermark) == (dt.date(2026, 5, 10), dt.date(2026, 5, 11), False)
    b = INC.resolve_window(as_of=as_of, initial_start_date="2026-05-01")
    assert b.start_date == dt.date(2026, 5, 1)
    e = INC.resolve_window(as_of=as_of, explicit_start="2026-05-01", explicit_end="2026-05-02")
    assert e.origin == "explicit" and not e.should_update_watermark
    assert INC.parse_watermark("2026-05-10T02:00:00") == INC.parse_watermark("2026-05-10T02:00:00+00:00")


def test_watermark_commit_is_monotone(spark, tmp_path):
    path = str(tmp_path / "state")
    w1 = INC.resolve_window(as_of=dt.datetime(2026, 5, 10, 2, tzinfo=dt.timezone.utc))
    w0 = INC.resolve_window(as_of=dt.datetime(2026, 5, 9, 2, tzinfo=dt.timezone.utc))
    now = dt.datetime(2026, 5, 10, 3, tzinfo=dt.timezone.utc)
    assert INC.commit(spark, path, INC.state_row(spark, w1, "r1", now, "local", 3, 2))
    assert not INC.commit(spark, path, INC.state_row(spark, w1, "r1b", now, "local", 3, 2))   # equal
    assert not INC.commit(spark, path, INC.state_row(spark, w0, "r0", now, "local", 3, 2))    # older
    assert INC.current_watermark(INC.read_state(spark, path)) == w1.next_watermark


def test_upsert_latest_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    s = "k string, d date, v int, ts int"
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    INC.upsert_latest(spark, spark.createDataFrame([("a", d1, 1, 1), ("b", d2, 1, 1)], s), path, ["k"], "ts", ["d"])
    INC.upsert_latest(spark, spark.createDataFrame([("a", d1, 2, 2), ("c", d1, 1, 2)], s), path, ["k"], "ts", ["d"])
    INC.upsert_latest(spark, spark.createDataFrame([("a", d1, 0, 0)], s), path, ["k"], "ts", ["d"])  # stale replay
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {"a": 2, "b": 1, "c": 1}


def test_upsert_latest_keeps_undated_rows_and_moves_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    s = "k string, d date, v int, ts int"
    d1, d2, d3 = (dt.date(2026, 1, i) for i in (1, 2, 3))

    def upsert(*rows):
        touched = INC.upsert_latest(spark, spark.createDataFrame(list(rows), s), path, ["k"], "ts", ["d"])
        table = spark.read.schema(s).parquet(path)
        return {r["d"] for r in touched.collect()}, sorted((r["k"], str(r["d"]), r["v"]) for r in table.collect())

    upsert(("a", d1, 1, 1), ("b", None, 1, 1), ("c", d2, 1, 1), ("e", d3, 1, 1))
    # an undated newcomer keeps the undated row; the only row of d1 moves to d2
    days, rows = upsert(("f", None, 2, 2), ("a", d2, 2, 2))
    assert days == {None, d1, d2}
    assert rows == [("a", "2026-01-02", 2), ("b", "None", 1), ("c", "2026-01-02", 1), ("e", "2026-01-03", 1), ("f", "None", 2)]
    assert not (tmp_path / "t" / "d=2026-01-01").exists()
    # the undated row gets its day; an older version of a moved key changes nothing
    days, rows = upsert(("b", d1, 3, 3), ("a", d3, 0, 0))
    assert rows == [("a", "2026-01-02", 2), ("b", "2026-01-01", 3), ("c", "2026-01-02", 1), ("e", "2026-01-03", 1), ("f", "None", 2)]


def test_touched_partitions_are_literal_partition_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    s = "k string, d date"
    days = [dt.date(2026, 1, i) for i in range(1, 6)]
    spark.createDataFrame([("a", d) for d in [*days, None]], s).write.partitionBy("d").parquet(path)
    table = spark.read.schema(s).parquet(path)
    some = INC.in_partitions(table, spark.createDataFrame([(days[1],), (None,)], "d date"), ["d"])
    assert {r["d"] for r in some.collect()} == {days[1], None}
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "isnull(d" in filters and filters.count("isnotnull(d") == 0
    assert "Join" not in plan


DOCS = [
    (1, {"a": {"visitor_key": "x", "b": [{"visitorKey": "y"}, {"visitor_key": 5}]}, "visitor_key": ["z"]}),
    (2, [1, 2, {"deep": {"deeper": {"visitor_key": "q", "inner": {"visitor_key": "r"}}}}]),
    (4, {"visitor_key": {"visitor_key": "below", "visitorKey": ["not", "strings"]}}),   # walk below a match
    (3, "not json {"),
]


def test_harvest_any_depth_strings_only(spark):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in DOCS], "id long, j string")
    got = {r["v"] for r in J.harvest(df, ["id"], "j", ["visitor_key", "visitorKey"], "v").collect()}
    assert got == {"x", "y", "q", "r", "below"}


def test_extract_records_shapes(spark):
    docs = [("a", "[1, 2]"), ("b", '{"events": [1]}'), ("c", '{"data": "s", "items": [1, 2, 3]}'),
            ("d", '{"results": 5}'), ("e", '"text"')]
    df = J.extract_records(spark.createDataFrame(docs, "id string, j string"), "j")
    got = {r["id"]: r["n"] for r in df.select("id", F.size("records").alias("n")).collect()}
    assert got == {"a": 2, "b": 1, "c": 3, "d": 0, "e": 0}


def test_shape_redacts_sensitive_subtrees(spark):
    doc = json.dumps({"ip": {"v4": "1.2.3.4"}, "name": "n", "items": [{"k": 1}, {"k": 2.5}], "email": None})
    rows = {(r["path"], r["json_type"]): r for r in J.shape(spark.createDataFrame([(doc,)], "j string"), "j").collect()}
    assert rows[("$.ip", "object")]["redacted"] and ("$.ip.v4", "string") not in rows
    assert rows[("$.items", "array")]["max_length"] == 2
    assert ("$.items[].k", "int") in rows and ("$.items[].k", "float") in rows
    assert rows[("$.email", "null")]["redacted"]


def test_shape_walks_structures_not_documents(spark):
    texts = [f'{{"n": {i}, "STRING": "t{i}", "o": {{"email": "x", "e": {{}}, "f": {i}.25, "b": true, "z": null}}}}' for i in range(200)]
    odd = ['{"a b": 1, "OBJECT<": {"c: STRING, d": "x"}}', '[{"n": 1}, {"n": "x"}, []]', "3", '"x"', "null", "{", "12345678901234567890",
           '{"ARRAY": {"o": [1, 2]}}', '{"ARRAY": {"o": 1}}', '{"ARRAY": {"o": 1}}']
    docs = spark.createDataFrame([(t,) for t in texts + odd], "j string")
    assert J._samples(docs.limit(200), "j").count() < 10                  # one per precision of a number
    nodes = J.walk(docs.withColumn("one", F.lit(1)), ["one"], "j", descend_sensitive=False)
    walked = nodes.groupBy("path", J.json_type(F.col("node")).alias("t")).agg(F.sum("one").alias("n")).collect()
    got = {(r["path"], r["json_type"]): r for r in J.shape(docs, "j").collect()}
    assert {(*k, r["n_nodes"]) for k, r in got.items()} == {tuple(r) for r in walked}
    assert (got["$", "array"]["min_length"], got["$.ARRAY.o", "array"]["max_length"]) == (3, 2)
    assert got["$.o.email", "string"]["redacted"] and got["$.o.f", "float"]["n_nodes"] == 200


def test_drop_sensitive(spark):
    assert is_sensitive_name("Description") and not is_sensitive_name("title")
    df = spark.createDataFrame([("k", "1.1.1.1", ("b", "t"))], "event_key string, ip string, "
                               "agent struct<browser:string, api_key:string>")
    out = drop_sensitive(df)
    assert out.columns == ["event_key", "agent"] and out.schema["agent"].dataType.fieldNames() == ["browser"]


def test_size_check_uses_plan_statistics_and_bounds(spark, sf_small):
    from engagelake.operators.broadcast import estimated_bytes, sized_broadcast
    from engagelake.sources import testdata as T
    cust = T.table(spark, sf_small, "customer")
    assert estimated_bytes(cust) > 0
    places = T.visitor_places(spark, sf_small)
    assert estimated_bytes(places) > 10 * 1024 * 1024        # a join chain is estimated as a product

    def hints(df):
        return df._jdf.queryExecution().analyzed().toString().count("ResolvedHint")

    assert sized_broadcast(places) is places                  # unbounded estimate: no hint
    assert hints(sized_broadcast(places, bound=cust)) == hints(places) + 1
    assert sized_broadcast(cust, cap_bytes=1) is cust


def test_distinct_count_matches_count_distinct_on_skewed_groups(spark):
    from engagelake.operators.aggregate import distinct_count, null_safe_join
    hot = [("hot", i % 500) for i in range(5000)]                     # one group holds most rows
    cold = [(f"g{i}", i % 3) for i in range(300)] + [("nulls", None), (None, 1), (None, 2)]
    df = spark.createDataFrame(hot + cold, "k string, x int")
    a = {r["k"]: r["n"] for r in distinct_count(df, ["k"], "x", "n").collect()}
    b = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count_distinct("x").alias("n")).collect() if r["n"]}
    assert a == b and a["hot"] == 500 and a[None] == 2 and "nulls" not in a
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("b", 20)], "k string, w int")
    got = {(r["k"], r["w"]) for r in null_safe_join(left, right, ["k"]).collect()}
    assert got == {(None, 10), ("a", None)}


def test_incremental_rerun_changes_nothing(spark, sf_small):
    from engagelake.plans.workflow import read_published, run_incremental
    from engagelake.session import new_run_dir
    root = new_run_dir(spark, "test-rerun")
    as_of = dt.datetime(2024, 1, 20, 2, tzinfo=dt.timezone.utc)
    first = run_incremental(spark, sf_small, root, as_of, initial_start_date="2024-01-15")
    audit = ["gold_loaded_at", "pipeline_run_id", "source_file", "ingested_at", "ingest_date"]  # provenance only
    table = lambda t: spark.read.parquet(f"{root}/{t}") if t.startswith("silver") else read_published(spark, root, t)
    snap = lambda t: sorted(map(tuple, table(t).drop(*audit).collect()), key=str)
    before = {t: snap(t) for t in ("silver/events", "gold/fact_media_engagement", "gold/dim_visitor")}
    again = run_incremental(spark, sf_small, root, as_of, initial_start_date="2024-01-15")
    after = {t: snap(t) for t in before}
    assert first.watermark_committed and not again.watermark_committed      # same clock: state unchanged
    assert before == after                                                   # overlap removed: nothing changes


def test_merged_schema_fits_all_documents(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": [1]}',), ('{"a": 2.5, "c": "x"}',)], "j string")
    schema = J.merged_schema(docs, "j").first()["merged_schema"]
    assert schema.startswith("OBJECT<") and "a:" in schema and "b: ARRAY" in schema and "c: STRING" in schema


def test_latest_and_dedup_carry_unorderable_columns(spark):
    df = spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 2, {"x": "2"}), ("b", 1, {"y": "3"})],
                               "k string, t int, m map<string,string>")
    latest = {r["k"]: r["m"] for r in latest_by(df, ["k"], "t").collect()}
    assert latest == {"a": {"x": "2"}, "b": {"y": "3"}}
    kept = {r["k"]: r["m"] for r in dedup_keep_one(df, ["k"]).collect()}
    assert kept == {"a": {"x": "1"}, "b": {"y": "3"}}


def test_compact_latest_keeps_newest_row_per_key(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    s = "media_id string, channel string, ingested_at int, ingest_date string"
    rows = [("m1", "A", 1, "d1"), ("m1", "B", 2, "d2"), ("m2", "A", 1, "d1")]
    spark.createDataFrame(rows, s).write.partitionBy("ingest_date").parquet(path)
    assert INC.compact_latest(spark, path, ["media_id"], "ingested_at", ["ingest_date"]) == 2
    got = {r["media_id"]: r["channel"] for r in spark.read.parquet(path).collect()}
    assert got == {"m1": "B", "m2": "A"}


def test_daily_run_commits_watermark_only_forward(spark, sf_small):
    from engagelake.plans.workflow import run_daily
    from engagelake.session import new_run_dir
    root = new_run_dir(spark, "test-daily")
    utc = dt.timezone.utc
    first = run_daily(spark, sf_small, root, with_reports=False, as_of=dt.datetime(2024, 2, 1, 2, tzinfo=utc))
    assert first.watermark_committed and first.window.based_on is None
    second = run_daily(spark, sf_small, root, with_reports=False, as_of=dt.datetime(2024, 2, 2, 2, tzinfo=utc))
    assert second.watermark_committed and second.window.start_date == dt.date(2024, 1, 31)
    older = run_daily(spark, sf_small, root, with_reports=False, as_of=dt.datetime(2024, 2, 1, 3, tzinfo=utc))
    assert not older.watermark_committed
    assert len(first.check_lines) == 27 and first.rows["gold.fact_media_engagement"] > 0


def test_harvest_screen_keeps_escaped_names(spark):
    docs = [(1, '{"other": {"x": "no"}}'), (2, '{"visitor\\u005fkey": "escaped"}'), (3, '{"a": [{"visitorKey": "k"}]}')]
    df = spark.createDataFrame(docs, "id long, j string")
    got = {r["v"] for r in J.harvest(df, ["id"], "j", ["visitor_key", "visitorKey"], "v").collect()}
    assert got == {"escaped", "k"}


def test_pages_do_not_depend_on_partitions_and_have_no_gaps(spark):
    from engagelake.sources import bronze
    rows = [(g, f"k{i}", i) for g, n in (("a", 2050), ("b", 100), (None, 7), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, k string, v int")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "4", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append({(r.g, r.k): r.page for r in bronze.page_records(df.repartition(int(n)), ["g"], "k", 100).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
    sizes = {}
    for (g, _), page in seen[0].items():
        sizes.setdefault(g, {}).setdefault(page, 0)
        sizes[g][page] += 1
    assert sizes == {"a": {p: 100 if p < 21 else 50 for p in range(1, 22)}, "b": {1: 100}, None: {1: 7}, "c": {1: 1}}


def test_numbers_are_the_same_for_any_number_of_ranges(spark):
    from engagelake.operators.aggregate import numbered
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("k"))
    got = [{(r.g, r.k): r.n for r in numbered(df, ["g"], "k", "n", bits).collect()} for bits in (1, 5, 12)]
    assert got[0] == got[1] == got[2] and sorted(n for (g, _), n in got[0].items() if g == 0) == list(range(1, 168))


def test_harvest_repeated_members_escapes_and_text_that_looks_like_members(spark):
    docs = [(1, '{"visitor_key": "first", "visitor_key": "last"}'), (2, '{"t": "{\\"visitor_key\\":\\"inside a string\\"}"}'),
            (3, '{"a": {"visitor_key": "q\\"uote \\\\ \\u00e9 \\n"}}'), (4, '{"x\\"visitor_key": "other name"}'),
            (5, '[[[{"visitor_key" : "deep"}]]]'), (6, '{"visitor_key": ""}'), (7, '{"visitor_key": null, "k": ["visitor_key", "v"]}')]
    df = spark.createDataFrame(docs, "id long, j string")
    got = {r["v"] for r in J.harvest(df, ["id"], "j", ["visitor_key"], "v").collect()}
    assert got == {"last", 'q"uote \\ é \n', "deep", ""}


def test_watch_seconds_are_exact_and_nulls_stay_null(spark):
    from engagelake.plans import gold
    ev = spark.createDataFrame([(f"e{i}", "v", "m", dt.date(2024, 1, 1), p) for i, p in enumerate([0.1, 0.2, 0.3, None] * 50)]
                               + [("n", "w", "m", dt.date(2024, 1, 1), None), ("o", "v", "unknown", dt.date(2024, 1, 1), 0.5)],
                               "event_key string, visitor_key string, media_id string, event_date date, percent_viewed double")
    media = spark.createDataFrame([("m", 33.35)], "media_id string, duration_seconds double")
    rows = {(r.media_id, r.visitor_key): r for r in gold.visitor_daily(ev, media, hash_ids=False).collect()}
    assert rows["m", "v"].total_watch_time_seconds == 1000.5 and rows["m", "v"].watched_percent == 30.0 / 150
    assert rows["m", "w"].watched_percent is None and rows["m", "w"].total_watch_time_seconds is None
    assert rows["unknown", "v"].total_watch_time_seconds is None and rows["unknown", "v"].watched_percent == 0.5


def test_channel_summary_reads_its_input_once(spark, sf_small):
    from engagelake import registry
    plan = registry.rpt_channel_summary(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    one = registry.fact_frame(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    two = registry.dim_media_frame(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_id#") > 0 and plan.count("Relation [") <= one.count("Relation [") + two.count("Relation [")


def test_registering_again_moves_the_views_and_the_projection_follows_the_clock(spark, tmp_path):
    from engagelake.plans import catalog, publish
    from engagelake.plans.workflow import FACT, fact_schema
    root, today = str(tmp_path), spark.sql("SELECT current_date()").first()[0]

    def fact(*rows):
        return spark.createDataFrame([(m, "v", 1, None, None, None, None, None, None, None, None, d) for m, d in rows], fact_schema())
    one, _ = publish.stage(fact(("m1", today), ("m1", today + dt.timedelta(1)), ("m2", today), ("m1", dt.date(2020, 1, 1))), root, FACT, "a", "date")
    names = catalog.register_gold_tables(spark, root, {FACT: one}, "test_lake")
    catalog.register_media(spark, spark.createDataFrame([("m1", "c")], "media_id string, channel string"), f"{root}/cfg", "test_lake")
    view = catalog.projection_view(spark, dt.date(2021, 1, 1), "test_lake")
    read = lambda name: sorted((r.media_id, r.date) for r in spark.table(name).collect())
    assert names == {"fact_media_engagement": "test_lake.fact_media_engagement"} and len(read("test_lake.fact_media_engagement")) == 4
    assert read(view) == [("m1", today)]
    two = publish.replacing(one, publish.stage(fact(("m1", today), ("m1", today)), root, FACT, "b", "date")[0], [today])
    assert catalog.register_gold_tables(spark, root, {FACT: two}, "test_lake") == names
    assert read(view) == [("m1", today), ("m1", today)]
