"""The 27 gold-layer checks, grouped per table, and the gate.

Per table: one aggregate pass for all metric rules, one grouped aggregate
for key uniqueness, one anti join per foreign key.  The expected media
count (a scalar subquery) and the allowed channels (an anti join) come
from the configured media list, so no value is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagelake.operators import quality as q


def check_dim_media(dim_media: DataFrame, media_config: DataFrame,
                    channels: Sequence[str] | None = None) -> DataFrame:
    """``media_config`` is the configured ``(media_id, channel)`` list: its
    size is the expected row count and its channels the allowed values
    (``channels`` overrides them with a fixed list)."""
    expected = media_config.select(F.count(F.lit(1))).scalar()
    metrics = q.evaluate(dim_media, [
        q.row_count_rule("dim_media.row_count", expected),
        q.null_rule("dim_media.media_id.not_null", "media_id"),
        q.null_rule("dim_media.title.not_null", "title"),
        q.null_rule("dim_media.channel.not_null", "channel"),
    ], seq0=0)
    unique = q.unique_check("dim_media.media_id.unique", dim_media, ["media_id"], 4)
    if channels is not None:
        values = q.evaluate(dim_media, [
            q.allowed_values_rule("dim_media.channel.expected_values", "channel", channels)], seq0=5)
    else:
        values = q.allowed_values_check("dim_media.channel.expected_values", dim_media, "channel",
                                        media_config.select("channel"), 5)
    return q.union_all([metrics, unique, values])


def check_dim_visitor(dim_visitor: DataFrame) -> DataFrame:
    head = q.evaluate(dim_visitor, [
        q.row_count_rule("dim_visitor.row_count_positive"),
        q.null_rule("dim_visitor.visitor_id.not_null", "visitor_id"),
    ], seq0=100)
    unique = q.unique_check("dim_visitor.visitor_id.unique", dim_visitor, ["visitor_id"], 102)
    tail = q.evaluate(dim_visitor, [
        q.positive_rule("dim_visitor.event_count.positive", "event_count"),
        q.range_rule("dim_visitor.avg_percent_viewed.between_0_and_1", "avg_percent_viewed", 0, 1),
        q.range_rule("dim_visitor.max_percent_viewed.between_0_and_1", "max_percent_viewed", 0, 1),
    ], seq0=103)
    return q.union_all([head, unique, tail])


# --- fixed values: columns that must not be negative, and (below) the names of the checks ---
FACT_NON_NEGATIVE = ("play_count", "total_watch_time_seconds", "total_watch_time_hours",
                     "media_load_count", "media_play_count", "media_hours_watched")


_FACT = "fact_media_engagement"
FACT_GRAIN = ["media_id", "visitor_id", "date"]


def _fact_head_rules():
    return [q.row_count_rule(f"{_FACT}.row_count_positive"),
            q.null_rule(f"{_FACT}.media_id.not_null", "media_id"),
            q.null_rule(f"{_FACT}.visitor_id.not_null", "visitor_id"),
            q.null_rule(f"{_FACT}.date.not_null", "date")]


def _fact_value_rules():
    return [*[q.negative_rule(f"{_FACT}.{c}.non_negative", c) for c in FACT_NON_NEGATIVE],
            q.range_rule(f"{_FACT}.play_rate.between_0_and_1", "play_rate", 0, 1),
            q.range_rule(f"{_FACT}.watched_percent.between_0_and_1", "watched_percent", 0, 1)]


def _fact_references(fact: DataFrame, dim_media: DataFrame, dim_visitor: DataFrame) -> list[DataFrame]:
    t = _FACT
    media = q.exists_check(f"{t}.media_id.exists_in_dim_media", fact, dim_media, ["media_id"], 213,
                           "missing_media_count")
    visitor = q.exists_check(f"{t}.visitor_id.exists_in_dim_visitor", fact, dim_visitor, ["visitor_id"], 214,
                             "missing_visitor_count")
    return [media, visitor]


def check_fact(fact: DataFrame, dim_media: DataFrame, dim_visitor: DataFrame) -> DataFrame:
    head = q.evaluate(fact, _fact_head_rules(), seq0=200)
    unique = q.unique_check(f"{_FACT}.grain.unique", fact, FACT_GRAIN, 204)
    rest = q.evaluate(fact, _fact_value_rules(), seq0=205)
    return q.union_all([head, unique, rest, *_fact_references(fact, dim_media, dim_visitor)])


def fact_check_partials(fact: DataFrame) -> DataFrame:
    """Per-date counts of every fact metric rule plus the per-date number of
    duplicated grain keys (the grain contains the date, so duplicates never
    span dates).  Kept per partition, recomputed only for rewritten days."""
    rules = _fact_head_rules() + _fact_value_rules()
    metrics = q.metric_partials(fact, rules, ["date"])
    dups = (fact.groupBy(*FACT_GRAIN).agg(F.count(F.lit(1)).alias("_n"))
                .groupBy("date").agg(F.count_if(F.col("_n") > 1).cast("long").alias("_dups")))
    return metrics.join(dups, "date", "full")


def check_fact_from_partials(partials: DataFrame, fact: DataFrame, dim_media: DataFrame,
                             dim_visitor: DataFrame) -> DataFrame:
    """The fact's checks from summed per-date partials (same result rows as
    ``check_fact``); the reference checks still read the fact's keys."""
    head_rules, value_rules = _fact_head_rules(), _fact_value_rules()
    n_head = len(head_rules)
    head = q.evaluate_partials(partials.select(*[F.col(f"_m{i}") for i in range(n_head)]), head_rules, 200)
    rest = q.evaluate_partials(
        partials.select(*[F.col(f"_m{n_head + i}").alias(f"_m{i}") for i in range(len(value_rules))]),
        value_rules, 205)
    dups = partials.agg(F.coalesce(F.sum("_dups"), F.lit(0)).cast("long").alias("observed"))
    unique = dups.select(F.lit(204).alias("seq"), F.lit(f"{_FACT}.grain.unique").alias("check"),
                         (F.col("observed") == 0).alias("passed"), "observed",
                         F.concat(F.lit("duplicate_key_count="), F.col("observed").cast("string")).alias("details"))
    return q.union_all([head, unique, rest, *_fact_references(fact, dim_media, dim_visitor)])


def check_gold(fact: DataFrame, dim_media: DataFrame, dim_visitor: DataFrame,
               media_config: DataFrame, fact_partials: DataFrame | None = None) -> DataFrame:
    """All 27 results in the reference order (``seq``); with ``fact_partials``
    the fact's metric rules are summed from per-date partials."""
    fact_results = (check_fact(fact, dim_media, dim_visitor) if fact_partials is None
                    else check_fact_from_partials(fact_partials, fact, dim_media, dim_visitor))
    return q.union_all([check_dim_media(dim_media, media_config), check_dim_visitor(dim_visitor), fact_results])
