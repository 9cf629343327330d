"""Catalog tables over published gold, and the projected fact view.

``register_gold_tables`` declares, under fixed names in a database, an external
table with explicit column types over each gold table's folder (partitioned by
version, the fact by date as well) and a view of the current rows on top.
Registering again after a commit replaces the views, one statement each; the tables
stay.  ``projection_view`` is the partition-projection idea as a SQL view that
reports can name: only dates from a first day to the day on which it is read, and
media in the configured list, are visible -- the date predicate becomes a
partition filter and the list a semi join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engagelake.plans import publish

DIM_MEDIA_DDL = """media_id STRING, numeric_id BIGINT, title STRING, description STRING, channel STRING,
  duration_seconds DOUBLE, media_type STRING, status STRING, archived BOOLEAN, created_at TIMESTAMP,
  updated_at TIMESTAMP, gold_loaded_at TIMESTAMP"""
DIM_VISITOR_DDL = """visitor_id STRING, country STRING, region STRING, city STRING, browser STRING,
  browser_version STRING, platform STRING, mobile BOOLEAN, first_seen_at TIMESTAMP, last_seen_at TIMESTAMP,
  event_count BIGINT, distinct_media_count BIGINT, avg_percent_viewed DOUBLE, max_percent_viewed DOUBLE,
  gold_loaded_at TIMESTAMP"""
FACT_DDL = """media_id STRING, visitor_id STRING, play_count BIGINT, play_rate DOUBLE, total_watch_time_seconds DOUBLE,
  total_watch_time_hours DOUBLE, watched_percent DOUBLE, media_load_count BIGINT, media_play_count BIGINT,
  media_hours_watched DOUBLE, gold_loaded_at TIMESTAMP, date DATE"""
GOLD_TABLES = {"dim_media": (DIM_MEDIA_DDL, []), "dim_visitor": (DIM_VISITOR_DDL, []),
               "fact_media_engagement": (FACT_DDL, ["date"])}
FACT = "fact_media_engagement"


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def create_external_table(spark: SparkSession, name: str, columns_ddl: str, location: str,
                          partitioned_by: Sequence[str] = ()) -> str:
    """Declare an external table, or discover the new partitions of one that is there (elsewhere: declared anew)."""
    there = _location(spark, name)
    if there is not None and there.split(":", 1)[-1].rstrip("/") != location.split(":", 1)[-1].rstrip("/"):
        spark.sql(f"DROP TABLE {name}")                        # the table is external: its files stay
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING parquet{part} LOCATION '{location}'")
    if partitioned_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def register_gold_tables(spark: SparkSession, root: str, manifest: publish.Manifest, database: str = "engagelake") -> dict[str, str]:
    """Tables ``<name>_versions`` and views ``<name>`` of the gold tables in ``manifest``; returns the views' names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = {}
    for name, (ddl, by) in GOLD_TABLES.items():
        entry = manifest.get(f"gold/{name}")
        if entry is None:
            continue
        table = create_external_table(spark, f"{database}.{name}_versions", f"{ddl}, {publish.VERSION} STRING",
                                      f"{root.rstrip('/')}/gold/{name}", [publish.VERSION, *by])
        columns = ", ".join(c.split()[0] for c in ddl.replace("\n", " ").split(", "))
        names[name] = f"{database}.{name}"
        spark.sql(f"CREATE OR REPLACE VIEW {names[name]} AS SELECT {columns} FROM {table} WHERE {publish.current_rows(entry)}")
    return names


def register_media(spark: SparkSession, media_config: DataFrame, location: str, database: str = "engagelake") -> str:
    """The configured ``(media_id, channel)`` list as a table that SQL can name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    media_config.select("media_id", "channel").write.mode("overwrite").parquet(location)
    return create_external_table(spark, f"{database}.media_config", "media_id STRING, channel STRING", location)


def projection_view(spark: SparkSession, first_date: dt.date, database: str = "engagelake",
                    name: str = f"{FACT}_projected") -> str:
    """View of the fact from ``first_date`` to the day of reading, for configured media."""
    view = f"{database}.{name}"
    spark.sql(f"""CREATE OR REPLACE VIEW {view} AS SELECT * FROM {database}.{FACT}
        WHERE date BETWEEN DATE '{first_date}' AND current_date()
          AND media_id IN (SELECT media_id FROM {database}.media_config)""")
    return view


def projected_fact(fact: DataFrame, first_date: dt.date, media_ids: DataFrame | Sequence[str],
                   today: dt.date) -> DataFrame:
    """Fact rows visible under the projection: ``date`` in
    ``[first_date, today]`` and ``media_id`` in the configured set."""
    f = fact.filter(F.col("date").between(F.lit(first_date), F.lit(today)))
    if isinstance(media_ids, DataFrame):
        return f.join(media_ids.select("media_id").distinct(), "media_id", "left_semi")
    return f.filter(F.col("media_id").isin(*media_ids))
