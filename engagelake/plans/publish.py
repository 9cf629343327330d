"""Audited publishing: tables are written as versions, checked, and made current by one commit.

A run writes each table (or the partitions it recomputed) below
``<root>/<table>/version=<run>``; nothing that readers see is overwritten.  The
manifest names, per table, the version that holds it whole and the versions that
replaced single partitions since.  It is part of the commit record of the run's
watermark (``incremental.commit``), so data and watermark move together, in one
atomic step, or not at all: a run that fails or is refused by its checks leaves
readers, reports and watermark as they were.

A manifest has one entry per table and replaced partition (days), so it stays
small; reading turns it into a partition filter, and only the folders it names are
listed.  ``prune`` deletes versions that no commit within a time limit refers to.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagelake.sources.files import MissingTableError, child_folders, remove_folder, write_table

VERSION = "version"
NO_VALUE = ""                                # the null partition


@dataclass(frozen=True)
class Entry:
    """Where a table's rows are: ``whole`` but for the partitions ``parts`` names, which are in other versions."""

    whole: str
    schema: str                              # JSON of the columns
    by: str | None = None                    # the partition column
    parts: dict[str, str] = field(default_factory=dict)

    def versions(self) -> list[str]:
        return sorted({self.whole, *self.parts.values()})


Manifest = dict[str, Entry]


def to_text(manifest: Manifest) -> str:
    return json.dumps({name: vars(entry) for name, entry in sorted(manifest.items())})


def from_text(text: str | None) -> Manifest:
    return {name: Entry(**entry) for name, entry in json.loads(text or "{}").items()}


def folder(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/{VERSION}={version}"


def stage(df: DataFrame, root: str, table: str, version: str, by: str | None = None,
          cluster_by: Sequence[str] = ()) -> tuple[Entry, Observation]:
    """Write ``df`` as a version of a table; writing it again replaces that version only."""
    _, seen = write_table(df, f"{root.rstrip('/')}/{table}", f"{VERSION}={version}", [by] if by else [], cluster_by=cluster_by)
    return Entry(version, df.schema.json(), by), seen


def replacing(previous: Entry | None, staged: Entry, values: Iterable) -> Entry:
    """``previous`` with the partitions of the given values taken from ``staged`` (also those it has no row for)."""
    if previous is None:
        return staged
    names = {NO_VALUE if v is None else str(v): staged.whole for v in values}
    return Entry(previous.whole, staged.schema, previous.by, previous.parts | names)


def open_table(spark: SparkSession, root: str, manifest: Manifest, table: str) -> DataFrame:
    """The rows of a table by a manifest."""
    if table not in manifest:
        raise MissingTableError(f"{table} is not published under {root}")
    entry = manifest[table]
    schema = T.StructType.fromJson(json.loads(entry.schema))
    if not entry.parts:
        return spark.read.schema(schema).parquet(folder(root, table, entry.whole))
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())]))
            .option("basePath", f"{root.rstrip('/')}/{table}").parquet(*[folder(root, table, v) for v in entry.versions()]))
    return rows.filter(current_rows(entry)).select(*schema.fieldNames())


def _listed(by: str, values: Iterable[str]) -> str:
    values = sorted(values)
    dated = ", ".join(f"DATE '{v}'" for v in values if v != NO_VALUE)
    tests = ([f"{by} IN ({dated})"] if dated else []) + ([f"{by} IS NULL"] if NO_VALUE in values else [])
    return "(" + " OR ".join(tests) + ")"


def current_rows(entry: Entry) -> str:
    """SQL predicate over the version and (date) partition columns that keeps a table's current rows."""
    held: dict[str, list[str]] = {}
    for value, version in entry.parts.items():
        held.setdefault(version, []).append(value)
    whole = f"{VERSION} = '{entry.whole}'"
    tests = [f"({VERSION} = '{v}' AND {_listed(entry.by, values)})" for v, values in sorted(held.items())]
    if entry.parts:
        whole = f"({whole} AND coalesce(NOT {_listed(entry.by, entry.parts)}, true))"
    return " OR ".join([whole, *tests])


def prune(spark: SparkSession, root: str, state: DataFrame, keep_since: dt.datetime) -> list[str]:
    """Delete versions that neither the newest commit nor one completed since ``keep_since`` refers to; their folders."""
    newest = state.agg(F.max("seq")).first()[0]
    rows = state.filter((F.col("seq") == F.lit(newest)) | (F.col("updated_at") >= F.lit(keep_since.isoformat()))).select("published")
    manifests = [from_text(r[0]) for r in rows.collect()]                # one row per run of the kept time
    gone = []
    for table in sorted({name for m in manifests for name in m}):
        used = {v for m in manifests if table in m for v in m[table].versions()}
        for name in child_folders(spark, f"{root.rstrip('/')}/{table}"):
            if name.startswith(f"{VERSION}=") and name.split("=", 1)[1] not in used:
                remove_folder(spark, f"{root.rstrip('/')}/{table}/{name}")
                gone.append(f"{table}/{name}")
    return gone
