"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir

#: The white space that separates words: space, tab, newline, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\f\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A higher-order lambda evaluates what it captures again for every element;
    a one-element array binds the value to a lambda variable instead.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the maximal runs of characters other than ``WHITE``; empty for null, empty or blank text."""
    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WHITE_RUN)))


def temp_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name in taken:
        name += "_"
    return name


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage: write ``df`` below the shared folder of the session and read it back.

    Survives the loss of executors; nothing is kept in a machine-local folder.
    """
    spark: SparkSession = df.sparkSession
    path = f"{new_run_dir(spark, 'llm')}/{purpose}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_buffers(column):
    """UTF-8 bytes and offsets (numpy) of an Arrow string array; nulls are empty texts."""
    import numpy as np
    import pyarrow as pa
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), offsets


def salt_count(rows: int, rows_per_salt: int = 100_000, least: int = 64) -> int:
    """Number of salts that keeps a third of ``rows`` under one key in pieces of a task's size."""
    return max(least, -(-rows // rows_per_salt))


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per context), as ``--py-files`` does."""
    context = spark.sparkContext
    if getattr(context, "_engagelake_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="run-"), "engagelake-package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    context._engagelake_shipped = True
