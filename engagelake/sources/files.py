"""Table files: existence checks, required reads, partitioned writes.

Existence is asked of the Hadoop file system of the path (any scheme:
``file:``, object stores, HDFS), one call per path.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _located(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path of any scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _located(spark, path)
    return bool(fs.exists(p))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _located(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _located(spark, path)
    fs.delete(p, True)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; of any number of writers at once exactly one is told True.

    The text is written aside and given its name in one step that fails where the name is taken: a hard link on a
    local disk, elsewhere a rename without overwriting (atomic on HDFS; on an object store as far as its Hadoop
    file system refuses to replace an object)."""
    fs, p = _located(spark, path)
    fs.mkdirs(p.getParent())
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}")    # hidden from readers
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(aside.toUri().getPath(), p.toUri().getPath())
        else:
            kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            kinds[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), fs.getConf()).rename(aside, p, kinds)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    finally:
        fs.delete(aside, False)


def remove_partition(spark: SparkSession, path: str, values: dict[str, str | None]) -> None:
    """Delete one partition folder of the table at ``path`` (values as text, null for the null partition)."""
    jvm = spark.sparkContext._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = jvm.org.apache.hadoop.fs.Path("/".join([path, *(names.getPartitionPathString(c, v) for c, v in values.items())]))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class MissingTableError(RuntimeError):
    pass


def read_required(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table that must exist; partition columns typed by ``schema``
    (no type inference from folder names)."""
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        raise MissingTableError(f"Missing required table: {path}. Run the step that produces it first.")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, root: str, table: str, partition_cols: Sequence[str] = (),
                mode: str = "overwrite", dynamic: bool = False,
                cluster_by: Sequence[str] = ()) -> tuple[str, Observation]:
    """Write Parquet, rebalanced on the partition columns first (one shuffle,
    few files per folder; AQE splits a hot partition value over several
    tasks instead of one).  The row count is observed during the write, so
    the plan is not run a second time to count.  ``dynamic`` replaces only
    the partitions present in ``df``; ``cluster_by`` sorts rows inside each
    file so Parquet min/max statistics can skip row groups."""
    path = f"{root.rstrip('/')}/{table}"
    obs = Observation(f"rows_{table}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_cols:
        out = out.hint("rebalance", *partition_cols)
    if partition_cols or cluster_by:
        out = out.sortWithinPartitions(*partition_cols, *cluster_by)
    writer = out.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return path, obs


def observed(seen: Observation, name: str, default=None):
    """A metric of a finished write; ``default`` where the optimizer found that there are no rows and left the observation out."""
    try:
        return seen.get.get(name, default)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return default


def written_rows(obs: Observation) -> int:
    return int(observed(obs, "rows") or 0)
