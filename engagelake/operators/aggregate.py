"""Skew-safe exact distinct counting and numbering.

``count(DISTINCT x) GROUP BY k`` is planned by Spark as a shuffle on ``k``
carrying the distinct ``x`` values: every distinct value of a group meets in
one reducer, so a group holding a third of the data is one task's work.
``distinct_count`` de-duplicates on ``(k, x)`` first -- that shuffle is
spread by ``x`` -- and then counts per ``k`` with map-side combining, so no
task holds more than its share whatever the group sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distinct_count(df: DataFrame, keys: Sequence[str], col: str, alias: str) -> DataFrame:
    """``(keys..., alias)``: exact number of distinct non-null ``col`` per group.

    Groups whose values are all null are absent (callers left-join and
    default to 0 when they need every group).
    """
    pairs = df.select(*keys, col).filter(F.col(col).isNotNull()).dropDuplicates([*keys, col])
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where null keys match each other (group keys may be null)."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    rest = [c for c in right.columns if c not in set(keys)]
    return left.join(right, cond, how).select(*[left[c] for c in left.columns], *[right[c] for c in rest])


def numbered(df: DataFrame, groups: Sequence[str], key: str, name: str, bits: int = 8) -> DataFrame:
    """Add ``name``: gapless numbers from 1 within each group, in the order of the key's hash (ties by key).

    The hashes are cut into ``2 ** bits`` ranges.  Rows are counted per range (combined map-side), prefix sums give
    each range its offset, and rows are ranked inside their range: no task holds a whole group, and the numbers do
    not depend on how many ranges or partitions there are.  Null group values are values; rows that share the key
    are numbered in any order."""
    hashed = df.select("*", F.struct(F.lit(0).alias("_"), *groups).alias("_group"), F.xxhash64(key).alias("_hash"))
    ranged = hashed.withColumn("_range", F.shiftrightunsigned("_hash", 64 - bits).cast("int"))
    counts = ranged.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_group", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_group", "_range").orderBy("_hash", key)
    return (ranged.withColumn("_rank", F.row_number().over(inside)).join(offsets, ["_group", "_range"])
            .withColumn(name, F.col("_offset") + F.col("_rank")).drop("_group", "_hash", "_range", "_rank", "_offset"))
