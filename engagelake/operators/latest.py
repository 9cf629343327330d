"""Latest-version selection and key de-duplication.

``latest_by`` keeps the newest row per key: ``row_number()`` over
``PARTITION BY keys ORDER BY order_col DESC NULLS LAST, tiebreak...``.
Catalyst turns the rank filter into a partial ``WindowGroupLimit`` that runs
*before* the shuffle, so every map task forwards at most one row per key and
a hot key cannot pile up in one reducer.

The tie-break makes the survivor deterministic (input-order and partition
independent); without one, rows equal on the order column are resolved by
the remaining columns of the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _orderable(dtype) -> bool:
    """Whether Spark can sort by a value of this type (maps and variants cannot)."""
    name = dtype.typeName()
    if name in ("map", "variant"):
        return False
    if name == "array":
        return _orderable(dtype.elementType)
    if name == "struct":
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def _order_columns(df: DataFrame, keys: Sequence[str], order_col: str,
                   tiebreak: Sequence[str] | None, descending_tiebreak: bool) -> list[Column]:
    if tiebreak is None:
        skip = set(keys) | {order_col}
        tiebreak = [f.name for f in df.schema.fields if f.name not in skip and _orderable(f.dataType)]
    order = [F.col(order_col).desc_nulls_last()]
    for c in tiebreak:
        order.append(F.col(c).desc_nulls_last() if descending_tiebreak else F.col(c).asc_nulls_first())
    return order


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str = "ingested_at",
    tiebreak: Sequence[str] | None = None,
    descending_tiebreak: bool = True,
) -> DataFrame:
    """Newest row per ``keys`` by ``order_col`` (nulls lose); null keys form one group."""
    window = Window.partitionBy(*keys).orderBy(
        *_order_columns(df, keys, order_col, tiebreak, descending_tiebreak))
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_keep_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the survivor being the smallest remaining row.

    Deterministic stand-in for ``dropDuplicates(keys)`` (whose survivor is
    arbitrary).  Runs as one hash/sort aggregate with map-side partial
    aggregation: ``min(struct(rest))`` per key, so a hot key is reduced to one
    row per map task before the shuffle.
    """
    rest = [c for c in df.columns if c not in set(keys)]
    if not rest:
        return df.dropDuplicates(list(keys))
    row = F.struct(*[F.col(c) for c in rest])
    order = [f.name for f in df.schema.fields if f.name in set(rest) and _orderable(f.dataType)]
    if len(order) == len(rest):
        survivor = F.min(row)
    else:                                   # carry unorderable columns, order by the others
        survivor = F.min_by(row, F.struct(*[F.col(c) for c in order]))
    packed = df.groupBy(*keys).agg(survivor.alias("__row"))
    return packed.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)
