"""Broadcast only behind a size check.

The check uses Catalyst's plan statistics (no job is run): for a Parquet scan
it is the file size of the columns read, for derived plans an upper bound.
The cap is the session's ``spark.sql.autoBroadcastJoinThreshold`` (a
disabled threshold disables the hint too).
Below the cap the side is hinted for broadcast; above it the plan keeps its
shuffle join and AQE may still switch to a broadcast at run time from the
measured shuffle size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FALLBACK_CAP_BYTES = 10 * 1024 * 1024


def session_cap(df: DataFrame) -> int:
    """The session's broadcast threshold (Spark's own planning limit)."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    try:
        text = str(raw).strip().lower()
        mult = {"k": 1024, "m": 1024 ** 2, "g": 1024 ** 3}
        for suffix in ("kb", "mb", "gb", "k", "m", "g", "b"):
            if text.endswith(suffix):
                return int(float(text[: -len(suffix)]) * mult.get(suffix[0], 1))
        value = int(text)
        return value if value > 0 else 0
    except (TypeError, ValueError):
        return FALLBACK_CAP_BYTES


def estimated_bytes(df: DataFrame) -> int | None:
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


# Per-type widths in bytes, as Catalyst sizes rows without statistics.
_WIDTH = {"string": 20, "binary": 100, "boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8,
          "float": 4, "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}


def _width(dtype) -> int:
    name = dtype.typeName()
    if name == "struct":
        return sum(_width(f.dataType) for f in dtype.fields)
    if name in ("array", "map"):
        return 100
    return _WIDTH.get(name, 20)


def _row_width(df: DataFrame) -> int:
    return max(1, sum(_width(f.dataType) for f in df.schema.fields))


def sized_broadcast(df: DataFrame, cap_bytes: int | None = None, bound: DataFrame | None = None) -> DataFrame:
    """Hint ``df`` for broadcast when its size is known to be under the cap.

    ``bound`` is a frame known to have at least as many rows as ``df`` (e.g.
    the left side of a left join on a unique key, or the input of a
    one-row-per-key selection); its estimate, rescaled to ``df``'s row
    width, then stands in for the (often unbounded) estimate of ``df``.
    """
    cap = session_cap(df) if cap_bytes is None else cap_bytes
    size = estimated_bytes(df)
    if bound is not None:
        b = estimated_bytes(bound)
        if b is not None:
            scaled = b * _row_width(df) // _row_width(bound) + 1
            size = scaled if size is None else min(size, scaled)
    if size is not None and size <= cap:
        return F.broadcast(df)
    return df


def counted_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Hint ``df`` for broadcast when its counted ``rows``, as wide as Catalyst takes them, are under the session's cap."""
    return F.broadcast(df) if rows * _row_width(df) <= session_cap(df) else df
