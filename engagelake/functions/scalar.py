"""Column expressions shared by the transforms.

All are built-in Spark expressions (JVM side, whole-stage codegen); the
``try_`` forms give null on malformed input whatever the session's ANSI
setting is, which is the null-on-error behaviour of the data model.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from engagelake.constants import EVENT_TIME_PATTERN, FILE_PART_UNSAFE


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    return col(c).try_cast("double")


def _whole(c, kind: str) -> Column:
    """Whole numbers, also when written with a fraction or exponent (``3.0``, ``1e3``), truncated; bad text -> null."""
    return F.coalesce(col(c).try_cast(kind), col(c).cast("string").try_cast("decimal(38,9)").try_cast(kind))


def as_long(c) -> Column:
    return _whole(c, "long")


def as_int(c) -> Column:
    return _whole(c, "int")


def as_bool(c) -> Column:
    return col(c).try_cast("boolean")


def iso_timestamp(c) -> Column:
    """ISO-8601 text (offset or ``Z``; naive means UTC) -> timestamp, bad -> null."""
    return col(c).try_cast("timestamp")


def iso_date(c) -> Column:
    """Calendar date of an ISO text (the date part as written), bad -> null."""
    return col(c).try_cast("date")


def event_time(c) -> Column:
    """Event time text in the fixed millisecond pattern; other shapes -> null."""
    return F.try_to_timestamp(col(c), F.lit(EVENT_TIME_PATTERN))


def pseudonym(c) -> Column:
    """Lower-case hex SHA-256 of the key's text (unsalted)."""
    return F.sha2(col(c).cast("string"), 256)


def safe_ratio(num, den) -> Column:
    """num / den as double when den > 0, else null (also null when either is null)."""
    return F.when(col(den) > 0, col(num).cast("double") / col(den).cast("double"))


def sanitize_file_part(c) -> Column:
    """Runs of characters outside [A-Za-z0-9_.=-] become one underscore."""
    return F.regexp_replace(col(c), FILE_PART_UNSAFE, "_")


def exact_sum(c, scale: int = 6, precision: int = 18) -> Column:
    """Order-independent sum of a rounded double column, as a decimal.

    Values of the gold layer carry at most ``scale`` decimals, so the cast is
    exact and the decimal sum does not depend on partitioning or task order.
    """
    return F.sum(col(c).cast(f"decimal({precision},{scale})"))


def exact_sum_double(c, scale: int = 6) -> Column:
    return exact_sum(c, scale).cast("double")


def exact_avg(c, scale: int = 6) -> Column:
    """Average as exact-sum / count, in double."""
    return exact_sum(c, scale).cast("double") / F.count(col(c))


def plain_decimal(c, digits: int = 13, scale: int = 9) -> Column:
    """A double read as the decimal it was written as (to ``scale`` decimals); not a number, or too large -> null."""
    return col(c).try_cast(f"decimal({digits + scale},{scale})")


def round_exact_sum(c, digits: int, scale: int = 6) -> Column:
    return F.round(exact_sum(c, scale), digits).cast("double")
