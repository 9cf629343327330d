"""Privacy guards: sensitive-name test and column exclusion."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engagelake.constants import SENSITIVE_KEY_PARTS

SENSITIVE_PATTERN = "|".join(re.escape(p) for p in SENSITIVE_KEY_PARTS)


def is_sensitive_name(name: str) -> bool:
    """Lower-cased name contains any sensitive part (driver-side, for schema names)."""
    low = name.lower()
    return any(p in low for p in SENSITIVE_KEY_PARTS)


def is_sensitive_key(key: Column) -> Column:
    """Same test as a column expression, for key names held in data."""
    return F.lower(key).rlike(SENSITIVE_PATTERN)


def drop_sensitive(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop top-level columns whose name is sensitive (except ``keep``).

    Nested struct fields with sensitive names are removed too, so a raw
    record struct can be carried forward without its personal fields.
    """
    out = []
    for field in df.schema.fields:
        if field.name in keep:
            out.append(F.col(field.name))
        elif is_sensitive_name(field.name):
            continue
        elif field.dataType.typeName() == "struct":
            out.append(_prune_struct(F.col(f"`{field.name}`"), field.dataType).alias(field.name))
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)


def _prune_struct(c: Column, dtype) -> Column:
    sensitive = [f.name for f in dtype.fields if is_sensitive_name(f.name)]
    if not sensitive:
        return c
    return c.dropFields(*sensitive)
