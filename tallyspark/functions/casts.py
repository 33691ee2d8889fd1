"""Safe casts with warehouse ``SAFE_CAST`` edges.

Spark's ``try_cast`` is more lenient than the warehouse at the edges: it takes
``'2026'`` and ``'10:00'`` as timestamps and ``'1.5d'`` as a double. A regex
guard rejects those before the cast. ``inf``/``nan`` text becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed patterns (they define which text counts as a number / timestamp).
INT_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = r"^[+-]?[0-9]*[.]?[0-9]+([eE][+-]?[0-9]+)?$"
TIMESTAMP_PREFIX_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_bigint(s) -> Column:
    s = _c(s)
    return F.when(s.rlike(INT_PATTERN), s.try_cast("bigint"))


def safe_double(s) -> Column:
    s = _c(s)
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))


def safe_timestamp(s) -> Column:
    s = _c(s)
    return F.when(s.rlike(TIMESTAMP_PREFIX_PATTERN), s.try_cast("timestamp"))


def to_output(df: DataFrame) -> DataFrame:
    """Publish timestamps as wall-clock UTC (TIMESTAMP_NTZ), so a reader in
    any session zone sees the same values. Session zone is pinned to UTC."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
