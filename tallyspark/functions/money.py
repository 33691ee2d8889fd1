"""Money aggregation.

Money is staged as DOUBLE (like the reference), but summed as DECIMAL so
the result does not depend on partitioning or row order; the total is then
returned as DOUBLE. Six decimals keep amounts below a cent; 22 digits before
the point hold any amount a shop can state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DECIMAL = "decimal(28,6)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(x) -> Column:
    """Value as the exact summation type."""
    return _c(x).cast(MONEY_DECIMAL)


def money_sum(x) -> Column:
    """Exact partial sum (decimal); finish with ``.cast('double')``."""
    return F.sum(money(x))


def ratio(num, den) -> Column:
    """``safe_divide``: NULL when the divisor is 0 or NULL; DOUBLE result."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
