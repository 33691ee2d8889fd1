"""Event-parameter lookup (O2): the value of one key in the repeated
``event_params`` record, without a join: a higher-order ``filter`` over the
array, first match (duplicate keys: the first one wins, D16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KIND_FIELD = {"int": "int_value", "string": "string_value"}


def event_param(key: str, kind: str, params: str = "event_params") -> Column:
    hit = F.get(F.filter(F.col(params), lambda p: p["key"] == F.lit(key)), 0)
    return hit["value"][_KIND_FIELD[kind]]
