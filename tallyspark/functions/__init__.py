"""Column-level helpers: JSON scalars, safe casts, event params, money sums."""

from tallyspark.functions.casts import safe_bigint, safe_double, safe_timestamp, to_output
from tallyspark.functions.events import event_param
from tallyspark.functions.json import json_value, parse_fields, parse_json, scalar_text
from tallyspark.functions.money import money_sum, ratio

__all__ = [
    "safe_bigint", "safe_double", "safe_timestamp", "to_output",
    "event_param", "json_value", "parse_fields", "parse_json", "scalar_text",
    "money_sum", "ratio",
]
