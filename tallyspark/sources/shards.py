"""Daily event shards (S11): folders ``events_<suffix>`` found by listing.

The shards in the suffix window are chosen by name before any of them is opened,
so a run over the last days lists and reads those alone, whatever history lies
beside them. Shards of different times have different columns: every shard is
read with the one declared schema, in which a column or a nested field that
a shard lacks is NULL and one that it has besides is not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.sources.schemas import GA_EVENTS_SCHEMA

PREFIX = "events_"
DAILY = re.compile("[0-9]{8}")


def find_shards(spark: SparkSession, root: str, floor: str, daily_only: bool = False) -> dict[str, str]:
    """Suffix -> folder of the shards at or after ``floor``, by string compare as the
    staging model does (``'intraday_20260401' >= '20260401'``, D14)."""
    suffixes = [n.removeprefix(PREFIX) for n in files.names(spark, root) if n.startswith(PREFIX)]
    return {s: f"{root}/{PREFIX}{s}" for s in suffixes if s >= floor and (not daily_only or DAILY.fullmatch(s))}


def read_shards(spark: SparkSession, root: str, floor: str, daily_only: bool = False) -> DataFrame:
    """The events of those shards with their ``_table_suffix``."""
    shards = find_shards(spark, root, floor, daily_only)
    if not shards:
        return spark.createDataFrame([], GA_EVENTS_SCHEMA)
    columns = [f for f in GA_EVENTS_SCHEMA.fields if f.name != "_table_suffix"]
    events = spark.read.schema(type(GA_EVENTS_SCHEMA)(columns)).parquet(*shards.values())
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return events.select("*", F.substring(folder, len(PREFIX) + 1, 1000).alias("_table_suffix"))
