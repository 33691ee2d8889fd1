"""Tables of partition folders behind a version pointer.

A table is ``{path}/data/{run}/part=.../`` folders and ``{path}/_versions/{n}.json``,
one small file per version that names its live folders. A change writes new
folders beside the live ones and then renames its version file into place:
that rename is the change. A crash before it leaves the old table, one after
it the new table; nothing that a version names is written to or moved. Readers go
through the newest version file.

Folders that neither the newest ``KEEP`` versions name nor the running change
wrote are deleted at the end of a change (a reader of an older version has that long).
One change runs at a time per table.

The partition column is kept in the files as well, so a version reads as plain
Parquet paths with an explicit schema; a partition's folder is chosen here, by
value, before any file is listed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import files

KEEP = 3
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    number: int
    #: Live folder (relative to the table) by partition value; None is the NULL partition.
    folders: dict[str | None, str]


def _number(name: str) -> int | None:
    stem = name.removesuffix(".json")
    return int(stem) if name.endswith(".json") and stem.isdigit() else None


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(n for n in map(_number, files.names(spark, f"{path}/_versions")) if n is not None)


def _load(spark: SparkSession, path: str, number: int) -> Version:
    doc = files.read_json(spark, f"{path}/_versions/{number:012d}.json")
    return Version(number, {value: folder for value, folder in doc["folders"]})


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version; none before the first change."""
    have = versions(spark, path)
    return _load(spark, path, have[-1]) if have else None


def read(spark: SparkSession, path: str, schema, version: Version | None, values=None) -> DataFrame:
    """The rows of ``version``, or of its partitions ``values`` alone."""
    if version is None:
        return spark.createDataFrame([], schema)
    folders = [f for v, f in version.folders.items() if values is None or v in values]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])


def partition_value(part_col: str):
    """The value a row's folder goes by: as a folder name has it, empty is NULL."""
    return F.nullif(F.col(part_col).cast("string"), F.lit(""))


def replace(df: DataFrame, path: str, part_col: str, base: Version | None, touched=None) -> Version:
    """A new version with the rows of ``df`` in place of the ``touched``
    partitions of ``base`` (``None``: of all)."""
    spark = df.sparkSession
    run = f"data/{uuid.uuid4().hex}"
    # Rebalanced by partition value: one file per small partition, and a large
    # one is split over tasks.
    (df.withColumn("part", partition_value(part_col)).hint("rebalance", "part")
     .write.partitionBy("part").parquet(f"{path}/{run}"))
    folders = {} if base is None or touched is None else {v: f for v, f in base.folders.items() if v not in touched}
    for name in files.names(spark, f"{path}/{run}"):
        if name.startswith("part="):
            value = unquote(name.removeprefix("part="))
            folders[None if value == NULL_FOLDER else value] = f"{run}/{name}"
    new = Version((base.number if base else 0) + 1, folders)
    files.write_json(spark, f"{path}/_versions/{new.number:012d}.json", {"folders": list(new.folders.items())})
    _clean(spark, path, run)
    return new


def _clean(spark: SparkSession, path: str, run: str) -> None:
    """Drops old versions, then the folders that no version names any more."""
    have = versions(spark, path)
    for n in have[:-KEEP]:
        files.delete(spark, f"{path}/_versions/{n:012d}.json")
    live = {f for n in have[-KEEP:] for f in _load(spark, path, n).folders.values()}
    live_runs = {f.rsplit("/", 1)[0] for f in live} | {run}
    for name in files.names(spark, f"{path}/data"):
        if f"data/{name}" not in live_runs:
            files.delete(spark, f"{path}/data/{name}")
