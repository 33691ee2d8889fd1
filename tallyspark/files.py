"""Small files on the cluster's file system, through Hadoop: whatever store the
tables lie in, their pointers and ledgers lie in as well."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; a missing folder has none."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Moves a file or folder to a name that doesn't exist yet, in one step.
    There is one writer per table, so looking first is enough."""
    fs, src = _fs(spark, old)
    dst = _fs(spark, new)[1]
    if fs.exists(dst):
        raise FileExistsError(new)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"{old} could not be renamed to {new}")


def read_json(spark: SparkSession, path: str):
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    """A new file that is there whole or not at all: written beside its place,
    then renamed into it."""
    folder, name = path.rsplit("/", 1)
    fs, tmp = _fs(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(tmp)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    rename(spark, tmp.toString(), path)
