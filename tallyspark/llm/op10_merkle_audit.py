"""Operator 10, WARC archives with a Merkle fixity audit.

:func:`records_of` lays pages out as WARC records with their byte offsets, an
archive being a run of ``pages_per_archive`` page ids. :func:`write_archives`
writes one WARC file per archive through Spark's text sink, a gzip member per
record, and :func:`read_archives` reads such files back, each in one task, and
hashes every record.

A member's header keeps the record's offset in the archive as it was written
(extra field "TO", under the header's checksum), so records behind a lost,
added, lengthened or shortened one stay at their place; members without it
are counted on from the last. After a member that can't be read, reading goes
on at the next one that can. A record of 16 MB or more continues in further
members, marked "TC".

The audit compares replicas by trees of hashes (:func:`tree_of`): leaves are
the SHA-256 of the records; a node of level 0 hashes the records that begin
in one range of ``range_bytes``, in order of offset, and a node of level n
the ``fanout`` nodes of level n - 1 below it. Ranges are places in the
archive, so a lost record changes only the branch it stood in.
:func:`audit` compares roots, then only the children of nodes that differ,
down to the records: ``changed``, ``missing`` (in the replica) or ``extra``.
Every step groups or joins by (archive, range): no group holds more than
``fanout`` nodes or the records that begin in one range.

Defined cases: null html and url are empty; a null page id goes to one of
4096 archives below 0 by its content; repeated rows are records each; an
unreadable stretch of a file is skipped to the next record, so its records
are missing, also if it is compressed bytes that are changed, cut or lost; of
several records at one offset the intact one is the record, the others are
extra; other columns are ignored; an empty table has no archives.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyspark.session import fresh_path

from .tables import map_texts, table, utf8_lists, written

EOR = "\r\n\r\n"
LEAVES = "archive long, offset long, length long, digest string"


def records_of(pages: DataFrame, pages_per_archive: int = 1024) -> DataFrame:
    """``archive, page_id, offset, length, digest, record`` (without its
    closing EOR, which ``length`` counts). The digest is taken before the
    offsets, so that leaves need no record in their shuffle."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    lost = -1 - F.pmod(F.xxhash64(url, html), F.lit(4096))
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.translate(url, "\r\n", ""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(EOR), html)
    rows = pages.select(
        F.coalesce(F.floor(F.col("page_id") / pages_per_archive), lost).cast("long").alias("archive"),
        F.col("page_id").cast("long").alias("page_id"), record.alias("record"))
    rows = rows.select("archive", "page_id", (F.octet_length("record") + len(EOR)).cast("long").alias("length"),
                       F.sha2(F.col("record").cast("binary"), 256).alias("digest"), "record")
    before = W.partitionBy("archive").orderBy("page_id", "digest").rowsBetween(W.unboundedPreceding, -1)
    return rows.select("archive", "page_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
                       "length", "digest", "record")


# A member holds less than this: the last byte of its size is zero, and is what
# Spark's text sink puts behind each row as its line separator.
MEMBER = (1 << 24) - 1
_MAGIC = b"\x1f\x8b\x08\x06"  # deflate, with header checksum and extra field
_TO = re.compile(rb"\x1f\x8b\x08\x06.{6}\x0c\x00T([OC])\x08\x00(.{8})", re.S)


def _member(data: bytes, kind: bytes, offset: int) -> bytes:
    head = _MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<H2sHq", 12, kind, 8, offset)
    press = zlib.compressobj(6, zlib.DEFLATED, -15)
    return (head + struct.pack("<H", zlib.crc32(head) & 0xFFFF) + press.compress(data) + press.flush()
            + struct.pack("<II", zlib.crc32(data), len(data)))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for offset, record in zip(b.column(1).to_pylist(), utf8_lists(b, "record")):
            data = record + EOR.encode()
            out.append(b"".join(_member(data[i:i + MEMBER], b"TC" if i else b"TO", offset + i)
                                for i in range(0, len(data), MEMBER))[:-1])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                         names=["archive", "offset", "members"])


def write_archives(records: DataFrame, path: str) -> None:
    """One WARC file per archive, gzip members: ``path/archive=N/*.txt``."""
    (map_texts(records.select("archive", "offset", "record"), _members, "archive long, offset long, members binary")
     .repartition("archive").sortWithinPartitions("archive", "offset")
     .select("archive", F.col("members").cast("string").alias("members")).write.partitionBy("archive")
     .option("lineSep", "\0").option("compression", "none").text(path))


_HEAD = re.compile(rb"WARC/1\.0\r\n(?:[^\r\n]+\r\n)*?Content-Length: (\d+)\r\n(?:[^\r\n]+\r\n)*\r\n")


def _stretches(content: bytes) -> Iterator[tuple[int | None, bytes]]:
    """(offset, data) of the readable members, continuations with their
    first; None without a kept offset."""
    at, start, parts = 0, None, []
    while 0 <= at < len(content):
        inflate = zlib.decompressobj(31)
        try:
            data = inflate.decompress(content[at:at + (1 << 16)])
            more = at + (1 << 16)
            while not inflate.eof and more < len(content):
                data += inflate.decompress(content[more:more + (1 << 20)])
                more += 1 << 20
            whole = inflate.eof
        except zlib.error:
            whole = False
        if not whole:
            at = content.find(b"\x1f\x8b\x08", at + 1)
            continue
        m = _TO.match(content, at)
        place = struct.unpack("<q", m[2])[0] if m else None
        if m and m[1] == b"C" and parts and start is not None and place == start + sum(map(len, parts)):
            parts.append(data)
        else:
            if parts:
                yield start, b"".join(parts)
            start, parts = place, [data]
        at = min(more, len(content)) - len(inflate.unused_data)
        while content[at:at + 1] == b"\0":  # padding between members
            at += 1
        if at < len(content) and content[at:at + 3] != b"\x1f\x8b\x08":
            at = content.find(b"\x1f\x8b\x08", at)
    if parts:
        yield start, b"".join(parts)


def _records(data: bytes) -> Iterator[tuple[int, int, str]]:
    """(place, length, digest) of the records that stand in the stretch."""
    at = 0
    while at >= 0:
        m = _HEAD.match(data, at)
        end = m.end() + int(m[1]) + len(EOR) if m else len(data) + 1
        if end <= len(data) and data[end - 4:end] == EOR.encode():
            yield at, end - at, hashlib.sha256(data[at:end - 4]).hexdigest()
            at = end
        else:
            at = data.find(b"WARC/1.0\r\n", at + 1)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for archive, content in zip(b.column(0).to_pylist(), b.column(1)):
            rows, counted, plain = [], 0, b""
            # Members without an offset of their own are one stream with their neighbours.
            for offset, data in chain(_stretches(content.as_buffer().to_pybytes()), [(0, b"")]):
                if offset is None:
                    plain += data
                    continue
                rows += [(archive, counted + at, n, digest) for at, n, digest in _records(plain)]
                rows += [(archive, offset + at, n, digest) for at, n, digest in _records(data)]
                counted, plain = offset + len(data), b""
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                                 names=["archive", "offset", "length", "digest"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Leaves (archive, offset, length, digest) of the readable records."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,txt}").option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_extract("path", r"archive=(-?\d+)/", 1).cast("long").alias("archive"), "content"))
    return files.mapInArrow(_parse, LEAVES)


def leaves_of(records: DataFrame, *more: str) -> DataFrame:
    return records.select("archive", "offset", "length", "digest", *more)


def tree_of(leaves: DataFrame, levels: int, range_bytes: int = 16 << 10, fanout: int = 16) -> DataFrame:
    """Nodes (archive, level, place, digest); the highest level is the root,
    where the archive is no longer than ``range_bytes * fanout ** levels``."""
    def node(rows: DataFrame, place, order: str, level: int) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("digest").alias("d"))))
        text = F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["at"].cast("string"), x["d"])), ",")
        return (rows.groupBy("archive", place.alias("place")).agg(F.sha2(text, 256).alias("digest"))
                .select("archive", F.lit(level).alias("level"), "place", "digest"))

    nodes = [node(leaves, F.floor(F.col("offset") / range_bytes).cast("long"), "offset", 0)]
    for level in range(1, levels + 1):
        nodes.append(node(nodes[-1], F.floor(F.col("place") / fanout).cast("long"), "place", level))
    out = nodes[0]
    for n in nodes[1:]:
        out = out.unionAll(n)
    return out


def audit(left: DataFrame, right: DataFrame, range_bytes: int = 16 << 10, fanout: int = 16) -> DataFrame:
    """Damaged records: ``archive, offset, length, status`` of the leaves of
    ``right`` held against ``left`` (the leaves of the kept manifest)."""
    longest = left.unionAll(right).agg(F.max(F.col("offset") + F.col("length"))).first()[0] or 0
    levels = 0
    while range_bytes * fanout ** levels < longest:
        levels += 1
    a, b = (written(tree_of(x, levels, range_bytes, fanout), "merkle") for x in (left, right))
    open_ = None  # (archive, place) of the nodes that differ, one level up
    for level in range(levels, -1, -1):
        sides = []
        for tree in (a, b):
            nodes = tree.filter(F.col("level") == level).select("archive", "place", "digest")
            if open_ is not None:
                nodes = nodes.withColumn("up", F.floor(F.col("place") / fanout).cast("long")).join(
                    open_, ["archive", "up"], "left_semi").drop("up")
            sides.append(nodes)
        differ = (sides[0].withColumnRenamed("digest", "_a").join(
            sides[1].withColumnRenamed("digest", "_b"), ["archive", "place"], "full_outer")
            .filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("archive", F.col("place").alias("up")))
        open_ = written(differ, f"merkle-differ-{level}")

    def under(x: DataFrame, side: str) -> DataFrame:
        return (x.withColumn("up", F.floor(F.col("offset") / range_bytes).cast("long"))
                .join(open_, ["archive", "up"], "left_semi")
                .select("archive", "offset", F.col("length").alias(f"length{side}"), F.col("digest").alias(f"digest{side}")))

    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed"))
    kept = under(left, "_a").withColumn("nth", F.lit(1))
    intact = F.coalesce(F.col("digest_b") == F.col("digest_a"), F.lit(False))
    at = W.partitionBy("archive", "offset").orderBy(intact.desc(), "digest_b", "length_b")
    held = (under(right, "_b").join(kept.select("archive", "offset", "digest_a"), ["archive", "offset"], "left")
            .withColumn("nth", F.row_number().over(at)).drop("digest_a"))
    return (kept.join(held, ["archive", "offset", "nth"], "full_outer")
            .filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
            .select("archive", "offset", F.coalesce("length_a", "length_b").alias("length"), status.alias("status")))


def damaged(records: DataFrame, every: int = 97) -> DataFrame:
    """A replica with known faults: of each ``every`` page ids one has a
    character changed (id % every = 13) and one is zeroed (14); every fifth
    archive has lost its last record."""
    last = W.partitionBy("archive").orderBy(F.col("offset").desc())
    fault = F.pmod("page_id", F.lit(every))
    end = F.expr("right(record, 1)")
    changed = F.concat(F.expr("substring(record, 1, char_length(record) - 1)"),
                       F.expr("repeat('~', octet_length(right(record, 1)))"))
    zeroed = F.expr(f"repeat('0', cast(length as int) - {len(EOR)})")
    return (records.withColumn("_n", F.row_number().over(last))
            .filter(~((F.pmod("archive", F.lit(5)) == 4) & (F.col("_n") == 1))).drop("_n")
            .withColumn("record", F.when((fault == 13) & (end != "\n"), changed).when(fault == 14, zeroed).otherwise(F.col("record"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages`` archived; a damaged replica, written as WARC files and
    read back, is audited against it. One row per damaged record."""
    records = records_of(table(spark, sf_dir, "pages"))
    path = fresh_path(spark, "llm-warc")
    write_archives(damaged(records), path)
    manifest = written(leaves_of(records, "page_id"), "warc-leaves")
    found = audit(manifest.drop("page_id"), written(read_archives(spark, path), "warc-replica"))
    ids = manifest.select("archive", "offset", "page_id")
    return found.join(ids, ["archive", "offset"], "left").select("page_id", "archive", "offset", "length", "status")


# Bytes of a record besides its page id, url, html and length.
_FIXED = len("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:>\r\nWARC-Target-URI: "
             "\r\nContent-Type: text/html\r\nContent-Length: ") + 2 * len(EOR)

ORACLE_SQL = f"""
WITH records AS (
  SELECT CAST(floor(page_id / 1024.0) AS BIGINT) AS archive, page_id,
         length(CAST(page_id AS VARCHAR)) + octet_length(encode(replace(replace(url, chr(13), ''), chr(10), '')))
           + octet_length(encode(html)) + length(CAST(octet_length(encode(html)) AS VARCHAR))
           + {_FIXED} AS length
  FROM pages),
placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         row_number() OVER (PARTITION BY archive ORDER BY page_id DESC) AS from_end
  FROM records)
SELECT page_id, archive, CAST(start AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
       CASE WHEN (archive % 5 = 4 AND from_end = 1) OR page_id % 97 = 14 THEN 'missing' ELSE 'changed' END AS status
FROM placed
WHERE page_id % 97 IN (13, 14) OR (archive % 5 = 4 AND from_end = 1)
"""
