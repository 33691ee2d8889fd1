import hashlib

from pyspark.sql import functions as F

from tallyspark.checks.compare import compare, duck
from tallyspark.llm import op10_merkle_audit as op
from tallyspark.llm.tables import table

SCHEMA = "page_id long, url string, html string"


def test_whole_table_matches_sql(spark, sf_small):
    r = compare(op.query(spark, sf_small), duck(sf_small), op.ORACLE_SQL)
    assert r["hash_match"] and r["columns_match"], r


def test_files_round_trip(spark, sf_small, tmp_path):
    records = op.records_of(table(spark, sf_small, "pages"), pages_per_archive=16)
    op.write_archives(records, f"{tmp_path}/warc")
    key = lambda df: sorted(map(tuple, df.select("archive", "offset", "length", "digest").collect()))
    assert key(op.read_archives(spark, f"{tmp_path}/warc")) == key(op.leaves_of(records))


def test_damage_is_located_exactly(spark):
    leaves = [(a, i * 700, 700, hashlib.sha256(f"{a}:{i}".encode()).hexdigest()) for a in range(6) for i in range(200)]
    replica = {x[:2]: x for x in leaves}
    replica[0, 700] = (0, 700, 700, "rot")
    del replica[1, 0], replica[2, 199 * 700]
    replica[3, 90_000_000] = (3, 90_000_000, 5, "new")
    replica = {k: v for k, v in replica.items() if k[0] != 5}
    replica[7, 0] = (7, 0, 9, "whole new archive")
    a, b = (spark.createDataFrame(x, op.LEAVES) for x in (leaves, list(replica.values())))
    got = sorted((r.archive, r.offset, r.status) for r in op.audit(a, b, range_bytes=2048, fanout=4).collect())
    want = [(0, 700, "changed"), (1, 0, "missing"), (2, 199 * 700, "missing"), (3, 90_000_000, "extra"), (7, 0, "extra")]
    assert got == sorted(want + [(5, i * 700, "missing") for i in range(200)])
    assert op.audit(a, a).count() == 0


def test_awkward_rows(spark, tmp_path):
    rows = [(None, None, None), (1, None, "x\r\n\r\ny"), (1, "u\r\nv", "é€"), (1, "u\r\nv", "é€"), (5000, "u", ""), (-3, "u", "z" * 70_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("archive", F.lit("clash")).withColumn("length", F.lit(None).cast("int"))
    records = op.records_of(df)
    assert records.count() == len(rows)
    op.write_archives(records, f"{tmp_path}/warc")
    assert op.audit(op.leaves_of(records), op.read_archives(spark, f"{tmp_path}/warc")).count() == 0
    none = op.records_of(spark.createDataFrame([], SCHEMA))
    assert op.audit(op.leaves_of(none), op.leaves_of(none)).count() == 0


def test_damage_inside_an_archive(spark, tmp_path):
    """Lost, added, lengthened and shortened records, and compressed bytes that
    are flipped, cut out or cut off: only the records they meet are damaged."""
    import gzip
    import random
    from pathlib import Path
    rnd = random.Random(10)
    pages = [(i, f"http://h/{i}", " ".join(str(rnd.randrange(10 ** 9)) for _ in range(60))) for i in range(240)]
    records = op.records_of(spark.createDataFrame(pages, SCHEMA), pages_per_archive=40).cache()
    kept = {r.page_id: (r.archive, r.offset) for r in records.collect()}
    n = F.col("page_id")
    replica = records.filter(~n.isin(5, 6, 45)).withColumn("record", F.when(
        n.isin(10, 88), F.concat("record", F.lit("longer"))).otherwise(F.col("record")))
    html = "short"
    replica = replica.withColumn("record", F.when(n == 50, F.concat(F.regexp_replace(
        F.expr("substring_index(record, '\\r\\n\\r\\n', 1)"), r"Content-Length: \d+", "Content-Length: 5"), F.lit(op.EOR + html)))
        .otherwise(F.col("record")))
    extra = records.filter("page_id = 60").withColumn("offset", F.col("offset") + 1)
    twice = records.filter("page_id = 62")
    op.write_archives(replica.unionByName(extra).unionByName(twice), f"{tmp_path}/warc")
    files = {int(f.parent.name.split("=")[1]): f for f in Path(f"{tmp_path}/warc").rglob("*.txt")}
    assert b"WARC/1.0" in gzip.decompress(files[5].read_bytes())  # a valid gzip file
    starts = {a: [i for i in range(len(b)) if b[i:i + 4] == op._MAGIC and op._TO.match(b, i)] for a, b in
              ((a, f.read_bytes()) for a, f in files.items())}
    for archive, cut in ((3, lambda b, s: b[:s[7] + 60] + bytes([b[s[7] + 60] ^ 4]) + b[s[7] + 61:]),    # a bit flipped
                         (4, lambda b, s: b[:s[9] + 100] + b[s[9] + 103:]),                          # three bytes lost
                         (5, lambda b, s: b[:s[30] + 50])):                                          # cut off
        f = files[archive]
        f.write_bytes(cut(f.read_bytes(), starts[archive]))
        for crc in f.parent.glob(".*.crc"):
            crc.unlink()
    got = sorted((r.archive, r.offset, r.status) for r in op.audit(op.leaves_of(records), op.read_archives(spark, f"{tmp_path}/warc")).collect())
    want = [(*kept[i], "missing") for i in (5, 6, 45, 10, 88, 127, 169, *range(230, 240))]
    want += [(*kept[50], "changed"), (kept[60][0], kept[60][1] + 1, "extra"), (*kept[62], "extra")]
    assert got == sorted(want)


def test_records_longer_than_a_member(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "MEMBER", 100)
    parts = [op._member(b"x" * 100, b"TO", 700), op._member(b"y" * 30, b"TC", 800), op._member(b"z", b"TO", 900)]
    assert list(op._stretches(b"".join(parts))) == [(700, b"x" * 100 + b"y" * 30), (900, b"z")]
    assert list(op._stretches(b"junk" + parts[0][:-5] + parts[2])) == [(900, b"z")]
