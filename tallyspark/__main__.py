"""Command line.

    python -m tallyspark --sf-dir /root/testdata/sf0.01 [--out PATH] [--skip-tests]
    python -m tallyspark land --root ROOT --pages order=DIR [--pages product=DIR ...]
                              [--stream --checkpoint DIR]

The first form builds every model as a table, then runs the quality suite.
The ``land`` form lands API page files (one page object per line) into raw
tables ``ROOT/raw_{entity}s`` with one checkpoint row per entity in
``ROOT/landing_state`` -- as a batch run, or as an ``availableNow`` file
stream that lands only page files it has not seen.

Writes each model once under ``--out`` (default: a new folder under the
shared folder named by ``spark.checkpoint.dir``), downstream models reading
their upstream's table. Then runs the 108 tests over those tables and prints one
line per test that did not pass. Exit status 1 when an error-severity test
fails (warn-severity failures are reported only).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F


def land(argv: list[str]) -> int:
    ap = argparse.ArgumentParser(prog="tallyspark land")
    ap.add_argument("--root", required=True)
    ap.add_argument("--pages", action="append", required=True, help="entity=DIR (order, product, customer)")
    ap.add_argument("--shop-domain", default="shop-a")
    ap.add_argument("--batch-no", type=int, default=None, help="default: seconds since epoch")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--checkpoint", help="stream checkpoint folder (default: ROOT/_stream_{entity})")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    import time

    from tallyspark.session import build_session
    from tallyspark.sources import landing
    from tallyspark.streaming.landing_stream import land_stream

    spark = build_session(a.master)
    pages = dict(p.split("=", 1) for p in a.pages)
    state = f"{a.root}/landing_state"
    for entity, pages_dir in pages.items():
        raw = f"{a.root}/raw_{entity}s"
        if a.stream:
            ckpt = a.checkpoint or f"{a.root}/_stream_{entity}"
            land_stream(spark, pages_dir, entity, raw, state, ckpt, a.shop_domain)
        else:
            batch_no = a.batch_no if a.batch_no is not None else int(time.time())
            recs = landing.unwrap_pages(landing.read_pages(spark, pages_dir))
            print(json.dumps(landing.land_batch(spark, recs, entity, raw, state, a.shop_domain, batch_no)))
    for r in landing.read_state(spark, state).collect():
        print(json.dumps({"source": r.source, "last_updated_at": str(r.last_updated_at)}))
    return 0


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if argv and argv[0] == "land":
        return land(argv[1:])
    ap = argparse.ArgumentParser(prog="tallyspark")
    ap.add_argument("--sf-dir", required=True, help="testdata directory the raw inputs derive from")
    ap.add_argument("--out", help="where the model tables go (default: under spark.checkpoint.dir)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--suffix-floor", default=None, help="event shard floor (YYYYMMDD)")
    ap.add_argument("--skip-tests", action="store_true")
    a = ap.parse_args(argv)

    from tallyspark.params import Params
    from tallyspark.plans.build import MODEL_NAMES, Models, build_all
    from tallyspark.plans.quality import dq_suite
    from tallyspark.plans.reports import tieouts_of_run
    from tallyspark.session import build_session, fresh_path

    spark = build_session(a.master)
    params = Params() if not a.suffix_floor else Params(event_suffix_floor=a.suffix_floor)
    models = Models(spark, a.sf_dir, params)
    root = a.out or fresh_path(spark, "run")
    built = build_all(models, root)
    print(json.dumps({"models": len(MODEL_NAMES), "root": root}))
    for name, row in tieouts_of_run(spark, root).items():
        print(json.dumps({name: row.first().asDict()}))
    if a.skip_tests:
        return 0
    results = dq_suite(built).where(F.col("status") != "pass").collect()
    for r in results:
        print(f"{r.status.upper():5} {r.model}.{r.column_name or '-'} {r.test}: {r.failures}")
    failed = sum(1 for r in results if r.status == "fail")
    print(json.dumps({"tests": 108, "not_passed": len(results), "failed": failed}))
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
