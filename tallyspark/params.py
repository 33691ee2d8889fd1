"""Run parameters (the values the reference hard-codes are parameters here)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace


def batch_tag(now: _dt.datetime | None = None) -> str:
    """Run batch tag, ``%Y%m%d%H%M%S`` in UTC (the reference's format string
    prints a literal ``S``; we print the seconds, quirk D6)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%d%H%M%S")


@dataclass(frozen=True)
class Params:
    # Event shards with suffix below this are not read (string compare, as in
    # the reference, whose floor this is).
    event_suffix_floor: str = "20260401"
    # Only read daily shards (YYYYMMDD); off = reference behaviour.
    daily_shards_only: bool = False
    # Folder of daily event shards (``events_<suffix>``); none: the one event relation.
    event_shards_root: str | None = None
    # Lookback for the incremental facts (O3).
    lookback: str = "INTERVAL 1 DAY"
    # Floor when the target fact is empty (O3).
    lookback_floor: str = "1900-01-01 00:00:00"
    # Batch tag stamped on fact rows.
    transform_batch_no: str = field(default_factory=batch_tag)
    # JSON path of the order's customer id (D13: real payloads nest it).
    order_customer_path: str = "$.customer_id"
    # k for the "top channels" dashboard list (L3).
    top_k: int = 10
    # Shop the fixtures land under.
    shop_domain: str = "shop-a"

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Fixed batch tag used by the registered check queries so results are
# reproducible (a real run stamps the wall clock), and a floor inside the
# testdata's events (2024-01-01..2024-01-30).
CHECK_BATCH_NO = "20240131000000"
CHECK_PARAMS = Params(transform_batch_no=CHECK_BATCH_NO, event_suffix_floor="20240105")
