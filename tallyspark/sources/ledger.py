"""The ledger of streamed landing batches.

Each batch is a folder ``batch_no=N`` of the raw table, with an entry
``_batch.json`` (stream id, epoch, rows, watermark) among its files. Folder
and entry are written aside and appear together, by one rename; nothing that
has landed is written to again. Under ``_ledger/{stream id}/`` an epoch's
claim names its batch number before the batch is written, so that a replay
finds it. Numbers are drawn from the clock, past every folder that is there;
should another landing take a claimed number first, the rename fails and the
replay draws a new one.

A batch that broke off before its rename is written anew under its claim; a
batch whose folder is there, with its own entry in it, has landed, and a
replay of it does nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspark import files


class Ledger:
    def __init__(self, spark: SparkSession, raw_path: str, stream: str):
        self.spark, self.raw_path, self.stream = spark, raw_path, stream
        self.folder = f"{raw_path}/_ledger/{stream}"

    def _claim(self, epoch: int) -> str:
        return f"{self.folder}/{epoch:012d}.json"

    def _data(self, batch_no: int) -> str:
        return f"{self.raw_path}/batch_no={batch_no}"

    def _landed(self, number: int, epoch: int) -> bool | None:
        """Whether the number's folder is this epoch's; None if there is no folder."""
        if not files.exists(self.spark, self._data(number)):
            return None
        if not files.exists(self.spark, f"{self._data(number)}/_batch.json"):
            return False
        e = self.entry(number)
        return (e["stream"], e["epoch"]) == (self.stream, epoch)

    def batch_no(self, epoch: int) -> int:
        """The epoch's number: the claimed one, or a new claim."""
        claim = self._claim(epoch)
        if files.exists(self.spark, claim):
            number = files.read_json(self.spark, claim)["batch_no"]
            if self._landed(number, epoch) is not False:
                return number
            files.delete(self.spark, claim)  # a batch of somebody else's took the number first
        number = time.time_ns() // 1000
        while files.exists(self.spark, self._data(number)):
            number += 1
        files.write_json(self.spark, claim, {"batch_no": number})
        return number

    def land(self, epoch: int, rows: Callable[[int], DataFrame]) -> dict:
        """Lands ``rows(batch number)``, unless this epoch has landed. Returns the entry."""
        number = self.batch_no(epoch)
        if not self._landed(number, epoch):
            # One folder per epoch: what a broken run left there is replaced.
            aside = f"{self.raw_path}/_staging/{self.stream}-{epoch}"
            seen = Observation(f"landing-{self.stream}-{epoch}")
            (rows(number).drop("batch_no").observe(seen, F.max(F.unix_micros("updated_at")).alias("watermark"), F.count(F.lit(1)).alias("rows"))
             .write.mode("overwrite").option("compression", "zstd").parquet(aside))
            files.write_json(self.spark, f"{aside}/_batch.json", {"stream": self.stream, "epoch": epoch, "batch_no": number, **seen.get})
            files.rename(self.spark, aside, self._data(number))
        return self.entry(number)

    def entry(self, batch_no: int) -> dict:
        return files.read_json(self.spark, f"{self._data(batch_no)}/_batch.json")

    def _committed(self) -> int:
        done = [n for n in files.names(self.spark, f"{self.folder}/committed") if n.endswith(".json")]
        return int(done[-1].removesuffix(".json")) if done else -1

    def uncommitted(self) -> list[dict]:
        """Entries of the landed epochs after the last committed one."""
        out, epoch = [], self._committed() + 1
        while files.exists(self.spark, self._claim(epoch)):
            number = files.read_json(self.spark, self._claim(epoch))["batch_no"]
            if self._landed(number, epoch):
                out.append(self.entry(number))
            epoch += 1
        return out

    def commit(self, epoch: int) -> None:
        """Notes that the checkpoint covers the epochs up to this one."""
        folder = f"{self.folder}/committed"
        files.write_json(self.spark, f"{folder}/{epoch:012d}.json", {})
        for old in files.names(self.spark, folder):
            if old.endswith(".json") and int(old.removesuffix(".json")) < epoch:
                files.delete(self.spark, f"{folder}/{old}")
