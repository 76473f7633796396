"""A keyed cache as the state of a stream: the newest entry per key, with a time to live and a cap on entries.

Entries live in a bucket's map state, so a micro-batch touches only the keys it brings. Beside them an index of time slots holds
which keys were last written when: entries that run out are found by a timer of the oldest slot, and entries beyond the cap
are taken from the oldest slots, without a look at the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

CHANGES = "bucket int, key string, change string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLOTS = 200  # time slots in a time to live


class Cache(StatefulProcessor):
    """Per bucket at most ``cap`` entries (key, at, value), at in microseconds, none older than ``ttl`` microseconds once the watermark says so."""

    def __init__(self, ttl: int, cap: int):
        self.ttl, self.cap, self.width = ttl, cap, max(1, ttl // SLOTS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getMapState("entries", "key string", "at long, value string")
        self.slots = handle.getMapState("slots", "slot long", "keys array<string>")
        self.size = handle.getValueState("size", "n long")

    def _count(self) -> int:
        return self.size.get()[0] if self.size.exists() else 0

    def _in_slot(self, slot: int) -> list[str]:
        return list(self.slots.getValue((slot,))[0]) if self.slots.containsKey((slot,)) else []

    def _arm(self) -> None:
        """A timer for the oldest slot, when all its entries have run out."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        oldest = min((s for (s,) in self.slots.keys()), default=None)
        if oldest is not None:
            self.handle.registerTimer(((oldest + 1) * self.width + self.ttl) // 1000 + 1)

    def _remove(self, slot: int, gone: set[str]) -> None:
        left = [k for k in self._in_slot(slot) if k not in gone]
        if left:
            self.slots.updateValue((slot,), (left,))
        else:
            self.slots.removeKey((slot,))

    def _drop(self, bucket: int, slot: int, keys: list[str], why: str) -> list[tuple]:
        for k in keys:
            self.entries.removeKey((k,))
        self._remove(slot, set(keys))
        return [(bucket, k, why) for k in keys]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        bucket, now = int(key[0]), timerValues.getCurrentWatermarkInMs() * 1000
        newest: dict[str, tuple[int, str]] = {}
        for pdf in rows:
            for k, at, value in zip(pdf["key"], pdf["at"], pdf["value"], strict=True):
                newest[k] = max(newest.get(k, (at, value)), (at, value))
        changes, gone, come = [], {}, {}
        for k, (at, value) in newest.items():
            known = self.entries.getValue((k,)) if self.entries.containsKey((k,)) else None
            if at + self.ttl <= now or known is not None and (known[0], known[1]) >= (at, value):
                continue
            if known is not None:
                gone.setdefault(known[0] // self.width, set()).add(k)
            self.entries.updateValue((k,), (int(at), value))
            come.setdefault(int(at) // self.width, []).append(k)
            changes.append((bucket, k, "put" if known is None else "renewed"))
        for slot, keys in gone.items():
            self._remove(slot, keys)
        for slot, keys in come.items():
            self.slots.updateValue((slot,), (self._in_slot(slot) + keys,))
        count = self._count() + sum(c[2] == "put" for c in changes)
        if count > self.cap:
            for slot in sorted(s for (s,) in self.slots.keys()):
                aged = sorted((self.entries.getValue((k,))[0], k) for k in self._in_slot(slot))
                out = [k for _, k in aged[: count - self.cap]]
                changes += self._drop(bucket, slot, out, "evicted")
                count -= len(out)
                if count <= self.cap:
                    break
        if changes:
            self.size.update((count,))
            self._arm()
        yield pd.DataFrame(changes, columns=["bucket", "key", "change"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bucket, now = int(key[0]), timerValues.getCurrentWatermarkInMs() * 1000
        changes = []
        for slot in sorted(s for (s,) in self.slots.keys() if (s + 1) * self.width + self.ttl <= now):
            changes += self._drop(bucket, slot, self._in_slot(slot), "expired")
        self.size.update((self._count() - len(changes),))
        self._arm()
        yield pd.DataFrame(changes, columns=["bucket", "key", "change"])

    def close(self) -> None:
        pass


def micros(gap: dt.timedelta) -> int:
    return gap // dt.timedelta(microseconds=1)


def changes(entries: DataFrame, ttl: dt.timedelta, cap: int, delay: str = "0 seconds", buckets: int = 8) -> DataFrame:
    """The stream of changes (bucket, key, change: put, renewed, evicted or expired) that a stream of entries (key, ts, value) makes
    to the cache. Of one key the entry of greatest (ts, value) counts, however late the others come; null keys and times are dropped."""
    rows = (entries.where("key is not null and ts is not null").withWatermark("ts", delay)
            .select("ts", "key", F.unix_micros("ts").alias("at"), F.coalesce("value", F.lit("")).alias("value"), F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket")))
    return rows.groupBy("bucket").transformWithStateInPandas(Cache(micros(ttl), cap), CHANGES, "Update", "EventTime")


def feed(entries: DataFrame, checkpoint: str, ttl: dt.timedelta, cap: int, delay: str = "0 seconds", buckets: int = 8, log: str | None = None) -> None:
    """Brings all entries there are into the cache kept under ``checkpoint``; changes are appended to ``log`` if given."""
    spark = entries.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        out = changes(entries, ttl, cap, delay, buckets).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        if log:
            out.foreachBatch(lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{log}/epoch={epoch}")).start().awaitTermination()
        else:
            out.format("noop").start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def current(spark: SparkSession, checkpoint: str, now: dt.datetime, ttl: dt.timedelta, cap: int) -> DataFrame:
    """(key, ts, value) of the cache as the last micro-batch left it: the newest ``cap`` entries that have not run out at ``now``.

    Every bucket holds its newest ``cap`` entries, so the newest of all are among them."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "entries").load()
    rows = state.select(F.col("user_map_key.key").alias("key"), F.timestamp_micros("user_map_value.at").alias("ts"), F.col("user_map_value.value").alias("value"))
    return rows.where(F.col("ts") > F.lit(now) - F.lit(ttl)).orderBy(F.desc("ts"), "key").limit(cap)
