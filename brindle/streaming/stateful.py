"""The work queue as keyed state: "has all of A and none of B" is kept for each id as its rows arrive, instead of being asked of the whole table again.

Each id has one value: the first write of each included state, whether an excluded state was seen, and what was last told.  Rows may come late, twice or in any order: of several writes of a state
the one of least (ts, data) counts whatever comes first, so the end is that of ``operators.state.get_many`` over all rows.  What goes out are changes (id, version, ready, ts, rows): an id becomes ready, its rows
change, or it stops being ready.  ``current`` keeps the last version of each id, and ``merged`` makes of its rows what the batch query makes.

With ``window_days`` a row counts while it is younger than the window by the clock.  A timer of the id goes off when its oldest row that counts leaves the window; that row's payload is then dropped, and
an id that was ready is told to be so no longer.

State lies in RocksDB beside the checkpoint (``start`` sets the provider), so it is bounded by disk, not by memory, and a restart goes on where the last finished batch ended.  A hot id is a single key: its rows of
a batch are handled by one task one by one, and nothing but one value is kept.  Most ids have few rows, so they come as rows: a frame for each id would cost many times the work on it.

Defined cases: rows without an id or a state are left out; a first write with null data does not count, nor do later ones then; rows of other states change nothing; an excluded state counts whatever its age and data.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.state import truthy

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "id string, version long, ready boolean, ts timestamp, rows string"
DAY_MS = 86_400_000
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


class QueueProcessor(StatefulProcessor):
    """One value a key: its rows (JSON), whether it is excluded, what was told last, and how often."""

    def __init__(self, include: list[str], exclude: list[str], window_ms: int) -> None:
        self.include, self.exclude, self.window_ms = set(include), set(exclude), window_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.value = handle.getValueState("queue", "rows string, excluded boolean, told string, version long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, excluded, told, version = self._load()
        for r in rows:
            state, ts, data = r["state"], r["micros"], r["data"]
            if state in self.exclude:
                excluded = True
            if state in self.include and (state not in first or (ts, data or "") < (first[state][0], first[state][1] or "")):
                first[state] = (ts, data)
        yield from self._settled(key, first, excluded, told, version, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settled(key, *self._load(), timerValues)

    def close(self) -> None:
        pass

    def _load(self):
        self.held = self.value.get()
        if self.held is None:
            return {}, False, "", 0
        rows, excluded, told, version = self.held
        return {s: (ts, data) for s, ts, data in json.loads(rows)}, excluded, told, version

    def _settled(self, key, first: dict, excluded: bool, told: str, version: int, timers) -> list[Row]:
        """Drop what is too old, set the timer of the oldest that is left, keep the value, and say what has changed."""
        if self.window_ms:
            now = timers.getCurrentProcessingTimeInMs()
            # a row that is too old stays as a mark without data, or an older copy of it could come in again
            first = {s: (ts, data if ts // 1000 + self.window_ms >= now else None) for s, (ts, data) in first.items()}
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            if alive := [ts for ts, data in first.values() if data is not None]:
                self.handle.registerTimer(min(alive) // 1000 + self.window_ms + 1)
        alive = sorted((s, ts, data) for s, (ts, data) in first.items() if data is not None)
        ready = not excluded and len(alive) == len(self.include)
        say = json.dumps(alive) if ready else ""
        out = []
        if say != told:
            version += 1
            at = EPOCH + dt.timedelta(microseconds=max((ts for _, ts, _ in alive), default=0))
            out.append(Row(id=key[0], version=version, ready=ready, ts=at, rows=say or "[]"))
        new = (json.dumps([(s, ts, data) for s, (ts, data) in sorted(first.items())]), excluded, say, version)
        if self.held is None or new != tuple(self.held):  # each call goes to the store
            self.value.update(new)
        return out


def changes(rows: DataFrame, include: list[str], exclude: list[str] | None = None, *, window_days: float = 0) -> DataFrame:
    """Changes of the queue as a stream, from a stream of state rows (id, state, ts, data)."""
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # rows of other states never reach the state
    some = rows.where(F.col("state").isin(sorted({*include, *(exclude or ())})) & F.col("id").isNotNull())
    keyed = some.select(F.col("id").cast("string").alias("id"), "state", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), "data").where("micros is not null").groupBy("id")
    return keyed.transformWithState(QueueProcessor(include, list(exclude or ()), int(window_days * DAY_MS)), CHANGES, "Update", "ProcessingTime" if window_days else "None")


def start(rows: DataFrame, path: str, checkpoint: str, include: list[str], exclude: list[str] | None = None, *, window_days: float = 0, every: str | None = None) -> StreamingQuery:
    """Append the changes to a folder of Parquet; with ``every`` the query stays (and timers go off), without it ends when all rows are read."""

    def append(batch: DataFrame, number: int) -> None:
        # a batch that is run again replaces what its first run left
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={number}")

    made = changes(rows, include, exclude, window_days=window_days).writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint)
    return (made.trigger(processingTime=every) if every else made.trigger(availableNow=True)).start()


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(f"{path.rstrip('/')}/part=*")


def current(told: DataFrame) -> DataFrame:
    """The ids that are ready, each with its rows as last told."""
    last = told.groupBy("id").agg(F.max_by(F.struct("ready", "ts", "rows"), "version").alias("last"))
    return last.where("last.ready").select("id", "last.ts", F.from_json("last.rows", "array<array<string>>").alias("rows"))


def merged(ready: DataFrame, fields: dict[str, str]) -> DataFrame:
    """id, ts and each payload field: of truthy values that of the latest (ts, state), as ``operators.state.get_many`` merges."""
    kinds = ", ".join(f"`{k}` {v}" for k, v in fields.items())
    rows = ready.select("id", "ts", F.transform("rows", lambda r: F.struct(r[1].cast("long").alias("at"), r[0].alias("state"), F.from_json(r[2], kinds).alias("d"))).alias("rows"))

    def best(name: str, kind: str):
        good = F.filter("rows", lambda r: truthy(r["d"][name], kind))
        top = F.array_max(F.transform(good, lambda r: F.struct(r["at"], r["state"])))
        return F.try_element_at(F.filter(good, lambda r: (r["at"] == top["at"]) & (r["state"] == top["state"])), F.lit(1))["d"][name].alias(name)

    return rows.select("id", "ts", *[best(k, v) for k, v in fields.items()])
