"""State machines for `transformWithState`: sessions closed by timers, first events with a time to live.

They need the RocksDB state store (`with_rocksdb`), which keeps state on disk and
uploads its changes to the checkpoint.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_rocksdb(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


class Sessions(StatefulProcessor):
    """One open session per key: bounds and size as a value, events by kind as a map.

    Rows of a batch come in any order; they are taken by time.  State is read once and
    written once for a key and batch, not for each event.  An event after the gap
    closes the open session.  A timer one gap after the last event closes it when the
    watermark gets there, so an idle key leaves no state.
    """

    def __init__(self, key: str, ts: str, kind: str, gap_ms: int):
        self.key, self.ts, self.kind, self.gap_ms = key, ts, kind, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        bounds = StructType([StructField(n, LongType()) for n in ("first", "last", "n")])
        self.open = handle.getValueState("open", bounds)
        self.kinds = handle.getMapState("kinds", StructType([StructField("kind", StringType())]), StructType([StructField("n", LongType())]))

    def _row(self, key, state: tuple, kinds: int) -> dict:
        first, last, n = state
        return {self.key: key, "session_start": pd.Timestamp(first, unit="us"), "session_end": pd.Timestamp(last, unit="us"), "events": n, "kinds": kinds}

    def _closed(self, key) -> dict:
        row = self._row(key, self.open.get(), sum(1 for _ in self.kinds.keys()))
        self.open.clear()
        self.kinds.clear()
        return row

    def _frame(self, rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[self.key, "session_start", "session_end", "events", "kinds"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = [e for batch in rows for e in zip(batch[self.ts].astype("datetime64[us]").astype("int64").tolist(), batch[self.kind].tolist())]
        closed, state = [], self.open.get() if self.open.exists() else None
        before = state[1] if state else None
        stored = state is not None  # the map holds kinds of the open session
        seen: Counter = Counter()  # those of this batch
        for micros, kind in sorted(events, key=lambda e: (e[0], e[1] or "")):
            first, last, n = state or (micros, micros, 0)
            if micros - last > self.gap_ms * 1000:
                kinds = {k[0] for k in self.kinds.keys()} if stored else set()
                closed.append(self._row(key[0], state, len(kinds | seen.keys())))
                if stored:
                    self.kinds.clear()
                stored, seen, first, last, n = False, Counter(), micros, micros, 0
            state = (min(first, micros), max(last, micros), n + 1)
            seen["" if kind is None else kind] += 1
        self.open.update(state)
        for kind, times in seen.items():
            known = stored and self.kinds.containsKey((kind,))
            self.kinds.updateValue((kind,), (times + (self.kinds.getValue((kind,))[0] if known else 0),))
        if before is not None and before != state[1]:
            self.handle.deleteTimer(before // 1000 + self.gap_ms + 1)
        if before != state[1]:
            self.handle.registerTimer(state[1] // 1000 + self.gap_ms + 1)
        if closed:
            yield self._frame(closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._frame([self._closed(key[0])] if self.open.exists() else [])

    def close(self) -> None:
        pass


def timed_sessions(df: DataFrame, key: str, ts: str, kind: str, gap_seconds: int, delay: str = "10 minutes") -> DataFrame:
    """`key, session_start, session_end, events, kinds` of a stream, each session once, when it is over."""
    with_rocksdb(df.sparkSession)
    layout = f"{key} {df.schema[key].dataType.simpleString()}, session_start timestamp, session_end timestamp, events bigint, kinds bigint"
    rows = df.select(key, ts, kind).withWatermark(ts, delay)
    return rows.groupBy(key).transformWithStateInPandas(Sessions(key, ts, kind, gap_seconds * 1000), layout, "Append", "eventTime")


class FirstSeen(StatefulProcessor):
    """Lets the first row of a key pass; the key is forgotten `ttl_ms` after that, by the clock."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", StructType([StructField("n", LongType())]), ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, first = self.seen.exists(), None
        for batch in rows:  # all of them, or the next key's rows do not come
            if first is None:
                first = batch.head(0 if known else 1)
        if not known:
            self.seen.update((1,))
        yield first

    def close(self) -> None:
        pass


def first_seen(df: DataFrame, key: str, ttl_seconds: float) -> DataFrame:
    """The first row of each key for as long as its state lives.

    Time to live goes by the clock, and such a stream has a batch at every trigger: it
    is stopped by its owner, and a run over what is there does not end by itself.
    """
    with_rocksdb(df.sparkSession)
    return df.groupBy(key).transformWithStateInPandas(FirstSeen(int(ttl_seconds * 1000)), df.schema, "Append", "processingTime")
