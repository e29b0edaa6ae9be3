"""Job-event streams whose rows depend on the order of event times.

Files arrive in any order. A job's events wait in list state until the watermark has
passed them, and are then applied by (ts, event_id): no event can come before them any
more, since Spark drops those behind the watermark. Timers wake a job when its next event
is due to be applied, or when its silence has lasted too long, so that claims and verdicts
leave the stream while it runs. State and buffers live in RocksDB, by job."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructField, StructType

#: What a session needs for keyed state with timers.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class InOrder(StatefulProcessor):
    """start() is a job's state before its first event, a tuple of `kept`; apply() takes
    the next event in order; idle() is told how far event time has come (microseconds) and
    says when it wants to be told again (milliseconds of watermark). apply and idle return
    the new state and append output rows, without the job, to `out`."""

    kept = ""
    columns: list[str] = []

    def __init__(self, event_type: str):
        self.event_type = event_type

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"at bigint, event_id {self.event_type}, state string")
        self.state = handle.getValueState("kept", self.kept.format(event=self.event_type))

    def start(self) -> tuple:
        raise NotImplementedError

    def apply(self, state: tuple, at: int, event, kind: str, out: list) -> tuple:
        raise NotImplementedError

    def idle(self, state: tuple, passed: int, out: list) -> tuple[tuple, int | None]:
        raise NotImplementedError

    def _wake(self, due: int, mark: int) -> None:
        """A timer goes off once the watermark is past it, or has reached it; either will do."""
        self.handle.registerTimer(due - 1 if due - 1 > mark else due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            new = list(zip(pdf["at"].tolist(), pdf["event_id"].tolist(), pdf["state"].where(pdf["state"].notna(), None).tolist(), strict=True))
            if new:
                self.waiting.appendList(new)
                first = min([x[0] for x in new] + ([] if first is None else [first]))
        if first is not None:
            self.handle.registerTimer(-(-first // 1000) - 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        passed, out = mark * 1000, []
        waiting = [tuple(x) for x in self.waiting.get()] if self.waiting.exists() else []
        due = sorted((x for x in waiting if x[0] <= passed), key=lambda x: x[:2])
        rest = [x for x in waiting if x[0] > passed]
        state = tuple(self.state.get()) if self.state.exists() else self.start()
        for at, event, kind in due:
            state = self.apply(state, at, event, kind, out)
        if due:
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        state, next_ = self.idle(state, passed, out)
        self.state.update(state)
        for ms in ([] if next_ is None else [next_]) + ([-(-min(x[0] for x in rest) // 1000)] if rest else []):
            self._wake(ms, mark)
        return iter([pd.DataFrame([(key[0], *x) for x in out], columns=["job_id", *self.columns])] if out else [])

    def close(self) -> None:
        pass


class StaleJobs(InOrder):
    """State: the last event if it was active, and how often the job was reclaimed."""

    kept = "event {event}, at bigint, active boolean, n int"
    columns = ["event_id", "action"]

    def __init__(self, event_type: str, ceiling_seconds: int):
        super().__init__(event_type)
        self.limit = ceiling_seconds * 1_000_000

    def start(self):
        return None, 0, False, 0

    def _judge(self, state, now, out):
        event, at, active, n = state
        if not active or now - at <= self.limit:
            return state
        out.append((event, "terminal" if n else "dispatch_again"))
        return None, 0, False, n + 1

    def apply(self, state, at, event, kind, out):
        n = self._judge(state, at, out)[3]
        return (event, at, True, n) if kind == "active" else (None, 0, False, n)

    def idle(self, state, passed, out):
        state = self._judge(state, passed, out)
        return state, (state[1] + self.limit) // 1000 + 1 if state[2] else None


class Heartbeats(InOrder):
    """State: when the job was last heard of, whether it was active then, whether its
    silence since has been told, and how often it stalled."""

    kept = "at bigint, active boolean, told boolean, stalls int"
    columns = ["noticed_us", "stalls", "verdict"]

    def __init__(self, event_type: str, gap_seconds: int, most: int):
        super().__init__(event_type)
        self.gap, self.most = gap_seconds * 1_000_000, most

    def start(self):
        return 0, False, False, -1

    def _tell(self, at, stalls, out):
        out.append((at, stalls, "failed" if stalls > self.most else "stalled" if stalls else "alive"))

    def _listen(self, state, now, out):
        at, active, told, stalls = state
        if not active or told or now - at <= self.gap:
            return state
        self._tell(at + self.gap, stalls + 1, out)
        return at, active, True, stalls + 1

    def apply(self, state, at, event, kind, out):
        stalls = self._listen(state, at, out)[3]
        if stalls < 0:
            stalls = 0
            self._tell(at, 0, out)
        return at, kind == "active", False, stalls

    def idle(self, state, passed, out):
        state = self._listen(state, passed, out)
        return state, (state[0] + self.gap) // 1000 + 1 if state[1] and not state[2] else None


def _by_job(events: DataFrame, late: str, processor: InOrder, more: list[StructField], mode: str = "append") -> DataFrame:
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).filter("ts is not null and event_id is not null").withWatermark("ts", late)
    rows = rows.select("job_id", "event_id", "state", "ts", F.unix_micros("ts").alias("at"))
    schema = StructType([StructField("job_id", events.schema["job_id"].dataType), *more])
    return rows.groupBy("job_id").transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode="eventtime")


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def reclaim_stale(events: DataFrame, ceiling_seconds: int, late: str = "10 minutes") -> DataFrame:
    """Streaming form of `runs.stale`: job_id, event_id, action. An active event that
    nothing follows within the ceiling, by event time, is dispatched again the first time
    and ends the job the next. Files may come in any order within `late`; job and event ids
    keep the input's types; rows without a time or an id are left out. Needs STATE_STORE."""
    event = events.schema["event_id"]
    return _by_job(events, late, StaleJobs(event.dataType.simpleString(), ceiling_seconds), [StructField("event_id", event.dataType), *_fields("action string")])


def live_verdicts(events: DataFrame, gap_seconds: int, most: int = 2, late: str = "10 minutes") -> DataFrame:
    """Streaming form of `rows.liveness_verdicts(..., last=True)`: job_id, noticed_us, stalls,
    verdict. A job's first event says alive; each silence longer than the gap while it was
    active says stalled, and after `most` of them failed, as soon as the watermark has
    passed the gap, whether or not the job is heard of again. Needs STATE_STORE."""
    return _by_job(events, late, Heartbeats(events.schema["event_id"].dataType.simpleString(), gap_seconds, most), _fields("noticed_us bigint, stalls bigint, verdict string"))


def verdicts_now(told: DataFrame) -> DataFrame:
    """Each job's last verdict, from what `live_verdicts` has sent so far."""
    return told.groupBy("job_id").agg(F.max("stalls").alias("stalls"), F.max_by("verdict", "stalls").alias("verdict"))
