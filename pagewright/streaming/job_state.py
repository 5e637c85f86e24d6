"""Jobs as state machines: events move a job through stages and statuses, in a stream or in a batch.

One step function serves both. A move is legal within a stage as MOVES says, and from a completed
stage to the next one's first statuses; anything else is told and leaves the job as it is. An event
that is not after the job's last one (by time, then number) is told as late, one with the last one's
number as repeated. A job without an event for EXPIRES seconds is forgotten: its next event begins
anew. So the state of a job is its last event's stage, status, time and number and a few counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.operators.jobs import STAGES, STATES

PENDING, PROCESSING, COMPLETED, FAILED = STATES
#: Legal moves of a stage: from a status to others. A failed stage may be tried again.
MOVES = {PENDING: (PROCESSING, FAILED), PROCESSING: (PROCESSING, COMPLETED, FAILED), FAILED: (PENDING, PROCESSING), COMPLETED: ()}
#: Seconds without an event after which a job is forgotten.
EXPIRES = 7 * 24 * 3600


class State(NamedTuple):
    stage: str
    status: str
    at: int  # microseconds
    event_id: int
    moves: int
    illegal: int


def legal(stage: str, status: str, to_stage: str, to_status: str) -> bool:
    if stage == to_stage:
        return to_status in MOVES.get(status, ())
    following = STAGES.index(stage) + 1
    return status == COMPLETED and following < len(STAGES) and to_stage == STAGES[following] and to_status in (PENDING, PROCESSING)


def step(state: State | None, stage: str | None, status: str | None, at: int, event_id: int, expires: int = EXPIRES) -> tuple[State | None, str]:
    """The state after an event, and what became of it: begun, moved, illegal, unknown, late or repeated."""
    if state is not None and at - state.at > expires * 1_000_000:
        state = None
    if state is not None and event_id == state.event_id:
        return state, "repeated"
    if state is not None and (at, event_id) < (state.at, state.event_id):
        return state, "late"
    if stage not in STAGES or status not in STATES:
        return state, "unknown"
    if state is None:
        return State(stage, status, at, event_id, 1, 0), "begun"
    if legal(state.stage, state.status, stage, status):
        return State(stage, status, at, event_id, state.moves + 1, state.illegal), "moved"
    return state._replace(at=at, event_id=event_id, illegal=state.illegal + 1), "illegal"


#: What became of each event, and the job after it.
TOLD = "job_id long, event_id long, ts timestamp, told string, stage string, status string, moves long, illegal long"
_KINDS = [pa.int64(), pa.int64(), pa.timestamp("us", "UTC"), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
NAMES = [c.split()[0] for c in TOLD.split(", ")]


def _told(job: Any, event: tuple, state: State | None, told: str) -> tuple:
    at, event_id = event
    return (job, event_id, at, told, *((state.stage, state.status, state.moves, state.illegal) if state else (None, None, 0, 0)))


def fold(events: DataFrame, expires: int = EXPIRES) -> DataFrame:
    """TOLD for all of events (job_id, event_id, ts, stage, status), each job's in order. Jobs are dealt
    to tasks and sorted; a task keeps one job's state at a time, so a job of any size is read through.

    Rows with a null job_id, ts or event_id belong to no job and are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job, state = None, None
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(2).cast(pa.int64()), batch.column(3), batch.column(4))]
            for j, event_id, at, stage, status in zip(*columns, strict=True):
                if j != job:
                    job, state = j, None
                state, told = step(state, stage, status, at, event_id, expires)
                out.append(_told(j, (at, event_id), state, told))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()).cast(k) if pa.types.is_timestamp(k) else pa.array(c, k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)], names=NAMES)

    rows = events.select(F.col("job_id").cast("long"), F.col("event_id").cast("long"), F.col("ts").cast("timestamp"), "stage", "status").filter("job_id is not null and ts is not null and event_id is not null")
    return rows.repartition("job_id").sortWithinPartitions("job_id", "ts", "event_id").mapInArrow(run, TOLD)


def latest(told: DataFrame) -> DataFrame:
    """Per job of TOLD its stage, status and counts after its last event that was neither late nor repeated."""
    rows = told.filter(~F.col("told").isin("late", "repeated"))
    last = F.max_by(F.struct("stage", "status", "moves", "illegal"), F.struct("ts", "event_id")).alias("s")
    return rows.groupBy("job_id").agg(last, F.count("*").alias("n_events")).select("job_id", "s.*", "n_events")


def state_stream(events: DataFrame, expires: int = EXPIRES, late: str = "1 hour") -> DataFrame:
    """TOLD for a stream of events: each job's state is kept between micro-batches, and dropped by a
    timer once the watermark has passed its last event by expires seconds. Needs RocksDB as the state
    store (rocksdb_state)."""
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class Jobs(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("job", "stage string, status string, at long, event_id long, moves long, illegal long")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
            state = State(*self.state.get()) if self.state.exists() else None
            # a micro-batch's events of a job, which may come in several frames, in their order
            batch = pd.concat(list(rows)).sort_values(["at", "event_id"], kind="stable")
            out = []
            for at, event_id, stage, status in batch[["at", "event_id", "stage", "status"]].itertuples(index=False):
                state, told = step(state, stage, status, int(at), int(event_id), expires)
                out.append(_told(int(key[0]), (int(at), int(event_id)), state, told))
            if state is not None:
                self.state.update(tuple(state))
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(max(state.at // 1000 + expires * 1000, timerValues.getCurrentWatermarkInMs() + 1))
            frame = pd.DataFrame(out, columns=NAMES)
            yield frame.assign(ts=pd.to_datetime(frame["ts"], unit="us"))

        def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
            self.state.clear()
            yield pd.DataFrame({n: [] for n in NAMES})

        def close(self) -> None:
            pass

    rows = events.select(F.col("job_id").cast("long").alias("job_id"), F.col("event_id").cast("long").alias("event_id"), F.col("ts").cast("timestamp").alias("ts"), "stage", "status")
    rows = rows.filter("job_id is not null and ts is not null and event_id is not null").withWatermark("ts", late).withColumn("at", F.unix_micros("ts"))
    return rows.groupBy("job_id").transformWithStateInPandas(statefulProcessor=Jobs(), outputStructType=TOLD, outputMode="Append", timeMode="EventTime")


def rocksdb_state(spark: Any) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def replay(events: Iterable[tuple], expires: int = EXPIRES) -> list[tuple]:
    """What fold() tells, of (job_id, event_id, at, stage, status) in plain Python, for one job after
    another."""
    out, states = [], {}
    for job, event_id, at, stage, status in events:
        states[job], told = step(states.get(job), stage, status, at, event_id, expires)
        out.append(_told(job, (at, event_id), states[job], told))
    return out
