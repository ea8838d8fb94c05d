"""Task streams: draining a queue, idempotent claims, leases with redelivery and dead letters, liveness and long operations."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LEASE_S, RECEIVES = 450, 3


def queue(spark: SparkSession, folder: str, schema, glob: str = "*", files_per_batch: int | None = None) -> DataFrame:
    """A folder of Parquet files as a queue; back-pressure is the number of files a batch takes."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Processes all that waits, batch by batch, and stops. A batch that failed comes again with the same number, so ``handle`` should write by it."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drained(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Drains into a folder, a subfolder per batch that a repeated batch overwrites, and reads it all."""
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    drain(stream, write, checkpoint)
    return stream.sparkSession.read.schema(schema).parquet(f"{out}/batch=*")


def claims(stream: DataFrame, key: list[str], time_col: str, retention: str = "10 days") -> DataFrame:
    """The first message of each key; state is kept for the retention of the queue, so it doesn't grow for ever."""
    return stream.withWatermark(time_col, retention).dropDuplicatesWithinWatermark(key)


def liveness(stream: DataFrame, worker_col: str, time_col: str) -> DataFrame:
    """The last sign of life of each worker (complete mode)."""
    return stream.groupBy(worker_col).agg(F.max(time_col).alias("last_seen"), F.count("*").alias("n"))


State = tuple[float, int]  # hidden until, receives
NEW: State = (0.0, 0)


def lease_step(state: State, at: float, action: str, lease: float = LEASE_S, receives: int = RECEIVES) -> tuple[State, str]:
    """What becomes of a message: delivered, hidden, extended, acked, stale or dead. Once acked or dead it is gone: what comes under its id later is a new message."""
    hidden, n = state
    if action in ("ack", "extend"):
        if not n or at > hidden:
            return state, "stale"
        return (NEW, "acked") if action == "ack" else ((at + lease, n), "extended")
    if n and at < hidden:
        return state, "hidden"
    if n >= receives:
        return NEW, "dead"
    return (at + lease, n + 1), "delivered"


def lease_outcomes(rows: list[tuple[float, str]], lease: float = LEASE_S, receives: int = RECEIVES) -> list[str]:
    """The outcomes of all that happens to one message, in the order of (at, action)."""
    state, out = NEW, []
    for at, action in rows:
        state, outcome = lease_step(state, float(at), action, lease, receives)
        out.append(outcome)
    return out


def leases(stream: DataFrame, lease: float = LEASE_S, receives: int = RECEIVES, retention_s: float = 10 * 86_400) -> DataFrame:
    """(message_id, at, outcome) of a stream of (message_id, at in seconds, action). The state of a message goes when it is acked or dead, and else when nothing was heard of it
    for the retention of the queue, so it doesn't grow for ever."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        own, out = (tuple(state.get) if state.exists else NEW), []
        rows = pd.concat(list(frames)).sort_values(["at", "action"])
        for at, action in zip(rows["at"], rows["action"]):
            own, outcome = lease_step(own, float(at), action, lease, receives)
            out.append((key[0], float(at), outcome))
        if own == NEW:
            if state.exists:
                state.remove()
        else:
            state.update(own)
            state.setTimeoutTimestamp(int((max(rows["at"].max(), state.getCurrentWatermarkMs() / 1000) + retention_s) * 1000))
        yield pd.DataFrame(out, columns=["message_id", "at", "outcome"])

    timed = stream.withColumn("ts", F.timestamp_seconds("at")).withWatermark("ts", f"{int(retention_s)} seconds")  # what comes later than the retention belongs to no message
    return timed.groupBy("message_id").applyInPandasWithState(step, "message_id long, at double, outcome string", "hidden double, receives int", "append", GroupStateTimeout.EventTimeTimeout)


def run_until_idle(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, empty_polls: int = 6, interval_s: float = 20.0, after: Callable[[], bool] = lambda: False) -> int:
    """Polls a queue and processes what it has; stops after so many polls in a row that found nothing, never if that is 0 or less, or once ``after`` says so (a signal to end: the batch
    at work is finished). Returns the number of batches. A batch that failed comes again with the same number."""
    state = {"batches": 0, "empty": 0}

    def work(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            handle(batch, number)
            state["batches"] += 1
            state["empty"] = 0

    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(processingTime=f"{interval_s} seconds").start()
    try:
        while not query.awaitTermination(interval_s):
            busy = query.status["isTriggerActive"] and query.status["isDataAvailable"]
            state["empty"] += not busy
            if after() or 0 < empty_polls <= state["empty"]:
                break
    finally:
        query.stop()
    return state["batches"]


class QuotaError(Exception):
    """The service takes no more for now."""


class Clock:
    """The time of day; tests replace it."""

    def now(self) -> float:
        return time.time()

    def sleep(self, seconds: float) -> None:
        time.sleep(seconds)


@dataclass
class Operation:
    """A batch at a service: pending, submitted, completed or failed."""

    name: str
    status: str = "pending"
    attempts: int = 0
    error: str | None = None


def run_operations(
    names: list[str], submit: Callable[[str], None], check: Callable[[str], tuple[bool, str | None]], written: Callable[[str], bool] = lambda error: False, clock: Clock | None = None, in_flight: int = 8, retries: int = 5,
    pause: float = 60.0, factor: float = 1.5, most: float = 900.0, timeout: float = 10_800.0, poll: float = 30.0,
) -> tuple[list[Operation], int]:
    """(operations, pauses): submits batches, so many in flight at most, and polls until all are completed or failed.

    A quota error pauses all submissions, longer each time in a row. A batch whose submission fails otherwise is tried again until its retries are used up. An operation that
    reports an error failed, unless ``written`` says that its output is there all the same; an error of a poll means nothing. Beyond the time allowed TimeoutError is raised."""
    clock = clock or Clock()
    ops, deadline, until, in_a_row, pauses = [Operation(n) for n in names], clock.now() + timeout, 0.0, 0, 0
    while any(o.status in ("pending", "submitted") for o in ops):
        if clock.now() > deadline:
            raise TimeoutError(f"not done after {timeout:.0f} s")
        if clock.now() >= until:
            running = sum(o.status == "submitted" for o in ops)
            for o in [o for o in ops if o.status == "pending"][: max(0, in_flight - running)]:
                try:
                    submit(o.name)
                    o.status, in_a_row = "submitted", 0
                except QuotaError:
                    in_a_row, pauses = in_a_row + 1, pauses + 1
                    until = clock.now() + min(pause * factor ** (in_a_row - 1), most)
                    break
                except Exception as e:
                    o.attempts += 1
                    if o.attempts >= retries:
                        o.status, o.error = "failed", f"submit failed after {o.attempts} attempts: {e}"
        for o in [o for o in ops if o.status == "submitted"]:
            try:
                done, error = check(o.name)
            except Exception:
                continue
            if done and error and not written(error):
                o.status, o.error = "failed", error
            elif done:
                o.status = "completed"
        if any(o.status in ("pending", "submitted") for o in ops):
            clock.sleep(poll)
    return ops, pauses
