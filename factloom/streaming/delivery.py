"""Delivery of commits with attempts, timed retries and expiry, as arbitrary state with timers (L4)."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# Seconds of backoff by attempt, the last attempt, and the results that end a file's delivery.
BACKOFF, MAX_ATTEMPTS = (30, 60, 120, 300), 5
TERMINAL = ("indexed", "skipped-empty", "skipped-media", "skipped-indexed", "skipped-no-index")

_OUT = "sha string, attempt int, action string, retry_after int, at timestamp"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Delivery(StatefulProcessor):
    """State of one commit: the attempt, when its retry is due and when it is given up, in milliseconds of event time."""

    def __init__(self, expiry_ms: int):
        self.expiry_ms = expiry_ms

    def init(self, handle) -> None:  # noqa: ANN001
        self.handle = handle
        self.state = handle.getValueState("delivery", "attempt int, due long, over long")

    def _get(self) -> tuple[int, int, int]:
        return self.state.get() if self.state.exists() else (0, 0, 0)

    def _end(self, due: int, over: int) -> None:
        for t in (due, over):
            if t:
                self.handle.deleteTimer(t)
        self.state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        attempt, due, over = self._get()
        got = pd.concat(list(rows)).sort_values("ts", kind="stable")  # what one batch has of one commit
        out = []
        for row in got.itertuples():
            now = int(row.ts.timestamp() * 1000)
            attempt += 1
            statuses = row.statuses if row.statuses is not None else []
            done = all(s in TERMINAL for s in statuses)
            dead = not done and attempt >= MAX_ATTEMPTS
            wait = None if done or dead else BACKOFF[min(attempt, len(BACKOFF)) - 1]
            out.append(_row(key, attempt, "ack" if done else "dead_letter" if dead else "wait", wait, now))
            self._end(due, over)
            if wait is None:
                attempt, due, over = 0, 0, 0
            else:
                due = now + wait * 1000
                over = max(now + self.expiry_ms, due + 1)
                for t in (due, over):
                    self.handle.registerTimer(t)
                self.state.update((attempt, due, over))
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        attempt, due, over = self._get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        if attempt and at == due:
            self.state.update((attempt, 0, over))
            out.append(_row(key, attempt, "retry", None, at))
        elif attempt and at == over:
            self._end(due, 0)
            out.append(_row(key, attempt, "expired", None, at))
        yield _frame(out)

    def close(self) -> None:
        pass


def _row(key: tuple, attempt: int, action: str, wait: int | None, at: int) -> tuple:
    return key[0], attempt, action, wait, datetime.fromtimestamp(at / 1000, timezone.utc)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["sha", "attempt", "action", "retry_after", "at"])
    return out.astype({"attempt": "int32", "retry_after": "Int32", "at": "datetime64[ns, UTC]"})


def delivery_stream(outcomes: DataFrame, expiry: int = 3600, lateness: str = "10 minutes") -> DataFrame:
    """outcomes(sha, statuses[, ts]), the results of all files of a commit at each attempt -> (sha, attempt, action, retry_after, at).

    `ack` when every file of the attempt is terminal (also when it has no files), `dead_letter` at the fifth attempt that isn't;
    else `wait` with the seconds of backoff, and `retry` when they are over. `expired` where nothing came for `expiry`
    seconds after a failed attempt. The state ends with ack, dead letter and expiry; what comes later is a first attempt.

    The clock is that of the events, ts, behind by `lateness`; without ts it is the time at which an outcome arrives. Timers fire as
    the clock moves with later outcomes, so a run over all that is available ends. Timers need the RocksDB state store: it is
    set for the session if it isn't.
    """
    conf = outcomes.sparkSession.conf
    if conf.get("spark.sql.streaming.stateStore.providerClass", "") != _ROCKS:
        conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    if "ts" not in outcomes.columns:
        outcomes, lateness = outcomes.withColumn("ts", F.current_timestamp()), "0 seconds"
    return outcomes.withWatermark("ts", lateness).groupBy("sha").transformWithStateInPandas(Delivery(expiry * 1000), _OUT, "append", "EventTime")
