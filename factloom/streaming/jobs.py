"""The event stream as Structured Streaming jobs, each with a batch twin where tests compare them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.streaming.delivery import BACKOFF, MAX_ATTEMPTS, TERMINAL


def parse_triggers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L2: raw(value) -> (triggers(sha, ts, source), poison(value)): messages without a readable sha part."""
    j = F.from_json("value", "sha string, ts timestamp, source string")
    q = raw.select("value", j.alias("j"))
    bad = F.coalesce(F.col("j.sha"), F.lit("")) == ""
    return q.where(~bad).select("j.*"), q.where(bad).select("value")


def dedup_triggers(triggers: DataFrame, seconds: int = 120) -> DataFrame:
    """L1: each sha once within the window of event time."""
    return triggers.withWatermark("ts", f"{seconds} seconds").dropDuplicatesWithinWatermark(["sha"])


def changed_files(triggers: DataFrame, changes: DataFrame) -> DataFrame:
    """L3: stream-static join to the changes of each commit without deletions and media; an unknown commit
    has a null path and resolved false (to be tried again), one without changes has no rows."""
    from factloom.functions import text as T

    known = changes.select("commit").distinct().withColumn("known", F.lit(True))
    live = changes.where((F.col("status") != "D") & ~T.is_media(F.col("path"))).select("commit", "path")
    q = triggers.join(known, triggers["sha"] == known["commit"], "left").select("sha", "ts", F.coalesce("known", F.lit(False)).alias("resolved"))
    return q.join(live, q["sha"] == live["commit"], "left").where("not resolved or path is not null").select("sha", "ts", "resolved", "path")


def delivery_state(attempts: DataFrame) -> DataFrame:
    """L4, batch twin: attempts(sha, attempt, statuses array) -> (sha, attempt, action, retry_after): ack when
    every file of the last attempt is terminal, else retry by backoff, dead letter from the fifth on. A delivery
    without an attempt so far (0) is retried as after the first."""
    last = attempts.groupBy("sha").agg(F.max(F.struct("attempt", "statuses")).alias("a"))
    done = F.forall("a.statuses", lambda s: s.isin(*TERMINAL))
    dead = F.col("a.attempt") >= MAX_ATTEMPTS
    # No attempt yet (0) waits as long as the first.
    wait = F.get(F.array(*map(F.lit, BACKOFF)), F.greatest(F.least(F.col("a.attempt"), F.lit(len(BACKOFF))) - 1, F.lit(0)))
    return last.select(
        "sha",
        F.col("a.attempt").alias("attempt"),
        F.when(done, "ack").when(dead, "dead_letter").otherwise("retry").alias("action"),
        F.when(~done & ~dead, wait).alias("retry_after"),
    )


def awaited_results(commits: DataFrame, outcomes: DataFrame, within: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """commits(commit, path, ts) with outcomes(commit, path, result, done_at) that came within the bound; `missing` where
    none did. As streams, a row without outcome comes out once both have moved past the bound; state ends with it.
    """
    c = commits.withWatermark("ts", lateness).alias("c")
    o = outcomes.withWatermark("done_at", lateness).alias("o")
    same = (F.col("c.commit") == F.col("o.commit")) & (F.col("c.path") == F.col("o.path"))
    soon = (F.col("o.done_at") >= F.col("c.ts")) & (F.col("o.done_at") <= F.col("c.ts") + F.expr(f"interval {within}"))
    return c.join(o, same & soon, "left").select("c.commit", "c.path", "c.ts", F.coalesce("o.result", F.lit("missing")).alias("result"), "o.done_at")


def live_counts(events: DataFrame, window: str = "1 hour", slide: str | None = None, watermark: str = "24 hours") -> DataFrame:
    """Events per stage and status in tumbling (or sliding) windows; late rows beyond the watermark don't count."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    late = events.withWatermark("ts", watermark) if events.isStreaming else events
    return late.groupBy(w.alias("w"), "stage", "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "stage", "status", "n")


def activity(events: DataFrame, minutes: int = 15, watermark: str = "24 hours") -> DataFrame:
    """Sessions of events; where one ends, nothing came for `minutes`.

    As a batch, the sessions of each hour are made first and then joined over the hours, so that a component
    with most of the events meets in one task with a few rows an hour only.
    """
    s = F.session_window("ts", f"{minutes} minutes")
    if not events.isStreaming:
        hours = events.groupBy(s.alias("s"), "component", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"))
        hours = hours.select("component", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")
        order = Window.partitionBy("component").orderBy("start", "end")
        seen = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        new = F.when(F.col("start") < seen, 0).otherwise(1)
        parts = hours.withColumn("new", new).withColumn("nth", F.sum("new").over(order))
        return parts.groupBy("component", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("nth")
    late = events.withWatermark("ts", watermark)
    return late.groupBy(s.alias("s"), "component").agg(F.count("*").alias("n")).select("component", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def dedup_batch(triggers: DataFrame, key: str, seconds: int = 120) -> DataFrame:
    """L1, batch twin: a trigger stays if none of its sha was kept within the `seconds` before it; one that is
    left out doesn't prolong the window. Ties of ts go by key, which is unique.

    A pause of more than `seconds` always starts anew, so the runs between two pauses are dealt over tasks. Each task goes
    through its sorted rows once and holds no run; the next trigger that stays is found by bisection in the batch at hand.
    """
    order = Window.partitionBy("sha").orderBy("ts", key)
    at = F.unix_timestamp("ts")
    pause = F.coalesce(at - F.lag(at).over(order) > seconds, F.lit(True)).cast("int")
    runs = triggers.select("sha", "ts", F.col(key).cast("string").alias("_k"), key, at.alias("_at"), pause.alias("_pause")).withColumn("_run", F.sum("_pause").over(order))
    rows = runs.repartition("sha", "_run").sortWithinPartitions("sha", "_run", "ts", key).select("sha", "_run", "_at", "_k")

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, kept = None, None
        for f in frames:
            if f.empty:
                continue
            at, sha, run = (f[c].to_numpy() for c in ("_at", "sha", "_run"))
            new = np.append(last != (sha[0], run[0]), (sha[1:] != sha[:-1]) | (run[1:] != run[:-1]))
            edges, stay = np.unique([0, *np.flatnonzero(new), len(f)]), []
            for a, z in zip(edges.tolist(), edges[1:].tolist(), strict=False):
                kept = None if new[a] else kept
                while a < z:
                    a += 0 if kept is None else int(np.searchsorted(at[a:z], kept + seconds, "right"))
                    if a < z:
                        stay.append(a)
                        kept = at[a]
                        a += 1
            last = (sha[-1], run[-1])
            yield f.iloc[stay][["sha", "_k"]]

    kept = rows.mapInPandas(walk, "sha string, _k string").withColumnRenamed("sha", "_sha")
    return triggers.join(kept, triggers["sha"].eqNullSafe(kept["_sha"]) & (triggers[key].cast("string") == kept["_k"]), "left_semi")
