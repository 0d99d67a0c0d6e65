"""Pipeline events, status and alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import text as T


def stage_status_counts(events: DataFrame) -> DataFrame:
    """D3: events per stage and status."""
    return events.groupBy("stage", "status").agg(F.count("*").alias("n"))


def failure_totals(events: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Failed and skipped events, failed in the trailing window, newest indexed/ok time. One row."""
    since = F.lit(as_of) - F.expr(f"interval {int(hours)} hours")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return events.agg(
        count(F.col("status") == "failed").alias("failed"),
        count(F.col("status") == "skipped").alias("skipped"),
        count((F.col("status") == "failed") & (F.col("ts") >= since) & (F.col("ts") <= F.lit(as_of))).alias("failed_recent"),
        F.max(F.when((F.col("stage") == "indexed") & (F.col("status") == "ok"), F.col("ts"))).alias("last_indexed"),
    )


def dead_letters(events: DataFrame, statuses: tuple[str, ...] = ("failed", "skipped"), n: int = 50) -> DataFrame:
    """The newest n events of these statuses."""
    return events.where(F.col("status").isin(list(statuses))).orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def recent_problems(events: DataFrame, n: int = 10) -> DataFrame:
    """H4: failures, newest first, then skips, up to n rows."""
    rank = F.when(F.col("status") == "failed", 0).when(F.col("status") == "skipped", 1)
    return events.withColumn("rank", rank).where("rank is not null").orderBy("rank", F.desc("ts"), F.desc("event_id")).limit(n)


def timelines(events: DataFrame) -> DataFrame:
    """events in order within each hash, with the seconds since the one before. Null hashes stay out."""
    w = Window.partitionBy("sha256").orderBy("ts", "event_id")
    lag = F.lag("ts").over(w)
    return events.where("sha256 is not null").select(
        "sha256", "event_id", "stage", "status", F.row_number().over(w).alias("step"), (F.unix_timestamp("ts") - F.unix_timestamp(lag)).alias("seconds_since")
    )


def trace(events: DataFrame, keys: DataFrame) -> DataFrame:
    """C17: for each key, all events of any hash that an event with that doc_id, raw_path or sha256 has.

    A key without any hash gives the events that match it themselves. keys(key).
    """
    keys = keys.select("key").distinct()
    each = events.select("event_id", "sha256", F.explode(F.array_distinct(F.array_compact(F.array("doc_id", "raw_path", "sha256")))).alias("key"))
    seeds = each.join(keys, "key")
    shas = seeds.where("sha256 is not null").select("key", "sha256").distinct()
    by_sha = shas.join(events.select("sha256", "event_id"), "sha256").select("key", "event_id")
    direct = seeds.join(shas.select("key").distinct(), "key", "left_anti").select("key", "event_id")
    return by_sha.unionByName(direct).distinct()


def worst_status(components: DataFrame) -> DataFrame:
    """The worst of the components' statuses: ok, degraded, down."""
    rank = F.when(F.col("status") == "down", 2).when(F.col("status") == "degraded", 1).otherwise(0)
    top = F.coalesce(F.max(rank), F.lit(0))
    return components.agg(F.when(top == 2, "down").when(top == 1, "degraded").otherwise("ok").alias("status"))


def freshness(events: DataFrame, as_of: datetime, minutes: int = 15) -> DataFrame:
    """Whether the newest event is at most `minutes` old."""
    age = F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp(F.max("ts"))
    return events.agg(age.alias("age_s"), F.when(age <= minutes * 60, "fresh").otherwise("stale").alias("verdict"))


def outages(events: DataFrame, minutes: int = 15) -> DataFrame:
    """L8, batch twin: gaps over `minutes` without any event: (gap_start, gap_end).

    Gaps inside an hour are found there; only each hour's first and last event meet in one window.
    """
    t = events.where("ts is not null").select("ts", F.date_trunc("hour", "ts").alias("hour"))
    inner = t.withColumn("prev", F.lag("ts").over(Window.partitionBy("hour").orderBy("ts"))).select("prev", "ts")
    ends = t.groupBy("hour").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    outer = ends.select(F.lag("last").over(Window.orderBy("hour")).alias("prev"), F.col("first").alias("ts"))
    gap = F.unix_timestamp("ts") - F.unix_timestamp("prev")
    return inner.unionByName(outer).where(gap > minutes * 60).select(F.col("prev").alias("gap_start"), F.col("ts").alias("gap_end"))


def status_ladder() -> Column:
    """The first rung that holds, over indexed, no_index, raw_path, present, extract_error, content, sink_ok, error."""
    return (
        F.when(F.col("indexed"), "skipped-indexed")
        .when(F.coalesce("no_index", F.lit(False)), "skipped-no-index")
        .when(T.is_media(F.col("raw_path")), "skipped-media")
        .when(~F.col("present"), "missing-file")
        .when(F.col("extract_error").isNotNull(), "extract-failed")
        .when(F.trim(F.coalesce("content", F.lit(""))) == "", "skipped-empty")
        .when(F.col("error").isNotNull(), "error")
        .when(~F.coalesce("sink_ok", F.lit(True)), "sink-failed")
        .otherwise("indexed")
    )


def ladder_events(docs: DataFrame) -> DataFrame:
    """The events that documents of each status emit, in order: (raw_path, seq, stage, event_status)."""

    def steps(*pairs: str) -> Column:
        return F.array(*[F.struct(F.lit(p.split("/")[0]).alias("stage"), F.lit(p.split("/")[1]).alias("event_status")) for p in pairs])

    s = F.col("status")
    plan = (
        F.when(s == "indexed", steps("received/started", "extracted/ok", "enriched/ok", "indexed/ok"))
        .when(s.isin("skipped-indexed", "skipped-no-index", "skipped-media"), steps("received/skipped"))
        .when(s == "missing-file", steps("received/failed"))
        .when(s == "extract-failed", steps("received/started", "extracted/failed"))
        .when(s == "skipped-empty", steps("received/started", "extracted/skipped"))
        .when(s == "sink-failed", steps("received/started", "extracted/ok", "enriched/ok", "indexed/failed"))
        .otherwise(steps("received/started", "extracted/ok", "enriched/failed"))
    )
    return docs.withColumn("status", status_ladder()).select("raw_path", "status", F.posexplode(plan).alias("seq", "e")).select("raw_path", "status", "seq", "e.*")


def tally(docs: DataFrame) -> DataFrame:
    """Documents by status; what is no known status counts as failure."""
    known = F.col("status").isin("indexed", "skipped-empty", "skipped-media", "skipped-indexed", "skipped-no-index", "missing-file")
    return docs.groupBy(F.when(known, F.col("status")).otherwise("failures").alias("status")).agg(F.count("*").alias("n"))


def exposure_summary(exposed: DataFrame, first: int = 5) -> DataFrame:
    """Incidents, noise, and the first few paths of each kind of severity."""
    nth = F.row_number().over(Window.partitionBy("severity").orderBy("raw_path"))
    heads = exposed.withColumn("nth", nth).where(F.col("nth") <= first)
    listed = heads.groupBy("severity").agg(F.array_join(F.sort_array(F.collect_list("raw_path")), ",").alias("first_paths"))
    return exposed.groupBy("severity").agg(F.count("*").alias("n")).join(listed, "severity")


def system_status(figures: DataFrame, max_failures: int = 0) -> DataFrame:
    """One row figures(failed, missing, incidents, skipped, stale) -> the same with status, checks, alerts and
    exit level (0 clear, 1 warnings, 2 critical)."""
    checks = F.struct((F.col("failed") <= max_failures).alias("pipeline"), (F.col("incidents") == 0).alias("restricted"), (~F.col("stale")).alias("fresh"))
    good = F.col("checks.pipeline") & F.col("checks.restricted") & F.col("checks.fresh")
    alert = lambda level, name: F.struct(F.lit(level).alias("level"), F.lit(name).alias("name"))
    alerts = F.array_compact(
        F.array(
            F.when(F.col("missing") > 0, alert("critical", "missing_documents")),
            F.when(~F.col("checks.pipeline"), alert("critical", "pipeline_failures")),
            F.when(~good, alert("warning", "health_degraded")),
        )
    )
    level = F.when(F.exists("alerts", lambda a: a["level"] == "critical"), 2).when(F.size("alerts") > 0, 1).otherwise(0)
    return (
        figures.withColumn("checks", checks)
        .withColumn("status", F.when(good, "ok").otherwise("degraded"))
        .withColumn("alerts", alerts)
        .withColumn("exit", level)
    )


def name_status(lines: DataFrame) -> DataFrame:
    """Git name-status lines to (commit, status, path); the last field is the path."""
    parts = F.split("line", "\t")
    q = lines.select("commit", "pos", F.substring(F.element_at(parts, 1), 1, 1).alias("status"), F.element_at(parts, -1).alias("path"), F.size(parts).alias("n"))
    return q.where(F.col("status").isin(list("AMDRCT")) & (F.col("n") >= 2)).drop("n")


def changed_paths(changes: DataFrame) -> DataFrame:
    """the paths of a commit once each, in order of first appearance."""
    return changes.groupBy("commit", "path").agg(F.min("pos").alias("pos"))


def file_results(changed: DataFrame, manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Each changed path with its hash and result; a path without a result is 'missing'."""
    m = manifest.groupBy("raw_path").agg(F.min("sha256").alias("sha256"))
    return changed.join(m, changed["path"] == m["raw_path"], "left").join(results.select("sha256", "result"), "sha256", "left").select(
        "commit", "path", "sha256", F.coalesce("result", F.lit("missing")).alias("result")
    )


def message_id(stream: Column, sequence: Column, subject: Column, ts: Column, payload: Column) -> Column:
    """The id of an archived message, the same at each delivery: of its stream and sequence number, or where it has no
    number of its subject, time and payload. Parts are set apart by NUL, so that none runs into the next."""
    nul = F.decode(F.unhex(F.lit("00")), "UTF-8")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    own = F.concat(F.lit("seq"), nul, blank(stream), nul, sequence.cast("string"))
    content = F.concat(F.lit("msg"), nul, blank(subject), nul, blank(F.unix_micros(ts)), nul, blank(payload))
    return F.concat(F.lit("msg_"), F.sha2(F.coalesce(own, content), 256))


def archived(messages: DataFrame) -> DataFrame:
    """messages(stream, sequence, subject, ts, payload, ...) -> one row for each message_id, with how often it was delivered.
    Of deliveries that differ, the one with the largest payload counts."""
    m = messages.withColumn("message_id", message_id(*(F.col(c) for c in ("stream", "sequence", "subject", "ts", "payload"))))
    rest = [c for c in messages.columns if c != "payload"]
    return m.groupBy("message_id").agg(F.max(F.struct("payload", *rest)).alias("m"), F.count("*").alias("deliveries")).select("message_id", "deliveries", "m.*")
