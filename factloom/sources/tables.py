"""Sources and sinks as tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators.guards import extracted_rows, valid_exclusions

EXCLUSION = "raw_path string, reason string, timestamp string, source string, raw_sha256 string"
ENTRY = (
    "raw_path string, raw_commit string, size long, matters array<string>, origin string, document_type string, author string, "
    "no_index boolean, no_index_reason string, no_index_category string, date string, metadata_error string"
)


def read_raw_tree(spark: SparkSession, root: str, skip_media: bool = True) -> DataFrame:
    """A1: (raw_path, tree, size, sha256, content); media are dropped by their path before any byte is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # The scheme and host that Spark puts before a path say nothing; the root is taken literally, at the front.
    plain = F.regexp_replace("path", "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(?=/)", "")
    front = re.sub("^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(?=/)", "", root).rstrip("/") + "/"
    rel = F.when(plain.startswith(front), F.substr(plain, F.lit(len(front) + 1))).otherwise(plain)
    q = files.withColumn("raw_path", rel)
    q = q.where(~T.is_media(F.col("raw_path"))) if skip_media else q
    return q.select("raw_path", T.tree_of(F.col("raw_path")).alias("tree"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A2: a JSON object keyed by hash, one row per entry; hashes in lower case."""
    one = spark.read.text(path, wholetext=True)
    return one.select(F.explode(F.from_json("value", f"map<string,struct<{','.join(f.strip().replace(' ', ':', 1) for f in ENTRY.split(', '))}>>")).alias("sha", "e")).select(F.lower("sha").alias("sha256"), "e.*")


def write_manifest(entries: DataFrame, path: str) -> None:
    """A3: one entry per hash, the one of the first path."""
    rest = [c for c in entries.columns if c != "sha256"]
    one = entries.groupBy(F.lower("sha256").alias("sha256")).agg(F.min_by(F.struct(*rest), "raw_path").alias("e")).select("sha256", "e.*")
    one.write.mode("overwrite").parquet(path)


def parse_exclusions(lines: DataFrame) -> DataFrame:
    """A4: lines(value, pos) -> registry(idx, raw_path, reason, timestamp, source, raw_sha256); blanks, #
    comments, malformed lines and entries without a path go; idx keeps the order of lines."""
    e = F.from_json("value", EXCLUSION, {"mode": "PERMISSIVE"})
    q = lines.where(~F.col("value").rlike(r"^\s*(#|$)")).select(F.col("pos").alias("idx"), e.alias("e")).where("e.raw_path is not null")
    return q.select("idx", "e.raw_path", "e.reason", "e.timestamp", F.coalesce("e.source", F.lit("manual")).alias("source"), F.lower("e.raw_sha256").alias("raw_sha256"))


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """A4 over a file of JSON lines; the order is that of the files' names and of the lines in them."""
    lines = spark.read.text(path).select("value", F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("pos"))
    return parse_exclusions(lines)


def append_exclusions(entries: DataFrame, path: str) -> DataFrame:
    """A5: append the valid entries as JSON lines; returns the rejected ones with their error."""
    checked = valid_exclusions(entries)
    checked.where("error is null").drop("error").write.mode("append").json(path)
    return checked.where("error is not null")


def docs_from_source(rows: DataFrame) -> DataFrame:
    """rows(_id, source JSON) -> documents; unknown keys go, a missing doc_id is the stored key."""
    schema = (
        "doc_id string, raw_path string, raw_sha256 string, content string, summary string, author string, document_type string, "
        "matters array<string>, keywords array<string>, entities array<string>, ingested_at string"
    )
    q = rows.select("_id", F.from_json("source", schema).alias("d"))
    lists = ("matters", "keywords", "entities")
    empty = F.array().cast("array<string>")
    cols = [F.coalesce(f"d.{c}", empty).alias(c) if c in lists else F.col(f"d.{c}") for c in ("raw_path", "raw_sha256", "content", "summary", "author", "document_type", *lists, "ingested_at")]
    return q.select(F.coalesce("d.doc_id", "_id").alias("doc_id"), *cols)


def docs_from_frontmatter(files: DataFrame) -> DataFrame:
    """files(path, text) -> (doc_id, raw_path, content, meta, error): YAML prelude and body, doc_id made
    anew; README.md is left out, a file without raw_path is rejected with an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for b in batches:
            out = []
            for front in b["front"]:
                try:
                    d = yaml.safe_load(front or "") or {}
                    out.append({str(k): str(v) for k, v in d.items()} if isinstance(d, dict) else {})
                except yaml.YAMLError:
                    out.append({})
            yield pd.DataFrame({"path": b["path"], "body": b["body"], "meta": [list(m.items()) for m in out]})

    pattern = r"(?s)\A---\s*\n(.*?)\n---\s*\n(.*)\z"
    parts = files.where(~F.col("path").rlike(r"(^|/)README\.md$")).select(
        "path", F.regexp_extract("text", pattern, 1).alias("front"), F.when(F.col("text").rlike(pattern), F.regexp_extract("text", pattern, 2)).otherwise(F.col("text")).alias("body")
    )
    q = parts.mapInPandas(run, "path string, body string, meta array<struct<k:string,v:string>>").withColumn("meta", F.map_from_entries("meta"))
    raw = F.col("meta")["raw_path"]
    return q.select(T.doc_id(raw, F.col("body")).alias("doc_id"), raw.alias("raw_path"), F.col("body").alias("content"), "meta", F.when(raw.isNull(), "no raw_path").alias("error"))


def write_extracted(docs: DataFrame, path: str) -> DataFrame:
    """Write the accepted rows, partitioned by tree; returns counts of written and refused."""
    rows = extracted_rows(docs)
    rows.where("refused is null").drop("refused").write.mode("overwrite").partitionBy("tree").parquet(path)
    return rows.groupBy(F.coalesce("refused", F.lit("written")).alias("outcome")).agg(F.count("*").alias("n"))


def append_events(events: DataFrame, path: str) -> None:
    """A10, K5: append, partitioned by date, so that later reads prune."""
    events.withColumn("date", F.to_date("ts")).write.mode("append").partitionBy("date").parquet(path)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """K5: append alerts(ts, severity, ...), partitioned by severity, then date."""
    alerts.withColumn("date", F.to_date("ts")).write.mode("append").partitionBy("severity", "date").parquet(path)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, canonical) from a JSON object of canonical name -> list of aliases; no file, no rows."""
    schema = "alias string, canonical string"
    try:
        one = spark.read.text(path, wholetext=True)
        return one.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("canonical", "names")).select(
            "canonical", F.explode("names").alias("alias")
        ).select(T.norm(F.col("alias")).alias("alias"), T.norm(F.col("canonical")).alias("canonical"))
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise
