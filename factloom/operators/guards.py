"""Guards on write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators.completeness import match_exclusions


def guarded(docs: DataFrame, registry: DataFrame, key: str = "doc_id") -> DataFrame:
    """K1: docs with refused (registry before no_index, null if accepted) and the alert's category."""
    m = match_exclusions(docs, registry, key)
    why = F.when(F.col("excl_kind").isNotNull(), "registry").when(F.coalesce("no_index", F.lit(False)), "no_index")
    cat = F.when(F.col("excl_kind").isNotNull(), "legally_obligatory").when(F.coalesce("no_index", F.lit(False)), T.category(F.col("no_index_category")))
    return m.withColumn("refused", why).withColumn("alert_category", cat)


def check_prefixes(prefixes: list[str], force: bool = False) -> list[str]:
    """K2: no empty prefix, not the root, at least 3 characters unless forced."""
    out = [p.strip() for p in prefixes]
    bad = [p for p in out if not p or p == "/" or (len(p) < 3 and not force)]
    if bad or not out:
        raise ValueError(f"unsafe prefixes: {bad or 'none given'}")
    return out


def deindex(docs: DataFrame, prefixes: list[str], force: bool = False) -> tuple[DataFrame, DataFrame]:
    """K2: (kept, removed) documents by literal path prefixes; a dry run counts the second."""
    hit = F.lit(False)
    for p in check_prefixes(prefixes, force):
        hit = hit | F.coalesce(F.col("raw_path").startswith(p), F.lit(False))
    return docs.where(~hit), docs.where(hit)


def tombstone(docs: DataFrame, files: DataFrame) -> DataFrame:
    """K3: documents whose raw file still exists."""
    return docs.join(files.select("raw_path").distinct(), "raw_path", "left_semi")


def validation_errors(matters: Column, primary: Column, sensitivity: Column, disclosure: Column, channel: Column) -> Column:
    """K6: array of rule names that a document breaks."""
    return F.array_compact(
        F.array(
            F.when(primary.isNotNull() & ~F.array_contains(F.coalesce(matters, F.array().cast("array<string>")), primary), "primary_matter"),
            F.when(~sensitivity.isin("sensitive", "normal"), "sensitivity"),
            F.when(~disclosure.isin("served", "unused", "undisclosed", "own", "unknown"), "disclosure_status"),
            F.when(~channel.isin("official_disclosure", "own_records", "third_party", "unofficial", "unknown"), "source_channel"),
        )
    )


def valid_exclusions(entries: DataFrame) -> DataFrame:
    """A5: entries with error: a reason, and a source of deindex or manual, are required."""
    e = F.when(F.trim(F.coalesce("reason", F.lit(""))) == "", "reason").when(~F.col("source").isin("deindex", "manual"), "source")
    return entries.withColumn("error", e)


def upsert(stored: DataFrame, new: DataFrame, key: str = "doc_id", order: str = "ingested_at") -> DataFrame:
    """One row per key, the newest; a second run with the same rows changes nothing."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order), F.desc("_new")))
    return both.withColumn("_n", nth).where("_n = 1").drop("_n", "_new")


def extracted_rows(docs: DataFrame) -> DataFrame:
    """(target, text, refused): the stored form of each document; no_index and paths that leave the root are refused."""
    escape = F.col("raw_path").startswith("/") | F.array_contains(F.split("raw_path", "/"), F.lit(".."))
    refused = F.when(F.col("raw_path").isNull(), "no raw_path").when(escape, "path traversal").when(F.coalesce("no_index", F.lit(False)), "no_index")
    text = F.concat(F.lit("---\nraw_path: "), F.to_json(F.struct("raw_path")), F.lit("\n---\n"), F.coalesce("content", F.lit("")))
    return docs.select("doc_id", F.concat("raw_path", F.lit(".md")).alias("target"), T.tree_of(F.col("raw_path")).alias("tree"), text.alias("text"), refused.alias("refused"))
