"""What should be in the corpus, what is, and what must not be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import text as T

#: Registry entries up to which a join by path prefix is broadcast; beyond, prefixes are joined by equality.
REGISTRY_ROWS = 10_000


def filter_allowlisted(files: DataFrame, include: dict[str, str], exclude_globs: list[str] = ()) -> DataFrame:
    """B1: files of included trees without git folders, metadata carriers and excluded globs; adds origin."""
    path = F.col("raw_path")
    q = files.where(~path.rlike(r"(^|/)\.git/") & ~path.rlike(r"(^|/)metadata\.yaml$") & ~path.endswith(".metadata.yaml"))
    for g in exclude_globs:
        q = q.where(~path.rlike(T.glob_pattern(g)))
    origins = F.create_map(*[F.lit(x) for kv in include.items() for x in kv])
    return q.withColumn("origin", F.get(F.array(origins[T.tree_of(path)]), F.lit(0))).where("origin is not null")


def match_exclusions(rows: DataFrame, registry: DataFrame, key: str, prefix_rows: int = REGISTRY_ROWS) -> DataFrame:
    """Adds excl_kind (sha, path or prefix), excl_idx, excl_reason of the entry that hits a row.

    rows(key, raw_path, raw_sha256), key unique; registry(idx, raw_path, raw_sha256, reason), idx in file
    order. A hash hit goes first, then an equal path, then the first prefix in file order. The registry
    is broadcast while it is small; a larger one is joined on prefixes of the lengths that occur in it.
    """
    reg = registry.where("raw_path is not null").select("idx", F.col("raw_path").alias("_path"), F.lower("raw_sha256").alias("_sha"), "reason")
    by_sha = reg.where("_sha is not null").groupBy("_sha").agg(F.min(F.struct("idx", "reason")).alias("sha_hit"))
    by_path = reg.groupBy("_path").agg(F.min(F.struct("idx", "reason")).alias("path_hit"))
    slim = rows.select(key, "raw_path", F.lower("raw_sha256").alias("_sha"))
    if reg.count() <= prefix_rows:
        small = F.broadcast(reg.select("_path", "idx", "reason"))
        met = slim.join(small, F.col("raw_path").startswith(F.col("_path")))
    else:
        sizes = sorted(r[0] for r in reg.select(F.length("_path")).distinct().collect())  # path lengths: a few hundred
        heads = slim.select(key, "raw_path", F.explode(F.array(*map(F.lit, sizes))).alias("n")).where("n <= length(raw_path)")
        met = heads.select(key, F.expr("left(raw_path, n)").alias("_path")).join(reg.select("_path", "idx", "reason"), "_path")
    by_prefix = met.groupBy(key).agg(F.min(F.struct("idx", "reason")).alias("prefix_hit"))
    hit = (
        slim.join(by_sha, "_sha", "left")
        .join(by_path, F.col("raw_path") == F.col("_path"), "left")
        .join(by_prefix, key, "left")
        .select(
            key,
            F.when(F.col("sha_hit").isNotNull(), "sha").when(F.col("path_hit").isNotNull(), "path").when(F.col("prefix_hit").isNotNull(), "prefix").alias("excl_kind"),
            F.coalesce("sha_hit.idx", "path_hit.idx", "prefix_hit.idx").alias("excl_idx"),
            F.coalesce("sha_hit.reason", "path_hit.reason", "prefix_hit.reason").alias("excl_reason"),
        )
    )
    return rows.join(hit, key)


def skip_reason() -> Column:
    """B2: why an entry with excl_kind and no_index isn't ingested; null if it may be."""
    return (
        F.when(F.col("excl_kind").isNotNull(), "deliberately_excluded")
        .when(F.coalesce("no_index", F.lit(False)), "no_index")
        .when(T.is_media(F.col("raw_path")), "media")
    )


def provenance(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Docs with the manifest's matters, first matter, origin (only a known one) by lower-case hash."""
    m = manifest.groupBy(F.lower("sha256").alias("_sha")).agg(F.min_by(F.struct("matters", "origin", "raw_path"), "raw_path").alias("m"))
    valid = F.col("m.origin").isin("own", "disclosure", "court", "third_party", "public")
    return docs.join(m, F.lower(docs["raw_sha256"]) == F.col("_sha"), "left").select(
        docs["*"], F.col("m.matters").alias("base_matters"), F.get("m.matters", F.lit(0)).alias("base_primary"), F.when(valid, F.col("m.origin")).alias("base_origin")
    )


def completeness(expected: DataFrame, indexed: DataFrame) -> DataFrame:
    """(raw_path, status): matched, missing (expected only) or extra (indexed only)."""
    e = expected.select("raw_path").distinct().withColumn("e", F.lit(True))
    i = indexed.select("raw_path").distinct().withColumn("i", F.lit(True))
    status = F.when(F.col("e") & F.col("i"), "matched").when(F.col("e"), "missing").otherwise("extra")
    return e.join(i, "raw_path", "full_outer").select("raw_path", status.alias("status"))


def missing_by_matter(expected: DataFrame, indexed: DataFrame) -> DataFrame:
    """Missing documents by matter, '(none)' without one, most first."""
    gap = expected.join(indexed.select("raw_path").distinct(), "raw_path", "left_anti")
    each = gap.select(F.explode_outer("matters").alias("matter"))
    return each.groupBy(F.coalesce("matter", F.lit("(none)")).alias("matter")).agg(F.count("*").alias("missing"))


def hash_gap(files: DataFrame, indexed_shas: DataFrame) -> DataFrame:
    """Files whose content hash is not indexed, in any case of letters."""
    have = indexed_shas.where("raw_sha256 is not null").select(F.lower("raw_sha256").alias("_sha")).distinct()
    return files.withColumn("_sha", F.lower("sha256")).join(have, "_sha", "left_anti").drop("_sha")


def gap_by_tree(classified: DataFrame, indexed_shas: DataFrame) -> DataFrame:
    """Per tree: scanned files, skipped by reason, and the gap among the rest. classified has skip_reason."""
    have = indexed_shas.select(F.lower("raw_sha256").alias("_sha")).distinct().withColumn("_in", F.lit(True))
    rows = classified.withColumn("_sha", F.lower("sha256")).join(have, "_sha", "left")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return rows.groupBy(T.tree_of(F.col("raw_path")).alias("tree")).agg(
        F.count("*").alias("scanned"),
        count(F.col("skip_reason") == "media").alias("media"),
        count(F.col("skip_reason") == "no_index").alias("no_index"),
        count(F.col("skip_reason") == "deliberately_excluded").alias("excluded"),
        count(F.col("skip_reason").isNull() & F.col("_in").isNull()).alias("gap"),
    )


def catchup_report(classified: DataFrame, batch: int = 50) -> DataFrame:
    """One row of counters over the manifest. classified has skip_reason, indexed and present."""
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    open_ = F.col("skip_reason").isNull() & ~F.col("indexed")
    pending = open_ & F.col("present")
    return classified.agg(
        F.count("*").alias("scanned"),
        count(F.col("indexed")).alias("indexed"),
        count(pending).alias("pending"),
        F.greatest(count(pending) - batch, F.lit(0)).alias("remaining"),
        count(F.col("skip_reason") == "no_index").alias("no_index_skipped"),
        count(F.col("skip_reason") == "deliberately_excluded").alias("deliberately_excluded"),
        count(open_ & ~F.col("present")).alias("missing_source"),
    )


#: Results of an attempted entry that leave it to the dead letters.
DEAD = ("error", "sink-failed", "extract-failed", "missing-file")


def catchup_pass(classified: DataFrame, known: DataFrame, results: DataFrame, batch: int = 50) -> DataFrame:
    """The counters of one bounded pass: those of catchup_report, and `new` entries (their hash isn't in known.sha256), `skipped`
    ones (indexed before), `ingested` and `dead_lettered` ones by results(sha256, status), and `degraded`, whether a backlog is left.
    """
    report = catchup_report(classified, batch)
    new = classified.select(F.lower("sha256").alias("sha256")).join(known.select(F.lower("sha256").alias("sha256")).distinct(), "sha256", "left_anti").agg(F.count("*").alias("new"))
    done = results.agg(F.count(F.when(F.col("status") == "indexed", 1)).alias("ingested"), F.count(F.when(F.col("status").isin(*DEAD), 1)).alias("dead_lettered"))
    return report.crossJoin(new).crossJoin(done).withColumns({"skipped": F.col("indexed"), "degraded": F.col("remaining") > 0})  # one row each


def pending_batch(classified: DataFrame, batch: int = 50) -> DataFrame:
    """the next entries to ingest, by hash, at most `batch` (the batch is the feature)."""
    return classified.where(F.col("skip_reason").isNull() & ~F.col("indexed") & F.col("present")).orderBy("sha256", "raw_path").limit(batch)


def select_work(manifest: DataFrame, only: DataFrame | None, indexed: DataFrame, max_docs: int | None = None) -> DataFrame:
    """Manifest entries, only those paths, without the indexed hashes, at most max_docs by path."""
    q = manifest if only is None else manifest.join(only.select("raw_path").distinct(), "raw_path", "left_semi")
    q = hash_gap(q, indexed)
    return q if max_docs is None else q.orderBy("raw_path").limit(max_docs)


def new_entries(walk: DataFrame, manifest: DataFrame) -> DataFrame:
    """H3: files of unknown hash, the first path of each; other paths of it are reported by duplicates()."""
    known = manifest.select(F.lower("sha256").alias("_sha")).distinct()
    new = walk.withColumn("_sha", F.lower("sha256")).join(known, "_sha", "left_anti")
    nth = F.row_number().over(Window.partitionBy("_sha").orderBy("raw_path"))
    return new.withColumn("_n", nth).where("_n = 1").drop("_n", "_sha")


def duplicates(walk: DataFrame) -> DataFrame:
    """(sha256, first_path, paths): content that stands at several paths."""
    return walk.groupBy(F.lower("sha256").alias("sha256")).agg(F.min("raw_path").alias("first_path"), F.countDistinct("raw_path").alias("paths")).where("paths > 1")


def orphans(manifest: DataFrame, files: DataFrame, indexed: DataFrame) -> DataFrame:
    """Manifest rows without their file, with the doc_id that is still indexed, if any."""
    gone = manifest.join(files.select("raw_path").distinct(), "raw_path", "left_anti")
    live = indexed.groupBy("raw_path").agg(F.min("doc_id").alias("doc_id"))
    return gone.join(live, "raw_path", "left").select("raw_path", "sha256", "doc_id")


def missing_sources(pending: DataFrame, files: DataFrame) -> DataFrame:
    """Pending entries whose source file isn't there."""
    return pending.join(files.select("raw_path").distinct(), "raw_path", "left_anti")


def blocked_reingests(matched: DataFrame, indexed: DataFrame) -> DataFrame:
    """Entries that a registry entry keeps from being ingested: not indexed, not media, hit."""
    return hash_gap(matched, indexed).where(F.col("excl_kind").isNotNull() & ~T.is_media(F.col("raw_path")))


def live_exposure(docs: DataFrame, registry: DataFrame, key: str = "doc_id") -> DataFrame:
    """C14: indexed documents that a registry entry hits or that are no_index, with category and severity."""
    m = match_exclusions(docs, registry, key)
    hit = m.where(F.col("excl_kind").isNotNull() | F.coalesce("no_index", F.lit(False)))
    cat = T.category(F.col("no_index_category"))
    return hit.select(key, "raw_path", "excl_kind", cat.alias("category"), T.severity(F.col("no_index_category")).alias("severity"))


def last_stage_of_missing(missing: DataFrame, events: DataFrame) -> DataFrame:
    """Each missing document with the stage, status and reason of its newest event."""
    newest = (
        events.where("sha256 is not null")
        .groupBy(F.lower("sha256").alias("_sha"))
        .agg(F.max(F.struct("ts", "stage", "status", "reason")).alias("e"))
    )
    return missing.join(newest, F.lower(missing["sha256"]) == F.col("_sha"), "left").select(
        missing["raw_path"], F.col("e.stage").alias("last_stage"), F.col("e.status").alias("last_status"), F.col("e.reason").alias("last_reason")
    )


def stale(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Indexed documents whose hash differs from the manifest's of the same path."""
    now = manifest.groupBy("raw_path").agg(F.min(F.lower("sha256")).alias("now"))
    return docs.join(now, "raw_path").where(~F.lower("raw_sha256").eqNullSafe(F.col("now"))).select("raw_path", "doc_id", F.lower("raw_sha256").alias("was"), "now")


def latest_versions(docs: DataFrame) -> DataFrame:
    """docs with is_current: the newest of each path by ingested_at, then doc_id."""
    nth = F.row_number().over(Window.partitionBy("raw_path").orderBy(F.desc("ingested_at"), F.desc("doc_id")))
    return docs.withColumn("is_current", nth == 1)


def dry_run(files: DataFrame, include: dict[str, str], exclude_globs: list[str] = ()) -> DataFrame:
    """Files and bytes that would be taken per tree, and how many of the tree would not."""
    taken = filter_allowlisted(files, include, exclude_globs).groupBy(T.tree_of(F.col("raw_path")).alias("tree")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    all_ = files.groupBy(T.tree_of(F.col("raw_path")).alias("tree")).agg(F.count("*").alias("n"))
    return all_.join(taken, "tree", "left").select(
        "tree", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"), (F.col("n") - F.coalesce("files", F.lit(0))).alias("excluded")
    )


def retracted(docs: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """C20: (doc_id, depth): what derives, over any number of steps, from the retracted seeds(doc_id).

    docs(doc_id, derived_from array<string>). Breadth first; each step is written to the shared folder.
    Goes on until nothing new is found; where max_depth is given and more than that is left, it raises.
    """
    edges = docs.select("doc_id", F.explode("derived_from").alias("source")).distinct()
    found = seeds.select("doc_id", F.lit(0).alias("depth")).distinct()
    front = found
    depth = 0
    while True:
        depth += 1
        front = edges.join(front.select(F.col("doc_id").alias("source")), "source").select("doc_id").distinct()
        front = front.join(found, "doc_id", "left_anti").select("doc_id", F.lit(depth).alias("depth"))
        front = _cut(front)
        if front.isEmpty():
            return found
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"retraction spreads over more than {max_depth} steps")
        found = _cut(found.unionByName(front))


def _cut(df: DataFrame) -> DataFrame:
    from factloom.sources.shared import checkpoint

    return checkpoint(df)
