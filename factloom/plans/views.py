"""The library's tables as views over the driver's tables, in Spark and, for the oracle, in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text as T


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with path, hash, provenance and handling; in_index, in_manifest and present tell
    which of the audited sets hold it."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    i = F.col("doc_id")
    tree = F.get(F.array(*map(F.lit, ("evidence", "reports", "analysis", "exhibits", "telegram"))), (i % 5).cast("int"))
    ext = F.get(F.array(*map(F.lit, ("md", "txt", "pdf", "mp4"))), (i % 4).cast("int"))
    path = F.concat(tree, F.lit("/"), "source", F.lit("/"), "lang", F.lit("/doc_"), i.cast("string"), F.when(i % 7 == 3, "_ocr").otherwise(""), F.lit("."), ext)
    return d.join(lab, "doc_id", "left").select(
        i.alias("pk"), path.alias("raw_path"), F.sha2("text", 256).alias("raw_sha256"), F.sha2("text", 256).alias("sha256"),
        F.col("text").alias("content"), F.length("text").cast("long").alias("size"), "source", "lang",
        F.array("source").alias("matters"), F.concat(F.lit("speaker_"), (i % 17).cast("string")).alias("author"), F.col("lang").alias("document_type"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("reviewed"), F.when(F.col("toxic") == 1, "sensitive").otherwise("normal").alias("sensitivity"),
        (i % 13 == 4).alias("no_index"), F.when(i % 2 == 0, "housekeeping").alias("no_index_category"),
        (i % 3 != 0).alias("in_index"), (i % 11 != 5).alias("in_manifest"), (i % 17 != 3).alias("present"),
    )


DOCS = """docs AS (SELECT d.doc_id AS pk,
 CASE d.doc_id%5 WHEN 0 THEN 'evidence' WHEN 1 THEN 'reports' WHEN 2 THEN 'analysis' WHEN 3 THEN 'exhibits' ELSE 'telegram' END || '/' || d.source || '/' || d.lang || '/doc_' || d.doc_id || CASE WHEN d.doc_id%7=3 THEN '_ocr' ELSE '' END || '.' || CASE d.doc_id%4 WHEN 0 THEN 'md' WHEN 1 THEN 'txt' WHEN 2 THEN 'pdf' ELSE 'mp4' END AS raw_path,
 sha256(d.text) AS raw_sha256, sha256(d.text) AS sha256, d.text AS content, length(d.text) AS size, d.source, d.lang, 'speaker_' || (d.doc_id%17) AS author, d.lang AS document_type,
 coalesce(l.quality=1,false) AS reviewed, CASE WHEN l.toxic=1 THEN 'sensitive' ELSE 'normal' END AS sensitivity,
 d.doc_id%13=4 AS no_index, CASE WHEN d.doc_id%2=0 THEN 'housekeeping' END AS no_index_category,
 d.doc_id%3<>0 AS in_index, d.doc_id%11<>5 AS in_manifest, d.doc_id%17<>3 AS present,
 CASE d.doc_id%5 WHEN 0 THEN 'evidence' WHEN 1 THEN 'reports' WHEN 2 THEN 'analysis' WHEN 3 THEN 'exhibits' ELSE 'telegram' END AS tree,
 CASE d.doc_id%4 WHEN 0 THEN 'md' WHEN 1 THEN 'txt' WHEN 2 THEN 'pdf' ELSE 'mp4' END AS ext
 FROM documents d LEFT JOIN labels l USING (doc_id))"""


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """Some folder prefixes, an exact path, and hashes of some documents."""
    rows = [(0, "telegram/src1", "undertaking"), (1, "exhibits/src0/de/", "privilege"), (2, "telegram/src1/en/", "late"), (3, "reports/src2/fr/doc_1", "one")]
    fixed = spark.createDataFrame(rows, "idx long, raw_path string, reason string").withColumn("raw_sha256", F.lit(None).cast("string"))
    d = docs(spark, sf).where("pk % 97 = 0")
    shas = d.select((F.col("pk") + 100).alias("idx"), F.concat(F.lit("gone/"), F.col("pk").cast("string")).alias("raw_path"), F.lit("hash").alias("reason"), F.upper("sha256").alias("raw_sha256"))
    return fixed.unionByName(shas)


REGISTRY = """registry AS (SELECT * FROM (VALUES (0,'telegram/src1','undertaking',NULL),(1,'exhibits/src0/de/','privilege',NULL),(2,'telegram/src1/en/','late',NULL),(3,'reports/src2/fr/doc_1','one',NULL)) t(idx,raw_path,reason,raw_sha256)
 UNION ALL SELECT pk+100, 'gone/' || pk, 'hash', upper(sha256) FROM docs WHERE pk%97=0),
 hits AS (SELECT d.pk, CASE WHEN s.idx IS NOT NULL THEN 'sha' WHEN p.idx IS NOT NULL THEN 'path' WHEN x.idx IS NOT NULL THEN 'prefix' END AS excl_kind,
  coalesce(s.idx,p.idx,x.idx) AS excl_idx FROM docs d
  LEFT JOIN (SELECT lower(raw_sha256) h, min(idx) idx FROM registry WHERE raw_sha256 IS NOT NULL GROUP BY 1) s ON lower(d.raw_sha256)=s.h
  LEFT JOIN (SELECT raw_path r, min(idx) idx FROM registry GROUP BY 1) p ON d.raw_path=p.r
  LEFT JOIN (SELECT d2.pk k, min(g.idx) idx FROM docs d2 JOIN registry g ON starts_with(d2.raw_path,g.raw_path) GROUP BY 1) x ON x.k=d.pk),
 classified AS (SELECT d.*, h.excl_kind, h.excl_idx, CASE WHEN h.excl_kind IS NOT NULL THEN 'deliberately_excluded' WHEN d.no_index THEN 'no_index' WHEN d.ext='mp4' THEN 'media' END AS skip_reason FROM docs d JOIN hits h USING (pk))"""


#: Line items that a task joins and numbers, on average.
TASK_ITEMS = 250_000


def claims(spark: SparkSession, sf: str) -> DataFrame:
    """T5: line items as claims about parts; (doc_id, claim_idx) is unique.

    Both tables are dealt over as many tasks as their rows (counted in the files' footers) need, so that the rows that one
    task joins and sorts don't grow with the tables.
    """
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    tasks = max(spark.sparkContext.defaultParallelism, -(-items.count() // TASK_ITEMS))
    i = items.repartition(tasks, "l_orderkey").join(orders.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus"))
    k, n, p, s = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    pred = F.when(F.col("l_returnflag") == "R", "was  returned").when(F.col("l_returnflag") == "A", "does not accept").otherwise("is shipped")
    who = F.when(n % 3 == 0, F.concat(F.lit("  SUPPLIER "), s.cast("string"))).otherwise(F.concat(F.lit("Supplier "), s.cast("string")))
    path = F.concat(F.lit("evidence/"), (k % 50).cast("string"), F.lit("/order_"), (k - k % 2).cast("string"), F.when(k % 2 == 1, "_ocr.pdf").otherwise(".md"))
    aud = F.when(F.col("o_orderpriority").startswith("1"), "police").when(F.col("o_orderpriority").startswith("2"), "court").when(F.col("o_orderpriority").startswith("3"), "journalist")
    return i.select(
        k.alias("doc_id"), nth.alias("claim_idx"), path.alias("raw_path"),
        F.when(n % 2 == 0, F.concat(F.lit("PART "), p.cast("string"))).otherwise(F.concat(F.lit("Part "), p.cast("string"))).alias("subject"),
        pred.alias("predicate"), F.concat(F.lit("qty "), (F.col("l_quantity").cast("int") % 5).cast("string")).alias("object"),
        (F.col("l_linestatus") == "O").alias("polarity"), F.when(n % 7 != 0, who).alias("asserted_by"),
        F.when(n % 4 != 0, F.concat(F.lit("span "), (k % 1000).cast("string"))).alias("source_span"), aud.alias("audience"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("claim_date"), s.alias("supp"),
    )


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Every odd supplier is the even one before it."""
    s = table(spark, sf, "supplier").where("s_suppkey % 2 = 1")
    return s.select(F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string")).alias("alias"), F.concat(F.lit("supplier "), (F.col("s_suppkey") - 1).cast("string")).alias("canonical"))


CLAIMS = """claims AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey,l_quantity,l_shipdate,l_returnflag,l_linestatus)::INT AS claim_idx,
 'part ' || l_partkey AS s, CASE l_returnflag WHEN 'R' THEN 'was returned' WHEN 'A' THEN 'does not accept' ELSE 'is shipped' END AS p,
 'qty ' || (l_quantity::INT % 5) AS o, l_linestatus='O' AS pol,
 CASE WHEN l_linenumber%7<>0 THEN CASE WHEN l_linenumber%3=0 THEN '  SUPPLIER ' || l_suppkey ELSE 'Supplier ' || l_suppkey END END AS asserted_by,
 CASE WHEN l_linenumber%7<>0 THEN CASE WHEN l_suppkey%2=1 AND s_suppkey IS NOT NULL THEN 'supplier ' || (l_suppkey-1) ELSE 'supplier ' || l_suppkey END END AS who,
 'evidence/' || (l_orderkey%50) || '/order_' || (l_orderkey - l_orderkey%2) AS stem,
 CASE WHEN l_linenumber%4<>0 THEN 'span ' || (l_orderkey%1000) ELSE '' END AS span,
 CASE left(o_orderpriority,1) WHEN '1' THEN 'police' WHEN '2' THEN 'court' WHEN '3' THEN 'journalist' END AS audience, l_suppkey AS supp,
 CASE WHEN l_linenumber%2=0 THEN 'PART ' ELSE 'Part ' END || l_partkey AS subject
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey LEFT JOIN supplier ON s_suppkey=l_suppkey)"""

PAIRS = f"""WITH {CLAIMS}, pairs AS (SELECT l.s AS subject, l.p AS predicate, l.doc_id AS left_doc, l.claim_idx AS left_idx, r.doc_id AS right_doc, r.claim_idx AS right_idx,
 CASE WHEN l.pol<>r.pol THEN 'opposite_polarity' ELSE 'conflicting_object' END AS kind, coalesce(l.who=r.who,false) AS same
 FROM claims l JOIN claims r ON l.s=r.s AND l.p=r.p AND (l.doc_id,l.claim_idx)<(r.doc_id,r.claim_idx) AND (l.pol<>r.pol OR l.o<>r.o) AND l.doc_id<>r.doc_id AND l.stem<>r.stem
 AND NOT (l.span<>'' AND l.span=r.span) AND NOT (l.pol<>r.pol AND l.o<>r.o AND l.p='does not accept'))"""


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events by stage and status; every eleventh has no hash."""
    e, i = table(spark, sf, "events"), F.col("event_id")
    stage = F.get(F.array(*map(F.lit, ("received", "extracted", "enriched", "indexed"))), (i % 4).cast("int"))
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("ok")
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), stage.alias("stage"), status.alias("status"), F.when(i % 11 != 0, F.sha2(F.col("user_id").cast("string"), 256)).alias("sha256"),
        F.concat(F.lit("doc_"), (F.col("user_id") % 40).cast("string")).alias("doc_id"), F.concat(F.lit("raw/"), F.col("user_id").cast("string")).alias("raw_path"),
        F.get_json_object("props", "$.k").alias("reason"), F.lit("worker").alias("component"), "user_id",
    )


EVENTS = """ev AS (SELECT event_id, ts, CASE event_id%4 WHEN 0 THEN 'received' WHEN 1 THEN 'extracted' WHEN 2 THEN 'enriched' ELSE 'indexed' END AS stage,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN event_id%11<>0 THEN sha256(user_id::VARCHAR) END AS sha256,
 'doc_' || (user_id%40) AS doc_id, 'raw/' || user_id AS raw_path, json_extract_string(props,'$.k') AS reason, user_id FROM events)"""

FIELDS = ("author", "case_number", "date", "matters", "no_index", "no_index_category", "no_index_reason", "notes", "topic", "method", "claim_source")


def folder_layers(spark: SparkSession, sf: str) -> DataFrame:
    """A layer for each folder of the documents, and sidecars for some files: (source, folder, depth, kind_of, ...)."""
    d = docs(spark, sf)
    tree = d.select(T.tree_of(F.col("raw_path")).alias("folder")).distinct().withColumn("depth", F.lit(1))
    sub = d.select(F.concat(T.tree_of(F.col("raw_path")), F.lit("/"), "source").alias("folder")).distinct().withColumn("depth", F.lit(2))
    side = d.where("pk % 10 = 0").select(F.col("raw_path").alias("folder")).withColumn("depth", F.lit(9))
    all_ = tree.unionByName(sub).unionByName(side)
    return all_.select(
        F.concat("folder", F.when(F.col("depth") == 9, ".metadata.yaml").otherwise("/metadata.yaml")).alias("source"), "folder", "depth",
        F.when(F.col("depth") == 9, "sidecar").otherwise("folder").alias("kind_of"),
    )


LAYERS = """layers AS (SELECT DISTINCT tree AS folder, 1 AS depth FROM docs UNION SELECT DISTINCT tree || '/' || source, 2 FROM docs UNION SELECT raw_path, 9 FROM docs WHERE pk%10=0),
 chain AS (SELECT d.raw_path, l.folder, l.depth FROM docs d JOIN layers l ON l.folder IN (d.tree, d.tree || '/' || d.source, d.raw_path))"""
