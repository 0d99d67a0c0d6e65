"""One registered query per operator, over the whole of the driver's tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators import claims as C
from factloom.operators import completeness as M
from factloom.operators import containment as W
from factloom.operators import enrich as N
from factloom.operators import events as E
from factloom.operators import grounding as G
from factloom.operators import guards as K
from factloom.operators import layers as L
from factloom.operators import seam as S
from factloom.operators import search as R
from factloom.operators import text_index as X
from factloom.plans import views as V
from factloom.sources import rawtree as B
from factloom.sources import tables as A
from factloom.sources.shared import shared_folder
from factloom.sources.store import Store
from factloom.streaming import jobs as J
from factloom.streaming import projection as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
AS_OF = datetime(2024, 1, 30, 12, 0, 0)
INCLUDE = {"evidence": "own", "reports": "own", "exhibits": "court", "telegram": "third_party"}
D, DR, EV = f"WITH {V.DOCS}", f"WITH {V.DOCS}, {V.REGISTRY}", f"WITH {V.EVENTS}"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    m = M.match_exclusions(V.docs(spark, sf), V.registry(spark, sf), "pk")
    return m.withColumn("skip_reason", M.skip_reason())


# --- claims and contradictions


@query(V.PAIRS + " SELECT CASE WHEN NOT same THEN 'contested' WHEN kind='opposite_polarity' THEN 'CONTRADICTION' ELSE 'LEAD' END AS tier, kind, count(*) AS pairs, count(DISTINCT subject) AS subjects FROM pairs GROUP BY 1,2")
def contradiction_tiers(spark, sf):
    """The flagship: tiers of contradictions over all claims."""
    n = C.contradiction_counts(V.claims(spark, sf), V.aliases(spark, sf))
    n = n.groupBy("tier", "kind", "subject").agg(F.sum("pairs").alias("pairs"))
    return n.groupBy("tier", "kind").agg(F.sum("pairs").alias("pairs"), F.count("*").alias("subjects"))


@query(V.PAIRS + " SELECT subject, predicate, left_doc, left_idx, right_doc, right_idx, kind FROM pairs WHERE same")
def contradictions_within_speaker(spark, sf):
    p = C.contradictions(V.claims(spark, sf), V.aliases(spark, sf), one_speaker=True)
    return p.select("subject", "predicate", "left_doc", "left_idx", "right_doc", "right_idx", "kind")


_CAPPED = V.CLAIMS + ", first AS (SELECT doc_id FROM claims GROUP BY 1 ORDER BY 1 LIMIT 2000), few AS (SELECT claims.* FROM claims JOIN first USING (doc_id) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY claim_idx)<=3)"


@query(V.PAIRS.replace(V.CLAIMS, _CAPPED).replace("FROM claims l JOIN claims r", "FROM few l JOIN few r") + " SELECT left_doc, left_idx, right_doc, right_idx, CASE WHEN NOT same THEN 'contested' WHEN kind='opposite_polarity' THEN 'CONTRADICTION' ELSE 'LEAD' END AS tier FROM pairs")
def capped_contradictions(spark, sf):
    """The caps of retrieval are the feature: the first 2000 documents, three claims of each."""
    p = C.contradictions(V.claims(spark, sf), V.aliases(spark, sf), max_docs=2000, max_claims_per_doc=3)
    return p.select("left_doc", "left_idx", "right_doc", "right_idx", "tier")


@query(f"WITH {V.CLAIMS} SELECT who AS canonical_speaker, count(*) AS claims, count(DISTINCT asserted_by) AS labels FROM claims GROUP BY 1")
def speaker_canonicalisation(spark, sf):
    q = C.canonical_speaker(V.claims(spark, sf), V.aliases(spark, sf))
    return q.groupBy("canonical_speaker").agg(F.count("*").alias("claims"), F.countDistinct("asserted_by").alias("labels"))


@query(f"WITH {V.CLAIMS} SELECT doc_id, list_position(idx, i)-1 AS claim_idx, subject FROM (SELECT doc_id, list(claim_idx ORDER BY claim_idx) idx, unnest(list(claim_idx ORDER BY claim_idx)) i, unnest(list(subject ORDER BY claim_idx)) subject FROM claims GROUP BY doc_id)")
def claim_explode(spark, sf):
    """G29 over documents whose claims are nested."""
    c = V.claims(spark, sf).select("doc_id", "raw_path", F.struct("claim_idx", "subject", "predicate", "object").alias("c"))
    nested = c.groupBy("doc_id").agg(F.min("raw_path").alias("raw_path"), F.sort_array(F.collect_list("c")).alias("claims")).withColumn("matters", F.array(F.lit("m")))
    nested = nested.withColumn("claims", F.transform("claims", lambda x: x.dropFields("claim_idx")))
    return C.explode_claims(nested).select("doc_id", F.col("claim_idx").cast("long").alias("claim_idx"), "subject")


@query(f"WITH {V.CLAIMS}, f AS (SELECT doc_id, claim_idx, row_number() OVER (PARTITION BY doc_id ORDER BY claim_idx) n FROM claims WHERE asserted_by='Supplier 7' AND (subject ILIKE 'part%') AND (o='qty 2' OR o LIKE 'qty%')), d AS (SELECT DISTINCT doc_id FROM f ORDER BY doc_id LIMIT 20) SELECT doc_id, claim_idx FROM f JOIN d USING (doc_id) WHERE n<=25")
def claim_search(spark, sf):
    """One speaker's claims, any shared word of subject and object."""
    q = C.find_claims(V.claims(spark, sf), asserted_by="Supplier 7", subject="part", object_="qty")
    return q.select("doc_id", "claim_idx")



_STOP = ",".join(f"'{w}'" for w in T.STOPWORDS)
_SEAM = (
    f"WITH {V.CLAIMS}, c AS (SELECT doc_id*100+claim_idx AS id, audience, who, list_distinct(list_filter(regexp_extract_all(lower(s || ' ' || o),'[a-z0-9]+'), lambda x: x NOT IN ({_STOP}))) AS t FROM claims WHERE audience IS NOT NULL AND who IS NOT NULL),"
    " e AS (SELECT id, unnest(t) AS x, len(t) AS n FROM c), f AS (SELECT x, count(*) AS df FROM e GROUP BY 1),"
    " k AS (SELECT id, x FROM (SELECT id, e.x, n, row_number() OVER (PARTITION BY id ORDER BY df, e.x) AS r FROM e JOIN f USING (x)) WHERE r<=n-ceil(0.7*n-1e-9)+1),"
    " g AS (SELECT k.x, c.* FROM k JOIN c USING (id)), p AS (SELECT DISTINCT l.id AS left_id, r.id AS right_id, len(list_intersect(l.t,r.t)) AS b, len(l.t)+len(r.t) AS n FROM g l JOIN g r ON l.who=r.who AND l.x=r.x AND l.id<r.id AND l.audience<>r.audience)"
    " SELECT left_id, right_id, round(b/(n-b),6) AS similarity FROM p WHERE b/(n-b)>=0.7"
)


@query(_SEAM)
def seam_pairs(spark, sf):
    """Same speaker, other audience, Jaccard of the claim's tokens at least 0.7, over every supplier."""
    c = C.canonical_speaker(V.claims(spark, sf), V.aliases(spark, sf)).withColumn("claim_id", F.col("doc_id") * 100 + F.col("claim_idx"))
    p = S.candidate_pairs(c, 0.7)
    return p.select("left_id", "right_id", F.round("similarity", 6).alias("similarity"))


# The name under which the pairs of all suppliers were first registered.
QUERIES["seam_pairs_all"], ORACLE_SQL["seam_pairs_all"] = seam_pairs, _SEAM


_SCORED = "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] v FROM embeddings) SELECT l.vec_id AS left_id, r.vec_id AS right_id FROM e l JOIN e r ON l.label=r.label AND l.vec_id<r.vec_id AND l.vec_id%3<>r.vec_id%3"


@query(_SCORED + " WHERE list_cosine_similarity(l.v,r.v)>=0.3 ORDER BY round(list_cosine_similarity(l.v,r.v),9) DESC, 1, 2 LIMIT 100")
def ranked_pairs(spark, sf):
    """The hundred best pairs (the cap is the feature) by a caller's scorer, the cosine; labels as speakers."""
    e = V.table(spark, sf, "embeddings")
    claims = e.select(F.col("vec_id").alias("claim_id"), (F.col("vec_id") % 3).alias("audience"), F.col("label").alias("canonical_speaker"), F.lit("").alias("subject"), F.lit("").alias("object"), "embedding")
    p = S.candidate_pairs(claims, 0.3, 100, S.Cosine("embedding", 9), ("embedding",))
    return p.select("left_id", "right_id")


@query("WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] v FROM embeddings WHERE vec_id%25=0), f AS (SELECT vec_id, label, embedding::DOUBLE[] v FROM embeddings) SELECT e.vec_id AS left_id, f.vec_id AS right_id FROM e JOIN f ON e.label=f.label AND e.vec_id<>f.vec_id WHERE list_cosine_similarity(e.v,f.v)>=0.3")
def embedding_scorer(spark, sf):
    """Cosine within a label by matrix products of blocks; queries are the vectors 0, 25, 50, ..., against all."""
    e = V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("claim_id"), F.col("label").alias("canonical_speaker"), "embedding")
    return S.vector_pairs(e.where("claim_id % 25 = 0"), e, S.Cosine("embedding"), 0.3).select("left_id", "right_id")


@query("WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] v FROM embeddings) SELECT l.vec_id AS left_id, r.vec_id AS right_id FROM e l JOIN e r ON l.label=r.label AND l.vec_id<r.vec_id AND l.vec_id%3<>r.vec_id%3 WHERE list_cosine_similarity(l.v,r.v)>=0.35")
def near_claims(spark, sf):
    """All pairs by a caller's scorer, the cosine; labels as speakers, vectors with non-finite components with none.

    At 0.35 the cells of angle_cells part nothing: nearly every two vectors share one, and each is there four times.
    """
    e = V.table(spark, sf, "embeddings").where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    claims = e.select(F.col("vec_id").alias("claim_id"), (F.col("vec_id") % 3).alias("audience"), F.col("label").alias("canonical_speaker"), F.lit("").alias("subject"), F.lit("").alias("object"), "embedding")
    p = S.candidate_pairs(claims, 0.35, None, S.Cosine("embedding"), ("embedding",))
    return p.select("left_id", "right_id")


# --- scalar functions over every path and text


@query(D + " SELECT pk, lower(regexp_replace(regexp_replace(raw_path,'(\\.(pdf|md|txt))+$',''),'_ocr$','')) AS stem, CASE WHEN starts_with(raw_path,'reports/') THEN 'REPORTS' WHEN starts_with(raw_path,'analysis/') THEN 'ANALYSIS' ELSE 'OTHER' END AS layer, CASE ext WHEN 'md' THEN 'passthrough' WHEN 'txt' THEN 'passthrough' ELSE 'external' END AS route, 'gb_' || sha256(raw_path || chr(0) || content) AS doc_id FROM docs")
def path_functions(spark, sf):
    """Stem, layer, route and identity of every document."""
    d = V.docs(spark, sf)
    return d.select("pk", F.lower(T.doc_stem(F.col("raw_path"))).alias("stem"), T.layer_of(F.col("raw_path")).alias("layer"), T.route(F.col("raw_path")).alias("route"), T.doc_id(F.col("raw_path"), F.col("content")).alias("doc_id"))


_WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_FOLD = "replace(translate(TEXT," + "'" + T.DOUBLE_QUOTES + T.SINGLE_QUOTES + "','" + '"' * len(T.DOUBLE_QUOTES) + "''" * len(T.SINGLE_QUOTES) + "'),'…','...')"
_QUOTED = "sha256(trim(regexp_replace(regexp_replace(" + _FOLD + r",'\.[ \t]*\.[ \t]*\.(?:[ \t]*\.)*','...','g')" + f",'{_WS}',' ','g')))"


@query(D + f" SELECT pk, sha256(trim(regexp_replace(lower(content),'{_WS}',' ','g'))) AS norm, {_QUOTED.replace('TEXT', 'content')} AS squeezed, len(list_distinct(list_filter(regexp_extract_all(lower(content),'[a-z0-9]+'), lambda x: x NOT IN ({_STOP})))) AS tokens FROM docs")
def text_functions(spark, sf):
    """Normal forms of every text."""
    d = V.docs(spark, sf)
    return d.select("pk", F.sha2(T.norm(F.col("content")), 256).alias("norm"), F.sha2(T.quote_norm(F.col("content")), 256).alias("squeezed"), F.size(T.jaccard_tokens(F.col("content"))).cast("long").alias("tokens"))


_SMART = "replace(replace(replace(content,' the ',' “the” '),' de ',' ‚de’ '),'. ',' . . .  . ') || '…'"


@query(D + f" SELECT pk, {_QUOTED.replace('TEXT', _SMART)} AS squeezed FROM docs")
def quoted_texts(spark, sf):
    """Every text with smart quotes and dot runs put into it."""
    t = F.replace(F.replace(F.replace("content", F.lit(" the "), F.lit(" “the” ")), F.lit(" de "), F.lit(" ‚de’ ")), F.lit(". "), F.lit(" . . .  . "))
    return V.docs(spark, sf).select("pk", F.sha2(T.quote_norm(F.concat(t, F.lit("…"))), 256).alias("squeezed"))


@query(D + " SELECT pk, sha256(regexp_replace(regexp_replace(content || chr(10),'[ \\t]+\\n',chr(10),'g'),'^\\s+|\\s+$','','g') || chr(10)) AS clean FROM docs")
def passthrough_text(spark, sf):
    """G1"""
    return V.docs(spark, sf).select("pk", F.sha2(T.passthrough(F.col("content")), 256).alias("clean"))


@query("SELECT page_id, length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,'<(script|style)\\b.*?</(script|style)\\s*>',' ','gis'),'<[^>]+>',' ','gs'),'&(nbsp|lt|gt|quot|middot|copy|amp);','','g'),'[^a-z]+','','g')) AS letters FROM pages")
def stripped_tags(spark, sf):
    """Lower-case letters that are left of each page."""
    p = V.table(spark, sf, "pages")
    return p.select("page_id", F.length(F.regexp_replace(T.strip_tags(F.col("html")), "[^a-z]+", "")).cast("long").alias("letters"))


@query(D + " SELECT CASE WHEN regexp_matches(lower(content),'police') THEN 'police' WHEN regexp_matches(lower(content),'court') THEN 'court' END AS audience, count(*) AS n, sum((NOT reviewed OR sensitivity='sensitive')::INT)::BIGINT AS caution FROM docs GROUP BY 1")
def audience_and_caution(spark, sf):
    """caller's audience rules, and documents to be handled with caution."""
    d = V.docs(spark, sf)
    h = F.struct("reviewed", F.lit(False).alias("cpia_s17"), F.lit(False).alias("privileged"), "sensitivity")
    return d.groupBy(T.audience(F.col("content"), (("police", "police"), ("court", "court"))).alias("audience")).agg(F.count("*").alias("n"), F.sum(T.requires_caution(h).cast("long")).alias("caution"))


@query("SELECT conv_id, turn, coalesce(text<>lag(text) OVER (PARTITION BY conv_id ORDER BY turn), true) AS new_text, CASE WHEN turn%3=0 THEN turn%2=0 WHEN role='user' THEN true WHEN role='assistant' THEN false END AS uncertain FROM conversations")
def conversation_lines(spark, sf):
    """Turns that repeat the one before, and the date rule over role as basis."""
    from pyspark.sql import Window

    c = V.table(spark, sf, "conversations")
    prev = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    explicit = F.when(F.col("turn") % 3 == 0, F.col("turn") % 2 == 0)
    date = F.when(F.col("role") != "system", "2020")
    basis = F.when(F.col("role") == "assistant", "on its face").otherwise("guess")
    return c.select("conv_id", "turn", F.coalesce(F.col("text") != prev, F.lit(True)).alias("new_text"), T.date_uncertain(explicit, date, basis).alias("uncertain"))


_LINES = "WITH l AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(text,'[ \\t\\n\\r]+',' ','g'),'<[^>]*>','','g'),'[ ]+',' ','g')) AS t FROM conversations)"


@query(_LINES + ", k AS (SELECT conv_id, turn, t FROM l WHERE t<>'' AND NOT regexp_matches(t,'^[0-9]+$') AND NOT contains(t,'-->') AND NOT starts_with(t,'WEBVTT')) SELECT conv_id, sha256(string_agg(t,chr(10) ORDER BY turn)) AS digest FROM k GROUP BY 1")
def captions(spark, sf):
    """Each conversation as captions with header, note, cue numbers, times and tags; every line comes twice."""
    c = V.table(spark, sf, "conversations").select("conv_id", "turn", F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " ")).alias("t"))
    n = F.col("turn").cast("string")
    cue = F.concat(n, F.lit("\n00:00:01.000 --> 00:00:02.000\n<v a>"), "t", F.lit("</v>\n"), "t", F.lit("\n\n"))
    body = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", cue.alias("x")))), lambda s: s["x"]), "").alias("b"))
    text = F.concat(F.lit("WEBVTT\n\nNOTE made up\nof two lines\n\n"), "b")
    return body.select("conv_id", T.transcript(text).alias("x")).where("x <> ''").select("conv_id", F.sha2("x", 256).alias("digest"))


@query("SELECT conv_id, turn, 'Re: ' || conv_id AS subject, role || '@x.org' AS sender, 2::INT AS receivers, sha256(trim(regexp_replace(text,'[ \\t\\n\\r]+',' ','g'))) AS body, CASE WHEN turn%2=0 THEN 1 ELSE 0 END AS files FROM conversations")
def mails(spark, sf):
    """Each turn as a mail, every second one in parts with a file."""
    c = V.table(spark, sf, "conversations").withColumn("t", F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " ")))
    head = F.concat(F.lit("Subject: Re: "), F.col("conv_id").cast("string"), F.lit("\r\nFrom: "), "role", F.lit("@x.org\r\nTo: B <b@x.org>, c@x.org\r\n"))
    plain = F.concat(F.lit("Content-Type: text/plain; charset=utf-8\r\nContent-Transfer-Encoding: base64\r\n\r\n"), F.base64("t"), F.lit("\r\n"))
    parts = F.concat(F.lit("Content-Type: multipart/mixed; boundary=b0\r\n\r\n--b0\r\n"), plain, F.lit("--b0\r\nContent-Type: text/csv\r\nContent-Disposition: attachment; filename=a.csv\r\n\r\n1,2\r\n--b0--\r\n"))
    name = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    m = N.parse_emails(c.select(name.alias("file"), F.concat(head, F.when(F.col("turn") % 2 == 0, parts).otherwise(plain)).cast("binary").alias("content")))
    at = F.split("file", "/")
    return m.select(
        F.get(at, F.lit(0)).cast("long").alias("conv_id"), F.get(at, F.lit(1)).cast("long").alias("turn"), "subject", F.col("from_addr").alias("sender"),
        F.size("to_addrs").alias("receivers"), F.sha2(F.trim("body"), 256).alias("body"), F.size("attachments").alias("files"),
    )


# --- completeness


@query(D + " SELECT coalesce(e.raw_path,i.raw_path) AS raw_path, CASE WHEN e.raw_path IS NULL THEN 'extra' WHEN i.raw_path IS NULL THEN 'missing' ELSE 'matched' END AS status FROM (SELECT raw_path FROM docs WHERE in_manifest) e FULL JOIN (SELECT raw_path FROM docs WHERE in_index) i USING (raw_path)")
def completeness_status(spark, sf):
    """C2, H1"""
    d = V.docs(spark, sf)
    return M.completeness(d.where("in_manifest"), d.where("in_index"))


@query(D + " SELECT source AS matter, count(*) AS missing FROM docs WHERE in_manifest AND NOT in_index GROUP BY 1")
def missing_by_matter(spark, sf):
    """D7"""
    d = V.docs(spark, sf)
    return M.missing_by_matter(d.where("in_manifest"), d.where("in_index"))


@query(D + " SELECT pk FROM docs WHERE sha256 NOT IN (SELECT sha256 FROM docs WHERE in_index)")
def hash_gap(spark, sf):
    """Case of the hash doesn't matter."""
    d = V.docs(spark, sf)
    return M.hash_gap(d, d.where("in_index").select(F.upper("raw_sha256").alias("raw_sha256"))).select("pk")


@query(DR + " SELECT pk, excl_kind, excl_idx FROM hits WHERE excl_kind IS NOT NULL")
def exclusion_match(spark, sf):
    """C4: hash, then path, then first prefix."""
    return M.match_exclusions(V.docs(spark, sf), V.registry(spark, sf), "pk").where("excl_kind is not null").select("pk", "excl_kind", "excl_idx")


@query(DR + " SELECT pk, excl_kind, excl_idx FROM hits WHERE excl_kind IS NOT NULL")
def exclusion_match_by_lengths(spark, sf):
    """The same by equality on prefixes of the registry's lengths, as for a registry too large to broadcast."""
    return M.match_exclusions(V.docs(spark, sf), V.registry(spark, sf), "pk", prefix_rows=0).where("excl_kind is not null").select("pk", "excl_kind", "excl_idx")


@query(DR + " SELECT skip_reason, count(*) AS n, min(pk) AS first FROM classified GROUP BY 1")
def skip_reasons(spark, sf):
    """B2"""
    return _classified(spark, sf).groupBy("skip_reason").agg(F.count("*").alias("n"), F.min("pk").alias("first"))


@query(D + " SELECT tree, count(*) AS files, sum(size)::BIGINT AS bytes, 0::BIGINT AS excluded FROM docs WHERE tree NOT IN ('analysis','exhibits') GROUP BY 1 UNION ALL SELECT 'exhibits', count(*) FILTER (ext<>'mp4'), sum(size) FILTER (ext<>'mp4')::BIGINT, count(*) FILTER (ext='mp4') FROM docs WHERE tree='exhibits' UNION ALL SELECT 'analysis',0,0,count(*) FROM docs WHERE tree='analysis'")
def allowlisted_trees(spark, sf):
    """Included trees, one glob excluded."""
    return M.dry_run(V.docs(spark, sf), INCLUDE, ["exhibits/**.mp4"])


@query(DR + " SELECT c.tree, count(*) AS scanned, count(*) FILTER (skip_reason='media') AS media, count(*) FILTER (skip_reason='no_index') AS no_index, count(*) FILTER (skip_reason='deliberately_excluded') AS excluded, count(*) FILTER (skip_reason IS NULL AND x.sha256 IS NULL) AS gap FROM classified c LEFT JOIN (SELECT DISTINCT sha256 FROM docs WHERE in_index) x ON x.sha256=c.sha256 GROUP BY 1")
def gap_by_tree(spark, sf):
    """D8"""
    c = _classified(spark, sf)
    return M.gap_by_tree(c, c.where("in_index").select("raw_sha256"))


@query(DR + " SELECT count(*) AS scanned, count(*) FILTER (in_index) AS indexed, count(*) FILTER (skip_reason IS NULL AND NOT in_index AND present) AS pending, greatest(count(*) FILTER (skip_reason IS NULL AND NOT in_index AND present)-50,0) AS remaining, count(*) FILTER (skip_reason='no_index') AS no_index_skipped, count(*) FILTER (skip_reason='deliberately_excluded') AS deliberately_excluded, count(*) FILTER (skip_reason IS NULL AND NOT in_index AND NOT present) AS missing_source FROM classified WHERE in_manifest")
def catchup_report(spark, sf):
    """D10"""
    return M.catchup_report(_classified(spark, sf).where("in_manifest").withColumn("indexed", F.col("in_index")))


_PASS = (
    DR + ", m AS (SELECT *, skip_reason IS NULL AND NOT in_index AND present AS open FROM classified WHERE in_manifest), b AS (SELECT pk FROM m WHERE open ORDER BY sha256, raw_path LIMIT 50)"
    " SELECT count(*) AS scanned, count(*) FILTER (in_index) AS indexed, count(*) FILTER (open) AS pending, greatest(count(*) FILTER (open)-50,0) AS remaining, count(*) FILTER (skip_reason='no_index') AS no_index_skipped,"
    " count(*) FILTER (skip_reason='deliberately_excluded') AS deliberately_excluded, count(*) FILTER (skip_reason IS NULL AND NOT in_index AND NOT present) AS missing_source,"
    " count(*) FILTER (sha256 NOT IN (SELECT sha256 FROM docs WHERE in_manifest AND pk%5<>0)) AS new, count(*) FILTER (in_index) AS skipped,"
    " (SELECT count(*) FROM b WHERE pk%4<>1) AS ingested, (SELECT count(*) FROM b WHERE pk%4=1) AS dead_lettered, count(*) FILTER (open)>50 AS degraded FROM m"
)


@query(_PASS)
def catchup_pass(spark, sf):
    """All counters of a pass; every fourth document of the batch fails, every fifth entry is new."""
    c = _classified(spark, sf).where("in_manifest").withColumn("indexed", F.col("in_index"))
    done = M.pending_batch(c).select("sha256", F.when(F.col("pk") % 4 == 1, "extract-failed").otherwise("indexed").alias("status"))
    return M.catchup_pass(c, c.where("pk % 5 <> 0"), done)


@query(DR + " SELECT pk FROM (SELECT pk, sha256, raw_path FROM classified WHERE skip_reason IS NULL AND NOT in_index AND present ORDER BY sha256, raw_path LIMIT 50)")
def pending_batch(spark, sf):
    """the batch is the feature."""
    return M.pending_batch(_classified(spark, sf).withColumn("indexed", F.col("in_index"))).select("pk")


@query(D + " SELECT pk FROM docs WHERE in_manifest AND tree='reports' AND sha256 NOT IN (SELECT sha256 FROM docs WHERE in_index)")
def work_list(spark, sf):
    """B11"""
    d = V.docs(spark, sf)
    return M.select_work(d.where("in_manifest"), d.where(F.col("raw_path").startswith("reports/")), d.where("in_index")).select("pk")


@query(D + " SELECT sha256, min(raw_path) AS raw_path FROM docs WHERE sha256 NOT IN (SELECT sha256 FROM docs WHERE in_manifest AND pk%2=0) GROUP BY 1")
def new_manifest_entries(spark, sf):
    """H3"""
    d = V.docs(spark, sf)
    return M.new_entries(d, d.where("in_manifest and pk % 2 = 0")).select("sha256", "raw_path")


@query(D + " SELECT sha256, min(raw_path) AS first_path, count(DISTINCT raw_path) AS paths FROM docs GROUP BY 1 HAVING count(DISTINCT raw_path)>1")
def duplicate_contents(spark, sf):
    return M.duplicates(V.docs(spark, sf))


@query(D + " SELECT raw_path, sha256, CASE WHEN in_index THEN pk END AS doc_id FROM docs WHERE in_manifest AND NOT present")
def orphans(spark, sf):
    """C13"""
    d = V.docs(spark, sf)
    return M.orphans(d.where("in_manifest"), d.where("present"), d.where("in_index").withColumnRenamed("pk", "doc_id"))


@query(D + " SELECT pk FROM docs WHERE in_manifest AND NOT in_index AND NOT present")
def missing_sources(spark, sf):
    """C15"""
    d = V.docs(spark, sf)
    return M.missing_sources(d.where("in_manifest and not in_index"), d.where("present")).select("pk")


@query(DR + " SELECT pk FROM classified WHERE excl_kind IS NOT NULL AND ext<>'mp4' AND sha256 NOT IN (SELECT sha256 FROM docs WHERE in_index)")
def blocked_reingests(spark, sf):
    """C16"""
    c = _classified(spark, sf)
    return M.blocked_reingests(c, c.where("in_index")).select("pk")


_EXPOSED = "exposed AS (SELECT pk, raw_path, excl_kind, coalesce(no_index_category,'legally_obligatory') AS category, CASE WHEN no_index_category='housekeeping' THEN 'noise' ELSE 'incident' END AS severity FROM classified WHERE in_index AND (excl_kind IS NOT NULL OR no_index))"


@query(f"{DR}, {_EXPOSED} SELECT * FROM exposed")
def live_exposure(spark, sf):
    """C14, G17"""
    return M.live_exposure(V.docs(spark, sf).where("in_index"), V.registry(spark, sf), "pk")


@query(f"{DR}, {_EXPOSED} SELECT severity, count(*) AS n, array_to_string(list(raw_path ORDER BY raw_path)[1:5],',') AS first_paths FROM exposed GROUP BY 1")
def exposure_summary(spark, sf):
    """D14"""
    return E.exposure_summary(M.live_exposure(V.docs(spark, sf).where("in_index"), V.registry(spark, sf), "pk"))


@query(D + " SELECT d.pk, m.raw_path AS first_path, m.source AS matter FROM docs d LEFT JOIN (SELECT sha256, min(raw_path) raw_path, min_by(source,raw_path) source FROM docs WHERE in_manifest GROUP BY 1) m USING (sha256) WHERE d.in_index")
def provenance_join(spark, sf):
    """C1"""
    d = V.docs(spark, sf)
    man = d.where("in_manifest").withColumn("origin", F.lit("own"))
    q = M.provenance(d.where("in_index"), man)
    first = man.groupBy("sha256").agg(F.min("raw_path").alias("first_path"))
    return q.join(first, "sha256", "left").select("pk", "first_path", F.col("base_primary").alias("matter"))


@query(D + " SELECT raw_path, pk AS doc_id, sha256 AS was, sha256(content || 'x') AS now FROM docs WHERE in_index AND in_manifest AND pk%9=1")
def stale_documents(spark, sf):
    """Every ninth manifest entry has changed since."""
    d = V.docs(spark, sf)
    now = F.when(F.col("pk") % 9 == 1, F.sha2(F.concat("content", F.lit("x")), 256)).otherwise(F.upper("sha256"))
    return M.stale(d.where("in_index").withColumnRenamed("pk", "doc_id"), d.where("in_manifest").withColumn("sha256", now))


@query("SELECT doc_id, event_id=max(event_id) OVER (PARTITION BY doc_id) AS is_current FROM (SELECT event_id, user_id%40 AS doc_id FROM events)")
def latest_versions(spark, sf):
    """event times ascend with event_id."""
    e = V.table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), (F.col("user_id") % 40).alias("raw_path"), F.col("event_id").alias("ingested_at"))
    return M.latest_versions(e).select(F.col("raw_path").alias("doc_id"), "is_current")


@query("WITH RECURSIVE e AS (SELECT doc_id AS d, doc_id//2 AS s FROM documents WHERE doc_id>0 UNION SELECT doc_id, doc_id//3 FROM documents WHERE doc_id>0), r(d,depth) AS (SELECT 5::BIGINT,0 UNION SELECT e.d, r.depth+1 FROM e JOIN r ON e.s=r.d) SELECT d AS doc_id, min(depth) AS depth FROM r GROUP BY 1")
def retraction_spread(spark, sf):
    """C20: each document derives from two with smaller ids; document 5 is retracted."""
    i = F.col("doc_id")
    d = V.table(spark, sf, "documents").where("doc_id > 0").select("doc_id", F.array_distinct(F.array(F.floor(i / 2), F.floor(i / 3))).alias("derived_from"))
    return M.retracted(d, spark.range(5, 6).select(F.col("id").alias("doc_id")))


# --- events and status


@query(EV + " SELECT stage, status, count(*) AS n FROM ev GROUP BY 1,2")
def stage_status_counts(spark, sf):
    """D3"""
    return E.stage_status_counts(V.events(spark, sf))


@query(EV + " SELECT count(*) FILTER (status='failed') AS failed, count(*) FILTER (status='skipped') AS skipped, count(*) FILTER (status='failed' AND ts>=TIMESTAMP '2024-01-29 12:00:00' AND ts<=TIMESTAMP '2024-01-30 12:00:00') AS failed_recent, epoch_us(max(ts) FILTER (stage='indexed' AND status='ok')) AS last_us FROM ev")
def failure_totals(spark, sf):
    """D4-D6"""
    return E.failure_totals(V.events(spark, sf), AS_OF).select("failed", "skipped", "failed_recent", F.unix_micros("last_indexed").alias("last_us"))


@query(EV + " SELECT event_id FROM (SELECT event_id FROM ev WHERE status IN ('failed','skipped') ORDER BY ts DESC, event_id DESC LIMIT 50)")
def dead_letters(spark, sf):
    """The newest 50 are the feature."""
    return E.dead_letters(V.events(spark, sf)).select("event_id")


@query(EV + " SELECT event_id, status FROM (SELECT event_id, status FROM ev WHERE status IN ('failed','skipped') ORDER BY status, ts DESC, event_id DESC LIMIT 10)")
def recent_problems(spark, sf):
    """H4"""
    return E.recent_problems(V.events(spark, sf)).select("event_id", "status")


@query(EV + " SELECT sha256, event_id, row_number() OVER w AS step, floor(epoch(ts))::BIGINT - floor(epoch(lag(ts) OVER w))::BIGINT AS seconds_since FROM ev WHERE sha256 IS NOT NULL WINDOW w AS (PARTITION BY sha256 ORDER BY ts,event_id)")
def event_timelines(spark, sf):
    """F5"""
    return E.timelines(V.events(spark, sf)).select("sha256", "event_id", F.col("step").cast("long").alias("step"), "seconds_since")


@query(EV + ", k AS (SELECT DISTINCT doc_id AS key FROM ev WHERE user_id%40<5), s AS (SELECT DISTINCT k.key, e.sha256 FROM k JOIN ev e ON e.doc_id=k.key WHERE e.sha256 IS NOT NULL) SELECT s.key, count(*) AS n, sum(event_id)::BIGINT AS ids FROM s JOIN ev e USING (sha256) GROUP BY 1")
def event_trace(spark, sf):
    """C17: all traces of some documents at once."""
    e = V.events(spark, sf)
    t = E.trace(e, e.where("user_id % 40 < 5").select(F.col("doc_id").alias("key")))
    return t.groupBy("key").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(EV + ", m AS (SELECT raw_path, sha256 FROM (SELECT DISTINCT raw_path, sha256(substr(raw_path,5)) AS sha256 FROM ev WHERE user_id%3=0)), l AS (SELECT sha256, max_by(stage,(ts,stage,status,reason)) s, max_by(status,(ts,stage,status,reason)) t FROM ev WHERE sha256 IS NOT NULL GROUP BY 1) SELECT m.raw_path, l.s AS last_stage, l.t AS last_status FROM m LEFT JOIN l USING (sha256)")
def last_stage_of_missing(spark, sf):
    """C18"""
    e = V.events(spark, sf)
    m = e.where("user_id % 3 = 0").select("raw_path", F.sha2(F.col("user_id").cast("string"), 256).alias("sha256")).distinct()
    return M.last_stage_of_missing(m, e).select("raw_path", "last_stage", "last_status")


@query(EV + ", w AS (SELECT ts, lag(ts) OVER (ORDER BY ts) p FROM ev) SELECT epoch_us(p) AS gap_start, epoch_us(ts) AS gap_end FROM w WHERE floor(epoch(ts))-floor(epoch(p))>900")
def event_outages(spark, sf):
    """L8, D21, as a batch."""
    return E.outages(V.events(spark, sf)).select(F.unix_micros("gap_start").alias("gap_start"), F.unix_micros("gap_end").alias("gap_end"))


@query(EV + " SELECT (epoch(TIMESTAMP '2024-01-30 12:00:00')-floor(epoch(max(ts))))::BIGINT AS age_s, CASE WHEN epoch(TIMESTAMP '2024-01-30 12:00:00')-floor(epoch(max(ts)))<=900 THEN 'fresh' ELSE 'stale' END AS verdict FROM ev")
def event_freshness(spark, sf):
    """D21"""
    return E.freshness(V.events(spark, sf), AS_OF)


@query(EV + " SELECT CASE max(CASE status WHEN 'failed' THEN 2 WHEN 'skipped' THEN 1 ELSE 0 END) WHEN 2 THEN 'down' WHEN 1 THEN 'degraded' ELSE 'ok' END AS status FROM ev")
def worst_component(spark, sf):
    """Stages as components."""
    status = F.when(F.col("status") == "failed", "down").when(F.col("status") == "skipped", "degraded").otherwise("ok")
    return E.worst_status(V.events(spark, sf).select(F.col("stage").alias("component"), status.alias("status")))


@query(EV + ", t AS (SELECT count(*) FILTER (status='failed') f, count(*) FILTER (status='skipped') s FROM ev) SELECT 'degraded' AS status, 2 AS exit, s AS skipped FROM t")
def system_status(spark, sf):
    """The verdict over one row of figures, as expressions on that row."""
    zero, no = F.lit(0).cast("long"), F.lit(False)
    r = E.failure_totals(V.events(spark, sf), AS_OF).select("failed", zero.alias("missing"), zero.alias("incidents"), "skipped", no.alias("stale"))
    return E.system_status(r).select("status", "exit", "skipped")


_LADDER = "lad AS (SELECT raw_path, CASE WHEN in_index THEN 'skipped-indexed' WHEN no_index THEN 'skipped-no-index' WHEN ext='mp4' THEN 'skipped-media' WHEN NOT present THEN 'missing-file' WHEN pk%19=1 THEN 'extract-failed' WHEN pk%23=1 THEN 'skipped-empty' WHEN pk%29=1 THEN 'error' WHEN pk%31=1 THEN 'sink-failed' ELSE 'indexed' END AS status FROM docs)"


def _run(spark, sf):
    i = F.col("pk")
    return V.docs(spark, sf).select(
        "raw_path", F.col("in_index").alias("indexed"), "no_index", "present", F.when(i % 19 == 1, "timeout").alias("extract_error"),
        F.when(i % 23 != 1, F.lit("x")).alias("content"), F.when(i % 29 == 1, "boom").alias("error"), (i % 31 != 1).alias("sink_ok"),
    )


@query(f"{D}, {_LADDER} SELECT CASE WHEN status IN ('error','sink-failed','extract-failed') THEN 'failures' ELSE status END AS status, count(*) AS n FROM lad GROUP BY 1")
def ingest_tally(spark, sf):
    """D9, J6"""
    return E.tally(_run(spark, sf).withColumn("status", E.status_ladder()))


@query(f"{D}, {_LADDER} SELECT status, count(*)*CASE WHEN status IN ('indexed','sink-failed') THEN 4 WHEN status='error' THEN 3 WHEN status IN ('extract-failed','skipped-empty') THEN 2 ELSE 1 END AS events FROM lad GROUP BY status")
def ingest_events(spark, sf):
    """The events that each status emits."""
    return E.ladder_events(_run(spark, sf)).groupBy("status").agg(F.count("*").alias("events"))


@query(f"{D}, {_LADDER} SELECT CASE WHEN status='extract-failed' THEN 'extracted' WHEN status='error' THEN 'enriched' WHEN status='sink-failed' THEN 'indexed' ELSE 'received' END AS stage, count(*) AS n FROM lad GROUP BY 1")
def failure_stages(spark, sf):
    """The stage that each status of the run points to."""
    return _run(spark, sf).withColumn("status", E.status_ladder()).groupBy(T.failure_stage(F.col("status")).alias("stage")).agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS commit, o_orderkey AS path, min(o_orderkey) AS pos FROM orders WHERE o_orderstatus<>'P' GROUP BY 1,2")
def changed_paths(spark, sf):
    """Name-status lines made of orders."""
    o = V.table(spark, sf, "orders")
    code = F.when(F.col("o_orderstatus") == "O", "M").when(F.col("o_orderstatus") == "F", "R100\told").otherwise("X")
    lines = o.select(F.col("o_custkey").alias("commit"), F.col("o_orderkey").alias("pos"), F.concat_ws("\t", code, F.col("o_orderkey").cast("string")).alias("line"))
    q = E.changed_paths(E.name_status(lines))
    return q.select("commit", F.col("path").cast("long").alias("path"), "pos")


@query(D + ", m AS (SELECT raw_path, min(sha256) sha FROM docs WHERE in_manifest GROUP BY 1), r AS (SELECT DISTINCT sha256 sha FROM docs WHERE in_index) SELECT d.raw_path AS path, CASE WHEN r.sha IS NULL THEN 'missing' ELSE 'indexed' END AS result FROM docs d LEFT JOIN m USING (raw_path) LEFT JOIN r ON r.sha=m.sha")
def commit_file_results(spark, sf):
    """C19"""
    d = V.docs(spark, sf)
    changed = d.select(F.lit("c1").alias("commit"), F.col("raw_path").alias("path"))
    results = d.where("in_index").select("sha256").distinct().withColumn("result", F.lit("indexed"))
    return E.file_results(changed, d.where("in_manifest"), results).select("path", "result")


# --- metadata layers


def _chain(spark, sf):
    return L.layer_chain(V.docs(spark, sf), V.folder_layers(spark, sf)).select("raw_path", "folder", "depth", "source", "kind_of")


_CH = f"WITH {V.DOCS}, {V.LAYERS}"


@query(_CH + " SELECT raw_path, count(*) AS layers, max(depth) AS deepest FROM chain GROUP BY 1")
def layer_chain(spark, sf):
    """C8"""
    return _chain(spark, sf).groupBy("raw_path").agg(F.count("*").alias("layers"), F.max("depth").alias("deepest"))


@query(_CH + " SELECT raw_path, 'author' AS key, max_by(folder,depth) AS value FROM chain WHERE length(folder)%3<>0 GROUP BY 1")
def layer_scalars(spark, sf):
    """The deepest value wins; blanks don't count."""
    v = _chain(spark, sf).select("raw_path", F.lit("author").alias("key"), F.when(F.length("folder") % 3 != 0, F.col("folder")).otherwise("").alias("value"), "depth")
    return L.fold_scalars(v)


@query(_CH + " SELECT raw_path, array_to_string(list(folder ORDER BY depth),'|') AS items FROM chain GROUP BY 1")
def layer_lists(spark, sf):
    """Lists are joined from the root on."""
    v = _chain(spark, sf).select("raw_path", F.lit("matters").alias("key"), F.array("folder", "folder").alias("items"), "depth")
    return L.fold_lists(v).select("raw_path", F.array_join("items", "|").alias("items"))


@query(_CH + " SELECT raw_path, count(DISTINCT length(folder)%2) AS n FROM chain GROUP BY 1 HAVING count(DISTINCT length(folder)%2)>1")
def layer_conflicts(spark, sf):
    """D16"""
    v = _chain(spark, sf).select("raw_path", F.lit("k").alias("key"), (F.length("folder") % 2).cast("string").alias("value"))
    return L.locked_conflicts(v).select("raw_path", "n")


@query(_CH + ", v AS (SELECT raw_path, depth, folder, k FROM chain, (VALUES ('date'),('skip'),('matters'),('summary'),('method')) t(k)) SELECT raw_path, k AS key, CASE k WHEN 'date' THEN max_by(folder,depth) WHEN 'skip' THEN max(length(folder)%2=1)::VARCHAR WHEN 'matters' THEN array_to_string(list(folder ORDER BY depth),chr(10)) WHEN 'summary' THEN max_by(folder,depth) ELSE min_by(folder,depth) END AS value, k='method' AND count(DISTINCT folder)>1 AS conflict FROM v WHERE k<>'summary' OR depth=9 GROUP BY 1,2")
def layer_legacy(spark, sf):
    """D19"""
    keys = F.explode(F.array(*map(F.lit, ("date", "skip", "matters", "summary", "method"))))
    v = _chain(spark, sf).select("raw_path", "depth", "folder", keys.alias("key"))
    odd = F.when(F.length("folder") % 2 == 1, "true").otherwise("false")
    v = v.select("raw_path", "depth", "key", F.when(F.col("key") == "skip", odd).otherwise(F.col("folder")).alias("value"), (F.col("depth") == 9).alias("is_leaf"))
    return L.resolve_legacy(v)


def _raw_layers(spark, sf):
    """YAML by a hash of the folder: clean, excluded with and without reason, misspelled, quoted, broken, unknown key."""
    n = F.pmod(F.length("folder"), F.lit(7))
    raw = (
        F.when(n == 0, "author: A\n").when(n == 1, "no_index: true\nno_index_reason: court\nno_index_category: housekeeping\n").when(n == 2, "no_index: true\n")
        .when(n == 3, "No-Index: true\n").when(n == 4, 'no_index: "true"\n').when(n == 5, "a: [\n").otherwise("auhtor: A\nno_index: false\n")
    )
    return V.folder_layers(spark, sf).withColumn("raw", raw)


_EXAM = "exam AS (SELECT *, length(folder)%7 AS n FROM layers)"


@query(f"{_CH}, {_EXAM} SELECT n IN (5,6) AS dropped, n IN (1,2,3,4,5) AS latched, n<>0 AS mentioned, n IN (2,3,4,5) AS ambiguous, count(*) AS layers FROM exam GROUP BY 1,2,3,4")
def layer_examination(spark, sf):
    """Exclusion signals of every parsed layer."""
    x = L.examine_layers(L.parse_layers(_raw_layers(spark, sf)), V.FIELDS)
    return x.groupBy("dropped", "latched", "mentioned", "ambiguous").agg(F.count("*").alias("layers"))


@query(f"{_CH} SELECT raw_path, CASE WHEN bool_or(length(folder)%7 BETWEEN 1 AND 5) THEN true WHEN bool_or(length(folder)%7=6) THEN false END AS no_index, CASE WHEN bool_or(length(folder)%7 BETWEEN 1 AND 5) THEN CASE WHEN bool_or(length(folder)%7 BETWEEN 2 AND 5) THEN 'legally_obligatory' ELSE 'housekeeping' END END AS no_index_category FROM chain GROUP BY 1")
def no_index_latch(spark, sf):
    """The one-way latch along each file's chain."""
    x = L.examine_layers(L.parse_layers(_raw_layers(spark, sf)), V.FIELDS)
    return L.fold_no_index(_chain(spark, sf).join(x, "source")).select("raw_path", "no_index", "no_index_category")


@query(f"{_CH}, {_EXAM} SELECT 'error' AS level, CASE n WHEN 2 THEN 'no_index without reason' WHEN 3 THEN 'suspected no_index typo' WHEN 4 THEN 'no_index is not a boolean' WHEN 5 THEN 'layer does not parse' WHEN 6 THEN 'unknown keys: auhtor' END AS finding, count(*) AS n FROM exam WHERE n>=2 GROUP BY 1,2 UNION ALL SELECT 'warn','author or claim_source without method',count(*) FROM exam WHERE n=0 HAVING count(*)>0 UNION ALL SELECT 'error','orphan sidecar',count(*) FROM exam e LEFT JOIN (SELECT raw_path FROM docs WHERE present) d ON d.raw_path=e.folder WHERE depth=9 AND d.raw_path IS NULL HAVING count(*)>0")
def layer_lint(spark, sf):
    """K4"""
    raw = _raw_layers(spark, sf)
    p = L.parse_layers(raw)
    f = L.lint(p, L.examine_layers(p, V.FIELDS), raw, V.docs(spark, sf).where("present"))
    return f.groupBy("level", "finding").agg(F.count("*").alias("n"))


@query(D + " SELECT pk, sha256(CASE WHEN pk%3=0 THEN content ELSE content || chr(10) || chr(10) || '<!-- notes -->' || chr(10) || 'note ' || pk || chr(10) || '<!-- notes -->' || chr(10) END) AS body, CASE WHEN pk%2=0 THEN 'case' ELSE source END AS primary_matter FROM docs")
def annotated_bodies(spark, sf):
    """Annotating twice is annotating once."""
    d = V.docs(spark, sf)
    notes = F.when(F.col("pk") % 3 != 0, F.concat(F.lit(" note "), F.col("pk").cast("string")))
    once = d.withColumn("content", L.annotate(F.col("content"), notes))
    _, primary = L.matters_of(F.when(F.col("pk") % 2 == 0, "case"), F.col("matters"), F.lit(None).cast("string"))
    return once.select("pk", F.sha2(L.annotate(F.col("content"), notes), 256).alias("body"), primary.alias("primary_matter"))


# --- search, facets and filters

_BM = (
    "t AS (SELECT doc_id, regexp_extract_all(lower(text),'[\\p{L}\\p{N}]+') t FROM documents), q AS (SELECT * FROM (VALUES (1,'the'),(1,'thereble'),(2,'de'),(2,'la'),(2,'elle')) v(query_id,term)),"
    " st AS (SELECT count(*) n, avg(len(t)) a FROM t), h AS (SELECT doc_id, len(t) dl, u.term, count(*) tf FROM (SELECT doc_id, t, unnest(t) term FROM t) u WHERE term IN (SELECT term FROM q) GROUP BY 1,2,3),"
    " df AS (SELECT term, count(*) df FROM h GROUP BY 1), sc AS (SELECT query_id, doc_id, sum(ln(1+(n-df+0.5)/(df+0.5))*tf*2.2/(tf+1.2*(1-0.75+0.75*dl/a))) s FROM h JOIN df USING (term) JOIN q USING (term), st GROUP BY 1,2)"
)


@query(f"WITH {_BM} SELECT query_id, doc_id, round(s,6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) r FROM sc) WHERE r<=10")
def bm25_search(spark, sf):
    """Two queries at once, ten best documents each (the top-k is the feature)."""
    queries = spark.createDataFrame([(1, "the thereble"), (2, "de la elle")], "query_id int, text string")
    q = R.search(V.table(spark, sf, "documents"), queries, {"text": 1.0})
    return q.select("query_id", "doc_id", F.round("score", 6).alias("score"))


_ASKED = "(1,'the'),(1,'thereble'),(2,'de'),(2,'la'),(2,'elle'),(3,'license'),(4,'question'),(4,'number'),(4,'of'),(4,'the')"


@query(f"WITH {_BM} SELECT query_id, doc_id, round(s,6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) r FROM sc) WHERE r<=10".replace("(1,'the'),(1,'thereble'),(2,'de'),(2,'la'),(2,'elle')", _ASKED))
def stored_search(spark, sf):
    """The documents' index is written, and four queries read their terms' folders of it, ten best each (a top-k)."""
    path = _new(spark, "index")
    X.write_index(V.table(spark, sf, "documents"), path, ["text"])
    queries = spark.createDataFrame([(1, "the thereble"), (2, "de la elle"), (3, "license"), (4, "number of the question")], "query_id int, text string")
    return X.search_index(spark, path, queries, {"text": 1.0}).select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query("WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text),'[\\p{L}\\p{N}]+')) term FROM documents) SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t GROUP BY 1")
def inverted_index(spark, sf):
    """Term and document frequencies of the whole index."""
    postings, _ = R.build_index(V.table(spark, sf, "documents"), {"text": 1.0})
    return postings.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("doc_id").alias("df"))


_HIT = r"'(?is)^(|.*?[^\p{L}\p{N}_])(?:that|with|les)(?:[^\p{L}\p{N}_]|$)'"
_NEXT = _HIT.replace("(|", "(")


@query(D + f", a AS (SELECT pk, content, CASE WHEN regexp_matches(content,{_HIT}) THEN greatest(0,length(regexp_extract(content,{_HIT},1))-40) END AS s FROM docs), b AS (SELECT pk, content, s, s+160 AS e, substr(content,s+160) AS rest FROM a), c AS (SELECT *, CASE WHEN length(rest)>1 AND regexp_matches(rest,{_NEXT}) THEN greatest(e,e-1+length(regexp_extract(rest,{_NEXT},1))-40) END AS z FROM b), d AS (SELECT pk, CASE WHEN s IS NULL THEN [] WHEN z IS NULL THEN [substr(content,s+1,160)] ELSE [substr(content,s+1,160),substr(content,z+1,160)] END AS f FROM c) SELECT pk, len(f)::INT AS n, sha256(array_to_string(f,'|')) AS digest FROM d")
def search_highlights(spark, sf):
    """I4: fragments of every document around three words."""
    h = R.highlights(V.docs(spark, sf), ["that", "with", "les"], key="pk")
    return h.select("pk", F.size("fragments").alias("n"), F.sha2(F.array_join("fragments", "|"), 256).alias("digest"))


@query(D + ", e AS (SELECT 'matters' AS field, source AS value FROM docs UNION ALL SELECT 'author', author FROM docs UNION ALL SELECT 'document_type', document_type FROM docs), c AS (SELECT field, value, count(*) n FROM e GROUP BY 1,2) SELECT field, value, n FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) r FROM c) WHERE r<=20")
def document_facets(spark, sf):
    """The 20 most frequent values of each field (a top-k report)."""
    return R.facets(V.docs(spark, sf), ["matters", "author", "document_type"]).select("field", "value", "n")


@query(D + " SELECT pk FROM docs WHERE source IN ('src1','src2','src3') AND document_type='en' AND (starts_with(raw_path,'reports/') OR starts_with(raw_path,'evidence/src1/') OR starts_with(raw_path,'analysis/'))  AND NOT starts_with(raw_path,'analysis/')")
def filtered_documents(spark, sf):
    """B3, B4, B10"""
    d = R.input_role(V.docs(spark, sf).withColumn("role", F.lit("input")))
    d = R.filter_documents(d, ["src1", "src2", "src3"], document_type="en")
    return R.filter_paths(d, ["reports/", "evidence/src1/", "analysis/"], exclude_analysis=True).select("pk")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id=42")
def one_document(spark, sf):
    """B6"""
    return R.get_document(V.table(spark, sf, "documents"), 42).select("doc_id", "n_chars")


# --- grounding: benchmark items as quotations, documents as held texts


def _grounding(spark, sf):
    """Files that quote each item beside two citations; each source is one authority, held as all its texts."""
    b = V.table(spark, sf, "benchmark")
    i = F.col("item_id")
    cite = lambda n: F.concat(F.lit("[2001] EWHC "), n.cast("string"), F.lit(" (Admin)"))
    text = F.concat(F.lit('As '), cite(i % 20), F.lit(' says, "'), F.regexp_replace("text", r"\s+", " "), F.lit('" and so on.\n\n'), F.lit("x" * 300), F.lit(" See s.7 of the Human Rights Act 1998; [2001] Foo."))
    files = b.select(F.concat(F.lit("reports/f"), i.cast("string"), F.lit(".md")).alias("file"), text.alias("text"), "item_id")
    d = V.table(spark, sf, "documents")
    n = F.regexp_replace("source", "src", "").cast("int")
    primary = d.where(n < 15).select(F.concat(F.lit("authorities_primary_text/"), "source", F.lit("/"), F.lit("2001_x_EWHC_"), n.cast("string"), F.lit("_Admin_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), "text")
    return files, primary


_HELD = "q AS (SELECT item_id, item_id%20 AS n, trim(regexp_replace(text,'[ \\t\\n\\r]+',' ','g')) AS quote FROM benchmark), d AS (SELECT replace(source,'src','')::INT AS n, trim(regexp_replace(text,'[ \\t\\n\\r]+',' ','g')) AS t FROM documents WHERE replace(source,'src','')::INT<15), v AS (SELECT q.item_id, CASE WHEN q.n>=15 THEN 'AMBER' WHEN max(contains(d.t,q.quote)::INT)=1 THEN 'GREEN' ELSE 'RED' END AS verdict FROM q LEFT JOIN d USING (n) GROUP BY q.item_id, q.n)"


@query(f"WITH {_HELD} SELECT 'reports/f' || item_id || '.md' AS file, verdict FROM v")
def quote_verdicts(spark, sf):
    """C9, C10, C12, F10, G20-G22, J1"""
    files, primary = _grounding(spark, sf)
    spans = G.scan(files)
    v = G.verdicts(G.near_citations(G.quotes(spans), G.references(spans)), G.hold(primary, _new(spark, "held")))
    return v.select("file", "verdict")


@query(f"WITH {_HELD}, f AS (SELECT 'quote' AS kind, verdict, count(*) AS n FROM v GROUP BY 2 UNION ALL SELECT 'malformed_citation','AMBER',count(*) FROM q UNION ALL SELECT 'citation_without_source','AMBER',1+count(DISTINCT n) FROM q WHERE n>=15) SELECT kind, verdict, n FROM f")
def grounding_counts(spark, sf):
    """D12, F9, G18, G19, G23, C11"""
    files, primary = _grounding(spark, sf)
    return G.finding_counts(G.findings(files, primary, held=G.hold(primary, _new(spark, "held"))))


@query("WITH q AS (SELECT item_id, trim(regexp_replace(text,'[ \\t\\n\\r]+',' ','g')) AS quote FROM benchmark), d AS (SELECT trim(regexp_replace(text,'[ \\t\\n\\r]+',' ','g')) AS t FROM documents) SELECT item_id FROM q WHERE EXISTS (SELECT 1 FROM d WHERE contains(d.t, substr(q.quote, 3, greatest(length(q.quote)-4,1))))")
def contained_passages(spark, sf):
    """Items, without their first and last letters, in any text of one authority that has all documents."""
    b = V.table(spark, sf, "benchmark").select("item_id", T.quote_norm(F.col("text")).alias("q"))
    cut = b.select("item_id", F.expr("substr(q, 3, greatest(length(q) - 4, 1))").alias("quote"))
    texts = V.table(spark, sf, "documents").select(F.lit("all").alias("key"), F.col("doc_id").alias("path"), T.quote_norm(F.col("text")).alias("text"))
    found = W.contained(cut.select(F.lit("all").alias("key"), "quote"), texts)
    return cut.join(found, "quote").select("item_id")


@query("SELECT 'stat:human rights act 1998 s7' AS key, count(*) AS files FROM benchmark UNION ALL SELECT 'ncit:2001 ewhc ' || (item_id%20) || ' admin', count(*) FROM benchmark WHERE item_id%20>=15 GROUP BY item_id%20")
def blast_radius(spark, sf):
    """D11"""
    files, primary = _grounding(spark, sf)
    return G.blast_radius(G.references(G.scan(files)), G.held_texts(primary)).select("key", "files")


@query("SELECT count(*) AS primary_texts, (SELECT count(*) FROM benchmark) AS files_scanned FROM documents WHERE replace(source,'src','')::INT<15")
def held_counts(spark, sf):
    """D13"""
    files, primary = _grounding(spark, sf)
    return G.held_counts(G.held_texts(primary), files)


@query("SELECT item_id, 'ncit:2001 ewhc ' || (item_id%20) || ' admin' AS keys FROM benchmark")
def citation_keys(spark, sf):
    """G18, built-in only"""
    files, _ = _grounding(spark, sf)
    return files.select("item_id", F.array_join(G.citation_keys(F.col("text")), ",").alias("keys"))


# --- enrichment


def _completions(spark, sf):
    """A completion for each document: full, with a claim lacking an object, with odd types, or cut off."""
    i = F.col("pk")
    num = i.cast("string")
    body = F.concat(
        F.lit('{"summary": "s'), num, F.lit('", "keywords": ["k1", "", "k'), (i % 5).cast("string"), F.lit('"], "claims": [{"subject": "a", "predicate": "is", "object": '), num,
        F.lit(', "polarity": '), F.when(i % 3 == 0, '"No"').otherwise("true"), F.lit(', "confidence": '), F.when(i % 4 == 0, "7").otherwise("0.5"),
        F.lit(', "epistemic_status": "'), F.when(i % 2 == 0, "Quoted").otherwise("guess"), F.lit('"}, {"subject": "b", "predicate": "is", "object": ""}]}'),
    )
    return V.docs(spark, sf).withColumn("completion", F.when(i % 10 == 9, F.expr("left(content, 20)")).otherwise(body)).select("pk", "completion", F.col("author").alias("own_author"))


@query("SELECT doc_id AS pk, CASE WHEN doc_id%10=9 THEN '' ELSE 's' || doc_id END AS summary, CASE WHEN doc_id%10=9 THEN '' ELSE 'k1,k' || (doc_id%5) END AS keywords, CASE WHEN doc_id%10=9 THEN 0 ELSE 1 END AS claims, CASE WHEN doc_id%10<>9 THEN doc_id%3<>0 END AS polarity, CASE WHEN doc_id%10<>9 AND doc_id%4<>0 THEN 0.5 END AS confidence, CASE WHEN doc_id%10<>9 AND doc_id%2=0 THEN 'quoted' END AS status FROM documents")
def parsed_completions(spark, sf):
    """G10"""
    p = N.parse_completions(_completions(spark, sf))
    c = F.get("claims", F.lit(0))
    return p.select("pk", "summary", F.array_join("keywords", ",").alias("keywords"), F.size("claims").alias("claims"), c["polarity"].alias("polarity"), c["confidence"].alias("confidence"), c["epistemic_status"].alias("status"))


@query("SELECT doc_id AS pk, CASE WHEN doc_id%10=9 THEN 'base,base' WHEN doc_id%5=1 THEN 'base,base,k1' ELSE 'base,base,k1,k' || (doc_id%5) END AS keywords, CASE WHEN doc_id%10<>9 THEN 'witness' END AS speaker FROM documents")
def merged_enrichment(spark, sf):
    """Base keywords keep their repeats; the claim source speaks every claim."""
    p = N.parse_completions(_completions(spark, sf))
    base = p.select("pk", F.array(F.lit("base"), F.lit("base")).alias("keywords"), F.array().cast("array<string>").alias("entities"), F.col("own_author").alias("author"), F.lit(None).cast("string").alias("document_type"), F.lit(" witness ").alias("claim_source"))
    m = N.merge_enrichment(base, p, "pk")
    return m.select("pk", F.array_join("keywords", ",").alias("keywords"), F.get("claims", F.lit(0))["asserted_by"].alias("speaker"))


@query(D + " SELECT pk, CASE WHEN pk%4=0 THEN 'folder' ELSE author END AS author FROM docs")
def overlaid_fields(spark, sf):
    """G12"""
    d = V.docs(spark, sf)
    r = d.select("raw_path", F.when(F.col("pk") % 4 == 0, "folder").alias("author"))
    return N.overlay(d, r, ["author"]).select("pk", "author")


@query(D + " SELECT pk, author, source AS matter, no_index_category IS NOT NULL AS has_category FROM docs")
def index_round_trip(spark, sf):
    """To the stored JSON and back; nulls are dropped on the way and come back as null."""
    d = V.docs(spark, sf).select("pk", "raw_path", "author", "matters", "no_index_category")
    stored = N.index_document(d, "pk").withColumn("_id", F.concat(F.lit("gb_"), F.col("pk").cast("string")))
    back = A.docs_from_source(stored)
    return stored.join(back, stored["_id"] == back["doc_id"]).select("pk", "author", F.get("matters", F.lit(0)).alias("matter"), F.contains("source", F.lit("no_index_category")).alias("has_category"))


@query("SELECT doc_id, sha256(regexp_extract(text,'^((?:\\s*(?:[0-9A-Za-z_]+|[^0-9A-Za-z_\\s])){0,100})',1)) AS lead FROM documents")
def lead_texts(spark, sf):
    """G28"""
    return V.table(spark, sf, "documents").select("doc_id", F.sha2(N.lead_text(F.col("text"), 100), 256).alias("lead"))


@query("SELECT doc_id, CASE WHEN n_chars<20 THEN 'too short' WHEN NOT contains(lower(trim(text)),'e') THEN 'text missing' ELSE 'ok' END AS verdict FROM (SELECT doc_id, text, length(trim(text)) n_chars FROM documents)")
def extraction_expectations(spark, sf):
    """G27"""
    d = V.table(spark, sf, "documents")
    none, no = F.lit(None).cast("string"), F.lit(False)
    return d.select("doc_id", N.expectation(F.col("text"), none, F.lit(20), no, no, F.lit("E")).alias("verdict"))


def _backwards(texts):
    return [t and t[::-1] for t in texts]


@query("SELECT doc_id, sha256(array_to_string(list_reverse(string_split(text,'')),'')) AS digest, CASE WHEN text='' OR text IS NULL THEN 'empty' ELSE 'ok' END AS status FROM documents")
def applied_function(spark, sf):
    """A caller's function in batches, over every text."""
    r = N.apply_to_texts(V.table(spark, sf, "documents"), _backwards, "doc_id", "text")
    return r.select("doc_id", F.sha2("result", 256).alias("digest"), "status")


# --- guards, stores and streams


@query(DR + " SELECT CASE WHEN excl_kind IS NOT NULL THEN 'registry' WHEN no_index THEN 'no_index' END AS refused, CASE WHEN excl_kind IS NOT NULL THEN 'legally_obligatory' WHEN no_index THEN coalesce(no_index_category,'legally_obligatory') END AS alert_category, count(*) AS n FROM classified GROUP BY 1,2")
def guarded_writes(spark, sf):
    """K1"""
    return K.guarded(V.docs(spark, sf), V.registry(spark, sf), "pk").groupBy("refused", "alert_category").agg(F.count("*").alias("n"))


@query(D + " SELECT 'kept' AS part, count(*) AS n FROM docs WHERE NOT (starts_with(raw_path,'telegram/') OR starts_with(raw_path,'exhibits/src0')) UNION ALL SELECT 'removed', count(*) FROM docs WHERE starts_with(raw_path,'telegram/') OR starts_with(raw_path,'exhibits/src0')")
def deindexed(spark, sf):
    """K2"""
    kept, gone = K.deindex(V.docs(spark, sf), ["telegram/", "exhibits/src0"])
    return kept.select(F.lit("kept").alias("part")).unionByName(gone.select(F.lit("removed").alias("part"))).groupBy("part").agg(F.count("*").alias("n"))


@query(D + " SELECT pk FROM docs WHERE in_index AND present")
def tombstoned(spark, sf):
    """K3"""
    d = V.docs(spark, sf)
    return K.tombstone(d.where("in_index"), d.where("present")).select("pk")


@query(D + " SELECT array_to_string(list_filter([CASE WHEN pk%6=0 THEN 'primary_matter' END, CASE WHEN pk%5=0 THEN 'sensitivity' END, CASE WHEN pk%7=0 THEN 'source_channel' END], lambda x: x IS NOT NULL),',') AS errors, count(*) AS n FROM docs GROUP BY 1")
def validation_errors(spark, sf):
    """K6"""
    i = F.col("pk")
    e = K.validation_errors(F.col("matters"), F.when(i % 6 == 0, "other").otherwise(F.col("source")), F.when(i % 5 == 0, "odd").otherwise(F.col("sensitivity")), F.lit("served"), F.when(i % 7 == 0, "odd").otherwise("unknown"))
    return V.docs(spark, sf).groupBy(F.array_join(e, ",").alias("errors")).agg(F.count("*").alias("n"))


@query(D + " SELECT pk, CASE WHEN pk%2=0 THEN 2 ELSE 1 END AS ingested_at FROM docs")
def upserted(spark, sf):
    """Every second document comes again, twice."""
    d = V.docs(spark, sf).select("pk")
    new = d.where("pk % 2 = 0").withColumn("ingested_at", F.lit(2))
    once = K.upsert(d.withColumn("ingested_at", F.lit(1)), new, "pk")
    return K.upsert(once, new, "pk")


@query(D + " SELECT CASE WHEN no_index THEN 'no_index' ELSE 'written' END AS outcome, count(*) AS n FROM docs GROUP BY 1")
def extracted_outcomes(spark, sf):
    """The store of extracted texts is written; what became of each document."""
    return A.write_extracted(V.docs(spark, sf).withColumnRenamed("pk", "doc_id"), _new(spark, "extracted"))


@query(D + " SELECT tree, raw_path || '.md' AS target, sha256('---' || chr(10) || 'raw_path: {\"raw_path\":\"' || raw_path || '\"}' || chr(10) || '---' || chr(10) || content) AS digest FROM docs WHERE NOT no_index")
def extracted_store(spark, sf):
    """The texts that were written, read back by tree."""
    path = _new(spark, "extracted")
    A.write_extracted(V.docs(spark, sf).withColumnRenamed("pk", "doc_id"), path)
    return spark.read.parquet(path).select("tree", "target", F.sha2("text", 256).alias("digest"))


def _docs_store(spark, sf, buckets=64):
    """A store of all documents' paths, as they were ingested first."""
    d = V.docs(spark, sf).select("pk", "raw_path", "author", F.lit(1).alias("ingested_at"))
    store = Store.create(d.limit(0), _new(spark, "store"), "pk", "ingested_at", buckets)
    store.upsert(d)
    return store


@query(D + " SELECT pk, CASE WHEN pk%100=7 THEN 'new' ELSE author END AS author, CASE WHEN pk%100=7 THEN 2 ELSE 1 END AS ingested_at FROM docs")
def stored_upserts(spark, sf):
    """A stored table; every hundredth document comes again, newer, then again as it is, then older."""
    store = _docs_store(spark, sf)
    new = V.docs(spark, sf).where("pk % 100 = 7").select("pk", "raw_path", F.lit("new").alias("author"), F.lit(2).alias("ingested_at"))
    for rows in (new, new, new.withColumns({"ingested_at": F.lit(0), "author": F.lit("old")})):
        store.upsert(rows)
    return store.read().select("pk", "author", "ingested_at")


@query(D + " SELECT 'stored' AS part, split_part(raw_path,'/',1) || '/' || source AS name, count(*) AS n FROM docs WHERE NOT (starts_with(raw_path,'telegram/') OR starts_with(raw_path,'exhibits/src0')) GROUP BY 2 UNION ALL SELECT * FROM (VALUES ('registry','telegram/',1),('registry','exhibits/src0',1)) v(part,name,n)")
def stored_deindexing(spark, sf):
    """K2: a dry run, the run, and a second run on the store; what is left, and the prefixes that were recorded."""
    store, registry = _docs_store(spark, sf), _new(spark, "registry")
    for dry in (True, False, False):
        store.deindex(["telegram/", "exhibits/src0"], "undertaking", registry, dry_run=dry)
    at = F.split("raw_path", "/")
    left = store.read().groupBy(F.lit("stored").alias("part"), F.concat_ws("/", F.get(at, F.lit(0)), F.get(at, F.lit(1))).alias("name")).agg(F.count("*").alias("n"))
    return left.unionByName(A.read_exclusions(spark, registry).groupBy(F.lit("registry").alias("part"), F.col("raw_path").alias("name")).agg(F.count("*").alias("n")))


@query(D + " SELECT pk FROM docs WHERE present")
def stored_tombstones(spark, sf):
    """K3 on the store."""
    store = _docs_store(spark, sf)
    store.tombstone(V.docs(spark, sf).where("present"))
    return store.read().select("pk")


@query(D + " SELECT pk AS idx, raw_path, CASE WHEN pk%2=0 THEN 'deindex' ELSE 'manual' END AS source, CASE WHEN pk%3=0 THEN sha256 END AS raw_sha256 FROM docs WHERE pk%10>=3")
def parsed_exclusions(spark, sf):
    """A4: registry lines with comments, blanks and broken ones."""
    i = F.col("pk")
    rec = F.to_json(F.struct("raw_path", F.lit("r").alias("reason"), F.when(i % 2 == 0, "deindex").alias("source"), F.when(i % 3 == 0, F.upper("sha256")).alias("raw_sha256")))
    line = F.when(i % 10 == 0, "# note").when(i % 10 == 1, "  ").when(i % 10 == 2, '{"raw_path": ').otherwise(rec)
    r = A.parse_exclusions(V.docs(spark, sf).select(line.alias("value"), i.alias("pos")))
    return r.select("idx", "raw_path", "source", "raw_sha256")


@query(D + " SELECT pk, 'gb_' || sha256(raw_path || chr(0) || 'body ' || pk) AS doc_id, CASE WHEN pk%8<>0 THEN author END AS author, CASE WHEN pk%8=0 THEN 'no raw_path' END AS error FROM docs WHERE pk%9<>0 AND pk%8<>0 UNION ALL SELECT pk, NULL, NULL, 'no raw_path' FROM docs WHERE pk%9<>0 AND pk%8=0")
def frontmatter_documents(spark, sf):
    """A7"""
    i = F.col("pk")
    text = F.concat(F.lit("---\nauthor: "), "author", F.lit("\nraw_path: "), "raw_path", F.lit("\n---\nbody "), i.cast("string"))
    path = F.concat(F.lit("x/"), i.cast("string"), F.when(i % 9 == 0, "/README.md").otherwise(".md"))
    d = A.docs_from_frontmatter(V.docs(spark, sf).select(path.alias("path"), F.when(i % 8 == 0, F.concat(F.lit("body "), i.cast("string"))).otherwise(text).alias("text")))
    num = F.regexp_extract("content", r"(\d+)\s*$", 1).cast("long")
    return d.select(num.alias("pk"), F.col("doc_id"), F.col("meta")["author"].alias("author"), "error")


@query("SELECT epoch_us(date_trunc('hour',ts)) AS start, CASE event_id%4 WHEN 0 THEN 'received' WHEN 1 THEN 'extracted' WHEN 2 THEN 'enriched' ELSE 'indexed' END AS stage, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'ok' END AS status, count(*) AS n FROM events GROUP BY 1,2,3")
def live_counts(spark, sf):
    """L7 over the whole table; the tests run the same function as a stream."""
    return J.live_counts(V.events(spark, sf)).select(F.unix_micros("start").alias("start"), "stage", "status", "n")


@query("WITH w AS (SELECT ts, epoch(ts)-epoch(lag(ts) OVER (ORDER BY ts))>=900 AS new FROM events), s AS (SELECT ts, sum(coalesce(new,true)::INT) OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) g FROM w) SELECT epoch_us(min(ts)) AS start, count(*) AS n FROM s GROUP BY g")
def activity_sessions(spark, sf):
    """Sessions that a quarter of an hour without events ends."""
    return J.activity(V.events(spark, sf)).select(F.unix_micros("start").alias("start"), "n")


@query("WITH l AS (SELECT user_id, list([epoch(date_trunc('second',ts))::BIGINT, event_id] ORDER BY ts, event_id::VARCHAR) AS l FROM events GROUP BY 1), k AS (SELECT list_reduce(list_transform(l, lambda x: [x]), lambda a, x: CASE WHEN x[1][1]-a[len(a)][1]>120 THEN list_concat(a,x) ELSE a END) AS k FROM l) SELECT unnest(list_transform(k, lambda x: x[2])) AS event_id FROM k")
def deduplicated_triggers(spark, sf):
    """L1, batch twin: users as commits; the window runs from the trigger that was kept."""
    t = V.events(spark, sf).select(F.col("user_id").cast("string").alias("sha"), "ts", "event_id")
    return J.dedup_batch(t, "event_id").select("event_id")


@query("WITH a AS (SELECT user_id, event_id%7 AS attempt, event_type FROM events), l AS (SELECT user_id, max(attempt) m FROM a GROUP BY 1), r AS (SELECT a.user_id, l.m, bool_and(event_type IN ('view','click')) done FROM a JOIN l ON l.user_id=a.user_id AND l.m=a.attempt GROUP BY 1,2), x AS (SELECT user_id::VARCHAR AS sha, m::INT AS attempt, CASE WHEN done THEN 'ack' WHEN m>=5 THEN 'dead_letter' ELSE 'retry' END AS action FROM r) SELECT *, CASE WHEN action='retry' THEN [30,60,120,300][greatest(least(attempt,4),1)] END::INT AS retry_after FROM x")
def delivery_actions(spark, sf):
    """L4, batch twin: users as commits, event types as file results; attempt 0 waits as the first."""
    s = F.when(F.col("event_type").isin("view", "click"), "indexed").otherwise("failed")
    e = V.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("sha"), (F.col("event_id") % 7).cast("int").alias("attempt"), s.alias("s"))
    a = e.groupBy("sha", "attempt").agg(F.collect_list("s").alias("statuses"))
    return J.delivery_state(a).select("sha", "attempt", "action", "retry_after")


@query("SELECT user_id AS commit, event_id AS path, CASE WHEN event_id%5<3 THEN 'indexed' ELSE 'missing' END AS result FROM events")
def awaited_outcomes(spark, sf):
    """Each event is a changed file; of five, three have an outcome in time, one too late, one never. The tests run it as streams."""
    e, i = V.events(spark, sf), F.col("event_id")
    commits = e.select(F.col("user_id").alias("commit"), i.alias("path"), "ts")
    late = F.when(i % 5 < 3, F.expr("interval 30 minutes")).otherwise(F.expr("interval 2 hours"))
    outcomes = e.where("event_id % 5 < 4").select(F.col("user_id").alias("commit"), i.alias("path"), F.lit("indexed").alias("result"), (F.col("ts") + late).alias("done_at"))
    return J.awaited_results(commits, outcomes).select("commit", "path", "result")


def _new(spark, name):
    """A folder of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_TREE = D + ", f AS (SELECT split_part(raw_path,'/',1) AS tree, source, pk//6400 AS part, string_agg(content || chr(10), '' ORDER BY pk) AS t FROM docs GROUP BY 1,2,3) SELECT tree, source, part, octet_length(encode(t))::BIGINT AS size, sha256(t) AS sha256 FROM f"


def _written_tree(spark, sf):
    """A tree of files, each with the texts of at most 1,280 documents of one folder."""
    path = _new(spark, "raw")
    d = V.docs(spark, sf).select(F.get(F.split("raw_path", "/"), F.lit(0)).alias("tree"), "source", F.floor(F.col("pk") / 6400).alias("part"), "pk", "content")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("pk", "content"))), lambda x: x["content"])
    d.groupBy("tree", "source", "part").agg(F.array_join(texts, "\n").alias("value")).write.partitionBy("tree", "source", "part").text(path)
    return path


def _named(t):
    name = lambda k: F.regexp_extract("raw_path", f"(?:^|/){k}=([^/]*)/", 1)
    return t.select(name("tree").alias("tree"), name("source").alias("source"), name("part").cast("long").alias("part"), "size", "sha256")


@query(_TREE)
def raw_tree(spark, sf):
    """A1: files with the documents' texts, written and walked."""
    return _named(A.read_raw_tree(spark, _written_tree(spark, sf)))


@query(_TREE)
def hashed_tree(spark, sf):
    """A1: the same tree by the source that reads files of any size in chunks."""
    return _named(B.hash_raw_tree(spark, _written_tree(spark, sf)))


@query(D + " SELECT sha256, min(raw_path) AS raw_path, count(DISTINCT raw_path) AS paths FROM docs WHERE in_manifest GROUP BY 1")
def manifest_round_trip(spark, sf):
    """A2, A3: entries with upper-case hashes as JSON objects of at most 2,000, one a file, read, written with one entry a hash, read back."""
    d = V.docs(spark, sf).where("in_manifest")
    files = d.groupBy(F.floor(F.col("pk") / 2000).alias("f")).agg(F.collect_list(F.struct(F.upper("sha256").alias("k"), "raw_path")).alias("e"))
    body = F.concat(F.lit("{"), F.array_join(F.transform("e", lambda e: F.concat(F.lit('"'), e["k"], F.lit('": '), F.to_json(F.struct(e["raw_path"].alias("raw_path"))))), ","), F.lit("}"))
    source, target = _new(spark, "manifest"), _new(spark, "manifest")
    files.repartition("f").select("f", body.alias("value")).write.partitionBy("f").option("maxRecordsPerFile", 1).text(source)
    entries = A.read_manifest(spark, f"{source}/*")
    A.write_manifest(entries, target)
    paths = entries.groupBy("sha256").agg(F.count_distinct("raw_path").alias("paths"))
    return spark.read.parquet(target).select("sha256", "raw_path").join(paths, "sha256")


@query(D + " SELECT raw_path, CASE WHEN pk%3=0 THEN 'deindex' ELSE 'manual' END AS source, CASE WHEN pk%2=0 THEN sha256 END AS raw_sha256, NULL::VARCHAR AS error FROM docs WHERE pk%5<>0 AND pk%7<>0 UNION ALL SELECT raw_path, CASE WHEN pk%7=0 THEN 'robot' WHEN pk%3=0 THEN 'deindex' ELSE 'manual' END, NULL, CASE WHEN pk%5=0 THEN 'reason' ELSE 'source' END FROM docs WHERE pk%5=0 OR pk%7=0")
def appended_exclusions(spark, sf):
    """A5: entries without reason or of unknown source are rejected; the others are appended in two runs and read back."""
    i, path = F.col("pk"), _new(spark, "registry")
    e = V.docs(spark, sf).select(
        "raw_path", F.when(i % 5 == 0, " ").otherwise("why").alias("reason"), F.lit("t").alias("timestamp"),
        F.when(i % 7 == 0, "robot").when(i % 3 == 0, "deindex").otherwise("manual").alias("source"), F.when(i % 2 == 0, F.upper("sha256")).alias("raw_sha256"), "pk",
    )
    bad = [A.append_exclusions(e.where(f"pk % 2 = {k}").drop("pk"), path) for k in (0, 1)]
    out = A.read_exclusions(spark, path).select("raw_path", "source", "raw_sha256", F.lit(None).cast("string").alias("error"))
    for b in bad:
        out = out.unionByName(b.select("raw_path", "source", F.lit(None).cast("string").alias("raw_sha256"), "error"))
    return out


@query(EV + " SELECT strftime(ts,'%Y-%m-%d') AS day, count(*)*2 AS events, count(DISTINCT event_id) AS ids, 0::BIGINT AS files FROM ev GROUP BY 1")
def appended_events(spark, sf):
    """A10: the log, appended twice; its partitions are days."""
    path = _new(spark, "events")
    for _ in range(2):
        A.append_events(V.events(spark, sf), path)
    e = spark.read.parquet(path)
    return e.groupBy(F.date_format("date", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"), F.sum((F.to_date("ts") != F.col("date")).cast("long")).alias("files"))


@query(DR + " SELECT CASE WHEN excl_kind IS NULL AND no_index_category='housekeeping' THEN 'noise' ELSE 'incident' END AS severity, count(*) AS n, min(pk) AS first FROM classified WHERE excl_kind IS NOT NULL OR no_index GROUP BY 1")
def appended_alerts(spark, sf):
    """K5: an alert for each refused document, stored by severity."""
    path = _new(spark, "alerts")
    g = K.guarded(V.docs(spark, sf), V.registry(spark, sf), "pk").where("refused is not null")
    A.append_alerts(g.select(F.lit(AS_OF).alias("ts"), "pk", T.severity(F.col("alert_category")).alias("severity")), path)
    return spark.read.parquet(path).groupBy("severity").agg(F.count("*").alias("n"), F.min("pk").alias("first"))


@query("SELECT 'part ' || p_partkey || x AS alias, 'part no. ' || p_partkey AS canonical FROM part, (VALUES ('a'),(' b')) v(x)")
def alias_map(spark, sf):
    """Names of parts as JSON objects, one a file; both sides are normalized."""
    k, path = F.col("p_partkey").cast("string"), _new(spark, "aliases")
    entry = F.concat(F.lit('"  Part No. '), k, F.lit('": ["PART '), k, F.lit('a", "part   '), k, F.lit(' B "]'))
    files = V.table(spark, sf, "part").groupBy((F.col("p_partkey") % 16).alias("f")).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}")).alias("value"))
    files.repartition("f").write.partitionBy("f").option("maxRecordsPerFile", 1).text(path)
    return A.read_aliases(spark, f"{path}/*")


@query(EV + " SELECT event_id, stage, status FROM ev")
def projected_events(spark, sf):
    """The log as a stream of files, in bounded passes, delivered twice; each event is stored once."""
    source, store = _new(spark, "stream"), _new(spark, "store")
    e = V.events(spark, sf).select("event_id", "stage", "status")
    e.repartition(4).write.parquet(source)
    for run in ("first", "again"):
        s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(source)
        P.project_idempotently(s, store, "event_id", f"{store}-{run}").awaitTermination()
    return P.read_projection(spark, store, e.schema)


@query(EV + " SELECT event_id, 'msg_' || sha256(CASE WHEN event_id%3<>0 THEN 'seq' || chr(0) || 'pipeline' || chr(0) || event_id ELSE 'msg' || chr(0) || 'stage.' || stage || chr(0) || epoch_us(ts) || chr(0) || event_id END) AS message_id, CASE WHEN event_id%4=1 THEN 2 ELSE 1 END::BIGINT AS deliveries FROM ev")
def archived_messages(spark, sf):
    """Each event as a message, every fourth delivered twice, every third without a sequence number."""
    e, i = V.events(spark, sf), F.col("event_id")
    m = e.select(F.lit("pipeline").alias("stream"), F.when(i % 3 != 0, i).alias("sequence"), F.concat(F.lit("stage."), "stage").alias("subject"), "ts", i.cast("string").alias("payload"), "event_id")
    return E.archived(m.unionByName(m.where("event_id % 4 = 1"))).select("event_id", "message_id", "deliveries")


@query("SELECT event_id AS event_id, event_type='error' AS poison FROM events")
def parsed_triggers(spark, sf):
    """L2: messages without a readable commit are set apart."""
    body = F.to_json(F.struct(F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("sha"), "ts"))
    e = V.table(spark, sf, "events")
    good, bad = J.parse_triggers(e.select(F.when(F.col("event_type") == "error", F.concat(F.lit("{x "), F.col("event_id").cast("string"))).otherwise(body).alias("value")))
    return good.select(F.col("sha").cast("long").alias("event_id"), F.lit(False).alias("poison")).unionByName(bad.select(F.regexp_extract("value", r"(\d+)", 1).cast("long").alias("event_id"), F.lit(True).alias("poison")))


@query(D + " SELECT pk, CASE WHEN pk%5=0 THEN false ELSE true END AS resolved, CASE WHEN pk%5<>0 THEN raw_path END AS path FROM docs WHERE pk%5=0 OR (pk%6<>0 AND ext<>'mp4')")
def resolved_changes(spark, sf):
    """L3: a commit for each document; some commits are unknown, some changes are deletions."""
    d = V.docs(spark, sf)
    i = F.col("pk")
    changes = d.where("pk % 5 <> 0").select(i.alias("commit"), F.when(i % 6 == 0, "D").otherwise("M").alias("status"), F.col("raw_path").alias("path"))
    return J.changed_files(d.select(i.alias("sha"), F.lit(0).alias("ts")), changes).select(F.col("sha").alias("pk"), "resolved", "path")
