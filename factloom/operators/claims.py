"""Attributed claims: exploding, filtering, and finding where accounts contradict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.sources.shared import checkpoint, stored

#: Claims of a subject and predicate up to which pairs are made where only their number is asked for.
PAIRED = 2_000


def explode_claims(docs: DataFrame) -> DataFrame:
    """One row per claim with claim_idx; documents without claims give none. Keeps doc_id, raw_path, matters."""
    return docs.select("doc_id", "raw_path", "matters", F.posexplode("claims").alias("claim_idx", "c")).select(
        "doc_id", "raw_path", "matters", "claim_idx", "c.*"
    )


def canonical_speaker(claims: DataFrame, aliases: DataFrame, column: str = "asserted_by") -> DataFrame:
    """Adds canonical_speaker: the alias map's name, else the normalized one; null where empty.

    aliases(alias, canonical), normalized here; one canonical name per alias (the smallest).
    """
    names = aliases.select(T.norm(F.col("alias")).alias("_alias"), T.norm(F.col("canonical")).alias("_canonical"))
    names = names.groupBy("_alias").agg(F.min("_canonical").alias("_canonical"))
    keyed = claims.withColumn("_alias", T.norm(F.col(column)))
    own = F.coalesce("_canonical", "_alias")
    return keyed.join(names, "_alias", "left").withColumn("canonical_speaker", F.when(own != "", own)).drop("_alias", "_canonical")


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def find_claims(
    claims: DataFrame,
    asserted_by: str | None = None,
    subject: str | None = None,
    object_: str | None = None,
    text: str | None = None,
    per_doc: int | None = 25,
    max_docs: int | None = 20,
) -> DataFrame:
    """Claims that meet every condition at once, at most per_doc of a document and max_docs documents.

    "match" shares a lower-case word; text looks into subject, predicate and object. score counts the
    shared words. A cap of None takes all. Documents are ranked by their best claim, then by id.
    """
    q = claims.withColumn("score", F.lit(0))
    if asserted_by is not None:
        q = q.where(F.col("asserted_by") == asserted_by)
    for col, want in (("subject", subject), ("object", object_)):
        if want is not None:
            n = F.size(F.array_intersect(_words(F.col(col)), _words(F.lit(want))))
            q = q.where(n > 0).withColumn("score", F.col("score") + n)
    if text is not None:
        n = F.size(F.array_intersect(_words(F.concat_ws(" ", "subject", "predicate", "object")), _words(F.lit(text))))
        q = q.where(n > 0).withColumn("score", F.col("score") + n)
    if per_doc is not None:
        nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "claim_idx"))
        q = q.withColumn("_nth", nth).where(F.col("_nth") <= per_doc).drop("_nth")
    if max_docs is not None:
        best = q.groupBy("doc_id").agg(F.max("score").alias("_best")).orderBy(F.desc("_best"), "doc_id").limit(max_docs)
        q = q.join(F.broadcast(best.select("doc_id")), "doc_id", "left_semi")  # max_docs rows
    return q


def _narrow(claims: DataFrame, aliases: DataFrame) -> DataFrame:
    return canonical_speaker(claims, aliases).select(
        T.norm(F.col("subject")).alias("s"),
        T.norm(F.col("predicate")).alias("p"),
        T.norm(F.col("object")).alias("o"),
        F.coalesce("polarity", F.lit(True)).alias("pol"),
        "doc_id",
        "claim_idx",
        F.col("raw_path").cast("string").alias("raw_path"),
        F.col("source_span").cast("string").alias("source_span"),
        F.col("canonical_speaker").alias("who"),
        F.col("asserted_by").cast("string").alias("asserted_by"),
    )


def _placed(narrow: DataFrame) -> DataFrame:
    """With what tells representations apart, stem and span, in place of the path and the raw span; neg:
    the predicate negates, told once a claim and not for each pair."""
    stem, span = F.coalesce(T.doc_stem(F.col("raw_path")), F.lit("")), T.norm(F.col("source_span"))
    return narrow.withColumn("stem", stem).withColumn("span", span).withColumn("neg", T.is_negation(F.col("p"))).drop("raw_path", "source_span")


def contradictions(claims: DataFrame, aliases: DataFrame, max_docs: int | None = None, max_claims_per_doc: int | None = None, one_speaker: bool = False) -> DataFrame:
    """Pairs of claims of one (subject, predicate) that conflict.

    claims(doc_id, claim_idx, raw_path, subject, predicate, object, polarity, asserted_by, source_span).
    Left is the claim of smaller (doc_id, claim_idx). Pairs of one representation, and opposite polarity
    under a negating predicate with different objects, are no conflict. tier: CONTRADICTION or LEAD for
    one speaker, contested otherwise (also without a speaker). Groups that can hold no conflict are cut
    before the self-join; both sides keep the partitioning by (subject, predicate), which Spark splits
    where a group is large. Uncapped unless caps are given. one_speaker: only pairs of
    one speaker, who is then part of the groups and of the join's key. The claims are made once and written to the shared
    folder; with one_speaker only those whose group can hold a conflict are.
    """
    if max_docs is not None:
        claims = claims.join(claims.select("doc_id").distinct().orderBy("doc_id").limit(max_docs), "doc_id", "left_semi")
    if max_claims_per_doc is not None:
        nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("claim_idx"))
        claims = claims.withColumn("_nth", nth).where(F.col("_nth") <= max_claims_per_doc).drop("_nth")
    narrow = _narrow(claims, aliases)
    if one_speaker:
        # Most groups of a speaker are one claim: grouping them would combine nothing before its shuffle.
        own = Window.partitionBy("s", "p", "who")
        differ = lambda c: F.min(c).over(own) != F.max(c).over(own)
        held = narrow.where("who is not null").withColumn("_open", differ("pol") | differ("o")).where("_open").drop("_open")
        return _pairs(stored(_placed(held)), True)
    narrow = stored(_placed(narrow))
    return _pairs(narrow.join(_conflicting(narrow), ["s", "p"]))


def _conflicting(narrow: DataFrame) -> DataFrame:
    """(s, p, n): groups that can hold a conflict, and the number of their claims."""
    ends = narrow.groupBy("s", "p").agg(F.min("pol").alias("a"), F.max("pol").alias("b"), F.min("o").alias("c"), F.max("o").alias("d"), F.count("*").alias("n"))
    return ends.where("a <> b or c <> d").select("s", "p", "n")


def _pairs(side: DataFrame, one_speaker: bool = False) -> DataFrame:
    left, right = side.alias("l"), side.alias("r")
    lc, rc = (lambda n: F.col(f"l.{n}")), (lambda n: F.col(f"r.{n}"))
    opposite = lc("pol") != rc("pol")
    on = (
        (lc("s") == rc("s")) & (lc("p") == rc("p"))
        & (F.struct(lc("doc_id"), lc("claim_idx")) < F.struct(rc("doc_id"), rc("claim_idx")))
        & (opposite | (lc("o") != rc("o")))
        & (lc("doc_id") != rc("doc_id"))
        & ~((lc("stem") != "") & (lc("stem") == rc("stem")))
        & ~((lc("span") != "") & (lc("span") == rc("span")))
        & ~(opposite & (lc("o") != rc("o")) & lc("neg"))
    )
    if one_speaker:
        on = on & (lc("who") == rc("who"))
    within = F.coalesce(lc("who") == rc("who"), F.lit(False))
    kind = F.when(opposite, "opposite_polarity").otherwise("conflicting_object")
    return left.join(right, on).select(
        lc("s").alias("subject"), lc("p").alias("predicate"),
        lc("doc_id").alias("left_doc"), lc("claim_idx").alias("left_idx"), rc("doc_id").alias("right_doc"), rc("claim_idx").alias("right_idx"),
        kind.alias("kind"),
        F.when(within, "within_speaker").otherwise("contested").alias("scope"),
        F.when(within, lc("asserted_by")).alias("asserted_by"),
        F.when(~within, "contested").when(opposite, "CONTRADICTION").otherwise("LEAD").alias("tier"),
    )


def contradiction_counts(claims: DataFrame, aliases: DataFrame, most: int = PAIRED) -> DataFrame:
    """(subject, predicate, tier, kind, pairs): what contradictions() has of each, for pairs > 0.

    Only groups of at most `most` claims are paired. In larger ones the pairs are counted without being made, which
    takes eight rows a claim; so the work grows with the claims, also where a subject has very many. Where no group is
    larger, nothing is counted so. The claims are made once, the groups found once; both are written to the shared folder.
    """
    narrow = stored(_placed(_narrow(claims, aliases)))
    groups = checkpoint(_conflicting(narrow))
    few = _pairs(narrow.join(groups.where(F.col("n") <= most), ["s", "p"])).groupBy("subject", "predicate", "tier", "kind").agg(F.count("*").alias("pairs"))
    large = groups.where(F.col("n") > most)
    return few if large.isEmpty() else few.unionByName(_count(narrow.join(large, ["s", "p"])))


def _count(narrow: DataFrame) -> DataFrame:
    """Counts of pairs by inclusion and exclusion: pairs of one representation share the document, the stem or the
    span, and pairs that share a set of these are counted by squares of group sizes. Every grouping is combined
    before its shuffle."""
    same = ("doc_id", "stem", "span")
    sets = []
    for mask in range(1 << len(same)):
        own = [c for i, c in enumerate(same) if mask >> i & 1]
        told = F.lit(True)
        for c in own:
            told = told & (F.col(c) != "") if c != "doc_id" else told
        keys = [F.when(F.lit(c in own), F.col(c)).alias(c) for c in same]
        sets.append(F.when(told, F.struct(F.lit(mask).alias("mask"), F.lit((-1) ** len(own)).alias("sign"), *keys)))
    by = ["s", "p", "mask", "sign", *same]
    rows = narrow.where("doc_id is not null").select("s", "p", "o", "pol", "who", F.explode(F.array_compact(F.array(*sets))).alias("x"))
    cells = rows.select("s", "p", "o", "pol", "who", "x.*").groupBy(*by, "who", "o").agg(F.count_if("pol").alias("t"), F.count_if(~F.col("pol")).alias("f"))

    def pairs(cells: DataFrame, *more: str) -> DataFrame:
        # Squares of counts pass 64 bits beyond three billion claims; the numbers of pairs that come out are long again.
        cells = cells.withColumns({c: F.col(c).cast("decimal(18,0)") for c in ("t", "f")})
        big = lambda x: x.cast("decimal(38,0)")
        t, f = (F.sum(c).cast("decimal(18,0)") for c in ("t", "f"))
        square = lambda c: big(F.sum(F.col(c)).cast("decimal(18,0)") * F.sum(F.col(c)).cast("decimal(18,0)")) - big(F.sum(F.col(c) * F.col(c)))
        groups = cells.groupBy(*by, *more).agg(
            big(t * f).alias("opposite"),
            big(F.sum(F.col("t") * F.col("f"))).alias("same_object"),
            F.call_function("div", square("t") + square("f"), F.lit(2)).alias("other"),
        )
        kinds = F.when(T.is_negation(F.col("p")), F.col("same_object")).otherwise(F.col("opposite"))
        signed = lambda x: F.sum(F.when(F.col("sign") > 0, x).otherwise(-x)).cast("long")
        return groups.groupBy("s", "p").agg(signed(kinds).alias("opposite"), signed(F.col("other")).alias("other"))

    every = pairs(cells.groupBy(*by, "o").agg(F.sum("t").alias("t"), F.sum("f").alias("f")))
    within = pairs(cells.where("who is not null"), "who").select("s", "p", F.col("opposite").alias("own_opposite"), F.col("other").alias("own_other"))
    both = every.join(within, ["s", "p"], "left").na.fill(0, ["own_opposite", "own_other"])
    row = lambda tier, kind, n: F.struct(F.lit(tier).alias("tier"), F.lit(kind).alias("kind"), n.alias("pairs"))
    tiers = F.array(
        row("CONTRADICTION", "opposite_polarity", F.col("own_opposite")),
        row("LEAD", "conflicting_object", F.col("own_other")),
        row("contested", "opposite_polarity", F.col("opposite") - F.col("own_opposite")),
        row("contested", "conflicting_object", F.col("other") - F.col("own_other")),
    )
    return both.select(F.col("s").alias("subject"), F.col("p").alias("predicate"), F.inline(tiers)).where("pairs > 0")
