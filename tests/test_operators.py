"""Literal cases: guards that must fire and must not, and what the SQL comparison can't reach."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators import claims as C
from factloom.operators import completeness as M
from factloom.operators import enrich as N
from factloom.operators import events as E
from factloom.operators import grounding as G
from factloom.operators import guards as K
from factloom.operators import layers as L
from factloom.operators import seam as S
from factloom.operators import search as R
from factloom.sources import tables as A
from factloom.streaming import delivery as D
from factloom.streaming import jobs as J
from factloom.streaming import projection as P


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x"))).first()[0]


CLAIM = "doc_id string, claim_idx int, raw_path string, subject string, predicate string, object string, polarity boolean, asserted_by string, source_span string"


def claims(spark, *rows):
    return spark.createDataFrame([(d, 0, p, s, v, o, pol, who, span) for d, p, s, v, o, pol, who, span in rows], CLAIM)


def tiers(spark, rows, aliases=()):
    al = spark.createDataFrame(list(aliases), "alias string, canonical string")
    return [(r["tier"], r["kind"]) for r in C.contradictions(claims(spark, *rows), al).collect()]


@pytest.mark.parametrize("most", [0, 8, 1000])
def test_contradiction_counts(spark, most):
    rng = random.Random(3)
    pick = lambda *x: rng.choice(x)
    rows = [
        (pick("d1", "d2", "d3", "d4", None), pick("x/a.md", "x/A_ocr.pdf", "y/b.md", "y/c.md", "", None), pick("He", "he ", "She"), pick("saw", "does not name"), pick("x", "y", None), pick(True, False, None), pick("Ann", "ann", "Bob", None), pick("s1", "s2", "s3", "", None))
        for _ in range(90)
    ] + [("d9", "z.md", "They", "saw", "x", True, "Ann", "s")]
    al = spark.createDataFrame([("bob", "Ann")], "alias string, canonical string")
    c = claims(spark, *rows)
    want = C.contradictions(c, al).groupBy("subject", "predicate", "tier", "kind").count().collect()
    assert want and sorted(map(tuple, C.contradiction_counts(c, al, most).collect())) == sorted(map(tuple, want))


def test_no_claims_count_nothing(spark):
    al = spark.createDataFrame([], "alias string, canonical string")
    assert C.contradiction_counts(spark.createDataFrame([], CLAIM), al, 0).collect() == []


A1, A2 = ("d1", "x/a.md"), ("d2", "x/b.md")


@pytest.mark.parametrize(
    ("left", "right", "want"),
    [
        ((*A1, "He", "saw", "it", True, "Ann", "s1"), (*A2, "he ", "saw", "it", False, "ann", "s2"), [("CONTRADICTION", "opposite_polarity")]),
        ((*A1, "He", "saw", "it", True, "Ann", "s1"), (*A2, "HE", "saw", "two", True, "Ann", "s2"), [("LEAD", "conflicting_object")]),
        ((*A1, "He", "saw", "it", True, "Ann", "s1"), (*A2, "He", "saw", "it", False, "Bob", "s2"), [("contested", "opposite_polarity")]),
        ((*A1, "He", "saw", "it", True, None, "s1"), (*A2, "He", "saw", "it", False, None, "s2"), [("contested", "opposite_polarity")]),
        ((*A1, "He", "saw", "it", True, "Ann", "s1"), (*A2, "He", "saw", "it", True, "Ann", "s2"), []),
        (("d1", "x/a.pdf", "He", "saw", "it", True, "Ann", "s1"), ("d2", "x/a_ocr.pdf", "He", "saw", "it", False, "Ann", "s2"), []),
        ((*A1, "He", "saw", "it", True, "Ann", "same"), (*A2, "He", "saw", "it", False, "Ann", "Same "), []),
        ((*A1, "He", "does not name", "x", True, "Ann", "s1"), (*A2, "He", "does not name", "y", False, "Ann", "s2"), []),
        ((*A1, "He", "does not name", "x", True, "Ann", "s1"), (*A2, "He", "does not name", "x", False, "Ann", "s2"), [("CONTRADICTION", "opposite_polarity")]),
        ((*A1, "He", "saw", "it", True, "Ann", "s1"), ("d1", "x/c.md", "He", "saw", "it", False, "Ann", "s2"), []),
    ],
)
def test_contradiction_pairs(spark, left, right, want):
    assert tiers(spark, [left, right]) == want
    assert tiers(spark, [right, left]) == want


def test_aliases_make_one_speaker(spark):
    rows = [(*A1, "He", "saw", "it", True, "A. Smith", "s1"), (*A2, "He", "saw", "it", False, "Ann", "s2")]
    assert tiers(spark, rows) == [("contested", "opposite_polarity")]
    assert tiers(spark, rows, [("a.  smith", "Ann")]) == [("CONTRADICTION", "opposite_polarity")]


def test_a_large_group_keeps_every_pair(spark):
    rows = [(f"d{i:03}", f"x/{i}.md", "He", "saw", "it", i % 2 == 0, "Ann", f"s{i}") for i in range(120)]
    assert len(tiers(spark, rows)) == 60 * 60


@pytest.mark.parametrize(
    ("path", "stem"),
    [
        ("x/a.md", "x/a"), ("x/a_ocr.pdf", "x/a"), ("x/pdf_original/a.PDF", "x/a"), ("x/p-1.txt", "x/p-1"), ("x/p-16.txt", "x/p-16"),
        ("x/a.ocr.txt", "x/a"), ("x/a (2).pdf", "x/a"), ("", ""), ("X/ocr_v2/b copy.docx", "X/b"),
    ],
)
def test_doc_stem(spark, path, stem):
    assert one(spark, path, T.doc_stem) == stem


def test_text_forms(spark):
    assert one(spark, None, T.norm) == ""
    assert one(spark, " A b\n c ", T.norm) == "a b c"
    assert one(spark, "“Yes” … no . . . it’s", T.quote_norm) == "\"Yes\" ... no ... it's"
    assert one(spark, "\r\na \r\n\tb\t\r\rc\n\n", T.passthrough) == "a\n\tb\n\nc\n"
    vtt = "WEBVTT\n\nNOTE a\nb\n\n1\n00:00.0 --> 00:01.0\n<c>Hello</c> you\n\n2\n00:01.0 --> 00:02.0\nHello you\nthere\n"
    assert one(spark, vtt, T.transcript) == "Hello you\nthere"
    assert one(spark, "<p>a &amp; b</p><script>x</script>", T.strip_tags) == "a & b"
    assert one(spark, "No _Index", T.key_norm) == "noindex"
    assert [one(spark, p, T.layer_of) for p in ("evidence/evidence_of_service/sent_bundles/x/sent-text.md", "evidence/evidence_of_service/sent_bundles/x/draft.md", "evidence/evidence_of_service/sent/a.md")] == ["SERVED", "ANALYSIS", "SERVED"]
    assert [one(spark, p, T.audience) for p in ("a/press/police.md", "b/police/summons.md", "c/summons.md", "d", None)] == ["journalist", "police", "court", None, None]
    assert [one(spark, p, T.failure_stage) for p in ("extract-failed: x", "error: y", "sink-failed", "missing")] == ["extracted", "enriched", "indexed", "received"]


@pytest.mark.parametrize(("glob", "path", "hit"), [("a/*.md", "a/b/c.md", True), ("**/x.md", "x.md", False), ("**/x.md", "a/x.md", True), ("a?.t", "ab.t", True), ("[!a]b", "ab", False), ("a.md", "axmd", False)])
def test_globs(spark, glob, path, hit):
    assert one(spark, path, lambda c: c.rlike(T.glob_pattern(glob))) is hit


def test_exclusions_first_hit_wins(spark):
    reg = spark.createDataFrame([(0, "a/", None, "p0"), (1, "a/b", None, "p1"), (2, "z", "AB", "s"), (3, "a/b", None, "p3")], "idx long, raw_path string, raw_sha256 string, reason string")
    rows = spark.createDataFrame([(1, "a/b", "x"), (2, "a/bc.txt", "x"), (3, "q", "ab"), (4, "a/b", "ab"), (5, "q", None)], "k int, raw_path string, raw_sha256 string")
    for limit in (10, 0):
        got = {r["k"]: (r["excl_kind"], r["excl_idx"]) for r in M.match_exclusions(rows, reg, "k", limit).collect()}
        assert got == {1: ("path", 1), 2: ("prefix", 0), 3: ("sha", 2), 4: ("sha", 2), 5: (None, None)}


def test_second_catchup_pass_is_a_no_op(spark):
    walk = spark.createDataFrame([("b", "X"), ("a", "x"), ("c", "y")], "raw_path string, sha256 string")
    first = M.new_entries(walk, spark.createDataFrame([], "sha256 string"))
    assert sorted(r["raw_path"] for r in first.collect()) == ["a", "c"]
    assert M.new_entries(walk, first).count() == 0


def test_retraction_handles_cycles(spark):
    d = spark.createDataFrame([("b", ["a"]), ("c", ["b"]), ("a", ["c"]), ("x", ["y"])], "doc_id string, derived_from array<string>")
    got = {r["doc_id"]: r["depth"] for r in M.retracted(d, spark.createDataFrame([("a",)], "doc_id string")).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def seam(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "claim_id int, audience string, canonical_speaker string, subject string, object string")


def test_seam_pairs(spark):
    c = seam(spark, ("police", "ann", "red car", "seen"), ("court", "ann", "the red car", "seen"), ("court", "ann", "red bus", "gone"), ("police", "ann", "red car", "seen"), ("court", "bob", "red car", "seen"))
    got = {(r["left_id"], r["right_id"]): round(r["similarity"], 3) for r in S.candidate_pairs(c, 0.2).collect()}
    assert got == {(0, 1): 1.0, (0, 2): 0.2, (1, 3): 1.0, (2, 3): 0.2}
    plain = {(r["left_id"], r["right_id"]) for r in S.candidate_pairs(c, 0.2, scorer=lambda a, b: F.size(F.array_intersect(a["tokens"], b["tokens"])) / F.size(F.array_union(a["tokens"], b["tokens"]))).collect()}
    assert plain == set(got)
    assert S.candidate_pairs(c, 0.0).count() == 4
    assert S.candidate_pairs(c, 0.2, max_pairs=1).first()["left_id"] == 0


def test_seam_pairs_start_only_where_they_can_be_completed(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(14)]
    texts = [[w for w in words if rng.random() < rng.choice((0.2, 0.5, 0.9))] for _ in range(140)]
    texts += texts[:40]
    c = seam(spark, *((rng.choice(["police", "court"]), rng.choice(["ann", "bob"]), " ".join(t), "") for t in texts))
    rows = [(r["claim_id"], r["audience"], r["canonical_speaker"], set(r["subject"].split())) for r in c.collect()]
    for least in (0.2, 0.5, 0.7, 1.0):
        got = [(r["left_id"], r["right_id"]) for r in S.candidate_pairs(c, least).collect()]
        want = {(i, j) for i, a, s, t in rows for j, b, z, u in rows if i < j and a != b and s == z and t | u and len(t & u) / len(t | u) >= least}
        assert want and len(got) == len(set(got)) and set(got) == want
    # Every claim has the words part and qty, and one of two numbers; only a part's own number can begin a pair of 0.7.
    c = seam(spark, *(("police" if i % 2 else "court", "ann", f"part {100 + i // 2}", f"qty {i % 2}") for i in range(40)), ("court", "ann", "part 100", "qty 1"))
    own = c.withColumn("tokens", T.jaccard_tokens(F.col("subject"), F.col("object")))
    assert {r["token"] for r in S._leads(own, 0.7).collect()} == {str(100 + i) for i in range(20)}
    assert {(r["left_id"], r["right_id"]) for r in S.candidate_pairs(c, 0.7).collect()} == {(1, 40)}


def layer(spark, *rows):
    return spark.createDataFrame([(s, r) for s, r in rows], "source string, raw string")


@pytest.mark.parametrize(
    ("raw", "latched", "category"),
    [
        ("author: A", False, None), ("no_index: false", False, None), ("no_index: true", True, "legally_obligatory"),
        ("no_index: true\nno_index_reason: x", True, "legally_obligatory"), ("no_index: true\nno_index_reason: x\nno_index_category: housekeeping", True, "housekeeping"),
        ("no_index: true\nno_index_reason: x\nno_index_category: odd", True, "legally_obligatory"), ('no_index: "true"', True, "legally_obligatory"),
        ("NO-INDEX: true", True, "legally_obligatory"), ("noindex: false", True, "legally_obligatory"), ("a: [", True, "legally_obligatory"), ("- a", True, "legally_obligatory"), ("", False, None),
    ],
)
def test_no_index_fails_closed(spark, raw, latched, category):
    allowed = ("author", "no_index", "no_index_reason", "no_index_category")
    x = L.examine_layers(L.parse_layers(layer(spark, ("m", raw))), allowed)
    chain = x.withColumn("raw_path", F.lit("f")).withColumn("depth", F.lit(1))
    r = L.fold_no_index(chain).first()
    assert (bool(r and r["no_index"]), r and r["no_index_category"]) == (latched, category)


def test_child_cannot_unset_the_latch(spark):
    allowed = ("no_index", "no_index_reason")
    x = L.examine_layers(L.parse_layers(layer(spark, ("p", "no_index: true\nno_index_reason: court"), ("c", "no_index: false"))), allowed)
    chain = x.withColumn("raw_path", F.lit("f")).withColumn("depth", F.when(F.col("source") == "p", 1).otherwise(2))
    r = L.fold_no_index(chain).first()
    assert r["no_index"] and r["no_index_reason"] == "court"


def test_grounding(spark):
    prime = [
        ("authorities_primary_text/2008_x_EWHC_148_Admin.md", "# X v Y\n\nThe court must always look at the words themselves. See s.7 of the Human Rights Act 1998."),
        ("authorities_primary_text/REPEALED_2001_z_EWCA_Civ_12.md", "# Old\n\nThese are the words of a text that is dead now."),
    ]
    files = [
        ("reports/a.md", 'In X [2008] EWHC 148 (Admin), "The court must always look at the words  themselves."'),
        ("evidence/evidence_of_service/sent/b.md", 'In X [2008] EWHC Admin 148, “The court may never look at the words themselves.”'),
        ("analysis/c.md", 'Under section 7 of the HRA it says "everybody may rely upon such rights in court". Also CrimPR rule 3.4 and [2010] Foo.'),
        ("analysis/d.md", 'As in [2001] EWCA Civ 12, "These are the words of a text that is dead now."'),
        ("analysis/e.md", "poa " + "x" * 300 + ' s.7 proposal "short"'),
    ]
    found = G.findings(spark.createDataFrame(files, "file string, text string"), spark.createDataFrame(prime, "path string, text string")).collect()
    got = {(r["kind"], r["verdict"], r["file"][-4:], r["key"]) for r in found}
    assert ("quote", "GREEN", "a.md", "ncit:2008 ewhc 148 admin") in got
    assert ("quote", "RED", "b.md", "ncit:2008 ewhc 148 admin") in got
    # 8 characters from the quote to the rule, 10 from the HRA to the quote: the rule is nearest.
    assert ("quote", "AMBER", "c.md", "rule:criminal procedure rules 3.4") in got
    assert ("quote", "RED", "d.md", "ncit:2001 ewca civ 12") in got
    assert ("repealed_citation", "RED", "d.md", "ncit:2001 ewca civ 12") in got
    assert ("malformed_citation", "AMBER", "c.md", None) in got
    assert ("citation_without_source", "AMBER", "c.md", "rule:criminal procedure rules 3.4") in got
    assert not any(x[2] == "e.md" for x in got)
    assert found[0]["file"].endswith("b.md")  # the served layer's error first


def test_completions(spark):
    rows = [
        (1, json.dumps({"summary": "s", "keywords": ["a", None, ""], "claims": [{"subject": 1, "predicate": True, "object": "o", "polarity": "Negated", "confidence": "0.4", "epistemic_status": "Held"}, {"subject": "x", "predicate": "y"}]})),
        (2, '{"summary": "cut'), (3, "[1]"), (4, None),
    ]
    r = {x["doc_id"]: x for x in N.parse_completions(spark.createDataFrame(rows, "doc_id int, completion string")).collect()}
    c = r[1]["claims"][0]
    assert (c["subject"], c["predicate"], c["polarity"], c["confidence"], c["epistemic_status"]) == ("1", "true", False, 0.4, "held")
    assert len(r[1]["claims"]) == 1 and r[1]["keywords"] == ["a"]
    assert all(r[i]["summary"] == "" and r[i]["claims"] == [] for i in (2, 3, 4))


def test_a_failing_function_fails_by_document(spark):
    def fn(texts):
        if any(t == "bad" for t in texts):
            raise ValueError("no")
        return [t.upper() for t in texts]

    d = spark.createDataFrame([("1", "a"), ("2", "bad"), ("3", "")], "doc_id string, content string").coalesce(1)
    got = {r["doc_id"]: (r["result"], r["status"]) for r in N.apply_to_texts(d, fn).collect()}
    assert got == {"1": ("A", "ok"), "2": (None, "error: no"), "3": ("", "empty")}


def test_email(spark):
    raw = b"Subject: Hi\r\nFrom: a@x.org\r\nTo: B <b@x.org>, c@x.org\r\nContent-Type: text/html\r\n\r\n<p>Fish &amp; chips</p>"
    r = N.parse_emails(spark.createDataFrame([("f", raw)], "file string, content binary")).withColumn("md", N.email_markdown()).first()
    assert (r["subject"], r["to_addrs"], r["body"]) == ("Hi", ["b@x.org", "c@x.org"], "Fish & chips")
    assert r["md"].startswith("# Hi\n\nFrom: a@x.org")


def test_lead_text(spark):
    assert one(spark, "one, two three", lambda c: N.lead_text(c, 3)) == "one, two"
    assert spark.range(1).select(N.budget_plan(F.lit(30_000)), N.budget_plan(F.lit(20_000)), N.budget_plan(F.lit(90_000))).first()[:] == (50_000, 25_000, 100_000)


def test_prefixes_are_checked():
    assert K.check_prefixes([" abc "]) == ["abc"]
    for bad in ([], ["/"], [""], ["ab"]):
        with pytest.raises(ValueError):
            K.check_prefixes(bad)
    assert K.check_prefixes(["ab"], force=True) == ["ab"]


def test_stored_forms(spark, tmp_path):
    docs = spark.createDataFrame([("1", "a/x.md", "t", False), ("2", "../y", "t", False), ("3", "a/z", "t", True), ("4", None, "t", False)], "doc_id string, raw_path string, content string, no_index boolean")
    got = {r["outcome"]: r["n"] for r in A.write_extracted(docs, str(tmp_path / "e")).collect()}
    assert got == {"written": 1, "path traversal": 1, "no_index": 1, "no raw_path": 1}
    (tmp_path / "raw/evidence").mkdir(parents=True)
    (tmp_path / "raw/evidence/a.txt").write_bytes(b"abc")
    (tmp_path / "raw/evidence/b.mp4").write_bytes(b"abc")
    files = A.read_raw_tree(spark, str(tmp_path / "raw")).collect()
    assert [(r["raw_path"], r["tree"], r["size"]) for r in files] == [("evidence/a.txt", "evidence", 3)]
    (tmp_path / "m.json").write_text(json.dumps({"AB": {"raw_path": "p", "matters": ["m"], "no_index": True}}))
    m = A.read_manifest(spark, str(tmp_path / "m.json"))
    assert [(r["sha256"], r["raw_path"], r["no_index"]) for r in m.collect()] == [("ab", "p", True)]
    A.write_manifest(m, str(tmp_path / "m.parquet"))
    assert spark.read.parquet(str(tmp_path / "m.parquet")).count() == 1
    assert A.read_aliases(spark, str(tmp_path / "none.json")).count() == 0
    e = spark.createDataFrame([("p", "why", "t", "manual", None), ("q", " ", "t", "manual", None), ("r", "x", "t", "robot", None)], A.EXCLUSION)
    assert sorted(r["error"] for r in A.append_exclusions(e, str(tmp_path / "reg")).collect()) == ["reason", "source"]
    assert [r["raw_path"] for r in A.read_exclusions(spark, str(tmp_path / "reg")).collect()] == ["p"]
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2), "ok")], "ts timestamp, status string")
    A.append_events(ev, str(tmp_path / "ev"))
    A.append_events(ev, str(tmp_path / "ev"))
    assert spark.read.parquet(str(tmp_path / "ev")).where("date = '2024-01-01'").count() == 2


def test_trace_without_hash(spark):
    e = spark.createDataFrame([(1, "s", "d", "p"), (2, "s", None, None), (3, None, "e", None)], "event_id int, sha256 string, doc_id string, raw_path string")
    got = {(r["key"], r["event_id"]) for r in E.trace(e, spark.createDataFrame([("d",), ("e",)], "key string")).collect()}
    assert got == {("d", 1), ("d", 2), ("e", 3)}


def test_status_levels(spark):
    rows = [(0, 0, 0, 0, False), (0, 0, 1, 0, False), (0, 3, 0, 0, False), (2, 0, 0, 5, True)]
    got = E.system_status(spark.createDataFrame(rows, "failed long, missing long, incidents long, skipped long, stale boolean").coalesce(1)).collect()
    assert [(r["exit"], r["status"]) for r in got] == [(0, "ok"), (1, "degraded"), (2, "ok"), (2, "degraded")]
    assert [a["name"] for a in got[3]["alerts"]] == ["pipeline_failures", "health_degraded"]


def test_triggers_from_the_kept_one(spark):
    at = [("a", s, f"k{s}") for s in (0, 100, 200, 290, 321, 1000)] + [("b", 0, "x"), ("b", 0, "y"), (None, 5, "n")]
    t = spark.createDataFrame(at, "sha string, s long, id string").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r["id"] for r in J.dedup_batch(t, "id").collect()) == ["k0", "k1000", "k200", "k321", "n", "x"]


def test_retraction_runs_to_the_end(spark):
    docs = spark.createDataFrame([(str(i), [str(i - 1)]) for i in range(1, 60)], "doc_id string, derived_from array<string>")
    seed = spark.createDataFrame([("0",)], "doc_id string")
    assert M.retracted(docs.where("int(doc_id) < 56"), seed).count() == 56
    with pytest.raises(ValueError):
        M.retracted(docs, seed, max_depth=3)


def test_character_references(spark):
    for t, want in (("a&amp;lt;b", "a&lt;b"), ("&eacute;&#233;&#xE9;&#x1F642;", "ééé🙂"), ("&nosuch; &#0; &am", "&nosuch; &#0; &am"), ("x&nbsp;y &hellip;", "x y …"), (None, None)):
        assert spark.createDataFrame([(t,)], "t string").select(T.strip_tags(F.col("t"))).first()[0] == want


def test_mail_of_unknown_charset(spark):
    raw = b"Subject: Hi\r\nContent-Type: text/plain; charset=nobody-knows\r\n\r\nx"
    assert N.parse_emails(spark.createDataFrame([("f", raw)], "file string, content binary")).first()["subject"] == "Hi"


def test_lead_by_a_callers_tokenizer(spark):
    import re

    d = spark.createDataFrame([("1", "ab cd  ef"), ("2", None), ("3", "x")], "doc_id string, content string")
    got = {r["doc_id"]: (r["lead"], r["n_tokens"]) for r in N.lead_by(d, lambda t: [m.span() for m in re.finditer(r"\S+", t)], 2).collect()}
    assert got == {"1": ("ab cd", 3), "2": (None, 0), "3": ("x", 1)}


def test_raw_tree_of_an_odd_root(spark, tmp_path):
    root = tmp_path / "a.b+c" / "x" / "a.b+c"
    (root / "x").mkdir(parents=True)
    (root / "x" / "f.txt").write_bytes(b"1")
    assert [r["raw_path"] for r in A.read_raw_tree(spark, str(root)).collect()] == ["x/f.txt"]


def test_spans_far_and_near(spark):
    rows = [("f", a, a + 9) for a in range(0, 20_000, 97)]
    l = spark.createDataFrame(rows, "file string, l0 int, l1 int")
    r = spark.createDataFrame([("f", a, a + 500) for a in range(0, 20_000, 701)], "file string, r0 int, r1 int")
    got = sorted((x["l0"], x["r0"], x["gap"]) for x in G._within(l, r, "l0", "l1", "r0", "r1", 60).collect())
    gap = lambda a, b, c, d: max(c - b, a - d, 0)
    assert got == sorted((a, c, gap(a, a + 9, c, c + 500)) for a in range(0, 20_000, 97) for c in range(0, 20_000, 701) if gap(a, a + 9, c, c + 500) <= 60)


def test_highlights_against_brute_force(spark):
    text = "the cat sat. " * 30 + "a cat"
    frag = R.highlights(spark.createDataFrame([(1, text), (2, None)], "doc_id int, content string"), ["cat"], size=40).collect()
    assert [len(x) for x in frag[0]["fragments"]] == [40, 40] and all("cat" in x for x in frag[0]["fragments"])
    assert frag[1]["fragments"] == []


def test_search_without_text_lists_all(spark):
    d = spark.createDataFrame([(1, "a b", ["k"]), (2, "b b", ["b c"])], "doc_id int, content string, keywords array<string>")
    q = spark.createDataFrame([(1, ""), (2, "b c")], "query_id int, text string")
    got = {(r["query_id"], r["doc_id"]): round(r["score"], 3) for r in R.search(d, q, {"content": 1.0}, None, exact={"keywords": 2.0}).collect()}
    assert got[1, 1] == got[1, 2] == 0 and got[2, 2] == 2.0 and 0 < got[2, 1] < 1


# --- streams against their batch twins


def feed(tmp_path, rows, name="in"):
    d = tmp_path / name
    d.mkdir(exist_ok=True)
    for i, part in enumerate(rows):
        (d / f"{i}.json").write_text("\n".join(json.dumps(r) for r in part))
    return str(d)


def drain(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    return stream.sparkSession.table(name)


def test_stream_windows_equal_batch(spark, tmp_path):
    rows = [{"ts": f"2024-01-01T0{i % 5}:1{i % 6}:00Z", "stage": "indexed", "status": "ok" if i % 2 else "failed"} for i in range(40)]
    path, schema = feed(tmp_path, [rows[:20], rows[20:]]), "ts timestamp, stage string, status string"
    batch = {tuple(r) for r in J.live_counts(spark.read.schema(schema).json(path)).collect()}
    live = drain(J.live_counts(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)), "live", "complete")
    assert {tuple(r) for r in live.collect()} == batch


def test_stream_dedup_and_projection(spark, tmp_path):
    rows = [[{"sha": "a", "ts": "2024-01-01T00:00:00Z"}, {"sha": "a", "ts": "2024-01-01T00:00:30Z"}], [{"sha": "b", "ts": "2024-01-01T00:01:00Z"}]]
    path = feed(tmp_path, rows)
    s = spark.readStream.schema("sha string, ts timestamp").json(path)
    assert sorted(r["sha"] for r in drain(J.dedup_triggers(s), "dedup").collect()) == ["a", "b"]
    store = str(tmp_path / "store")
    for check in ("c1", "c2"):  # the second run delivers everything again
        assert P.project_idempotently(s, store, "sha", str(tmp_path / check)).awaitTermination(120) is not False
    assert sorted(r["sha"] for r in P.read_projection(spark, store, "sha string, ts timestamp").collect()) == ["a", "b"]


def test_stream_delivery_state(spark, tmp_path):
    ok, bad = ["indexed"], ["indexed", "error"]
    path = feed(tmp_path, [[{"sha": "a", "statuses": bad}, {"sha": "b", "statuses": ok}], [{"sha": "a", "statuses": bad}], *[[{"sha": "a", "statuses": bad}]] * 3])
    s = spark.readStream.schema("sha string, statuses array<string>").option("maxFilesPerTrigger", 1).json(path)
    got = drain(D.delivery_stream(s), "attempts", "append").collect()
    assert [(r["attempt"], r["action"], r["retry_after"]) for r in sorted(got, key=lambda r: r["attempt"]) if r["sha"] == "a"] == [
        (1, "wait", 30), (2, "wait", 60), (3, "wait", 120), (4, "wait", 300), (5, "dead_letter", None),
    ]
    assert [(r["attempt"], r["action"]) for r in got if r["sha"] == "b"] == [(1, "ack")]


def test_partitions_and_order_change_nothing(spark, sf):
    from factloom.plans import views as V

    c, al = V.claims(spark, sf), V.aliases(spark, sf)
    a = C.contradictions(c, al).groupBy("tier").count().collect()
    b = C.contradictions(c.repartition(7).orderBy(F.desc("claim_idx")), al).groupBy("tier").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_mails_are_parsed_in_small_parts_and_keep_only_text():
    import pandas as pd

    class Raw:
        def select(self, *columns):
            return self

        def mapInPandas(self, run, schema):  # noqa: N802
            return run

    mail = b"Subject: =?utf-8?q?caf=C3=A9?=\r\nFrom: A <a@x.org>\r\nTo: b@x.org\r\nDate: Mon, 1 Jan 2024 10:00:00 +0000\r\n\r\nhello\r\n"
    n = 2 * N.MAILS + 1
    parts = list(N.parse_emails(Raw())(iter([pd.DataFrame({"file": [str(i) for i in range(n)], "content": [mail] * (n - 1) + [None]})])))
    assert [len(p) for p in parts] == [N.MAILS, N.MAILS, 1]
    for p in parts[:2]:
        assert {type(x) for c in ("subject", "from_addr", "date") for x in p[c]} == {str}
        assert set(p["subject"]) == {"café"} and set(p["from_addr"]) == {"A <a@x.org>"}
    assert parts[2]["subject"].tolist() == [None] and parts[2]["file"].tolist() == [str(n - 1)]


def test_claims_are_made_once_for_all_steps(spark):
    """Groups, both sides of the pairs and the counts go on from the written claims; a speaker's groups are cut by speaker."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = [(i, 0, f"r/{i}.md", "S", "is", f"o{i // 4 % 3}", i % 2 == 0, f"who{i % 4}" if i % 5 else None, None) for i in range(40)]
    kind = "doc_id long, claim_idx int, raw_path string, subject string, predicate string, object string, polarity boolean, asserted_by string, source_span string"
    claims = spark.createDataFrame(rows, kind).mapInPandas(count, kind)
    aliases = spark.createDataFrame([("who1", "who0")], "alias string, canonical string")
    who = {r[0]: r[7] and ("who0" if r[7] == "who1" else r[7]) for r in rows}
    pairs = {(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and (x[6] != y[6] or x[5] != y[5])}
    got = [(r["left_doc"], r["right_doc"]) for r in C.contradictions(claims, aliases, one_speaker=True).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in pairs if who[a] and who[a] == who[b]}
    assert made.value == len(rows)
    got = [(r["left_doc"], r["right_doc"]) for r in C.contradictions(claims, aliases).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs and made.value == 2 * len(rows)
    for most in (5, 1000):
        assert C.contradiction_counts(claims, aliases, most).agg(F.sum("pairs")).first()[0] == len(pairs)
    assert made.value == 4 * len(rows)
