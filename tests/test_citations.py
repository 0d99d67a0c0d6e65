"""Readers of citations, sections and quotations by cases, and the search for quotations against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators import citations as R
from factloom.operators import containment as W
from factloom.operators import grounding as G


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("In X [2008] EWHC 148 (Admin), it", [("2008\tEWHC\t148\tAdmin", "[2008] EWHC 148 (Admin)")]),
        ("[2008] EWHC Admin 148", [("2008\tEWHC Admin\t148\t", "[2008] EWHC Admin 148")]),
        ("[2001]\n EWCA  Civ\t12(x)", [("2001\tEWCA Civ\t12\tx", "[2001]\n EWCA  Civ\t12(x)")]),
        ("[2001] UKSC 9 ( Admin)", [("2001\tUKSC\t9\t", "[2001] UKSC 9")]),
        ("[2001] UKSC 9 (Ad1)", [("2001\tUKSC\t9\t", "[2001] UKSC 9")]),
        ("[[2001] UKSC 9]", [("2001\tUKSC\t9\t", "[2001] UKSC 9")]),
        ("[1801] AB 7abc", [("1801\tAB\t7\t", "[1801] AB 7")]),
        ("[201] UKSC 9 [20011] UKSC 9 [2001]UKSC 9 [2001] U 9 [2001] Uksc 9 [2001] UKSC Foo 9 [2001] UKSC Civ [2001", []),
        ("[2001] UKSC 1; [2002] UKSC 2", [("2001\tUKSC\t1\t", "[2001] UKSC 1"), ("2002\tUKSC\t2\t", "[2002] UKSC 2")]),
    ],
)
def test_neutral_citations(text, want):
    got = [(k, raw) for what, k, raw, a, z in R.bracket_spans(text) if what == "cite" and text[a:z] == raw]
    assert got == want


def test_openers():
    got = [(raw, a) for what, _, raw, a, _ in R.bracket_spans("x [2010] Foo\nbar [1899] A [1710] B [2010] 3 [2010]") if what == "opener"]
    assert got == [("[2010] Foo", 2)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("CrimPR rule 3.4", ["3.4"]), ("crimpr, r.3.12.1.", ["3.12.1"]), ("Criminal  Procedure Rules, Part 5", ["5"]), ("criminal procedure rule pt 7.", ["7"]),
        ("CrimPR3", []), ("CrimPR rule. 3", []), ("criminal proceedings rule 3", []), ("CrimPR section 3", []), ("İ CrimPR r 9", ["9"]),
    ],
)
def test_rules(text, want):
    assert [k.rsplit(" ", 1)[1] for _, k, *_ in R.rule_spans(text)] == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("s.7", [("7", "s.7")]), ("s 7", [("7", "s 7")]), ("s7(1)(a)", [("7", "s7(1)(a)")]), ("ss. 12 (3)", [("12", "ss. 12 (3)")]), ("under section  40(2), or", [("40", "section  40(2)")]),
        ("sections 3 and 4", [("3", "sections 3")]), ("S.7 Section 7 section.7 section7 s..7 s  7 has7 1s7 _s7", []), ("s1s2", [("1", "s1")]), ("s.7 s.8", [("7", "s.7"), ("8", "s.8")]), ("s.7(1) (b )", [("7", "s.7(1)")]),
    ],
)
def test_sections(text, want):
    got = [(k, raw) for _, k, raw, a, z in R.section_spans(text) if text[a:z] == raw]
    assert got == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('say "one" and “two”', ["one", "two"]), ('"a” “b"', ["a", "b"]), ('""x"', ["x"]), ("”a”", []), ('“a “b”', ["b"]), ('"' + "x" * 21 + '" y "z"', [" y "]),
        ("> line\n >\tother\nno > line\n>\n> ", ["line", "other", " "]), ('"two\nlines"', ["two\nlines"]),
    ],
)
def test_quotation_marks(text, want):
    got = [(raw, a, z) for _, _, raw, a, z in R.quote_spans(text, 20)]
    assert [x[0] for x in got] == want and all(text[a:z] == raw for raw, a, z in got)


def test_navigation_is_no_prose(spark):
    words = "these are the words of a passage that is long enough "
    bad = [words + "[x](y)", words + "| cell", words + "\n - item", words + "\n\n\t# head", words + "\n\nnext", words + "[1999] [2000] [2001]", "1234567890 " * 5]
    good = [words, words + "\nnext line - dash", words + "[1999] [2000] [200]", words + "a|b"]
    rows = [(f"f{i}", "quote", None, t, i, i + len(t)) for i, t in enumerate(bad + good)]
    got = {r["file"] for r in G.quotes(spark.createDataFrame(rows, "file string, what string, key string, raw string, start int, end int")).collect()}
    assert got == {f"f{i}" for i in range(len(bad), len(bad) + len(good))}


def test_keys_of_a_text_equal_those_of_its_spans(spark):
    texts = [
        "In X [2008] EWHC 148 (Admin), and [2008] EWHC Admin 148; CrimPR rule 3.4", "[2001] EWCA Civ 12(x) [2001] EWCA Civ 12 [2001] Foo 3", "none", "[2001] UKSC 9abc (KB) Criminal Procedure Rules, Part 5",
        "[2010] UKSC 7 (KB) crimpr r. 7.1.", "[2001] AB 1 [2002] CD 2 (Fam) (Ch)",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    plain = {r["i"]: sorted(r["k"]) for r in df.select("i", G.citation_keys(F.col("text")).alias("k")).collect()}
    spans = G.references(G.scan(df.select(F.col("i").cast("string").alias("file"), "text"))).where("kind <> 'statute'")
    want = {i: [] for i in plain}
    for r in spans.select("file", "key").distinct().collect():
        want[int(r["file"])].append(r["key"])
    assert plain == {i: sorted(k) for i, k in want.items()}


def test_negations(spark):
    rows = ["does not accept", "denied", "refuses it", "declining", "a note", "unlacked", "failure", "fails", "notary", "WITHOUT  doubt", "lack", None]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in rows], "p string").coalesce(1).select(T.is_negation(F.col("p"))).collect()]
    assert got == [True, True, True, True, False, False, False, True, False, True, True, False]


def test_quotations_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "of", "the", "law", "court", "évidence", "judgment", "administration", "x" * 30, "日本語", "part."]
    texts = [(k, f"p{i}", " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))) for i in range(60) for k in rng.sample(["A", "B", "C"], rng.randint(1, 2))]
    texts += [("A", "p0", ""), ("D", "void", None), (None, "p1", "the law of the court")]
    quotes = {("A", ""), ("Z", "the law of"), ("A", "no such words are in any text at all"), ("A", "xxxxxxxxxxxxxxx"), ("B", "x" * 31), ("C", "ministration of"), ("A", "t"), (None, "law"), ("A", None), ("D", "a")}
    for k, _, t in texts:
        if t:
            a = rng.randrange(len(t))
            quotes |= {(k, t[a : a + rng.randint(1, 90)].strip()) for _ in range(4)} | {("B", t[a : a + 40].strip() + "?")}
    # Many quotations of one authority.
    long = " ".join(str(rng.randrange(10**6)) for _ in range(3000))
    texts.append(("E", "long", long))
    quotes |= {("E", long[a : a + 60].strip()) for a in range(0, len(long) - 60, 20)} | {("E", long[a : a + 50].strip() + "1") for a in range(0, 3000, 30)}
    q = spark.createDataFrame(list(quotes), "key string, quote string")
    got = sorted(tuple(r) for r in W.contained(q, spark.createDataFrame(texts, "key string, path string, text string")).collect())
    assert got == sorted({(k, x) for k, x in quotes for j, _, t in texts if k is not None and k == j and x is not None and t is not None and x in t})
    assert W.contained(q.limit(0), spark.createDataFrame(texts, "key string, path string, text string")).count() == 0


def test_work_grows_with_hits_only(spark, monkeypatch):
    """Quotations of one authority that share their frequent words with every text meet only texts that have their rare ones."""
    texts = [("A", f"p{i}", f"so it is the law of the land that case {i} be heard in open court and not else") for i in range(200)]
    quotes = [("A", f"the law of the land that case {i} be heard in open court") for i in range(0, 400, 2)]
    seen = []
    own = W.checkpoint
    monkeypatch.setattr(W, "checkpoint", lambda df: seen.append(own(df)) or seen[-1])
    found = W.contained(spark.createDataFrame(quotes, "key string, quote string"), spark.createDataFrame(texts, "key string, path string, text string"))
    assert found.count() == 100
    asked, hits = seen
    each = asked.select("key", "quote", F.explode("grams").alias("gram"))
    rare = each.join(hits.groupBy("key", "gram").count(), ["key", "gram"]).groupBy("quote").agg(F.min("count").alias("n"))
    assert {r["n"] for r in rare.where("quote like '%case 1_ %'").collect()} == {1}


def test_quotations_move_only_texts_that_may_hold_them(spark, monkeypatch):
    """Whatever is broadcast, the same is found; where each quotation has a gram, texts are searched once."""
    texts = spark.createDataFrame([("a", "p", "one two three four five six"), ("a", "q", "zero ab cd"), ("b", "p", "one two three four five")], "key string, path string, text string")
    long = [("a", "ne two three four fiv"), ("b", "ne two three four five six"), ("b", "two three four five")]
    want = {("a", "ne two three four fiv"), ("b", "two three four five")}
    for bound in (W.BROADCAST_NAMES, 0):
        monkeypatch.setattr(W, "BROADCAST_NAMES", bound)
        found = W.contained(spark.createDataFrame(long, "key string, quote string"), texts)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Contains(") == 1
        assert {tuple(r) for r in found.collect()} == want
        short = spark.createDataFrame([*long, ("a", "b c"), ("b", "b c"), (None, "b c")], "key string, quote string")
        assert {tuple(r) for r in W.contained(short, texts).collect()} == {*want, ("a", "b c")}


def test_held_texts_are_dealt_and_scanned_once(spark):
    rows = [(f"authorities_primary_text/2001_x_EWHC_{i % 3}_Admin_{i}.md", f"# X\n\nText  {i}") for i in range(20)]
    held = G.held_texts(spark.createDataFrame(rows, "path string, text string").coalesce(1))
    plan = held._jdf.queryExecution()
    assert "RepartitionByExpression [path" in plan.logical().toString() and "MapInPandas" not in plan.optimizedPlan().toString()
    got = {r["path"]: (r["subject_keys"], r["normalized"]) for r in held.collect()}
    assert got == {p: ([f"ncit:2001 ewhc {i % 3} admin"], f"# X Text {i}") for i, (p, _) in enumerate(rows)}
