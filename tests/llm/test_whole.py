"""Cases that a cut in a training-data operator would lose."""

from __future__ import annotations

import hashlib
import random

import pytest

from factloom.llm import decontamination, html_text, katz, secrets

# --- 9 leaks


@pytest.mark.parametrize("item", ["Solve 12 x 34 + 56 = 78", "Anna Bert Clara Dora Emil 12 13 14 km", "Add 1 2 3 4 5 6 7 8 9 10 11 12"])
def test_items_of_few_literals_at_every_offset(spark, item):
    bench = spark.createDataFrame([(1, item), (2, "the quick brown fox jumps over the lazy dog and runs away from every hunter there")], "item_id long, text string")
    docs = [(k, " ".join(["word"] * k) + f" {item} " + "after it") for k in range(8)] + [(100, "nothing of it here at all, in many words")]
    got = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(k, 1) for k in range(8)]


def test_item_split_by_an_insertion(spark):
    item = [f"{a}{b}" for a in "abcd" for b in "vwxyz"]  # 16 windows, of which an insertion in the middle leaves 6 and 6
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = [(8 * k + n, " ".join(["o"] * k + item[:10] + ["in"] * (n + 1) + item[10:])) for k in range(8) for n in range(8)]
    got = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r["doc_id"], r["n_matched"]) for r in got) == [(i, 12) for i, _ in docs]


# --- 4 pages

BODY = "A paragraph that is long enough to be the body of an article, whatever stands around it on the page."


@pytest.mark.parametrize("script", ["for(i=0;i<n;i++){f(i)}", "if(a<b)c()", "x='<p>'+\"<!--\"", "a<b", "</p><script", "", "s='<a href=\"'"])
@pytest.mark.parametrize("tag", ["script", "style", "textarea", "svg"])
def test_raw_elements_end_at_their_own_end_tag(tag, script):
    assert html_text.main_text(f"<html><head><{tag} a='b'>{script}</{tag.upper()} ></head><body><p>{BODY}</p></body></html>") == BODY
    assert html_text.main_text(f"<body><article><p>one</p><{tag}>{script}</{tag}><p>two</p></article><script>x</script>") == "one\ntwo"


def test_raw_elements_without_an_end():
    assert html_text.main_text(f"<p>{BODY}</p><script>var a = '<p>no</p>'") == BODY
    assert html_text.main_text(f"<iframe src=x><p>{BODY}</p><iframe src=y>") == BODY


@pytest.mark.parametrize(
    ("inner", "kept"),
    [
        ('<h2 id="search">Search</h2>', "Search"), ('<h2 id="social-impact">Impact</h2>', "Impact"), ('<section class="related-work"><p>Work</p></section>', "Work"),
        ('<div class="post-header"><p>Head</p></div>', "Head"), ("<figure><img src=x><figcaption>Caption</figcaption></figure>", "Caption"),
        ("<p><a href=x>only a link</a></p>", "only a link"), ('<ul class="menu"><li>x</ul>', "x"),
        ('<div class="big related"><p>x</p></div>', ""), ('<section class="Share">x</section>', ""), ("<aside>x</aside>", ""), ("<nav>x</nav>", ""), ("<h2 hidden>x</h2>", ""),
    ],
)
def test_blocks_of_a_marked_article(inner, kept):
    for page in (f"{inner}<p>{BODY}</p>", f"<p>{BODY}</p>{inner}"):
        lines = html_text.main_text(f"<p>out</p><article>{page}</article><p>out</p>").split("\n")
        assert sorted(lines) == sorted([BODY, *filter(None, [kept])])


@pytest.mark.parametrize("inner", ['<p class="notice">x</p>', '<p class="notice">x', '<ul><li class="ad">x<li class="big ad">x</ul>', '<ul><li class="ad">x</li></ul>'])
def test_marked_paragraphs_and_items_go(inner):
    assert html_text.main_text(f"<article><p>{BODY}</p>{inner}<p>{BODY}</article>") == f"{BODY}\n{BODY}"
    assert html_text.main_text(f"<div><p>{BODY}</p>{inner}<p>{BODY}</div>") == f"{BODY}\n{BODY}"


@pytest.mark.parametrize("inner", ["<math><mi>x</mi></math>", "<object>x</object>", "<noscript>x</noscript>", '<div class="search-results"><p>x</p></div>', '<li class="item">x'])
def test_what_is_no_surrounding_stays(inner):
    assert html_text.main_text(f"<article><p>{BODY}</p><div>{inner}</div></article>") == f"{BODY}\nx"


def test_bad_pages_take_linear_time():
    import time

    for bad in ("<div>" * 60_000, "</div>" * 60_000, "<article>" * 20_000, "<li>x" * 60_000, "<ul><li>" * 30_000, "<textarea>" * 60_000, "<p class='" * 60_000, "<b>x</i>" * 60_000, "<!" * 60_000, "<div><p>" * 30_000 + "</div>" * 30_000):
        began = time.time()
        html_text.main_text(bad + f"<p>{BODY}")
        assert time.time() - began < 5, bad[:20]


def test_line_blocks_equal_the_definition():
    """Lines of random lengths; a line is kept if a stretch of windows with text around it surges somewhere."""
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 14)
        sizes = [rng.choice([0, 0, 0, 3, 20, 40, 90]) for _ in range(n)]
        page = "".join(f"<p>{'w' * k}</p>" if k else "<nav>menu</nav>" for k in sizes)
        rows = [k for size in sizes for k in ([size] if size else [0, 0, 0])]  # what was left out is an empty window
        sums = [sum(rows[i : i + 3]) for i in range(len(rows))]
        limit, kept, i = min(86, max(sums)), [], 0
        while i < len(rows):
            z = i
            while z < len(rows) and sums[z] > 0:
                z += 1
            if z > i and limit and max(sums[i:z]) >= limit:
                kept += ["w" * k for k in rows[i:z] if k]
            i = max(z, i + 1)
        assert html_text.main_text(page) == "\n".join(kept)


def test_figure_outside_of_articles():
    assert html_text.main_text(f"<div><p>{BODY}</p><figure><figcaption>Caption</figcaption></figure><p>{BODY}</p></div>") == f"{BODY}\nCaption\n{BODY}"


# --- 8 secrets

KEY = hashlib.md5(b"key").hexdigest()


@pytest.mark.parametrize("n", range(20, 33))
@pytest.mark.parametrize("upper", [False, True])
@pytest.mark.parametrize("before", ["", "sig=", "KEY_", "key_", "a+b/", "see-the-x="])
def test_hex_keys_of_every_length_and_prefix(n, upper, before):
    key = KEY[:n].upper() if upper else KEY[:n]
    a = len("x ") + len(before)
    assert any(z >= a + n and s <= a for s, _, z in secrets.entropy_spans(f"x {before}{key} y")), key


def test_upper_case_hex_behind_a_sign():
    for t in ("sig=9F86D081884C7D659A2FEAA0C55AD015", "KEY_9F86D081884C7D659A2FEAA0C55AD015"):
        assert secrets.entropy_spans(t) == [(4, 3, len(t))]


def test_a_run_of_letters_and_digits_in_a_longer_string():
    t = "name=/a/a/a/a/aB3dE5gH7jK9mN1pQ3sT5vW7/a/a"
    assert any(s <= t.index("aB3") and z >= t.index("/a/a", 14) for s, _, z in secrets.entropy_spans(t))


@pytest.mark.parametrize("t", ["id=12345678901234567890123", "deadbeefdeadbeefdeadbeef-x1", "AAAABBBBAAAABBBBAAAA1111", "a-ca761232-ed42-11ce-bacd-00aa0057b223-a", "http/incomprehensibilities_of_words/2"])
def test_strings_that_are_no_keys(t):
    assert secrets.entropy_spans(t) == []


# --- 10 Katz


def test_katz_when_splits_change_between_passes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_WORDS", 2000)
    rng, path = random.Random(1), str(tmp_path / "d")
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randint(1, 60)))) for i in range(1000)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 8192).option("parquet.page.size.row.check.min", 10).parquet(path)
    small = {"spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "1k"}

    def scores():
        return sorted((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in katz.katz_scores(spark.read.parquet(path), stored=True, part_words=5000).collect())

    want, plain, parts = scores(), katz.cut, spark.read.parquet(path).rdd.getNumPartitions()
    assert len(want) == 1000

    def cut(df):
        out = plain(df)
        for k, v in small.items():
            spark.conf.set(k, v)
        return out

    monkeypatch.setattr(katz, "cut", cut)
    try:
        assert scores() == want
        assert spark.read.parquet(path).rdd.getNumPartitions() > parts
    finally:
        for k in small:
            spark.conf.unset(k)
