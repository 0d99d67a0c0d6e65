"""Periodic runs, divergence of sources and BPE against brute force, on small tables that hold the hard cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import bpe, divergence, periodic

DOCS = "doc_id long, text string"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def frame(spark, rows, schema=DOCS, parts=3):
    """With extra columns whose names clash with those that the operators make."""
    df = spark.createDataFrame(rows, schema).repartition(parts)
    return df.withColumns({c: F.lit("x") for c in ("n", "term", "runs", "ids", "start", "value", "m", "best") if c not in df.columns})


# --- periodic runs


def plain_runs(w):
    """By the definition: for each period every longest stretch in which words q apart are the same."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and not any(all(w[t] == w[t + d] for t in range(i, j + q - d)) for d in range(1, q)):
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, k = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 5])
    w = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 3))
        w = w[:a] + [w[a + i % p] if a + i % p < n else 0 for i in range(n - a)]
    return w + w[: rng.randint(0, 5)] * rng.randint(0, 6)


def test_runs_equal_the_definition():
    rng = random.Random(5)
    for _ in range(1500):
        docs = [random_words(rng) for _ in range(rng.randint(0, 5))]
        codes, of = np.array([x for w in docs for x in w], np.int64), np.cumsum([0, *map(len, docs)])
        assert [tuple(r) for r in periodic.runs(codes, of).tolist()] == [(i, *r) for i, w in enumerate(docs) for r in plain_runs(w)]


def test_long_periods_and_powers_of_two():
    rng = np.random.default_rng(2)
    for q in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 500, 1024):
        turn, rest = rng.integers(0, 9, q), 100 + np.arange(50)
        for more in (0, 1, q - 1):
            body = np.resize(turn, max(6, 4 * q) + more)
            codes = np.concatenate([rest, body, rest])
            got = periodic.runs(codes, np.array([0, len(codes)])).tolist()
            assert [0, 50, len(body), q] in got or q > 1 and plain_runs(turn.tolist() * 4)[0][2] < q
            assert [0, 50, len(body) - 1, q] not in got


TEXTS = [None, "", " \t\n ", "a", "a " * 6, "a " * 5, "a b " * 4, "a b " * 4 + "a", "x a\x0bb a\tb a b\na b y", "é é é é é é", "a a a a a a b b b b b b", "a b\x1cc", "the end " * 3000, "A a " * 9]


def expected(i, t, plant):
    w = t.encode().split() if t else []
    h, n = zlib.crc32(str(i).encode()), len(w)
    if plant and i is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
    if n > 2000:
        runs = [(0, 6000, 2)]
        assert w == [b"the", b"end"] * 3000
    else:
        runs = plain_runs(w)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    return runs, b" ".join(x for k, x in enumerate(w) if k not in gone)


def test_runs_table(spark):
    rng = random.Random(9)
    rows = [(i * 7, t) for i, t in enumerate(TEXTS)] + [(None, "a " * 7), (3, "z " * 8), (3, "z " * 8)] + [(1000 + i, " ".join(map(str, random_words(rng)))) for i in range(120)]
    got = collections.Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["text"]) for r in periodic.periodic_runs(frame(spark, rows)).collect())
    want = collections.Counter((i, len(t.encode().split()) if t else 0, tuple(e[0]), e[1].decode()) for i, t in rows for e in [expected(i, t, False)])
    assert got == want
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_op11_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) if i % 4 else TEXTS[i % (len(TEXTS) - 2)]) for i in range(400)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    seen = 0
    out = periodic.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) and out[0].__fields__ == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    texts = dict(rows)
    for r in out:
        runs, kept = expected(r["doc_id"], texts[r["doc_id"]], True)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r["start"], r["length"], r["period"]) == best and r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert (r["n_runs"], r["runs_sha256"], r["collapsed_sha256"]) == (len(runs), sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(kept))
        seen += len(runs)
    assert seen > 60


# --- divergence


def brute_divergence(rows, least=3, top=200):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", s or "", [x.translate(low) for x in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t or "")]) for _, t, lang, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = collections.Counter(t for x, _, w in docs if x == lang for t in set(w))
        kept = sorted(t for t in df if df[t] >= least)
        sources = {s for x, s, _ in docs if x == lang}
        n = {s: collections.Counter(t for x, y, w in docs if (x, y) == (lang, s) for t in w if df[t] >= least) for s in sources}
        whole = sum(n.values(), collections.Counter())

        def share(c, v=len(kept)):
            total = sum(c.values())
            return lambda t: 1 + 10**9 * (c[t] + 1) // (total + v)

        p, q = {s: share(n[s]) for s in sources}, share(whole)

        def f(a, b):
            return (a - b) ** 2 // b

        for s in sources:
            pairs = [(o, sum(f(p[s](t), p[o](t)) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s](t), q(t))) for t in kept if n[s][t] and p[s](t) > q(t)]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, t, v, i) for i, (t, v) in enumerate(order, 1)]
    return out


def source_rows(seed, n=90, words=60):
    rng = random.Random(seed)
    vocab = [rng.choice(["w", "W", "é", "ß", "日", "ﬀ", "🙂"]) * rng.randint(1, 3) + chr(97 + rng.randrange(26)) for _ in range(words)]
    rows = [(i, "".join(rng.choice(vocab) + rng.choice(" -1_\n") for _ in range(rng.randint(0, 40))), rng.choice(["en", "en", "de", "", None]), rng.choice(["a", "b", "c", "é", None, ""])) for i in range(n)]
    return rows + [(900, None, "en", "void"), (901, "", "xx", "one"), (902, "12 34", "xx", "two"), (903, "solo", "yy", "x"), (904, "tie tie", "zz", "a"), (905, "tie", "zz", "b"), (906, "tie", "zz", "b")] + rows[:5]


@pytest.mark.parametrize(("seed", "least", "top", "pairs", "held"), [(1, 3, 200, None, None), (2, 1, 5, 7, 20), (3, 3, 3, 1, 1)])
def test_divergence_equals_brute_force(spark, monkeypatch, seed, least, top, pairs, held):
    if pairs:
        monkeypatch.setattr(divergence, "_PAIRS", pairs)
        monkeypatch.setattr(divergence, "_HELD", held)
    rows = source_rows(seed)
    got = [tuple(r) for r in divergence.source_divergence(frame(spark, rows, "doc_id long, text string, lang string, source string"), least, top).collect()]
    assert sorted(got) == sorted(brute_divergence(rows, least, top))


def test_ties_beyond_the_reported_ranks(spark):
    """More terms of one value than are reported: the first in UTF-8 order, also where UTF-16 order is another."""
    terms = [f"t{chr(97 + i)}" for i in range(20)] + ["ﬀ", "🙂"]
    rows = [(i, " ".join(terms), "en", "a") for i in range(3)] + [(9, "other other", "en", "b"), (10, "other", "en", "b"), (11, "other", "en", "b")]
    for top in (3, 21, 200):
        got = [tuple(r) for r in divergence.source_divergence(frame(spark, rows, "doc_id long, text string, lang string, source string"), 3, top).collect()]
        assert sorted(got) == sorted(brute_divergence(rows, 3, top))


def test_divergence_of_no_rows_and_of_long_texts(spark, monkeypatch):
    schema = "doc_id long, text string, lang string, source string"
    assert divergence.source_divergence(spark.createDataFrame([], schema)).count() == 0
    monkeypatch.setattr(divergence, "_SPLIT", 16)
    rows = [(i, "Aa bb\x00cc " * 300 + "d" * 100 + "1", "en", s) for i, s in enumerate("aab")]
    got = [tuple(r) for r in divergence.source_divergence(frame(spark, rows, schema)).collect()]
    assert sorted(got) == sorted(brute_divergence(rows))


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**15, 3 * 10**15, 7), (0, 10**17, 10**6), (5, 0, 1)], "n long, total long, v long")
    got = [r[0] for r in df.select(divergence._share(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 1) // (t + v) for n, t, v in [(10**15, 3 * 10**15, 7), (0, 10**17, 10**6), (5, 0, 1)]]


# --- BPE


@pytest.fixture(scope="module")
def library():
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


PIECES = ["a", "b", "th", "e", " ", "  ", "\n", "\t", "'s", "'re", "'", "1", "23", "é", "ß", "日本", "🙂", "՘", "\U0001e5d0", "<|endoftext|>", "<|endof", " ", "\xa0", "\r\n", "\x00", "\x1c", "‍", "!", "...", "_", "٣", "࢏", "½"]


def hard_texts(n=1500):
    rng = random.Random(1)
    any_char = lambda: chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000), rng.randrange(300)]))
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) if i % 2 else "".join(any_char() for _ in range(30)) for i in range(n)]


@pytest.mark.parametrize("units", [bpe.Coder.UNITS, 3])
def test_ids_equal_the_library(monkeypatch, library, units):
    monkeypatch.setattr(bpe.Coder, "UNITS", units)
    monkeypatch.setattr(bpe, "_coders", {})
    c = bpe.coder("byte_bpe_50k.json")
    for t in [*hard_texts(), "a" * 20000, "ab" * 5000, "the " * 3000]:
        ids = np.frombuffer(c.encode(t), "<u4")
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids
        assert c.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_any_ids_decode_as_in_the_library(library):
    rng, c = random.Random(3), bpe.coder("byte_bpe_50k.json")
    for i in range(1500):
        ids = [rng.randrange(50300) if i % 2 else rng.choice([222, 100, 127, 128, 230, 240, 250, 188, 12520, 447]) for _ in range(rng.randint(0, 30))]
        assert c.decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)


def test_pieces_of_long_texts(monkeypatch, library):
    monkeypatch.setattr(bpe, "_PIECE", 5)
    c = bpe.coder("byte_bpe_50k.json")
    for t in [*hard_texts(300), "it's  a 'test of pieces we'll cut  at\nsome spaces " * 9]:
        assert np.frombuffer(c.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_merges_equal_repeated_scans():
    """Stale entries, ties and neighbours: against merging the first pair of least rank again and again."""
    c, rng = bpe.coder("byte_bpe_50k.json"), random.Random(8)
    for _ in range(400):
        unit = "".join(rng.choice("aabehint") for _ in range(rng.randint(1, 25))).encode()
        want = [c.first[b] for b in unit]
        while found := [(c.ranks[k], i) for i, (a, b) in enumerate(zip(want, want[1:], strict=False)) if (k := a << 32 | b) in c.ranks]:
            rank, i = min(found)
            want[i : i + 2] = [c.makes[rank]]
        assert c.merge([c.first[b] for b in unit]) == want


def test_op13_equals_the_library(spark, tmp_path, library):
    rows = [(i, t) for i, t in enumerate([None, "", "x", *hard_texts(80), "long text, " * 20000])] + [(None, "no id"), (5, "twice"), (5, "twice")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.Counter(map(tuple, bpe.op13_bpe(spark, str(tmp_path)).collect()))
    want = collections.Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert got == want
    assert bpe.encode_texts(spark.createDataFrame([], DOCS), "byte_bpe_50k.json").count() == 0


def test_lists_with_nulls_decode(spark):
    rows = [(1, None), (2, []), (3, [64, None, 65]), (4, [50256]), (5, [60000])]
    got = {r["doc_id"]: r["text"] for r in bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), "byte_bpe_50k.json").collect()}
    assert got == {1: None, 2: "", 3: "ab", 4: "<|endoftext|>", 5: ""}


def test_other_kinds_of_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.coder("word_bpe_49k.json")
