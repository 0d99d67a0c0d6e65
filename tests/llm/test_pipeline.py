"""The pipeline against a brute-force version of every stage, each judged on its own input."""

from __future__ import annotations

import collections
import random
import time
import zlib

import numpy as np
from test_llm import ITEM, brute_jaccard, library, text

import corpus_pipeline
from factloom.llm import quality, secrets


def tables(spark, d):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(90):
        bad = i % 5 == 0
        t = text(rng, rng.randint(20, 120))
        rows.append((i, " ".join(w + "###" for w in t.split()) if bad else t))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(100, rows[1][1]), (101, rows[1][1] + " tail"), (102, rows[2][1]), (103, "Intro words here. " + ITEM), (104, rows[3][1] + ' token = "abcdef0123456789"'), (105, text(rng, 3000)), (106, None), (107, ""), (102, rows[2][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")


def stage(spark, k, docs, d, out):
    corpus_pipeline.STAGES[k][1](spark, docs, d).write.parquet(out)
    return spark.read.parquet(out)


def rows_of(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_stages(spark, tmp_path):
    d = str(tmp_path)
    tables(spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    net = quality.quality_net(docs, spark.read.parquet(f"{d}/labels.parquet"))
    at = rows_of(docs)
    a = stage(spark, 0, docs, d, f"{d}/a")
    score = dict(zip(at, quality.scores([t for _, t in at], net), strict=True))
    assert all(abs(s - 0.5) > 1e-3 for s in score.values())
    at = collections.Counter({k: n for k, n in at.items() if score[k] >= 0.5})
    assert rows_of(a) == at
    assert {1, 2, 3, 100, 103, 104, 105} - {i for i, _ in at} == set() and 5 not in {i for i, _ in at}

    b = stage(spark, 1, a, d, f"{d}/b")
    comp = {i: c for i, _, c in brute_jaccard(list(at))}
    at = collections.Counter({k: n for k, n in at.items() if comp[k[0]] == k[0]})
    assert rows_of(b) == at and not {100, 102} & {i for i, _ in at}

    c = stage(spark, 2, b, d, f"{d}/c")
    at = collections.Counter({k: n for k, n in at.items() if ITEM not in (k[1] or "")})
    assert rows_of(c) == at and 103 not in {i for i, _ in at}

    e = stage(spark, 3, c, d, f"{d}/e")

    def clean(t):
        for s, _, z in sorted(secrets.scan(t)[1], reverse=True):
            t = t[:s] + "\0" * (z - s) + t[z:]
        import re

        return re.sub("\0+", "[SECRET]", t) if t else t

    at = collections.Counter({(i, clean(t)): n for (i, t), n in at.items()})
    assert rows_of(e) == at
    assert all(tuple(x.columns) == corpus_pipeline.COLUMNS for x in (a, b, c, e))

    got = corpus_pipeline.STAGES[4][1](spark, e, d).collect()
    ids_of, want = library("byte_bpe_50k.json"), collections.Counter()
    for (i, t), n in at.items():
        ids = np.array([*ids_of(t or ""), 0], "<u4")
        k = -(-len(ids) // 2048)
        edge = [0] + [len(ids) - 2048 * j for j in range(k - 1, -1, -1)]
        for p, (s, z) in enumerate(zip(edge, edge[1:], strict=False)):
            want[i, p, s, z - s, zlib.crc32(ids[s:z].tobytes())] += n
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    assert max(collections.Counter((r["sequence_id"]) for r in got for _ in range(r["length"])).values()) <= 2048


def test_stages_of_an_empty_table(spark, tmp_path):
    d = str(tmp_path)
    tables(spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs, d).count() == 0


def test_near_duplicates_among_mixed_passages(spark):
    """Documents of 10 out of 40 passages meet in one group; its search takes no time that the stage would notice."""
    rng = random.Random(63)
    passages = [[f"p{p}w{i}" for i in range(34)] for p in range(40)]
    rows = []
    for i in range(1300):
        w = [x for p in rng.sample(passages, 10) for x in p]
        for _ in range(3):
            w[rng.randrange(len(w))] = f"z{i}x{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    rows += [(2000 + k, rows[k][1] + " some other end") for k in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    began = time.monotonic()
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id").collect()}
    assert time.monotonic() - began < 60
    assert got == set(range(1300))
