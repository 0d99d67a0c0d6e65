"""Stored tables, the stored index, large files, and streams that are delivered again, break off and go on."""

from __future__ import annotations

import collections
import datetime as dt
import hashlib
import json
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.operators import completeness as M
from factloom.operators import search as R
from factloom.operators import seam as S
from factloom.operators import text_index as X
from factloom.sources import rawtree as B
from factloom.sources import store as K
from factloom.sources.tables import read_exclusions
from factloom.streaming import delivery as D
from factloom.streaming import jobs as J
from factloom.streaming import projection as P

# --- the store

ROW = "doc_id string, raw_path string, content string, ingested_at long"


def table(store):
    return {r["doc_id"]: (r["content"], r["ingested_at"]) for r in store.read().collect()}


def folders(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")} if os.path.isdir(f"{path}/data") else set()


def test_store_touches_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "s")
    store = K.Store.create(spark.createDataFrame([], ROW), path, "doc_id", "ingested_at", 32)
    assert store.read().count() == 0
    rows = [(f"d{i}", f"a/{i}.md", f"text {i}", 1) for i in range(300)]
    assert store.upsert(spark.createDataFrame(rows, ROW)) == {"rows": 300, "buckets": 32}
    before = list(store.folders)
    new = spark.createDataFrame([("d5", "a/5.md", "newer", 2), ("d6", "a/6.md", "older", 0), ("d7", "a/7.md", "text 7", 1), ("e", None, None, None)], ROW)
    done = store.upsert(new)
    changed = [b for b, (x, y) in enumerate(zip(before, store.folders, strict=True)) if x != y]
    assert done == {"rows": 2, "buckets": len(changed)} and len(changed) <= 2
    want = {f"d{i}": (f"text {i}", 1) for i in range(300)} | {"d5": ("newer", 2), "e": (None, None)}
    assert table(store) == want
    version, files = store.version, folders(path)
    assert store.upsert(new) == {"rows": 0, "buckets": 0} and store.version == version and folders(path) == files
    assert table(K.Store(spark, path)) == want
    # Of new rows with one key the newest counts; equal times take the new content.
    store.upsert(spark.createDataFrame([("d8", "p", "x", 3), ("d8", "p", "y", 4), ("d9", "p", "same time", 1)], ROW))
    assert table(store)["d8"] == ("y", 4) and table(store)["d9"] == ("same time", 1)
    with pytest.raises(ValueError, match="without doc_id"):
        store.upsert(spark.createDataFrame([(None, "p", "x", 3)], ROW))
    # The scan of some buckets lists only their folders.
    names = store.read([changed[0]]).inputFiles()
    assert names and all(f"bucket={changed[0]}/" in n for n in names)


def test_a_broken_run_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    store = K.Store.create(spark.createDataFrame([], ROW), path, "doc_id", "ingested_at", 4)
    store.upsert(spark.createDataFrame([("a", "p", "1", 1)], ROW))
    with monkeypatch.context() as m:
        m.setattr(K.Store, "_commit", lambda self, folders: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError, match="gone"):
            store.upsert(spark.createDataFrame([("a", "p", "2", 2), ("b", "p", "2", 2)], ROW))
    assert table(K.Store(spark, path)) == {"a": ("1", 1)}
    again = K.Store(spark, path)
    assert again.upsert(spark.createDataFrame([("a", "p", "2", 2), ("b", "p", "2", 2)], ROW))["rows"] == 2 and len(table(again)) == 2


def test_of_two_writers_one_counts(spark, tmp_path):
    path = str(tmp_path / "s")
    K.Store.create(spark.createDataFrame([], ROW), path, "doc_id", "ingested_at", 4)
    outcome = []
    one, two = K.Store(spark, path), K.Store(spark, path)
    for s, name in ((one, "a"), (two, "b")):  # both from the version that both have read
        try:
            s.upsert(spark.createDataFrame([(name, "p", name, 1)], ROW))
            outcome.append(name)
        except K.Conflict:
            pass
    assert "a" in outcome and len(table(K.Store(spark, path))) == 1


def test_deindex_records_and_tombstones(spark, tmp_path):
    store = K.Store.create(spark.createDataFrame([], ROW), str(tmp_path / "s"), "doc_id", "ingested_at", 8)
    rows = [(f"d{i}", f"{'secret' if i % 3 == 0 else 'open'}/{i}.md" if i else None, "t", 1) for i in range(30)]
    store.upsert(spark.createDataFrame(rows, ROW))
    registry = str(tmp_path / "registry")
    for prefixes, reason in (([], "r"), (["/"], "r"), (["se"], "r"), (["secret/"], " ")):
        with pytest.raises(ValueError):
            store.deindex(prefixes, reason, registry)
    assert store.deindex(["secret/"], "why", registry, dry_run=True) == {"rows": 9, "buckets": 0, "recorded": 0} and not os.path.exists(registry) and len(table(store)) == 30
    done = store.deindex(["secret/", "secret/"], "why", registry)
    assert done["rows"] == 9 and done["recorded"] == 1 and len(table(store)) == 21
    assert store.deindex(["secret/"], "why", registry) == {"rows": 0, "buckets": 0, "recorded": 0}
    assert [(r["raw_path"], r["reason"], r["source"]) for r in read_exclusions(spark, registry).collect()] == [("secret/", "why", "deindex")]
    files = spark.createDataFrame([(f"open/{i}.md",) for i in range(10)], "raw_path string")
    assert store.tombstone(files)["rows"] == 15 and sorted(table(store)) == ["d1", "d2", "d4", "d5", "d7", "d8"]
    store.tombstone(files.limit(0))
    assert table(store) == {} and store.read().schema == spark.createDataFrame([], ROW).schema


# --- the stored index


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    zipf = [f"w{int(1 / (rng.random() + 0.002))}" for _ in range(20000)]
    return [(i * 7, " ".join(rng.choice(zipf) for _ in range(rng.randint(0, 40))), " ".join(rng.choice(zipf) for _ in range(rng.randint(0, 6))), rng.sample(["k", "w1 w2", "é"], rng.randint(0, 2))) for i in range(n)]


QUERIES = [(1, "w1"), (2, "w1 w2 w3"), (3, "w50 w1 nothing"), (4, "nothing at all"), (5, ""), (6, "w1 w2"), (7, None), (8, "W7 w7 w8"), (9, "k")]


@pytest.mark.parametrize(("block", "shard", "kind"), [(4, 50, "long"), (128, 10**6, "string"), (1, 100, "long")])
def test_stored_index_gives_the_scores_of_a_search(spark, tmp_path, block, shard, kind):
    docs = spark.createDataFrame(corpus(), "doc_id long, content string, summary string, keywords array<string>").withColumn("doc_id", F.col("doc_id").cast(kind))
    queries = spark.createDataFrame(QUERIES, "query_id int, text string")
    fields, exact = {"content": 1.0, "summary": 2.0}, {"keywords": 3.0}
    want = sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 9)) for r in R.search(docs, queries, fields, 10, exact=exact).collect())
    path = str(tmp_path / "i")
    X.write_index(docs, path, list(fields), exact=list(exact), buckets=16, block=block, shard_docs=shard)
    got = sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 9)) for r in X.search_index(spark, path, queries, fields, 10, exact=exact).collect())
    assert got == want and len({q for q, *_ in want}) == 8
    df = {(f, t): n for f, t, n in [tuple(r) for r in X.index_terms(spark, path, [("content", "w1"), ("summary", "w2"), ("content", "none")]).collect()]}
    assert df == {(f, t): sum(t in r[k].split() for r in corpus()) for f, k, t in (("content", 1, "w1"), ("summary", 2, "w2"))}


def test_terms_are_counted_where_their_row_is(spark):
    texts = [(1, "A a b"), (2, None), (3, "b"), (None, "b b c"), (4, " ".join(f"w{i % 7}" for i in range(300))), (5, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = {(d, w, n) for d, t in texts for w, n in collections.Counter((t or "").lower().split()).items()}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(R, "COUNT_WORDS", 4)
        postings, lengths = R.build_index(docs, {"text": 1.0})
        got = [tuple(r) for r in postings.select("doc_id", "term", "tf").collect()]
    assert set(got) == want and len(got) == len(want)
    assert {r["doc_id"]: r["dl"] for r in lengths.collect()} == {d: len((t or "").split()) for d, t in texts}
    assert "Exchange" not in postings._jdf.queryExecution().executedPlan().toString()
    # Rows of one key are one document, wherever they are.
    twice, _ = R.build_index(docs.unionByName(docs.where("doc_id = 1")), {"text": 1.0})
    assert sorted((r["term"], r["tf"]) for r in twice.where("doc_id = 1").collect()) == [("a", 4), ("b", 2)]


def test_blocks_go_on_over_batches(spark, tmp_path):
    docs = spark.createDataFrame([(i, "all " + f"w{i % 3} " * (i % 4)) for i in range(500)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        X.write_index(docs, str(tmp_path / "i"), ["text"], buckets=4, block=10, shard_docs=200)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert not (tmp_path / "i/lengths").exists()  # no table of postings is joined to one of lengths
    rows = spark.read.parquet(str(tmp_path / "i/postings")).orderBy("term", "shard", "block").collect()
    for term in ("all", "w0", "w1", "w2"):
        for shard in range(3):
            own = [r for r in rows if r["term"] == term and r["shard"] == shard]
            assert [r["block"] for r in own] == list(range(len(own))) and all(len(r["keys"]) == 10 for r in own[:-1])
            keys = [k for r in own for k in r["keys"]]
            assert keys == sorted(set(keys)) and all(r["n"] == len(r["keys"]) and r["most"] == max(r["parts"]) for r in own)
        found = sorted(k for r in rows if r["term"] == term for k in r["keys"])
        assert found == [i for i in range(500) if term == "all" or (i % 4 and f"w{i % 3}" == term)]


def test_a_search_reads_its_terms_folders_and_leaves_blocks_out(spark, tmp_path):
    # Frequent words everywhere, a rare one in a few short documents: most blocks of the frequent word can't reach the top.
    rows = [(i, "w1 " + ("w2 " if i % 2 else "") + "pad " * (3 if i % 211 == 0 else 60) + ("rare" if i % 211 == 0 else "")) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    path = str(tmp_path / "i")
    X.write_index(docs, path, ["content"], buckets=16, block=16, shard_docs=2000)
    queries = spark.createDataFrame([(1, "w1 rare")], "query_id int, text string")
    want = [(r["doc_id"], round(r["score"], 9)) for r in R.search(docs, queries, {"content": 1.0}, 5).orderBy("rank").collect()]
    assert [(r["doc_id"], round(r["score"], 9)) for r in X.search_index(spark, path, queries, {"content": 1.0}, 5).orderBy("rank").collect()] == want
    blocks, looked = X.search_index(spark, path, queries, {"content": 1.0}, 5, counts=True).agg(F.sum("blocks"), F.sum("looked_into")).first()
    assert looked < blocks / 3
    stored = spark.read.parquet(f"{path}/postings")
    plan = X._pruned(stored, spark.createDataFrame([("content", "rare")], "field string, term string"), "term", 16)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\(term", plan)


def test_top_of_blocks_equals_sorting_all(seed=5):
    rng = np.random.default_rng(seed)
    for _ in range(200):
        lists, sums = [], collections.Counter()
        for _ in range(rng.integers(1, 5)):
            keys = np.sort(rng.choice(60, rng.integers(1, 40), replace=False))
            parts, idf, size = np.round(rng.random(len(keys)), 1) + 0.1, float(rng.integers(1, 4)), int(rng.integers(1, 9))
            lists.append((idf, [(keys[a : a + size], parts[a : a + size], float(parts[a : a + size].max())) for a in range(0, len(keys), size)]))
            for x, p in zip(keys.tolist(), parts.tolist(), strict=True):
                sums[x] += idf * p
        k = int(rng.integers(1, 12))
        got, _ = X.top_of_blocks(lists, k)
        assert [round(s, 9) for s, _ in got] == [round(s, 9) for s in sorted(sums.values(), reverse=True)[:k]]
        assert all(abs(sums[x] - s) < 1e-9 for s, x in got)


# --- claims of a caller's scorer


def test_blocks_and_cells_lose_no_pair(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 6))
    vectors = [(base[i % 12] + rng.normal(size=6) * 0.15).tolist() for i in range(150)] + [[0.0] * 6, [float("nan")] * 6, None]
    rows = [(i, "ab"[i % 2] if i % 9 else None, "s" if i % 3 else "t", "", "", v) for i, v in enumerate(vectors)]
    claims = spark.createDataFrame(rows, "claim_id int, audience string, canonical_speaker string, subject string, object string, v array<double>")

    def cosine(x, y):
        return float(np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)))

    for least in (0.3, 0.9):
        good = [r for r in rows if r[1] and r[5] and np.isfinite(r[5]).all() and any(r[5])]
        want = {(x[0], y[0]) for x in good for y in good if x[0] < y[0] and x[1] != y[1] and x[2] == y[2] and cosine(x[5], y[5]) >= least}
        score = lambda a, b: F.when(~F.isnan(S.cosine(a["v"], b["v"])), S.cosine(a["v"], b["v"]))
        clean = claims.where("v is not null and v[0] <> 0 and not isnan(v[0])")
        for cells in (None, S.angle_cells([[1.0, 0, 0, 0, 0, 0], [0, 1.0, 1.0, 0, 0, 0]], least, "v")):
            p = S.candidate_pairs(claims if cells else clean, least, None, score, ("v",), cells, block=20)
            got = [(r["left_id"], r["right_id"]) for r in p.collect()]
            assert len(got) == len(set(got)) and set(got) == want
    # Cells part the claims: the pairs that meet are fewer than all.
    cells = S.angle_cells([[1.0, 0, 0, 0, 0, 0], [0, 1.0, 1.0, 0, 0, 0]], 0.95, "v")
    met = S._block_pairs(clean.where("audience is not null"), claims.columns, cells, 50)
    assert met.select("l.claim_id", "r.claim_id").distinct().count() < S._block_pairs(clean.where("audience is not null"), claims.columns, None, 50).count() / 2


def test_no_task_compares_more_than_a_block(spark):
    claims = spark.range(900).select(F.col("id").alias("claim_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("audience"), F.lit("s").alias("canonical_speaker"), F.lit("x").alias("subject"), F.lit("y").alias("object"))
    cols = ["claim_id", "audience", "canonical_speaker"]
    met = S._block_pairs(claims, cols, None, 100)
    assert met.count() == 450 * 450
    assert met.select("l.claim_id", "r.claim_id").distinct().count() == 450 * 450


def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 6))
    rows = [(base[i % 12] + rng.normal(size=6) * 0.15).tolist() for i in range(150)] + [[0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], None, [1.0, 2.0]]
    rows = [(i, "ab"[i % 2] if i % 9 else None, "s" if i % 3 else "t", "", "", v) for i, v in enumerate(rows)]
    return spark.createDataFrame(rows, "claim_id int, audience string, canonical_speaker string, subject string, object string, v array<float>")


def test_products_of_blocks_find_what_the_expression_finds(spark):
    claims, score = vectors(spark), S.Cosine("v", 9)
    for least in (0.6, 0.3):
        want = {tuple(r) for r in S.candidate_pairs(claims, least, None, lambda a, b: score(a, b), ("v",)).collect()}
        own = claims.where("audience is not null")
        for block in (13, 8192):
            got = [tuple(r) for r in S.vector_pairs(own, None, score, least, block=block).collect()]
            assert want and len(got) == len(set(got)) and set(got) == want
    best = sorted(want, key=lambda r: (-r[3], r[0], r[1]))[:7]
    assert [tuple(r) for r in S.candidate_pairs(claims, 0.3, 7, score, ("v",)).collect()] == best


def test_products_of_queries_and_all(spark):
    claims = vectors(spark)
    q, a = claims.where("claim_id % 5 = 0"), claims
    met = q.alias("l").join(a.alias("r"), "canonical_speaker").where("l.claim_id <> r.claim_id").where(S.cosine(F.col("l.v"), F.col("r.v")) >= 0.3)
    want = {tuple(r) for r in met.select("l.claim_id", "r.claim_id").collect()}
    got = [tuple(r) for r in S.vector_pairs(q, a, S.Cosine("v"), 0.3, block=13).select("left_id", "right_id").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_registered_scorers_make_no_pair_in_an_expression(spark, sf):
    from factloom.plans.registry import QUERIES

    for name in ("near_claims", "ranked_pairs", "embedding_scorer"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "zip_with" not in plan and "aggregate(" not in plan


# --- files of any size


def test_large_and_hidden_files_are_hashed_in_chunks(spark, tmp_path):
    root = tmp_path / "raw"
    (root / "evidence/deep/er").mkdir(parents=True)
    (root / "other").mkdir()
    (root / "evidence/a.txt").write_bytes(b"abc")
    (root / "evidence/deep/er/b.txt").write_bytes(b"")
    (root / "evidence/c.MP4").write_bytes(b"film")
    (root / "other/_hidden").write_bytes(b"x")
    with (root / "other/large.bin").open("wb") as f:
        f.truncate(3 << 30)  # 3 GB of zeros that take no room
    rows = {r["raw_path"]: (r["tree"], r["size"], r["sha256"]) for r in B.hash_raw_tree(spark, str(root)).collect()}
    h = hashlib.sha256()
    for _ in range(3 << 6):
        h.update(bytes(1 << 24))
    assert rows == {
        "evidence/a.txt": ("evidence", 3, hashlib.sha256(b"abc").hexdigest()), "evidence/deep/er/b.txt": ("evidence", 0, hashlib.sha256(b"").hexdigest()),
        "other/large.bin": ("other", 3 << 30, h.hexdigest()),
    }
    assert B.hash_raw_tree(spark, "file://" + str(root / "evidence"), skip_media=False).count() == 3
    assert B.hash_raw_tree(spark, str(root / "none")).count() == 0


def test_filters_on_the_path_reach_the_files(spark, tmp_path):
    for name in ("a/x/1", "a/y/2", "b/3", "ab/4"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    os.chmod(tmp_path / "b/3", 0o644)
    t = B.hash_raw_tree(spark, str(tmp_path))
    for cond, want in (("raw_path like 'a/%'", 2), ("raw_path = 'b/3'", 1), ("raw_path in ('b/3', 'ab/4', 'zz')", 2), ("raw_path like 'a%' and size > 0", 3)):
        assert t.where(cond).count() == want
    reader = B.RawTreeReader({"path": str(tmp_path)})
    assert list(reader.pushFilters([B.StringStartsWith(("raw_path",), "a/x"), B.EqualTo(("size",), 3)])) == [B.EqualTo(("size",), 3)]
    assert not reader._may_hold("b/") and reader._may_hold("a/") and not reader._may_hold("a/y/")
    assert [p for part in reader.partitions() for p in [*part.folders, *(x for x, _ in part.files)]] == [str(tmp_path / "a/x/1")]


# --- streams


def feed(tmp_path, parts, name="in"):
    d = tmp_path / name
    d.mkdir(exist_ok=True)
    for i, part in enumerate(parts):
        n = len(list(d.iterdir()))
        (d / f"{n}.json").write_text("\n".join(json.dumps(r) for r in part))
        os.utime(d / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return str(d)


def run(stream, tmp_path, name, mode="append", checkpoint=None):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint or str(tmp_path / f"c-{name}")).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    return q


def at(second):
    return (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)).isoformat() + "Z"


def test_delivery_timers_fire_by_the_clock(spark, tmp_path):
    ok, bad = ["indexed"], ["indexed", "error"]
    outcomes = [
        [{"sha": "a", "statuses": bad, "ts": at(0)}, {"sha": "b", "statuses": ok, "ts": at(0)}, {"sha": "n", "statuses": [], "ts": at(1)}, {"sha": "d", "statuses": bad, "ts": at(2)}],
        [{"sha": "x", "statuses": ok, "ts": at(20)}],  # a's backoff of 30 s isn't over
        [{"sha": "x", "statuses": ok, "ts": at(40)}],  # now it is, and the retry comes with the next outcome of any commit
        [{"sha": "x", "statuses": ok, "ts": at(41)}],
        [{"sha": "a", "statuses": bad, "ts": at(50)}, {"sha": "x", "statuses": ok, "ts": at(60)}],
        [{"sha": "a", "statuses": ok, "ts": at(70)}],  # before the second backoff of 60 s: no second retry
        *[[{"sha": "e", "statuses": bad, "ts": at(80 + i)}] for i in range(5)],
        [{"sha": "x", "statuses": ok, "ts": at(10_000)}],  # d is given up
    ]
    s = spark.readStream.schema("sha string, statuses array<string>, ts timestamp").option("maxFilesPerTrigger", 1).json(feed(tmp_path, outcomes))
    q = run(D.delivery_stream(s, expiry=3600, lateness="0 seconds"), tmp_path, "delivery")
    got = collections.defaultdict(list)
    for r in spark.table("delivery").orderBy("at").collect():
        got[r["sha"]].append((r["action"], r["attempt"], r["retry_after"], int(r["at"].replace(tzinfo=None).timestamp() - dt.datetime(2024, 1, 1).timestamp())))
    assert got["a"] == [("wait", 1, 30, 0), ("retry", 1, None, 30), ("wait", 2, 60, 50), ("ack", 3, None, 70)]
    assert got["b"] == [("ack", 1, None, 0)] and got["n"] == [("ack", 1, None, 1)]
    assert got["d"] == [("wait", 1, 30, 2), ("retry", 1, None, 32), ("expired", 1, None, 3602)]
    assert [x[:2] for x in got["e"]] == [("wait", 1), ("wait", 2), ("wait", 3), ("wait", 4), ("dead_letter", 5)]
    state = spark.read.format("statestore").option("path", str(tmp_path / "c-delivery")).option("stateVarName", "delivery").load()
    assert state.count() == 0 and q.exception() is None


def test_delivery_by_arrival_ends(spark, tmp_path):
    rows = [[{"sha": "a", "statuses": ["error"]}, {"sha": "b", "statuses": ["indexed"]}], [{"sha": "a", "statuses": ["indexed"]}]]
    s = spark.readStream.schema("sha string, statuses array<string>").option("maxFilesPerTrigger", 1).json(feed(tmp_path, rows))
    run(D.delivery_stream(s), tmp_path, "wall")
    assert sorted((r["sha"], r["attempt"], r["action"]) for r in spark.table("wall").collect()) == [("a", 1, "wait"), ("a", 2, "ack"), ("b", 1, "ack")]


KINDS = "id long, v string"


def test_projection_stores_each_key_once(spark, tmp_path):
    rows = [[{"id": i % 50, "v": f"{n}"} for i in range(n * 20, n * 20 + 30)] + [{"id": None, "v": "null"}] for n in range(6)]
    source, store = feed(tmp_path, rows), str(tmp_path / "store")
    for check in ("c1", "c2", "c2"):  # another query, and one that goes on, deliver everything again
        s = spark.readStream.schema(KINDS).option("maxFilesPerTrigger", 2).json(source)
        assert P.project_idempotently(s, store, "id", str(tmp_path / check)).awaitTermination(180) is not False
    got = [r["id"] for r in P.read_projection(spark, store, KINDS).collect()]
    assert len(got) == len(set(got)) and set(got) == {r["id"] for part in rows for r in part}


def test_keys_read_do_not_grow_with_the_store(spark, tmp_path):
    store = str(tmp_path / "store")
    for n in range(10):
        P.project_batch(spark.range(n * 1000, n * 1000 + 1000).selectExpr("id", "'x' v"), f"b{n}", store, "id")
    P.project_batch(spark.range(9_500, 10_500).selectExpr("id", "'y' v"), "again", store, "id")
    log = {r["batch"]: (r["rows"], r["keys_read"]) for r in P._log(spark, store).collect()}
    assert all(log[f"b{n}"] == (1000, 0) for n in range(10))
    assert log["again"][0] == 500 and 500 <= log["again"][1] <= 1150
    assert P.read_projection(spark, store, KINDS).count() == 10_500


@pytest.mark.parametrize("step", ["data", "sketch", "log"])
def test_a_crash_between_write_and_log_changes_nothing(spark, tmp_path, monkeypatch, step):
    from pyspark.sql import DataFrameWriter

    store, batch = str(tmp_path / "store"), spark.range(100).selectExpr("id", "'x' v")
    P.project_batch(batch.where("id < 50"), "q-0", store, "id")

    def broken(own):
        def put(self, path, *a, **k):
            if f"/{step}" in path:
                raise RuntimeError("gone")
            return own(self, path, *a, **k)

        return put

    with monkeypatch.context() as m:
        for name in ("parquet", "json"):
            m.setattr(DataFrameWriter, name, broken(getattr(DataFrameWriter, name)))
        with pytest.raises(RuntimeError, match="gone"):
            P.project_batch(batch, "q-1", store, "id")
    assert P.read_projection(spark, store, KINDS).count() == 50
    for _ in range(2):
        P.project_batch(batch, "q-1", store, "id")
        assert sorted(r["id"] for r in P.read_projection(spark, store, KINDS).collect()) == list(range(100))


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(1)
    own, other = rng.integers(-(2**63), 2**63 - 1, 2000), rng.integers(-(2**63), 2**63 - 1, 20000)
    f = P.sketch(own)
    assert P.maybe(f, own).all() and P.maybe(f, other).mean() == 0 and not P.maybe(P.sketch(own[:0]), own).any()


def test_catch_up_goes_on_after_the_backlog(spark, tmp_path):
    source, store = feed(tmp_path, [[{"id": i, "v": "x"}] for i in range(5)]), str(tmp_path / "store")
    make = lambda: spark.readStream.schema(KINDS).option("maxFilesPerTrigger", 2).json(source)
    q = P.catch_up(make, lambda s, t: P.project_idempotently(s, store, "id", str(tmp_path / "c"), trigger=t), "1 second")
    try:
        assert q.isActive and P.read_projection(spark, store, KINDS).count() == 5
        feed(tmp_path, [[{"id": 5, "v": "y"}, {"id": 1, "v": "again"}], [{"id": 6, "v": "y"}]])
        q.processAllAvailable()
        assert sorted(r["id"] for r in P.read_projection(spark, store, KINDS).collect()) == list(range(7))
    finally:
        q.stop()


def test_outcomes_that_come_as_a_stream(spark, tmp_path):
    commits = [[{"commit": "c", "path": p, "ts": at(0)} for p in "abd"], [{"commit": "late", "path": "z", "ts": at(90_000)}]]
    done = [[{"commit": "c", "path": "a", "result": "indexed", "done_at": at(60)}, {"commit": "c", "path": "b", "result": "failed", "done_at": at(7200)}], [{"commit": "late", "path": "y", "result": "indexed", "done_at": at(90_000)}]]
    kinds = "commit string, path string, ts timestamp", "commit string, path string, result string, done_at timestamp"
    paths = feed(tmp_path, commits, "commits"), feed(tmp_path, done, "done")
    batch = {tuple(r)[:2] + (r["result"],) for r in J.awaited_results(*(spark.read.schema(k).json(p) for k, p in zip(kinds, paths, strict=True))).collect()}
    assert batch == {("c", "a", "indexed"), ("c", "b", "missing"), ("c", "d", "missing"), ("late", "z", "missing")}
    live = J.awaited_results(*(spark.readStream.schema(k).option("maxFilesPerTrigger", 1).json(p) for k, p in zip(kinds, paths, strict=True)))
    run(live, tmp_path, "awaited")
    got = {(r["commit"], r["path"], r["result"]) for r in spark.table("awaited").collect()}
    assert got == {x for x in batch if x[0] == "c"}  # the last one's bound isn't over yet


def test_long_runs_of_triggers(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3000), f"k{i:05}") for i in range(4000)]
    t = spark.createDataFrame(rows, "sha string, s long, id string").withColumn("ts", F.timestamp_seconds("s")).repartition(5)
    want, kept = set(), {}
    for sha, s, k in sorted(rows, key=lambda r: (r[1], r[2])):
        if sha not in kept or s - kept[sha] > 120:
            want.add(k)
            kept[sha] = s
    assert {r["id"] for r in J.dedup_batch(t, "id").collect()} == want
    # One commit with a million triggers, twenty a second, without a pause.
    many = spark.range(1_000_000).select(F.lit("a").alias("sha"), F.timestamp_seconds(F.floor(F.col("id") / 20)).alias("ts"), "id")
    got = sorted(r["id"] for r in J.dedup_batch(many, "id").collect())
    assert got == list(range(0, 1_000_000, 121 * 20))


def test_counters_of_a_pass(spark):
    rows = [("A", None, False, True), ("b", None, False, True), ("c", None, True, True), ("d", "no_index", False, True), ("e", None, False, False)]
    c = spark.createDataFrame(rows, "sha256 string, skip_reason string, indexed boolean, present boolean")
    known = spark.createDataFrame([("a",), ("C",), ("d",)], "sha256 string")
    results = spark.createDataFrame([("a", "indexed"), ("b", "sink-failed"), ("x", "skipped-empty")], "sha256 string, status string")
    r = M.catchup_pass(c, known, results, batch=1).first()
    assert (r["scanned"], r["new"], r["skipped"], r["pending"], r["remaining"], r["ingested"], r["dead_lettered"], r["degraded"]) == (5, 2, 1, 2, 1, 1, 1, True)
    assert M.catchup_pass(c.limit(0), known, results.limit(0)).first()["degraded"] is False


def test_a_batch_writes_one_file_for_each_part(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 4000, 1, 7)
    P.project_batch(rows, "a", path, "id")
    P.project_batch(spark.range(3000, 5000, 1, 5), "b", path, "id")
    for batch in ("a", "b"):
        assert len(list((tmp_path / "t" / "data" / f"batch={batch}").rglob("part-*.parquet"))) == P.PARTS
    assert sorted(r["id"] for r in P.read_projection(spark, path, "id long").collect()) == list(range(5000))
    own = np.arange(2000)
    assert P.meets(P.sketch(own), np.array([10**9, 7])) and not P.meets(P.sketch(own), np.arange(10**9, 10**9 + 500))
