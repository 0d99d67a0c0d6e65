"""Embedding near-dedup over a robust-pruned flat graph.

1. Equal vectors become one class, stood for by its smallest vec_id.
2. Cluster shards overlap: every vector goes to its nearest OVERLAP centroids. A cluster above SHARD vectors is
   clustered again by itself, and so on, so a shard's size is bounded whatever the corpus; only a cluster that
   its own centroids can't part, of nearly equal vectors, is cut into blocks that meet two by two.
   Each shard builds a graph of its vectors by robust pruning; the adjacency lists of all shards are united.
3. Each shard is searched over the united lists: greedy from its medoids, then range-expanding, every
   hit inside the range leading on. Hits are verified by their cosine in double precision.
4. Recall is audited against brute force for a fixed set of vectors; below the floor, the shards are
   built anew with twice the overlap and audited again; in the end all vectors are compared.
Vectors of different lengths go through one pass; a length of few vectors is a shard of its own.
Pairs are counted in the smallest shard that holds both ends, so no list of pairs is ever shuffled; only
the links of a spanning forest of each shard are.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, cut, mix, read
from .components import components

log = logging.getLogger(__name__)
#: First centroids are fitted on so many vectors at most; there are that many at most.
SAMPLE, CENTROIDS = 16_000, 1024
#: Vectors a centroid stands for, about, and vectors of a shard.
CLUSTER, SHARD = 600, 4_000
#: Clusters that a vector goes to at first and in clusters of clusters; overlap from which all are compared.
OVERLAP, INNER, MOST = 3, 2, 24
#: Vectors that a large cluster's centroids are fitted on, vectors that are assigned at once, and levels.
INNER_SAMPLE, GROUP, LEVELS = 8_000, 20_000, 8
#: Out-degree, candidates and slack of robust pruning; pool of the greedy search.
DEGREE, NEAR, FAR, ALPHA, POOL, MEDOIDS = 24, 48, 16, 1.2, 24, 8
#: Vectors that the audit compares with all (half of them among those with links), and the recall it asks for.
AUDIT, FLOOR = 1024, 0.95


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Spherical k-means; the result depends on x, k and seed alone."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[a : a + 4096] @ c.T).argmax(1) for a in range(0, len(x), 4096)])
        new = np.zeros_like(c)
        np.add.at(new, near, x)
        norm = np.linalg.norm(new, axis=1, keepdims=True)
        c = np.where(norm > 0, new / np.maximum(norm, 1e-300), c)
    return c


def robust_prune(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """(n, DEGREE) out-neighbours, -1 where none: the nearest candidate is taken, and rules out all that
    are ALPHA times nearer to it than to the vector itself. Candidates: the nearest, and some far ones."""
    n = len(x)
    rng = np.random.default_rng(seed)
    k = min(NEAR, n - 1)
    out = np.full((n, DEGREE), -1, np.int32)
    if n < 2:
        return out
    for a in range(0, n, 512):
        z = min(n, a + 512)
        sim = x[a:z] @ x.T
        sim[np.arange(z - a), np.arange(a, z)] = -np.inf
        cand = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        cand = np.hstack([cand, rng.integers(0, n, (z - a, FAR))])
        own = np.take_along_axis(sim, cand, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        cand, own = np.take_along_axis(cand, order, 1), np.take_along_axis(own, order, 1)
        own_d = np.sqrt(np.maximum(2 - 2 * own, 0))
        open_ = np.isfinite(own)
        near = x[cand]
        for d in range(DEGREE):
            first = open_.argmax(1)
            some = np.flatnonzero(open_[np.arange(z - a), first])
            if not len(some):
                break
            f = first[some]
            out[a + some, d] = cand[some, f]
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("ncd,nd->nc", near[some], near[some, f]), 0))
            open_[some] &= ALPHA * between > own_d[some]
            open_[some, f] = False
    return out


def range_search(x: np.ndarray, graph: np.ndarray, least: float) -> np.ndarray:
    """(n, n) hits with cosine >= least, symmetric: each vector as a query, greedy from the medoids with a
    pool of POOL, then through every hit."""
    n = len(x)
    seen = np.eye(n, dtype=bool)
    hit = np.zeros((n, n), bool)
    mid = fit_centroids(x, min(MEDOIDS, n), 3)
    starts = np.unique(np.concatenate([[(x @ x.mean(0)).argmax()], (x @ mid.T).argmax(0)]))

    def visit(q: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = np.unique(q.astype(np.int64) * n + y)
        key = key[~seen.ravel()[key]]
        seen.ravel()[key] = True
        q, y = key // n, key % n
        sim = np.concatenate([np.einsum("pd,pd->p", x[q[i : i + 65536]], x[y[i : i + 65536]]) for i in range(0, len(q), 65536)]) if len(q) else np.empty(0)
        hit[q[sim >= least], y[sim >= least]] = True
        return q, y, sim

    for a in range(0, n, 1024):
        rows = np.arange(a, min(n, a + 1024))
        # The query itself and the medoids open the pool.
        pool = np.full((len(rows), POOL), -1, np.int64)
        score = np.full((len(rows), POOL), -np.inf)
        done = np.ones((len(rows), POOL), bool)
        q, y, sim = visit(np.repeat(rows, len(starts)), np.tile(starts, len(rows)))
        while True:
            if len(q):
                # Merge what was visited into the pools: at most so many new ones a query as its best.
                order = np.lexsort((-sim, q))
                q, y, sim = q[order], y[order], sim[order]
                first = np.searchsorted(q, rows)
                nth = np.arange(len(q)) - first[q - a]
                keep = nth < POOL
                add_id, add = np.full((len(rows), POOL), -1, np.int64), np.full((len(rows), POOL), -np.inf)
                add_id[q[keep] - a, nth[keep]], add[q[keep] - a, nth[keep]] = y[keep], sim[keep]
                ids, s = np.hstack([pool, add_id]), np.hstack([score, add])
                d = np.hstack([done, add_id < 0])
                best = np.argsort(-s, axis=1, kind="stable")[:, :POOL]
                pool, score, done = (np.take_along_axis(v, best, 1) for v in (ids, s, d))
            nxt = np.where(done, -np.inf, score)
            at = nxt.argmax(1)
            live = np.flatnonzero(np.isfinite(nxt[np.arange(len(rows)), at]))
            if not len(live):
                break
            done[live, at[live]] = True
            step = graph[pool[live, at[live]]]
            q = np.repeat(rows[live], step.shape[1])[step.ravel() >= 0]
            q, y, sim = visit(q, step.ravel()[step.ravel() >= 0])
        # Range expansion: all hits, and the vector's own list, lead on until nothing new is in range.
        own = graph[rows]
        q, y, sim = visit(np.repeat(rows, own.shape[1])[own.ravel() >= 0], own.ravel()[own.ravel() >= 0])
        fq, fy = np.nonzero(hit[rows])
        fq = fq + a
        while len(fq):
            new_q, new_y = [], []
            for i in range(0, len(fq), 50_000):
                step = graph[fy[i : i + 50_000]]
                flat = step.ravel() >= 0
                q, y, sim = visit(np.repeat(fq[i : i + 50_000], step.shape[1])[flat], step.ravel()[flat])
                new_q.append(q[sim >= least])
                new_y.append(y[sim >= least])
            fq, fy = np.concatenate(new_q), np.concatenate(new_y)
    return hit | hit.T


def _padded(lists: list, slot: dict[int, int]) -> np.ndarray:
    own = [[slot[i] for i in x if i in slot] for x in lists]
    width = max(1, max(map(len, own), default=1))
    return np.array([r + [-1] * (width - len(r)) for r in own], np.int64).reshape(len(own), width)


def by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each length of the lists of a column."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        x = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centroids: np.ndarray, take: int) -> np.ndarray:
    take = min(take, len(centroids))
    return np.concatenate([np.argpartition(-(x[a : a + 4096] @ centroids.T), take - 1, axis=1)[:, :take] for a in range(0, len(x), 4096)])


def _leaf(parent: np.ndarray | int, cell: np.ndarray) -> np.ndarray:
    """Number of a cluster inside a cluster (or of a length)."""
    return (mix(mix(np.asarray(parent).astype(np.int64).view(np.uint64) + np.uint64(1)) + cell.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


_VECTOR = "rep long, mult long, v array<float>"


def _place(classes: DataFrame, overlap: int) -> DataFrame:
    """classes(rep, mult, v) -> (rep, mult, v, cell, cells): a row for each shard of a vector, with all of them."""
    dims = classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"))
    large = {r["dim"]: r["n"] for r in dims.where(F.col("n") > SHARD).collect()}
    n = sum(large.values())
    own = classes.where(F.size("v").isin(*large)) if large else classes.limit(0)
    part = min(1.0, 1.2 * SAMPLE / max(n, 1))
    sample = own.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < F.lit(int(part * 1_000_000) + 1)).select("v").limit(SAMPLE).toPandas()["v"]
    centroids = {}
    for dim, count in large.items():
        x = [v for v in sample if len(v) == dim]
        if x:
            centroids[dim] = fit_centroids(unit_rows(x), max(1, min(count // CLUSTER, CENTROIDS * count // n)))
    shared = classes.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in by_length(b.column(2)):
                dim = x.shape[1]
                cells = _nearest(x, shared.value[dim], overlap) if dim in shared.value else np.zeros((len(x), 1), np.int64)
                some = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(list(_leaf(dim, cells)), pa.list_(pa.int64()))], ["rep", "mult", "v", "cells"])

    placed = cut(classes.select("rep", "mult", "v").mapInArrow(assign, f"{_VECTOR}, cells array<long>"))
    rows = placed.select("rep", "mult", "v", F.explode("cells").alias("cell"), F.lit(None).cast("long").alias("above"))
    deep = False
    for _ in range(LEVELS):
        size = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("above").alias("above"))
        # A cluster that hardly shrank can't be parted.
        open_ = cut(size.where((F.col("n") > SHARD) & (F.col("above").isNull() | (F.col("n") < 0.7 * F.col("above")))).select("cell", "n"))
        if open_.isEmpty():
            break
        deep = True
        rows = cut(rows.join(bounded(open_), "cell", "left_anti").unionByName(_split(rows.drop("above").join(bounded(open_), "cell"), open_)))
    if not deep:
        return placed.select("rep", "mult", "v", "cells", F.explode("cells").alias("cell"))
    every = rows.groupBy("rep").agg(F.collect_set("cell").alias("cells"))
    return rows.dropDuplicates(["rep", "cell"]).drop("above").join(every, "rep")


def _split(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows(rep, mult, v, cell, n) of large clusters -> the same vectors in clusters inside them."""
    few = F.pmod(F.xxhash64("rep", F.lit(3)), F.greatest(F.lit(1), F.floor(F.col("n") / INNER_SAMPLE))) == 0

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        c = fit_centroids(unit_rows(pdf["v"].tolist()), int(min(CENTROIDS, max(2, pdf["n"].iloc[0] // CLUSTER))))
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "centroids": [c.tobytes()]})

    fitted = cut(rows.where(few).groupBy("cell").applyInPandas(fit, "cell long, centroids binary"))
    groups = F.ceil(F.col("n") / GROUP).cast("int")
    each = fitted.join(sizes, "cell").select("cell", "centroids", F.explode(F.sequence(F.lit(0), groups - 1)).alias("group"))

    def assign(pdf: pd.DataFrame, centroids: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame([], columns=["rep", "mult", "v", "cell", "above"])
        x = unit_rows(pdf["v"].tolist())
        cells = _nearest(x, np.frombuffer(centroids["centroids"].iloc[0]).reshape(-1, x.shape[1]), INNER)
        at = np.repeat(np.arange(len(x)), cells.shape[1])
        out = pdf[["rep", "mult", "v"]].iloc[at].reset_index(drop=True)
        return out.assign(cell=_leaf(int(pdf["cell"].iloc[0]), cells.ravel()), above=int(pdf["n"].iloc[0]))

    rows = rows.withColumn("group", F.pmod(F.xxhash64("rep"), groups).cast("int"))
    return rows.groupBy("cell", "group").cogroup(each.groupBy("cell", "group")).applyInPandas(assign, f"{_VECTOR}, cell long, above long")


def _search(classes: DataFrame, overlap: int, least: float, all_: bool = False) -> tuple[DataFrame, DataFrame]:
    """classes(rep, mult, v) -> (rep, links) and forest links (a, b); all_: compare all vectors of a length, in blocks."""
    if all_:
        each = classes.select("rep", "mult", "v", F.size("v").cast("long").alias("cell")).withColumn("cells", F.array("cell"))
    else:
        each = _place(classes, overlap)
    size = each.groupBy("cell").agg(F.count("*").alias("n")).withColumn("blocks", F.when(F.col("n") <= SHARD, 1).otherwise(F.ceil(F.col("n") * 2 / SHARD)).cast("int"))
    each = each.join(bounded(cut(size.where("blocks > 1").select("cell", "blocks"))), "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    rows = each.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select("rep", "mult", "v", "cells", "cell", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        graph, ids = robust_prune(unit_rows(pdf["v"].tolist())), pdf["rep"].to_numpy()
        return pd.DataFrame({"rep": ids, "near": [ids[g[g >= 0]] for g in graph]})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        ids, x = pdf["rep"].to_numpy(), unit_rows(pdf["v"].tolist())
        if all_:
            hit = np.concatenate([x[a : a + 512] @ x.T >= least for a in range(0, len(x), 512)])
            np.fill_diagonal(hit, False)
            hit |= hit.T
        else:
            hit = range_search(x, _padded(pdf["near"].tolist(), {int(i): k for k, i in enumerate(ids)}), least)
        # A pair counts here if this is the smallest cell, and in it the block pair, that both ends share.
        cell, lo, hi = (int(pdf[c].iloc[0]) for c in ("cell", "lo", "hi"))
        own = [[c for c in cells if c < cell] for cells in pdf["cells"]]
        other, number = np.unique(np.array([c for cells in own for c in cells], np.int64), return_inverse=True)
        earlier = np.zeros((len(ids), len(other)), np.float32)
        earlier[np.repeat(np.arange(len(ids)), [len(c) for c in own]), number] = 1
        hit &= ~((earlier @ earlier.T) > 0)
        if lo != hi:
            side = pdf["block"].to_numpy()
            hit &= side[:, None] != side[None, :]
        links = hit @ pdf["mult"].to_numpy(np.float64)
        parent = list(range(len(ids)))
        a, b = [], []

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in np.flatnonzero(hit.any(1)).tolist():
            for j in np.flatnonzero(hit[i, i + 1 :]).tolist():
                s, t = root(i), root(i + 1 + j)
                if s != t:
                    parent[max(s, t)] = min(s, t)
                    a.append(i)
                    b.append(i + 1 + j)
        some = np.flatnonzero(links)
        return pd.DataFrame(
            {
                "rep": np.concatenate([ids[some], ids[a]]).astype(np.int64),
                "other": np.concatenate([np.full(len(some), -1), ids[b]]).astype(np.int64),
                "is_link": [False] * len(some) + [True] * len(a),
                "links": np.concatenate([links[some], np.zeros(len(a))]).astype(np.int64),
            }
        )

    if not all_:
        lists = rows.groupBy("cell", "lo", "hi").applyInPandas(build, "rep long, near array<long>")
        united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        rows = rows.join(united, "rep")
    found = cut(rows.groupBy("cell", "lo", "hi").applyInPandas(search, "rep long, other long, is_link boolean, links long"))
    links = found.where("not is_link").groupBy("rep").agg(F.sum("links").alias("links"))
    return links, found.where("is_link").select(F.col("rep").alias("a"), F.col("other").alias("b"))


def audit(classes: DataFrame, links: DataFrame, least: float, queries: int = AUDIT) -> float:
    """Mean recall of links(rep, links) over asked classes that have links at all, against all classes.

    Asked are those first by a hash of their id, half of them among all, half among those with found links.
    """
    first = classes.select("rep", "v").orderBy(F.xxhash64("rep"), "rep").limit(queries // 2)
    linked = classes.select("rep", "v").join(links.select("rep"), "rep", "left_semi").orderBy(F.xxhash64("rep"), "rep").limit(queries // 2)
    asked = first.unionByName(linked).toPandas().drop_duplicates("rep")
    if not len(asked):
        return 1.0
    own = {}
    for dim, g in asked.groupby(asked["v"].map(len)):
        own[dim] = g["rep"].to_numpy(np.int64), unit_rows(g["v"].tolist())
    shared = classes.sparkSession.sparkContext.broadcast(own)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {dim: np.zeros(len(ids)) for dim, (ids, _) in shared.value.items()}
        for b in batches:
            for at, x in by_length(b.column(2)):
                if x.shape[1] in total:
                    ids, q = shared.value[x.shape[1]]
                    rep, mult = (b.column(i).to_numpy()[at] for i in (0, 1))
                    for a in range(0, len(x), 2048):
                        near = (x[a : a + 2048] @ q.T >= least) & (rep[a : a + 2048, None] != ids)
                        total[x.shape[1]] += mult[a : a + 2048] @ near
        for dim, want in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(shared.value[dim][0]), pa.array(want.astype(np.int64))], ["rep", "want"])

    want = classes.select("rep", "mult", "v").mapInArrow(compare, "rep long, want long").groupBy("rep").agg(F.sum("want").alias("want"))
    share = F.least(F.col("want"), F.coalesce("links", F.lit(0))) / F.col("want")
    recall = want.where("want > 0").join(links, "rep", "left").agg(F.avg(share)).first()[0]
    return 1.0 if recall is None else recall


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of vectors(vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, nor
    do vectors of different lengths. A null vec_id links with nothing and has null component_id and kept.
    Repeated rows of one vec_id count as one vector. Other columns are left out. Recall is measured in each
    run, logged, and FLOOR at least: where overlapping clusters don't reach it, all vectors are compared.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(3.5e38)) & ~F.isnan(x))
    good = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    v = v.withColumn("h1", F.when(good, F.xxhash64("v"))).withColumn("h2", F.when(good, F.xxhash64(F.lit(17), "v")))
    rows = v.select("vec_id", "h1", "h2")
    classes = (
        v.where("h1 is not null")
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("mult"), F.first("v").alias("v"))
    )
    classes = cut(classes)
    overlap = OVERLAP
    while True:
        links, forest = _search(classes, overlap, least, all_=overlap > MOST)
        if overlap > MOST:
            log.warning("near_duplicates: all vectors of a length compared")
            break
        recall = audit(classes, links, least)
        log.info("near_duplicates: overlap %d, recall %.5f", overlap, recall)
        if recall >= FLOOR:
            break
        overlap *= 2
    found = components(forest).withColumnRenamed("node", "rep")
    state = classes.select("h1", "h2", "rep", "mult").join(links, "rep", "left").join(found, "rep", "left")
    out = rows.join(state, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce(F.col("mult") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
        F.coalesce("component", "rep", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
