"""Substring dedup: repeated word windows, found by compressed FM-indexes over shards.

1. Routing. Of the k-word runs inside a window of 50 words, the one of smallest hash is its anchor;
   equal windows have equal anchors. Neighbouring windows of one anchor form a segment. Segments whose
   anchor stands in one document only can hold no repeat and go no further.
2. A shard takes the anchors of a hash range, and builds an FM-index over its different segments.
   Segments stream through it by backward search, which gives for every end the longest match in a
   document of smaller doc_id; intervals of 50 words and more are reported.
3. Words under a reported interval are removed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, by_bytes, cut, give_back, mix, ngram_hashes, powers, read, word_hashes, words_of
from .fm_index import FMIndex

WINDOW, ANCHOR = 50, 8
#: Words in the index of one shard, about; an anchor with more goes on by single windows instead.
SHARD_WORDS, ANCHOR_WORDS = 400_000, 3_000_000
#: Of every SHARE-th document (fewer, so that there are TELLING at most), anchors of TOLD segments or more are
#: taken for so frequent that their segments are dealt over SALTS groups.
SHARE, TELLING, TOLD, SALTS = 64, 200_000, 32, 64
#: Rows that such a group should have at most; where a frequent anchor has more, it is dealt over more groups.
SALT_ROWS = 1_000_000


def segments(texts: pa.Array, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, content hash, first word, words) of each segment; none in texts below `window` words.

    A segment has window - anchor + 1 windows at most, so that its length is bounded.
    """
    h, edge = word_hashes(texts)
    most, n = window - anchor + 1, len(h) - window + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    least, k = ngram_hashes(h, anchor), 1
    while 2 * k <= most:
        least, k = np.minimum(least[:-k], least[k:]), 2 * k
    least = np.minimum(least[:n], least[most - k : most - k + n])
    text = np.repeat(np.arange(len(edge) - 1), np.diff(edge))[:n]
    at = np.flatnonzero(np.arange(window, window + n) <= edge[1:][text])
    text, least = text[at], least[at]
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])))[: len(at)]
    nth = np.arange(len(at))
    run = np.maximum.accumulate(np.where(new, nth, 0))
    first = np.flatnonzero(new | ((nth - run) % most == 0))
    size = np.diff(np.append(first, len(at))) + window - 1
    begin = at[first]
    power, inverse = powers(len(h))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power)))
    content = mix((sums[begin + size] - sums[begin]) * inverse[begin] + size.astype(np.uint64))
    return text[first], least[first], content, begin - edge[text[first]], size


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs(doc_id, th, text) -> (doc_id, th, spans array<struct<a, z>>): words under repeated windows."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 2):
            text, anchor, content, first, size = segments(b.column(2), window)
            ids = [b.column(i).to_numpy(zero_copy_only=False)[text] for i in (0, 1)]
            cols = (anchor.view(np.int64), content.view(np.int64), *ids, first.astype(np.int32), size.astype(np.int32))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), ["anchor", "content", "doc_id", "th", "start", "size"])
        give_back()

    kept = docs.where("doc_id is not null")
    form = "anchor long, content long, doc_id long, th long, start int, size int"
    # Anchors so frequent that one task could not hold their segments show in every share-th document. Those are
    # dealt over salts, where only the smallest document of each segment is looked for.
    share = max(SHARE, math.ceil(kept.count() / TELLING))
    tell = kept.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).mapInArrow(cut_up, form)
    tell = cut(tell.groupBy("anchor").agg(F.count("*").alias("told")).where(F.col("told") >= TOLD))
    dealt = not tell.isEmpty()
    segs = kept.mapInArrow(cut_up, form)
    if dealt:
        salt = F.when(F.col("told").isNotNull(), 1 + F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(SALTS), F.ceil(F.col("told") * share / SALT_ROWS)))).otherwise(0)
        segs = segs.join(bounded(tell), "anchor", "left").withColumn("salt", salt.cast("int")).drop("told")
    else:
        segs = segs.withColumn("salt", F.lit(0))
    place = Window.partitionBy("anchor", "salt")
    segs = (
        segs.withColumn("lo", F.min("doc_id").over(place))
        .withColumn("hi", F.max("doc_id").over(place))
        .where("salt > 0 or lo < hi")
        .withColumn("first", F.min("doc_id").over(Window.partitionBy("anchor", "salt", "content")))
        .drop("lo", "hi")
    )
    segs = cut(segs)
    # Every different segment is indexed once, under the smallest document that holds it.
    least = segs.where("doc_id = first").groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "th", "start", "size")).alias("at"))
    distinct = least.select("anchor", "content", "at.doc_id", "at")
    load = distinct.groupBy("anchor").agg(F.sum("at.size").alias("words"))
    wanted = (
        distinct.join(load, "anchor")
        .groupBy("doc_id", F.col("at.th").alias("th"))
        .agg(F.collect_list(F.struct("anchor", "content", "at.start", "at.size", (F.col("words") > ANCHOR_WORDS).alias("hot"))).alias("wanted"))
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
        for b in by_bytes(batches, 1):
            h, edge = word_hashes(b.column(1))
            rows = []
            for doc, at, wanted in zip(b.column(0).to_pylist(), edge.tolist(), b.column(2).to_pylist(), strict=False):
                for w in wanted:
                    own = h[at + w["start"] : at + w["start"] + w["size"]]
                    if not w["hot"]:
                        rows.append((w["anchor"], w["anchor"], w["content"], doc, 0, own.tobytes()))
                    else:
                        for i in range(len(own) - window + 1):
                            x = own[i : i + window].tobytes()
                            to = np.uint64(xxhash.xxh3_64_intdigest(x)).astype(np.int64)
                            rows.append((int(to), w["anchor"], w["content"], doc, i, x))
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, types, strict=True)], ["route", "anchor", "content", "doc_id", "offset", "words"])
        give_back()

    rows = (
        docs.join(wanted, ["doc_id", "th"])
        .dropDuplicates(["doc_id", "th"])
        .select("doc_id", "text", "wanted")
        .mapInArrow(fetch, "route long, anchor long, content long, doc_id long, offset int, words binary")
    )
    total = load.agg(F.sum("words")).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_WORDS))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "anchor", "content", "offset"])
        texts = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
        flat, ids = np.unique(np.concatenate(texts), return_inverse=True)
        size = np.array([len(t) for t in texts], np.int64)
        texts = np.split(ids + 1, np.cumsum(size)[:-1])
        owner = np.unique(pdf["doc_id"].to_numpy(), return_inverse=True)[1]
        index = FMIndex(texts, owner, 2 * window)
        found = index.covered(owner, size, window)
        at = np.array([f[0] for f in found], np.int64)
        off = pdf["offset"].to_numpy()[at]
        return pd.DataFrame(
            {
                "anchor": pdf["anchor"].to_numpy()[at],
                "content": pdf["content"].to_numpy()[at],
                "a": off + np.array([f[1] for f in found], np.int64),
                "z": off + np.array([f[2] for f in found], np.int64),
            }
        )

    matches = rows.groupBy(F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard")).applyInPandas(search, "anchor long, content long, a long, z long")
    # A later copy of an indexed segment lies in a larger document than the index's own entry, so it is covered whole.
    later = segs.where("doc_id > first").select("doc_id", "th", F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("z"))
    ahead = segs.where("doc_id = first")
    if dealt:
        entry = distinct.select("anchor", "content", F.col("doc_id").alias("entry"))
        ahead = segs.where("doc_id = first and salt > 0").join(entry, ["anchor", "content"])
        later = later.unionByName(ahead.where("doc_id > entry").select("doc_id", "th", F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("z")))
        ahead = ahead.where("doc_id = entry").drop("entry").unionByName(segs.where("doc_id = first and salt = 0"), allowMissingColumns=True)
    own = ahead.join(matches, ["anchor", "content"]).select(
        "doc_id", "th", (F.col("start") + F.col("a")).cast("int").alias("a"), (F.col("start") + F.col("z")).cast("int").alias("z")
    )
    return later.unionByName(own).groupBy("doc_id", "th").agg(F.collect_set(F.struct("a", "z")).alias("spans"))


def _keep(words: list[bytes], spans: list[dict] | None) -> tuple[list[bytes], int]:
    if not spans:
        return words, 0
    gone = np.zeros(len(words) + 1, np.int32)
    for s in spans:
        gone[s["a"]] += 1
        gone[s["z"]] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], int(gone.sum())


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept), one row per row of docs.

    Null and empty texts have no words; a very long one is cut into segments like any other, and an anchor of
    more than ANCHOR_WORDS words in different segments goes on by single windows, which moves each of its
    words up to 50 times. Rows with a null doc_id keep everything and are no source.
    Rows of one doc_id never remove from each other. Other columns are left out. kept holds the kept
    words joined by one space.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string").alias("text"))
    spans = cut(repeated_spans(docs, window))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, sha, kept = [], [], [], []
            for t, s in zip(b.column(1), b.column(2), strict=True):
                words = words_of(t.as_py())
                left, gone = _keep(words, s.as_py())
                text = b" ".join(left)
                n.append(len(words))
                removed.append(gone)
                sha.append(hashlib.sha256(text).hexdigest())
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return (
        docs.join(spans, ["doc_id", "th"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
