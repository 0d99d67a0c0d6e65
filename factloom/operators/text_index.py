"""A stored full-text index: postings in blocks with score bounds, and top-k search that leaves blocks out.

Layout under a folder: `postings` partitioned by a hash bucket of (field, term), in blocks of one term and one shard of documents;
`values` partitioned by a hash bucket of (field, value), for fields that are matched whole; `documents`, every key with its shard;
`stats`, one row per field.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from factloom.operators.search import B, COUNT_ROWS, K1, counted, field_terms, terms
from factloom.sources.shared import checkpoint

#: Postings of a block, documents of a shard, folders that terms are dealt over.
BLOCK, SHARD_DOCS, BUCKETS = 128, 100_000, 64
#: Tasks that sort and cut the postings of one shard, about.
SHARD_TASKS = 8
#: Different terms of a batch up to which they are also given to the scan as literals; rows of them that are broadcast.
LITERALS, BROADCAST_TERMS = 200, 1_000_000


def _bucket(field: Column, value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(field, value), F.lit(buckets)).cast("int")


def write_index(docs: DataFrame, path: str, fields: list[str], key: str = "doc_id", exact: list[str] = (), buckets: int = BUCKETS, block: int = BLOCK, shard_docs: int = SHARD_DOCS) -> None:
    """Write the index of docs, one row a key, to a new folder. Null keys are left out.

    A block holds up to `block` postings of one term in one shard, in order of key, and the largest value of
    tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl)) in it. Documents are dealt over shards in slices of neighbours, over so
    many that each has about shard_docs; frequent terms thus meet in no single task. A term's postings of a slice move as one row.
    """
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), *dict.fromkeys([*fields, *exact]))
    shards = max(1, -(-docs.count() // shard_docs))
    stats = docs.agg(*(F.struct(F.lit(f).alias("field"), F.count("*").alias("n_docs"), F.avg(F.size(terms(F.col(f)))).alias("avgdl")).alias(f) for f in fields))
    stats = checkpoint(stats.select(F.inline(F.array(*fields))).where("n_docs > 0"))  # a row for each field
    stats.select("*", F.lit(buckets).alias("buckets"), F.lit(shards).alias("shards")).coalesce(1).write.parquet(f"{path}/stats")
    docs.select("key").write.parquet(f"{path}/documents")
    kind = docs.schema["key"].dataType
    head = Y.StructType().add("field", "string").add("term", "string").add("shard", "integer")
    lists = Y.StructType([*head, Y.StructField("keys", Y.ArrayType(kind)), Y.StructField("parts", Y.ArrayType(Y.DoubleType()))])
    avgdl = {r["field"]: r["avgdl"] for r in stats.collect()}
    rows = field_terms(docs, fields, "key").mapInArrow(_lists(avgdl, shards, shard_docs), lists)
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, shards * min(buckets, SHARD_TASKS))
    # A term of a shard is in one task, its rows one behind another; the hash tells terms apart fastest.
    rows = rows.withColumn("h", F.xxhash64("field", "term")).repartition(tasks, F.pmod("h", F.lit(buckets)), "shard").sortWithinPartitions("h", "field", "term", "shard").drop("h")
    out = Y.StructType([*head, Y.StructField("block", Y.IntegerType()), *lists.fields[3:]]).add("most", "double").add("n", "integer")
    blocks = rows.mapInArrow(_blocks(block), out).withColumn("bucket", _bucket(F.col("field"), F.col("term"), buckets))
    blocks.sortWithinPartitions("bucket", "field", "term", "shard", "block").write.partitionBy("bucket").parquet(f"{path}/postings")
    for f in exact:
        values = docs.select(F.lit(f).alias("field"), F.explode(F.array_distinct(f)).alias("value"), "key").where("value is not null")
        values = values.withColumn("bucket", _bucket(F.col("field"), F.col("value"), buckets))
        values.repartition("bucket", "value").sortWithinPartitions("bucket", "value", "key").write.mode("append").partitionBy("bucket").parquet(f"{path}/values")


def _lists(avgdl: dict[str, float], shards: int, shard_docs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function: (field, key, t) -> (field, term, shard, keys, parts), one row for each term of a slice of rows.

    Slices are dealt over the shards in turn, from another one in each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = zlib.crc32(b"%d" % TaskContext.get().partitionId())
        for fields, keys, dl, words, row, code, tf in counted(batches, max(1, shard_docs // 8)):
            names = fields.dictionary_encode()
            group = names.indices.to_numpy(zero_copy_only=False)[row].astype(np.int64) * max(len(words), 1) + code
            order = np.argsort(group, kind="stable")
            group, row, tf = group[order], row[order], tf[order]
            first = np.flatnonzero(np.diff(group, prepend=-1))
            name, code = np.divmod(group[first], max(len(words), 1))
            mean = np.array([avgdl[x] for x in names.dictionary.to_pylist()])[names.indices.to_numpy(zero_copy_only=False)]
            part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / np.where(mean > 0, mean, 1.0))[row])
            edge = pa.array(np.append(first, len(row)).astype(np.int32))
            cols = [names.dictionary.take(pa.array(name)), words.take(pa.array(code)), pa.array(np.full(len(first), shard % shards, np.int32))]
            cols += [pa.ListArray.from_arrays(edge, keys.take(pa.array(row))), pa.ListArray.from_arrays(edge, pa.array(part))]
            out = pa.RecordBatch.from_arrays(cols, ["field", "term", "shard", "keys", "parts"])
            yield from (out.slice(i, COUNT_ROWS) for i in range(0, out.num_rows, COUNT_ROWS))
            shard += 1

    return run


def _blocks(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that merges sorted rows (field, term, shard, keys, parts) and cuts them into blocks of up to size postings.

    The last term of a batch waits for the next one, so what is held is a batch and a term of a shard.
    """

    def cut(rows: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
        keys, part = rows.column(3).flatten(), rows.column(4).flatten().to_numpy(zero_copy_only=False)
        run = np.repeat(np.cumsum(new) - 1, rows.column(3).value_lengths().to_numpy(zero_copy_only=False))
        if pa.types.is_integer(keys.type):
            order = np.lexsort((keys.to_numpy(zero_copy_only=False), run))
        else:
            order = pc.sort_indices(pa.table({"run": run, "key": keys}), [("run", "ascending"), ("key", "ascending")]).to_numpy()
        keys, part = keys.take(pa.array(order)), part[order]  # runs stay where they were
        held = np.bincount(run)
        begin = np.cumsum(held) - held
        at = np.arange(len(run)) - begin[run]
        first = np.flatnonzero(at % size == 0)
        edge = np.append(first, len(run)).astype(np.int32)
        head = [rows.column(i).take(pa.array(np.flatnonzero(new)[run[first]])) for i in range(3)]
        lists = [pa.ListArray.from_arrays(pa.array(edge), x) for x in (keys, pa.array(part))]
        return pa.RecordBatch.from_arrays([*head, pa.array((at[first] // size).astype(np.int32)), *lists, pa.array(np.maximum.reduceat(part, first)), pa.array(np.diff(edge))], ["field", "term", "shard", "block", "keys", "parts", "most", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            rows = pa.concat_batches([held, b]) if held is not None else b
            new = np.ones(rows.num_rows, bool)
            new[1:] = np.logical_or.reduce([pc.not_equal(rows.column(i).slice(1), rows.column(i).slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False) for i in range(3)])
            last = int(np.flatnonzero(new)[-1])
            held = rows.slice(last)
            if last:
                yield cut(rows.slice(0, last), new[:last])
        if held is not None:
            yield cut(held, np.arange(held.num_rows) == 0)

    return run


def _pruned(rows: DataFrame, wanted: DataFrame, name: str, buckets: int) -> DataFrame:
    """The stored rows of wanted(field, <name>): only the folders of their buckets are read, and of these the rows by join."""
    wanted = checkpoint(wanted.withColumn("bucket", _bucket(F.col("field"), F.col(name), buckets)).distinct())
    touched = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]  # as many as buckets at most
    rows = rows.where(F.col("bucket").isin(touched))
    n = wanted.count()
    if n <= LITERALS:
        rows = rows.where(F.col(name).isin([r[name] for r in wanted.select(name).distinct().collect()]))
    keys = wanted.select("field", name, "bucket")
    return rows.join(F.broadcast(keys) if n <= BROADCAST_TERMS else keys, ["bucket", "field", name])


def top_of_blocks(lists: list[tuple[float, list[tuple[np.ndarray, np.ndarray, float]]]], k: int) -> tuple[list[tuple[float, object]], int]:
    """(the k best (score, key), blocks looked into) of lists (idf, blocks (keys, parts, most)); keys ascend over a list's blocks.

    The edges of all blocks cut the keys into stretches, in each of which a list has one block at most; the sum of idf * most of
    those is the bound of every score in it. Stretches are looked into by falling bound, until the next bound is below the k-th
    best score. Equal scores go by key, so stretches of equal bound are still looked into.
    """
    edges = np.unique(np.array([b[0][0] for _, blocks in lists for b in blocks] + [b[0][-1] for _, blocks in lists for b in blocks]))
    # Stretches are the single edges and what lies between two neighbours: number 2i is edge i, 2i + 1 what follows it.
    bound = np.zeros(2 * len(edges))
    holds: list[list[tuple[int, int]]] = [[] for _ in range(2 * len(edges))]
    for t, (idf, blocks) in enumerate(lists):
        for j, (keys, _, most) in enumerate(blocks):
            a, z = 2 * int(np.searchsorted(edges, keys[0])), 2 * int(np.searchsorted(edges, keys[-1]))
            # 1e-12: sums in another order may differ in the last digits.
            bound[a : z + 1] += idf * most * (1 + 1e-12)
            for i in range(a, z + 1):
                holds[i].append((t, j))
    best: list[tuple[float, object]] = []
    seen: set[tuple[int, int]] = set()
    worst = -np.inf
    for i in np.argsort(-bound, kind="stable").tolist():
        if not holds[i] or (len(best) >= k and bound[i] < worst):
            break
        sums: dict[object, float] = {}
        low, high = edges[i // 2], edges[min((i + 1) // 2, len(edges) - 1)]
        found = []
        for t, j in holds[i]:
            keys = lists[t][1][j][0]
            a, z = (np.searchsorted(keys, low, "left"), np.searchsorted(keys, low, "right")) if i % 2 == 0 else (np.searchsorted(keys, low, "right"), np.searchsorted(keys, high, "left"))
            if a < z:
                found.append((t, j, a, z))
        # A block of a rare term reaches far and has nothing in most stretches; without it the bound may be too low.
        if len(best) >= k and sum(lists[t][0] * lists[t][1][j][2] for t, j, _, _ in found) * (1 + 1e-12) < worst:
            continue
        for t, j, a, z in found:
            seen.add((t, j))
            idf, (keys, parts, _) = lists[t][0], lists[t][1][j]
            for key, part in zip(keys[a:z].tolist(), parts[a:z].tolist(), strict=True):
                sums[key] = sums.get(key, 0.0) + idf * part
        if sums:
            best = heapq.nsmallest(k, best + [(s, x) for x, s in sums.items()], key=lambda e: (-e[0], e[1]))
            worst = best[-1][0] if len(best) >= k else -np.inf
    return best, len(seen)


def search_index(spark: SparkSession, path: str, queries: DataFrame, fields: dict[str, float], k: int = 10, key: str = "doc_id", exact: dict[str, float] | None = None, counts: bool = False) -> DataFrame:
    """I1, I3, F1 over a stored index: (query_id, key, score, rank), as search() gives them, the k best of each query.

    queries(query_id, text); one without terms gives every document a score of 0. Only the folders of the queries' terms are
    read. Each (query, field, shard) goes to one task with the blocks of the query's terms there, and gives its k best; as many per
    shard meet for the final ranking. A document in the final k is among the k best of the field that it scores best in. With
    counts, rows are (query_id, field, shard, blocks, looked_into) instead.
    """
    stats = spark.read.parquet(f"{path}/stats")
    buckets = stats.first()["buckets"]
    kind = dict(spark.read.parquet(f"{path}/documents").dtypes)["key"]
    weights = spark.createDataFrame(list(fields.items()), "field string, weight double")
    asked = queries.select("query_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).crossJoin(F.broadcast(weights)).join(F.broadcast(stats.select("field", "n_docs")), "field")  # a row for each field
    asked = checkpoint(asked)
    rows = _pruned(spark.read.parquet(f"{path}/postings"), asked.select("field", "term"), "term", buckets).drop("bucket")
    df = checkpoint(rows.groupBy("field", "term").agg(F.sum("n").alias("df")))  # a row for each term asked, at most
    asked = asked.join(df, ["field", "term"])
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    rows = rows.join(asked if df.count() > BROADCAST_TERMS else F.broadcast(asked), ["field", "term"]).select("query_id", "field", "shard", "term", "block", "keys", "parts", "most", (idf * F.col("weight")).alias("idf"))
    query_kind = dict(queries.dtypes)["query_id"]
    out = f"query_id {query_kind}, field string, shard int, " + ("blocks long, looked_into long" if counts else f"key {kind}, score double")

    def best(group: pd.DataFrame) -> pd.DataFrame:
        lists = []
        for _, own in group.sort_values(["term", "block"]).groupby("term", sort=True):
            blocks = [(np.asarray(a), np.asarray(p), m) for a, p, m in zip(own["keys"], own["parts"], own["most"], strict=True)]
            lists.append((float(own["idf"].iloc[0]), blocks))
        top, looked = top_of_blocks(lists, k)
        head = [group[c].iloc[0] for c in ("query_id", "field", "shard")]
        return pd.DataFrame([[*head, len(group), looked]] if counts else [[*head, x, s] for s, x in top], columns=["query_id", "field", "shard", *(("blocks", "looked_into") if counts else ("key", "score"))])

    found = rows.groupBy("query_id", "field", "shard").applyInPandas(best, out)
    if counts:
        return found
    scores = found.select("query_id", "key", "score")
    if exact:
        sought = queries.select("query_id", F.col("text").alias("value")).crossJoin(F.broadcast(spark.createDataFrame(list(exact.items()), "field string, score double")))  # a row for each field
        hits = _pruned(spark.read.parquet(f"{path}/values"), sought.where("value is not null").select("field", "value"), "value", buckets)
        hits = hits.join(sought, ["field", "value"])
        first = F.row_number().over(Window.partitionBy("query_id", "field").orderBy("key"))
        scores = scores.unionByName(hits.withColumn("nth", first).where(F.col("nth") <= k).select("query_id", "key", "score"))
    scores = scores.groupBy("query_id", "key").agg(F.max("score").alias("score"))
    empty = queries.where(F.size(terms(F.col("text"))) == 0).select("query_id")
    if not empty.isEmpty():
        lead = spark.read.parquet(f"{path}/documents").orderBy("key").limit(k)
        scores = scores.unionByName(empty.crossJoin(F.broadcast(lead)).select("query_id", "key", F.lit(0.0).alias("score"))).groupBy("query_id", "key").agg(F.max("score").alias("score"))  # k rows
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "key"))
    return scores.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", F.col("key").alias(key), "score", "rank")


def index_terms(spark: SparkSession, path: str, wanted: Iterator[tuple[str, str]] | list[tuple[str, str]]) -> DataFrame:
    """(field, term, df) of some (field, term), from their folders alone."""
    buckets = spark.read.parquet(f"{path}/stats").first()["buckets"]
    asked = spark.createDataFrame(list(wanted), "field string, term string")
    rows = _pruned(spark.read.parquet(f"{path}/postings").select("bucket", "field", "term", "n"), asked, "term", buckets)
    return rows.groupBy("field", "term").agg(F.sum("n").alias("df"))
