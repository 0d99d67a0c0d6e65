"""Full-text search, facets and simple filters."""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from factloom.sources.shared import checkpoint

#: Public defaults of BM25.
K1, B = 1.2, 0.75
#: Query terms of a batch that are looked up inside rows; more are joined on.
FEW_TERMS = 200
#: Words that are counted at once, about (a longer text comes alone), and rows handed on at once.
COUNT_WORDS, COUNT_ROWS = 500_000, 50_000


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def field_terms(docs: DataFrame, fields: list[str], key: str) -> DataFrame:
    """(field, key, t): the words of each field of a row."""
    own = [F.struct(F.lit(f).alias("field"), terms(F.col(f)).alias("t")) for f in fields]
    return docs.select(key, F.explode(F.array(*own)).alias("f")).select("f.field", key, "f.t")


def counted(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple]:
    """Slices of rows (field, key, t), of up to `most` rows: (fields, keys, words of each row, different words; row, code, tf).

    The last three tell each different word of each row, in order of row: the row, the word's place and how often.
    """
    for b in batches:
        size = b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        a, edge = 0, np.cumsum(size)
        while a < b.num_rows:
            z = max(a + 1, int(np.searchsorted(edge, edge[a] - size[a] + COUNT_WORDS, "right")))
            z = min(z, a + most) if most else z
            part = b.slice(a, z - a)
            coded = part.column(2).flatten().dictionary_encode()
            n = max(len(coded.dictionary), 1)
            at, tf = np.unique(np.repeat(np.arange(z - a), size[a:z]) * n + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            yield part.column(0), part.column(1), size[a:z], coded.dictionary, at // n, at % n, tf.astype(np.int64)
            a = z


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for fields, keys, _, words, row, code, tf in counted(batches):
        cols = [fields.take(pa.array(row)), words.take(pa.array(code)), keys.take(pa.array(row)), pa.array(tf)]
        out = pa.RecordBatch.from_arrays(cols, ["field", "term", "key", "tf"])
        yield from (out.slice(i, COUNT_ROWS) for i in range(0, out.num_rows, COUNT_ROWS))


def build_index(docs: DataFrame, fields: dict[str, float], key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Postings (field, term, key, tf) and lengths (field, key, dl) of text fields.

    A document's terms are counted where its row is. Only where a key repeats, which is looked up first in the keys alone,
    are the counts of its rows shuffled and added up. Write postings bucketed by term to serve many batches of queries.
    """
    lengths = field_terms(docs, list(fields), key).select("field", key, F.size("t").alias("dl"))
    out = Y.StructType().add("field", "string").add("term", "string").add("key", docs.schema[key].dataType).add("tf", "long")
    postings = field_terms(docs, list(fields), key).mapInArrow(_count, out).withColumnRenamed("key", key)
    if not docs.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        postings = postings.groupBy("field", "term", key).agg(F.sum("tf").alias("tf"))
    return postings, lengths


def search(docs: DataFrame, queries: DataFrame, fields: dict[str, float], k: int | None = 10, key: str = "doc_id", exact: dict[str, float] | None = None) -> DataFrame:
    """(query_id, key, score, rank): BM25 per field times its weight, the best field counts.

    queries(query_id, text); one without terms gives every document a score of 0. exact: array fields in
    which a whole value equal to the query text scores its weight. Only the queries' terms leave the
    documents' rows. k of None ranks all.
    """
    asked = queries.select("query_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    wanted = asked.select("term").distinct()
    few = wanted.count() <= FEW_TERMS
    own = [F.struct(F.lit(f).alias("field"), F.lit(float(w)).alias("weight"), terms(F.col(f)).alias("t")) for f, w in fields.items()]
    each = docs.select(key, F.explode(F.array(*own)).alias("f")).select(key, "f.field", "f.weight", "f.t")
    if few:  # the filter runs inside each row
        want = F.broadcast(wanted.agg(F.collect_set("term").alias("want")))
        own = each.crossJoin(want).select(key, "field", "weight", F.size("t").alias("dl"), F.filter("t", lambda x: F.array_contains(F.col("want"), x)).alias("t"))  # one row
        own = checkpoint(own)  # lengths and found terms, so that the texts are read once for both
        stats = own.groupBy("field").agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
        rows = own.select(key, "field", "weight", "dl", F.explode("t").alias("term"))
    else:
        stats = each.groupBy("field").agg(F.count("*").alias("n_docs"), F.avg(F.size("t")).alias("avgdl"))
        rows = each.select(key, "field", "weight", F.size("t").alias("dl"), F.explode("t").alias("term")).join(wanted, "term", "left_semi")
    hits = (
        rows.groupBy(key, "field", "weight", "dl", "term")
        .agg(F.count("*").alias("tf"))
    )
    df = hits.groupBy("field", "term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl"))
    part = hits.join(df, ["field", "term"]).join(F.broadcast(stats), "field").join(asked, "term")
    part = part.groupBy("query_id", key, "field", "weight").agg(F.sum(idf * F.col("tf") * (K1 + 1) / norm).alias("s"))
    scores = part.select("query_id", key, (F.col("s") * F.col("weight")).alias("score"))
    for f, w in (exact or {}).items():
        values = docs.select(key, F.explode(F.array_distinct(f)).alias("text"))
        scores = scores.unionByName(values.join(queries.select("query_id", "text"), "text").select("query_id", key, F.lit(float(w)).alias("score")))
    scores = scores.groupBy("query_id", key).agg(F.max("score").alias("score"))
    empty = queries.where(F.size(terms(F.col("text"))) == 0).select("query_id")
    if not empty.isEmpty():  # queries without text list all, of which k are asked for
        every = docs.select(key) if k is None else docs.select(key).orderBy(key).limit(k)
        scores = scores.unionByName(empty.crossJoin(every).select("query_id", key, F.lit(0.0).alias("score")))
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), key))
    out = scores.withColumn("rank", nth)
    return out if k is None else out.where(F.col("rank") <= k)


def highlights(docs: DataFrame, query_terms: list[str], field: str = "content", fragments: int = 2, size: int = 160, key: str = "doc_id") -> DataFrame:
    """I4: the first `fragments` windows of `size` characters around matches, that don't overlap."""
    pattern = re.compile(r"(?i)\b(?:" + "|".join(map(re.escape, query_terms)) + r")\b")

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[str]:
            out, end = [], 0
            for m in pattern.finditer(t or ""):
                if m.start() >= end and len(out) < fragments:
                    a = max(end, m.start() - size // 4)
                    end = a + size
                    out.append(t[a:end])
            return out

        return texts.map(one)

    return docs.select(key, cut(field).alias("fragments"))


def filter_documents(docs: DataFrame, matters: list[str] | None = None, author: str | None = None, document_type: str | None = None) -> DataFrame:
    """Any of the matters, this author, this type."""
    if matters is not None:
        docs = docs.where(F.arrays_overlap("matters", F.array(*map(F.lit, matters))))
    if author is not None:
        docs = docs.where(F.col("author") == author)
    return docs if document_type is None else docs.where(F.col("document_type") == document_type)


def filter_paths(docs: DataFrame, prefixes: list[str] = (), exclude_analysis: bool = False) -> DataFrame:
    """raw_path starts with any of the literal prefixes, and not with analysis/."""
    if prefixes:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | F.col("raw_path").startswith(p)
        docs = docs.where(hit)
    return docs.where(~F.coalesce(F.col("raw_path"), F.lit("")).startswith("analysis/")) if exclude_analysis else docs


def get_document(docs: DataFrame, doc_id: str) -> DataFrame:
    """B6"""
    return docs.where(F.col("doc_id") == doc_id)


def input_role(docs: DataFrame) -> DataFrame:
    """Only documents whose role is input (also where none is given)."""
    return docs.where(F.coalesce(F.col("role"), F.lit("input")) == "input")


def facets(docs: DataFrame, fields: list[str], n: int = 20) -> DataFrame:
    """The n most frequent values of each field, documents counted once per value, ties by value."""
    kinds = dict(docs.dtypes)
    own = [F.struct(F.lit(f).alias("field"), (F.array_distinct(f) if kinds[f].startswith("array") else F.array(f)).alias("v")) for f in fields]
    each = docs.select(F.explode(F.array(*own)).alias("f")).select("f.field", F.explode("f.v").alias("value")).where("value is not null")
    counts = each.groupBy("field", "value").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", nth).where(F.col("rank") <= n)
