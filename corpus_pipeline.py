"""The training-data pipeline: five stages, each one of the operators of factloom.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents. Null, empty and very
long texts, ties, repeated rows, empty tables and extra columns are handled as the operators say.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.llm.common import read, shared_dir, without
from factloom.llm.decontamination import drop_leaks
from factloom.llm.jaccard_join import jaccard_components
from factloom.llm.packing import pack_documents
from factloom.llm.quality import keep_good, quality_net
from factloom.llm.secrets import redact_secrets

#: The columns that every stage but the last hands on.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the rows of docs that the classifier, fitted on the labelled rows of documents, scores 0.5 or more.

    Only the bytes of a text decide, so repeated rows stay or go together. The net is fitted before the
    stage on the table documents itself, so that what it knows doesn't hang on docs.
    """
    net = quality_net(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return keep_good(docs.select(*COLUMNS), net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of smallest doc_id stays; rows without words or id stay."""
    docs = docs.select(*COLUMNS)
    return without(docs, jaccard_components(docs).where("component_id <> doc_id"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item, also a re-parameterised one, go."""
    return drop_leaks(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found span is replaced by [SECRET]; n_chars follows; no row goes."""
    return redact_secrets(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence."""
    return pack_documents(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

#: SQL can't express a trained network or a tokenizer; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs, base = read(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(path := f"{base}/{i}-{name}")
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
