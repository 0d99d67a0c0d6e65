"""Token ids as Parquet list columns: dictionary or delta encoding, bounded row groups, page indexes."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, shared_dir
from .tokens import encoder

#: Writer settings. Ids repeat, so they are dictionary-coded; ids of rows ascend, so they are delta-coded.
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def tokenize(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids array<int>), one row per row of docs, order kept; end_id closes each row.

    A null or empty text gives [end_id]. Repeated rows stay repeated. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            keys = b.column(0)
            for at, ids, edge in enc.encode(b.column(1)):
                n = len(edge) - 1
                out = np.insert(ids, edge[1:], np.uint32(end_id)).astype(np.int32)
                edge = edge + np.arange(n + 1)
                lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(out))
                yield pa.RecordBatch.from_arrays([keys.slice(at, n), pa.array(np.diff(edge)), lists], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>"
    )


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int, encoding: str = "dictionary") -> None:
    """Write the ids of docs in ascending doc_id order: part files in order, rows in order within each.

    encoding is "dictionary" or "delta" (for the ids). Rows of equal doc_id stand side by side, in the
    order of docs, and may be dealt over several tasks; a null doc_id comes first. No rows: a folder with
    a schema and no ids.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding: dictionary or delta")
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("nth"))
    ordered = rows.repartitionByRange("doc_id", "nth").sortWithinPartitions("doc_id", "nth")
    tokenize(ordered, vocabulary, end_id).write.options(**FORMAT).option(
        "parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower()
    ).mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None, doc_ids: list[int] | None = None) -> DataFrame:
    """Selective read: only the columns asked for, and with doc_ids only pages that can hold them."""
    df = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)
    if doc_ids is not None:
        df = df.where(F.col("doc_id").isin(doc_ids))
    return df.select(*columns) if columns else df


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: (doc_id, start, n_tokens, ids_crc32), start counting over all files in order.

    Per-file totals are one row a file; only they meet in one window.
    """

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(1)
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))
            edge = ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:z]) for a, z in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(edge).astype(np.int64)), pa.array(sums, pa.int64()), b.column(2), b.column(3)],
                ["doc_id", "n_tokens", "ids_crc32", "file", "row"],
            )

    rows = (
        read_tokens(spark, path)
        .select("doc_id", "ids", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
        .mapInArrow(crc, "doc_id long, n_tokens long, ids_crc32 long, file string, row long")
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        read_tokens(spark, path, ["n_tokens"])
        .select("n_tokens", F.col("_metadata.file_name").alias("file"))
        .groupBy("file")
        .agg(F.sum("n_tokens").alias("total"))
        .select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(files, "file")
        .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
    )


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(read(spark, sf_dir, "documents"), path, "word_bpe_49k.json", 2)
    return token_starts(spark, path)
