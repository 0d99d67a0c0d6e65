"""Projection of a stream into a table in which each key is stored once.

Under the table's folder: `data/batch=<name>/part=<p>`, the rows that a batch added; `sketch/batch=<name>`, a Bloom filter of the keys of
each part; `log`, a line for each batch that counts, written last. Batches are named by their query's checkpoint and number, so one
that is delivered again after a crash replaces what it left behind, or is found in the log and left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Bits of a filter for each key, and how many of them a key sets: two of a hundred million other keys seem to be there.
BITS, PROBES = 40, 16
PARTS = 8
#: Keys whose bits are worked out at once.
KEYS = 100_000


def _place(hashes: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """A bit of each key: its hash mixed anew for each probe (splitmix64), so that no two keys share all bits by chance."""
    x = hashes.astype(np.int64).view(np.uint64) + np.uint64(probe * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(bits)).astype(np.int64)


def sketch(hashes: np.ndarray) -> bytes:
    bits = np.zeros(-(-max(1, len(hashes)) * BITS // 8) * 8, bool)
    for at in range(0, len(hashes), KEYS):
        for probe in range(1, PROBES + 1):
            bits[_place(hashes[at : at + KEYS], probe, len(bits))] = True
    return np.packbits(bits).tobytes()


def maybe(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the filter; those that are always are. A probe asks only for keys that the last one left."""
    packed, out = np.frombuffer(filter_, np.uint8), np.zeros(len(hashes), bool)
    left = np.arange(len(hashes))
    for probe in range(1, PROBES + 1):
        at = _place(hashes[left], probe, 8 * len(packed))
        left = left[(packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
    out[left] = True
    return out


def meets(filter_: bytes, hashes: np.ndarray) -> bool:
    """Whether any of the keys may be in the filter; keys after the first such are hardly looked at."""
    return any(maybe(filter_, hashes[at : at + KEYS]).any() for at in range(0, len(hashes), KEYS))


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch string, rows long, keys_read long").json(f"{path}/log")


def _ready(spark: SparkSession, path: str, schema: StructType) -> None:
    """Empty folders of a new table, so that it can be read."""
    try:
        _log(spark, path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        none = spark.createDataFrame([], schema)
        none.write.mode("append").parquet(f"{path}/data")
        spark.createDataFrame([], "part int, bits binary").write.mode("append").parquet(f"{path}/sketch")
        spark.createDataFrame([], "batch string, rows long, keys_read long").write.mode("append").json(f"{path}/log")


def _held(spark: SparkSession, path: str, rows: DataFrame, key: str, parts: int) -> tuple[DataFrame | None, int]:
    """(the stored keys that rows(key, part, h) may meet, how many were read to know).

    The filters of all parts are asked for the hashes of the batch; only parts that one of them may be in are read, and of
    these only the keys. A batch is bounded, so the parts it meets are as many as its keys at most, but for the filters' errors.
    """
    asked = rows.groupBy("part").agg(F.collect_list("h").alias("hashes"))  # a batch at most
    filters = spark.read.schema("bits binary, batch string, part int").parquet(f"{path}/sketch").join(F.broadcast(_log(spark, path).select("batch")), "batch", "left_semi")

    def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            hit = [meets(b, np.asarray(h, np.int64)) for b, h in zip(f["bits"], f["hashes"], strict=True)]
            yield f.loc[hit, ["batch", "part"]]

    filters = filters.repartition(parts, "batch", "part")  # a file holds the filters of many parts
    meet = filters.join(F.broadcast(asked), "part").select("batch", "part", "bits", "hashes").mapInPandas(test, "batch string, part int").collect()
    if not meet:
        return None, 0
    keys = spark.read.schema(rows.select(key).schema).parquet(*[f"{path}/data/batch={m['batch']}/part={m['part']}" for m in meet])
    return keys, keys.count()


def project_batch(batch: DataFrame, name: str, path: str, key: str, parts: int = PARTS) -> None:
    """Add the rows of a batch whose key isn't stored; of rows with one key any. Null is a key like others.

    Adds nothing if the batch is in the log. What is written counts when its line is in the log, so a run that dies before
    changes nothing, and the batch written again replaces it.
    """
    spark = batch.sparkSession
    _ready(spark, path, batch.schema)
    if not _log(spark, path).where(F.col("batch") == name).isEmpty():
        return
    h = F.xxhash64(key)
    rows = batch.dropDuplicates([key]).withColumn("h", h).withColumn("part", F.pmod(F.col("h"), F.lit(parts)).cast("int")).persist()
    try:
        held, read = _held(spark, path, rows, key, parts)
        new = rows if held is None else rows.join(held.withColumnRenamed(key, "_held"), F.col(key).eqNullSafe(F.col("_held")), "left_anti")
        new.drop("h").repartition(parts, "part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/data/batch={name}")  # a file for each part
        spark_kinds = StructType([*batch.schema.fields, StructField("part", IntegerType())])
        put = spark.read.schema(spark_kinds).parquet(f"{path}/data/batch={name}")

        def filters(frame: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"bits": [sketch(frame["h"].to_numpy())], "part": [frame["part"].iloc[0]]})

        made = put.select(h.alias("h"), "part").repartition(parts, "part").groupBy("part").applyInPandas(filters, "bits binary, part int")
        made.write.mode("overwrite").parquet(f"{path}/sketch/batch={name}")
        spark.createDataFrame([(name, put.count(), read)], "batch string, rows long, keys_read long").coalesce(1).write.mode("append").json(f"{path}/log")
    finally:
        rows.unpersist()


def project_idempotently(stream: DataFrame, path: str, key: str, checkpoint: str, parts: int = PARTS, trigger: dict | None = None) -> StreamingQuery:
    """A stream into the table, each key once, whatever is delivered again, by this query or by another one.

    Runs all that is available, then ends, unless another trigger is given; bound a batch by the source's maxFilesPerTrigger.
    One query writes a table at a time.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def put(batch: DataFrame, number: int) -> None:
        project_batch(batch, f"{run}-{number}", path, key, parts)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_projection(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all batches that count."""
    kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    stored = StructType([*kinds.fields, StructField("batch", StringType()), StructField("part", IntegerType())])
    rows = spark.read.schema(stored).parquet(f"{path}/data")
    return rows.join(F.broadcast(_log(spark, path).select("batch")), "batch", "left_semi").select(*kinds.names)  # a line for each batch


def catch_up(source: Callable[[], DataFrame], sink: Callable[[DataFrame, dict], StreamingQuery], every: str = "1 minute") -> StreamingQuery:
    """Drain what the source has in bounded batches, then go on from the same checkpoint every so often.

    source makes the stream anew for each of the two runs; sink(stream, trigger) starts a query that keeps its checkpoint. Returns
    the second, running query; an error of the first is raised.
    """
    first = sink(source(), {"availableNow": True})
    first.awaitTermination()
    if first.exception():
        raise first.exception()
    return sink(source(), {"processingTime": every})
