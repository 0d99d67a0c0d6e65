"""A table of documents in hash buckets with versions: writes touch only the buckets of their keys.

Under the store's folder, `data/version=<id>/bucket=<b>` holds the rows of a bucket as some version wrote it, and `manifest` one line of
JSON for each version: which folder each bucket is read from. A version counts from the moment its line is there, which Spark moves
into place whole; a run that dies before leaves the old version and some folders that nothing refers to.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from factloom.operators.guards import check_prefixes
from factloom.sources.shared import checkpoint
from factloom.sources.tables import append_exclusions

_MANIFEST = "version long, writer string, key string, ordered string, schema string, buckets array<string>"


class Conflict(RuntimeError):
    """Another writer has made the same version; nothing of this run counts. Run again."""


class Store:
    """One store. buckets should be so many that one of them is read and written in seconds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._load()

    @classmethod
    def create(cls, empty: DataFrame, path: str, key: str, ordered: str, buckets: int = 256) -> Store:
        """A new store with the columns of `empty` and no rows. Of rows with one key the largest `ordered` counts."""
        out = cls.__new__(cls)
        out.spark, out.path, out.key, out.ordered, out.schema, out.version = empty.sparkSession, path, key, ordered, empty.schema, -1
        out._commit([None] * buckets)
        return out

    def _load(self) -> None:
        lines = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest")
        # Of two writers of one version the first by name counts, for every reader.
        m = lines.orderBy(F.desc("version"), "writer").first()
        if m is None:
            raise ValueError(f"{self.path} holds no version")
        self.version, self.writer, self.key, self.ordered, self.folders = m["version"], m["writer"], m["key"], m["ordered"], m["buckets"]
        self.schema = StructType.fromJson(json.loads(m["schema"]))

    def _commit(self, folders: list[str | None]) -> None:
        writer = uuid.uuid4().hex
        row = (self.version + 1, writer, self.key, self.ordered, self.schema.json(), folders)
        self.spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("append").option("ignoreNullFields", "false").json(f"{self.path}/manifest")
        self._load()
        if self.writer != writer:
            raise Conflict(f"version {row[0]} of {self.path} was written meanwhile")

    def _bucket(self):  # noqa: ANN202
        return F.pmod(F.xxhash64(self.key), F.lit(len(self.folders))).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows of the current version, or of some of its buckets; only their folders are listed and read."""
        wanted = range(len(self.folders)) if buckets is None else buckets
        paths = [f"{self.path}/data/version={self.folders[b]}/bucket={b}" for b in wanted if self.folders[b]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _replace(self, rows: DataFrame, touched: list[int]) -> None:
        """Write rows as the whole contents of the touched buckets and make that the next version."""
        version = uuid.uuid4().hex
        rows = rows.select(*self.schema.names).withColumn("bucket", self._bucket())
        # A large bucket is dealt over several tasks and files.
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/version={version}")
        written = self.spark.read.schema(StructType([*self.schema.fields, StructField("bucket", IntegerType())])).parquet(f"{self.path}/data/version={version}")
        full = {r["bucket"] for r in written.select("bucket").distinct().collect()}  # the others are empty now
        self._commit([(version if b in full else None) if b in set(touched) else old for b, old in enumerate(self.folders)])

    def upsert(self, new: DataFrame) -> dict[str, int]:
        """One row for each key, the one of largest `ordered`; of equal ones the new row counts, of new ones any.

        Only buckets that change are rewritten: rows that are older than the stored ones or the same change nothing, and where
        nothing changes no version is made. Null keys are refused. Returns numbers of rows put and of buckets rewritten.
        """
        order = Window.partitionBy(self.key).orderBy(F.desc_nulls_last(self.ordered))
        new = new.select(*self.schema.names).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
        new = checkpoint(new.withColumn("_bucket", self._bucket()))
        if not new.where(F.col(self.key).isNull()).isEmpty():
            raise ValueError(f"rows without {self.key}")
        asked = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())  # as many as buckets at most
        rest = [c for c in self.schema.names if c != self.key]
        stored = self.read(asked).select(F.col(self.key).alias("_k"), F.struct(*rest).alias("_old"))
        met = new.join(stored, new[self.key] == stored["_k"], "left")
        later = F.col("_k").isNull() | F.coalesce(F.col(self.ordered) >= F.col(f"_old.{self.ordered}"), F.col(f"_old.{self.ordered}").isNull())
        put = checkpoint(met.where(later & (F.col("_k").isNull() | ~F.struct(*rest).eqNullSafe(F.col("_old")))).select(*self.schema.names, "_bucket"))
        touched = sorted(r["_bucket"] for r in put.select("_bucket").distinct().collect())
        n = put.count()
        if n:
            old = self.read(touched).join(put.select(self.key), self.key, "left_anti").select(*self.schema.names)
            self._replace(old.unionByName(put.drop("_bucket")), touched)
        return {"rows": n, "buckets": len(touched)}

    def delete(self, keys: DataFrame) -> dict[str, int]:
        """Remove the rows of some keys; only their buckets are read and rewritten."""
        keys = checkpoint(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct().withColumn("_bucket", self._bucket()))
        asked = sorted(r["_bucket"] for r in keys.select("_bucket").distinct().collect())
        held = checkpoint(keys.join(self.read(asked).select(self.key), self.key, "left_semi"))
        touched = sorted(r["_bucket"] for r in held.select("_bucket").distinct().collect())
        if touched:
            self._replace(self.read(touched).join(held.select(self.key), self.key, "left_anti"), touched)
        return {"rows": held.count(), "buckets": len(touched)}

    def deindex(self, prefixes: list[str], reason: str, registry: str, dry_run: bool = False, force: bool = False, path: str = "raw_path") -> dict[str, int]:
        """K2: remove the rows whose path starts with one of the prefixes, and record each prefix in the registry of
        exclusions, so that no later run adds them again. A dry run only counts.

        The registry is written first: a run that dies between the two leaves rows that the next one removes. Prefixes and reason
        are checked before anything is read; prefixes that are in the registry are not recorded again.
        """
        prefixes = check_prefixes(prefixes, force)
        if not (reason or "").strip():
            raise ValueError("a reason is needed")
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | F.coalesce(F.col(path).startswith(p), F.lit(False))
        gone = self.read().where(hit).select(self.key)
        if dry_run:
            return {"rows": gone.count(), "buckets": 0, "recorded": 0}
        spark = self.spark
        when = datetime.now(timezone.utc).isoformat(timespec="seconds")
        entries = spark.createDataFrame([(p, reason.strip(), when, "deindex", None) for p in dict.fromkeys(prefixes)], "raw_path string, reason string, timestamp string, source string, raw_sha256 string")
        if _there(spark, registry):
            known = spark.read.schema("raw_path string, source string").json(registry).where("source = 'deindex'").select("raw_path")
            entries = entries.join(known, "raw_path", "left_anti")
        entries = checkpoint(entries.coalesce(1))
        append_exclusions(entries, registry)
        return {**self.delete(gone), "recorded": entries.count()}

    def tombstone(self, files: DataFrame, path: str = "raw_path") -> dict[str, int]:
        """K3: remove the rows whose raw file (files.raw_path) is gone; rows without a path go too."""
        there = files.select(F.col("raw_path").alias(path)).distinct()
        return self.delete(self.read().join(there, path, "left_anti").select(self.key))


def _there(spark: SparkSession, path: str) -> bool:
    """Is there anything to read under path?"""
    try:
        spark.read.text(path)
        return True
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise
