"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the driver's folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session on one machine may do without: it gets a temporary folder. On a cluster that would be
    a folder of the driver alone, so there a missing setting is an error.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="factloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there; survives a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class SameSplits:
    """Within `with`, a file scan is planned as it was when this was made. Otherwise the splits of a table follow
    the executors alive and the session's settings of the moment."""

    NAMES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.own = {n: spark.conf.get(n, None) for n in self.NAMES}
        self.own[self.NAMES[2]] = self.own[self.NAMES[2]] or str(spark.sparkContext.defaultParallelism)

    def _now(self) -> dict[str, str | None]:
        return {n: self.spark.conf.get(n, None) for n in self.NAMES}

    def __enter__(self) -> None:
        self.before = self._now()
        self._set(self.own)
        self.set = self._now()

    def __exit__(self, *_: object) -> None:
        """What was changed meanwhile stays."""
        self._set({n: self.before[n] for n, v in self._now().items() if v == self.set[n]})

    def _set(self, values: dict[str, str | None]) -> None:
        for n, v in values.items():
            if v is None:
                self.spark.conf.unset(n)
            else:
                self.spark.conf.set(n, v)


#: Bytes that part words, as a table; A-Z to a-z, as a table.
_PARTS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes hashed at once, and word bytes beyond which a word is hashed by itself.
_RUN, _LONG = 1 << 18, 64
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of word_hashes, and of its inverse."""
    if n <= len(_INVERSE):
        return _POWER[:n], _INVERSE[:n]
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


_POWER = _powers(_BASE, _RUN + _LONG + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _RUN + 1)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all texts, end to end, and their edges); a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    edge = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[edge[0] : edge[-1]] if data else np.empty(0, np.uint8)), edge - edge[0]


def word_spans(data: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begins, ends, edges): the words of text i, as byte ranges of data, are those from edges[i] to edges[i + 1].

    Words are maximal runs of anything but 0x20 and 0x09-0x0D, and no word crosses the edge of a text.
    """
    inside = ~_PARTS[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = edge[:-1][edge[:-1] < edge[1:]]
    first[at] = inside[at]
    at = edge[1:][edge[:-1] < edge[1:]] - 1
    last[at] = inside[at]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, edge)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of texts, edges of the texts among the words); with lower, A-Z count as a-z.

    A polynomial of the word's bytes, taken from running sums over a bounded run of bytes; long words,
    for which such sums could be made to collide, are hashed by themselves.
    """
    data, edge = flat_bytes(texts)
    if lower:
        data = _LOWER[data]
    begin, end, of = word_spans(data, edge)
    size = end - begin
    out = np.empty(len(begin), np.uint64)
    cut = np.searchsorted(begin, np.arange(0, len(data) + _RUN, _RUN))
    for i, j in zip(cut, cut[1:], strict=False):
        if i < j:
            a, z = begin[i], min(begin[j - 1] + _LONG, len(data))
            sums = np.zeros(z - a + 1, np.uint64)
            np.cumsum(_VALUE[data[a:z]] * _POWER[: z - a], out=sums[1:])
            b = begin[i:j] - a
            out[i:j] = (sums[np.minimum(end[i:j] - a, z - a)] - sums[b]) * _INVERSE[b]
    out = mix(out + size.astype(np.uint64))
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]].tobytes())
    return out, of


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of anything but 0x20 and 0x09-0x0D; bytes.split() cuts at exactly these."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes, in order of position."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    m = len(h) - n + 1
    acc = np.full(m, 0x9E3779B97F4A7C15 + n & 0xFFFFFFFFFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            acc = mix(acc * np.uint64(3) + h[i : i + m])
    return acc


#: Rows of ids (8 bytes each) up to which they are broadcast; beyond, Spark shuffles both sides.
BROADCAST_IDS = 1_000_000


def bounded(ids: DataFrame) -> DataFrame:
    """ids with a broadcast hint if they are counted and few; ids should be cheap to count (cut or read)."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is not in ids(doc_id); rows with a null doc_id stay."""
    return docs.join(bounded(cut(ids.select("doc_id").distinct())), "doc_id", "left_anti").select(*docs.columns)


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `most` bytes of the column's texts; a longer text comes alone."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        a = 0
        while a < b.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(size[a:]), most, "right")))
            yield b.slice(a, n)
            a += n


def give_back() -> None:
    """Return freed memory to the system: Python workers live on, and the next stage needs the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def giving_back(run: Callable) -> Callable:
    """A function on the rows of a group (or of two) that gives memory back at its end."""

    def one(*frames: object) -> object:
        try:
            return run(*frames)
        finally:
            give_back()

    def two(left: object, right: object) -> object:
        return one(left, right)

    return two if run.__code__.co_argcount == 2 else lambda frame: one(frame)


def sliced(run: Callable, rows: int = 1024) -> Callable:
    """A mapInArrow function that sees its batches in slices of so many rows, and gives memory back at its end."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, rows):
                yield b.slice(a, rows)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(slices(batches))
        finally:
            give_back()

    return whole
