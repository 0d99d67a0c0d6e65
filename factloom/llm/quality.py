"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover it whole. Learned filters run over each
chunk, each filter's largest answer in the chunk is kept (max-pooling), and a document's chunks are
combined into one probability from the largest, the mean and the smallest answer of every filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, sliced

CHUNK, OVERLAP = 512, 32
WIDTH, STRIDE, EMBED, FILTERS = 8, 2, 8, 24
#: The network is fitted on so many labelled rows at most, whose texts hold so many bytes together at most. A row
#: is taken with its whole text or not at all.
TRAIN_ROWS, TRAIN_BYTES = 4000, 24 << 20
STEPS = 300
#: Chunks that are worked on at once.
SLICE = 512


def chunks_of(data: bytes) -> np.ndarray:
    """(n, CHUNK) bytes, 0-padded; neighbours overlap by OVERLAP; an empty text is one chunk of zeros."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    buf = np.zeros((n - 1) * step + CHUNK, np.uint8)
    buf[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(buf, (n, CHUNK), (step, 1))


@dataclass
class Net:
    embed: np.ndarray  # (256, EMBED); byte 0 pads
    conv: np.ndarray  # (WIDTH * EMBED, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (3 * FILTERS,): of the largest, mean and smallest answers
    out_bias: float

    def _windows(self, x: np.ndarray) -> np.ndarray:
        e = self.embed[x]  # (n, CHUNK, EMBED)
        n, s = (CHUNK - WIDTH) // STRIDE + 1, e.strides
        return np.lib.stride_tricks.as_strided(e, (len(x), n, WIDTH * EMBED), (s[0], s[1] * STRIDE, s[2])), e

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """(chunks, FILTERS): each filter's largest answer, at least 0."""
        return np.maximum(self.best(x)[1] + self.bias, 0)

    def best(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chunks, FILTERS) each: the window of each filter's largest answer, and that answer before its bias."""
        top, out = np.empty((len(x), FILTERS), np.int64), np.empty((len(x), FILTERS), np.float32)
        for a in range(0, len(x), SLICE):
            w, _ = self._windows(x[a : a + SLICE])
            r = (w.reshape(-1, WIDTH * EMBED) @ self.conv).reshape(len(w), -1, FILTERS)
            top[a : a + SLICE], out[a : a + SLICE] = r.argmax(1), r.max(1)
        return top, out

    def combine(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probability for each document; starts: index of its first chunk."""
        n = np.diff(np.append(starts, len(pooled)))[:, None]
        f = np.hstack([np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / n, np.minimum.reduceat(pooled, starts)]).astype(np.float64)
        z = f @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: list[tuple[np.ndarray, int]], epochs: int = 9, batch: int = 48, rate: float = 6e-3, seed: int = 7) -> Net:
    """Adam on cross-entropy; rows: (chunks (k, CHUNK), label). The result depends on rows and seed alone.

    Few rows are gone over more often, for STEPS steps at least.

    No rows: a net that answers 0.5. One label only: its answers lean to that label.
    """
    rng = np.random.default_rng(seed)
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)),
        "conv": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)),
        "bias": np.zeros(FILTERS),
        "out": np.zeros(3 * FILTERS),
        "ob": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["embed"][0] = 0
    if rows:
        share = min(max(np.mean([y for _, y in rows]), 1e-3), 1 - 1e-3)
        p["ob"][0] = np.log(share / (1 - share))
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    epochs = max(epochs, -(-STEPS // max(1, -(-len(rows) // batch))))
    step, total = 0, epochs * -(-len(rows) // batch)
    for _ in range(epochs if rows else 0):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), batch):
            some = [rows[i] for i in order[a : a + batch]]
            size = np.array([len(x) for x, _ in some])
            starts = np.cumsum(size) - size
            x, y = np.concatenate([c for c, _ in some]), np.array([t for _, t in some], np.float32)
            net = Net(p["embed"], p["conv"], p["bias"], p["out"], float(p["ob"][0]))
            top, best = net.best(x)
            best += p["bias"]
            pool = np.maximum(best, 0)
            hi, mean, lo = np.maximum.reduceat(pool, starts), np.add.reduceat(pool, starts) / size[:, None], np.minimum.reduceat(pool, starts)
            z = np.hstack([hi, mean, lo]) @ p["out"] + p["ob"]
            dz = ((1 / (1 + np.exp(-z))) - y) / len(y)
            g = {"out": np.hstack([hi, mean, lo]).T @ dz + 1e-4 * p["out"], "ob": dz.sum(keepdims=True)}
            df = dz[:, None] * p["out"]
            doc = np.repeat(np.arange(len(some)), size)
            d = df[doc, :FILTERS] * (pool == hi[doc]) + df[doc, FILTERS : 2 * FILTERS] / size[doc][:, None]
            d += df[doc, 2 * FILTERS :] * (pool == lo[doc])
            d *= best > 0
            g["bias"] = d.sum(0)
            # Only the winning window of each (chunk, filter) has a gradient.
            g["conv"], de = np.empty_like(p["conv"]), np.zeros((256, EMBED))
            for k in range(FILTERS):
                c = np.flatnonzero(d[:, k])
                seen = x[c[:, None], top[c, k][:, None] * STRIDE + np.arange(WIDTH)]
                g["conv"][:, k] = d[c, k] @ p["embed"][seen].reshape(len(c), WIDTH * EMBED)
                # What each byte at each place of the window gets.
                at = np.bincount((seen + 256 * np.arange(WIDTH)).ravel(), np.repeat(d[c, k], WIDTH), 256 * WIDTH)
                de += at.reshape(WIDTH, 256).T @ p["conv"][:, k].reshape(WIDTH, EMBED)
            g["embed"] = de.astype(np.float32)
            g["embed"][0] = 0
            step += 1
            lr = rate * 0.5 * (1 + np.cos(np.pi * step / (total + 1)))
            for k_ in p:
                m[k_] = 0.9 * m[k_] + 0.1 * g[k_]
                v[k_] = 0.999 * v[k_] + 0.001 * g[k_] ** 2
                p[k_] -= lr * (m[k_] / (1 - 0.9**step)) / (np.sqrt(v[k_] / (1 - 0.999**step)) + 1e-7)
    return Net(p["embed"], p["conv"], p["bias"], p["out"], float(p["ob"][0]))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality") -> list[tuple[np.ndarray, int]]:
    """Labelled rows, first by a hash of their id, up to TRAIN_ROWS and TRAIN_BYTES, each with all chunks of its text.

    A row whose text doesn't fit in what is left of TRAIN_BYTES is passed over, and those after it are still looked at.

    Rows whose crc32(doc_id as text) mod 3 is 1 are held out; so are null ids and labels that aren't 0 or 1.
    Labels of one id that contradict each other: the largest counts. Of the texts of one id the largest counts.
    """
    marks = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = (
        marks.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
        .withColumn("nth", F.xxhash64("doc_id"))
    )
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    size = rows.groupBy("doc_id", "nth", "y").agg(F.max(F.octet_length("text")).alias("size")).toPandas().sort_values(["nth", "doc_id"])
    room, fits = TRAIN_BYTES, []
    for n in size["size"].tolist():
        fits.append(n <= room)
        room -= n if fits[-1] else 0
    size = size[np.array(fits, bool)]
    some = docs.sparkSession.createDataFrame(size[["doc_id", "y"]].astype("int64").values.tolist(), "doc_id long, y int")
    got = rows.drop("y").join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.max("text").alias("text")).toPandas()
    texts = sorted(zip(got["y"].tolist(), (t.encode("utf-8", "surrogatepass") for t in got["text"]), strict=True))
    return [(chunks_of(t), y) for y, t in texts]


def score_quality(docs: DataFrame, net: Net) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of docs; only the bytes of text decide.

    Null and empty texts get the score of an empty text. A null doc_id has null held_out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(b.column(1).to_pylist(), shared.value), pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sliced(run), "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, net: Net, least: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores `least` or more, with all their columns; map only."""
    shared, at = docs.sparkSession.sparkContext.broadcast(net), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(scores(b.column(at).to_pylist(), shared.value) >= least, pa.bool_()))

    return docs.mapInArrow(sliced(run), docs.schema)


def scores(texts: list[str | None], net: Net) -> np.ndarray:
    """Probability of quality for each text, a bounded number of chunks at a time."""
    out, held, n = [], [], 0

    def flush() -> None:
        pooled = net.pooled(np.concatenate(held))
        size = np.array([len(c) for c in held])
        out.append(net.combine(pooled, np.cumsum(size) - size))

    for t in texts:
        held.append(chunks_of((t or "").encode("utf-8", "surrogatepass")))
        n += len(held[-1])
        if n >= 2048:
            flush()
            held, n = [], 0
    if held:
        flush()
    return np.concatenate(out) if out else np.empty(0)


def quality_net(docs: DataFrame, labels: DataFrame) -> Net:
    return fit(training_rows(docs, labels))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_quality(docs, quality_net(docs, read(spark, sf_dir, "labels")))
