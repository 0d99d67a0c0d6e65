"""Periodic runs of words by a dictionary of basic factors, and texts with the repeats taken out."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, flat_bytes, give_back, read, word_spans

#: A run has at least so many words, and so many times its period.
LEAST, TIMES = 6, 4
RUNS = "array<struct<start: long, length: long, period: long>>"


def word_codes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only: the words' bytes, put end to end, are dictionary-coded."""
    size = end - begin
    edge = np.concatenate(([0], np.cumsum(size)))
    where = np.repeat(begin - edge[:-1], size) + np.arange(edge[-1])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(data[where])])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _names(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each different key, steps from each place to the next one in order that has its key, 0 if there is none)."""
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    name = np.empty(len(key), np.int64)
    name[order] = np.concatenate(([0], np.cumsum(~same))) if len(key) else 0
    after = np.zeros(len(key), np.int64)
    after[order[:-1][same]] = order[1:][same]
    return name, after


def runs(codes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, ordered; text i has the words from of[i] to of[i + 1], starts count within it.

    A basic factor is the 2**k words from some place on, named by the names of its halves. A factor at least as long as a
    run's period q holds a whole turn of it, and as a turn of smallest period is equal to none of its own rotations, the factor's
    next occurrence in the run is exactly q further. So at the level with 2**(k-1) < q <= 2**k the places of a run, as long as
    factor and successor lie within, have the same step q to their successors: an arithmetic progression of occurrences for each
    place of a turn. Each longest stretch of equal steps, extended by the step and the factor, is a candidate, and no neighbour
    carries it on: there the factors would differ. No shorter period holds in it, or the step would be shorter. Each run has
    one level, and there one stretch, so nothing is found twice; what is too short goes.

    Only places whose factor is repeated at all within the reach of later levels are kept from level to level.
    """
    n = len(codes)
    text = np.repeat(np.arange(len(of) - 1), np.diff(of))
    last = of[1:][text] if n else of[:0]
    place, found, width = np.arange(n), [], 1
    name = codes
    while len(place):
        # Factors of one text only, and names as long as there are places, so that a pair of them fits 64 bits.
        inside = place + width <= last[place]
        place, name = place[inside], name[inside]
        ids, after = _names(text[place] * (int(name.max(initial=0)) + 1) + name)
        step = np.where(after > 0, place[after] - place, 0)
        near = (step > width // 2) & (step <= width)
        at = np.flatnonzero(near)
        if len(at):
            head = np.concatenate(([True], (np.diff(place[at]) != 1) | (np.diff(step[at]) != 0)))
            first, count = np.flatnonzero(head), np.diff(np.append(np.flatnonzero(head), len(at)))
            start, q = place[at[first]], step[at[first]]
            length = count + q + width - 1
            long = length >= np.maximum(LEAST, TIMES * q)
            found.append(np.stack([text[start], start - of[text[start]], length, q], 1)[long])
        # A later level's period exceeds width; its places are repeated here too, as are those right after them.
        again = after > 0
        again[after[again]] = True
        where = np.full(n, -1)
        where[place] = np.where(again, ids, -1)
        left = place[again]
        left = left[left + width < n]
        both = where[left + width] >= 0
        left = left[both]
        key = where[left] * (int(ids.max(initial=0)) + 1) + where[left + width]
        name, place, width = _names(key)[0], left, 2 * width
    out = np.concatenate(found) if found else np.empty((0, 4), np.int64)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words that no run (rows start, length, period) holds after its first turn."""
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, found[:, 0] + found[:, 2], 1)
    np.add.at(mark, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, text), one row per row of docs(doc_id, text).

    Words are the maximal runs of anything but 0x20 and 0x09-0x0D. runs holds (start, length, period) of every stretch of
    words that has its smallest period at least four times, and six words at least, ordered by start, then period; text is
    the words joined by one space without those that a run only repeats. A null, empty or blank text has no words, no runs and
    the text ''. Repeated rows stay repeated, an empty table gives none, other columns are left out. Whole texts, map
    only; a text of over 4 MB is looked at alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 1):
            data, edge = flat_bytes(b.column(1))
            begin, end, of = word_spans(data, edge)
            found = runs(word_codes(data, begin, end), of)
            each = np.searchsorted(found[:, 0], np.arange(b.num_rows + 1))
            texts = []
            for i, t in enumerate(pa.array(b.column(1)).cast(pa.binary()).to_pylist()):
                words = t.split() if t else []
                own = found[each[i] : each[i + 1], 1:]
                texts.append(b" ".join(collapsed(words, own) if len(own) else words))
            spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(found[:, c])) for c in (1, 2, 3)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(each, pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(of)), lists, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "text"])
        give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, text string")


def planted(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) where a tenth of the texts, told by the crc32 of their id, are made periodic from some word on.

    Rows without an id are left as they are.
    """

    def turned(i: int, text: bytes) -> bytes:
        h = zlib.crc32(b"%d" % i)
        words, g = text.split(), h // 10
        n = len(words)
        if h % 10 or not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 1):
            rows = zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True)
            texts = [t if i is None or t is None else turned(i, t) for i, t in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(read(spark, sf_dir, "documents")))
    # Exact: a/p > b/q as a*q > b*p; equal ones stay in their order, by start and then period.
    best = F.aggregate(
        "runs",
        F.expr("cast(null as struct<start: long, length: long, period: long>)"),
        lambda top, r: F.when(top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
