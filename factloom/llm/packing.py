"""Best-fit packing of token pieces with Martello-Toth dominance reduction.

Only the number of pieces of each length matters for a packing, so the instance is a table of at most
`capacity` counts, whatever the corpus. The reduction and the best-fit run on that table, many equal
bins at a time; Spark then deals every piece to its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, sliced
from .tokens import encoder

Bins = list[tuple[int, list[tuple[int, int]]]]  # (how many equal bins, [(length, copies in each)])


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32); the first piece of a cut document may be shorter.

    A null or empty text is one piece, the end id. Repeated rows give their pieces again. A very long text
    gives as many pieces as it needs; a batch's texts are encoded a few megabytes at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            keys = b.column(0).to_pylist()
            for at, ids, edge in enc.encode(b.column(1)):
                rows = []
                for k in range(len(edge) - 1):
                    own = np.append(ids[edge[k] : edge[k + 1]], np.uint32(end_id)).astype("<u4")
                    n = -(-len(own) // capacity)
                    cuts = [0] + [len(own) - capacity * j for j in range(n - 1, -1, -1)]
                    rows += [(keys[at + k], p, a, z - a, zlib.crc32(own[a:z])) for p, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                        ["doc_id", "piece", "start", "length", "ids_crc32"],
                    )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sliced(run, 4096), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def reduce_dominated(count: dict[int, int], capacity: int) -> Bins:
    """Fix bins that dominate every alternative, taking their items out of count.

    For the longest open item j: alone, if nothing fits beside it; with the longest k that fits, if
    k fills the bin, if no two items fit beside j, or if no three fit and no two that fit outweigh k
    (they could then stand in k's place). An item for which none holds stays for best-fit.
    """
    fixed: Bins = []
    open_ = sorted(count)
    kept: set[int] = set()
    while True:
        open_ = [x for x in open_ if count.get(x)]
        j = next((x for x in reversed(open_) if x not in kept), None)
        if j is None:
            return fixed
        room = capacity - j
        # The three shortest items beside one j, with their multiplicity.
        short: list[int] = []
        for x in open_:
            short += [x] * min(3 - len(short), count[x] - (x == j))
            if len(short) >= 3:
                break
        if not short or short[0] > room:
            fixed.append((count.pop(j), [(j, 1)]))
            continue
        at = bisect.bisect_right(open_, room) - 1
        while at >= 0 and open_[at] == j and count[j] < 2:
            at -= 1
        k = open_[at]
        sure = k == room or len(short) < 2 or short[0] + short[1] > room
        if not sure and (len(short) < 3 or sum(short) > room):
            best = 0
            for a in open_:
                z = bisect.bisect_right(open_, min(room - a, a)) - 1
                if z >= 0:
                    best = max(best, a + open_[z])
            sure = best <= k
        if not sure:
            kept.add(j)
            continue
        n = count[j] // 2 if k == j else min(count[j], count[k])
        fixed.append((n, [(j, 2)] if k == j else [(j, 1), (k, 1)]))
        for x, m in ((j, n), (k, n)):
            count[x] -= m
            if not count[x]:
                del count[x]


def best_fit(count: dict[int, int], capacity: int) -> Bins:
    """Best-fit decreasing over counts; bins of equal content are one entry, split when it must be."""
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # by room left
    rooms: list[int] = []

    def put(room: int, n: int, content: list[tuple[int, int]]) -> None:
        if n:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((n, content))

    for x in sorted(count, reverse=True):
        c = count[x]
        while c:
            at = bisect.bisect_left(rooms, x)
            if at == len(rooms):
                each = capacity // x
                put(capacity - each * x, c // each, [(x, each)])
                if c % each:
                    put(capacity - c % each * x, 1, [(x, c % each)])
                break
            room = rooms[at]
            n, content = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            each = room // x
            full = min(n, c // each)
            if full:
                put(room - each * x, full, [*content, (x, each)])
                c -= full * each
                put(room, n - full, content)
            else:
                put(room - c * x, 1, [*content, (x, c)])
                put(room, n - 1, content)
                c = 0
    return [g for room in rooms for g in groups[room]]


def place(count: dict[int, int], capacity: int) -> tuple[dict[int, np.ndarray], int]:
    """Per length: rows (first rank, copies, offset, first sequence), by first rank; and all sequences."""
    left = dict(count)
    bins = reduce_dominated(left, capacity)
    bins += best_fit(left, capacity)
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for n, content in bins:
        offset = 0
        for x, each in content:
            slots.setdefault(x, []).append((rank.get(x, 0), each, offset, sequence))
            rank[x] = rank.get(x, 0) + n * each
            offset += x * each
        sequence += n
    if rank != {x: c for x, c in count.items() if c}:
        raise AssertionError("packing lost items")
    return {x: np.array(s, np.int64) for x, s in slots.items()}, sequence


def pack(pieces: DataFrame, capacity: int, group: int = 100_000) -> DataFrame:
    """pieces with sequence_id and offset added. Needs columns length (1..capacity), doc_id and piece.

    Ranks are counted within (length, a hash of the row) and then shifted; there are so many hash parts
    that even a length that all pieces share is dealt over groups of about `group` rows. Equal rows take
    any order among them. pieces is read three times and should be stored.
    """
    parts = max(1, math.ceil(pieces.count() / group))
    parts_of = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(parts)).cast("int")
    rows = pieces.withColumn("part", parts_of)
    counts = cut(rows.groupBy("length", "part").agg(F.count("*").alias("n")))
    total = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(x > capacity or x < 1 for x in total):
        raise ValueError("a piece is longer than a sequence, or empty")
    slots, _ = place(total, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(slots)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        rows.withColumn("rank", F.row_number().over(inside) - 1)
        .join(base, ["length", "part"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            seq, off = np.empty_like(rank), np.empty_like(rank)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                s = table[int(x)]
                hit = s[np.searchsorted(s[:, 0], rank[own], "right") - 1]
                inner = rank[own] - hit[:, 0]
                seq[own] = hit[:, 3] + inner // hit[:, 1]
                off[own] = hit[:, 2] + inner % hit[:, 1] * x
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)], [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(
        settle, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Tokenize once (the pieces are written to the shared folder), then pack. No rows: no rows."""
    return pack(cut(pieces_of(docs, vocabulary, end_id, capacity)), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
