"""Language-model scoring by Katz backoff: Good-Turing discounted n-grams over words, exactly normalised.

The corpus is handled in chunks, runs of rows of a task that hold about as many words each.

1. A chunk sends its distinct words, as compressed blocks, to the part of the model that a hash names,
   and gets back each word's number and its count over all chunks.
2. A chunk sends its n-grams to the part that the last word of their history names. A part so holds every
   n-gram of a history, and of its shorter histories down to one word: it counts them, and backoff needs
   nothing from elsewhere. A word too frequent for one part is split over several by the word before it
   (histories of two words stay whole); its own counts are then partial sums, which go as compressed blocks to
   buckets of pairs, are added up there and come back in the order they were sent. Only n-grams of such words wait for
   that; what else a part holds is scored where it lies.
3. Each part scores its n-grams, recursively from the shortest history to the longest, and sends a chunk
   one sum for each text. An n-gram that is frequent in a chunk is asked for once, and its answer added to
   each text by the chunk, so a passage that many texts share doesn't fill a part.

P(w | h) = d(c) * c(h, w) / c(h) for an n-gram seen in training, else a(h) * P(w | shorter h), with
a(h) = (1 - sum of the former) / (1 - sum of P(w | shorter h) over the words seen after h);
P(w) = d(c) * c(w) / N for a known word, and the mass that is left for the one unknown word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SameSplits, by_bytes, cut, give_back, giving_back, mix, read, word_hashes

#: Longest n-gram; counts up to K are discounted.
ORDER, K = 3, 5
#: Words and texts of a chunk, about (a longer text is a chunk of its own), and n-grams of a part.
CHUNK_WORDS, PART_WORDS = 1_000_000, 1_250_000
#: An n-gram that a chunk holds more often is asked for once.
MANY = 8
UNKNOWN, END, START, FIRST = 0, 1, 2, 3
#: A task adds up the sums of its parts for a text until it holds so many.
HELD_SUMS = 1_000_000
#: Sums of log probabilities move as multiples of 1 / UNIT.
UNIT = 2.0**30
_NAMES = ["part", "chunk", "kind", "a", "b", "c", "d", "e", "f", "stats"]
_ROW = "part int, chunk long, kind int, a binary, b binary, c binary, d binary, e binary, f binary, stats array<long>"
WORD_ASK, WORD_GOT, STATS, TEXTS, GRAMS, META, TABLE, SPLIT_TABLE, PAIRS, SUMS = range(10)
#: A part's sums of a bucket's pairs; their counts over all parts (in the same order, with the part's histories), or the
#: facts of a history: its count, the P of words seen after it, the number of words seen 1 to K + 1 times after it.
_DEALT = "bucket int, part int, v binary, w binary, n binary, cw binary"
_FACTS = "part int, bucket int, n binary, own array<long>, v long, c long, low double, r array<long>"


def pack(x: np.ndarray) -> bytes:
    """Bytes of equal weight stand together, which leaves little of small numbers."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T if len(x) else np.empty((0, 0), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(b: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel() if len(raw) else np.empty(0, dtype)


def discounts(n: np.ndarray) -> np.ndarray:
    """d[r] for counts r = 1..K from n[r], the number of types of count r = 1..K+1; d[0] is 1.

    Where the Good-Turing ratio is no share between 0 and 1, as in tiny corpora, the absolute discount
    n1 / (n1 + 2 n2) stands in.
    """
    d = np.ones(K + 1)
    if n[1] <= 0:
        return d
    a = (K + 1) * n[K + 1] / n[1]
    flat = n[1] / (n[1] + 2 * n[2])
    for r in range(1, K + 1):
        x = ((r + 1) * n[r + 1] / (n[r] * r) - a) / (1 - a) if n[r] > 0 and a < 1 else 0
        d[r] = x if 0 < x < 1 else (r - flat) / r if r > flat else 0.5
    return d


@dataclass
class Words:
    """What all parts know of single words: N, V, documents (end tokens), discounts and the unknown mass."""

    total: int
    types: int
    ends: int
    d: np.ndarray
    unknown: float

    def p(self, count: np.ndarray) -> np.ndarray:
        """P of words by their count in training; 0 is the unknown word."""
        c = np.asarray(count, np.float64)
        d = np.where(c <= K, self.d[np.minimum(c, K).astype(int)], 1.0)
        return np.where(c > 0, d * c / max(self.total, 1) * (1.0 if self.exact else 1 - self.unknown), self.unknown)

    @property
    def exact(self) -> bool:
        return self.d[1:].min() < 1


def word_stats(total: int, types: int, ends: int, n: np.ndarray) -> Words:
    """n[c]: words of count c. What the discounts take away is left for the unknown word."""
    d = discounts(n)
    taken = float(sum((1 - d[r]) * r * n[r] for r in range(1, K + 1)))
    left = taken / total if total else 1.0
    if left <= 0:  # nothing is rare: one more unseen event
        return Words(total, types, ends, np.ones(K + 1), 1 / (total + 1))
    return Words(total, types, ends, d, left)


def _word_part(words: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the hash, so that sorted words are sorted by part."""
    return ((words >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def _runs(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) for the parts that occur in sorted part numbers."""
    edge = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else [0]
    return ((int(part[a]), a, z) for a, z in zip(edge, edge[1:], strict=False))


def _row(part: int, chunk: int, kind: int, *blobs: bytes, stats: np.ndarray | None = None) -> tuple:
    return (part, chunk, kind, *blobs, *([None] * (6 - len(blobs))), None if stats is None else stats.tolist())


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 6 + [pa.list_(pa.int64())]
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], _NAMES)


@dataclass
class Chunk:
    """Some texts: word hashes end to end, words of each text, state (0 learn, 1 held out, 2 no id), ids (0: null)."""

    number: int
    hashes: np.ndarray
    size: np.ndarray
    state: np.ndarray
    ids: np.ndarray


def _each_chunk(make: Callable[[Chunk], list[tuple]]) -> Callable:
    """A mapInArrow function over (doc_id, held_out, text) that calls make for each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal nth, n
            chunk = Chunk(task << 32 | nth, *(np.concatenate(c) for c in zip(*held, strict=True)))
            nth, n = nth + 1, 0
            held.clear()
            return _batch(make(chunk))

        try:
            for b in by_bytes(batches, 2):
                h, edge = word_hashes(b.column(2), lower=True)
                state = np.array([2 if x is None else int(x) for x in b.column(1).to_pylist()], np.uint8)
                held.append((h, np.diff(edge), state, b.column(0).fill_null(0).to_numpy()))
                n += len(h) + len(state)
                if n >= CHUNK_WORDS:
                    yield flush()
            if held:
                yield flush()
        finally:
            give_back()

    return run


def _ask_words(parts: int) -> Callable:
    def make(c: Chunk) -> list[tuple]:
        words, local = np.unique(c.hashes, return_inverse=True)
        counts = np.bincount(local[np.repeat(c.state == 0, c.size)], minlength=len(words))
        rows = [_row(p, c.number, WORD_ASK, pack(np.diff(words[a:z], prepend=np.uint64(0))), pack(counts[a:z])) for p, a, z in _runs(_word_part(words, parts))]
        return [*rows, _row(0, c.number, STATS, stats=np.array([(c.state == 0).sum()]))]

    return _each_chunk(make)


def _lay_out(c: Chunk) -> list[tuple]:
    """A chunk as one row: its words as ranks by frequency, words of each text, states, ids, and for each rank the
    place among the chunk's sorted words, as differences (equally frequent words are in order)."""
    _, local, n = np.unique(c.hashes, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(n), np.int32)
    rank[order] = np.arange(len(n))
    return [_row(0, c.number, TEXTS, pack(rank[local]), pack(c.size), pack(c.state), pack(c.ids), pack(np.diff(order, prepend=0).astype(np.int32)))]


def _merge_words(parts: int) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        rows, ask = [], pdf[pdf["kind"] == WORD_ASK].sort_values("chunk")
        if len(ask):
            own = [np.cumsum(unpack(b, np.uint64)) for b in ask["a"]]
            words, at = np.unique(np.concatenate(own), return_inverse=True)
            total = np.bincount(at, np.concatenate([unpack(b, np.int64) for b in ask["b"]]).astype(np.float64), len(words)).astype(np.int64)
            rank = np.empty(len(words), np.int64)
            rank[np.lexsort((words, -total))] = np.arange(len(words))
            ids = np.where(total > 0, FIRST + rank * parts + part, UNKNOWN)
            edge = np.cumsum([0, *map(len, own)])
            for c, a, z in zip(ask["chunk"], edge, edge[1:], strict=False):
                rows.append(_row(part, int(c), WORD_GOT, pack(ids[at[a:z]]), pack(total[at[a:z]])))
            n = np.bincount(np.minimum(total, K + 2), minlength=K + 3)
            rows.append(_row(part, -1, STATS, stats=np.array([total.sum(), (total > 0).sum(), 0, *n[1 : K + 2]], np.int64)))
        ends = sum(int(s[0]) for s in pdf.loc[pdf["kind"] == STATS, "stats"])
        if ends:
            n = np.zeros(K + 2, np.int64)
            if ends <= K + 1:
                n[ends] = 1
            rows.append(_row(part, -1, STATS, stats=np.array([ends, 1, ends, *n[1:]], np.int64)))
        return _frame(rows)

    return run


def _rising(x: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Differences to the value before, whole values where new."""
    return np.where(new, x, np.diff(x, prepend=0))


def _risen(d: np.ndarray, new: np.ndarray) -> np.ndarray:
    total = np.cumsum(d)
    at = np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))
    return total - (total - d)[at] if len(d) else d


def _pack_grams(history: list[np.ndarray], w: np.ndarray, cw: np.ndarray) -> list[bytes]:
    """n-grams in order of their history as (v, other history, words, [word numbers and counts])."""
    v = history[0]
    new = np.concatenate(([True], v[1:] != v[:-1]))[: len(v)]
    words, at, index = np.unique(w, return_index=True, return_inverse=True)
    rest = [_rising(history[1], new), *history[2:]] if len(history) > 1 else [np.empty(0, np.int64)]
    return [pack(np.diff(v, prepend=0)), pack(np.concatenate(rest)), pack(index.astype(np.int32)), pack(np.concatenate((np.diff(words, prepend=0), cw[at])))]


def _unpack_grams(a: bytes, b: bytes, c: bytes, d: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    v = np.cumsum(unpack(a, np.int64))
    new = np.concatenate(([True], v[1:] != v[:-1]))[: len(v)]
    rest = unpack(b, np.int64)
    rest = np.split(rest, len(rest) // len(v)) if len(rest) else []
    words, cw = np.split(unpack(d, np.int64), 2)
    index = unpack(c, np.int32)
    if rest:
        rest[0] = _risen(rest[0], new)
    return [v, *rest], np.cumsum(words)[index], cw[index]


def _send_grams(parts: int, words: Words, order: int, part_words: int) -> Callable:
    """A chunk's n-grams to the parts; what it can tell of its texts by itself goes along as META."""

    def run(docs: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return _frame([])
        r = docs.iloc[0]
        local, size, state, ids, place = (unpack(r[c], t) for c, t in zip("abcde", (np.int32, np.int64, np.uint8, np.int64, np.int32), strict=True))
        local = np.cumsum(place)[local]
        got, none = info.sort_values("part"), np.empty(0, np.int64)
        known = np.concatenate([none, *(unpack(b, np.int64) for b in got["a"]), [END, START]])
        count = np.concatenate([none, *(unpack(b, np.int64) for b in got["b"]), [words.ends, words.ends]])
        # Every text as a row of local numbers: order - 1 starts, the words, the end.
        v, pad = len(known) - 2, order - 1
        begin = np.cumsum(size + pad + 1) - size - pad - 1
        seq = np.full(int((size + pad + 1).sum()), v, np.int64)
        front = (begin[:, None] + np.arange(pad)).ravel()
        seq[front] = v + 1
        token = np.ones(len(seq), bool)
        token[front] = False
        inner = token.copy()
        inner[begin + size + pad] = False
        seq[inner] = local
        at = np.flatnonzero(token)
        doc = np.repeat(np.arange(len(size)), size + 1)
        own = count[seq[at]]
        first = np.cumsum(size + 1) - size - 1
        base = np.add.reduceat(np.log10((own + 0.1) / (words.total + 0.1 * (words.types + 1))), first)
        n_known = np.add.reduceat((own > 0).astype(np.int64), first)
        # After an unknown word only the word's own probability is left.
        alone = count[seq[at - 1]] == 0
        score = np.bincount(doc[alone], np.log10(words.p(own[alone])), len(size))
        at, doc = at[~alone], doc[~alone]
        history = [known[seq[at - 1 - k]] for k in range(pad)]
        w, cw, cv = known[seq[at]], count[seq[at]], count[seq[at - 1]]
        n = (state == 0)[doc].astype(np.int64)
        split = cv > part_words
        pieces = np.where(split, -(-cv // part_words), 1).astype(np.uint64)
        other = mix((history[1] if pad > 1 else w).astype(np.uint64)) % pieces
        part = (mix(history[0].astype(np.uint64) + mix(other) * split) % np.uint64(parts)).astype(np.int64)
        order_ = np.lexsort((doc, w, *reversed(history), part))
        history, w, cw, doc, n, split, part = [h[order_] for h in history], *(x[order_] for x in (w, cw, doc, n, split, part))
        change = np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in (*history, w)])))[: len(w)]
        gram = np.cumsum(change) - 1
        often = np.bincount(gram, minlength=0) if len(gram) else none
        many = often > MANY
        slot = np.cumsum(many) - 1
        hot = many[gram] if len(gram) else np.empty(0, bool)
        hot_doc, hot_slot = doc[hot], slot[gram[hot]] if len(gram) else none
        keep = ~hot | change
        total = np.bincount(gram, n).astype(np.int64) if len(gram) else none
        n = np.where(hot, total[gram], n)[keep] if len(gram) else none
        doc = np.where(hot, len(size) + slot[gram], doc)[keep] if len(gram) else none
        history, w, cw, split, part = [h[keep] for h in history], w[keep], cw[keep], split[keep], part[keep]
        rows, chunk = [], int(r["chunk"])
        for p, a, z in _runs(part):
            rest = np.concatenate((doc[a:z].astype(np.int32), n[a:z].astype(np.int32), split[a:z].astype(np.int32)))
            rows.append(_row(p, chunk, GRAMS, *_pack_grams([h[a:z] for h in history], w[a:z], cw[a:z]), pack(rest)))
        meta = [pack(ids), pack(np.concatenate((state.astype(np.int64), size, n_known))), pack(base), pack(score), pack(hot_doc.astype(np.int32)), pack(hot_slot.astype(np.int32))]
        return _frame([*rows, _row(chunk % parts, chunk, META, *meta)])

    return run


def _levels(history: list[np.ndarray], w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n-grams sorted by history, per length 2, 3, ...: (history number, pair number, first n-gram of each pair)."""
    words, wi = np.unique(w, return_inverse=True)
    new = np.zeros(len(w), bool)
    new[:1] = True
    out = []
    for h in history:
        new[1:] |= h[1:] != h[:-1]
        g = np.cumsum(new) - 1
        _, first, pair = np.unique(g * len(words) + wi, return_index=True, return_inverse=True)
        out.append((g, pair, first))
    return out


def _merge_grams(order: int) -> Callable:
    """One part: its n-grams with their counts and who asks for them, as one row, and one more for n-grams of split
    words; META goes through."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        through = [tuple(x) for x in pdf[pdf["kind"] == META][_NAMES].itertuples(index=False)]
        pdf = pdf[pdf["kind"] == GRAMS].sort_values("chunk")
        if not len(pdf):
            return _frame(through)
        blocks = [_unpack_grams(*(r[c] for c in "abcd")) for _, r in pdf.iterrows()]
        history = [np.concatenate([b[0][k] for b in blocks]) for k in range(order - 1)]
        w, cw = (np.concatenate([b[i] for b in blocks]) for i in (1, 2))
        held = [len(b[1]) for b in blocks]
        del blocks
        rest = [np.split(unpack(b, np.int32), 3) for b in pdf["e"]]
        doc, n = (np.concatenate([x[i] for x in rest]) for i in range(2))
        split = np.concatenate([x[2].astype(bool) for x in rest])
        del rest
        chunk = np.repeat(np.arange(len(pdf), dtype=np.int32), held)
        o = np.lexsort((w, *reversed(history)))
        # One column after another, so that old and new ones don't stand side by side.
        for k in range(order - 1):
            history[k] = history[k][o]
        w = w[o]
        cw = cw[o]
        doc = doc[o]
        n = n[o]
        split = split[o]
        chunk = chunk[o]
        del o
        new = np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in (*history, w)])))
        first = np.flatnonzero(new)
        asked = np.diff(np.append(first, len(w)))
        c = np.add.reduceat(n.astype(np.int64), first)
        history, w, cw, split = [h[first] for h in history], w[first], cw[first], split[first]
        stats, rows = [0], []
        for k, (_, pair, at) in enumerate(_levels(history, w)):
            total = np.bincount(pair, c).astype(np.int64)
            if k == 0 and split.any():  # what is split is counted when its sums are known
                s = split[at]
                rows.append(_row(part, -1, PAIRS, pack(history[0][at[s]]), pack(w[at[s]]), pack(total[s]), pack(cw[at[s]])))
                stats[0], total = int(s.sum()), total[~s]
            stats += np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2].tolist()
        chunks = pdf["chunk"].to_numpy(np.int64)
        for kind, own in ((TABLE, ~split), (SPLIT_TABLE, split)):
            if own.any():
                by = np.repeat(own, asked)
                who = pack(np.concatenate((chunk[by], doc[by], chunks.view(np.int32))))
                rows.append(_row(part, len(pdf), kind, *_pack_grams([h[own] for h in history], w[own], cw[own]), pack(np.concatenate((asked[own], c[own]))), who))
        return _frame([*through, *rows, _row(part, -1, STATS, stats=np.array(stats, np.int64))])

    return run


def history_weights(total: np.ndarray, low: np.ndarray, rare: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale of seen pairs, backoff weight) of histories; total: c(h), low: sum of P over words seen
    after h, rare[:, r - 1]: number of words seen r times after h.

    Where no seen pair is discounted, one more unseen event is assumed. A history never seen backs off
    whole. Both make the sum over all words exactly 1.
    """
    r = np.arange(1, K + 1)
    left = (rare * ((1 - d[1:]) * r)).sum(1)
    bare = (total > 0) & (left <= 1e-9)
    scale = np.where(bare, 1 / (total + 1.0), 1 / np.maximum(total, 1))
    mass = np.where(total > 0, np.where(bare, 1.0, left) * scale, 1.0)
    return scale, mass / np.maximum(1 - low, 1e-300)


def _bucket(v: np.ndarray, w: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(v.astype(np.uint64) + mix(w.astype(np.uint64))) % np.uint64(buckets)).astype(np.int64)


def _deal_pairs(buckets: int) -> Callable:
    """A part's sums of the pairs of split words, by bucket; they stay in order of history and word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, *blobs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                v, w, n, cw = (unpack(x, np.int64) for x in blobs)
                of = _bucket(v, w, buckets)
                order = np.argsort(of, kind="stable")
                v, w, n, cw = (x[order] for x in (v, w, n, cw))
                rows = [(k, part, pack(np.diff(v[i:j], prepend=0)), pack(np.diff(w[i:j], prepend=0)), pack(n[i:j]), pack(cw[i:j])) for k, i, j in _runs(of[order])]
                cols = zip((pa.int32(), pa.int32(), *[pa.binary()] * 4), zip(*rows, strict=True), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in cols], ["bucket", "part", "v", "w", "n", "cw"])

    return run


def _merge_pairs(words: Words) -> Callable:
    """One bucket: each pair's count over all parts, to every part that holds it, and what it adds to its history's facts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        vs, ws = ([np.cumsum(unpack(b, np.int64)) for b in pdf[c]] for c in "vw")
        edge = np.cumsum([0, *map(len, vs)])
        v, w = np.concatenate(vs), np.concatenate(ws)
        n, cw = (np.concatenate([unpack(b, np.int64) for b in pdf[c]]) for c in ("n", "cw"))
        order = np.lexsort((w, v))
        new = np.concatenate(([True], (np.diff(v[order]) != 0) | (np.diff(w[order]) != 0)))
        first = np.flatnonzero(new)
        count = np.add.reduceat(n[order], first)
        every = np.empty(len(v), np.int64)
        every[order] = count[np.cumsum(new) - 1]
        bucket = int(pdf["bucket"].iloc[0])
        rows = [(int(p), bucket, pack(every[i:j]), np.unique(o), None, None, None, None) for p, o, i, j in zip(pdf["part"], vs, edge, edge[1:], strict=False)]
        v, cw, count = (x[count > 0] for x in (v[order][first], cw[order][first], count))
        at = np.flatnonzero(np.diff(v, prepend=-1))
        if len(at):
            rare = np.stack([np.add.reduceat((count == t).astype(np.int64), at) for t in range(1, K + 2)], 1)
            facts = zip(v[at].tolist(), np.add.reduceat(count, at).tolist(), np.add.reduceat(words.p(cw), at).tolist(), rare.tolist(), strict=True)
            rows += [(None, bucket, None, None, *x) for x in facts]
        out = pd.DataFrame(rows, columns=["part", "bucket", "n", "own", "v", "c", "low", "r"])
        return out.astype({"part": "Int32", "v": "Int64", "c": "Int64"})

    return run


def _score_table(r: dict, words: Words, d: list[np.ndarray], facts: pd.DataFrame | None, buckets: int = 1) -> list[np.ndarray]:
    """A part's sums for the texts of each chunk, as (chunk, text, sum): the probabilities of its n-grams, from short to
    long. facts: with a table of split words, their counts over all parts."""
    history, w, cw = _unpack_grams(*(r[c] for c in "abcd"))
    asked, c = np.split(unpack(r["e"], np.int64), 2)
    who, n_chunks = unpack(r["f"], np.int32), int(r["chunk"])
    chunks = who[len(who) - 2 * n_chunks :].view(np.int64)
    chunk, doc = np.split(who[: len(who) - 2 * n_chunks], 2)
    p = words.p(cw)
    for k, (g, pair, at) in enumerate(_levels(history, w)):
        count = np.bincount(pair, c).astype(np.int64)
        hist, low = g[at], p[at]
        n = int(hist[-1]) + 1
        seen = count > 0
        total = np.bincount(hist, count, n).astype(np.int64)
        under = np.bincount(hist[seen], low[seen], n)
        rare = np.zeros((n, K), np.int64)
        for t in range(1, K + 1):
            rare[:, t - 1] = np.bincount(hist[count == t], minlength=n)
        if k == 0 and facts is not None:
            # Pairs are in order of history and word here as where they were dealt.
            of = _bucket(history[0][at], w[at], buckets)
            for _, f in facts[facts["v"].isna()].iterrows():
                count[of == f["bucket"]] = unpack(f["n"], np.int64)
            whole = facts[facts["v"].notna()].sort_values("v")
            own = np.flatnonzero(np.isin(np.unique(history[0]), whole["v"].to_numpy(np.int64)))
            total[own], under[own] = whole["c"].to_numpy(np.int64), whole["low"].to_numpy(np.float64)
            rare[own] = np.array(whole["r"].tolist(), np.int64).reshape(-1, K + 1)[:, :K]
        scale, back = history_weights(total, under, rare, d[k])
        own = np.where(count <= K, d[k][np.minimum(count, K)], 1.0) * count * scale[hist]
        p = np.where(count > 0, own, back[hist] * low)[pair]
    del history, w, cw, c
    return _added(chunks[chunk], doc, np.repeat(np.log10(p), asked), lambda x: np.rint(x * UNIT).astype(np.int64))


def _added(chunk: np.ndarray, doc: np.ndarray, x: np.ndarray, of: Callable = lambda x: x) -> list[np.ndarray]:
    """x added up by chunk and text, in their order."""
    o = np.lexsort((doc, chunk))
    x = x[o]
    chunk = chunk[o]
    doc = doc[o]
    del o
    first = np.flatnonzero(np.concatenate(([True], (chunk[1:] != chunk[:-1]) | (doc[1:] != doc[:-1]))))
    return [chunk[first], doc[first], of(np.add.reduceat(x, first))]


def _sum_rows(held: list[list[np.ndarray]]) -> list[tuple]:
    """The sums of several tables as a row for each chunk; empties held."""
    chunk, doc, sums = _added(*(np.concatenate(x) for x in zip(*held, strict=True)))
    held.clear()
    edge = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
    return [_row(0, int(chunk[a]), SUMS, pack(doc[a:z]), pack(sums[a:z])) for a, z in zip(edge, edge[1:], strict=False)]


def _answer(words: Words, d: list[np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for b in batches:
            for i in range(b.num_rows):
                held.append(_score_table(b.slice(i, 1).to_pylist()[0], words, d, None))
                give_back()
                if sum(len(x[1]) for x in held) >= HELD_SUMS:
                    yield _batch(_sum_rows(held))
        if held:
            yield _batch(_sum_rows(held))

    return run


def _answer_split(words: Words, d: list[np.ndarray], buckets: int) -> Callable:
    def run(table: pd.DataFrame, facts: pd.DataFrame) -> pd.DataFrame:
        return _frame(_sum_rows([_score_table(r, words, d, facts, buckets) for _, r in table.iterrows()]) if len(table) else [])

    return run


_OUT = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]


def _finish(pdf: pd.DataFrame) -> pd.DataFrame:
    meta = pdf[pdf["kind"] == META].iloc[0]
    ids = unpack(meta["a"], np.int64)
    state, size, n_known = np.split(unpack(meta["b"], np.int64), 3)
    base, score = (unpack(meta[c], np.float64) for c in "cd")
    hot_doc, hot_slot = (unpack(meta[c], np.int32) for c in "ef")
    total = np.zeros(len(ids) + (int(hot_slot.max()) + 1 if len(hot_slot) else 0), np.int64)
    for _, r in pdf[pdf["kind"] == SUMS].sort_values("part").iterrows():
        total[unpack(r["a"], np.int32)] += unpack(r["b"], np.int64)
    total = total / UNIT
    score = score + total[: len(ids)]
    np.add.at(score, hot_doc, total[len(ids) + hot_slot])
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if t == 2 else i for t, i in zip(state, ids.tolist(), strict=True)], "Int64"),
            "held_out": pd.array([None if t == 2 else bool(t) for t in state], "boolean"),
            "n_tokens": size + 1,
            "n_known": n_known,
            "base_score": base,
            "score": score,
        },
        columns=_OUT,
    )


def _sums(rows: DataFrame, width: int) -> np.ndarray:
    """Sums of the stats arrays of rows, added up by Spark."""
    got = rows.where(f"kind = {STATS}").select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(width, np.int64)
    for r in got:
        out[r["i"]] = r["x"]
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0


def katz_scores(docs: DataFrame, stored: bool = False, order: int = ORDER, part_words: int = PART_WORDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row.

    docs: any DataFrame with doc_id and text. Two passes must see the same rows in the same places, as a
    chunk's answers are paired with its rows; so docs is written once to the shared folder, unless stored
    says that it is a plain read of files, whose splits are then kept the same.

    Null and empty texts are one end token. A null doc_id has null held_out and teaches nothing. Repeated
    rows count and score again. A text longer than a chunk is a chunk of its own. No training rows: every
    token is the one unknown word of probability 1 (score 0). Other columns are left out.
    """
    if order < 2:
        raise ValueError("order: 2 or more")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    docs, splits = docs if stored else cut(docs), SameSplits(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / 6 / part_words))
    with splits:
        got = cut(docs.mapInArrow(_ask_words(parts), _ROW).groupBy("part").applyInPandas(giving_back(_merge_words(parts)), _ROW))
    sums = _sums(got, K + 4)
    words = word_stats(int(sums[0]), int(sums[1]), int(sums[2]), np.concatenate(([0], sums[3:])))
    chunks = docs.mapInArrow(_each_chunk(_lay_out), _ROW).groupBy("chunk").cogroup(got.where(f"kind = {WORD_GOT}").groupBy("chunk"))
    sent = chunks.applyInPandas(giving_back(_send_grams(parts, words, order, part_words)), _ROW)
    with splits:
        table = cut(sent.groupBy("part").applyInPandas(giving_back(_merge_grams(order)), _ROW))
    sums = _sums(table, 1 + (order - 1) * (K + 1))
    rare = sums[1:].reshape(order - 1, K + 1)
    out = table.where(f"kind = {META}")
    if sums[0]:
        # Words that are split over parts: their pairs are added up, and each part gets back those it holds.
        buckets = math.ceil(sums[0] / part_words)
        dealt = table.where(f"kind = {PAIRS}").select("part", "a", "b", "c", "d").mapInArrow(_deal_pairs(buckets), _DEALT)
        facts = cut(dealt.groupBy("bucket").applyInPandas(giving_back(_merge_pairs(words)), _FACTS))
        each = F.array(*(F.sum(F.get("r", F.lit(t))) for t in range(K + 1))).alias("r")
        whole = cut(facts.where("v is not null").groupBy("v").agg(F.sum("c").alias("c"), F.sum("low").alias("low"), each))
        for r in whole.select(F.posexplode("r").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect():
            rare[0, r["i"]] += r["x"]
        held = facts.where("v is null").select("part", F.explode("own").alias("v")).distinct().join(whole, "v")
        facts = facts.where("v is null").drop("own").unionByName(held, allowMissingColumns=True)
    d = [discounts(np.concatenate(([0], n))) for n in rare]
    out = out.unionByName(table.where(f"kind = {TABLE}").mapInArrow(_answer(words, d), _ROW))
    if sums[0]:
        both = table.where(f"kind = {SPLIT_TABLE}").groupBy("part").cogroup(facts.groupBy("part"))
        out = out.unionByName(both.applyInPandas(_answer_split(words, d, buckets), _ROW))
    scored = out.groupBy("chunk").applyInPandas(_finish, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(read(spark, sf_dir, "documents"), stored=True)
