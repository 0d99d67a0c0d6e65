"""A compressed FM-index over word ids: wavelet matrix of packed bits, backward search for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first `depth` symbols, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k, order = 1, np.argsort(rank, kind="stable")
    while k < depth:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        if n and rank[order[-1]] == n - 1:
            break
        k *= 2
    return order


class Bits:
    """Packed bits with a running count before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        own = np.packbits(bits.astype(np.uint8), bitorder="little")
        packed[: len(own)] = own
        self.words = packed.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1])).astype(np.uint32)
        self.zeros = n - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Number of set bits in front of position i."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & low)


class LeastInRange:
    """Smallest value in [lo, hi): minima inside blocks of 8, and a sparse table over the blocks."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        pad = np.full(-(-max(n, 1) // 8) * 8, np.iinfo(np.int32).max, np.int32)
        pad[:n] = values
        b = pad.reshape(-1, 8)
        self.values = pad
        self.head = np.minimum.accumulate(b, 1).ravel()
        self.tail = np.minimum.accumulate(b[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [b.min(1)]
        while 2 << (len(self.table) - 1) <= len(b):
            t, k = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(t[: len(t) - k], t[k:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        last = hi - 1
        a, z = lo >> 3, last >> 3
        out = np.minimum(self.tail[lo], self.head[last])
        same = np.flatnonzero(a == z)
        if len(same):
            at = (a[same] * 8)[:, None] + np.arange(8)
            v = np.where((at >= lo[same, None]) & (at < hi[same, None]), self.values[at], np.iinfo(np.int32).max)
            out[same] = v.min(1)
        far = np.flatnonzero(z - a > 1)
        if len(far):
            x, n = a[far] + 1, z[far] - a[far] - 1
            level = np.frexp(n.astype(np.float64))[1] - 1
            for k in np.unique(level):
                own = level == k
                t, f = self.table[k], far[own]
                out[f] = np.minimum(out[f], np.minimum(t[x[own]], t[x[own] + n[own] - (1 << int(k))]))
        return out


class FMIndex:
    """Over texts of word ids (1 and up), each of which belongs to a numbered owner."""

    def __init__(self, texts: list[np.ndarray], owner: np.ndarray, depth: int):
        size = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(size + 1) - size - 1
        flat = np.zeros(int((size + 1).sum()), np.int64)
        keep = np.ones(len(flat), bool)
        keep[self.first + size] = False
        flat[keep] = np.concatenate(texts)
        self.symbols, flat = np.unique(flat, return_inverse=True)
        self.text = flat.astype(np.int64)
        order = suffix_array(self.text, depth)
        bwt = self.text[order - 1]
        counts = np.bincount(self.text, minlength=len(self.symbols))
        self.start = np.cumsum(counts) - counts
        self.levels: list[Bits] = []
        cur = bwt
        for bit in range(max(1, int(len(self.symbols) - 1).bit_length()) - 1, -1, -1):
            b = (cur >> bit) & 1
            self.levels.append(Bits(b))
            cur = np.concatenate((cur[b == 0], cur[b == 1]))
        symbol = np.arange(len(self.symbols))
        self.base = self.start - self._down(symbol, np.zeros(len(symbol), np.int64))
        self.owner = LeastInRange(np.repeat(owner, size + 1)[order].astype(np.int32))
        self.n = len(flat)

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Position i of the transform, followed through the wavelet matrix along the bits of c."""
        top = len(self.levels) - 1
        for k, bits in enumerate(self.levels):
            one = bits.ones(i)
            i = np.where((c >> (top - k)) & 1, bits.zeros + one, i - one)
        return i

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the interval of c followed by what [lo, hi) stands for."""
        both = self._down(np.concatenate((c, c)), np.concatenate((lo, hi)))
        shift = self.base[c]
        return both[: len(c)] + shift, both[len(c) :] + shift

    def leftward(self, end: np.ndarray, stop: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """For patterns that end before position `end` of the text: the leftmost start, not under `stop`,
        from which the pattern also occurs in a text of a smaller owner (matching statistics)."""
        at = end.copy()
        active = np.flatnonzero(at > stop)
        lo, hi = np.zeros(len(active), np.int64), np.full(len(active), self.n, np.int64)
        while len(active):
            lo, hi = self.extend(self.text[at[active] - 1], lo, hi)
            good = hi > lo
            good[good] = self.owner(lo[good], hi[good]) < owner[active[good]]
            at[active[good]] -= 1
            good &= at[active] > stop[active]
            active, lo, hi = active[good], lo[good], hi[good]
        return at

    def covered(self, owner: np.ndarray, size: np.ndarray, window: int) -> list[tuple[int, int, int]]:
        """(text, from, to): words under windows that also occur in a text of a smaller owner.

        Each text is matched from its end first. Where that stops short, its other windows are taken
        from the left: a match that breaks off at p rules out every window over p that reaches the end.
        """
        out: list[tuple[int, int, int]] = []
        q = np.flatnonzero(size >= window)
        left = self.leftward(self.first[q] + size[q], self.first[q], owner[q]) - self.first[q]
        for i, a in zip(q[size[q] - left >= window], left[size[q] - left >= window], strict=True):
            out.append((int(i), int(a), int(size[i])))
        s, most = np.zeros(len(q), np.int64), np.minimum(left - 1, size[q] - window - 1)
        todo = np.flatnonzero(s <= most)
        while len(todo):
            begin = self.first[q[todo]] + s[todo]
            at = self.leftward(begin + window, begin, owner[q[todo]])
            hit = at == begin
            out += [(int(q[i]), int(s[i]), int(s[i]) + window) for i in todo[hit]]
            s[todo] += np.where(hit, 1, at - begin)
            todo = todo[s[todo] <= most[todo]]
        return out
