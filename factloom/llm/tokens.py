"""Exact, fast use of the tokenizers library inside tasks: pre-tokens are encoded once, then remembered."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space that the careful path does not cut at; a text that holds any is encoded whole.
_ODD = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁠　﻿\x00]")
_UNITS_BYTE = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")
_UNITS_WORD = re.compile(r"[^ \n]+")
# One pre-token for either tokenizer: letters, or signs without an apostrophe.
_SIMPLE = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+)")

LETTER, SIGN, SPACE, LINE, OTHER, STRANGE = range(6)
_CLASS = np.full(256, STRANGE, np.uint8)
_CLASS[33:127] = SIGN
_CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
_CLASS[[*range(48, 58), 39]] = OTHER
_CLASS[32], _CLASS[10] = SPACE, LINE


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each UTF-8 byte as one letter: printable bytes as themselves, the others,
    in order, from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class Encoder:
    """Texts -> one flat uint32 array of ids and the offsets of each text in it.

    Spaces and line ends bound what the pre-tokenizer may join, and letters and signs part within;
    the ids of a text are the ids of its pre-tokens, one after another. Each is encoded once by the
    library and remembered, up to a bound. Texts of other shapes take careful or whole encoding.
    """

    LIMIT = 200_000
    CHUNK = 2 << 20

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(name if os.sep in name else public_tokenizers.path(name))
        # Texts that hold one of the vocabulary's own marks are encoded whole, as the library finds it there.
        self.added = [t.content for t in self.t.get_added_tokens_decoder().values()]
        self.word = os.path.basename(name).startswith("word")
        self.model, self.letters = self.t.model, _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.pool, self.first = array("I"), array("q", [0])

    def _marked(self, text: str) -> bool:
        low = text.lower()
        return any(mark.lower() in low for mark in self.added)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, unit: bytes) -> int:
        s = unit.decode("utf-8", "surrogatepass")
        if _SIMPLE.fullmatch(s):
            if self.word:
                s = s.strip(" ").lower()
            self.pool.extend([t.id for t in self.model.tokenize(s.translate(self.letters))])
        else:
            self.pool.extend(self.whole([s])[0])
        at = self.slot[unit] = len(self.first) - 1
        self.first.append(len(self.pool))
        return at

    def _cut(self, data: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where pre-tokens start, which texts need the careful path); data: texts end to end, none empty."""
        cls = _CLASS[data]
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        after = after[(data[after] >= 0x80) & (data[after] <= 0xBF) & (data[after] != 0x97) & (data[after] != 0xB7)]
        cls[after] = cls[after - 1] = LETTER
        white = (cls == SPACE) | (cls == LINE)
        begin = np.zeros(len(data), bool)
        begin[edge[:-1]] = True
        bad = (cls == STRANGE) | (white & begin)
        bad[1:] |= white[1:] & white[:-1]
        bad[:-1] |= white[:-1] & begin[1:]
        bad[-1] |= white[-1]
        careful = np.logical_or.reduceat(bad, edge[:-1])
        # Inside a word with digits or apostrophes nothing is cut.
        word = begin | white
        word[1:] |= cls[:-1] == LINE
        at = np.flatnonzero(word)
        whole = np.repeat(np.logical_or.reduceat(cls == OTHER, at), np.diff(np.append(at, len(data))))
        inner = np.zeros(len(data), bool)
        inner[1:] = (cls[1:] != cls[:-1]) & (cls[:-1] != SPACE)
        return np.flatnonzero(word | (inner & ~whole)), careful

    def _chunk(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        has = np.flatnonzero(size)
        n = np.zeros(len(size), np.int64)
        if not len(has):
            return np.empty(0, np.uint32), np.zeros(len(size) + 1, np.int64)
        own = texts.take(pa.array(has))
        edge = np.frombuffer(own.buffers()[1], np.int64, len(own) + 1, own.offset * 8)
        data = np.frombuffer(own.buffers()[2], np.uint8)[: edge[-1]]
        cuts, careful = self._cut(data, edge)
        for mark in self.added:
            careful |= pc.match_substring(own, mark, ignore_case=True).to_numpy(zero_copy_only=False)
        n[has] = np.diff(np.append(np.searchsorted(cuts, edge[:-1]), len(cuts)))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(data)).astype(np.int64)), own.buffers()[2]])
        coded = units.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        _, offsets, values = coded.dictionary.buffers()
        at, raw = np.frombuffer(offsets, np.int64, len(coded.dictionary) + 1).tolist(), values.to_pybytes()
        dictionary = [raw[a:z] for a, z in zip(at, at[1:], strict=False)]
        used = None
        if careful.any():
            index, dictionary = self._careful(texts, has[careful], n, index, dictionary)
            used = np.unique(index)
        if len(self.slot) > self.LIMIT:
            self._forget()
        wanted = dictionary if used is None else [dictionary[i] for i in used]
        slots = list(map(self.slot.get, wanted))
        for i, k in enumerate(slots):
            if k is None:
                slots[i] = self._learn(wanted[i])
        back = np.zeros(len(dictionary), np.int64)
        back[slice(None) if used is None else used] = slots
        index = back[index]
        pool, first = np.array(self.pool, np.uint32), np.array(self.first, np.int64)
        each = np.diff(first)[index]
        ends = np.cumsum(each)
        where = np.repeat(first[index] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        return pool[where], np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n)))]

    def _careful(self, texts: pa.Array, rows: np.ndarray, n: np.ndarray, index: np.ndarray, dictionary: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Units of some texts by pattern, put in place of those that _cut gave."""
        at = {u: i for i, u in enumerate(dictionary)}
        edges, out, last = np.concatenate(([0], np.cumsum(n))), [], 0
        for i, t in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist(), strict=True):
            units = [t] if _ODD.search(t) or self._marked(t) else (_UNITS_WORD if self.word else _UNITS_BYTE).findall(t)
            out += [index[edges[last] : edges[i]], np.array([at.setdefault(u.encode("utf-8", "surrogatepass"), len(at)) for u in units], np.int64)]
            n[i], last = len(units), i + 1
        return np.concatenate([*out, index[edges[last] :]]), list(at)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(index of the first text, ids, offsets) for runs of texts of bounded size; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        run = (np.cumsum(size) // self.CHUNK) if len(size) else size
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), len(size)] if len(size) else [0]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield int(a), *self._chunk(texts.slice(a, b - a))


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]
