"""Byte-level BPE: merges by a priority queue over a linked list of symbols, and the way back to text."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, give_back, read

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points below this have the same class in every version of Unicode.
_SETTLED = 0x530
#: A character of each class, to stand for characters of which the two libraries differ.
_STAND_IN = {"letter": "b", "number": "0", "other": "!", "space": " "}
#: Characters of a text that are cut into pre-tokens at once; a cut before a space between two letters parts none.
_PIECE, _SAFE = 1 << 20, re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
#: Bytes of text in a batch of the encoder, of ids in one of the decoder.
_BATCH = 4 << 20


def byte_letters() -> list[str]:
    """Byte-level vocabularies write each byte as one letter: printable bytes as themselves, the others, in order,
    from code point 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Coder:
    """One vocabulary file of the tokenizers library: text to ids and ids to text.

    Ids are held as little-endian unsigned 32-bit integers. What a pre-tokenizer's unit becomes is remembered, up to a
    bound, so that frequent words are merged once.
    """

    UNITS, LONGEST = 400_000, 64

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before, added = file["model"], file["pre_tokenizer"] or {}, file["added_tokens"]
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not file["normalizer"]
        odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or odd or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.first = [vocab[x] for x in letters]
        #: left id << 32 | right id -> rank, and the id that each rank makes.
        self.ranks: dict[int, int] = {}
        self.makes: list[int] = []
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.makes.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in added}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        byte = {x: b for b, x in enumerate(letters)}
        self.strings: dict[int, bytes] = {i: bytes(byte[x] for x in s) for s, i in vocab.items()}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        self.units = regex.compile(PATTERN)
        self.probe = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.known: set[str] = {chr(c) for c in range(_SETTLED)}
        self.stand_in: dict[int, str] = {}
        self.memo: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours, least rank first and among equals leftmost, until none is left to merge.

        Neighbours are linked both ways. The queue holds rank << 32 | place of the left symbol. A pair that is queued may
        meanwhile have lost a symbol to another merge; the place then has another rank or none, and the entry is skipped.
        """
        n, get, makes = len(symbols), self.ranks.get, self.makes
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [r << 32 | i for i in range(n - 1) if (r := get(symbols[i] << 32 | symbols[i + 1])) is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j, own = right[i], symbols[i]
            if own < 0 or j < 0 or get(own << 32 | symbols[j]) != rank:
                continue
            symbols[i] = both = makes[rank]
            symbols[j] = -1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (r := get(both << 32 | symbols[k])) is not None:
                    heappush(queue, r << 32 | i)
            h = left[i]
            if h >= 0 and (r := get(symbols[h] << 32 | both)) is not None:
                heappush(queue, r << 32 | h)
        return [s for s in symbols if s >= 0]

    def _unit(self, unit: str) -> bytes:
        out = np.array(self.merge([self.first[b] for b in unit.encode()]), "<u4").tobytes()
        if len(unit) <= self.LONGEST:
            if len(self.memo) >= self.UNITS:
                self.memo.clear()
            self.memo[unit] = out
        return out

    def _classes(self, text: str) -> None:
        """Learn the classes of new characters: the library's Unicode may be older than that of the patterns."""
        for c in set(text) - self.known:
            self.known.add(c)
            own = next((k for k in ("letter", "number", "other") if len(self.probe.pre_tokenize_str(_STAND_IN[k] + c)) == 1), "space")
            if len(self.units.findall(_STAND_IN[own] + c)) != 1 or own == "space" and not c.isspace():
                self.stand_in[ord(c)] = _STAND_IN[own]

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The pre-tokenizer's units of text, in lists of bounded size."""
        if not text.isascii():
            self._classes(text)
        a = 0
        while a < len(text):
            m = _SAFE.search(text, a + _PIECE) if len(text) - a > _PIECE else None
            piece = text[a : m.start() if m else None]
            a += len(piece)
            seen = piece.translate(self.stand_in) if self.stand_in and not piece.isascii() else piece
            yield self.units.findall(piece) if seen == piece else [piece[m.start() : m.end()] for m in self.units.finditer(seen)]

    def encode(self, text: str) -> bytes:
        out: list[bytes] = []
        get, unit = self.memo.get, self._unit
        for i, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if i % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
                continue
            for units in self._cut(part):
                out.append(b"".join([get(u) or unit(u) for u in units]))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary's strings one after another; ids that it lacks are left out, torn characters become U+FFFD."""
        try:
            parts = b"".join(map(self.strings.__getitem__, ids.tolist()))
        except KeyError:
            parts = b"".join([self.strings.get(i, b"") for i in ids.tolist()])
        return parts.decode("utf-8", "replace")


_coders: dict[str, Coder] = {}


def coder(vocabulary: str) -> Coder:
    """One coder per Python worker and vocabulary: a path, or a name of the installed public vocabularies."""
    if vocabulary not in _coders:
        import public_tokenizers

        _coders[vocabulary] = Coder(vocabulary if os.sep in vocabulary else public_tokenizers.path(vocabulary))
    return _coders[vocabulary]


def encode_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids array<int>), one row per row of docs(doc_id, text); no end id is added.

    A null or empty text gives []. Repeated rows stay repeated, an empty table gives none, other columns are left out. A text
    is encoded whole, whatever its length, in pieces that are parted where no pre-token is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocabulary)
        for whole in batches:
            for b in by_bytes(iter([whole]), 1, _BATCH):
                ids = [c.encode(t) if t else b"" for t in b.column(1).to_pylist()]
                edge = np.cumsum([0, *map(len, ids)]) // 4
                lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").view("<i4")))
                yield pa.RecordBatch.from_arrays([b.column(0), lists], ["doc_id", "ids"])
        give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(rows: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, text) of rows(doc_id, ids array<int>): ids as they came and the text that they spell.

    A null list gives a null text, [] an empty one; a null id or one that the vocabulary lacks adds nothing. Rows stay as many as
    they were; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocabulary)
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                texts = [c.decode(x.values.drop_null().to_numpy(zero_copy_only=False)) if x.is_valid else None for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
        give_back()

    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, ids array<int>, text string")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "byte_bpe_50k.json"

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.ascontiguousarray(x.values.to_numpy(zero_copy_only=False), "<i4") for x in b.column(1)]
            sums = [pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *sums, b.column(2)], ["doc_id", "n_tokens", "ids_sha256", "text"])

    back = decode_ids(encode_texts(read(spark, sf_dir, "documents"), name), name)
    rows = back.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, text string")
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
