"""Secret scans: fixed patterns, and sliding-window Shannon entropy per character class."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, sliced

KINDS = ("assign", "access", "hex", "entropy")
_KEYWORDS = ("passw", "secret", "token", "api")
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
#: Candidate strings: runs of characters that keys are written with.
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: (class, its runs, window, least bits a character). Hex has 4 bits at most, base64 log2(window). The windows of
#: 20 reach every candidate; of random hex, one in 10,000 lies below 2.5 bits in 20 characters.
CLASSES = (
    ("hex", re.compile(r"[0-9a-f]{20,}"), 20, 2.5),
    ("hex", re.compile(r"[0-9A-F]{20,}"), 20, 2.5),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 32, 3.1),
    ("hex", re.compile(r"[0-9A-F]{32,}"), 32, 3.1),
    ("alnum", re.compile(r"[A-Za-z0-9]{20,}"), 20, 3.8),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.9),
)
#: Allow-list. Strings that are high in entropy for a known reason and are no secrets.
ALLOW = (
    re.compile(r"[A-Za-z/_=+-]*"),  # no digit: words, paths and rules drawn with signs
    re.compile(r"[0-9/_=+-]*"),  # no letter: numbers, dates
    re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"),  # UUIDs
    re.compile(r"(?:[A-Za-z]+[-_/]|[0-9]{1,4}[-_/])*(?:[A-Za-z]+|[0-9]{1,4})"),  # names and numbers joined by signs
    re.compile(r"(?=.*[A-Za-z])[A-Za-z]+[0-9]{1,4}"),  # a word and a short number
)


def dense_windows(s: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of all windows of s whose entropy is at least bits; counts change by one in, one out."""
    n = len(s)
    if n < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    count: dict[str, int] = {}
    total = 0.0  # sum of c*log2(c); entropy = log2(window) - total/window
    limit = (math.log2(window) - bits) * window + 1e-9
    spans: list[tuple[int, int]] = []
    for i, ch in enumerate(s):
        c = count.get(ch, 0)
        total += term[c + 1] - term[c]
        count[ch] = c + 1
        if i >= window:
            old = s[i - window]
            c = count[old]
            total += term[c - 1] - term[c]
            count[old] = c - 1
        if i >= window - 1 and total <= limit:
            a = i - window + 1
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((a, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, sorted."""
    out: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def entropy_spans(text: str, allow: tuple[re.Pattern, ...] = ALLOW) -> list[tuple[int, int, int]]:
    """(start, 3, end) of candidate stretches with a dense window. Each class slides its window over its own
    runs in the candidate; candidates and runs that the allow-list has are left out."""
    out: list[tuple[int, int, int]] = []
    for m in _CANDIDATE.finditer(text):
        s = m.group()
        if any(p.fullmatch(s) for p in allow):
            continue
        spans: list[tuple[int, int]] = []
        for _, runs, window, bits in CLASSES:
            for r in runs.finditer(s):
                if not any(p.fullmatch(r.group()) for p in allow):
                    spans += [(m.start() + r.start() + a, m.start() + r.start() + z) for a, z in dense_windows(r.group(), window, bits)]
        end = -1
        for a, z in sorted(spans):
            if a <= end:
                out[-1] = (out[-1][0], 3, end := max(end, z))
            else:
                out.append((a, 3, end := z))
    return out


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans, both sorted by start, then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans), one row per row of docs.

    A null or empty text has no spans: counts 0, the digest of an empty string, spans ''. Whole texts,
    map only. Repeated rows give repeated results; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]
        for b in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for t in b.column(1):
                base, spans = scan(t.as_py())
                for k in range(4):
                    cols[k].append(sum(x[1] == k for x in spans))
                cols[4].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                cols[5].append(_joined(spans))
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span of its text replaced by mark; n_chars follows where the column is there.

    Null and clean texts come back unchanged, no row goes, every column stays.
    """

    at = docs.columns.index("text")

    def one(t: str | None) -> str | None:
        spans = scan(t)[1]
        if not spans:
            return t
        parts, end = [], 0
        for a, _, z in spans:
            if a >= end:
                parts += [t[end:a], mark]
            end = max(end, z)
        return "".join([*parts, t[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = pa.array([one(t.as_py()) for t in b.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], clean, *b.columns[at + 1 :]], b.schema.names)

    out = docs.mapInArrow(sliced(run), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents"))
