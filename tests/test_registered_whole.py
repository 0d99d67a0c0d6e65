"""Registered queries over rows that the driver's tables don't have: nothing is left out."""

from __future__ import annotations

import hashlib
import random
import re

from factloom.functions import text as T
from factloom.plans import queries as Q


def test_seam_pairs_of_every_supplier(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, i % 3, s := rng.randrange(12), rng.choice(["part 1", "the part 1 new", "part 2"]), rng.choice(["qty 1", "qty 2"]), rng.choice(["police", "court", None]), rng.choice([f"Supplier {s}", f"  SUPPLIER {s}", None])) for i in range(160)]
    claims = spark.createDataFrame(rows, "doc_id long, claim_idx int, supp long, subject string, object string, audience string, asserted_by string")
    aliases = spark.createDataFrame([(f"Supplier {s}", f"supplier {s - 1}") for s in range(1, 12, 2)], "alias string, canonical string")
    monkeypatch.setattr(Q.V, "claims", lambda spark, sf: claims)
    monkeypatch.setattr(Q.V, "aliases", lambda spark, sf: aliases)
    got = {tuple(r) for r in Q.QUERIES["seam_pairs_all"](spark, "").collect()}
    own = [(d * 100 + k, a, s - s % 2, set(re.findall("[a-z0-9]+", f"{x} {y}".lower())) - set(T.STOPWORDS)) for d, k, s, x, y, a, w in rows if a and w]
    want = {(i, j, round(len(t & u) / len(t | u), 6)) for i, a, s, t in own for j, b, z, u in own if i < j and a != b and s == z and len(t & u) / len(t | u) >= 0.7}
    assert got == want
    supp = {d * 100 + k: s for d, k, s, *_ in rows}
    assert {supp[i] % 10 for i, _, _ in got} - {3}


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_text_functions_of_every_text(spark, monkeypatch):
    rows = [(1, "“Yes”  he said"), (2, "well . . . No"), (3, "it’s…\tso"), (4, "Plain Text")]
    docs = spark.createDataFrame(rows, "pk long, content string")
    monkeypatch.setattr(Q.V, "docs", lambda spark, sf: docs)
    got = {r["pk"]: (r["norm"], r["squeezed"], r["tokens"]) for r in Q.QUERIES["text_functions"](spark, "").collect()}
    assert got == {
        1: (sha("“yes” he said"), sha('"Yes" he said'), 3), 2: (sha("well . . . no"), sha("well ... No"), 1),
        3: (sha("it’s… so"), sha("it's... so"), 2), 4: (sha("plain text"), sha("Plain Text"), 2),
    }


def test_applied_function_of_every_text(spark, monkeypatch):
    rows = [(1, "abc"), (2, "Ελλάδα"), (3, "мир"), (4, "日本語"), (5, "‘x’…"), (6, "🙂 ok"), (7, ""), (8, None)]
    monkeypatch.setattr(Q.V, "table", lambda spark, sf, name: spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["digest"], r["status"]) for r in Q.QUERIES["applied_function"](spark, "").collect()}
    assert got == {i: (sha(t[::-1]) if t is not None else None, "ok" if t else "empty") for i, t in rows}


def test_claims_are_dealt_by_their_number(spark, sf, monkeypatch):
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    monkeypatch.setattr(Q.V, "TASK_ITEMS", 100)
    claims = Q.V.claims(spark, sf).select("doc_id", "claim_idx")
    assert claims.rdd.getNumPartitions() == -(-n // 100)
    assert claims.distinct().count() == n
