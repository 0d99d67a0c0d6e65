"""Enrichment and extraction seams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLAIM = (
    "array<struct<subject:string,predicate:string,object:string,asserted_by:string,polarity:string,epistemic_status:string,"
    "source_span:string,claim_date:string,confidence:string,derived_from:array<string>>>"
)
STATUSES = ("asserted", "inferred", "quoted", "held")  # fixed values


def parse_completions(rows: DataFrame, text: str = "completion") -> DataFrame:
    """Adds summary, long_summary, keywords, entities, author, document_type and claims, read defensively.

    Scalars of any JSON type become strings; a claim without the full triple goes; polarity is true
    unless the text negates it; an unknown epistemic status, and a confidence outside 0..1, is null;
    what is no JSON object gives an empty result.
    """
    schema = f"summary string, long_summary string, keywords array<string>, entities array<string>, author string, document_type string, claims {CLAIM}"
    j = F.from_json(text, schema)
    empty = F.array().cast("array<string>")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))

    def claim(c: Column) -> Column:
        conf = c["confidence"].try_cast("double")
        status = F.lower(F.trim(c["epistemic_status"]))
        return F.struct(
            F.trim(c["subject"]).alias("subject"),
            F.trim(c["predicate"]).alias("predicate"),
            F.trim(c["object"]).alias("object"),
            F.nullif(c["asserted_by"], F.lit("")).alias("asserted_by"),
            ~F.lower(F.trim(F.coalesce(c["polarity"], F.lit("true")))).isin("false", "no", "negated", "0").alias("polarity"),
            F.when(status.isin(*STATUSES), status).alias("epistemic_status"),
            blank(c["source_span"]).alias("source_span"),
            blank(c["claim_date"]).alias("claim_date"),
            F.when(conf.between(0, 1), conf).alias("confidence"),
            F.filter(F.transform(F.coalesce(c["derived_from"], empty), F.trim), lambda x: x != "").alias("derived_from"),
        )

    whole = lambda c: c.isNotNull() & (F.coalesce(c["subject"], F.lit("")) != "") & (F.coalesce(c["predicate"], F.lit("")) != "") & (F.coalesce(c["object"], F.lit("")) != "")
    filled = lambda c: F.filter(F.coalesce(c, empty), lambda x: x.isNotNull() & (x != ""))
    claims = F.filter(F.transform(F.filter(j["claims"], lambda c: c.isNotNull()), claim), whole)
    return rows.withColumns(
        {
            "summary": F.coalesce(j["summary"], F.lit("")),
            "long_summary": j["long_summary"],
            "keywords": filled(j["keywords"]),
            "entities": filled(j["entities"]),
            "author": F.nullif(j["author"], F.lit("")),
            "document_type": F.nullif(j["document_type"], F.lit("")),
            "claims": F.coalesce(claims.cast(claims_type()), F.array().cast(claims_type())),
        }
    )


def claims_type() -> str:
    return (
        "array<struct<subject:string,predicate:string,object:string,asserted_by:string,polarity:boolean,epistemic_status:string,"
        "source_span:string,claim_date:string,confidence:double,derived_from:array<string>>>"
    )


def union_keep(first: Column, second: Column) -> Column:
    """The second's new values after the first; repeats inside the first stay."""
    return F.concat(first, F.array_distinct(F.filter(second, lambda x: ~F.array_contains(first, x))))


def merge_enrichment(base: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """found's keywords and entities are added to base's; author and type only fill gaps; a
    claim_source of base speaks every claim. base(key, keywords, entities, author, document_type, claim_source)."""
    f = found.select(key, *[F.col(c).alias(f"f_{c}") for c in ("keywords", "entities", "author", "document_type", "claims", "summary")])
    empty = F.array().cast("array<string>")
    speaker = F.nullif(F.trim("claim_source"), F.lit(""))
    said = F.transform("f_claims", lambda c: c.withField("asserted_by", F.coalesce(speaker, c["asserted_by"])))
    return base.join(f, key, "left").select(
        key,
        F.col("f_summary").alias("summary"),
        union_keep(F.coalesce("keywords", empty), F.coalesce("f_keywords", empty)).alias("keywords"),
        union_keep(F.coalesce("entities", empty), F.coalesce("f_entities", empty)).alias("entities"),
        F.coalesce("author", "f_author").alias("author"),
        F.coalesce("document_type", "f_document_type").alias("document_type"),
        said.alias("claims"),
    )


def overlay(docs: DataFrame, resolved: DataFrame, fields: list[str], key: str = "raw_path") -> DataFrame:
    """The folder's authoritative fields over the stored ones, where they are given."""
    r = resolved.select(key, *[F.col(f).alias(f"r_{f}") for f in fields])
    q = docs.join(r, key, "left")
    return q.withColumns({f: F.coalesce(f"r_{f}", f) for f in fields}).drop(*[f"r_{f}" for f in fields])


def index_document(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, source): the document as JSON without nulls and empty lists."""
    lists = {c for c, t in docs.dtypes if t.startswith("array")}
    cols = [F.when(F.size(c) > 0, F.col(c)).alias(c) if c in lists else F.col(c) for c in docs.columns]
    return docs.select(key, F.to_json(F.struct(*cols), {"ignoreNullFields": "true"}).alias("source"))


def lead_text(text: Column, budget: int) -> Column:
    """The leading text of at most `budget` tokens, where a token is a run of word signs or one other sign."""
    return F.regexp_extract(text, rf"^(?s:(?:\s*(?:\w+|[^\w\s])){{0,{int(budget)}}})", 0)


def lead_by(docs: DataFrame, tokens_of: Callable[[str], list[tuple[int, int]]], budget: int, key: str = "doc_id", column: str = "content") -> DataFrame:
    """G28 by a caller's tokenizer: (key, lead, n_tokens), the text up to the end of its budget-th token.

    tokens_of gives the (start, end) of each token in code points; a null text has no tokens.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            spans = [tokens_of(t) if isinstance(t, str) else [] for t in b[column]]
            lead = [(t if len(s) <= budget else t[: s[budget - 1][1]] if budget else "") if isinstance(t, str) else None for t, s in zip(b[column], spans, strict=True)]
            yield pd.DataFrame({key: b[key], "lead": lead, "n_tokens": [len(s) for s in spans]})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, column).mapInPandas(run, f"{key} {kind}, lead string, n_tokens long")


def budget_plan(tokens: Column, first: int = 100_000, steps: int = 3) -> Column:
    """The budget that holds a text: the first, halved up to steps - 1 times, that is at least needed."""
    sizes = [first >> i for i in range(steps)]
    out = F.lit(sizes[0])
    for s in sizes[1:]:
        out = F.when(tokens <= s, F.lit(s)).otherwise(out)
    return out


def apply_to_texts(docs: DataFrame, fn: Callable[[list[str | None]], list[str | None]], key: str = "doc_id", column: str = "content") -> DataFrame:
    """(key, result, status) from the caller's function on batches; it fails by document, not by job.

    A batch that raises is run again one by one; what still raises gets status 'error: ...'. Persist the
    result before a second action if calls are dear.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b[column].tolist()
            try:
                out = [(x, "ok" if x else "empty") for x in fn(texts)]
            except Exception:  # noqa: BLE001  the caller's function may raise anything
                out = []
                for t in texts:
                    try:
                        x = fn([t])[0]
                        out.append((x, "ok" if x else "empty"))
                    except Exception as e:  # noqa: BLE001
                        out.append((None, f"error: {e}"))
            yield pd.DataFrame({key: b[key], "result": [x for x, _ in out], "status": [s for _, s in out]})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, column).mapInPandas(run, f"{key} {kind}, result string, status string")


def expectation(text: Column, error: Column, min_chars: Column, allow_empty: Column, allow_error: Column, contains: Column) -> Column:
    """Ok, or the first expectation that the extraction of a document misses."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (
        F.when(error.isNotNull(), F.when(allow_error, "ok").otherwise("error"))
        .when(t == "", F.when(allow_empty, "ok").otherwise("empty"))
        .when(F.length(t) < F.coalesce(min_chars, F.lit(0)), "too short")
        .when(contains.isNotNull() & ~F.contains(F.lower(t), F.lower(contains)), "text missing")
        .otherwise("ok")
    )


#: Mails of which a task holds the parsed fields at once.
MAILS = 256


def parse_emails(raw: DataFrame) -> DataFrame:
    """raw(file, content binary) -> subject, from_addr, to_addrs, cc_addrs, date, body, attachments.

    A plain body is taken before an HTML one, whose tags are stripped; broken mail gives empty fields.
    """
    schema = (
        "file string, subject string, from_addr string, to_addrs array<string>, cc_addrs array<string>, date string, body string, "
        "attachments array<struct<filename:string,content_type:string,size_bytes:int>>"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import email
        import html
        import re
        from email import policy
        from email.headerregistry import HeaderRegistry
        from email.utils import getaddresses

        class Headers(HeaderRegistry):
            """One class for each header's name; the library makes one for each header."""

            def __init__(self):
                super().__init__()
                self.made = {}

            def __getitem__(self, name):
                kind = self.registry.get(name.lower(), self.default_class)
                if kind not in self.made:
                    self.made[kind] = super().__getitem__(name)
                return self.made[kind]

        def text(header: str | None) -> str | None:
            # A header holds its parse; only its text is kept.
            return None if header is None else str(header)

        rules = policy.default.clone(header_factory=Headers())
        for b in (whole.iloc[at : at + MAILS] for whole in batches for at in range(0, len(whole), MAILS)):
            rows = []
            for file, content in zip(b["file"], b["content"], strict=True):
                m = email.message_from_bytes(content or b"", policy=rules)
                part = m.get_body(preferencelist=("plain", "html"))
                try:
                    body = "" if part is None else part.get_content()
                except (LookupError, ValueError):  # a charset that nobody knows
                    body = ""
                if part is not None and part.get_content_type() == "text/html":
                    body = re.sub(r"[ \t]+", " ", html.unescape(re.sub(r"<[^>]+>", " ", body))).strip()
                files = [
                    {"filename": a.get_filename(), "content_type": a.get_content_type(), "size_bytes": len(a.get_payload(decode=True) or b"")}
                    for a in m.iter_attachments()
                ]
                names = {h: [x for _, x in getaddresses(m.get_all(h, []))] for h in ("to", "cc")}
                rows.append((file, text(m["subject"]), text(m["from"]), names["to"], names["cc"], text(m["date"]), body, files))
            yield pd.DataFrame(rows, columns=["file", "subject", "from_addr", "to_addrs", "cc_addrs", "date", "body", "attachments"])

    return raw.select("file", "content").mapInPandas(run, schema)


def email_markdown() -> Column:
    """Subject as a heading, addresses, the body, attachments as a list."""
    files = F.array_join(F.transform("attachments", lambda a: F.concat(F.lit("- "), a["filename"])), "\n")
    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("# "), F.coalesce("subject", F.lit("(no subject)"))),
        F.concat_ws("\n", F.concat(F.lit("From: "), "from_addr"), F.concat(F.lit("To: "), F.array_join("to_addrs", ", ")), F.concat(F.lit("Date: "), "date")),
        F.trim("body"),
        F.when(F.size("attachments") > 0, F.concat(F.lit("Attachments:\n"), files)),
    )
