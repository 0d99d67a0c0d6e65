"""Column functions on text, paths and identities. All are built-in expressions, so scans stay in the JVM."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
FORMAT_EXTENSIONS = "pdf md txt ocr tsv eml docx doc pptx json vtt srt html htm rtf csv".split()
FORMAT_FOLDERS = "pdf_original ocr_output markdown md text txt tsv ocr images img original".split()
#: Words that negate, and stems that do with any ending.
NEGATIONS = "not no never none without deny denies denied fail fails failed".split()
NEGATION_STEMS = "refus declin lack".split()
STOPWORDS = (
    "the a an of to in on and or for by with is was are were be been that this it as at from his her their any no not"
).split()
MEDIA_EXTENSIONS = "mp4 mov avi mkv webm m4a mp3 wav ogg".split()
PASSTHROUGH_EXTENSIONS = "md markdown txt text json tsv csv".split()
SUBTITLE_EXTENSIONS = "vtt srt".split()
DOUBLE_QUOTES = "“”„‟″«»"
SINGLE_QUOTES = "‘’‚‛′"
SERVED_MARKERS = "sent-text sent_text covering-email covering_email email_as_sent email-as-sent".split()

#: Default audience rules (label, pattern on the lower-cased path); the first that matches counts.
AUDIENCE_RULES = (
    ("journalist", r"/press/|journalist|request_for_comment"),
    ("police", r"/cps/|\bmg6c\b|police|referrals_to_authorities"),
    ("court", r"case_summary|\bsummons\b|prosecution_bundle|court_electronic_bundle|particulars_of_claim|court_correspondence/"),
)


def norm(x: Column) -> Column:
    """Lower case, white space runs to one space, trimmed; null is ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"(?U)\s+", " "))


def extension(path: Column) -> Column:
    """Lower-case extension of a path's last part, '' if none."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def route(path: Column) -> Column:
    """Passthrough, subtitle or external."""
    e = extension(path)
    return F.when(e.isin(PASSTHROUGH_EXTENSIONS), "passthrough").when(e.isin(SUBTITLE_EXTENSIONS), "subtitle").otherwise("external")


def is_media(path: Column) -> Column:
    return extension(path).isin(MEDIA_EXTENSIONS)


def tree_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), 1)


def doc_stem(path: Column) -> Column:
    """Folders that only name a representation go, then stacked format extensions and copy markers of the leaf."""
    parts = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda p: p != "")
    folders = F.filter(
        F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: ~F.lower(p).isin(FORMAT_FOLDERS) & ~F.lower(p).rlike("^(ocr_.+|.+_ocr)$"),
    )
    leaf = F.lower(F.element_at(parts, -1))
    leaf = F.regexp_replace(leaf, rf"(\.({'|'.join(FORMAT_EXTENSIONS)}))+$", "")
    leaf = F.regexp_replace(leaf, r"([ _-]*(ocr|original|copy|\(\d+\)))+$", "")
    return F.when(F.size(parts) > 0, F.concat_ws("/", folders, leaf)).otherwise("")


def is_negation(predicate: Column) -> Column:
    """E5: the negation stands in the predicate."""
    stem = lambda w: F.array_contains(F.array(*(w.startswith(x) for x in NEGATION_STEMS)), True)
    return F.exists(F.split(norm(predicate), r"[^\p{L}\p{N}_]+"), lambda w: w.isin(NEGATIONS) | stem(w))


def layer_of(path: Column) -> Column:
    """SERVED, AUTHORITIES, REPORTS, ANALYSIS or OTHER."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    sent = F.lit(False)
    for m in SERVED_MARKERS:
        sent = sent | F.contains(name, F.lit(m))
    return (
        F.when(F.contains(path, F.lit("evidence_of_service/sent_bundles/")), F.when(sent, "SERVED").otherwise("ANALYSIS"))
        .when(F.contains(path, F.lit("evidence_of_service/sent/")), "SERVED")
        .when(path.startswith("authorities_primary_text/"), "AUTHORITIES")
        .when(path.startswith("reports/"), "REPORTS")
        .when(path.startswith("analysis/"), "ANALYSIS")
        .otherwise("OTHER")
    )


def layer_rank(layer: Column) -> Column:
    return F.when(layer == "SERVED", 3).when(layer == "AUTHORITIES", 2).when(layer == "REPORTS", 1).when(layer == "ANALYSIS", 0).otherwise(-1)


def audience(path: Column, rules: tuple[tuple[str, str], ...] = AUDIENCE_RULES) -> Column:
    """Ordered patterns, the first match wins, else null."""
    out = F.lit(None).cast("string")
    for label, pattern in reversed(rules):
        out = F.when(F.lower(path).rlike(pattern), label).otherwise(out)
    return out


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def doc_id(path: Column, content: Column) -> Column:
    """gb_ and the SHA-256 of path, NUL, content."""
    return F.concat(F.lit("gb_"), F.sha2(F.concat(path, F.decode(F.unhex(F.lit("00")), "UTF-8"), content), 256))


def is_stale(previous: Column, current: Column) -> Column:
    return previous.isNull() | ~previous.eqNullSafe(current)


def passthrough(text: Column) -> Column:
    """G1: CRLF and CR to LF, lines right-trimmed, the whole stripped, one line end at the end."""
    t = F.regexp_replace(text, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"(?m)[^\S\n]+$", "")
    return F.concat(F.regexp_replace(t, r"^\s+|\s+$", ""), F.lit("\n"))


def transcript(text: Column) -> Column:
    """Captions to text; header, notes, cue numbers and times go, tags too, repeated lines once."""
    lines = F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n")
    # A NOTE, STYLE or REGION block runs to the next empty line.
    whole = F.regexp_replace(F.array_join(lines, "\n"), r"(?m)^(NOTE|STYLE|REGION)\b[^\n]*(\n(?!\s*\n)[^\n]+)*", "")
    lines = F.transform(
        F.split(whole, "\n"), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", ""), r"\s+", " "))
    )
    lines = F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^WEBVTT") & ~x.rlike(r"^\d+$") & ~F.contains(x, F.lit("-->")))
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: (s["i"] == 0) | (s["x"] != F.get(lines, s["i"] - 1)))
    return F.array_join(F.transform(kept, lambda s: s["x"]), "\n")


def unescape(text: Column) -> Column:
    """Named and numbered character references, each read once: what a reference stands for is no part of another.

    The text is cut before each reference; a piece's head is looked up in Python's table of the HTML names, or
    counted out. Unknown names, and numbers of no character, stay as they stand; &nbsp; is a plain blank.
    """
    names = F.create_map(*(F.lit(x) for n, c in html5.items() if n.endswith(";") for x in (n, " " if n == "nbsp;" else c)))
    pieces = F.split(text, "(?=&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});)")

    def one(piece: Column) -> Column:
        head = F.regexp_extract(piece, r"^&((?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});)", 1)
        rest = F.substr(piece, F.length(head) + 2)
        digits = F.regexp_extract(head, "^#[xX]?([0-9a-fA-F]+);$", 1)
        code = F.conv(digits, 10, 10).cast("int")
        code = F.when(F.lower(head).startswith("#x"), F.conv(digits, 16, 10).cast("int")).otherwise(code)
        good = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        value = F.when(head.startswith("#"), char).otherwise(F.try_element_at(names, head))
        return F.when((head != "") & value.isNotNull(), F.concat(value, rest)).otherwise(piece)

    return F.array_join(F.transform(pieces, one), "")


def strip_tags(html: Column) -> Column:
    """Tags to spaces, character references decoded, blanks squeezed, lines trimmed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", " ")
    t = unescape(t)
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, r" ?\n ?", "\n")
    return F.trim(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def quote_norm(text: Column) -> Column:
    """Smart quotes to plain ones, ellipses to three dots, white space runs to one space; nothing else."""
    t = F.translate(text, DOUBLE_QUOTES + SINGLE_QUOTES, '"' * len(DOUBLE_QUOTES) + "'" * len(SINGLE_QUOTES))
    t = F.regexp_replace(F.replace(t, F.lit("…"), F.lit("...")), r"\.[ \t]*\.[ \t]*\.(?:[ \t]*\.)*", "...")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def key_norm(key: Column) -> Column:
    """Lower case without white space, underscores and hyphens."""
    return F.regexp_replace(F.lower(key), r"(?U)[\s_\-]+", "")


def date_uncertain(explicit: Column, date: Column, basis: Column) -> Column:
    """An explicit value wins; a date is uncertain unless it stands on its face."""
    return F.when(explicit.isNotNull(), explicit).when(F.coalesce(date, F.lit("")) != "", ~F.coalesce(basis == "on its face", F.lit(False)))


def failure_stage(status: Column) -> Column:
    """The stage at which a run of this status failed."""
    return (
        F.when(status.startswith("extract-failed"), "extracted").when(status.startswith("error"), "enriched").when(status == "sink-failed", "indexed").otherwise("received")
    )


def severity(category: Column) -> Column:
    """Noise for housekeeping, incident for all else."""
    return F.when(F.trim(F.coalesce(category, F.lit(""))) == "housekeeping", "noise").otherwise("incident")


def category(category: Column) -> Column:
    return F.when(F.trim(F.coalesce(category, F.lit(""))) == "housekeeping", "housekeeping").otherwise("legally_obligatory")


def jaccard_tokens(*texts: Column) -> Column:
    """Distinct [a-z0-9]+ tokens of the texts without stopwords."""
    joined = F.lower(F.concat_ws(" ", *texts))
    return F.array_distinct(F.array_except(F.regexp_extract_all(joined, F.lit("[a-z0-9]+"), F.lit(0)), F.array(*map(F.lit, STOPWORDS))))


def requires_caution(h: Column) -> Column:
    """Not reviewed, or a protective flag still stands."""
    return ~h["reviewed"] | h["cpia_s17"] | h["privileged"] | (h["sensitivity"] == "sensitive")


def glob_pattern(glob: str) -> str:
    """B1: a shell pattern as a regular expression; * and ** cross folders, ? is one character."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            while i + 1 < len(glob) and glob[i + 1] == "*":
                i += 1
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and "]" in glob[i + 2 :]:
            j = glob.index("]", i + 2)
            body = glob[i + 1 : j]
            out += f"[{'^' + body[1:] if body[0] == '!' else body}]"
            i = j
        else:
            out += "\\" + c if not c.isalnum() and c not in "_/" else c
        i += 1
    return f"^(?s:{out})$"
