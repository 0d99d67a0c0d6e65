"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|[^<]+|<""", re.S)
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)

#: Content that is never shown, or is no text: skipped to its end tag, whatever stands in it.
RAW = frozenset("script style template textarea title iframe svg canvas noframes".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
#: Elements that hold what surrounds an article.
AROUND = frozenset("head nav header footer aside form menu dialog button select audio video".split())
#: Words in class, id or role that mark such a container.
MARKS = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted
    nav navbar navigation menu breadcrumb breadcrumbs toolbar topbar masthead header footer sidebar sidebars aside
    rail widget widgets related recommended recommendations share sharing social comment comments commentlist disqus
    respond reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter
    subscribe subscription signup login form search pagination pager copyright contentinfo complementary skip""".split()
)
BLOCK = frozenset(
    """address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main
    ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are no containers, whatever their class.
INLINE = frozenset("b i a em strong u s small big code font sub sup".split())
#: Lines in a window, and characters that a window needs for a surge: the values that the method was published with.
WINDOW, SURGE = 3, 86


def _marked(attrs: str) -> bool:
    if not attrs:
        return False
    for m in _NAMED.finditer(attrs):
        if any(w.lower() in MARKS for w in _PART.findall(m.group(1) or m.group(2) or m.group(3) or "")):
            return True
    return bool(_HIDDEN.search(attrs))


#: Of MARKS, words that an article's own parts may well have: they count where links make up half of the text, or beside
#: a word for a box of such things. Of these, WHOLE ones also count as a whole class of a div, aside or section.
WEAK = frozenset("masthead topbar header aside rail widget widgets form search skip contentinfo complementary menu social related".split())
SHELLS = frozenset("links link box bar list block buttons button posts stories panel container".split())
WHOLE = frozenset("menu social related".split())


def _words(attrs: str) -> tuple[set[str], set[str]]:
    """(the words of class, id and role, the whole classes and names), in lower case."""
    values = [m.group(1) or m.group(2) or m.group(3) or "" for m in _NAMED.finditer(attrs)]
    return {w.lower() for v in values for w in _PART.findall(v)}, {w for v in values for w in v.lower().split()}


class _Amounts:
    """Characters of text, and of those in links, before each token."""

    def __init__(self, tokens: list[tuple[str, str, str]]):
        self.text, self.linked = [0], [0]
        links = 0
        for kind, name, _ in tokens:
            n = len("".join(name.split())) if kind == "t" else 0
            links += (kind == "s" and name == "a") - (kind == "e" and name == "a" and links > 0)
            self.text.append(self.text[-1] + n)
            self.linked.append(self.linked[-1] + (n if links else 0))

    def surrounds(self, name: str, attrs: str, start: int, end: int, core: tuple[int, int]) -> bool:
        """Is a container inside an article none of its parts? Hidden ones are; marked ones are unless they are a heading or
        hold most of the article's text."""
        if not attrs:
            return False
        if _HIDDEN.search(attrs):
            return True
        own, linked = self.text[end] - self.text[start], self.linked[end] - self.linked[start]
        if name in _HEADINGS or 2 * own > self.text[core[1]] - self.text[core[0]]:
            return False
        words, whole = _words(attrs)
        marks = words & MARKS
        boxed = bool(words & SHELLS) or (name in ("div", "aside", "section") and bool(whole & WHOLE))
        return bool(marks - WEAK) or (bool(marks) and (boxed or 2 * linked >= own))


def _ends(tokens: list[tuple[str, str, str]]) -> dict[int, int]:
    """Where each container ends, found with a stack that unclosed inner elements don't upset; linear, as an end
    tag without an open element is told by the places of the open ones.

    A paragraph ends where a block starts, a list item where the next one of its list does.
    """
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}

    def close(depth: int, at: int) -> None:
        while len(stack) > depth:
            name, i = stack.pop()
            places[name].pop()
            ends[i] = at

    def last(*names: str) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    for i, (kind, name, _) in enumerate(tokens):
        if kind == "s" and name not in VOID and name not in INLINE:
            if name in BLOCK and stack and stack[-1][0] == "p":
                close(len(stack) - 1, i)
            if name == "li" and (k := last("li")) > last("ul", "ol", "menu"):
                close(k, i)
            places.setdefault(name, []).append(len(stack))
            stack.append((name, i))
        elif kind == "e" and places.get(name):
            close(places[name][-1], i)
    close(0, len(tokens))
    return ends


def _holds(cores: list[int], start: int, end: int) -> bool:
    k = bisect.bisect_right(cores, start)
    return k < len(cores) and cores[k] < end


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, characters outside links, inside article or main) of each block; ('', 0, _) where a
    surrounding container was left out, which parts what stands on its two sides."""
    tokens: list[tuple[str, str, str]] = []  # (kind, name or text, attributes)
    at, endless = 0, set()
    while m := _TOKEN.match(page, at):
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            t = m.group()
            if not t.startswith(("<!", "<?")):
                tokens.append(("t", t, ""))
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            tokens.append(("e", name, ""))
        elif name in RAW:
            # Only the own end tag counts, so nothing inside is read as a tag. Without one, a script or
            # style takes the rest, and of the others just the tag is left out.
            end = None if name in endless else _RAW_END[name].search(page, at)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                break
            else:
                endless.add(name)
        else:
            tokens.append(("s", name, m.group(3) or m.group(6) or ""))
    ends = _ends(tokens)
    cores = [i for i, (kind, name, attrs) in enumerate(tokens) if kind == "s" and name in ("article", "main") and not _marked(attrs)]
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    free = links = core_end = 0
    core, amounts = (0, 0), _Amounts(tokens)

    def close(inside: bool) -> None:
        nonlocal free
        line = " ".join("".join(text).split())
        if line:
            out.append((line, free, inside))
        text.clear()
        free = 0

    i = 0
    while i < len(tokens):
        kind, name, attrs = tokens[i]
        inside = i <= core_end and core_end > 0
        if kind == "t":
            t = html.unescape(name)
            text.append(t)
            if not links:
                free += len(t.strip())
        elif kind == "s":
            end = ends.get(i, i)
            if name in AROUND or (end > i and name not in ("html", "body", "main") and (amounts.surrounds(name, attrs, i, end, core) if inside else _marked(attrs))):
                # A wrapper that holds the article is no surrounding container.
                if name == "head" or (name == "header" and inside) or not _holds(cores, i, end):
                    keep_title = name == "header" and inside
                    close(inside)
                    if not keep_title:
                        out.append(("", 0, inside))
                        # An element that the start of the next one ends leaves that to be read.
                        i = i + 1 if end <= i else end if end < len(tokens) and tokens[end][0] == "s" else end + 1
                        continue
            if name in ("article", "main") and end > i:
                close(inside)
                core = core if inside else (i, end)
                core_end = max(core_end, end)
            elif name in BLOCK:
                close(inside)
            elif name == "br":
                text.append(" ")
            elif name == "a":
                links += 1
        else:
            if name in BLOCK or name in AROUND:
                close(inside)
            elif name == "a" and links:
                links -= 1
        i += 1
    close(i < core_end or bool(core_end >= len(tokens)))
    return out


def _between_marks(lines: list[tuple[str, int]], window: int) -> list[str]:
    """The lines that no window without text covers; all of them where none has text."""
    weight = [free if 2 * free >= len(text) else 0 for text, free in lines]
    if not any(weight):
        return [text for text, _ in lines]
    kept = [True] * len(lines)
    empty = 0
    for i, w in enumerate(weight):
        empty = 0 if w else empty + 1
        if empty >= window:
            kept[i - window + 1 : i + 1] = [False] * window
    return [text for (text, _), k in zip(lines, kept, strict=True) if k]


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Blocks between surge and dive points, joined by one line end.

    The length of a line is its text outside links. A window sums `window` lines from its first one; a
    stretch starts where a window with text follows one without, dives where the sum is 0 again, and is
    kept when one of its windows surges. Pages whose largest window is below `surge` take that as limit.
    Where the page marks an article, its lines alone are looked at. The mark bounds them, so any window with text in
    it surges, and only a window of lines that are all links dives.
    """
    lines = lines_of(page or "")
    article = [(text, free) for text, free, inside in lines if inside and text]
    if article:
        return "\n".join(_between_marks(article, window))
    weight: list[int] = []
    texts: list[str] = []
    for text, free, _ in lines:
        if not text:  # a container that was left out parts its two sides
            weight += [0] * window
            texts += [""] * window
            continue
        weight.append(free if 2 * free >= len(text) else 0)
        texts.append(text)
    n = len(weight)
    sums = [sum(weight[i : i + window]) for i in range(n)]
    limit = min(surge, max(sums, default=0))
    kept: list[str] = []
    i = 0
    while i < n:
        if not sums[i]:
            i += 1
            continue
        z = i
        while z < n and sums[z]:
            z += 1
        if limit and max(sums[i:z]) >= limit:
            run = [(t, w) for t, w in zip(texts[i:z], weight[i:z], strict=True) if t]
            while run and not run[0][1]:
                run.pop(0)
            while run and not run[-1][1]:
                run.pop()
            kept += [t for t, _ in run]
        i = z
    return "\n".join(kept)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of pages, map only; other columns are left out.

    A null or empty html, and one without any text, give '' and 0. n_chars counts code points.
    Repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))
