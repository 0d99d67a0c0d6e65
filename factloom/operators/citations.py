"""Readers for citations, sections and quotations in one text, with offsets.

Each reader goes from sign to sign (a bracket, a number, a quotation mark) and looks what stands around it up in a table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

# Fixed values.
DIVISION_NAMES = "Admin KB QB Ch Fam Comm Pat TCC IPEC SCCO".split()
APPEAL_NAMES = "Civ Crim".split()
COURTS = "ewca ewhc ukhl uksc ukpc ewcop ewfc".split()
#: What a procedure rule's number may follow, and whether a full stop may stand behind it.
RULE_MARKERS = {"part": False, "rule": False, "pt": True, "r": True}
#: Words that announce a section, and the short forms that may touch its number.
SECTION_WORDS, SECTION_SHORTS = ("section", "sections"), ("s", "ss")

_RUN = re.compile("[0-9]+")
_BEHIND_COURT = {*DIVISION_NAMES, *APPEAL_NAMES}

Span = tuple[str, str | None, str, int, int]


class Cursor:
    """A place in a text that moves over what it reads; each reader returns '' or 0 where there is nothing."""

    def __init__(self, text: str, at: int):
        self.text, self.at = text, at

    def _while(self, test) -> str:  # noqa: ANN001
        a = self.at
        while self.at < len(self.text) and test(self.text[self.at]):
            self.at += 1
        return self.text[a : self.at]

    def blanks(self) -> int:
        return len(self._while(str.isspace))

    def digits(self) -> str:
        return self._while(lambda c: "0" <= c <= "9")

    def letters(self) -> str:
        return self._while(lambda c: c.isascii() and c.isalpha())

    def sign(self, c: str) -> bool:
        found = self.text.startswith(c, self.at)
        self.at += len(c) * found
        return found

    def in_brackets(self, digits: bool = False) -> str:
        """A word in round brackets, after blanks or none; the place stays where it is if there is none."""
        back = self.at
        self.blanks()
        word = self.sign("(") and self._while(lambda c: c.isascii() and (c.isalnum() if digits else c.isalpha()))
        if word and self.sign(")"):
            return word
        self.at = back
        return ""


def bracket_spans(text: str) -> Iterator[Span]:
    """Neutral citations, as year, court, number and division, and openers of such, from each square bracket on."""
    at, done = text.find("["), 0
    while at >= 0:
        c = Cursor(text, at + 1)
        year = c.digits()
        if len(year) == 4 and c.sign("]") and c.blanks():
            if year[:2] in ("19", "20") and text[c.at : c.at + 1].isascii() and text[c.at : c.at + 1].isalpha():
                yield "opener", None, text[at : at + 40].split("\n")[0], at, c.at + 1
            read = _court_and_number(c) if at >= done else None
            if read:
                done = c.at
                yield "cite", "\t".join((year, *read)), text[at:done], at, done
        at = text.find("[", at + 1)


def _court_and_number(c: Cursor) -> tuple[str, str, str] | None:
    court = c.letters()
    if len(court) < 2 or not court.isupper() or not c.blanks():
        return None
    back = c.at
    name = c.letters()
    if name in _BEHIND_COURT and c.blanks():
        court = f"{court} {name}"
    else:
        c.at = back
    number = c.digits()
    return (court, number, c.in_brackets()) if number else None


def rule_spans(text: str) -> Iterator[Span]:
    """Procedure rules: the rules' short or full name, blanks or commas, a marker and a dotted number."""
    low = text.lower()
    if len(low) != len(text):  # letters that grow in lower case
        low = "".join(x if len(x) == 1 else y for x, y in zip((y.lower() for y in text), text, strict=True))
    for name in ("crimpr", "criminal"):
        at = low.find(name)
        while at >= 0:
            c = Cursor(low, at + len(name))
            full = name == "crimpr" or bool(c.blanks() and c.letters() == "procedure" and c.blanks() and c.letters() in ("rule", "rules"))
            number = _rule_number(c) if full else ""
            if number:
                yield "rule", f"rule:criminal procedure rules {number}", text[at : c.at].strip(), at, c.at
            at = low.find(name, at + 1)


def _rule_number(c: Cursor) -> str:
    gap = c.at
    while c.blanks() or c.sign(","):
        pass
    if c.at == gap:
        return ""
    marker = c.letters()
    if marker not in RULE_MARKERS:
        return ""
    if RULE_MARKERS[marker]:
        c.sign(".")
    c.blanks()
    parts = [c.digits()]
    while parts[-1]:
        back = c.at
        if not (c.sign(".") and (more := c.digits())):
            c.at = back
            break
        parts.append(more)
    return ".".join(parts) if parts[0] else ""


def section_spans(text: str) -> Iterator[Span]:
    """Sections, from each number back to the word before it and on over bracketed subsections."""
    done = 0
    for m in _RUN.finditer(text):
        a = m.start()
        while a > done and text[a - 1].isspace():
            a -= 1
        gap = m.start() - a
        stop = a > done and text[a - 1] == "."
        z = a - 1 if stop else a
        a = z
        while a > 0 and (text[a - 1].isalnum() or text[a - 1] == "_"):
            a -= 1
        word = text[a:z]
        short = word in SECTION_SHORTS and gap <= 1
        if a < done or not (short or (word in SECTION_WORDS and gap and not stop)):
            continue
        c = Cursor(text, m.end())
        while c.in_brackets(digits=True):
            pass
        done = c.at
        yield "section", m.group(), text[a:done], a, done


def quote_spans(text: str, most: int) -> Iterator[Span]:
    """What stands between two quotation marks, up to `most` characters, and what stands on a line behind its > sign."""
    marks = [i for i, c in enumerate(text) if c in '"“”'] if '"' in text or "“" in text else []
    i = 0
    while i + 1 < len(marks):
        a, z = marks[i], marks[i + 1]
        whole = text[a] != "”" and text[z] != "“" and 1 < z - a <= most + 1
        if whole:
            yield "quote", None, text[a + 1 : z], a + 1, z
        i += 1 + whole
    at = 0
    for line in text.split("\n"):
        inner = line.lstrip(" \t")
        if inner.startswith(">"):
            body = inner[2:] if inner[1:2] in (" ", "\t") and len(inner) > 2 else inner[1:]
            if body:
                yield "quote", None, body, at + len(line) - len(body), at + len(line)
        at += len(line) + 1


def act_reader(acts: dict[str, tuple[str, ...]]):  # noqa: ANN201
    """A reader of Acts: the longest name counts, names are whole words and don't overlap."""
    names = {form: act for act, forms in acts.items() for form in forms}
    found = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)", re.I) if names else None

    def read(text: str) -> Iterator[Span]:
        for m in found.finditer(text) if found else ():
            if m.group().lower() in names:
                yield "act", names[m.group().lower()], m.group(), m.start(), m.end()

    return read
