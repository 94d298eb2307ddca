"""PII by offset-preserving deobfuscation (operator 1).

Base detectors run on the text as it is.  The same detectors then run on a normalised copy, written
by a transducer that undoes homoglyphs (full-width, mathematical, Cyrillic and Greek look-alikes,
zero-width characters), digit words beside digits or each other, and at / dot disguises, and keeps, for
each normalised character, the source characters it stands for; digit words are read in two ways.  A normalised find that rests on a rewritten place
is mapped back to source characters and added, unless a base span of its kind covers it.

Row-wise, one output row per input row: nothing is shuffled.  Null text counts as empty; a null
doc_id, repeated rows and an empty table pass through; other columns are not read.
"""
from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame

from .common import Spans, id_text, map_batches, sha

KINDS = ("email", "ip", "card", "phone")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DOTTED = re.compile(r"[0-9]\.[0-9]++\.[0-9]")  # any address holds one; quicker to look for
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Cyrillic and Greek letters that look like Latin ones.  Compatibility forms (full-width,
#: mathematical, circled) and other scripts' digits follow from Unicode's own tables below.
LOOKALIKES = dict(zip("авеокмнтрсухіјѕԁһԛԝАВЕКМНОРСТУХІЈЅ", "abeokmhtpcyxijsdhqwABEKMHOPCTYXIJS"))
LOOKALIKES |= dict(zip("αορνικυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopvikuABEZHIKMNOPTYX"))
LOOKALIKES |= {"。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " ", " ": " ", " ": " "}
LOOKALIKES |= dict.fromkeys("​‌‍⁠﻿­", "")
DIGITS = dict(zip("zero oh one two three four five six seven eight nine".split(), "00123456789"))

_DIGIT = "(?:" + "|".join(DIGITS) + ")"
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s?", r"\s?[\])}>]\s{0,3}"
_DOTS = rf"(?:{_OPEN}(?:dot|\.){_CLOSE}|\s{{1,3}}dot\s{{1,3}})"
#: Digit words and digits in a row, with blanks, signs or dot disguises between.
CHAIN = re.compile(
    rf"(?:\bplus[\s,-]{{1,3}})?(?<![A-Za-z0-9_])(?:{_DIGIT}\b|[0-9]++)(?:(?:[\s,.()-]{{1,3}}|{_DOTS})(?:{_DIGIT}\b|[0-9]++))+",
    re.I | re.A)
PLUS = re.compile(r"plus[\s,-]{1,3}", re.I | re.A)
#: Digit words that are written as one number, with full stops between them or not.
RUNS = [re.compile(rf"\b{_DIGIT}(?:[\s,{dot}-]{{1,3}}{_DIGIT})*\b", re.I | re.A) for dot in (".", "")]
#: Places to rewrite: a bracketed at, a plain at or @ whose host has a disguised dot, and a disguised dot
#: between digits.  Other dot disguises count only behind an at (see undo_disguises).
SITE = re.compile(
    rf"(?P<at>(?<=[A-Za-z0-9_%+-])(?:{_OPEN}(?:at|@){_CLOSE}(?=[A-Za-z0-9])|\s{{1,3}}at\s{{1,3}}(?=[A-Za-z0-9-]{{1,63}}{_DOTS}[A-Za-z0-9])))"
    rf"|(?P<plain>(?<=[A-Za-z0-9._%+-])@(?=[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}})*{_DOTS}[A-Za-z0-9]))"
    rf"|(?P<dot>(?<=[0-9]){_DOTS}(?=[0-9]))",
    re.I | re.A)
DOT = re.compile(_DOTS + r"(?=[A-Za-z0-9])", re.I | re.A)
LABELS = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:(?:\.|{_DOTS})[A-Za-z0-9-]{{1,63}})*", re.I | re.A)
BRACKET = re.compile(r"[\[({<]\s?(?:at|@|\.)\s?[\])}>]", re.I | re.A)


def may_hold_site(text: str) -> bool:
    """Necessary conditions for a place to rewrite, by plain substring counts where they will do."""
    low = text.lower()
    return bool(BRACKET.search(low) or ("dot" in low and DOT.search(low)))


def fold(ch: str) -> str:
    """The ASCII form of a look-alike, else the character itself."""
    if ch in LOOKALIKES:
        return LOOKALIKES[ch]
    flat = unicodedata.normalize("NFKC", ch)
    if len(flat) == 1 and flat < "\x80":
        return flat
    digit = unicodedata.decimal(ch, None)
    return ch if digit is None else str(digit)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """Leftmost non-overlapping addresses: a local part is the run of its characters before an @, so
    only the @ signs are visited, and never more than that run."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", at + 1)


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base kinds, by kind and start; failing matches are dropped."""
    out = [(0, *s) for s in emails(text)]
    for m in IP.finditer(text) if DOTTED.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


class Rewriter:
    """Writes normalised text and remembers which source characters each piece stands for."""

    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.parts: list[str] = []
        self.norm, self.source, self.kept = [0], [0], []  # piece borders in both texts; kept: copied as is

    def _add(self, part: str, until: int, kept: bool) -> None:
        if part or until > self.source[-1]:
            self.parts.append(part)
            self.norm.append(self.norm[-1] + len(part))
            self.source.append(until)
            self.kept.append(kept)

    def put(self, start: int, end: int, part: str) -> None:
        """Copy up to ``start``, then write ``part`` for the source characters start..end."""
        if start > self.at:
            self._add(self.text[self.at:start], start, True)
        self._add(part, end, False)
        self.at = end

    def done(self) -> str:
        if self.at < len(self.text):
            self._add(self.text[self.at:], len(self.text), True)
        return "".join(self.parts)

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of a normalised span, and whether a rewritten piece lies in it."""
        i = bisect_right(self.norm, start) - 1
        j = bisect_right(self.norm, end - 1) - 1
        s = self.source[i] + (start - self.norm[i] if self.kept[i] else 0)
        e = self.source[j] + (end - self.norm[j]) if self.kept[j] else self.source[j + 1]
        return s, e, not all(self.kept[i: j + 1])


def fold_lookalikes(text: str) -> Rewriter | None:
    if text.isascii():
        return None
    swap = {c: f for c in set(text) if c > "\x7f" and (f := fold(c)) != c}
    if not swap:
        return None
    out = Rewriter(text)
    for m in re.finditer("[" + "".join(map(re.escape, swap)) + "]", text):
        out.put(m.start(), m.end(), swap[m[0]])
    return out


def spell_digits(text: str, dots: bool) -> Rewriter | None:
    """Digit words beside digits or each other become digits, those in a row one number; with ``dots`` the
    full stops between them stay."""
    out, found = Rewriter(text), False
    for m in CHAIN.finditer(text):
        runs = list(RUNS[dots].finditer(text, m.start(), m.end()))
        if not runs:
            continue
        found = True
        if plus := PLUS.match(text, m.start()):
            out.put(plus.start(), plus.end(), "+")
        for last, r in zip([None, *runs], runs):
            if dots and last and text[last.end(): r.start()].strip() == ".":
                out.put(last.end(), r.start(), ".")
            out.put(r.start(), r.end(), "".join(DIGITS[w] for w in re.findall("[a-z]+", r[0].lower())))
    return out if found else None


def undo_disguises(text: str) -> Rewriter | None:
    if not may_hold_site(text):
        return None
    out = Rewriter(text)
    at, found = 0, False
    while m := SITE.search(text, at):
        found = True
        if m["dot"]:
            out.put(m.start(), m.end(), ".")
            at = m.end()
        else:
            out.put(m.start(), m.end(), "@")
            host = LABELS.match(text, m.end())
            at = host.end() if host else m.end()
            for d in DOT.finditer(text, m.end(), at):
                out.put(d.start(), d.end(), ".")
    return out if found else None


def readings(text: str):
    """(steps, normalised text): look-alikes alone, with at and dot disguises, and with digit words in
    both ways; a number may end before digit words that another one needs."""
    steps = []
    if fold := fold_lookalikes(text):
        steps, text = [fold], fold.done()
        yield steps, text
    for spell in (None, False, True):
        more, now = list(steps), text
        if spell is not None:
            if not (step := spell_digits(text, spell)):
                return
            more, now = [*more, step], step.done()
        if step := undo_disguises(now):
            more, now = [*more, step], step.done()
        if len(more) > len(steps):
            yield more, now


def added(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans found only in normalised text, on source characters, but for those that a base span of
    their kind covers."""
    out, held = set(), [sorted((s, e) for k, s, e in base if k == kind) for kind in range(len(KINDS))]
    for steps, norm in readings(text):
        finds = detect(norm)
        # a telephone number that is spelled out carries no plus
        taken = Spans((s, e) for _, s, e in finds)
        finds += [(3, m.start(), m.end()) for m in re.finditer(r"(?<![0-9+])[0-9]{10,15}(?![0-9])", norm)
                  if not taken.touch(m.start(), m.end())]
        for kind, s, e in finds:
            rewritten = False
            for step in reversed(steps):
                s, e, here = step.back(s, e)
                rewritten |= here
            if rewritten and not covered(held[kind], s, e):
                out.add((kind, s, e))
    # of spans of one kind those that another one covers go: by start, the longer first, the farthest end so far decides
    kept, far = [], [-1] * len(KINDS)
    for kind, s, e in sorted(out, key=lambda x: (x[0], x[1], -x[2])):
        if e > far[kind]:
            kept.append((kind, s, e))
            far[kind] = e
    return kept


def covered(spans: list[tuple[int, int]], s: int, e: int) -> bool:
    """Whether one of ``spans`` (sorted, apart) holds all of [s, e)."""
    at = bisect_right(spans, (s, float("inf"))) - 1
    return at >= 0 and e <= spans[at][1]


def spelled(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find_pii(text: str) -> tuple[list, list]:
    base = detect(text)
    return base, added(text, base)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts by kind and spans as kind:start:end (code points, end exclusive).

    Counts and ``base_sha256`` hold the base spans alone; ``spans`` holds all, by kind and start."""
    def run(batch):
        cols = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
        for text in batch.column(1).to_pylist():
            base, more = find_pii(text)
            for k, kind in enumerate(KINDS):
                cols[f"n_{kind}"].append(sum(b[0] == k for b in base))
            cols["base_sha256"].append(sha(spelled(base)))
            cols["spans"].append(spelled(sorted(base + more)))
            cols["n_added"].append(len(more))
        return cols | {"doc_id": batch.column(0)}

    return map_batches(id_text(docs, id_col, text_col), run, SCHEMA)


def redact(text: str, spans: str, mark: str = "<{}>") -> str:
    """The text with the spans of :func:`pii_spans` replaced by their kind; overlaps count once."""
    out, at = [], 0
    for kind, s, e in sorted(((k, int(s), int(e)) for k, s, e in (x.split(":") for x in spans.split(",") if x)), key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], mark.format(kind)]
        at = max(at, e)
    return "".join(out) + text[at:]
