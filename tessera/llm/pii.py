"""Personal data in disguise: offset-preserving deobfuscation.

Base detectors run on the text as it is.  Then small transducers rewrite
disguises (look-alike characters and invisible ones, spelled digits, at / dot
words); each keeps, for every character it emits, the source range it came
from, and transducers compose by composing those ranges.  The same detectors
run on the normalised text and their spans are mapped back to source
characters.  A mapped span is added if it holds a rewritten piece and is not
inside a base span of its kind; base spans always stay.

Cases: a null text is an empty one (no spans); repeated rows give repeated
rows; other columns are ignored; an empty table gives an empty result.  Work
is linear in the text (no pattern restarts inside a run it has already read).
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# FIXED VALUES: characters that look like an ASCII one.
LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝ", "aeopcyxijsdhqw", strict=True))
LOOKALIKES |= dict(zip("АВЕКМНОРСТХЅІЈ", "ABEKMHOPCTXSIJ", strict=True))
LOOKALIKES |= dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧον", "ABEZHIKMNOPTYXov", strict=True))
LOOKALIKES |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}  # full-width forms of printable ASCII
LOOKALIKES |= {chr(first + i): str(i) for first in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for i in range(10)}
LOOKALIKES |= {"﹫": "@", "․": ".", "。": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " "}
INVISIBLE = "​‌‍⁠﻿­"
# FIXED VALUES: words that are no name and no host in front of, or behind, the word at.
PLAIN_WORDS = frozenset("a all an and any are her here him his home in is it its least me my night noon of on one or our she some that the their them there they this time us was we were what where you your".split())
# FIXED VALUES: words for digits, the at sign and the dot in English, French, German and Spanish.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
DIGIT_WORDS |= {"zéro": "0", "un": "1", "une": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9"}
DIGIT_WORDS |= {"null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9"}
DIGIT_WORDS |= {"cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9"}
_SURE_AT_WORD = "arroba|arobase|arrobase|arobas|klammeraffe"  # these mean nothing else
_AT_WORD = f"at|{_SURE_AT_WORD}"
_PROSE_DOT = "punkt|point|punto"  # common words of their language, too
_DOT_WORD = f"dot|{_PROSE_DOT}"
# FIXED VALUES: top domains asked for where both "at" and a common dot word stand bare ("at which point we").
TOP_DOMAINS = frozenset("com org net edu gov info biz eu de fr es ch ca lu uk us io co dev app mx ar cl".split())

_STRANGE = re.compile("[" + "".join(map(re.escape, LOOKALIKES)) + INVISIBLE + "]")
_DIGIT = "|".join(DIGIT_WORDS)
#: At least three spelled digits in a row, "plus" in front and digits in between allowed.
_SPELLED = re.compile(rf"(?i)\b(?:plus[ -]+)?(?:(?:double|triple)[ -]+)?(?:{_DIGIT})(?:(?:[ -]+(?:(?:double|triple)[ -]+)?(?:{_DIGIT}))|(?:[ -]+(?:{_DOT_WORD})[ -]+(?:{_DIGIT}))|[ -]+[0-9]+){{2,}}\b")
_SPELLED_PART = re.compile(rf"(?i)(?:(double|triple)[ -]+)?\b({_DIGIT})\b|\b(plus)[ -]+|[ -]+({_DOT_WORD})[ -]+")
_BRACKETED = re.compile(rf"(?i)[ \t]?[\[({{<][ \t]?(?:({_AT_WORD}|@)|({_DOT_WORD}|\.))[ \t]?[\])}}>][ \t]?")
_BARE = re.compile(rf"(?i)(?<=[A-Za-z0-9])[ \t](?:({_AT_WORD})|({_DOT_WORD}))[ \t](?=[A-Za-z0-9])")
#: What the patterns above match, without what they may take at their ends; a bare at only in front of a host.
_BRACKET_MARK = re.compile(rf"(?i)[\[({{<][ \t]?(?:{_AT_WORD}|@|{_DOT_WORD}|\.)[ \t]?[\])}}>]")
_BARE_DOT = re.compile(rf"(?i)[ \t](?<=[A-Za-z0-9][ \t])(?:{_DOT_WORD})[ \t](?=[A-Za-z0-9])")
_AT_HOST = re.compile(rf"(?i)[ \t](?<=[A-Za-z0-9][ \t])(?:{_AT_WORD})[ \t](?=[A-Za-z0-9])[A-Za-z0-9-]++\.[A-Za-z0-9-]")
_SURE_AT = re.compile(rf"(?i)[ \t](?:{_SURE_AT_WORD})[ \t]")
_BARE_PROSE_DOT = re.compile(rf"(?i)[ \t](?:{_PROSE_DOT})[ \t]")


def _may_hide(t: str) -> bool:
    """Whether any transducer could rewrite a piece of an identifier (cheap; most texts end here)."""
    return bool(_BARE_DOT.search(t) or _BRACKET_MARK.search(t) or _AT_HOST.search(t) or _SPELLED.search(t) or (not t.isascii() and _STRANGE.search(t)))


class Mapped:
    """A normalised text; character i came from source range ``start[i]:end[i]``; ``new[i]``: it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))
        self.new = [False] * len(text)

    def rewrite(self, pieces: list[tuple[int, int, str]]) -> None:
        """Replace disjoint ranges, given in order, by texts; each new character stands for its whole range."""
        if not pieces:
            return
        text, start, end, new, at = [], [], [], [], 0
        for a, b, by in [*pieces, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            new += self.new[at:a]
            if by:
                text.append(by)
                start += [self.start[a]] * len(by)
                end += [self.end[b - 1]] * len(by)
                new += [True] * len(by)
            elif b > a and new:  # deleted: its neighbour counts as rewritten
                new[-1] = True
            at = b
        self.text, self.start, self.end, self.new = "".join(text), start, end, new


def lookalikes(m: Mapped) -> None:
    """Transducer: look-alike characters become ASCII, invisible ones go."""
    m.rewrite([(x.start(), x.end(), LOOKALIKES.get(x[0], "")) for x in _STRANGE.finditer(m.text)])


def spelled_digits(m: Mapped) -> None:
    """Transducer: runs of three or more digit words become digits ("double", "plus" and "dot" inside them too)."""
    pieces = []
    for run in _SPELLED.finditer(m.text):
        for x in _SPELLED_PART.finditer(m.text, run.start(), run.end()):
            if x[2]:
                times = {"double": 2, "triple": 3}.get((x[1] or "").lower(), 1)
                pieces.append((x.start(), x.end(), DIGIT_WORDS[x[2].lower()] * times))
            else:
                pieces.append((x.start(), x.end(), "+" if x[3] else "."))
    m.rewrite(pieces)


def bracketed_marks(m: Mapped) -> None:
    """Transducer: (at), [dot] and the like."""
    m.rewrite([(x.start(), x.end(), "@" if x[1] else ".") for x in _BRACKETED.finditer(m.text)])


def bare_marks(m: Mapped) -> None:
    """Transducer: the words for at and dot between single blanks or tabs."""
    m.rewrite([(x.start(), x.end(), "@" if x[1] else ".") for x in _BARE.finditer(m.text)])


def _emails(t: str) -> list[tuple[int, int]]:
    out, floor, at = [], 0, t.find("@")
    while at >= 0:
        a = at
        while a > floor and t[a - 1] in _LOCAL_CHARS:
            a -= 1
        if a < at and (m := _DOMAIN.match(t, at + 1)):
            out.append((a, m.end()))
            floor = m.end()
        else:
            floor = at + 1
        at = t.find("@", floor)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def find(t: str) -> dict[str, list[tuple[int, int]]]:
    """The base detectors: leftmost non-overlapping matches of each kind that pass its test."""
    out = {"email": _emails(t), "ip": [], "card": [], "phone": []}
    for m in _IP.finditer(t):
        if all(map(_byte, m.groups())):
            out["ip"].append(m.span())
    for m in _CARD.finditer(t):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) <= 19 and _luhn(digits):
            out["card"].append(m.span())
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


def _convincing(kind: str, piece: str, bare: bool, rewritten_dot: bool, prose_dot: bool) -> bool:
    """A bare "at" is a common word: a last label of letters is asked for, a written dot only after an identifier-like name, and a known top domain behind a common dot word."""
    if kind != "email":
        return True
    name, _, domain = piece.partition("@")
    top = domain.rpartition(".")[2]
    if not (top.isalpha() and 2 <= len(top) <= 24):
        return False
    if bare and prose_dot and top.lower() not in TOP_DOMAINS:
        return False
    if bare and (name.lower() in PLAIN_WORDS or domain.partition(".")[0].lower() in PLAIN_WORDS):
        return False
    return not bare or rewritten_dot or any(not c.isalpha() for c in name)


def hidden(t: str, base: dict[str, list[tuple[int, int]]]) -> dict[str, list[tuple[int, int]]]:
    """Spans that show only after normalisation, as source ranges."""
    out: dict[str, set[tuple[int, int]]] = {k: set() for k in KINDS}
    if not _may_hide(t):
        return {k: [] for k in KINDS}
    m = Mapped(t)
    for step in (lookalikes, spelled_digits, bracketed_marks, bare_marks):
        before = m.text
        step(m)
        bare = step is bare_marks
        if step in (lookalikes, spelled_digits) or (m.text == before and bare):
            continue
        for kind, spans in find(m.text).items():
            inside = base[kind]
            for a, b in spans:
                if not any(m.new[a:b]):
                    continue
                s, e = m.start[a], m.end[b - 1]
                piece = m.text[a:b]
                new_dot = any(m.new[i] for i in range(a, b) if m.text[i] == ".")
                new_at = any(m.new[i] for i in range(a, b) if m.text[i] == "@")
                if not _convincing(kind, piece, bare and new_at and not _SURE_AT.search(t[s:e]), new_dot, bool(_BARE_PROSE_DOT.search(t[s:e]))):
                    continue
                i = bisect_left(inside, (s + 1,)) - 1
                if i >= 0 and inside[i][0] <= s and e <= inside[i][1]:
                    continue
                if any(not (e <= x or y <= s) for x, y in out[kind]):
                    continue
                out[kind].add((s, e))
    return {k: sorted(v) for k, v in out.items()}


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_hidden long"
_ARROW = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_hidden", pa.int64())])


def _scan(batches):
    for batch in batches:
        rows = []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            t = t.as_py() or ""
            base = find(t)
            more = hidden(t, base)
            every = {k: sorted({*base[k], *more[k]}) for k in KINDS}
            rows.append((i, *(len(base[k]) for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), sum(map(len, more.values()))))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)] if rows else [pa.array([], f.type) for f in _ARROW], schema=_ARROW)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans, number of added ones.

    A map over the documents: no shuffle, memory of one batch.
    """
    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).mapInArrow(_scan, SCHEMA)
