"""Personal data in texts: e-mail addresses, IPv4 addresses, payment cards and phone numbers, also disguised ones.

Base. Each kind has a pattern, leftmost and non-overlapping; matches that fail the kind's check (octets at most 255, 12 to
19 digits with a right Luhn sum, 9 to 15 digits) are dropped without another try.

Method. Offset-preserving deobfuscation: a chain of transducers rewrites the text and keeps, for every character it
writes, the range of source characters that it stands for. (1) Letters that look like ASCII ones (Cyrillic, Greek, full
width, mathematical), decimal digits of other scripts, dashes, spaces and dots become ASCII; invisible characters vanish.
(2) ``[at]``, ``(dot)`` and the like, and ``name at host dot com`` (with a well-known or a country's last label), become ``@`` and ``.``. (3) Four or
more spelled digits in a row, or fewer next to numerals or a plus, become digits, with ``plus`` before and ``dot`` between, also
between numerals. Each is tried wherever its own pattern can occur. The same patterns are then run over the result, and
what they find is mapped back to source characters. Found ranges that lie in no base range of their kind are added, also
where they overlap one (a partly disguised identifier); base ranges always stay. A text in which no transducer changes anything has its base ranges only.

Offsets are code points, ends exclusive. Scale: one pass over Arrow batches without a shuffle; work is linear in the text.

Defined cases: null text counts as empty (no ranges); rows repeated, null ids and other columns change nothing; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import small_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, place in KINDS, end

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _HOST.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    if any(d in text for d in "0123456789"):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                    out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _look_alikes() -> dict[str, str]:
    """Character -> ASCII character, or nothing for invisible ones."""
    #: Letters of other scripts that look like ASCII letters, pair by pair.
    pairs = "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS οo αa νv ιi ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
    out = {p[0]: p[1] for p in pairs.split()}
    for c in map(chr, [*range(0x80, 0xD800), *range(0xF900, 0x20000)]):
        if (d := unicodedata.decimal(c, None)) is not None:
            out[c] = str(d)
        elif unicodedata.category(c) == "Zs":
            out[c] = " "
        elif unicodedata.category(c) == "Pd":
            out[c] = "-"
        elif "！" <= c <= "～" or "\U0001d400" <= c <= "\U0001d7ff" or "﹐" <= c <= "﹫":
            n = unicodedata.normalize("NFKC", c)
            if len(n) == 1 and n.isascii():
                out[c] = n
    return out | {c: "" for c in "­​‌‍⁠﻿"} | {"․": ".", "。": ".", "−": "-"}


_ALIKE = _look_alikes()
#: All that is neither ASCII nor a Latin letter with an accent.
_FOREIGN = re.compile("[^\x00-\x7f\xc0-\u024f]")
_AT = re.compile(r"(?:\[\s*(?:at|@)\s*\]|\(\s*(?:at|@)\s*\)|\{\s*(?:at|@)\s*\}|<\s*(?:at|@)\s*>)", re.I)
_DOT = re.compile(r"(?:\[\s*(?:dot|\.)\s*\]|\(\s*(?:dot|\.)\s*\)|\{\s*(?:dot|\.)\s*\}|<\s*(?:dot|\.)\s*>)", re.I)
#: Last labels that end an address whose ``at`` or ``dot`` are plain words: generic ones and all of countries.
_ENDS = (
    "com org net edu gov mil int arpa info biz name pro aero coop museum jobs mobi travel tel cat asia post xxx app dev online site store tech xyz blog cloud shop club email page wiki news live agency digital "
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu "
    "fi fj fk fm fo fr ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly "
    "ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl sm sn so sr ss st su sv sx sy sz "
    "tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw"
)
#: Names with at most 64 characters, so that the search stays linear.
_WORDS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(\s+at\s+|@)[A-Za-z0-9-]{1,64}+(?:(?:\s+dot\s+|\.)[A-Za-z0-9-]{1,64}+)*(?:\s+dot\s+|\.)(?:" + _ENDS.replace(" ", "|") + r")(?![A-Za-z0-9-])", re.I)
_WORD_AT, _WORD_DOT = re.compile(r"\s+at\s+", re.I), re.compile(r"\s+dot\s+", re.I)
_SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_ONE = "(?:" + "|".join(_SPELLED) + ")"
_ITEM = rf"(?:{_ONE}(?![A-Za-z0-9])|[0-9]++(?![A-Za-z]))"
#: Spelled digits and numerals in a row.
_RUN = re.compile(rf"(?<![A-Za-z0-9])(?:plus[\s(-]+)?{_ITEM}(?:(?:[\s,()-]++(?:dot[\s,-]++)?|\.){_ITEM})*+", re.I)
_SPELLED_WORD = re.compile(rf"[^a-z0-9]{_ONE}(?![a-z0-9])")
_TOKEN = re.compile("plus|dot|[0-9]+|" + "|".join(_SPELLED), re.I)
_NUMERAL_DOT = re.compile(r"[0-9]\s+dot\s")


class Mapped:
    """A rewritten text; character ``i`` stands for the source characters ``start[i]`` to ``end[i]``."""

    def __init__(self, text: str) -> None:
        self.text, self.start, self.end = text, range(len(text)), range(1, len(text) + 1)

    def write(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace disjoint ranges, given in order. What replaces a range stands for all of it."""
        if not edits:
            return
        text, start, end, last = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[last:a], new]
            start += [*self.start[last:a], *[self.start[a]] * len(new)]
            end += [*self.end[last:a], *[self.end[b - 1]] * len(new)]
            last = b
        self.text = "".join([*text, self.text[last:]])
        self.start, self.end = [*start, *self.start[last:]], [*end, *self.end[last:]]


def _bracketed(pattern: re.Pattern, text: str, new: str) -> list[tuple[int, int, str]]:
    """Each match, with the blanks around it, becomes ``new``."""
    out, last = [], 0
    for m in pattern.finditer(text):
        a, b = m.span()
        while a > last and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        out.append((a, b, new))
        last = b
    return out


def _spelled(m: re.Match) -> list[tuple[int, int, str]]:
    """Each spelled word of a run becomes its character; what separates spelled words vanishes, and what surrounds ``dot`` or
    follows ``plus``. Numerals stay, with what separates them. A run without numerals or plus needs four spelled digits."""
    tokens = [(m.start() + t.start(), m.start() + t.end(), t[0].lower()) for t in _TOKEN.finditer(m[0])]
    words = sum(w in _SPELLED for _, _, w in tokens)
    numerals = any(w[0].isdecimal() for _, _, w in tokens)
    plus = tokens[0][2] == "plus" or m.string[m.start() - 1 : m.start()] == "+"
    if not (words >= 4 or words and (numerals or plus) or any(w == "dot" for _, _, w in tokens) and numerals or tokens[0][2] == "plus"):
        return []
    out, before, last = [], "", m.start()
    for a, b, word in tokens:
        between = m.string[last:a]
        joined = "dot" in (word, before) or before in _SPELLED and word in _SPELLED
        if between and (before == "plus" and "(" not in between or joined and not set(between) & set("().")):
            out.append((last, a, ""))
        if not word[0].isdecimal():
            out.append((a, b, "+" if word == "plus" else "." if word == "dot" else _SPELLED[word]))
        before, last = word, b
    return out


def deobfuscated(text: str) -> Mapped | None:
    """The rewritten text, or nothing when no transducer changes it."""
    out = Mapped(text)
    if not text.isascii():
        out.write([(m.start(), m.end(), _ALIKE[m[0]]) for m in _FOREIGN.finditer(out.text) if m[0] in _ALIKE])
    low = out.text.lower()
    if any(c in low for c in "[({<"):
        if "at" in low or "@" in low:
            out.write(_bracketed(_AT, out.text, "@"))
        if "dot" in low or "." in low:
            out.write(_bracketed(_DOT, out.text, "."))
    if "at" in low or "dot" in low and "@" in out.text:
        edits = []
        for m in _WORDS.finditer(out.text):
            a = m.start(1)
            edits += [(a, m.end(1), "@")] if m[1] != "@" else []
            edits += [(d.start(), d.end(), ".") for d in _WORD_DOT.finditer(out.text, m.end(1), m.end())]
        out.write(edits)
    if any(w in low for w in _SPELLED) and _SPELLED_WORD.search(f" {low} ") or "dot" in low and _NUMERAL_DOT.search(low) or "plus" in low:
        out.write([e for m in _RUN.finditer(out.text) for e in _spelled(m)])
    return out if out.text != text else None


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base ranges, and base and added ranges."""
    base = base_spans(text)
    new = deobfuscated(text)
    if new is None:
        return base, base
    own = [[(s, e) for s, k, e in base if k == kind] for kind in range(len(KINDS))]  # disjoint and in order
    more: list[Span] = []
    last = [(0, 0)] * len(KINDS)
    for a, kind, b in base_spans(new.text):
        start, end = new.start[a], new.end[b - 1]
        i = bisect_right(own[kind], (start, len(text) + 1)) - 1
        if not (i >= 0 and end <= own[kind][i][1] or last[kind][0] <= start and end <= last[kind][1]):
            more.append((start, kind, end))
            last[kind] = (start, end)
    return base, sorted([*base, *more])


def _said(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base ranges' numbers ``n_email, n_ip, n_card, n_phone`` and
    ``base_sha256``, ``spans`` (all ranges, ``kind:start:end``), and ``n_added``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for b in batches:
            found = [all_spans(t or "") for t in b.column("text").to_pylist()]
            numbers = [pa.array([sum(k == i for _, k, _ in base) for base, _ in found], pa.int64()) for i in range(len(KINDS))]
            sha = pa.array([hashlib.sha256(_said(base).encode()).hexdigest() for base, _ in found], pa.string())
            spans = pa.array([_said(every) for _, every in found], pa.string())
            added = pa.array([len(every) - len(base) for base, every in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *numbers, sha, spans, added], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_added long"
    return rows.mapInArrow(run, schema)
