"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs,
digits, plus signs, schemes and identifier cues. Around each anchor a small
deterministic parser expands to the candidate's boundaries and validates it.

Kinds that every text is searched for: ``email``, ``ip``, ``card``, ``phone``
(leftmost, not overlapping within a kind). The method adds ``address`` (after
a scheme: a network address that names a user or a numeric host, or a phone
address) and ``account`` (after an identifier cue, on its own or in a longer name
such as ``aws_secret_access_key``: a token, key, password, account or document
number; or an ``@name`` handle). A cue and its value may have a sign, the word
"is" or blanks between them, and quotes around the value. A value needs six
characters and a digit; a password that is set by ``:`` or ``=`` needs no digit.

Offsets are code points, ends exclusive. Defined results: a null or empty text
has no spans; rows are independent, so repeated rows get equal results; an
empty table gives an empty result. Runs of any length are parsed in time linear
in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from mdmspark.llm.common import map_arrow, slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")

# Words in front of an identifier, in lower case; a blank stands for ``-`` and ``_``, too.
CUES = ("account", "acct", "api key", "apikey", "bearer", "iban", "passport", "password", "passwd", "pwd", "secret", "ssn", "tax id", "token")
# Those of them behind which any value counts, with or without a digit, if it is set by a sign.
PASSWORDS = ("password", "passwd", "pwd")
# Schemes in front of an address.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://", "mailto:", "tel:", "sip:")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_GROUP = re.compile(r"[0-9]+")
_SPACED = re.compile(r"[0-9 -]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Each stops where another scheme of its kind could begin (at the slashes, or
# the colon), so text is scanned once however many schemes stand in a row.
_AUTHORITY = re.compile(r"[^\s\"'<>`/?#]+")
_TELEPHONE = re.compile(r"[0-9+().-]+")
_SIP = re.compile(r"[^\s\"'<>`/?#:]+")
_NUMERIC_HOST = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?")
_IBAN = re.compile(r"[ \t]*(?:(?:number|no\.?|is|[:=#])[ \t]*){0,3}[\"']?([A-Za-z]{2}[0-9]{2})", re.IGNORECASE)
_IBAN_GROUP = re.compile(r" ?[A-Za-z0-9]{1,31}")
# What may stand between a cue and its value: more words of a longer name, then a sign, "is" or blanks.
_NAME = re.compile(r"(?:[ _-]?(?:access|auth|client|key|secret|number|no\.|no|nr|id|code|value)(?![A-Za-z0-9])){0,4}", re.IGNORECASE)
_SIGN = re.compile(r"[\"']?[ \t]*(?:[:=#]+>?|->|is\b)[ \t]*", re.IGNORECASE)
_BLANKS = re.compile(r"[ \t]+")
_NUMBERS = re.compile(r"[0-9]+(?:[ -][0-9]+)+(?![A-Za-z0-9])")
_VALUE = re.compile(r"[^\s\"'<>`,;]+")
_QUOTED = {q: re.compile(rf"[^{q}\n]*(?={q})") for q in ('"', "'")}
_WORD = re.compile(r"[^\s\"'<>`]+")
_HANDLE = re.compile(r"[A-Za-z][A-Za-z0-9_]{2,}+(?!@|\.[A-Za-z0-9_])")
_LEAST_VALUE = 6
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    a.add_word("+", ("+", 1))
    for d in "0123456789":
        a.add_word(d, ("d", 1))
    for s in SCHEMES:
        a.add_word(s, ("address", len(s)))
    for c in CUES:
        for form in {c.replace(" ", j) for j in " -_"}:
            a.add_word(form, ("account", len(form)))
    a.make_automaton()
    return a


_ANCHORS: list[ahocorasick.Automaton] = []


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in the order of :data:`KINDS`, then of start."""
    if not text:
        return []
    if not _ANCHORS:
        _ANCHORS.append(_automaton())
    low = text.lower()
    if len(low) != len(text):  # some letters grow when lower-cased; offsets must not move
        low = text.translate(_LOWER)
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)  # where the last candidate of a kind ended
    ats: list[int] = []
    bare = [0]  # up to where the last run behind a cue, which had no digit, went
    for last, (kind, size) in _ANCHORS[0].iter(low):
        start, end = last + 1 - size, last + 1
        if kind == "d":
            if start >= done["ip"]:
                done["ip"] = _dotted(text, start, found["ip"])
            if start >= done["card"]:
                done["card"] = _spaced(text, start, found["card"])
        elif kind == "@":
            if span := _email(text, start, done["email"]):
                found["email"].append(span)
                done["email"] = span[1]
            else:
                ats.append(start)
        elif kind == "+":
            if m := _PHONE.match(text, start):
                if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                    found["phone"].append(m.span())
        elif start >= done[kind]:
            if span := _address(text, start, end) if kind == "address" else _account(text, start, end, bare):
                found[kind].append(span)
                done[kind] = span[1]
    handles = [s for s in (_handle(text, at) for at in ats) if s]
    found["account"] = sorted({*found["account"], *handles})
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Left over the local part (not into the match before), right over the domain."""
    start = at
    while start > floor and text[start - 1] in _LOCAL_CHARS:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def _dotted(text: str, start: int, out: list[tuple[int, int]]) -> int:
    """Numeric addresses in the run of digits and dots from ``start``: four
    groups joined by single dots, taken from the left; where the run ends."""
    run = _DOTTED.match(text, start)
    if run.group().count(".") >= 3:
        groups = [m.span() for m in _GROUP.finditer(text, start, run.end())]
        i = 0
        while i + 3 < len(groups):
            gaps = [groups[j + 1][0] - groups[j][1] for j in range(i, i + 3)]
            if gaps == [1, 1, 1]:
                if all(_octet(text[a:b]) for a, b in groups[i : i + 4]):
                    out.append((groups[i][0], groups[i + 3][1]))
                i += 4
            else:
                i += 1
    return run.end()


def _octet(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) < 3 or (len(p) == 3 and p <= "255")


def _spaced(text: str, start: int, out: list[tuple[int, int]]) -> int:
    """Card numbers in the run of digits, spaces and hyphens from ``start``."""
    run = _SPACED.match(text, start)
    for m in _CARD.finditer(text, start, run.end()):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return run.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def _address(text: str, start: int, end: int) -> tuple[int, int] | None:
    """Scheme and authority, if it names a user or a numeric host; a scheme
    for telephones with a user or at least seven digits. (The address behind
    ``mailto:`` is an email.)"""
    scheme = text[start:end].lower()
    if scheme == "mailto:":
        return None
    m = (_AUTHORITY if scheme[-1] == "/" else _TELEPHONE if scheme == "tel:" else _SIP).match(text, end)
    if not m:
        return None
    found = m.group().rstrip(".,;:!?)]}")
    user, at, host = found.rpartition("@")
    if scheme[-1] != "/":
        held = (at and user and host) or sum("0" <= c <= "9" for c in found) >= 7
    else:
        held = (at and user and host) or _NUMERIC_HOST.fullmatch(host)
    return (start, end + len(found)) if held else None


def _account(text: str, start: int, end: int, bare: list[int]) -> tuple[int, int] | None:
    """The value after a cue that stands as a word or as part of a longer name:
    an international account number that passes its check; groups of digits;
    or a run up to the next blank, comma or quote (of a quoted value: up to the
    closing quote) of at least six characters, one of them a digit. Behind a
    password cue and a sign the run needs no digit and may hold commas."""
    if (start and text[start - 1].isalnum()) or text[end : end + 1].isalnum():
        return None
    cue = text[start:end].lower()
    if cue == "iban":
        m = _IBAN.match(text, end)
        return _iban_span(text, *m.span(1)) if m else None
    at = _NAME.match(text, end).end()
    m = _SIGN.match(text, at) or _BLANKS.match(text, at)
    if not m:
        return None
    at, signed = m.end(), not m.group().isspace()
    free = signed and cue in PASSWORDS and not m.group().strip().lower().endswith("is")
    quote = text[at : at + 1]
    if quote in _QUOTED and quote:
        m = _QUOTED[quote].match(text, at + 1)
        if m and len(m.group()) >= _LEAST_VALUE and (free or _has_digit(m.group())):
            return m.span()
        at += 1
    if m := _NUMBERS.match(text, at):
        if sum("0" <= c <= "9" for c in m.group()) >= _LEAST_VALUE:
            return m.span()
    if not free and at < bare[0]:
        return None  # the same run from a later place on
    m = (_WORD if free else _VALUE).match(text, at)
    value = m.group().rstrip(".,;:!?)]}") if m else ""
    if free or _has_digit(value):
        return (at, at + len(value)) if len(value) >= _LEAST_VALUE else None
    bare[0] = m.end() if m else at
    return None


def _has_digit(text: str) -> bool:
    return any("0" <= c <= "9" for c in text)


def _iban_span(text: str, start: int, end: int) -> tuple[int, int] | None:
    """From the country and check digits on over groups: the longest run of
    whole groups that passes (words in upper case may follow the number)."""
    ends, size = [], 4
    while (m := _IBAN_GROUP.match(text, end)) and size <= 34:
        size += len(m.group().lstrip(" "))
        end = m.end()
        ends.append(end)
    return next(((start, e) for e in reversed(ends) if _iban(text[start:e])), None)


def _iban(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _handle(text: str, at: int) -> tuple[int, int] | None:
    """``@name``, not behind a character of a local part or another at-sign."""
    if at and (text[at - 1] in _LOCAL_CHARS or text[at - 1] in "@/" or text[at - 1].isalnum()):
        return None
    m = _HANDLE.match(text, at + 1)
    return (at, m.end()) if m else None


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; spans
    of several kinds that overlap become one, named after the first."""
    spans = sorted(find_spans(text), key=lambda x: (x[1], -x[2]))
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"<{kind.upper()}>"]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id and ``found``, its
    spans as an array of (kind, start, end). One narrow pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches):
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "found"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {key}, found array<struct<kind:string,start:long,end:long>>")


def redact_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced (see :func:`redact`)
    and, where there is one, ``n_chars`` set to the new length. All rows and
    columns stay; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [redact(t) for t in b.column("text").to_pylist()]
            b = b.set_column(b.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            if "n_chars" in b.schema.names:
                i = b.schema.get_field_index("n_chars")
                sizes = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                b = b.set_column(i, "n_chars", sizes.cast(b.schema.field(i).type))
            yield b

    return map_arrow(docs, run, docs.schema)
