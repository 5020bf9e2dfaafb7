"""Line-first quality cleaning.

Each line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed; a document that loses more than ``max_loss`` percent of its
words to them is rejected. Documents also pass two whole-text checks first
(too few words, too many words inside repeated five-word windows).

Defined results: a null or empty text has no words, so it fails the minimum
and is rejected; rows are judged one by one, so repeated rows and ties get
equal results; lines without a word are kept as they are and count nowhere; an
empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from mdmspark.llm.common import map_arrow, slices

# Phrases of licence, legal and site lines, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "gnu general public license",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "enable javascript",
    "subscribe to our newsletter",
    "click here",
    "lorem ipsum",
)
# Words that stand alone between the entries of a menu or trail.
SEPARATORS = ("|", ">", "»", "›", "·", "•", "/", "::")
SYMBOLS = "#*$%&|<>"
# Marks that end a sentence or close one: Latin and general, Arabic,
# Devanagari, Armenian, Ethiopic, Burmese, Khmer, Tibetan, East Asian (wide, half wide).
TERMINAL = ".!?…:;\"')”’»" + "؟۔؛" + "।॥" + "։՞՜" + "።፧፨" + "၊။" + "។៕" + "།༎" + "。！？：；」』）】》〉﹒﹖﹗｡｣"
# Scripts that put no blanks between words.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")


@dataclass(frozen=True)
class Rules:
    """Thresholds; shares are whole percents."""

    min_words: int = 10
    max_repeat: int = 20
    max_symbols: int = 10  # symbols per characters in words
    min_separators: int = 20  # separators per words, from two separators on
    min_shouts: int = 30  # "!!" per words, from three on
    boilerplate_words: int = 40  # a longer line is prose that mentions a phrase
    stub_words: int = 3  # a shorter line needs a terminal mark
    unspaced_letters: int = 2  # letters of scripts without blanks that count as a word
    max_loss: int = 40  # words in removed lines; a short clean text with one licence line stays


_UNSPACED = regex.compile("[" + "".join(rf"\p{{{s}}}" for s in UNSPACED) + "]")
_ALNUM = regex.compile(r"[\p{L}\p{N}]")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_SEPARATORS = frozenset(s.encode() for s in SEPARATORS)
_SPACES = " \t\n\v\f\r"


def line_fails(line: str, words: list[bytes], rules: Rules = Rules()) -> str | None:
    """The first rule that a line (``words``: its words, at least one) breaks:
    ``symbols``, ``no_letters``, ``shout`` (punctuation), ``separators``,
    ``stub`` (navigation), ``boilerplate``; None if it passes."""
    n = len(words)
    symbols = sum(map(line.count, SYMBOLS))
    if symbols and 100 * symbols > rules.max_symbols * _word_chars(line):
        return "symbols"
    if not _ALNUM.search(line):
        return "no_letters"
    shouts = line.count("!!")
    if shouts >= 3 and 100 * shouts >= rules.min_shouts * n:
        return "shout"
    marks = sum(map(words.count, _SEPARATORS)) if any(map(line.__contains__, SEPARATORS)) else 0
    if marks >= 2 and 100 * marks >= rules.min_separators * n:
        return "separators"
    if n < rules.stub_words and words[-1].decode("utf-8", "surrogatepass")[-1] not in TERMINAL:
        if line.isascii() or n + len(_UNSPACED.findall(line)) // rules.unspaced_letters < rules.stub_words:
            return "stub"
    if n <= rules.boilerplate_words:
        low = line.translate(_LOWER)
        if any(p in low for p in BOILERPLATE):
            return "boilerplate"
    return None


def _word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, _SPACES))


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows whose words occur at two or more places."""
    n = len(words) - 4
    if n < 2:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    mixed = at[:n].astype(np.uint64)
    for k in range(1, 5):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + at[k : n + k].astype(np.uint64)
    mixed.sort()
    if (mixed[1:] != mixed[:-1]).all():  # equal windows have equal sums, so there are none
        return 0
    # A window's number from the numbers of its parts: exact, whatever the words.
    two = _number(at[:-1], at[1:])
    four = _number(two[:-2], two[2:])
    five = _number(four[:-1], at[4:])
    again = np.bincount(five)[five] > 1
    steps = np.zeros(len(words) + 1, np.int64)
    where = np.flatnonzero(again)
    np.add.at(steps, where, 1)
    np.add.at(steps, where + 5, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def _number(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def judge(text: str | None, rules: Rules = Rules()) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_bad_lines, n_lost_words, kept, cleaned text)."""
    text = text or ""
    words, seen, dup, bad, lost, passed = [], set(), 0, 0, 0, []
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if own:
            words += own
            dup += line in seen
            seen.add(line)
            if line_fails(line, own, rules):
                bad, lost = bad + 1, lost + len(own)
                continue
        passed.append(line)
    repeat = repeated_words(words)
    failed = len(words) < rules.min_words or 100 * repeat > rules.max_repeat * len(words)
    kept = not failed and 100 * lost <= rules.max_loss * len(words)
    return (len(words), _word_chars(text), sum(map(text.count, SYMBOLS)), dup, repeat, failed, bad, lost, kept, "\n".join(passed) if bad else text)


_MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
             "n_bad_lines long, n_lost_words long, kept boolean")


def clean_lines(docs: DataFrame, *, with_text: bool = False, rules: Rules = Rules()) -> DataFrame:
    """The verdict on every row of ``docs`` (doc_id, text): doc_id, the
    measures of :func:`judge` and, on request, ``clean_text`` (null for a null
    text). One narrow pass, no shuffle."""
    names = ["doc_id", *re.findall(r"(\w+) (?:long|boolean)", _MEASURES), *(["clean_text"] if with_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            cols = list(zip(*(judge(t, rules) for t in texts)))
            arrays = [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.bool_()),
                      *(pa.array(c, pa.int64()) for c in cols[6:8]), pa.array(cols[8], pa.bool_())]
            if with_text:
                arrays.append(pa.array([None if t is None else c for t, c in zip(texts, cols[9])], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, {_MEASURES}" + (", clean_text string" if with_text else "")
    return map_arrow(docs.select("doc_id", "text"), run, schema)


def keep_clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that stay, their texts without the failing lines
    and, where there is one, ``n_chars`` set to the new length. All columns
    stay, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            verdicts = [judge(t, rules) for t in b.column("text").to_pylist()]
            b = b.set_column(b.schema.get_field_index("text"), "text", pa.array([v[9] for v in verdicts], pa.string()))
            if "n_chars" in b.schema.names:
                i = b.schema.get_field_index("n_chars")
                b = b.set_column(i, "n_chars", pa.array([len(v[9]) for v in verdicts]).cast(b.schema.field(i).type))
            yield b.filter(pa.array([v[8] for v in verdicts], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
