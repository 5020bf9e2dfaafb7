"""Packing by power-of-two decomposition.

A document of n tokens is cut into whole sequences of the maximum length and,
for the rest, one piece for each bit of its binary length, longest first. Each
piece has a power-of-two length and is a sequence of its own, so no sequence
crosses documents and none needs padding; sequences of equal length stand
together (a bucket), ready to be batched.

Tokens are the tokenizer's ids and then one end id. Defined results: a null or
empty text has the end id alone, one piece of length 1; repeated rows give
pieces of their own; an empty table gives no pieces.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdmspark.llm.common import map_arrow, materialize, running_totals, slices

MAX_LENGTH = 2048
END_ID = 1
# Words whose ids a Python worker remembers, in each of two generations.
MEMORY = 400_000


def piece_lengths(n: int, most: int = MAX_LENGTH) -> list[int]:
    """``n`` as multiples of ``most`` (a power of two) and then its binary parts, falling."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if rest >> b & 1]


class WordIds(dict):
    """Ids of texts by a tokenizer that cuts at white space and drops it: a
    text's ids are those of its words, one after the other. Maps a word in
    lower case to its ids and remembers the last words it saw (two generations
    of ``memory`` words at most). Texts for which that may not hold word by
    word (special tokens, composed letters, case that depends on the place) go
    to the tokenizer whole."""

    def __init__(self, path: str, memory: int = MEMORY) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model, self.memory, self.old = self.tokenizer.model, memory, {}

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        low = text.lower()
        if "<|" in text or "Σ" in text or not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)):
            return self._whole(text)
        if len(self) > self.memory:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, low.replace("\n", " ").split(" ")))

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            # Letters and the marks behind them are tokens of their own.
            head = word.rstrip(_MARKS)
            if not head.isalpha():
                ids = self._whole(word)
            elif head == word:
                ids = self._letters(word)
            else:
                ids = self[head] + self[word[len(head) :]]
        self[word] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a run of lower-case letters: one token for the tokenizer's
        first steps, so its merges are all that is left to do."""
        if not word.isascii():
            word = "".join(map(_BYTE_LETTERS.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()


# Marks that end a run of letters and are no white space, letter or digit; the
# apostrophe, which can begin a token of letters, is not among them.
_MARKS = ".,!?;:*$%&#|<>()[]{}/=+-_~^@\"\\"


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if it is printable in Latin-1, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()
_ENCODERS: dict[str, WordIds] = {}


def cut_pieces(docs: DataFrame, tokenizer: str, *, most: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of every row of ``docs`` (doc_id, text): doc_id,
    start, length, ids_crc32, doc_tokens and, on request, ``ids``; also the
    task that cut it (``part``) and how many pieces of its length the task had
    cut before (``nth``). Narrow."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth", "part", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, WordIds(tokenizer))
        end, part, cut = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), {}
        for b in slices(batches, limit=1 << 20):
            keys, rows, ids = [], [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                raw, at = encoder.encode(text or "") + end, 0
                view, n = memoryview(raw), len(raw) // 4
                for size in piece_lengths(n, most):
                    piece = view[4 * at : 4 * (at + size)]
                    keys.append(k)
                    rows.append((at, size, zlib.crc32(piece), n, nth := cut.get(size, 0)))
                    cut[size] = nth + 1
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
                    at += size
            cols = np.array(rows, np.int64).reshape(-1, 5)
            arrays = [b.column("doc_id").take(pa.array(keys, pa.int64())), *(pa.array(cols[:, i]) for i in range(5)), pa.array(np.full(len(cols), part, np.int32))]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, nth long, part int" + (", ids array<int>" if with_ids else "")
    return map_arrow(docs.select("doc_id", "text"), run, schema)


def pack(docs: DataFrame, tokenizer: str, *, most: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of :func:`cut_pieces` as sequences: ``sequence_id`` counts
    them from 0, longest bucket first; ``offset`` is 0, as each sequence holds
    one piece; ``bucket_index`` counts within the bucket of equal lengths.

    The pieces are written once. A bucket's sequences are numbered task by
    task, so all that is added up is how many pieces of a length each task cut:
    at most (number of tasks) x (number of lengths) rows. Pieces stay where they
    are; Spark broadcasts those rows below its threshold."""
    pieces = materialize(cut_pieces(docs, tokenizer, most=most, end_id=end_id, with_ids=with_ids), "pieces")
    shares = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_pieces")).withColumn("_rank", -F.col("length"))
    starts = materialize(running_totals(shares, ["_rank", "part"], {"_start": "_pieces"}, "packing"), "packing-starts")
    firsts = starts.groupBy("length").agg(F.min("_start").alias("_first"))  # one row per power of two
    starts = materialize(starts.join(F.broadcast(firsts), "length").select("length", "part", "_start", "_first"), "packing-offsets")
    out = pieces.join(starts, ["length", "part"])
    kept = [c for c in pieces.columns if c not in ("nth", "part")]
    return out.select(*kept, (F.col("_start") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                      (F.col("_start") + F.col("nth") - F.col("_first")).alias("bucket_index"))
