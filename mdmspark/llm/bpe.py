"""Byte-level BPE as a tree reduction.

A text is cut into matches of a pattern, and each match is encoded on its own
(a match that is a token as a whole is that token). A match is cut in halves
until these are short, the short ones are encoded by merging the adjacent pair
of lowest rank first, and neighbours are then joined up the tree.

*Joining.* The encodings of two neighbours are joined by encoding again the
bytes of a window of tokens around their boundary. Call two adjacent tokens
fast if their bytes, encoded alone, give these two tokens. A merge depends on
nothing but the two parts that it joins and the order of ranks and places, so
no merge ever crosses the boundary of fast tokens: a sequence of tokens is the
encoding of its bytes exactly if all its neighbours are fast. An encoding of a
window has fast neighbours. So if the window's first token is the one that was
there before, its neighbour outside is fast with it as before, likewise at the
window's other end, and nothing outside can change. Else the window grows to
twice as many tokens on the side that failed, at most to the whole side.

*Decoding* joins the bytes of the ids, a stretch at a time.

Defined results: a null or empty text has no ids, and empty bytes when decoded;
rows are independent, so repeated rows get equal results; ids outside the
vocabulary, or a null or ragged sequence of ids, decode to null; an empty table
gives an empty result. A text is held whole by one task, as are its ids, and is
matched a stretch at a time.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from mdmspark.llm.common import map_arrow, slices

# Bytes that are encoded without being halved.
LEAF = 16
# Matches whose ids a Python worker remembers, in each of two generations, and the longest of them (code points).
MEMORY, LONGEST = 400_000, 64
# Code points that are matched at a time, and ids that are decoded at a time.
STRETCH = 1 << 16
# Bytes from which on a window is merged with a heap.
HEAP = 96
# Above all ranks: the pair is no token.
NONE = 1 << 62


class Encoder(dict):
    """Maps a match to its packed ids and remembers the last ones it saw."""

    def __init__(self, path: str, pattern: str, memory: int = MEMORY) -> None:
        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"{path}: no token for the bytes {missing}")
        self.pattern, self.memory, self.old = regex.compile(pattern), memory, {}

    # -- one match ------------------------------------------------------------

    def merge(self, piece: bytes) -> list[int]:
        """Ids of ``piece`` by merging the pair of lowest rank, the leftmost of equals, until none is a token."""
        if len(piece) > HEAP:
            return self._merge_by_heap(piece)
        get, parts = self.ranks.get, [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], NONE) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) != NONE:
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], NONE)
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], NONE)
        return [self.ranks[p] for p in parts]

    def _merge_by_heap(self, piece: bytes) -> list[int]:
        """The same in n log n steps: parts are stretches of ``piece``, open
        pairs lie in a heap by (rank, start); entries that a merge has made
        stale are passed over."""
        n, get = len(piece), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            middle = end[i]
            if middle <= 0 or middle >= n or end[middle] != to:
                continue  # one of its parts has grown, or is part of another
            end[i], end[middle] = to, 0
            if to < n:
                before[to] = i
                if (r := get(piece[i : end[to]])) is not None:
                    heapq.heappush(heap, (r, i, end[to]))
            if (j := before[i]) >= 0 and (r := get(piece[j:to])) is not None:
                heapq.heappush(heap, (r, j, to))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of the bytes of ``left`` and ``right``, both encodings."""
        if not left or not right:
            return left or right
        a = b = 1
        while True:
            window = left[-a:] + right[:b]
            again = self.merge(b"".join(map(self.bytes_of.__getitem__, window)))
            left_holds = a >= len(left) or again[0] == window[0]
            right_holds = b >= len(right) or again[-1] == window[-1]
            if left_holds and right_holds:
                return left[:-a] + again + right[b:]
            a, b = a if left_holds else 2 * a, b if right_holds else 2 * b

    def reduce(self, piece: bytes) -> list[int]:
        """Ids of ``piece`` up the tree; the left half has a power of two times ``LEAF`` bytes."""
        if len(piece) <= LEAF:
            return self.merge(piece)
        cut = LEAF << (((len(piece) - 1) // LEAF).bit_length() - 1)
        return self.join(self.reduce(piece[:cut]), self.reduce(piece[cut:]))

    def __missing__(self, match: str) -> bytes:
        packed = self.old.get(match)
        if packed is None:
            piece = match.encode()
            whole = self.ranks.get(piece)
            packed = array("I", [whole] if whole is not None else self.reduce(piece)).tobytes()
        if len(match) <= LONGEST:
            self[match] = packed
        return packed

    # -- texts ----------------------------------------------------------------

    def encode(self, text: str) -> bytes:
        """Ids of the text, packed as little-endian unsigned 32-bit integers."""
        if len(self) > self.memory:
            self.old = dict(self)
            self.clear()
        return b"".join(b"".join(map(self.__getitem__, self.pattern.findall(part))) for part in stretches(text))

    def decode(self, packed: bytes) -> bytes | None:
        """The bytes of packed ids; null if one is no token."""
        ids = np.frombuffer(packed, "<u4") if len(packed) % 4 == 0 else None
        if ids is None or not all(map(self.bytes_of.__contains__, np.unique(ids).tolist())):
            return None
        return b"".join(b"".join(map(self.bytes_of.__getitem__, ids[i : i + STRETCH].tolist())) for i in range(0, len(ids), STRETCH))


# No match of the usual patterns reaches from a character over a blank behind
# it, and none looks back, so matches begin anew there.
_CUT = regex.compile(r"(?<=\S) ")


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """``text`` in parts of about ``size`` code points, cut where every match ends."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    return _ENCODERS.get((path, pattern)) or _ENCODERS.setdefault((path, pattern), Encoder(path, pattern))


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ``ids`` (packed little-endian unsigned 32-bit
    integers) of every row of ``docs`` (doc_id, text), by the rank file
    ``ranks``; matches of ``pattern`` must end before a blank that stands
    behind anything but white space. One narrow pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        for b in slices(batches, limit=1 << 20):
            ids = [encoder.encode(t or "") for t in b.column("text").to_pylist()]
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), sizes, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {key}, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` (with packed ``ids``) with ``decoded``, the bytes of its ids. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        for b in slices(batches, "ids", 1 << 20):
            whole = [None if x is None else encoder.decode(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(whole, pa.binary())], names=[*b.schema.names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "decoded")
    return map_arrow(encoded.drop("decoded"), run, f"{kinds}, decoded binary")
