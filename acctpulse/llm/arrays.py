"""Text as byte arrays inside tasks: words, shingles and their hashes, without a loop over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; one longer text is handled alone.
BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C55)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each row begins; a null row is empty."""
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes together."""
    offsets = utf8(batch.column(column))[1]
    start = 0
    while start < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = max(start + 1, end)
        yield batch.slice(start, end - start)
        start = end


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each piece of ``data``: a polynomial, by differences of one running sum."""
    n = len(data)
    if n == 0 or len(start) == 0:
        return np.zeros(0, np.uint64)
    power, back = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    return mix((total[end] - total[start]) * back[start])


KNOWN_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least; kept for a task's next blocks."""
    if not KNOWN_POWERS or len(KNOWN_POWERS[0]) < n:
        both = [np.full(max(n, 2 * BLOCK), b, np.uint64) for b in (BASE, INVERSE)]
        for table in both:
            table[0] = 1
            np.cumprod(table, out=table)
        KNOWN_POWERS[:] = both
    return KNOWN_POWERS


def word_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each byte: its form with A-Z lower-cased, and whether words hold it.

    Words are runs of a-z, 0-9 and characters beyond ASCII.
    """
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    return low, inside


class Words:
    """Words of some texts: ``start`` and ``end`` in ``data``, ``doc`` and ``hash`` of each.

    ``first`` has, per text, its first word's place, and one more for the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low, inside = word_tables()
        self.data = low[data]
        n = len(data)
        flag = np.zeros(n + 2, bool)
        flag[1:-1] = inside[self.data]
        starts = flag[1:-1] & ~flag[:-2]
        ends = flag[1:-1] & ~flag[2:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        starts[edges] = flag[1:-1][edges]
        ends[edges - 1] = flag[1:-1][edges - 1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = hashes(self.data, self.start, self.end)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first word of each run of ``k`` words within a text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), none, none
        h = np.full(n, np.uint64(k), np.uint64)
        for j in range(k):
            h = h * BASE + self.hash[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return mix(h[at]), self.doc[at], at

    def text(self, first: int, last: int) -> str:
        """Words ``first`` up to ``last``, not included, in lower case, one space between."""
        raw, at = self.data, zip(self.start[first:last], self.end[first:last], strict=True)
        return b" ".join(raw[s:e].tobytes() for s, e in at).decode("utf-8", "replace")
