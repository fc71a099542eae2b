"""Vectorised scanning of text columns: words, lines and windows of whole Arrow batches.

A chunk of documents is one byte buffer plus offsets. Words, lines and n-gram windows are found for all documents
of the chunk at once with numpy, and spans are named by 64-bit polynomial hashes (equal bytes, equal hash). All
functions take whole texts; a document larger than ``CHUNK_BYTES`` simply forms a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)

#: White space of the contracts: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words between white space, and words of letters and digits.
PLAIN_WORD = ~SPACE
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_random = np.random.default_rng(20240613).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
EXACT_TABLE, LOWER_TABLE = _random, _random[LOWER]

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base ** i (mod 2**64) for i < n at least."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 65536), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Chunk:
    """Documents ``rows`` of a batch: bytes ``buf`` with document i at ``offs[i]:offs[i + 1]``."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, rows: slice):
        self.buf, self.offs, self.rows, self.n = buf, offs, rows, len(offs) - 1
        self._sums: dict[int, np.ndarray] = {}

    def text(self, i: int) -> bytes:
        return self.buf[self.offs[i] : self.offs[i + 1]].tobytes()

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of the bytes in table ``inside``: starts, ends, and for each document its first run."""
        ok = inside[self.buf]
        before = np.empty(len(ok) + 1, bool)
        before[0], before[1:] = False, ok
        edges = self.offs[1:-1]
        first = ok & ~before[:-1]
        cut = edges[edges < len(ok)]
        first[cut] = ok[cut]
        last = ok.copy()
        last[:-1] &= ~ok[1:]
        cut = cut[cut > 0] - 1
        last[cut] = ok[cut]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.offs)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parts between line feeds, empty ones too: starts, ends, first line of each document."""
        feeds = np.flatnonzero(self.buf == 10)
        starts = np.sort(np.concatenate([self.offs[:-1], feeds + 1]), kind="stable")
        ends = np.sort(np.concatenate([feeds, self.offs[1:]]), kind="stable")
        per = np.searchsorted(feeds, self.offs)
        return starts, ends, per + np.arange(self.n + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = EXACT_TABLE) -> np.ndarray:
        """64-bit hashes of spans; equal bytes have equal hashes wherever they stand."""
        key = id(table)
        if key not in self._sums:
            sums = np.zeros(len(self.buf) + 1, np.uint64)
            np.cumsum(table[self.buf] * _power("up", _BASE, len(self.buf)), out=sums[1:])
            self._sums[key] = sums
        sums = self._sums[key]
        down = _power("down", _INV, len(self.buf) + 1)
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * U(0xC2B2AE3D27D4EB4F))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k neighbours h[i:i + k], len(h) - k + 1 of them (none if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = h[:n].copy()
    for j in range(1, k):
        out *= U(0x9FB21C651E98DF25)
        out ^= out >> U(29)
        out += h[j : j + n]
    return mix(out)


def starts_of_windows(first: np.ndarray, k: int) -> np.ndarray:
    """Which of the word positions start k words of one document; ``first``: first word of each document."""
    ok = np.ones(first[-1], bool)
    for j in range(1, k):
        cut = first[1:] - j
        cut = cut[cut >= first[:-1]]
        ok[cut] = False
    return ok


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column in chunks of about ``limit`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
        if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
            column = column.cast(pa.string())
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield Chunk(data[offs[at] : offs[to]], offs[at : to + 1] - offs[at], slice(at, to))
        at = to


def per_chunk(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    """(the batch's rows, their texts) for batches with a column ``text``."""
    for batch in batches:
        for chunk in chunks(batch.column("text"), limit):
            yield batch.slice(chunk.rows.start, chunk.n), chunk
