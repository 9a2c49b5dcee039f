"""Words, hashes and line spans of whole Arrow text columns, by array arithmetic on UTF-8 bytes.

Word classes used here are ASCII classes, so they can be decided byte by byte:
every byte of a character beyond ASCII is 128 or more. A batch is cut at row
boundaries into pieces of about ``PIECE`` bytes, so scratch arrays stay small
whatever the batch size; a single longer text is one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
#: For scans that hold many arrays for each byte; results are the same for every size.
SMALL_PIECE = 1 << 18

_BYTES = np.arange(256)
#: Not white space: ``[^\x20\x09-\x0D]``.
SPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
#: Digits, a-z and everything beyond ASCII, after A-Z are lowered.
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

_rng = np.random.default_rng(20_240_229)
_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_ROLL = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        _powers[:] = tables
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Piece:
    """Consecutive texts of a batch: rows first..last, their bytes and row offsets."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8")


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[Piece]:
    """Cut a string column into pieces; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield Piece(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal stretch of bytes in the class; none crosses a row."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = member[data]
    filled = offsets[1:] > offsets[:-1]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[offsets[:-1][filled]] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[offsets[1:][filled] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes in every piece and process."""
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * powers[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive words of one row, and the index of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += hashes[i:i + n] * _ROLL[i % 64] + np.uint64(i)
    at = np.flatnonzero(rows[:n] == rows[k - 1:])
    return mix(total[at]), at


def row_bounds(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """First word index of each row, and the total behind the last."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def text_key(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit digest of each whole text, as a signed number Spark can hold."""
    return span_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)


def list_array(values: np.ndarray | pa.Array, bounds: np.ndarray) -> pa.ListArray:
    """A list column from flat values and row bounds."""
    flat = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)
