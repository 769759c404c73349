"""Vectorised words and hashes over Arrow text columns.

Helpers that run inside tasks.  Texts are cut into pieces of a few megabytes
so that memory does not follow the size of an Arrow batch; a single document
is never cut.  NULL counts as empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240611)).integers(1, 2**63, 256, dtype=np.uint64)
_FACTORS = np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, 16, dtype=np.uint64) | _U(1)


class Words(NamedTuple):
    """``first[d] .. first[d + 1]`` are the words of document ``d``."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> _U(27))
        x = x * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: Bytes hashed together, and the longest word that is hashed with others.
_RUN_BYTES = 1 << 20


@lru_cache(maxsize=1)
def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    def table(base):
        out = np.empty(_RUN_BYTES + 1, np.uint64)
        out[0] = filled = 1
        with np.errstate(over="ignore"):
            while filled < len(out):
                step = min(filled, len(out) - filled)
                out[filled : filled + step] = out[:step] * (out[filled - 1] * base)
                filled += step
        return out

    return table(_BASE), table(_INVERSE)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of text each."""
    if batch.num_rows == 0:
        return
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        upto = max(at + 1, min(upto, batch.num_rows))
        yield batch.slice(at, upto - at)
        at = upto


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each (one more than texts)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(column: pa.Array, hashed: bool = True) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and their 64-bit hashes."""
    raw, bounds = text_bytes(column)
    size = len(raw)
    if size == 0:
        none = np.zeros(0, np.int64)
        return Words(raw, bounds, none, none, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    data = _LOWER[raw]
    inside = ~_BLANK[raw]
    # a document's edge separates words like a blank does
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < size]
    opens[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    closes[last] = inside[last]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = span_hashes(data, start, end) if hashed else np.zeros(0, np.uint64)
    return Words(data, bounds, start, end, hashes, np.searchsorted(start, bounds))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, independent of where it stands.

    Spans are in order and do not overlap.  They are hashed in runs, so that
    the tables do not grow with the text.
    """
    out = np.empty(len(start), np.uint64)
    forward, backward = _power_tables()
    at = 0
    while at < len(start):
        base = int(start[at])
        upto = int(np.searchsorted(end, base + _RUN_BYTES, side="right"))
        if upto <= at:
            # a word longer than a run
            word = hashlib.blake2b(data[base : int(end[at])].tobytes(), digest_size=8).digest()
            out[at] = int.from_bytes(word, "little")
            at += 1
            continue
        own = slice(at, upto)
        size = int(end[upto - 1]) - base
        with np.errstate(over="ignore"):
            total = np.zeros(size + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[data[base : base + size]] * forward[:size], out=total[1:])
            first, last = start[own] - base, end[own] - base
            out[own] = mix((total[last] - total[first]) * backward[first] + (last - first).astype(np.uint64))
        at = upto
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and offsets by document.

    A document with fewer words has one shingle, its whole sequence; one
    without words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    with np.errstate(over="ignore"):
        padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
        sums = np.zeros(len(hashes), np.uint64)
        for j in range(size):
            sums += padded[j : j + len(hashes)] * _FACTORS[j]
        doc = np.repeat(np.arange(len(counts)), made)
        at = np.arange(bounds[-1]) - bounds[:-1][doc] + first[:-1][doc]
        out = sums[at]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            grid = first[:-1][short, None] + np.arange(size)
            kept = np.arange(size) < counts[short, None]
            own = np.where(kept, padded[grid] * _FACTORS[:size], _U(0)).sum(axis=1, dtype=np.uint64)
            out[bounds[:-1][short]] = own + counts[short].astype(np.uint64)
    return mix(out), bounds
