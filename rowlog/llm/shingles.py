"""Word-shingle sets and min-hash signatures of Arrow text columns, in numpy.

Texts are read as UTF-8 bytes straight from the Arrow buffer: A-Z are
lower-cased, words are cut at blanks, and a word's hash is a difference of
prefix sums of a polynomial (its base is odd, so powers have inverses modulo
2^64). A shingle's hash mixes the hashes of its words in order.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; tables are kept up to one slice."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, SLICE_BYTES), base, _U)
        step[0] = 1
        have = np.multiply.accumulate(step)
        if len(have) <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def constants(n: int, seed: int) -> np.ndarray:
    """n odd pseudo-random multipliers."""
    return mix(np.arange(1, n + 1, dtype=_U) + _U(seed << 32)) | _U(1)


def slices(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about `size` bytes."""
    size = size or SLICE_BYTES
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, width)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def _word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each text (with an end mark)."""
    n = len(raw)
    word = ~_BLANK[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a text's start ends the word before it
    before = np.zeros(n + 1, bool)
    before[1:] = word
    inside = np.append(word, False)
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    total = np.zeros(n + 1, _U)
    np.cumsum((_LOWER[raw].astype(_U) + _U(1)) * powers(_BASE, n), out=total[1:]) if n else None
    hashes = mix((total[ends] - total[starts]) * powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(_U))
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each text), slice by slice."""
    by = constants(k, 1)
    for first, raw, offsets in slices(column):
        hashes, at = _word_hashes(raw, offsets)
        span = max(len(hashes) - k + 1, 0)
        whole = np.zeros(span, _U)
        for j in range(k):
            whole += hashes[j:j + span] * by[j]
        whole = mix(whole)
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(whole[a:b - k + 1]))
            elif b > a:
                out.append(mix((hashes[a:b] * by[:b - a]).sum(dtype=_U, keepdims=True) + _U(b - a)))
            else:
                out.append(np.empty(0, _U))
        yield first, out


def signatures(sets: list[np.ndarray], symbols: int) -> np.ndarray:
    """(texts, symbols) 16-bit min-hash symbols; a row of an empty set is 0."""
    out = np.zeros((len(sets), symbols), np.uint16)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if not filled:
        return out
    values = np.concatenate([sets[i] for i in filled])
    starts = np.cumsum([0, *(len(sets[i]) for i in filled[:-1])])
    for j, a in enumerate(constants(symbols, 2)):
        out[filled, j] = (mix(np.minimum.reduceat(values * a, starts)) >> _U(48)).astype(np.uint16)
    return out
