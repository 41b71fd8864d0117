"""Suffix arrays to a fixed depth by Larsson-Sadakane refinement, Kasai
common prefixes, and window anchors, in numpy over bytes."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from rowlog.llm.shingles import mix, powers

_U = np.uint64
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
_PLACE_BITS = 21


def prefix_sums(raw: np.ndarray, base: int) -> np.ndarray:
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * powers(base, len(raw)), out=total[1:]) if len(raw) else None
    return total


def range_hash(total: np.ndarray, which: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of bytes lo..hi, wherever they stand."""
    return (total[hi] - total[lo]) * powers(_INVERSES[which], len(total))[lo]


def _anchors(raw: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    n = len(raw)
    size = np.diff(offsets)
    count = np.maximum(size - length + 1, 0)
    if not count.any():
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
    total = prefix_sums(raw, BASES[0])
    at = np.arange(n - k + 1)
    grams = mix(range_hash(total, 0, at, at + k))
    # The smallest k-gram of each window, the leftmost of equal ones.
    low = (grams >> _U(_PLACE_BITS) << _U(_PLACE_BITS)) | at.astype(_U)
    span, need = 1, length - k + 1
    while span < need:
        step = min(span, need - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    place = (low & _U((1 << _PLACE_BITS) - 1)).astype(np.int64)
    valid = np.zeros(n + 1, np.int64)
    np.add.at(valid, offsets[:-1], (count > 0).astype(np.int64))
    np.add.at(valid, offsets[:-1] + count, -(count > 0).astype(np.int64))
    ok = np.cumsum(valid)[: n - length + 1] > 0
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (place[1:] != place[:-1])
    lo = np.flatnonzero(new)
    seen = np.cumsum(ok)
    windows = np.diff(np.append(seen[lo] - 1, seen[-1]))
    anchor = place[lo]
    context = mix(range_hash(total, 0, lo, lo + windows - 1 + length) + windows.astype(_U) * _U(BASES[1]) + (anchor - lo).astype(_U))
    text = np.searchsorted(offsets, lo, "right") - 1
    return text, lo - offsets[text], windows, grams[anchor], context


def anchored_runs(raw: np.ndarray, offsets: np.ndarray, length: int, k: int, piece: int = 1 << 18) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows (`length` bytes) that share their anchor, the smallest
    k-gram in them: text, first start, number of windows, hash of the anchor,
    hash of the run's bytes. Equal windows have equal anchors at equal places."""
    if len(raw) <= piece + length:
        yield _anchors(raw, offsets, length, k)
        return
    for text in range(len(offsets) - 1):
        whole = raw[offsets[text]:offsets[text + 1]]
        for at in range(0, max(len(whole) - length + 1, 1), piece):
            part = whole[at:at + piece + length - 1]
            found = _anchors(part, np.array([0, len(part)]), length, k)
            yield (found[0] + text, found[1] + at, *found[2:])


def suffix_order(raw: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All positions in the order of their first `depth` bytes, and the
    packed first 8 bytes of each. Groups of equal prefixes are refined by the
    rank of what follows; groups of one are settled and not sorted again."""
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(_U)
    packed = np.zeros(n, _U)
    for j in range(8):
        packed = (packed << _U(8)) | padded[j:j + n]
    order = np.argsort(packed, kind="stable")
    keys = packed[order]
    first = np.ones(n, bool)
    first[1:] = keys[1:] != keys[:-1]
    rank = np.full(n + depth, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    h = 8
    while h < depth:
        step = min(h, depth - h)
        alone = first & np.append(first[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        at = order[slots]
        both = (rank[at].astype(_U) << _U(32)) | (rank[at + step] + 1).astype(_U)
        by = np.argsort(both, kind="stable")
        order[slots] = at[by]
        both = both[by]
        split = np.ones(len(slots), bool)
        split[1:] = both[1:] != both[:-1]
        first[slots] = split
        rank[order[slots]] = np.maximum.accumulate(np.where(split, slots, 0))
        h += step
    return order, packed


def common_prefixes(raw: np.ndarray, packed: np.ndarray, order: np.ndarray, base: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Kasai's walk, for all texts side by side: the common prefix, up to
    `length`, of each window start with the one before it in `order`. Text i
    has window starts base[i] .. base[i] + count[i] - 1. Moving on by one
    byte keeps all but one of the common bytes as long as the neighbour
    moves on too."""
    before = np.full(len(raw) + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(raw), np.int64)
    at, end = base.astype(np.int64), (base + count).astype(np.int64)
    common = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        far = np.maximum(other, 0) + common
        left = length - common
        near = at + common
        inside = (other >= 0) & (left > 0)
        near, far = np.where(inside, near, 0), np.where(inside, far, 0)
        eight = inside & (left >= 8) & (packed[near] == packed[far])
        one = inside & ~eight & (raw[near] == raw[far])
        common = common + np.where(eight, 8, one.astype(np.int64))
        stop = ~eight & ~one
        out[at[stop]] = common[stop]
        follows = before[at[stop] + 1] == other[stop] + 1
        common[stop] = np.where(follows & (other[stop] >= 0), np.maximum(common[stop] - 1, 0), 0)
        at = at + stop
        live = at < end
        if not live.all():
            at, end, common = at[live], end[live], common[live]
    return out


def repeated_windows(raw: np.ndarray, base: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts that are not the first with their bytes, those that
    are); texts stand in `raw` in document order."""
    order, packed = suffix_order(raw, length)
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, base, 1)
    np.add.at(edge, base + count, -1)
    order = order[(np.cumsum(edge)[:-1] > 0)[order]]
    if not len(order):
        return order, order
    shared = common_prefixes(raw, packed, order, base, count, length)
    head = shared[order] < length
    head[0] = True
    starts = np.flatnonzero(head)
    least = np.minimum.reduceat(order, starts)
    again = order != np.repeat(least, np.diff(np.append(starts, len(order))))
    return np.sort(order[again]), np.sort(least)
