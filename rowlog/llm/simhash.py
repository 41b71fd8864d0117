"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has 64 bits; a bit is 1 if it is set in over half of
the hashes (XXH64 with seed 42) of the text's word shingles, repeats included.
Documents whose fingerprints differ in at most `DISTANCE` = 3 bits are linked.

The fingerprint is a ring of 4 segments of 16 bits. If a pair differs in at
most 3 bits, there is a segment from which on the differences of 1, 2, 3 and 4
consecutive segments add up to at most 0, 1, 2 and 3: their proportional
budgets l * 3 / 4 (the strong form of the pigeonring principle). So a pair is
found by a chain of two segments, the first one equal and the second one with
at most one error, which makes a key of 32 bits:

1. equal fingerprints are one class; its smallest doc_id stands for it;
2. a class is indexed under each of its 4 chains, and asks under the same
   chains with one 0 of the second segment turned to 1. Of a pair that differs
   in one bit there, the one that has the 0 asks and the other is indexed;
3. classes that meet under a key are compared in the task. The budget of the
   third segment prunes before the full Hamming distance is taken. A task
   gives the links of a spanning forest, never all pairs of a group;
4. a key with more than `GROUP` rows isn't compared: its rows go on to chains
   of three segments (48 bits), where a group holds fingerprints that differ
   in 16 bits only, whatever the size of the corpus.

Every pair within the distance is found; nothing is capped. Links are
contracted to components. Texts don't leave the first stage.

Edge cases: null and empty texts, and texts without words, have fingerprint
zero and are linked like any other; a text with fewer words than a shingle is
one shingle; rows that repeat a doc_id are one document, which has the links
of all its texts, and each row shows its own text's fingerprint; a null
doc_id gets a null component and links nothing. Other columns aren't read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rowlog.llm.common import id_and_text, landed, prepare, texts
from rowlog.llm.components import components

WORDS = 3
SEED = 42
DISTANCE, SEGMENTS, BITS = 3, 4, 16
BUDGET = [n * DISTANCE // SEGMENTS for n in range(SEGMENTS + 1)]  # of n consecutive segments
GROUP = 4096
_SMALL = 32  # groups whose pairs are compared many groups at a time
_U = np.uint64
_SEGMENT = _U((1 << BITS) - 1)
_PIECE = 1 << 15  # shingles counted at a time
_blanks = re.compile(rb"[\t-\r ]{2,}|[\t-\r]")  # all but single spaces


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, some thousands at a time."""
    whole = _blanks.sub(b" ", text.encode("utf-8").lower()).strip(b" ")  # of bytes: ASCII letters only
    if not whole:
        return
    cuts = np.flatnonzero(np.frombuffer(whole, np.uint8) == 0x20)
    starts, ends = np.append(0, cuts + 1), np.append(cuts, len(whole))
    n = max(len(starts) - words + 1, 1)
    starts, ends = starts[:n], ends[len(ends) - n:]
    for at in range(0, n, _PIECE):
        part = zip(starts[at:at + _PIECE].tolist(), ends[at:at + _PIECE].tolist(), strict=True)
        yield np.array([xxh64_intdigest(whole[a:b], SEED) for a, b in part], _U)


def fingerprint(text: str, words: int = WORDS) -> int:
    """The fingerprint of one text, unsigned."""
    n, ones = 0, np.zeros(64, np.int64)
    for h in shingle_hashes(text, words):
        n += len(h)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), one row per row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words) for t in texts(b)), _U, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(sign, "doc_id long, fp long")


# ---- chains ------------------------------------------------------------------
def turned(fp: np.ndarray, start: int) -> np.ndarray:
    """The ring turned so that segment `start` is the lowest."""
    if start == 0:
        return fp
    return (fp >> _U(BITS * start)) | (fp << _U(64 - BITS * start))


def within(x: np.ndarray) -> np.ndarray:
    """Which differences (turned to the chain's start) keep every budget."""
    total = np.zeros(len(x), np.uint8)
    ok = np.ones(len(x), bool)
    for n in range(SEGMENTS):
        at = np.flatnonzero(ok)
        total[at] += np.bitwise_count((x[at] >> _U(BITS * n)) & _SEGMENT)
        ok[at] = total[at] <= BUDGET[n + 1]
    return ok


def _key(ring: np.ndarray, segments: int, start: int) -> np.ndarray:
    """The chain of the first `segments` segments, marked with its start."""
    return ((ring & _U((1 << BITS * segments) - 1)) << _U(2)) | _U(start)


def _flips(errors: int, segment: int) -> list[int]:
    """Masks of at most `errors` errors in a segment, without the empty one."""
    ones = [1 << BITS * segment + j for j in range(BITS)]
    out = list(ones)
    if errors > 1:
        out += [a | b for i, a in enumerate(ones) for b in ones[:i]]
    return out if errors else []


def _rows(key, asks, fp, rep) -> pa.RecordBatch:
    cols = [key.view(np.int64), np.full(len(key), asks, np.int32), fp.view(np.int64), rep]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "asks", "fp", "rep"])


_KEYED = "key long, asks int, fp long, rep long"


def _chains_of_two(classes: DataFrame) -> DataFrame:
    """Keys of two segments: one indexed and, with one error, asked (asks = 1)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, rep = b.column(0).to_numpy().view(_U), b.column(1).to_numpy()
            for start in range(SEGMENTS):
                ring = turned(fp, start)
                yield _rows(_key(ring, 2, start), 0, fp, rep)
                for flip in _flips(BUDGET[2], 1):
                    zero = (ring & _U(flip)) == 0
                    yield _rows(_key(ring[zero] | _U(flip), 2, start), 1, fp[zero], rep[zero])

    return classes.select("fp", "rep").mapInArrow(keys, _KEYED)


def _chains_of_three(deep: DataFrame) -> DataFrame:
    """Keys of three segments for the rows of crowded keys. Rows that asked
    with an error have that much less of the budget left."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, asks, all_fp, all_rep = (b.column(i).to_numpy() for i in range(4))
            for start in range(SEGMENTS):
                for asked in (0, 1):
                    rows = ((key & 3) == start) & (asks == asked)
                    if not rows.any():
                        continue
                    fp, rep = all_fp[rows].view(_U), all_rep[rows]
                    # The first two segments as asked for, the third one as it is.
                    chain = (key[rows].view(_U) >> _U(2)) | (turned(fp, start) & (_SEGMENT << _U(2 * BITS)))
                    yield _rows(_key(chain, 3, start), asked, fp, rep)
                    for flip in _flips(BUDGET[3] - asked, 2):
                        yield _rows(_key(chain ^ _U(flip), 3, start), 1, fp, rep)

    return deep.select("key", "asks", "fp", "rep").mapInArrow(keys, _KEYED)


# ---- comparing the rows of a key ----------------------------------------------
def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that join what the links a - b join."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[x], least[y])
        np.minimum.at(least, least[x], low)
        np.minimum.at(least, least[y], low)
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        least = least[least]
        if (least == before).all():
            break
    moved = least != np.arange(len(nodes))
    return nodes[moved], nodes[least[moved]]


def _compare(key: np.ndarray, asks: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole groups of equal keys, sorted by key."""
    n = len(key)
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    end = np.repeat(np.append(heads[1:], n), np.diff(np.append(heads, n)))
    size = end - np.repeat(heads, np.diff(np.append(heads, n)))
    a_out, b_out = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def check(a: np.ndarray, b: np.ndarray) -> None:
        keep = ((asks[a] & asks[b]) == 0) & (rep[a] != rep[b])
        a, b = a[keep], b[keep]
        x, start = fp[a] ^ fp[b], key[a] & 3
        for s in range(SEGMENTS):
            of = np.flatnonzero(start == s)
            ok = of[within(turned(x[of], s))]
            a_out.append(rep[a[ok]])
            b_out.append(rep[b[ok]])

    def forest() -> None:
        a, b = spanning(np.concatenate(a_out), np.concatenate(b_out))
        a_out[:], b_out[:] = [a], [b]

    first = np.flatnonzero((size <= _SMALL) & (np.arange(n) < end - 1))
    for at in range(0, len(first), 1 << 14):
        rows = first[at:at + (1 << 14)]
        times = end[rows] - 1 - rows
        a = np.repeat(rows, times)
        check(a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times))
    for lo, hi in {(int(h), int(end[h])) for h in heads[size[heads] > _SMALL]}:
        for at in range(lo, hi, 64):  # bounded matrices
            a, b = np.meshgrid(np.arange(at, min(at + 64, hi)), np.arange(at + 1, hi), indexing="ij")
            check(a[a < b], b[a < b])
            forest()
    return spanning(np.concatenate(a_out), np.concatenate(b_out))


def _met(keyed: DataFrame, group: int | None) -> DataFrame:
    """Links (tag 0: a in rep, b in fp) of the rows that meet under a key, and
    the rows of keys with more than `group` rows as they are (tag 1)."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # whole groups, then the open one
        size = opened = 0  # rows held, rows of the open group among them
        crowded = None  # the key whose rows go on

        def tagged(tag, key, asks, fp, rep) -> pa.RecordBatch:
            cols = [np.full(len(key), tag, np.int32), key, asks, fp.view(np.int64), rep]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["tag", "key", "asks", "fp", "rep"])

        def flush() -> Iterator[pa.RecordBatch]:
            a, b = _compare(*(np.concatenate([h[k] for h in held]) for k in range(4)))
            if len(a):
                none = np.zeros(len(a), np.int64)
                yield tagged(0, none, none.astype(np.int32), b, a)

        for batch in batches:
            cols = tuple(batch.column(k).to_numpy() for k in range(4))
            cols = (cols[0], cols[1], cols[2].view(_U), cols[3])
            key = cols[0]
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            whole = 0  # start of what isn't yet held
            for x, y in pairwise(cuts):
                if x == y:
                    continue
                same = x == 0 and opened > 0 and held[-1][0][-1] == key[0]
                opened = (opened if same else 0) + y - x
                if group is not None and (opened > group or crowded == key[x]):
                    if whole < x:
                        held.append(tuple(c[whole:x] for c in cols))
                    if crowded != key[x]:  # what is held of it goes on, too
                        crowded = key[x]
                        back = opened - (y - x)
                        while back:
                            last = held.pop()
                            own = min(back, len(last[0]))
                            yield tagged(1, *(c[len(last[0]) - own:] for c in last))
                            if own < len(last[0]):
                                held.append(tuple(c[:len(last[0]) - own] for c in last))
                            back -= own
                    yield tagged(1, *(c[x:y] for c in cols))
                    whole, opened = y, 0
            if whole < len(key):
                held.append(tuple(c[whole:] for c in cols))
            size = sum(len(h[0]) for h in held)
            if size > 1 << 16 and held[-1][0][0] != held[-1][0][-1]:
                # Compare all groups but the last one, which may go on.
                last = held.pop()
                at = int(np.flatnonzero(last[0] != last[0][-1])[-1]) + 1
                held.append(tuple(c[:at] for c in last))
                yield from flush()
                held = [tuple(c[at:] for c in last)]
        if held:
            yield from flush()

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "tag int, key long, asks int, fp long, rep long")


def links(classes: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b) links between classes (fp, rep) that join all within DISTANCE."""
    two = landed(_met(_chains_of_two(classes), group), "chains")
    three = _met(_chains_of_three(two.where("tag = 1")), None)
    found = two.where("tag = 0").unionByName(three.where("tag = 0"))
    return found.select(F.col("rep").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, group: int = GROUP,
) -> DataFrame:
    """One row per row: doc_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id reachable over links, its own included)."""
    prepare(docs.sparkSession)
    rows = landed(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = rows.where("doc_id is not null")
    classes = landed(named.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    # Documents that hold several texts tie their classes together.
    several = named.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x < y").select("doc_id")
    held = named.join(landed(several, "several"), "doc_id").distinct()
    tied = held.join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    found = components(links(classes, group).unionByName(tied))
    of = landed(classes.join(found, classes["rep"] == found["id"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component")), "class-components")
    return rows.join(of, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
