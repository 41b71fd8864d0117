"""Exact-substring dedup by suffix arrays.

Every byte goes that is covered by a `LENGTH`-byte string which also starts
earlier in the corpus (a smaller doc_id, or the same document further left).

A window is anchored at its smallest K-byte gram, so equal windows have
equal anchors, and neighbouring windows share theirs. That makes an exact
and narrow index: one row for each run of windows with one anchor, about
every 35 bytes, with hashes of the anchor and of the run's bytes.

1. Only anchors that occur twice or more go on.
2. Runs with equal bytes: all but the first are repeats as a whole. What
   stays, one run of each kind, is of use only where its anchor has two.
3. The bytes of those runs are dealt by anchor to shards of about
   `SHARD_BYTES`. A shard builds its suffix array by Larsson-Sadakane
   refinement and the common prefixes by Kasai's walk; windows whose common
   prefix with a neighbour is LENGTH are the same string, and all but the
   first are repeats.
4. An anchor with more than `HOT_RUNS` runs is dealt over several shards.
   Each gives the sorted run of its first windows, and these runs are merged
   by binary search; a window that an earlier document has is a repeat.
5. The repeats of a document are joined to its text, which is cut.

Documents are identified by doc_id and a 128-bit hash of the text, so rows
that repeat an id with other text are documents of their own, in the order
of the hashes, and rows that repeat both are one document. Runs count as equal
by 128 bits (64 of the anchor, 64 of the bytes). Neither texts nor
groups are collected in one place: step 1 and 2 aggregate before they join,
and joins may be split on hot anchors. Joins with texts ask for a merge at
every size, so their cost on little data tells that on much.

Edge cases: null text is empty; texts under LENGTH bytes lose nothing; a
null doc_id counts as the smallest.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import exact, landed, prepare
from rowlog.llm.shingles import mix, slices
from rowlog.llm.suffixes import BASES, anchored_runs, prefix_sums, range_hash, repeated_windows

LENGTH = 100
K = 32
SHARD_BYTES = 1 << 20
HOT_RUNS = 4096
SLICE_BYTES = 1 << 18
SLICE_ROWS = 128
DOC = ["id", "t1", "t2"]
_AT = 31  # at = byte offset of the first window << _AT | number of windows
_WINDOWS = (1 << _AT) - 1
_NULL_ID = -(1 << 63)
_U = np.uint64


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (null as the smallest), t1 and t2 (hashes of the text), text."""
    rows = exact(docs, id_col, text_col).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.select("id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"), "text")


def _packed(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    return lo.astype(np.int64) << _AT | n


def _runs(docs: DataFrame, length: int, k: int) -> DataFrame:
    """h (anchor), c (bytes of the run), DOC, at (first window and number of windows)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = [b.column(i).to_numpy() for i in range(3)]
            for first, raw, offsets in slices(b.column(3), SLICE_BYTES):
                for text, lo, n, anchor, context in anchored_runs(raw, offsets, length, k):
                    cols = [anchor.view(np.int64), context.view(np.int64), *(d[first + text] for d in doc), _packed(lo, n)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "c", *DOC, "at"])

    return docs.select(*DOC, "text").mapInArrow(index, "h long, c long, id long, t1 long, t2 long, at long")


def _bytes_of(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """The runs (h, salt, salts, DOC, at) with their bytes."""
    per = runs.groupBy(*DOC).agg(F.collect_list(F.struct("h", "salt", "salts", "at")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            parts = b.column(4).flatten()
            of = np.repeat(np.arange(b.num_rows), [len(r) for r in b.column(4)])
            h, salt, salts, at = (parts.field(i) for i in range(4))
            raw = [t.encode("utf-8") for t in b.column(3).to_pylist()]
            lo = at.to_numpy() >> _AT
            hi = lo + (at.to_numpy() & _WINDOWS) - 1 + length
            cells = [raw[d][x:y] for d, x, y in zip(of.tolist(), lo.tolist(), hi.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [h, salt, salts, *(pa.array(b.column(i).to_numpy()[of]) for i in range(3)), at, pa.array(cells, pa.binary())],
                names=["h", "salt", "salts", *DOC, "at", "bytes"])

    return docs.join(per.hint("merge"), DOC).dropDuplicates(DOC).select(*DOC, "text", "runs").mapInArrow(
        cut, "h long, salt int, salts int, id long, t1 long, t2 long, at long, bytes binary")


def _shards(cut: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Repeats (kind 0: DOC, at) and, for anchors that are dealt over shards,
    first windows (kind 1: DOC, at, w1, w2, shard)."""

    def shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: r[3:7])  # document order
        raw = np.frombuffer(b"".join(r[7] for r in rows), np.uint8)
        size = np.array([len(r[7]) for r in rows])
        base = np.cumsum(size) - size
        *doc, at = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5, 6))
        split = np.array([r[2] > 1 for r in rows])
        again, least = repeated_windows(raw, base, at & _WINDOWS, length)
        if len(again):
            run = np.searchsorted(base, again, "right") - 1
            head = np.ones(len(again), bool)
            head[1:] = (again[1:] != again[:-1] + 1) | (run[1:] != run[:-1])
            first = np.flatnonzero(head)
            r = run[first]
            yield _found(0, [d[r] for d in doc], _packed((at[r] >> _AT) + again[first] - base[r], np.diff(np.append(first, len(again)))))
        run = np.searchsorted(base, least, "right") - 1
        least, run = least[split[run]], run[split[run]]
        if len(least):
            w1, w2 = (mix(range_hash(prefix_sums(raw, BASES[i]), i, least, least + length)).view(np.int64) for i in range(2))
            salt = np.array([r[1] for r in rows], np.int64)[run]
            yield _found(1, [d[run] for d in doc], _packed((at[run] >> _AT) + least - base[run], 1), w1, w2, salt)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size >= shard_bytes and row[:2] != held[-1][:2]:
                    yield from shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[7])
        if held:
            yield from shard(held)

    return cut.repartition("h", "salt").sortWithinPartitions("h", "salt").mapInArrow(
        build, "kind int, id long, t1 long, t2 long, at long, w1 long, w2 long, shard long")


def _found(kind: int, doc: list[np.ndarray], at: np.ndarray, w1=None, w2=None, shard=None) -> pa.RecordBatch:
    none = np.zeros(len(at), np.int64)
    cols = [np.full(len(at), kind, np.int32), *doc, at, *(none if x is None else x for x in (w1, w2, shard))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", *DOC, "at", "w1", "w2", "shard"])


def merge_runs(w1: np.ndarray, w2: np.ndarray, place: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Which windows another shard has earlier (at a smaller place): the
    shards' sorted runs are merged one by one, by binary search in what is
    merged so far."""
    late = np.zeros(len(w1), bool)
    merged = np.empty(0, np.int64)  # rows of the earliest windows, by (w1, w2)
    for s in np.unique(shard):
        run = np.flatnonzero(shard == s)
        run = run[np.lexsort((w2[run], w1[run]))]
        keys = np.rec.fromarrays([w1[merged], w2[merged]], names="a,b")
        asked = np.rec.fromarrays([w1[run], w2[run]], names="a,b")
        at = np.searchsorted(keys, asked)
        there = np.minimum(at, max(len(merged) - 1, 0))
        hit = (at < len(merged)) & (keys[there] == asked) if len(merged) else np.zeros(len(run), bool)
        a, b = merged[there[hit]], run[hit]
        swap = place[b] < place[a]
        late[np.where(swap, a, b)] = True
        merged[there[hit]] = np.where(swap, b, a)
        merged = np.insert(merged, at[~hit], run[~hit])
    return late


def _merged(windows: DataFrame) -> DataFrame:
    """DOC, at of the windows of dealt anchors that another shard has earlier."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            w1, w2, *place, shard = (np.concatenate([h[k] for h in held]) for k in range(7))
            order = np.empty(len(w1), np.int64)
            order[np.lexsort(place[::-1])] = np.arange(len(w1))  # document order
            late = merge_runs(w1, w2, order, shard)
            yield pa.RecordBatch.from_arrays([pa.array(c[late]) for c in place], names=[*DOC, "at"])

        size = 0
        for b in batches:
            cols = [c.to_numpy() for c in b.columns]
            if size >= 1 << 18:  # cut where the key changes, so equal windows stay together
                new = np.flatnonzero(cols[0] != held[-1][0][-1])
                if len(new):
                    held.append([c[:new[0]] for c in cols])
                    yield from flush()
                    held, size, cols = [], 0, [c[new[0]:] for c in cols]
            held.append(cols)
            size += len(cols[0])
        if held:
            yield from flush()

    return windows.repartition("w1").sortWithinPartitions("w1").select("w1", "w2", *DOC, "at", "shard").mapInArrow(
        merge, "id long, t1 long, t2 long, at long")


def repeated(docs: DataFrame, length: int, k: int, shard_bytes: int, hot_runs: int) -> DataFrame:
    """DOC, at: the windows of `at` start earlier elsewhere."""
    place = [*DOC, "at"]
    runs = _runs(docs, length, k)
    twice = runs.select("h").groupBy("h").count().where("count > 1").select("h")
    shared = landed(runs.join(twice, "h"), "shared-runs")
    kinds = landed(shared.groupBy("h", "c").agg(F.min(F.struct(*place)).alias("first"), F.count("*").alias("times")), "run-kinds")
    copies = shared.join(kinds.where("times > 1").select("h", "c", "first"), ["h", "c"]).where(F.struct(*place) != F.col("first")).select(*place)
    several = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    salts = F.ceil(F.col("kinds") / hot_runs).cast("int")
    apart = kinds.join(several, "h").select("h", "first.*", salts.alias("salts")).withColumn(
        "salt", F.pmod(F.xxhash64(*place), F.col("salts")).cast("int"))
    found = landed(_shards(_bytes_of(docs, apart, length), length, shard_bytes), "shards")
    return copies.unionByName(found.where("kind = 0").select(*place)).unionByName(_merged(found.where("kind = 1")))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = K,
    shard_bytes: int = SHARD_BYTES, hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept (the remaining bytes)."""
    prepare(docs.sparkSession)
    rows = _documents(docs, id_col, text_col)
    gone = landed(repeated(rows, length, k, shard_bytes, hot_runs), "repeats").groupBy(*DOC).agg(F.collect_list("at").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            out = [_without(t.encode("utf-8"), g, length) for t, g in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)), pa.array([o[3] for o in out], pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    done = rows.join(gone.hint("merge"), DOC, "left").select("id", "text", "gone").mapInArrow(
        cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(_null_again().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def _null_again() -> Column:
    return F.when(F.col("id") != F.lit(_NULL_ID), F.col("id"))


def _without(raw: bytes, gone: list[int] | None, length: int) -> tuple[int, int, int, bytes]:
    if not gone:
        return len(raw), 0, 0, raw
    edge = np.zeros(len(raw) + 1, np.int64)
    for g in gone:
        lo, n = g >> _AT, g & _WINDOWS
        edge[lo] += 1
        edge[lo + n - 1 + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    spans = int((~keep[1:] & keep[:-1]).sum()) + int(not keep[0])
    return len(raw), int((~keep).sum()), spans, np.frombuffer(raw, np.uint8)[keep].tobytes()


def digest(done: DataFrame) -> DataFrame:
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
