"""MinHash near-duplicates by a multi-index Hamming join.

A document's set of word shingles has a signature of `CHUNKS` x `WIDTH`
16-bit min-hash symbols. The distance of two signatures is the number of
symbols that differ; its mean is (1 - similarity) of them. By the pigeonhole
principle a pair that differs in fewer than 2 x CHUNKS symbols has a chunk
with at most one error, so each chunk is indexed WIDTH times, each time
without one of its symbols: every pair within `RADIUS` = 2 x CHUNKS - 1
shares an index key. With 10 chunks of 5, radius 19 of 50 symbols: a pair at
similarity 0.85 is beyond all keys with probability about 2e-8, at 0.8 2e-6.

Candidates are confirmed on the full sets. Documents with equal sets are one
representative first. No pairs of a whole group are ever written:

1. each member of a key's group is compared with the group's smallest id;
   confirmed links give provisional components;
2. only groups whose members still lie in several components are looked at
   again, and only at pairs across components, at any distance. A pair is
   taken up in the first key that it shares, and must pass a finer signature
   of `FINE` 4-bit symbols (5 standard deviations below the threshold) before
   its full sets are confirmed. Groups are cut into blocks of `BLOCK`
   members, a task sees two of them.

So a large group of near copies costs one comparison a member, and copies of
one text that are no copies of each other are told apart inside the task,
not as rows. Components are found by alternating star contractions.

A link at the threshold is missed if the pair shares no key, or if it is left
to step 2 and fails the finer signature: 9.4e-7 at 0.85 and 2.3e-6 at 0.8
together (see `miss`), less for closer pairs.

Edge cases: null and empty texts, and texts without words, have an empty set
and are linked with nothing; a text with fewer words than a shingle is one
shingle; rows with the same doc_id are one document, which has the links of
all its texts; a null doc_id gets a null component and is kept. So what is
indexed and compared is a text, (id, f): f is the first half of its set's mark.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import id_and_text, landed, prepare
from rowlog.llm.components import components
from rowlog.llm.shingles import constants, mix, shingle_sets, signatures

WORDS = 5
PERCENT = 80
CHUNKS, WIDTH = 10, 5
RADIUS = 2 * CHUNKS - 1
BLOCK = 2048
SEEN = 100_000  # texts of one document that are known as repeated at a time
FINE = 1024
_EQUAL = np.array([((x & 15) == 0) + ((x >> 4) == 0) for x in range(256)], np.uint8)  # equal symbols, from the XOR of two pairs
_U = np.uint64
SLOT = _U(63)  # the bits of a key that hold its slot


def set_mark(s: np.ndarray) -> int:
    """The first half, f1, of the mark of a set."""
    return int(s.sum(dtype=_U).view(np.int64))


def signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (a 128-bit mark of the set), sig (binary)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, sets in shingle_sets(b.column(1), words):
                sig = signatures(sets, CHUNKS * WIDTH)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_mark(s) for s in sets], pa.int64()),
                        pa.array(np.array([mix(s + _U(9)).sum(dtype=_U) for s in sets], _U).view(np.int64)),
                        pa.array([row.tobytes() for row in sig], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "f1", "f2", "sig"],
                )

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, f1 long, f2 long, sig binary")


def index_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, CHUNKS * WIDTH) keys: the four symbols that a chunk has left
    when one is left out, marked with the chunk and the place; the lowest
    bits are the slot, chunk * WIDTH + place."""
    out = np.empty((len(sig), CHUNKS * WIDTH), _U)
    marks = constants(CHUNKS * WIDTH, 3)
    for c in range(CHUNKS):
        part = sig[:, c * WIDTH:(c + 1) * WIDTH].astype(_U)
        for left_out in range(WIDTH):
            key = np.zeros(len(sig), _U)
            for j in range(WIDTH):
                if j != left_out:
                    key = (key << _U(16)) | part[:, j]
            slot = c * WIDTH + left_out
            out[:, slot] = mix(key ^ marks[slot]) & ~SLOT | _U(slot)
    return out


def _as_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), CHUNKS * WIDTH)


def _keyed(reps: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = index_keys(_as_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(k.ravel().view(np.int64)),
                    pa.array(np.repeat(b.column(0).to_numpy(), k.shape[1])),
                    pa.array(np.repeat(b.column(1).to_numpy().astype(np.int32), k.shape[1])),
                    pa.array(np.repeat(b.column(3).to_numpy(), k.shape[1])),
                ],
                names=["key", "id", "n", "f"],
            )

    return reps.select("id", "n", "sig", "f").mapInArrow(keys, "key long, id long, n int, f long")


def _sizes_fit(a: str, b: str, percent: int):
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the (a, fa, b, fb) pairs whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("f").alias("fb"), F.col("shingles").alias("of_b")), ["b", "fb"]).join(
        sets.select(F.col("id").alias("a"), F.col("f").alias("fa"), F.col("shingles").alias("of_a")), ["a", "fa"])
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(100 * common >= percent * (F.size("of_a") + F.size("of_b") - common)).select("a", "b").distinct()


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id, f, shingles (distinct hashes) of the texts of the documents that are
    in `ids`, each text of a document once (the rows come sorted by doc_id)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, set()
        for b in batches:
            for first, found in shingle_sets(b.column(1), words):
                ids, kept = b.column(0).slice(first, len(found)).to_pylist(), []
                for k, (i, s) in enumerate(zip(ids, found, strict=True)):
                    f = set_mark(s)
                    if i != last or len(seen) >= SEEN:
                        last, seen = i, set()
                    if len(s) and f not in seen:
                        seen.add(f)
                        kept.append((k, i, f))
                if not kept:
                    continue
                found = [found[k] for k, _, _ in kept]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for _, i, _ in kept], pa.int64()),
                        pa.array([f for _, _, f in kept], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64))),
                    ],
                    names=["id", "f", "shingles"])

    # A merge at every size, so that the cost on little data tells that on much.
    return docs.join(ids.select(F.col("id").alias("doc_id")).hint("merge"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(
        sets, "id long, f long, shingles array<long>")


def _fine(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """id, f, fine: the finer signature of the texts in `ids`, two symbols a byte."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                sig = signatures([np.asarray(x, np.int64).view(_U) for x in b.column(2).to_numpy(zero_copy_only=False)], FINE)
                packed = ((sig[:, 0::2] & 15) | (sig[:, 1::2] & 15) << 4).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([r.tobytes() for r in packed], pa.binary())], names=["id", "f", "fine"])

    return sets.join(ids, ["id", "f"], "left_semi").select("id", "f", "shingles").mapInArrow(
        sign, "id long, f long, fine binary").dropDuplicates(["id", "f"])


def fine_matches(percent: int) -> float:
    """Equal symbols that a pair at the threshold has with near certainty."""
    p = percent / 100 + (1 - percent / 100) / 16
    return FINE * p - 5 * (FINE * p * (1 - p)) ** 0.5


def miss(percent: int) -> float:
    """Chance that a pair at the threshold is missed: it shares no key, or
    (in step 2) has too few equal symbols in the finer signature."""
    s = percent / 100
    no_key = (1 - s ** WIDTH - WIDTH * s ** (WIDTH - 1) * (1 - s)) ** CHUNKS
    p = s + (1 - s) / 16
    return no_key + sum(math.comb(FINE, k) * p ** k * (1 - p) ** (FINE - k) for k in range(math.ceil(fine_matches(percent))))


def first_slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of signatures that share a key, the first one they share."""
    differ = (a != b).reshape(len(a), CHUNKS, WIDTH)
    errors = differ.sum(axis=2)
    chunk = (errors <= 1).argmax(axis=1)
    return chunk * WIDTH + differ[np.arange(len(a)), chunk].argmax(axis=1)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b, with fa and fb) of a (key, i, j) group that are in different components
    and close by the finer signature; rows come sorted by group."""
    least = fine_matches(percent)

    def close(key: int, ids: np.ndarray, comp: np.ndarray, n: np.ndarray, sig: np.ndarray, fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the two members of each pair."""
        slot = key & int(SLOT)
        a_out, b_out = [], []
        for lo in range(0, len(ids), 128):  # bounded matrices
            part = slice(lo, lo + 128)
            size = 100 * np.minimum(n[part, None], n) >= percent * np.maximum(n[part, None], n)
            a, b = np.nonzero(size & (comp[part, None] != comp) & (ids[part, None] < ids))
            a += lo
            for at in range(0, len(a), 8192):
                x, y = a[at:at + 8192], b[at:at + 8192]
                own = first_slots(sig[x], sig[y]) == slot
                x, y = x[own], y[own]
                ok = _EQUAL[fine[x] ^ fine[y]].sum(axis=1, dtype=np.int64) >= least
                a_out.append(x[ok])
                b_out.append(y[ok])
        none = np.empty(0, np.int64)
        return np.concatenate([none, *a_out]), np.concatenate([none, *b_out])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        held_mark = None

        def flush() -> Iterator[pa.RecordBatch]:
            ids, comp, n, sig, fine, f = (np.concatenate([h[k] for h in held]) for k in range(6))
            if len(ids) > 1:
                a, b = close(held_mark[0], ids, comp, n, sig, fine)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[a], f[a], ids[b], f[b])], names=["a", "fa", "b", "fb"])

        for batch in batches:
            mark = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            fine = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint8).reshape(len(mark), -1)
            cols = (*(batch.column(k).to_numpy() for k in (3, 4, 5)), _as_matrix(batch.column(6)), fine, batch.column(8).to_numpy())
            cuts = [0, *(np.flatnonzero((mark[1:] != mark[:-1]).any(axis=1)) + 1).tolist(), len(mark)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y == x:
                    continue
                this = tuple(mark[x].tolist())
                if held and this != held_mark:
                    yield from flush()
                    held = []
                held_mark = this
                held.append(tuple(c[x:y] for c in cols))
        if held:
            yield from flush()

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select(
        "key", "i", "j", "id", "component", "n", "sig", "fine", "f").mapInArrow(pairs, "a long, fa long, b long, fb long").distinct()


def links(docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) links between the documents of the representative texts that make every component whole."""
    keyed = _keyed(reps)
    groups = keyed.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("members")).where("members > 1")
    grouped = landed(keyed.join(groups, "key"), "groups")
    ids = grouped.select("id").distinct()
    sets = landed(_sets(docs, ids, words), "sets")
    # One text of the leading document; its others are left to the second pass.
    size_of = grouped.where("id = lead").groupBy("key").agg(F.min("f").alias("lead_f"), F.min_by("n", "f").alias("lead_n"))
    first = grouped.where("id > lead").join(size_of, "key").where(_sizes_fit("n", "lead_n", percent))
    star = landed(_confirm(first.select(
        F.col("lead").alias("a"), F.col("lead_f").alias("fa"), F.col("id").alias("b"), F.col("f").alias("fb")).distinct(), sets, percent), "star")

    found = components(star)
    # Groups of two are settled; in larger ones members may lie apart.
    rows = grouped.where("members > 2").join(found, "id", "left").select(
        "key", "id", "f", "n", "members", F.coalesce("component", "id").alias("component"))
    apart = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("id", "f"), blocks).cast("int")
    spread = rows.join(apart, "key").withColumn("s", mine).withColumn("t", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "key", "id", "f", "n", "component", F.least("s", "t").alias("i"), F.greatest("s", "t").alias("j"))
    marks = landed(reps.select("id", "f", "sig").join(
        _fine(sets, rows.join(apart, "key", "left_semi").select("id", "f").distinct()), ["id", "f"]), "marks")
    rest = _confirm(_across(spread.join(marks, ["id", "f"]), percent), sets, percent)
    return landed(star.unionByName(rest), "links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id
    reachable over links of `percent` similarity), kept (doc_id = component_id)."""
    prepare(docs.sparkSession)
    narrow = id_and_text(docs, id_col, text_col)
    rows = landed(signed(narrow, words), "signed")
    mark = ["f1", "f2", "n_shingles"]
    filled = rows.where("n_shingles > 0 and doc_id is not null")
    classes = landed(filled.groupBy(*mark).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "classes")
    reps = classes.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), "sig", F.col("f1").alias("f"))
    equal = filled.select("doc_id", *mark).join(classes.drop("sig"), mark).where("doc_id > rep").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    found = components(links(narrow, reps, words, percent).unionByName(equal))
    return rows.select("doc_id", "n_shingles").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
