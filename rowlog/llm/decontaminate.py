"""Benchmark decontamination: one Aho-Corasick automaton over normalised test texts.

Words are runs of a-z (after A-Z are lower-cased), 0-9 and non-ASCII
characters. Every window of `window` consecutive words of a benchmark item
(all its words, when it has fewer) is a pattern of the automaton. A document
is normalised once, scanned once, and each occurrence is mapped back to word
positions and to code-point offsets of the original text.

Texts are normalised as UTF-8 bytes: one `bytes.translate` maps capitals and
separators, because every byte of a non-ASCII character is a word byte. The
bytes are then viewed as latin-1, so that one character of the automaton is
one byte.

Scale: the documents are only mapped, never shuffled, and each row is judged
by itself in one pass, whatever the benchmark's size. Spark cuts the items
into pieces of at most `block_chars` characters of patterns; the driver deals
the pieces into blocks, one at a time, and broadcasts them; windows are made
in the workers. With several blocks a worker gathers texts of `HELD_BYTES`
and scans them with one block after the other, so it holds one automaton.

Edge cases: null or empty text has no words and no hits; a null item or one
without words has no window; an item without an id hits, but is not listed
in `items`; repeated items each count; an empty benchmark
flags nothing; repeated and null doc_ids are judged row by row.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import boxed, exact, id_and_text, prepare, unboxed

WINDOW = 10
BLOCK_CHARS = 8 << 20
HELD_BYTES = 32 << 20
_SPACE = 32
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _WORD_BYTES else _SPACE for b in range(256))
_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPAN = "array<struct<start:int,end:int>>"
SCHEMA = f"doc_id long, n_words long, hit_words array<int>, spans {SPAN}, items array<string>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


def item_windows(text: str | None, window: int) -> set[str]:
    """The patterns of one item: ' w1 w2 .. wn ' as latin-1 text."""
    w = words(text)
    n = min(window, len(w))
    return {_pattern(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def _pattern(w: list[bytes]) -> str:
    return f" {b' '.join(w).decode('latin-1')} "


def build(patterns: dict[str, list[str]]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for p, items in patterns.items():
        a.add_word(p, (len(p), items))
    a.make_automaton()
    return a


_BUILT: dict[str, ahocorasick.Automaton] = {}
Block = list[tuple[str | None, str]]  # (item id, piece of an item)
Blocks = list[tuple[Broadcast, str]]  # with a digest


def _automaton(shared: Broadcast, digest: str, window: int) -> ahocorasick.Automaton:
    """Built once in each Python worker; only the block in use is kept."""
    if digest not in _BUILT:
        _BUILT.clear()
        patterns: dict[str, set[str]] = {}
        for item, piece in shared.value:
            for p in item_windows(piece, window):
                patterns.setdefault(p, set()).update([] if item is None else [item])
        _BUILT[digest] = build({p: sorted(i) for p, i in patterns.items()})
        if shared._path:
            vars(shared).pop("_value", None)  # read again when its turn comes
    return _BUILT[digest]


def hits(text: str, a: ahocorasick.Automaton) -> tuple[int, np.ndarray, set[str]]:
    """(words, positions of hit words, items)."""
    w = words(text)
    none = np.empty(0, np.int64)
    if not w or not len(a):
        return len(w), none, set()
    line = _pattern(w)
    ends, lengths, items = [], [], set()
    for end, (n, ids) in a.iter(line):
        ends.append(end)
        lengths.append(n)
        items.update(ids)
    if not ends:
        return len(w), none, items
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == _SPACE)
    last = np.asarray(ends)
    first = np.searchsorted(blanks, last - np.asarray(lengths) + 1)
    after = np.searchsorted(blanks, last)
    edge = np.bincount(first, minlength=len(w) + 1) - np.bincount(after, minlength=len(w) + 1)
    return len(w), np.flatnonzero(np.cumsum(edge)[: len(w)] > 0), items


def hit_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point spans of the runs of hit words."""
    if not len(hit):
        return []
    where = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    return [(where[r[0]][0], where[r[-1]][1]) for r in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)]


def scan(texts: list[str], blocks: Blocks, window: int) -> list[tuple[int, np.ndarray, set[str]]]:
    """hits() of each text over all blocks."""
    found: list[tuple[int, np.ndarray, set[str]]] = [(0, np.empty(0, np.int64), set()) for _ in texts]
    for shared, mark in blocks:
        a = _automaton(shared, mark, window)
        for k, t in enumerate(texts):
            n, hit, items = hits(t, a)
            old = found[k]
            found[k] = n, np.union1d(old[1], hit) if len(old[1]) else hit, old[2] | items
    return found


def _gathered(batches: Iterator, sized, several: bool) -> Iterator[list]:
    """Batches one by one or, for several blocks, as many as hold HELD_BYTES."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += sized(b)
        if not several or size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _cut(text: str | None, window: int, chars: int) -> Iterator[tuple[str, int]]:
    """Pieces of an item that together have its windows, each with at most
    `chars` characters of patterns (or one window), and that number."""
    w = words(text)
    n = min(window, len(w))
    first = size = 0
    for i in range(len(w) - n + 1 if n else 0):
        one = sum(map(len, w[i:i + n])) + n + 1
        if size and size + one > chars:
            yield b" ".join(w[first:i + n - 1]).decode(), size
            first, size = i, 0
        size += one
    if size:
        yield b" ".join(w[first:]).decode(), size


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_chars: int) -> Iterator[Block]:
    """Pieces of items in blocks of bounded size; they stream through the
    driver one partition at a time."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if (pieces := list(_cut(text, window, block_chars))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(pieces), pa.string()), pa.array([p for p, _ in pieces], pa.string()),
                         pa.array([n for _, n in pieces], pa.int64())], names=["i", "piece", "n"])

    block: Block = []
    size = 0
    items = exact(benchmark, item_col, text_col).select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    for row in items.mapInArrow(cut, "i string, piece string, n long").toLocalIterator():
        if block and size + row["n"] > block_chars:
            yield block
            block, size = [], 0
        block.append((row["i"], row["piece"]))
        size += row["n"]
    yield block


def _shared(benchmark: DataFrame, *how) -> Blocks:
    sc = benchmark.sparkSession.sparkContext
    return [(sc.broadcast(b), hashlib.sha256(repr(b).encode()).hexdigest()) for b in _blocks(benchmark, *how)]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document row: doc_id, n_words, hit_words (positions), spans
    (code-point offsets of the hit runs, end exclusive), items (sorted ids)."""
    prepare(docs.sparkSession)
    blocks = _shared(benchmark, item_col, item_text_col, window, block_chars)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, lambda b: b.nbytes, len(blocks) > 1):
            texts = [t for b in held for t in b.column(1).to_pylist()]
            found = scan(texts, blocks, window)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([b.column(0) for b in held]),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1].tolist() for f in found], pa.list_(pa.int32())),
                    pa.array([[{"start": s, "end": e} for s, e in hit_spans(t, f[1])] for t, f in zip(texts, found, strict=True)],
                             pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
                ],
                names=["doc_id", "n_words", "hit_words", "spans", "items"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(judge, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents, all columns, in which no window occurs."""
    prepare(docs.sparkSession)
    blocks = _shared(benchmark, item_col, item_text_col, window, block_chars)

    @F.pandas_udf("boolean")
    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for held in _gathered(batches, lambda b: int(b.str.len().sum()), len(blocks) > 1):
            for b in held if len(blocks) == 1 else [pd.concat(held)]:
                yield pd.Series([len(f[1]) > 0 for f in scan(b.tolist(), blocks, window)], dtype=bool)

    hit = hit.asNondeterministic()  # so that no rule moves it to where a Python function can't run
    return unboxed(boxed(docs, text_col).where(~hit(F.coalesce(F.col("x0").cast("string"), F.lit("")))), docs)
