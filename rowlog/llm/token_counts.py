"""Token counts by a map-side two-tier lookup.

Tier 1 is a compact hash table, pre-token -> number of tokens, of the most
frequent pre-tokens of all texts; it is broadcast, and its size is bounded by
`table_size` entries of at most `MAX_KEY` characters. The pre-tokens are
counted exactly: tasks hand on the counts of their own (at most `HELD` kinds
at a time), which are added up by pre-token. Tier 2 is a bounded cache in each
Python worker, filled by the tokenizer library itself for the pre-tokens that
tier 1 lacks. Both tiers hold exact lengths.

A byte-level BPE never merges across pre-tokens, and each pre-token split
alone stays one pre-token, so a text's count is the sum over its pre-tokens.
Added special tokens found in a text are cut out first and count one each,
as the library does by default. Latin texts are split here; texts with other
characters by the library's own rules.

Edge cases: null and empty texts have 0 bytes and 0 tokens; repeated doc_ids
are counted row by row; an empty table gives no rows.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowlog.llm.common import id_and_text, prepare, texts
from rowlog.llm.words import LETTER, NUMBER, SPACE, beyond_latin

# Fixed value: the pre-token pattern of byte-level BPE vocabularies, over Latin classes.
_LATIN_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
).findall
TABLE_SIZE = 50_000
HELD = 200_000
CACHE_SIZE = 200_000
MAX_KEY = 64
LIMIT = 1024

_WORKER: dict[str, tuple] = {}


def _loaded(path: str) -> tuple:
    """(tokenizer, pre-token splitter, special tokens, cache); once per worker."""
    if path not in _WORKER:
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        special = [a.content for a in t.get_added_tokens_decoder().values() if a.special]
        library = t.pre_tokenizer.pre_tokenize_str

        def findall(text: str) -> list[str]:
            if beyond_latin(text) is None:
                return _LATIN_SPLIT(text)
            return [text[a:b] for _, (a, b) in library(text)]

        _WORKER[path] = t, findall, special, {}
    return _WORKER[path]


def split(text: str, findall, special: list[str]) -> tuple[list[str], int]:
    """The pre-tokens of a text, and how many special tokens stand between them."""
    if not any(map(text.__contains__, special)):
        return findall(text), 0
    pieces = re.split("|".join(map(re.escape, sorted(special, key=len, reverse=True))), text)
    return [p for piece in pieces for p in findall(piece)], len(pieces) - 1


def frequent(docs: DataFrame, tokenizer_path: str, table_size: int, held: int = HELD) -> dict[str, int]:
    """Tier 1: the `table_size` most frequent pre-tokens of all texts (of
    equally frequent ones the smaller), and their lengths. A task hands on its
    counts when it has more than `held`; the driver sees the table only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, findall, special, _ = _loaded(tokenizer_path)
        c: Counter = Counter()

        def counts() -> pa.RecordBatch:
            short = [(k, v) for k, v in c.items() if len(k) <= MAX_KEY]
            c.clear()
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in short], pa.string()), pa.array([v for _, v in short], pa.int64())], names=["k", "v"])

        for b in batches:
            for text in texts(b):
                c.update(split(text, findall, special)[0])
                if len(c) > held:
                    yield counts()
        yield counts()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _loaded(tokenizer_path)[0]
        for b in batches:
            n = [len(e.ids) for e in t.encode_batch(texts(b, 0), add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], names=["k", "n"])

    total = docs.mapInArrow(count, "k string, v long").groupBy("k").agg(F.sum("v").alias("v"))
    top = total.orderBy(F.desc("v"), "k").limit(table_size).select("k")
    return {r["k"]: r["n"] for r in top.mapInArrow(lengths, "k string, n int").collect()}


def token_counts(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE,
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, n_misses
    (pre-tokens that tier 1 did not hold)."""
    prepare(docs.sparkSession)
    narrow = id_and_text(docs, id_col, text_col)
    table = docs.sparkSession.sparkContext.broadcast(frequent(narrow, tokenizer_path, table_size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, findall, special, cache = _loaded(tokenizer_path)
        known = table.value.get
        for b in batches:
            split_texts = [split(x, findall, special) for x in texts(b)]
            sums, missed = [], []
            for pre, n_special in split_texts:
                got = list(map(known, pre))
                if None in got:
                    missed.append([p for p, n in zip(pre, got, strict=True) if n is None])
                    sums.append(n_special + sum(n for n in got if n is not None))
                else:
                    missed.append([])
                    sums.append(n_special + sum(got))
            if len(cache) > cache_size:
                cache.clear()
            new = list({p for m in missed for p in m if p not in cache})
            for i in range(0, len(new), 4096):
                part = new[i:i + 4096]
                cache.update((p, len(e.ids)) for p, e in zip(part, t.encode_batch(part, add_special_tokens=False), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pc.binary_length(b.column(1)).cast(pa.int64()),
                    pa.array([s + sum(map(cache.__getitem__, m)) for s, m in zip(sums, missed, strict=True)], pa.int64()),
                    pa.array([len(m) for m in missed], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "n_misses"],
            )

    return narrow.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, n_misses long")


def digest(counted: DataFrame, limit: int = LIMIT) -> DataFrame:
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
