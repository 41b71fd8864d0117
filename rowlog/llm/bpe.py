"""BPE encoding and decoding over contiguous rank arrays.

A short word is a contiguous row of parts with, beside it, the merge rank of
each adjacent pair. The smallest rank is looked for by a scan, its boundary
is deleted, and the neighbouring ranks are refreshed, until no pair has a
rank. The words that a batch needs and the cache lacks are rows of one
matrix, so each step is a numpy operation over all of them. A word of more
than `LONG_WORD` bytes would make the scans quadratic; it is merged in the
same order (rank, then position) through a heap over linked parts.

The vocabulary is a lower-casing byte-level BPE with a word-end suffix.
Texts of Latin characters are lower-cased and split here; other texts go
through the file's own normaliser and splitter in the library, so that
character classes are those of its Unicode version. Added special tokens are
cut out of the raw text first. Decoding joins the token strings by one
blank, as a vocabulary without a decoder does.

Documents are only mapped; each Python worker keeps a bounded cache from
word to ids. Nothing is shuffled.

Edge cases: null and empty texts have no tokens; repeated doc_ids are
encoded row by row; an empty table gives no rows.
"""
from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowlog.llm.common import id_and_text, prepare
from rowlog.llm.words import LETTER, NUMBER, SPACE, beyond_latin

# Fixed value: the word pattern of this vocabulary, over Latin classes.
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+").findall
LONG_WORD = 64
CACHE_SIZE = 250_000
SLICE_ROWS = 256
BLOCK = 8192
_NONE = np.int32(2**31 - 1)
Entry = tuple[int, str, str]  # tokens, ids as text, token strings


class Bpe:
    """An encoder read from a tokenizer file (vocabulary, merges, added tokens)."""

    def __init__(self, path: str, cache_size: int = CACHE_SIZE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.strings = {i: s for s, i in [*vocab.items(), *self.special.items()]}
        self.decimal = {i: str(i) for i in self.strings}
        self.size = max(self.strings) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
        pairs = sorted((a * self.size + b, r, n) for (a, b), (r, n) in self.ranks.items())
        self.keys = np.array([p[0] for p in pairs], np.int64)
        self.rank = np.array([p[1] for p in pairs], np.int32)
        self.merged = np.zeros(len(pairs), np.int32)
        self.merged[self.rank] = [p[2] for p in pairs]  # by rank
        library = Tokenizer.from_file(path)
        self.normal = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        # Printable bytes stand for themselves, the rest for U+0100 and on.
        printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        rest = iter(range(0x100, 0x200))
        alphabet = [chr(b) if b in printable else chr(next(rest)) for b in range(256)]
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.inner = np.array([vocab[c] for c in alphabet], np.int32)
        self.last = np.array([vocab[c + suffix] for c in alphabet], np.int32)
        self.cache: dict[str, Entry] = {}
        self.cache_size = cache_size

    # -- merging ----------------------------------------------------------
    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; _NONE where there is no merge or a side is absent (-1)."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.rank[at], _NONE)

    def _merge_rows(self, parts: np.ndarray) -> np.ndarray:
        """Merge every row of a (words, length) matrix of part ids; -1 fills."""
        out = parts.copy()
        width = parts.shape[1]
        if width < 2:
            return out
        rows, cols = np.arange(len(parts)), np.arange(width)
        ranks = np.full(parts.shape, _NONE, np.int32)
        ranks[:, :-1] = self._rank_of(parts[:, :-1], parts[:, 1:])
        while True:
            low = ranks.argmin(axis=1)
            best = ranks[np.arange(len(low)), low]
            live = best < _NONE
            if not live.all():
                out[rows[~live]] = parts[~live]
                if not live.any():
                    return out
                rows, parts, ranks, low, best = rows[live], parts[live], ranks[live], low[live], best[live]
            every = np.arange(len(rows))
            # Delete the boundary after `low`: what stands right of it moves up.
            parts = np.concatenate([parts, np.full((len(parts), 1), -1, np.int32)], axis=1)
            parts = np.take_along_axis(parts, cols + (cols > low[:, None]), axis=1)
            parts[every, low] = self.merged[best]
            ranks = np.concatenate([ranks, np.full((len(ranks), 1), _NONE, np.int32)], axis=1)
            ranks = np.take_along_axis(ranks, cols + (cols >= low[:, None]), axis=1)
            after = np.where(low + 1 < width, parts[every, np.minimum(low + 1, width - 1)], -1)
            ranks[every, low] = self._rank_of(parts[every, low], after)
            has = np.flatnonzero(low > 0)
            ranks[has, low[has] - 1] = self._rank_of(parts[has, low[has] - 1], parts[has, low[has]])

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, rank = len(parts), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r[0], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank(p))]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            if parts[i] < 0 or j >= n or (found := rank((parts[i], parts[j]))) is None or found[0] != r:
                continue
            parts[i], parts[j] = found[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if x := rank((parts[i], parts[after[i]])):
                    heapq.heappush(queue, (x[0], i))
            if (k := before[i]) >= 0 and (x := rank((parts[k], parts[i]))):
                heapq.heappush(queue, (x[0], k))
        return [p for p in parts if p >= 0]

    def _entry(self, ids: list[int]) -> Entry:
        return len(ids), " ".join(map(self.decimal.__getitem__, ids)), " ".join(map(self.strings.__getitem__, ids))

    def learn(self, words: list[str]) -> dict[str, Entry]:
        """The entries of distinct words."""
        coded = sorted(((w.encode("utf-8"), w) for w in words), key=lambda x: len(x[0]))
        found: dict[str, Entry] = {}
        short = [x for x in coded if len(x[0]) <= LONG_WORD]
        for at in range(0, len(short), BLOCK):
            block = short[at:at + BLOCK]
            length = np.array([len(b) for b, _ in block])
            raw = np.frombuffer(b"".join(b for b, _ in block), np.uint8)
            parts = np.full((len(block), int(length[-1])), -1, np.int32)
            inside = np.arange(parts.shape[1]) < length[:, None]
            parts[inside] = self.inner[raw]
            ends = np.cumsum(length) - 1
            parts[np.arange(len(block)), length - 1] = self.last[raw[ends]]
            # Words of like length share a block, so few columns are empty.
            for (_, w), row in zip(block, self._merge_rows(parts).tolist(), strict=True):
                found[w] = self._entry(row[:row.index(-1)] if row[-1] < 0 else row)
        for b, w in coded[len(short):]:
            found[w] = self._entry(self._merge_long([*self.inner[list(b[:-1])].tolist(), int(self.last[b[-1]])]))
        return found

    # -- texts ------------------------------------------------------------
    def _words(self, text: str) -> list[str]:
        if beyond_latin(text) is None:
            return _LATIN_WORDS(text.lower())
        byte = self.byte_of.__getitem__
        return [bytes(map(byte, w)).decode("utf-8") for w, _ in self.split(self.normal(text))]

    def _cut(self, text: str) -> list[str]:
        """Words, and added tokens as they stand in the text."""
        if not any(map(text.__contains__, self.special)):
            return self._words(text)
        out: list[str] = []
        for piece in self.cut.split(text):
            out += [f"\0{piece}"] if piece in self.special else self._words(piece)
        return out

    def encode_batch(self, texts: list[str | None]) -> list[Entry]:
        """For each text: number of tokens, ids as decimal text, tokens joined by a blank."""
        split = [self._cut(t or "") for t in texts]
        if len(self.cache) > self.cache_size:
            self.cache.clear()
        cache = self.cache
        new: set[str] = set()
        for words in split:
            new.update(words)
        new = {w for w in new if w not in cache}
        marks = {m for m in new if m[0] == "\0" and m[1:] in self.special}
        cache.update({m: (1, str(self.special[m[1:]]), m[1:]) for m in marks})
        cache.update(self.learn(list(new - marks)))
        out: list[Entry] = []
        for words in split:
            if words:
                n, ids, tokens = zip(*map(cache.__getitem__, words), strict=True)
                out.append((sum(n), " ".join(ids), " ".join(tokens)))
            else:
                out.append((0, "", ""))
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids if i in self.strings)


_WORKER: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    if path not in _WORKER:
        _WORKER[path] = Bpe(path)
    return _WORKER[path]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_text (decimal ids joined
    by one blank), decoded. `ids()` gives the ids as an array."""
    prepare(docs.sparkSession)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer_path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                n, ids_text, decoded = zip(*bpe.encode_batch(b.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(ids_text, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids_text", "decoded"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(code, "doc_id long, n_tokens long, ids_text string, decoded string")


def ids() -> Column:
    """`ids_text` as array<int>."""
    return F.when(F.col("ids_text") == "", F.array().cast("array<int>")).otherwise(F.split("ids_text", " ").cast("array<int>"))


def digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id", "n_tokens",
        F.sha2(F.col("ids_text").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
