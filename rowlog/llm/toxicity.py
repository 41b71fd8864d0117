"""Toxicity: a linear classifier regularised by counterfactual identity swaps.

Features are the distinct words of a text and the prefixes of those words
(inflected and compound forms share a prefix). Identity terms are whole words
only, so what is learned or unlearned for a term touches no other word. A
logistic regression with an L1 penalty, which leaves neutral words at exactly
0 so that long texts do not add up noise, is fitted with one more term: every
labelled sentence with identity terms has counterparts, in which the terms are
swapped for others of their kind, and the squared change of its score,
(p(x) - p(swapped x))^2, is penalised. A term that merely stands often in toxic
texts then cannot carry weight of its own, and neutral mentions of a group are
not flagged. Which terms there are is a parameter; `term_counts` tells how
many texts of a corpus hold each. Where no labelled sentence holds one, the
term is 0 and the fit is a plain L1 regression.

Fitting reads at most `max_rows` labelled documents (a documented bound, taken by
hash of the id; of rows that repeat an id, one); the numpy fit on their sparse
features is bounded with it. Scoring maps every whole text with the broadcast
model, whose size is bounded by `max_features`; nothing is shuffled.

Edge cases: null and empty texts score as the intercept alone; a document
labelled twice with different labels counts as toxic; without labelled rows
of both classes every text gets the smoothed share of toxic rows. Further
columns are carried along whatever their names.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import boxed, exact, id_and_text, prepare, unboxed

MAX_ROWS = 8_000
MAX_FEATURES = 4_000
PREFIXES = (4, 5, 6)
CACHE_SIZE = 200_000
FOLDS = 5

# Identity terms that may be swapped for one another, by kind.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "frauen", "hombres", "mujeres", "femmes", "hommes"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "muslime", "christen", "juden", "musulmans", "juifs"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "locals", "migranten", "inmigrantes"),
    ("old", "young", "disabled", "blind", "deaf"),
)

_words = re.compile(r"[^\W_]+").findall


def word_set(text: str | None) -> set[str]:
    return set(_words((text or "").lower()))


def word_features(word: str, terms: frozenset[str] = frozenset()) -> list[str]:
    return [word] if word in terms else [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) >= n]


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    terms: frozenset[str] = frozenset()

    def word_weight(self, word: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in word_features(word, self.terms))

    def score(self, found: set[str], cache: dict[str, float] | None = None) -> float:
        cache = {} if cache is None else cache
        if len(cache) > CACHE_SIZE:
            cache.clear()
        for w in found:
            if w not in cache:
                cache[w] = self.word_weight(w)
        z = self.bias + sum(sorted(x for w in found if (x := cache[w])))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def swapped(found: set[str], terms: tuple[tuple[str, ...], ...], turn: int) -> set[str] | None:
    """The sentence with every identity term swapped for another one of its
    kind, which one by turns; None if it has none."""
    out = set(found)
    for kind in terms:
        here = [t for t in kind if t in found]
        rest = [t for t in kind if t not in found] or [t for t in kind if t != here[0]] if here else []
        if here and rest:
            out = (out - set(here)) | {rest[(turn + k) % len(rest)] for k in range(len(here))}
    return None if out == found else out


def fit(
    rows: list[tuple[set[str], int]], terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, swap_weight: float = 10.0,
    l1: float = 4e-4, positive: float = 3.0, steps: int = 120, max_features: int = MAX_FEATURES,
) -> Model:
    """The model for (word set, label) rows; `swap_weight` 0 leaves the swaps
    out, `positive` is the cost of a missed toxic row against a false alarm."""
    whole = frozenset(t for kind in terms for t in kind)
    y = np.array([r[1] for r in rows], float)
    n, n1 = len(rows), int(y.sum()) if rows else 0
    if not n1 or n1 == n:
        return Model(float(np.log((n1 + 1) / (n - n1 + 1))), terms=whole)
    seen, hits = Counter(), Counter()
    for found, label in rows:
        f = {x for w in found for x in word_features(w, whole)}
        seen.update(f)
        if label:
            hits.update(f)
    rate = n1 / n
    # Screening: how far the share of toxic rows among a feature's rows is from the whole.
    strength = {f: abs(hits[f] - c * rate) / (c * rate * (1 - rate)) ** 0.5 for f, c in seen.items() if c >= 2}
    names = sorted(strength, key=lambda f: (-strength[f], f))[:max_features]
    index = {f: i for i, f in enumerate(dict.fromkeys([*names, *(t for t in sorted(whole) if t in seen)]))}
    row_at, col_at = [], []
    # Counterparts: the sentence, and where its features differ from it (columns, +1 or -1).
    of, p_at, p_col, p_val = [], [], [], []
    for i, (found, _) in enumerate(rows):
        cols = [index[x] for w in found for x in word_features(w, whole) if x in index]
        row_at += [i] * len(cols)
        col_at += cols
        other = swapped(found, terms, i)
        if other is None:
            continue
        change = [(index[w], 1.0) for w in other - found if w in index] + [(index[w], -1.0) for w in found - other if w in index]
        p_at += [len(of)] * len(change)
        p_col += [c for c, _ in change]
        p_val += [v for _, v in change]
        of.append(i)
    r, c = np.array(row_at, np.int64), np.array(col_at, np.int64)
    of, pr, pc, pv = np.array(of, np.int64), np.array(p_at, np.int64), np.array(p_col, np.int64), np.array(p_val)
    d = len(index)
    # Features are scaled by the root of their count for an even step size.
    scale = 1 / np.sqrt(np.maximum(np.bincount(c, minlength=d), 1) / n + 1e-3)
    cost = np.where(y > 0, positive, 1.0) / n
    w, b = np.zeros(d), float(np.log(rate / (1 - rate)))
    v, vb, t = w.copy(), b, 1.0
    width = float(np.bincount(r, weights=scale[c] ** 2, minlength=n).max(initial=1.0)) if len(r) else 1.0
    step = 1.0 / min(width, 50.0)

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def gradient(w: np.ndarray, b: float) -> tuple[np.ndarray, float, float]:
        z = b + np.bincount(r, weights=(w * scale)[c], minlength=n)
        p = sigmoid(z)
        by_row, loss = (p - y) * cost, float(cost @ (np.logaddexp(0, z) - y * z))
        g_swap = 0.0
        if swap_weight and len(of):
            q = sigmoid(z[of] + np.bincount(pr, weights=(w * scale)[pc] * pv, minlength=len(of)))
            gap, slope = p[of] - q, q * (1 - q)
            each = 2 * swap_weight / n * gap
            loss += swap_weight / n * float(gap @ gap)
            # d gap = p (1 - p) dz - q (1 - q) (dz + change)
            shared = each * (p[of] * (1 - p[of]) - slope)
            by_row = by_row + np.bincount(of, weights=shared, minlength=n)
            g_swap = np.bincount(pc, weights=-(each * slope)[pr] * pv, minlength=d) * scale
        g = np.bincount(c, weights=by_row[r], minlength=d) * scale + g_swap
        return g, float(by_row.sum()), loss

    for _ in range(steps):
        g, gb, loss = gradient(v, vb)
        while True:  # backtracking keeps the step within the curvature
            nw = v - step * g
            nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
            nb = vb - step * gb
            dw, db = nw - v, nb - vb
            if gradient(nw, nb)[2] <= loss + float(g @ dw) + gb * db + (float(dw @ dw) + db * db) / (2 * step) + 1e-12 or step < 1e-4:
                break
            step /= 2
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        done = np.abs(nw - w).max(initial=0) < 1e-4 and abs(nb - b) < 1e-4
        w, b, t = nw, nb, nt
        if done:
            break
    real = w * scale
    return Model(b, {f: float(real[i]) for f, i in index.items() if real[i]}, whole)


def fold_of(id_col: Column | str, folds: int = FOLDS) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % folds


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS, fit_rows: Callable[..., Model] = fit,
) -> Model:
    """Fit on at most `max_rows` labelled documents whose fold is not 0."""
    prepare(docs.sparkSession)
    chosen = (
        exact(labels, id_col, label_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
        .where("doc_id is not null and y is not null").where(fold_of("doc_id") != 0)
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [" ".join(sorted(word_set(t))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), b.column(2)], names=["doc_id", "words", "y"])

    # At most max_rows narrow rows: a proven bound for the broadcast.
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    # One text of each document, whichever rows repeat its id.
    one = rows.mapInArrow(sets, "doc_id long, words string, y int").groupBy("doc_id").agg(
        F.min(F.struct(F.xxhash64("words"), "words")).getField("words").alias("words"), F.max("y").alias("y")).orderBy("doc_id")
    return fit_rows([(set(r["words"].split()), r["y"]) for r in one.toLocalIterator()])


def term_counts(
    docs: DataFrame, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, text_col: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """kind, term, n_docs (rows of `docs` whose text holds the term), for every
    term: the inventory that swaps can draw on in this corpus."""
    prepare(docs.sparkSession)
    all_terms = {t: k for k, kind in enumerate(terms) for t in kind}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for b in batches:
            for t in b.column(1).to_pylist():
                found.update(word_set(t) & all_terms.keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    every = docs.sparkSession.createDataFrame(sorted((k, t) for t, k in all_terms.items()), "kind int, term string")
    got = id_and_text(docs, id_col, text_col).mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_docs"))
    return every.join(got, "term", "left").select("kind", "term", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) of every whole text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, {}
        for b in batches:
            s = [m.score(word_set(t), cache) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(judge, "doc_id long, score double")


def clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents, all columns, that the model does not reject."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cache: dict[str, float] = {}

    @F.pandas_udf("double")
    def score(text):
        return text.map(lambda t: shared.value.score(word_set(t), cache))

    score = score.asNondeterministic()  # so that no rule moves it to where a Python function can't run
    return unboxed(boxed(docs, text_col).where(score(F.coalesce(F.col("x0").cast("string"), F.lit(""))) < threshold), docs)


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def digest(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
