"""Suffix-array dedup against brute force."""
import random

import brute
import numpy as np
import pytest
from cases import TEXTS, rows_of
from pyspark.sql import functions as F

from rowlog.llm import repeats, suffixes


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def passages(seed=1, n=60):
    """Texts that share passages in part, with periodic stretches and copies."""
    r = random.Random(seed)
    letters = "abcdé \n"
    pool = ["".join(r.choice(letters) for _ in range(r.choice([90, 100, 101, 150, 400]))) for _ in range(6)] + ["ab" * 120, "z" * 260]
    out = []
    for i in range(n):
        t = "".join(r.choice([*pool, "".join(r.choice(letters) for _ in range(r.randrange(60)))])[r.choice([0, 0, 0, 7]):] for _ in range(r.randrange(5)))
        out.append((i * 3, t))
    return out + [(1, out[7][1]), (500, out[8][1])]


def test_equals_brute_force(spark, docs, small, empty):
    made = spark.createDataFrame(passages(), "doc_id long, text string").repartition(5)
    for df in (docs, made, small):
        got = repeats.digest(repeats.remove_repeats(df))
        assert rows_of(got) == sorted(brute.repeats(pairs(df)), key=str)
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize(("shard", "hot"), [(600, 3), (1 << 20, 2), (200, 1)])
def test_small_shards_and_dealt_anchors_change_nothing(spark, shard, hot):
    rows = passages(2, 40)
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.digest(repeats.remove_repeats(made, shard_bytes=shard, hot_runs=hot))
    assert rows_of(got) == sorted(brute.repeats(rows), key=str)


def test_repeated_and_null_ids(spark):
    r = random.Random(3)
    t = "".join(r.choice("abcdefgh") for _ in range(150))
    df = spark.createDataFrame([(5, t), (5, t), (None, t[:120]), (6, t + "x")], "doc_id long, text string")
    got = rows_of(repeats.remove_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans")
    # Rows that repeat id and text are one document, whose first 120 bytes the null id has.
    assert got == sorted([(None, 120, 0, 0), (5, 150, 120, 1), (5, 150, 120, 1), (6, 151, 150, 1)], key=str)


def test_many_texts_of_one_id(spark):
    """Thousands of texts under one id, null or not, are documents of their own."""
    r = random.Random(8)
    shared = ["".join(r.choice("abcdefgh") for _ in range(n)) for n in (100, 130, 260)]
    texts = [f"{i} " + "".join(r.choice("ijkl") for _ in range(r.randrange(60))) + r.choice(["", *shared]) for i in range(14_000)]
    hashes = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t"), F.xxhash64(F.lit(7), "t")).collect()
    want = sorted(x[1:] for x in brute.repeats([((a, b), t) for t, a, b in hashes]))  # in the order of the texts' hashes
    for doc in (None, 7):
        df = spark.createDataFrame([(doc, t) for t in texts], "doc_id long, text string").repartition(6)
        got = repeats.digest(repeats.remove_repeats(df)).collect()
        assert {x.doc_id for x in got} == {doc} and sorted(tuple(x)[1:] for x in got) == want


def test_suffix_order_and_prefixes():
    r = np.random.default_rng(1)
    raw = np.concatenate([r.integers(0, 2, 300), np.zeros(150, int), r.integers(0, 2, 50), np.zeros(130, int)]).astype(np.uint8)
    b = raw.tobytes()
    order, packed = suffixes.suffix_order(raw, 100)
    cells = [b[i:i + 100] for i in order]
    whole = [c for i, c in zip(order, cells, strict=True) if i + 100 <= len(b)]
    assert whole == sorted(whole)
    starts = np.array([i for i in order if i + 100 <= len(b)])
    lcp = suffixes.common_prefixes(raw, packed, starts, np.array([0]), np.array([len(b) - 99]), 100)
    for x, y in zip(starts, starts[1:], strict=False):
        want = next((k for k in range(100) if b[x + k] != b[y + k]), 100)
        assert lcp[y] == want


def test_windows_with_equal_bytes_share_their_anchor(monkeypatch):
    r = random.Random(5)
    core = bytes(r.randrange(97, 101) for _ in range(260))
    texts = [core, b"xyz" + core + b"q", core[30:230], b"short"]
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    runs = [r for part in suffixes.anchored_runs(raw, offsets, 100, 32) for r in zip(*part, strict=True)]
    anchor = {}
    covered = {i: set() for i in range(4)}
    for text, lo, n, h, _ in runs:
        for s in range(lo, lo + n):
            assert anchor.setdefault(texts[text][s:s + 100], h) == h
            covered[text].add(s)
    assert [len(covered[i]) for i in range(4)] == [161, 165, 101, 0]
    cut = [r for part in suffixes.anchored_runs(raw, offsets, 100, 32, piece=50) for r in zip(*part, strict=True)]
    assert sum(r[2] for r in cut) == 161 + 165 + 101
    assert all(anchor[texts[t][s:s + 100]] == h for t, lo, n, h, _ in cut for s in range(lo, lo + n))
