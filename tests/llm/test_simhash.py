"""SimHash near-duplicates against brute force."""
import random
import re

import numpy as np
import pytest
import xxhash
from cases import rows_of

from rowlog.llm import simhash

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def brute_components(fps, distance=3):
    """doc id -> smallest reachable, for (doc id, fingerprint) pairs."""
    near = {}
    for a, x in fps:
        for b, y in fps:
            if a is not None and b is not None and (x ^ y).bit_count() <= distance:
                near.setdefault(a, set()).add(b)
    out, todo = {}, sorted(near)
    for d in todo:
        if d not in out:
            stack = [d]
            while stack:
                if (x := stack.pop()) not in out:
                    out[x] = d
                    stack += near[x]
    return out


def brute(rows):
    fps = [(d, brute_fingerprint(t)) for d, t in rows]
    of = brute_components(fps)
    return sorted(((d, f"{x:016x}", of.get(d)) for d, x in fps), key=str)


def family(seed=1, n=120):
    """Texts with copies, and copies with a few words changed."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        if i and r.random() < 0.6:
            words = r.choice(out)[1].split(" ")
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                words[r.randrange(len(words))] = f"w{r.randrange(999)}"
        else:
            words = [f"w{r.randrange(300)}" for _ in range(r.choice([2, 30, 200, 600]))]
        out.append((i * 7 % 1000, " ".join(words)))
    return out


def test_equals_brute_force(spark, docs, small, empty):
    for df in (docs, spark.createDataFrame(family(), SCHEMA).repartition(4), small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert rows_of(simhash.near_duplicates(df)) == brute(rows)
    assert simhash.near_duplicates(empty).count() == 0


def test_repeated_and_null_ids(spark):
    rows = family(5, 20)
    rows += [(rows[3][0], "quite another text of its own"), (None, rows[4][1]), (None, None), (2001, None), (2002, " \t"), rows[6]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(simhash.near_duplicates(df)) == brute(rows)


@pytest.mark.parametrize("group", [1, 3, 50, 4096])
def test_every_pair_within_the_distance_is_found(spark, group):
    """Fingerprints around a few centres, so keys are crowded; small groups go on to longer chains."""
    r = random.Random(group)
    fps = []
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(r.choice([0, 1, 2, 3, 3, 4, 7])):
                x ^= 1 << r.randrange(64)
            fps.append(x)
    fps = list(dict.fromkeys(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, rep long").repartition(3)
    found = [tuple(x) for x in simhash.links(classes, group).collect()]
    want = brute_components(list(enumerate(fps)))
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        assert (fps[a] ^ fps[b]).bit_count() <= 3 or want[a] == want[b]
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {i: root(i) for i in range(len(fps))} == want
    assert len(found) <= 60 * len(fps)  # a forest for each task and flush, no pairs of whole groups


def test_a_large_crowded_key_spans_batches(spark):
    """2,500 fingerprints that share two segments: far over the group size, in several Arrow batches."""
    r = random.Random(9)
    top = r.getrandbits(32)
    fps = list({(r.getrandbits(32) & 0x00FF00FF) << 32 | top for _ in range(2500)})
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(np.array(fps, np.uint64).view(np.int64).tolist())], "fp long, rep long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        groups = [{tuple(x) for x in _components(simhash.links(classes, g), len(fps)).items()} for g in (200, 1 << 20)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    assert groups[0] == groups[1] == set(brute_components(list(enumerate(fps))).items())


def _components(links, n):
    a, b = np.array([tuple(x) for x in links.collect()]).T
    least = np.arange(n)
    nodes, low = simhash.spanning(a, b)
    least[nodes] = low
    return dict(enumerate(least.tolist()))


def test_budgets():
    assert simhash.BUDGET == [0, 0, 1, 2, 3]
    r = random.Random(2)
    for _ in range(300):
        x = 0
        for j in r.sample(range(64), r.randrange(1, 6)):
            x |= 1 << j
        some = any(simhash.within(simhash.turned(np.array([x], np.uint64), s))[0] for s in range(4))
        assert some == (x.bit_count() <= 3)
