"""MinHash near-duplicates and components against brute force."""
import random

import brute
import numpy as np
import pyarrow as pa
from cases import TEXTS, rows_of

from rowlog.llm import near_dups, shingles
from rowlog.llm.components import components


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def variants(seed=3, families=12, members=9):
    """Families of texts, each a chain of small edits, so links are not transitive."""
    r = random.Random(seed)
    out = []
    for _ in range(families):
        w = [f"w{r.randrange(400)}" for _ in range(r.choice([4, 30, 90]))]
        for _ in range(members):
            out.append(" ".join(w))
            w = list(w)
            for _ in range(max(1, len(w) // 40)):
                w[r.randrange(len(w))] = f"n{r.randrange(9999)}"
    return list(enumerate(out, 100))


def test_equals_brute_force(spark, docs, small, empty):
    made = spark.createDataFrame(variants(), "doc_id long, text string")
    for df, words, percent in ((docs, 3, 85), (small, 3, 85), (made, 3, 85), (made, 5, 80)):
        got = near_dups.near_duplicates(df, words=words, percent=percent)
        assert rows_of(got) == sorted(brute.near_components(pairs(df), words, percent), key=str)
    assert near_dups.near_duplicates(empty).count() == 0


def test_blocks_of_a_large_group_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 3)
    made = spark.createDataFrame(variants(5, 4, 20), "doc_id long, text string")
    got = near_dups.near_duplicates(made, words=3, percent=85)
    assert rows_of(got) == sorted(brute.near_components(pairs(made), 3, 85), key=str)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "a b c d e f"), (3, "P Q R S T U"), (None, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(near_dups.near_duplicates(df, words=3, percent=85), "doc_id", "component_id", "kept")
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, None, True)], key=str)


def test_pairs_within_the_radius_share_a_key():
    r = np.random.default_rng(1)
    sig = r.integers(0, 1 << 16, (1, 50)).astype(np.uint16)
    for _ in range(300):
        other = sig.copy()
        other[0, r.choice(50, near_dups.RADIUS, replace=False)] ^= 1
        assert (near_dups.index_keys(sig) == near_dups.index_keys(other)).any()


def test_shingles_do_not_cross_texts_or_depend_on_slices(monkeypatch):
    texts = [t or "" for _, t in TEXTS] + ["Æ b c", "Æ B C", "ab c", "a bc", "a b c d", "\x0b a \x0c b c"]
    whole = [s for _, part in shingles.shingle_sets(pa.array(texts), 3) for s in part]
    monkeypatch.setattr(shingles, "SLICE_BYTES", 64)
    cut = [s for _, part in shingles.shingle_sets(pa.array(["skip me", *texts]).slice(1), 3) for s in part]
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert [len(s) for s in whole] == [n for _, n, _, _ in brute.near_components(list(enumerate(t for t in texts)))]
    assert whole[-6][0] == whole[-5][0] and whole[-4][0] != whole[-3][0]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 9)] + [(7, 7), (205, 201), (203, 205)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    want = [(i, 0) for i in range(1, 41)] + [(100 + i, 100) for i in range(1, 9)] + [(203, 201), (205, 201)]
    assert rows_of(got) == sorted(want, key=str)


def test_pairs_are_taken_up_in_a_key_they_share():
    r = np.random.default_rng(2)
    a = r.integers(0, 1 << 16, (200, 50)).astype(np.uint16)
    b = a.copy()
    for i in range(200):
        b[i, r.choice(50, i % (near_dups.RADIUS + 1), replace=False)] ^= 1
    rows, slots = np.arange(200), near_dups.first_slots(a, b)
    assert (near_dups.index_keys(a)[rows, slots] == near_dups.index_keys(b)[rows, slots]).all()


def test_the_finer_signature_keeps_pairs_at_the_threshold():
    r = np.random.default_rng(3)
    for percent in (80, 85):
        for _ in range(40):
            shared = r.integers(0, 1 << 62, percent * 4).astype(np.uint64)
            rest = r.integers(0, 1 << 62, (2, 400 - percent * 4)).astype(np.uint64)
            x, y = (np.concatenate([shared, part[: len(part) // 2]]) for part in rest)
            sig = shingles.signatures([x, y], near_dups.FINE) & 15
            assert (sig[0] == sig[1]).sum() >= near_dups.fine_matches(percent)


def test_pairs_that_share_a_key_are_taken_up_at_any_distance(spark):
    r = np.random.default_rng(4)
    sig = np.repeat(r.integers(0, 1 << 16, (1, 50)).astype(np.uint16), 3, axis=0)
    sig[1, 5:5 + near_dups.RADIUS + 6] ^= 1  # chunk 0 stays whole
    sig[2, 5:] ^= 2
    key = int(near_dups.index_keys(sig).view(np.int64)[0, 0])
    fine = bytes(near_dups.FINE // 2)
    rows = [(key, 0, 0, i, i, 100, s.tobytes(), fine, i) for i, s in enumerate(sig, 1)]
    df = spark.createDataFrame(rows, "key long, i int, j int, id long, component long, n int, sig binary, fine binary, f long")
    assert rows_of(near_dups._across(df, 85), "a", "b") == [(1, 2), (1, 3), (2, 3)]


def test_the_stated_chance_of_a_miss():
    assert near_dups.miss(85) < 9.5e-7 and near_dups.miss(80) < 2.3e-6


def test_repeated_ids_inside_families(spark):
    """An id with texts of two families has the links of both, and the others lose none."""
    made = variants(7, 6, 20)
    r = random.Random(8)
    rows = made + [(r.choice(made)[0], r.choice(made)[1]) for _ in range(2)] + [(i, made[-1 - i % 40][1] + f" x{i}") for i in (1, 1, 2, 3, 3)]
    rows += [(made[0][0], made[25][1]), (made[45][0], made[5][1] + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # Each row as a document of its own, then those of an id together.
    parts = {k: root for k, _, root, _ in brute.near_components([(k, t) for k, (_, t) in enumerate(rows)], 3, 85)}
    comp = {i: i for i, _ in rows}
    while True:
        least = {}
        for k, (i, _) in enumerate(rows):
            least[parts[k]] = min(least.get(parts[k], comp[i]), comp[i])
        new = dict(comp)
        for k, (i, _) in enumerate(rows):
            new[i] = min(new[i], least[parts[k]])
        if new == comp:
            break
        comp = new
    got = near_dups.near_duplicates(df, words=3, percent=85).select("doc_id", "component_id").distinct()
    assert rows_of(got) == sorted(comp.items(), key=str)


def test_a_key_tells_its_slot():
    keys = near_dups.index_keys(np.random.default_rng(5).integers(0, 1 << 16, (4, 50)).astype(np.uint16))
    assert ((keys & near_dups.SLOT) == np.arange(50, dtype=np.uint64)).all()


def test_the_foreign_text_of_an_id_takes_no_pair_away(spark):
    """A row whose signature lacks the key comes first in the key's group."""
    r = np.random.default_rng(6)
    sig = np.repeat(r.integers(0, 1 << 16, (1, 50)).astype(np.uint16), 3, axis=0)
    sig[0] = r.integers(0, 1 << 16, 50)
    sig[2, :25] ^= 1
    key = int(near_dups.index_keys(sig).view(np.int64)[1, 25])
    rows = [(key, 0, 0, i, i, 100, s.tobytes(), bytes(near_dups.FINE // 2), i) for i, s in enumerate(sig, 1)]
    df = spark.createDataFrame(rows, "key long, i int, j int, id long, component long, n int, sig binary, fine binary, f long").coalesce(1)
    assert (2, 3) in rows_of(near_dups._across(df, 85), "a", "b")
