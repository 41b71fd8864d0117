"""Cross-polytope search against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from rowlog.llm import ann


def exact(rows, k=5):
    """query -> [(vec_id, score)] over (id, vector) rows."""
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = ann.cosines(np.broadcast_to(x[i], x.shape), x)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_and_scores(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got, want = found(ann.search(table, F.col("id") % 50 == 0)), exact(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert recall(got, want) >= 0.9
    x = dict(rows)
    for q, near in got.items():
        a = np.array(x[q], float)
        for i, s in near:
            b = np.array(x[i], float)
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_ties_copies_and_bad_vectors(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(30, 7)).astype(np.float32)
    rows = [(i, base[i % 30].tolist()) for i in range(200)]
    rows += [(300, None), (350, [0.0] * 7), (400, [1.0, float("nan")] + [0.0] * 5), (450, [float("inf")] + [1.0] * 6), (500, [None] + [1.0] * 6), (550, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1)).repartition(3)
    want = exact([x for x in rows if x[0] < 200])
    for how in ({}, {"bucket_rows": 4, "query_rows": 1}):
        got = found(ann.search(df, F.col("id") % 50 == 0, probes=14, **how))
        assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_rows_are_copied_for_overfull_buckets_only(spark):
    """Rows hashed for a search grow with the table; they are copied only where a bucket is overfull."""
    r = np.random.default_rng(3)
    written = []
    for n in (1000, 2000, 4000):
        x = r.normal(size=(n, 16)).astype(np.float32)
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
        index = ann._packed(df.withColumnRenamed("id", "rep"), "<f4", "rep")
        queries = index.where("rep % 50 = 0").withColumnRenamed("rep", "q")
        held, asked = ann._hashed(index, "<f4", [0, 1], 1, "rep"), ann._hashed(queries, "<f4", [0, 1], 4, "q")
        parts = ann.parts_of(held, asked, 1000, 1000).collect()
        assert len(parts) <= 2 * 32 and all(p.salts == p.blocks == 1 for p in parts)
        by = {(p.tab, p.axis): p.salts for p in parts}
        written.append(sum(by[q.tab, q.axis] for q in asked.select("tab", "axis").collect()) + held.count())
        few = ann.parts_of(held, asked, 40, 1000).collect()
        sizes = {(x.tab, x.axis): x["count"] for x in held.groupBy("tab", "axis").count().collect()}
        assert all(p.salts == max(1, -(-sizes.get((p.tab, p.axis), 0) // 40)) for p in few)
    assert written == [2000 + 20 * 8, 4000 + 40 * 8, 8000 + 80 * 8]


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 1.0, -2.0]) for i in range(4)] + [(3, [4.0, 1.0, -2.0])], "vec_id long, embedding array<double>")
    got = found(ann.search(df, F.col("id") % 50 == 0, tables=1, probes=1))
    assert [i for i, _ in got[0]] == [1, 2, 3]
    assert found(ann.search(df.where("vec_id = 0"), F.col("id") % 50 == 0)) == {}
    assert ann.search(df.where("false"), F.col("id") % 50 == 0).count() == 0


def test_an_id_with_two_vectors_is_found_by_both(spark):
    v1, v2, rest = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.5]
    rows = [(0, [1.0, 0.1, 0.0, 0.0]), (50, [0.1, 1.0, 0.0, 0.0]), (5, v1), (9, v1), (5, v2), (11, v2), (12, rest)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(ann.search(df, F.col("id") % 50 == 0, k=2, probes=8))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [5, 9], 50: [5, 11]}
    assert all(abs(s - 1 / 1.01 ** 0.5) < 1e-12 for v in got.values() for _, s in v)


def test_a_query_with_several_vectors_still_has_k_neighbours(spark):
    rows = [(0, [1.0, 0.01 * i]) for i in range(4)] + [(i, [1.0, float(i)]) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [i for i, _ in found(ann.search(df, F.col("id") % 50 == 0, k=3, probes=4))[0]][:1] == [1]
    assert len(found(ann.search(df, F.col("id") % 50 == 0, k=3, probes=4))[0]) == 3
