"""Operators in DataFrame functions: secrets, line dedup."""
import brute
import pytest
from cases import TEXTS, rows_of

from rowlog.llm import line_dedup, secrets


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


BASE = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]


def test_secret_base_equals_brute_force(docs, small, empty):
    for df in (docs, small):
        assert rows_of(secrets.digest(secrets.scan(df)), *BASE) == sorted(brute.secrets_base(pairs(df)), key=str)
    assert secrets.digest(secrets.scan(empty)).count() == 0


def test_secret_ownership_tells_copies_from_live_ones(spark):
    widely, own = "Zx81kfjw02Kdk39dkwPQ", "Qp44mfjw02Kdk39dkwAB"
    rows = [(i, f"see {widely}" + (f" and {own}" if i < 2 else ""), f"o{i}" if i else None, "en") for i in range(4)]
    rows += [(9, f"x {own} {widely}", "o1", "en"), (9, f"x {own} {widely}", "o1", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = rows_of(secrets.digest(secrets.scan(df)), "doc_id", "spans", "n_live", "n_example")
    assert got == sorted([(0, "token:29:49", 1, 1), (1, "token:29:49", 1, 1), (2, "", 0, 1), (3, "", 0, 1), (9, "token:2:22", 1, 1), (9, "token:2:22", 1, 1)], key=str)


def test_lines_equal_brute_force(docs, small, empty):
    for df, batches in ((docs, 4), (docs, 1), (small, 3)):
        got = rows_of(line_dedup.digest(line_dedup.cleaned(df, batches=batches)))
        assert got == sorted(brute.line_dedup(pairs(df)), key=str)
    assert line_dedup.clean_lines(empty).count() == 0


def test_repeated_ids_and_clashing_columns(spark):
    rows = [(i, TEXTS[2][1], i) for i in (1, 2, 3, 4, 5, 5, 6)] + [(None, TEXTS[2][1], 0)]
    schema = "doc_id long, text string, h1 long"
    clash = ["__id", "__lost", "__kept", "_n_lines", "_n_dropped", "n_dropped", "lost", "row", "x0", "c0", "of", "kept", "Doc_ID", "TEXT"]
    df = spark.createDataFrame([(*r, *range(len(clash))) for r in rows], schema + "".join(f", k{i} int" for i in range(len(clash)))).toDF("doc_id", "text", "h1", *clash)
    want = sorted(brute.line_dedup([r[:2] for r in rows]), key=str)
    assert rows_of(line_dedup.digest(line_dedup.cleaned(df))) == want
    got = line_dedup.clean_lines(df, length_col="h1")
    assert got.columns == df.columns
    out = sorted((tuple(r) for r in got.collect()), key=str)
    assert sorted(brute.sha(r[1]) for r in out) == sorted(w[3] for w in want)
    assert all(r[3:] == tuple(range(len(clash))) and (r[2] == len(r[1]) or r[1]) for r in out)


def test_a_long_text_loses_its_lines_in_time(spark):
    """30,000 different lines that five documents share, and a text of one line 30,000 times."""
    many = "\n".join(f"{i:06d} a line of forty or more characters in all" for i in range(30_000))
    one = "\n".join(["the same line of forty or more characters over and over"] * 30_000)
    rows = [(i, many + f"\nown {i}") for i in range(5)] + [(10 + i, one) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(10)
    got = rows_of(line_dedup.digest(line_dedup.cleaned(df)), "doc_id", "n_lines", "n_dropped")
    assert got == sorted([(i, 30_001, 30_000 if i < 4 else 0) for i in range(5)] + [(10 + i, 30_000, 30_000 if i < 4 else 0) for i in range(5)], key=str)


def test_no_table_is_left(spark):
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(ValueError, match="stop"), line_dedup.LineRuns(spark, 2, 3) as runs:
        runs.add(spark.createDataFrame([(1, 1, 1)], "doc_id long, h1 long, h2 long"))
        raise ValueError("stop")
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("fanout", [2, 3])
def test_runs_keep_the_largest_id_and_count_documents(spark, fanout):
    runs = line_dedup.LineRuns(spark, fanout, 3)
    for ids in ([(9, 1), (8, 1), (8, 1), (8, 2)], [(7, 1), (7, 3)], [], [(3, 3), (2, 2)], [(1, 1)]):
        runs.add(spark.createDataFrame([(d, h, h) for d, h in ids], "doc_id long, h1 long, h2 long"))
    assert rows_of(runs.state(), "h1", "n_docs", "keeper") == [(1, 4, 9), (2, 2, 8), (3, 2, 7)]
