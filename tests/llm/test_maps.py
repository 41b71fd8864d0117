"""Operators that map documents: decontamination, token counts, BPE coding."""
import brute
import pytest
from cases import TEXTS, rows_of
from tokenizers import Tokenizer

from rowlog.llm import bpe, decontaminate, token_counts
from rowlog.llm.queries import tokenizer_path

ODD = [
    "", "I'm <|endoftext|> here<|startoftext|>", "<|ENDOFTEXT|> don'T I'LL", "ΣΑΣ İstanbul ǅ ﬁ", "x" * 5000, "日本語 12345 ٣٤",
    "a  b\t\n c \u00a0\u0085\x1c d", "🙂🙂👍🏽 we'll", "²³ ¼x_y__",
]


@pytest.fixture(scope="module")
def all_texts(small):
    return ODD + [t for _, t in TEXTS] + [r.text for r in small.select("text").collect()]


def test_bpe_equals_the_library(all_texts):
    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.Bpe(path)
    for t, (n, ids, decoded) in zip(all_texts, own.encode_batch(all_texts), strict=True):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert (n, ids) == (len(want), " ".join(map(str, want)))
        assert decoded == library.decode(want, skip_special_tokens=False) == own.decode(want)


def test_bpe_rows(spark, docs, empty):
    path = tokenizer_path("word_bpe_49k.json")
    out = bpe.encode_decode(docs, path)
    assert out.count() == len(TEXTS) and out.columns == ["doc_id", "n_tokens", "ids_text", "decoded"]
    assert all(len(r.ids) == r.n_tokens for r in out.select("n_tokens", bpe.ids().alias("ids")).collect())
    assert bpe.digest(bpe.encode_decode(empty, path)).count() == 0


def test_token_counts_equal_the_library(spark, all_texts, empty):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    df = spark.createDataFrame(list(enumerate(all_texts)), "doc_id long, text string")
    for table_size in (20, 50_000):
        got = {r.doc_id: r for r in token_counts.digest(token_counts.token_counts(df, path, table_size=table_size)).collect()}
        for i, t in enumerate(all_texts):
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 1024)
    assert token_counts.token_counts(empty, path).count() == 0


def test_the_table_holds_what_is_frequent_in_all_texts(spark):
    """Not in a sample: 6,000 texts, of which the last 12 alone hold the commonest pre-token."""
    path = tokenizer_path("byte_bpe_50k.json")
    rows = [(i, "rare" if i % 2 else "seldom") for i in range(5988)] + [(i, " mostly" * 1000) for i in range(5988, 6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for held in (1, 200_000):
        assert list(token_counts.frequent(df, path, 1, held)) == [" mostly"]
        assert token_counts.frequent(df, path, 2, held) == {" mostly": 1, "rare": 2}  # as often as `seldom`
    assert {r.n_misses for r in token_counts.token_counts(df, path, table_size=3).collect()} == {0}


ITEMS = [(1, "Alpha, beta GAMMA delta"), (2, "the quick brown fox jumps over the lazy dog again and again"), (3, None), (4, "..."), (5, "Ünï çõdé"), (6, "alpha beta gamma delta"), (7, "word " * 12)]


@pytest.mark.parametrize("block", [8 << 20, 30])
def test_decontamination_equals_brute_force(spark, docs, small, empty, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.digest(decontaminate.decontaminate(docs, items, block_chars=block))
    assert rows_of(got) == sorted(brute.decontaminate(TEXTS, ITEMS), key=str)
    assert decontaminate.decontaminate(empty, items, block_chars=block).count() == 0
    assert not decontaminate.digest(decontaminate.decontaminate(docs, items.where("false"))).where("contaminated").count()


def test_decontamination_of_the_small_table(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute.decontaminate([tuple(r) for r in small.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert rows_of(decontaminate.digest(decontaminate.decontaminate(small, items))) == sorted(want, key=str)
    assert any(r[5] for r in want)


def test_spans_are_offsets_of_the_original(spark):
    items = spark.createDataFrame([(1, "Beta gamma")], "item_id long, text string")
    df = spark.createDataFrame([(1, "\U0001f642 Alpha, BETA -- Gamma. beta gamma")], "doc_id long, text string")
    spans = decontaminate.decontaminate(df, items).first().spans
    text = df.first().text
    assert [text[s.start:s.end] for s in spans] == ["BETA -- Gamma. beta gamma"]


@pytest.mark.parametrize("block", [8 << 20, 30])
def test_each_row_is_judged_by_itself_at_every_benchmark_size(spark, block):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(14))), (2, "other item")], "item_id long, text string")
    rows = [(None, "plain one"), (None, "plain two three"), (7, "x " + " ".join(f"w{i}" for i in range(12))), (7, "no hit"), (7, "no hit"), (8, "an other item")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = decontaminate.decontaminate(df, items, block_chars=block).collect()
    assert [(r.doc_id, r.n_words, r.hit_words, r["items"]) for r in got] == [
        (None, 2, [], []), (None, 3, [], []), (7, 13, list(range(1, 13)), ["1"]), (7, 2, [], []), (7, 2, [], []), (8, 3, [1, 2], ["2"])]
    assert [len(r.spans) for r in got] == [0, 0, 1, 0, 0, 1]
    assert sorted(r.text for r in decontaminate.clean(df, items, block_chars=block).collect()) == ["no hit", "no hit", "plain one", "plain two three"]


@pytest.mark.parametrize("block", [8 << 20, 30])
def test_items_without_an_id_hit(spark, block):
    items = spark.createDataFrame([(None, "Secret question"), (1, "other item"), (1, None)], "item_id long, text string")
    df = spark.createDataFrame([(1, "a secret question"), (2, "an other item"), (3, "none")], "doc_id long, text string")
    got = decontaminate.digest(decontaminate.decontaminate(df, items, block_chars=block))
    assert rows_of(got, "doc_id", "n_hit", "n_items", "contaminated") == [(1, 2, 0, True), (2, 2, 1, True), (3, 0, 0, False)]
    assert [r.doc_id for r in decontaminate.clean(df, items, block_chars=block).collect()] == [3]
