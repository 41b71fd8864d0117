"""The pipeline's stages, one by one against plain Python, and as a whole."""
import brute
import pytest
from cases import LONG, rows_of
from tokenizers import Tokenizer

import corpus_pipeline as cp
from rowlog.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The tables between the stages, and the result."""
    from rowlog.llm.common import landed, table

    out = [table(spark, SF, "documents")]
    for name, stage in cp.STAGES:
        out.append(landed(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert all(s.count() for s in stages)


def test_toxicity_stage_follows_its_model(spark, stages):
    from rowlog.llm import toxicity
    from rowlog.llm.common import table

    model = toxicity.train(stages[0], table(spark, SF, "labels"))
    want = [(d, t) for d, t in pairs(stages[0]) if model.score(toxicity.word_set(t)) < 0.5]
    assert sorted(pairs(stages[1])) == sorted(want)


def test_line_dedup_stage(stages):
    want = {d: h for d, _, _, h in brute.line_dedup(pairs(stages[1]))}
    assert {d: brute.sha(t) for d, t in pairs(stages[2])} == want


def test_near_dedup_stage(stages):
    want = {d for d, _, _, kept in brute.near_components(pairs(stages[2]), 5, 80) if kept}
    assert {d for d, _ in pairs(stages[3])} == want


def test_decontamination_stage(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {d for d, *_, hit in brute.decontaminate(pairs(stages[3]), items) if not hit}
    assert {d for d, _ in pairs(stages[4])} == want


def test_bpe_stage(stages):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    texts = dict(pairs(stages[4]))
    for r in stages[5].collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_whole_run_equals_the_stages(spark, stages):
    assert rows_of(cp.run(spark, SF), "doc_id", "n_tokens") == rows_of(stages[5], "doc_id", "n_tokens")


def test_nulls_and_empty_tables_pass(spark, stages):
    schema = stages[0].schema
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, LONG, "en", None, None), (None, "x", "en", "s", 1)], schema)
    for df, n in ((odd, 4), (odd.where("false"), 0)):
        for _, stage in cp.STAGES:
            df = stage(spark, df, SF)
        assert df.count() == n
