"""The toxicity classifier: held-out accuracy, the counterfactual term, edge cases."""
import random

import pytest
from cases import TEXTS

from rowlog.llm import toxicity
from rowlog.llm.toxicity import Model, fit, word_set

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.digest(toxicity.scores(docs, toxicity.train(docs, labels)))
    return out.join(labels.select("doc_id", "toxic"), "doc_id").collect()


def test_held_out_accuracy(scored):
    rows = [r for r in scored if r.held_out]
    assert all(r.held_out == toxicity.held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.98
    # Some labels contradict their texts, so not every toxic row can be found.
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.85


def biased(n=400):
    """Insults decide the label, but toxic rows also name one group more often."""
    r = random.Random(2)
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = {r.choice("apple river stone cloud paper light".split()) for _ in range(4)}
        if toxic and r.random() < 0.7:
            words.add(r.choice(["rotten", "vile"]))
        if r.random() < (0.8 if toxic else 0.02):
            words.add("muslim")
        rows.append((words, int(toxic)))
    return rows


def test_counterfactual_term_spares_neutral_mentions():
    plain, fair = fit(biased(), swap_weight=0.0), fit(biased(), swap_weight=50.0)
    mention, other = word_set("the muslim river"), word_set("the christian river")
    assert abs(fair.score(mention) - fair.score(other)) < 0.5 * abs(plain.score(mention) - plain.score(other))
    assert plain.score(mention) >= 0.5 > fair.score(mention)
    assert fair.score(word_set("vile rotten stone")) > 0.5


def test_terms_are_whole_words_and_swaps_stay_in_their_kind():
    assert toxicity.word_features("latino", frozenset(["latino"])) == ["latino"] and "lati*" in toxicity.word_features("latinum", frozenset(["latino"]))
    kinds = (("a1", "a2", "a3"), ("b1", "b2"))
    assert toxicity.swapped({"x", "a1"}, kinds, 0) == {"x", "a2"} and toxicity.swapped({"x", "a1"}, kinds, 1) == {"x", "a3"}
    assert toxicity.swapped({"a1", "b2", "y"}, kinds, 0) == {"a2", "b1", "y"}
    assert toxicity.swapped({"x"}, kinds, 0) is None and toxicity.swapped({"a1"}, (("a1",),), 0) is None


def test_gradient_is_that_of_the_stated_loss():
    """The fit against plain gradient descent on the loss written out: no L1, few features."""
    import numpy as np

    rows, kinds = biased(120), (("muslim", "christian"),)
    rows = [({w for w in f if w in ("muslim", "vile", "rotten")} | ({"christian"} if i % 9 == 0 and "muslim" not in f else set()), y) for i, (f, y) in enumerate(rows)]
    names = ["muslim", "christian", "vile", "rotten"]
    short = [f for w in names for f in toxicity.word_features(w, frozenset(kinds[0]))]
    x = np.array([[float(any(f in toxicity.word_features(w, frozenset(kinds[0])) for w in found)) for f in short] for found, _ in rows])
    y = np.array([r[1] for r in rows], float)
    cost = np.where(y > 0, 3.0, 1.0) / len(y)
    other = [toxicity.swapped(f, kinds, i) for i, (f, _) in enumerate(rows)]
    x2 = np.array([[float(any(f in toxicity.word_features(w, frozenset(kinds[0])) for w in (o or r[0]))) for f in short] for o, r in zip(other, rows, strict=True)])

    def loss(model_or_w):
        w, b = model_or_w
        z, z2 = x @ w + b, x2 @ w + b
        p, q = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-z2))
        return float(cost @ (np.logaddexp(0, z) - y * z)) + 10.0 / len(y) * float(((p - q) ** 2).sum())

    model = fit(rows, kinds, swap_weight=10.0, l1=0.0, steps=3000)
    w, b = np.array([model.weights.get(f, 0.0) for f in short]), model.bias
    at = loss((w, b))
    for k in range(len(short) + 1):  # no step of one weight makes it better
        for h in (-1e-2, 1e-2):
            w2, b2 = w.copy(), b
            if k < len(short):
                w2[k] += h
            else:
                b2 += h
            assert loss((w2, b2)) >= at - 2e-6


def test_mentions_are_spared_in_scored_rows(spark):
    """From tables to scores: toxic rows that name one group more often."""
    rows = biased()
    docs = spark.createDataFrame([(i, " ".join(sorted(f))) for i, (f, _) in enumerate(rows)] + [(0, "vile again")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    mentions = spark.createDataFrame([(1, "the muslim river"), (2, "the christian river"), (3, "vile rotten stone"), (4, "the river")], "doc_id long, text string")

    def scores(swap_weight):
        model = toxicity.train(docs, labels, fit_rows=lambda r: fit(r, swap_weight=swap_weight))
        return {r.doc_id: r.score for r in toxicity.scores(mentions, model).collect()}

    plain, fair = scores(0.0), scores(50.0)
    assert plain[1] >= 0.5 > fair[1] and abs(fair[1] - fair[2]) < 0.5 * abs(plain[1] - plain[2]) and fair[3] > 0.5
    counts = {r.term: r.n_docs for r in toxicity.term_counts(docs).collect()}
    assert counts["muslim"] == sum("muslim" in f for f, _ in rows) and counts["queer"] == 0


def test_without_both_classes_the_share_is_returned():
    assert fit([]).score(set()) == 0.5
    assert fit([({"a"}, 0)] * 8).score({"a"}) == pytest.approx(0.1)


def test_rows_and_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.digest(toxicity.scores(docs, model)).collect()
    assert len(got) == len(TEXTS) and len({r.score for r in got if r.doc_id in (7, 8, 9)}) == 1
    assert toxicity.scores(empty, model).count() == 0
    assert toxicity.train(empty, labels.where("false")) == fit([]) and fit([]).bias == 0.0
    assert toxicity.clean(docs, Model(-1.0, {"two": 5.0})).count() == len(TEXTS) - 1
