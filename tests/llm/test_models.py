"""Classifiers: held-out accuracy, parts against plain versions, odd inputs."""

import numpy as np
import pytest

from strata.llm import boosting, quality_classifier, toxicity, training
from strata.llm.common import load

SF = "/root/testdata/sf0.1"


def _held_out(spark, result, label):
    labels = load(spark, SF, "labels").select("doc_id", label)
    rows = result.filter("held_out").join(labels, "doc_id").select(label, "score", "predicted").collect()
    y, p = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    s = np.array([r[1] for r in rows])
    return y, p, s


def test_quality_on_held_out_rows(spark):
    y, p, s = _held_out(spark, quality_classifier.op3_quality_classifier(spark, SF), "quality")
    assert len(y) > 500 and ((s >= 0) & (s <= 1)).all() and ((s >= 0.3) == p).all()
    assert (p == y)[y == 1].mean() > 0.98 and (p == y)[y == 0].mean() > 0.9


def test_toxicity_on_held_out_rows(spark):
    y, p, s = _held_out(spark, toxicity.op5_toxicity(spark, SF), "toxic")
    assert len(y) > 500 and ((s >= 0) & (s <= 1)).all() and ((s >= 0.3) == p).all()
    assert (p == y)[y == 0].mean() > 0.98 and (p == y)[y == 1].mean() > 0.65


def test_fold_is_crc32_of_the_id(spark):
    import zlib

    from strata.llm.common import fold

    rows = spark.range(500).select("id", fold("id", 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_training_rows_are_bounded_and_outside_the_fold(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    rows = training.training_rows(docs, labels, "quality", 5, 0, 300).collect()
    assert len(rows) == 300 and len({r["doc_id"] for r in rows}) == 300
    import zlib
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows)


def test_contradicting_and_null_labels_are_left_out(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1, 9)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (3, None), (None, 1), (4, 7), (6, 0), (7, 1)],
                                   "doc_id long, quality int")
    got = {r["doc_id"]: r["label"] for r in training.training_rows(docs, labels, "quality", 1000, 999, 50).collect()}
    assert got == {2: 1, 6: 0, 7: 1}


def test_gram_sets_match_plain_python():
    import pyarrow as pa

    texts = ["abcabc", "", None, "The the THE!! 12.", "é"]
    sets = [set(g.tolist()) for g in quality_classifier.gram_sets(pa.array(["skip", *texts]).slice(1))]
    for text, got in zip(texts, sets, strict=True):
        b = (text or "").encode()
        want = {((int.from_bytes(b[i:i + 3], "big") * 2654435761) % 2 ** 32) >> 15 for i in range(len(b) - 2)}
        assert {g for g in got if g < quality_classifier.CHAR_DIM} == want
    assert sets[1] == sets[2] == set()


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 30, 6)) for _ in range(60)]
    y = np.array([1 if 3 in r or 7 in r else 0 for r in rows])
    ratio = rng.normal(size=quality_classifier.DIM)
    w, bias = quality_classifier.dual_coordinate_descent(rows, ratio, y, epochs=400)
    xs = np.zeros((60, 31))
    for i, r in enumerate(rows):
        xs[i, r] = ratio[r] / np.linalg.norm(ratio[r])
    xs[:, 30] = 1
    v = np.concatenate((w[:30], [bias]))
    s = np.where(y == 1, 1.0, -1.0)
    slack = np.maximum(0, 1 - s * (xs @ v))
    gradient = v - 2 * xs.T @ (s * slack)
    assert np.abs(gradient).max() < 1e-2


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_odd_documents_and_no_labels(spark, odd_docs, no_docs, module):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = module.train(odd_docs, labels)
    rows = module.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert module.score(no_docs, model).count() == 0
    some = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (5, 0, 1), (7, 1, 0), (11, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    model = module.train(odd_docs, some)
    rows = module.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_isotonic_matches_definition():
    x, p = boosting.fit_isotonic(np.array([1., 2, 2, 3, 4, 5]), np.array([0, 1, 0, 0, 1, 1]))
    assert np.all(np.diff(p) >= 0) and np.all(np.diff(x) > 0)
    assert np.interp([1, 2, 3, 4, 5], x, p).tolist() == pytest.approx([0, 1 / 3, 1 / 3, 1, 1])


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(int)
    model = boosting.fit_boosted(x[:1500], y[:1500])
    assert ((model.raw(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_hidden_spellings_and_distance_are_features():
    import pyarrow as pa

    lex = toxicity.Lexicon({"idiot": 5.0}, {"lowei": 4.0})
    x = toxicity.features(pa.array(["you are an idiot", "an 1d1ot!", "loweiding word", "lowei", "clean text", "", None]), lex)
    col = {n: i for i, n in enumerate(toxicity.NAMES)}
    assert x[0, col["lexicon_strength"]] == 5 and x[0, col["second_near"]] == pytest.approx(1 / 4)
    assert x[1, col["obfuscated"]] > 0 and x[1, col["lexicon_strength"]] == 5
    assert x[2, col["lexicon_strength"]] == 4 and x[3, col["lexicon_strength"]] == 0
    assert x[4, :8].sum() == 0 and (x[5:] == 0).all()
