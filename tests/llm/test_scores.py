"""Fitted models: held-out accuracy on the given tables, and the additive model by itself."""

import numpy as np
import pytest

from stationflow.llm import additive, quality, toxicity
from stationflow.llm.labels import bounded


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    model = additive.fit(x, y)
    assert ((additive.scored(model, x) >= 0.5) == y).mean() > 0.95


def test_without_both_labels_the_score_is_their_share():
    assert additive.scored(additive.fit(np.zeros((0, 1)), np.zeros(0)), np.zeros((2, 4))).tolist() == [0.5, 0.5]
    assert additive.scored(additive.fit(np.ones((9, 1)), np.ones(9)), np.ones((1, 1)))[0] == pytest.approx(0.95)


@pytest.mark.parametrize(("query", "label", "least"), [(quality.op5_quality_classifier, "quality", 0.97), (toxicity.op1_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.01"
    rows = query(spark, sf).toPandas()
    assert len(rows) == 1000 and rows.score.between(0, 1).all()
    both = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(rows, on="doc_id")
    held = both[both.held_out]
    assert len(held) > 50 and (held.predicted == held[label]).mean() >= least


def test_sample_is_the_least_marks(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS y", "xxhash64(id) AS mark")
    marks = sorted(r.mark for r in rows.collect())
    for most in (0, 40, 2400, 2600, 9000):
        assert sorted(r.mark for r in bounded(rows, most).collect()) == marks[:most]


@pytest.mark.parametrize(("query", "label", "sf", "recall", "precision", "area"), [
    (quality.op5_quality_classifier, "quality", "/root/testdata/sf0.01", 0.97, 0.97, 0.99),
    (toxicity.op1_toxicity, "toxic", "/root/testdata/sf0.1", 0.85, 0.85, 0.97)])
def test_held_out_ranking(spark, query, label, sf, recall, precision, area):
    """What constant scores cannot reach: recall, precision and the share of pairs in the right order.

    The smaller table has 14 held-out toxic rows, too few to rank.
    """
    held = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(query(spark, sf).toPandas(), on="doc_id")
    held = held[held.held_out]
    yes, no = held[held[label] == 1], held[held[label] == 0]
    hits = (yes.predicted == 1).sum()
    assert hits / len(yes) >= recall and hits / (held.predicted == 1).sum() >= precision
    order = yes.score.to_numpy()[:, None] - no.score.to_numpy()[None, :]
    assert ((order > 0) + 0.5 * (order == 0)).mean() >= area
