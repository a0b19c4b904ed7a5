"""Penalty paths against MLlib and against the definition."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hearthspark.operators import elastic as el
from hearthspark.operators import models as md
from hearthspark.plans import training as tr
from hearthspark.session import fresh_path, materialize

PENALTIES = [0.3 * 0.001 ** (i / 24) for i in range(25)]
FOLDS = 4


def drawn():
    source = np.random.default_rng(1)
    x = source.normal(size=(700, 7))
    x[:, 1] = 2 * x[:, 0] + 0.1 * source.normal(size=700)
    x[:, 5] = 3.0
    x[:, 6] = x[:, 2]
    x *= np.array([1, 10, 0.1, 1, 1, 1, 1])
    y = (1 / (1 + np.exp(-(x[:, 0] - 8 * x[:, 2] + 0.5))) > source.random(700)).astype(int)
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = drawn()
    listed = [(i % FOLDS, int(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return materialize(spark.createDataFrame(listed, "fold int, label int, features array<double>").repartition(3))


@pytest.fixture(scope="module")
def path(rows):
    return el.logistic_path(rows, PENALTIES, 0.5, FOLDS, block=10)


def mllib(df, penalty):
    fitted = LogisticRegression(elasticNetParam=0.5, regParam=penalty, maxIter=500, tol=1e-10).fit(df)
    return np.concatenate(([fitted.intercept], fitted.coefficients.toArray()))


@pytest.mark.parametrize("i", [0, 12, 24])
def test_coefficients_are_mllibs(rows, path, i):
    found = mllib(rows.withColumn("features", array_to_vector("features")), PENALTIES[i])
    assert np.abs(found - path.coefficients[i]).max() < 1e-4


def test_held_out_losses_are_those_of_single_fits(rows, path):
    x, y = drawn()
    z = np.column_stack((np.ones(len(x)), x))
    fold = np.arange(len(x)) % FOLDS
    vectors = rows.withColumn("features", array_to_vector("features"))
    for f, i in ((0, 5), (3, 20)):
        margin = z[fold == f] @ mllib(vectors.filter(F.col("fold") != f), PENALTIES[i])
        loss = (np.logaddexp(0, margin) - y[fold == f] * margin).mean()
        assert loss == pytest.approx(path.losses[i, f], abs=1e-5)


def test_optimality_of_every_fit(path):
    """No coefficient can move: the gradient balances the penalty, or stays within it at zero."""
    x, y = drawn()
    spread = x.std(axis=0, ddof=1)
    for penalty, b in zip(PENALTIES, path.coefficients, strict=True):
        p = 1 / (1 + np.exp(-(b[0] + x @ b[1:])))
        assert abs((y - p).mean()) < 1e-6
        for j in range(x.shape[1]):
            if spread[j] < 1e-9:
                assert b[1 + j] == 0
                continue
            pull = (x[:, j] / spread[j] * (y - p)).mean() - penalty * 0.5 * b[1 + j] * spread[j]
            limit = penalty * 0.5
            assert abs(pull - limit * np.sign(b[1 + j])) < 1e-5 if b[1 + j] else abs(pull) < limit + 1e-6


def test_passes_do_not_follow_penalties_and_folds(path):
    assert path.passes < 40 < len(PENALTIES) * (FOLDS + 1)


def test_equal_columns_share_a_coefficient(path):
    # Columns 2 and 6 are one but for their unit.
    assert np.allclose(path.coefficients[:, 3] * 0.1, path.coefficients[:, 7], atol=1e-5)


def test_blocks_change_nothing(rows, path):
    other = el.logistic_path(rows, PENALTIES, 0.5, FOLDS, block=4)
    assert np.abs(other.coefficients - path.coefficients).max() < 1e-4
    assert np.abs(other.losses - path.losses).max() < 1e-5


def test_a_scorer_of_the_path_is_saved_and_loaded(spark, survey):
    names = ["P5000", "Nper", "Li", "Fex_c"]
    train = materialize(survey.train.select("id", "Pobre", *names))
    results, scorer, path = tr.elastic_path(train, names, n_penalties=8, k=3)
    assert results.count() == 8 and path.coefficients.shape == (8, 5)
    assert np.allclose(path.coefficients[0, 1:], 0, atol=1e-3)
    where = fresh_path(spark, "scorer")
    scorer.with_threshold(0.4).save(spark, where)
    loaded = md.Scorer.load(spark, where)
    assert loaded.threshold == 0.4
    ours = {r["id"]: r["score"] for r in scorer.score(survey.test).collect()}
    assert ours == {r["id"]: r["score"] for r in loaded.score(survey.test).collect()}
    assert all(0 < value < 1 for value in ours.values())


def test_sums_of_all_models_are_those_of_each_alone(monkeypatch):
    """One product of matrices a chunk gives all models' sums, in place of one for each model."""
    monkeypatch.setattr(el, "CHUNK", 300)
    x, y = drawn()
    source = np.random.default_rng(2)
    fold, left_out = source.integers(0, FOLDS, len(x)).astype(np.int32), np.array([-1, 0, 3, 2, -1])
    betas = source.normal(size=(5, 8)) * 30
    batch = pa.RecordBatch.from_arrays([pa.array(fold), pa.array(y.astype(float)), pa.array(list(x))], names=list("abc"))
    made = []

    def in_one_task(_, add_up):
        real = el.pair_products
        monkeypatch.setattr(el, "pair_products", lambda z: (made.append(len(z)), real(z))[1])
        return add_up(iter([batch]))

    monkeypatch.setattr(el, "sum_arrays", in_one_task)
    loss, held_out, gradient, products = el.newton_sums(None, betas, left_out)
    assert made == [300, 300, 100]
    z = np.column_stack((np.ones(len(x)), x))
    for m in range(5):
        margin, seen = z @ betas[m], fold != left_out[m]
        one, p = np.logaddexp(0, margin) - y * margin, 1 / (1 + np.exp(-margin))
        assert loss[m] == pytest.approx(one[seen].sum()) and held_out[m] == pytest.approx(one[~seen].sum())
        assert gradient[m] == pytest.approx(z[seen].T @ (y - p)[seen], abs=1e-8)
        assert np.allclose(products[m], z.T @ ((p * (1 - p) * seen)[:, None] * z), atol=1e-8)
