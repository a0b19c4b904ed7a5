"""The neural classifier: gradients by differences, patience, parts, and its place in a scorer."""

from __future__ import annotations

import numpy as np
import pytest

from hearthspark.operators import metrics as m
from hearthspark.operators import models as md
from hearthspark.operators import neural as nn
from hearthspark.operators.neural import Network
from hearthspark.session import fresh_path, materialize

SCHEMA = "key long, label int, weight double, held boolean, features array<double>"


def frame(spark, n=600, seed=1):
    source = np.random.default_rng(seed)
    x = source.normal(size=(n, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (source.random(n) < 0.05)).astype(int)
    rows = [(i, int(a), 1.0, i % 4 == 0, b.tolist()) for i, (a, b) in enumerate(zip(y, x, strict=True))]
    return materialize(spark.createDataFrame(rows, SCHEMA).repartition(2))


def test_gradient_is_that_of_differences():
    source = np.random.default_rng(3)
    network = Network(hidden=(5, 4), dropout=0.3)
    weights = nn.Weights(network, 3)
    weights.values += 0.1 * source.normal(size=len(weights.values))
    x, y, weight = source.normal(size=(9, 3)), source.integers(0, 2, 9), source.random(9) + 0.5
    masks = [(source.random((9, n)) >= 0.3) / 0.7 for n in network.hidden]
    _, gradient, _ = nn.loss_and_gradient(weights, x, y, weight, masks)
    for i in range(len(weights.values)):
        losses = []
        for step in (1e-6, -1e-6):
            moved = weights.values.copy()
            moved[i] += step
            losses.append(nn.loss_and_gradient(nn.Weights(network, 3, moved), x, y, weight, masks)[0])
        assert gradient[i] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-5)


def test_class_weights_move_the_loss():
    weights = nn.Weights(Network(hidden=(4,), dropout=0.0), 2)
    x, y = np.array([[0.0, 1.0], [1.0, 0.0], [1.0, 1.0]]), np.array([0, 1, 1])
    ones = [np.ones((3, 4))]
    twice = nn.loss_and_gradient(weights, x, y, np.array([2.0, 1, 1]), ones)
    alike = nn.loss_and_gradient(weights, x, y, np.ones(3), ones)
    chance = [nn.loss_and_gradient(weights, x, y, np.eye(3)[i] + 1e-12, ones)[0] for i in range(3)]
    assert alike[0] == pytest.approx(np.mean(chance)) and twice[0] == pytest.approx(np.average(chance, weights=[2, 1, 1]))


def test_learns_what_no_linear_model_can(spark):
    rows = frame(spark)
    model, scores = nn.fit_network(rows, Network(hidden=(16, 8), dropout=0.0, rate=0.01, epochs=30, patience=8))
    assert max(scores) > 0.85
    # The weights of the best epoch are kept, and training ended at most ``patience`` epochs after it.
    assert len(scores) - int(np.argmax(scores)) <= 9 or len(scores) == 30
    held = rows.filter("held")
    x = np.array([r["features"] for r in held.select("features").collect()])
    y = np.array([r["label"] for r in held.select("label").collect()])
    out = nn.logits(nn.Weights(model.network, 4, np.array(model.values)), np.array(model.running), x)
    yes = out[:, 1] > out[:, 0]
    assert 2 * (yes & (y == 1)).sum() / (yes.sum() + y.sum()) == pytest.approx(max(scores))


def test_parts_are_averaged(spark):
    rows = frame(spark)
    network = Network(hidden=(16, 8), dropout=0.1, rate=0.01, epochs=25, patience=25)
    _, one = nn.fit_network(rows, network)
    _, many = nn.fit_network(rows, network, part_bytes=12_000)
    assert len(many) == len(one) == 25 and max(many) > 0.75
    assert nn.fit_network(rows, network)[1] == one


def test_no_rows(spark):
    rows = frame(spark, 20)
    with pytest.raises(ValueError, match="no rows"):
        nn.fit_network(rows.withColumn("held", rows.key >= 0), Network())
    model, scores = nn.fit_network(rows.withColumn("held", rows.key < 0), Network(hidden=(4,), epochs=2))
    assert scores == [0.0, 0.0] and len(model.values) > 0


def test_a_scorer_is_saved_and_loaded(spark, survey):
    names = ["P5000", "Nper", "Fex_c"]
    train = materialize(survey.train.select("id", "Pobre", "Dominio", *names))
    scorer, _ = md.fit_network_scorer(train, names, Network(hidden=(8,), rate=0.01, epochs=4), categories=["Dominio"])
    where = fresh_path(spark, "scorer")
    scorer.save(spark, where)
    loaded = md.Scorer.load(spark, where)
    assert loaded.model == scorer.model
    ours = {r["id"]: r["score"] for r in scorer.score(survey.test).collect()}
    assert ours == {r["id"]: r["score"] for r in loaded.score(survey.test).collect()}
    scored = scorer.predict(train, ["id", "Pobre"])
    assert m.roc_auc(scored.withColumnRenamed("Pobre", "label")).first()["auc"] > 0.7
