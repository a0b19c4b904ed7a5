"""Registered fits have the published sizes."""

from __future__ import annotations

import inspect

import pytest

from hearthspark.operators import models as md
from hearthspark.operators.boosting import Boost
from hearthspark.operators.neural import Network
from hearthspark.plans import model_queries as mq
from hearthspark.plans import training as tr


class Asked(Exception):
    """Carries the settings a query asks for, before anything is fitted."""


class Rows:
    def filter(self, _) -> Rows:
        return self


def ask(monkeypatch, module, name: str, build) -> dict:
    real = inspect.signature(getattr(module, name))

    def recorder(*args, **settings):
        bound = real.bind(*args, **settings)
        bound.apply_defaults()
        raise Asked(bound.arguments)

    monkeypatch.setattr(tr, "modelling_tables", lambda s, **_: (None, None, []))
    monkeypatch.setattr(tr, "categories", lambda train: [])
    monkeypatch.setattr(mq, "materialize", lambda df: df)
    monkeypatch.setattr(mq.sm, "undersample", lambda *_: None)
    monkeypatch.setattr(mq.sm, "class_weights", lambda *_, **__: None)
    monkeypatch.setattr(mq.sm, "split_stratified", lambda *_, **__: Rows())
    monkeypatch.setattr(mq, "apply_scale", lambda *_: None)
    monkeypatch.setattr(mq.c, "feature_names", lambda *_: [])
    monkeypatch.setattr(tr, "smote_rows", lambda *_: None)
    monkeypatch.setattr(md, "fit_inputs", lambda *_, **__: type("Blank", (), {"inputs": [], "scale": {}}))
    monkeypatch.setattr(module, name, recorder)
    with pytest.raises(Asked) as found:
        build(None)
    return found.value.args[0]


@pytest.mark.parametrize("module, name, build, sizes", [
    (md, "forest", mq.rf_predict, {"trees": 500}),
    (md, "forest", mq.feature_importance, {"trees": 500}),
    (tr, "forest_flow", mq.rf_cross_validate, {"trees": 500, "k": 5}),
    (tr, "adversarial_validation", mq.adversarial_validation, {"trees": 100}),
    (tr, "adversarial_validation", mq.adversarial_confusion, {"trees": 100}),
    (tr, "elastic_path", mq.elasticnet_logistic, {"n_penalties": 100, "k": 10}),
    (tr, "network_with_patience", mq.nn_predict, {"network": Network()}),
    (tr, "network_search", mq.nn_search, {"space": tr.NETWORK_SPACE, "runs": 75, "epochs": 100}),
    (md, "perceptron", mq.mlp_predict, {"rounds": 100}),
    (tr, "halving_search", mq.random_search, {"space": tr.BOOST_SPACE, "runs": 20}),
    (md, "fit_boosted_scorer", mq.gbt_predict, {"boost": Boost(**md.BOOST)}),
    (md, "fit_boosted_scorer", mq.split_importance, {"boost": Boost(**md.BOOST)}),
    (tr, "boost_with_patience", mq.gbt_early_stop, {"boost": Boost(rounds=1000, patience=10)}),
    (tr, "boosted_pair", mq.stacking_predict, {"boost": Boost(**md.TUNED_BOOST)}),
])
def test_published_size(monkeypatch, module, name, build, sizes):
    asked = ask(monkeypatch, module, name, build)
    assert {key: asked[key] for key in sizes} == sizes
