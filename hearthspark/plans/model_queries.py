"""Queries that fit models on all training households and score all others.

Fits have the published sizes, the defaults of the library functions, where the README doesn't say otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.operators import columns as c
from hearthspark.operators import metrics as m
from hearthspark.operators import models as md
from hearthspark.operators import sampling as sm
from hearthspark.operators.boosting import Boost
from hearthspark.operators.encode import apply_scale
from hearthspark.plans import training as tr
from hearthspark.plans.registry import query, with_tables
from hearthspark.session import fresh_path, materialize
from hearthspark.sources.files import export_predictions
from hearthspark.sources.survey import LABEL, Survey

SEED = 42


@query()
def rf_predict(s: Survey) -> DataFrame:
    train, test, names = tr.modelling_tables(s)
    balanced = materialize(sm.undersample(train, "id", LABEL, SEED))
    scorer = md.fit_scorer(balanced, md.forest(), names, scale=False, threshold=0.75,
                           categories=tr.categories(train))
    return scorer.predict(test)


@query()
def feature_importance(s: Survey) -> DataFrame:
    train, _, names = tr.modelling_tables(s)
    scorer = md.fit_scorer(train, md.forest(), names, scale=False, categories=tr.categories(train))
    return md.feature_importance(scorer, s.spark)


@query()
def split_importance(s: Survey) -> DataFrame:
    train, _, names = tr.modelling_tables(s)
    scorer, _ = md.fit_boosted_scorer(train, names, Boost(), categories=tr.categories(train))
    return md.split_importance(scorer, s.spark)


@query()
def rf_cross_validate(s: Survey) -> DataFrame:
    train, _, names = tr.modelling_tables(s, filled=False)
    checked, _ = tr.forest_flow(train, names, k=5, final=False)
    return m.fold_summary(checked.per_fold, ["auc", "precision", "recall", "f1"])


@query()
def elasticnet_logistic(s: Survey) -> DataFrame:
    train, test, names = tr.modelling_tables(s)
    balanced = materialize(sm.undersample(train, "id", LABEL, SEED))
    _, scorer, _ = tr.elastic_path(balanced, names)
    return scorer.predict(test)


@query()
def elasticnet_path(s: Survey) -> DataFrame:
    """The cross-validated loss of each of the 100 penalties, the largest first."""
    train, _, names = tr.modelling_tables(s)
    balanced = materialize(sm.undersample(train, "id", LABEL, SEED))
    return tr.elastic_path(balanced, names)[0]


@query()
def elasticnet_grid(s: Survey) -> DataFrame:
    train, _, names = tr.modelling_tables(s)
    results, _ = tr.elastic_grid(train, names)
    return results


@query()
def gbt_predict(s: Survey) -> DataFrame:
    train, test, names = tr.modelling_tables(s)
    weights = sm.class_weights(train, LABEL, boost={1: 1.5})
    scorer, _ = md.fit_boosted_scorer(train, names, Boost(), weights=weights, categories=tr.categories(train))
    return scorer.predict(test)


@query()
def gbt_early_stop(s: Survey) -> DataFrame:
    """Boosting that ends after 10 rounds without gain on held-out rows; ``rounds`` are those kept."""
    train, test, names = tr.modelling_tables(s)
    boost = Boost(rounds=md.PATIENT_ROUNDS, patience=md.PATIENCE)
    scorer, _ = tr.boost_with_patience(train, names, boost=boost, categories=tr.categories(train))
    return scorer.predict(test).withColumn("rounds", F.lit(len(scorer.model.trees)))


def _adversarial(s: Survey) -> tr.Adversarial:
    """Train against test households by all columns but key, label and expansion factors."""
    train, test, _ = tr.modelling_tables(s)
    texts = tr.categories(train)
    names = c.feature_names(train, ["id", LABEL, "Fex_c", "Fex_dpto", *texts])
    return tr.adversarial_validation(train, test, names, texts=texts)


@query()
def adversarial_validation(s: Survey) -> DataFrame:
    return _adversarial(s).metrics


@query()
def adversarial_confusion(s: Survey) -> DataFrame:
    return _adversarial(s).confusion


@query()
def adversarial_importance(s: Survey) -> DataFrame:
    return _adversarial(s).importances


@query()
def stacking_predict(s: Survey) -> DataFrame:
    """Two kinds of learners (by levels, best-first) stacked on training rows scaled and brought to parity by SMOTE; the
    cut-off from held-out rows."""
    train, test, names = tr.modelling_tables(s)
    split = materialize(sm.split_stratified(train, "id", LABEL, 0.8, SEED))
    fitted = split.filter("split = 'train'")
    scale = md.fit_inputs(fitted, names).scale
    balanced = materialize(tr.smote_rows(apply_scale(fitted, scale), names))
    stack = tr.fit_stack(balanced, tr.boosted_pair(names, Boost(**md.TUNED_BOOST)), k=5)
    held = apply_scale(split.filter("split = 'test'"), scale)
    threshold = tr.tune_threshold(stack.score(held, ["id", LABEL]))
    return m.apply_cutoff(stack.score(apply_scale(test, scale)), threshold, op=">=")


@query()
def mlp_predict(s: Survey) -> DataFrame:
    train, test, names = tr.modelling_tables(s)
    balanced = materialize(sm.undersample(train, "id", LABEL, SEED))
    texts = tr.categories(train)
    width = len(md.fit_inputs(balanced, names, scale=False, categories=texts).inputs)
    scorer = md.fit_scorer(balanced, md.perceptron(width), names, categories=texts)
    return scorer.predict(test)


@query()
def nn_predict(s: Survey) -> DataFrame:
    """Class weights in place of undersampling, stopped by F1 on held-out rows; ``epochs`` are those run."""
    train, test, names = tr.modelling_tables(s)
    scorer, scores = tr.network_with_patience(train, names, categories=tr.categories(train))
    return scorer.predict(test).withColumn("epochs", F.lit(len(scores)))


@query()
def batch_score(s: Survey) -> DataFrame:
    """Fit, save, load, and score the test households with the loaded scorer."""
    train, test, names = tr.modelling_tables(s)
    path = fresh_path(s.spark, "scorer")
    md.fit_scorer(train, md.elastic_logistic(0.0, 0.01), names, threshold=0.4,
                  categories=tr.categories(train)).save(s.spark, path)
    return md.Scorer.load(s.spark, path).predict(test)


@query(with_tables("select id, case when 1-Fex_c/500>0.8e0 then 1 else 0 end as pobre from test"))
def prediction_export(s: Survey) -> DataFrame:
    """The written prediction file read back; the score is a column expression so that SQL can follow."""
    predicted = m.apply_cutoff(s.test.select("id", (1 - F.col("Fex_c") / 500).alias("score")), 0.8)
    return export_predictions(predicted, s.test, fresh_path(s.spark, "predictions"))


@query()
def gbt_cross_validate(s: Survey) -> DataFrame:
    """Three folds, each scaled and brought to parity by SMOTE before boosting that watches the fold left out."""
    train, _, names = tr.modelling_tables(s)
    texts = tr.categories(train)
    boost = Boost(rounds=md.PATIENT_ROUNDS, patience=md.PATIENCE)

    def fit(rows: DataFrame, left_out: DataFrame) -> md.Scorer:
        return tr.boost_on_smote(rows, left_out, names, boost, texts=texts)

    checked = tr.cross_validate(train, None, k=3, width=3, watching=fit)
    return m.fold_summary(checked.per_fold, ["auc", "precision", "recall", "f1"])


@query()
def random_search(s: Survey) -> DataFrame:
    """The search over boosted trees: 20 draws by successive halving, with the rounds each was given."""
    train, _, names = tr.modelling_tables(s)
    return tr.halving_search(train, names, texts=tr.categories(train)).results


@query()
def nn_search(s: Survey) -> DataFrame:
    """The search over networks: 75 draws by successive halving, with the epochs each was given."""
    train, _, names = tr.modelling_tables(s)
    return tr.network_search(train, names, texts=tr.categories(train)).results
