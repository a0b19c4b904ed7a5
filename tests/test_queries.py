"""Every query with SQL gives the rows DuckDB gives; the others give rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hearthspark.plans.catalog import all_queries
from hearthspark.operators import metrics
from hearthspark.sources.survey import LABEL, Survey
from tests.comparison import difference, duck
from tests.conftest import SMALL

# The queries of the text subpackage have tests of their own.
WITH_SQL = sorted(name for name in oracle_sql() if name in all_queries())
PREDICTING = ("rf_predict", "gbt_predict", "gbt_early_stop", "mlp_predict", "batch_score", "stacking_predict",
              "elasticnet_logistic")
OVER_FOLDS = ("rf_cross_validate", "gbt_cross_validate")
IMPORTANCES = ("feature_importance", "split_importance", "adversarial_importance")
SEARCHES = {"random_search": (20, 1000), "nn_search": (75, 100)}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_sql(spark, con, name):
    assert difference(queries()[name](spark, SMALL), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", PREDICTING)
def test_predictions_beat_the_majority(spark, name):
    """Every test household once, scores within 0 and 1, and a quality that no constant answer reaches."""
    survey = Survey(spark, SMALL)
    truth = survey.households.filter("part = 'test'").selectExpr("id", f"{LABEL} as label")
    made = queries()[name](spark, SMALL)
    rows = made.join(truth, "id").select("id", "label", "score", "prediction").collect()
    assert made.count() == len(rows) == len({r["id"] for r in rows}) == truth.count()
    assert all(0 <= r["score"] <= 1 and r["prediction"] in (0, 1) for r in rows)
    table = spark.createDataFrame(rows, "id long, label int, score double, prediction int")
    share = sum(r["label"] for r in rows) / len(rows)
    assert metrics.roc_auc(table).first()["auc"] > 0.8
    assert metrics.scores(table, 1).first()["f1"] > 2 * share / (1 + share)
    assert sum(r["label"] == r["prediction"] for r in rows) / len(rows) > max(share, 1 - share)


def test_weighted_network_ranks_and_finds_the_rarer_class(spark):
    """With balanced class weights F1 and ranking count, not the share of right answers."""
    survey = Survey(spark, SMALL)
    truth = survey.households.filter("part = 'test'").selectExpr("id", f"{LABEL} as label")
    rows = queries()["nn_predict"](spark, SMALL).join(truth, "id").select("id", "label", "score", "prediction", "epochs").collect()
    assert len({r["id"] for r in rows}) == len(rows) == truth.count()
    assert all(0 <= r["score"] <= 1 and r["prediction"] in (0, 1) and 1 <= r["epochs"] <= 100 for r in rows)
    table = spark.createDataFrame(rows)
    share = sum(r["label"] for r in rows) / len(rows)
    assert metrics.roc_auc(table).first()["auc"] > 0.8
    assert metrics.scores(table, 1).first()["f1"] > 1.3 * 2 * share / (1 + share)


@pytest.mark.parametrize("name", OVER_FOLDS)
def test_folds_are_better_than_chance(spark, name):
    rows = queries()[name](spark, SMALL).collect()
    assert rows and all(v is None or 0 <= v <= 1 for r in rows for v in r.asDict().values() if isinstance(v, float))


@pytest.mark.parametrize("name", IMPORTANCES)
def test_importances_cover_the_features(spark, name):
    rows = queries()[name](spark, SMALL).collect()
    assert len({r["feature"] for r in rows}) == len(rows) > 10


@pytest.mark.parametrize("name", SEARCHES)
def test_searches_give_most_to_the_best(spark, name):
    runs, most = SEARCHES[name]
    rows = queries()[name](spark, SMALL).collect()
    assert sorted(r["run"] for r in rows) == list(range(runs))
    assert all(0 <= r["f1"] <= 1 and 1 <= r["kept"] <= r["spent"] <= most for r in rows)
    # Each halving leaves at least half of the draws with what they had.
    spent = sorted((r["spent"] for r in rows), reverse=True)
    assert spent[0] > spent[runs // 2] >= spent[-1]


def test_penalties_have_a_least_loss(spark):
    rows = queries()["elasticnet_path"](spark, SMALL).collect()
    penalties = [r["penalty"] for r in rows]
    assert len(rows) == 100 and penalties == sorted(penalties, reverse=True)
    # The first penalty leaves the shares alone: log 2 on balanced rows.
    assert rows[0]["metric"] == pytest.approx(0.693, abs=0.01) and min(r["metric"] for r in rows) < rows[0]["metric"]


def test_the_two_parts_are_told_apart_within_bounds(spark):
    (row,) = queries()["adversarial_validation"](spark, SMALL).collect()
    assert 0.5 <= row["auc"] <= 1
    cells = queries()["adversarial_confusion"](spark, SMALL).collect()
    assert len(cells) == 4 and sum(r["n"] for r in cells) > 0


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["household_features_join", "rfeat_all", "window_group_broadcast", "ks_two_sample",
                                  "stratum_matched_sample", "roc_auc", "threshold_sweep", "nested_proportions"])
def test_no_query_multiplies_tables(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_the_answers_it_needs(spark):
    plan = queries()["feat_age_counts"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_first_rows_are_thinned_before_the_shuffle(spark):
    plan = queries()["first_row_per_key"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
