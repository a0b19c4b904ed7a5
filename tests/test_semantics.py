"""Hand-made tables for each rule about missing answers, ties and zero denominators."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from hearthspark.functions.pvalues import student_tail
from hearthspark.operators import columns as c
from hearthspark.operators import drift as d
from hearthspark.operators import encode as e
from hearthspark.operators import features as ft
from hearthspark.operators import impute as i
from hearthspark.operators import joins as j
from hearthspark.operators import metrics as m
from hearthspark.operators import models as md
from hearthspark.operators import profile as p
from hearthspark.operators import sampling as sm
from hearthspark.plans import prepare as pr
from hearthspark.plans import training as tr

NULL = None


def persons(spark, schema, groups):
    rows = [(key, *(v if isinstance(v, tuple) else (v,))) for key, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "id string, " + schema)


def by_id(df, *names):
    return {row["id"]: tuple(row[n] for n in names) if len(names) > 1 else row[names[0]] for row in df.collect()}


def test_two_readings_of_any(spark):
    t = persons(spark, "P6210 int", {"h1": [6, NULL], "h2": [1, NULL], "h3": [NULL, NULL], "h4": [1, 2]})
    two = ft.build_features(t, [ft.university()])
    assert by_id(two, "has_university_education") == {"h1": 1, "h2": 0, "h3": 0, "h4": 0}
    three = ft.build_features(t, [ft._known_flag("known", lambda: F.col("P6210") == 6)])
    assert by_id(three, "known") == {"h1": 1, "h2": NULL, "h3": NULL, "h4": 0}


def test_share_leaves_out_unknown_conditions(spark):
    t = persons(spark, "P6240 int, P6430 int", {"h1": [(1, 1), (1, NULL), (2, NULL)], "h2": [(NULL, NULL)]})
    got = ft.build_features(t, ft.employment_2())
    assert by_id(got, "share_empleado_privado") == {"h1": 50.0, "h2": NULL}


def test_activity_mode_diversity_and_rate(spark):
    t = persons(spark, "P6240 int", {"h1": [3, 1, 3, 1], "h2": [NULL], "h3": [5], "h4": [1, 2, 2], "h5": [3, 4]})
    got = by_id(ft.build_features(t, ft.activity()), "P6240_main_household_activity", "P6240_activity_diversity",
                "P6240_unemployment_rate", "P6240_someone_works")
    assert got["h1"] == (1, 0.5, 0.0, 1)
    assert got["h2"] == (0, 0.0, 0.0, 0)
    assert got["h3"] == (5, 0.0, 0.0, 0)
    assert got["h4"][2] == pytest.approx(2 / 3)
    assert got["h5"][2] == 0.0


def test_open_domain_forms_agree_with_the_listed_ones(spark, survey):
    listed = ft.build_features(survey.persons, ft.activity())
    mode = ft.answer_mode(survey.persons, "P6240", "mode")
    diversity = ft.answer_diversity(survey.persons, "P6240", "diversity")
    both = listed.join(mode, "id").join(diversity, "id")
    odd = both.filter((F.col("mode") != F.col("P6240_main_household_activity"))
                      | (F.abs(F.col("diversity") - F.col("P6240_activity_diversity")) > 1e-12))
    assert both.count() == listed.count() and odd.count() == 0


def test_answers_outside_the_code_list_count(spark):
    t = persons(spark, "P6240 int", {"h1": [1, 77], "h2": [77, 77, 2], "h3": [88, 77, 77, 88], "h4": [1, 1, 77],
                                     "h5": [NULL], NULL: [99, 2, 99]})
    got = ft.build_features(t, ft.activity())
    assert by_id(got, "P6240_main_household_activity") == {"h1": 1, "h2": 77, "h3": 77, "h4": 1, "h5": 0, NULL: 99}
    shares = {"h1": 0.5, "h2": 1 - 5 / 9, "h3": 0.5, "h4": 1 - 5 / 9, "h5": 0, NULL: 1 - 5 / 9}
    assert by_id(got, "P6240_activity_diversity") == pytest.approx(shares)
    listed = ft.build_features(t, ft.activity((1, 77, 88, 99)))
    assert by_id(listed, "P6240_main_household_activity") == by_id(got, "P6240_main_household_activity")


def test_pension_status(spark):
    t = persons(spark, "P6920 int", {"h1": [1, 2], "h2": [1, 1], "h3": [3, 3], "h4": [2, NULL], "h5": [2, 3],
                                     "h6": [NULL], "h7": [1, NULL]})
    got = by_id(ft.build_features(t, ft.pension()), "pension_status")
    assert got == {"h1": "mixed", "h2": "all_contributing", "h3": "all_pensioners", "h4": "none", "h5": "other",
                   "h6": NULL, "h7": "mixed"}


def test_dependency_ratio(spark):
    t = persons(spark, "P6040 int", {"h1": [10, 40, 70], "h2": [70, 80], "h3": [15, 64], "h4": [14, 65]})
    got = by_id(ft.build_features(t, [ft.dependency()]), "dependency_ratio")
    assert got == {"h1": 2.0, "h2": math.inf, "h3": 0.0, "h4": math.inf}


def test_education_hours_and_rooms(spark):
    t = persons(spark, "P6210 int, P6800 int", {"h1": [(2, 40), (9, NULL), (NULL, NULL)], "h2": [(1, NULL)]})
    got = by_id(ft.build_features(t, [ft.education_sum(), *ft.hours_2()]),
                "educ_attainment", "horas_total_bruto", "horas_promedio_bruto")
    assert got == {"h1": (9, 40, 40.0), "h2": (0, 0, 0.0)}
    rooms = spark.createDataFrame([("a", 4, 2, 1), ("b", 0, 2, 2), ("c", NULL, 2, NULL)],
                                  "id string, P5000 int, P5010 int, P5090 int")
    assert by_id(ft.housing_flags(rooms), "cuartospersona", "casa_propia") == {"a": (0.5, 1), "b": (0.0, 0),
                                                                               "c": (0.0, 0)}


def test_household_without_persons_keeps_its_row(spark):
    t = persons(spark, "P6240 int", {"h1": [1]})
    households = spark.createDataFrame([("h1",), ("h2",)], "id string")
    chosen = ft.activity()
    got = by_id(ft.join_features(households, ft.build_features(t, chosen), chosen), "P6240_main_household_activity",
                "P6240_unemployment_rate")
    assert got == {"h1": (1, 0.0), "h2": (0, 0.0)}


def test_auc_and_best_cutoff(spark):
    t = spark.createDataFrame([(1, .9), (0, .8), (1, .7), (0, .1)], "label int, score double")
    assert m.roc_auc(t).first()["auc"] == 0.75
    flipped = t.withColumn("score", -F.col("score"))
    assert m.roc_auc(flipped).first()["auc"] == 0.25
    assert m.roc_auc(flipped, either_direction=True).first()["auc"] == 0.75
    best = m.best_threshold(m.precision_recall_curve(t)).first()
    assert best["threshold"] == 0.7 and best["f1"] == pytest.approx(0.8, abs=1e-6)
    sweep = {r["threshold"]: r for r in m.threshold_table(t, [0.05, 0.5, 0.7, 0.95]).collect()}
    assert sweep[0.05]["recall"] == 1 and sweep[0.5]["f1"] == pytest.approx(0.8)
    assert sweep[0.7]["recall"] == 0.5 and sweep[0.95]["f1"] == 0


def test_positive_class_decides_f1(spark):
    t = spark.createDataFrame([(0, 0)] * 8 + [(1, 0), (1, 1)], "label int, prediction int")
    assert m.scores(t, 0).first()["f1"] == pytest.approx(16 / 17)
    assert m.scores(t, 1).first()["f1"] == pytest.approx(2 / 3)
    empty = spark.createDataFrame([(0, 0)], "label int, prediction int")
    assert m.scores(empty, 1).first()["f1"] == 0 and m.scores(empty, 1, undefined=None).first()["f1"] is None


def test_kolmogorov_smirnov(spark):
    a = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "x int")
    b = spark.createDataFrame([(x,) for x in (3, 4, 5, 6)], "x int")
    assert d.kolmogorov_smirnov(a, b, ["x"]).first()["d"] == 0.5
    assert d.kolmogorov_smirnov(b, a, ["x"]).first()["d"] == 0.5
    same = d.kolmogorov_smirnov(a, a, ["x"]).first()
    assert same["d"] == 0 and same["p_value"] == 1
    # The two forms of the limit law meet at 1.
    grid = spark.createDataFrame([(0.9999,), (1.0001,)], "x double")
    from hearthspark.functions.pvalues import kolmogorov_p
    low, high = [r[0] for r in grid.select(kolmogorov_p(F.col("x") / 100, F.lit(20000), F.lit(20000))).collect()]
    assert low == pytest.approx(0.27, abs=1e-3) and low == pytest.approx(high, abs=3e-4)


def test_student_tail_known_values():
    assert student_tail(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert student_tail(1.0, 1) == pytest.approx(0.5, abs=1e-10)
    assert student_tail(1.959963985, 1e9) == pytest.approx(0.05, abs=1e-8)
    assert student_tail(1.98397152, 100) == pytest.approx(0.05, abs=1e-7)
    assert student_tail(1.9602012, 10000.0) == pytest.approx(0.05, abs=1e-6)
    assert student_tail(0.0, 7) == pytest.approx(1.0)


def test_scale_divides_by_n(spark):
    t = spark.createDataFrame([(1, 4), (3, 4)], "x int, y int")
    fitted = e.fit_scale(t, ["x", "y"])
    assert sorted(map(tuple, e.apply_scale(t, fitted).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def test_onehot_drops_first_and_ignores_unknown(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    levels = {"k": e.fit_levels(train, "k")}
    other = spark.createDataFrame([("a",), ("z",), (NULL,)], "k string")
    assert [tuple(r) for r in e.onehot_columns(other, levels, drop_first=True).collect()] == [(0, 0)] * 3
    assert [tuple(r) for r in e.onehot_columns(other, levels).collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_medians_are_exact_and_modes_take_the_lowest(spark):
    t = spark.createDataFrame([(1, "b"), (2, "a"), (NULL, "b"), (7, "a"), (8, NULL)], "x int, k string")
    assert i.fit_median(t, ["x"]) == {"x": 4.5}
    assert i.fit_mode(t, ["k"]) == {"k": "a"}
    filled = i.apply_fill(t, {"x": 4.5, "k": "a"})
    assert {tuple(r) for r in filled.collect()} == {(1.0, "b"), (2.0, "a"), (4.5, "b"), (7.0, "a"), (8.0, "a")}
    assert i.fit_mean_or_mode(t, ["x", "k"]) == {"x": 4.5, "k": "a"}


def test_fills_and_schema_algebra(spark):
    t = spark.createDataFrame([(NULL, NULL, NULL, float("nan"))], "n int, s string, b boolean, x double")
    assert tuple(c.fill_all(t).first()) == (0, "0", False, 0.0)
    assert c.drop_incomplete_rows(c.fill_all(t)).count() == 1 and c.drop_incomplete_rows(t).count() == 0
    assert c.drop_empty_columns(t.select("n", F.lit(1).alias("one"))).columns == ["one"]
    assert c.numeric_names(t) == ["n", "x"] and c.numeric_names(t, include_boolean=True) == ["n", "b", "x"]
    assert c.align(t.select("n"), t.schema).columns == t.columns
    with pytest.raises(ValueError, match="missing columns: q"):
        c.require_columns(t, ["n", "q"])
    infinite = spark.createDataFrame([(float("inf"),), (2.0,)], "x double")
    assert p.infinite_total(infinite, ["x"]).first()[0] == 1
    assert {r[0] for r in c.replace_infinite(infinite, ["x"]).collect()} == {None, 2.0}


def test_lookup_matches_missing_with_missing_beyond_and_within_the_limit(spark):
    left = spark.createDataFrame([(1, NULL), (2, "a"), (3, "q")], "id int, k string")
    right = spark.createDataFrame([(NULL, 10), ("a", 20)], "k string, v int")
    for limit in (1, 100):
        assert {(r["id"], r["v"]) for r in j.lookup(left, right, ["k"], limit=limit).collect()} == {
            (1, 10), (2, 20), (3, NULL)}


def test_prepare_uses_training_medians_for_both_tables(spark):
    train = spark.createDataFrame([("1", 1.0, 0, 9), ("2", 3.0, 1, 9), ("3", NULL, NULL, 9)],
                                  "id string, x double, Pobre int, Indigente int")
    test = spark.createDataFrame([("4", NULL), ("5", 100.0)], "id string, x double")
    fitted = pr.fit_prepare(train)
    assert {r["id"]: r["x"] for r in pr.apply_prepare(test, fitted).collect()} == {"4": 2.0, "5": 100.0}
    prepared = pr.apply_prepare(train, fitted)
    assert prepared.columns == ["id", "x", "Pobre"] and prepared.count() == 2


def test_class_weights_and_ratio(spark):
    t = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "Pobre int")
    assert {r["Pobre"]: r["weight"] for r in sm.class_weights(t, "Pobre").collect()} == {0: 8 / 12, 1: 2.0}
    assert sm.positive_ratio(sm.class_weights(t, "Pobre", {1: 1.5}), "Pobre") == pytest.approx(4.5)


def test_split_by_draw_is_near_the_asked_share(survey):
    got = sm.split_by_draw(survey.households.select("id"), "id", 0.8).filter("split = 'train'").count()
    assert abs(got / survey.households.count() - 0.8) < 0.05


def test_patience_keeps_the_best_round():
    assert tr.best_round([5, 4, 3, 3, 3, 2, 9], 2) == 3
    assert tr.best_round([5, 4, 3, 3, 2.5, 2, 9], 2) == 6
    assert tr.best_round([1, 2, 3, 4], 10) == 1
    assert tr.best_round([3, 2, 1], 1) == 3
    assert tr.best_round([1, 1, 0], 1) == 1


def test_recode_gives_labels_to_codes(spark):
    rows = spark.createDataFrame([(1,), (2,), (9,), (NULL,)], "k int")
    found = [r["l"] for r in c.recode(rows, "k", {1: "one", 2: "two"}, "l").collect()]
    assert found == ["one", "two", NULL, NULL]


def test_scorer_takes_categories_and_loads_again(spark, tmp_path):
    draw = random.Random(1)
    rows = [(i, draw.choice("ab"), draw.random()) for i in range(400)]
    table = spark.createDataFrame([(i, k, x, int(k == "a")) for i, k, x in rows], "id long, k string, x double, Pobre int")
    scorer = md.fit_scorer(table, md.elastic_logistic(0.0, 0.01), ["x"], categories=["k"])
    assert scorer.inputs == ["x", "k_a", "k_b"]
    scorer.save(spark, str(tmp_path / "scorer"))
    again = md.Scorer.load(spark, str(tmp_path / "scorer"))
    new = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.5), (3, "z", 0.5), (4, NULL, 0.5)], "id long, k string, x double")
    got = {r["id"]: r["score"] for r in again.predict(new).collect()}
    assert got[1] > 0.9 and got[2] < 0.1 and got[3] == got[4]


def test_elastic_grid_from_products_is_the_fit_on_rows(spark):
    draw = random.Random(3)
    rows = []
    for i in range(300):
        a, b = draw.gauss(0, 1), draw.gauss(2, 3)
        rows.append((i, a, b, a + draw.gauss(0, 0.5), 1.0, float(a + 0.1 * b + draw.gauss(0, 1) > 0)))
    names = ["a", "b", "c", "flat"]
    table = spark.createDataFrame(rows, "id long, a double, b double, c double, flat double, Pobre double")
    alphas, penalties, k = [0.05, 0.5, 0.95], [0.01, 0.1, 0.3, 2.0], 3
    grid = {(r["alpha"], r["penalty"]): r["metric"] for r in tr.elastic_grid(table, names, alphas, penalties, k)[0].collect()}
    assert len(grid) == 12
    folded = sm.folds(table, "id", k, seed=42).cache()
    for alpha, penalty in ((0.05, 0.01), (0.5, 0.1), (0.95, 0.3), (0.5, 2.0)):
        errors = []
        for fold in range(k):
            scorer = md.fit_scorer(folded.filter(F.col("fold") != fold), md.elastic_linear(alpha, penalty), names)
            scored = scorer.score(folded.filter(F.col("fold") == fold), ["Pobre"]).collect()
            errors.append(math.sqrt(sum((r["score"] - r["Pobre"]) ** 2 for r in scored) / len(scored)))
        assert grid[alpha, penalty] == pytest.approx(sum(errors) / k, abs=1e-4)
