"""The distributed forms against brute force, with hot groups and copies."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthspark.operators import joins as j
from hearthspark.operators import metrics as m
from hearthspark.operators import models as md
from hearthspark.operators import neighbours as nb
from hearthspark.operators import ordering as o
from hearthspark.operators import sampling as sm
from hearthspark.plans import training as tr
from hearthspark.session import fresh_path, materialize, scratch, shared_dir
from hearthspark.sources import files
from tests.conftest import SMALL


def brute_neighbours(points: dict[int, list[float]], k: int) -> dict[int, list[tuple[int, float]]]:
    ids = sorted(points)
    x = np.array([points[i] for i in ids], dtype=float)
    found = {}
    for row, key in enumerate(ids):
        far = np.sqrt(((x - x[row]) ** 2).sum(axis=1))
        order = sorted((far[n], ids[n]) for n in range(len(ids)) if n != row)
        found[key] = [(m, dist) for dist, m in order[:k]]
    return found


@pytest.mark.parametrize("shape", ["clusters", "copies", "lattice"])
def test_neighbours_equal_brute_force_over_many_blocks(spark, shape):
    source = random.Random(3)
    points: dict[int, list[float]] = {}
    for i in range(300):
        if shape == "clusters":
            points[i] = [source.gauss(10 * (i % 5), 0.5) for _ in range(3)]
        elif shape == "copies" and i % 3 == 0:
            points[i] = [1.0, 2.0, 3.0]
        else:
            points[i] = [float(source.randint(0, 4)) for _ in range(3)]
    df = spark.createDataFrame(list(points.items()), "id long, v array<double>")
    got: dict[int, list] = {}
    for r in nb.nearest(df, "id", "v", 5, block_rows=16).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbour"], r["distance"]))
    want = brute_neighbours(points, 5)
    assert got.keys() == want.keys()
    for key, expected in want.items():
        assert [n for n, _ in got[key]] == [n for n, _ in expected]
        assert [x for _, x in got[key]] == pytest.approx([x for _, x in expected])


def test_pruning_leaves_out_far_block_pairs(spark):
    source = random.Random(5)
    rows = [(i, [source.gauss(1000 * (i % 8), 1.0), source.gauss(0, 1.0)]) for i in range(800)]
    distinct = nb._distinct_points(spark.createDataFrame(rows, "member long, vec array<double>"), 6)
    pivots = np.array([[1000.0 * n, 0.0] for n in range(8)])
    placed = nb._place(distinct, pivots, 50).cache()
    bounds = nb._block_bounds(placed, 6).cache()
    n_blocks = bounds.count()
    assert n_blocks >= 16
    assert nb._block_pairs(bounds, pivots).count() < n_blocks * n_blocks / 3


def test_smote_reaches_parity_between_minority_points(spark):
    source = random.Random(1)
    rows = [(i, 1 if i < 20 else 0, source.random(), source.random() + (5 if i < 20 else 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    made = nb.smote(df, "id", "y", ["a", "b"], seed=7)
    assert {(r["y"], r["n"]) for r in made.groupBy("y").agg(F.count("*").alias("n")).collect()} == {(0, 70), (1, 70)}
    inside = made.filter("synthetic = 1").agg(F.min("b").alias("low"), F.max("b").alias("high")).first()
    assert 5 <= inside["low"] and inside["high"] <= 6
    points = df.filter("y = 1").select("id", F.array("a", "b").alias("v"))
    where = {r["id"]: np.array(r["v"]) for r in points.collect()}
    for r in nb.synthetic_points(points, "id", "v", 33, seed=7).collect():
        start, end = where[r["base"]], where[r["neighbour"]]
        assert np.allclose(np.array(r["vec"]), start + r["step"] * (end - start)) and 0 <= r["step"] < 1


def test_segments_have_exact_sizes_in_hot_and_tiny_groups(spark):
    rows = [(i, "hot" if i < 5000 else f"g{i % 700}") for i in range(7000)]
    df = spark.createDataFrame(rows, "id long, g string")
    for digits in (1, 4):
        cut = o.segments(df, "part", "id", lambda n: [F.floor(n * 0.3), F.floor(n * 0.7)], by=["g"], digits=digits)
        counts = {(r["g"], r["part"]): r["n"] for r in cut.groupBy("g", "part").agg(F.count("*").alias("n")).collect()}
        for group, n in Counter(g for _, g in rows).items():
            sizes = [counts.get((group, part), 0) for part in range(3)]
            assert sizes == [int(n * 0.3), int(n * 0.7) - int(n * 0.3), n - int(n * 0.7)]
        assert cut.count() == 7000


def test_copies_of_a_key_stay_together(spark):
    df = spark.createDataFrame([(i % 40,) for i in range(2000)], "id long")
    cut = sm.split_random(df, "id", 0.5)
    assert cut.groupBy("id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0


def test_missing_group_is_a_group(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(100)], "id long, g string")
    cut = sm.folds(df, "id", 5, stratify="g")
    sizes = cut.groupBy("g", "fold").agg(F.count("*").alias("n")).collect()
    assert len(sizes) == 10 and {r["n"] for r in sizes} == {10}


def test_row_numbers_are_dense(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(1000)], "id long, g boolean")
    got = o.row_numbers(df, "n", "id", ["g"]).groupBy("g").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.count_distinct("n").alias("d"), F.count("*").alias("c"))
    assert all(r["low"] == 1 and r["high"] == r["d"] == r["c"] for r in got.collect())


def test_running_totals_equal_a_plain_sum(spark):
    source = random.Random(2)
    rows = [(g, float(v), source.randint(1, 9)) for g in ("a", "b") for v in source.sample(range(10000), 500)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    want, seen = {}, Counter()
    for g, v, n in sorted(rows):
        want[(g, v)] = seen[g]
        seen[g] += n
    got = {(r["g"], r["v"]): r["n_before"] for r in o.running_totals(df, "v", ["n"], by=["g"], buckets=16).collect()}
    assert got == want
    flat = df.groupBy("v").agg(F.sum("n").alias("n"))
    total = o.running_totals(flat, "v", ["n"], buckets=8).orderBy(F.desc("v")).first()
    assert total["n_before"] + total["n"] == sum(n for *_, n in rows)


@pytest.mark.parametrize("form", ["group_value_on_rows", "join_household_columns"])
def test_hot_household_is_split_in_the_join(spark, form):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"))
        if form == "group_value_on_rows":
            got = j.group_value_on_rows(rows, {"n": F.count(F.lit(1))})
        else:
            got = j.join_household_columns(rows, rows.select("id").distinct().withColumn("n", F.lit(66667)), ["n"])
        collected = got.collect()
        assert len(collected) == 200000 and {r["n"] for r in collected if r["id"] == 0} == {66667}
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_scorer_survives_saving(spark, survey):
    names = ["P5000", "P5010", "Nper", "Li", "Fex_c", "P5130"]
    scorer = md.fit_scorer(survey.train, md.elastic_logistic(0.0, 0.01), names, impute=True, threshold=0.4, op=">=")
    path = fresh_path(spark, "scorer-test")
    scorer.save(spark, path)
    loaded = md.Scorer.load(spark, path)
    ours = {r["id"]: (r["score"], r["prediction"]) for r in scorer.predict(survey.test).collect()}
    theirs = {r["id"]: (r["score"], r["prediction"]) for r in loaded.predict(survey.test).collect()}
    assert ours == theirs and len(ours) == survey.test.count()


def test_fit_on_smote_scales_before_it_oversamples(spark):
    source = random.Random(8)
    rows = [(i, int(i % 6 == 0), source.gauss(3.0 * (i % 6 == 0), 1.0), 1000 * source.random()) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, Pobre int, a double, b double")
    scorer = tr.fit_on_smote(df, md.elastic_logistic(0.0, 0.01), ["a", "b"])
    assert m.roc_auc(scorer.score(df, ["id", "Pobre"]), "Pobre").first()["auc"] > 0.9
    assert scorer.scale["b"][1] > 100


def test_forest_beats_the_majority_and_best_fold_is_kept(spark):
    source = random.Random(4)
    rows = [(i, int(i % 4 == 0), source.gauss(3.0 * (i % 4 == 0), 1.0), source.random()) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, Pobre int, a double, b double")
    checked, final = tr.forest_flow(df, ["a", "b"], trees=10, k=3)
    table = {r["fold"]: r for r in checked.per_fold.collect()}
    assert len(table) == 3 and all(r["f1"] > 0.7 and r["auc"] > 0.9 for r in table.values())
    assert checked.out_of_fold.select("id").distinct().count() == 800
    best = max(table.values(), key=lambda r: (r["f1"], -r["fold"]))["fold"]
    assert checked.best() is checked.scorers[best]
    ranked = md.feature_importance(final, spark).collect()
    assert ranked[0]["feature"] == "a" and sum(r["importance"] for r in ranked) == pytest.approx(1)


def test_stack_and_search(spark):
    source = random.Random(6)
    rows = [(i, int(i % 2 == 0), source.gauss(2.0 * (i % 2 == 0), 1.0), source.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, Pobre int, a double, b double")

    def fit(part, settings=None):
        return md.fit_scorer(part, md.boosted(**{"rounds": 3, "depth": 2, **(settings or {})}), ["a", "b"])

    stack = tr.fit_stack(df, [fit, lambda part: fit(part, {"depth": 3, "seed": 9})], k=3)
    assert stack.score(df, ["id", "Pobre"]).count() == 300
    counted = {r["feature"]: r["splits"] for r in md.split_importance(fit(df), spark).collect()}
    trees = fit(df).model.trees
    assert sum(counted.values()) == sum((tree.numNodes - 1) // 2 for tree in trees) and counted["a"] > 0
    assert 0 < tr.tune_threshold(stack.score(df, ["id", "Pobre"])) < 1
    results, best = tr.random_search(df, fit, {"rounds": (2, 4), "depth": [2, 3], "threshold": (0.4, 0.6)}, runs=3)
    assert results.count() == 3 and set(best) == {"rounds", "depth", "threshold"}
    assert tr.draws({"rate": (0.1, 0.2)}, 2) == tr.draws({"rate": (0.1, 0.2)}, 2)


def test_penalty_path_empties_the_model_first(spark, survey):
    names = ["P5000", "Nper", "Li"]
    path = tr.penalty_path(survey.train, names, n=4)
    assert path == sorted(path, reverse=True) and path[-1] == pytest.approx(path[0] * 1e-4)
    scorer = md.fit_scorer(survey.train, md.elastic_logistic(0.5, path[0] * 1.01), names)
    assert np.count_nonzero(scorer.model.coefficients.toArray()) == 0


def test_files(spark):
    df = spark.createDataFrame([("a", 1.5, True), ("b", float("inf"), None), ("c", None, False)],
                               "id string, x double, y boolean")
    path = fresh_path(spark, "csv-test")
    assert not files.path_exists(spark, path)
    with pytest.raises(FileNotFoundError, match="no table at"):
        files.read_csv(spark, path, df.schema)
    spark_rows = sorted(map(str, df.collect()))
    df.selectExpr("id", "case when x = double('inf') then 'inf' else cast(x as string) end as x", "y").write.option(
        "header", "true").csv(path)
    assert sorted(map(str, files.read_csv(spark, path, df.schema).collect())) == spark_rows
    turned = df.schema.__class__(df.schema.fields[::-1])
    assert sorted(str(r.asDict()) for r in files.read_csv(spark, path, turned).select(*df.columns).collect()) == sorted(
        str(r.asDict()) for r in df.collect())
    with pytest.raises(ValueError, match="no column absent"):
        files.read_csv(spark, path, df.schema.__class__(df.schema.fields[:1]).add("absent", "integer"))
    households = spark.createDataFrame([("a",), ("b",)], "id string")
    scored = spark.createDataFrame([("a", 1), ("b", 0)], "id string, prediction int")
    back = files.export_predictions(scored, households, fresh_path(spark, "predictions-test"))
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", 0)]
    with pytest.raises(ValueError, match="differ"):
        files.export_predictions(scored.limit(1), households, fresh_path(spark, "predictions-test"))
    assert shared_dir(spark) == shared_dir(spark)


def test_rows_without_a_usable_vector_are_set_aside(spark):
    clean = [(i, [float(i), float(i * i % 7)]) for i in range(60)]
    odd = [(100, [float("nan"), 0.0]), (101, [None, 0.0]), (102, [float("inf"), 0.0]), (103, None)]
    table = spark.createDataFrame(clean + odd, "id long, vec array<double>")
    found = sorted(map(tuple, nb.nearest(table, "id", "vec", 5).collect()))
    alone = sorted(map(tuple, nb.nearest(spark.createDataFrame(clean, table.schema), "id", "vec", 5).collect()))
    assert found == alone and len(found) == 300
    assert {r["usable"]: r["n"] for r in nb.set_aside(table, "vec").collect()} == {True: 60, False: 4}
    made = nb.synthetic_points(table, "id", "vec", 100).collect()
    assert len(made) == 100 and {r["base"] for r in made} <= set(range(60))


def test_scratch_deletes_its_stages(spark):
    outer = shared_dir(spark)
    with scratch(spark) as folder:
        assert materialize(spark.range(5)).count() == 5
        assert files.path_exists(spark, folder) and shared_dir(spark) == folder
    assert not files.path_exists(spark, folder) and shared_dir(spark) == outer


def test_tasks_find_the_package_from_any_folder(tmp_path):
    """A driver started elsewhere, with the package on its own path alone."""
    root = Path(__file__).resolve().parent.parent
    program = (f"import sys; sys.path.insert(0, {str(root)!r})\n"
               "from hearthspark.session import local_session\nfrom hearthspark.plans.catalog import all_queries\n"
               f"print('rows', all_queries()['knn_minority'](local_session(2), {SMALL!r}).count())")
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
