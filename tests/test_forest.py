"""The forest against a plain version, in both ways of growing it."""

from __future__ import annotations

import numpy as np
import pytest

from hearthspark.operators import boosting as bo
from hearthspark.operators import forest as fo
from hearthspark.operators import models as md
from hearthspark.operators.forest import Forest
from hearthspark.session import fresh_path, materialize

SCHEMA = "key long, label int, weight double, features array<double>"


def drawn(n=500, width=5, seed=1):
    source = np.random.default_rng(seed)
    x = np.round(source.normal(size=(n, width)), 1)
    x[:, -1] = 7.0
    y = ((x[:, 0] * x[:, 1] + x[:, 2] > 0.2) ^ (source.random(n) < 0.1)).astype(int)
    return x, y, 1.0 + np.arange(n) % 3


@pytest.fixture(scope="module")
def rows(spark):
    rows = [(i, int(a), float(b), c.tolist()) for i, (a, b, c) in enumerate(zip(*[drawn()[j] for j in (1, 2, 0)], strict=True))]
    return materialize(spark.createDataFrame(rows, SCHEMA).repartition(3))


def plain_tree(x, y, weight, cuts, forest, number):
    """(feature, cut, left, right) or the share of class 1, by loops over rows."""
    bins, key = bo.binned(x, cuts), np.arange(len(x), dtype=np.int64)
    bits = bo.mixed(key, forest.seed, number // 4).view(np.uint16).reshape(-1, 4)[:, number % 4]
    times = fo.POISSON[bits]

    def sums(part):
        return sum(times[i] * weight[i] for i in part), sum(times[i] * weight[i] * y[i] for i in part)

    def impurity(part):
        whole, ones = sums(part)
        return 2 * ones * (whole - ones) / whole

    def grow(part, path, depth):
        at = np.arange(x.shape[1]) + path * x.shape[1]
        chosen = sorted(np.argsort(bo.draw(at, forest.seed, -1 - number))[:int(np.ceil(np.sqrt(x.shape[1])))].tolist())
        best = None
        for feature in chosen if depth < forest.depth else ():
            for cut in range(forest.bins - 1):
                sides = [i for i in part if bins[i, feature] <= cut], [i for i in part if bins[i, feature] > cut]
                if all(sides):
                    gain = impurity(part) - impurity(sides[0]) - impurity(sides[1])
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, feature, cut, sides
        if best is None:
            whole, ones = sums(part)
            return ones / whole
        _, feature, cut, (left, right) = best
        return feature, cut, grow(left, 2 * path, depth + 1), grow(right, 2 * path + 1, depth + 1)

    return grow([i for i in range(len(x)) if times[i]], 1, 0)


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return pytest.approx(float(tree.value[node]))
    child = int(tree.left[node])
    return int(tree.feature[node]), int(tree.cut[node]), nested(tree, child), nested(tree, child + 1)


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("few", [1, fo.FEW_ROWS])
def test_trees_split_for_split(rows, weighted, few, monkeypatch):
    monkeypatch.setattr(fo, "FEW_ROWS", few)
    monkeypatch.setattr(fo, "TOGETHER", 100)
    forest = Forest(trees=6, depth=4, bins=8)
    x, y, weight = drawn()
    for local in (True, False):
        model = fo.fit_forest(rows, forest, weighted, local)
        assert len(model.trees) == 6
        for number, tree in enumerate(model.trees):
            assert plain_tree(x, y, weight if weighted else np.ones(len(x)), model.cuts, forest, number) == nested(tree)


def test_ways_of_growing_and_layouts_of_rows_give_one_forest(rows, monkeypatch):
    forest = Forest(trees=9, depth=7)
    one = fo.fit_forest(rows, forest, local=True)
    monkeypatch.setattr(fo, "WHOLE_BYTES", 4000)
    monkeypatch.setattr(fo, "PART_BYTES", 4000)
    for source in (rows, rows.repartition(7)):
        other = fo.fit_forest(source, forest)
        assert [x.packed() for x in one.trees] == [x.packed() for x in other.trees]
    assert one.importances().sum() == pytest.approx(1) and one.importances()[4] == 0


def test_a_draw_has_the_poisson_mean_and_trees_differ():
    key = np.arange(20_000, dtype=np.int64) * 7919
    times = np.array([fo.POISSON[bo.mixed(key, 42, i // 4).view(np.uint16).reshape(-1, 4)[:, i % 4]] for i in range(8)])
    assert np.allclose(times.mean(axis=1), 1, atol=0.03) and np.allclose(times.var(axis=1), 1, atol=0.05)
    assert np.abs(np.corrcoef(times) - np.eye(8)).max() < 0.03


def test_a_level_of_all_trees_is_one_job(spark, rows, monkeypatch):
    """What is sent for a tree are counts of its open nodes, whatever the number of rows and trees."""
    real, levels = fo.Grown.extend, []
    monkeypatch.setattr(fo.Grown, "extend", lambda tree, level: (levels.append(len(tree.feature) - tree.open), real(tree, level)))
    start = bo.bin_rows(rows.withColumn("held", rows.key < 0), 32)
    grown = fo.trees_by_levels(start.table.repartition(5), Forest(trees=40, depth=4), 5, 32, 0.5, False)
    assert len(grown) == 40 and len(levels) <= 40 * 4 and max(levels) <= 8
    for tree in grown:
        inner = tree.feature >= 0
        assert np.allclose(tree.cover[inner], tree.cover[tree.left[inner]] + tree.cover[tree.left[inner] + 1])


def test_a_forest_is_scored_saved_and_loaded(spark, survey):
    names = ["P5000", "Nper", "Fex_c"]
    train = materialize(survey.train.select("id", "Pobre", "Dominio", *names))
    scorer = md.fit_scorer(train, md.forest(20, 6), names, scale=False, categories=["Dominio"])
    assert isinstance(scorer.model, fo.ForestModel)
    where = fresh_path(spark, "scorer")
    scorer.save(spark, where)
    loaded = md.Scorer.load(spark, where)
    ours = {r["id"]: r["score"] for r in scorer.score(survey.test).collect()}
    assert ours == {r["id"]: r["score"] for r in loaded.score(survey.test).collect()} and len(ours) > 100
    assert len(set(ours.values())) > 20 and all(0 <= x <= 1 for x in ours.values())
    splits = {r["feature"]: r["splits"] for r in md.split_importance(scorer, spark).collect()}
    assert sum(splits.values()) == sum(int((x.feature >= 0).sum()) for x in scorer.model.trees)
    with pytest.raises(Exception, match="is not 0 or 1"):
        md.fit_scorer(train.withColumn("Pobre", train.Pobre * 2), md.forest(2, 2), names, scale=False)
