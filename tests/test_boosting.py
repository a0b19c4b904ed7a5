"""Boosted trees against a plain version, in both ways of growing them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from hearthspark.operators import boosting as bo
from hearthspark.operators import metrics as m
from hearthspark.operators import models as md
from hearthspark.operators.boosting import Boost
from hearthspark.plans import training as tr
from hearthspark.session import fresh_path, materialize

SCHEMA = "key long, label int, weight double, held boolean, features array<double>"


def drawn(n=400, width=5, seed=1):
    source = np.random.default_rng(seed)
    x = np.round(source.normal(size=(n, width)), 1)
    x[:, -1] = 7.0
    y = ((x[:, 0] * x[:, 1] + x[:, 2] > 0.2) ^ (source.random(n) < 0.1)).astype(int)
    return x, y, 1.0 + np.arange(n) % 3, np.arange(n) % 5 == 0


def frame(spark, x, y, weight, held):
    rows = [(i, int(a), float(b), bool(c), d.tolist()) for i, (a, b, c, d) in enumerate(zip(y, weight, held, x, strict=True))]
    return materialize(spark.createDataFrame(rows, SCHEMA).repartition(3))


@pytest.fixture(scope="module")
def rows(spark):
    return frame(spark, *drawn())


def plain_trees(x, y, weight, held, cuts, start, boost):
    """The same trees by loops over rows, as nested (feature, bin, gain, left, right) or a leaf value."""
    bins = bo.binned(x, cuts)
    margin, trees = np.full(len(x), start), []
    for number in range(boost.rounds):
        p = 1 / (1 + np.exp(-margin))
        draw = bo.draw(np.arange(len(x), dtype=np.int64), boost.seed, number)
        used = [i for i in range(len(x)) if not held[i] and draw[i] < boost.row_share]
        g = {i: int(np.rint((p[i] - y[i]) * weight[i] * bo.UNIT)) for i in used}
        h = {i: int(np.rint(p[i] * (1 - p[i]) * weight[i] * bo.UNIT)) for i in used}
        features = bo.columns_of(boost, number, x.shape[1]).tolist()

        def value(part):
            a, b = sum(g[i] for i in part) / bo.UNIT, sum(h[i] for i in part) / bo.UNIT
            return a, b, a * a / (b + boost.l2)

        def split(part, depth):
            best = None
            for f in features if depth < boost.depth else ():
                for cut in range(boost.bins - 1):
                    left = [i for i in part if bins[i, f] <= cut]
                    right = [i for i in part if bins[i, f] > cut]
                    if len(left) < boost.min_rows or len(right) < boost.min_rows:
                        continue
                    (_, wl, vl), (_, wr, vr) = value(left), value(right)
                    gain = (vl + vr - value(part)[2]) / 2
                    if wl >= boost.min_weight and wr >= boost.min_weight and gain > bo.LEAST_GAIN and (
                            best is None or gain > best[0] + 1e-9):
                        best = gain, f, cut, left, right
            if best is None:
                a, b, _ = value(part)
                return -boost.rate * a / (b + boost.l2)
            gain, f, cut, left, right = best
            return f, cut, gain, split(left, depth + 1), split(right, depth + 1)

        tree = split(used, 0)
        trees.append(tree)

        def walk(node, i):
            while isinstance(node, tuple):
                node = node[3] if bins[i, node[0]] <= node[1] else node[4]
            return node

        margin = margin + np.array([walk(tree, i) for i in range(len(x))])
    return trees


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    child = tree.left[node]
    return tree.feature[node], tree.bin[node], tree.gain[node], nested(tree, child), nested(tree, child + 1)


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-6) and same(a[3], b[3]) and same(a[4], b[4])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and a == pytest.approx(b, abs=1e-9)


BOOST = Boost(rounds=3, depth=3, bins=8, min_rows=4)


def test_trees_split_for_split(rows):
    model, _ = bo.fit_boosted(rows, BOOST)
    plain = plain_trees(*drawn(), model.cuts, model.start, BOOST)
    assert len(plain) == len(model.trees) == 3
    assert all(same(a, nested(b)) for a, b in zip(plain, model.trees, strict=True))


@pytest.mark.parametrize("boost", [BOOST, Boost(rounds=2, depth=6, leaves=6, bins=16), Boost(rounds=12, depth=2, patience=3)])
def test_one_task_and_many_jobs_grow_the_same_trees(rows, boost):
    (one, first), (other, second) = (bo.fit_boosted(rows, boost, local) for local in (True, False))
    assert one.trees == other.trees and first.watched == second.watched


def test_growth_goes_on_where_it_stopped(rows):
    start = bo.bin_rows(rows, 16)
    boost = Boost(rounds=9, depth=3, bins=16)
    whole = bo.Booster(start, boost).advance(9)
    steps = bo.Booster(start, boost).advance(2).advance(3).advance(9)
    assert whole.progress.trees == steps.progress.trees


def test_no_round_is_grown_after_patience_ended(rows, monkeypatch):
    grown = []
    real = bo.local_rounds

    def counted(table, progress, boost, until, n_features):
        table, progress = real(table, progress, boost, until, n_features)
        grown.append(len(progress.trees))
        return table, progress

    monkeypatch.setattr(bo, "local_rounds", counted)
    monkeypatch.setattr(bo, "KEEP_LOCAL", 7)
    model, progress = bo.fit_boosted(rows, Boost(rounds=500, depth=4, rate=0.5, patience=5), True)
    assert grown[-1] == len(progress.trees) == len(model.trees) + 5 < 500
    assert len(model.trees) == tr.best_round(progress.watched, 5)
    assert min(progress.watched) == progress.watched[len(model.trees) - 1]


def test_watched_loss_and_f1_are_those_of_the_model(rows):
    x, y, weight, held = drawn()
    vectors = rows.withColumn("features", array_to_vector("features"))
    for watch in ("loss", "f1"):
        model, progress = bo.fit_boosted(rows, Boost(rounds=6, depth=3, patience=0, watch=watch))
        scored = {r["key"]: r["p"] for r in vectors.select("key", model.probability(vectors.features).alias("p")).collect()}
        p = np.array([scored[i] for i in range(len(x))])[held]
        loss = -(weight[held] * np.log(np.where(y[held] == 1, p, 1 - p))).sum() / weight[held].sum()
        table = rows.sparkSession.createDataFrame([(int(a), int(b > 0.5)) for a, b in zip(y[held], p, strict=True)],
                                                  "label int, prediction int")
        f1 = m.scores(table, 1).first()["f1"]
        assert min(progress.watched) == pytest.approx(loss if watch == "loss" else -f1, abs=1e-5)


def test_best_first_growth_takes_the_largest_gain(rows):
    model, _ = bo.fit_boosted(rows, Boost(rounds=3, depth=20, leaves=5, bins=16, row_share=1.0, column_share=1.0))
    for tree in model.trees:
        assert tree.feature.count(-1) == 5 and len(tree.feature) == 9
        order = sorted((tree.left[i], tree.gain[i]) for i in range(9) if tree.feature[i] >= 0)
        waiting = {0: tree.gain[0]}
        for child, gain in order:
            assert gain == max(waiting.values())
            del waiting[next(i for i in waiting if tree.left[i] == child)]
            waiting.update({i: tree.gain[i] for i in (child, child + 1) if tree.feature[i] >= 0})


def test_gain_sums_are_those_of_a_loop(rows, spark):
    model, _ = bo.fit_boosted(rows, BOOST)
    names = [f"x{i}" for i in range(5)]
    totals = dict.fromkeys(names, 0.0)
    for tree in model.trees:
        for i, feature in enumerate(tree.feature):
            if feature >= 0:
                totals[names[feature]] += tree.gain[i]
    scorer = md.Scorer(names, {}, {}, model)
    listed = md.split_importance(scorer, spark).collect()
    assert {r["feature"]: pytest.approx(r["total_gain"]) for r in listed} == totals
    assert sum(r["splits"] for r in listed) == sum(sum(f >= 0 for f in tree.feature) for tree in model.trees)
    assert all(r["mean_gain"] * r["splits"] == pytest.approx(r["total_gain"]) for r in listed)
    assert totals["x4"] == 0


def test_nothing_to_split(spark):
    x = np.ones((20, 2))
    model, _ = bo.fit_boosted(frame(spark, x, np.zeros(20), np.ones(20), np.zeros(20, bool)), Boost(rounds=2))
    assert [tree.feature for tree in model.trees] == [[-1], [-1]]
    with pytest.raises(ValueError, match="no rows"):
        bo.fit_boosted(frame(spark, x, np.zeros(20), np.ones(20), np.ones(20, bool)), Boost(rounds=2))


def test_a_scorer_is_saved_and_loaded(spark, survey):
    names = ["P5000", "Nper", "Fex_c"]
    train = materialize(survey.train.select("id", "Pobre", "Dominio", *names))
    scorer, _ = md.fit_boosted_scorer(train, names, Boost(rounds=5, depth=3), categories=["Dominio"])
    where = fresh_path(spark, "scorer")
    scorer.save(spark, where)
    loaded = md.Scorer.load(spark, where)
    assert loaded.model == scorer.model
    ours = {r["id"]: r["score"] for r in scorer.score(survey.test).collect()}
    assert ours == {r["id"]: r["score"] for r in loaded.score(survey.test).collect()} and len(ours) > 100


def test_search_spends_rounds_on_the_better_half(spark):
    x, y, _, _ = drawn(300)
    rows = [(i, int(a), *map(float, b[:4])) for i, (a, b) in enumerate(zip(y, x, strict=True))]
    df = spark.createDataFrame(rows, "id long, Pobre int, a double, b double, c double, d double")
    space = {"rate": (0.05, 0.4), "rounds": (30, 40), "depth": [2, 3]}
    found = tr.halving_search(df, list("abcd"), space, runs=4, first=4)
    table = found.results.collect()
    assert sorted(r["spent"] for r in table) == sorted([4, 4, 8, int(found.settings["rounds"])])
    assert all(0 <= r["f1"] <= 1 and r["kept"] <= r["spent"] for r in table)
    assert found.scorer.score(df, ["id"]).count() == 300


def test_cuts_are_quantiles_by_rank(spark):
    source = np.random.default_rng(5)
    x = np.column_stack((source.integers(0, 5, 3000), source.normal(size=3000), np.full(3000, 2.0), -source.integers(0, 900, 3000)))
    rows = frame(spark, x, np.zeros(3000), np.ones(3000), np.zeros(3000, bool)).repartition(4)
    for column, cuts in zip(x.T, bo.sorted_cuts(rows, 4, 16), strict=True):
        ordered = np.sort(column)
        wanted = {float(ordered[int(np.ceil(i / 16 * 3000)) - 1]) for i in range(1, 16)}
        assert cuts == sorted(value for value in wanted if value < ordered[-1])


def test_a_summary_keeps_ranks_and_ends():
    values = np.random.default_rng(6).normal(size=50_000)
    made, total = bo.summary(values, most=1000)
    ordered = np.sort(values)
    assert len(made) == 1000 and total.sum() == 50_000 and made[-1] == ordered[-1]
    assert np.abs(np.searchsorted(ordered, made, side="right") - total.cumsum()).max() == 0 and total.max() <= 50
    both, sums = bo.summary(np.concatenate((made, made)), np.concatenate((total, total)))
    assert (both == made).all() and (sums == 2 * total).all()


def test_joint_bins_count_what_single_features_do(monkeypatch):
    monkeypatch.setattr(bo, "FEW_ROWS", 50)
    monkeypatch.setattr(bo, "TOGETHER", 300)
    source = np.random.default_rng(7)
    n, widths = 2000, np.array([2, 2, 64, 3, 2, 40, 64, 1])
    bins = (source.random((n, 8)) * widths).astype(np.uint8)
    weight = np.where(source.random(n) < 0.5, 1.0, 3.7e6)
    rows = bo.Rows(np.arange(n), (source.random(n) < 0.4).astype(float), weight, source.random(n) < 0.2, np.zeros(n), bins).prepare()
    assert len(rows.joint) == 2 and all(len(x.parts) <= bo.JOINT_CELLS for x in rows.joint)
    tree = bo.Tree()
    tree.split(0, 2, 30, 1.0)
    tree.split(1, 0, 0, 1.0)
    tree.split(4, 5, 0, 1.0)
    rows.begin(Boost(row_share=0.9), 0)
    rows.follow(tree.arrays())
    node = np.where(rows.drawn, bo.routed(tree.arrays(), bins), -1)
    features = np.array([0, 2, 3, 5, 7])
    found = rows.histogram([3, 6, 5, 2], features, 64)
    assert 0 < (node == 5).sum() < 50 < (node == 3).sum()
    for i, one in enumerate([3, 6, 5, 2]):
        inside = node == one
        for j, feature in enumerate(features):
            for k, values in enumerate((rows.gradient, rows.curve, np.ones(n))):
                wanted = np.bincount(bins[inside, feature], values[inside], 64)
                assert (found[i, j, :, k] == wanted.astype(np.int64)).all()
    margin = rows.margin.copy()
    tree.value = [float(i) for i in range(len(tree.value))]
    rows.finish(tree)
    assert np.allclose(rows.margin - margin, bo.routed(tree.arrays(), bins))
