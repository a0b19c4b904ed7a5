"""Training flows: cross-validation, penalty paths, search, stacking, drift by classifier."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.operators import columns as c
from hearthspark.operators import elastic as el
from hearthspark.operators import features as ft
from hearthspark.operators import metrics as m
from hearthspark.operators import models as md
from hearthspark.operators import sampling as sm
from hearthspark.operators.boosting import Boost, Booster, Progress, bin_rows
from hearthspark.operators.encode import apply_scale, assemble
from hearthspark.operators.neighbours import smote
from hearthspark.operators.neural import Network, Trainer, training_table
from hearthspark.plans.prepare import ready_table
from hearthspark.session import materialize
from hearthspark.sources.survey import LABEL, LEAKY, Survey

# Ranges of the published searches.
BOOST_SPACE = {"rate": (0.01, 0.3), "rounds": (100, 1000), "depth": (3, 10), "row_share": (0.5, 1.0),
               "column_share": (0.5, 1.0)}
STACK_SPACE = {"rate": (0.01, 0.2), "rounds": (100, 300), "depth": (3, 15), "row_share": (0.5, 1.0),
               "column_share": (0.5, 1.0), "min_rows": (1, 6), "threshold": (0.3, 0.6)}
NETWORK_SPACE = {"rate": (3e-4, 1e-2), "batch": [32, 64], "hidden_1": [128, 256], "hidden_2": [32, 64, 128],
                 "hidden_3": [16, 32, 64], "dropout": (0.1, 0.5), "decay": (7e-6, 1e-4)}
NETWORK_RUNS = 75
GRID_ALPHAS = [i / 100 for i in range(5, 100, 5)]
GRID_PENALTIES = [i / 10 for i in range(1, 71)]
SEARCH_RUNS = 20

Fit = Callable[[DataFrame], md.Scorer]
# Fits on the rows of the other folds and may watch those of the fold left out.
WatchingFit = Callable[[DataFrame, DataFrame], md.Scorer]


def modelling_tables(s: Survey, no_ratio: float = 0.0, filled: bool = True
                     ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Ready train and test tables, written once, and the numeric feature names.

    With ``filled`` off missing cells stay, for flows that fit their fills on
    each fold. ``no_ratio`` stands for the dependency ratio of a household without members of working age.
    """
    rows = materialize(ft.enhance(s.households, s.persons))
    train = rows.filter("part = 'train'").drop("part")
    test = rows.filter("part = 'test'").drop("part", LABEL, *LEAKY)

    def finish(df: DataFrame, other: DataFrame) -> DataFrame:
        keep = [LABEL] if LABEL in df.columns else []
        ready = ready_table(df, other) if filled else c.drop_columns(c.common_columns(df, other, keep=keep), LEAKY)
        return c.replace_infinite(ready, ["dependency_ratio"], no_ratio)

    ready_train, ready_test = materialize(finish(train, test)), materialize(finish(test, train))
    return ready_train, ready_test, c.numeric_names(ready_train, excluded=["id", LABEL])


def categories(train: DataFrame) -> list[str]:
    """The text columns of a ready table, which enter a model as 0/1 columns."""
    return [f.name for f in train.schema.fields if f.dataType.simpleString() == "string" and f.name != "id"]


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def fit_on_smote(rows: DataFrame, estimator: Estimator | md.Forest, names: Sequence[str], label: str = LABEL, key: str = "id",
                 seed: int = 42, threshold: float = 0.5, op: str = ">") -> md.Scorer:
    """Scale, oversample the minority in the scaled space, fit; new tables are scaled the same way."""
    inputs = md.fit_inputs(rows, names, label, threshold=threshold, op=op)
    scaled = apply_scale(rows.select(key, label, *names), inputs.scale)
    balanced = materialize(smote(scaled, key, label, names, seed=seed))
    ready = assemble(balanced, names, keep=[label]).withColumn(label, F.col(label).cast("double"))
    if isinstance(estimator, md.Forest):
        return replace(inputs, model=md.fit_forest_rows(ready, estimator, label))
    return replace(inputs, model=estimator.copy({estimator.labelCol: label}).fit(ready))


def smote_rows(scaled: DataFrame, names: Sequence[str], label: str = LABEL, key: str = "id", seed: int = 42
               ) -> DataFrame:
    """Rows brought to parity by SMOTE, with a key made of their values: equal rows fall into one fold."""
    balanced = smote(scaled.select(key, label, *names), key, label, names, seed=seed)
    return balanced.withColumn(key, F.xxhash64("synthetic", *names)).drop("synthetic")


# ---- cross-validation -------------------------------------------------------------

@dataclass(frozen=True)
class CrossValidated:
    out_of_fold: DataFrame  # id, label, fold, score, prediction
    per_fold: DataFrame     # fold, auc, precision, recall, f1
    scorers: list[md.Scorer]

    def best(self) -> md.Scorer:
        """The scorer of the fold with the highest F1, the first on ties."""
        rows = self.per_fold.select("fold", "f1").collect()
        return self.scorers[min(rows, key=lambda r: (-r["f1"], r["fold"]))["fold"]]


def cross_validate(train: DataFrame, fit: Fit | None, k: int = 5, key: str = "id", label: str = LABEL, seed: int = 42,
                   threshold: float = 0.5, op: str = ">", width: int = 4,
                   balance: Callable[[DataFrame], DataFrame] | None = None,
                   watching: WatchingFit | None = None) -> CrossValidated:
    """Fit on k - 1 folds (balanced if asked), score the one left out, evaluate all folds in one grouped pass.

    ``watching`` takes the place of ``fit`` where a fit is to watch the fold left out.
    """
    folded = materialize(sm.folds(train, key, k, stratify=label, seed=seed))

    def run(fold: int) -> tuple[md.Scorer, DataFrame]:
        part, left_out = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        rows = balance(part) if balance else part
        scorer = watching(rows, left_out) if watching else fit(rows)
        return scorer, scorer.score(left_out, [key, label, "fold"])

    results = md.in_parallel([lambda fold=fold: run(fold) for fold in range(k)], width)
    scored = materialize(stacked([scores for _, scores in results]))
    predicted = m.apply_cutoff(scored, threshold, op=op)
    quality = m.scores(predicted, 1, label, by=["fold"])
    area = m.roc_auc(scored, label, by=["fold"]).select("fold", "auc")
    per_fold = area.join(quality, "fold").select("fold", "auc", "precision", "recall", "f1")
    return CrossValidated(predicted, per_fold, [scorer for scorer, _ in results])


def forest_flow(train: DataFrame, names: Sequence[str], trees: int = md.FOREST_TREES, k: int = 5,
                threshold: float = 0.5, seed: int = 42, impute: bool = True, final: bool = True
                ) -> tuple[CrossValidated, md.Scorer | None]:
    """Cross-validate an undersampled forest, then (if ``final``) fit it on all undersampled rows.

    Medians for missing cells are those of the rows a fit gets: no fold's own
    values fill its cells.
    """
    texts = categories(train)

    def fit(rows: DataFrame) -> md.Scorer:
        return md.fit_scorer(rows, md.forest(trees, seed=seed), names, scale=False, threshold=threshold,
                             categories=texts, impute=impute)

    def balance(rows: DataFrame) -> DataFrame:
        return materialize(sm.undersample(rows, "id", LABEL, seed))

    checked = cross_validate(train, fit, k, seed=seed, threshold=threshold, balance=balance)
    return checked, fit(balance(train)) if final else None


# ---- elastic net --------------------------------------------------------------------

def penalty_path(df: DataFrame, names: Sequence[str], label: str = LABEL, alpha: float = md.ELASTIC_ALPHA,
                 n: int = 100, ratio: float = 1e-4) -> list[float]:
    """Geometric path from the smallest penalty that empties the model down to ``ratio`` of it."""
    target = F.col(label).cast("double")
    row = df.agg(*[F.abs(F.corr(F.col(name).cast("double"), target)).alias(name) for name in names],
                 F.stddev_pop(target).alias("_spread")).first()
    strongest = max((row[name] for name in names if row[name] is not None), default=1.0)
    top = strongest * row["_spread"] / alpha
    return [top * ratio ** (i / (n - 1)) for i in range(n)] if n > 1 else [top]


def elastic_path(train: DataFrame, names: Sequence[str], alpha: float = md.ELASTIC_ALPHA, n_penalties: int = 100,
                 k: int = 10, label: str = LABEL, seed: int = 42, block: int = el.BLOCK
                 ) -> tuple[DataFrame, md.Scorer, el.Path]:
    """Logistic elastic net: the penalty with the least cross-validated log-loss, all folds and penalties in few passes.

    Results are (alpha, penalty, metric); the scorer has the fit on all rows at that penalty.
    """
    penalties = penalty_path(train, names, label, alpha, n_penalties)
    folded = sm.folds(train, "id", k, stratify=label, seed=seed)
    blank = md.fit_inputs(folded, names, label)
    rows = md.training_rows(blank, folded, ["fold"])
    # Every pass reads these rows once: as many parts as there are tasks at a time.
    written = materialize(rows.select("fold", F.col(label).alias("label"), vector_to_array("features").alias("features"))
                          .repartition(train.sparkSession.sparkContext.defaultParallelism))
    path = el.logistic_path(written, penalties, alpha, k, block)
    table = [(alpha, penalty, float(loss)) for penalty, loss in zip(penalties, path.losses.mean(axis=1), strict=True)]
    results = train.sparkSession.createDataFrame(table, "alpha double, penalty double, metric double")
    return results, replace(blank, model=path.model(path.best())), path


def elastic_grid(train: DataFrame, names: Sequence[str], alphas: Sequence[float] = GRID_ALPHAS,
                 penalties: Sequence[float] = GRID_PENALTIES, k: int = 10, label: str = LABEL, seed: int = 42,
                 ) -> tuple[DataFrame, md.Scorer]:
    """Linear elastic net on the 0/1 label: the pair with the least cross-validated error.

    One pass gives the sums of products of each fold. Fits and errors of all
    pairs and folds follow from those small matrices, whatever the table's
    size; only the chosen pair is then fitted on the rows.
    """
    folded = sm.folds(train, "id", k, seed=seed)
    blank = md.fit_inputs(folded, names, label)
    products = fold_products(md.training_rows(blank, folded, ["fold"]), label, k, len(blank.inputs))
    errors = elastic_errors(products, alphas, penalties)
    table = [(float(a), float(b), float(errors[i, j])) for i, a in enumerate(alphas) for j, b in enumerate(penalties)]
    alpha, penalty, _ = min(table, key=lambda row: row[2])
    results = train.sparkSession.createDataFrame(table, "alpha double, penalty double, metric double")
    return results, md.fit_scorer(train, md.elastic_linear(alpha, penalty), names, label)


def fold_products(rows: DataFrame, label: str, k: int, n_features: int) -> np.ndarray:
    """Per fold the sums of products of (1, features, label), as an array of k square matrices."""
    size = n_features + 2
    source = rows.select("fold", vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, size, size))
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, n_features)
            z = np.column_stack((np.ones(len(x)), x, batch.column(2).to_numpy()))
            own = batch.column(0).to_numpy()
            for fold in np.unique(own):
                part = z[own == fold]
                sums[fold] += part.T @ part
        place = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums.ravel()[place])], names=["place", "value"])

    found = np.zeros(k * size * size)
    for row in source.mapInArrow(add_up, "place long, value double").groupBy("place").agg(
            F.sum("value").alias("value")).collect():
        found[row["place"]] = row["value"]
    return found.reshape(k, size, size)


def elastic_errors(products: np.ndarray, alphas: Sequence[float], penalties: Sequence[float]) -> np.ndarray:
    """Mean held-out root mean squared error over the folds, by (alpha, penalty)."""
    errors = np.zeros((len(alphas), len(penalties)))
    whole = products.sum(axis=0)
    order = np.argsort(penalties)[::-1]
    for held in products:
        scaled = standardized(whole - held)
        for i, alpha in enumerate(alphas):
            b = np.zeros(len(scaled.target))
            for j in order:
                b = descend(scaled, alpha, penalties[j], b)
                beta = b * scaled.spread_y / scaled.spread_x
                w = np.concatenate(([scaled.mean_x @ beta - scaled.mean_y], -beta, [1.0]))
                errors[i, j] += math.sqrt(max(0.0, w @ held @ w) / held[0, 0]) / len(products)
    return errors


@dataclass(frozen=True)
class Standardized:
    """Covariances of standardized features, and of them with the standardized label."""

    gram: np.ndarray
    target: np.ndarray
    mean_x: np.ndarray
    mean_y: float
    spread_x: np.ndarray
    spread_y: float


def standardized(products: np.ndarray) -> Standardized:
    n = products[0, 0]
    mean = products[0, 1:] / n
    cov = products[1:, 1:] / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 0) * n / (n - 1))
    # A column without spread gets no coefficient.
    spread[spread <= 1e-12 * (1 + np.abs(mean))] = np.inf
    unit = cov / np.outer(spread, spread)
    return Standardized(unit[:-1, :-1], unit[:-1, -1], mean[:-1], mean[-1], spread[:-1], spread[-1])


def descend(scaled: Standardized, alpha: float, penalty: float, start: np.ndarray, tolerance: float = 1e-8,
            rounds: int = 1000) -> np.ndarray:
    """Elastic-net coefficients by coordinate descent, from ``start``."""
    b = start.copy()
    flat, round_ = penalty / scaled.spread_y * alpha, penalty / scaled.spread_y * (1 - alpha)
    gradient = scaled.target - scaled.gram @ b
    bends = np.diag(scaled.gram)
    for _ in range(rounds):
        largest = 0.0
        # Coordinates that stay at zero are passed over.
        for j in np.flatnonzero((b != 0) | (np.abs(gradient) > flat)):
            pull = gradient[j] + bends[j] * b[j]
            new = math.copysign(max(0.0, abs(pull) - flat), pull) / (bends[j] + round_) if bends[j] else 0.0
            if new != b[j]:
                gradient -= scaled.gram[:, j] * (new - b[j])
                largest = max(largest, abs(new - b[j]))
                b[j] = new
        if largest < tolerance:
            break
    return b


# ---- boosting ------------------------------------------------------------------------

def best_round(losses: Sequence[float], patience: int) -> int:
    """Rounds to keep: up to the lowest loss before ``patience`` rounds in a row brought no lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def boost_with_patience(train: DataFrame, names: Sequence[str], label: str = LABEL, seed: int = 42, share: float = 0.8,
                        boost: Boost = Boost(patience=md.PATIENCE), categories: Sequence[str] = (),
                        balanced: bool = True) -> tuple[md.Scorer, Progress]:
    """Boosting watched on held-out rows of each class: no round is grown after patience has ended."""
    marked = materialize(sm.split_stratified(train, "id", label, share, seed))
    rows, held = (marked.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    weights = sm.class_weights(rows, label) if balanced else None
    return md.fit_boosted_scorer(rows, names, boost, label, weights, held, categories=categories)


def network_with_patience(train: DataFrame, names: Sequence[str], network: Network = Network(), label: str = LABEL,
                          seed: int = 42, share: float = 0.8, categories: Sequence[str] = ()
                          ) -> tuple[md.Scorer, list[float]]:
    """A neural classifier with balanced class weights, watched by F1 on held-out rows of each class."""
    marked = materialize(sm.split_stratified(train, "id", label, share, seed))
    rows, held = (marked.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    weights = sm.class_weights(rows, label)
    return md.fit_network_scorer(rows, names, network, label, weights, held, categories=categories)


@dataclass(frozen=True)
class Oversampled:
    """Rows scaled and brought to parity by SMOTE, the rows that watch, and the inputs both are made by."""

    inputs: md.Scorer
    rows: DataFrame
    watched: DataFrame | None
    places: list[str]


def oversampled(rows: DataFrame, held: DataFrame | None, names: Sequence[str], label: str = LABEL, key: str = "id",
                seed: int = 42, texts: Sequence[str] = ()) -> Oversampled:
    """Scale, oversample the minority in the scaled space; ``held`` rows are scaled the same way, not oversampled.

    Text columns go through SMOTE as the 0/1 columns of their values, so a made row may lie between two values.
    """
    inputs = md.fit_inputs(rows, names, label, categories=texts)
    places = [f"x{i}" for i in range(len(inputs.inputs))]

    def wide(df: DataFrame) -> DataFrame:
        values = vector_to_array("features")
        return inputs.features(df, [key, label]).select(key, label, *[values[i].alias(n) for i, n in enumerate(places)])

    made = materialize(smote_rows(wide(rows), places, label, key, seed))
    watched = None if held is None else wide(held).withColumn(key, F.xxhash64(key, *places))
    return Oversampled(inputs, made, watched, places)


def boost_on_smote(rows: DataFrame, held: DataFrame | None, names: Sequence[str], boost: Boost, label: str = LABEL,
                   key: str = "id", seed: int = 42, texts: Sequence[str] = ()) -> md.Scorer:
    """Boosted trees on oversampled rows; new tables are scaled the same way."""
    made = oversampled(rows, held, names, label, key, seed, texts)
    scorer, _ = md.fit_boosted_scorer(made.rows, made.places, boost, label, held=made.watched, key=key)
    return replace(made.inputs, model=scorer.model)


# ---- stacking ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Stack:
    learners: list[md.Scorer]
    meta: md.Scorer
    label: str = LABEL

    def level_one(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """One score column per learner, all from one pass over the rows."""
        return one_pass_scores(self.learners, df, keep)

    def score(self, df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
        return self.meta.score(self.level_one(df, keep), keep)


def one_pass_scores(learners: Sequence[md.Scorer], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    names = list(dict.fromkeys(n for learner in learners for n in learner.columns))
    current, made = df.select(*keep, *names), []
    for i, learner in enumerate(learners):
        current = learner.score(current, [*keep, *names, *made]).withColumnRenamed("score", f"p{i}")
        made.append(f"p{i}")
    return current.select(*keep, *made)


def fit_stack(train: DataFrame, fits: Sequence[Fit], k: int = 5, key: str = "id", label: str = LABEL,
              seed: int = 42, width: int = 8) -> Stack:
    """Out-of-fold scores of every learner train a logistic model; learners are refitted on all rows."""
    folded = materialize(sm.folds(train, key, k, stratify=label, seed=seed))

    # One fit for each fold and learner, and one of each learner on all rows; all are independent.
    def fitted(fit: Fit, fold: int | None) -> md.Scorer:
        return fit((folded if fold is None else folded.filter(F.col("fold") != fold)).drop("fold"))

    places = [(i, fold) for fold in [None, *range(k)] for i in range(len(fits))]
    made = md.in_parallel([lambda i=i, fold=fold: fitted(fits[i], fold) for i, fold in places], width)
    scorers = dict(zip(places, made, strict=True))
    parts = [one_pass_scores([scorers[i, fold] for i in range(len(fits))], folded.filter(F.col("fold") == fold), [key, label])
             for fold in range(k)]
    level_one = materialize(stacked(parts))
    names = [f"p{i}" for i in range(len(fits))]
    meta = md.fit_scorer(level_one, md.elastic_logistic(0.0, 0.0, 1000), names, label, scale=False)
    return Stack([scorers[i, None] for i in range(len(fits))], meta, label)


def boosted_pair(names: Sequence[str], boost: Boost, label: str = LABEL) -> list[Fit]:
    """A learner that grows by levels and one that grows best-first, with the same rate, rounds and shares."""

    def fit(own: Boost) -> Fit:
        return lambda rows: md.fit_boosted_scorer(rows, names, own, label)[0]

    return [fit(boost), fit(replace(boost, **md.SECOND_LEARNER))]


def tune_threshold(scored: DataFrame, label: str = LABEL) -> float:
    """The score cut-off (``>=``) with the highest F1 on validation rows."""
    return m.best_threshold(m.precision_recall_curve(scored, label)).first()["threshold"]


# ---- search ----------------------------------------------------------------------------

def draws(space: dict[str, tuple], runs: int, seed: int = 42) -> list[dict[str, float]]:
    """Seeded uniform draws; a range of whole numbers gives whole numbers, a list one of its items."""
    source = random.Random(seed)

    def one(choice) -> object:
        if isinstance(choice, list):
            return source.choice(choice)
        low, high = choice
        return source.randint(low, high) if isinstance(low, int) and isinstance(high, int) else source.uniform(low, high)

    return [{name: one(choice) for name, choice in space.items()} for _ in range(runs)]


def random_search(train: DataFrame, fit: Callable[[DataFrame, dict[str, float]], md.Scorer], space: dict[str, tuple],
                  runs: int = SEARCH_RUNS, label: str = LABEL, seed: int = 42, share: float = 0.8,
                  width: int = 4) -> tuple[DataFrame, dict[str, float]]:
    """Fit every draw, score the same validation rows, rank by F1; evaluated in one grouped pass."""
    split = materialize(sm.split_stratified(train, "id", label, share, seed))
    rows, held_out = split.filter("split = 'train'"), split.filter("split = 'test'")
    chosen = draws(space, runs, seed)

    def run(i: int) -> DataFrame:
        scorer = fit(rows, {name: value for name, value in chosen[i].items() if name != "threshold"})
        predicted = scorer.with_threshold(chosen[i].get("threshold", 0.5), ">=").predict(held_out, ["id", label])
        return predicted.withColumn("run", F.lit(i))

    predicted = materialize(stacked(md.in_parallel([lambda i=i: run(i) for i in range(runs)], width)))
    quality = m.scores(predicted, 1, label, by=["run"])
    names = sorted(space)
    listed = train.sparkSession.createDataFrame(
        [(i, *[float(chosen[i][n]) for n in names]) for i in range(runs)],
        "run int, " + ", ".join(f"{n} double" for n in names))
    results = listed.join(quality, "run", "left").orderBy(F.desc("f1"), "run")
    return results, chosen[results.first()["run"]]


@dataclass(frozen=True)
class Halving:
    """Every draw with the rounds it was given and its best F1 on the rows held out, and the best draw's scorer."""

    results: DataFrame  # run, the draw's settings, spent, kept, f1
    scorer: md.Scorer
    settings: dict[str, float]


def halving_search(train: DataFrame, names: Sequence[str], space: dict[str, tuple] = BOOST_SPACE,
                   runs: int = SEARCH_RUNS, label: str = LABEL, seed: int = 42, share: float = 0.8, first: int = 20,
                   texts: Sequence[str] = (), width: int = 4) -> Halving:
    """Search by successive halving: all draws grow ``first`` rounds, the better half goes on to twice as many, until
    one is left, which grows to its own number of rounds.

    Boosters go on where they stopped, so no round is grown twice. All start
    from one table of bins, of rows brought to parity by SMOTE, and are ranked
    by their best F1 on the rows held out; on ties the earlier draw is better.
    """
    split = materialize(sm.split_stratified(train, "id", label, share, seed))
    rows, held = (split.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    made = oversampled(rows, held, names, label, seed=seed, texts=texts)
    blank = md.fit_inputs(made.rows, made.places, label, scale=False)
    start = bin_rows(md.weighted_rows(blank, made.rows, None, made.watched))
    chosen = draws(space, runs, seed)
    boosters = [Booster(start, Boost(**{name: value for name, value in one.items() if name != "threshold"}, patience=0,
                                     watch="f1", seed=seed)) for one in chosen]

    def quality(i: int) -> tuple[float, int]:
        return min(boosters[i].progress.watched), i

    alive, rounds = list(range(runs)), first
    while len(alive) > 1:
        md.in_parallel([lambda i=i: boosters[i].advance(min(rounds, boosters[i].boost.rounds)) for i in alive], width)
        alive = sorted(alive, key=quality)[:(len(alive) + 1) // 2]
        rounds *= 2
    best = boosters[alive[0]]
    best.advance(best.boost.rounds)
    listed = sorted(space)
    table = [(i, *[float(chosen[i][n]) for n in listed], len(x.progress.trees), x.progress.best(), -min(x.progress.watched))
             for i, x in enumerate(boosters)]
    results = train.sparkSession.createDataFrame(
        table, "run int, " + ", ".join(f"{n} double" for n in listed) + ", spent int, kept int, f1 double")
    return Halving(results.orderBy(F.desc("spent"), F.desc("f1"), "run"), replace(made.inputs, model=best.model()),
                   chosen[alive[0]])


def network_search(train: DataFrame, names: Sequence[str], space: dict[str, tuple] = NETWORK_SPACE,
                   runs: int = NETWORK_RUNS, label: str = LABEL, seed: int = 42, share: float = 0.8, first: int = 2,
                   epochs: int = Network.epochs, texts: Sequence[str] = (), width: int = 8) -> Halving:
    """Successive halving over networks: all draws train ``first`` epochs, the better half goes on to twice as many.

    Class weights are balanced; draws are ranked by their best F1 on the held-out rows, on ties the earlier is better.
    """
    split = materialize(sm.split_stratified(train, "id", label, share, seed))
    rows, held = (split.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    blank = md.fit_inputs(rows, names, label, categories=texts)
    start = training_table(md.weighted_rows(blank, rows, sm.class_weights(rows, label), held))
    chosen = draws(space, runs, seed)

    def network(one: dict) -> Network:
        rest = {name: value for name, value in one.items() if not name.startswith("hidden")}
        return Network(hidden=tuple(one[name] for name in sorted(one) if name.startswith("hidden")), epochs=epochs,
                       seed=seed, **rest)

    trainers = [Trainer(start, network(one)) for one in chosen]
    alive, until = list(range(runs)), first
    while True:
        md.in_parallel([lambda i=i: trainers[i].advance(until) for i in alive], width)
        if len(alive) == 1 and until >= epochs:
            break
        alive = sorted(alive, key=lambda i: (-max(trainers[i].scores), i))[:(len(alive) + 1) // 2]
        until = epochs if len(alive) == 1 else min(epochs, 2 * until)
    listed = sorted(space)
    table = [(i, *[float(chosen[i][n]) for n in listed], len(x.scores), int(np.argmax(x.scores)) + 1, max(x.scores))
             for i, x in enumerate(trainers)]
    results = train.sparkSession.createDataFrame(
        table, "run int, " + ", ".join(f"{n} double" for n in listed) + ", spent int, kept int, f1 double")
    return Halving(results.orderBy(F.desc("spent"), F.desc("f1"), "run"),
                   replace(blank, model=trainers[alive[0]].model()), chosen[alive[0]])


# ---- drift by classifier ------------------------------------------------------------------

@dataclass(frozen=True)
class Adversarial:
    metrics: DataFrame      # auc, precision, recall, f1
    confusion: DataFrame
    importances: DataFrame


def adversarial_validation(first: DataFrame, second: DataFrame, names: Sequence[str],
                           trees: int = md.ADVERSARIAL_TREES, seed: int = 43, share: float = 0.7,
                           texts: Sequence[str] = ()) -> Adversarial:
    """How well a forest tells two tables apart on held-out rows; ``texts`` enter as the 0/1 columns of their values."""
    both = ["id", *names, *texts]
    tagged = c.union_tagged(first.select(*both), second.select(*both), "is_test")
    split = materialize(sm.split_random(tagged, ["id", "is_test"], share, seed))
    scorer = md.fit_scorer(split.filter("split = 'train'"), md.forest(trees, seed=seed), names, "is_test", scale=False,
                           categories=texts)
    scored = materialize(scorer.predict(split.filter("split = 'test'"), ["id", "is_test"]))
    area = m.roc_auc(scored, "is_test", either_direction=True).first()["auc"]
    quality = m.scores(scored, 1, "is_test").select(F.lit(area).cast("double").alias("auc"), "precision", "recall", "f1")
    return Adversarial(quality, m.confusion_matrix(scored, "is_test"), md.feature_importance(scorer, first.sparkSession))
