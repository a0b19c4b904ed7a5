"""Logistic regression with an elastic-net penalty: all penalties of a path and all folds from few passes.

One pass over the rows gives, for every (fold, penalty) of a block of the path,
the loss, its gradient and the weighted sums of products at the present
coefficients. The next coefficients follow from those small matrices by
coordinate descent on the driver, for all models at once. So the number of
passes depends on neither the folds nor the width of a block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthspark.functions.sums import sum_arrays

# Penalties of a path that are moved together.
BLOCK = 20
# Rows whose products are added at once in a task.
CHUNK = 1024
MOST_STEPS = 50
# Sweeps between two linear systems, and systems for one step at most.
SWEEPS, MOST_SOLVES = 4, 200
TOLERANCE = 1e-6


@dataclass(frozen=True)
class LogisticModel:
    """Coefficients of a fitted regression, as a model a ``Scorer`` can hold."""

    coefficients: list[float]
    intercept: float

    def probability(self, features: Column) -> Column:
        values = vector_to_array(features)
        margin = sum((values[i] * F.lit(float(c)) for i, c in enumerate(self.coefficients) if c), F.lit(float(self.intercept)))
        return 1 / (1 + F.exp(-margin))

    def settings(self) -> dict:
        return {"kind": "logistic", "coefficients": self.coefficients, "intercept": self.intercept}


@dataclass(frozen=True)
class Path:
    """Fits of all penalties: on all rows, and held-out loss over the folds."""

    penalties: list[float]
    coefficients: np.ndarray  # (penalty, 1 + features), the intercept first
    losses: np.ndarray        # (penalty, fold): mean held-out log-loss
    passes: int

    def best(self) -> int:
        """The penalty with the least mean held-out loss, the largest on ties."""
        return int(np.argmin(self.losses.mean(axis=1)))

    def model(self, i: int) -> LogisticModel:
        return LogisticModel(self.coefficients[i, 1:].tolist(), float(self.coefficients[i, 0]))


def fold_moments(rows: DataFrame, k: int) -> dict[int, np.ndarray]:
    """For each fold the sums over its rows of (1, label, features, squares of features)."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        found: dict[int, np.ndarray] = {}
        for fold, y, x in parts(batches):
            z = np.column_stack((np.ones(len(x)), y, x, x * x))
            for f in np.unique(fold):
                found[int(f)] = found.get(int(f), 0) + z[fold == f].sum(axis=0)
        return found

    return sum_arrays(rows, add_up)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(fold, label, features) of bounded numbers of rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            fold, y = part.column(0).to_numpy(), part.column(1).to_numpy()
            yield fold, y, part.column(2).flatten().to_numpy().reshape(part.num_rows, -1)


def pair_products(z: np.ndarray) -> np.ndarray:
    """Products of each column with itself and those behind it, in the order of ``np.triu_indices``."""
    n, q = z.shape
    made, end = np.empty((n, q * (q + 1) // 2)), 0
    for i in range(q):
        np.multiply(z[:, i:i + 1], z[:, i:], out=made[:, end:end + q - i])
        end += q - i
    return made


def newton_sums(rows: DataFrame, betas: np.ndarray, left_out: np.ndarray) -> tuple[np.ndarray, ...]:
    """One pass: for each model (loss, held-out loss, gradient, sums of products weighted by p(1 - p)).

    Model m has the coefficients ``betas[m]`` and doesn't see the rows of fold
    ``left_out[m]``, on which its held-out loss is taken.
    """
    n_models, q = betas.shape
    upper = np.triu_indices(q)

    def add_up(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        sums = np.zeros((n_models, 2 + q))
        products = np.zeros((n_models, len(upper[0])))
        for fold, y, x in parts(batches):
            z = np.column_stack((np.ones(len(x)), x))
            margin = z @ betas.T
            seen = (fold[:, None] != left_out[None, :]).astype(np.float64)
            # From one exponential: log(1 + e^m) = max(m, 0) + log(1 + e^-|m|).
            small = np.exp(-np.abs(margin))
            loss = np.maximum(margin, 0) + np.log1p(small) - y[:, None] * margin
            chance = np.where(margin >= 0, 1.0, small) / (1 + small)
            weight = chance * (1 - chance) * seen
            sums[:, 0] += np.einsum("nm,nm->m", loss, seen)
            sums[:, 1] += np.einsum("nm,nm->m", loss, 1 - seen)
            sums[:, 2:] += ((y[:, None] - chance) * seen).T @ z
            # Products of columns are made once for all models, each pair once: their sums are one matrix product.
            products += weight.T @ pair_products(z)
        return {m: np.concatenate((sums[m], products[m])) for m in range(n_models)}

    found = sum_arrays(rows, add_up)
    packed = np.array([found.get(m, np.zeros(2 + q + len(upper[0]))) for m in range(n_models)])
    products = np.zeros((n_models, q, q))
    products[:, upper[0], upper[1]] = products[:, upper[1], upper[0]] = packed[:, 2 + q:]
    return packed[:, 0], packed[:, 1], packed[:, 2:2 + q], products


def descend_all(gram: np.ndarray, target: np.ndarray, flat: np.ndarray, bent: np.ndarray, start: np.ndarray,
                tolerance: float = 1e-9) -> np.ndarray:
    """Least 1/2 b'Gb - t'b + flat |b| + 1/2 bent b^2, for many models at once.

    Coordinate descent finds which coefficients are not zero and their signs;
    with those given the rest is one linear system, whose solution is taken
    where it keeps the signs. So columns that are nearly equal cost no more
    sweeps than others. The sweep after it decides whether any coefficient
    still moves.
    """
    b = start.copy()
    diagonal = np.einsum("mii->mi", gram)
    curve = diagonal + bent
    curve[curve <= 0] = 1.0
    unit = np.eye(b.shape[1])
    free = flat == 0
    left = np.arange(len(b))

    def sweep() -> np.ndarray:
        """One step for each coordinate of the models left; the largest move of each model."""
        g, own = gram[left], b[left]
        rest = target[left] - np.einsum("mij,mj->mi", g, own)
        largest = np.zeros(len(left))
        for j in range(b.shape[1]):
            pull = rest[:, j] + diagonal[left, j] * own[:, j]
            step = np.sign(pull) * np.maximum(0, np.abs(pull) - flat[left, j]) / curve[left, j] - own[:, j]
            if step.any():
                rest -= g[:, :, j] * step[:, None]
                own[:, j] += step
                largest = np.maximum(largest, np.abs(step))
        b[left] = own
        return largest

    for _ in range(MOST_SOLVES):
        for _ in range(SWEEPS):
            largest = sweep()
        left = left[largest >= tolerance]
        if not len(left):
            break
        sign = np.sign(b[left])
        on = (sign != 0) | (free[left] & (diagonal[left] > 0))
        both = on[:, :, None] & on[:, None, :]
        system = np.where(both, gram[left], 0) + unit * np.where(on, bent[left], 1.0)[:, :, None]
        # A coefficient that is not zero has a finite penalty.
        pulled = np.where(on, target[left] - np.where(on, flat[left], 0) * sign, 0)
        solved = np.linalg.solve(system, pulled[:, :, None])[:, :, 0]
        same = ((solved * sign >= 0) | free[left]).all(axis=1)
        b[left[same]] = solved[same]
    return b


def logistic_path(rows: DataFrame, penalties: Sequence[float], alpha: float, k: int, block: int = BLOCK) -> Path:
    """Fit every penalty on all rows and on all but each fold.

    ``rows`` has the columns fold (0 to k - 1), label (0 or 1) and features
    (an array), and is read once a pass. The objective of a fit is the mean
    log-loss plus penalty * (alpha |b| + (1 - alpha) / 2 b^2) with b the
    coefficients of features divided by their standard deviation (n - 1) over
    the rows of the fit; the intercept is free. A feature that is constant in
    those rows has a coefficient of 0. Penalties, in descending order, are moved in blocks;
    a block starts from where the one before ended.
    """
    source = rows.select("fold", F.col("label").cast("double"), "features")
    moments = fold_moments(source, k)
    width = len(next(iter(moments.values())))
    whole = sum(moments.values())
    q = (width - 2) // 2 + 1
    folds = np.array([-1, *range(k)])
    n, spread = np.zeros(len(folds)), np.zeros((len(folds), q))
    starts = np.zeros((len(folds), q))
    for i, f in enumerate(folds):
        own = whole - moments.get(int(f), np.zeros(width))
        n[i] = own[0]
        mean = own[2:1 + q] / n[i]
        variance = np.maximum(0, own[1 + q:] / n[i] - mean ** 2) * n[i] / max(1, n[i] - 1)
        spread[i, 1:] = np.where(variance > 1e-12 * (1 + mean ** 2), np.sqrt(variance), 0)
        share = min(max(own[1] / n[i], 1e-9), 1 - 1e-9)
        starts[i, 0] = np.log(share / (1 - share))
    held = np.array([moments[f][0] if f in moments else 0 for f in range(k)])

    coefficients, losses, passes = [], [], 0
    for first in range(0, len(penalties), block):
        lambdas = np.array(penalties[first:first + block])
        # Models in the order (penalty, fold), the fit on all rows first.
        models = _Models(np.repeat(lambdas, len(folds)), np.tile(folds, len(lambdas)), np.tile(n, len(lambdas)),
                         np.tile(spread, (len(lambdas), 1)), alpha, np.tile(starts, (len(lambdas), 1)))
        passes += models.fit(source)
        starts = models.betas[-len(folds):]
        coefficients.extend(models.betas[::len(folds)])
        losses.extend((models.held_out.reshape(len(lambdas), -1)[:, 1:] / np.maximum(1, held)).tolist())
    return Path(list(penalties), np.array(coefficients), np.array(losses), passes + 1)


class _Models:
    """Newton steps of several models side by side."""

    def __init__(self, penalty: np.ndarray, left_out: np.ndarray, n: np.ndarray, spread: np.ndarray, alpha: float,
                 betas: np.ndarray) -> None:
        self.left_out, self.n, self.betas = left_out, n, betas.copy()
        self.unit = np.where(spread > 0, spread, 1.0)
        self.flat = (penalty * alpha)[:, None] * np.where(spread > 0, 1.0, 0.0)
        self.bent = (penalty * (1 - alpha))[:, None] * np.where(spread > 0, 1.0, 0.0)
        # A constant feature stays out; the intercept is not penalized.
        self.flat[:, 1:][spread[:, 1:] == 0] = np.inf
        self.held_out = np.zeros(len(n))

    def penalty(self, betas: np.ndarray, on: np.ndarray) -> np.ndarray:
        scaled = betas * self.unit[on]
        flat = np.where(np.isfinite(self.flat[on]), self.flat[on], 0)
        return (flat * np.abs(scaled) + self.bent[on] * scaled ** 2 / 2).sum(axis=1)

    def fit(self, rows: DataFrame) -> int:
        """Step until no coefficient moves; a step that raises the objective is halved. Returns the passes used."""
        on = np.arange(len(self.n))
        origin = self.betas.copy()
        before = np.full(len(self.n), np.inf)
        for step in range(1, MOST_STEPS + 1):
            loss, held_out, gradient, products = newton_sums(rows, self.betas[on], self.left_out[on])
            value = loss / self.n[on] + self.penalty(self.betas[on], on)
            worse = value > before[on] + 1e-10
            good = on[~worse]
            self.held_out[good] = held_out[~worse]
            unit, n = self.unit[good], self.n[good][:, None]
            scaled = self.betas[good] * unit
            gram = products[~worse] / n[:, :, None] / unit[:, :, None] / unit[:, None, :]
            target = gradient[~worse] / n / unit + np.einsum("mij,mj->mi", gram, scaled)
            moved = descend_all(gram, target, self.flat[good], self.bent[good], scaled)
            settled = np.abs(moved - scaled).max(axis=1) < TOLERANCE
            origin[good], before[good] = self.betas[good], value[~worse]
            self.betas[good[~settled]] = (moved / unit)[~settled]
            bad = on[worse]
            self.betas[bad] = (self.betas[bad] + origin[bad]) / 2
            on = np.sort(np.concatenate((good[~settled], bad)))
            if not len(on):
                return step
        return MOST_STEPS
