"""A neural classifier trained over the parts of a table: mini-batches within a part, averages between parts.

Every epoch is one job. A task starts from the common weights, goes through
the rows of its part in mini-batches drawn by a hash of their keys, and gives
its weights back; the next epoch starts from their mean, by rows. One part is
plain mini-batch training. The same job counts how the weights it started from
do on held-out rows, which decides when to stop.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from hearthspark.functions.sums import sum_arrays
from hearthspark.operators.boosting import draw
from hearthspark.session import materialize

# Bytes of a part; a task holds one.
PART_BYTES = 64 << 20
# What keeps a variance from dividing by zero, how fast running statistics follow, and Adam's constants.
EPSILON, MOMENTUM = 1e-5, 0.1
BETA_1, BETA_2, ADAM_EPSILON = 0.9, 0.999, 1e-8


@dataclass(frozen=True)
class Network:
    """Layers with batch normalization, ReLU and dropout before a two-class output, and how they are trained."""

    hidden: tuple[int, ...] = (128, 64, 32)
    dropout: float = 0.3
    rate: float = 1e-4
    decay: float = 1e-5
    batch: int = 32
    epochs: int = 100
    patience: int = 10
    seed: int = 42


class Weights:
    """All numbers of a network in one vector, and views of them by layer."""

    def __init__(self, network: Network, n_inputs: int, values: np.ndarray | None = None) -> None:
        self.network, self.n_inputs = network, n_inputs
        sizes = [n_inputs, *network.hidden, 2]
        # Of each layer the matrix and the shift; of hidden ones the scale and shift behind normalization as well.
        self.shapes = [shape for a, b in zip(sizes[:-1], sizes[1:]) for shape in ((a, b), (b,), (b,), (b,))][:-2]
        self.sizes = [int(np.prod(shape)) for shape in self.shapes]
        self.values = self._first() if values is None else values

    def _first(self) -> np.ndarray:
        source = np.random.default_rng(self.network.seed)
        made = []
        for i, (shape, size) in enumerate(zip(self.shapes, self.sizes, strict=True)):
            bound = 1 / np.sqrt(self.shapes[i // 4 * 4][0])
            made.append(np.ones(size) if i % 4 == 2 else np.zeros(size) if i % 4 == 3 else source.uniform(-bound, bound, size))
        return np.concatenate(made)

    def layers(self, values: np.ndarray | None = None) -> list[list[np.ndarray]]:
        """Views of the vector (or of one like it), a list for each layer."""
        values = self.values if values is None else values
        cut = np.split(values, np.cumsum(self.sizes)[:-1])
        flat = [part.reshape(shape) for part, shape in zip(cut, self.shapes, strict=True)]
        return [flat[i:i + 4] for i in range(0, len(flat), 4)]

    def running(self) -> np.ndarray:
        """Running means and variances to begin with, by hidden layer."""
        return np.concatenate([np.concatenate((np.zeros(n), np.ones(n))) for n in self.network.hidden])


def running_layers(network: Network, running: np.ndarray) -> list[np.ndarray]:
    cut = np.split(running, np.cumsum([2 * n for n in network.hidden])[:-1])
    return [part.reshape(2, -1) for part in cut]


def logits(weights: Weights, running: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Output of the trained network, normalized by the running statistics."""
    statistics = running_layers(weights.network, running)
    for layer, (matrix, shift, *norm) in enumerate(weights.layers()):
        x = x @ matrix + shift
        if norm:
            mean, variance = statistics[layer]
            x = np.maximum(0, (x - mean) / np.sqrt(variance + EPSILON) * norm[0] + norm[1])
    return x


def loss_and_gradient(weights: Weights, x: np.ndarray, y: np.ndarray, weight: np.ndarray, masks: list[np.ndarray]
                      ) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted mean cross-entropy of a mini-batch, its gradient, and the batch's means and variances by layer.

    ``masks`` are the dropout factors of each hidden layer.
    """
    layers, kept, seen = weights.layers(), [], []
    for layer, (matrix, shift, *norm) in enumerate(layers):
        source = x
        x = x @ matrix + shift
        if norm:
            mean, variance = x.mean(axis=0), x.var(axis=0)
            spread = np.sqrt(variance + EPSILON)
            unit = (x - mean) / spread
            made = unit * norm[0] + norm[1]
            x = np.maximum(0, made) * masks[layer]
            seen.append(np.concatenate((mean, variance * len(x) / max(1, len(x) - 1))))
            kept.append((source, unit, spread, made))
        else:
            kept.append((source, None, None, None))
    top = x - x.max(axis=1, keepdims=True)
    chance = np.exp(top) / np.exp(top).sum(axis=1, keepdims=True)
    share = weight / weight.sum()
    loss = -(share * np.log(chance[np.arange(len(y)), y] + 1e-300)).sum()
    back = chance.copy()
    back[np.arange(len(y)), y] -= 1
    back *= share[:, None]

    gradient = np.zeros_like(weights.values)
    views = weights.layers(gradient)
    for layer in range(len(layers) - 1, -1, -1):
        source, unit, spread, made = kept[layer]
        if unit is not None:
            back = back * masks[layer] * (made > 0)
            views[layer][2][:] = (back * unit).sum(axis=0)
            views[layer][3][:] = back.sum(axis=0)
            back = back * layers[layer][2]
            back = (back - back.mean(axis=0) - unit * (back * unit).mean(axis=0)) / spread
        views[layer][0][:] = source.T @ back
        views[layer][1][:] = back.sum(axis=0)
        back = back @ layers[layer][0].T
    return float(loss), gradient, np.concatenate(seen)


@dataclass
class Training:
    """Where training stands: weights, running statistics, Adam's two moments and the steps taken."""

    values: np.ndarray
    running: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: float

    def packed(self) -> np.ndarray:
        return np.concatenate((self.values, self.running, self.first, self.second, [self.steps]))

    @staticmethod
    def of(data: np.ndarray, n: int) -> Training:
        values, running, first, second, steps = np.split(data, [n, len(data) - 2 * n - 1, len(data) - n - 1, len(data) - 1])
        return Training(values.copy(), running.copy(), first.copy(), second.copy(), float(steps[0]))


def run_epoch(state: Training, network: Network, key: np.ndarray, y: np.ndarray, weight: np.ndarray, x: np.ndarray,
              number: int, part: int = 0) -> None:
    """Go through the rows once in mini-batches; no batch has a single row unless there is only one."""
    weights = Weights(network, x.shape[1], state.values)
    source = np.random.default_rng((network.seed, number, part))
    order = np.lexsort((key, draw(key, network.seed, number)))
    cuts = np.arange(network.batch, len(order) - 1, network.batch)
    for batch in np.split(order, cuts):
        masks = [(source.random((len(batch), n)) >= network.dropout) / (1 - network.dropout) for n in network.hidden]
        _, gradient, seen = loss_and_gradient(weights, x[batch], y[batch], weight[batch], masks)
        gradient += network.decay * state.values
        state.steps += 1
        state.first += (1 - BETA_1) * (gradient - state.first)
        state.second += (1 - BETA_2) * (gradient ** 2 - state.second)
        size = network.rate * np.sqrt(1 - BETA_2 ** state.steps) / (1 - BETA_1 ** state.steps)
        state.values -= size * state.first / (np.sqrt(state.second) + ADAM_EPSILON * np.sqrt(1 - BETA_2 ** state.steps))
        state.running += MOMENTUM * (seen - state.running)


@dataclass(frozen=True)
class NeuralModel:
    """A trained network, as a model a ``Scorer`` can hold."""

    network: Network
    n_inputs: int
    values: list[float]
    running: list[float]

    def probability(self, features: Column) -> Column:
        """Probability of class 1, by batches of rows."""
        network, n_inputs = self.network, self.n_inputs
        values, running = np.array(self.values), np.array(self.running)

        @F.pandas_udf(DoubleType())
        def score(rows):
            if not len(rows):
                return rows.astype("float64")
            out = logits(Weights(network, n_inputs, values), running, np.stack(rows.to_numpy()))
            return type(rows)(1 / (1 + np.exp(out[:, 0] - out[:, 1])))

        return score(vector_to_array(features))

    def settings(self) -> dict:
        return {"kind": "neural", "network": asdict(self.network), "n_inputs": self.n_inputs, "values": self.values,
                "running": self.running}

    @staticmethod
    def of(settings: dict) -> NeuralModel:
        network = Network(**{**settings["network"], "hidden": tuple(settings["network"]["hidden"])})
        return NeuralModel(**{**settings, "network": network})


@dataclass(frozen=True)
class TrainingTable:
    """Written rows in parts of bounded bytes, which any number of trainers may start from."""

    table: DataFrame
    n_inputs: int
    watching: bool


def training_table(rows: DataFrame, part_bytes: int = PART_BYTES) -> TrainingTable:
    """``rows`` has key, label, weight, held and features (an array); held rows watch, and are never learned from."""
    source = rows.select("key", F.col("label").cast("double"), F.col("weight").cast("double"), "held", "features")
    size = source.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width"),
                      F.count_if("held").alias("held")).first()
    if size["n"] == size["held"]:
        raise ValueError("no rows to learn from")
    parts = max(1, -(-size["n"] * (8 * size["width"] + 40) // part_bytes))
    written = materialize(source.repartition(parts, "key").sortWithinPartitions("key"))
    return TrainingTable(written, size["width"], size["held"] > 0)


class Trainer:
    """Training that can go on: the state after each epoch, F1 on the held rows, and the best state so far."""

    def __init__(self, rows: TrainingTable, network: Network) -> None:
        weights = Weights(network, rows.n_inputs)
        n = len(weights.values)
        self.rows, self.network = rows, network
        self.state = self.best = Training(weights.values, weights.running(), np.zeros(n), np.zeros(n), 0.0)
        self.scores: list[float] = []
        self.trained = 0

    @property
    def stopped(self) -> bool:
        """Whether the best epoch is ``patience`` epochs back."""
        return self.rows.watching and bool(self.scores) and (
            len(self.scores) - int(np.argmax(self.scores)) > self.network.patience)

    def advance(self, epochs: int) -> Trainer:
        """Go on until so many epochs in all have been scored, or until patience ends."""
        epochs = min(epochs, self.network.epochs)
        while len(self.scores) < epochs and not self.stopped:
            f1, following = _epoch_job(self.rows.table, self.state, self.network, self.rows.n_inputs, self.trained,
                                       train=self.trained < self.network.epochs)
            if self.trained:
                if not self.rows.watching or f1 > max(self.scores, default=-1.0):
                    self.best = self.state
                self.scores.append(f1)
            self.state = following
            self.trained += 1
        return self

    def model(self) -> NeuralModel:
        """The best epoch's network, the first on ties; the last one's if nothing was watched."""
        return NeuralModel(self.network, self.rows.n_inputs, self.best.values.tolist(), self.best.running.tolist())


def fit_network(rows: DataFrame, network: Network, part_bytes: int = PART_BYTES) -> tuple[NeuralModel, list[float]]:
    """Train until F1 on the held rows (class 1) has not risen for ``patience`` epochs.

    Returns the network of the best epoch and F1 after each epoch. Without
    held rows all epochs are run and the last one is kept.
    """
    trainer = Trainer(training_table(rows, part_bytes), network).advance(network.epochs)
    return trainer.model(), trainer.scores


def _epoch_job(table: DataFrame, state: Training, network: Network, n_inputs: int, number: int, train: bool
               ) -> tuple[float, Training]:
    """F1 of ``state`` on the held rows, and the state after one more epoch."""
    shared = table.sparkSession.sparkContext.broadcast(state.packed())
    n_values = len(state.values)

    def add_up(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        own = [batch for batch in batches if batch.num_rows]
        if not own:
            return {}
        whole = pa.concat_batches(own)
        key, label, weight, held = (whole.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        x = whole.column(4).flatten().to_numpy().reshape(len(key), -1)
        here = Training.of(shared.value, n_values)
        out = logits(Weights(network, n_inputs, here.values), here.running, x[held])
        yes, true = out[:, 1] > out[:, 0], label[held] > 0
        counts = np.array([(yes & true).sum(), (yes & ~true).sum(), (~yes & true).sum()], np.float64)
        learned = ~held
        if train and learned.any():
            run_epoch(here, network, key[learned], label[learned].astype(np.int64), weight[learned], x[learned], number,
                      int(key[learned].min() & 0xFFFF))
        n = float(learned.sum())
        return {0: counts, 1: np.concatenate(([n], n * here.packed()))}

    found = sum_arrays(table, add_up)
    shared.unpersist()
    right, false, missed = found[0]
    return (float(2 * right / max(1, 2 * right + false + missed)),
            Training.of(found[1][1:] / found[1][0], n_values))
