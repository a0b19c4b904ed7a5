"""Gradient-boosted trees by histograms, grown a round at a time on a written table of byte bins.

Gradients and second derivatives are whole numbers of a fixed fine unit, so
sums don't depend on how rows are dealt to tasks: the same table gives the same
trees in any number of partitions and by either way of adding up.

A table whose bins have at most LOCAL_BYTES (they are counted first) is grown
on in one task, many rounds to a job; several boosters then run side by side.
For a larger one each level of a tree is a job: tasks make the histograms of
their rows, a shuffle adds them up, and the driver chooses the splits from the
sums. Both go on from the margins written with the rows, so a lost executor
costs the rounds since then.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from hearthspark.functions.sums import sum_arrays
from hearthspark.session import materialize

# Units of a gradient in one.
UNIT = 1 << 20
# Bytes of a binned table that one task grows on.
LOCAL_BYTES = 128 << 20
# Nodes with fewer rows are counted without joint bins; rows counted at once; and joint bins at most.
FEW_ROWS, TOGETHER, JOINT_CELLS = 1024, 1 << 15, 4096
# Bytes of histograms that splits are chosen from at once.
SPLIT_BYTES = 16 << 20
# Rounds between written margins: of a table in one task, and of one that takes a job a level.
KEEP_LOCAL, KEEP_JOBS = 100, 10
LEAST_GAIN = 1e-9
# In place of a zero that would divide: no row has a second derivative below a unit's.
TINY = 1e-12
# Accuracy of the quantiles that cut a feature into bins, and bytes of the rows they are taken of at once.
ACCURACY, CUT_BYTES = 10_000, 32 << 20

Histogram = np.ndarray  # (node, feature, bin, 3): gradients, second derivatives, rows
Count = Callable[[list[int]], Histogram]


@dataclass(frozen=True)
class Boost:
    """How trees are grown. ``leaves`` chooses best-first growth to so many leaves, else levels down to ``depth``."""

    depth: int = 6
    rate: float = 0.1
    rounds: int = 500
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 1
    min_weight: float = 1.0
    l2: float = 1.0
    bins: int = 64
    leaves: int | None = None
    seed: int = 42
    # What is watched on held-out rows, "loss" or "f1", and the rounds without gain that end the growth; none if that is
    # never asked, 0 for watching alone.
    patience: int | None = None
    watch: str = "loss"


@dataclass
class Tree:
    """Nodes in the order they were made: children of split nodes stand behind them."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> int:
        """Make two children; returns the left one, the right one is the next."""
        child = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, cut, child, gain
        for values, blank in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0),
                              (self.cover, 0.0)):
            values.extend([blank, blank])
        return child

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return (np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.value))


def routed(tree: tuple[np.ndarray, ...], bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """The node each of ``rows`` comes to rest in, of all by default."""
    feature, cut, left, _ = tree
    rows = np.arange(len(bins)) if rows is None else rows
    node = np.zeros(len(rows), np.int64)
    going = np.flatnonzero(feature[node] >= 0)
    while len(going):
        at = node[going]
        node[going] = left[at] + (bins[rows[going], feature[at]] > cut[at])
        going = going[feature[node[going]] >= 0]
    return node


# ---- rows of a task -----------------------------------------------------------------------

class Rows:
    """Binned rows with their labels, weights and margins; ``held`` rows only watch."""

    def __init__(self, key: np.ndarray, label: np.ndarray, weight: np.ndarray, held: np.ndarray, margin: np.ndarray,
                 bins: np.ndarray) -> None:
        self.key, self.label, self.weight, self.held, self.margin, self.bins = key, label, weight, held, margin, bins
        self.columns: np.ndarray | None = None
        self.joint: list[Joint] = []

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        key, label, weight, held, margin = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        n = batch.num_rows
        bins = bin_matrix(batch.column(5)) if n else np.zeros((0, 1), np.uint8)
        return Rows(key, label, weight, held, margin.copy(), bins)

    def prepare(self) -> Rows:
        """For many rounds on the same rows: the bins by feature, and features of few bins counted by their joint bins."""
        self.columns = np.ascontiguousarray(self.bins.T)
        widths = self.columns.max(axis=1, initial=0).astype(np.int64) + 1
        self.joint = []
        own, cells = [], 1
        for feature in np.argsort(widths, kind="stable").tolist():
            if own and cells * widths[feature] > JOINT_CELLS:
                self.joint.append(Joint.of(self.columns, own, widths))
                own, cells = [], 1
            own.append(feature)
            cells *= int(widths[feature])
        self.joint.append(Joint.of(self.columns, own, widths))
        return self

    def begin(self, boost: Boost, number: int) -> None:
        """Gradients of a round, and the rows that its tree is grown on."""
        chance = 1 / (1 + np.exp(-self.margin))
        self.drawn = ~self.held & (draw(self.key, boost.seed, number) < boost.row_share)
        weight = self.weight * UNIT
        self.gradient = np.rint((chance - self.label) * weight)
        self.curve = np.rint(chance * (1 - chance) * weight)
        # The rows of each node that is not split.
        self.at = {0: np.flatnonzero(self.drawn)}

    def follow(self, tree: tuple[np.ndarray, ...]) -> None:
        feature, cut, left, _ = tree
        waiting = list(self.at)
        while waiting:
            node = waiting.pop()
            if feature[node] < 0:
                continue
            rows = self.at.pop(node)
            values = self.bins[rows, feature[node]] if self.columns is None else self.columns[feature[node]].take(rows)
            right = values > cut[node]
            child = int(left[node])
            self.at[child], self.at[child + 1] = rows[~right], rows[right]
            waiting += [child, child + 1]

    def histogram(self, nodes: Sequence[int], features: np.ndarray, n_bins: int) -> Histogram:
        """Sums of the rows in each of ``nodes``, by feature and bin."""
        made = np.zeros((len(nodes), len(features), n_bins, 3), np.int64)
        rows = [self.at.get(node, ()) for node in nodes]
        large = [i for i, own in enumerate(rows) if self.joint and len(own) >= FEW_ROWS]
        if large:
            joints = [joint for joint in self.joint if np.isin(joint.features, features).any()]
            sums = [np.zeros((len(large), 3, len(joint.parts))) for joint in joints]
            for place, i in enumerate(large):
                for start in range(0, len(rows[i]), TOGETHER):
                    here = rows[i][start:start + TOGETHER]
                    gradient, curve = self.gradient.take(here), self.curve.take(here)
                    # Rows are counted above the largest sum of curves where one number has room for both.
                    unit = float(1 << int(curve.sum() + 1).bit_length())
                    unit = unit if unit * (len(here) + 1) < 1 << 53 else None
                    curve = curve if unit is None else curve + unit
                    for joint, own in zip(joints, sums, strict=True):
                        joint.add(here, gradient, curve, unit, own[place])
            for joint, own in zip(joints, sums, strict=True):
                joint.share(own, large, features, made)
        few = [i for i, own in enumerate(rows) if 0 < len(own) and not (self.joint and len(own) >= FEW_ROWS)]
        if few:
            every = np.concatenate([rows[i] for i in few])
            place = np.repeat(few, [len(rows[i]) for i in few])
            for start in range(0, len(every), TOGETHER):
                here, at = every[start:start + TOGETHER], place[start:start + TOGETHER]
                first, width = at[0], len(features) * n_bins
                cell = ((at - first) * width)[:, None] + self.bins[here[:, None], features] + np.arange(len(features)) * n_bins
                size = int(at[-1] - first + 1) * width
                part = made[first:at[-1] + 1]
                cell = cell.ravel()
                for k, values in enumerate((self.gradient, self.curve, None)):
                    weight = None if values is None else np.repeat(values[here], len(features))
                    part[..., k] += np.bincount(cell, weight, size).astype(np.int64).reshape(part.shape[:3])
        return made

    def end(self, tree: Tree) -> None:
        arrays = tree.arrays()
        self.margin += arrays[3][routed(arrays, self.bins)]

    def finish(self, tree: Tree) -> None:
        """``end`` for the tree just grown, whose rows stand in its nodes."""
        arrays = tree.arrays()
        self.follow(arrays)
        for node, rows in self.at.items():
            self.margin[rows] += arrays[3][node]
        rest = np.flatnonzero(~self.drawn)
        self.margin[rest] += arrays[3][routed(arrays, self.bins, rest)]

    def watch(self) -> np.ndarray:
        """Of the held-out rows: log-loss in units, their weight, and right, false and missed ones of class 1."""
        margin, label, weight = (x[self.held] for x in (self.margin, self.label, self.weight))
        loss = np.logaddexp(0, margin) - label * margin
        yes = margin > 0
        return np.array([np.rint(loss * weight * UNIT).sum(), np.rint(weight * UNIT).sum(), (yes & (label > 0)).sum(),
                         (yes & (label == 0)).sum(), (~yes & (label > 0)).sum()], np.int64)


@dataclass(frozen=True)
class Joint:
    """Some features, counted at once by the number that their bins make together."""

    features: list[int]
    widths: list[int]
    codes: np.ndarray  # by row
    parts: np.ndarray  # (cell, bins of the features side by side): 1 where the cell has the bin

    @staticmethod
    def of(columns: np.ndarray, features: list[int], widths: np.ndarray) -> Joint:
        own = [int(widths[feature]) for feature in features]
        codes, cells = np.zeros(columns.shape[1], np.uint16), np.zeros(1, np.int64)
        for feature, width in zip(features, own, strict=True):
            codes = codes * np.uint16(width) + columns[feature]
            cells = (cells[:, None] * width + np.arange(width)).ravel()
        parts, step = [], len(cells)
        for width in own:
            step //= width
            parts.append((cells // step % width)[:, None] == np.arange(width))
        return Joint(features, own, codes, np.concatenate(parts, axis=1).astype(np.float64))

    def add(self, rows: np.ndarray, gradient: np.ndarray, curve: np.ndarray, unit: float | None, sums: np.ndarray) -> None:
        """Add some rows to (3, cell) sums; ``curve`` counts them as well, in units of ``unit``, where that is given."""
        n = len(self.parts)
        cell = self.codes.take(rows).astype(np.intp)
        sums[0] += np.bincount(cell, gradient, n)
        found = np.bincount(cell, curve, n)
        if unit is None:
            sums[1] += found
            sums[2] += np.bincount(cell, minlength=n)
        else:
            number = np.floor(found / unit)
            sums[1] += found - number * unit
            sums[2] += number

    def share(self, found: np.ndarray, places: list[int], features: np.ndarray, made: Histogram) -> None:
        """From (node, 3, cell) sums to those of single features."""
        ends = np.cumsum([0, *self.widths])
        listed = {feature: j for j, feature in enumerate(features.tolist())}
        pair = found.reshape(len(found), 3, *self.widths) if len(self.widths) == 2 else None
        split = (found.reshape(-1, len(self.parts)) @ self.parts).reshape(len(found), 3, -1) if pair is None else None
        for i, feature in enumerate(self.features):
            if feature in listed:
                own = split[..., ends[i]:ends[i + 1]] if pair is None else pair.sum(axis=3 - i)
                made[places, listed[feature], :self.widths[i]] = own.transpose(0, 2, 1)


def bin_matrix(column: pa.Array) -> np.ndarray:
    """A row of bytes for each value, all of one length; no copy is made."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].reshape(len(column), -1)


def mixed(key: np.ndarray, seed: int, number: int) -> np.ndarray:
    """64 bits for each key, other ones for each round."""
    x = key.view(np.uint64) + np.uint64((seed * 1_000_003 + number) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw(key: np.ndarray, seed: int, number: int) -> np.ndarray:
    """A number from 0 to 1 for each key, other ones for each round."""
    return (mixed(key, seed, number) >> np.uint64(11)).astype(np.float64) / (1 << 53)


# ---- growing a tree from histograms -----------------------------------------------------------

@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int


def columns_of(boost: Boost, number: int, n_features: int) -> np.ndarray:
    """The features a round's tree may split on, ascending."""
    n = max(1, round(boost.column_share * n_features))
    return np.sort(np.random.default_rng((boost.seed, number)).permutation(n_features)[:n])


def best_splits(found: Histogram, boost: Boost, features: np.ndarray) -> list[Split | None]:
    """For each node the split with the largest gain, the first feature and bin on ties."""
    if not len(found):
        return []
    step = max(1, SPLIT_BYTES // found[0].nbytes)
    if len(found) > step:
        return [split for i in range(0, len(found), step) for split in best_splits(found[i:i + step], boost, features)]
    sums = found.astype(np.float64)
    sums[..., :2] /= UNIT
    whole = sums[:, :1, :, :].sum(axis=2, keepdims=True)
    left = sums.cumsum(axis=2)
    right = whole - left

    def value(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / np.maximum(x[..., 1] + boost.l2, TINY)

    gain = (value(left) + value(right) - value(whole)) / 2
    allowed = ((left[..., 1] >= boost.min_weight) & (right[..., 1] >= boost.min_weight)
               & (left[..., 2] >= boost.min_rows) & (right[..., 2] >= boost.min_rows))
    gain = np.where(allowed, gain, -np.inf).reshape(len(found), -1)
    made: list[Split | None] = []
    for row, place in zip(gain, gain.argmax(axis=1).tolist(), strict=True):
        feature, cut = divmod(place, found.shape[2])
        made.append(Split(float(row[place]), int(features[feature]), cut) if row[place] > LEAST_GAIN else None)
    return made


def totals(found: Histogram) -> np.ndarray:
    """(node, 3) sums over all bins of the first feature."""
    return found[:, 0].sum(axis=1)


def settle(tree: Tree, node: int, sums: np.ndarray, boost: Boost) -> None:
    """Value and cover of a node; a value that stays if the node is not split."""
    gradient, curve = sums[0] / UNIT, sums[1] / UNIT
    tree.value[node] = -boost.rate * gradient / max(curve + boost.l2, TINY)
    tree.cover[node] = float(curve)


def grow(count: Callable[[Tree, list[int]], Histogram], boost: Boost, features: np.ndarray) -> Tree:
    """A tree from histograms: ``count`` gives those of some nodes of the tree as it stands.

    Of two children only the one with fewer rows is counted, the other is
    what it leaves of the parent.
    """
    tree = Tree()
    root = count(tree, [0])
    settle(tree, 0, totals(root)[0], boost)
    if boost.leaves is None:
        _by_levels(tree, root, count, boost, features)
    else:
        _by_gain(tree, root, count, boost, features)
    return tree


def _close(tree: Tree, nodes: list[int], found: Histogram, splits: Sequence[Split], count, boost: Boost) -> None:
    """Split ``nodes`` into leaves, whose sums are those on both sides of the cut."""
    for own, node, split in zip(found, nodes, splits, strict=True):
        child = tree.split(node, split.feature, split.cut, split.gain)
        sums = own[int(np.searchsorted(count.features, split.feature))]
        left = sums[:split.cut + 1].sum(axis=0)
        settle(tree, child, left, boost)
        settle(tree, child + 1, sums.sum(axis=0) - left, boost)


def _open(tree: Tree, nodes: list[int], found: Histogram, splits: Sequence[Split], count, boost: Boost
          ) -> tuple[list[int], Histogram]:
    """Split ``nodes``; returns their children and the children's histograms."""
    smaller, larger = [], []
    for i, (node, split) in enumerate(zip(nodes, splits, strict=True)):
        child = tree.split(node, split.feature, split.cut, split.gain)
        feature = int(np.searchsorted(count.features, split.feature))
        left = found[i, feature, :split.cut + 1, 2].sum()
        fewer_left = 2 * left <= found[i, feature, :, 2].sum()
        smaller.append(child if fewer_left else child + 1)
        larger.append(child + 1 if fewer_left else child)
    counted = count(tree, smaller)
    children = [*smaller, *larger]
    sums = np.concatenate((counted, found - counted))
    for child, total in zip(children, totals(sums), strict=True):
        settle(tree, child, total, boost)
    return children, sums


def _by_levels(tree: Tree, found: Histogram, count, boost: Boost, features: np.ndarray) -> None:
    nodes = [0]
    for level in range(boost.depth):
        splits = best_splits(found, boost, features)
        on = [i for i, split in enumerate(splits) if split is not None]
        if not on:
            break
        if level == boost.depth - 1:
            _close(tree, [nodes[i] for i in on], found[on], [splits[i] for i in on], count, boost)
            break
        nodes, found = _open(tree, [nodes[i] for i in on], found[on], [splits[i] for i in on], count, boost)


def _by_gain(tree: Tree, found: Histogram, count, boost: Boost, features: np.ndarray) -> None:
    """The open leaf with the largest gain is split next, the older one on ties."""
    waiting: list[tuple[float, int, Split, int, np.ndarray]] = []

    def offer(node: int, sums: np.ndarray, depth: int) -> None:
        split = best_splits(sums[None], boost, features)[0]
        if split is not None and depth < boost.depth:
            heapq.heappush(waiting, (-split.gain, node, split, depth, sums))

    offer(0, found[0], 0)
    leaves = 1
    while waiting and leaves < boost.leaves:
        _, node, split, depth, sums = heapq.heappop(waiting)
        children, made = _open(tree, [node], sums[None], [split], count, boost)
        for child, own in zip(children, made, strict=True):
            offer(child, own, depth + 1)
        leaves += 1


class Counter:
    """What ``grow`` asks for the histograms of nodes."""

    def __init__(self, features: np.ndarray) -> None:
        self.features = features

    def __call__(self, tree: Tree, nodes: list[int]) -> Histogram:
        raise NotImplementedError


class TaskCounter(Counter):
    """Histograms of the rows of this task."""

    def __init__(self, rows: Rows, features: np.ndarray, n_bins: int) -> None:
        super().__init__(features)
        self.rows, self.n_bins = rows, n_bins

    def __call__(self, tree: Tree, nodes: list[int]) -> Histogram:
        self.rows.follow(tree.arrays())
        return self.rows.histogram(nodes, self.features, self.n_bins)


class JobCounter(Counter):
    """Histograms by one job: tasks bring their rows' margins up to date with the trees since they were written."""

    def __init__(self, table: DataFrame, boost: Boost, number: int, since: list[Tree], features: np.ndarray,
                 n_bins: int) -> None:
        super().__init__(features)
        self.table, self.boost, self.number, self.since, self.n_bins = table, boost, number, since, n_bins

    def __call__(self, tree: Tree, nodes: list[int]) -> Histogram:
        boost, number, since, features, n_bins = self.boost, self.number, list(self.since), self.features, self.n_bins
        arrays = tree.arrays()

        def add_up(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
            found = 0
            for batch in batches:
                rows = Rows.of(batch)
                for one in since:
                    rows.end(one)
                rows.begin(boost, number)
                rows.follow(arrays)
                found = found + rows.histogram(nodes, features, n_bins)
            # Each node is a key, so that the sums of nodes are added up in several tasks.
            return {i: found[i].ravel() for i in range(len(nodes))} if not isinstance(found, int) else {}

        made = sum_arrays(self.table, add_up, "<i8")
        shape = (len(features), n_bins, 3)
        return np.array([made[i].reshape(shape) if i in made else np.zeros(shape, np.int64) for i in range(len(nodes))])


# ---- rounds --------------------------------------------------------------------------------

@dataclass
class Progress:
    """Trees so far and what the held-out rows said after each."""

    trees: list[Tree] = field(default_factory=list)
    watched: list[float] = field(default_factory=list)
    stopped: bool = False

    def best(self) -> int:
        """Rounds up to the best one watched, the first on ties; all if none was watched."""
        return int(np.argmin(self.watched)) + 1 if self.watched else len(self.trees)

    def note(self, watched: np.ndarray, boost: Boost) -> None:
        loss, weight, right, false, missed = watched.tolist()
        value = loss / max(1, weight) if boost.watch == "loss" else -2 * right / max(1, 2 * right + false + missed)
        self.watched.append(value)
        self.stopped = 0 < boost.patience <= len(self.watched) - self.best()


TABLE = "key long, label double, weight double, held boolean, margin double, bins binary"
ROW = pa.schema([("key", pa.int64()), ("label", pa.float64()), ("weight", pa.float64()), ("held", pa.bool_()),
                 ("margin", pa.float64()), ("bins", pa.binary())])


def local_rounds(table: DataFrame, progress: Progress, boost: Boost, until: int, n_features: int
                 ) -> tuple[DataFrame, Progress]:
    """Rounds up to ``until`` on a table that one task holds; one job, which also writes the new margins."""
    done, watched = len(progress.trees), list(progress.watched)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.concat_batches(list(batches))
        rows = Rows.of(whole).prepare()
        here = Progress([], list(watched))
        while done + len(here.trees) < until and not here.stopped:
            number = done + len(here.trees)
            features = columns_of(boost, number, n_features)
            rows.begin(boost, number)
            tree = grow(TaskCounter(rows, features, boost.bins), boost, features)
            rows.finish(tree)
            here.trees.append(tree)
            if boost.patience is not None:
                here.note(rows.watch(), boost)
        text = json.dumps([[asdict(tree) for tree in here.trees], here.watched, here.stopped])
        names = [*ROW.names, "trees"]
        yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in ROW], pa.array([text])], names=names)
        columns = [*whole.columns[:4], pa.array(rows.margin), whole.column(5), pa.nulls(whole.num_rows, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    made = materialize(table.repartition(1).mapInArrow(run, f"{TABLE}, trees string"))
    trees, watched, stopped = json.loads(made.where("trees is not null").first()["trees"])
    return (made.where("trees is null").drop("trees"),
            Progress([*progress.trees, *[Tree(**tree) for tree in trees]], watched, stopped))


def job_rounds(table: DataFrame, progress: Progress, boost: Boost, until: int, n_features: int
               ) -> tuple[DataFrame, Progress]:
    """Rounds up to ``until`` with one job for each level (or split) of a tree; margins are written at the end."""
    made = Progress(list(progress.trees), list(progress.watched))
    start = len(made.trees)
    while len(made.trees) < until and not made.stopped:
        number = len(made.trees)
        features = columns_of(boost, number, n_features)
        made.trees.append(grow(JobCounter(table, boost, number, made.trees[start:], features, boost.bins), boost, features))
        if boost.patience is not None:
            since = made.trees[start:]

            def add_up(batches: Iterator[pa.RecordBatch], since: list[Tree] = since) -> dict[int, np.ndarray]:
                found = np.zeros(5, np.int64)
                for batch in batches:
                    rows = Rows.of(batch)
                    for tree in since:
                        rows.end(tree)
                    found += rows.watch()
                return {0: found}

            made.note(sum_arrays(table, add_up, "<i8")[0], boost)
    since = made.trees[start:]

    def renew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Rows.of(batch)
            for tree in since:
                rows.end(tree)
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(rows.margin))

    return materialize(table.mapInArrow(renew, TABLE)), made


# ---- models --------------------------------------------------------------------------------

@dataclass(frozen=True)
class BoostedModel:
    """Trees with the cuts of their features, as a model a ``Scorer`` can hold."""

    trees: list[Tree]
    cuts: list[list[float]]
    start: float

    def probability(self, features: Column) -> Column:
        """Probability of class 1, by all trees for a batch of rows at once."""
        trees = [tree.arrays() for tree in self.trees]
        cuts, start = self.cuts, self.start

        @F.pandas_udf(DoubleType())
        def score(values):
            if not len(values):
                return values.astype("float64")
            bins = binned(np.stack(values.to_numpy()), cuts)
            margin = np.full(len(bins), start)
            for tree in trees:
                margin += tree[3][routed(tree, bins)]
            return type(values)(1 / (1 + np.exp(-margin)))

        return score(vector_to_array(features))

    def importance(self, names: Sequence[str]) -> list[tuple[str, int, float, float, float]]:
        """(feature, splits, total gain, mean gain, total cover) over all nodes of all trees."""
        splits, gain, cover = (np.zeros(len(names)) for _ in range(3))
        for tree in self.trees:
            feature = np.array(tree.feature)
            on = feature >= 0
            np.add.at(splits, feature[on], 1)
            np.add.at(gain, feature[on], np.array(tree.gain)[on])
            np.add.at(cover, feature[on], np.array(tree.cover)[on])
        return [(name, int(n), float(g), float(g / n) if n else 0.0, float(c))
                for name, n, g, c in zip(names, splits, gain, cover, strict=True)]

    def settings(self) -> dict:
        return {"kind": "boosted", "trees": [asdict(tree) for tree in self.trees], "cuts": self.cuts, "start": self.start}


def binned(values: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """The bin of each value: how many of its feature's cuts lie below it."""
    made = np.empty(values.shape, np.uint8)
    for j, own in enumerate(cuts):
        made[:, j] = np.searchsorted(np.array(own), values[:, j], side="left")
    return made


def summary(values: np.ndarray, counts: np.ndarray | None = None, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how many rows have them; the rows of at most ``most`` of them, evenly by rank."""
    if counts is None:
        made, total = np.unique(values, return_counts=True)
    else:
        made, place = np.unique(values, return_inverse=True)
        total = np.bincount(place, counts, len(made)).astype(np.int64)
    if most is not None and len(made) > most:
        ranks = total.cumsum()
        kept = np.unique(np.searchsorted(ranks, -(-np.arange(1, most + 1) * ranks[-1] // most)))
        made, total = made[kept], np.diff(ranks[kept], prepend=0)
    return made, total


def find_cuts(rows: DataFrame, n_features: int, bins: int) -> list[list[float]]:
    """At most bins - 1 quantiles of each feature, where values at or below a cut go left."""
    shares = [i / bins for i in range(1, bins)]
    row = rows.agg(*[F.percentile_approx(F.col("features")[j], shares, ACCURACY).alias(f"q{j}")
                     for j in range(n_features)]).first()
    tops = rows.agg(*[F.max(F.col("features")[j]).alias(f"m{j}") for j in range(n_features)]).first()
    # A cut at the largest value parts nothing.
    return [sorted({float(x) for x in row[f"q{j}"] or () if x < tops[f"m{j}"]}) for j in range(n_features)]


def sorted_cuts(rows: DataFrame, n_features: int, bins: int) -> list[list[float]]:
    """What ``find_cuts`` gives, by sorting parts of the rows: many times cheaper a value, and other values of like rank.

    Exact where a feature has few values; else each part of CUT_BYTES of a task's rows is known by ACCURACY of its values.
    """
    shares = np.array([i / bins for i in range(1, bins)])
    most = max(ACCURACY, CUT_BYTES // (8 * max(1, n_features)))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        waiting, n = [], 0
        for batch in batches:
            if n + batch.num_rows > most and n:
                yield np.concatenate(waiting)
                waiting, n = [], 0
            waiting.append(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1))
            n += batch.num_rows
        if n:
            yield np.concatenate(waiting)

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n_features)]
        for part in parts(batches):
            for own, values in zip(found, np.ascontiguousarray(part.T), strict=True):
                own.append(summary(values, most=ACCURACY))
        for j, own in enumerate(found):
            if own:
                made, total = summary(*[np.concatenate(x) for x in zip(*own, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([made.tobytes()], pa.binary()),
                                                  pa.array([total.tobytes()], pa.binary())], names=["feature", "made", "total"])

    def choose(found: pa.Table) -> pa.Table:
        made, total = [np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in found.column(name)])
                       for name, kind in (("made", "<f8"), ("total", "<i8"))]
        made, total = summary(made, total)
        ranks = total.cumsum()
        values = made[np.searchsorted(ranks, np.ceil(shares * ranks[-1]))]
        # A cut at the largest value parts nothing.
        cuts = np.unique(values[values < made[-1]])
        return pa.table({"feature": found.column("feature")[:1], "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    found = rows.select("features").mapInArrow(summarize, "feature int, made binary, total binary").groupBy("feature").applyInArrow(
        choose, "feature int, cuts array<double>").collect()
    cuts = {row["feature"]: list(row["cuts"]) for row in found}
    return [cuts[j] for j in range(n_features)]


@dataclass(frozen=True)
class Binned:
    """A written table of byte bins, which any number of boosters may start from."""

    table: DataFrame
    cuts: list[list[float]]
    start: float
    bytes: int


def bin_rows(rows: DataFrame, bins: int = Boost.bins,
             find: Callable[[DataFrame, int, int], list[list[float]]] = find_cuts) -> Binned:
    """Cut every feature into at most ``bins`` bins by its quantiles over the rows that are not held out.

    ``rows`` has key (a long; rows with the same key are drawn together),
    label (0 or 1), weight, held and features (an array without nulls). Held
    rows are watched, never learned from.
    """
    source = materialize(rows.select("key", F.col("label").cast("double"), F.col("weight").cast("double"), "held", "features"))
    learned = source.where(~F.col("held"))
    head = learned.agg(F.sum(F.col("weight") * F.col("label")), F.sum("weight"), F.max(F.size("features"))).first()
    if not head[1]:
        raise ValueError("no rows to learn from")
    cuts = find(learned, head[2], bins)
    share = min(max(head[0] / head[1], 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share)))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(4).flatten().to_numpy().reshape(batch.num_rows, len(cuts))
            ends = pa.py_buffer(np.arange(batch.num_rows + 1, dtype=np.int32) * len(cuts))
            data = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(binned(values, cuts))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(np.full(batch.num_rows, start)), data], schema=ROW)

    table = materialize(source.mapInArrow(make, TABLE))
    return Binned(table, cuts, start, table.count() * (len(cuts) + 40))


class Booster:
    """Trees that can be grown further: their margins stand with the rows, in a table written after each advance.

    ``local`` chooses how: in one task or by a job a level. By default the
    size of the table does; the trees are the same.
    """

    def __init__(self, rows: Binned, boost: Boost, local: bool | None = None) -> None:
        self.rows, self.boost, self.table, self.progress = rows, boost, rows.table, Progress()
        self.local = rows.bytes <= LOCAL_BYTES if local is None else local

    def advance(self, rounds: int) -> Booster:
        """Grow up to ``rounds`` trees in all, fewer where patience ends."""
        grown, step = (local_rounds, KEEP_LOCAL) if self.local else (job_rounds, KEEP_JOBS)
        while len(self.progress.trees) < rounds and not self.progress.stopped:
            until = min(rounds, len(self.progress.trees) + step)
            self.table, self.progress = grown(self.table, self.progress, self.boost, until, len(self.rows.cuts))
        return self

    def model(self) -> BoostedModel:
        """The trees up to the best round watched, all if none was watched."""
        return BoostedModel(self.progress.trees[:self.progress.best()], self.rows.cuts, self.rows.start)


def fit_boosted(rows: DataFrame, boost: Boost, local: bool | None = None) -> tuple[BoostedModel, Progress]:
    """Grow ``boost.rounds`` trees on ``rows`` (see ``bin_rows``), or fewer where patience ends."""
    booster = Booster(bin_rows(rows, boost.bins), boost, local).advance(boost.rounds)
    return booster.model(), booster.progress
