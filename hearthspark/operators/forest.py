"""Random forests by histograms, over a written table of byte bins.

A tree sees each row as often as a Poisson draw of its key says, and each node
chooses among features drawn by its place in the tree. So a forest depends on
rows and seed only, not on how rows are dealt to tasks.

A table of at most WHOLE_BYTES of bins is read by every task, and a task grows
whole trees of its own, side by side with the others. For a larger one a level of all
trees is a job: tasks count the rows of their part in the nodes of a tree, the
counts of a tree meet in one group, which chooses its splits.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from hearthspark.operators.boosting import TINY, bin_matrix, bin_rows, binned, draw, mixed, sorted_cuts
from hearthspark.session import in_parallel, materialize

# Bytes of a binned table that every task reads whole, and of a part that a task counts at once.
WHOLE_BYTES, PART_BYTES = 128 << 20, 64 << 20
# Weight of a split's gain that is more than rounding, a share of the node's.
LEAST_GAIN = 1e-12
# Nodes with fewer rows are counted together, so many rows at once.
FEW_ROWS, TOGETHER = 512, 1 << 15
# Counts of rows and of those of class 1 are added up in one number.
ONES = float(1 << 26)
# How often a row is drawn, by 16 random bits.
POISSON = np.searchsorted(np.cumsum([np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)]),
                          (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass(frozen=True)
class Forest:
    """How trees are grown: gini, the root of the number of features for each node, as many draws as there are rows."""

    trees: int = 500
    depth: int = 10
    bins: int = 32
    seed: int = 42


@dataclass
class Grown:
    """A tree by its nodes, those of a level behind those of the one before; a leaf has the feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray  # share of class 1
    gain: np.ndarray   # of a split: impurity times rows
    cover: np.ndarray  # rows
    path: np.ndarray   # the node's number where all nodes are split
    open: int = 0      # the first node of the last level

    KINDS = ("<i2", "u1", "<i4", "<f8", "<f8", "<f8", "<i8")

    @staticmethod
    def begin() -> Grown:
        return Grown(*[np.array([x], kind) for x, kind in zip((-1, 0, 0, 0.5, 0, 0, 1), Grown.KINDS, strict=True)])

    def arrays(self) -> list[np.ndarray]:
        return [self.feature, self.cut, self.left, self.value, self.gain, self.cover, self.path]

    def packed(self) -> list[bytes]:
        return [x.tobytes() for x in self.arrays()]

    @staticmethod
    def of(data: Sequence[bytes]) -> Grown:
        return Grown(*[np.frombuffer(x, kind).copy() for x, kind in zip(data, Grown.KINDS, strict=True)])

    def extend(self, level: np.ndarray) -> None:
        """Take the splits of the last level, as ``choose`` gives them, and open their children."""
        feature, cut, gain, cover, value, left_cover, left_value, right_cover, right_value = level
        begin = self.open
        self.value[begin:], self.cover[begin:] = value, cover
        on = np.flatnonzero(feature >= 0)
        nodes = begin + on
        self.open = len(self.feature)
        self.feature[nodes], self.cut[nodes], self.gain[nodes] = feature[on], cut[on], gain[on]
        self.left[nodes] = self.open + 2 * np.arange(len(on))

        def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.column_stack((a, b)).ravel()

        n = 2 * len(on)
        path = self.path[nodes]
        more = (np.full(n, -1), np.zeros(n), np.zeros(n), both(left_value[on], right_value[on]), np.zeros(n),
                both(left_cover[on], right_cover[on]), both(2 * path, 2 * path + 1))
        (self.feature, self.cut, self.left, self.value, self.gain, self.cover, self.path) = [
            np.concatenate((old, new.astype(old.dtype))) for old, new in zip(self.arrays(), more, strict=True)]


def down(tree: Grown, bins: np.ndarray, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    """One step: the node of each row, -1 for rows whose node is a leaf."""
    feature = tree.feature[node]
    right = bins[rows, feature] > tree.cut[node]
    return np.where(feature >= 0, tree.left[node] + right, -1)


def subsets(tree: Grown, number: int, forest: Forest, n_features: int) -> np.ndarray:
    """The features each open node chooses among, ascending."""
    n = int(np.ceil(np.sqrt(n_features)))
    keys = tree.path[tree.open:, None] * n_features + np.arange(n_features)
    return np.sort(np.argsort(draw(keys, forest.seed, -1 - number), axis=1, kind="stable")[:, :n], axis=1)


class Part:
    """Rows of a task."""

    def __init__(self, batches: Sequence[pa.RecordBatch]) -> None:
        whole = pa.concat_batches(batches)
        self.key, label, self.weight = (whole.column(i).to_numpy() for i in range(3))
        self.packed = np.where(label > 0, 1 + ONES, 1.0)
        self.ones = label > 0
        self.bins = bin_matrix(whole.column(5))
        self.columns = np.ascontiguousarray(self.bins.T)
        self.drawn: tuple[int, np.ndarray] | None = None

    def sample(self, number: int, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Rows that a tree sees, and how often."""
        # Four trees share the 64 bits of a draw.
        if self.drawn is None or self.drawn[0] != number // 4:
            self.drawn = number // 4, mixed(self.key, forest.seed, number // 4).view(np.uint16).reshape(-1, 4)
        times = POISSON[self.drawn[1][:, number % 4]]
        rows = np.flatnonzero(times)
        return rows, times[rows]

    def counts(self, rows: np.ndarray, times: np.ndarray, place: np.ndarray, chosen: np.ndarray, n_bins: int,
               weighted: bool) -> np.ndarray:
        """(2, node, feature, bin): weight of all rows and of those of class 1, by place of the node and its features."""
        if not weighted:
            packed = self._sums(rows, times * self.packed[rows], place, chosen, n_bins)
            ones = np.floor(packed / ONES)
            return np.stack((packed - ones * ONES, ones))
        weight = times * self.weight[rows]
        return np.stack([self._sums(rows, x, place, chosen, n_bins) for x in (weight, weight * self.ones[rows])])

    def _sums(self, rows: np.ndarray, weight: np.ndarray, place: np.ndarray, chosen: np.ndarray, n_bins: int
              ) -> np.ndarray:
        n_nodes, width = chosen.shape
        found = np.zeros((n_nodes, width, n_bins))
        small = np.dtype(np.uint16) if n_nodes <= 1 << 16 else place.dtype
        order = np.argsort(place.astype(small), kind="stable")
        rows, weight, place = rows[order], weight[order], place[order]
        ends = np.searchsorted(place, np.arange(n_nodes + 1))
        sizes = np.diff(ends)
        for i in np.flatnonzero(sizes >= FEW_ROWS).tolist():
            here, own = rows[ends[i]:ends[i + 1]], weight[ends[i]:ends[i + 1]]
            for j, feature in enumerate(chosen[i].tolist()):
                found[i, j] = np.bincount(self.columns[feature].take(here), own, n_bins)
        every = np.flatnonzero((sizes < FEW_ROWS)[place])
        for few in np.split(every, range(TOGETHER, len(every), TOGETHER)) if len(every) else ():
            # Rows are in the order of their nodes.
            at, first, last = place[few], place[few[0]], place[few[-1]] + 1
            cell = self.bins[rows[few, None], chosen[at]] + ((at[:, None] - first) * width + np.arange(width)) * n_bins
            size = (last - first) * width * n_bins
            found[first:last] += np.bincount(cell.ravel(), np.repeat(weight[few], width), size).reshape(-1, width, n_bins)
        return found


def choose(found: np.ndarray, chosen: np.ndarray, share: float) -> np.ndarray:
    """For each node (feature or -1, cut, gain, rows, share of class 1, rows and share left, rows and share right).

    The split with the largest gain, the first feature and bin on ties. ``share`` is that of a node without rows.
    """
    whole = found[:, :, 0].sum(axis=2)
    left = found.cumsum(axis=3)
    right = whole[:, :, None, None] - left

    def impurity(x: np.ndarray) -> np.ndarray:
        return 2 * x[1] * (x[0] - x[1]) / np.maximum(x[0], TINY)

    start = impurity(whole)
    gain = np.where((left[0] > 0) & (right[0] > 0), start[:, None, None] - impurity(left) - impurity(right), -np.inf)
    n = len(chosen)
    best = gain.reshape(n, -1).argmax(axis=1)
    feature, cut = np.divmod(best, found.shape[3])
    nodes = np.arange(n)
    most = gain[nodes, feature, cut]
    split = most > LEAST_GAIN * np.maximum(whole[0], TINY)
    sides = [side[:, nodes, feature, cut] for side in (left, right)]
    shares = [np.where(x[0] > 0, x[1] / np.maximum(x[0], TINY), share) for x in (whole, *sides)]
    return np.array([np.where(split, chosen[nodes, feature], -1), cut, np.where(split, most, 0), whole[0], shares[0],
                     sides[0][0], shares[1], sides[1][0], shares[2]])


# ---- growing -------------------------------------------------------------------------------

TREE = "tree int, feature binary, cut binary, left binary, value binary, gain binary, cover binary, path binary"


def whole_trees(table: DataFrame, forest: Forest, n_features: int, n_bins: int, share: float, weighted: bool,
                slices: int) -> list[Grown]:
    """A job of one task for each slice of the trees; its task reads the table and grows them."""

    def run(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[pa.RecordBatch]:
        part = Part([batch for batch in batches if batch.num_rows])
        for number in range(first, forest.trees, slices):
            tree = Grown.begin()
            rows, times = part.sample(number, forest)
            node = np.zeros(len(rows), np.int64)
            for _ in range(forest.depth):
                chosen = subsets(tree, number, forest, n_features)
                found = part.counts(rows, times, node - tree.open, chosen, n_bins, weighted)
                tree.extend(choose(found, chosen, share))
                node = down(tree, part.bins, rows, node)
                on = node >= 0
                rows, times, node = rows[on], times[on], node[on]
                if tree.open == len(tree.feature):
                    break
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *[pa.array([x], pa.binary()) for x in tree.packed()]],
                                             names=[f.split()[0] for f in TREE.split(", ")])

    def grown(first: int) -> list[tuple]:
        return table.coalesce(1).mapInArrow(lambda batches: run(batches, first), TREE).collect()

    made = in_parallel([lambda i=i: grown(i) for i in range(min(slices, forest.trees))], slices)
    return [Grown.of(row[1:]) for row in sorted(sum(made, []), key=lambda row: row["tree"])]


def trees_by_levels(table: DataFrame, forest: Forest, n_features: int, n_bins: int, share: float, weighted: bool
                    ) -> list[Grown]:
    """A job for each level of all trees."""
    trees = [Grown.begin() for _ in range(forest.trees)]
    most = max(1, PART_BYTES // (n_features + 40))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
        waiting, n = [], 0
        for batch in batches:
            if n and n + batch.num_rows > most:
                yield Part(waiting)
                waiting, n = [], 0
            waiting.append(batch)
            n += batch.num_rows
        if n:
            yield Part(waiting)

    for level in range(forest.depth):
        going = [i for i, tree in enumerate(trees) if tree.open < len(tree.feature)]
        if not going:
            break

        def count(batches: Iterator[pa.RecordBatch], level: int = level, going: list[int] = going
                  ) -> Iterator[pa.RecordBatch]:
            for part in chunks(batches):
                for number in going:
                    tree = trees[number]
                    rows, times = part.sample(number, forest)
                    node = np.zeros(len(rows), np.int64)
                    for _ in range(level):
                        node = down(tree, part.bins, rows, node)
                        on = node >= 0
                        rows, times, node = rows[on], times[on], node[on]
                    chosen = subsets(tree, number, forest, n_features)
                    found = part.counts(rows, times, node - tree.open, chosen, n_bins, weighted)
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([found.tobytes()], pa.binary())],
                                                     names=["tree", "data"])

        def add_up(rows: pa.Table) -> pa.Table:
            number = rows.column("tree")[0].as_py()
            chosen = subsets(trees[number], number, forest, n_features)
            found = sum(np.frombuffer(data.as_buffer(), "<f8") for data in rows.column("data"))
            splits = choose(found.reshape(2, *chosen.shape, n_bins), chosen, share)
            return pa.table({"tree": rows.column("tree")[:1], "data": pa.array([splits.tobytes()], pa.binary())})

        made = table.mapInArrow(count, "tree int, data binary").groupBy("tree").applyInArrow(
            add_up, "tree int, data binary").collect()
        for number, data in made:
            trees[number].extend(np.frombuffer(data, "<f8").reshape(9, -1))
    return trees


@dataclass(frozen=True)
class ForestModel:
    """Trees with the cuts of their features, as a model a ``Scorer`` can hold."""

    trees: list[Grown]
    cuts: list[list[float]]
    depth: int

    def probability(self, features: Column) -> Column:
        """Mean of the trees' shares of class 1, by batches of rows."""
        trees = [(x.feature, x.cut, x.left, x.value) for x in self.trees]
        cuts, depth = self.cuts, self.depth

        @F.pandas_udf(DoubleType())
        def score(values):
            if not len(values):
                return values.astype("float64")
            bins = binned(np.stack(values.to_numpy()), cuts)
            flat, start = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
            total = np.zeros(len(bins))
            for feature, cut, left, value in trees:
                # A leaf leads to itself.
                leaf = feature < 0
                step = np.where(leaf, np.arange(len(feature)), left)
                column, limit = np.where(leaf, 0, feature).astype(np.int64), np.where(leaf, 255, cut).astype(np.uint8)
                node = np.zeros(len(bins), np.int64)
                for _ in range(depth):
                    node = step.take(node) + (flat.take(start + column.take(node)) > limit.take(node))
                total += value[node]
            return type(values)(total / len(trees))

        return score(vector_to_array(features))

    def importances(self) -> np.ndarray:
        """Gain by feature: shares of each tree's, averaged over the trees that were split."""
        total = np.zeros(len(self.cuts))
        for tree in self.trees:
            on = tree.feature >= 0
            own = np.bincount(tree.feature[on], tree.gain[on], len(total))
            total += own / own.sum() if own.sum() > 0 else 0
        return total / total.sum() if total.sum() > 0 else total

    def splits(self) -> list[tuple[int, float]]:
        """(splits, mean gain a row) by feature."""
        on = [tree.feature >= 0 for tree in self.trees]
        feature = np.concatenate([tree.feature[x] for tree, x in zip(self.trees, on, strict=True)])
        gain = np.concatenate([tree.gain[x] / tree.cover[x] for tree, x in zip(self.trees, on, strict=True)])
        n = np.bincount(feature, minlength=len(self.cuts))
        mean = np.bincount(feature, gain, len(self.cuts)) / np.maximum(1, n)
        return list(zip(n.tolist(), mean.tolist(), strict=True))

    def settings(self) -> dict:
        return {"kind": "forest", "cuts": self.cuts, "depth": self.depth,
                "trees": [[base64.b64encode(x).decode() for x in tree.packed()] for tree in self.trees]}

    @staticmethod
    def of(settings: dict) -> ForestModel:
        trees = [Grown.of([base64.b64decode(x) for x in tree]) for tree in settings["trees"]]
        return ForestModel(trees, settings["cuts"], settings["depth"])


def fit_forest(rows: DataFrame, forest: Forest, weighted: bool = False, local: bool | None = None) -> ForestModel:
    """Grow a forest on ``rows`` with key (a long), label (0 or 1), weight and features (an array without nulls).

    ``local`` chooses how; by default the size of the table does, and the trees are the same.
    """
    if forest.depth > 30:
        raise ValueError("a tree has 30 levels at most")
    source = rows.select("key", "label", "weight", F.lit(False).alias("held"), "features")
    start = bin_rows(source, forest.bins, sorted_cuts)
    n_features, n_bins = len(start.cuts), max(map(len, start.cuts)) + 1
    share = float(1 / (1 + np.exp(-start.start)))
    spark = rows.sparkSession
    slices = spark.sparkContext.defaultParallelism
    if start.bytes <= WHOLE_BYTES if local is None else local:
        trees = whole_trees(start.table, forest, n_features, n_bins, share, weighted, slices)
    else:
        parts = max(slices, -(-start.bytes // PART_BYTES))
        trees = trees_by_levels(materialize(start.table.repartition(parts)), forest, n_features, n_bins, share, weighted)
    return ForestModel(trees, start.cuts, forest.depth)
