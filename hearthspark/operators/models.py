"""Classifiers for household poverty: MLlib's, and forests, boosted trees, penalty paths and networks of this package.

A ``Scorer`` keeps everything a new table needs: columns, fill values, scale,
the fitted model and the cut-off. It is fitted once and saved as one folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthspark.operators.boosting import Boost, BoostedModel, Progress, Tree, fit_boosted
from hearthspark.operators.elastic import LogisticModel
from hearthspark.operators.encode import MISSING, fit_levels, fit_scale
from hearthspark.operators.forest import Forest, ForestModel, fit_forest
from hearthspark.operators.impute import apply_fill, fit_median
from hearthspark.operators.metrics import apply_cutoff
from hearthspark.operators.neural import Network, NeuralModel, fit_network
from hearthspark.operators.sampling import with_weights
from hearthspark.session import fresh_path, in_parallel  # noqa: F401
from hearthspark.sources.survey import LABEL

# Settings of the published runs.
FOREST_TREES = 500
ADVERSARIAL_TREES = 100
BOOST = {"depth": 6, "rate": 0.1, "rounds": 500, "row_share": 0.8, "column_share": 0.8}
PATIENCE = 10
PATIENT_ROUNDS = 1000
TUNED_BOOST = {"depth": 15, "rate": 0.08033620527180446, "rounds": 210, "row_share": 0.6432694972867776,
               "column_share": 0.5509301191523459}
# The second learner of the stack grows best-first to this many leaves, of so many rows and so much weight at least.
SECOND_LEARNER = {"leaves": 31, "min_rows": 20, "min_weight": 1e-3, "l2": 0.0}
HIDDEN_LAYERS = (128, 64, 32)
TUNED_HIDDEN_LAYERS = (256, 128, 32)
ELASTIC_ALPHA = 0.5

# Models of this package, which score by an expression and are saved with the settings.
OWN_MODELS = (BoostedModel, ForestModel, LogisticModel, NeuralModel)


@dataclass(frozen=True)
class Scorer:
    names: list[str]
    fills: dict[str, float]
    scale: dict[str, tuple[float, float]]
    model: Model | BoostedModel | ForestModel | LogisticModel | NeuralModel
    threshold: float = 0.5
    op: str = ">"
    label: str = LABEL
    # Categorical columns and the values each has a 0/1 input for; any other value gives zeros.
    levels: dict[str, list[str]] = field(default_factory=dict)

    @property
    def inputs(self) -> list[str]:
        """What the positions of the feature vector stand for."""
        return [*self.names, *[f"{name}_{value}" for name, values in self.levels.items() for value in values]]

    @property
    def columns(self) -> list[str]:
        return [*self.names, *self.levels]

    def features(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Align, fill and scale a table the way the training table was, as one vector column."""
        have = set(df.columns)

        def ready(name: str) -> Column:
            value = (F.col(name) if name in have else F.lit(None)).cast("double")
            if name in self.fills:
                value = F.coalesce(value, F.lit(float(self.fills[name])))
            mean, spread = self.scale.get(name, (0.0, 1.0))
            return (value - F.lit(mean)) / F.lit(spread or 1.0) if name in self.scale else value

        def hot(name: str, value: str) -> Column:
            return (category(F.col(name) if name in have else F.lit(None)) == F.lit(value)).cast("double")

        inputs = {f"_in_{name}": ready(name) for name in self.names}
        pairs = [(name, value) for name, values in self.levels.items() for value in values]
        inputs |= {f"_hot_{i}": hot(name, value) for i, (name, value) in enumerate(pairs)}
        wide = df.select(*keep, *[value.alias(alias) for alias, value in inputs.items()])
        return VectorAssembler(inputCols=list(inputs), outputCol="features").transform(wide).select(*keep, "features")

    def score(self, df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
        """``keep`` columns and ``score``: probability of the label, or the regression value."""
        if isinstance(self.model, OWN_MODELS):
            return self.features(df, keep).select(*keep, self.model.probability(F.col("features")).alias("score"))
        scored = self.model.transform(self.features(df, keep))
        probability = "probability" in scored.columns
        value = vector_to_array("probability")[1] if probability else F.col("prediction")
        return scored.select(*keep, value.alias("score"))

    def predict(self, df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
        return apply_cutoff(self.score(df, keep), self.threshold, op=self.op)

    def with_threshold(self, threshold: float, op: str = ">") -> Scorer:
        return replace(self, threshold=threshold, op=op)

    def save(self, spark: SparkSession, path: str) -> None:
        settings = {"names": self.names, "fills": self.fills, "scale": self.scale, "threshold": self.threshold,
                    "op": self.op, "label": self.label, "levels": self.levels}
        if isinstance(self.model, OWN_MODELS):
            settings["own"] = self.model.settings()
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        spark.createDataFrame([(json.dumps(settings),)], "settings string").write.mode("overwrite").parquet(
            f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scorer:
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        settings["scale"] = {name: tuple(pair) for name, pair in settings["scale"].items()}
        own = settings.pop("own", None)
        return Scorer(model=own_model(own) if own else PipelineModel.load(f"{path}/model").stages[0], **settings)


def own_model(settings: dict) -> BoostedModel | ForestModel | LogisticModel | NeuralModel:
    """A model of this package from what its ``settings`` gave."""
    kind = settings.pop("kind")
    if kind == "logistic":
        return LogisticModel(**settings)
    if kind == "neural":
        return NeuralModel.of(settings)
    if kind == "forest":
        return ForestModel.of(settings)
    return BoostedModel(**{**settings, "trees": [Tree(**tree) for tree in settings["trees"]]})


def category(value: Column) -> Column:
    """A categorical answer as text, a missing one as a value of its own."""
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def fit_inputs(train: DataFrame, names: Sequence[str], label: str = LABEL, impute: bool = False,
               scale: bool = True, threshold: float = 0.5, op: str = ">", categories: Sequence[str] = ()) -> Scorer:
    """Everything of a scorer but the model.

    ``impute`` adds exact medians for missing cells; ``categories`` are
    one-hot columns of the values in ``train``.
    """
    listed = list(names)
    fills = fit_median(train, listed) if impute else {}
    scales = fit_scale(apply_fill(train, fills), listed) if scale else {}
    texts = train.select(*[category(F.col(name)).alias(name) for name in categories])
    levels = {name: fit_levels(texts, name) for name in categories}
    return Scorer(listed, fills, scales, None, threshold, op, label, levels)


def training_rows(inputs: Scorer, df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(label as double, extra columns, features)."""
    rows = inputs.features(df, [inputs.label, *extra])
    return rows.withColumn(inputs.label, F.col(inputs.label).cast("double"))


def fit_scorer(train: DataFrame, estimator: Estimator | Forest, names: Sequence[str], label: str = LABEL,
               weights: DataFrame | None = None, extra: Sequence[str] = (), **inputs) -> Scorer:
    """Fit inputs and model on one table; ``extra`` columns reach the estimator as they are."""
    blank = fit_inputs(train, names, label, **inputs)
    weighted = train if weights is None else with_weights(train, weights, label)
    more = [*extra] if weights is None else [*extra, "weight"]
    if isinstance(estimator, Forest):
        more += ["id"] if "id" in train.columns and "id" not in (*more, label) else []
        return replace(blank, model=fit_forest_rows(training_rows(blank, weighted, more), estimator, label, weights is not None))
    chosen = estimator.copy({estimator.labelCol: label})
    if weights is not None:
        chosen.set(chosen.weightCol, "weight")
    return replace(blank, model=chosen.fit(training_rows(blank, weighted, more)))


def fit_forest_rows(rows: DataFrame, forest: Forest, label: str, weighted: bool = False) -> ForestModel:
    """A forest on rows with a vector of features. What tells rows apart decides which trees see them: all their columns."""
    numbers = rows.withColumn("features", vector_to_array("features"))
    known = F.col(label).cast("double")
    checked = F.when(known.isin(0.0, 1.0), known).otherwise(F.raise_error(F.lit(f"{label} is not 0 or 1 in a row")))
    return fit_forest(numbers.select(
        F.xxhash64(*numbers.columns).alias("key"), checked.cast("double").alias("label"),
        F.col("weight").cast("double") if weighted else F.lit(1.0).alias("weight"), "features"), forest, weighted)


def weighted_rows(inputs: Scorer, df: DataFrame, weights: DataFrame | None, held: DataFrame | None, key: str = "id"
                  ) -> DataFrame:
    """(key, label, weight, held, features as an array); ``held`` rows are watched only."""
    def rows(part: DataFrame, is_held: bool) -> DataFrame:
        weighted = part.withColumn("weight", F.lit(1.0)) if weights is None else with_weights(part, weights, inputs.label)
        return inputs.features(weighted, [key, inputs.label, "weight"]).select(
            F.xxhash64(key).alias("key"), F.col(inputs.label).cast("double").alias("label"),
            F.col("weight").cast("double"), F.lit(is_held).alias("held"), vector_to_array("features").alias("features"))

    return rows(df, False) if held is None else rows(df, False).unionByName(rows(held, True))


def fit_boosted_scorer(train: DataFrame, names: Sequence[str], boost: Boost, label: str = LABEL,
                       weights: DataFrame | None = None, held: DataFrame | None = None, key: str = "id",
                       local: bool | None = None, **inputs) -> tuple[Scorer, Progress]:
    """Inputs and boosted trees fitted on ``train``; patience watches ``held``."""
    blank = fit_inputs(train, names, label, **{"scale": False, **inputs})
    model, progress = fit_boosted(weighted_rows(blank, train, weights, held, key), boost, local)
    return replace(blank, model=model), progress


def fit_network_scorer(train: DataFrame, names: Sequence[str], network: Network, label: str = LABEL,
                       weights: DataFrame | None = None, held: DataFrame | None = None, key: str = "id", **inputs
                       ) -> tuple[Scorer, list[float]]:
    """Scaled inputs and a neural classifier fitted on ``train``; patience watches F1 on ``held``."""
    blank = fit_inputs(train, names, label, **inputs)
    model, scores = fit_network(weighted_rows(blank, train, weights, held, key), network)
    return replace(blank, model=model), scores


# ---- estimators -----------------------------------------------------------------

def forest(trees: int = FOREST_TREES, depth: int = 10, seed: int = 42) -> Forest:
    return Forest(trees, depth, seed=seed)


def boosted(depth: int = 6, rate: float = 0.1, rounds: int = 500, row_share: float = 0.8, column_share: float = 0.8,
            min_rows: int = 1, seed: int = 42, **more) -> GBTClassifier:
    return GBTClassifier(maxDepth=depth, stepSize=rate, maxIter=rounds, subsamplingRate=row_share,
                         featureSubsetStrategy=str(column_share), minInstancesPerNode=min_rows, seed=seed,
                         maxMemoryInMB=1024, **more)


def elastic_logistic(alpha: float = ELASTIC_ALPHA, penalty: float = 0.0, rounds: int = 100) -> LogisticRegression:
    return LogisticRegression(elasticNetParam=alpha, regParam=penalty, maxIter=rounds, standardization=True)


def elastic_linear(alpha: float = ELASTIC_ALPHA, penalty: float = 0.0) -> LinearRegression:
    return LinearRegression(elasticNetParam=alpha, regParam=penalty, standardization=True)


def perceptron(n_features: int, hidden: Sequence[int] = HIDDEN_LAYERS, rounds: int = 100,
               seed: int = 42) -> MultilayerPerceptronClassifier:
    """No class weight exists here: balance the rows first."""
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], maxIter=rounds, seed=seed, blockSize=128)


# ---- around the models -------------------------------------------------------------

def feature_importance(scorer: Scorer, spark: SparkSession) -> DataFrame:
    """(feature, importance), highest first, name as tie-break."""
    own = isinstance(scorer.model, ForestModel)
    values = scorer.model.importances() if own else scorer.model.featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(scorer.inputs, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def split_importance(scorer: Scorer, spark: SparkSession) -> DataFrame:
    """(feature, splits, total_gain, mean_gain, total_cover) over all nodes of all trees, most splits first.

    Features never split on are included. The gains are those the trees were
    grown by, kept with the nodes. Of a forest come (feature, splits,
    mean_gain), of an MLlib model from the node table that saving it writes.
    """
    if isinstance(scorer.model, ForestModel):
        rows = [(name, *pair) for name, pair in zip(scorer.inputs, scorer.model.splits(), strict=True)]
        return spark.createDataFrame(rows, "feature string, splits long, mean_gain double").orderBy(F.desc("splits"), "feature")
    if not isinstance(scorer.model, BoostedModel):
        return _mllib_splits(scorer, spark)
    return spark.createDataFrame(
        scorer.model.importance(scorer.inputs),
        "feature string, splits long, total_gain double, mean_gain double, total_cover double",
    ).orderBy(F.desc("splits"), "feature")


def _mllib_splits(scorer: Scorer, spark: SparkSession) -> DataFrame:
    path = fresh_path(spark, "nodes")
    scorer.model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*").filter("leftChild >= 0")
    per_feature = nodes.groupBy(F.col("split.featureIndex").alias("position")).agg(
        F.count(F.lit(1)).alias("splits"), F.avg("gain").alias("mean_gain"))
    names = spark.createDataFrame(list(enumerate(scorer.inputs)), "position int, feature string")
    return names.join(per_feature, "position", "left").select(
        "feature", F.coalesce("splits", F.lit(0).cast("long")).alias("splits"),
        F.coalesce("mean_gain", F.lit(0.0)).alias("mean_gain")).orderBy(F.desc("splits"), "feature")
