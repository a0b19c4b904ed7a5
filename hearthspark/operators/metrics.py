"""Exact evaluation of scores and predictions.

Scores are counted per distinct value before anything is ordered, so the work
after the first shuffle depends on distinct scores, not on rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthspark.functions.nulls import or_zero, safe_ratio
from hearthspark.operators.ordering import rank_among, running_totals
from hearthspark.session import materialize

# Fixed value: keeps the F1 of the curve defined where precision and recall are both 0.
CURVE_EPSILON = 1e-8


def apply_cutoff(df: DataFrame, threshold: float, score: str = "score", name: str = "prediction",
                 op: str = ">") -> DataFrame:
    value, limit = F.col(score), F.lit(threshold)
    tests = {">": value > limit, ">=": value >= limit, "<=": value <= limit, "<": value < limit}
    return df.withColumn(name, F.when(tests[op], F.lit(1)).otherwise(F.lit(0)))


def cutoffs(start: int, stop: int, scale: int = 100) -> list[float]:
    """start/scale .. stop/scale, both ends included, from whole numbers."""
    return [i / scale for i in range(start, stop + 1)]


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     labels: Sequence[int] = (0, 1)) -> DataFrame:
    """(actual, predicted, n) for every pair of labels, empty pairs included."""
    cells = [(a, p) for a in labels for p in labels]
    row = df.agg(*[
        F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"n_{i}") for i, (a, p) in enumerate(cells)
    ])
    entries = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n_{i}").alias("n"))
        for i, (a, p) in enumerate(cells)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def precision_recall_f1(hits: Column, predicted: Column, actual: Column,
                        undefined: float | None = 0.0) -> tuple[Column, Column, Column]:
    """From counts; ``undefined`` stands where a denominator is zero."""
    precision = F.coalesce(safe_ratio(hits, predicted), F.lit(undefined).cast("double"))
    recall = F.coalesce(safe_ratio(hits, actual), F.lit(undefined).cast("double"))
    f1 = F.coalesce(F.try_divide(precision * recall * 2, precision + recall), F.lit(undefined).cast("double"))
    return precision, recall, f1


def scores(df: DataFrame, positive: object, label: str = "label", prediction: str = "prediction",
           undefined: float | None = 0.0, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of the class named by ``positive``, per group if asked."""
    counts = df.groupBy(*by).agg(
        F.count_if((F.col(label) == positive) & (F.col(prediction) == positive)).alias("hits"),
        F.count_if(F.col(prediction) == positive).alias("predicted"),
        F.count_if(F.col(label) == positive).alias("actual"),
    )
    precision, recall, f1 = precision_recall_f1(F.col("hits"), F.col("predicted"), F.col("actual"), undefined)
    return counts.select(*by, precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy and both averages."""
    pairs = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(F.lit(0))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col(label).cast("string").alias("class"), hit.alias("hits"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col(prediction).cast("string").alias("class"), F.lit(0).cast("long").alias("hits"),
                 F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )).alias("e")).select("e.*")
    per_class = sides.groupBy("class").agg(F.sum("hits").alias("hits"), F.sum("support").alias("support"),
                                           F.sum("predicted").alias("predicted"))
    precision, recall, f1 = precision_recall_f1(F.col("hits"), F.col("predicted"), F.col("support"))
    classes = per_class.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                               "support", "hits")
    weighted = {
        m: F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support").cast("double"))
        for m in ("precision", "recall", "f1")
    }
    averages = classes.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in weighted], *[v.alias(f"weighted_{m}") for m, v in weighted.items()],
        safe_ratio(F.sum("hits"), F.sum("support")).alias("accuracy"), F.sum("support").alias("total"),
    )
    none = F.lit(None).cast("double")
    rows = [("accuracy", (none, none, F.col("accuracy")))] + [
        (f"{kind} avg", tuple(F.col(f"{kind}_{m}") for m in weighted)) for kind in ("macro", "weighted")
    ]
    extra = averages.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                 F.col("total").alias("support"))
        for name, (p, r, f) in rows
    ])).alias("e")).select("e.*")
    return classes.drop("hits").unionByName(extra)


def score_counts(df: DataFrame, label: str = "label", score: str = "score", positive: object = 1,
                 by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; rows without label or score leave."""
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == positive).alias("pos"), F.count_if(F.col(label) != positive).alias("neg")
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", positive: object = 1,
            either_direction: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half, per group if asked.

    ``either_direction`` reports the better of the score and its negative.
    """
    ordered = running_totals(score_counts(df, label, score, positive, by), "score", ["neg"], by=by)
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
    area = F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg").cast("double"))
    result = ordered.groupBy(*by).agg(area.alias("auc"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return result.withColumn("auc", F.greatest("auc", F.lit(1.0) - F.col("auc"))) if either_direction else result


def threshold_table(df: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "score",
                    positive: object = 1, op: str = ">") -> DataFrame:
    """Precision, recall and F1 at each cut-off, from one grouped pass.

    Each row falls into the interval between two cut-offs; counts per interval
    (at most one more than there are cut-offs) are then summed from above.
    """
    cuts = sorted(set(thresholds))
    passed = {">": lambda t: F.col(score) > t, ">=": lambda t: F.col(score) >= t}[op]
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = known.groupBy(rank_among(cuts, passed).alias("reached")).agg(
        F.count_if(F.col(label) == positive).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    intervals = counts.agg(F.collect_list(F.struct("reached", "pos", "n")).alias("_intervals"))
    points = intervals.select("_intervals", F.posexplode(F.array(*[F.lit(t) for t in cuts])).alias("_i", "threshold"))

    def above(field: str, from_rank: Column) -> Column:
        return F.aggregate("_intervals", F.lit(0).cast("long"), lambda total, e: total + F.when(
            e["reached"] >= from_rank, e[field]).otherwise(F.lit(0)))

    points = points.select("threshold", above("pos", F.lit(0)).alias("actual"),
                           above("pos", F.col("_i") + 1).alias("hits"), above("n", F.col("_i") + 1).alias("predicted"))
    precision, recall, f1 = precision_recall_f1(F.col("hits"), F.col("predicted"), F.col("actual"))
    return points.select("threshold", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def best_threshold(table: DataFrame, digits: int | None = None) -> DataFrame:
    """The row with the highest F1; the lowest cut-off on ties."""
    f1 = F.col("f1") if digits is None else F.round("f1", digits)
    best = F.min_by(F.struct(*table.columns), F.struct(-f1, F.col("threshold"))).alias("best")
    return table.agg(best).select("best.*")


def precision_recall_curve(df: DataFrame, label: str = "label", score: str = "score",
                           positive: object = 1) -> DataFrame:
    """(threshold, precision, recall, f1) with every distinct score as ``>=`` cut-off."""
    counts = materialize(score_counts(df, label, score, positive))
    ordered = running_totals(counts, "score", ["pos", "neg"], written=True)
    totals = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    positives, negatives = F.lit(totals["pos"] or 0), F.lit(totals["neg"] or 0)
    hits = positives - F.col("pos_before")
    predicted = hits + negatives - F.col("neg_before")
    points = ordered.select(
        F.col("score").alias("threshold"),
        or_zero(safe_ratio(hits, predicted)).alias("precision"),
        or_zero(safe_ratio(hits, positives)).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return points.withColumn("f1", F.lit(2.0) * p * r / (p + r + F.lit(CURVE_EPSILON)))


def fold_summary(per_fold: DataFrame, metrics: Sequence[str], fold: str = "fold") -> DataFrame:
    """Per-fold metrics and a last row with their means."""
    rows = per_fold.select(F.col(fold).cast("string").alias(fold), *metrics)
    means = rows.agg(*[F.avg(m).alias(m) for m in metrics]).select(F.lit("mean").alias(fold), *metrics)
    return rows.unionByName(means)
