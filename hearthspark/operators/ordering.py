"""Ranks, running totals and first rows without a single-task sort.

The order is cut into buckets, each bucket is worked on its own, and a small
table of bucket totals carries the running state from one bucket to the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthspark.functions.draws import AFTER_ALL, draw
from hearthspark.operators.joins import lookup, null_safe, settle
from hearthspark.session import materialize

# Sixteen to the power of this many buckets per group.
DRAW_DIGITS = 4
# Values, or rows, that one bucket holds about; there are FEW_BUCKETS at least.
BUCKET_ROWS = 1_000_000
FEW_BUCKETS = 64


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def first_row_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row of each key in the stated order, all columns kept.

    The ``== 1`` lets Spark keep one row per key in every map task before the
    shuffle, so a hot key sends one row per task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _before(by: Sequence[str], order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def bucket_digits(rows: int, least: int = 3) -> int:
    """Hexadecimal digits that make buckets of about BUCKET_ROWS rows."""
    digits = least
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def row_numbers(df: DataFrame, name: str, key: str | Sequence[str], by: Sequence[str] = (), seed: int = 42,
                digits: int | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """1, 2, 3, ... in each group, in the order of the hashed key, then of ``tie``.

    Rows are numbered inside (group, leading digits of the draw), which is
    evenly filled however large a group is; bucket totals give the offset. The
    number of digits follows the number of rows.
    """
    group = list(by)
    digits = digits or bucket_digits(df.count())
    marked = df.withColumn("_draw", draw(key, seed)).withColumn("_bucket", F.substring("_draw", 1, digits))
    totals = marked.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = totals.select(
        *group, "_bucket", F.coalesce(F.sum("_n").over(_before(group, "_bucket")), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_bucket").orderBy("_draw", *tie)
    ranked = marked.withColumn("_rank", F.row_number().over(inside))
    joined = lookup(ranked, offsets, [*group, "_bucket"])
    return joined.select(*df.columns, (F.col("_rank") + F.col("_offset")).cast("long").alias(name))


def segments(df: DataFrame, name: str, key: str | Sequence[str], cuts: Callable[[Column], Sequence[Column]],
             by: Sequence[str] = (), seed: int = 42, quotas: DataFrame | None = None,
             digits: int = DRAW_DIGITS) -> DataFrame:
    """Split each group at exact ranks of its hashed keys.

    ``cuts`` maps the group size to the ranks at which a new segment begins;
    ``name`` receives the segment number, from 0. ``quotas`` may carry further
    columns per group for ``cuts`` to use.

    The rows themselves are not shuffled or sorted. Bucket counts locate each
    cut, the few rows of that bucket give the exact digest at the cut, and the
    rows are compared with it. Rows that share a key stay in one segment.
    """
    group = list(by)
    drawn = df.select(*group, draw(key, seed).alias("_draw"), F.substring(draw(key, seed), 1, digits).alias("_bucket"))
    totals = drawn.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    placed = totals.withColumns({
        "_start": F.coalesce(F.sum("_n").over(_before(group, "_bucket")), F.lit(0)),
        "_size": F.sum("_n").over(Window.partitionBy(*group)),
    })
    if quotas is not None:
        placed = lookup(placed, quotas, group)
    ranks = [rank.cast("long") for rank in cuts(F.col("_size"))]
    listed = placed.select(*group, "_bucket", "_n", "_start", F.posexplode(F.array(*ranks)).alias("_cut", "_at"))
    inside = listed.filter("_start <= _at and _at < _start + _n").select(
        *group, "_bucket", "_cut", (F.col("_at") - F.col("_start")).alias("_at")
    )
    edge = lookup(drawn, inside, [*group, "_bucket"], "inner")
    per_draw = edge.groupBy(*group, "_bucket", "_cut", "_at", "_draw").agg(F.count(F.lit(1)).alias("_m"))
    reached = per_draw.withColumn(
        "_seen", F.coalesce(F.sum("_m").over(_before([*group, "_cut"], "_draw")), F.lit(0))
    ).filter("_seen <= _at and _at < _seen + _m")
    limits = reached.groupBy(*group).agg(
        *[F.max(F.when(F.col("_cut") == i, F.col("_draw"))).alias(f"_limit_{i}") for i in range(len(ranks))]
    )
    names = [f"_limit_{i}" for i in range(len(ranks))]
    if group:
        marked = lookup(df, limits, group)
        bounds = [F.coalesce(F.col(n), F.lit(AFTER_ALL)) for n in names]
    else:
        row = limits.first()
        marked, bounds = df, [F.lit(row[n] if row and row[n] is not None else AFTER_ALL) for n in names]
    number = F.lit(0)
    for bound in bounds:
        number = number + (draw(key, seed) >= bound).cast("int")
    return marked.withColumn(name, number).drop(*names)


def rank_among(cuts: Sequence[float], passed: Callable[[float], Column], start: int = 0) -> Column:
    """How many of the sorted ``cuts`` a row passes, by halving: a compiled decision tree."""
    if not cuts:
        return F.lit(start)
    middle = len(cuts) // 2
    upper = rank_among(cuts[middle + 1:], passed, start + middle + 1)
    return F.when(passed(cuts[middle]), upper).otherwise(rank_among(cuts[:middle], passed, start))


def running_totals(df: DataFrame, value: str, measures: Sequence[str], by: Sequence[str] = (),
                   buckets: int | None = None, written: bool = False) -> DataFrame:
    """Totals of ``measures`` over smaller values, as ``<measure>_before``.

    ``df`` holds one row per (group, value) and is written once, as it is read
    for the bucket edges, the bucket totals and the rows. Quantiles cut the values of each
    group into even buckets; buckets are summed in parallel and a table of
    bucket totals supplies what lies before each of them. Their number follows
    the number of values. ``written`` says that ``df`` already is a written
    table.
    """
    group = list(by)
    if not written:
        df = materialize(df)
    buckets = buckets or max(FEW_BUCKETS, -(-df.count() // BUCKET_ROWS))
    points = [i / buckets for i in range(1, buckets)]
    quantiles = F.percentile_approx(value, points, F.lit(16 * buckets)).alias("_edges")
    if group:
        edged = lookup(df, df.groupBy(*group).agg(quantiles), group)
        below = F.filter("_edges", lambda edge: edge < F.col(value))
        bucketed = edged.withColumn("_bucket", F.size(below)).drop("_edges")
    else:
        row = df.agg(quantiles).first()
        edges = sorted(set(row["_edges"] or []))
        bucketed = df.withColumn("_bucket", rank_among(edges, lambda edge: F.col(value) > F.lit(edge)))
    totals = bucketed.groupBy(*group, "_bucket").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    earlier = _before(group, "_bucket")
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_bucket").alias("_b"),
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_off_{m}") for m in measures],
    )
    small = settle(offsets)
    offsets = F.broadcast(small) if small is not None else offsets
    inside = _before([*group, "_bucket"], value)
    local = bucketed.withColumns({f"_in_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    same = null_safe([*group, "_bucket"], [*[f"_g_{g}" for g in group], "_b"])
    return local.join(offsets, same, "inner").select(
        *df.columns, *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"{m}_before") for m in measures]
    )
