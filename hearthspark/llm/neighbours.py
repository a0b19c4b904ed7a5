"""Approximate nearest neighbours by largest inner product: probed lists scanned with an adaptive number of dimensions.

Largest inner product becomes smallest distance by one more dimension that
brings all vectors to the largest norm. Vectors are rotated at random and kept
in column blocks; after each block the partial distance is tested against what
a query still needs, and candidates that fail the test are abandoned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from hearthspark.llm.common import append, hashed_sample, tidy
from hearthspark.llm.storage import Stage

TOP = 20
# Vectors that centroids, probes and thresholds are fitted on, at most (chosen by a hash).
SAMPLE = 16384
# Lists: the square root of the number of vectors, at most this many.
MOST_LISTS = 4096
# Share of sampled neighbours that the probed lists must hold, and queries it is measured with.
PROBE_RECALL, PROBE_QUERIES = 0.98, 512
ROUNDS = 8
# Dimensions of a column block, and how many standard deviations too far a partial distance must be.
BLOCK_DIMS = 16
DEVIATIONS = 3.0
# Pairs are gathered one by one once this share of them is left; until then whole blocks are multiplied.
GATHER_SHARE = 0.05
# Vectors of a list, and queries of a chunk, compared in one go.
TILE = 1024
# Neighbouring lists are bundled, as a query travels once to each bundle it probes: to so many bundles of all vectors,
# of one ``TILE`` at least. A tile, what one row holds of a bundle, has at most so many vectors.
BUNDLES, MOST_BUNDLED = 32, 16384
EVERY = 20
# Queries compared with the sample in one go.
PROBE_CHUNK = 64
# Distinct vectors that a task gathers before it passes on their smallest ids.
GATHERED = 20_000


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_keys(vector: Column) -> list[Column]:
    """128 bits of hash of a vector."""
    return [F.xxhash64(vector).alias("k1"), F.xxhash64(F.lit(1), vector).alias("k2")]


def distinct_vectors(vectors: DataFrame, top: int) -> DataFrame:
    """k1, k2, vector, ids (its ``top`` + 1 smallest ids), asked (is one of its ids a query?).

    More copies of one vector can't be among ``top`` neighbours. Tasks pass on
    no more than that of each vector they gather, so a vector that a third of
    all rows hold comes to one row for each of their tasks.
    """
    most = top + 1
    rows = vectors.select(*vector_keys(F.col("vector")), "vector", F.array("vec_id").alias("ids"), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}

        def passed_on() -> pa.RecordBatch:
            columns = list(zip(*[(*key, *value) for key, value in found.items()], strict=True))
            made = pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.list_(pa.float32())), pa.array(columns[3], pa.list_(pa.int64())),
                 pa.array(columns[4], pa.bool_())], names=["k1", "k2", "vector", "ids", "asked"])
            found.clear()
            return made

        for batch in batches:
            k1, k2, ids, asked = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for i, key in enumerate(zip(k1, k2, strict=True)):
                known = found.get(key)
                if known is None:
                    found[key] = [batch.column(2)[i].values.to_numpy(zero_copy_only=False), ids[i], asked[i]]
                else:
                    known[1] = sorted(known[1] + ids[i])[:most]
                    known[2] = known[2] or asked[i]
            if len(found) > GATHERED:
                yield passed_on()
        if found:
            yield passed_on()

    return (rows.mapInArrow(tidy(run), rows.schema).groupBy("k1", "k2")
            .agg(F.first("vector").alias("vector"),
                 F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, most).alias("ids"),
                 F.max("asked").alias("asked")))


@dataclass
class Fitted:
    """What a bounded sample gives: norm, rotation, centroids, probes, and sample vectors for first thresholds."""

    norm2: float
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    sample: np.ndarray
    owners: np.ndarray
    top: int
    # The bundle of each list, and vectors of a tile of a bundle.
    bundles: np.ndarray | None = None
    tile: int = TILE

    def raised(self, vectors: np.ndarray) -> np.ndarray:
        """With the dimension that gives all vectors the same norm."""
        rest = np.sqrt(np.maximum(0.0, self.norm2 - np.einsum("ij,ij->i", vectors, vectors)))
        return np.concatenate((vectors, rest[:, None]), axis=1)

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        """Of queries, whose length does not matter, scaled to the same norm."""
        scale = np.sqrt(self.norm2 / np.einsum("ij,ij->i", vectors, vectors))
        return np.concatenate((vectors * scale[:, None], np.zeros((len(vectors), 1))), axis=1)

    def lists(self, vectors: np.ndarray) -> np.ndarray:
        return squared(self.raised(vectors), self.centroids).argmin(axis=1)

    def probed(self, vectors: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Of queries the lists to probe, nearest first, and a squared distance that enough of their vectors keep.

        Where the usual number of lists holds too few vectors of the sample,
        more are probed. The limit is that of twice as many sample vectors of
        the probed lists as are wanted, as a test may abandon some of them.
        """
        queries = self.asked(vectors)
        order = np.argsort(squared(queries, self.centroids), axis=1, kind="stable")
        enough = min(2 * (self.top + 1), len(self.sample))
        held = np.cumsum(np.bincount(self.owners, minlength=len(self.centroids))[order], axis=1)
        number = np.maximum(self.probes, (held < enough).sum(axis=1) + 1)
        limit = np.full(len(vectors), np.inf)
        for start in range(0, len(vectors) if enough > self.top + 1 else 0, PROBE_CHUNK):
            some = slice(start, start + PROBE_CHUNK)
            probed = np.zeros(order[some].shape, dtype=bool)
            np.put_along_axis(probed, order[some], np.arange(order.shape[1]) < number[some, None], axis=1)
            far = np.where(probed[:, self.owners], squared(queries[some], self.sample), np.inf)
            limit[some] = np.partition(far, enough - 1, axis=1)[:, enough - 1]
        # Rounding must not shut out the last of them.
        return [row[:n] for row, n in zip(order, number, strict=True)], limit * (1 + 1e-9) + 1e-9 * self.norm2


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and of ``b``."""
    return (np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)).clip(min=0)


def squared_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``squared`` as a single product, which rounding may leave a little below 0."""
    left = np.column_stack((-2 * a, np.einsum("ij,ij->i", a, a), np.ones(len(a))))
    right = np.column_stack((b, np.ones(len(b)), np.einsum("ij,ij->i", b, b)))
    return left @ right.T


def fit(distinct: DataFrame, dims: int, top: int, seed: int = 11) -> Fitted:
    """Centroids by k-means on a sample, and as many probes as the sample's own neighbours need."""
    row = distinct.agg(F.count("*").alias("n"), F.max(F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("norm2")).first()
    n, norm2 = row["n"], float(row["norm2"] or 1.0)
    drawn = hashed_sample(distinct, SAMPLE, n, "k2", "k1").select("vector").toArrow()
    sample = matrix(drawn.column(0).combine_chunks(), dims)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dims + 1, dims + 1)))[0]
    fitted = Fitted(norm2, rotation, np.zeros((1, dims + 1)), 1, sample, np.zeros(0, dtype=np.int64), top)
    if not len(sample):
        return fitted
    fitted.sample = raised = fitted.raised(sample)
    k = min(MOST_LISTS, len(sample), max(1, math.isqrt(n)))
    centroids = raised[rng.choice(len(raised), k, replace=False)]
    for _ in range(ROUNDS):
        own = squared(raised, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, raised)
        counts = np.bincount(own, minlength=k)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], centroids)
    fitted.centroids = centroids
    fitted.owners = own = squared(raised, centroids).argmin(axis=1)
    sizes = np.bincount(own, minlength=k) * (n / len(sample))
    fitted.tile = min(MOST_BUNDLED, max(TILE, n // BUNDLES))
    fitted.bundles = bundled(centroids, sizes, fitted.tile)
    queries = fitted.asked(sample[:PROBE_QUERIES])
    nearest = np.argsort(squared(queries, raised), axis=1)[:, :top + 1]
    rank = np.argsort(np.argsort(squared(queries, centroids), axis=1), axis=1)
    needed = np.take_along_axis(rank, own[nearest], axis=1).ravel()
    fitted.probes = int(np.quantile(needed, PROBE_RECALL, method="higher")) + 1
    return fitted


def bundled(centroids: np.ndarray, sizes: np.ndarray, most: float) -> np.ndarray:
    """The bundle of each list: halves of halves along the widest dimension until one holds ``most`` vectors or a list."""
    bundles, found, left = np.zeros(len(centroids), dtype=np.int32), 0, [np.arange(len(centroids))]
    while left:
        some = left.pop()
        if len(some) > 1 and sizes[some].sum() > most:
            widest = centroids[some].var(axis=0).argmax()
            some = some[np.argsort(centroids[some, widest], kind="stable")]
            left += [some[:len(some) // 2], some[len(some) // 2:]]
            continue
        bundles[some] = found
        found += 1
    return bundles


def by_bundle(lists: Sequence[np.ndarray], bundles: np.ndarray) -> pa.Array:
    """Of each query its bundles, and in each the lists to probe."""
    query = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    probed = np.concatenate([np.zeros(0, dtype=np.int64), *lists])
    own = bundles[probed]
    order = np.lexsort((probed, own, query))
    query, probed, own = query[order], probed[order], own[order]
    begins = np.nonzero(np.diff(query, prepend=-1) | np.diff(own, prepend=-1))[0]
    inner = pa.ListArray.from_arrays(pa.array([*begins, len(probed)], pa.int32()), pa.array(probed, pa.int32()))
    outer = np.searchsorted(query[begins], np.arange(len(lists) + 1))
    return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(own[begins], pa.int32()), inner], names=["bundle", "lists"]))


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def adaptive_scan(queries: np.ndarray, vectors: np.ndarray, limits: np.ndarray, block: int = BLOCK_DIMS,
                  deviations: float = DEVIATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs that may lie within the query's limit of squared distance.

    Both sides are rotated and lie in column blocks. After d of D dimensions a
    pair's partial distance, times D / d, estimates its distance. It is
    abandoned if the estimate exceeds the limit by more than ``deviations``
    standard deviations of such an estimate, sqrt(2/d (1 - d/D)) of itself.
    While many pairs are left, a block of all of them is one matrix product,
    far cheaper than gathering the pairs; the few left later are gathered.
    """
    dims = queries.shape[1]
    edges = [*range(0, dims, block), dims]
    if len(edges) > 2 and edges[-1] - edges[-2] < block // 2:
        del edges[-2]
    partial, alive = np.zeros((len(queries), len(vectors))), np.ones((len(queries), len(vectors)), dtype=bool)
    rows = cols = None
    for begin, seen in zip(edges, edges[1:], strict=False):
        q, x = queries[:, begin:seen], vectors[:, begin:seen]
        spread = math.sqrt(2 / seen * (1 - seen / dims))
        allowed = limits * (seen / dims) * (1 + deviations * spread) if seen < dims else limits
        if rows is None:
            partial += squared_product(q, x)
            alive &= partial <= allowed[:, None]
            if seen == dims or np.count_nonzero(alive) <= GATHER_SHARE * alive.size:
                rows, cols = np.nonzero(alive)
                partial = partial[rows, cols]
            continue
        partial = partial + np.square(q[rows] - x[cols]).sum(axis=1)
        kept = partial <= allowed[rows]
        rows, cols, partial = rows[kept], cols[kept], partial[kept]
    return rows, cols


FOUND = StructType([StructField(name, LongType()) for name in ("q1", "q2", "k1", "k2")]
                   + [StructField("score", DoubleType()), StructField("first", LongType()),
                      StructField("ids", ArrayType(LongType()))])


def scan_tiles(pairs: DataFrame, fitted: Fitted, dims: int, top: int) -> DataFrame:
    """For each query of each (tile, chunk) row the best ``top`` + 1 distinct vectors of its lists there, by exact score."""
    sent = pairs.sparkSession.sparkContext.broadcast((fitted.norm2, fitted.rotation))
    step = TILE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm2, rotation = sent.value
        shape = Fitted(norm2, rotation, np.zeros((0, 0)), 0, np.zeros((0, 0)), np.zeros(0), top)
        for batch in batches:
            for i in range(batch.num_rows):
                tile = batch.column(0)[i].values
                chunk = batch.column(1)[i].values
                vectors, queries = matrix(tile.field("vector"), dims), matrix(chunk.field("vector"), dims)
                limits = chunk.field("limit").to_numpy(zero_copy_only=False)
                turned, asked = shape.raised(vectors) @ rotation, shape.asked(queries) @ rotation
                lists, probed = tile.field("list").to_numpy(), chunk.field("lists")
                wanted = probed.flatten().to_numpy()
                wanting = np.repeat(np.arange(len(queries)), probed.value_lengths().to_numpy())
                found = []
                for one in np.unique(lists):
                    members, askers = np.nonzero(lists == one)[0], wanting[wanted == one]
                    for start in range(0, len(members) if len(askers) else 0, step):
                        some = members[start:start + step]
                        rows, cols = adaptive_scan(asked[askers], turned[some], limits[askers])
                        found.append((askers[rows], some[cols]))
                if not found:
                    continue
                rows, cols = (np.concatenate(x) for x in zip(*found, strict=True))
                score = np.einsum("ij,ij->i", queries[rows], vectors[cols])
                first = tile.field("first").to_numpy()[cols]
                order = np.lexsort((first, -score, rows))
                rows, cols, score = rows[order], cols[order], score[order]
                begins = np.searchsorted(rows, rows)
                best = np.arange(len(rows)) - begins <= top
                q, x = pa.array(rows[best]), pa.array(cols[best])
                yield pa.RecordBatch.from_arrays(
                    [chunk.field("k1").take(q), chunk.field("k2").take(q), tile.field("k1").take(x),
                     tile.field("k2").take(x), pa.array(score[best]), tile.field("first").take(x),
                     tile.field("ids").take(x)], names=FOUND.fieldNames())

    return pairs.mapInArrow(tidy(run), FOUND)


def nearest(embeddings: DataFrame, top: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``top`` nearest found of each query.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all
    rows but the query's own; nearness is the inner product of the vectors as
    given, in double precision, ties go to the smaller vec_id. A query with
    fewer candidates gets all. Rows with a null id, a null or zero vector, a
    null or non-finite component, or another number of components than most
    rows, take no part. Two rows with one id and different vectors are two
    candidates. Copies of a vector are searched for once; the probed lists are
    scanned whole, in tiles of their bundle, however large a list is.
    """
    ids = embeddings.select("vec_id", F.col("embedding").cast("array<float>").alias("vector"))
    valid = ids.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = valid.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "dims").first()
    dims = common["dims"] if common else 1
    valid = valid.where(F.size("vector") == dims).withColumn("asked", F.col("vec_id") % every == 0)
    distinct = Stage(distinct_vectors(valid, top), "vectors").df
    fitted = fit(distinct, dims, top)
    spark = embeddings.sparkSession
    sent = spark.sparkContext.broadcast(fitted)

    def place() -> Callable[[pa.Array], Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            own = sent.value.lists(matrix(column, dims))
            return pa.array(own.astype(np.int32)), pa.array(sent.value.bundles[own])

        return compute

    def probe() -> Callable[[pa.Array], Sequence[pa.Array]]:
        def compute(column: pa.Array) -> Sequence[pa.Array]:
            near, limit = sent.value.probed(matrix(column, dims))
            return by_bundle(near, sent.value.bundles), pa.array(limit, pa.float64())

        return compute

    listed = append(distinct, place, [StructField("list", IntegerType()), StructField("bundle", IntegerType())],
                    ["vector"]).withColumn("first", F.element_at("ids", 1))
    listed = Stage(listed, "listed").df
    # As many rows as bundles.
    tiles = listed.groupBy("bundle").agg(F.ceil(F.count("*") / fitted.tile).cast("int").alias("tiles"))
    tiled = (listed.join(tiles, "bundle").withColumn("tile", F.pmod(F.xxhash64("k2"), F.col("tiles").cast("long")))
             .groupBy("bundle", "tile")
             .agg(F.collect_list(F.struct("k1", "k2", "vector", "first", "ids", "list")).alias("rows")))
    probes = StructType([StructField("bundle", IntegerType()), StructField("lists", ArrayType(IntegerType()))])
    queries = append(distinct.where("asked").select("k1", "k2", "vector"), probe,
                     [StructField("bundles", ArrayType(probes)), StructField("limit", DoubleType())], ["vector"])
    # Written, as both the chunks of a bundle and their number are made from it.
    queries = Stage(queries, "asked").df
    spread = queries.select("k1", "k2", "vector", "limit", F.explode("bundles").alias("at")).select(
        "k1", "k2", "vector", "limit", "at.*")
    chunks = spread.groupBy("bundle").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))
    chunked = (spread.join(chunks, "bundle").withColumn("chunk", F.pmod(F.xxhash64("k2"), "chunks"))
               .groupBy("bundle", "chunk").agg(F.collect_list(F.struct("k1", "k2", "vector", "limit", "lists")).alias("asked"))
               .join(tiles, "bundle").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles").cast("long") - 1))))
    pairs = tiled.join(chunked, ["bundle", "tile"]).select("rows", "asked")
    found = scan_tiles(pairs, fitted, dims, top)
    best = found.groupBy("q1", "q2").agg(F.collect_list(F.struct(
        (-F.col("score")).alias("minus"), "first", "ids")).alias("found"))
    most = top + 1
    each = F.flatten(F.transform(F.slice(F.array_sort("found"), 1, most), lambda x: F.transform(
        x["ids"], lambda i: F.struct(x["minus"].alias("minus"), i.alias("vec_id")))))
    ranked = best.select(F.col("q1").alias("k1"), F.col("q2").alias("k2"), F.slice(F.array_sort(each), 1, most).alias("found"))
    asking = valid.where("asked").select(F.col("vec_id").alias("query_id"), *vector_keys(F.col("vector")))
    own = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, top)
    return (asking.join(ranked, ["k1", "k2"]).select("query_id", F.posexplode(own).alias("place", "x"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.minus")).alias("score")))
