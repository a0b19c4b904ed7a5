from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from hearthspark.llm import neighbours, queries
from tests.llm.data import SMALL, given

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(ids, vectors, top=20, every=20):
    """{query: [(id, score)]} by brute force in double precision."""
    found = {}
    x = np.asarray(vectors, dtype=np.float32).astype(np.float64)
    for i in range(len(ids)):
        if ids[i] % every == 0:
            scores = x @ x[i]
            others = sorted((-scores[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[i])
            found[ids[i]] = [(j, -s) for s, j in others[:top]]
    return found


def answers(df):
    found: dict[int, list] = {}
    for row in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(found[row["query_id"]])
    return found


def test_recall_on_the_given_vectors(spark):
    rows = given(spark, "embeddings").collect()
    expected = exact([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    found = answers(queries.op10_nearest_neighbours(spark, SMALL))
    assert found.keys() == expected.keys() and all(len(x) == 20 for x in found.values())
    near = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected]
    assert np.mean(near) / 20 >= 0.9
    scores = {(q, i): s for q, x in exact([r["vec_id"] for r in rows], [r["embedding"] for r in rows], 10_000).items()
              for i, s in x}
    for q, x in found.items():
        assert [s for _, s in x] == pytest.approx([scores[q, i] for i, _ in x], abs=1e-12)
        assert x == sorted(x, key=lambda e: (-e[1], e[0]))


def test_clusters_of_different_norms(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(30, 16)) * 3
    vectors = np.concatenate([c + rng.normal(size=(40, 16)) * 0.2 for c in centers]).astype(np.float32)
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, vectors, strict=True)], SCHEMA)
    expected, found = exact(ids, vectors), answers(neighbours.nearest(df))
    near = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected]
    assert np.mean(near) / 20 >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 1.0], 1), (3, None, 1),
            (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 2.0, 3.0], 1),
            (None, [1.0, 1.0], 1), (40, None, 1), (9, [], 1), (60, [-1.0, -1.0], None)]
    found = answers(neighbours.nearest(spark.createDataFrame(rows, SCHEMA)))
    assert found == {
        0: [(1, 2.0), (2, 1.0), (20, 0.0), (60, -1.0)], 20: [(2, 1.0), (0, 0.0), (1, 0.0), (60, -1.0)],
        60: [(0, -1.0), (20, -1.0), (1, -2.0), (2, -2.0)]}
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_many_copies(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(3000)] + [(10_000 + i, [0.6, 0.8], 0) for i in range(41)]
    found = answers(neighbours.nearest(spark.createDataFrame(rows, SCHEMA).repartition(6)))
    assert len(found) == 150 + 3
    assert [i for i, _ in found[0]] == list(range(1, 21)) and [i for i, _ in found[20]] == [*range(20)]
    assert [i for i, _ in found[40]] == list(range(20))
    assert [i for i, _ in found[10_000]] == list(range(10_001, 10_021))


def test_tiles_of_large_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", 7)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(400, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA)
    found, expected = answers(neighbours.nearest(df)), exact(list(range(400)), vectors)
    near = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected]
    assert np.mean(near) / 20 >= 0.9 and all(len(x) == 20 for x in found.values())


def test_scan_without_a_limit_keeps_all_pairs():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(5, 40)), rng.normal(size=(9, 40))
    rows, cols = neighbours.adaptive_scan(a, b, np.full(5, np.inf))
    assert len(rows) == 45
    limits = np.sort(neighbours.squared(a, b), axis=1)[:, 2]
    rows, cols = neighbours.adaptive_scan(a, b, limits * (1 + 1e-12), deviations=50)
    assert np.bincount(rows, minlength=5).tolist() == [3] * 5


def test_pairs_are_not_gathered_while_most_are_left():
    rng = np.random.default_rng(5)
    a, b = (v / np.linalg.norm(v, axis=1)[:, None] for v in (rng.normal(size=(300, 64)), rng.normal(size=(500, 64))))
    far = neighbours.squared(a, b)
    limits = np.sort(far, axis=1)[:, 9] * (1 + 1e-9)
    tracemalloc.start()
    rows, cols = neighbours.adaptive_scan(a, b, limits)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Two blocks of partial distances, and flags; gathered dimensions take a multiple of it.
    assert peak < 40 * len(a) * len(b)
    # What is left is what a test of each pair on its own leaves.
    left = np.ones(far.shape, dtype=bool)
    for seen in (16, 32, 48):
        spread = np.sqrt(2 / seen * (1 - seen / 64))
        left &= neighbours.squared(a[:, :seen], b[:, :seen]) <= (limits * seen / 64 * (1 + 3 * spread))[:, None]
    left &= far <= limits[:, None]
    assert sorted(zip(rows, cols, strict=True)) == sorted(zip(*np.nonzero(left), strict=True))


def test_limits_of_probed_lists():
    rng = np.random.default_rng(6)
    sample, asked = rng.normal(size=(400, 6)), rng.normal(size=(150, 6))
    norm2 = float((sample * sample).sum(axis=1).max())
    fitted = neighbours.Fitted(norm2, np.eye(7), np.zeros((0, 7)), 3, sample, np.zeros(0), 4)
    fitted.sample = fitted.raised(sample)
    fitted.centroids = fitted.sample[:25]
    fitted.owners = fitted.lists(sample)
    lists, limits = fitted.probed(asked)
    far = neighbours.squared(fitted.asked(asked), fitted.sample)
    for i in range(len(asked)):
        held = np.sort(far[i, np.isin(fitted.owners, lists[i])])
        assert len(held) >= 10 and limits[i] == pytest.approx(held[9], rel=1e-6)


def test_queries_are_probed_once(spark):
    found = neighbours.nearest(given(spark, "embeddings"))
    # The scan of the tiles is left; chunks of queries and their number come from what is written.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_queries_travel_once_to_each_bundle_of_lists(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(4000, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), i % 20 == 0) for i, v in enumerate(vectors)],
                               "vec_id long, vector array<float>, asked boolean")
    fitted = neighbours.fit(neighbours.distinct_vectors(df, 20), 16, 20)
    assert len(fitted.centroids) == 63 and len(np.unique(fitted.bundles)) <= 8
    lists, _ = fitted.probed(vectors[:50].astype(np.float64))
    assert np.mean([len(x) for x in lists]) > 16
    sent = neighbours.by_bundle(lists, fitted.bundles).to_pylist()
    for row, probed in zip(sent, lists, strict=True):
        assert len({x["bundle"] for x in row}) == len(row) <= 8
        assert sorted(i for x in row for i in x["lists"]) == sorted(probed)
        assert all(fitted.bundles[i] == x["bundle"] for x in row for i in x["lists"])
    assert neighbours.by_bundle([], fitted.bundles).to_pylist() == []


def test_bundles_hold_no_more_than_a_tile_or_a_list():
    rng = np.random.default_rng(8)
    centroids, sizes = rng.normal(size=(50, 5)), rng.integers(0, 40, 50).astype(float)
    sizes[3] = 500
    bundles = neighbours.bundled(centroids, sizes, 100)
    assert sorted(set(bundles)) == list(range(bundles.max() + 1))
    for i in range(bundles.max() + 1):
        assert sizes[bundles == i].sum() <= 100 or (bundles == i).sum() == 1
    assert neighbours.bundled(np.zeros((40, 2)), np.full(40, 9.0), 100).max() < 8
