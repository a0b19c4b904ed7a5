from __future__ import annotations

import zlib

import numpy as np

from hearthspark.llm import quality, queries
from tests.llm.data import SMALL, documents, given


def test_held_out_accuracy(spark):
    known = {r["doc_id"]: r["quality"] for r in given(spark, "labels").collect()}
    rows = queries.op6_quality_classifier(spark, SMALL).collect()
    assert len(rows) == given(spark, "documents").count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
    tested = [row for row in rows if row["held_out"] and row["doc_id"] in known]
    right = np.mean([row["predicted"] == known[row["doc_id"]] for row in tested])
    assert right > np.mean([known[row["doc_id"]] for row in tested]) and right >= 0.9


def test_gradient():
    rng = np.random.default_rng(0)
    owner = np.array([0, 0, 1, 2, 2, 2])
    first, label = np.array([0, 2, 3]), np.array([1.0, 0.0, 0.5])
    x = rng.normal(size=(6, quality.FEATURES))
    model = quality.train(x, owner, label, rounds=1)
    w, x = model.weights, (x - model.mean) / model.scale

    def loss(weights):
        out, _ = quality.forward(weights, x, owner, first)
        return float(np.mean(np.log1p(np.exp(out)) - label * out))

    for name, g in quality.gradient(w, x, owner, first, label).items():
        for place in list(np.ndindex(g.shape))[:: max(1, g.size // 5)]:
            up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
            up[name][place] += 1e-6
            down[name][place] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - g[place]) < 1e-6


def test_passages_cover_whole_texts():
    texts = [b"", b" \n ", b"one", b"word " * 64, b"word " * 65, b"word " * 100_000, "é ".encode() * 70]
    table, owner = quality.passages(texts)
    assert np.bincount(owner).tolist() == [1, 1, 1, 1, 2, 32, 2]
    words = np.exp(table[:, len(quality.CLASS_NAMES)])
    by_doc = np.bincount(owner, weights=words)
    assert np.allclose(by_doc[2:], [1, 64, 65, 100_000, 70])
    assert np.isfinite(table).all()


def test_table_cases(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "some text"), (3, "some text"), (None, "some text")], clash="predicted")
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (1, None)], "doc_id long, quality int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == 5 and len({r["score"] for r in rows if r["doc_id"] in (3, None)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert quality.score_quality(docs, labels.limit(0)).count() == 5
    assert quality.score_quality(docs.limit(0), labels).count() == 0
