from __future__ import annotations

import zlib

import numpy as np

from tests.conftest import SMALL
from tracklake.llm import quality
from tracklake.llm.queries import QUERIES

from .helpers import no_documents, odd_documents

LARGER = SMALL.replace("0.001", "0.01")


def walk(model, row):
    """A tree at a time, node by node."""
    total = model.base
    for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
        node = 0
        for _ in range(model.depth):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += value[node - 2**model.depth + 1]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_equal_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = quality.train(x, y, trees=20)
    assert np.allclose(model.score(x), [walk(model, row) for row in x])
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.97


def test_degenerate_training():
    assert quality.train(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (quality.train(np.ones((50, 3)), np.ones(50)).score(np.ones((2, 3))) > 0.9).all()


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = QUERIES["op10_quality"](spark, LARGER).collect()
    assert len(rows) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in tested]) > 0.95


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit_quality(odd_documents(spark), labels)
    scored = quality.score_quality(odd_documents(spark), model)
    assert scored.count() == 10 and scored.where("score BETWEEN 0 AND 1").count() == 10
    empty = quality.fit_quality(no_documents(spark), labels)
    assert quality.score_quality(no_documents(spark), empty).count() == 0
