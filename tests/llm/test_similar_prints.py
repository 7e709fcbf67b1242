"""The near-duplicate stage looks by fingerprints and Golay keys first, and by bands for what these miss."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tracklake.llm import similar

from .test_similar import kept_ids


def near(texts):
    return [(k, t) for k, t in enumerate(texts)]


def stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SMALL).collect())


LONG = [f"w{k}" for k in range(600)]


def test_golay_keys_find_what_bands_would_not_be_asked_for(spark, monkeypatch):
    monkeypatch.setattr(similar, "band_keys", lambda hashes: [])
    rows = near([" ".join(LONG), " ".join([*LONG, "one"]), " ".join([*LONG, "two"]), "quite another text of some words"])
    assert stage(spark, rows) == kept_ids(rows) == [0, 3]


@pytest.mark.parametrize("changed", [0, 1, 12, 30])
def test_pairs_beyond_three_bits_are_found_too(spark, changed):
    other = list(LONG)
    for k in range(changed):
        other[10 + k * 19] = f"x{k}"
    rows = near([" ".join(LONG), " ".join(other)])
    assert stage(spark, rows) == kept_ids(rows)
