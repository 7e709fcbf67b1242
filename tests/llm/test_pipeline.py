"""The pipeline against brute force, and every thin query against its SQL."""

from __future__ import annotations

import pyarrow as pa
import pytest

import check
import corpus_pipeline
from tests.conftest import SMALL
from tracklake.llm.common import stored
from tracklake.llm.oracle import ORACLE
from tracklake.llm.queries import QUERIES

from .helpers import no_documents, odd_documents
from .test_decontaminate import brute
from .test_similar import kept_ids


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_parity(spark, name):
    assert check.compare(spark, check.duck(SMALL), SMALL, name).startswith("ok")


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    predicted = {r["doc_id"]: r["predicted"] for r in QUERIES["op10_quality"](spark, SMALL).collect()}
    good = stored(stages["quality"](spark, docs, SMALL), "t")
    assert {r["doc_id"] for r in good.collect()} == {k for k, p in predicted.items() if p}
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    single = stored(stages["near_duplicates"](spark, good, SMALL), "t")
    assert sorted(r["doc_id"] for r in single.collect()) == kept_ids(rows)
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    clean = stored(stages["decontamination"](spark, single, SMALL), "t")
    assert {r["doc_id"] for r in clean.collect()} == {d for d, *_, bad in brute(rows, items) if not bad}
    private = stored(stages["privacy"](spark, clean, SMALL), "t")
    assert private.columns == docs.columns and private.count() == clean.count()
    packed = stages["packing"](spark, private, SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in clean.collect()}
    assert corpus_pipeline.run(spark, SMALL).count() == packed.count()


def test_stages_bear_odd_rows_and_empty_tables(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, SMALL), "odd")
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
        assert out.count() >= 0


def test_workers_get_a_few_megabytes_of_long_texts_at_once(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat('long text ', 1000) AS text")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        dict(corpus_pipeline.STAGES)["packing"](spark, docs, SMALL)
        assert max(r["n"] for r in docs.mapInArrow(sizes, "n bigint").collect()) < 5_000_000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
