"""A corpus pipeline over ``documents``: quality, near-duplicates, decontamination, privacy, packing.

Every stage takes (spark, docs, sf_dir). All but the last return rows with the columns of ``docs``; each result is
written and read again as the next stage's input. Texts travel to Python workers in batches of bounded bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm import decontaminate, packing, privacy, quality, similar
from tracklake.llm.common import fresh, read, small_batches, stored
from tracklake.llm.queries import privacy_key, tokenizer_files

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """A stage whose Python workers hold a few MB of texts at once; by default a batch has up to 64 MB of them."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@bounded
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go; it learns from the labels outside the held-out fifth."""
    labels = read(spark, sf_dir, "labels").where(~quality.held_out("doc_id"))
    model = quality.fit_quality(docs, labels)
    score, predicted = fresh(docs.columns, "score"), fresh(docs.columns, "predicted")
    scored = quality.score_quality(docs, model, score_col=score, predicted_col=predicted)
    return scored.where(F.col(predicted) == 1).drop(score, predicted)


@bounded
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8) stays: the one with the smallest id."""
    return similar.deduplicate(docs)


@bounded
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    judged = decontaminate.decontaminate(docs.drop(*decontaminate.ADDED), read(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*docs.columns)


@bounded
def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; ``n_chars`` follows the new text."""
    replaced = privacy.pseudonymise(docs, privacy_key(spark))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        replaced = replaced.withColumn("n_chars", F.when(F.col("n_entities") > 0, length).otherwise(F.col("n_chars")))
    return replaced.select(*docs.columns)


@bounded
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    return packing.pack(docs, *tokenizer_files())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("privacy", privacy_stage),
    ("packing", packing_stage),
]

#: Trees, fuzzy hashing, surrogates and tokens are beyond SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
