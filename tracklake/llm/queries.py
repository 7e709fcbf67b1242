"""The thin queries over the operators; their contracts fix the columns they return."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm import (
    decontaminate,
    html_text,
    language,
    lexical,
    packing,
    privacy,
    quality,
    simhash,
    spelling,
    substrings,
    suffixes,
    urlfilter,
    vectors,
)
from tracklake.llm.common import read

SITE_RULES = (
    urlfilter.site_rule("allow", "org", "/"),
    urlfilter.site_rule("block", "example.org", "/es/"),
    urlfilter.site_rule("block", "example.org", "/en/1"),
    urlfilter.site_rule("allow", "com", "/fr/"),
    urlfilter.site_rule("block", "com", "/de/"),
)


def tokenizer_files() -> tuple[bytes, str, dict[str, int]]:
    """Ranks, split pattern and added tokens of the public 50k byte-level vocabulary; the installed package knows their place."""
    import public_tokenizers

    listed = json.loads(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"))["added_tokens"]
    ranks = Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()
    return ranks, public_tokenizers.PATTERN, {t["content"]: t["id"] for t in listed}


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 1024."""
    pieces = packing.pack(read(spark, sf_dir, "documents"), *tokenizer_files())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return vectors.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the site rules, else by the default rules."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    judged = urlfilter.filter_urls(pages, SITE_RULES + urlfilter.DEFAULT_RULES)
    rule = F.when(F.col("tier") == 0, F.col("rule"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), "verdict")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", "n_chars")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 35-word windows that occur more than once."""
    found = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def privacy_key(spark: SparkSession) -> bytes:
    """The secret that surrogates are drawn with; a deployment sets its own."""
    return spark.conf.get("spark.tracklake.privacy.key", "surrogates").encode()


def op7_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for the personal data in it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return privacy.pseudonymise(docs, privacy_key(spark)).select("doc_id", "text", "n_entities", "entity_spans")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that start in an earlier document."""
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels outside the held-out fifth."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels.where(~quality.held_out("doc_id")))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, some runs with a code point left out."""
    return spelling.group_variants(spelling.word_counts(read(spark, sf_dir, "documents"), slip=31))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents outside the held-out third."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_language(docs.where(~language.held_out("doc_id")))
    found = language.predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_vectors": op3_vectors,
    "op4_url_filter": op4_url_filter,
    "op5_html_text": op5_html_text,
    "op6_substrings": op6_substrings,
    "op7_privacy": op7_privacy,
    "op8_simhash": op8_simhash,
    "op9_suffixes": op9_suffixes,
    "op10_quality": op10_quality,
    "op11_lexical": op11_lexical,
    "op12_spelling": op12_spelling,
    "op13_language": op13_language,
}
