from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL
from tracklake.llm import substrings, suffixes

from .helpers import no_documents, odd_documents, sorted_rows


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.text("ab", max_size=60).map(str.encode), st.text("abc", max_size=5).map(lambda s: s.encode() * 9)))
def test_suffix_array(data):
    assert suffixes.suffix_array(data) == sorted(range(len(data)), key=lambda i: data[i:])


def brute_words(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, texts, strict=True):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((doc, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def brute_bytes(rows, window):
    least = {}
    texts = [(t or "").encode() for _, t in rows]
    ids = [suffixes.NO_ID if d is None else d for d, _ in rows]
    for d, b in zip(ids, texts, strict=True):
        for i in range(len(b) - window + 1):
            least[b[i : i + window]] = min(least.get(b[i : i + window], d), d)
    out = []
    for (doc, _), d, b in zip(rows, ids, texts, strict=True):
        gone = {j for i in range(len(b) - window + 1) if least[b[i : i + window]] < d for j in range(i, i + window)}
        spans = sum(j - 1 not in gone for j in gone)
        out.append((doc, len(b), len(gone), spans, bytes(x for k, x in enumerate(b) if k not in gone)))
    return sorted(out, key=repr)


def mixed(seed, count=60):
    """Documents that share passages, copies, near copies, periodic text and a passage common to most."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "klmn" for b in "aeiou"]
    passage = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared, common = [passage(rng.randint(20, 90)) for _ in range(8)], passage(60)
    rows = []
    for k in range(count):
        words = passage(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(shared)
            a, b = sorted((rng.randint(0, len(part)), rng.randint(0, len(part))))
            words += part[a:b] + passage(rng.randint(0, 9))
        if k % 2:
            words += common + passage(3)
        if k % 9 == 0:
            words += [rng.choice(vocabulary)] * 80
        rows.append((k if k % 11 else None, " ".join(words)))
    rows += [(200 + k, rows[k][1]) for k in range(0, count, 4)] + [rows[3], (3, rows[3][1]), (7, None), (8, "")]
    rng.shuffle(rows)
    return rows


SETTINGS = [{}, {"hot": 3, "chunk_bytes": 900, "buckets": (5, 5)}, {"hot": 10**9, "chunk_bytes": 1500}]


@pytest.mark.parametrize("change", SETTINGS)
@pytest.mark.parametrize("seed", [1, 2])
def test_word_windows_match_brute_force(spark, seed, change):
    rows = mixed(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substrings.remove_repeats(df, rule=replace(substrings.WORD_RULE, **change))
    assert sorted_rows(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_words(rows, 35)


@pytest.mark.parametrize("change", SETTINGS)
@pytest.mark.parametrize("seed", [1, 2])
def test_byte_windows_match_brute_force(spark, seed, change):
    rows = mixed(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.remove_repeats(df, rule=replace(suffixes.BYTE_RULE, **change))
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()), key=repr)
    assert got == brute_bytes(rows, 50)


def test_small_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted_rows(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_text") == brute_words(rows, 35)
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffixes.remove_repeats(docs).collect()), key=repr)
    assert got == brute_bytes(rows, 50)


def test_edge_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted_rows(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_text") == brute_words(rows, 35)
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffixes.remove_repeats(docs).collect()), key=repr)
    assert got == brute_bytes(rows, 50)
    assert substrings.remove_repeats(no_documents(spark)).count() == 0
    assert suffixes.remove_repeats(no_documents(spark)).count() == 0
