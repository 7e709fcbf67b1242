from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import partial

import pyarrow.parquet as pq

from tests.conftest import SMALL
from tracklake.llm import lexical
from tracklake.llm.common import read, stored
from tracklake.llm.queries import QUERIES

from .helpers import no_documents, odd_documents, sorted_rows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, queries, k):
    """Every score of every document, in plain loops."""
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    out = []
    for key, wanted in queries.items():
        scored = []
        for (doc, c), n in zip(counts, sizes, strict=True):
            score = 0
            for t in wanted:
                if c[t]:
                    df = sum(1 for _, other in counts if other[t])
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    m = 100 - 50 + (50 * n * n_docs) // total
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(key, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in read(spark, SMALL, "documents").select("doc_id", "text").collect()]
    items = {r["item_id"]: set(terms(r["text"])) for r in read(spark, SMALL, "benchmark").collect()}
    assert sorted_rows(QUERIES["op11_lexical"](spark, SMALL)) == brute(docs, items, 50)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = [(1, "Beta gamma"), (1, "delta"), (None, "here only"), (2, None), (3, ""), (4, "日本 CÖDÉ cödé"), (5, "nowhere")]
    queries = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    found = lexical.ranked_search(docs, queries, k=4)
    wanted = {1: {"beta", "gamma", "delta"}, None: {"here", "only"}, 4: {"日本", "cÖdÉ", "cödé"}, 5: {"nowhere"}}
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted_rows(found) == brute(rows, wanted, 4)


def test_empty_tables(spark):
    queries = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert lexical.ranked_search(no_documents(spark), queries).collect() == []
    none = lexical.ranked_search(odd_documents(spark), queries.limit(0))
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]


def made(seed, n):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(20)], [f"r{i}" for i in range(800)]
    return [
        (i, " ".join([*rng.choices(common, k=rng.randint(5, 60)), *rng.choices(rare, k=rng.randint(0, 6))])) for i in range(n)
    ]


def test_small_shards_ties_and_copies(spark):
    rows = made(1, 300) + [(1000 + i, "r1 r2 c3") for i in range(40)] + [(5, "r1 r2 c3"), (None, "r1 r2 c3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = {1: {"r1", "r2", "c3"}, 2: {"c0", "c1", "c2", "c3", "r7"}, 3: {"r9"}}
    queries = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    index = lexical.build_index(docs, shard_docs=17)
    assert index.count() > 15
    assert sorted_rows(lexical.search(index, queries, k=7)) == brute(rows, items, 7)
    assert sorted_rows(lexical.search(index, queries, k=7, query_block=1)) == brute(rows, items, 7)


def opened(rows, ranking_terms):
    counts = [Counter(t.encode() for t in terms(text)) for _, text in rows]
    row = lexical.shard_of([doc for doc, _ in rows], counts)
    df = Counter(t for c in counts for t in c)
    weights = {t: lexical.weight(row["n_docs"], df[t]) for t in ranking_terms if df[t]}
    return lexical.Shard(row, lexical.Ranking(row["n_docs"], row["n_terms"], weights))


def test_blocks_that_cannot_matter_stay_compressed():
    rows = made(2, 4000)
    rows += [(9000 + i, "r1 r2 r3 c0") for i in range(12)]
    wanted = [b"r1", b"r2", b"r3", b"c0", b"c1", b"c2"]
    shard = opened(rows, wanted)
    docs, scores = shard.search(wanted, 10, 1)
    best = sorted(zip((-scores).tolist(), docs.tolist(), strict=True))[:10]
    full = opened(rows, wanted)
    every, all_scores = full.search(wanted, len(rows), 1)
    assert best == sorted(zip((-all_scores).tolist(), every.tolist(), strict=True))[:10]
    assert len(full.read) == len({n for t in wanted for n in range(full.start[full.lists[t]], full.start[full.lists[t] + 1])})
    assert len(shard.read) < len(full.read) / 2


def test_postings_survive_wide_gaps_and_frequencies():
    counts = [Counter({b"a": 1})] + [Counter({b"z": 1})] * 70_000 + [Counter({b"a": 70_000, b"z": 300})]
    row = lexical.shard_of(list(range(len(counts))), counts)
    shard = lexical.Shard(row, lexical.Ranking(row["n_docs"], row["n_terms"], {b"a": 1000, b"z": 10}))
    k = shard.lists[b"a"]
    docs, _ = shard.blocks(b"a", range(shard.start[k], shard.start[k + 1]))
    assert docs.tolist() == [0, 70_001] and int(row["block_tf"][shard.start[k]]) == 70_000
    k = shard.lists[b"z"]
    assert shard.blocks(b"z", range(shard.start[k], shard.start[k + 1]))[0].tolist() == list(range(1, 70_002))


def test_a_reader_unpacks_one_shard_at_a_time(spark, monkeypatch):
    files = []

    def keep(df, label, *more):
        out = stored(df, label, *more)
        files.extend(out.inputFiles() if label == "lexical-index" else [])
        return out

    rows = made(3, 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    queries = spark.createDataFrame([(1, "c1 r5")], "item_id long, text string")
    monkeypatch.setattr(lexical, "stored", keep)
    monkeypatch.setattr(lexical, "build_index", partial(lexical.build_index, shard_docs=17))
    assert sorted_rows(lexical.ranked_search(docs, queries, k=7)) == brute(rows, {1: {"c1", "r5"}}, 7)
    held = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
    assert sum(m.num_rows for m in held) == 12
    assert all(m.row_group(k).num_rows == 1 for m in held for k in range(m.num_row_groups))
