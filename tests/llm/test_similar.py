"""The near-duplicate stage against exact Jaccard similarity of five-word shingles."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from tests.conftest import SMALL
from tracklake.llm import similar

from .helpers import no_documents, odd_documents


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def kept_ids(rows, similarity=0.8):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k in range(len(rows)):
        for j in range(k):
            if jaccard(sets[k], sets[j]) >= similarity:
                parent[find(k)] = find(j)
    groups = {}
    for k, (doc, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(doc)
    return sorted(min(g) for g in groups.values())


def stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SMALL).collect())


def test_small_documents_have_the_exact_groups(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert stage(spark, rows) == kept_ids(rows)


def test_short_and_middling_texts_around_the_limit(spark):
    rng = random.Random(3)
    rows = []
    for length in (3, 6, 9, 12, 20, 40, 60, 120, 300):
        for _ in range(6):
            words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
            rows.append((len(rows), " ".join(words)))
            for changed in (0, 1, 1, 2, 3, 5):
                other = list(words)
                for _ in range(changed):
                    other[rng.choice((0, -1, rng.randrange(length)))] = f"x{rng.randrange(10**6)}"
                rows.append((len(rows), " ".join(other)))
    # A chain: neighbours are similar, the ends are not.
    words = [f"c{k}" for k in range(200)]
    rows += [(len(rows) + k, " ".join(words[5 * k : 5 * k + 100])) for k in range(20)]
    assert stage(spark, rows) == kept_ids(rows)


def test_pairs_across_components_are_compared(spark, monkeypatch):
    """With one bucket for all texts, every pair must still be decided, not only those with the bucket's smallest."""
    import numpy as np

    rng = random.Random(4)
    rows = []
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        rows += [(len(rows) + k, " ".join([*words[: 55 - k], *(f"t{len(rows)}-{k}-{i}" for i in range(k))])) for k in range(6)]
    monkeypatch.setattr(similar, "band_keys", lambda hashes: np.zeros(min(1, len(hashes)), np.int64))
    assert stage(spark, rows) == kept_ids(rows)


def test_blocks_give_the_same_groups(spark, monkeypatch):
    """A bucket of many blocks: every pair of blocks is compared, and only a forest comes back."""
    import numpy as np

    rng = random.Random(5)
    rows = []
    for _ in range(25):
        words = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        rows += [(len(rows) + k, " ".join([*words[: 38 - k], *(f"t{len(rows)}-{k}-{i}" for i in range(k))])) for k in range(5)]
    rng.shuffle(rows)
    monkeypatch.setattr(similar, "band_keys", lambda hashes: np.zeros(min(1, len(hashes)), np.int64))
    monkeypatch.setattr(similar, "BLOCK", 9)
    monkeypatch.setattr(similar, "COLUMNS", 16)
    assert stage(spark, rows) == kept_ids(rows)


def test_forest_unites_what_all_pairs_unite():
    import numpy as np

    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 1 << 60, 50).astype(np.uint64)) for _ in range(6)]
    sets = [np.unique(np.concatenate([base[k % 6][: 50 - k // 6], rng.integers(0, 1 << 60, 3).astype(np.uint64)])) for k in range(60)]
    plain = [[len(np.intersect1d(a, b)) for b in sets[20:]] for a in sets[:20]]
    assert similar.shared_counts(sets[:20], sets[20:]).tolist() == plain
    for sides in ([0] * 60, [0] * 20 + [3] * 40):
        found = similar.forest(sets, list(range(100, 160)), sides, 0.8)
        links = {(a, b) for a in range(60) for b in range(60) if a < b and (sides[a] != sides[b] or not any(sides)) and similar.jaccard(sets[a], sets[b]) >= 0.8}
        assert {(a - 100, b - 100) for a, b in found} <= links and len(found) < 60

        def groups(edges):
            label = list(range(60))
            for _ in range(60):
                for a, b in edges:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        assert groups([(a - 100, b - 100) for a, b in found]) == groups(sorted(links))


def test_edge_rows(spark):
    docs = odd_documents(spark)
    kept = similar.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.select("doc_id").collect(), key=repr) == sorted(
        docs.where("doc_id IN (1, 3, 5, 6, 7) OR doc_id IS NULL AND text IS NOT NULL").distinct().select("doc_id").collect(), key=repr
    )
    assert similar.deduplicate(no_documents(spark)).count() == 0


def test_no_block_is_broadcast(spark):
    """A bucket's rows become one per block, of which Spark's estimate knows nothing."""
    hashes = [np.arange(k // 2 * 100, k // 2 * 100 + 50, dtype=np.uint64).tobytes() for k in range(1200)]
    sets = spark.createDataFrame([(k, h) for k, h in enumerate(hashes)], "node bigint, hashes binary")
    placed = spark.range(1200).selectExpr("1L AS band", "id AS node", "1200L AS size", "id AS c")
    links = similar._across(placed, sets, 0.8)
    assert {tuple(sorted(r)) for r in links.collect()} == {(k, k + 1) for k in range(0, 1200, 2)}
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
