from __future__ import annotations

import numpy as np
import xxhash

from tests.conftest import SMALL
from tracklake.llm import simhash
from tracklake.llm.queries import QUERIES

from .helpers import no_documents, odd_documents


def mixed(h, k):
    if not k:
        return h
    h = (h + k * 0x9E3779B97F4A7C15) % 2**64
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
    return h ^ h >> 31


def fingerprint(text, number=0):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [mixed(xxhash.xxh64_intdigest(s, 42), number) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, count=1):
    every = [np.array([fingerprint(t, k) for _, t in rows], dtype=np.uint64) for k in range(count)]
    prints = every[0]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k in range(len(rows)):
        for p in every:
            for j in np.flatnonzero(np.bitwise_count(p[:k] ^ p[k]) <= 3):
                parent[find(k)] = find(int(j))
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return sorted(((d, f"{int(p):016x}", least.get(find(k))) for k, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=repr)


def test_golay_code():
    error, keys = simhash.ERROR, simhash.KEYS
    assert len({int(e) for e in error}) == 2048 and max(int(e).bit_count() for e in error) == 3
    assert {len(set(k.tolist())) for k in keys} == {1, 6}
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 3000)
    for bit in range(23):
        assert (simhash.codewords_near(words) == simhash.codeword(words ^ (1 << bit))[:, None]).any(axis=1).all()


def test_links_are_complete_and_single(spark):
    rng = np.random.default_rng(1)
    prints = set(rng.integers(-(2**63), 2**63 - 1, 150, dtype=np.int64).tolist())
    for p in list(prints):
        for _ in range(6):
            bits = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            prints.add((p ^ (bits - (1 << 64) if bits >> 63 else bits)))
    values = np.array(sorted(prints), dtype=np.int64)
    raw = values.view(np.uint64)
    want = {(int(min(a, b)), int(max(a, b))) for k, a in enumerate(values) for b in values[:k][np.bitwise_count(raw[:k] ^ raw[k]) <= 3]}
    got = [tuple(r) for r in simhash.links_within(spark.createDataFrame([(int(v),) for v in values], "fp long"), "fp").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_small_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op8_simhash"](spark, SMALL)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == components(rows)


def test_edge_rows_and_one_of_each_group(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == components(rows)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    groups = {r[2] if r[2] is not None else r[1] for r in components(rows, 4)}
    assert kept.count() == len(groups)
    assert simhash.near_duplicates(no_documents(spark)).count() == simhash.deduplicate(no_documents(spark)).count() == 0


def test_one_of_each_group_over_several_fingerprints(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # Copies of a long text that differ in one word each.
    words = " ".join(t or "" for _, t in rows[:3]).split()[:300]
    rows += [(10_000 + k, " ".join([*words[: 20 * k], f"other{k}", *words[20 * k + 1 :]])) for k in range(12)]
    kept = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in components(rows, 4)}
    assert kept.where("doc_id >= 10000").count() <= 2


def test_no_key_is_broadcast(spark):
    """Some 40 keys a fingerprint: a table of keys that Spark takes for a small one may be of GBs."""
    prints = spark.range(0, 2000, 1, 4).selectExpr("xxhash64(id) AS fp")
    prints = prints.unionByName(prints.selectExpr("fp ^ 7 AS fp"))
    links = simhash.links_within(prints, "fp")
    assert links.count() == 2000
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
