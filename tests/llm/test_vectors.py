from __future__ import annotations

import numpy as np

from tracklake.llm import vectors

from .helpers import sorted_rows


def brute(rows, least=0.93):
    ok = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and lab is not None
        for _, v, lab in rows
    ]
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    links[a] += 1
                    links[b] += 1
                    parent[find(a)] = find(b)
    smallest = {}
    for k in range(n):
        if rows[k][0] is not None:
            smallest[find(k)] = min(smallest.get(find(k), rows[k][0]), rows[k][0])
    return sorted(
        [(rows[k][0], links[k], smallest.get(find(k)), rows[k][0] == smallest.get(find(k))) for k in range(n)], key=repr
    )


def clusters(seed, groups, size, width=16, noise=0.12):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.normal(size=width)
        out += [(centre + rng.normal(size=width) * noise * np.linalg.norm(centre) / 4).tolist() for _ in range(size)]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_matches_brute_force_over_shards_and_blocks(spark):
    rows = [(k, v, k % 2) for k, v in enumerate(clusters(3, 20, 12) + clusters(4, 1, 90, noise=0.05))]
    rows += [(1000 + k, rows[5][1], 1) for k in range(40)]  # copies
    got = vectors.near_duplicate_vectors(frame(spark, rows), block_rows=24, overlap=3)
    want = brute(rows)
    got_rows = sorted_rows(got, "vec_id", "n_links", "component_id", "kept")
    true, found = {r[0]: r[1] for r in want}, {r[0]: r[1] for r in got_rows}
    assert all(found[k] <= true[k] for k in true)
    assert sum(found.values()) >= 0.98 * sum(true.values())
    audit = vectors.audit_recall(frame(spark, rows), got, every=5).first()
    assert audit["queries"] > 40 and audit["recall"] >= 0.98


def test_one_shard_is_exact(spark):
    rows = [(k, v, k % 3) for k, v in enumerate(clusters(5, 12, 15))]
    assert sorted_rows(vectors.near_duplicate_vectors(frame(spark, rows))) == brute(rows)


def test_edge_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, one, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 0.0], 1),
        (7, [float("nan"), 1.0, 0.0], 1), (8, [float("inf"), 1.0, 0.0], 1), (9, [1.0, 0.0], 1), (10, [], 1), (None, one, 1),
        (None, [0.0, 1.0, 0.0], 1), (None, None, None), (11, [1e-200, 0.0, 0.0], 1), (12, [-1.0, 0.0, 0.0], 1),
    ]
    got = sorted_rows(vectors.near_duplicate_vectors(frame(spark, rows)), "vec_id", "n_links", "component_id", "kept")
    want = brute([(i, v, lab) if i != 11 else (i, one, lab) for i, v, lab in rows])
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert vectors.near_duplicate_vectors(frame(spark, rows).limit(0)).count() == 0


def test_tight_cluster_among_spread_vectors_and_clashing_columns(spark):
    """A cluster of many blocks beside spread vectors: no centroid splits it; columns named as those inside are not touched."""
    rows = [(k, v, 0) for k, v in enumerate(clusters(6, 1, 1200, noise=0.06) + clusters(7, 1500, 1))]
    df = spark.createDataFrame([(*r, "x", 7, -1) for r in rows], "vec_id long, embedding array<double>, label int, rid string, shard int, block int")
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicate_vectors(df, block_rows=128).collect()}
    x = vectors.unit_rows([r[1] for r in rows])
    true = (x @ x.T >= 0.93).sum(1) - 1
    assert len(got) == len(rows) and true.sum() > 1_000_000
    assert all(got[k] <= true[k] for k in got) and sum(got.values()) >= 0.98 * true.sum()


def test_centroids_of_one_cluster_become_one():
    x = vectors.unit_rows(clusters(8, 1, 50, noise=0.05))
    apart = vectors.apart(np.concatenate([x, -x, np.zeros((1, 16))]), 0.93)
    assert len(apart) == 3
