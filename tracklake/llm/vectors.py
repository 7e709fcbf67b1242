"""Embedding near-duplicates by a robust-pruned flat graph over overlapping cluster shards.

1. Equal vectors of a label are one node with a count. Nodes go to the shards of their nearest centroids (fitted on a bounded
   sample), so shards overlap; a shard holds about half of ``block_rows`` at every size, so the work per node does not grow. A
   shard that is larger (a tight cluster, or more than ``max_shards`` would be needed) is dealt into blocks by a hash.
2. In every block each node gets the neighbours that robust pruning leaves of all others (a candidate goes if a kept
   neighbour is closer to it by the factor ``alpha``). The lists of a node from all its shards are united.
3. Every pair of blocks of a shard is one task: the nodes of one block search the united graph of the other, greedily from its
   medoids with a beam, then outward through everything within range. Distances are computed for visited nodes only.
4. A pair found is verified by its cosine in double precision, counted in its first common shard only, and tasks emit counts
   and a spanning forest of their links, never the pairs. :func:`audit_recall` holds the counts against brute force.

A hot label or a tight cluster becomes many bounded tasks. What one task holds is at most two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import stored
from tracklake.llm.components import component_roots

NODE = "rid bigint, label string, vec array<double>, copies bigint"


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not NULL, no NULL or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def centroids_of(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    centre = sample[rng.choice(len(sample), count, replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centre.T).argmax(1)
        total = np.zeros_like(centre)
        np.add.at(total, nearest, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-300), centre)
    return centre


def apart(centre: np.ndarray, least: float) -> np.ndarray:
    """Of the centroids those with a cosine below ``least`` to all kept before: two within one tight cluster would split its links."""
    centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-300)
    open_ = np.ones(len(centre), dtype=bool)
    kept = []
    while open_.any():
        kept.append(int(open_.argmax()))
        open_ &= centre @ centre[kept[-1]] < least
        open_[kept[-1]] = False
    return centre[kept]


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def robust_prune(x: np.ndarray, degree: int, alpha: float) -> list[np.ndarray]:
    """Neighbours of every row: from the closest on, a candidate is kept unless a kept one is closer to it by ``alpha``."""
    n = len(x)
    out = []
    distance = 1.0 - x @ x.T
    for k in range(n):
        own = distance[k].copy()
        own[k] = np.inf
        kept = []
        while len(kept) < min(degree, n - 1):
            nearest = int(own.argmin())
            if own[nearest] == np.inf:
                break
            kept.append(nearest)
            own[alpha * distance[nearest] <= distance[k]] = np.inf
            own[nearest] = np.inf
        out.append(np.array(kept, dtype=np.int64))
    return out


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """The row nearest to the mean, then rows farthest from those chosen."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    closest = x @ x[chosen[0]]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, x @ x[chosen[-1]])
    return np.array(chosen)


def range_search(
    x: np.ndarray, graph: np.ndarray, queries: np.ndarray, starts: np.ndarray, least: float, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs with cosine >= ``least`` that a search of the graph reaches. ``graph`` pads with -1."""
    m, n = len(queries), len(x)
    seen = np.zeros((m, n), dtype=bool)
    ids = np.tile(starts, (m, 1))
    sims = queries @ x[starts].T
    seen[:, starts] = True
    done = np.zeros(ids.shape, dtype=bool)
    got_q, got_x = [], []

    def keep(q: np.ndarray, v: np.ndarray, s: np.ndarray) -> None:
        near = s >= least
        got_q.append(q[near])
        got_x.append(v[near])

    keep(np.repeat(np.arange(m), len(starts)), ids.ravel(), sims.ravel())
    active = np.arange(m)
    while len(active):  # greedy: every query expands its best open row
        open_sim = np.where(done[active], -np.inf, sims[active])
        pick = open_sim.argmax(1)
        some = open_sim[np.arange(len(active)), pick] > -np.inf
        active, pick = active[some], pick[some]
        if not len(active):
            break
        done[active, pick] = True
        near = graph[ids[active, pick]]
        fresh_ = (near >= 0) & ~seen[active[:, None], near]
        q, v = np.repeat(active, near.shape[1]).reshape(near.shape)[fresh_], near[fresh_]
        seen[q, v] = True
        s = np.full(near.shape, -np.inf)
        s[fresh_] = np.einsum("ij,ij->i", x[v], queries[q])
        keep(q, v, s[fresh_])
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_sims = np.concatenate([sims[active], s], axis=1)
        all_done = np.concatenate([done[active], s == -np.inf], axis=1)
        width = min(beam, all_sims.shape[1])
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        if ids.shape[1] < width:
            grow = width - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, grow)))
            sims = np.pad(sims, ((0, 0), (0, grow)), constant_values=-np.inf)
            done = np.pad(done, ((0, 0), (0, grow)), constant_values=True)
        row = np.arange(len(active))[:, None]
        ids[active, :width], sims[active, :width], done[active, :width] = (
            all_ids[row, top], all_sims[row, top], all_done[row, top]
        )
        ids[active, width:], sims[active, width:], done[active, width:] = 0, -np.inf, True
    front_q, front_x = np.concatenate(got_q), np.concatenate(got_x)
    while len(front_q):  # outward through everything within range
        next_q, next_x = [], []
        for at in range(0, len(front_q), 100_000):
            q, v = front_q[at : at + 100_000], front_x[at : at + 100_000]
            near = graph[v]
            q = np.repeat(q, near.shape[1])
            v = near.ravel()
            fresh_ = (v >= 0) & ~seen[q, v]
            pairs = np.unique(q[fresh_] * n + v[fresh_])
            q, v = pairs // n, pairs % n
            seen[q, v] = True
            for b in range(0, len(q), 50_000):
                s = np.einsum("ij,ij->i", x[v[b : b + 50_000]], queries[q[b : b + 50_000]])
                near_ = s >= least
                next_q.append(q[b : b + 50_000][near_])
                next_x.append(v[b : b + 50_000][near_])
        front_q = np.concatenate(next_q) if next_q else front_q[:0]
        front_x = np.concatenate(next_x) if next_x else front_x[:0]
        got_q.append(front_q)
        got_x.append(front_x)
    return np.concatenate(got_q), np.concatenate(got_x)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links (member, smallest of its group) that connect what the pairs connect; whole arrays at a time."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return [(int(k), int(label[k])) for k in np.flatnonzero(label != np.arange(n))]
        label = new


def _members(nodes: DataFrame, sample_rows: int, block_rows: int, overlap: int, max_shards: int, least: float) -> DataFrame:
    """Rows (label, shard, block, blocks, rid, vec, copies, shards): a node once in each of its shards."""
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    count = min(max_shards, -(-2 * overlap * largest // block_rows))
    if count <= overlap:  # every shard would hold every node
        count = 1
    width = F.size("vec")
    if count > 1:
        sample = nodes.orderBy(F.xxhash64("rid")).select("vec").limit(sample_rows).toPandas()["vec"]
        by_width: dict[int, list] = {}
        for v in sample:
            by_width.setdefault(len(v), []).append(v)
        centres = {k: apart(centroids_of(unit_rows(v), min(count, len(v))), least) for k, v in by_width.items()}

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = batch.column(batch.schema.get_field_index("vec")).to_pylist()
                shards: list[list[int]] = [[0]] * len(vectors)
                lengths = np.array([len(v) for v in vectors])
                for long, centre in centres.items():
                    for at in np.array_split(np.flatnonzero(lengths == long), -(-len(vectors) // 1024)):
                        if len(at):
                            near = unit_rows([vectors[k] for k in at]) @ centre.T
                            best = np.sort(np.argsort(-near, axis=1, kind="stable")[:, :overlap], axis=1)
                            for k, some in zip(at, best.tolist(), strict=True):
                                shards[k] = some
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(shards, pa.list_(pa.int32()))], names=[*batch.schema.names, "shards"]
                )

        placed = nodes.mapInArrow(assign, f"{NODE}, shards array<int>")
    else:
        placed = nodes.withColumn("shards", F.array(F.lit(0)))
    each = placed.withColumn("width", width).withColumn("shard", F.explode("shards"))
    each = stored(each, "shard-members")
    sizes = each.groupBy("label", "width", "shard").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    each = each.join(sizes, ["label", "width", "shard"])
    return each.withColumn("block", F.pmod(F.xxhash64("rid", F.lit(11)), "blocks").cast("int"))


def _adjacency(members: DataFrame, degree: int, alpha: float) -> DataFrame:
    """``rid`` and the union of its neighbour lists over all its blocks, both directions of every edge."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        rid = frame["rid"].to_numpy()
        lists = robust_prune(unit_rows(list(frame["vec"])), degree, alpha)
        source = np.repeat(np.arange(len(rid)), [len(x) for x in lists])
        target = np.concatenate(lists).astype(np.int64)
        n = len(rid)
        edges = np.unique(np.r_[source * n + target, target * n + source])  # one row a node leaves the task, not one an edge
        near = np.split(rid[edges % n], np.searchsorted(edges // n, np.arange(1, n)))
        return pd.DataFrame({"rid": rid, "near": near})

    lists = members.groupBy("label", "width", "shard", "block").applyInPandas(build, "rid bigint, near array<bigint>")
    return lists.groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def link_nodes(
    nodes: DataFrame, least: float = 0.93, sample_rows: int = 20_000, block_rows: int = 1024, overlap: int = 3,
    degree: int = 24, alpha: float = 1.2, beam: int = 24, entries: int = 8, max_shards: int = 2048,
) -> DataFrame:
    """``rid``, ``links`` (rows linked through other nodes) or a link ``rid``-``other`` of the spanning forest."""
    members = stored(_members(nodes, sample_rows, block_rows, overlap, max_shards, least), "blocks")
    with_graph = members.join(_adjacency(members, degree, alpha), "rid", "left")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = with_graph.select("*", other).withColumn("first", F.least("block", "other"))
    tasks = tasks.withColumn("second", F.greatest("block", "other")).drop("other", "blocks")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        rid, copies = frame["rid"].to_numpy(), frame["copies"].to_numpy()
        x = unit_rows(list(frame["vec"]))
        one, two = int(frame["first"].iloc[0]), int(frame["second"].iloc[0])
        block = frame["block"].to_numpy()
        base, asking = np.flatnonzero(block == two), np.flatnonzero(block == one)
        if not len(base) or not len(asking):
            return pd.DataFrame({"rid": [], "other": [], "links": []}).astype("int64")
        at = {int(r): k for k, r in enumerate(rid[base])}
        near = frame["near"].to_numpy()
        lists = [[at[int(r)] for r in (near[b] if near[b] is not None else ()) if int(r) in at] for b in base]
        graph = np.full((len(base), max(1, max(map(len, lists)))), -1, dtype=np.int64)
        for k, some in enumerate(lists):
            graph[k, : len(some)] = some
        xb = x[base]
        starts = medoids(xb, entries)
        found_q, found_x = [], []
        for start in range(0, len(asking), 512):
            q, v = range_search(xb, graph, x[asking[start : start + 512]], starts, least, beam)
            found_q.append(asking[q + start])
            found_x.append(base[v])
        a, b = np.concatenate(found_q), np.concatenate(found_x)
        n = len(rid)
        keys = np.unique(np.minimum(a, b) * n + np.maximum(a, b))
        a, b = keys // n, keys % n
        a, b = a[a != b], b[a != b]
        shards = frame["shards"].to_numpy()
        shard = int(frame["shard"].iloc[0])
        width = max(len(s) for s in shards)
        table = np.full((n, width), -1, dtype=np.int64)
        for k, s in enumerate(shards):
            table[k, : len(s)] = s
        earlier = np.zeros(len(a), dtype=bool)  # whether the pair also meets in a shard before this one
        for j in range(width):
            mine = table[a, j]
            earlier |= (mine >= 0) & (mine < shard) & (table[b] == mine[:, None]).any(axis=1)
        links = np.zeros(n, dtype=np.int64)
        np.add.at(links, a[~earlier], copies[b[~earlier]])
        np.add.at(links, b[~earlier], copies[a[~earlier]])
        tree = forest(a, b, n)
        counted = np.flatnonzero(links)
        return pd.DataFrame(
            {
                "rid": np.r_[rid[counted], rid[[t[0] for t in tree]]] if tree else rid[counted],
                "other": np.r_[np.full(len(counted), -1), rid[[t[1] for t in tree]]] if tree else np.full(len(counted), -1),
                "links": np.r_[links[counted], np.zeros(len(tree), np.int64)] if tree else links[counted],
            }
        )

    keys = ["label", "width", "shard", "first", "second"]
    return tasks.groupBy(*keys).applyInPandas(search, "rid bigint, other bigint, links bigint")


def near_duplicate_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    least: float = 0.93, **options: int,
) -> DataFrame:
    """Per row: the id, ``n_links``, ``component_id`` (smallest id reachable) and ``kept``.

    Only rows of equal, non-NULL labels and equally long vectors are compared. Vectors without a direction (see
    :func:`usable`) and rows without a label link with nothing and stay. Repeated rows are different rows that link with each
    other. NULL ids are never the smallest; a row whose component has no id is kept. Other columns are not read.
    """
    picked = rows.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
    )
    ok = usable(F.col("vec")) & F.col("label").isNotNull()
    good, rest = picked.where(ok), picked.where(~ok)
    grouped = good.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    nodes = stored(grouped.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    found = stored(link_nodes(nodes.select("rid", "label", "vec", "copies"), least, **options), "vector-links")
    roots = component_roots(found.where("other >= 0"), "rid", "other")
    counts = found.where("other < 0").groupBy("rid").agg(F.sum("links").alias("links"))
    joined = nodes.join(counts, "rid", "left").join(roots, nodes["rid"] == roots["node"], "left")
    joined = joined.select("label", "vec", "least", "copies", "links", F.coalesce("root", nodes["rid"]).alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    by_vector = joined.join(named, "root").select(
        "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = good.join(by_vector, ["label", "vec"]).select("id", "n_links", "component_id")
    out = out.unionByName(rest.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return out.withColumn("kept", kept).withColumnRenamed("id", id_col)


def audit_recall(
    rows: DataFrame, result: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    least: float = 0.93, every: int = 50, block_rows: int = 1024,
) -> DataFrame:
    """One row: ``queries``, ``links`` (true), ``found``, ``recall`` over the rows whose id is divisible by ``every``.

    Those rows are compared with all rows of their label in blocks. No true link counts as recall 1.
    """
    picked = rows.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
    ).where(usable(F.col("vec")) & F.col("label").isNotNull())
    picked = picked.withColumn("width", F.size("vec"))
    asked = picked.where(F.col("id") % every == 0)
    keys = ["label", "width", "block", "part"]
    blocks = asked.groupBy("label", "width").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    spread = picked.join(blocks, ["label", "width"]).withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(64)).cast("int")
    )
    each = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    queries = each.where((F.col("id") % every == 0) & (F.pmod(F.xxhash64("id"), "blocks") == F.col("block")))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(63))))
    queries = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("id", "vec", *keys)])
    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "links": []}).astype("int64")
        near = unit_rows(list(left["q_vec"])) @ unit_rows(list(right["vec"])).T >= least
        return pd.DataFrame({"id": left["q_id"].to_numpy(), "links": near.sum(axis=1)})

    true = queries.groupBy(*[f"q_{k}" for k in keys]).cogroup(each.groupBy(*keys)).applyInPandas(count, "id bigint, links bigint")
    true = true.groupBy("id").agg((F.sum("links") - 1).alias("links"))
    both = true.join(result.select(F.col(id_col).alias("id"), F.col("n_links").alias("found")), "id")
    total = both.agg(
        F.count("*").alias("queries"), F.coalesce(F.sum("links"), F.lit(0)).alias("links"),
        F.coalesce(F.sum(F.least("links", "found")), F.lit(0)).alias("found"),
    )
    return total.withColumn("recall", F.when(F.col("links") > 0, F.col("found") / F.col("links")).otherwise(F.lit(1.0)))
