"""Near-duplicates by the Jaccard similarity of word shingles: SimHash fingerprints with Golay keys find candidates, MinHash bands
those that fingerprints miss, exact sets decide.

A text is its set of distinct five-word shingles (the whole of a shorter text), folded to lower case and single spaces; equal sets are
one *node* before anything is joined. Each node has the fingerprint of its set (``simhash.majority``), and fingerprints within three bits are
linked by their Golay keys; what they connect is compared first. At a similarity of 0.8 some ten of 64 bits differ, so the keys alone
would miss most pairs near the limit. Therefore each node also has ``BANDS`` bands of ``ROWS`` minima, by which nodes that are still in
several components are compared. Two sets of similarity s share a band with
probability 1 - (1 - s^8)^64, whatever their sizes: at 0.8 eight pairs in a million are missed, above it fewer. No pair below the
similarity is ever linked, as every candidate is verified by its sets.

A bucket (the nodes of connected fingerprints, or of a band's value) is not multiplied out: its nodes are compared with its smallest one first, which is one row per
node. A bucket whose nodes are then still in several components is compared in blocks of bounded size: a task counts what the sets of
two blocks share by a matrix product, and returns a forest over the components, never pairs. So the rows grow with the
nodes, and the components are still those of all candidate pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import by_sorting, fresh, stored, text_key
from tracklake.llm.components import component_roots
from tracklake.llm.simhash import links_within, majority

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 64, 8
FACTORS = np.random.default_rng(8).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Up to so many nodes that need their sets travel with the second pass over the texts; more are joined.
TRAVELLING = 1_000_000
#: Nodes of a mixed bucket that a task compares with as many others at once, and shingles it counts at once.
BLOCK, COLUMNS = 512, 4096


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 (seed 42) hashes of the word shingles; empty without words."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    ends = np.cumsum(sizes)
    starts = (ends - sizes).tolist()
    ends = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends, strict=False)], dtype=np.uint64))


def node_of(hashes: np.ndarray) -> int:
    """A signed long that stands for the set."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), 42)).view(np.int64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One signed long per band, none for the empty set; the band's number is part of it."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (FACTORS[:, None] * hashes[None, at : at + 1024]).min(axis=1), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _alike(a: Column, b: Column, similarity: float) -> Column:
    """Sets whose sizes differ by more cannot be similar enough."""
    return F.least(a, b) / F.greatest(a, b) >= F.lit(similarity)


def _nodes(keyed: DataFrame, shingle: int) -> DataFrame:
    """``id``, ``key``, ``node``, ``n`` (size of the set), ``fp`` (its fingerprint) and ``bands`` of rows (``id``, ``key``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingle_set(t.as_py(), shingle) for t in batch.column(2))
            rows = [(node_of(s), len(s), majority(s), band_keys(s)) for s in sets]
            node, n, fp, bands = ([r[k] for r in rows] for k in range(4))
            numbers = [pa.array(c, pa.int64()) for c in (node, n, fp)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *numbers, pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "key", "node", "n", "fp", "bands"],
            )

    id_type = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {id_type}, key string, node bigint, n bigint, fp bigint, bands array<bigint>")


def _sets(keyed: DataFrame, table: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``node`` and ``hashes`` (little-endian unsigned longs) of the distinct nodes ``wanted``, read again from the texts."""
    first = table.groupBy("node").agg(F.min("key").alias("key")).join(wanted, "node", "left_semi")
    first = stored(first.select(F.xxhash64("key").alias("k")).distinct(), "wanted")
    few = first.limit(TRAVELLING + 1).count() <= TRAVELLING
    texts = keyed.withColumn("k", F.xxhash64("key")).join(F.broadcast(first) if few else first, "k", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(0)]
            columns = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "hashes"])

    return texts.mapInArrow(run, "node bigint, hashes binary").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar enough."""
    both = pairs.join(sets.withColumnsRenamed({"node": "a", "hashes": "x"}), "a")
    both = both.join(sets.withColumnsRenamed({"node": "b", "hashes": "y"}), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                jaccard(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) >= similarity
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``left`` has in common with each of ``right``."""
    out = np.zeros((len(left), len(right)))
    mine = np.unique(np.concatenate([np.zeros(0, np.uint64), *left]))
    common = np.intersect1d(mine, np.concatenate([np.zeros(0, np.uint64), *right]))
    for at in range(0, len(common), COLUMNS):
        columns = common[at : at + COLUMNS]
        sides = []
        for sets in (left, right):
            has = np.zeros((len(sets), len(columns)), np.float32)
            for row, hashes in enumerate(sets):
                some = hashes[np.searchsorted(hashes, columns[0]) : np.searchsorted(hashes, columns[-1], "right")]
                place = np.searchsorted(columns, some)
                has[row, place[columns[place] == some]] = 1
            sides.append(has)
        out += sides[0] @ sides[1].T
    return out


def forest(sets: list[np.ndarray], parts: list[int], sides: list[int], similarity: float) -> list[tuple[int, int]]:
    """Links between components (``parts``) that suffice to unite all whose sets are similar enough.

    Compared are the sets of side 0 with those of side 1, or all with all if there is one side only.
    """
    rows = [k for k, side in enumerate(sides) if side == min(sides)]
    others = [k for k, side in enumerate(sides) if side != min(sides)] or rows
    both = shared_counts([sets[k] for k in rows], [sets[k] for k in others])
    size = np.array([len(s) for s in sets], np.float64)
    union = size[rows][:, None] + size[others][None, :] - both
    label = {c: n for n, c in enumerate(dict.fromkeys(parts))}
    part = np.array([label[c] for c in parts])
    linked = (both >= similarity * union) & (part[rows][:, None] != part[others][None, :])
    names, root, out = list(label), list(range(len(label))), []

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    edges = np.unique(np.sort(np.stack([part[rows][linked.nonzero()[0]], part[others][linked.nonzero()[1]]], axis=1), axis=1), axis=0)
    for x, y in edges.tolist():
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((names[x], names[y]))
    return out


def _across(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (``a``, ``b``) between the components ``c`` of nodes that share a ``band`` of ``size`` nodes."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = placed.withColumn("blocks", blocks).withColumn("block", F.pmod(F.hash("node"), "blocks"))
    mine = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = mine.select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "c", "node"
    ).join(by_sorting(sets), "node")  # a row of a table of compressed files became one per block

    def run(table: pa.Table) -> pa.Table:
        held = [np.frombuffer(h.as_py(), np.uint64) for h in table.column("hashes")]
        found = forest(held, table.column("c").to_pylist(), table.column("block").to_pylist(), similarity)
        a, b = ([f[k] for f in found] for k in range(2))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("band", "i", "j").applyInArrow(run, "a bigint, b bigint")


def _print_groups(each: DataFrame) -> DataFrame:
    """Nodes by the fingerprints that Golay keys connect: ``node``, ``n`` and ``band`` (the smallest of these fingerprints)."""
    roots = component_roots(links_within(each, "fp"), "a", "b")
    grouped = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return grouped.select("node", "n", F.coalesce("root", "fp").alias("band"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` that ``roots`` has not united yet."""
    for end, root in (("a", "x"), ("b", "y")):
        pairs = pairs.join(roots.withColumnsRenamed({"node": end, "root": root}), end, "left")
    return pairs.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def _united(
    keyed: DataFrame, table: DataFrame, members: DataFrame, known: DataFrame | None, shingle: int, similarity: float
) -> DataFrame:
    """``node`` and ``root`` of every node linked to another within a ``band`` of ``members``, or by the roots ``known`` before."""
    heads = members.groupBy("band").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("size")).where("size > 1")
    shared = stored(members.join(by_sorting(heads), "band"), "buckets")  # nodes times bands
    fits = _alike(F.col("n"), F.col("head.n"), similarity)
    first = shared.where((F.col("node") != F.col("head.node")) & fits)
    first = first.select(F.col("head.node").alias("a"), F.col("node").alias("b")).distinct()
    first = stored(first if known is None else _apart(first, known), "first-pairs")
    ends = first.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = _verified(first, _sets(keyed, table, ends, shingle), similarity)
    if known is not None:
        links = links.unionByName(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = stored(component_roots(stored(links, "first-links"), "a", "b"), "first-roots")

    # Buckets whose nodes are not all in one component: what is across components is still to be compared.
    placed = shared.join(roots, "node", "left").select("band", "node", "size", F.coalesce("root", "node").alias("c"))
    mixed = placed.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("band")
    placed = stored(placed.join(mixed, "band", "left_semi"), "mixed")
    if placed.isEmpty():
        return roots
    sets = _sets(keyed, table, placed.select("node").distinct(), shingle)
    above = stored(component_roots(_across(placed, sets, similarity), "a", "b"), "further-roots")
    lower = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    lower = lower.select("node", F.coalesce("top", "root").alias("root"))
    return lower.unionByName(above.join(roots, "node", "left_anti").select("node", "root"))


def _roots(keyed: DataFrame, table: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``node`` and ``root`` of every node that is linked to another: by fingerprints first, then by bands across what these united."""
    each = table.where("n > 0").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "fp", "bands")])
    near = stored(_united(keyed, table, _print_groups(each), None, shingle, similarity), "print-roots")
    return _united(keyed, table, each.select("node", "n", F.explode("bands").alias("band")), near, shingle, similarity)


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id (NULL ids last). Columns as in ``docs``.

    Two texts are linked if the Jaccard similarity of their shingle sets is ``similarity`` or more, and a group is what
    links connect. Texts without words are one group, NULL ones too; of repeated rows one stays.
    """
    key = fresh(docs.columns, "key_now")
    named = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")), F.lit(":"), text_key(text_col))
    marked = docs.withColumn(key, named)
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    keyed = marked.select(F.col(f"`{id_col}`").alias("id"), F.col(key).alias("key"), text)
    table = stored(_nodes(keyed, shingle), "shingle-sets")
    roots = _roots(keyed.select("key", "text"), table, shingle, similarity)
    at = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    least = table.groupBy("node").agg(F.min(at).alias("least"))
    rooted = least.join(roots, "node", "left")
    winners = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    kept = marked.join(winners.select(F.col("least.key").alias(key)), key, "left_semi")
    repeated = not table.groupBy("key").count().where("count > 1").isEmpty()
    return (kept.dropDuplicates([key]) if repeated else kept).drop(key)
