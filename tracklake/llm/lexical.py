"""Ranked lexical search: Block-Max MaxScore over an index of document shards.

The index has one row per shard, a bounded run of documents of one task. A shard holds, for every term, its postings in
compressed blocks, and beside them each block's last document, largest term frequency and shortest document. None of this
depends on the rest of the corpus: shards are built in one pass without a shuffle, and new documents are new shards.

A search first sums the corpus statistics of the queries' terms over the shards. A shard is then searched term by term, by
falling bound (the best score that the list can give anywhere in the shard). Partial scores raise the threshold; as soon as
the lists that are left cannot reach it together, they are *non-essential*: they bring in no new candidate. For the
candidates found until then, the block maxima of the non-essential lists are added up, and who cannot reach the threshold is
rejected before a block is decompressed. The survivors' blocks are read, the heap of the task carries its threshold on to the
task's next shard, and the heaps of all tasks are merged by one small shuffle.

A row of the index has some MB. It is stored as a row group of its own, and goes to Python alone, so that a task holds one shard
at a time: readers unpack all rows of a row group together, up to 4,096.

Scores are whole numbers, so a candidate is rejected only if its bound is *below* the threshold: equal scores are ranked by id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm.common import small_batches, stored

BLOCK = 128
#: Of Parquet's writer: each shard is a row group.
ONE_BY_ONE = {"parquet.block.row.count.limit": "1"}
WIDTHS = (1, 2, 4)

#: Bytes that separate terms become a space, A-Z become a-z; every byte of a character beyond ASCII belongs to a term.
_SEPARATES = [c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)]
_FOLD = bytes(32 if c in _SEPARATES else c + 32 if 65 <= c <= 90 else c for c in range(256))

INDEX = (
    "ids array<bigint>, lengths array<bigint>, terms binary, list_start array<int>, list_docs array<int>, "
    "block_last array<int>, block_tf array<bigint>, block_least array<bigint>, block_at array<bigint>, "
    "gap_width array<tinyint>, tf_width array<tinyint>, postings binary, n_docs bigint, n_terms bigint"
)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a whole text, with repeats, as UTF-8."""
    return (text or "").encode("utf-8").translate(_FOLD).split()


def _widths(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4)).astype(np.int8)


def _pack(data: np.ndarray, at: np.ndarray, values: np.ndarray, widths: np.ndarray) -> None:
    """Write each value, little-endian in its width, at its place."""
    for width in WIDTHS:
        some = np.flatnonzero(widths == width)
        raw = values[some].astype(f"<u{width}").view(np.uint8).reshape(-1, width)
        data[at[some][:, None] + np.arange(width)] = raw


class Held:
    """Documents of a shard in the making: the numbers of their terms, by arrival, and how often each occurs."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.number: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []

    def add(self, doc: int | None, count: Counter) -> None:
        number = self.number
        self.ids.append(doc)
        self.terms.append(np.fromiter((number.setdefault(t, len(number)) for t in count), np.int32, len(count)))
        self.tf.append(np.fromiter(count.values(), np.int32, len(count)))


def shard_of(ids: list[int | None], counts: list[Counter]) -> dict[str, object]:
    """The index row of one shard: ``counts`` has the term frequencies of each document."""
    held = Held()
    for doc, count in zip(ids, counts, strict=True):
        held.add(doc, count)
    return shard_row(held)


def shard_row(held: Held) -> dict[str, object]:
    """The index row of the documents held."""
    none = np.zeros(0, np.int32)
    sizes = np.fromiter(map(len, held.terms), np.int64, len(held.terms))
    lengths = np.fromiter((n.sum(dtype=np.int64) for n in held.tf), np.int64, len(held.tf))
    vocabulary = sorted(held.number)
    rank = np.zeros(len(vocabulary), np.int32)
    rank[np.fromiter(map(held.number.__getitem__, vocabulary), np.int64, len(vocabulary))] = np.arange(len(vocabulary))
    term = rank[np.concatenate([none, *held.terms])]
    order = np.argsort(term, kind="stable")
    term = term[order]
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
    tf = np.concatenate([none, *held.tf])[order]
    del order
    df = np.bincount(term, minlength=len(vocabulary))
    start = np.concatenate([[0], np.cumsum(df)])
    blocks = -(-df // BLOCK)
    list_start = np.concatenate([[0], np.cumsum(blocks)])
    place = np.arange(len(term)) - start[term]
    block = list_start[term] + place // BLOCK
    inside = (place % BLOCK).astype(np.int32)
    first = np.flatnonzero(inside == 0)
    gap = doc - np.where(place == 0, -1, np.concatenate([[np.int32(-1)], doc[:-1]])) - 1
    del place
    size = np.diff(np.append(first, len(term)))
    top = lambda values, how: how.reduceat(values, first) if len(first) else none
    gap_width, tf_width = _widths(top(gap, np.maximum)), _widths(top(tf, np.maximum))
    at = np.concatenate([[0], np.cumsum(size * (gap_width.astype(np.int64) + tf_width))])
    data = np.zeros(int(at[-1]), np.uint8)
    _pack(data, at[block] + inside * gap_width[block], gap, gap_width[block])
    _pack(data, at[block] + size[block] * gap_width[block] + inside * tf_width[block], tf, tf_width[block])
    return {
        "ids": held.ids, "lengths": lengths, "terms": b"\n".join(vocabulary), "list_start": list_start.astype(np.int32),
        "list_docs": df.astype(np.int32), "block_last": doc[first + size - 1].astype(np.int32),
        "block_tf": top(tf, np.maximum).astype(np.int64), "block_least": top(lengths[doc], np.minimum), "block_at": at,
        "gap_width": gap_width, "tf_width": tf_width, "postings": data.tobytes(),
        "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
    }


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = 16_384, shard_chars: int = 1 << 24
) -> DataFrame:
    """One row per shard of at most ``shard_docs`` documents and about ``shard_chars`` characters (one document at least).

    A NULL or empty text is a document without terms; a NULL id stays NULL; a repeated row is a document of its own. Other
    columns are not read. The id must be a whole number.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    types = {f.name: f.dataType for f in rows.sparkSession.createDataFrame([], INDEX).schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        held, chars = Held(), 0

        def row() -> pa.RecordBatch:
            made = shard_row(held)
            arrays = [pa.array([made[name]], to_arrow_type(kind)) for name, kind in types.items()]
            return pa.RecordBatch.from_arrays(arrays, names=list(types))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_py()
                held.add(doc, Counter(terms_of(words)))
                chars += len(words or "")
                if len(held.ids) >= shard_docs or chars >= shard_chars:
                    yield row()
                    held, chars = Held(), 0
        if held.ids:
            yield row()

    return rows.mapInArrow(run, INDEX)


@dataclass(frozen=True)
class Ranking:
    """Corpus statistics a score needs: documents with terms, all their terms, and the weight of each term of the queries."""

    documents: int
    terms: int
    weights: dict[bytes, int]

    def parts(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What a posting adds per unit of weight; it grows with the frequency and falls with the document's length."""
        m = 50 + 50 * length * self.documents // max(1, self.terms)
        return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def ranking_of(index: DataFrame, terms: set[bytes]) -> Ranking:
    """Statistics of the whole index for ``terms``; one row per term comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for blob, docs in zip(batch.column(0), batch.column(1), strict=True):
                held = blob.as_py().split(b"\n")
                df = docs.values.to_numpy()
                for k, term in enumerate(held):
                    if term in terms:
                        total[term] += int(df[k])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["term", "df"]
        )

    sums = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    documents, words = int(sums[0] or 0), int(sums[1] or 0)
    found = index.select("terms", "list_docs").mapInArrow(run, "term binary, df bigint").groupBy("term").agg(F.sum("df"))
    return Ranking(documents, words, {bytes(t): weight(documents, n) for t, n in found.collect()})


class Shard:
    """One shard of the index, opened for a set of queries. Blocks are decompressed when first read, and kept."""

    def __init__(self, row: dict[str, object], ranking: Ranking):
        self.lengths, self.ranking = row["lengths"], ranking
        self.start, self.last, self.at = row["list_start"], row["block_last"], row["block_at"]
        self.gap_width, self.tf_width, self.postings = row["gap_width"], row["tf_width"], row["postings"]
        self.bound = ranking.parts(row["block_tf"], row["block_least"])
        wanted = ranking.weights
        self.lists = {t: k for k, t in enumerate(row["terms"].split(b"\n")) if t in wanted}
        self.size = {t: int(row["list_docs"][k]) for t, k in self.lists.items()}
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def list_bound(self, term: bytes) -> int:
        k = self.lists[term]
        return self.ranking.weights[term] * int(self.bound[self.start[k] : self.start[k + 1]].max())

    def block(self, term: bytes, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block, and what the term adds to their scores."""
        if number not in self.read:
            k = self.lists[term]
            count = min(BLOCK, self.size[term] - (number - int(self.start[k])) * BLOCK)
            gaps_wide, tf_wide, at = int(self.gap_width[number]), int(self.tf_width[number]), int(self.at[number])
            gap = np.frombuffer(self.postings, f"<u{gaps_wide}", count, at).astype(np.int64)
            tf = np.frombuffer(self.postings, f"<u{tf_wide}", count, at + count * gaps_wide).astype(np.int64)
            before = int(self.last[number - 1]) if number > self.start[k] else -1
            docs = before + np.cumsum(gap + 1)
            self.read[number] = docs, self.ranking.weights[term] * self.ranking.parts(tf, self.lengths[docs])
        return self.read[number]

    def blocks(self, term: bytes, numbers: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(term, int(n)) for n in numbers]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def search(self, terms: Sequence[bytes], k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the ``k`` best with their whole scores, none below ``threshold``; all of the k best are."""
        bounds = {t: self.list_bound(t) for t in terms if t in self.lists}
        order = sorted(bounds, key=bounds.__getitem__, reverse=True)
        left = np.append(np.cumsum([bounds[t] for t in order][::-1])[::-1], 0)
        score = np.zeros(len(self.lengths), np.int64)
        done = 0
        while done < len(order) and left[done] >= threshold:  # essential: alone, the lists left could still reach it
            n = self.lists[order[done]]
            docs, adds = self.blocks(order[done], range(self.start[n], self.start[n + 1]))
            score[docs] += adds
            done += 1
            if done < len(order) and len(score) >= k:
                threshold = max(threshold, int(np.partition(score, -k)[-k]))
        docs = np.flatnonzero((score > 0) & (score + left[done] >= threshold))
        rest = order[done:]
        where, most = [], []
        for term in rest:
            n = self.lists[term]
            lo, hi = int(self.start[n]), int(self.start[n + 1])
            number = lo + np.searchsorted(self.last[lo:hi], docs)
            bound = self.ranking.weights[term] * self.bound[np.minimum(number, hi - 1)]
            where.append(number)
            most.append(np.where(number < hi, bound, 0))
        for j, term in enumerate(rest):
            stays = score[docs] + sum(most[j:]) >= threshold
            docs, where, most = docs[stays], [w[stays] for w in where], [m[stays] for m in most]
            inside = most[j] > 0
            if inside.any():
                held, adds = self.blocks(term, np.unique(where[j][inside]))
                at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
                score[docs] += np.where(held[at] == docs, adds[at], 0)
        docs = docs[score[docs] >= threshold]
        return docs, score[docs]


def _best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best by score, then id, NULL ids last."""
    pick = np.lexsort((ids, ~known, -scores))[:k]
    return scores[pick], ids[pick], known[pick]


def _heaps(index: DataFrame, queries: list[tuple[int, list[bytes]]], ranking: Ranking, k: int) -> DataFrame:
    """``number``, ``id`` and ``score``: the k best documents of each query in each task."""

    def opened(batch: pa.RecordBatch, row: int) -> dict[str, object]:
        held = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            value = column[row]
            held[name] = value.values if pa.types.is_list(column.type) else value.as_py()
            if name != "ids" and pa.types.is_list(column.type):
                held[name] = held[name].to_numpy(zero_copy_only=False)
        return held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        heap = {number: (none, none, none.astype(bool)) for number, _ in queries}
        for batch in batches:
            for row in range(batch.num_rows):
                held = opened(batch, row)
                known = ~held["ids"].is_null().to_numpy(zero_copy_only=False)
                ids = held["ids"].fill_null(0).to_numpy(zero_copy_only=False)
                shard = Shard(held, ranking)
                for number, terms in queries:
                    best = heap[number]
                    threshold = int(best[0][-1]) if len(best[0]) == k else 1
                    docs, scores = shard.search(terms, k, threshold)
                    if len(docs):
                        both = (np.concatenate(p) for p in zip(best, (scores, ids[docs], known[docs]), strict=True))
                        heap[number] = _best(*both, k)
        for number, (scores, ids, known) in heap.items():
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), number)), pa.array(ids, mask=~known), pa.array(scores)],
                    names=["number", "id", "score"],
                )

    return index.mapInArrow(run, "number bigint, id bigint, score bigint")


def search(
    index: DataFrame, queries: DataFrame, key_col: str = "item_id", text_col: str = "text", k: int = 50, id_col: str = "doc_id",
    query_block: int = 4096,
) -> DataFrame:
    """``key_col``, ``rank`` (from 1), ``id_col``, ``score``: the ``k`` documents of highest score above 0 for each key.

    Rows of one key are one query of all their terms, each counted once; a NULL key is a key like any other. Equal scores
    are ranked by id, NULL ids last. A query without terms that occur has no rows, and an empty index or query table gives none.
    Queries go to the shards in blocks of about ``query_block`` keys, so that what travels is bounded.
    """
    spark = index.sparkSession
    asked = queries.select(F.col(f"`{key_col}`").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    asked = stored(asked.groupBy("key").agg(F.collect_list("text").alias("texts")), "queries")
    blocks = -(-asked.count() // query_block)
    out = spark.createDataFrame([], f"number bigint, id bigint, score bigint, key {asked.schema['key'].dataType.simpleString()}")
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).collect()
        sought = [(n, {t for text in r["texts"] for t in terms_of(text)}) for n, r in enumerate(rows)]
        ranking = ranking_of(index, set().union(*(t for _, t in sought)))
        # Terms in a fixed order, so that a task run anew does the same work.
        plan = [(n, sorted(t & ranking.weights.keys())) for n, t in sought]
        names = spark.createDataFrame([(n, r["key"]) for n, r in enumerate(rows)], f"number bigint, {asked.schema['key'].simpleString()}")
        found = _heaps(index, [q for q in plan if q[1]], ranking, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        named = found.join(F.broadcast(names), "number")  # one row per key of the block
        out = out.unionByName(named.select("number", "id", "score", "key", "rank"), allowMissingColumns=True)
    if not blocks:
        out = out.withColumn("rank", F.lit(0))
    return out.select(F.col("key").alias(key_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def ranked_search(
    docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str = "item_id",
    query_col: str = "text", k: int = 50,
) -> DataFrame:
    """Index ``docs``, write the index to the shared folder, and :func:`search` it."""
    small_batches(docs.sparkSession)
    index = stored(build_index(docs, id_col, text_col), "lexical-index", ONE_BY_ONE)
    return search(index, queries, key_col, query_col, k, id_col)
