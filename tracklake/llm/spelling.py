"""Spelling variants grouped by a dictionary of trie-node pairs.

The words are sorted into ranges, and each range walks its part of the forward trie with a stack: a word shares the nodes of
its common prefix with the word before it, and every further code point is a new node with the next number. The same is done with the
words reversed. A prefix that continues over the end of a range gets the number it has in the range before (one short
list per range boundary). So a word is two arrays of integers, its prefix nodes and its suffix nodes, and since the nodes of words
rise in sorted order, the number of a word's last node is its id and its rank at once.

A word's *skip* pairs are (prefix node up to i, suffix node after i); its *split* pairs are (prefix node up to i, suffix node
from i). Words with a skip pair in common differ in one replaced code point, there and nowhere else; a skip pair that equals another
word's split pair is a deleted or inserted code point. Equal integers are equal strings, so the neighbours are exact. In a run of
equal code points only the first counts for deletions, so each neighbour is met once. Pairs of words are never listed: a
dictionary entry is reduced to its number of words and its most frequent ones, which every member then looks up. (A form is ten
times as frequent as its variant, so the most frequent other word is all a variant needs to know of an entry.)
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import stored

#: As Latin-1 bytes: A-Z become a-z, letters and U+00C0 to U+00FF stay, everything else separates.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
FLUSH = 200_000
RANGE_BITS = 40
SPLIT, SKIP, SKIP_FIRST = 0, 1, 2


def words_of(text: str | None, doc: str, least: int, slip: int) -> Counter:
    """Words of a whole text with ``least`` code points or more, by Latin-1 bytes.

    With ``slip`` a run whose crc32 (of ``doc:run``) it divides loses the code point at crc32 modulo its length.
    """
    runs = Counter(w for w in (text or "").encode("latin-1", "replace").translate(_FOLD).split() if len(w) >= least)
    if not slip:
        return runs
    head = zlib.crc32(f"{doc}:".encode())
    out: Counter = Counter()
    for word, n in runs.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), head)
        if h % slip == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < least:
                continue
        out[word] += n
    return out


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, slip: int = 0, occurrences: int = 2
) -> DataFrame:
    """``word`` and ``n``: the words of all texts with ``occurrences`` or more. A NULL id counts as an empty one."""
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def counted() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                total.update(words_of(text.as_py(), doc.as_py(), least, slip))
                if len(total) >= FLUSH:
                    yield counted()
                    total.clear()
        if total:
            yield counted()

    counts = rows.mapInArrow(run, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    size = min(len(a), len(b))
    for k in range(size):
        if a[k] != b[k]:
            return k
    return size


def trie_paths(words: DataFrame, column: str) -> DataFrame:
    """All columns, ``range`` and ``path``: the numbers of the trie nodes of every prefix of ``column``, the root (0) first.

    ``column`` must be distinct and not NULL. Numbers are unique within a range of words; :func:`boundary_nodes` unites those of
    prefixes that several ranges share.
    """
    sorted_words = words.repartitionByRange(column).sortWithinPartitions(column)
    at = words.columns.index(column)
    schema = ", ".join(f"`{n}` {t}" for n, t in words.dtypes) + ", range int, path array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        node = number << RANGE_BITS
        before, path = "", [0]
        for batch in batches:
            paths = []
            for word in batch.column(at).to_pylist():
                same = _shared(before, word)
                new = len(word) - same
                path = [*path[: same + 1], *range(node + 1, node + 1 + new)]
                node += new
                before = word
                paths.append(path)
            ranges = pa.array(np.full(len(paths), number, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, ranges, pa.array(paths, pa.list_(pa.int64()))], names=[*batch.schema.names, "range", "path"]
            )

    return sorted_words.mapInArrow(run, schema)


def boundary_nodes(paths: DataFrame, column: str) -> dict[int, int]:
    """Numbers that stand for a node an earlier range has numbered too, and that earlier number.

    One row per range comes to the driver. Only the first word of a range can share a prefix with an earlier range, and its own
    nodes have the range's first numbers.
    """
    word = F.col(column)
    ends = paths.groupBy("range").agg(F.min(word).alias("first"), F.max(F.struct(word.alias("w"), "path")).alias("last"))
    stands: dict[int, int] = {}
    before, path = "", [0]
    for row in sorted(ends.collect(), key=lambda r: r["range"]):
        for depth in range(1, _shared(before, row["first"]) + 1):
            stands[(row["range"] << RANGE_BITS) + depth] = stands.get(path[depth], path[depth])
        before, path = row["last"]["w"], row["last"]["path"]
    return stands


def node_pairs(words: DataFrame, forward: dict[int, int], backward: dict[int, int]) -> DataFrame:
    """``p``, ``s``, ``kind``, ``id``, ``n``: the skip and split pairs of every row of (``word``, ``id``, ``n``, ``path``, ``back``)."""

    def named(stands: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array(sorted(stands), np.int64)
        return keys, np.array([stands[k] for k in keys.tolist()], np.int64)

    tables = named(forward), named(backward)

    def united(nodes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        keys, values = table
        if not len(keys):
            return nodes
        at = np.minimum(np.searchsorted(keys, nodes), len(keys) - 1)
        return np.where(keys[at] == nodes, values[at], nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                word, ids, ns, path, back = batch.columns
                size = np.fromiter(map(len, word.to_pylist()), np.int64, len(word)) + 1
                first = np.concatenate([[0], np.cumsum(size)])
                row = np.repeat(np.arange(len(size)), size)
                place = np.arange(first[-1]) - first[row]
                prefix = united(path.flatten().to_numpy(), tables[0])
                # The suffix that starts at each place: the reversed word's nodes from the far end.
                suffix = united(back.flatten().to_numpy(), tables[1])[first[row] + size[row] - 1 - place]
                head = np.flatnonzero(place < size[row] - 1)
                points = np.frombuffer("".join(word.to_pylist()).encode("utf-32-le"), np.uint32)
                fresh = np.concatenate([[True], points[1:] != points[:-1]]) if len(points) else np.zeros(0, bool)
                fresh[place[head] == 0] = True
                kind = np.concatenate([np.full(len(row), SPLIT), np.where(fresh, SKIP_FIRST, SKIP)]).astype(np.int8)
                rows = np.concatenate([row, row[head]])
                columns = [
                    np.concatenate([prefix, prefix[head]]), np.concatenate([suffix, suffix[head + 1]]), kind,
                    ids.to_numpy()[rows], ns.to_numpy()[rows],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["p", "s", "kind", "id", "n"])

    chosen = words.select("word", "id", "n", "path", "back")
    return chosen.mapInArrow(run, "p bigint, s bigint, kind tinyint, id bigint, n bigint")


def neighbours(pairs: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best`` (n, -id) of the words that have a near word.

    ``best`` is the most frequent near word (of equal ones the smallest), if one is more frequent than the word itself; else
    it may be NULL or any near word that is not. An entry holds at most one word per code point, and one split pair.
    """
    kind = F.col("kind")
    word = F.struct("n", (-F.col("id")).alias("m"))
    entries = pairs.groupBy("p", "s").agg(
        F.count_if(kind > SPLIT).alias("skips"),
        F.count_if(kind == SKIP_FIRST).alias("firsts"),
        F.max(F.when(kind > SPLIT, word)).alias("top"),
        F.max(F.when(kind == SKIP_FIRST, word)).alias("top_first"),
        F.max(F.when(kind == SPLIT, word)).alias("whole"),
    )
    entries = entries.where((F.col("skips") > 1) | ((F.col("firsts") > 0) & F.col("whole").isNotNull()))
    met = pairs.join(entries, ["p", "s"])
    longer = (kind == SKIP_FIRST) & F.col("whole").isNotNull()
    near = F.when(kind == SPLIT, F.col("firsts")).otherwise(F.col("skips") - 1 + longer.cast("int"))
    other = F.when(F.col("top.m") != -F.col("id"), F.col("top"))
    best = F.when(kind == SPLIT, F.col("top_first")).otherwise(F.greatest(other, F.when(longer, F.col("whole"))))
    return met.groupBy("id").agg(F.sum(near).alias("n_near"), F.max(best).alias("best")).where("n_near > 0")


def _roots(links: DataFrame) -> DataFrame:
    """``id`` and ``root`` of (``id``, ``to``) by pointer doubling: forms grow tenfold a step, so five rounds are enough for longs."""
    links = stored(links, "forms")
    while True:
        on = links.select(F.col("id").alias("to"), F.col("to").alias("next"))
        if links.join(on, "to", "left_semi").isEmpty():
            return links.withColumnRenamed("to", "root")
        links = stored(links.join(on, "to", "left").select("id", F.coalesce("next", "to").alias("to")), "forms")


def group_variants(counts: DataFrame, times: int = 10) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every row of (``word``, ``n``), whose words are distinct.

    Two words are near if one inserted, deleted or replaced code point makes them equal. The form is the near word of largest n (of
    equal ones the smallest by code points) if that is at least ``times`` (two or more) the word's; the root is the end of the chain of
    forms, the word itself if it has none. Words of any length and alphabet are compared, the empty word included; NULL words
    are left out.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its variant")
    counts = stored(counts.select("word", "n").where("word IS NOT NULL"), "words")
    paths = stored(trie_paths(counts, "word").withColumn("id", F.element_at("path", -1)), "forward-trie")
    reversed_words = paths.select(F.reverse("word").alias("reversed"), "id")
    backs = stored(trie_paths(reversed_words, "reversed"), "backward-trie")
    joined = paths.select("word", "id", "n", "path").join(backs.select("id", F.col("path").alias("back")), "id")
    pairs = node_pairs(joined, boundary_nodes(paths, "word"), boundary_nodes(backs, "reversed"))
    near = stored(neighbours(pairs.repartition("p", "s")), "near-words")
    named = paths.select("id", "word", "n")
    forms = named.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("best.n") >= F.col("n") * times, F.col("best")).alias("best"),
    )
    forms = stored(forms, "words-and-forms")
    links = forms.where("best IS NOT NULL").select("id", (-F.col("best.m")).alias("to"), F.col("best.n").alias("form_n"))
    roots = _roots(links.select("id", "to"))
    texts = named.select(F.col("id").alias("to"), F.col("word").alias("form"))
    last = named.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    found = links.join(texts, "to").join(roots, "id").join(last, "root").select("id", "form", "form_n", "root_word")
    return forms.join(found, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
