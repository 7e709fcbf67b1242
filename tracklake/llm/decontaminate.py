"""Benchmark decontamination with DataFrame functions only.

The benchmark's word n-grams (``window`` words; a shorter item is one window) are hashed by their first words. Every
position of every document is tested against that hash set; only the few positions that pass build their whole
window, and a join on the window itself verifies the hit. The hash set travels with the query while it is small
(``set_limit`` hashes, counted first); beyond that the positions are exploded and joined, with the same result.

What is decided about a text is keyed by a 128-bit hash of the text, so thousands of copies are decided once and neither NULL nor
repeated ids matter. Hits are few; they are written once to the shared folder and joined back, broadcast only if
they were counted to be few. Documents are then not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import drop_named, fresh, stored, text_key

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEAD = 3
ADDED = ("n_words", "n_hit", "n_items", "items", "hit_spans", "contaminated")


def words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, with A-Z lower-cased; NULL has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def _head(array: Column, at: Column, size: int) -> Column:
    """Hash of the words from the 1-based position ``at`` on; words beyond the end count as missing."""
    return F.xxhash64(*[F.get(array, at - 1 + k) for k in range(size)])


def _starts(array: Column, width: int, heads: list[int]) -> Callable[[Column], Column]:
    return lambda at: _head(array, at, width).isin(heads)


def _sized(size: int) -> Callable[[Column], Column]:
    return lambda at: F.struct(at.alias("at"), F.lit(size).alias("size"))


def _window(array: Column, at: Column, size: Column | int) -> Column:
    return F.array_join(F.slice(array, at, size), " ")


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows: ``window`` (text), ``size`` (words), ``head`` (hash), ``items`` (ids as sorted strings).

    A NULL id counts as the item ''. An item without words has no window.
    """
    split = items.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"),
        words(F.col(f"`{text_col}`").cast("string")).alias("w"),
    ).where(F.size("w") > 0)
    size = F.least(F.lit(window), F.size("w"))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    cut = split.select("item", size.alias("size"), at.alias("at"), "w")
    head = F.when(F.col("size") >= HEAD, _head(F.col("w"), F.col("at"), HEAD))
    for k in range(HEAD - 1, 0, -1):
        head = F.when(F.col("size") == k, _head(F.col("w"), F.col("at"), k)).otherwise(head)
    return (
        cut.select("item", "size", _window(F.col("w"), F.col("at"), F.col("size")).alias("window"), head.alias("head"))
        .groupBy("window", "size", "head")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


@dataclass(frozen=True)
class Hits:
    """Verified hits by text: ``key``, ``spans`` (from, to: 1-based words, both inclusive), ``items``; and their count."""

    rows: DataFrame
    count: int


def find_hits(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 13, set_limit: int = 50_000,
) -> Hits:
    """Every occurrence of a benchmark window in a document."""
    grams = stored(benchmark_windows(items, item_id, item_text, window), "benchmark-windows")
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # at most ``window`` values
    n_grams = grams.count()
    w, at = F.col("w"), F.col("at")
    text = F.col(f"`{text_col}`").cast("string")
    # Behind a generator the words are made once; a plain projection would be repeated inside every lambda.
    split = docs.select(text_key(text_col).alias("key"), F.explode(F.array(words(text))).alias("w"))
    if n_grams <= set_limit:
        found = []
        for size in sizes:
            width = min(size, HEAD)
            rows = grams.where(F.col("size") == size).select("head").distinct().collect()  # at most set_limit
            heads = [r["head"] for r in rows]
            places = F.when(F.size("w") >= size, F.sequence(F.lit(1), F.size("w") - size + 1)).otherwise(
                F.array().cast("array<int>")
            )
            hit = F.filter(places, _starts(w, width, heads))
            found.append(F.transform(hit, _sized(size)))
        places = F.concat(*found) if found else F.array().cast("array<struct<at:int,size:int>>")
        cut = split.select("key", "w", F.explode(places).alias("p")).select("key", "w", "p.at", "p.size")
        candidates = cut.select("key", "at", "size", _window(w, at, F.col("size")).alias("window"))
        verified = candidates.join(F.broadcast(grams.drop("head")), ["window", "size"])  # at most set_limit rows
    else:
        length = F.size("w")
        placed = split.where(length > 0).select("key", "w", F.explode(F.sequence(F.lit(1), length)).alias("at"))
        verified = None
        for width in sorted({min(s, HEAD) for s in sizes}):
            some = placed.select("key", "at", "w", _head(w, at, width).alias("head"))
            for size in (s for s in sizes if min(s, HEAD) == width):
                cut = some.where(F.size("w") - at + 1 >= size)
                cut = cut.select("key", "at", "head", F.lit(size).alias("size"), _window(w, at, size).alias("window"))
                more = cut.join(grams.where(F.col("size") == size), ["head", "size", "window"])
                more = more.select("key", "at", "size", "items")
                verified = more if verified is None else verified.unionByName(more)
    merged = (
        verified.groupBy("key")
        .agg(
            F.array_sort(F.collect_set(F.struct(F.col("at").alias("start"), (at + F.col("size") - 1).alias("end")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    rows = stored(merged, "benchmark-hits")
    return Hits(rows, rows.count())


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 13, share: int = 20, set_limit: int = 50_000, broadcast_limit: int = 50_000,
) -> DataFrame:
    """All rows and columns of ``docs`` with what was found in their texts.

    Adds ``n_words``, ``n_hit`` (words inside occurrences), ``items`` (ids found, as sorted strings), ``n_items``,
    ``hit_spans`` (1-based word ranges) and ``contaminated`` (``n_hit > 0 and share * n_hit >= n_words``). Columns of these
    names are replaced. NULL and empty texts have no words and are clean; an empty benchmark finds nothing; repeated rows and
    copies get equal results.
    """
    hits = find_hits(docs, items, text_col, item_id, item_text, window, set_limit)
    key = fresh([*docs.columns, *ADDED], "text_key_now")
    base = docs.withColumn(key, text_key(text_col))
    counted = base.withColumn("n_words", F.size(words(F.col(f"`{text_col}`").cast("string"))).cast("bigint"))
    counted = counted.select(*[counted[f"`{c}`"] for c in drop_named(docs, ADDED).columns], "n_words", key)
    places = F.transform("spans", lambda s: F.sequence(s["start"], s["end"]))
    found = hits.rows.select(
        F.col("key").alias(key),
        F.size(F.array_distinct(F.flatten(places))).cast("bigint").alias("n_hit"),
        "items",
        F.col("spans").alias("hit_spans"),
    )
    joined = counted.join(F.broadcast(found) if hits.count <= broadcast_limit else found, key, "left").drop(key)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (
        joined.withColumn("n_hit", n_hit)
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("n_items", F.size("items").cast("bigint"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )


def remove_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Take the hit words, each with the separators after it, out of the texts of :func:`decontaminate`'s result."""
    text = F.col(f"`{text_col}`")
    between = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # A-Z are word characters before lower-casing
    lead = F.regexp_extract(text, f"^[{between}]+", 0)
    pieces = F.regexp_extract_all(text, F.lit(f"([^{between}]+[{between}]*)"), 1)
    kept = F.filter(
        pieces, lambda _, i: ~F.exists(F.col("hit_spans"), lambda s: (i + 1 >= s["start"]) & (i + 1 <= s["end"]))
    )
    return docs.withColumn(
        text_col, F.when(F.col("n_hit") > 0, F.concat(lead, F.array_join(kept, ""))).otherwise(text)
    )
